import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from fieldlake.session import local_session

    return local_session(8, shuffle_partitions=4)


@pytest.fixture
def small():
    return SMALL
