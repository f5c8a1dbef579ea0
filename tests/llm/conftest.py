import os
from pathlib import Path

import pytest

# the workers import the package by name
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [str(Path(__file__).resolve().parents[2]), os.environ.get("PYTHONPATH")]))

DOCS = "doc_id long, text string, source string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from texts; ids from 0, or (id, text) pairs."""

    def make(texts):
        rows = [(t if isinstance(t, tuple) else (i, t)) for i, t in enumerate(texts)]
        return spark.createDataFrame([(i, t, "s") for i, t in rows], DOCS)

    return make
