"""Session settings and the shared work folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. Shuffle width is left to the cluster: AQE
# coalesces small partitions and splits skewed ones at run time.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM does not compile methods over 8,000 bytes; scoring twelve rules in
    # one generated method ran 13 times slower than in split ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Sessions of a hot sensor are merged on the map side before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session made elsewhere."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("fieldlake")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


@functools.cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="fieldlake-")


def shared_base(spark: SparkSession) -> str:
    """The folder all executors see, named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting falls back to a folder on
    this machine; on a cluster a missing setting is an error, because a local
    folder would not be seen by the other executors.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local"):
        return _local_base()
    raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a reduced table to the shared folder and read it back.

    Cuts the lineage, and gives Catalyst the true size: it broadcasts the table
    when that is under the threshold, and shuffles otherwise.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tasks_for(rows: int, each: int = 250_000) -> int:
    """Partitions of at most about ``each`` rows, so that a task's hash table does not grow with the table."""
    return max(2, -(-rows // each))


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the maker of its paths."""
    to_path = spark._jvm.org.apache.hadoop.fs.Path
    return to_path(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), to_path


def path_exists(spark: SparkSession, path: str) -> bool:
    files, to_path = file_system(spark, path)
    return files.exists(to_path(path))


def is_folder(spark: SparkSession, path: str) -> bool:
    files, to_path = file_system(spark, path)
    return files.getFileStatus(to_path(path)).isDirectory()


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, not yet existing path under the shared folder."""
    return f"{shared_base(spark)}/{name}-{uuid.uuid4().hex}"
