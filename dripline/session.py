"""Session settings shared by jobs, tests and the bench."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": STATE_STORE,
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

_LOCAL_DIRS: dict[str, str] = {}


def local_session(cores: int | str = "*", app: str = "dripline", **extra: str) -> SparkSession:
    """A local session for tests and the bench; a cluster passes its own session in."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for written tables and stream checkpoints.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session, where the
    driver and the executors share one machine, falls back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="dripline-")
    return _LOCAL_DIRS[app]


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder for one run of one job."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def files_of(spark: SparkSession, path: str):
    """The file system a path is on, and the path as it takes it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def written(df: DataFrame, name: str) -> DataFrame:
    """Write rows to the shared folder and read them back: cheap to read again, safe to lose."""
    folder = scratch(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
