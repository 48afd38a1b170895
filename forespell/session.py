"""Session helpers: a local session for tests, and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
_local_dirs: dict[str, str] = {}


def local_session(cores: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A local session with the settings the tests and the benchmark use."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("forespell")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A temporary folder stands in for it only when the master is local; on a
    cluster an unset ``spark.checkpoint.dir`` is an error, because files on one
    machine are neither visible to nor safe from the loss of another.
    """
    named = spark.conf.get(_CHECKPOINT_KEY, None)
    if named:
        return named
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError(f"set {_CHECKPOINT_KEY} to a folder shared by all executors")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="forespell-")
    return _local_dirs[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and continue from the copy."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
