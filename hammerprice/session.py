"""Session settings and durable intermediate tables."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def local_session(app_name: str, cores: str | int = "*", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update(conf)
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the one the cluster names in spark.checkpoint.dir.

    Each application has a folder of its own in it, which can be dropped once the application has ended.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    app_id = spark.sparkContext.applicationId
    if configured:
        return f"{configured.rstrip('/')}/hammerprice/{app_id}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if app_id not in _local_roots:
        _local_roots[app_id] = tempfile.mkdtemp(prefix="hammerprice-")
    return _local_roots[app_id]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` as Parquet to the shared scratch folder and read it back.

    Cuts the lineage, survives the loss of any executor and keeps later reads columnar.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_dropping: dict[str, tuple[int, str | None]] = {}
_dropping_lock = threading.Lock()


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Jobs that start inside delete their shuffle files once they end, not when the driver happens to collect garbage.

    For what is written and read back. Threads may be inside together; the last one out restores the setting.
    """
    session = spark.sparkContext.applicationId
    with _dropping_lock:
        inside, before = _dropping.get(session, (0, spark.conf.get(_DROP_SHUFFLES, None)))
        _dropping[session] = inside + 1, before
        spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        with _dropping_lock:
            inside, before = _dropping.pop(session)
            if inside > 1:
                _dropping[session] = inside - 1, before
            elif before is None:
                spark.conf.unset(_DROP_SHUFFLES)
            else:
                spark.conf.set(_DROP_SHUFFLES, before)


def drop_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables; no frame that reads one may be used afterwards.

    For the end of an application, or between the jobs of a long one.
    """
    drop_path(spark, scratch_root(spark))


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate tables that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
