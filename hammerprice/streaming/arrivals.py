"""React to newly landed snapshots."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from hammerprice.sources.snapshots import announcements, read_latest


def on_new_snapshots(
    spark: SparkSession, root: str, job: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Call ``job(current raw table, batch id)`` once for all snapshots that were completed since the last run.

    The stream watches the signals of complete snapshots, a bounded number of empty files: which snapshots
    are the newest is in the manifest, and contents are read by the batch reader, which binds columns by
    name. A snapshot replaces its source's older one as a whole, so the job always sees the newest complete
    one of each source. The batch id makes a repeated call after a failure recognisable.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(announcements(root))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)

    def handle(batch: DataFrame, batch_id: int) -> None:
        job(read_latest(batch.sparkSession, root), batch_id)  # a batch is there because there are new signals

    return (
        spark.readStream.text(announcements(root))
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
