"""What the operators share: the columns they read, and batches that stay small whatever the rows hold."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hammerprice.session import scratch_path

#: Rows are handed to Python code in slices of at most so many rows and about so many bytes.
SLICE_ROWS = 512
SLICE_BYTES = 8 << 20


def id_and_bytes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id` and `text` alone, the text as its UTF-8 bytes and empty instead of null."""
    return df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"),
    )


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in slices bounded by rows and bytes (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        each = max(1, min(SLICE_ROWS, int(batch.num_rows * SLICE_BYTES / max(1, batch.nbytes))))
        for start in range(0, batch.num_rows, each):
            yield batch.slice(start, each)


def map_slices(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | StructType
) -> DataFrame:
    """`function` on every slice of `df`; it returns rows of `schema`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            if (out := function(part)) is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)


def packed(df: DataFrame, **beside: Column) -> DataFrame:
    """Whole rows of `df` in one column `row`, so that no name of theirs meets those of `beside`."""
    row = F.struct(*[F.col("`" + c.replace("`", "``") + "`").alias(c) for c in df.columns]).alias("row")
    return df.select(row, *[column.alias(name) for name, column in beside.items()])


def unpacked(df: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The rows of `packed` again, some columns `changed`."""
    return df.select(*[changed.get(c, F.col("row").getField(c)).alias(c) for c in columns])


def written(df: DataFrame, label: str) -> DataFrame:
    """`df` written as Parquet to the shared scratch folder and read back: cuts the lineage and outlives executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished steps now, not when the driver's heap happens to fill."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()
