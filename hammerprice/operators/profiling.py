"""Summaries and null reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hammerprice.operators.row_order import order_rows
from hammerprice.schemas import STOREY_LABELS
from hammerprice.session import materialize


def band_summary(
    df: DataFrame,
    band: str = "storey_range_grouped",
    value: str = "storey_max",
    labels: Sequence[str] = tuple(STOREY_LABELS),
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Min, max and count of `value` per band in band order; a band without rows stays with count 0."""
    spark = df.sparkSession
    bands = spark.createDataFrame(list(enumerate(labels, start=1)), f"_rank int, {band} string")
    found = df.groupBy(band).agg(
        F.min(value).alias("min_storey"), F.max(value).alias("max_storey"), F.count(value).alias("counts"), *extra
    )
    return (
        bands.join(found, band, "left")
        .withColumn("counts", F.coalesce("counts", F.lit(0)))
        .orderBy("_rank")
        .drop("_rank")
    )


def min_max_count(df: DataFrame, key: str, value: str, names: tuple[str, str, str], order: str | None = None):
    """Min, max and non-null count per key, for the keys present; sorted by `order`, then the key."""
    low, high, n = names
    summary = df.groupBy(key).agg(F.min(value).alias(low), F.max(value).alias(high), F.count(value).alias(n))
    return summary.orderBy(*([order] if order else []), key)


def distinct_lists(df: DataFrame, key: str, lists: dict[str, str], limit: int | None = None) -> DataFrame:
    """Sorted distinct non-null values of some columns per key, as arrays named by `lists`.

    With `limit` only the first keys, whose values alone are gathered. For keys of very many values take `distinct_pages`.
    """
    if limit:
        first = df.select(F.col(key).alias("_key")).distinct().orderBy("_key").limit(limit)
        # At most `limit` rows.
        df = df.join(F.broadcast(first), F.col(key).eqNullSafe(F.col("_key")), "left_semi")
    grouped = df.groupBy(key).agg(*[F.sort_array(F.collect_set(c)).alias(name) for name, c in lists.items()])
    return grouped.orderBy(key)


def distinct_pages(df: DataFrame, key: str, columns: Sequence[str], page: int = 10_000) -> DataFrame:
    """(key, column, page, values): the distinct non-null texts of `columns` per key, ascending, `page` of them to an array.

    The pairs of key and value are made distinct first and numbered in a range sort, so that a key of any number of
    values spreads over many tasks and no array grows with the table.
    """
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    pairs = df.select(F.col(key).alias("key"), F.inline(F.array(*cells))).where("value IS NOT NULL").distinct()
    placed = materialize(order_rows(pairs, ["key", "column", "value"]).indexed("row"), "distinct-pairs")
    starts = placed.groupBy(F.col("key").alias("_key"), F.col("column").alias("_column")).agg(F.min("row").alias("_first"))
    # NULL is a key too.
    same = F.col("key").eqNullSafe(F.col("_key")) & (F.col("column") == F.col("_column"))
    number = F.floor((F.col("row") - F.col("_first")) / page).cast("long").alias("page")
    numbered = placed.join(starts, same).select("key", "column", number, "value")
    return numbered.groupBy("key", "column", "page").agg(F.sort_array(F.collect_list("value")).alias("values"))


def grouped_facts(df: DataFrame, sets: Sequence[Sequence[str]], *measures: Column) -> DataFrame:
    """All `measures` for every grouping in `sets`, in one aggregate over one scan; `of_grouping` takes one of them out."""
    columns = list(dict.fromkeys(c for group in sets for c in group))
    grouped = df.groupingSets([list(group) for group in sets], *columns)
    return materialize(grouped.agg(F.grouping_id().alias("_grouping"), *measures), "facts")


def of_grouping(facts: DataFrame, columns: Sequence[str], group: Sequence[str]) -> DataFrame:
    """The rows of one grouping of `grouped_facts`, where `columns` are all grouping columns in order."""
    number = sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in group)
    return facts.where(F.col("_grouping") == number)


def null_counts(df: DataFrame, columns: list[str] | None = None, by: str | None = None) -> DataFrame:
    """(column, rows, nulls) per column, and per value of `by`; one map-side combined pass."""
    columns = columns or [c for c in df.columns if c != by]
    counts = [F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    grouped = df.groupBy(by) if by else df.groupBy()
    wide = grouped.agg(F.count(F.lit(1)).alias("_rows"), *counts)
    return wide.unpivot([by, "_rows"] if by else ["_rows"], columns, "column", "nulls").withColumnRenamed(
        "_rows", "rows"
    )


def newly_null(raw: DataFrame, typed: DataFrame, columns: list[str], key: Column | None = None) -> DataFrame:
    """(column, raw_nulls, typed_nulls, newly_null): what a lenient cast lost, from two narrow scans."""
    before = null_counts(raw, columns).select("column", F.col("nulls").alias("raw_nulls"))
    after = null_counts(typed, columns).select("column", F.col("nulls").alias("typed_nulls"))
    return before.join(after, "column").withColumn("newly_null", F.col("typed_nulls") - F.col("raw_nulls"))


def top_rows(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    return df.orderBy(*order).limit(n)


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))
