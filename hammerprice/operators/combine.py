"""Unions, aligned outer joins and set comparisons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hammerprice.session import dropping_shuffles, materialize

_CHUNK = 100_000
#: Hashes of repeated rows that every task may hold.
_FEW = 1_000_000


def union_all(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames by column name; a column a frame lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def align_full(frames: list[DataFrame], sort: bool = False) -> DataFrame:
    """Full outer join of all frames on every column they share, left to right.

    NULL keys match nothing and rows that repeat on both sides multiply. A column outside the key may
    occur in one frame only. With `sort` the result is ordered by the shared columns.
    """
    shared = [c for c in frames[0].columns if all(c in f.columns for f in frames)]
    if not shared:
        raise ValueError("the frames share no column")
    extras = [c for f in frames for c in f.columns if c not in shared]
    twice = sorted({c for c in extras if extras.count(c) > 1})
    if twice:
        raise ValueError(f"columns outside the key occur in several frames: {twice}")
    joined = _align_with_extras(frames, shared) if extras else _align_identical(frames, shared)
    return joined.orderBy(*shared) if sort else joined


def _align_with_extras(frames: list[DataFrame], on: list[str]) -> DataFrame:
    # Each step reads its sides more than once, so all start from written tables.
    joined, *rest = [materialize(frame, "aligned") for frame in frames]
    for i, frame in enumerate(rest, start=1):
        joined = _full_outer(joined, frame, on)
        joined = materialize(joined, "aligned") if i < len(rest) else joined
    return joined


def _full_outer(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Full outer join as its parts.

    Adaptive execution splits a hot key on either side of an inner join and on the left of an anti join,
    but cannot split a full outer join. The anti joins look keys up in distinct keys, which are never hot.
    Rows with a NULL key match nothing and need no join; as both joins start from the same rows without
    one, their shuffles are the same and Spark runs them once.
    """
    filled = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on])
    left_filled, right_filled = left.where(filled), right.where(filled)
    matched = left_filled.join(right_filled, on)
    only_left = left_filled.join(right_filled.select(*on).distinct(), on, "left_anti")
    only_right = right_filled.join(left_filled.select(*on).distinct(), on, "left_anti")
    return union_all([matched, only_left, only_right, left.where(~filled), right.where(~filled)])


def _align_identical(frames: list[DataFrame], columns: list[str]) -> DataFrame:
    """`align_full` when every column is a key: only the number of copies of a row is open.

    A row whose hash no other row has comes out once, and is not moved at all: hashes alone are shuffled to find the others,
    which are compared and counted in full. So the frames are read twice; those that could tell something else the second
    time are written first.
    """
    frames = [f if f._jdf.queryExecution().analyzed().deterministic() else materialize(f, "aligned") for f in frames]
    tagged = [f.select(*columns, F.lit(i).alias("_frame")) for i, f in enumerate(frames)]
    hashed = reduce(DataFrame.unionByName, tagged).withColumn("_hash", F.xxhash64(*columns))
    repeated = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_hash")
    with dropping_shuffles(hashed.sparkSession):
        repeated = materialize(repeated, "repeated-hashes")
    n = repeated.count()
    if not n:
        return hashed.select(*columns)
    if n > _FEW:
        return _multiplied(hashed, len(frames), columns)
    lone = hashed.join(F.broadcast(repeated), "_hash", "left_anti").select(*columns)
    again = hashed.join(F.broadcast(repeated), "_hash", "left_semi")
    return lone.unionAll(_multiplied(again, len(frames), columns))


def _multiplied(hashed: DataFrame, frames: int, columns: list[str]) -> DataFrame:
    """A row without NULLs as often as its counts in the frames that hold it multiply to; a row with a NULL matches nothing,
    so its counts add up. One aggregate, combined before its shuffle, replaces the joins, which also takes the heat out of
    repeated rows.
    """
    counts = [F.count_if(F.col("_frame") == i) for i in range(frames)]
    has_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    product = reduce(lambda a, b: a * b, [F.greatest(c, F.lit(1).cast("bigint")) for c in counts])
    total = reduce(lambda a, b: a + b, counts)
    # A split of a file is few bytes, but its rows are many in a task's table of counts. So they are dealt out by what they
    # weigh, equal ones together; by a hash, as by the columns themselves the parts of a hot row could not be split.
    counted = (
        hashed.hint("rebalance", F.col("_hash"))
        .groupBy(*columns)
        .agg(product.alias("_product"), total.alias("_total"))
        .withColumn("_copies", F.when(has_null, F.col("_total")).otherwise(F.col("_product")))
    )
    # Copies unfold chunk by chunk, and the chunks of a row with very many spread over the cluster before they do; no others move.
    few = _repeat_rows(counted.where(F.col("_copies") <= _CHUNK), F.col("_copies"), columns)
    many = counted.where(F.col("_copies") > _CHUNK)
    chunks = many.withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.expr(f"(_copies - 1) div {_CHUNK}"))))
    chunks = chunks.withColumn("_copies", F.least(F.lit(_CHUNK), F.col("_copies") - F.col("_chunk") * _CHUNK))
    return few.unionAll(_repeat_rows(chunks.hint("rebalance"), F.col("_copies"), columns))


def _repeat_rows(df: DataFrame, copies: Column, columns: list[str]) -> DataFrame:
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies.cast("int")))).select(*columns)


def distinct_values(df: DataFrame, column: str, sort: bool = True) -> DataFrame:
    values = df.select(column).distinct()
    return values.orderBy(column) if sort else values


def values_missing_from(candidate: DataFrame, known: DataFrame) -> DataFrame:
    """Distinct rows of `candidate` that `known` lacks; NULL counts as a value."""
    return candidate.subtract(known)


def is_subset(candidate: DataFrame, known: DataFrame) -> bool:
    return values_missing_from(candidate, known).isEmpty()
