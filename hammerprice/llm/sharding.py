"""Shards of near-equal bytes by Karmarkar-Karp differencing; documents of equal text stay together.

Differencing holds partial partitions, each a vector of one sum per shard; at first every group of equal texts is one. The two
with the largest spread (largest minus smallest sum) are combined in opposite order, largest sum with smallest, until one is
left. Its lanes are the shards.

One heap cannot hold a corpus, so groups are differenced in blocks:

1. Groups above one `HEAVY_PARTS`-th of all bytes or rows, of which there are fewer than twice `HEAVY_PARTS`, come first, in
   one block.
2. The others are dealt by hash into blocks of about `BLOCK_GROUPS`. A block starts from its share of the sums so far, as one
   more partial partition whose lanes are known shards: what the heavy groups made uneven is evened out by every block.
3. Blocks follow in waves, each a `WAVE`-th of what is left and the last a single block, which start from the true sums of all
   before. So spreads that remain in blocks do not add up.

The driver holds one sum per shard. Documents meet their group's shard through a join by digest; heavy groups, the only ones that
can hold many rows, are bounded in number and broadcast.

Edge cases: a null text has no bytes and is of one group with the empty texts. Rows that repeat a doc_id, or lack one, count
each. A group of more bytes than a shard's share fills a shard and leaves the others even. Ties of spread go by order of
digest, so sums and shards depend on the rows alone; slots follow the order in which tasks read rows. An empty table gives no
rows; with fewer groups than shards some shards are empty. Other columns are ignored, or kept as they are by `with_shards`.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hammerprice.llm.columns import written

#: A group above this part of all bytes or rows is placed first.
HEAVY_PARTS = 4096
#: About so many groups are differenced by one task at a time.
BLOCK_GROUPS = 32_768
#: A wave leaves one block in so many to the waves after it.
WAVE = 64

#: Bytes that a document costs besides its text.
ROW_BYTES = 16


class _Partial:
    """A partial partition: sums in descending order less the smallest, and for every lane a chain of items."""

    __slots__ = ("sums", "heads", "tails")

    def __init__(self, sums: np.ndarray, heads: np.ndarray, tails: np.ndarray):
        order = np.argsort(-sums, kind="stable")
        self.sums, self.heads, self.tails = sums[order], heads[order], tails[order]
        self.sums -= self.sums[-1]


def difference(sizes: list[int], sums: list[int]) -> list[int]:
    """A lane for every item of `sizes`, so that `sums`, the sums that the lanes start from, end nearly equal.

    Items are taken largest first and must come in descending order.
    """
    n, lanes = len(sizes), len(sums)
    chained = np.full(n + lanes, -1, np.int64)

    def single(i: int) -> _Partial:
        vector = np.zeros(lanes, np.int64)
        vector[0] = sizes[i]
        chain = np.full(lanes, -1, np.int64)
        chain[0] = i
        return _Partial(vector, chain, chain.copy())

    names = np.arange(n, n + lanes)  # an item of size 0 in every lane says which one it is
    heap = [(-(max(sums) - min(sums)), 0, _Partial(np.array(sums, np.int64), names, names.copy()))]
    at, serial = 0, 0

    def largest() -> _Partial:
        nonlocal at
        if at < n and (not heap or sizes[at] >= -heap[0][0]):
            at += 1
            return single(at - 1)
        return heapq.heappop(heap)[2]

    while len(heap) + n - at > 1:
        first, second = largest(), largest()
        heads, tails = second.heads[::-1], second.tails[::-1]
        both = (first.tails >= 0) & (heads >= 0)
        chained[first.tails[both]] = heads[both]
        merged = _Partial(
            first.sums + second.sums[::-1],
            np.where(first.heads >= 0, first.heads, heads),
            np.where(tails >= 0, tails, first.tails),
        )
        serial += 1
        heapq.heappush(heap, (-int(merged.sums[0]), serial, merged))
    following, found = chained.tolist(), [0] * n
    for item in heap[0][2].heads.tolist():
        members, lane = [], -1
        while item >= 0:
            if item < n:
                members.append(item)
            else:
                lane = item - n
            item = following[item]
        for member in members:
            found[member] = lane
    return found


PLACED = "digest binary, bytes long, shard int"


def _place(groups: DataFrame, sums: list[int], ahead: int) -> DataFrame:
    """Shards for the groups of some blocks; `ahead` bytes are still to be placed, these included."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("bytes", "descending"), ("digest", "ascending")])
        sizes = table.column("bytes").to_pylist()
        mine, least = sum(sizes), min(sums)
        lanes = difference(sizes, [(s - least) * mine // max(1, ahead) for s in sums])
        return pa.table([table.column("digest"), table.column("bytes"), pa.array(lanes, pa.int32())], ["digest", "bytes", "shard"])

    return groups.groupBy("block").applyInArrow(run, PLACED)


def _waves(blocks: int) -> Iterator[tuple[int, int]]:
    """Ranges of blocks, the last one of a single block."""
    while blocks > 0:
        rest = 0 if blocks == 1 else math.ceil(blocks / WAVE)
        yield rest, blocks
        blocks = rest


def _sums(placed: DataFrame, sums: list[int]) -> list[int]:
    sums = list(sums)
    for shard, more in placed.groupBy("shard").agg(F.sum("bytes")).collect():  # one row per shard
        sums[shard] += more
    return sums


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def group_shards(
    sized: DataFrame, n_shards: int, block_groups: int = BLOCK_GROUPS, heavy_parts: int = HEAVY_PARTS
) -> tuple[DataFrame, DataFrame]:
    """Shards of the groups in `sized` (digest, size): of the heavy groups, and of the others."""
    groups = written(sized.groupBy("digest").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")), "groups")
    count, total, rows = groups.agg(F.count(F.lit(1)), F.sum("bytes"), F.sum("rows")).first()
    total, rows = total or 0, rows or 0
    heavy = (F.col("bytes") * heavy_parts > total) | (F.col("rows") * heavy_parts > rows)
    sums, ahead = [0] * n_shards, total

    first = written(_place(groups.where(heavy).withColumn("block", F.lit(-1)), sums, ahead), "heavy-shards")
    sums = _sums(first, sums)
    blocks = max(1, math.ceil(count / block_groups))
    light = groups.where(~heavy).withColumn("block", F.pmod(F.xxhash64("digest"), F.lit(blocks)).cast("int"))
    placed = []
    for start, stop in _waves(blocks):
        ahead = total - sum(sums)
        wave = light.where((F.col("block") >= start) & (F.col("block") < stop))
        placed.append(written(_place(wave, sums, ahead), "light-shards"))
        if start:
            sums = _sums(placed[-1], sums)
    others = placed[0]
    for more in placed[1:]:
        others = others.unionByName(more)
    return first, others


def _meet(rows: DataFrame, heavy: DataFrame, others: DataFrame) -> DataFrame:
    """`rows` with the shard of their digest."""
    # Fewer than 2 * HEAVY_PARTS groups are heavy, however large the table.
    few = F.broadcast(heavy.select("digest", "shard"))
    rest = rows.join(few, "digest", "left_anti").join(others.select("digest", "shard"), "digest")
    return rows.join(few, "digest").unionByName(rest)


def _numbered(batches: Iterator[pa.RecordBatch], n_shards: int) -> Iterator[pa.RecordBatch]:
    """Rows numbered within their task and shard."""
    task, seen = TaskContext.get().partitionId(), np.zeros(n_shards, np.int64)
    for batch in batches:
        shards = batch.column("shard").to_numpy()
        order = np.argsort(shards, kind="stable")
        counts = np.bincount(shards, minlength=n_shards)
        starts = np.cumsum(counts) - counts
        place = np.empty(len(shards), np.int64)
        place[order] = np.arange(len(shards)) - np.repeat(starts - seen, counts)
        seen += counts
        columns = [*batch.columns, pa.array(np.full(len(shards), task, np.int32)), pa.array(place)]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "task", "place"])


def assign_shards(
    df: DataFrame,
    n_shards: int = 40,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_groups: int = BLOCK_GROUPS,
    heavy_parts: int = HEAVY_PARTS,
) -> DataFrame:
    """`doc_id`, `size`, `text_crc32`, `shard` and `slot` (gapless within the shard) of every row.

    A size is the text's UTF-8 bytes plus `ROW_BYTES`.
    """
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    sized = df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        _digest(text).alias("digest"),
    )
    sized = written(sized, "sized")
    heavy, others = group_shards(sized, n_shards, block_groups, heavy_parts)
    rows = _meet(sized, heavy, others).drop("digest")
    schema = "doc_id long, size long, text_crc32 long, shard int, task int, place long"
    numbered = written(rows.mapInArrow(lambda batches: _numbered(batches, n_shards), schema), "shard-places")
    # One row per task and shard; a window sees the tasks of one shard.
    counts = numbered.groupBy("shard", "task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return numbered.join(offsets, ["shard", "task"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("place")).alias("slot")
    )


def with_shards(df: DataFrame, n_shards: int = 40, text_col: str = "text", shard_col: str = "shard") -> DataFrame:
    """All columns of `df` and the shard, as for `write.partitionBy(shard_col)`; `shard_col` must be a new name."""
    if shard_col in df.columns:
        raise ValueError(f"the table has a column {shard_col!r}; name another one")
    text = F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b""))
    size = (F.octet_length(text) + ROW_BYTES).cast("long")
    sized = written(df.select(size.alias("size"), _digest(text).alias("digest")), "sized")
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), _digest(text).alias("digest"))
    met = _meet(rows, *group_shards(sized, n_shards))
    return met.select(*[F.col("row").getField(c).alias(c) for c in df.columns], F.col("shard").alias(shard_col))
