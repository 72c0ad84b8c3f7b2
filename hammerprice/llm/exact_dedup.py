"""Exact duplicates by an extendible-hash index on shared files.

Texts are normalised (A-Z lower-cased), hashed to 64 bits and combined per task, so that copies meet before anything moves.
The directory is built from row counts by hash prefix: it starts with one bucket and doubles while a bucket is overfull,
and only overfull buckets split, so a bucket is a range of keys with a local depth. Each bucket goes to one owner task. The
owner chains the entries of equal hash and compares their bytes; every distinct text becomes one index entry. The entries
are written to the shared folder, sorted by bucket and key, and documents find theirs by key.

A bucket's rows are bounded by `bucket_rows` unless its texts collide in all 64 bits. A text that a third of the rows share
reaches its owner once per task that has met it; its members are not gathered anywhere.

Edge cases: a null text counts as empty, and empty texts equal each other. Every input row gives one output row. Rows that
repeat a doc_id count as members each; of equal texts the largest doc_id stays, null being smaller than any. An empty table
gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hammerprice.llm.columns import free_shuffles, id_and_bytes, packed, slices, unpacked, written

#: Most distinct texts (as seen by the tasks that met them) in a bucket before it splits.
BUCKET_ROWS = 1024

ENTRY = "bucket int, hash long, chain int, sha256 binary, keep_id long, group_size long, n_bytes long"


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _keys(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        texts = [text.lower() for text in part.column("text").to_pylist()]  # bytes: only A-Z change
        columns = {
            "doc_id": part.column("doc_id"),
            "hash": pa.array([_signed(xxhash.xxh3_64_intdigest(text)) for text in texts], pa.int64()),
            "sha256": pa.array([hashlib.sha256(text).digest() for text in texts], pa.binary()),
        }
        if with_text:
            columns["text"] = pa.array(texts, pa.binary())
        yield pa.RecordBatch.from_pydict(columns)


def keyed(df: DataFrame, with_text: bool = False) -> DataFrame:
    """`doc_id`, `hash` and `sha256` of the normalised text, which follows if asked for."""
    schema = "doc_id long, hash long, sha256 binary" + ", text binary" * with_text
    return df.mapInArrow(lambda batches: _keys(batches, with_text), schema)


class Directory:
    """Extendible-hash directory: 2**depth slots in key order, each naming a bucket that covers one or more of them."""

    def __init__(self, counts: dict[int, int], fine_depth: int, bucket_rows: int):
        """`counts`: rows by the first `fine_depth` bits of the hash."""
        self.depth = 0
        buckets = [(0, 0, sum(counts.values()))]  # first fine slot, local depth, rows
        done = []
        totals = [0]
        for slot in range(1 << fine_depth):
            totals.append(totals[-1] + counts.get(slot, 0))
        while buckets:
            start, local, rows = buckets.pop()
            if rows <= bucket_rows or local == fine_depth:
                done.append((start, local))
                continue
            if local == self.depth:
                self.depth += 1  # the directory doubles
            half = 1 << (fine_depth - local - 1)
            for at in (start, start + half):
                buckets.append((at, local + 1, totals[at + half] - totals[at]))
        done.sort()
        self.slots: list[int] = []
        for bucket, (_, local) in enumerate(done):
            self.slots += [bucket] * (1 << (self.depth - local))
        self.n_buckets = len(done)


def build_directory(keys: DataFrame, bucket_rows: int) -> Directory:
    """Directory over `keys`; its size follows the number of buckets, not of rows."""
    rows = keys.count()
    fine = max(0, math.ceil(math.log2(max(1, rows / bucket_rows)))) + 3
    prefix = F.shiftrightunsigned("hash", 64 - fine).cast("int").alias("slot")
    counts = keys.select("hash", "sha256").distinct().groupBy(prefix).count()
    return Directory({row["slot"]: row["count"] for row in counts.collect()}, fine, bucket_rows)


def _combined(batches: Iterator[pa.RecordBatch], depth: int, slots: list[int]) -> Iterator[pa.RecordBatch]:
    """One row per distinct text of each slice of the task: its bucket, largest doc_id and number of rows."""
    for part in slices(batches):
        best: dict[bytes, list] = {}
        for doc_id, key, sha, text in zip(*(part.column(i).to_pylist() for i in range(4)), strict=True):
            entry = best.get(text)
            if entry is None:
                best[text] = [key, sha, doc_id, 1]
            else:
                entry[2] = doc_id if entry[2] is None or doc_id is not None and doc_id > entry[2] else entry[2]
                entry[3] += 1
        keys, shas, ids, rows = zip(*best.values(), strict=True)
        bucket = [slots[(key & (1 << 64) - 1) >> (64 - depth)] for key in keys]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(bucket, pa.int32()),
                pa.array(keys, pa.int64()),
                pa.array(shas, pa.binary()),
                pa.array(ids, pa.int64()),
                pa.array(rows, pa.int64()),
                pa.array(list(best), pa.binary()),
            ],
            ["bucket", "hash", "sha256", "doc_id", "rows", "text"],
        )


def _owned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Index entries of the buckets of one owner; its rows come sorted by bucket and hash, so one chain is held at a time."""
    key, chain, out = None, {}, []

    def entries() -> None:
        for at, (text, (sha, keep, rows)) in enumerate(chain.items()):
            out.append((key[0], key[1], at, sha, keep, rows, len(text)))

    def flushed() -> pa.RecordBatch:
        names = ["bucket", "hash", "chain", "sha256", "keep_id", "group_size", "n_bytes"]
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        arrays = [pa.array(x, kind) for x, kind in zip(zip(*out, strict=True), kinds, strict=True)]
        out.clear()
        return pa.RecordBatch.from_arrays(arrays, names)

    for part in slices(batches):
        for bucket, hashed, sha, doc_id, rows, text in zip(*(part.column(i).to_pylist() for i in range(6)), strict=True):
            if (bucket, hashed) != key:
                if key:
                    entries()
                key, chain = (bucket, hashed), {}
            known = chain.get(text)  # the chain of this hash: equal only if all bytes are
            if known is None:
                chain[text] = (sha, doc_id, rows)
            else:
                keep = max((x for x in (known[1], doc_id) if x is not None), default=None)
                chain[text] = (sha, keep, known[2] + rows)
        if len(out) >= 4096:
            yield flushed()
    if key:
        entries()
    if out:
        yield flushed()


def build_index(texts: DataFrame, keys: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Index entries (`ENTRY`), one per distinct text, written to the shared folder in order of bucket and key."""
    directory = build_directory(keys, bucket_rows)
    depth, slots = directory.depth, directory.slots

    def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _combined(_reordered(_keys(batches, True)), depth, slots)

    moved = texts.mapInArrow(
        combined, "bucket int, hash long, sha256 binary, doc_id long, rows long, text binary"
    )
    owned = moved.repartition("bucket").sortWithinPartitions("bucket", "hash").mapInArrow(_owned, ENTRY)
    return written(owned, "hash-index")


def _reordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (batch.select(["doc_id", "hash", "sha256", "text"]) for batch in batches)


def exact_groups(
    df: DataFrame, bucket_rows: int = BUCKET_ROWS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`doc_id`, `keep_id`, `group_size`, `kept` and `text_sha256` of every row."""
    texts = id_and_bytes(df, id_col, text_col)
    keys = written(keyed(texts), "hash-keys")
    index = build_index(texts, keys, bucket_rows)
    free_shuffles(df.sparkSession)
    entries = index.select("hash", "sha256", "keep_id", "group_size")
    return keys.join(entries, ["hash", "sha256"], "left").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha256")).alias("text_sha256"),
    )


def drop_exact_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `df` that stay, with all their columns.

    Of rows equal in doc_id and normalised text the one of the least text stays, and of rows equal in both any one.
    """
    kept = exact_groups(df, id_col=id_col, text_col=text_col).where("kept")
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    lower = F.translate(F.coalesce(F.col(text_col), F.lit("")), _UPPER, _UPPER.lower())
    as_text = lambda doc_id: F.coalesce(doc_id.cast("long").cast("string"), F.lit(""))
    rows = packed(df, id=as_text(F.col(id_col)), sha=F.sha2(lower.cast("binary"), 256), text=text)
    stays = kept.select(as_text(F.col("doc_id")).alias("id"), F.col("text_sha256").alias("sha"))
    found = rows.join(stays, ["id", "sha"], "left_semi").groupBy("id", "sha").agg(F.min_by("row", "text").alias("row"))
    return unpacked(found, df.columns)


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
