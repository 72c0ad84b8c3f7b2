"""Repeated passages across documents, by column-wise construction over anchored stretches of many documents.

Every string of `length` bytes has an anchor in it: the leftmost of its `GRAM`-byte grams with the least hash. Equal strings
have the same anchor at the same place, so only stretches around equal anchors can hold equal strings. Neighbouring strings
of a document that share an anchor form one occurrence: a stretch of less than 2 * `length` bytes.

1. Scan: the occurrences of all documents, as hashes and positions. Anchors that occur once are dropped.
2. Occurrences with all bytes equal form a class. The earliest one represents it; all others are repeated as a whole.
3. Representatives whose anchor has several classes are compared column by column, from the right: each round puts one more
   symbol in front of every stretch, re-sorts the stretches stably by that symbol, and updates the common prefixes of
   neighbours, as when the Burrows-Wheeler transform of a collection grows by one symbol per document and round. Runs of
   neighbours with a common prefix of `length` are equal strings; all but the earliest are repeated there. The stretches
   wait, sorted by anchor, in Spark's shuffle files, and are read in sequence, as many anchors at a time as fit.
4. The repeated strings' bytes are removed document by document.

An anchor with more than `group_rows` classes is compared otherwise, not held in one task: its strings are listed by
place in the stretch and 128-bit hash, and the earliest of each is found by aggregation.

Equality in steps 2 and the last is equality of two 64-bit hashes; step 3 compares bytes.

Edge cases: a null or empty text, or one shorter than `length`, keeps all it has. Rows that repeat a doc_id with different
texts are versions of one document in the order of their hashes; rows equal in both are one document and treated alike.
Rows without a doc_id come after all others and are told apart by their texts alone. Other columns are ignored. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hammerprice.llm.chunks import mix
from hammerprice.llm.columns import free_shuffles, id_and_bytes, packed, slices, unpacked, written

LENGTH = 100
GRAM = 32
#: Bytes of text that are scanned at a time; longer texts are scanned in parts that overlap.
PART = 2 << 20
#: Stretches compared at a time, and the largest number of classes of one anchor that is compared by columns.
BATCH_ROWS = 50_000
GROUP_ROWS = 200_000
#: Stretches put into columns at a time: an index of all their bytes would be many times the columns.
FILL_ROWS = 4096

#: Where a document without an id stands in the order.
NO_ID = (1 << 63) - 1

OCCURRENCE = "anchor long, content long, doc long, version long, place long"
_PLACE = np.int64(1 << 14)
_LOW = np.uint64((1 << 24) - 1)


def occurrences(data: bytes, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """First and last string start, anchor position and anchor hash of the occurrences in texts joined at `offsets`."""
    n, reach = len(data), length - GRAM + 1
    if n < length:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    words = np.ndarray((n - 7,), "<u8", data, strides=(1,))
    grams = n - GRAM + 1
    hashes = words[:grams] * np.uint64(0x9E3779B97F4A7C15)
    for at, odd in ((8, 0xC2B2AE3D27D4EB4F), (16, 0x165667B19E3779F9), (24, 0xD6E8FEB86659FD93)):
        hashes += words[at : at + grams] * np.uint64(odd)
    mix(hashes)
    least = (hashes & ~_LOW) | np.arange(grams, dtype=np.uint64)
    span = 1
    while 2 * span <= reach:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < reach:
        least = np.minimum(least[: grams - reach + 1], least[reach - span :])
    anchor = (least & _LOW).astype(np.int64)  # by string start
    valid = np.ones(len(anchor), bool)
    for end in offsets[1:].tolist():
        valid[max(0, end - length + 1) : end] = False
    starts = np.flatnonzero(valid)
    if not len(starts):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    at = anchor[starts]
    opens = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    closes = np.append(opens[1:], len(starts)) - 1
    return starts[opens], starts[closes], at[opens], hashes[at[opens]]


def _scan(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        docs, versions = (part.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        texts = part.column("text").to_pylist()
        pieces, held = [], 0  # row, first byte, bytes
        for row, text in enumerate(texts):
            for start in range(0, max(1, len(text) - length + 1), PART):
                pieces.append((row, start, text[start : start + PART + length - 1]))
                held += len(pieces[-1][2])
                if held >= PART:
                    yield _scanned(pieces, docs, versions, length)
                    pieces, held = [], 0
        if pieces:
            yield _scanned(pieces, docs, versions, length)


def _scanned(pieces: list[tuple[int, int, bytes]], docs: np.ndarray, versions: np.ndarray, length: int) -> pa.RecordBatch:
    data = b"".join([piece[2] for piece in pieces])
    offsets = np.concatenate([[0], np.cumsum([len(piece[2]) for piece in pieces])])
    first, last, anchor, hashes = occurrences(data, offsets, length)
    hashed = xxhash.xxh3_64_intdigest
    spans = zip(first.tolist(), (last + length).tolist(), (anchor - first).tolist(), strict=True)
    content = np.fromiter((hashed(data[a:b], before) for a, b, before in spans), np.uint64, len(first))
    piece = np.searchsorted(offsets, first, "right") - 1
    row = np.array([x[0] for x in pieces])[piece]
    position = anchor - offsets[piece] + np.array([x[1] for x in pieces])[piece]
    place = position * _PLACE + (anchor - first) * 128 + (anchor - last)
    columns = (hashes.view(np.int64), content.view(np.int64), docs[row], versions[row], place)
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], OCCURRENCE.replace(" long", "").split(", "))


def scanned(texts: DataFrame, length: int) -> DataFrame:
    """All occurrences; `place` packs the anchor's position with the distances from the first and last string start."""
    return texts.mapInArrow(lambda batches: _scan(batches, length), OCCURRENCE)


class Columns:
    """Stretches aligned at their anchors, in groups, and the strings that an earlier stretch of the group has too."""

    def __init__(self, group: np.ndarray, before: np.ndarray, after: np.ndarray, stretches: list[bytes], length: int):
        """`group` rises; rows of a group come from the earliest to the latest.

        `before` and `after`: distances of the anchor from the first and the last string start.
        """
        n, self.length, self.reach = len(group), length, length - GRAM
        self.group = np.cumsum(np.concatenate([[0], group[1:] != group[:-1]])) if n else np.zeros(0, np.int64)
        sizes = before - after + length
        self.width = self.reach + length
        self.symbols = np.zeros((self.width, n), np.uint16)  # 0: outside the stretch
        for start in range(0, n, FILL_ROWS):
            some = slice(start, start + FILL_ROWS)
            flat, each = np.frombuffer(b"".join(stretches[some]), np.uint8), sizes[some]
            row = np.repeat(np.arange(start, start + len(each)), each)
            column = np.arange(len(flat)) + np.repeat(self.reach - before[some] - (np.cumsum(each) - each), each)
            self.symbols[column, row] = flat.astype(np.uint16) + 1

    def repeated(self) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest distance of a repeated string's start before the anchor, by row; -1 where none is."""
        n = len(self.group)
        order, common = np.arange(n), np.zeros(n + 1, np.int32)  # common[i]: of the rows at i - 1 and i
        nearest, farthest = np.full(n, -1), np.full(n, -1)
        for column in range(self.width - 1, -1, -1):
            symbol = self.symbols[column][order]
            key = self.group[order] * 512 + symbol
            moved = np.argsort(key, kind="stable")
            old, key = moved, key[moved]
            order, symbol = order[moved], symbol[moved]
            same = np.flatnonzero((key[1:] == key[:-1]) & (symbol[1:] > 0)) + 1
            grown = np.zeros(n + 1, np.int32)
            p, q = old[same - 1], old[same]
            beside = q == p + 1
            grown[same[beside]] = common[q[beside]] + 1
            if not beside.all():
                spans = np.stack([p[~beside] + 1, q[~beside] + 1], axis=1).reshape(-1)
                grown[same[~beside]] = np.minimum.reduceat(common, spans)[::2] + 1
            common = grown
            if column <= self.reach:
                equal = common[1:n] >= self.length
                if equal.any():
                    run = np.concatenate([[0], np.cumsum(~equal)])
                    earliest = np.minimum.reduceat(order, np.flatnonzero(np.concatenate([[True], ~equal])))
                    later = order[order > earliest[run]]
                    distance = self.reach - column
                    farthest[later] = distance
                    nearest[later[nearest[later] < 0]] = distance
        return nearest, farthest


SPAN = "doc long, version long, first long, stop long"


def _spans(docs: list, versions: list, first: np.ndarray, stop: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(x, pa.int64()) for x in (docs, versions, first, stop)], ["doc", "version", "first", "stop"]
    )


def _compared(rows: list[tuple], length: int) -> pa.RecordBatch:
    anchor, doc, version, place, stretch = zip(*rows, strict=True)
    place = np.array(place, np.int64)
    position, before, after = place // _PLACE, place % _PLACE // 128, place % 128
    nearest, farthest = Columns(np.array(anchor), before, after, list(stretch), length).repeated()
    hit = np.flatnonzero(farthest >= 0)
    docs, versions = [doc[i] for i in hit.tolist()], [version[i] for i in hit.tolist()]
    return _spans(docs, versions, (position - farthest)[hit], (position - nearest)[hit] + length)


def compare_columns(stretches: DataFrame, length: int) -> DataFrame:
    """Repeated spans of `stretches` (`anchor`, `doc`, `version`, `place`, `stretch`), anchor by anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for part in slices(batches):
            held += zip(*(part.column(i).to_pylist() for i in range(5)), strict=True)
            if len(held) >= BATCH_ROWS:
                cut = len(held)  # the last anchor may go on
                while cut and held[cut - 1][0] == held[-1][0]:
                    cut -= 1
                if cut:
                    yield _compared(held[:cut], length)
                    held = held[cut:]
        if held:
            yield _compared(held, length)

    names = ["anchor", "doc", "version", "place"]
    ordered = stretches.select(*names, "stretch").repartition("anchor").sortWithinPartitions(*names)
    return ordered.mapInArrow(run, SPAN)


def compare_strings(stretches: DataFrame, length: int) -> DataFrame:
    """The same spans for anchors with very many classes: strings by distance from the anchor and hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            out = []
            for anchor, doc, version, place, stretch in zip(*(part.column(i).to_pylist() for i in range(5)), strict=True):
                position, before, after = place >> 14, place >> 7 & 127, place & 127
                for distance in range(after, before + 1):
                    start = before - distance
                    digest = xxhash.xxh3_128_digest(stretch[start : start + length])
                    out.append((anchor, distance, digest, doc, version, position))
            names = ["anchor", "distance", "digest", "doc", "version", "position"]
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            columns = zip(zip(*out, strict=True), kinds, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in columns], names)

    schema = "anchor long, distance long, digest binary, doc long, version long, position long"
    strings = written(
        stretches.select("anchor", "doc", "version", "place", "stretch").mapInArrow(run, schema), "strings"
    )
    keys = ["anchor", "distance", "digest"]
    at = F.struct("doc", "version", "position")
    earliest = written(strings.groupBy(*keys).agg(F.min(at).alias("earliest"), F.count(F.lit(1)).alias("n")), "earliest")
    start = F.col("position") - F.col("distance")
    return (
        strings.join(earliest.where("n > 1"), keys)
        .where(at != F.col("earliest"))
        .select("doc", "version", start.alias("first"), (start + length).alias("stop"))
    )


def cut_stretches(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """`wanted` (`anchor`, `doc`, `version`, `place`) with the bytes of each stretch."""
    lists = wanted.groupBy("doc", "version").agg(
        F.collect_list("anchor").alias("anchors"), F.collect_list("place").alias("places")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            names = ["doc", "version", "text", "anchors", "places"]
            out: list[tuple] = []
            for doc, version, text, anchors, places in zip(*(part.column(x).to_pylist() for x in names), strict=True):
                for anchor, place in zip(anchors, places, strict=True):
                    position, before, after = place >> 14, place >> 7 & 127, place & 127
                    out.append((anchor, doc, version, place, text[position - before : position - after + length]))
            kinds = [pa.int64()] * 4 + [pa.binary()]
            columns = zip(zip(*out, strict=True), kinds, strict=True)
            names = ["anchor", "doc", "version", "place", "stretch"]
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in columns], names)

    schema = "anchor long, doc long, version long, place long, stretch binary"
    found = texts.join(lists, ["doc", "version"]).mapInArrow(run, schema)
    return found.dropDuplicates(["anchor", "doc", "version", "place"])


def repeated_spans(texts: DataFrame, length: int = LENGTH, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Spans (`SPAN`) of repeated bytes of `texts` (`doc`, `version`, `text`); they may overlap."""
    spark = texts.sparkSession
    found = scanned(texts, length)
    repeated = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    repeated = written(repeated, "anchors")
    free_shuffles(spark)
    places = written(found.join(repeated, "anchor", "left_semi"), "occurrences")
    free_shuffles(spark)
    at = F.struct("doc", "version", "place")
    classes = written(
        places.groupBy("anchor", "content").agg(F.min(at).alias("earliest"), F.count(F.lit(1)).alias("n")), "contents"
    )
    start, stop = F.shiftright("place", 14), F.shiftright("place", 14) + length
    first = start - F.shiftright("place", 7).bitwiseAND(127)
    whole = (
        places.join(classes.where("n > 1").drop("n"), ["anchor", "content"])
        .where(at != F.col("earliest"))
        .select("doc", "version", first.alias("first"), (stop - F.col("place").bitwiseAND(127)).alias("stop"))
    )
    whole = written(whole, "spans")
    groups = written(classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("classes")).where("classes > 1"), "groups")
    wanted = written(classes.join(groups, "anchor").select("anchor", "classes", "earliest.*"), "representatives")
    free_shuffles(spark)
    stretches = written(cut_stretches(texts, wanted.drop("classes"), length), "stretches")
    free_shuffles(spark)
    large = groups.where(F.col("classes") > group_rows).select("anchor")
    small = stretches.join(large, "anchor", "left_anti")
    spans = whole.unionByName(compare_columns(small, length))
    if large.take(1):
        spans = spans.unionByName(compare_strings(stretches.join(large, "anchor", "left_semi"), length))
    return written(spans, "spans")


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for first, stop in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([first, stop])
    return [(first, stop) for first, stop in out]


def _kept(text: bytes, spans: list[tuple[int, int]], characters: bool) -> bytes:
    parts, at = [], 0
    for first, stop in spans:
        if characters:  # a character goes only if all its bytes do
            while first < stop and text[first] & 0xC0 == 0x80:
                first += 1
            while stop > first and stop < len(text) and text[stop] & 0xC0 == 0x80:
                stop -= 1
        parts.append(text[at:first])
        at = max(at, stop)
    parts.append(text[at:])
    return b"".join(parts)


def without_repeats(
    df: DataFrame,
    length: int = LENGTH,
    characters: bool = False,
    group_rows: int = GROUP_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """`doc_id`, `version`, `n_bytes`, `n_removed`, `n_spans` and `kept` (the bytes that stay) of every row.

    With `characters`, `kept` has whole characters: one of which a byte stays stays whole.
    """
    texts = id_and_bytes(df, id_col, text_col)
    texts = texts.withColumn("doc", F.coalesce("doc_id", F.lit(NO_ID)))
    again = texts.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1").take(1)
    texts = texts.select("doc", (F.xxhash64("text") if again else F.lit(0).cast("long")).alias("version"), "text")
    spans = repeated_spans(texts, length, group_rows)
    free_shuffles(df.sparkSession)
    lists = spans.distinct().groupBy("doc", "version").agg(
        F.collect_list("first").alias("firsts"), F.collect_list("stop").alias("stops")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            names = ["doc", "version", "text", "firsts", "stops"]
            out: list[tuple] = []
            for doc, version, text, firsts, stops in zip(*(part.column(x).to_pylist() for x in names), strict=True):
                merged = _merged(list(zip(firsts or (), stops or (), strict=True)))
                removed = sum(stop - first for first, stop in merged)
                doc = None if doc == NO_ID else doc
                out.append((doc, version, len(text), removed, len(merged), _kept(text, merged, characters)))
            kinds = [pa.int64()] * 5 + [pa.binary()]
            columns = zip(zip(*out, strict=True), kinds, strict=True)
            names = ["doc_id", "version", "n_bytes", "n_removed", "n_spans", "kept"]
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in columns], names)

    schema = "doc_id long, version long, n_bytes long, n_removed long, n_spans long, kept binary"
    return texts.join(lists, ["doc", "version"], "left").mapInArrow(run, schema)


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """`df` with the repeated passages of each text removed, character by character, and `chars_col` brought up to date.

    Rows equal in id and text stay as many as they are.
    """
    kept = without_repeats(df, characters=True, id_col=id_col, text_col=text_col).where("n_removed > 0")
    again = df.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where("n > 1").take(1)
    version = F.xxhash64(F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))) if again else F.lit(0).cast("long")
    kept = written(kept.select("doc_id", "version", "kept"), "shortened").dropDuplicates(["doc_id", "version"])
    kept = kept.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), "version", F.col("kept").cast("string").alias("shorter"))
    rows = packed(df, doc=F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)), version=version)
    found = rows.join(kept, ["doc", "version"], "left")
    shorter, old = F.col("shorter"), F.col("row")
    changed = {text_col: F.coalesce(shorter, old.getField(text_col))}
    if chars_col in df.columns:
        chars = F.when(shorter.isNotNull(), F.length(shorter)).otherwise(old.getField(chars_col))
        changed[chars_col] = chars.cast(df.schema[chars_col].dataType)
    return unpacked(found, df.columns, **changed)
