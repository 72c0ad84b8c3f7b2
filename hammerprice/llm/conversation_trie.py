"""A trie of conversation prefixes, built from vertical bitmaps.

Conversations are dealt into shards, ranges of conversation ids of about `SHARD_TURNS` turns, and a shard's turns into bands of
`BAND` positions. A task holds one band of one shard as an index from (position, turn) to a bitset of the shard's conversations.
From the bitset of a node, the turn that its first conversation has next names a posting; the intersection is a child, and the
rest of the bitset names the next one. Depth first, every child costs a few operations on bitsets. Popcounts, members and the
list of conversations that end in a node are kept per shard.

Nodes of all shards meet by key: the exclusive or of 128-bit hashes of (position, turn) up to the node's depth, the turn itself
being known by the SHA-256 of its role and text. So a band can start where the one before it ends, and a conversation of any
length spreads over many tasks. What concerns a subtree follows without walking it:

- A node belongs to its smallest member. If a conversation owns a node, it owns all deeper ones on its path, so the nodes fall
  into chains, one per owner.
- The subtree of a node holds the whole chains of all its members but the part of its own chain above it. A subtree's sum is
  therefore the sum of chain totals over the members, less a running sum in the chain.

Edge cases: rows without conversation id take no part. A null role or text counts as empty. Turns are ordered by number, null first;
those of one number by role and text digest, as any order among them is as good. Repeated rows are turns each. Other columns are
ignored. A table without conversations has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hammerprice.llm.columns import written
from hammerprice.operators.row_order import order_rows

SHARD_TURNS = 4096
#: Positions that one task looks at.
BAND = 128

WORD = r"[^\x20\x09-\x0D]+"

LOCAL = (
    "k1 long, k2 long, p1 long, p2 long, depth long, shard long, n long, conv_id long, words long, "
    "ends string, members array<long>"
)


def _half(hexadecimal: Column, start: int) -> Column:
    return F.conv(F.substring(hexadecimal, start, 16), 16, -10).cast("long")


def ordered_turns(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """`conv_id`, `row` (position among all turns, by conversation), `t1`, `t2` (128 bits of the turn's digest), `words`."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    turns = df.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
        role.alias("role"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    placed = order_rows(turns, ["conv_id", "turn", "role", "digest"], unique=False).indexed("row")
    return placed.select("conv_id", "row", _half(F.col("digest"), 1).alias("t1"), _half(F.col("digest"), 17).alias("t2"), "words")


def _path(turns: DataFrame) -> DataFrame:
    """(conv_id, shard, pos, h1, h2, words, last) from the turns; a position's hash covers the position."""
    pos = F.col("pos")
    return turns.select(
        "conv_id",
        "shard",
        pos,
        F.when(pos > 0, F.xxhash64("pos", "t1", "t2")).otherwise(F.lit(0)).cast("long").alias("h1"),
        F.when(pos > 0, F.xxhash64("t2", "pos", "t1")).otherwise(F.lit(0)).cast("long").alias("h2"),
        "words",
        "last",
    )


def paths(turns: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The paths of the conversations as they are; `turns` from `ordered_turns`."""
    return rebuilt_paths(turns, F.lit(0), 1, shard_turns)


def rebuilt_paths(turns: DataFrame, borrowed: Column, every: int, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Paths of rebuilt conversations: the first h turns of conversation c - c % every, then the own turns after the first h.

    `borrowed` is h as an expression of `conv_id`, less than `every`. Positions count from 1; position 0 is there for every
    conversation, one without turns too.
    """
    turns = written(turns, "turns")
    spans = turns.groupBy("conv_id").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    spans = written(spans, "conversations")
    lenders = spans.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = (
        spans.withColumn("h", borrowed.cast("long"))
        .withColumn("base", F.col("conv_id") - F.col("conv_id") % every)
        .join(lenders, "base", "left")
        .withColumn("lent", F.least("h", F.coalesce("base_n", F.lit(0))))
        .withColumn("len", F.col("lent") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
        .withColumn("shard", F.floor(F.col("first") / shard_turns).cast("long"))
        .select("conv_id", "first", "h", "base", "lent", "len", "shard")
    )
    convs = written(convs, "rebuilt-conversations")
    last = (F.col("pos") == F.col("len")).alias("last")
    roots = convs.select(
        "conv_id", "shard", F.lit(0).cast("long").alias("pos"), F.lit(0).cast("long").alias("t1"),
        F.lit(0).cast("long").alias("t2"), F.lit(0).cast("long").alias("words"), (F.col("len") == 0).alias("last"),
    )
    own = (
        turns.join(convs.select("conv_id", "first", "h", "lent", "len", "shard"), "conv_id")
        .withColumn("place", F.col("row") - F.col("first"))
        .where(F.col("place") >= F.col("h"))
        .withColumn("pos", F.col("place") - F.col("h") + F.col("lent") + 1)
        .select("conv_id", "shard", "pos", "t1", "t2", "words", last)
    )
    starts = spans.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.col("first").alias("base_first"))
    lent = (
        convs.where("lent > 0")
        .select("conv_id", "shard", "base", "len", F.explode(F.sequence(F.lit(1).cast("long"), "lent")).alias("pos"))
        .join(starts, "base")
        .withColumn("row", F.col("base_first") + F.col("pos") - 1)
        .join(turns.select("row", "t1", "t2", "words"), "row")
        .select("conv_id", "shard", "pos", "t1", "t2", "words", last)
    )
    return written(_path(roots.unionByName(own).unionByName(lent)), "paths")


def _band(pos: Column, band: int) -> Column:
    return F.floor(pos / band).cast("long")


def _with_openings(path: DataFrame, size: int) -> DataFrame:
    """Rows by `band`; each band of a conversation opens with a row whose hash is the key of the node before it."""
    band = _band(F.greatest(F.col("pos") - 1, F.lit(0)), size)
    rows = path.withColumn("band", band).withColumn("opens", F.col("pos") == 0)
    long_ones = rows.where(F.col("pos") >= size).select("conv_id").distinct()
    ends = (
        rows.where("pos > 0")
        .join(long_ones, "conv_id", "left_semi")
        .groupBy("conv_id", "shard", "band")
        .agg(F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2"), F.max("last").alias("done"))
    )
    upto = Window.partitionBy("conv_id").orderBy("band").rowsBetween(Window.unboundedPreceding, 0)
    openings = ends.select(
        "conv_id",
        "shard",
        ((F.col("band") + 1) * size).alias("pos"),
        F.bit_xor("x1").over(upto).alias("h1"),
        F.bit_xor("x2").over(upto).alias("h2"),
        F.lit(0).cast("long").alias("words"),
        F.lit(False).alias("last"),
        (F.col("band") + 1).alias("band"),
        F.lit(True).alias("opens"),
        "done",
    )
    return rows.unionByName(openings.where(~F.col("done")).drop("done"))


def _bits(slots: np.ndarray, size: int) -> int:
    if len(slots) < 8:
        return sum(1 << slot for slot in slots.tolist())
    flags = np.zeros(size, np.uint8)
    flags[slots] = 1
    return int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")


def _slots(bits: int) -> list[int]:
    if bits.bit_count() < 8:
        out = []
        while bits:
            low = bits & -bits
            out.append(low.bit_length() - 1)
            bits ^= low
        return out
    flags = np.frombuffer(bits.to_bytes((bits.bit_length() + 7) // 8, "little"), np.uint8)
    return np.flatnonzero(np.unpackbits(flags, bitorder="little")).tolist()


def _runs(*columns: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of equal rows in sorted columns."""
    n = len(columns[0])
    if not n:
        return
    changed = np.zeros(n, bool)
    changed[0] = True
    for column in columns:
        changed[1:] |= column[1:] != column[:-1]
    starts = np.flatnonzero(changed)
    yield from zip(starts.tolist(), [*starts[1:].tolist(), n], strict=True)


def _grow(table: pa.Table, length: int) -> pa.Table:
    """The nodes of one band of one shard; the root too in the first band."""
    column = {name: table.column(name).to_numpy() for name in ("conv_id", "pos", "h1", "h2", "words", "last", "opens")}
    band, shard = table.column("band")[0].as_py(), table.column("shard")[0].as_py()
    first = band * length
    ids, slot = np.unique(column["conv_id"], return_inverse=True)
    size, ids = len(ids), ids.tolist()

    opens = column["opens"].astype(bool)
    turn = np.flatnonzero(~opens)
    order = turn[np.lexsort((slot[turn], column["h2"][turn], column["h1"][turn], column["pos"][turn]))]
    pos, h1, h2 = (column[name][order] for name in ("pos", "h1", "h2"))
    postings: list[tuple[int, int, int, int]] = []  # bitset, hash, words
    posting_of: list[dict[int, int]] = [{} for _ in range(length)]  # by depth, then by conversation
    alive: list[int] = [0] * (length + 1)
    ended: list[int] = [0] * (length + 1)
    for a, b in _runs(pos, h1, h2):
        depth, members = int(pos[a]) - first, slot[order[a:b]]
        bits = _bits(members, size)
        here = posting_of[depth - 1]
        for member in members.tolist():
            here[member] = len(postings)
        postings.append((bits, int(h1[a]), int(h2[a]), int(column["words"][order[a]])))
        alive[depth - 1] |= bits
    last = np.flatnonzero(column["last"].astype(bool))
    last = last[np.argsort(column["pos"][last], kind="stable")]
    for a, b in _runs(column["pos"][last]):
        ended[int(column["pos"][last[a]]) - first] = _bits(slot[last[a:b]], size)

    out = defaultdict(list)

    def emit(depth: int, bits: int, key: tuple[int, int], parent: tuple[int, int], words: int) -> None:
        ends = bits & ended[depth]
        members = [ids[i] for i in _slots(bits)]
        out["k1"].append(key[0])
        out["k2"].append(key[1])
        out["p1"].append(parent[0])
        out["p2"].append(parent[1])
        out["depth"].append(first + depth)
        out["n"].append(bits.bit_count())
        out["conv_id"].append(members[0])
        out["words"].append(words)
        out["ends"].append(",".join(str(ids[i]) for i in _slots(ends)) if ends else None)
        out["members"].append(members)

    start = np.flatnonzero(opens)
    start = start[np.lexsort((slot[start], column["h2"][start], column["h1"][start]))]
    stack: list[tuple[int, int, int, int]] = []
    for a, b in _runs(column["h1"][start], column["h2"][start]):
        key = (int(column["h1"][start[a]]), int(column["h2"][start[a]]))
        bits = _bits(slot[start[a:b]], size)
        if band == 0:
            emit(0, bits, key, key, 0)
        stack.append((0, bits, *key))
    while stack:
        depth, bits, k1, k2 = stack.pop()
        rest = bits & alive[depth] if depth < length else 0
        while rest:
            member = (rest & -rest).bit_length() - 1
            posting, g1, g2, words = postings[posting_of[depth][member]]
            child = rest & posting
            rest ^= child
            key = (k1 ^ g1, k2 ^ g2)
            emit(depth + 1, child, key, (k1, k2), words)
            stack.append((depth + 1, child, *key))
    out["shard"] = [shard] * len(out["n"])
    types = {"ends": pa.string(), "members": pa.list_(pa.int64())}
    names = [part.split()[0] for part in LOCAL.split(", ")]
    return pa.table({name: pa.array(out[name], types.get(name, pa.int64())) for name in names})


def _end_digests(local: DataFrame) -> DataFrame:
    """SHA-256 of a node's end list; the shards' parts pass in order, and none is kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            done: list[tuple[tuple[int, int], str]] = []
            for k1, k2, ends in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "ends")), strict=True):
                if (k1, k2) != key:
                    if digest is not None:
                        done.append((key, digest.hexdigest()))
                    key, digest = (k1, k2), hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ends.encode())
            yield _digest_rows(done)
        if digest is not None:
            yield _digest_rows([(key, digest.hexdigest())])

    parts = local.where(F.col("ends").isNotNull()).select("k1", "k2", "shard", "ends")
    ordered = parts.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "shard")
    return ordered.mapInArrow(run, "k1 long, k2 long, ends_sha256 string")


def _digest_rows(rows: list[tuple[tuple[int, int], str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([key[0] for key, _ in rows], pa.int64()),
            pa.array([key[1] for key, _ in rows], pa.int64()),
            pa.array([digest for _, digest in rows], pa.string()),
        ],
        ["k1", "k2", "ends_sha256"],
    )


def _above(nodes: DataFrame, size: int) -> DataFrame:
    """Sum of `saved` in a node's own chain above it, a band at a time, so that a long chain is no single window."""
    band = _band(F.col("depth"), size)
    chain = nodes.select("k1", "k2", "conv_id", "depth", "saved", band.alias("band"))
    before = Window.partitionBy("conv_id").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    bands = chain.groupBy("conv_id", "band").agg(F.sum("saved").alias("saved"))
    offsets = bands.select("conv_id", "band", F.coalesce(F.sum("saved").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("conv_id", "band").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    running = chain.withColumn("run", F.coalesce(F.sum("saved").over(within), F.lit(0)))
    return running.join(offsets, ["conv_id", "band"]).select("k1", "k2", (F.col("run") + F.col("offset")).alias("above"))


def trie(path: DataFrame, band: int = BAND) -> DataFrame:
    """One row per node of the trie over `path` (from `paths` or `rebuilt_paths`).

    `conv_id` (smallest member), `depth`, `parent_conv_id`, `n_convs`, `n_children`, `n_leaves` and `saved_tokens` of the
    subtree, and `ends_sha256` of the ids of the conversations that end in the node. conv_id and depth name the node's turns.
    """
    grown = _with_openings(path, band).groupBy("shard", "band").applyInArrow(lambda table: _grow(table, band), LOCAL)
    local = written(grown, "shard-nodes")
    merged = local.groupBy("k1", "k2").agg(
        F.min("p1").alias("p1"),
        F.min("p2").alias("p2"),
        F.min("depth").alias("depth"),
        F.sum("n").alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.min("words").alias("words"),
    )
    merged = written(merged.withColumn("saved", (F.col("n_convs") - 1) * F.col("words")), "nodes")
    children = merged.where("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2"))
    children = children.agg(F.count(F.lit(1)).alias("n_children"))
    nodes = merged.join(children, ["k1", "k2"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = written(nodes, "nodes-with-children")

    chains = nodes.groupBy("conv_id").agg(
        F.count(F.when(F.col("n_children") == 0, 1)).alias("leaves"), F.sum("saved").alias("total")
    )
    members = local.select("k1", "k2", F.explode("members").alias("conv_id"))
    below = (
        members.join(chains, "conv_id")
        .groupBy("k1", "k2")
        .agg(F.sum("leaves").alias("n_leaves"), F.sum("total").alias("total"))
    )
    parents = merged.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    parent = F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id")
    return (
        nodes.join(below, ["k1", "k2"])
        .join(_above(nodes, band), ["k1", "k2"])
        .join(_end_digests(local), ["k1", "k2"], "left")
        .join(parents, ["p1", "p2"])
        .select(
            "conv_id",
            "depth",
            parent,
            "n_convs",
            "n_children",
            "n_leaves",
            (F.col("total") - F.col("above")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        )
    )
