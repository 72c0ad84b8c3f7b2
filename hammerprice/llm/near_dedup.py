"""Near duplicates by fast similarity sketching, banding and exact verification.

A document's set is its distinct shingles of `words` consecutive words. Its sketch has bands * rows coordinates, filled in
rounds: in each of the first rounds every shingle is thrown into a hashed bin with a value that begins with the round; in
the rounds after those every shingle is thrown into one bin of its own turn, so that every coordinate fills. The smallest
value stays. Filling stops once no bin is empty, as later rounds cannot win. Like coordinates are as likely as the sets are
similar, with the concentration of independent samples.

Documents with equal sets form a class and are linked as such. Classes whose sketches agree on all rows of a band share a
bucket. Then links are confirmed on whole sets, in two steps. First every class is compared with the least class it shares a
bucket with. Afterwards only those buckets matter whose classes are not all connected yet: within each, classes of
different components are compared until they are connected or all pairs have been compared. Buckets with many shingles are
dealt out as pairs of blocks of bounded size. No step lists the pairs of a bucket.

A pair at similarity s shares no bucket with probability (1 - s**rows)**bands: with the defaults 3e-7 at 0.8, 2e-9 at 0.85.

Edge cases: a text with fewer words has its whole sequence as its one shingle; a null or empty text, or one without words,
has an empty set and no links. Rows without a doc_id have no links and no component, and are kept. Rows that repeat a doc_id
are one document: all their texts count for its links. Ties do not arise, the least doc_id names a component. Other
columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hammerprice.llm.chunks import LOWER, Chunks, mix, white_space_words
from hammerprice.llm.columns import free_shuffles, id_and_bytes, map_slices, packed, unpacked, written
from hammerprice.llm.components import components

WORDS = 5
PERCENT = 80
BANDS = 38
ROWS = 5
#: Shingles in one block of a bucket; a task holds two blocks.
BLOCK_SHINGLES = 1_000_000

_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Sorted 64-bit keys of each text's shingles."""
    chunks = Chunks(texts, white_space_words, LOWER)
    keys, first = chunks.keys(), chunks.first
    joined = np.zeros(len(keys), np.uint64)
    for i in range(words):
        joined[: max(0, len(keys) - i)] = mix(joined[: max(0, len(keys) - i)] * _STEP ^ keys[i:])
    sets = []
    for a, b in zip(first.tolist(), first[1:].tolist(), strict=False):
        if b - a >= words:
            sets.append(np.unique(joined[a : b - words + 1]))
        else:
            short = np.frombuffer(xxhash.xxh3_64_digest(keys[a:b].tobytes(), seed=b - a), "<u8")
            sets.append(short if b > a else short[:0])
    return sets


def sketch(keys: np.ndarray, size: int) -> np.ndarray:
    """`size` coordinates of a set that is not empty; a coordinate holds its round and the winner's value."""
    bins = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    each = min(size, max(1, math.ceil(size * (math.log(size) + 2) / len(keys))))
    for start in range(0, size, each):  # rounds of hashed bins, several at a time
        rounds = np.arange(start, min(size, start + each), dtype=np.uint64)[:, None]
        thrown = mix(keys[None, :] ^ (rounds + np.uint64(1)) * _STEP)
        bin_of = ((thrown >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)
        value = (rounds << np.uint64(32)) | (mix(thrown.copy()) >> np.uint64(32))
        np.minimum.at(bins, bin_of.reshape(-1).astype(np.int64), value.reshape(-1))
        if bins.max() != np.iinfo(np.uint64).max:
            return bins
    for empty in np.flatnonzero(bins == np.iinfo(np.uint64).max).tolist():  # one bin a round
        turn = np.array([size + empty], np.uint64)
        thrown = mix(keys ^ (turn + np.uint64(1)) * _STEP)
        bins[empty] = ((turn << np.uint64(32)) | (mix(thrown) >> np.uint64(32))).min()
    return bins


def band_keys(coordinates: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key per document and band; keys of different bands do not meet."""
    parts = coordinates.reshape(len(coordinates), bands, rows)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for row in range(rows):
        keys = mix(keys * _STEP ^ parts[:, :, row])
    return keys.astype(np.int64)


def described(texts: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """`doc_id`, `n_shingles`, the set's `digest` and its `bands` (none if the set is empty)."""

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(part.column("text").to_pylist(), words)
        filled = [i for i, keys in enumerate(sets) if len(keys)]
        bands_of = [np.zeros(0, np.int64)] * len(sets)
        if filled:
            coordinates = np.stack([sketch(sets[i], bands * rows) for i in filled])
            for i, keys in zip(filled, band_keys(coordinates, bands, rows), strict=True):
                bands_of[i] = keys
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": part.column("doc_id"),
                "n_shingles": pa.array([len(keys) for keys in sets], pa.int64()),
                "digest": pa.array([xxhash.xxh3_128_digest(keys.tobytes()) for keys in sets], pa.binary()),
                "bands": pa.array(bands_of, pa.list_(pa.int64())),
            }
        )

    return map_slices(texts, run, "doc_id long, n_shingles long, digest binary, bands array<long>")


def sets_of(texts: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """`node` and `keys` of the texts of the documents in `nodes`."""

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        sets = [keys.astype(np.int64) for keys in shingle_sets(part.column("text").to_pylist(), words)]
        return pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sets, pa.list_(pa.int64()))], ["node", "keys"])

    wanted = texts.join(nodes.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
    return map_slices(wanted, run, "node long, keys array<long>").where(F.size("keys") > 0).dropDuplicates(["node", "keys"])


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of `pairs` (`u`, `v`) whose sets are similar enough."""
    left = sets.select(F.col("node").alias("u"), F.col("keys").alias("a"))
    right = sets.select(F.col("node").alias("v"), F.col("keys").alias("b"))
    common = F.size(F.array_intersect("a", "b"))
    return (
        pairs.join(left, "u")
        .join(right, "v")
        .withColumn("common", common)
        .where(100 * F.col("common") >= percent * (F.size("a") + F.size("b") - F.col("common")))
        .select("u", "v")
    )


def _compare(rows: pd.DataFrame, percent: int) -> list[tuple[int, int]]:
    """Links that connect different components among `rows` (`node`, `label`, `side`, `keys`), compared exhaustively.

    With two sides only pairs across them are compared.
    """
    rows = rows.sort_values(["label", "node"]).reset_index(drop=True)
    nodes, labels, side = rows["node"].to_numpy(), rows["label"].to_numpy(), rows["side"].to_numpy()
    sizes = rows["keys"].str.len().to_numpy()
    codes, _ = pd.factorize(np.concatenate(rows["keys"].to_list()))
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    _, group = np.unique(labels, return_inverse=True)
    flags, links, apart = np.zeros(codes.max() + 1, bool), [], side.min() != side.max()
    for i in range(len(rows)):
        others = np.flatnonzero((group[i + 1 :] != group[i]) & ((side[i + 1 :] != side[i]) | (not apart))) + i + 1
        others = others[100 * np.minimum(sizes[others], sizes[i]) >= percent * np.maximum(sizes[others], sizes[i])]
        if not len(others):
            continue
        own = codes[offsets[i] : offsets[i + 1]]
        flags[own] = True
        for j in others.tolist():
            if group[j] == group[i]:
                continue  # a link found just now has connected them
            common = int(flags[codes[offsets[j] : offsets[j + 1]]].sum())
            if 100 * common >= percent * (sizes[i] + sizes[j] - common):
                links.append((int(nodes[i]), int(nodes[j])))
                group[group == group[j]] = group[i]
        flags[own] = False
    return links


def open_buckets(members: DataFrame, labels: DataFrame, tested: DataFrame) -> DataFrame:
    """`key`, `node`, `label` and the `blocks` of buckets whose classes are not all connected; of equal buckets one.

    A bucket of two classes that have been compared is not open.
    """
    labelled = written(
        members.join(labels, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component"),
        "bucket-members",
    )
    buckets = labelled.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("label").alias("low"),
        F.max("label").alias("high"),
        F.min("node").alias("u"),
        F.max("node").alias("v"),
        F.bit_xor(F.xxhash64("node")).alias("mark"),
        F.sum("n_shingles").alias("shingles"),
    )
    known = tested.select(F.col("v").alias("u"), F.col("u").alias("v"))  # a tested pair names its larger class first
    still = buckets.where("low <> high").join(known.withColumn("known", F.lit(True)), ["u", "v"], "left")
    still = still.where("n > 2 OR known IS NULL").groupBy("n", "u", "v", "mark")
    still = still.agg(F.min("key").alias("key"), F.max("shingles").alias("shingles"))
    blocks = F.ceil(F.col("shingles") / BLOCK_SHINGLES).cast("int").alias("blocks")
    return labelled.join(written(still.select("key", blocks), "open-buckets"), "key")


def compared(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between classes of different components that share an open bucket."""
    block = F.pmod(F.xxhash64("node", "key"), F.col("blocks")).cast("int")
    dealt = members.withColumn("side", block).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    )
    dealt = dealt.select(
        "key", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "node", "label", "side"
    )

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        i, j = rows["i"].iloc[0], rows["j"].iloc[0]
        if i != j and rows["side"].nunique() < 2:
            return pd.DataFrame({"u": [], "v": []})
        return pd.DataFrame(_compare(rows, percent), columns=["u", "v"])

    return dealt.join(sets, "node").groupBy("key", "i", "j").applyInPandas(run, "u long, v long")


def near_groups(
    df: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """`doc_id`, `n_shingles`, `component_id` and `kept` of every row.

    Sets are linked if 100 * intersection >= `percent` * union.
    """
    spark = df.sparkSession
    texts = id_and_bytes(df, id_col, text_col)
    documents = written(described(texts, words, bands, rows), "sketches")
    filled = documents.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = written(filled.groupBy("digest").agg(F.min("doc_id").alias("node")), "classes")
    sketched = (
        filled.join(classes, [filled["digest"] == classes["digest"], filled["doc_id"] == classes["node"]], "left_semi")
        .groupBy("digest", "doc_id")
        .agg(F.max("n_shingles").alias("n_shingles"), F.min("bands").alias("bands"))
        .select(F.col("doc_id").alias("node"), "n_shingles", F.explode("bands").alias("key"))
    )
    sketched = written(sketched, "bands")
    shared = sketched.groupBy("key").agg(F.min("node").alias("center"), F.max("node").alias("last"))
    shared = written(shared.where("center <> last").select("key", "center"), "buckets")
    members = sketched.join(shared, "key").groupBy("key", "node")
    members = written(members.agg(F.max("n_shingles").alias("n_shingles"), F.min("center").alias("center")), "members")
    pairs = members.where("node <> center").groupBy(F.col("node").alias("u")).agg(F.min("center").alias("v"))
    pairs = written(pairs, "pairs")
    involved = members.select("node").distinct()
    free_shuffles(spark)
    sets = written(sets_of(texts, involved, words), "sets")
    free_shuffles(spark)
    links = written(confirmed(pairs, sets, percent), "links")
    same = filled.join(classes, "digest").select("doc_id", "node")  # rows that repeat a doc_id connect their classes
    several = same.groupBy("doc_id").agg(F.min("node").alias("v"), F.max("node").alias("u")).where("u <> v")
    links = links.unionByName(same.join(several.select("doc_id", "v"), "doc_id").select(F.col("node").alias("u"), "v"))
    stars = written(components(links, "u", "v"), "components")
    more = written(compared(open_buckets(members.drop("center"), stars, pairs), sets, percent), "late-links")
    if more.take(1):
        all_links = stars.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(more)
        stars = written(components(all_links, "u", "v"), "components")
    named = classes.join(stars, "node", "left").select("digest", F.coalesce("component", "node").alias("component_id"))
    named = written(named, "class-components")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    found = documents.join(named, "digest", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id")
    )
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **parameters) -> DataFrame:
    """The rows of `df` that stay, with all their columns: the least doc_id of each component."""
    kept = near_groups(df, id_col=id_col, text_col=text_col, **parameters).where("kept AND doc_id IS NOT NULL")
    kept = written(kept.select(F.col("doc_id").alias("id")).distinct(), "kept")
    rows = packed(df, id=F.col(id_col).cast("long"))
    stays = rows.join(kept, "id", "left_semi").select("row")
    return unpacked(stays.unionAll(rows.where(F.col("id").isNull()).select("row")), df.columns)
