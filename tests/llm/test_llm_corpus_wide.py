"""Sharding, alignment and conversation trie against brute force."""

import collections
import hashlib
import heapq
import itertools
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_fixtures import EXTRA, corpus, frame, text_of
from pyspark.sql import functions as F

from hammerprice.llm import alignment, conversation_trie, sharding
from hammerprice.llm.queries import QUERIES


def counted(rows):
    return collections.Counter(map(tuple, rows))


# --- sharding ---


def plain_differencing(sizes, lanes):
    """Karmarkar-Karp on lists of items, without seeds or blocks."""
    heap = [(-size, i, [(size, [size])] + [(0, []) for _ in range(lanes - 1)]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    serial = len(sizes)
    while len(heap) > 1:
        first, second = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        merged = [(a + b, x + y) for (a, x), (b, y) in zip(first, reversed(second), strict=True)]
        merged.sort(key=lambda lane: -lane[0])
        heapq.heappush(heap, (merged[-1][0] - merged[0][0], serial, merged))
        serial += 1
    return [total for total, _ in heap[0][2]]


@pytest.mark.parametrize("lanes", [1, 2, 3, 7])
def test_differencing_is_as_even_as_the_plain_one(lanes):
    rng = random.Random(lanes)
    sizes = sorted((rng.randint(1, 10_000) for _ in range(300)), reverse=True)
    found = sharding.difference(sizes, [0] * lanes)
    sums = np.bincount(found, sizes, lanes)
    plain = plain_differencing(sizes, lanes)
    assert sums.sum() == sum(sizes)
    assert max(sums) - min(sums) <= max(4, 2 * (max(plain) - min(plain)))


def test_differencing_makes_up_for_uneven_sums():
    sizes = sorted(range(1, 400), reverse=True)
    start = [5000, 0, 1200, 40]
    lanes = sharding.difference(sizes, start)
    sums = np.bincount(lanes, sizes, 4) + start
    assert max(sums) - min(sums) <= 2
    assert sharding.difference([], start) == []


def shard_sums(rows, n):
    return [sum(r["size"] for r in rows if r["shard"] == s) for s in range(n)]


@pytest.mark.parametrize("block_groups", [5, 1000])
def test_shards_are_even_gapless_and_keep_groups_together(spark, block_groups):
    rows = corpus(3)
    found = sharding.assign_shards(frame(spark, rows).repartition(5), 4, block_groups=block_groups, heavy_parts=50).collect()
    want = counted((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert counted((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == want
    for shard in range(4):
        mine = sorted(r["slot"] for r in found if r["shard"] == shard)
        assert mine == list(range(len(mine)))
    homes = collections.defaultdict(set)
    for r in found:
        homes[r["text_crc32"]].add(r["shard"])
    assert all(len(shards) == 1 for shards in homes.values())
    sums = shard_sums(found, 4)
    largest = collections.Counter()
    for _, size, crc in want.elements():
        largest[crc] += size
    assert max(sums) <= max(sum(sums) / 4 * 1.05, max(largest.values()))


def test_a_group_of_a_third_of_all_rows_leaves_the_other_shards_even(spark):
    rng = random.Random(1)
    rows = [(i, text_of(rng, rng.randint(3, 60))) for i in range(600)] + [(600 + i, "the same text " * 9) for i in range(300)]
    found = sharding.assign_shards(frame(spark, rows).repartition(4), 8, block_groups=100).collect()
    sums = sorted(shard_sums(found, 8))
    hot = {r["shard"] for r in found if r["doc_id"] >= 600}
    assert len(hot) == 1
    assert sums[-2] - sums[0] <= 0.02 * sums[0] or sums[-1] - sums[0] <= 0.02 * sums[0]


def test_sharding_of_few_or_no_rows(spark):
    assert sharding.assign_shards(frame(spark, []), 3).collect() == []
    found = sharding.assign_shards(frame(spark, [(1, None), (2, ""), (None, "a")]), 5).collect()
    assert {r["shard"] for r in found if r["doc_id"] in (1, 2)}.__len__() == 1
    assert sorted(r["size"] for r in found) == [16, 16, 17]


def test_with_shards_keeps_every_column(spark):
    df = frame(spark, corpus(4)).withColumn("digest", F.lit(1))
    out = sharding.with_shards(df, 3)
    assert out.columns == [*df.columns, "shard"]
    assert counted(out.drop("shard").collect()) == counted(df.collect())
    with pytest.raises(ValueError, match="shard"):
        sharding.with_shards(out, 3)


def test_sharding_query(spark, small):
    found = QUERIES["op11_sharding"](spark, small).collect()
    documents = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    assert counted((r.doc_id, r["size"], r.text_crc32, r.law, r.grown_shard) for r in found) == counted(
        (d.doc_id, len(d.text.encode()) + 16, zlib.crc32(d.text.encode()), "bytes", None) for d in documents
    )


# --- alignment ---

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.mark.parametrize("piece", [1, 2, 7, 512])
def test_merge_groups_whatever_the_pieces(piece):
    rng = np.random.default_rng(piece)
    for n in (1, 2, 5, 60, 900):
        total = n * 3
        a = np.append(np.sort(rng.choice(np.arange(1, total), min(total - 1, n), replace=False)), total)
        b = np.append(np.sort(rng.choice(np.arange(1, total), min(total - 1, 2 * n), replace=False)), total)
        common = np.intersect1d(a, b)
        got_a, got_b = alignment.merge_groups(a, b, piece)
        assert (got_a == np.searchsorted(common, a)).all() and (got_b == np.searchsorted(common, b)).all()
        diagonals = np.arange(0, len(a) + len(b) + 1)
        merged = np.argsort(np.concatenate([a, b]), kind="stable") < len(a)
        assert (alignment.diagonal_cuts(a, b, diagonals) == np.concatenate([[0], np.cumsum(merged)])).all()
    empty = np.zeros(0, np.int64)
    assert [len(x) for x in alignment.merge_groups(empty, empty)] == [0, 0]


def brute_groups(text):
    """Groups of ids by encoding the whole text at once."""
    import sentencepiece
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel

    if not brute_groups.__dict__:
        brute_groups.a = Tokenizer.from_file(PATHS[0])
        brute_groups.a.encode_special_tokens = True
        brute_groups.b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
        assert len(ByteLevel.alphabet()) == 256
    a, b = brute_groups.a, brute_groups.b
    if not text:
        return []
    letters = alignment._byte_letters()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return []
    ends_a, ends_b = (list(itertools.accumulate(map(len, each))) for each in (bytes_a, bytes_b))
    cuts = sorted(set(ends_a) & set(ends_b))
    sides = []
    for ids, ends in ((ids_a, ends_a), (ids_b, ends_b)):
        groups, at = [], 0
        for end in cuts:
            stop = ends.index(end, at) + 1
            groups.append(ids[at:stop])
            at = stop
        sides.append(groups)
    return list(zip(*sides, strict=True))


def brute_linked(rows):
    documents = [(i, brute_groups(text)) for i, text in rows]
    links = [[(a, b) for left, right in groups for a in left for b in right] for _, groups in documents]
    count = collections.Counter(pair for each in links for pair in set(each))
    highest = collections.defaultdict(int)
    for (a, _), n in count.items():
        highest[a] = max(highest[a], n)
    for (i, groups), each in zip(documents, links, strict=True):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        yield (
            i, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(each),
            hashlib.sha256(text.encode()).hexdigest() if groups else "",
            sum(count[pair] == highest[pair[0]] for pair in each), sum(count[pair] for pair in each),
        )


ODD = [
    "", None, " ", "  ", "a ", " a", "  a  b ", "\n\n  a", "a\n\n  b\n c", "a　 b  c\u0085 d", "é à Ã  x", "x▁y z",
    "<s> </s> <unk> <0x41> <|endoftext|>", "数据 🙂 é ​ x", "a  b", "x" * 3000, "ab" * 1500 + " c", "\x00 a", "a\t b",
    "don't  we'll\r\n  x", "   ", "\n", "word", "1234567 89", "🙂" * 300, " ".join(["same word"] * 400),
]


def test_links_of_odd_texts(spark):
    rows = list(enumerate(ODD)) + [(100 + i, t) for i, t in corpus(5, 30) if i is not None] + [(None, "no id"), (3, "a b"), (3, "a b")]
    df = frame(spark, rows).repartition(3)
    assert counted(alignment.linked_counts(df, *PATHS).collect()) == counted(brute_linked(rows))
    groups = {(r.doc_id, r.groups) for r in alignment.aligned_groups(df, *PATHS).collect()}
    assert groups == {
        (i, ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in brute_groups(text))) for i, text in rows
    }


def test_links_over_several_blocks_and_a_forgetful_lexicon(monkeypatch):
    monkeypatch.setattr(alignment, "LEXICON", 20)
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 500)
    lexicon = alignment._Lexicon(alignment._tokenizers(*PATHS))
    texts = [(t or "").encode() for _, t in corpus(6, 20)]
    for start in range(0, len(texts), 3):
        part = texts[start : start + 3]
        block = alignment._Block(part, lexicon)
        for text, groups in zip(part, block.groups(lexicon), strict=True):
            want = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in brute_groups(text.decode()))
            assert groups.decode() == want


def test_alignment_of_no_rows(spark):
    assert alignment.linked_counts(frame(spark, []), *PATHS).collect() == []


def test_alignment_query(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op12_alignment"](spark, small)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    assert counted(found.select(names).collect()) == counted(brute_linked(rows))


# --- conversation trie ---


def brute_trie(rows, every=20, borrowed=lambda c: zlib.crc32(str(c).encode()) % 4):
    turns = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(role, text) for *_, role, text in sorted(v)] for c, v in turns.items()}
    rebuilt = {c: own.get(c - c % every, [])[: borrowed(c)] + own[c][borrowed(c) :] for c in own}
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c in sorted(rebuilt):
        path = tuple(rebuilt[c])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = collections.Counter(path[:-1] for path in members if path)
    leaves, saved = collections.Counter(), collections.Counter()
    for path, who in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += children[path] == 0
            saved[path[:d]] += (len(who) - 1) * words
    return counted(
        (
            who[0], len(path), members[path[:-1]][0] if path else None, len(who), children[path], leaves[path], saved[path],
            hashlib.sha256(",".join(map(str, ends[path])).encode()).hexdigest(),
        )
        for path, who in members.items()
    )


SCHEMA = "conv_id long, turn long, role string, text string"


def conversations(spark, rows):
    extra = [F.lit(None).cast("string").alias(name) for name in [*EXTRA.split(), "pos", "shard", "k1"]]
    return spark.createDataFrame(rows, SCHEMA).select("*", *extra)


def nodes(spark, rows, shard_turns=conversation_trie.SHARD_TURNS, band=conversation_trie.BAND):
    borrowed = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(4))
    turns = conversation_trie.ordered_turns(conversations(spark, rows).repartition(3))
    path = conversation_trie.rebuilt_paths(turns, borrowed, 20, shard_turns)
    return counted(conversation_trie.trie(path, band).collect())


def talk(seed, n=70):
    rng = random.Random(seed)
    says = ["hello there", "yes", "no, not now", "", None, "a\tb\nc", "été  là", "x " * 40]
    rows = []
    for conv in range(n):
        length = 25 if conv % 11 == 0 else rng.randint(1, 5)
        rows += [(conv, turn, rng.choice(["user", "assistant", None]), rng.choice(says)) for turn in range(length)]
    rows += [(500 + c, t, "user", "the very same") for c in range(40) for t in range(6)]
    rows += [(None, 1, "user", "nobody's"), (3, None, "system", "first of all"), (3, None, "system", "first of all")]
    return rows + [(1000, t, "user", "again") for t in [0] * 5]


@pytest.mark.parametrize(("shard_turns", "band"), [(4096, 128), (7, 2), (40, 1), (20, 3)])
def test_trie_whatever_the_shards_and_bands(spark, shard_turns, band):
    rows = talk(shard_turns)
    assert nodes(spark, rows, shard_turns, band) == brute_trie(rows)


def test_trie_of_turnless_and_of_no_conversations(spark):
    rows = [(c, 0, "user", "one turn only") for c in range(21, 40)]  # conversation 20, which they borrow from, is not there
    assert nodes(spark, rows) == brute_trie(rows)
    assert nodes(spark, []) == {}
    assert nodes(spark, [(None, 1, "user", "x")]) == {}


def test_trie_of_conversations_as_they_are(spark):
    rows = talk(9)
    turns = conversation_trie.ordered_turns(conversations(spark, rows))
    found = conversation_trie.trie(conversation_trie.paths(turns, 16), 4)
    assert counted(found.collect()) == brute_trie(rows, 1, lambda c: 0)


def test_trie_query(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert counted(QUERIES["op13_conversation_trie"](spark, small).collect()) == brute_trie(rows)
