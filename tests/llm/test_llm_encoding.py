import hashlib
import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from llm_fixtures import corpus, frame, text_of
from tokenizers import Tokenizer

from hammerprice.llm import byte_bpe, packing, token_counts
from hammerprice.llm.queries import QUERIES

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

ODD = [
    "a" * 3000, "ab" * 2000, "　x", "a\xa0 b  c  d　 e à é x \n\t q ", "  lead", "trail  ", " ", "\n", "x\x1c\x85y  \n\n z",
    "it's  don't 'll 's  z", "<|endoftext|> a<|b <s> </s>", "a▁b", "  a b", "İstanbul ΣΑΣ", "ſ K Å", "éͅ ą́", "x​y", "\x00 a\x01b",
    "ª º ² ¼ ß ẞ ﬁ ×a÷ c×. .é «x» x-'s q'.z (a'd-b)",
]


def library(ranks=RANKS):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.load_ranks(ranks), special_tokens={}
    )


def texts(n=40):
    rng = random.Random(4)
    return ODD + [text_of(rng, 80) for _ in range(n)] + ["".join(rng.choice(" a\n.'1é\xa0日B") for _ in range(9000))]


@pytest.mark.parametrize("cut", [None, byte_bpe.pre_token_cuts])
def test_bpe_equals_the_library(cut):
    encoder, wanted = byte_bpe.PairEncoder(byte_bpe.load_ranks(RANKS), public_tokenizers.PATTERN), library()
    found = encoder.encode([text.encode() for text in texts()], cut)
    assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == [wanted.encode_ordinary(text) for text in texts()]
    assert not any(encoder.leaves)  # the bitmap is empty after every pre-token


def test_bpe_merges_the_leftmost_pair_of_a_rank_first():
    ranks = {bytes([i]): i for i in range(256)} | {b"aa": 256, b"aab": 257, b"ba": 258, b"aaa": 259}
    encoder = byte_bpe.PairEncoder(ranks, r"\S+")
    assert encoder.parts(b"aaaaab") == [b"aa", b"aaa", b"b"]
    own = tiktoken.Encoding("own", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
    for text in ("aaaaab", "abaabaaab", "baaab", "aaaaaaaa", "b"):
        assert np.frombuffer(encoder.encode([text.encode()])[0], "<u4").tolist() == own.encode_ordinary(text)


def test_bpe_round_trip_of_every_row(spark):
    rows, wanted = corpus(), library()
    found = byte_bpe.round_trip(frame(spark, rows), RANKS, public_tokenizers.PATTERN).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1], x[2])
    got = sorted([(r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in found], key=key)
    packed = [(i, np.array(wanted.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in rows]
    assert got == sorted(packed, key=key)
    assert all(r.n_tokens == len(r.ids) // 4 for r in found)
    ids = byte_bpe.encode(frame(spark, rows), RANKS, public_tokenizers.PATTERN)
    assert byte_bpe.decode(ids, RANKS).count() == len(rows)
    assert byte_bpe.round_trip(frame(spark, []), RANKS, public_tokenizers.PATTERN).count() == 0


def test_bpe_query(spark, small):
    wanted = library()
    documents = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for row in QUERIES["op1_byte_bpe"](spark, small).collect():
        ids = np.array(wanted.encode_ordinary(documents[row.doc_id]), "<u4")
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(documents[row.doc_id].encode()).hexdigest()


def test_counts_equal_the_libraries():
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    counted = token_counts._counter(PIECES)([text.encode() for text in texts()])
    assert counted == [len(model.encode(text)) for text in texts()]
    tokenizer = Tokenizer.from_file(WORDS)
    counted = token_counts._counter(WORDS)([text.encode() for text in texts()])
    assert counted == [len(tokenizer.encode(text, add_special_tokens=False).ids) for text in texts()]


def test_counts_through_a_cold_and_a_warm_cache(spark, tmp_path):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows, cache = corpus(), str(tmp_path / "cache")
    wanted = sorted([(i or -1, len((t or "").encode()), len(model.encode(t or ""))) for i, t in rows])
    first = token_counts.token_counts(frame(spark, rows[:50]), PIECES, cache)
    assert first.count() == 50
    stored = spark.read.parquet(cache).count()
    assert stored == len({t or "" for _, t in rows[:50]})  # each content once
    found = token_counts.token_counts(frame(spark, rows), PIECES, cache).collect()
    assert sorted([(r.doc_id or -1, r.n_bytes, r.n_tokens) for r in found]) == wanted
    assert all(r.over_limit == (r.n_tokens > 4096) for r in found) and any(r.over_limit for r in found)
    everything = spark.read.parquet(cache).count()
    assert everything == len({t or "" for _, t in rows})
    token_counts.token_counts(frame(spark, rows), PIECES, cache).collect()
    assert spark.read.parquet(cache).count() == everything  # nothing missed, nothing appended
    other = token_counts.token_counts(frame(spark, [(1, "three words here")]), WORDS, cache).first()
    assert other.n_tokens == len(Tokenizer.from_file(WORDS).encode("three words here", add_special_tokens=False).ids)
    assert token_counts.token_counts(frame(spark, []), PIECES, cache).count() == 0


def test_count_query(spark, small):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    documents = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    found = QUERIES["op2_token_counts"](spark, small).collect()
    assert {r.doc_id: r.n_tokens for r in found} == {i: len(model.encode(t)) for i, t in documents.items()}


def checked_pieces(rows, pieces):
    """Pieces hold every document's ids once and in order, and sequences have no gap and no overflow."""
    tokenizer = Tokenizer.from_file(WORDS)
    documents, sequences = {}, {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == sequences.get(p.sequence_id, 0) and p.length > 0
        sequences[p.sequence_id] = p.offset + p.length
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        documents.setdefault(p.doc_id, []).append(p)
    assert max(sequences.values()) <= packing.WINDOW
    for i, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        own = sorted(documents[i], key=lambda p: p.start)
        assert [p.start for p in own] == np.cumsum([0, *(p.length for p in own)])[:-1].tolist()
        assert sum(p.length for p in own) == len(ids) == own[0].doc_tokens
        for p in own:
            part = np.array(ids[p.start : p.start + p.length], "<u4").tobytes()
            assert p.ids_crc32 == zlib.crc32(part)
    return sequences


def test_packing_keeps_every_id(spark):
    rows = [(i, t) for i, t in enumerate([t for _, t in corpus()] + ODD)]
    found = packing.pack(frame(spark, rows).coalesce(2), WORDS, stretch=6000).collect()
    checked_pieces(rows, found)
    assert packing.pack(frame(spark, []), WORDS).count() == 0
    assert packing.pack(frame(spark, corpus()), WORDS).agg({"doc_tokens": "count"}).first()[0] >= len(corpus())


def test_packing_query_pads_little(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    sequences = checked_pieces(rows, QUERIES["op4_packing"](spark, small).collect())
    assert len(sequences) * packing.WINDOW < 1.05 * sum(sequences.values())


def test_window_ends_are_the_cheapest():
    rng = np.random.default_rng(3)
    for _ in range(60):
        window, total = 8, int(rng.integers(5, 40))
        points = np.union1d(rng.choice(np.arange(1, total), min(total - 1, int(rng.integers(3, 30))), replace=False), total)
        points = np.union1d(points, np.arange(window, total, window))
        penalties = rng.choice([0.0, 1.0, 3.0], len(points))
        cost = {0: 0.0}
        for end, penalty in zip(points.tolist(), penalties.tolist(), strict=True):
            cost[end] = penalty + min(c + window - (end - q) for q, c in cost.items() if end - q <= window)
        ends = packing.window_ends(points, penalties, window)
        paid = dict(zip(points.tolist(), penalties.tolist(), strict=True))
        assert ends[-1] == total
        assert sum(paid[e] + window - (e - s) for s, e in zip([0, *ends], ends, strict=False)) == cost[total]


def test_word_ids_equal_the_library():
    tokenizer, library_of = packing.WordTokenizer(WORDS), Tokenizer.from_file(WORDS)
    found = tokenizer.encode([text.encode() for text in texts()])
    wanted = [library_of.encode(text, add_special_tokens=False).ids for text in texts()]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == wanted


def test_words_that_never_end_do_not_fill_a_worker():
    """What a worker remembers is bounded in chunks and bytes, and ids are the library's however often it forgets."""
    tokenizer, library_of = packing.WordTokenizer(WORDS), Tokenizer.from_file(WORDS)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = ["".join(w) for w in itertools.product(letters, repeat=4)][:400_000]
    texts = [" ".join(words[i : i + 1000]) + " caf\u00e9 " + "the" * (2000 + i // 1000) for i in range(0, len(words), 1000)]
    for start in range(0, len(texts), 20):
        found = tokenizer.encode([text.encode() for text in texts[start : start + 20]])
        held = [*tokenizer.chunks.items(), *tokenizer.chunks.older.items()]
        assert len(held) <= 320_000 and sum(len(k) + len(v) for k, v in held) < 10 << 20
        for i in (0, 19):
            assert np.frombuffer(found[i], "<u4").tolist() == library_of.encode(texts[start + i], add_special_tokens=False).ids
    again = tokenizer.encode([texts[0].encode()])[0]  # long forgotten
    assert np.frombuffer(again, "<u4").tolist() == library_of.encode(texts[0], add_special_tokens=False).ids


def test_ids_stay_right_when_a_slice_holds_more_chunks_than_are_remembered(monkeypatch):
    monkeypatch.setattr(packing, "KNOWN_CHUNKS", 7)
    tokenizer, library_of = packing.WordTokenizer(WORDS), Tokenizer.from_file(WORDS)
    for some in (texts(), texts()[::-1], texts()[:5]):
        found = tokenizer.encode([text.encode() for text in some])
        wanted = [library_of.encode(text, add_special_tokens=False).ids for text in some]
        assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == wanted
