"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Encoding a pre-token keeps its bytes as a linked list of parts. Every pair of neighbours that the vocabulary can merge
stands in the bucket of its merge rank, as the list position of its left part. A bitmap over the ranks, in words, with a
bitmap over those words, finds the lowest rank that has a bucket by two find-first-set steps. Entries
are never removed when a merge changes their neighbourhood: a popped entry whose pair no longer has that rank is skipped.
The cost of a pre-token of n bytes is O(n log n), whatever its length.

Edge cases: a null or empty text has no ids and decodes to an empty text. Row order, ties and repeated rows do not matter,
each row is on its own. Other columns of the input are ignored. Bytes that are not UTF-8 are replaced by U+FFFD, as a
string column cannot hold them. An id without an entry in the vocabulary stops decoding with an error.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from hammerprice.llm.chunks import Chunks, Memo, cut_before, gathered, letter_sign_cuts
from hammerprice.llm.columns import id_and_bytes, slices

#: Bits that number a rank within its word of the bitmap.
WORD = 8
LAST = (1 << WORD) - 1

ENCODED = "doc_id long, n_tokens long, ids binary"
ROUND_TRIP = ENCODED + ", decoded binary"


def load_ranks(path: str) -> dict[bytes, int]:
    """Merge ranks from lines of base64 token and rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PairEncoder:
    """Texts to ids as little-endian unsigned 32-bit integers, with a memo of the chunks met lately."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.packed = {token: rank.to_bytes(4, "little") for token, rank in ranks.items()}
        self.find = regex.compile(pattern).findall
        self.chunks = Memo(self._chunk, entries=300_000)
        #: A word has a bit for each of 2**WORD ranks that has a bucket; the root has one for each word that isn't zero.
        self.leaves = [0] * ((max(ranks.values()) >> WORD) + 1)
        self.bit = [1 << i for i in range(max(LAST + 1, len(self.leaves)))]

    def _piece(self, piece: str) -> bytes:
        data = piece.encode()
        return self.packed.get(data) or b"".join([self.packed[part] for part in self.parts(data)])

    def _chunk(self, chunk: bytes) -> bytes:
        return b"".join(map(self._piece, self.find(chunk.decode("utf-8", "replace"))))

    def encode(self, texts: list[bytes], cut=None) -> list[bytes]:
        """`cut` must cut where no pre-token of the pattern can cross; without it every text is matched as a whole."""
        if cut is None:
            return [self._chunk(text) for text in texts]
        chunks = Chunks(texts, cut)
        codes, distinct = chunks.distinct()
        return gathered(codes, [self.chunks[chunk] for chunk in distinct], chunks.first)

    def parts(self, data: bytes) -> list[bytes]:
        """The parts that are left when no pair of neighbours can be merged, lowest rank and leftmost pair first."""
        n, rank_of, leaves, bit = len(data), self.ranks.get, self.leaves, self.bit
        after = list(range(1, n + 1))  # a part starts at its position and ends where the next one starts
        before = list(range(-1, n - 1))
        current = [rank_of(data[i : i + 2], -1) for i in range(n)]  # rank of the pair that starts here
        current[-1] = -1
        buckets: dict[int, int | list[int]] = {}  # the position, or a heap of them
        root = 0
        pushed = [(rank, i) for i, rank in enumerate(current) if rank >= 0]
        while True:
            for rank, i in pushed:
                if rank in buckets:
                    held = buckets[rank]
                    if type(held) is int:
                        buckets[rank] = [held, i] if held < i else [i, held]
                    else:
                        heappush(held, i)
                else:
                    buckets[rank] = i
                    word = rank >> WORD
                    if not leaves[word]:
                        root |= bit[word]
                    leaves[word] |= bit[rank & LAST]
            if not root:
                break
            word = (root & -root).bit_length() - 1
            bits = leaves[word]
            lowest = bits & -bits
            rank = word << WORD | lowest.bit_length() - 1
            held = buckets[rank]
            if type(held) is int:
                i = held
            else:
                i = heappop(held)
                if held:
                    lowest = 0
            if lowest:
                del buckets[rank]
                leaves[word] = bits = bits ^ lowest
                if not bits:
                    root ^= bit[word]
            pushed = []
            if current[i] != rank:
                continue  # stale: a merge beside it has changed the pair
            merged = after[i]
            current[merged] = current[i] = -1
            after[i] = end = after[merged]
            if end < n:
                before[end] = i
                if (new := rank_of(data[i : after[end]], -1)) >= 0:
                    current[i] = new
                    pushed.append((new, i))
            if (left := before[i]) >= 0:
                current[left] = new = rank_of(data[left:end], -1)
                if new >= 0:
                    pushed.append((new, left))
        found, i = [], 0
        while i < n:
            found.append(data[i : after[i]])
            i = after[i]
        return found


def pre_token_cuts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cuts before a space that follows an ASCII sign or a letter of the Latin-1 block, and between letters and signs.

    No pre-token crosses there if the pattern keeps letters and signs apart, lets white space stand at the start of a
    pre-token only, and makes white space depend on nothing before it.
    """
    mask = data == 32
    signs = (data > 32) & (data < 127)
    signs[1:] |= (data[1:] >= 128) & (data[:-1] == 0xC3)
    mask[1:] &= signs[:-1]
    mask[letter_sign_cuts(data)] = True
    return cut_before(mask, offsets)


#: Patterns for which `pre_token_cuts` holds.
_CUTS = {
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""": pre_token_cuts,
}


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> PairEncoder:
    return PairEncoder(load_ranks(path), pattern)


@lru_cache(maxsize=2)
def _tokens(path: str) -> dict[int, bytes]:
    return {rank: token for token, rank in load_ranks(path).items()}


def _encode(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    encoder, cut = _encoder(path, pattern), _CUTS.get(pattern)
    for part in slices(batches):
        ids = encoder.encode(part.column("text").to_pylist(), cut)
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
            ["doc_id", "n_tokens", "ids"],
        )


def _decode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    token = _tokens(path).__getitem__
    for part in slices(batches):
        texts = [b"".join(map(token, np.frombuffer(ids or b"", "<u4").tolist())) for ids in part.column("ids").to_pylist()]
        yield part.append_column("decoded", pa.array(texts, pa.binary()))


def encode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id`, `n_tokens` and `ids` (little-endian unsigned 32-bit integers) of every whole text."""
    return id_and_bytes(df, id_col, text_col).mapInArrow(lambda batches: _encode(batches, path, pattern), ENCODED)


def decode(df: DataFrame, path: str) -> DataFrame:
    """`encode`'s columns and `decoded`, the bytes that the ids stand for; null ids count as none."""
    return df.select("doc_id", "n_tokens", "ids").mapInArrow(lambda batches: _decode(batches, path), ROUND_TRIP)


def round_trip(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`decode(encode(df))` in one Python pass."""
    return id_and_bytes(df, id_col, text_col).mapInArrow(
        lambda batches: _decode(_encode(batches, path, pattern), path), ROUND_TRIP
    )
