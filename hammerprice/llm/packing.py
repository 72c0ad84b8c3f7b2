"""Packing token streams into windows by an order-preserving dynamic program.

The documents of a task form one token stream, in the order in which Spark reads them. A window may end after a document,
after a sentence, or, inside a sentence that would not fit otherwise, after every `hard_step` tokens. The program chooses
the window ends that minimise padding plus a penalty for each cut inside a document. A window that ends at position p and
starts at q costs (window - (p - q)) + penalty(p), so the best start is the minimum of best(q) + q over the last `window`
positions, which a monotone queue yields in constant time a step.

The stream is cut into stretches of at most about `stretch` tokens to bound memory; a stretch's last window is not closed
but opens the next one, so no padding arises there. Only a task's last window ends early.

Edge cases: a null or empty text is its end mark alone. Null doc_ids, ties and repeated rows do not matter, each row is a
document of its own. Other columns of the input are ignored. An empty table gives no pieces.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame

from hammerprice.llm.chunks import LOWER, Chunks, Memo, gathered, words_and_signs
from hammerprice.llm.columns import id_and_bytes, slices

WINDOW = 4096
SENTENCE_PENALTY = 16.0
HARD_PENALTY = 64.0
HARD_STEP = 128
STRETCH = 1 << 20
#: Chunks in each of the two generations a worker remembers; rare ones never end, and every worker of an executor has its own.
KNOWN_CHUNKS = 150_000

PIECE = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
)


class WordTokenizer:
    """Texts to ids as little-endian unsigned 32-bit integers.

    The tokenizer drops white space, lower-cases, and never merges across words, so a text's ids are those of its chunks.
    New chunks of Latin script are taken apart into words and encoded word by word; the library gets others as they are, and
    whole texts in which special tokens may stand.
    """

    #: Where chunks are Latin script, lower-casing and the word pattern mean the same here and in the library.
    LATIN = re.compile("[!-~¡-ɏ]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        vocabulary = self.library.get_vocab()
        size = max(vocabulary.values()) + 1
        ends = np.zeros(size, bool)
        sentence = np.zeros(size, bool)
        for token, i in vocabulary.items():
            ends[i] = token.endswith("</w>")
            sentence[i] = token.endswith((".</w>", "!</w>", "?</w>"))
        self.ends, self.sentence = ends, sentence
        self.packed = [i.to_bytes(4, "little") for i in range(size)]
        self.find = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall
        self.chunks = Memo(lambda chunk: self._whole(chunk), entries=KNOWN_CHUNKS)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        special = [b"<|" in text for text in texts]
        chunks = Chunks([b"" if s else text for text, s in zip(texts, special, strict=True)], words_and_signs, LOWER)
        codes, distinct = chunks.distinct()
        long = self._learn(distinct)
        ids = gathered(codes, [self.chunks[chunk] for chunk in distinct], chunks.first)
        for chunk in long:
            self.chunks.pop(chunk, None)
            self.chunks.older.pop(chunk, None)
        return [self._whole(text) if s else found for text, s, found in zip(texts, special, ids, strict=True)]

    def _whole(self, text: bytes) -> bytes:
        ids = self.library.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _learn(self, chunks: list[bytes]) -> list[bytes]:
        """Put the new ones of `chunks` into the memo; returns those too long to stay there.

        Words of ASCII are what the library's pre-tokenizer makes of them, so its model gets them at once.
        """
        known, model, packed = self.chunks, self.library.model.tokenize, self.packed
        absent = [chunk for chunk in chunks if chunk not in known]
        if len(known) + len(absent) > known.entries:
            known.make_room(len(absent))
            absent = chunks
        older, new = known.older, []
        for chunk in absent:
            if (value := older.get(chunk)) is None:
                new.append(chunk)
            else:
                known[chunk] = value  # older ones go when there is no more room
        split: dict[bytes, list[str]] = {}
        for chunk in new:
            if chunk.isalpha():
                known[chunk] = b"".join([packed[token.id] for token in model(chunk.decode())])
            elif self.LATIN.fullmatch(text := chunk.decode("utf-8", "replace")):
                if text.isascii():
                    known[chunk] = b"".join([packed[t.id] for word in self.find(text) for t in model(word)])
                else:
                    split[chunk] = self.find(unicodedata.normalize("NFC", text).lower())
        rest = list(split)
        for start in range(0, len(rest), 64):  # longer texts take the library more time a word
            some = rest[start : start + 64]
            words = [word for chunk in some for word in split[chunk]]
            ids = np.array(self.library.encode(" ".join(words), add_special_tokens=False).ids, "<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1  # each word has one token that ends it
            if len(ends) != len(words):
                raise RuntimeError("the tokenizer does not end every word with one token")
            ends, joined = [0, *(ends * 4).tolist()], ids.tobytes()
            word = 0
            for chunk in some:
                last, word = word, word + len(split[chunk])
                known[chunk] = joined[ends[last] : ends[word]]
        return [chunk for chunk in new if len(chunk) > known.longest]


@lru_cache(maxsize=1)
def _tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def cut_points(
    ids: np.ndarray, doc_ends: np.ndarray, sentence: np.ndarray, window: int, hard_step: int
) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a window may end, and the penalty of each; at most `window` apart."""
    soft = np.flatnonzero(sentence[ids]) + 1
    points = np.union1d(soft, doc_ends)
    gaps = np.diff(points, prepend=0)
    hard = [np.arange(points[i] - gaps[i] + hard_step, points[i], hard_step) for i in np.flatnonzero(gaps > window // 16)]
    if hard:
        points = np.union1d(points, np.concatenate(hard))
    penalties = np.full(len(points), HARD_PENALTY)
    penalties[np.isin(points, soft, assume_unique=True)] = SENTENCE_PENALTY
    penalties[np.isin(points, doc_ends, assume_unique=True)] = 0.0
    return points, penalties


def window_ends(points: np.ndarray, penalties: np.ndarray, window: int) -> list[int]:
    """Ends of the windows that cost least, the last one being the last point."""
    ends, cost = [0, *points.tolist()], [0.0, *penalties.tolist()]
    n = len(ends)
    start = [0] * n
    queue: deque[int] = deque([0])  # candidates for a start: cost so far + end rises from left to right
    rising = [0.0] * n
    for i in range(1, n):
        end = ends[i]
        while ends[queue[0]] < end - window:
            queue.popleft()
        j = queue[0]
        start[i] = j
        rising[i] = value = rising[j] + window + cost[i]  # the window's cost, with `end` added
        while queue and rising[queue[-1]] >= value:
            queue.pop()
        queue.append(i)
    chosen, i = [], n - 1
    while i:
        chosen.append(ends[i])
        i = start[i]
    return chosen[::-1]


class _Stream:
    """The token stream of one task, closed window by window."""

    def __init__(self, sentence: np.ndarray, end_id: int, window: int, first_sequence: int):
        self.sentence, self.end_mark, self.window = sentence, end_id.to_bytes(4, "little"), window
        self.sequence = first_sequence
        self.docs: list[tuple] = []  # doc_id, ids, tokens before what is left here, tokens of the document
        self.held = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        ids += self.end_mark
        self.docs.append((doc_id, ids, 0, len(ids) // 4))
        self.held += len(ids) // 4

    def close(self, last: bool) -> list[tuple]:
        """Pieces of the windows that are settled; of all windows if the stream ends here."""
        if not self.docs:
            return []
        ids = np.frombuffer(b"".join([doc[1] for doc in self.docs]), "<u4")
        doc_ends = np.cumsum([len(doc[1]) // 4 for doc in self.docs])
        ends = window_ends(*cut_points(ids, doc_ends, self.sentence, self.window, HARD_STEP), self.window)
        pieces, at, doc = [], 0, 0
        settled = len(ends) if last else len(ends) - 1
        doc_id, packed, before, total = self.docs[0]
        for end in ends[:settled]:
            offset = 0
            while at < end:
                doc_id, packed, before, total = self.docs[doc]
                done = min(int(doc_ends[doc]), end)
                first = len(packed) // 4 - (int(doc_ends[doc]) - at)
                piece = packed[4 * first : 4 * (first + done - at)]
                pieces.append((doc_id, before + first, done - at, zlib.crc32(piece), total, self.sequence, offset, piece))
                offset += done - at
                at = done
                doc += at == doc_ends[doc]
            self.sequence += 1
        rest = self.docs[doc:]
        if rest:
            doc_id, packed, before, total = rest[0]
            first = len(packed) // 4 - (int(doc_ends[doc]) - at)
            rest[0] = (doc_id, packed[4 * first :], before + first, total)
        self.docs, self.held = rest, len(ids) - at
        return pieces


def _batch(pieces: list[tuple]) -> pa.RecordBatch:
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    columns = list(zip(*pieces, strict=True))
    return pa.RecordBatch.from_arrays(
        [pa.array(x, pa.int64() if name != "ids" else pa.binary()) for name, x in zip(names, columns, strict=True)], names
    )


def pack(
    df: DataFrame,
    path: str,
    end_id: int = 2,
    window: int = WINDOW,
    stretch: int = STRETCH,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece of a document: where it lies in its document and in its sequence, and its ids.

    `path`: a tokenizer file (.json) that drops white space and ends words by a mark. `sequence_id` counts from the task's
    number times 2**32, so sequences are distinct without a shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        stream = _Stream(tokenizer.sentence, end_id, window, TaskContext.get().partitionId() << 32)
        for part in slices(batches):
            encoded = tokenizer.encode(part.column("text").to_pylist())
            for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoded, strict=True):
                stream.add(doc_id, ids)
                if stream.held >= stretch and (pieces := stream.close(last=False)):
                    yield _batch(pieces)
        if pieces := stream.close(last=True):
            yield _batch(pieces)

    return id_and_bytes(df, id_col, text_col).mapInArrow(run, PIECE)
