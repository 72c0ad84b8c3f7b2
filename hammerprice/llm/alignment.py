"""Alignment of two tokenizers by merge-path partitioning of their token ends.

Both tokenizers cut the same bytes, so each gives ascending byte ends. A merge of the two lists is a path through a grid, and
diagonals of that grid cut the path into pieces of equal work, wherever the ends lie: the place where a diagonal meets the path
is found by binary search. All pieces of a block of documents advance together, one step of the merge at a time in every piece;
a step emits the token it passes with the number of common ends seen in its piece. An end in both lists closes a group. The
common ends of earlier pieces, added up, stitch pieces into groups over their boundaries.

Texts repeat their words, and neither tokenizer joins anything over a space that follows something else. So texts are cut there,
and each distinct stretch is tokenized, merged and written out once in a task's memory (`LEXICON` stretches at most).

How often two ids are linked is a matter of the whole corpus, and there are too many links to move. A block of documents counts
its documents by pair of ids; only these counts are shuffled. The sums come back to the blocks, one row per block and pair, and
are added up along the stretches of every document. A pair that every document holds is one row per block.

Edge cases: a null or empty text, and one whose tokens of either kind do not spell a space and the text byte by byte (a text with
U+2581, or bytes that are not UTF-8), has no tokens: zeros and an empty list of groups. Every input row gives one row, repeated
rows and doc_ids too, and counts as a document of its own. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hammerprice.llm.chunks import Chunks, cut_before
from hammerprice.llm.columns import id_and_bytes, slices, written

#: A block of documents is closed at so many bytes of text.
BLOCK_BYTES = 4 << 20
#: Distinct stretches that a task remembers; it forgets them all between two blocks when there are more.
LEXICON = 200_000
#: Steps of the merge in one piece.
PIECE = 512

#: Stretches are encoded so many at a time, longer ones than LONG bytes by themselves; so many texts go to a tokenizer at once.
RUN, LONG, SLAB = 128, 256, 64

#: Rows of stretches with their pairs hold so many stretches.
PAGE = 256

MARK = "▁"


# --- the merge ---


def diagonal_cuts(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many of the first `diagonals` elements of the merge of `a` and `b` come from `a`; equal ones from `a` first."""
    low, high = np.maximum(0, diagonals - len(b)), np.minimum(diagonals, len(a))
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high) // 2
        right = np.clip(diagonals - 1 - middle, 0, max(0, len(b) - 1))
        # The path passes a[middle] before the diagonal if it is not behind the element of b that it would replace.
        taken = open_ & (a[np.minimum(middle, len(a) - 1)] <= b[right])
        low = np.where(taken, middle + 1, low)
        high = np.where(open_ & ~taken, middle, high)


def merge_groups(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """For every token the number of its group, from the ascending ends of two tokenizations of the same bytes."""
    total = len(a) + len(b)
    group_a, group_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    if not total:
        return group_a, group_b
    starts = np.arange(0, total, piece)
    at_a = diagonal_cuts(a, b, starts)
    at_b = starts - at_a
    piece_a, piece_b = np.full(len(a), -1, np.int32), np.full(len(b), -1, np.int32)
    common = np.zeros(len(starts), np.int64)
    behind_a, behind_b = np.append(a, np.iinfo(np.int64).max), np.append(b, np.iinfo(np.int64).max)
    number = np.arange(len(starts))
    for step in range(piece):
        if starts[-1] + step == total:  # the last piece can be shorter
            number = number[:-1]
        i, j = at_a[number], at_b[number]
        from_a = behind_a[i] <= behind_b[j]
        ones, i, j = number[from_a], i[from_a], j[~from_a]
        group_a[i], piece_a[i] = common[ones], ones
        at_a[ones] += 1
        others = number[~from_a]
        group_b[j], piece_b[j] = common[others], others
        before = at_a[others] - 1
        common[others] += (before >= 0) & (a[before] == b[j])
        at_b[others] += 1
    stitched = np.cumsum(common) - common
    return group_a + stitched[piece_a], group_b + stitched[piece_b]


# --- the tokenizers ---


def _byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones as they are, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in set(plain)]
    return {chr(byte): byte for byte in plain} | {chr(256 + n): byte for n, byte in enumerate(others)}


#: Last bytes of white space above U+0080; a letter may end in them too, and is then not cut behind.
_WIDE_SPACE_END = np.zeros(256, bool)
_WIDE_SPACE_END[[*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = True


def _ends_solid(stretch: bytes) -> bool:
    last = stretch[-1]
    return (last > 32 and last != 127 and not _WIDE_SPACE_END[last]) or stretch[-2:-1] == b"\xc3"


class _Decimals:
    """Decimal ids, each followed by the first sign, or by the second one at the end of its side of a group."""

    def __init__(self, n: int, signs: bytes):
        texts = [str(i).encode() + bytes([sign]) for sign in signs for i in range(n)]
        self.n, self.flat = n, np.frombuffer(b"".join(texts), np.uint8)
        self.sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.first = np.cumsum(self.sizes) - self.sizes


class _Tokenizers:
    """The ids and the bytes of A (byte-level, .json) and B (pieces, .model)."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        letters = _byte_letters()
        self.a_bytes: list[bytes] = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            if all(letter in letters for letter in token):
                self.a_bytes[i] = bytes(letters[letter] for letter in token)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            value = bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(MARK, " ").encode()
            self.b_bytes.append(value)
        self.a_size, self.b_size = (np.array([len(token) for token in table], np.int64) for table in (self.a_bytes, self.b_bytes))
        self.a_text, self.b_text = _Decimals(len(self.a_bytes), b",|"), _Decimals(len(self.b_bytes), b",;")
        #: Whether no piece of B reaches over a space from what stands before it.
        self.divides = not any(MARK in self.b.id_to_piece(i).lstrip(MARK) for i in range(self.b.get_piece_size()))

    def encode(self, stretches: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of stretches that start with a space, which B adds by itself."""
        ids_a, ids_b = [], []
        for start in range(0, len(stretches), SLAB):  # the library's encodings are many times as large as their ids
            texts = [stretch.decode("utf-8", "replace") for stretch in stretches[start : start + SLAB]]
            ids_a += [np.array(encoding.ids, np.int64) for encoding in self.a.encode_batch(texts, add_special_tokens=False)]
            ids_b += [np.array(ids, np.int64) for ids in self.b.encode([text[1:] for text in texts], num_threads=1)]
        return ids_a, ids_b

    @staticmethod
    def _join(table: list[bytes], ids: np.ndarray) -> bytes:
        return b"".join(map(table.__getitem__, ids.tolist()))

    def spell(self, stretches: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Flat ids of A and of B, how many each stretch has, and which stretches both spell byte by byte.

        Stretches are encoded many at a time, joined: neither tokenizer joins them, unless white space meets white space.
        A run whose tokens do not spell it, or end elsewhere than its stretches, is encoded stretch by stretch.
        """
        alone = [
            i for i, stretch in enumerate(stretches)
            if not self.divides or len(stretch) > LONG or stretch[:2] == b"  " or not _ends_solid(stretch)
        ]
        apart = set(alone)
        joined = [i for i in range(len(stretches)) if i not in apart]
        runs = [joined[i : i + RUN] for i in range(0, len(joined), RUN)]
        bytes_of = [b"".join([stretches[i] for i in run]) for run in runs]
        order: list[int] = []
        parts_a, parts_b, sizes_a, sizes_b = [], [], [], []
        for run, whole, a, b in zip(runs, bytes_of, *self.encode(bytes_of), strict=True):
            ends = np.cumsum([len(stretches[i]) for i in run])
            ends_a, ends_b = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
            at_a, at_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
            if (
                len(a) and len(b) and ends_a[-1] == ends_b[-1] == ends[-1]
                and (ends_a[at_a] == ends).all() and (ends_b[at_b] == ends).all()
                and self._join(self.a_bytes, a) == whole == self._join(self.b_bytes, b)
            ):
                order += run
                parts_a.append(a)
                parts_b.append(b)
                sizes_a.append(np.diff(at_a, prepend=-1))
                sizes_b.append(np.diff(at_b, prepend=-1))
            else:
                alone += run
        spelled = np.ones(len(stretches), bool)
        for i, ids_a, ids_b in zip(alone, *self.encode([stretches[i] for i in alone]), strict=True):
            spelled[i] = self._join(self.a_bytes, ids_a) == stretches[i] == self._join(self.b_bytes, ids_b)
            kept_a, kept_b = (ids_a, ids_b) if spelled[i] else (ids_a[:0], ids_b[:0])
            parts_a.append(kept_a)
            parts_b.append(kept_b)
            sizes_a.append(np.array([len(kept_a)]))
            sizes_b.append(np.array([len(kept_b)]))
        order += alone
        found = []
        for parts, sizes in ((parts_a, sizes_a), (parts_b, sizes_b)):
            flat, size = np.concatenate([np.zeros(0, np.int64), *parts]), np.concatenate([np.zeros(0, np.int64), *sizes])
            first = np.cumsum(size) - size
            back = np.argsort(np.array(order, np.int64), kind="stable")
            found += [flat[_ragged(first[back], size[back])], size[back]]
        return *found, spelled


@lru_cache(maxsize=1)
def _tokenizers(a_path: str, b_path: str) -> _Tokenizers:
    return _Tokenizers(a_path, b_path)


def _cut(whole: list[bool]):
    """Stretches from a space that follows no white space up to the next one; texts marked `whole` are one stretch."""

    def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mask = data == 32
        before = data[:-1]
        solid = (before > 32) & (before != 127) & ~_WIDE_SPACE_END[before]
        solid[1:] |= (before[1:] >= 0x80) & (data[:-2] == 0xC3)  # the Latin-1 letters
        mask[1:] &= solid
        mask[:1] = False
        for i in np.flatnonzero(whole).tolist():
            mask[offsets[i] : offsets[i + 1]] = False
        return cut_before(mask, offsets)

    return cut


# --- stretches ---


class _Lexicon:
    """Distinct stretches with their groups and links."""

    def __init__(self, tokenizers: _Tokenizers):
        self.tokenizers = tokenizers
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.groups: list[bytes] = []
        self.counts = np.zeros((0, 4), np.int64)  # A tokens, B tokens, groups, links; A tokens < 0: not spelled
        self.pairs = np.zeros(0, np.int64)  # a << 32 | b, in order of stretch
        self.times = np.zeros(0, np.int64)
        self.first = np.zeros(1, np.int64)  # of the pairs of each stretch

    def add(self, stretches: list[bytes]) -> None:
        known = self.tokenizers
        flat_a, n_a, flat_b, n_b, spelled = known.spell(stretches)
        group_a, group_b = merge_groups(np.cumsum(known.a_size[flat_a]), np.cumsum(known.b_size[flat_b]))
        groups = int(group_a[-1]) + 1 if len(group_a) else 0
        in_a, in_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
        home = np.zeros(groups, np.int64)  # the stretch of a group
        home[group_a] = np.repeat(np.arange(len(stretches)), n_a)
        per_stretch = np.bincount(home, minlength=len(stretches)).astype(np.int64)
        links = np.bincount(home, in_a * in_b, len(stretches)).astype(np.int64)
        self.counts = np.concatenate([self.counts, np.stack([np.where(spelled, n_a, -1), n_b, per_stretch, links], 1)])
        self._write(flat_a, flat_b, group_a, group_b, home, len(stretches))

        where, pairs, times = _pairs(flat_a, flat_b, in_a, in_b, home)
        self.pairs, self.times = np.concatenate([self.pairs, pairs]), np.concatenate([self.times, times])
        each = np.bincount(where, minlength=len(stretches))
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(each)])
        for stretch in stretches:
            self.number[stretch] = len(self.number)

    def _write(self, flat_a, flat_b, group_a, group_b, home, n: int, slab: int = 1 << 17) -> None:
        """`a1,a2|b1;` of every group, joined for each stretch, the sign at the end left off."""
        known = self.tokenizers
        sign_a = np.append(group_a[1:] != group_a[:-1], True) if len(group_a) else np.zeros(0, bool)
        sign_b = np.append(group_b[1:] != group_b[:-1], True) if len(group_b) else np.zeros(0, bool)
        side = np.concatenate([group_a * 2, group_b * 2 + 1])
        order = np.argsort(side, kind="stable")
        which = np.concatenate([flat_a + sign_a * known.a_text.n, flat_b + sign_b * known.b_text.n + len(known.a_text.sizes)])[order]
        sizes = np.concatenate([known.a_text.sizes, known.b_text.sizes])
        first = np.concatenate([known.a_text.first, known.b_text.first + len(known.a_text.flat)])
        letters = np.concatenate([known.a_text.flat, known.b_text.flat])
        written_ = b"".join(
            letters[_ragged(first[part], sizes[part])].tobytes()
            for part in (which[i : i + slab] for i in range(0, len(which), slab))
        )
        ends = np.cumsum(np.bincount(home[side[order] >> 1], sizes[which], n)).astype(np.int64).tolist() if len(which) else [0] * n
        start = 0
        for end in ends:
            self.groups.append(written_[start : end - 1] if end > start else b"")
            start = end

    def numbers(self, stretches: list[bytes]) -> np.ndarray:
        new = [stretch for stretch in stretches if stretch not in self.number]
        if new:
            self.add(new)
        return np.array([self.number[stretch] for stretch in stretches], np.int64)


def _ragged(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indices first[i], first[i] + 1, ... (sizes[i] of them) for every i, one after the other."""
    stops = np.cumsum(sizes)
    return np.repeat(first - (stops - sizes), sizes) + np.arange(stops[-1] if len(stops) else 0)


def _tallied(groups: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (group, id) with how often they occur, by group."""
    order = np.lexsort((ids, groups))
    groups, ids = groups[order], ids[order]
    new = np.ones(len(ids), bool)
    new[1:] = (groups[1:] != groups[:-1]) | (ids[1:] != ids[:-1])
    at = np.flatnonzero(new)
    return groups[at], ids[at], np.diff(np.append(at, len(ids)))


def _pairs(flat_a, flat_b, in_a, in_b, home) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (stretch, pair of linked ids), in order of stretch, with how often they are linked there.

    Ids that repeat in a group are tallied first, so a long group costs its distinct pairs, which are results themselves.
    """
    groups = np.arange(len(in_a))
    group_a, id_a, times_a = _tallied(np.repeat(groups, in_a), flat_a)
    group_b, id_b, times_b = _tallied(np.repeat(groups, in_b), flat_b)
    distinct_b = np.bincount(group_b, minlength=len(groups))
    first_b = np.cumsum(distinct_b) - distinct_b
    each = distinct_b[group_a]
    left, right = np.repeat(np.arange(len(group_a)), each), _ragged(first_b[group_a], each)
    where = home[group_a[left]]
    pairs = (id_a[left] << 32) | id_b[right]
    times = times_a[left] * times_b[right]
    order = np.lexsort((pairs, where))
    where, pairs, times = where[order], pairs[order], times[order]
    new = np.ones(len(pairs), bool)
    new[1:] = (where[1:] != where[:-1]) | (pairs[1:] != pairs[:-1])
    at = np.flatnonzero(new)
    return where[at], pairs[at], np.add.reduceat(times, at) if len(at) else times


# --- documents ---


class _Block:
    """Stretches of some documents: their numbers in the lexicon, and where each document starts."""

    def __init__(self, texts: list[bytes], lexicon: _Lexicon):
        if len(lexicon.number) > LEXICON:
            lexicon.clear()
        apart = [not lexicon.tokenizers.divides or text.endswith(b" ") or MARK.encode() in text or b"\0" in text for text in texts]
        chunks = Chunks([b" " + text if text else b"" for text in texts], _cut(apart))
        codes, distinct = chunks.distinct()
        numbers = lexicon.numbers(distinct)
        self.first = chunks.first
        self.stretch = numbers[codes] if len(codes) else np.zeros(0, np.int64)
        self.n = len(texts)
        self.spelled = self.sums((lexicon.counts[:, 0] < 0).astype(np.int64)) == 0
        self.some = self.spelled & (np.diff(self.first) > 0)

    def sums(self, value: np.ndarray) -> np.ndarray:
        """By document, a value of the stretches added up."""
        return np.diff(np.concatenate([[0], np.cumsum(value[self.stretch])])[self.first])

    def totals(self, value: np.ndarray) -> np.ndarray:
        return np.where(self.some, self.sums(value), 0)

    def groups(self, lexicon: _Lexicon) -> Iterator[bytes]:
        written_, numbers = lexicon.groups, self.stretch.tolist()
        for some, a, b in zip(self.some.tolist(), self.first.tolist(), self.first[1:].tolist(), strict=False):
            yield b";".join([written_[n] for n in numbers[a:b]]) if some else b""


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    ids, texts, size = [], [], 0
    for part in slices(batches):
        for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
            ids.append(doc_id)
            texts.append(text)
            size += len(text)
            if size >= BLOCK_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def aligned_groups(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id`, `n_a`, `n_b`, `n_groups`, `n_links` and `groups` (`a1,a2|b1;a3|b2,b3`: ids in order) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = _Lexicon(_tokenizers(a_path, b_path))
        for ids, texts in _blocks(batches):
            block = _Block(texts, lexicon)
            columns = [pa.array(ids, pa.int64()), *(pa.array(block.totals(lexicon.counts[:, i])) for i in range(4))]
            columns.append(pa.array([groups.decode() for groups in block.groups(lexicon)], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups"])

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string"
    return id_and_bytes(df, id_col, text_col).mapInArrow(run, schema)


#: A block's rows are of three kinds. A document has the numbers of its stretches in `data`. A page of stretches, from number
#: `code` on, has how many pairs each holds in `sizes`, and the codes of these and how often they are linked in `data` and `times`.
#: A pair has its `code` in the block, its ids, and the number of the block's documents that hold it.
_DOCUMENT, _PAGE, _PAIR = range(3)
_TOTALS = ["n_a", "n_b", "n_groups", "n_links"]
_ROWS = (
    "block long, kind int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "code int, data binary, sizes binary, times binary, a int, b int, docs int"
)
_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
_TYPES = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def _rows(n: int, block: int, kind: int, **columns) -> pa.RecordBatch:
    """`n` rows of `_ROWS`, null in the columns not given."""
    columns |= {"block": np.full(n, block), "kind": np.full(n, kind, np.int32)}
    fields = [part.split() for part in _ROWS.split(", ")]
    values = [pa.array(columns[name], _TYPES[type_]) if name in columns else pa.nulls(n, _TYPES[type_]) for name, type_ in fields]
    return pa.RecordBatch.from_arrays(values, [name for name, _ in fields])


def _planes(values: np.ndarray) -> bytes:
    """Integers byte by byte, all lowest bytes first, as many planes as the largest needs."""
    if not len(values):
        return b""
    planes = max(1, (int(values.max()).bit_length() + 7) // 8)
    return bytes([planes]) + np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :planes].T).tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.int64)
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1)
    values = np.zeros(planes.shape[1], np.int64)
    for n, plane in enumerate(planes):
        values |= plane.astype(np.int64) << (8 * n)
    return values


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def _portions(bounds: np.ndarray, size: int = 50_000) -> Iterator[tuple[int, int]]:
    """Ranges of whole documents, of about `size` stretches or one document each."""
    start = 0
    while start < bounds[-1]:
        stop = int(bounds[max(np.searchsorted(bounds, start + size, "right") - 1, np.searchsorted(bounds, start, "right"))])
        yield start, stop
        start = stop


def _aligned(batches: Iterator[pa.RecordBatch], a_path: str, b_path: str) -> Iterator[pa.RecordBatch]:
    """Rows of `_ROWS` for all blocks of a task."""
    from pyspark import TaskContext

    lexicon, serial = _Lexicon(_tokenizers(a_path, b_path)), TaskContext.get().partitionId() << 32
    for ids, texts in _blocks(batches):
        block = _Block(texts, lexicon)
        doc = np.repeat(np.arange(block.n), np.diff(block.first))
        kept = block.some[doc]  # a document that is not spelled keeps no stretch
        doc, stretch = doc[kept], block.stretch[kept]
        often = np.bincount(stretch, minlength=len(lexicon.groups))
        used = np.flatnonzero(often)
        used = used[np.argsort(-often[used], kind="stable")]  # common stretches have small numbers
        number = np.empty(len(often), np.int64)
        number[used] = np.arange(len(used))
        stretch = number[stretch]
        sizes = np.diff(lexicon.first)[used]
        at = _ragged(lexicon.first[:-1][used], sizes)
        pairs = _distinct(lexicon.pairs[at])
        codes = np.searchsorted(pairs, lexicon.pairs[at])
        first = np.cumsum(sizes) - sizes

        # Documents by pair: distinct (document, stretch), then distinct (document, pair), some documents at a time.
        docs = np.zeros(len(pairs), np.int64)
        bounds = np.concatenate([[0], np.cumsum(np.diff(block.first) * block.some)])
        for a, b in _portions(bounds):
            held = _distinct(doc[a:b] * max(1, len(used)) + stretch[a:b])
            in_doc, held = held // max(1, len(used)), held % max(1, len(used))
            held = np.repeat(in_doc, sizes[held]) * max(1, len(pairs)) + codes[_ragged(first[held], sizes[held])]
            docs += np.bincount(_distinct(held) % max(1, len(pairs)), minlength=len(pairs))

        bounds = bounds.tolist()
        totals = {name: block.totals(lexicon.counts[:, i]) for i, name in enumerate(_TOTALS)}
        yield _rows(
            block.n, serial, _DOCUMENT, doc_id=ids, **totals,
            groups_sha256=[hashlib.sha256(groups).hexdigest() if groups else "" for groups in block.groups(lexicon)],
            data=[_planes(stretch[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)],
        )
        opens = list(range(0, len(used), PAGE))
        cuts = np.append(first, len(codes))[[*opens, len(used)]].tolist()
        times = lexicon.times[at]
        yield _rows(
            len(opens), serial, _PAGE, code=opens, sizes=[_planes(sizes[i : i + PAGE]) for i in opens],
            data=[_planes(codes[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)],
            times=[_planes(times[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)],
        )
        yield _rows(len(pairs), serial, _PAIR, code=np.arange(len(pairs)), a=pairs >> 32, b=pairs & 0xFFFFFFFF, docs=docs)
        serial += 1


def _finish(block: pa.Table, counted: pa.Table) -> pa.Table:
    """The documents of one block with what the corpus says of their links."""
    code = counted.column("pair_code").to_numpy()
    count, best = np.zeros(len(code), np.int64), np.zeros(len(code), np.int64)
    count[code] = counted.column("count").to_numpy()
    best[code] = counted.column("best").to_numpy()
    kind = block.column("kind").to_numpy()
    pages = block.take(np.flatnonzero(kind == _PAGE)).sort_by("code")
    sizes, codes, times = (
        np.concatenate([np.zeros(0, np.int64), *map(_from_planes, pages.column(name).to_pylist())])
        for name in ("sizes", "data", "times")
    )
    pair_first = np.concatenate([[0], np.cumsum(sizes)])
    documents = block.take(np.flatnonzero(kind == _DOCUMENT))
    stretches = [_from_planes(data) for data in documents.column("data").to_pylist()]

    def added(value: np.ndarray) -> pa.Array:
        of_stretch = np.diff(np.concatenate([[0], np.cumsum(value[codes] * times)])[pair_first])
        return pa.array([int(of_stretch[numbers].sum()) for numbers in stretches], pa.int64())

    kept = ["doc_id", *_TOTALS, "groups_sha256"]
    return pa.table([*(documents.column(name) for name in kept), added(best), added(count)], [*kept, "n_best", "count_sum"])


def linked_counts(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of every row its tokens, groups and links, and what its links count over all rows (`n_best`, `count_sum`).

    A pair's count is the number of rows that hold it linked; `n_best` is the number of links whose count is the highest
    of their A id, `count_sum` the sum of the counts. `groups_sha256` is that of `groups` in `aligned_groups`.
    """
    texts = id_and_bytes(df, id_col, text_col)
    rows = written(texts.mapInArrow(lambda batches: _aligned(batches, a_path, b_path), _ROWS), "aligned")
    held = rows.where(F.col("kind") == _PAIR).select(F.col("block").alias("of_block"), "code", "a", "b", "docs")
    counts = written(held.groupBy("a", "b").agg(F.sum("docs").alias("count")), "pair-counts")
    highest = counts.groupBy("a").agg(F.max("count").alias("highest"))
    best = (F.col("count") == F.col("highest")).cast("int").alias("best")
    judged = counts.join(highest, "a").select("a", "b", "count", best)
    counted = held.join(judged, ["a", "b"]).select("of_block", F.col("code").alias("pair_code"), "count", "best")
    kept = rows.where(F.col("kind") != _PAIR).drop("a", "b", "docs")
    return kept.groupBy("block").cogroup(counted.groupBy("of_block")).applyInArrow(_finish, _RESULT)
