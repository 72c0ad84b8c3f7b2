"""Texts taken apart at white space with numpy, so that Python meets each distinct chunk of a slice once.

A chunk's key mixes its bytes, eight at a time, with its length. Chunks of up to eight bytes have distinct keys; longer ones
differ in theirs but for chance (2**-64 for a pair), and those above `LONG` bytes are hashed one by one.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import xxhash

LONG = 256

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Masks of the first bytes of a little-endian word.
MASKS = np.array([(1 << 8 * n) - 1 for n in range(8)] + [0xFFFFFFFFFFFFFFFF], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (in place)."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


Cut = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


class Chunks:
    """Chunks of some texts, in order: `starts` and `ends` in the joined bytes, and `first` chunk of every text."""

    def __init__(self, texts: list[bytes], cut: Cut, mapped: np.ndarray | None = None):
        """`cut` gives starts and ends of the chunks from the joined bytes and the texts' offsets; none may cross texts.

        `mapped` replaces every byte by another one first, as for lower case.
        """
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.offsets = np.concatenate([[0], np.cumsum(lengths)])
        self.joined = b"".join(texts)
        if mapped is not None:
            self.joined = self.joined.translate(mapped.tobytes())
        self.bytes = np.frombuffer(self.joined + bytes(8), np.uint8)
        self.starts, self.ends = cut(self.bytes[:-8], self.offsets)
        self.first = np.searchsorted(self.starts, self.offsets)

    def keys(self) -> np.ndarray:
        words = np.ndarray((len(self.bytes) - 7,), "<u8", self.bytes, strides=(1,))
        length = self.ends - self.starts
        keys = length.astype(np.uint64) << np.uint64(56)
        np.bitwise_xor(keys, words[self.starts] & MASKS[np.minimum(length, 8)], out=keys)
        mix(keys)
        more, done = np.flatnonzero((length > 8) & (length <= LONG)), 8
        while len(more):
            left = length[more] - done
            block = words[self.starts[more] + done] & MASKS[np.minimum(left, 8)]
            keys[more] = mix((keys[more] * np.uint64(0x9E3779B97F4A7C15)) ^ block)
            more, done = more[left > 8], done + 8
        for i in np.flatnonzero(length > LONG).tolist():
            keys[i] = xxhash.xxh3_64_intdigest(self.joined[self.starts[i] : self.ends[i]])
        return keys

    def distinct(self) -> tuple[np.ndarray, list[bytes]]:
        """For every chunk the number of its distinct chunk, and the distinct chunks."""
        codes, _ = pd.factorize(self.keys())
        if not len(codes):
            return codes, []
        at = np.empty(codes.max() + 1, np.int64)
        at[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
        joined = self.joined
        spans = zip(self.starts[at].tolist(), self.ends[at].tolist(), strict=True)
        return codes, [joined[start:end] for start, end in spans]


def white_space_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of bytes other than ASCII white space."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~_SPACE[data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    opens = offsets[:-1][offsets[:-1] < len(data)]
    starts[opens] |= inside[opens]
    closes = offsets[1:][offsets[1:] > 0] - 1
    ends[closes] |= inside[closes]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_SIGN = np.zeros(256, bool)
_SIGN[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "'<|>"]] = True


def letter_sign_cuts(data: np.ndarray) -> np.ndarray:
    """Positions between an ASCII or Latin-1 letter and an ASCII sign, either way round.

    Apostrophes, which contractions need, and the signs of special tokens never cut.
    """
    if len(data) < 2:
        return np.zeros(0, np.int64)
    letter, sign = _LETTER[data], _SIGN[data]
    pair = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    letter[1:] |= pair
    letter[:-1] |= pair
    return np.flatnonzero((letter[:-1] & sign[1:]) | (sign[:-1] & letter[1:])) + 1


#: Lower case of A-Z, byte by byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words_and_signs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """White-space-separated runs, cut further between letters and signs."""
    starts, ends = white_space_words(data, offsets)
    cuts = letter_sign_cuts(data)
    cuts = cuts[~np.isin(cuts, offsets)]
    # two sorted runs each, which a stable sort merges
    return tuple(np.sort(np.concatenate([part, cuts]), kind="stable") for part in (starts, ends))


def cut_before(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chunks that together are all bytes, cut before every marked byte and between texts."""
    mask[offsets[:-1][offsets[:-1] < len(mask)]] = True
    starts = np.flatnonzero(mask)
    return starts, np.append(starts[1:], len(mask))[: len(starts)]


def gathered(codes: np.ndarray, packed: list[bytes], first: np.ndarray) -> list[bytes]:
    """The values of the chunks joined by text; a value is a row of little-endian unsigned 32-bit integers."""
    flat = np.frombuffer(b"".join(packed), "<u4")
    sizes = np.fromiter(map(len, packed), np.int64, len(packed)) >> 2
    begins = np.cumsum(sizes) - sizes
    each = sizes[codes]
    stops = np.cumsum(each)
    index = np.repeat(begins[codes] - (stops - each), each)
    index += np.arange(len(index))
    data = flat[index].tobytes()
    bounds = (4 * np.concatenate([[0], stops])[first]).tolist()
    return [data[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]


class Memo(dict):
    """A memo of two generations of at most `entries` values each, for keys of up to `longest` bytes."""

    def __init__(self, compute: Callable, entries: int = 200_000, longest: int = 48):
        super().__init__()
        self.compute, self.entries, self.longest = compute, entries, longest
        self.older: dict = {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= self.longest:
            self.make_room(1)
            self[key] = value
        return value

    def make_room(self, more: int) -> None:
        if len(self) + more > self.entries:
            self.older = dict(self)
            self.clear()
