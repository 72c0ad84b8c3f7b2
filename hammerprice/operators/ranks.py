"""Exact order statistics by radix selection.

A double is mapped to a whole number of 64 bits that keeps the order. Rows are counted by the first bits of it; the counts say in
which slots the wanted ranks lie, and only the rows of these slots are counted again by more bits, until every wanted slot
holds a single value. A round is one narrow scan, combined map-side: what is shuffled and what reaches the driver depends on
the number of slots, not on the rows or on how many distinct values there are. No value is written anywhere.
"""

from __future__ import annotations

import math
import struct
from bisect import bisect_right
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits that a round leaves uncounted: sign, exponent and 8 bits of the fraction first, then 14 bits a round.
SHIFTS = (44, 30, 16, 2, 0)

_LEAST_NORMAL = 2.0**-1022
_BITS = 52


def order_key(number: Column) -> Column:
    """A BIGINT that orders doubles as they are ordered, both zeros alike. NULL for NULL; there must be no NaN."""
    size = F.abs(number)
    guess = F.floor(F.log2(size))  # may miss by one near a power of two
    below, above = F.pow(F.lit(2.0), guess) > size, F.pow(F.lit(2.0), guess + 1) <= size
    exponent = guess - F.when(below, 1).otherwise(0) + F.when(above, 1).otherwise(0)
    fraction = (size / F.pow(F.lit(2.0), exponent) - 1) * 2.0**_BITS  # exact: only the exponent changes
    normal = (exponent + 1023).cast("long") * (1 << _BITS) + fraction.cast("long")
    small = (size * 2.0**537 * 2.0**537).cast("long")
    key = F.when(size == math.inf, F.lit(2047 << _BITS)).when(size >= _LEAST_NORMAL, normal).otherwise(small)
    return F.when(number < 0, -key).otherwise(key)


def key_value(key: int) -> float:
    """The double of an `order_key`."""
    value = struct.unpack("<d", struct.pack("<Q", abs(key)))[0]
    return -value if key < 0 else value


@dataclass(frozen=True)
class Place:
    """A value with the number of rows below it and up to it."""

    value: float
    below: int
    upto: int


@dataclass(frozen=True)
class Ranked:
    """The order statistics that some quantiles lie between, by column."""

    table_rows: int
    rows: Mapping[str, int]  # with a number
    places: Mapping[tuple[str, int], Place]

    def quantiles(self, column: str, probabilities: Sequence[float]) -> list[float]:
        """Linearly interpolated."""
        return [self._quantile(column, p)[0] for p in probabilities]

    def bin_counts(self, column: str, probabilities: Sequence[float]) -> list[int]:
        """Rows in the bins between the quantiles: closed below, open above, the last one closed."""
        below = [self._quantile(column, p)[1] for p in probabilities]
        top = self.places[column, ranks_around(self.rows[column], probabilities[-1])[1]]
        value = self._quantile(column, probabilities[-1])[0]
        below[-1] = top.upto if value == top.value else below[-1]
        return [b - a for a, b in zip(below, below[1:])]

    def _quantile(self, column: str, probability: float) -> tuple[float, int]:
        """A quantile, and the rows below it: no value lies between two neighbouring ranks."""
        low, high, share = ranks_around(self.rows[column], probability)
        low, high = self.places[column, low], self.places[column, high]
        value = interpolated(low.value, high.value, share)
        return value, low.below if value == low.value else high.below


def ranks_around(rows: int, probability: float) -> tuple[int, int, float]:
    """The two neighbouring ranks a quantile lies between, and its share of the way."""
    position = (rows - 1) * probability
    return math.floor(position), math.ceil(position), position - math.floor(position)


def interpolated(low: float, high: float, share: float) -> float:
    """Linear interpolation from the nearer end, so that both ends are met exactly."""
    if low == high:
        return low
    return low + (high - low) * share if share < 0.5 else high - (high - low) * (1 - share)


def ranked(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> Ranked:
    """The order statistics for `probabilities` of all columns, searched together; NULL and NaN are left out."""
    number = lambda c: F.nullif(F.col(c).cast("double"), F.lit(math.nan))
    keys = df.select(*[order_key(number(c)).alias(f"k{i}") for i, c in enumerate(columns)])
    cells = [F.struct(F.lit(i).alias("which"), F.col(f"k{i}").alias("key")) for i in range(len(columns))]
    missing, rows, places = 0, {}, {}
    open_slots: dict[tuple[int, int], list[tuple[int, int]]] = {}  # (column, slot) to (rank, rows before the slot)
    for depth, shift in enumerate(SHIFTS):
        if depth and not open_slots:
            break
        wanted = keys.select(F.inline(F.array(*cells)))
        if depth:
            slot = F.shiftright("key", SHIFTS[depth - 1])
            inside = [(F.col("which") == i) & slot.isin(*[s for w, s in open_slots if w == i]) for i in {w for w, _ in open_slots}]
            wanted = wanted.where(_any(inside))
            parent = slot.alias("parent")
        else:
            parent = F.lit(0).cast("long").alias("parent")
        counted = wanted.groupBy("which", parent, F.shiftright("key", shift).alias("slot")).agg(
            F.count(F.lit(1)).alias("n"), F.min("key").alias("least"), F.max("key").alias("most")
        )
        slots: dict[tuple[int, int], list[tuple[int, int, int, int]]] = {}
        for which, before, slot, n, least, most in counted.collect():  # a row per slot, whatever the rows
            if slot is None:
                missing = n if which == 0 else missing
            else:
                slots.setdefault((which, before), []).append((slot, n, least, most))
        if not depth:
            for i, c in enumerate(columns):
                rows[c] = sum(n for _, n, _, _ in slots.get((i, 0), []))
            absent = [c for c in columns if not rows[c]]
            if absent:
                raise ValueError(f"no values in {absent}")
            asked = {(i, 0): sorted({(r, 0) for p in probabilities for r in ranks_around(rows[c], p)[:2]}) for i, c in enumerate(columns)}
        else:
            asked = open_slots
        open_slots = {}
        for (which, parent_slot), ranks in asked.items():
            found = sorted(slots[which, parent_slot])
            starts = [0]
            for _, n, _, _ in found:
                starts.append(starts[-1] + n)
            for rank, before in ranks:
                at = bisect_right(starts, rank - before) - 1
                slot, n, least, most = found[at]
                start = before + starts[at]
                if least == most:
                    places[columns[which], rank] = Place(key_value(least), start, start + n)
                else:
                    open_slots.setdefault((which, slot), []).append((rank, start))
    return Ranked(rows[columns[0]] + missing, rows, places)


def _any(conditions: Sequence[Column]) -> Column:
    found = conditions[0]
    for condition in conditions[1:]:
        found = found | condition
    return found
