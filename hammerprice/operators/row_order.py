"""Row positions, expanding folds and repeatable shuffles."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hammerprice.session import materialize

_POSITION_BITS = 33  # monotonically_increasing_id: partition number above, position below


@dataclass(frozen=True)
class OrderedRows:
    """Rows in a total order, stored so that a row position is a literal bound on a column.

    `frame` carries ``_id``: the number of the sorted partition and the position in it, which grow with
    the row position. `offsets` has the first row position of each partition.
    """

    frame: DataFrame
    offsets: list[tuple[int, int]]
    rows: int

    def indexed(self, index: str = "row_index") -> DataFrame:
        """The rows with their dense 0-based position."""
        table = self.frame.sparkSession.createDataFrame(self.offsets, "_part bigint, _offset bigint")
        position = F.col("_id").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
        # One offset per shuffle partition: always small enough to broadcast.
        return (
            self.frame.withColumn("_part", F.shiftright("_id", _POSITION_BITS))
            .join(F.broadcast(table), "_part")
            .withColumn(index, F.col("_offset") + position)
            .drop("_part", "_offset", "_id")
        )

    def between(self, start: int, stop: int) -> DataFrame:
        """Rows at positions ``start <= position < stop``; the bounds reach the Parquet scan."""
        inside = (F.col("_id") >= self.id_at(start)) & (F.col("_id") < self.id_at(stop))
        return self.frame.where(inside).drop("_id")

    def all(self) -> DataFrame:
        return self.frame.drop("_id")

    def id_at(self, row: int) -> int:
        """The `_id` of a row position: rows before it have smaller ones, the others not."""
        part, offset = [o for o in self.offsets if o[1] <= row][-1]
        return (part << _POSITION_BITS) + row - offset


def order_rows(df: DataFrame, order: list[str], unique: bool = True) -> OrderedRows:
    """Put the rows into the total order of `order`.

    They are range-partitioned on the whole key, so one hot month (or any other leading value) spreads
    over many tasks, and each partition numbers its own rows; the only shared state is one row count per
    partition. The sorted rows are written to the shared scratch folder: all uses of them must see the
    same partitions.

    Where `order` is not `unique`, a random last key keeps many equal rows from meeting in one task. It is
    stored before the sort, because a key drawn anew in a repeated task could lose or double rows.
    """
    keys = [F.col(c) for c in order]
    columns = df.columns
    if not unique:
        df = materialize(df.withColumn("_tie", F.rand(0)), "ties")
        keys.append(F.col("_tie"))
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    saved = materialize(ranged.select(*columns, F.monotonically_increasing_id().alias("_id")), "row-order")
    sizes = saved.groupBy(F.shiftright("_id", _POSITION_BITS).alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    offsets, rows = [], 0
    for part, n in sorted((row["part"], row["n"]) for row in sizes):
        offsets.append((part, rows))
        rows += n
    return OrderedRows(saved, offsets, rows)


def with_row_index(df: DataFrame, order: list[str], index: str = "row_index") -> DataFrame:
    """Dense 0-based position of each row in the total order of `order`, which must be unique."""
    return order_rows(df, order).indexed(index)


def fold_size(rows: int, folds: int) -> int:
    size = rows // (folds + 1)
    if size == 0:
        raise ValueError(f"{rows} rows are too few for {folds} folds")
    return size


def fold_start(rows: int, folds: int, fold: int) -> int:
    """First row that fold `fold` validates on; it trains on every earlier row."""
    return rows - (folds - fold) * fold_size(rows, folds)


def fold_of(index: Column, rows: int, folds: int) -> Column:
    """Fold that validates on a row; -1 for the rows that are only ever trained on."""
    first = fold_start(rows, folds, 0)
    size = fold_size(rows, folds)
    return F.when(index < first, F.lit(-1)).otherwise(F.floor((index - first) / size)).cast("int")


# ---- permutations that are computed ----

_ROUNDS = 4
#: Steps after which a walk is surely back inside: a walk outside is at most as long as there are places outside.
_WALK = 64


def _round_value(seed: int, repeat: Column, number: int, value: Column) -> Column:
    """A repeatable pseudo-random BIGINT of its arguments."""
    text = F.concat_ws("|", F.lit(str(seed)), repeat.cast("string"), F.lit(str(number)), value.cast("string"))
    return F.conv(F.left(F.md5(text), F.lit(15)), 16, 10).cast("bigint")


def _mixed(position: Column, width: int, height: int, seed: int, repeat: Column) -> Column:
    """A Feistel network: a bijection of the places of a grid of `width` x `height`."""
    left, right = position % width, F.floor(position / width).cast("bigint")
    for number in range(1, _ROUNDS + 1):
        size = width if number % 2 else height
        left, right = right, (left + _round_value(seed, repeat, number, right)) % size
    return right * width + left


def permuted(position: Column, rows: int, seed: int, repeat: Column) -> Column:
    """Where a row position goes in permutation number `repeat` of the positions below `rows`: a computed bijection.

    The positions are the first places of a grid with less than a row of places more. What lands on one of these goes on
    from there until it lands on a position, which keeps the map one to one.
    """
    width = max(1, math.isqrt(max(rows, 1) - 1) + 1)
    height = -(-max(rows, 1) // width)
    first = _mixed(position, width, height, seed, repeat)
    if width * height == rows:
        return first
    steps = F.sequence(F.lit(1), F.lit(min(_WALK, width)))
    on = lambda at, _: F.when(at < rows, at).otherwise(_mixed(at, width, height, seed, repeat))
    walked = F.when(first < rows, first).otherwise(F.aggregate(steps, first, on))
    lost = F.raise_error(F.lit("a position did not return to the table")).cast("bigint")
    return F.when(walked < rows, walked).otherwise(lost)


def permutation_sql(rows: str, repeats: int, seed: int, name: str = "donors") -> str:
    """The recursive CTE `name` (repeat, i, row_index) that `permuted` computes, over the CTE `rows` with a dense `i`."""
    value = lambda number, of: f"CAST('0x' || left(md5('{seed}|' || repeat || '|{number}|' || {of}), 15) AS BIGINT)"
    return f"""
{name}_grid AS (SELECT n, w, CAST((n + w - 1) // w AS BIGINT) AS h FROM
  (SELECT count(*) AS n, CAST(ceil(sqrt(count(*))) AS BIGINT) AS w FROM {rows})),
{name}_walk AS (
  SELECT repeat, i, CAST(i AS BIGINT) AS x, 0 AS step FROM {rows}, range({repeats}) q(repeat)
  UNION ALL
  SELECT repeat, i, ((r2 + {value(4, 'r3')}) % h) * w + r3, step + 1 FROM
    (SELECT *, (r1 + {value(3, 'r2')}) % w AS r3 FROM
      (SELECT *, (r0 + {value(2, 'r1')}) % h AS r2 FROM
        (SELECT *, (x % w + {value(1, 'x // w')}) % w AS r1, x // w AS r0 FROM {name}_walk, {name}_grid WHERE step = 0 OR x >= n)))
),
{name} AS (SELECT repeat, i, x AS row_index FROM {name}_walk, {name}_grid WHERE step > 0 AND x < n)"""


def shuffled_donors(ordered: OrderedRows, columns: list[str], repeats: int, seed: int) -> DataFrame:
    """(repeat, row_index, columns...): per repeat, the rows' values dealt out in a random order.

    Each repeat is a permutation, so a column keeps its multiset of values. Where a row's values go is computed from its
    position: nothing is sorted or shuffled.
    """
    copies = ordered.indexed("_from").select(
        "_from", *columns, F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("repeat")
    )
    return copies.select("repeat", permuted(F.col("_from"), ordered.rows, seed, F.col("repeat")).alias("row_index"), *columns)
