"""One-hot slots from a dictionary that is a table, for text columns of any number of values.

The stages of `preparation` hold all labels of a column in the driver and in the model. Here the distinct labels are ranked
by a range sort, whose only shared state is a count per partition, and rows find their slots by joins, which Spark turns into
broadcasts where the dictionary is small and splits at a hot label where it is not.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hammerprice.operators.row_order import order_rows
from hammerprice.session import materialize


@dataclass(frozen=True)
class SlotDictionary:
    """(which, label, slot): slots count on from column to column, labels of one column in order."""

    columns: tuple[str, ...]
    table: DataFrame
    size: int

    def save(self, path: str) -> None:
        named = F.element_at(F.array(*[F.lit(c) for c in self.columns]), F.col("which") + 1).alias("column")
        self.table.select("which", named, "label", "slot").write.mode("errorifexists").parquet(path)

    def encode(self, df: DataFrame, output: str = "slots", keep: Sequence[str] | None = None) -> DataFrame:
        """`df` with the slots of its row as an ascending array; NULL and labels of no slot have none."""
        kept = list(keep or df.columns)
        if output in kept:
            raise ValueError(f"there is a column {output!r} already")
        row = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row")
        rows = df.select(row, *[F.col(f"`{c}`").alias(f"label_{i}") for i, c in enumerate(self.columns)])
        for i in range(len(self.columns)):
            labels = self.table.where(F.col("which") == i).select(F.col("label").alias(f"label_{i}"), F.col("slot").alias(f"slot_{i}"))
            rows = rows.join(labels, f"label_{i}", "left")
        slots = F.array_compact(F.array(*[f"slot_{i}" for i in range(len(self.columns))]))
        return rows.select(*[F.col("row").getField(c).alias(c) for c in kept], slots.alias(output))


def slot_dictionary(df: DataFrame, columns: Sequence[str]) -> SlotDictionary:
    """The dictionary of the text values of `columns` in `df`; NULL gets no slot."""
    cells = [F.struct(F.lit(i).alias("which"), F.col(f"`{c}`").alias("label")) for i, c in enumerate(columns)]
    labels = df.select(F.inline(F.array(*cells))).where(F.col("label").isNotNull()).distinct()
    ordered = order_rows(labels, ["which", "label"])
    table = materialize(ordered.indexed("slot").select("which", "label", "slot"), "slots")
    return SlotDictionary(tuple(columns), table, ordered.rows)


def read_dictionary(spark: SparkSession, path: str) -> SlotDictionary:
    stored = spark.read.parquet(path)
    names = stored.groupBy("which").agg(F.min("column").alias("column")).orderBy("which").collect()  # one row per column
    return SlotDictionary(tuple(row["column"] for row in names), stored.select("which", "label", "slot"), stored.count())
