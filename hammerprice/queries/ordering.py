"""Row positions, folds and shuffles over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hammerprice.operators.row_order import fold_of, order_rows, permutation_sql, shuffled_donors, with_row_index
from hammerprice.queries.frame import table
from hammerprice.queries.registry import query


def _by_month(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", F.trunc("o_orderdate", "month").alias("month"))


_INDEX_SQL = """
i AS (SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
             row_number() OVER (ORDER BY date_trunc('month', o_orderdate), o_orderkey) - 1 AS row_index FROM orders)
"""


@query(f"WITH {_INDEX_SQL} SELECT o_orderkey, month, row_index FROM i")
def row_index(spark, sf_dir):
    """Position of every order in time order."""
    return with_row_index(_by_month(spark, sf_dir), ["month", "o_orderkey"])


@query(
    f"""
WITH {_INDEX_SQL}, n AS (SELECT count(*) AS rows, count(*) // 6 AS size FROM orders)
SELECT o_orderkey, row_index, CAST(CASE WHEN row_index < rows - 5 * size THEN -1
                                        ELSE (row_index - (rows - 5 * size)) // size END AS INTEGER) AS fold
FROM i, n
"""
)
def fold_index(spark, sf_dir):
    """Which of five expanding folds validates on a row."""
    ordered = order_rows(_by_month(spark, sf_dir), ["month", "o_orderkey"])
    return ordered.indexed().drop("month").withColumn("fold", fold_of(F.col("row_index"), ordered.rows, 5))


@query(
    f"""
WITH RECURSIVE r AS (SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS i, p_partkey, p_brand FROM part),
{permutation_sql("r", 10, 42)}
SELECT CAST(repeat AS INTEGER) AS repeat, row_index, p_partkey, p_brand FROM donors JOIN r USING (i)
"""
)
def shuffled_rows(spark, sf_dir):
    """Ten repeatable permutations of a table."""
    parts = order_rows(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), ["p_partkey"])
    return shuffled_donors(parts, ["p_partkey", "p_brand"], repeats=10, seed=42)
