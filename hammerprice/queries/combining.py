"""Unions, aligned joins and set comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from hammerprice.operators.combine import (
    align_full,
    distinct_values,
    is_subset,
    union_all,
    values_missing_from,
)
from hammerprice.operators.splits import relative_month_split
from hammerprice.queries.frame import table
from hammerprice.queries.registry import query


@query(
    """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
UNION ALL BY NAME
SELECT s_name AS name, s_suppkey AS id, s_acctbal AS balance FROM supplier
"""
)
def union_missing(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance")
    )
    return union_all([customers, suppliers])


@query(
    """
WITH a AS (SELECT c_nationkey AS nation, CAST(round(c_acctbal / 500) AS INTEGER) AS level, c_custkey FROM customer),
     b AS (SELECT s_nationkey AS nation, CAST(round(s_acctbal / 500) AS INTEGER) AS level, s_suppkey FROM supplier),
     d AS (SELECT n_nationkey AS nation, CAST(n_nationkey AS INTEGER) AS level, n_name FROM nation)
SELECT nation, level, c_custkey, s_suppkey, n_name
FROM a FULL OUTER JOIN b USING (nation, level) FULL OUTER JOIN d USING (nation, level)
"""
)
def align_full_outer(spark, sf_dir):
    """Three frames aligned on the two columns they share."""
    level = lambda c: F.round(F.col(c) / 500).cast("int").alias("level")
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("nation"), level("c_acctbal"), "c_custkey"
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("nation"), level("s_acctbal"), "s_suppkey"
    )
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("nation"), F.col("n_nationkey").alias("level"), "n_name"
    )
    return align_full([customers, suppliers, nations])


@query(
    """
WITH a AS (SELECT o_orderpriority AS priority, nullif(o_orderstatus, 'P') AS status,
                  CAST(o_custkey AS VARCHAR) AS customer FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
     b AS (SELECT o_orderpriority AS priority, nullif(o_orderstatus, 'P') AS status,
                  CAST(o_custkey AS VARCHAR) AS customer FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')
SELECT priority, status, customer FROM a FULL OUTER JOIN b USING (priority, status, customer)
"""
)
def align_identical(spark, sf_dir):
    """Two frames with the same columns: repeated rows multiply, rows with a NULL match nothing."""
    orders = table(spark, sf_dir, "orders")
    frame = lambda rows: rows.select(
        F.col("o_orderpriority").alias("priority"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"),
        F.col("o_custkey").cast("string").alias("customer"),
    )
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    return align_full([frame(orders.where(F.col("o_orderdate") < cut)), frame(orders.where(F.col("o_orderdate") >= cut))])


@query("SELECT DISTINCT p_brand FROM part ORDER BY p_brand")
def distinct_sorted(spark, sf_dir):
    return distinct_values(table(spark, sf_dir, "part"), "p_brand")


@query(
    """
SELECT nullif(c_nationkey, 3) AS nationkey, c_mktsegment AS segment FROM customer
EXCEPT SELECT nullif(s_nationkey, 4), 'BUILDING' FROM supplier
"""
)
def set_difference(spark, sf_dir):
    """Nations and segments of customers that do not sell buildings there; NULL nations stand on both sides."""
    customers, suppliers = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    return values_missing_from(
        customers.select(F.nullif("c_nationkey", F.lit(3)).alias("nationkey"), F.col("c_mktsegment").alias("segment")),
        suppliers.select(F.nullif("s_nationkey", F.lit(4)).alias("nationkey"), F.lit("BUILDING").alias("segment")),
    )


@query(
    """
SELECT NOT EXISTS (SELECT c_nationkey FROM customer EXCEPT SELECT n_nationkey FROM nation) AS customers_known,
       NOT EXISTS (SELECT o_custkey FROM orders EXCEPT SELECT s_suppkey FROM supplier) AS buyers_are_suppliers,
       (SELECT count(*) FROM orders) AS orders
"""
)
def subset_test(spark, sf_dir):
    customers, nations = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    orders, suppliers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "supplier")
    known = is_subset(customers.select("c_nationkey"), nations.select("n_nationkey"))
    same = is_subset(orders.select("o_custkey"), suppliers.select("s_suppkey"))
    return orders.agg(
        F.lit(known).alias("customers_known"), F.lit(same).alias("buyers_are_suppliers"),
        F.count(F.lit(1)).alias("orders"),
    )


@query(
    """
WITH o AS (SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders),
     m AS (SELECT max(month) AS latest FROM o)
SELECT o_orderkey, month FROM o, m WHERE month < latest
"""
)
def union_train_test(spark, sf_dir):
    """Train and test together, without the newest month."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.trunc("o_orderdate", "month").alias("month")
    )
    splits = relative_month_split(orders)
    return union_all([splits["train"], splits["test"]])
