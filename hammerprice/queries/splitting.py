"""Time splits of whole tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from hammerprice.operators.splits import (
    from_month,
    label_splits,
    latest_month,
    relative_month_rules,
    year_rules,
)
from hammerprice.queries.frame import table
from hammerprice.queries.registry import query


def _monthly(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.trunc("o_orderdate", "month").alias("month")
    )


@query(
    """
WITH o AS (SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders),
     l AS (SELECT max(month) AS latest, CAST(max(month) - INTERVAL 1 MONTH AS DATE) AS before FROM o)
SELECT o_orderkey, month, CASE WHEN month < before THEN 'train' WHEN month = before THEN 'test'
                               ELSE 'retrain_test' END AS split
FROM o, l
"""
)
def month_split(spark, sf_dir):
    orders = _monthly(spark, sf_dir).drop("o_totalprice")
    return label_splits(orders, relative_month_rules(latest_month(orders)))


@query(
    """
SELECT o_orderkey, CASE WHEN year(o_orderdate) BETWEEN 1996 AND 1998 THEN 'train'
                        WHEN year(o_orderdate) = 1999 THEN 'test' ELSE 'deploy' END AS split
FROM orders WHERE year(o_orderdate) >= 1996
"""
)
def year_split(spark, sf_dir):
    return label_splits(table(spark, sf_dir, "orders"), year_rules("o_orderdate", 1996, 1998, 1999)).select(
        "o_orderkey", "split"
    )


@query(
    """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS orders, max(o_totalprice) AS highest
FROM orders WHERE o_orderdate >= TIMESTAMP '1998-06-01' GROUP BY 1
"""
)
def from_start_month(spark, sf_dir):
    kept = from_month(_monthly(spark, sf_dir), dt.date(1998, 6, 1))
    return kept.groupBy("month").agg(F.count(F.lit(1)).alias("orders"), F.max("o_totalprice").alias("highest"))
