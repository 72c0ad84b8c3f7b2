"""Summaries and null reports over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hammerprice.functions.parsing import to_double
from hammerprice.operators.features import add_storey_band
from hammerprice.operators.metrics import mean_and_spread
from hammerprice.operators.profiling import (
    band_summary as summarise_bands,
    distinct_lists,
    min_max_count,
    newly_null,
    null_counts,
    shape,
    top_rows,
)
from hammerprice.queries.frame import TRANSACTIONS_SQL, rounded, table, transactions
from hammerprice.queries.registry import query

_STOREY_SQL = f"""
WITH {TRANSACTIONS_SQL},
s AS (SELECT CAST(right(storey_range, 2) AS INTEGER) AS storey_max, CAST(resale_price AS DOUBLE) AS price FROM tx),
g AS (SELECT CASE WHEN storey_max <= 0 THEN NULL WHEN storey_max <= 15 THEN '1-15' WHEN storey_max <= 30 THEN '16-30'
                  WHEN storey_max <= 99 THEN '31+' END AS storey_range_grouped, storey_max, price FROM s)
"""


@query(
    _STOREY_SQL
    + """
SELECT b.storey_range_grouped, min(storey_max) AS min_storey, max(storey_max) AS max_storey,
       count(storey_max) AS counts, round(avg(price), 4) AS average_price
FROM (VALUES ('1-15'), ('16-30'), ('31+')) b(storey_range_grouped) LEFT JOIN g USING (storey_range_grouped)
GROUP BY 1 ORDER BY 1
"""
)
def band_summary(spark, sf_dir):
    """Storeys and price per band over the whole transaction table, bands without rows included."""
    banded = add_storey_band(transactions(spark, sf_dir))
    price = F.round(F.avg(to_double(F.col("resale_price"))), 4).alias("average_price")
    return summarise_bands(banded, extra=[price])


@query(
    """
WITH g AS (SELECT p_size AS storey_max FROM part WHERE p_size <= 12)
SELECT b.storey_range_grouped, min(storey_max) AS min_storey, max(storey_max) AS max_storey, count(storey_max) AS counts
FROM (VALUES ('1-15', 0, 15), ('16-30', 15, 30), ('31+', 30, 99)) b(storey_range_grouped, lo, hi)
     LEFT JOIN g ON storey_max > lo AND storey_max <= hi
GROUP BY 1
"""
)
def band_summary_empty_bands(spark, sf_dir):
    """Small parts only, so two bands stay empty."""
    small = table(spark, sf_dir, "part").where("p_size <= 12")
    banded = add_storey_band(small.select(F.lpad(F.col("p_size").cast("string"), 2, "0").alias("storey_range")))
    return summarise_bands(banded)


@query(
    """
WITH g AS (SELECT CASE WHEN p_size <= 15 THEN '1-15' WHEN p_size <= 30 THEN '16-30' ELSE '31+' END AS band, p_size
           FROM part WHERE p_size <= 12)
SELECT band, min(p_size) AS min_storey, max(p_size) AS max_storey, count(p_size) AS counts
FROM g GROUP BY band ORDER BY band
"""
)
def band_summary_present(spark, sf_dir):
    """The older rule: only bands with rows, sorted as text."""
    small = table(spark, sf_dir, "part").where("p_size <= 12")
    banded = add_storey_band(
        small.select(F.lpad(F.col("p_size").cast("string"), 2, "0").alias("storey_range")), overflow="last"
    ).withColumnRenamed("storey_range_grouped", "band")
    return min_max_count(banded, "band", "storey_max", ("min_storey", "max_storey", "counts"))


@query(
    """
SELECT p_size, array_to_string(list_sort(list(DISTINCT p_type)), ',') AS types,
       array_to_string(list_sort(list(DISTINCT p_brand)), ',') AS brands
FROM part GROUP BY p_size ORDER BY p_size LIMIT 20
"""
)
def group_lists(spark, sf_dir):
    """Distinct values per key as lists, first 20 keys."""
    lists = distinct_lists(table(spark, sf_dir, "part"), "p_size", {"types": "p_type", "brands": "p_brand"}, 20)
    return lists.withColumns({c: F.array_join(c, ",") for c in ("types", "brands")})


@query(
    """
SELECT p_type, min(p_size) AS min_size, max(p_size) AS max_size, count(p_size) AS counts
FROM part GROUP BY p_type ORDER BY max_size, p_type
"""
)
def group_min_max(spark, sf_dir):
    return min_max_count(
        table(spark, sf_dir, "part"), "p_type", "p_size", ("min_size", "max_size", "counts"), order="max_size"
    )


@query(
    f"""
WITH {TRANSACTIONS_SQL},
c AS (SELECT count(*) AS n, count(*) FILTER (WHERE town IS NULL) AS town,
             count(*) FILTER (WHERE remaining_lease IS NULL) AS remaining_lease,
             count(*) FILTER (WHERE resale_price IS NULL) AS resale_price FROM tx)
SELECT n AS rows, 'town' AS "column", town AS nulls FROM c
UNION ALL SELECT n, 'remaining_lease', remaining_lease FROM c
UNION ALL SELECT n, 'resale_price', resale_price FROM c
"""
)
def null_report(spark, sf_dir):
    return null_counts(transactions(spark, sf_dir), ["town", "remaining_lease", "resale_price"])


@query(
    """
WITH s AS (SELECT CASE WHEN year(l_shipdate) <= 1998 THEN 'train' ELSE 'test' END AS split,
                  nullif(l_returnflag, 'R') AS flag, nullif(l_discount, 0) AS discount, l_tax AS tax FROM lineitem)
SELECT split, count(*) AS rows, 'flag' AS "column", count(*) - count(flag) AS nulls FROM s GROUP BY split
UNION ALL SELECT split, count(*), 'discount', count(*) - count(discount) FROM s GROUP BY split
UNION ALL SELECT split, count(*), 'tax', count(*) - count(tax) FROM s GROUP BY split
"""
)
def null_report_by_split(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        F.when(F.year("l_shipdate") <= 1998, "train").otherwise("test").alias("split"),
        F.nullif(F.col("l_returnflag"), F.lit("R")).alias("flag"),
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("discount"),
        F.col("l_tax").alias("tax"),
    )
    return null_counts(lines, by="split")


@query(
    """
WITH r AS (SELECT nullif(l_returnflag, 'A') AS flag,
                  CASE WHEN l_linenumber = 7 THEN 'seven' ELSE CAST(l_linenumber AS VARCHAR) END AS line FROM lineitem),
     t AS (SELECT count(*) - count(flag) AS raw_flag, count(*) - count(TRY_CAST(flag AS DOUBLE)) AS typed_flag,
                  count(*) - count(line) AS raw_line, count(*) - count(TRY_CAST(line AS DOUBLE)) AS typed_line FROM r)
SELECT 'flag' AS "column", raw_flag AS raw_nulls, typed_flag AS typed_nulls, typed_flag - raw_flag AS newly_null FROM t
UNION ALL SELECT 'line', raw_line, typed_line, typed_line - raw_line FROM t
"""
)
def newly_null_report(spark, sf_dir):
    """What a lenient cast loses."""
    raw = table(spark, sf_dir, "lineitem").select(
        F.nullif(F.col("l_returnflag"), F.lit("A")).alias("flag"),
        F.when(F.col("l_linenumber") == 7, "seven").otherwise(F.col("l_linenumber").cast("string")).alias("line"),
    )
    return newly_null(raw, raw.select(*[to_double(F.col(c)).alias(c) for c in raw.columns]), raw.columns)


@query("SELECT count(*) AS rows, 11 AS columns FROM lineitem")
def table_shape(spark, sf_dir):
    return shape(table(spark, sf_dir, "lineitem"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def top_orders(spark, sf_dir):
    """A top-k report."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return top_rows(orders, 20, F.desc("o_totalprice"), "o_orderkey")


@query(
    """
WITH e AS (SELECT event_type, value FROM events)
SELECT event_type, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std FROM e GROUP BY event_type
"""
)
def score_spread(spark, sf_dir):
    """Mean and population deviation per group."""
    return rounded(mean_and_spread(table(spark, sf_dir, "events"), "value", ["event_type"]), 6, "mean", "std")
