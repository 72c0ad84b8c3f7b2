"""The benchmark tables in the shape of a transaction table, in Spark and in SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


ANCHOR = dt.date(1995, 1, 1)
WORD = "ECON"
TIES = ["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"]  # unique together


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item with the raw text columns, plus the unique tie-breakers."""
    # What belongs to an order is put together first: the lines, which are far more, then move once per key at most.
    orders = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    joined = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    )
    two_digits = lambda n: F.lpad(n.cast("string"), 2, "0")
    return joined.select(
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
        F.col("n_name").alias("town"),
        F.col("o_orderpriority").alias("flat_type"),
        F.col("l_linenumber").cast("string").alias("block"),
        F.col("c_mktsegment").alias("street_name"),
        F.concat(
            two_digits(F.greatest(F.col("p_size") - 4, F.lit(1))), F.lit(" TO "), two_digits(F.col("p_size"))
        ).alias("storey_range"),
        F.col("l_quantity").cast("string").alias("floor_area_sqm"),
        F.col("p_type").alias("flat_model"),
        (F.col("p_size") + 1960).cast("string").alias("lease_commence_date"),
        F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")).alias("remaining_lease"),
        F.col("l_extendedprice").cast("string").alias("resale_price"),
        *TIES,
    )


TRANSACTIONS_SQL = """
tx AS (
  SELECT strftime(o_orderdate, '%Y-%m') AS month, n_name AS town, o_orderpriority AS flat_type,
         CAST(l_linenumber AS VARCHAR) AS block, c_mktsegment AS street_name,
         lpad(CAST(greatest(p_size - 4, 1) AS VARCHAR), 2, '0') || ' TO '
           || lpad(CAST(p_size AS VARCHAR), 2, '0') AS storey_range,
         CAST(l_quantity AS VARCHAR) AS floor_area_sqm, p_type AS flat_model,
         CAST(p_size + 1960 AS VARCHAR) AS lease_commence_date,
         CASE WHEN l_returnflag <> 'R' THEN l_returnflag END AS remaining_lease,
         CAST(l_extendedprice AS VARCHAR) AS resale_price,
         l_orderkey, l_linenumber, l_partkey, l_shipdate
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
       JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""


def title_sql(text: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all(lower({text}), '[\\p{{L}}]+|[^\\p{{L}}]+'), "
        "lambda w: upper(w[1]) || w[2:]), '')"
    )


FEATURES_SQL = (
    TRANSACTIONS_SQL
    + f""",
features AS (
  SELECT CAST(strptime(month || '-01', '%Y-%m-%d') AS DATE) AS month,
         {title_sql('town')} AS town, {title_sql('flat_type')} AS flat_type,
         {title_sql("CASE WHEN contains(flat_model, 'ECON') THEN 'ECON' ELSE flat_model END")} AS flat_model_revised,
         CAST(left(month, 4) AS BIGINT) - CAST(lease_commence_date AS BIGINT) AS flat_age_years,
         CAST(floor_area_sqm AS DOUBLE) AS floor_area_sqm,
         date_diff('day', DATE '1995-01-01', CAST(strptime(month || '-01', '%Y-%m-%d') AS DATE))
           AS days_from_earliest_data,
         CAST(right(storey_range, 2) AS INTEGER) AS storey_max,
         CASE WHEN CAST(right(storey_range, 2) AS INTEGER) <= 0 THEN NULL
              WHEN CAST(right(storey_range, 2) AS INTEGER) <= 15 THEN '1-15'
              WHEN CAST(right(storey_range, 2) AS INTEGER) <= 30 THEN '16-30'
              WHEN CAST(right(storey_range, 2) AS INTEGER) <= 99 THEN '31+' END AS storey_range_grouped,
         CAST(resale_price AS DOUBLE) AS resale_price,
         remaining_lease, l_orderkey, l_linenumber, l_partkey, l_shipdate
  FROM tx
)"""
)

LATEST_SQL = (
    FEATURES_SQL
    + """,
latest AS (SELECT max(month) AS m, CAST(max(month) - INTERVAL 1 MONTH AS DATE) AS before FROM features),
processed AS (
  SELECT features.*, CASE WHEN month < before THEN 'train' WHEN month = before THEN 'test'
                          WHEN month = m THEN 'retrain_test' END AS split
  FROM features, latest
)"""
)
