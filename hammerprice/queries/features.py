"""Column functions over whole tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from hammerprice.functions.bands import band
from hammerprice.functions.dates import age_in_years, days_since, days_until, previous_month
from hammerprice.functions.parsing import to_bigint, to_bigint_strict, to_double, to_double_strict, to_month
from hammerprice.functions.text import collapse_variants, last_two, title_case, upper_bound_of_range
from hammerprice.operators.features import featurise
from hammerprice.queries.frame import ANCHOR, FEATURES_SQL, TIES, WORD, rounded, table, title_sql, transactions
from hammerprice.queries.registry import query
from hammerprice.schemas import PROCESSED_COLUMNS


@query(
    """
WITH t AS (
  SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month,
         CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE CAST(o_totalprice AS VARCHAR) END AS price,
         ' ' || CAST(o_custkey AS VARCHAR) || 'e1 ' AS customer
  FROM orders
)
SELECT o_orderkey, CAST(strptime(month || '-01', '%Y-%m-%d') AS DATE) AS month,
       TRY_CAST(price AS DOUBLE) AS price, CAST(TRY_CAST(trim(customer) AS DOUBLE) AS BIGINT) AS customer
FROM t
"""
)
def typed_cast(spark, sf_dir):
    """Lenient casts: texts that are no numbers become NULL, scientific notation counts."""
    orders = table(spark, sf_dir, "orders")
    price = F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).otherwise(
        F.col("o_totalprice").cast("string")
    )
    return orders.select(
        "o_orderkey",
        to_month(F.date_format("o_orderdate", "yyyy-MM")).alias("month"),
        to_double(price).alias("price"),
        to_bigint(F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit("e1 "))).alias("customer"),
    )


@query("SELECT o_orderkey, o_totalprice AS price, o_custkey AS customer FROM orders")
def strict_cast(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        "o_orderkey",
        to_double_strict(F.col("o_totalprice").cast("string")).alias("price"),
        to_bigint_strict(F.col("o_custkey").cast("string")).alias("customer"),
    )


@query(
    """
SELECT o_orderkey, year(o_orderdate) - (1960 + o_custkey % 50) AS age,
       date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS days,
       CAST(CAST(o_orderdate AS DATE) - INTERVAL 1 MONTH AS DATE) AS month_before,
       date_diff('day', DATE '1995-01-01', DATE '2020-02-29') AS days_today
FROM orders
"""
)
def time_features(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        age_in_years(day, F.lit(1960) + F.col("o_custkey") % 50).alias("age"),
        days_since(day, ANCHOR).alias("days"),
        previous_month(day).alias("month_before"),
        days_until(dt.date(2020, 2, 29), ANCHOR).alias("days_today"),
    )


@query(
    """
SELECT p_partkey, CASE WHEN contains(p_type, 'ECON') THEN 'ECON' ELSE p_type END AS model,
       right(p_name, 2) AS tail, CASE WHEN contains(p_name, 'red') THEN 'red' ELSE p_name END AS name
FROM part
"""
)
def collapsed_variants(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        collapse_variants(F.col("p_type"), WORD).alias("model"),
        last_two(F.col("p_name")).alias("tail"),
        collapse_variants(F.col("p_name"), "red").alias("name"),
    )


@query(
    """
SELECT p_partkey, p_size - 10 AS storey,
       CASE WHEN p_size - 10 <= 0 THEN NULL WHEN p_size - 10 <= 15 THEN '1-15'
            WHEN p_size - 10 <= 30 THEN '16-30' WHEN p_size - 10 <= 99 THEN '31+' END AS closed_band,
       CASE WHEN p_size - 10 <= 15 THEN '1-15' WHEN p_size - 10 BETWEEN 16 AND 30 THEN '16-30'
            ELSE '31+' END AS open_band,
       CAST(lpad(CAST(p_size AS VARCHAR), 2, '0') AS INTEGER) AS upper_bound
FROM part
"""
)
def band_labels(spark, sf_dir):
    """Both band rules, with values below the first edge."""
    storey = F.col("p_size") - 10
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        storey.alias("storey"),
        band(storey).alias("closed_band"),
        band(storey, overflow="last").alias("open_band"),
        upper_bound_of_range(F.concat(F.lit("01 TO "), F.lpad(F.col("p_size").cast("string"), 2, "0"))).alias(
            "upper_bound"
        ),
    )


@query(
    f"""
SELECT o_orderkey, {title_sql("o_orderpriority")} AS priority,
       {title_sql("o_orderpriority || '/' || o_orderstatus || 'x y'")} AS mixed
FROM orders
"""
)
def title_cased(spark, sf_dir):
    mixed = F.concat("o_orderpriority", F.lit("/"), "o_orderstatus", F.lit("x y"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", title_case(F.col("o_orderpriority")).alias("priority"), title_case(mixed).alias("mixed")
    )


@query(
    """
SELECT o_orderkey, round(ln(o_totalprice), 6) AS log_price, round(o_totalprice / 7, 3) AS per_day,
       format('{:,.2f}', o_totalprice) AS shown, round(-o_totalprice * 2 + 1, 2) AS negated
FROM orders
"""
)
def number_functions(spark, sf_dir):
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.round(F.ln(price), 6).alias("log_price"),
        F.round(price / 7, 3).alias("per_day"),
        F.format_number(price, 2).alias("shown"),
        F.round(-price * 2 + 1, 2).alias("negated"),
    )


@query(
    f"""
WITH {FEATURES_SQL}
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, town, flat_type, flat_model_revised, flat_age_years,
       floor_area_sqm, days_from_earliest_data, storey_range_grouped, resale_price
FROM features
"""
)
def feature_frame(spark, sf_dir):
    """The whole transaction table typed and featurised."""
    features = featurise(transactions(spark, sf_dir), anchor=ANCHOR, word=WORD)
    return features.select(*TIES, *PROCESSED_COLUMNS)
