"""Drift checks between the older and the newer part of a table."""

from __future__ import annotations

from pyspark.sql import functions as F

from hammerprice.operators.contracts import domain_table, values_outside_domain
from hammerprice.operators.drift import (
    category_checks as check_categories,
    check_table,
    exact_quantiles,
    percent_grid,
    population_stability,
    quantile_shares,
    quantile_table,
    retraining_verdict,
    unseen_categories as find_unseen,
)
from hammerprice.queries.frame import rounded, table
from hammerprice.queries.registry import query

_COLUMNS = ["l_quantity", "l_extendedprice"]
_CUT = "2000-01-01"


def _sides(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    cut = F.lit(_CUT).cast("timestamp_ntz")
    return lines.where(F.col("l_shipdate") < cut), lines.where(F.col("l_shipdate") >= cut)


_GRID = "[0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]"
_SHARES_SQL = f"""
WITH e AS (SELECT quantile_cont(l_quantity, {_GRID}) AS q, quantile_cont(l_extendedprice, {_GRID}) AS p
           FROM lineitem WHERE l_shipdate < TIMESTAMP '{_CUT}'),
bins AS (
  SELECT 'l_quantity' AS "column", i AS bin, q[i + 1] AS lower, q[i + 2] AS upper FROM e, range(10) r(i)
  UNION ALL SELECT 'l_extendedprice', i, p[i + 1], p[i + 2] FROM e, range(10) r(i)
),
vals AS (
  SELECT 'l_quantity' AS "column", l_quantity AS v, l_shipdate < TIMESTAMP '{_CUT}' AS old FROM lineitem
  UNION ALL SELECT 'l_extendedprice', l_extendedprice, l_shipdate < TIMESTAMP '{_CUT}' FROM lineitem
),
n AS (SELECT count(*) FILTER (WHERE l_shipdate < TIMESTAMP '{_CUT}') AS old_rows,
             count(*) FILTER (WHERE l_shipdate >= TIMESTAMP '{_CUT}') AS new_rows FROM lineitem),
shares AS (
  SELECT b."column", b.bin, b.lower, b.upper,
         count(*) FILTER (WHERE v.old) AS expected_count, count(*) FILTER (WHERE NOT v.old) AS actual_count,
         count(*) FILTER (WHERE v.old) / any_value(old_rows) AS expected_share,
         count(*) FILTER (WHERE NOT v.old) / any_value(new_rows) AS actual_share
  FROM bins b CROSS JOIN n
       LEFT JOIN vals v ON v."column" = b."column" AND v.v >= b.lower
                       AND (v.v < b.upper OR (b.bin = 9 AND v.v = b.upper))
  GROUP BY ALL
)
"""


@query(
    f"""
WITH e AS (SELECT quantile_cont(l_quantity, {_GRID}) AS q, quantile_cont(l_extendedprice, {_GRID}) AS p
           FROM lineitem WHERE l_shipdate < TIMESTAMP '{_CUT}')
SELECT 'l_quantity' AS "column", CAST(i AS INTEGER) AS edge, round(q[i + 1], 6) AS value FROM e, range(11) r(i)
UNION ALL SELECT 'l_extendedprice', CAST(i AS INTEGER), round(p[i + 1], 6) FROM e, range(11) r(i)
"""
)
def psi_edges(spark, sf_dir):
    """Exact quantile edges, one column of few values and one of many."""
    expected, _ = _sides(spark, sf_dir)
    return rounded(quantile_table(expected, _COLUMNS), 6, "value")


@query(
    f"""
WITH e AS (SELECT quantile_cont(l_extendedprice, [0.01, 0.25, 0.5, 0.99]) AS p FROM lineitem)
SELECT CAST(i AS INTEGER) AS edge, round(p[i + 1], 6) AS value FROM e, range(4) r(i)
"""
)
def quantiles_by_rank_search(spark, sf_dir):
    """Quantiles at uneven probabilities; the wanted ranks are located by range."""
    grid = [0.01, 0.25, 0.5, 0.99]
    found = exact_quantiles(table(spark, sf_dir, "lineitem"), ["l_extendedprice"], grid)
    values = spark.createDataFrame(list(enumerate(found["l_extendedprice"])), "edge int, value double")
    return rounded(values, 6, "value")


@query(
    _SHARES_SQL
    + """
SELECT "column", CAST(bin AS INTEGER) AS bin, round(lower, 6) AS lower, round(upper, 6) AS upper, expected_count,
       actual_count, round(expected_share, 9) AS expected_share, round(actual_share, 9) AS actual_share FROM shares
"""
)
def histogram(spark, sf_dir):
    expected, actual = _sides(spark, sf_dir)
    shares = quantile_shares(expected, actual, _COLUMNS, percent_grid(10))
    return rounded(rounded(shares, 6, "lower", "upper"), 9, "expected_share", "actual_share")


_PSI_SQL = """
psi AS (
  SELECT "column", sum((expected_share - actual_share) * ln(expected_share / actual_share)) AS psi,
         count(*) FILTER (WHERE expected_count = 0 AND actual_count = 0) AS degenerate_bins
  FROM shares GROUP BY 1
)
"""


@query(
    f"""{_SHARES_SQL}, {_PSI_SQL}
SELECT "column", round(psi, 9) AS psi, degenerate_bins, psi > 0.2 AS failed FROM psi
"""
)
def psi(spark, sf_dir):
    expected, actual = _sides(spark, sf_dir)
    return rounded(population_stability(expected, actual, _COLUMNS), 9, "psi")


_CATEGORY_SQL = """
o AS (
  SELECT o_orderpriority AS priority, CAST(o_custkey AS VARCHAR) AS customer,
         nullif(o_orderstatus, 'P') AS status, o_orderdate >= TIMESTAMP '2001-01-01' AS recent FROM orders
),
v AS (
  SELECT 'priority' AS "column", priority AS value, recent FROM o
  UNION ALL SELECT 'customer', customer, recent FROM o UNION ALL SELECT 'status', status, recent FROM o
),
unseen AS (
  SELECT "column", value FROM v WHERE recent EXCEPT SELECT "column", value FROM v WHERE NOT recent
)
"""


def _categories(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("priority"),
        F.col("o_custkey").cast("string").alias("customer"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"),
        (F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz")).alias("recent"),
    )
    return orders.where(~F.col("recent")).drop("recent"), orders.where("recent").drop("recent")


@query(f"WITH {_CATEGORY_SQL} SELECT \"column\", value FROM unseen")
def unseen_categories(spark, sf_dir):
    return find_unseen(*_categories(spark, sf_dir))


@query(
    f"""
WITH {_CATEGORY_SQL}
SELECT c."column", coalesce(list(u.value ORDER BY u.value) FILTER (u.value IS NOT NULL), [])
                   || CASE WHEN count(u."column") > count(u.value) THEN ['NULL'] ELSE [] END AS unseen,
       count(u."column") > 0 AS failed
FROM (SELECT DISTINCT "column" FROM v) c LEFT JOIN unseen u ON u."column" = c."column" GROUP BY 1
"""
)
def category_checks(spark, sf_dir):
    return check_categories(*_categories(spark, sf_dir))


@query(
    f"""
{_SHARES_SQL}, {_PSI_SQL}, {_CATEGORY_SQL},
checks AS (
  SELECT psi > 0.2 AS failed FROM psi
  UNION ALL
  SELECT count(u."column") > 0 FROM (SELECT DISTINCT "column" FROM v) c LEFT JOIN unseen u ON u."column" = c."column"
  GROUP BY c."column"
)
SELECT count(*) AS checks, count(*) FILTER (WHERE failed) AS failed_checks,
       count(*) FILTER (WHERE failed) > 0 AS retrain FROM checks
"""
)
def retraining_gate(spark, sf_dir):
    """Any failed check calls for retraining."""
    expected, actual = _sides(spark, sf_dir)
    checks = check_table(
        check_categories(*_categories(spark, sf_dir)), population_stability(expected, actual, _COLUMNS)
    )
    return retraining_verdict(checks)


@query(
    """
WITH v AS (SELECT 'priority' AS feature, o_orderpriority AS value FROM orders
           UNION ALL SELECT 'status', o_orderstatus FROM orders)
SELECT feature, value, count(*) AS rows FROM v
WHERE (feature, value) NOT IN (('priority', '1-URGENT'), ('priority', '2-HIGH'), ('priority', '3-MEDIUM'),
                               ('status', 'F'), ('status', 'O'))
GROUP BY 1, 2
"""
)
def allowed_values(spark, sf_dir):
    """Values outside a configured domain, with their row counts."""
    domains = domain_table(spark, {"priority": ["1-URGENT", "2-HIGH", "3-MEDIUM"], "status": ["F", "O"]})
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status")
    )
    return values_outside_domain(orders, domains, ["priority", "status"])
