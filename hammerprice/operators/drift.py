"""Drift between an expected (training) and an actual (test) table."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hammerprice.operators.columns import text_columns
from hammerprice.operators.ranks import Ranked, ranked
from hammerprice.schemas import DRIFT_COLUMNS

PSI_LIMIT = 0.2


# ---- quantiles ----


def percent_grid(buckets: int) -> list[float]:
    return [i / buckets for i in range(buckets + 1)]


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> dict[str, list[float]]:
    """Exact, linearly interpolated quantiles per column; missing values are left out."""
    found = ranked(df, columns, probabilities)
    return {c: found.quantiles(c, probabilities) for c in columns}


def quantile_table(df: DataFrame, columns: Sequence[str], buckets: int = 10) -> DataFrame:
    """(column, edge, value): the bucket edges the drift measure uses."""
    edges = exact_quantiles(df, columns, percent_grid(buckets))
    rows = [(c, i, float(v)) for c in columns for i, v in enumerate(edges[c])]
    return df.sparkSession.createDataFrame(rows, "column string, edge int, value double")


# ---- histograms and the population stability index ----


def histogram_shares(
    expected: DataFrame, actual: DataFrame, edges: Mapping[str, Sequence[float]],
    known: Ranked | None = None, probabilities: Sequence[float] = (),
) -> DataFrame:
    """(column, bin, lower, upper, expected_count, actual_count, expected_share, actual_share).

    One aggregate over each table. Where `edges` are the quantiles of the expected side, the order statistics that they
    were found by hold its counts already: `known`, at `probabilities`, saves its scan. Bins are ``[lower, upper)``, the
    last one closed. Values outside every bin, and missing ones, are in no count but in the denominator of the shares.
    """
    bins = [
        (c, i, float(lo), float(hi), i == len(edges[c]) - 2)
        for c in edges
        for i, (lo, hi) in enumerate(zip(edges[c][:-1], edges[c][1:]))
    ]
    inside = lambda value, lo, hi, closed: (value >= lo) & (value <= hi if closed else value < hi)
    counts = [F.count_if(inside(F.col(c).cast("double"), lo, hi, closed)) for c, _, lo, hi, closed in bins]
    if known:
        numbers = [n for c in edges for n in known.bin_counts(c, probabilities)]
        schema = ", ".join(["_expected boolean", "_rows bigint", *[f"b{k} bigint" for k in range(len(bins))]])
        first = actual.sparkSession.createDataFrame([(True, known.table_rows, *numbers)], schema)
    else:
        first = _one_row(expected, True, counts)
    sides = first.unionAll(_one_row(actual, False, counts))
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.lit(i).alias("bin"),
                F.lit(lo).alias("lower"),
                F.lit(hi).alias("upper"),
                F.col(f"b{k}").alias("n"),
            )
            for k, (c, i, lo, hi, _) in enumerate(bins)
        ]
    )
    side = lambda expected, value: F.coalesce(F.sum(F.when(F.col("_expected") == expected, value)), F.lit(0))
    return (
        sides.select("_expected", "_rows", F.inline(rows))
        .groupBy("column", "bin", "lower", "upper")
        .agg(
            side(True, F.col("n")).alias("expected_count"),
            side(False, F.col("n")).alias("actual_count"),
            side(True, F.try_divide("n", "_rows")).alias("expected_share"),
            side(False, F.try_divide("n", "_rows")).alias("actual_share"),
        )
    )


def _one_row(df: DataFrame, expected: bool, counts: list[Column]) -> DataFrame:
    rows = F.count(F.lit(1)).alias("_rows")
    return df.agg(F.lit(expected).alias("_expected"), rows, *[n.alias(f"b{k}") for k, n in enumerate(counts)])


def quantile_shares(
    expected: DataFrame, actual: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> DataFrame:
    """`histogram_shares` over the expected side's quantiles."""
    known = ranked(expected, columns, probabilities)
    edges = {c: known.quantiles(c, probabilities) for c in columns}
    return histogram_shares(expected, actual, edges, known, probabilities)


def psi_from_shares(shares: DataFrame, limit: float = PSI_LIMIT, on_degenerate: str = "report") -> DataFrame:
    """(column, psi, degenerate_bins, failed) from `histogram_shares`.

    A bin empty on one side makes the index infinite, a bin empty on both makes it NaN, and NaN does not
    fail. `degenerate_bins` counts the latter; ``on_degenerate="fail"`` fails such a column and
    ``"merge"`` leaves the empty bins out of the sum.
    """
    if on_degenerate not in ("report", "fail", "merge"):
        raise ValueError(f"unknown rule {on_degenerate!r}")
    e, a = F.col("expected_share"), F.col("actual_share")
    neither = (e == 0) & (a == 0)
    term = (
        F.when(neither, F.lit(0.0 if on_degenerate == "merge" else math.nan))
        .when((e == 0) | (a == 0), F.lit(math.inf))
        .otherwise((e - a) * F.ln(F.try_divide(e, a)))
    )
    failed = ~F.isnan("psi") & (F.col("psi") > limit)
    if on_degenerate == "fail":
        failed = failed | (F.col("degenerate_bins") > 0)
    return (
        shares.groupBy("column")
        .agg(F.sum(term).alias("psi"), F.count_if(neither).alias("degenerate_bins"))
        .withColumn("failed", failed)
    )


def population_stability(
    expected: DataFrame,
    actual: DataFrame,
    columns: Sequence[str] = tuple(DRIFT_COLUMNS),
    buckets: int = 10,
    limit: float = PSI_LIMIT,
    on_degenerate: str = "report",
) -> DataFrame:
    return psi_from_shares(quantile_shares(expected, actual, columns, percent_grid(buckets)), limit, on_degenerate)


# ---- categories ----


def category_presence(train: DataFrame, test: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, value, in_train, in_test) of every text value; one map-side combined pass over both."""
    columns = list(columns or text_columns(train))
    both = train.select(F.lit(True).alias("_expected"), *columns).unionAll(
        test.select(F.lit(False).alias("_expected"), *columns)
    )
    return (
        both.unpivot(["_expected"], columns, "column", "value")
        .groupBy("column", "value")
        .agg(F.bool_or("_expected").alias("in_train"), F.bool_or(~F.col("_expected")).alias("in_test"))
    )


def unseen_categories(train: DataFrame, test: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, value) of the text values that occur in `test` only; NULL counts as a value."""
    presence = category_presence(train, test, columns)
    return presence.where(F.col("in_test") & ~F.col("in_train")).select("column", "value")


def category_checks(train: DataFrame, test: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, unseen, failed), one row per text column; `unseen` lists the values, NULL as "NULL" last.

    A category list is short by nature. `unseen_categories` has the same values as rows, for columns that are not.
    """
    return checks_of_presence(category_presence(train, test, columns))


def checks_of_presence(presence: DataFrame) -> DataFrame:
    """`category_checks` from `category_presence`."""
    new = F.col("in_test") & ~F.col("in_train")
    values = F.sort_array(F.collect_list(F.when(new, F.col("value"))))
    null_too = F.bool_or(new & F.col("value").isNull())
    return (
        presence.groupBy("column")
        .agg(F.when(null_too, F.array_append(values, F.lit("NULL"))).otherwise(values).alias("unseen"))
        .withColumn("failed", F.size("unseen") > 0)
    )


# ---- verdict ----


def check_table(categories: DataFrame, numbers: DataFrame) -> DataFrame:
    """(kind, column, failed) of all checks."""
    return categories.select(F.lit("category").alias("kind"), "column", "failed").unionAll(
        numbers.select(F.lit("numeric").alias("kind"), "column", "failed")
    )


def retraining_verdict(checks: DataFrame) -> DataFrame:
    """(checks, failed_checks, retrain): any failed check calls for retraining."""
    return checks.agg(
        F.count(F.lit(1)).alias("checks"), F.count_if(F.col("failed")).alias("failed_checks")
    ).withColumn("retrain", F.col("failed_checks") > 0)
