"""Time splits."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RELATIVE_SPLITS = ["train", "test", "retrain_test"]


def latest_month(df: DataFrame, month: str = "month") -> dt.date:
    return df.agg(F.max(month)).first()[0]


def month_before(latest: dt.date) -> dt.date:
    """One calendar month earlier, clamped to the month's last day."""
    first = latest.replace(day=1)
    end_of_previous = first - dt.timedelta(days=1)
    return end_of_previous.replace(day=min(latest.day, end_of_previous.day))


def relative_month_rules(latest: dt.date, month: str = "month") -> dict[str, Column]:
    """Predicates on literals, so they reach the scan."""
    previous = F.lit(month_before(latest))
    return {
        "train": F.col(month) < previous,
        "test": F.col(month) == previous,
        "retrain_test": F.col(month) == F.lit(latest),
    }


def relative_month_split(df: DataFrame, month: str = "month", latest: dt.date | None = None) -> dict[str, DataFrame]:
    """Train on everything before the last month but one, test on that month, re-test on the last."""
    latest = latest or latest_month(df, month)
    return {name: df.where(rule) for name, rule in relative_month_rules(latest, month).items()}


def year_rules(month: str = "month", first: int = 2012, last: int = 2023, test: int = 2024) -> dict[str, Column]:
    """Whole years as date ranges rather than ``year(month)``, so that they can prune files."""
    day = F.col(month)
    start = lambda year: F.lit(dt.date(year, 1, 1))
    return {
        "train": (day >= start(first)) & (day < start(last + 1)),
        "test": (day >= start(test)) & (day < start(test + 1)),
        "deploy": day >= start(test + 1),
    }


def label_splits(df: DataFrame, rules: Mapping[str, Column], name: str = "split") -> DataFrame:
    """Tag each row with the first rule it meets; rows that meet none are in no split and leave."""
    tag = F.lit(None).cast("string")
    for label, rule in reversed(list(rules.items())):
        tag = F.when(rule, F.lit(label)).otherwise(tag)
    in_any = reduce(Column.__or__, rules.values())  # plain comparisons, unlike a test of the tag, reach the scan
    return df.where(in_any).withColumn(name, tag)


def from_month(df: DataFrame, start: dt.date, month: str = "month") -> DataFrame:
    return df.where(F.col(month) >= F.lit(start))
