"""Text to typed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark also reads Java float literals ("1d", "2F", "0x1p3") as numbers; plain data files mean text there.
_JAVA_LITERAL = r"[0-9.][dDfF]\s*$|[xX]"


def to_double(text: Column) -> Column:
    """Number, or NULL where the text is none ("NaN" counts as missing)."""
    number = F.nanvl(text.try_cast("double"), F.lit(None).cast("double"))
    return F.when(~text.rlike(_JAVA_LITERAL), number)


def to_bigint(text: Column) -> Column:
    """Whole number, or NULL; accepts "2e3" and drops a fraction."""
    return to_double(text).try_cast("bigint")


def or_stop(value: Column, text: Column, kind: str) -> Column:
    """`value`, or an error where there is a text but no value; whatever the session says about invalid casts."""
    wrong = F.raise_error(F.concat(F.lit(f"not a {kind}: "), text))
    return F.coalesce(value, F.when(text.isNotNull(), wrong))  # `value` is worked out once


def to_double_strict(text: Column) -> Column:
    """Number; a text that is none stops the job."""
    return or_stop(text.try_cast("double"), text, "number")


def to_bigint_strict(text: Column) -> Column:
    return or_stop(text.try_cast("bigint"), text, "whole number")


def to_month(text: Column) -> Column:
    """First day of a "yyyy-MM" month; other texts stop the job, NULL stays NULL."""
    return or_stop(to_month_or_null(text), text, "month")


def to_month_or_null(text: Column) -> Column:
    return F.try_to_date(text, "yyyy-M")


def json_text(document: Column, path: str) -> Column:
    """One field of a JSON document as text, e.g. ``$.data.url``."""
    return F.get_json_object(document, path)
