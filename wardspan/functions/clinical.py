"""Scalar rules of the hospital tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalise_code(code: Column) -> Column:
    """Diagnosis code in upper case without dots."""
    return F.translate(F.upper(code), ".", "")


def null_nan(value: Column) -> Column:
    """NaN to NULL: Spark orders NaN above every number, so it must not reach
    ``max`` or a median."""
    return F.when(~F.isnan(value), value)


def known_double(value: Column) -> Column:
    """``value`` as a double, NaN as NULL, ``value`` written once: filling a column
    again and again must not double its expression each time."""
    return F.nanvl(value.cast("double"), F.lit(None).cast("double"))


def age_at(anchor_age: Column, anchor_year: Column, when: Column) -> Column:
    """Age at ``when``, from an age known for an anchor year."""
    return anchor_age.cast("int") + (F.year(when) - anchor_year.cast("int"))


def flag(condition: Column) -> Column:
    """0/1 with missing counted as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def whole_days(start: Column, end: Column) -> Column:
    """Elapsed whole days from start to end, rounded down.

    ``datediff`` counts midnights; one is taken off again when the clock time
    of ``start`` has not been reached. Works on timestamps without a zone and
    needs no session zone.
    """
    midnights = F.datediff(end, start)
    return midnights - (start + F.make_dt_interval(midnights) > end).cast("int")


def one_hot(column: Column, categories: Iterable[str], prefix: str) -> list[Column]:
    """One 0/1 column ``<prefix>_<category>`` per listed category."""
    return [flag(column == F.lit(c)).alias(f"{prefix}_{c}") for c in categories]
