"""Repairs of hand-entered records."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from reachmart.functions.decisions import TARGET_SEGMENTS
from reachmart.functions.text import as_number


def looks_shifted(first_name: Column, segment: Column) -> Column:
    """A segment name in the name column, or a number in the segment column."""
    return F.coalesce(first_name.isin(TARGET_SEGMENTS), F.lit(False)) | as_number(segment).isNotNull()


def unit_score(score: Column) -> Column:
    """Scores above one are percentages; missing or negative ones become one half."""
    value = as_number(score)
    return F.when((value >= 0) & (value <= 1), value).when(value > 1, value / 100).otherwise(0.5)


def derived_id(email: Column) -> Column:
    """A stable id for a record without a usable one: a second run gives the same id."""
    return F.concat(F.lit("manual-"), F.substring(F.sha2(F.coalesce(email, F.lit("")), 256), 1, 16))
