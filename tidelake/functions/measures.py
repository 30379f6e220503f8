"""Expressions shared by the report queries."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def money(total: Column) -> Column:
    return total.cast("decimal(20,2)")


def percent(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent with two decimals; NULL where ``whole`` is zero."""
    share = F.lit(100.0) * part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))
    return F.round(share, 2)


def start_of_week(moment: Column) -> Column:
    """Monday 00:00 of the week, as a timestamp without zone."""
    return F.trunc(F.to_date(moment), "week").cast("timestamp_ntz")


def start_of_month(moment: Column) -> Column:
    return F.trunc(F.to_date(moment), "month").cast("timestamp_ntz")
