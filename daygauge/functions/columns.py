"""Expressions shared by the operators, as SQL text that Spark compiles into the stage's code."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VIEWS = "count_if(action = 'view')"
LIKES = "count_if(action = 'like')"


def exprs(*texts: str) -> list[Column]:
    return [F.expr(text) for text in texts]


def day(actions: DataFrame) -> Column:
    """Calendar day of an action.

    A log stored with a ``dt`` date partition is read by that column, so that a
    date filter prunes directories. Otherwise the day comes from ``time``; Spark
    turns a filter on it into a range on ``time`` and pushes that to the scan.
    """
    return F.col("dt") if "dt" in actions.columns else F.to_date("time")


def on_day(actions: DataFrame, d: date) -> DataFrame:
    return actions.where(day(actions) == F.lit(d))


def between_days(actions: DataFrame, first: date, last: date) -> DataFrame:
    return actions.where(day(actions).between(F.lit(first), F.lit(last)))


def round2(x: str) -> str:
    """Two decimals, ties to even (Spark's ``round`` sends ties away from zero)."""
    return f"rint(({x}) * 100) / 100"


def ratio(part: str, whole: str) -> str:
    """``part / whole`` as double; NULL where ``whole`` is zero."""
    return f"try_divide({part}, {whole})"


def ctr_pct(likes: str, views: str) -> str:
    return round2(ratio(f"{likes} * 100", views))


def number_text(x: str) -> str:
    """A two-decimal number with its second trailing zero dropped; NULL as ``nan``."""
    return f"CASE WHEN {x} IS NULL THEN 'nan' ELSE regexp_replace(format_string('%.2f', {x}), '0$', '') END"
