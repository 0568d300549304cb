"""Ordering and top-k reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.functions.columns import named


def rank_all(df: DataFrame, measure: str, tie: Sequence[str]) -> DataFrame:
    """Largest first, unknown before everything, ties in the order of ``tie``."""
    return df.orderBy(named(measure).desc_nulls_first(), *[named(t).asc_nulls_first() for t in tie])


def top_k(df: DataFrame, k: int, measure: str, tie: Sequence[str]) -> DataFrame:
    """The ``k`` largest; planned as a per-task heap and one merge, without a full sort."""
    return rank_all(df, measure, tie).limit(k)


def order_by_period(df: DataFrame, *names: str) -> DataFrame:
    return df.orderBy(*[named(n) for n in names or ("ano", "mes")])
