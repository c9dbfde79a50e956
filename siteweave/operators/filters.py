"""Row filters."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed


def exclude_like(df: DataFrame, col: str, words: Iterable[str]) -> DataFrame:
    """Drop rows whose text holds one of the words, and rows without text."""
    for word in words:
        df = df.filter(~F.col(col).contains(word))
    return df


def exclude_ilike(df: DataFrame, col: str, words: Iterable[str]) -> DataFrame:
    """As `exclude_like`, ignoring case."""
    for word in words:
        df = df.filter(~F.lower(col).contains(word.lower()))
    return df


def country_view(df: DataFrame, code: str = fixed.VIEW_COUNTRY) -> DataFrame:
    return df.filter(F.col("country_code") == code)
