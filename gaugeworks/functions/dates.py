"""Dates from text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_date(column: str, formats: Iterable[str]) -> Column:
    """The date by the first format that reads the text; NULL when none does."""
    return F.coalesce(*[F.try_to_date(F.col(column), pattern) for pattern in formats])


def strict_date(column: str, pattern: str) -> Column:
    """The date by one format; with ANSI mode on, other text is an error."""
    return F.to_date(F.col(column), pattern)
