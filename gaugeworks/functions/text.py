"""Text normalisation. Trimming removes blanks only; other white space stays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trimmed(column: str) -> Column:
    return F.trim(F.col(column))


def lowered(column: str) -> Column:
    return F.lower(trimmed(column))


def titled(column: str) -> Column:
    """First letter of each blank-separated word upper case, all others lower case."""
    return F.initcap(trimmed(column))
