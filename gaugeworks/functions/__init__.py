"""Column functions built from Spark's own expressions."""

from gaugeworks.functions.dates import first_date, strict_date
from gaugeworks.functions.text import lowered, titled, trimmed

__all__ = ["first_date", "lowered", "strict_date", "titled", "trimmed"]
