"""Text to numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A failed cast costs an exception per cell, so text is matched first.  The
# pattern also keeps out spellings that only a parser of program literals
# takes (1d, NaN, Infinity).
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
WHOLE = r"^[+-]?\d+$"


def to_number(value: Column | str) -> Column:
    """Double of trimmed text, NULL when it is not a number."""
    text = F.trim((F.col(value) if isinstance(value, str) else value).cast("string"))
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def to_whole(value: Column | str) -> Column:
    """BIGINT of trimmed whole-number text, else NULL."""
    text = F.trim((F.col(value) if isinstance(value, str) else value).cast("string"))
    return F.when(text.rlike(WHOLE), text.try_cast("bigint"))
