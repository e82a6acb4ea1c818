"""Column names (driver side; no row work)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def normalize_column_names(df: DataFrame) -> DataFrame:
    """Lower case, blanks to underscores; empty or repeated names become ``Column_i``."""
    seen: set[str] = set()
    names = []
    for position, name in enumerate(df.columns, start=1):
        clean = re.sub(r"\s+", "_", (name or "").strip().lower())
        if not clean or clean in seen:
            clean = f"column_{position}"
        seen.add(clean)
        names.append(clean)
    return df.toDF(*names)


def select_columns_like(df: DataFrame, patterns: list[str], always: list[str] = ()) -> DataFrame:
    """Columns that match one of the patterns (any case), and the fixed ones."""
    fixed = {c.lower() for c in always}
    rules = [re.compile(p, re.IGNORECASE) for p in patterns]
    keep = [c for c in df.columns if c.lower() in fixed or any(r.search(c) for r in rules)]
    return df.select(*keep)
