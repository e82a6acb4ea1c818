"""SQL names for the text functions, as plain SQL expressions."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .text import roman_numeral

_ROMANS = ", ".join(f"'{roman_numeral(n)}'" for n in range(1, 31))

_SQL = {
    "CompressWhiteSpace": "(s STRING) RETURNS STRING RETURN regexp_replace(s, '(\\\\s)\\\\s+', '$1')",
    "LevenshteinDistance": "(a STRING, b STRING) RETURNS INT RETURN levenshtein(a, b)",
    "NameSimilarity": (
        "(f1 STRING, l1 STRING, f2 STRING, l2 STRING) RETURNS DOUBLE RETURN "
        "(SELECT 1.0D - least(levenshtein(concat(a,' ',b), concat(c,' ',d)), "
        "levenshtein(concat(b,' ',a), concat(c,' ',d))) / "
        "CAST(greatest(length(concat(a,' ',b)), length(concat(c,' ',d))) AS DOUBLE) FROM (SELECT "
        "coalesce(regexp_replace(upper(trim(f1)), '(\\\\s)\\\\s+', '$1'), 'NULL') a, "
        "coalesce(regexp_replace(upper(trim(l1)), '(\\\\s)\\\\s+', '$1'), 'NULL') b, "
        "coalesce(regexp_replace(upper(trim(f2)), '(\\\\s)\\\\s+', '$1'), 'NULL') c, "
        "coalesce(regexp_replace(upper(trim(l2)), '(\\\\s)\\\\s+', '$1'), 'NULL') d))"
    ),
    "ToProperCase": (
        "(s STRING, roman_limit INT) RETURNS STRING RETURN "
        "rtrim(array_join(transform(split(regexp_replace(replace(lower(s), ',', ', '), '  +', ' '), "
        "'(?<=[ ,.\\'()/-])|(?=[ ,.\\'()/-])'), w -> CASE "
        f"WHEN array_contains(slice(array({_ROMANS}), 1, roman_limit), w) THEN upper(w) "
        "WHEN startswith(w, 'mc') THEN concat('Mc', upper(substr(w, 3, 1)), substr(w, 4)) "
        "ELSE concat(upper(substr(w, 1, 1)), substr(w, 2)) END), ''))"
    ),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create the temporary SQL functions; returns their names."""
    names = []
    for name, body in _SQL.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
        names.append(name)
    return names
