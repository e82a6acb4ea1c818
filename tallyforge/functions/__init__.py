"""Column functions: all native expressions, no Python UDF."""

from .codes import (
    VALUE_FORMATS,
    apply_value_format,
    decode_intensity,
    is_numeric,
    letters_to_null,
    recode_levels,
    report_level,
    pass_flag,
    sentinel_to_null,
    to_number_or_zero,
)
from .keys import (
    band_number,
    blank,
    clean_label,
    compose_date,
    composite_key,
    grade_or_default,
    median3,
    min3,
    trim_float_text,
)
from .numbers import to_number, to_whole
from .names import normalize_column_names, select_columns_like
from .sqlnames import register_sql_functions
from .text import (
    character_cleanup,
    compose_name,
    compress_whitespace,
    levenshtein_distance,
    name_similarity,
    proper_case_words,
    to_proper_case,
)

__all__ = [
    "VALUE_FORMATS", "apply_value_format", "band_number", "blank", "character_cleanup",
    "clean_label", "compose_date", "compose_name", "composite_key", "compress_whitespace",
    "decode_intensity", "grade_or_default", "is_numeric", "letters_to_null",
    "levenshtein_distance", "median3", "min3", "name_similarity", "normalize_column_names",
    "pass_flag", "proper_case_words", "recode_levels", "register_sql_functions",
    "report_level", "select_columns_like", "sentinel_to_null", "to_number", "to_number_or_zero",
    "to_proper_case", "to_whole", "trim_float_text",
]
