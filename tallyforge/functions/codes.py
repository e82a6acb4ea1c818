"""Report codes, recodes and missing-value spellings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numbers import to_number
from .text import _c

# Fixed values of the named report formats: value -> text, then the text for
# anything else.  "pad" is (low, high, width) for zero-padded whole numbers.
VALUE_FORMATS = {
    "padzerofmt": {"pad": (1, 12, 2), "map": {".": "  ", "": "  ", None: "  "}, "other": "! "},
    "dayfmt": {"pad": (1, 31, 2), "map": {".": "  ", "99": "  ", "": "  ", None: "  "}, "other": "! "},
    "yearfmt": {"pad": (1, 9999, 4), "map": {".": "    ", "": "    ", None: "    "}, "other": "! "},
    "genderfmt": {"map": {"1": "F", "2": "M", "*": " ", " ": " ", "": " "}},
    "scalefmt": {"pad": (0, 998, 3),
                 "map": {"999": "INV", ".": "DNA", ".A": "DNA", "": "DNA", None: "DNA"}},
    "perflevfmt": {"map": {"1": "15", "2": "14", "3": "13", "4": "12", "5": "11", ".I": "99",
                           ".A": "  ", ".": "  ", "": "  ", None: "  "}, "whole": True},
    "ethnicityfmt": {"map": {"1": "1", "2": "2", "3": "3", "4": "4", "5": "5", "6": "6", "7": "7",
                             "*": "  ", " ": "  ", "": "  "}},
    "migrantfmt": {"map": {"1": "Y", "": " ", " ": " ", "0": " "}},
    "binaryfmt": {"map": {"1": "Y", "0": " "}, "whole": True},
    "writingpromptfmt": {"map": {"A": "A ", "B": "B ", "C": "C ", "D": "D ", "E": "E ", "F": "F ",
                                 "G": "G ", "T": "T ", "": "  ", " ": "  "}},
    "rawfmt": {"pad": (0, 999, 3), "times": 10,
               "map": {".A": "   ", ".I": "   ", ".S": "   ", ".": "   ", "": "   ", None: "   "}},
    "levfmt": {"map": {"1": "-", "2": "*", "3": "+", ".A": " ", ".I": " ", ".S": " ", ".": " ",
                       "": " ", None: " "}, "whole": True},
    "yesnofmt": {"map": {"1": "Y", "0": "N", ".": " ", "": " ", None: " "}, "whole": True},
    "revfmt": {"map": {"0": "Y", "1": "N"}, "whole": True},
}


def apply_value_format(value: Column | str, name: str) -> Column:
    """Text of a value under one of the named report formats; ``!`` if none fits."""
    try:
        rule = VALUE_FORMATS[name.lower()]
    except KeyError:
        raise ValueError(f"unknown value format {name!r}") from None
    text = _c(value).cast("string")
    number = to_number(text)
    if "times" in rule:
        number = number * F.lit(rule["times"])
    whole = number.try_cast("bigint")
    if rule.get("whole") or "pad" in rule:
        text = F.coalesce(whole.cast("string"), text)
    out = None
    if "pad" in rule:
        low, high, width = rule["pad"]
        out = F.when(whole.between(low, high), F.lpad(whole.cast("string"), width, "0"))
    for key, target in rule["map"].items():
        test = text.isNull() if key is None else text == F.lit(key)
        out = F.when(test, F.lit(target)) if out is None else out.when(test, F.lit(target))
    return out.otherwise(F.lit(rule.get("other", "!")))


def is_numeric(value: Column | str) -> Column:
    """True for text that parses as a number (lone ``-``, ``$`` and ``.`` do not)."""
    return to_number(value).isNotNull()


def to_number_or_zero(value: Column | str) -> Column:
    return F.coalesce(to_number(value), F.lit(0.0))


def decode_intensity(value: Column | str) -> Column:
    """Hex digit of a mark's darkness: A..F are 10..15, ``-`` and junk are 0."""
    text = _c(value).cast("string")
    return (
        F.when(text.isin("A", "B", "C", "D", "E", "F"), F.conv(text, 16, 10).cast("double"))
        .otherwise(to_number_or_zero(text))
    )


def letters_to_null(df: DataFrame, columns: list[str], codes: tuple[str, ...] = ("A",),
                    missing: str | None = None) -> DataFrame:
    """Replace the listed missing codes in the named nominal columns."""
    chosen = {c.lower() for c in columns}
    return df.select(*[
        F.when(F.col(c).isin(list(codes)), F.lit(missing)).otherwise(F.col(c)).alias(c)
        if c.lower() in chosen else F.col(c)
        for c in df.columns
    ])


def sentinel_to_null(value: Column | str, sentinel) -> Column:
    """The sentinel (99 for a grade, 1 for a breach flag) becomes NULL."""
    column = _c(value)
    return F.when(column != F.lit(sentinel), column)


# Letter per performance level.
LEVEL_LETTERS = {"1": "L", "2": "B", "3": "P", "4": "A", "5": "AD"}


def recode_levels(level: Column | str) -> Column:
    """Performance level 1..5 to its letter, anything else to the empty text."""
    text = _c(level).cast("string")
    table = F.create_map(*[F.lit(x) for pair in LEVEL_LETTERS.items() for x in pair])
    return F.coalesce(F.try_element_at(table, text), F.lit(""))


def pass_flag(level: Column | str) -> Column:
    """1 passed (levels 3..5), 2 failed (1, 2), 3 no level."""
    text = _c(level).cast("string")
    return F.when(text.isin("3", "4", "5"), "1").when(text.isin("1", "2"), "2").otherwise("3")


def report_level(level: Column | str) -> Column:
    """Numeric level for reports, NULL outside 1..5."""
    number = _c(level).cast("string").try_cast("int")
    return F.when(number.between(1, 5), number)
