"""Names and text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def compress_whitespace(value: Column | str) -> Column:
    """Each run of whitespace becomes its first character."""
    return F.regexp_replace(_c(value), r"(\s)\s+", "$1")


def levenshtein_distance(left: Column | str, right: Column | str) -> Column:
    return F.levenshtein(_c(left), _c(right))


def _name_part(value: Column | str, null_as_text: bool) -> Column:
    part = compress_whitespace(F.upper(F.trim(_c(value))))
    return F.coalesce(part, F.lit("NULL" if null_as_text else ""))


def name_similarity(first1, last1, first2, last2, null_as_text: bool = True) -> Column:
    """Similarity of two names in 0..1, allowing swapped first and last names.

    One minus the smaller edit distance over the longer text.  An absent part
    reads as the text ``NULL`` unless ``null_as_text`` is off.
    """
    straight, swapped = clean_names(first1, last1, null_as_text)
    other, _ = clean_names(first2, last2, null_as_text)
    return clean_similarity(straight, swapped, other)


def clean_names(first, last, null_as_text: bool = True) -> tuple[Column, Column]:
    """Cleaned full name with the first name first, and with the last name first."""
    f, l = (_name_part(p, null_as_text) for p in (first, last))
    return F.concat(f, F.lit(" "), l), F.concat(l, F.lit(" "), f)


def clean_similarity(straight: Column, swapped: Column, other: Column) -> Column:
    """Similarity of cleaned full names (see :func:`name_similarity`)."""
    distance = F.least(F.levenshtein(straight, other), F.levenshtein(swapped, other))
    longest = F.greatest(F.length(straight), F.length(other))
    return F.lit(1.0) - distance.cast("double") / longest.cast("double")


def roman_numeral(number: int) -> str:
    text = ""
    for value, digit in ((10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")):
        while number >= value:
            text += digit
            number -= value
    return text


def _capitalise(word: Column) -> Column:
    return F.concat(F.upper(F.substring(word, 1, 1)), word.substr(F.lit(2), F.length(word)))


def to_proper_case(value: Column | str, roman_limit: int = 10) -> Column:
    """Name case: capitals after blank , . ' ( ) - / and after a leading ``mc``.

    Roman numerals up to ``roman_limit`` become capitals, a comma is followed
    by a blank, double blanks collapse.
    """
    romans = [roman_numeral(n) for n in range(1, roman_limit + 1)]
    lowered = F.regexp_replace(F.replace(F.lower(_c(value)), F.lit(","), F.lit(", ")), "  +", " ")
    words = F.split(lowered, r"(?<=[ ,.'()\-/])|(?=[ ,.'()\-/])")

    def one(word: Column) -> Column:
        mac = F.concat(F.lit("Mc"), _capitalise(word.substr(F.lit(3), F.length(word))))
        return (
            F.when(word.isin(romans), F.upper(word))
            .when(word.startswith("mc"), mac)
            .otherwise(_capitalise(word))
        )

    return F.rtrim(F.array_join(F.transform(words, one), ""))


def proper_case_words(value: Column | str) -> Column:
    """Title case word by word; words end at blanks and periods, i..x are Roman."""
    romans = [roman_numeral(n) for n in range(1, 11)]
    lowered = F.trim(F.regexp_replace(F.replace(F.lower(_c(value)), F.lit(","), F.lit(", ")), r"\s+", " "))
    words = F.split(lowered, r"(?<=[ .])|(?=[ .])")

    def one(word: Column) -> Column:
        return F.when(F.regexp_replace(word, ",+$", "").isin(romans), F.upper(word)).otherwise(_capitalise(word))

    return F.array_join(F.transform(words, one), "")


def compose_name(*parts: Column | str) -> Column:
    """Non-blank parts joined by one blank, blanks inside collapsed."""
    clean = [F.nullif(F.trim(_c(p)), F.lit("")) for p in parts]
    return F.regexp_replace(F.concat_ws(" ", *clean), " +", " ")


def character_cleanup(value: Column | str, replacements: dict[str, str] | None = None,
                      keep_pattern: str | None = None) -> Column:
    """Replace single characters; blank the value when it misses ``keep_pattern``."""
    out = _c(value)
    for old, new in (replacements or {"`": "'", "[": "(", "?": ""}).items():
        out = F.replace(out, F.lit(old), F.lit(new))
    if keep_pattern is not None:
        out = F.when(out.rlike(keep_pattern), out).when(out.isNotNull(), F.lit(""))
    return out
