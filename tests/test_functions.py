"""Column functions on hand-made cells."""

import pytest
from pyspark.sql import functions as F

from tallyforge import functions as fn
from tallyforge.operators.layout import implied_decimal, parse_us_date


def one(spark, *columns, **values):
    schema = ", ".join(f"{k} string" for k in values) or "z string"
    return tuple(spark.createDataFrame([tuple(values.values()) or ("",)], schema).select(*columns).first())


def test_names(spark):
    s = fn.name_similarity
    assert one(spark, s("a", "b", "b", "a"), a="Ann", b="Lee") == (1.0,)
    # an absent part reads NULL and adds five equal characters to both sides
    assert one(spark, s("a", F.lit(None), "b", F.lit(None)), a="ABCDE", b="ABXYE")[0] == pytest.approx(0.8)
    assert one(spark, s("a", F.lit(None), "b", F.lit(None), null_as_text=False), a="ABCDE", b="ABXYE")[0] == pytest.approx(1 - 2 / 6)
    assert one(spark, fn.compress_whitespace("a"), a="x \t y\n\n\nz") == ("x y\nz",)
    assert one(spark, fn.compose_name("a", "b", "c"), a=" Ann ", b=" ", c="Lee  Roy") == ("Ann Lee Roy",)


@pytest.mark.parametrize("text,wanted", [
    ("O'BRIEN-smith", "O'Brien-Smith"), ("mcdonald jr.", "McDonald Jr."), ("john PAUL ii", "John Paul II"),
    ("lee,ann", "Lee, Ann"), ("a  b (the/first)", "A B (The/First)"), ("", "")])
def test_proper_case(spark, text, wanted):
    assert one(spark, fn.to_proper_case("a", 10), a=text) == (wanted,)


def test_proper_case_words(spark):
    assert one(spark, fn.proper_case_words("a"), a="dr. m.d. SMITH  iv") == ("Dr. M.D. Smith IV",)


def test_sql_names_agree(spark):
    fn.register_sql_functions(spark)
    row = spark.sql("SELECT NameSimilarity('Ann', 'Lee', 'LEE', 'ann'), ToProperCase('mcneil xi', 10), ToProperCase('mcneil xi', 30), LevenshteinDistance('ab', 'b')").first()
    assert tuple(row) == (1.0, "McNeil Xi", "McNeil XI", 1)


@pytest.mark.parametrize("name,value,wanted", [
    ("padzerofmt", "7", "07"), ("padzerofmt", "13", "! "), ("padzerofmt", None, "  "), ("dayfmt", "99", "  "), ("yearfmt", "987", "0987"),
    ("genderfmt", "2", "M"), ("genderfmt", "x", "!"), ("scalefmt", "999", "INV"), ("scalefmt", ".A", "DNA"), ("scalefmt", "45", "045"),
    ("perflevfmt", "5", "11"), ("perflevfmt", ".I", "99"), ("ethnicityfmt", "*", "  "), ("migrantfmt", "1", "Y"), ("binaryfmt", "1.0", "Y"),
    ("writingpromptfmt", "T", "T "), ("rawfmt", "12.5", "125"), ("rawfmt", ".S", "   "), ("levfmt", "3", "+"), ("yesnofmt", "0", "N"), ("revfmt", "1", "N")])
def test_value_formats(spark, name, value, wanted):
    assert one(spark, fn.apply_value_format(F.lit(value).cast("string"), name)) == (wanted,)


def test_unknown_format():
    with pytest.raises(ValueError):
        fn.apply_value_format("a", "nofmt")


def test_numbers_and_codes(spark):
    assert one(spark, fn.is_numeric("a"), fn.is_numeric("b"), fn.is_numeric("c"), fn.to_number_or_zero("d"), a=" 1.5 ", b="-", c="1d", d="x") == (True, False, False, 0.0)
    assert one(spark, *[fn.decode_intensity(c) for c in "abcd"], a="F", b="-", c="7", d=None) == (15.0, 0.0, 7.0, 0.0)
    assert one(spark, fn.trim_float_text("a"), fn.trim_float_text("b"), fn.trim_float_text("c"), fn.trim_float_text("d"), a="3.0", b="3.50", c="x.0", d=None) == ("3", "3.50", "x.0", "")
    assert one(spark, fn.median3(F.lit(3), F.lit(1), F.lit(2)), fn.min3(F.lit(3), F.lit(1), F.lit(2)), fn.median3(F.lit(1), F.lit(None), F.lit(2))) == (2, 1, None)
    assert one(spark, *[fn.band_number(F.lit(n)) for n in (1, 5, 6, 45, 46, 500)]) == (1, 1, 2, 9, 10, 10)
    assert one(spark, fn.recode_levels("a"), fn.recode_levels("b"), fn.pass_flag("a"), fn.pass_flag("b"), a="5", b="9") == ("AD", "", "1", "3")
    assert one(spark, fn.clean_label("a"), a=" x - - y\t z ") == ("x - y z",)
    assert one(spark, fn.composite_key("a", "b"), fn.grade_or_default("a"), fn.grade_or_default("c"), a="10.0", b=None, c="K") == ("10.0_", "10", "99")
    assert one(spark, implied_decimal("a", "ID2"), implied_decimal("a", "ID2", reference_divisor=False), implied_decimal("b", "ID1"), a="125", b="-") == ("12.5", "1.25", "-")


def test_dates(spark):
    c = fn.compose_date
    assert one(spark, c("a", "b", "c", text=True), a="2012", b="2.0", c="29") == ("02/29/2012",)
    assert one(spark, c("a", "b", "c", text=True), a="2011", b="2", c="29") == (None,)
    assert one(spark, c("a", "b", "c", text=True, year_range=(1801, 2100)), a="1700", b="1", c="1") == (None,)
    assert str(one(spark, parse_us_date("a"), a="12312011")[0])[:10] == "2011-12-31"
    assert one(spark, parse_us_date("a"), a="13312011") == (None,)


def test_column_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["A  b", "a b", "C"])
    assert fn.normalize_column_names(df).columns == ["a_b", "column_2", "c"]
    assert fn.select_columns_like(df, ["^c$"], ["a b"]).columns == ["a b", "C"]
