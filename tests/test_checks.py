"""Id checks, comparisons, scores, erasures on small frames."""

import random

import pytest
from pyspark.sql import functions as F

from tallyforge.functions.text import clean_names, clean_similarity
from tallyforge.operators import attempts, erasure, linkage, quality, scoring

BOOK = "`item position` int, form_values string, `numeric key` int, `item format` string, role string, subject_values string, grade_values string"


@pytest.fixture(scope="module")
def book(spark):
    rows = [(i, f, i % 4 + 1, "MC", "Operational", "r", "10") for i in range(1, 7) for f in "AB"]
    rows += [(7, f, 1, "SA", "operational", "r", "10") for f in "AB"] + [(8, "A", 1, "MC", "Field Test", "r", "10")]
    return spark.createDataFrame(rows, BOOK).cache()


def test_id_sheet(spark, rows):
    data = [(1, None, None, "u", "x", "a", "l"), (2, "v", "", "w", "x", "a", "m"), (3, "v", ".", "z", "y", "b", None), (4, "v", "v", "q", None, "b", "l"),
            (5, "v", "v", "r", None, "c", "l"), (6, "v", "v", "s", "k", "c", "l")]
    df = spark.createDataFrame(data, "id int, nmiss string, nmiss_fail string, unique0 string, unique_fail string, id1 string, label1 string")
    sheet = [{"checktype": t, "variable": v, "labelvariable": l} for t, v, l in (
        ("NonMissing", "nmiss_fail", None), ("UniqueKey", "unique0", None), ("UniqueKey", "unique_fail", None), ("UniqueLabel", "id1", "label1"))]
    out = rows(quality.id_check(df, sheet), "bad_variable", "id", "bad_reason", "bad_label")
    # NULL is a label; repeated NULL keys are no duplicates
    assert out == sorted([("nmiss_fail", 1, "missing ID", ""), ("nmiss_fail", 2, "missing ID", ""), ("nmiss_fail", 3, "missing ID", ""),
                          ("unique_fail", 1, "not unique", ""), ("unique_fail", 2, "not unique", ""), ("id1", 1, "bad label", "l"),
                          ("id1", 2, "bad label", "m"), ("id1", 3, "bad label", None), ("id1", 4, "bad label", "l")], key=repr)
    assert rows(quality.check_unique_key(df, "unique_fail", "id", hot_rows=1), "id") == [(1,), (2,)]
    with pytest.raises(ValueError):
        quality.id_check(df, [{"checktype": "Other", "variable": "id1"}])


def test_compare_tables(spark, rows):
    a = spark.createDataFrame([(1, "x ", 0.0, 1), (2, None, 100.0, 2), (3, "z", 1.0, None), (4, "q", 2.0, 4)], "k int, t string, v double, w int")
    b = spark.createDataFrame([(1, "x", 0.0, 1), (2, "y", 100.1, 2), (3, "z", None, None), (9, "q", 2.0, 4)], "K int, t string, v double, extra int")
    out = quality.compare_tables(a, b, ["k"], tolerance=0.01)
    assert rows(out.differences, "k", "variable") == [(2, "t"), (3, "v")]
    assert rows(out.only_left) == [(4,)] and rows(out.only_right) == [(9,)]
    s = out.summary.first()
    assert (s["rows_matched"], s["rows_unequal"], s["values_unequal"]) == (3, 2, 2)
    assert out.schema_differences == [("w", "int", None), ("extra", None, "int")]
    assert rows(quality.compare_tables(a, b, ["k"], tolerance=0.0001).differences, "k", "variable") == [(2, "t"), (2, "v"), (3, "v")]
    assert quality.compare_to_specimen(a, b, ["k"], {"v": quality.differs_as_integer, "t": quality.differs_as_mixed}).differences.count() == 2


@pytest.mark.parametrize("store", [False, True])
def test_comparison_equals_all_pairs_of_a_key(spark, rows, store):
    """Repeated and missing keys, values that change places with nulls, blanks, numbers of other types."""
    rng = random.Random(6)

    def table(changes):
        out = []
        for i in range(120):
            row = [None if i % 31 == 0 else i // 2 if i < 60 else i, rng2.choice(["x", "x ", "y", None]), rng2.choice(["x", None, "y"]), rng2.choice([1.0, 2.0, 0.0, -0.0, float("nan"), None])]
            if rng.random() < changes:
                row[rng.randrange(1, 3)] = rng.choice(["y", None, " x"])
            if rng.random() >= changes / 2:
                out.append(tuple(row))
        return out

    rng2 = random.Random(1)
    a = table(0.2)
    rng2 = random.Random(1)
    b = table(0.2)
    left = spark.createDataFrame(a, "k int, s string, t string, v double")
    right = spark.createDataFrame(b, "k long, s string, t string, v double").withColumn("v", F.col("v").cast("float"))
    out = quality.compare_tables(left, right, ["k"], store=store)

    def trimmed(x):
        return x if x is None else x.strip(" ")

    def same(x, y):
        return x == y or (x is not None and y is not None and x != x and y != y)

    pairs = [(p, q) for p in a for q in b if p[0] is not None and p[0] == q[0]]
    wanted = sorted([(p[0], n) for p, q in pairs for n, i in (("s", 1), ("t", 2)) if trimmed(p[i]) != trimmed(q[i])]
                    + [(p[0], "v") for p, q in pairs if not same(p[3], q[3])])
    assert rows(out.differences, "k", "variable") == sorted(wanted, key=repr)
    lone = lambda x, y: sorted([(p[0],) for p in x if p[0] is None or p[0] not in {q[0] for q in y}], key=repr)
    assert rows(out.only_left) == lone(a, b) and rows(out.only_right) == lone(b, a)
    unequal = sum(any(trimmed(p[i]) != trimmed(q[i]) for i in (1, 2)) or not same(p[3], q[3]) for p, q in pairs)
    # rows are counted as they meet, so a repeated key counts once for each partner
    assert tuple(out.summary.first()) == (len(pairs) + len(lone(a, b)), len(pairs) + len(lone(b, a)), len(pairs), len(lone(a, b)), len(lone(b, a)), unequal, len(wanted))


def test_rescore(spark, rows):
    key = spark.createDataFrame([("01", 1, "2.0", "1"), ("01", 2, "x", "1"), ("sv", 1, "4", "2")], "form_id string, item_id int, numeric_key string, point_value string")
    data = [(1, "01", 1, "2", "1"), (2, "01", 1, "2.0", "0"), (3, " 01 ", 1, "-", "0"), (4, "SV", 1, "4", "2"), (5, "zz", 1, "4", "2"), (6, "sv", 9, "4", "2"),
            (7, "01", 1, "3", "q"), (8, "01", 2, "98", "1"), (9, "01", 1, "*", "")]
    out = scoring.rescore_check(spark.createDataFrame(data, "test_id int, form_id string, item_id int, finalraw_item string, score_item string"), key)
    found = {r["test_id"]: r for r in out.report.collect()}
    assert set(found) == {2, 5, 6, 7, 9} and found[2]["correct_score"] == 1 and found[9]["test_score"] == 99
    assert "form" in found[5]["message"] and "item" in found[6]["message"] and "number" in found[7]["message"]
    assert rows(out.output, "test_id", "score_item") == [(1, 1), (2, 1), (3, 0), (4, 2), (8, 1), (9, 0)]


@pytest.mark.parametrize("rule,scores,wanted", [
    ("short", ("2", "2", "", "2", None), "2"), ("short", ("2", "3", "", "2", None), "2.5"), ("short", ("1", "4", "4", "2", None), "4"), ("short", ("1", "4", "3", "2", None), "2.0"),
    ("short", ("A", "A", "", "A", None), "A"), ("extended", ("1", "3", "2", "2", None), "2.0"), ("extended", ("1", "2", "5", "2", None), "1.5"),
    ("extended", ("1", "4", "2", "2", "3"), "1.5"), ("extended", ("1", "6", "9", "2", "3"), "3"), ("writing", ("3", "3", "", "6", None), "6.0"),
    ("writing", ("3", "5", "4", "8", None), "8.0"), ("writing", ("0", "2", "1", "1", None), "1.0"), ("writing", ("1", "5", "9", "1", "4"), "8.0"), ("writing", ("A", "3", "", "A", None), None)])
def test_resolution_rules(spark, rule, scores, wanted):
    names = ("first", "second", "third", "final", "reso")
    df = spark.createDataFrame([scores], ", ".join(f"oe_{n} string" for n in names))
    df = df.withColumns({f"_{n}": F.col(f"oe_{n}").try_cast("double") for n in names})
    assert df.select(scoring.resolved_score(rule)).first()[0] == wanted


def test_attempts(spark, book, rows):
    flat = spark.createDataFrame([(1, "l1", "SP", "0", "0", "0"), (2, "l2", "BR", "9", "1", "0"), (3, "l3", "SP", "x", "1", "0"), (4, "l4", "SP", "7", "0", "1")],
                                 "id int, lithocode string, ucrx_form string, uprxraw string, ufrx_attempt string, ufrx_invalid string")
    flat = flat.withColumns({"ucrxgen": F.lit("2.0"), "preidflag": F.lit(1), "dob_year": F.lit("1999"), "dob_month": F.lit("2"), "dob_day": F.lit("30"),
                             "ucrxfnm": F.lit("ANN"), "ucrxlnm": F.lit("o'neil")})
    items = [(1, i, "1", "") for i in range(1, 6)] + [(2, i, "-", "A") for i in range(1, 8)] + [(3, 1, "2", ""), (3, 7, "", "3")] + [(4, 1, "-", "")]
    frame = spark.createDataFrame(items, "flat_table_id int, id int, uprx_finalraw_item string, uprx_oe_final string")
    out = scoring.attempt_check(flat, frame, book, "r")
    assert rows(out.mismatches) == [(1, 1, 0), (3, 0, 1), (4, 1, 0)]
    assert out.detail.where("flat_table_id = 1").count() == 5
    flags = attempts.derive_attempt_flags(flat, {"r": frame.withColumnRenamed("uprx_finalraw_item", "uprx_raw_item")}, book, "10")
    assert rows(flags, "id", "attempt_r", "variable_priority", "gender", "dob", "ucrxlnm") == [
        (1, 1, 11, "2", None, "O'Neil"), (2, 0, 10, "2", None, "O'Neil"), (3, 1, 11, "2", None, "O'Neil"), (4, 0, 10, "2", None, "O'Neil")]


def test_conversion_and_sums(spark, rows):
    data = spark.createDataFrame([(1, "3", "300", "2"), (2, "4.0", "310", "2"), (3, "9", "1", "1"), (4, "?", "1", "1")], "id int, raw string, scal string, lev string")
    table = spark.createDataFrame([("raw", 3.0, "s", 300.0), ("raw", 3.0, "l", 2.0), ("raw", 4.0, "s", 311.0), ("raw", 4.0, "l", None)], "raw_variable string, raw_score double, measure string, value double")
    rules = {"raw": {"scal": "s", "lev": "l"}}
    out = scoring.score_conversion_check(data, table, rules)
    assert rows(out.report, "id", "variable") == [(2, "lev"), (2, "scal"), (3, None), (4, None)]
    assert rows(scoring.conversion_output_wide(out, rules), "id", "scal", "lev") == [(1, 300.0, 2.0)]
    sums = scoring.sum_check(spark.createDataFrame([(1, "1", "2", "3"), (2, "1", "x", "3"), (3, "1", "2", "4")], "id int, a string, b string, t string"), ["a", "b"], "t")
    assert rows(sums.report, "id") == [(2,), (3,)]


def test_erasures(spark, book):
    def sheet(litho, kind, raw="10"):
        base = {"lithocode": litho, "schtype_attend": kind, "form_r": "A", "uprxraw": raw, "uprxlev": "4"}
        base.update({c: "1" for c in erasure.SHEET_COLUMNS if c != "lithocode"})
        for n in range(1, 7):
            key = n % 4 + 1
            # darkest mark F, second mark 9: erased, was wrong and is right
            base.update({f"uprx_raw_intensity_{n}": "F", f"uprx_second_inten_{n}": "9", f"uprx_raw_editor_{n}": "0", f"uprx_second_dark_{n}": str(key % 4 + 1),
                         f"uprx_raw_item_{n}": str(key), f"uprx_score_item_{n}": "1"})
        return base

    rows = [sheet("a", "P"), sheet("b", "H"), sheet("c", "P", "I")]
    part1 = spark.createDataFrame([tuple(r.values()) for r in rows], list(rows[0]))
    part2 = part1.select("lithocode", F.lit("z").alias("other"), "form_r")
    out = erasure.erasure_analysis(part1, part2, book, ["r"], writing_subjects=("r",)).collect()
    assert [(r["lithocode"], r["erased"], r["w_r"], r["raw"], r["pass_fail"]) for r in out] == [("a", 6, 6, 6.0, "A")]
    assert erasure.erasure_analysis(part1, part2, book, ["r"]).count() == 0


def linkage_frames(spark):
    hay = [(i, f"g{i % 3}", i % 7, f"id{i % 40}", ["Ann", "Bob", "Cid", "Dora"][i % 4], f"Name{i % 11}") for i in range(120)]
    needles = [("g1", 3, "id7", "Anne", "Name7"), ("g0", 1, "id8", "Name8", "Dora"), (None, 2, "zz", "Bob", "Name5")]
    return (spark.createDataFrame(needles, "g string, d int, code string, f string, l string"),
            spark.createDataFrame(hay, "hid int, g string, d int, code string, f string, l string"))


@pytest.mark.parametrize("cut", [1e-1, 1e-2, 2e-3])
def test_search_without_blocking_loses_no_pair(spark, cut):
    needles, hay = linkage_frames(spark)
    args = ({"g": 1.0, "d": 1.0}, {"code": 1.5}, ("f", "l"), 1.5, "hid", cut, 3, ["hid"])
    got = sorted((r["N_code"], r["hid"], round(r["prob"], 12)) for r in linkage.find_matches(needles, hay, *args).collect())
    # the same search over all pairs: a blocking column that is equal everywhere
    n, h = needles.withColumn("all", F.lit(1)), hay.withColumn("all", F.lit(1))
    args = ({"g": 1.0, "d": 1.0, "all": 1.0}, {"code": 1.5}, ("f", "l"), 1.5, "hid", cut, 3, ["hid"])
    wanted = sorted((r["N_code"], r["hid"], round(r["prob"], 12)) for r in linkage.find_matches(n, h, *args, blocking=["all"]).collect())
    assert got == wanted and (cut < 5e-3 or got)


def test_many_needles_and_a_cut_that_names_reach(spark):
    """Against plain Python over all pairs, with more needles than any list in a plan would hold."""
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abcde") for _ in range(n))
    hay = [(i, f"g{i % 50}", word(rng.randrange(3, 6)), word(rng.randrange(4, 8))) for i in range(150)]
    needles = [(f"g{i % 60}", *(rng.choice(hay)[2:] if i % 3 else (word(4), word(6)))) for i in range(1200)]
    n = spark.createDataFrame(needles, "g string, f string, l string").distinct()
    h = spark.createDataFrame(hay, "hid int, g string, f string, l string")
    out = linkage.find_matches(n, h, {"g": 1.0}, {}, ("f", "l"), 1.5, "hid", 1e-3, 10_000, ["hid"])
    got = sorted((r["N_g"], r["N_f"], r["N_l"], r["hid"], round(r["prob"], 12)) for r in out.collect())
    chances = linkage.name_calibration(h, "f", "l", "hid", 1.5)
    share = {r["value"]: r["freq"] for r in linkage.nominal_frequencies(h, "g", 1.0).collect()}
    pairs = n.selectExpr("g AS ng", "f AS nf", "l AS nl").join(h.withColumnRenamed("g", "hg"), F.lit(True))
    straight, swapped = clean_names("nf", "nl")
    step = F.round(F.lit(20.0) * clean_similarity(straight, swapped, clean_names("f", "l")[0]), 0).cast("int")
    wanted = []
    for r in pairs.withColumn("step", step).collect():
        prob = (share[r["ng"]] if r["ng"] == r["hg"] else 1.0) * chances[r["step"]]
        if prob < 1e-3:
            wanted.append((r["ng"], r["nf"], r["nl"], r["hid"], round(prob, 12)))
    assert got == sorted(wanted) and len(got) > 300


def test_a_frequent_value_makes_no_candidates_of_its_own(spark):
    """At a cut that near names alone can reach, rows that share only a value of every third row must have near names."""
    rng = random.Random(9)
    word = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    first, last = [word(6) for _ in range(8)], [word(6) for _ in range(8)]
    for size in (400, 800):
        hay = [(i, f"g{i % 3}", f"c{i}", rng.choice(first), rng.choice(last) + word(3)) for i in range(size)]
        needles = [(f"g{i % 3}", f"c{i * 7}", *hay[rng.randrange(size)][3:]) for i in range(50)]
        h = spark.createDataFrame(hay, "hid int, g string, code string, f string, l string")
        n = spark.createDataFrame(needles, "g string, code string, f string, l string")
        chances = linkage.name_calibration(h, "f", "l", "hid", 1.5)
        seen, plain = [], linkage._candidates
        try:
            linkage._candidates = lambda *a: seen.append(plain(*a)) or seen[-1]
            got = linkage.find_matches(n, h, {"g": 1.0}, {"code": 1.0}, ("f", "l"), 1.5, "hid", chances[18] * 1.001, 10_000, ["hid"])
        finally:
            linkage._candidates = plain
        assert got.count() >= 50 and seen[0].count() < 50 * size / 10


def test_pairs_behind_the_best_ones_make_no_candidates(spark, monkeypatch):
    """Two rows that share all columns with a needle leave rows that share one column no chance; none of the best is lost."""
    rng = random.Random(4)
    hay = [(i, f"g{i % 4}", f"b{i // 4 % 5}", f"Customer#{i:09d}", f"x{i}") for i in range(400)]
    needles = [(f"g{i % 4}", f"b{rng.randrange(5)}", f"Customer#{rng.randrange(400):09d}", f"x{i}") for i in range(40)]
    h = spark.createDataFrame(hay, "hid int, g string, b string, f string, l string")
    n = spark.createDataFrame(needles, "g string, b string, f string, l string")
    args = ({"g": 4.0, "b": 4.0}, {}, ("f", "l"), 1.0, "hid", 0.05)
    seen, plain = [], linkage._candidates
    monkeypatch.setattr(linkage, "_candidates", lambda *a: seen.append(plain(*a)) or seen[-1])
    best = linkage.find_matches(n, h, *args, 2, ["hid"]).collect()
    assert sum(s.count() for s in seen if s is not None) < 40 * 400 / 8
    every = linkage.find_matches(n, h, *args, 10 ** 6, ["hid"]).collect()  # so many are wanted that nothing is left out
    key = lambda r: (r["N_g"], r["N_b"], r["N_f"], r["N_l"], r["hid"], round(r["prob"], 14), r["rank"])
    assert sorted(map(key, best)) == sorted(key(r) for r in every if r["rank"] <= 2) and len(every) > 2 * len(best)
