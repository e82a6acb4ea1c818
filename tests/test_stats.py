"""Statistics against numpy and small hand-made groups."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.operators.cascade import cascade, regression_residual_t
from tallyforge.operators.longitudinal import longitudinal_compare
from tallyforge.operators.predicates import spec_predicate
from tallyforge.operators.quantiles import exact_group_quantiles, order_key
from tallyforge.operators.skew import number_rows
from tallyforge.operators.stats import distinct_cut, frequency_distribution, group_stats, student_t_critical, student_t_tails
from tallyforge.operators.ttest import ttest, ttest_level
from tallyforge.operators.windows import neighbor_overlap, running_total


def sheet(kinds, where="", value="", level="g"):
    return [{"variable_name": k.lower(), "levelvar": level, "inputvar": "x", "wherevar": where, "wherevalue": value, "type": k, "rdvalue": None} for k in kinds]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(1)
    rows = [(f"g{i % 5}", float(rng.normal(10, 4)), int(i % 2), "Yes" if i % 3 else "no ") for i in range(200)]
    rows += [("g0", None, 1, "Yes"), ("one", 3.0, 1, "Yes"), ("none", 3.0, 0, "Yes"), ("gap", None, 1, "Yes"), (None, 9.0, 1, "Yes")]
    return rows, spark.createDataFrame(rows, "g string, x double, flag int, word string").cache()


def test_all_statistics(data):
    rows, df = data
    kinds = ["N", "MEAN", "SUM", "NMISS", "STD", "VAR", "SKEW", "KURT", "STDERR", "MEDIAN", "Q1", "P90", "QRANGE", "RANGE", "CSS", "LCLM", "UCLM"]
    got = {r["g"]: r.asDict() for r in group_stats(df, sheet(kinds, "flag", "1"))["g"].collect()}
    assert None not in got and set(got) == {"g0", "g1", "g2", "g3", "g4", "one", "none", "gap"}
    for g, r in got.items():
        picked = [x for k, x, f, _ in rows if k == g and f == 1]
        x = np.array([v for v in picked if v is not None])
        total, n = len(picked), len(x)
        assert (r["n"], r["nmiss"]) == (total, total - n)
        if n == 0:
            assert r["median"] is None and r["stderr"] is None
            continue
        assert r["mean"] == pytest.approx(x.sum() / total) and r["sum"] == pytest.approx(x.sum())
        if n < 2:
            assert r["std"] is None
            continue
        spread = abs((x @ x) - x.sum() ** 2 / total) / (total - 1)
        assert r["std"] == pytest.approx(np.sqrt(spread)) and r["var"] == pytest.approx(spread)
        d = x - x.mean()
        assert r["skew"] == pytest.approx((d**3).mean() / x.std(ddof=1) ** 3)
        assert r["kurt"] == pytest.approx((d**4).mean() / x.std(ddof=1) ** 4 - 3)
        assert r["stderr"] == pytest.approx(x.std(ddof=1) / np.sqrt(n))
        assert r["q1"] == pytest.approx(np.quantile(x, 0.25)) and r["p90"] == pytest.approx(np.quantile(x, 0.9))
        half = student_t_critical(n - 1, 0.05) * x.std(ddof=1) / np.sqrt(n)
        assert r["uclm"] == pytest.approx(x.mean() + half) and r["lclm"] == pytest.approx(x.mean() - half)


def test_filter_by_sheet_is_filter_of_rows(data):
    _, df = data
    a = group_stats(df, sheet(["N", "MEAN", "STD"], "flag*word", "1 YES"))["g"].where("n > 0")
    b = group_stats(df.where("flag = 1 AND word = 'Yes'"), sheet(["N", "MEAN", "STD"]))["g"]
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def test_skip_missing_divides_by_present_values(data):
    rows, df = data
    r = {x["g"]: x["mean"] for x in group_stats(df, sheet(["MEAN"]), missing="skip")["g"].collect()}
    assert r["g0"] == pytest.approx(np.mean([x for g, x, *_ in rows if g == "g0" and x is not None]))


def test_groups_without_values_stay(spark):
    df = spark.createDataFrame([("a", 1.0, 1), ("a", 3.0, 1), ("b", None, 1), ("b", None, 1), ("c", 4.0, 0)], "g string, x double, flag int")
    out = group_stats(df, sheet(["MEDIAN", "QRANGE"], "flag", "1"))["g"]
    assert sorted(map(tuple, out.select("g", "median").collect())) == [("a", 2.0), ("b", None), ("c", None)]


def test_quantiles_under_several_conditions(data):
    rows, df = data
    specs = sheet(["MEDIAN", "P90"], "flag", "1") + [{**s, "variable_name": "all_" + s["variable_name"]} for s in sheet(["MEDIAN", "QRANGE"])]
    got = {r["g"]: r for r in group_stats(df, specs)["g"].collect()}
    for g, r in got.items():
        some = [row[1] for row in rows if row[0] == g and row[1] is not None]
        if not some:
            assert r["all_median"] is None and r["all_qrange"] is None
            continue
        assert r["all_median"] == pytest.approx(np.quantile(some, 0.5)) and r["all_qrange"] == pytest.approx(np.subtract(*np.quantile(some, [0.75, 0.25])))
    plain = {r["g"]: r for r in group_stats(df.where("flag = 1"), sheet(["MEDIAN", "P90"]))["g"].collect()}
    assert {g: (r["median"], r["p90"]) for g, r in got.items() if r["median"] is not None} == {g: (r["median"], r["p90"]) for g, r in plain.items() if r["median"] is not None}


def test_order_keys_never_fall(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.normal(size=300) * 10.0 ** rng.integers(-300, 300, 300), 2.0 ** np.arange(-1074, 1024, 7), np.nextafter(2.0 ** np.arange(-60, 60), 0),
                             [0.0, -0.0, 5e-324, 1.7976931348623157e308, np.inf, -np.inf, 1, 3, 1 + 2**-52]])
    values = np.concatenate([values, -values])
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = [r["k"] for r in df.select("x", order_key(F.col("x")).alias("k")).orderBy("x").collect()]
    assert got == sorted(got) and len(set(got)) > 800


def test_quantiles_of_values_far_apart_and_close_by(spark):
    rng = np.random.default_rng(5)
    groups = {"wide": rng.normal(size=301) * 10.0 ** rng.integers(-30, 30, 301), "near": 1e6 + np.arange(500) * 1e-9, "ends": np.array([-np.inf, -1.0, 0.0, 2.0, np.inf]),
              "ties": np.repeat([1.0, -2.0, 1e300], [50, 3, 7]), "one": np.array([7.5])}
    df = spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs], "g string, x double").repartition(5)
    probabilities = [0.0, 0.01, 0.25, 0.5, 0.77, 1.0]
    for r in exact_group_quantiles(df, ["g"], F.col("x"), probabilities).collect():
        with np.errstate(invalid="ignore"):
            want = np.quantile(groups[r["g"]], probabilities)
        for got, w in zip(r[1:], want):
            assert got == pytest.approx(w, rel=1e-12) or (r["g"] == "ends" and not np.isfinite(w))


def test_running_totals_over_missing_values(spark):
    rows = [(i % 2, i, None if i % 3 == 0 or i < 7 else i) for i in range(60)] + [(5, 1, None), (5, 2, None)]
    df = spark.createDataFrame(rows, "g int, o int, v int")
    plain, ranges = (running_total(df, "v", ["g"], ["o"], group_rows_limit=n) for n in (1000, 1))
    assert sorted(map(tuple, plain.collect()), key=repr) == sorted(map(tuple, ranges.collect()), key=repr)


def test_quantiles_of_one_repeated_value(spark):
    df = spark.createDataFrame([("a", 5.0)] * 50 + [("a", 7.0)] * 50 + [("b", None)], "g string, x double")
    out = exact_group_quantiles(df, ["g"], F.col("x"), [0.5, 0.25, 1.0]).collect()
    assert [tuple(r) for r in out] == [("a", 6.0, 5.0, 7.0)]


@pytest.mark.parametrize("row,error", [
    ({"type": "MODE"}, ValueError), ({"rdvalue": -1}, ValueError),
    ({"wherevar": "flag", "wherevalue": "1 2"}, ValueError), ({"variable_name": "1bad"}, ValueError), ({"inputvar": "nope"}, ValueError)])
def test_sheet_errors(data, row, error):
    with pytest.raises(error):
        group_stats(data[1], [{**sheet(["MEAN"])[0], **row}])


def test_rounding_and_duplicates(data):
    with pytest.raises(ValueError, match="twice"):
        group_stats(data[1], sheet(["MEAN", "MEAN"]))
    r = group_stats(data[1], [{**sheet(["MEAN"])[0], "rdvalue": 1}])["g"].first()["mean"]
    assert r == round(r, 1)


def test_predicate_ignores_case_and_trailing_blanks(data):
    _, df = data
    assert df.where(spec_predicate(df, "word", "NO")).count() == 67
    assert df.where(spec_predicate(df, "", None)).count() == df.count()


def test_ttest_edges(spark):
    rows = [("p1", "t1", 1.0), ("p1", "t1", 2.0), ("p1", "t2", 9.0), ("p1", "t2", 10.0), ("p1", "t3", 5.0), ("p2", "u", 3.0), ("p2", "u", 4.0),
            ("p3", "v", 1.0), ("p3", "w", 2.0), ("p4", "z1", 5.0), ("p4", "z2", 5.0), ("p4", "z3", 7.0)]
    df = spark.createDataFrame(rows, "p string, t string, x double")
    got = {r["t"]: r for r in ttest_level(df, ["t"], ["p"], "x", "code", 1.28, details=True).collect()}
    for t, r in got.items():
        own = np.array([x for p, k, x in rows if k == t])
        up = np.array([x for p, k, x in rows if p == r["p"]])
        n, m = len(own), len(up)
        num = 0.0 if n == m else max(0.0, up.var() * m - own.var() * n + up.sum() ** 2 / m - own.sum() ** 2 / n - (up.sum() - own.sum()) ** 2 / (m - n))
        se = np.sqrt(num * (m - n) / (m - n - 1)) / m if m - n > 1 else 0.0
        assert r["ttest_se"] == pytest.approx(se, abs=1e-9)
        value = (own.mean() - up.mean()) / se if se > 1e-12 else 0 if m - n <= 1 or own.mean() == up.mean() else 12.8 * np.sign(own.mean() - up.mean())
        agree = int(0.5 + up.mean()) == int(0.5 + own.mean())
        assert r["code"] == (2 if agree else 1 if value < -1.28 else 3 if value > 1.28 else 2), t


def test_ttest_checks(spark):
    two = spark.createDataFrame([("p", "t", 1.0), ("q", "t", 2.0)], "p string, t string, x double")
    with pytest.raises(Exception, match="more than one parent"):
        ttest_level(two, ["t"], ["p"], "x", "code").collect()
    missing = spark.createDataFrame([("p", "t", None), ("p", "s", 2.0)], "p string, t string, x double")
    with pytest.raises(Exception, match="missing input"):
        ttest_level(missing, ["t"], ["p"], "x", "code").collect()
    orphan = spark.createDataFrame([(None, "t", 1.0), ("p", "s", 2.0)], "p string, t string, x double")
    with pytest.raises(Exception, match="no parent"):
        ttest_level(orphan, ["t"], ["p"], "x", "code").collect()
    row = dict(outputvar="o", inputvar="x", targetlevel="t", targetid="t", wheret="", wheret_value="", parentlevel="p", parentid="p", wherep="", wherep_value="", critval=9)
    with pytest.raises(ValueError, match="critical value"):
        ttest(two, [row])


def test_regression_matches_numpy(spark):
    rng = np.random.default_rng(2)
    m = rng.normal(size=(30, 3)) + 5
    m[:, 2] += m[:, 0] * 0.5
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(m)] + [(99, None, 1.0, 1.0)], "g long, a double, b double, c double")
    got = {r["g"]: r for r in regression_residual_t(df, ["a", "b", "c"]).collect()}
    assert 99 not in got
    for y, name in enumerate("abc"):
        x = np.column_stack([np.ones(30), np.delete(m, y, axis=1)])
        beta, *_ = np.linalg.lstsq(x, m[:, y], rcond=None)
        e = m[:, y] - x @ beta
        h = np.diag(x @ np.linalg.inv(x.T @ x) @ x.T)
        t = e / np.sqrt((e @ e) / 27 * (h + 1))
        assert [got[i][f"t_{name}"] for i in range(30)] == pytest.approx(list(t))
    rows = [{"outputvar": "o" + c, "subject": "s", "level": "l", "levelvar": "g", "inputvar": c, "criterion": 1, "wherevar": "", "wherevalue": ""} for c in "abc"]
    assert cascade(df.where("g < 30"), rows)[("l", "s")].count() == 30


def test_longitudinal_blank_levels_and_order(spark):
    a = spark.createDataFrame([("x", "1.0"), ("x", "2"), ("y", None), ("y", "1")], "school string, level string")
    b = spark.createDataFrame([("x", "1"), ("x", "1"), ("y", ""), ("y", "2")], "school string, level string")
    base = {"variable": "level", "treatas": "nominal", "matchalgorithm": "proportion", "tolerance": 0, "missing_counted": "yes", "max_bad": 9}
    out = longitudinal_compare(a, b, [{**base, "by": "(all)", "tolerancetype": "absolute"}, {**base, "by": "school", "tolerancetype": "stat"},
                                      {**base, "by": "(all)", "tolerancetype": "stat", "max_bad": 0}]).collect()
    one = {(r["ByValue"], r["Value"]): r for r in out if r["Comparison"] == 1}
    assert one[("", "1")]["base"] == 50.0 and one[("", "")]["diff"] == 0.0
    assert all(r["Value"] != "" for r in out if r["Comparison"] == 2) and not [r for r in out if r["Comparison"] == 3]
    c = next(r for r in out if r["Comparison"] == 2 and r["ByValue"] == "x" and r["Value"] == "1")
    # 1 of 2 against 2 of 2: -ln( (3/4)^1 (1/4)^1 (3/4)^2 / (1/4) )
    assert c["diff"] == pytest.approx(-np.log(0.75**3 * 0.25 / 0.25))


@pytest.mark.parametrize("change", [{"matchalgorithm": "mean"}, {"treatas": "interval"}, {"tolerancetype": "x"}])
def test_unknown_words_of_a_comparison_sheet(spark, change):
    df = spark.createDataFrame([("1",)], "level string")
    row = {"variable": "level", "by": "(all)", "treatas": "nominal", "matchalgorithm": "proportion", "tolerance": 0,
           "tolerancetype": "absolute", "missing_counted": "yes", "max_bad": 9, **change}
    with pytest.raises(ValueError, match="line 1"):
        longitudinal_compare(df, df, [row])


def test_cuts_numbers_and_frequencies(spark, rows):
    df = spark.createDataFrame([("a", 2, "s"), ("a", 1, "t"), ("b", 1, None)], "k string, o int, v string")
    assert rows(distinct_cut(df, ["k"], ["v"], ["o"])) == [("a", "t"), ("b", None)]
    with pytest.raises(Exception, match="duplicate keys"):
        distinct_cut(df, ["k"], ["v"], ["o"], no_dups=True).collect()
    freq = frequency_distribution(df, "v")
    assert rows(freq, "v", "freq", "cum_freq", "cum_percent_freq") == [("s", 1, 1, 50.0), ("t", 1, 2, 100.0)]
    big = spark.range(500).select((F.col("id") % 3).alias("g"), ((F.col("id") * 37) % 500).alias("o"))
    assert number_rows(big, ["g"], ["o"]).exceptAll(number_rows(big, ["g"], ["o"], group_rows_limit=10)).count() == 0
    assert running_total(big, "o", ["g"], ["o"]).exceptAll(running_total(big, "o", ["g"], ["o"], group_rows_limit=10)).count() == 0
    spans = big.withColumn("e", F.col("o") + F.col("o") % 5)
    near = neighbor_overlap(spans, "o", "e", ["o"], ["g"])
    assert near.count() > 0 and near.exceptAll(neighbor_overlap(spans, "o", "e", ["o"], ["g"], group_rows_limit=10)).count() == 0


def test_tail_areas_of_students_t(spark):
    """At tabulated critical values, at the closed forms of one and two degrees, and near the normal distribution."""
    cases = [(v, student_t_critical(v, p), p) for v in (1, 2, 3, 7, 30, 99, 400) for p in (0.5, 0.05, 1e-4)]
    cases += [(1, 3.0, 1 - 2 / math.pi * math.atan(3.0)), (2, 1.5, 1 - 1.5 / math.sqrt(2 + 1.5 ** 2)), (5, 0.0, 1.0)]
    cases += [(v, t, math.erfc(t / math.sqrt(2))) for v in (10**6, 10**9) for t in (0.3, 1.96, 4.0)]
    df = spark.createDataFrame([(v, s * t, p) for v, t, p in cases for s in (1.0, -1.0)], "v long, t double, p double")
    for r in df.withColumn("got", student_t_tails(F.col("t"), F.col("v"))).collect():
        assert r["got"] == pytest.approx(r["p"], abs=1e-6 if r["v"] >= 10**6 else 1e-10), r
    assert spark.range(1).select(student_t_tails(F.lit(1.0), F.lit(0))).first()[0] is None


def test_two_limits_and_weights(spark):
    rows = [("a", x) for x in (1.0, 2.0, 4.0, None)] + [("b", 5.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    sheet = [{"variable_name": n, "levelvar": "g", "inputvar": "x", "wherevar": "", "wherevalue": "", "type": t, "rdvalue": None}
             for n, t in (("c", "CLM"), ("lo", "LCLM"), ("hi", "UCLM"), ("w", "SUMWGT"), ("p", "PROBT"))]
    got = {r["g"]: r for r in group_stats(df, sheet)["g"].collect()}
    assert (got["a"]["c_lclm"], got["a"]["c_uclm"], got["a"]["w"]) == (got["a"]["lo"], got["a"]["hi"], 3.0)
    assert got["a"]["p"] == pytest.approx(0.1181, abs=1e-3) and got["b"]["p"] is None and got["b"]["w"] == 1.0
