"""Keyed merge over its whole option matrix, against a plain model."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from tallyforge.operators.merge import MergeField, attach_dimension, keyed_merge, missing_from_dimension, read_merge_spec, sas_merge
from tallyforge.operators.skew import grid_join, hot_on_either, join_on_keys

FIELDS = [MergeField("k", "k", "k", "L"), MergeField("code", "code", "code", "LN"), MergeField("num", "num", "num", "R"),
          MergeField("a", "a", None, "LO"), MergeField("b", None, "b", "RO")]
LEFT = "lid long, k string, gender string, last string, first string, code string, num double, a string"
RIGHT = "rid long, k string, gender string, last string, first string, code string, num double, b string"


def table(seed, n, base):
    r = random.Random(seed)
    names = [("Smith", "Ann"), ("Ann", "Smith"), ("Smyth", "Ann"), ("Jones", None), ("Lee", "Bo")]
    out = []
    for i in range(n):
        last, first = r.choice(names)
        out.append((base + i, r.choice([None, "", *"abcdefghijkl"]), r.choice([None, "", "1", "2"]), last, first, r.choice([None, "", "x", "y"]),
                    r.choice([None, 1.0, 2.0]), f"v{i}"))
    return out


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def similarity(l1, f1, l2, f2):
    l1, f1, l2, f2 = (("NULL" if v is None else v.strip().upper()) for v in (l1, f1, l2, f2))
    a, x, b = f"{l1} {f1}", f"{f1} {l1}", f"{l2} {f2}"
    return 1 - min(distance(a, b), distance(x, b)) / max(len(a), len(b))


def model(left, right, dups_left, dups_right, dups_both):
    count = lambda t, k: sum(1 for r in t if r[1] == k)

    def rejected(own, other, k, allowed):
        if k is None:
            return True
        if count(own, k) > 1 and not allowed:
            return True
        return dups_left and dups_right and not dups_both and count(own, k) > 1 and count(other, k) > 1

    lefts = [r for r in left if not rejected(left, right, r[1], dups_left)]
    rights = [r for r in right if not rejected(right, left, r[1], dups_right)]
    good, bad = [], []
    for l, r in itertools.product(lefts, rights):
        if l[1] != r[1]:
            continue
        mismatch = l[2] is not None and r[2] is not None and l[2] != r[2]
        (bad if mismatch or similarity(l[3], l[4], r[3], r[4]) <= 0.8 else good).append((l, r))
    left_out = [r for r in left if r not in lefts] + [l for l in lefts if not any(l[1] == r[1] for r in rights)] + [l for l, _ in bad]
    right_out = [r for r in right if r not in rights] + [r for r in rights if not any(l[1] == r[1] for l in lefts)] + [r for _, r in bad]
    return good, left_out, right_out


@pytest.fixture(scope="module")
def sides(spark):
    left, right = table(3, 22, 1), table(4, 20, 101)
    return left, right, spark.createDataFrame(left, LEFT).cache(), spark.createDataFrame(right, RIGHT).cache()


MATRIX = [(a, b, c, j) for a, b, c in [(False, False, False), (True, False, False), (False, True, False), (True, True, False), (True, True, True)]
          for j in (("I", "F") if a == b else ("L", "R"))]


@pytest.mark.parametrize("dups_left,dups_right,dups_both,join", MATRIX)
def test_option_matrix(sides, dups_left, dups_right, dups_both, join):
    left, right, l, r = sides
    good, left_out, right_out = model(left, right, dups_left, dups_right, dups_both)
    result = keyed_merge(l, r, "lid", "rid", ["k"], ["gender"], [["last", "first"]], 0.8, FIELDS, join, dups_left, dups_right, dups_both)
    got = sorted((x["fk_left"] or 0, x["fk_right"] or 0) for x in result.output.collect())
    wanted = [(a[0], b[0]) for a, b in good]
    if join in "LF":
        wanted += [(a[0], 0) for a in left if a[0] not in {x[0] for x, _ in good}]
    if join in "RF":
        wanted += [(0, b[0]) for b in right if b[0] not in {y[0] for _, y in good}]
    assert got == sorted(wanted)
    if result.left_remainder is not None:
        assert sorted(x[0] for x in result.left_remainder.select("fk_left").collect()) == sorted(x[0] for x in left_out)
    if result.right_remainder is not None:
        assert sorted(x[0] for x in result.right_remainder.select("fk_right").collect()) == sorted(x[0] for x in right_out)


def test_hot_keys_take_another_way_to_the_same_rows(sides):
    _, _, l, r = sides
    args = (l, r, "lid", "rid", ["k"], ["gender"], [["last", "first"]], 0.8, FIELDS, "I", True, True, True)
    plain, split = keyed_merge(*args), keyed_merge(*args, hot_rows=1)
    for a, b in ((plain.output, split.output), (plain.left_remainder, split.left_remainder)):
        assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def test_a_key_hot_on_both_sides_is_spread_over_a_grid(spark):
    left = spark.range(2000).selectExpr("IF(id < 1800, 'hot', concat('k', id)) AS k", "id AS a")
    right = spark.range(600).selectExpr("IF(id < 500, 'hot', concat('k', 1500 + id)) AS k", "id AS b")
    hot = hot_on_either(left, right, ["k"], 100)
    assert [tuple(r) for r in hot.collect()] == [("hot", 1800, 500)]
    met = grid_join(left, right, ["k"], hot, 100)
    assert met.count() == met.distinct().count() == 1800 * 500
    cells = join_on_keys(left, right, ["k"], hot, 100)
    assert cells.where("k <> 'hot'").count() == 0 and cells.count() == left.join(right, "k").count()
    # 18 x 5 cells of about 100 rows a side: no cell has much more than its share of the pairs
    lines = left.where("k = 'hot'").groupBy(F.pmod(F.xxhash64("k", "a"), F.lit(18))).count().agg(F.max("count")).first()[0]
    assert lines < 160
    for keys in (("k",), ("k", "k2")):
        l, r = (df.withColumn("k2", F.lit(1)).withColumn("n", F.lit(s)) for df, s in ((left, "l"), (right, "r")))
        l = l.unionByName(spark.createDataFrame([("lonely", i, 1, "l") for i in range(150)], l.schema))
        r = r.unionByName(spark.createDataFrame([("other", i, 1, "r") for i in range(150)], r.schema))
        plain, split = (sas_merge(l, r, list(keys), hot_rows=h) for h in (10**6, 100))
        assert split.groupBy("k", "n").agg(F.count("*"), F.sum("a"), F.sum("b")).exceptAll(
            plain.groupBy("k", "n").agg(F.count("*"), F.sum("a"), F.sum("b"))).isEmpty() and plain.count() == split.count()


def test_meld_priorities_and_reasons(spark):
    l = spark.createDataFrame([(1, "a", "1", "", 5.0), (2, None, "1", "x", 5.0), (3, "c", "1", "x", 5.0)], "id long, k string, g string, code string, num double")
    r = spark.createDataFrame([(9, "a", None, "R", 6.0), (8, "c", "", "R", 6.0)], "id long, k string, g string, code string, num double")
    fields = [MergeField("code", "code", "code", "LN"), MergeField("num", "num", "num", "RN")]
    out = keyed_merge(l, r, "id", "id", ["k"], ["g"], fields=fields)
    assert [tuple(x) for x in out.output.collect()] == [(1, 9, "R", 6.0)]
    # an empty text is a value, so it differs from '1'
    reasons = {x["fk_left"]: x["merge_report"] for x in out.left_remainder.collect()}
    assert reasons == {2: "Missing required key on left", 3: 'Optional key mismatch ("1" vs "")'}


def test_similarity_at_the_threshold_is_rejected(spark):
    l = spark.createDataFrame([(1, "a", "ABCDE"), (2, "b", "ABCDE")], "id long, k string, n string")
    r = spark.createDataFrame([(1, "a", "ABCDE"), (2, "b", "ABXYE")], "id long, k string, n string")
    # 'ABCDE NULL' against 'ABXYE NULL': two of ten characters differ
    out = keyed_merge(l, r, "id", "id", ["k"], [], ["n"], 0.8, [MergeField("n", "n", "n", "L")])
    assert [x["fk_left"] for x in out.output.collect()] == [1]
    assert "Fuzzy key mismatch" in out.left_remainder.first()["merge_report"]


def spec(*rows):
    return [dict(zip(("variable name", "newname", "priority", "keys"), r)) for r in rows]


def test_merge_spec_errors(spark):
    left = spark.createDataFrame([(1, "x")], "k long, v string")
    right = spark.createDataFrame([(1, "x")], "k long, v string")
    good = spec(("k", "<same>", "first", "primary1"), ("v", "<same>", "second", ""))
    other = spec(("k", "<same>", "second", "required1"), ("v", "<same>", "first non-missing", ""))
    out = read_merge_spec(good, other, left, right)
    assert [f.priority for f in out.fields] == ["L", "RN"] and out.required == [("k", "k")]
    for bad in (spec(("k", "", "first", "primary1")), spec(("k", "", "first", "prime1"), ("v", "", "second", "")),
                spec(("k", "", "third", "primary1"), ("v", "", "second", "")), spec(("k", "z", "first", "primary1"), ("v", "z", "second", "")),
                spec(("k", "", "first", ""), ("v", "", "second", "")), spec(("q", "", "first", "primary1"))):
        with pytest.raises(ValueError):
            read_merge_spec(bad, other, left, right)
    with pytest.raises(ValueError, match="fit together"):
        read_merge_spec(good, spec(("k", "", "first", "primary1"), ("v", "", "first", "")), left, right)


def test_sas_merge_and_dimensions(spark, rows):
    l = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (None, "n", 1)], "k long, name string, x int")
    r = spark.createDataFrame([(2, None, 7), (3, "c", 8), (None, "m", 2)], "k long, name string, y int")
    assert rows(sas_merge(l, r, ["k"])) == sorted([(1, "a", 10, None), (2, None, 20, 7), (3, "c", None, 8), (None, "n", 1, None), (None, "m", None, 2)], key=repr)
    assert rows(sas_merge(l, r.union(r), ["k"], hot_rows=1)) == rows(sas_merge(l, r.union(r), ["k"]))
    with pytest.raises(ValueError):
        sas_merge(l, r, ["k"], keep=["k"], drop=["x"])
    dim = spark.createDataFrame([(1, "p"), (1, "q")], "d long, county string")
    base = spark.createDataFrame([(1, ""), (1, "own"), (5, None)], "k long, county string")
    out = attach_dimension(base, dim, {"k": "d"}, {"other": "county"}, ["county"], {"county": "county"})
    assert rows(out) == sorted([(1, "p", "p"), (1, "own", "p"), (5, None, None)], key=repr)
    nulls = spark.createDataFrame([(None, "z")], "d long, county string")
    assert missing_from_dimension(base, nulls, {"k": "d"}).count() == 3
