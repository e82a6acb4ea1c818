"""Layouts, files and report assembly on small inputs."""

import random
import re
import pytest
from pyspark.sql import functions as F

from tallyforge import plans, sources
from tallyforge.operators import layout as lo
from tallyforge.operators.predicates import conditional_update, lookup_update, split_by_flag
from tallyforge.plans.student import CUT_KEYS, cut_rows
from tallyforge.queries import QUERIES
from tallyforge.queries.registry import MASTER, STRANDS, STUDENTS

FULL = ["import_order", "start", "end", "type", "min", "max", "nominal_values", "std_code", "variable_name", "description", "comments", "counts_needed"]


def test_layout_rules(spark, rows):
    good = dict.fromkeys(FULL, "")
    data = [
        {**good, "import_order": "1", "start": "1", "end": "4", "type": "integer", "variable_name": "a"},
        {**good, "import_order": "2", "nominal_values": "x", "std_code": "abc"},
        {**good, "import_order": "3", "start": "3", "end": "2", "type": "blob", "variable_name": "bad name"},
        {**good, "import_order": "4", "start": "9", "end": "", "type": "", "variable_name": "x_tmp"},
        {**good, "import_order": "5"},
        {**good, "import_order": "6", "start": "-1", "end": "20", "type": "ID3", "variable_name": "bad_" + "v" * 28},
        {**good, "import_order": "7", "start": "30", "end": "31", "type": "NOMINAL_ID1", "variable_name": "a"},
    ]
    df = spark.createDataFrame([tuple(d[c] for c in FULL) for d in data], FULL)
    got = {(r[0], r[1]) for r in rows(lo.check_layout(df))}
    assert got == {("overlaps next", 1), ("duplicate name", 1), ("code not numeric", 2), ("name has a space", 3), ("start after end", 3), ("unknown type", 3),
                   ("name ends with _tmp", 4), ("start without end", 4), ("type missing", 4), ("blank row", 5), ("name too long", 6), ("name starts with bad_", 6),
                   ("negative start", 6), ("duplicate name", 7)}
    with pytest.raises(ValueError, match="required columns"):
        lo.check_layout(df.drop("comments"))


@pytest.mark.parametrize("row", [
    {"varname": "1a", "type": "int"}, {"varname": "a", "type": "blob"}, {"varname": "a", "type": "char"}, {"varname": "a", "type": "num", "length": 4},
    {"varname": "a", "type": "int", "min": "x"}, {"varname": "a", "type": "int", "start": 1, "end": None}])
def test_layout_row_errors(row):
    with pytest.raises(ValueError):
        lo.read_layout_rows([row])


def test_values_and_types(spark, rows):
    df = spark.createDataFrame([(1, "12", "abcdef", "12312011"), (2, "x", ".", ""), (3, "99", None, "99999999")], "line_number int, n string, t string, d string")
    layout = [{"varname": "n", "type": "int", "min": 5, "max": 50}, {"varname": "t", "type": "char", "length": 3, "regex": "a"}, {"varname": "d", "type": "datetime", "informat": "mmddyy8."}]
    assert rows(lo.check_values(df, layout), "line_number", "variable", "point_of_failure") == [(2, "t", "Regular Expression"), (3, "n", "Max value check")]
    typed = lo.apply_layout_types(df, layout)
    assert [(r["n"], r["t"], str(r["d"])[:10]) for r in typed.data.orderBy("line_number").collect()] == [(12, "abc", "2011-12-31"), (None, None, "None"), (99, None, "None")]
    assert rows(typed.errors, "line_number", "variable") == [(2, "n"), (3, "d")]


def test_item_families(spark, rows):
    names = ["id", "upmx_raw_item_1", "upmx_raw_item_2", "upmx_gap_item_2", "upmx_key_item_1", "upmx_key_item_2", "pos", "sc"]
    assert lo.detect_item_columns(names, r"[u][pcf][m]x_.*{icnt}.*") == {"upmx_raw_item": names[1:3], "upmx_key_item": names[4:6]}
    df = spark.createDataFrame([(7, "a", "b", "", "k1", "k2", "2", "9")], names)
    split = lo.flat_item_split(df, "id", {"m": r"upmx_.*{icnt}"}, {"m": (["pos"], {"score": ["sc"]})})
    assert split.flat.columns == ["id", "upmx_gap_item_2"]
    assert rows(split.items["m"]) == [(7, 1, "a", "k1", " "), (7, 2, "b", "k2", "9")]


def test_fixed_width_round_trip(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, "Ann", None, "7"), (22, "Bobby-long", "x", None)], "num int, name string, note string, dob string")
    layout = [{"start": 1, "end": 3, "length": 3, "name": "num", "type": "numeric"}, {"start": 5, "end": 9, "length": 5, "name": "name", "type": "alphanum"},
              {"start": 10, "end": 11, "length": 2, "name": "filler", "type": ""}, {"start": 12, "end": 13, "length": 2, "name": "note", "type": "alpha"},
              {"start": 14, "end": 15, "length": 2, "name": "dob", "type": "numeric"}]
    path = str(tmp_path / "out")
    sources.export_fixed_width(df, path, layout, zero_padded=["dob"])
    assert rows(spark.read.text(path)) == [("  1 Ann      07",), (" 22 Bobby  x  .",)]
    back = sources.read_fixed_width(spark, path, layout)
    assert rows(back.data, "num", "name", "note", "dob") == [("1", "Ann", None, "07"), ("22", "Bobby", "x", None)]
    assert back.errors.count() == 0
    with pytest.raises(ValueError, match="end - start"):
        sources.export_fixed_width(df, path, [{**layout[0], "length": 4}])


def test_delimited_by_name(spark, tmp_path, rows):
    path = tmp_path / "in.csv"
    path.write_text('﻿b,a,zzz\n"x, y",1,q\n\'k\',.,q,more\n,2,q\n', encoding="utf-8")
    out = sources.read_delimited(spark, str(path), [{"varname": "a"}, {"varname": "B"}])
    assert rows(out.data) == sorted([(2, "1", "x, y"), (3, None, "k"), (4, "2", None)], key=repr)
    assert rows(out.errors, "line_number", "point_of_failure") == [(1, "Variable Not Found In Layout"), (3, "More columns than specified in layout")]
    with pytest.raises(ValueError, match="not all variables"):
        sources.read_delimited(spark, str(path), [{"varname": "a"}, {"varname": "c"}])
    latin = tmp_path / "latin.txt"
    latin.write_bytes("a\nJosé\n".encode("latin-1"))
    assert rows(sources.read_delimited(spark, str(latin), [{"varname": "a"}], encoding="ISO-8859-1").data) == [(2, "José")]


def test_line_numbers_over_many_splits(spark, tmp_path):
    path = tmp_path / "big.txt"
    path.write_text("".join(f"row{i:06d}\n" for i in range(1, 20001)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lines = sources.numbered_lines(spark, str(path))
        assert lines.rdd.getNumPartitions() >= 1
        assert lines.where(F.substring("value", 4, 6).cast("int") != F.col("line_number")).count() == 0 and lines.count() == 20000
        ordered = sources.add_import_order(spark.read.text(str(path)), "n")
        assert ordered.where(F.substring("value", 4, 6).cast("int") != F.col("n")).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_text_in_many_parts_has_one_header(spark, tmp_path, rows):
    """Sorted rows are written as several files, of which the first alone begins with the names."""
    folder = tmp_path / "text"
    folder.mkdir()
    for i, part in enumerate(["a,zzz,b\n1,q,x\n", "2,q,y\n3,q,z,more\n", "", "4,q,w\n"]):
        (folder / f"part-{i:05d}.txt").write_text(part)
    out = sources.read_delimited(spark, str(folder), [{"varname": "b"}, {"varname": "a"}], one_text=True)
    assert rows(out.data) == [(2, "x", "1"), (3, "y", "2"), (4, "z", "3"), (5, "w", "4")]
    assert rows(out.errors, "line_number", "variable") == sorted([(1, "zzz"), (4, None)], key=repr)
    fixed = sources.read_fixed_width(spark, str(folder), [{"varname": "a", "length": 1}, {"varname": "b", "start": 5, "end": 6}], one_text=True)
    assert rows(fixed.data, "line_number", "a") == [(i, c) for i, c in enumerate("a1234", start=1)]
    assert rows(fixed.errors, "line_number") == [(2,), (3,), (5,)]


@pytest.mark.parametrize("name", ["read_delimited", "read_delimited_errors", "read_fixed_width"])
def test_file_queries_number_all_parts(spark, tmp_path, name):
    customer = [(i, f"Customer#{i}", i % 5, float(i), "BUILDING") for i in range(60)]
    spark.createDataFrame(customer, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(
        str(tmp_path / "customer.parquet"))
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")  # sorted rows stay in several partitions, as those of a large table do
    try:
        out = QUERIES[name](spark, str(tmp_path)).collect()
    finally:
        spark.conf.set(setting, before)
    numbers = sorted(r["line_number"] for r in out)
    wanted = {"read_delimited": range(2, 62), "read_delimited_errors": [1, *range(2, 62, 7)], "read_fixed_width": range(1, 61)}
    assert numbers == list(wanted[name])


def test_inference_and_exports(spark, tmp_path, rows):
    df = spark.createDataFrame([("1", "300", "1.5", "2011-01-02", "x", "3.0"), ("200", "-1", "", None, "4", "9")], "a string, b string, c string, d string, e string, f string")
    guess, typed = sources.infer_column_types(df)
    assert [guess[c].kind for c in "abcdef"] == ["tinyint", "smallint", "float", "datetime", "nvarchar", "tinyint"]
    assert [t for _, t in typed.dtypes] == ["smallint", "smallint", "double", "timestamp", "string", "smallint"]
    path = str(tmp_path / "o.csv")
    assert sources.export_delimited(df, path, columns=["a", "c"], where="a = '1'") == 1
    with pytest.raises(Exception):
        sources.export_delimited(df, path, replace=False)
    for bad in ({"path": str(tmp_path / "o.xyz")}, {"path": path, "dbms": "csv", "delimiter": ";"}):
        with pytest.raises(ValueError):
            sources.export_delimited(df, **bad)
    with pytest.raises(ValueError, match="exclude"):
        sources.copy_dataset(df, {"a": "z"}, "id")
    (tmp_path / "n.cty").write_text("k\tint\nv\tvarchar(3)\n")
    (tmp_path / "n.tsv").write_text("1\tabc\n")
    out = sources.read_typed_pair(spark, str(tmp_path / "n.tsv"), str(tmp_path / "n.cty"), overrides={"K": "float"})
    assert rows(out) == [(1.0, "abc")]
    with pytest.raises(ValueError, match="unknown columns"):
        sources.read_typed_pair(spark, str(tmp_path / "n.tsv"), str(tmp_path / "n.cty"), overrides={"q": "float"})


def test_updates_see_earlier_rules(spark, rows):
    df = spark.createDataFrame([(1, "a", None), (2, "b", "z")], "k int, s string, t string")
    out = conditional_update(df, [("s = 'a'", {"s": F.lit("b")}), ("s = 'b'", {"t": F.col("s")})])
    assert rows(out) == [(1, "b", "b"), (2, "b", "b")]
    assert [p.count() for p in split_by_flag(df, "t = 'z'")] == [1, 1]
    dim = spark.createDataFrame([(2, "new")], "d int, v string")
    assert rows(lookup_update(df, dim, {"k": "d"}, {"s": "m_v"})) == [(1, "a", None), (2, "new", "z")]


@pytest.fixture(scope="module")
def students(spark):
    return spark.read.parquet("/root/testdata/sf0.001/customer.parquet").selectExpr(*[f"{e} AS `{n}`" for n, e in STUDENTS.items()])


def test_student_rows(students):
    out = plans.student_derivations(students, STRANDS)
    assert out.where("schtype = 'H'").count() == 0
    doubled = plans.home_district_rows(out)
    assert doubled.count() == out.count() + out.where("dcrxid_home <> ''").count()
    dummy = doubled.where("dummy_record_flag = '1'")
    assert dummy.where("stateinclusionflag <> '0' OR dcrxid <> dcrxid_home OR bcrxid_attend <> ''").count() == 0
    special, rest = plans.split_special_schools(students)
    assert special.count() + rest.count() == students.count()
    cuts = plans.reporting_cuts(doubled)
    tables = plans.report_tables(cuts["district"], cuts["state"], cuts["school"], cuts["school_intervention"], doubled)
    assert len(tables) == 13 and all(t.limit(1).count() <= 1 for t in tables.values())


def test_intake_outputs(spark, students):
    master = spark.read.parquet("/root/testdata/sf0.001/supplier.parquet").selectExpr(*[f"{e} AS `{n}`" for n, e in MASTER.items()])
    sheet = [{"variable": "ethnicity", "by": "(all)", "treatas": "nominal", "matchalgorithm": "proportion", "tolerance": 0, "tolerancetype": "absolute",
              "missing_counted": "yes", "max_bad": 2}]
    items = students.select(F.col("id").alias("flat_table_id"), F.lit(1).alias("id"), F.lit("2").alias("uprx_finalraw_item"), F.lit("0").alias("uprx_score_item"))
    key = spark.createDataFrame([("a", 1, "2", "1"), ("b", 1, "3", "1")], "form_id string, item_id int, numeric_key string, point_value string")
    out = plans.intake_pipeline(students, master, [{"checktype": "UniqueKey", "variable": "lithocode"}], students, sheet, {"r": items}, {"r": key})
    assert out.corrected.intake.count() == students.count() and out.id_failures.count() == 0
    assert out.longitudinal.count() == 2
    # form A keys the answer, so its zero scores are wrong; form B does not
    assert out.rescore[("r", "regular")].report.count() == out.corrected.intake.where("form_r = 'A'").count()
    assert out.rescore[("r", "breach")].report.count() == 0
    assert out.corrected.home_districts.count() == students.count() + out.corrected.intake.where("trim(dcrxid_home) <> ''").count()


def test_ids(spark, rows):
    data = [(9, "d1", "b1", "Zed", "alg", None), (9, "d1", "b1", " Zed ", "alg", ""), (9, None, "b1", None, "", None), (10, "d1", "b1", "- -  Ann", "", "2"), (9, "d1", "b1", "", "alg", "")]
    df = spark.createDataFrame(data, "grade int, dcrxid_attend string, bcrxid_attend string, t string, c string, n string")
    out = plans.generate_ids(df, {"m": ("t", "c", "n")}, "0101", prefix="Q")
    assert rows(out, "mlabel", "mteacher_id", "imxnm", "mclass_id") == sorted([
        ("Zed", "Q0101T090000001", "Zed - alg", "Q0101Cm09000002"), ("Zed", "Q0101T090000001", "Zed - alg", "Q0101Cm09000002"),
        ("NO NAME", None, "CLASS ASSIGNMENT UNKNOWN", None), ("- Ann", "Q0101T100000002", "- Ann - 2", "Q0101Cm10000003"),
        ("NO NAME", None, "NO NAME - alg", "Q0101Cm09000001")], key=repr)


def test_every_query_has_a_plan():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 120
    own = {q for q in entry.queries() if q != "pipeline" and not re.match(r"op\d+_", q)}
    assert own <= set(entry.oracle_sql())


@pytest.mark.parametrize("order", [("lithocode", "dummy_record_flag"), ("at", "lithocode"), ("score", "at")])
def test_first_rows_of_cuts_are_found_without_sorting_all_students(spark, order):
    rng = random.Random(5)
    codes = ["", None, "a", "a\0", "\u00e9t\u00e9", "z", *[f"common-prefix-of-ids-{rng.randrange(10 ** 6)}" for _ in range(30)]]
    data = [(rng.choice(["10_1", "10_2", "11_1", None]), rng.choice(codes), rng.choice("01"), rng.choice([None, -5, 0, 2 ** 60, 7 + i]), rng.random(),
             rng.choice(["J", "H", None]), rng.choice(["", "s1", "s2"]), i) for i in range(400)]
    names = [c for c in dict.fromkeys(c for keys in CUT_KEYS.values() for c in keys) if c not in ("g_dcrxid", "schtype", "bcrxid")]
    df = spark.createDataFrame(data, "g_dcrxid string, lithocode string, dummy_record_flag string, at long, score double, schtype string, bcrxid string, i int").withColumns(
        {**{c: F.lit(c) for c in names}, "dcrxid": F.col("i").cast("string"), "dcrxnm": F.concat(F.lit("n"), "i")})
    cuts = cut_rows(df, order).where("cut = 'district'")
    got = sorted(((r["g_dcrxid"], r["dcrxid"], r["dcrxnm"]) for r in cuts.collect()), key=repr)
    at = [("lithocode", "dummy_record_flag", "at", "score").index(c) + 1 for c in order]
    place = lambda r: tuple((r[k] is not None, r[k].encode() if isinstance(r[k], str) else r[k] or 0) for k in at)
    assert [g for g, _, _ in got] == sorted({r[0] for r in data}, key=repr)
    for g, i, name in got:
        assert name == f"n{i}" and place(data[int(i)]) == min(place(r) for r in data if r[0] == g)
    if order[0] != "score":  # sorted aggregates see only the rows that a join has left
        lines = cut_rows(df, order)._jdf.queryExecution().executedPlan().toString().splitlines()
        depth = [len(re.match(r"[\s:+|-]*", x)[0]) for x in lines]
        for k, line in enumerate(lines):
            if "SortAggregate" in line:
                below = [lines[j] for j in range(k + 1, len(lines)) if all(d > depth[k] for d in depth[k + 1:j + 1])]
                assert any("Join" in x for x in below)
