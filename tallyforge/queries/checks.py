"""Id checks, table comparisons, score checks, master list reports."""

from pyspark.sql import functions as F

from ..operators import quality, scoring
from .registry import (
    BOOKMAP_SQL,
    ITEMS,
    ITEMS_SQL,
    MASTER_SQL,
    STUDENTS_SQL,
    Tables,
    bookmap,
    master,
    query,
    rounded,
    students,
)

_IDS = ("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 50 = 0 THEN NULL WHEN o_orderkey % 51 = 0 THEN '' WHEN o_orderkey % 53 = 0 THEN '.' "
        "ELSE cast(o_custkey AS STRING) END AS code, cast(o_orderkey % 14000 AS STRING) AS serial, "
        "CASE WHEN o_orderkey % 4000 = 1 THEN NULL ELSE cast(o_custkey % 40 AS STRING) END AS label, cast(o_custkey AS STRING) AS owner FROM orders")
_NONMISSING = "SELECT 'code' AS bad_variable, code AS bad_value, 'missing ID' AS bad_reason, id, '' AS bad_label FROM d WHERE code IS NULL OR rtrim(code) IN ('', '.')"
_UNIQUE = ("SELECT 'serial' AS bad_variable, serial AS bad_value, 'not unique' AS bad_reason, id, '' AS bad_label FROM d "
           "WHERE serial IN (SELECT serial FROM d GROUP BY serial HAVING count(*) > 1)")
_LABEL = ("SELECT 'owner' AS bad_variable, owner AS bad_value, 'bad label' AS bad_reason, min(id) AS id, label AS bad_label FROM d "
          "WHERE owner IN (SELECT owner FROM (SELECT DISTINCT owner, label FROM d) GROUP BY owner HAVING count(*) > 1) GROUP BY owner, label")


def _ids(t: Tables):
    return t.spark.sql(_IDS.replace("FROM orders", "FROM {o}"), o=t.orders)


@query("check_nonmissing", f"WITH d AS ({_IDS}) {_NONMISSING}")
def check_nonmissing(t: Tables):
    return rounded(quality.check_nonmissing(_ids(t), "code", "id"))


@query("check_unique_key", f"WITH d AS ({_IDS}) {_UNIQUE}")
def check_unique_key(t: Tables):
    return rounded(quality.check_unique_key(_ids(t), "serial", "id"))


@query("check_unique_label", f"WITH d AS ({_IDS}) {_LABEL}")
def check_unique_label(t: Tables):
    return rounded(quality.check_unique_label(_ids(t), "owner", "label", "id"))


@query("id_check", f"WITH d AS ({_IDS}) {_NONMISSING} UNION ALL {_UNIQUE} UNION ALL {_LABEL}")
def id_check(t: Tables):
    sheet = [{"checktype": "NonMissing", "variable": "code", "labelvariable": None}, {"checktype": "UniqueKey", "variable": "serial", "labelvariable": None},
             {"checktype": "UniqueLabel", "variable": "owner", "labelvariable": "label"}]
    return rounded(quality.id_check(_ids(t), sheet))


_CHANGED = ("SELECT o_orderkey, CASE WHEN o_orderkey % 20 = 0 THEN 'Z' WHEN o_orderkey % 21 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus, "
            "CASE WHEN o_orderkey % 30 = 0 THEN o_totalprice * 1.01 ELSE o_totalprice END AS o_totalprice, "
            "concat(o_orderpriority, '  ') AS o_orderpriority FROM orders WHERE o_orderkey % 25 <> 1")
_COMPARE = f"""
WITH a AS (SELECT o_orderkey AS k, o_orderstatus AS s, o_totalprice AS p FROM orders WHERE o_orderkey % 40 <> 2),
b AS (SELECT o_orderkey AS k, o_orderstatus AS s, o_totalprice AS p FROM ({_CHANGED})), j AS (SELECT a.k, a.s AS s1, b.s AS s2, a.p AS p1, b.p AS p2 FROM a JOIN b ON a.k = b.k)"""


def _comparison(t: Tables):
    left = t.orders.where("o_orderkey % 40 <> 2").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    right = t.spark.sql(_CHANGED.replace("FROM orders", "FROM {o}"), o=t.orders)
    return quality.compare_tables(left, right, ["o_orderkey"], tolerance=0.005)


@query("compare_tables", _COMPARE + """
SELECT k AS o_orderkey, 'o_orderstatus' AS variable, s1 AS left_value FROM j WHERE s1 IS DISTINCT FROM s2
UNION ALL SELECT k, 'o_totalprice', NULL FROM j WHERE abs(p1 - p2) / greatest(abs(p1), abs(p2)) >= 0.005""")
def compare_tables(t: Tables):
    rows = _comparison(t).differences
    return rows.select("o_orderkey", "variable", F.when(F.col("variable") == "o_orderstatus", F.col("left_value")).alias("left_value"))


@query("compare_tables_summary", _COMPARE + """
SELECT (SELECT count(*) FROM a) AS rows_left, (SELECT count(*) FROM b) AS rows_right, count(*) AS rows_matched,
  (SELECT count(*) FROM a WHERE k NOT IN (SELECT k FROM b)) AS rows_only_left, (SELECT count(*) FROM b WHERE k NOT IN (SELECT k FROM a)) AS rows_only_right,
  count(*) FILTER (WHERE s1 IS DISTINCT FROM s2 OR abs(p1 - p2) / greatest(abs(p1), abs(p2)) >= 0.005) AS rows_unequal,
  cast(count(*) FILTER (WHERE s1 IS DISTINCT FROM s2) + count(*) FILTER (WHERE abs(p1 - p2) / greatest(abs(p1), abs(p2)) >= 0.005) AS BIGINT) AS values_unequal FROM j""")
def compare_tables_summary(t: Tables):
    return rounded(_comparison(t).summary)


@query("compare_to_specimen", """
SELECT o_orderkey, 'o_totalprice' AS variable FROM orders WHERE o_orderkey % 30 = 0 AND round(o_totalprice * 1.01) <> round(o_totalprice)
UNION ALL SELECT o_orderkey, 'o_orderpriority' FROM orders WHERE left(o_orderpriority, 3) = '1-U'""")
def compare_to_specimen(t: Tables):
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority")
    other = rows.withColumns({
        "o_totalprice": F.when(F.col("o_orderkey") % 30 == 0, F.col("o_totalprice") * 1.01).otherwise(F.col("o_totalprice")),
        "o_orderpriority": F.regexp_replace("o_orderpriority", "^1-U", "1-V")})
    testers = {"o_totalprice": quality.differs_as_integer, "o_orderpriority": quality.differs_truncated(3)}
    return quality.compare_to_specimen(rows, other, ["o_orderkey"], testers).differences.select("o_orderkey", "variable")


_RESCORE = f"""
WITH i AS ({ITEMS_SQL}), k AS (SELECT "item position" AS item, CASE WHEN form_values = 'A' THEN '1' ELSE '2' END AS form, "numeric key" AS key FROM ({BOOKMAP_SQL}) WHERE "item format" = 'MC'),
r AS (SELECT flat_table_id AS test_id, CASE flat_table_id % 3 WHEN 0 THEN '1' WHEN 1 THEN '2' ELSE '9' END AS form_id, id AS item_id,
    CASE WHEN answer IN ('', '-', '*') THEN 99 ELSE answer::INT END AS ans, CASE WHEN score = '' THEN 99 ELSE try_cast(score AS INT) END AS sc FROM i),
j AS (SELECT r.*, key, CASE WHEN key = ans THEN 1 ELSE 0 END AS correct, form_id IN (SELECT form FROM k) AS known FROM r LEFT JOIN k ON form = form_id AND item = item_id)"""


def _rescored(t: Tables):
    rows = t.derived("lineitem", ITEMS).select(
        F.col("flat_table_id").alias("test_id"), F.expr("CASE flat_table_id % 3 WHEN 0 THEN '1' WHEN 1 THEN '2' ELSE '9' END").alias("form_id"),
        F.col("id").alias("item_id"), F.col("answer").alias("finalraw_item"), F.col("score").alias("score_item"))
    key = bookmap(t).where("`item format` = 'MC'").select(
        F.when(F.col("form_values") == "A", "1").otherwise("2").alias("form_id"), F.col("item position").alias("item_id"),
        F.col("numeric key").alias("numeric_key"), F.col("point value").alias("point_value"))
    return scoring.rescore_check(rows, key)


@query("rescore_check", _RESCORE + """
SELECT test_id, item_id, form_id, CASE WHEN sc IS NULL THEN 'score' WHEN NOT known THEN 'form' WHEN key IS NULL THEN 'item' ELSE 'wrong' END AS kind,
  CASE WHEN sc IS NOT NULL AND key IS NOT NULL THEN correct END AS correct_score FROM j WHERE sc IS NULL OR NOT known OR key IS NULL OR sc <> correct""")
def rescore_check(t: Tables):
    m = F.col("message")
    kind = F.when(m.startswith("score_item"), "score").when(m.startswith("form"), "form").when(m.startswith("item"), "item").otherwise("wrong")
    return rounded(_rescored(t).report.select("test_id", "item_id", "form_id", kind.alias("kind"), "correct_score"))


@query("rescore_output", _RESCORE + """
SELECT test_id, form_id, item_id, ans AS finalraw_item, correct AS score_item FROM j WHERE sc IS NOT NULL AND key IS NOT NULL""")
def rescore_output(t: Tables):
    return rounded(_rescored(t).output)


# Conversion: a balance band is the raw score, the table comes from all parts.
_CONVERSION = """
WITH tab AS (SELECT p_size::DOUBLE AS raw, cast(floor(max(p_retailprice)) AS BIGINT)::DOUBLE AS v, (max(p_partkey) % 5)::DOUBLE AS lev FROM part WHERE p_size % 10 <> 4 GROUP BY p_size),
d AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 33 = 0 THEN 'x' ELSE cast(c_custkey % 51 AS VARCHAR) END AS raw_text, (c_custkey % 1000 + 900)::DOUBLE AS scal, (c_custkey % 5)::DOUBLE AS lev FROM customer),
j AS (SELECT d.*, try_cast(raw_text AS DOUBLE) AS rawn, tab.raw AS hit, tab.v AS cv, tab.lev AS cl FROM d LEFT JOIN tab ON try_cast(raw_text AS DOUBLE) = tab.raw)"""


def _converted(t: Tables):
    k = F.col("c_custkey")
    data = t.customer.select(
        k.alias("id"), F.when(k % 33 == 0, "x").otherwise((k % 51).cast("string")).alias("uprxraw"),
        (k % 1000 + 900).cast("double").alias("uprxscal"), (k % 5).cast("double").alias("uprxlev"))
    table = t.part.where("p_size % 10 <> 4").groupBy("p_size").agg(
        F.floor(F.max("p_retailprice")).cast("double").alias("scale"), (F.max("p_partkey") % 5).cast("double").alias("level"))
    table = table.unpivot(["p_size"], ["scale", "level"], "measure", "value").select(
        F.lit("uprxraw").alias("raw_variable"), F.col("p_size").alias("raw_score"), "measure", "value")
    return scoring.score_conversion_check(data, table, {"uprxraw": {"uprxscal": "scale", "uprxlev": "level"}})


@query("score_conversion_check", _CONVERSION + """
SELECT id, raw_text, NULL AS variable, cast(NULL AS DOUBLE) AS correct_value, CASE WHEN rawn IS NULL THEN 'raw score variable uprxraw is not a number' ELSE 'no conversion for uprxraw = ' || cast(rawn AS VARCHAR) END AS message
  FROM j WHERE hit IS NULL
UNION ALL SELECT id, raw_text, 'uprxscal', cv, 'value of uprxscal differs from the conversion table' FROM j WHERE hit IS NOT NULL AND scal <> cv
UNION ALL SELECT id, raw_text, 'uprxlev', cl, 'value of uprxlev differs from the conversion table' FROM j WHERE hit IS NOT NULL AND lev <> cl""")
def score_conversion_check(t: Tables):
    return rounded(_converted(t).report.select("id", "raw_text", "variable", "correct_value", "message"))


@query("score_conversion_output", _CONVERSION + " SELECT id, cv AS uprxscal, cl AS uprxlev FROM j WHERE hit IS NOT NULL")
def score_conversion_output(t: Tables):
    return rounded(scoring.conversion_output_wide(_converted(t), {"uprxraw": {"uprxscal": "scale", "uprxlev": "level"}}))


@query("sum_check", """
WITH d AS (SELECT c_custkey AS id, c_custkey % 7 AS a, CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE c_custkey % 5 END AS b, c_custkey % 7 + c_custkey % 5 + CASE WHEN c_custkey % 31 = 0 THEN 1 ELSE 0 END AS total FROM customer)
SELECT id, total, (a + b)::DOUBLE AS correct_total, CASE WHEN b IS NULL THEN 'not a number: b' ELSE 'total differs from the sum of its parts' END AS message
FROM d WHERE b IS NULL OR total <> a + b""")
def sum_check(t: Tables):
    k = F.col("c_custkey")
    data = t.customer.select(k.alias("id"), (k % 7).alias("a"), F.when(k % 29 == 0, "?").otherwise((k % 5).cast("string")).alias("b"),
                             (k % 7 + k % 5 + F.when(k % 31 == 0, 1).otherwise(0)).alias("total"))
    return rounded(scoring.sum_check(data, ["a", "b"], "total").report)


_SCORED = f"""
WITH s AS ({STUDENTS_SQL}), i AS ({ITEMS_SQL}), b AS ({BOOKMAP_SQL}),
f AS (SELECT *, CASE WHEN ucmx_form = 'BR' THEN 'B' ELSE 'A' END AS form FROM s),
j AS (SELECT i.*, f.form, f.lithocode, f.upmxraw, f.ufmx_attempt::INT AS attempt_value, b."item format" AS fmt,
    (answer IN ('1','2','3','4','*'))::INT AS mc, (oe_final NOT IN ('A','B',''))::INT AS oe
  FROM i JOIN f ON i.flat_table_id = f.id JOIN b ON b."item position" = i.id AND b.form_values = f.form)"""


def _attempted(t: Tables):
    items = t.derived("lineitem", ITEMS).select("flat_table_id", "id", F.col("answer").alias("upmx_finalraw_item"), F.col("oe_final").alias("upmx_oe_final"))
    return scoring.attempt_check(students(t), items, bookmap(t), "m")


@query("attempt_check", _SCORED + """,
a AS (SELECT flat_table_id, attempt_value, CASE WHEN sum(mc + oe) >= 5 THEN 1 WHEN try_cast(any_value(upmxraw) AS DOUBLE) >= 5 THEN 1 ELSE 0 END AS calc_attempt FROM j GROUP BY ALL)
SELECT flat_table_id, calc_attempt, attempt_value FROM a WHERE calc_attempt <> attempt_value""")
def attempt_check(t: Tables):
    return rounded(_attempted(t).mismatches)


_HANDSCORE = _SCORED + """,
n AS (SELECT *, try_cast(oe_first AS DOUBLE) f, try_cast(oe_second AS DOUBLE) s, try_cast(nullif(oe_third, '') AS DOUBLE) t, try_cast(nullif(oe_final, '') AS DOUBLE) e,
  try_cast(oe_reso AS DOUBLE) r FROM j WHERE fmt = '{fmt}'),
c AS (SELECT *, {rule} AS calc FROM n),
d AS (SELECT *, CASE WHEN try_cast(calc AS DOUBLE) IS NOT NULL THEN cast(cast(round(calc::DOUBLE, 1) AS DECIMAL(6, 1)) AS VARCHAR) ELSE calc END AS shown FROM c)
SELECT flat_table_id, id AS item_id, oe_final, shown AS calc_oe_final FROM d
WHERE CASE WHEN e IS NOT NULL AND try_cast(shown AS DOUBLE) IS NOT NULL THEN round(e, 1) <> shown::DOUBLE ELSE oe_final <> shown END"""
_MEDIAN = "CASE WHEN f IS NOT NULL AND s IS NOT NULL AND e IS NOT NULL THEN list_sort([f, s, e])[2]::VARCHAR END"
_HALF = "(({} + {}) / 2)::VARCHAR"


def _handscored(t: Tables, rule: str):
    items = t.derived("lineitem", ITEMS).select(
        "flat_table_id", "id", *[F.col(f"oe_{n}").alias(f"upmx_oe_{n}") for n in ("first", "second", "third", "final", "reso")])
    wanted = "SA" if rule == "short" else "ER"
    out = scoring.handscore_check(students(t), items, bookmap(t), "m", rule, wanted)
    return rounded(out.select("flat_table_id", "item_id", "oe_final", "calc_oe_final"))


@query("handscore_check_short", _HANDSCORE.format(fmt="SA", rule=f"""CASE WHEN oe_first = oe_second THEN oe_first WHEN abs(f - s) = 1 THEN {_HALF.format('f', 's')}
  WHEN oe_first = oe_third THEN oe_first WHEN oe_second = oe_third THEN oe_second ELSE {_MEDIAN} END"""))
def handscore_check_short(t: Tables):
    return _handscored(t, "short")


@query("handscore_check_extended", _HANDSCORE.format(fmt="ER", rule=f"""CASE WHEN oe_first = oe_second THEN oe_first WHEN oe_first = oe_third THEN oe_first
  WHEN oe_second = oe_third THEN oe_second WHEN abs(f - t) = 1 AND abs(s - t) = 1 THEN {_MEDIAN} WHEN abs(f - s) = 1 THEN {_HALF.format('f', 's')}
  WHEN abs(f - t) = 1 THEN {_HALF.format('f', 't')} WHEN abs(s - t) = 1 THEN {_HALF.format('s', 't')} ELSE oe_reso END"""))
def handscore_check_extended(t: Tables):
    return _handscored(t, "extended")


@query("handscore_check_writing", _HANDSCORE.format(fmt="ER", rule="""CASE WHEN f IS NOT NULL AND s IS NOT NULL THEN CASE WHEN oe_first = oe_second OR abs(f - s) = 1 THEN (f + s)::VARCHAR
  WHEN oe_first = oe_third THEN (f + t)::VARCHAR WHEN oe_second = oe_third THEN (s + t)::VARCHAR
  WHEN abs(f - t) = 1 AND abs(s - t) = 1 AND least(f, s, t) <> 0 THEN (2 * t)::VARCHAR WHEN abs(f - t) = 1 THEN (f + t)::VARCHAR
  WHEN abs(s - t) = 1 THEN (s + t)::VARCHAR ELSE (2 * r)::VARCHAR END WHEN oe_first = oe_second THEN oe_first END"""))
def handscore_check_writing(t: Tables):
    return _handscored(t, "writing")


# ----------------------------------------------------- master list reports

_MASTERED = f"""
WITH s AS ({STUDENTS_SQL}), m AS ({MASTER_SQL}),
j AS (SELECT s.*, m.bcrxid_c, m.dcrxid_c, m.dcrxnm, m.bcrxnm, m.schtype, m.distrtype, m.dcxx_county AS mcounty FROM s LEFT JOIN m ON s.bcrxid_attend = m.bcrxid_c),
r AS (SELECT *, CASE WHEN bcrxid_c IS NULL THEN '' ELSE
    CASE WHEN dcrxid_attend <> dcrxid_c THEN 'DistrictID' ELSE '' END || CASE WHEN lower(dcrxnm_attend) <> lower(dcrxnm) THEN '*DistrictName' ELSE '' END
    || CASE WHEN lower(bcrxnm_attend) <> lower(bcrxnm) THEN '*SchoolName' ELSE '' END || CASE WHEN lower(schtype_attend) <> lower(schtype) THEN '*SchoolType' ELSE '' END
    || CASE WHEN lower(distrtype_attend) <> lower(distrtype) THEN '*DistrictType' ELSE '' END END AS reason FROM j)"""


@query("discrepancy_report", _MASTERED + """
SELECT bcrxid_attend, reason AS "Reason", min(dcrxid_attend) AS dcrxid_attend, min(bcrxid_c) AS bcrxid_c FROM r WHERE reason <> '' GROUP BY bcrxid_attend, reason""")
def discrepancy_report(t: Tables):
    _, report = quality.discrepancy_report(students(t), master(t))
    return report.select("bcrxid_attend", "Reason", "dcrxid_attend", "bcrxid_c")


@query("discrepancy_corrections", _MASTERED + """
SELECT id, reason AS "Reason", CASE WHEN bcrxid_c IS NOT NULL AND dcrxid_attend <> dcrxid_c THEN dcrxid_c ELSE dcrxid_attend END AS dcrxid_attend,
  coalesce(dcrxnm, dcrxnm_attend) AS dcrxnm_attend, coalesce(bcrxnm, bcrxnm_attend) AS bcrxnm_attend,
  CASE WHEN reason LIKE '%SchoolType%' THEN schtype ELSE schtype_attend END AS schtype_attend,
  CASE WHEN bcrxid_c IS NOT NULL AND bcrxid_home = '' AND dcrxid_attend <> dcrxid_c AND dcrxid_attend <> bcrxid_attend THEN dcrxid_attend ELSE dcrxid_home END AS dcrxid_home FROM r""")
def discrepancy_corrections(t: Tables):
    rows, _ = quality.discrepancy_report(students(t), master(t))
    return rounded(rows.select("id", "Reason", "dcrxid_attend", "dcrxnm_attend", "bcrxnm_attend", "schtype_attend", "dcrxid_home"))


@query("conflicting_records", f"""
WITH s AS ({STUDENTS_SQL})
SELECT id, CASE WHEN dcrxid_home = '' AND schtype_attend = 'J' THEN 'Missing dcrxid_home' WHEN bcrxid_attend = dcrxid_attend AND schtype_attend = 'J' THEN 'DCRXID=BCRXID for JVS schools' ELSE '' END AS "Reason"
  FROM s WHERE (bcrxid_attend = dcrxid_attend AND schtype_attend = 'J') OR dcrxid_home = ''
UNION ALL SELECT id, 'School type N has bcrxid <> dcrxid' FROM s WHERE schtype_attend = 'N' AND bcrxid_attend <> dcrxid_attend""")
def conflicting_records(t: Tables):
    return rounded(quality.conflicting_records(students(t)).select("id", "Reason"))


@query("missing_reference_report", _MASTERED + """
SELECT 'master' AS kind, bcrxid_attend AS key FROM j WHERE bcrxid_c IS NULL GROUP BY ALL
UNION ALL SELECT 'county', dcrxid_attend FROM s WHERE id % 3 = 0 GROUP BY ALL
UNION ALL SELECT 'diocese', bcrxid_attend FROM j WHERE (schtype_attend = 'D' AND schtype <> 'D') OR (schtype = 'D' AND schtype_attend <> 'D')""")
def missing_reference_report(t: Tables):
    rows = students(t).withColumn("dcxx_county", F.when(F.col("id") % 3 == 0, " ").otherwise(F.col("dcxx_county")))
    out = quality.missing_reference_report(rows, master(t))
    return (out.missing_from_master.select(F.lit("master").alias("kind"), F.col("bcrxid_attend").alias("key"))
            .unionByName(out.missing_county.select(F.lit("county").alias("kind"), F.col("dcrxid_attend").alias("key")))
            .unionByName(out.diocese_mismatch.select(F.lit("diocese").alias("kind"), F.col("bcrxid_attend").alias("key"))))
