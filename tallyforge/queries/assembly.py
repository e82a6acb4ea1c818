"""Student records, reports, extracts, ids, whole workflows."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import plans
from ..operators.merge import MergeField, MergeSpec
from .registry import BOOKMAP_SQL, ITEMS, ITEMS_SQL, MASTER_SQL, STRANDS, STUDENTS_SQL, SUBJECTS, Tables, bookmap, master, query, rounded, students

_LEVELS = ("3", "4", "5")
_KEPT = ("schtype_attend <> 'H' AND NOT (" + " AND ".join(f"uf{s}x_attempt = '0'" for s in SUBJECTS) + ")")
_GRADE = "CASE WHEN grade = '' THEN '99' ELSE grade::DOUBLE::INT::VARCHAR END"
_PASSED = " + ".join(f"(up{s}xlev IN ('3','4','5'))::INT" for s in SUBJECTS)
_VALID = " OR ".join(f"(uf{s}x_attempt = '1' AND uf{s}x_invalid = '0')" for s in SUBJECTS)
_OFF = " OR ".join(f"up{s}xlev IN ('1','2') OR uf{s}x_attempt = '0' OR uf{s}x_invalid = '1'" for s in SUBJECTS)
_ALL = " AND ".join(f"uf{s}x_attempt = '1'" for s in SUBJECTS)
_DERIVED = f"""
SELECT id, student, grade_text AS grade, g_dcrxid, birthdate, reported_flag, pass_count, ucxxpon, stateinclusionflag, districtinclusionflag, attempt_all,
  uprx_accom, uprxpass, uprxdum3, proforhigherr, advaccr, inclusionflagm, upradum2, upradum4, upmndum0, writing_prompt2, county FROM (
  SELECT *, regexp_replace(trim(ucrxfnm) || CASE WHEN studentmid = '' THEN '' ELSE ' q' END || ' ' || ucrxlnm, ' +', ' ', 'g') AS student, {_GRADE} AS grade_text,
    {_GRADE} || '_' || dcrxid_attend AS g_dcrxid,
    CASE WHEN dob_year = '' THEN '' ELSE lpad(dob_month, 2, '0') || '/' || lpad(dob_day, 2, '0') || '/' || dob_year END AS birthdate,
    CASE WHEN {_VALID} THEN '1' ELSE '0' END AS reported_flag, ({_PASSED})::VARCHAR AS pass_count, CASE WHEN {_OFF} THEN '0' ELSE '1' END AS ucxxpon,
    CASE WHEN schtype_attend IN ('N','H','D') OR (distrtype_attend = 'J' AND distrtype_home IN ('N','D')) THEN '0' ELSE '1' END AS stateinclusionflag,
    CASE WHEN schtype_attend IN ('N','H','C','U') THEN '0' ELSE '1' END AS districtinclusionflag, ({_ALL})::INT AS attempt_all,
    CASE WHEN uprx_read_aloud = '1' OR uprx_extended = '1' OR uprx_dictionary = '1' OR uprx_scribe = '1' OR uprx_other = '1' THEN '1' ELSE '' END AS uprx_accom,
    CASE WHEN uprxlev IN ('3','4','5') THEN '1' WHEN uprxlev IN ('1','2') THEN '2' ELSE '3' END AS uprxpass,
    CASE WHEN uprxlev = '' THEN '' WHEN uprxlev = '3' THEN '100' ELSE '0' END AS uprxdum3,
    CASE WHEN uprxlev IN ('3','4','5') THEN '100' WHEN uprxlev IN ('1','2') THEN '0' ELSE '' END AS proforhigherr,
    CASE WHEN uprxlev IN ('4','5') THEN '100' WHEN uprxlev IN ('1','2','3') THEN '0' ELSE '' END AS advaccr,
    CASE WHEN ufmx_attempt = '1' AND ufmx_invalid <> '1' THEN '1' ELSE '0' END AS inclusionflagm,
    CASE WHEN upralev = '' THEN '' WHEN upralev = '2' THEN '100' ELSE '0' END AS upradum2, CASE WHEN upralev IN ('2','3') THEN '100' ELSE '' END AS upradum4,
    CASE WHEN upmnlev = '' THEN '' ELSE '0' END AS upmndum0, CASE WHEN ufwx_attempt = '0' THEN '' ELSE upwx_oe_final_4 END AS writing_prompt2,
    upper(left(dcxx_county, 1)) || substr(dcxx_county, 2) AS county
  FROM ({STUDENTS_SQL}) WHERE {_KEPT})"""


def _derived(t: Tables):
    return plans.student_derivations(students(t), STRANDS)


@query("student_derivations", _DERIVED)
def student_derivations(t: Tables):
    return rounded(_derived(t).select(
        "id", F.col("student_name").alias("student"), "grade", "g_dcrxid", "birthdate", "reported_flag", "pass_count", "ucxxpon", "stateinclusionflag",
        "districtinclusionflag", "attempt_all", "uprx_accom", "uprxpass", "uprxdum3", "proforhigherr", "advaccr", "inclusionflagm", "upradum2", "upradum4",
        "upmndum0", "writing_prompt2", F.col("dcxx_county").alias("county")))


_HOME = f"""
WITH s AS (SELECT id, lithocode, {_GRADE} AS grade, grade AS rgrade, dcrxid_attend AS dcrxid, dcrxnm_attend AS dcrxnm, bcrxid_attend AS bcrxid, bcrxnm_attend AS bcrxnm,
    dcrxid_home, dcrxnm_home, bcrxid_attend, bcrxnm_attend, dcrxid_attend, dcrxnm_attend, schtype_attend AS schtype, '0' AS flag FROM ({STUDENTS_SQL}) WHERE {_KEPT}),
h AS (SELECT *, dcrxid AS d, dcrxnm AS dn, grade || '_' || bcrxid AS g_bcrxid FROM s
  UNION ALL SELECT id, lithocode, grade, rgrade, dcrxid, dcrxnm, bcrxid, bcrxnm, dcrxid_home, dcrxnm_home, '', bcrxnm_attend, dcrxid_attend, dcrxnm_home, '', '1',
    dcrxid_home, dcrxnm_home, '' FROM s WHERE dcrxid_home <> '')"""


@query("home_district_rows", _HOME + " SELECT id, flag AS dummy_record_flag, d AS dcrxid, dn AS dcrxnm, grade || '_' || d AS g_dcrxid, g_bcrxid, schtype FROM h")
def home_district_rows(t: Tables):
    return rounded(plans.home_district_rows(_derived(t)).select("id", "dummy_record_flag", "dcrxid", "dcrxnm", "g_dcrxid", "g_bcrxid", "schtype"))


@query("reporting_cuts", _HOME + """
SELECT 'district' AS cut, g AS key, dn AS name FROM (SELECT grade || '_' || d AS g, dn, lithocode, flag FROM h) QUALIFY row_number() OVER (PARTITION BY g ORDER BY lithocode, flag) = 1
UNION ALL SELECT DISTINCT 'state', grade || '_1', rgrade FROM h
UNION ALL SELECT 'school', g_bcrxid, bcrxnm FROM (SELECT DISTINCT g_bcrxid, grade || '_' || d, bcrxid, bcrxnm, grade, rgrade, schtype FROM h)
UNION ALL SELECT 'intervention', bcrxid_attend, dcrxnm_attend FROM (SELECT DISTINCT bcrxid_attend, bcrxnm_attend, dcrxid_attend, dcrxnm_attend, schtype FROM h)""")
def reporting_cuts(t: Tables):
    rows = plans.cut_rows(plans.home_district_rows(_derived(t)))
    shown = {"district": ("g_dcrxid", "dcrxnm"), "state": ("g_scrxid", "rgrade"), "school": ("g_bcrxid", "bcrxnm"), "school_intervention": ("bcrxid_attend", "dcrxnm_attend")}

    def pick(i: int):
        return F.coalesce(*[F.when(F.col("cut") == cut, F.col(columns[i])) for cut, columns in shown.items()])

    return rows.select(F.replace("cut", F.lit("school_"), F.lit("")).alias("cut"), pick(0).alias("key"), pick(1).alias("name"))


_TYPES = "schtype IN ('J', 'D', 'Y')"


@query("report_tables", _HOME + f""",
sc AS (SELECT DISTINCT g_bcrxid, grade || '_' || d AS g_dcrxid, bcrxid, bcrxnm, grade, rgrade, schtype FROM h),
it AS (SELECT DISTINCT bcrxid_attend, bcrxnm_attend, dcrxid_attend, dcrxnm_attend, schtype FROM h),
di AS (SELECT grade || '_' || d AS g_dcrxid, grade, d, dn FROM h QUALIFY row_number() OVER (PARTITION BY grade || '_' || d ORDER BY lithocode, flag) = 1),
hd AS (SELECT *, d <> dcrxid_home AND trim(dcrxid_home) <> '' AND schtype <> 'Y' AS away FROM h)
SELECT 'districtnames' AS tbl, d AS a, dn AS b, NULL AS c FROM (SELECT DISTINCT d, dn FROM h)
UNION ALL SELECT 'state', g, nullif(grade, '99'), nullif(rgrade, '99') FROM (SELECT DISTINCT grade || '_1' AS g, grade, rgrade FROM h)
UNION ALL SELECT 'school_repnum', g_dcrxid || '_' || lpad(least(ceil(row_number() OVER (PARTITION BY g_dcrxid ORDER BY g_bcrxid, bcrxid, schtype, rgrade, bcrxnm) / 5.0), 10)::INT::VARCHAR, 2, '0'), g_bcrxid, schtype FROM sc
UNION ALL SELECT 'school', g_bcrxid, substr(g_dcrxid, 4, 6), nullif(grade, '99') FROM sc
UNION ALL SELECT 'school_intervention', bcrxid_attend, dcrxid_attend, schtype FROM it
UNION ALL SELECT 'school_intervention_jd', bcrxid_attend, dcrxid_attend, schtype FROM it WHERE {_TYPES}
UNION ALL SELECT 'alldistricts', d, d, NULL FROM (SELECT DISTINCT d FROM di)
UNION ALL SELECT 'all_districts', d, d, NULL FROM (SELECT DISTINCT d FROM di)
UNION ALL SELECT 'all_districts', d, ' ', NULL FROM (SELECT DISTINCT d FROM h WHERE schtype = 'H')
UNION ALL SELECT 'allschools', x, bcrxid, NULL FROM (SELECT DISTINCT substr(g_dcrxid, 4, 6) AS x, bcrxid FROM sc)
UNION ALL SELECT 'allschools_jd', bcrxid, schtype, NULL FROM (SELECT DISTINCT bcrxid, schtype FROM sc WHERE {_TYPES})
UNION ALL SELECT 'district', g_dcrxid, nullif(grade, '99'), dn FROM di
UNION ALL SELECT 'student', lithocode || '-' || flag, d || bcrxid, nullif(grade, '99') FROM h
UNION ALL SELECT 'studenthomedistrict', lithocode || '-' || flag, CASE WHEN away THEN grade || '_' || dcrxid_home ELSE grade || '_' || d END, CASE WHEN away THEN dcrxid_home ELSE d END FROM hd""")
def report_tables(t: Tables):
    """Three telling columns of each of the thirteen tables."""
    people = plans.home_district_rows(_derived(t))
    cuts = plans.reporting_cuts(people)
    out = plans.report_tables(cuts["district"], cuts["state"], cuts["school"], cuts["school_intervention"], people)
    row = F.concat_ws("-", "lithocode", "dummy_record_flag")
    none = F.lit(None)
    shown = {"districtnames": ("dcrxid", "dcrxnm", none), "state": ("g_scrxid", "grade_recoded", "grade_r_recoded"),
             "school_repnum": ("g_dcrxid_n", "g_bcrxid", "schtype"), "school": ("g_bcrxid", "dcrxid", "grade_recoded"),
             "school_intervention": ("bcrxid_attend", "dcrxid_recoded", "schtype"), "school_intervention_jd": ("bcrxid_attend", "dcrxid_recoded", "schtype"),
             "alldistricts": ("dcrxid", "mergeid", none), "all_districts": ("dcrxid", "mergeid", none), "allschools": ("dcrxid", "bcrxid", none),
             "allschools_jd": ("bcrxid", "schtype", none), "district": ("g_dcrxid", "grade_recoded", "dcrxnm"),
             "student": (row, "labelid", "grade_recoded"), "studenthomedistrict": (row, "g_dcrxid", "dcrxid")}
    parts = [out[name].select(F.lit(name).alias("tbl"), *[(F.col(c) if isinstance(c, str) else c).cast("string").alias(x) for c, x in zip(columns, "abc")])
             for name, columns in shown.items()]
    return reduce(DataFrame.unionByName, parts)


@query("extract_rows", f"""
WITH s AS (SELECT *, CASE WHEN length(ssid) = 9 THEN ssid ELSE '' END AS ss FROM ({STUDENTS_SQL}) WHERE bcrxid_attend <> '000001'),
c AS (SELECT id, bcrxid_attend AS d, ss, schtype_attend FROM s WHERE schtype_attend IN ('J','D','Y')
  UNION ALL SELECT id, dcrxid_home, ss, schtype_attend FROM s WHERE (schtype_attend = 'J' AND trim(dcrxid_home) <> '') OR schtype_attend NOT IN ('J','D','Y')
  UNION ALL SELECT id, dcrxid_attend, ss, schtype_attend FROM s)
SELECT id, d AS dcrxid, ss AS ssid, 'District ' || substr(dcrxnm_attend, 10) AS dcrxnm_attend, CASE WHEN d < '000050' AND d <> '' THEN 'site' || d END AS dasites
FROM c JOIN (SELECT id AS i, dcrxnm_attend FROM s) ON id = i""")
def extract_rows(t: Tables):
    s = students(t).withColumn("schtype", F.col("schtype_attend"))
    parts = [s.select("lithocode", "id", "ssid", "schtype", "dcrxid_home", "dcrxid_attend"),
             s.select("lithocode", "bcrxid_attend", "dcrxnm_attend", "bcrxnm_attend", "dcrxnm_home", "ucrxfnm", "ucrxlnm")]
    # one site per supplier number below fifty, and per nation number
    numbers = t.supplier.select(F.col("s_suppkey").alias("n")).union(t.nation.select("n_nationkey")).union(t.customer.select(F.col("c_custkey") % 50)).distinct()
    sites = numbers.where("n < 50").select(F.lpad(F.col("n").cast("string"), 6, "0").alias("dcrxid")).withColumn("dasites", F.concat(F.lit("site"), F.col("dcrxid")))
    return rounded(plans.extract_rows(parts, sites).district.select("id", "dcrxid", "ssid", "dcrxnm_attend", "dasites"))


_IDS = """
WITH d AS (SELECT c_custkey, c_nationkey AS dist, c_custkey % 3 AS sch, c_custkey % 2 + 9 AS g,
    CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_mktsegment END AS t1, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 'algebra' END AS c1, '' AS n1,
    CASE WHEN c_custkey % 6 = 0 THEN '' ELSE lower(c_mktsegment) END AS t2, '' AS c2, CASE WHEN c_custkey % 7 = 0 THEN '' ELSE 'sec 1' END AS n2 FROM customer),
k AS (SELECT g, dist::VARCHAR d, sch::VARCHAR b, t1 t, c1 c, n1 n, 'm' s, c_custkey FROM d UNION ALL SELECT g, dist::VARCHAR, sch::VARCHAR, t2, c2, n2, 'r', c_custkey FROM d),
tk AS (SELECT *, row_number() OVER (ORDER BY g, d, b, t) AS i FROM (SELECT DISTINCT g, d, b, t FROM k WHERE t <> '')),
ck AS (SELECT *, row_number() OVER (ORDER BY g, d, b, t, c, n, s) AS i FROM (SELECT DISTINCT g, d, b, t, c, n, s FROM k WHERE t <> '' OR c <> '' OR n <> ''))
SELECT k.c_custkey, k.s AS subject, CASE WHEN k.t = '' THEN 'NO NAME' ELSE k.t END AS teacher_label,
  CASE WHEN tk.i IS NOT NULL THEN 'ID0310T' || lpad(k.g::VARCHAR, 2, '0') || lpad(tk.i::VARCHAR, 7, '0') END AS teacher_id,
  CASE WHEN ck.i IS NULL THEN 'CLASS ASSIGNMENT UNKNOWN' ELSE concat_ws(' - ', CASE WHEN k.t = '' THEN 'NO NAME' ELSE k.t END, nullif(k.c, ''), nullif(k.n, '')) END AS class_label,
  CASE WHEN ck.i IS NOT NULL THEN 'ID0310C' || k.s || lpad(k.g::VARCHAR, 2, '0') || lpad(ck.i::VARCHAR, 6, '0') END AS class_id
FROM k LEFT JOIN tk ON k.g = tk.g AND k.d = tk.d AND k.b = tk.b AND k.t = tk.t
LEFT JOIN ck ON k.g = ck.g AND k.d = ck.d AND k.b = ck.b AND k.t = ck.t AND k.c = ck.c AND k.n = ck.n AND k.s = ck.s"""


@query("generate_ids", _IDS)
def generate_ids(t: Tables):
    k = F.col("c_custkey")
    rows = t.customer.select(
        "c_custkey", F.col("c_nationkey").cast("string").alias("dcrxid_attend"), (k % 3).cast("string").alias("bcrxid_attend"), (k % 2 + 9).alias("grade"),
        F.when(k % 4 != 0, F.concat(F.lit(" "), F.col("c_mktsegment"))).alias("t1"), F.when(k % 5 == 0, "").otherwise("algebra").alias("c1"), F.lit(None).cast("string").alias("n1"),
        F.when(k % 6 == 0, "").otherwise(F.lower("c_mktsegment")).alias("t2"), F.lit("").alias("c2"), F.when(k % 7 == 0, " ").otherwise("sec   1").alias("n2"))
    out = plans.generate_ids(rows, {"m": ("t1", "c1", "n1"), "r": ("t2", "c2", "n2")}, "0310")
    columns = F.array(*[
        F.struct(F.lit(s).alias("subject"), F.col(f"{s}label").alias("teacher_label"), F.col(f"{s}teacher_id").alias("teacher_id"),
                 F.col(f"i{s}xnm").alias("class_label"), F.col(f"{s}class_id").alias("class_id")) for s in ("m", "r")])
    return out.select("c_custkey", F.inline(columns))


_INTAKE = f"""
WITH s AS ({STUDENTS_SQL}), m AS ({MASTER_SQL}),
j AS (SELECT s.*, m.* EXCLUDE (dcxx_county), m.dcxx_county AS mc FROM s LEFT JOIN m ON bcrxid_attend = bcrxid_c),
a AS (SELECT *, CASE WHEN dcrxid_home = dcrxid_attend OR dcrxid_home = bcrxid_attend THEN '' ELSE dcrxid_home END AS h1,
  CASE WHEN dcrxid_home = dcrxid_attend OR bcrxid_home = bcrxid_attend OR (dcrxid_home = bcrxid_attend) THEN '' ELSE bcrxid_home END AS b1 FROM j),
b AS (SELECT *, CASE WHEN bcrxid_c IS NOT NULL AND b1 = '' AND dcrxid_attend <> dcrxid_c AND dcrxid_attend <> bcrxid_attend THEN dcrxid_attend ELSE h1 END AS h2,
  CASE WHEN bcrxid_c IS NOT NULL AND dcrxid_attend <> dcrxid_c THEN dcrxid_c ELSE dcrxid_attend END AS d2,
  CASE WHEN bcrxid_c IS NOT NULL AND schtype_attend <> schtype THEN schtype ELSE schtype_attend END AS st2 FROM a),
c AS (SELECT *, CASE WHEN st2 = 'N' AND bcrxid_attend <> d2 THEN d2 ELSE h2 END AS h3, CASE WHEN st2 = 'N' AND bcrxid_attend <> d2 THEN bcrxid_attend ELSE d2 END AS d3 FROM b)
SELECT id, d3 AS dcrxid_attend, st2 AS schtype_attend,
  CASE WHEN h3 = d3 OR st2 = 'Y' OR h3 = bcrxid_attend THEN '' ELSE h3 END AS dcrxid_home,
  CASE WHEN ucrx_form = 'BR' THEN 'B' ELSE 'A' END AS form_r, CASE WHEN ethnicity IN ('1','2','3','4','5','6') THEN ethnicity ELSE '7' END AS ethnicity FROM c"""


@query("intake_pipeline", _INTAKE)
def intake_pipeline(t: Tables):
    result = plans.intake_pipeline(students(t), master(t), [{"checktype": "NonMissing", "variable": "ssid", "labelvariable": None}])
    return rounded(result.corrected.intake.select("id", "dcrxid_attend", "schtype_attend", "dcrxid_home", "form_r", "ethnicity"))


@query("intake_pipeline_failures", f"SELECT 'ssid' AS bad_variable, 'missing ID' AS bad_reason, count(*) AS count FROM ({STUDENTS_SQL}) WHERE ssid = ''")
def intake_pipeline_failures(t: Tables):
    result = plans.intake_pipeline(students(t), master(t), [{"checktype": "NonMissing", "variable": "ssid", "labelvariable": None}])
    return rounded(result.failure_counts)


_CHECKS = f"""
WITH s AS ({STUDENTS_SQL}), i AS ({ITEMS_SQL}),
k AS (SELECT "item position" AS item, form_values AS form, "numeric key" AS key FROM ({BOOKMAP_SQL}) WHERE "item format" = 'MC'),
r AS (SELECT flat_table_id AS id, CASE WHEN ucmx_form = 'BR' THEN 'breach' ELSE 'regular' END AS kind, CASE WHEN ucmx_form = 'BR' THEN 'B' ELSE 'A' END AS form, i.id AS item,
    CASE WHEN answer IN ('', '-', '*') THEN 99 ELSE answer::INT END AS ans, CASE WHEN i.score = '' THEN 99 ELSE try_cast(i.score AS INT) END AS sc FROM i JOIN s ON s.id = flat_table_id),
j AS (SELECT r.*, key, CASE WHEN key = ans THEN 1 ELSE 0 END AS correct FROM r LEFT JOIN k ON k.form = r.form AND k.item = r.item),
tab AS (SELECT p_size::DOUBLE - 1 AS raw, (max(p_partkey) % 5)::DOUBLE AS v FROM part WHERE p_size % 10 <> 4 GROUP BY p_size),
c AS (SELECT id, CASE WHEN ucrx_form = 'BR' THEN 'breach' ELSE 'regular' END AS kind, try_cast(uprxlev AS DOUBLE) AS lev, v FROM s LEFT JOIN tab ON tab.raw = uprxraw::DOUBLE)
SELECT 'rescore' AS test, kind, id, item::VARCHAR AS what, CASE WHEN sc IS NULL THEN 'score' WHEN key IS NULL THEN 'item' ELSE 'wrong' END AS finding FROM j WHERE sc IS NULL OR key IS NULL OR sc <> correct
UNION ALL SELECT 'conversion', kind, id, CASE WHEN v IS NOT NULL THEN 'uprxlev' END, CASE WHEN v IS NULL THEN 'no' ELSE 'value' END FROM c WHERE v IS NULL OR lev IS NULL OR lev <> v
UNION ALL SELECT 'scores', kind, id, item::VARCHAR, correct::VARCHAR FROM j WHERE sc IS NOT NULL AND key IS NOT NULL"""


@query("intake_pipeline_checks", _CHECKS)
def intake_pipeline_checks(t: Tables):
    """Rescoring and conversion of the whole workflow, apart for breach and regular forms."""
    items = t.derived("lineitem", ITEMS).select("flat_table_id", "id", F.col("answer").alias("upmx_finalraw_item"), F.col("score").alias("upmx_score_item"))
    key = bookmap(t).where("`item format` = 'MC'").select(
        F.col("form_values").alias("form_id"), F.col("item position").alias("item_id"), F.col("numeric key").alias("numeric_key"), F.col("point value").alias("point_value"))
    table = t.part.where("p_size % 10 <> 4").groupBy("p_size").agg((F.max("p_partkey") % 5).cast("double").alias("value")).select(
        F.lit("uprxraw").alias("raw_variable"), (F.col("p_size") - 1).cast("double").alias("raw_score"), F.lit("level").alias("measure"), "value")
    out = plans.intake_pipeline(students(t), master(t), item_tables={"m": items}, answer_keys={"m": key},
                                conversions={"r": (table, {"uprxraw": {"uprxlev": "level"}})}, subjects=("r", "m"))
    parts = []
    for kind in ("breach", "regular"):
        scored, converted = out.rescore["m", kind], out.conversion["r", kind]
        message = F.col("message")
        parts += [
            scored.report.select(F.lit("rescore").alias("test"), F.lit(kind).alias("kind"), F.col("test_id").alias("id"), F.col("item_id").cast("string").alias("what"),
                                 F.when(message.startswith("score_item"), "score").when(message.startswith("item"), "item").otherwise("wrong").alias("finding")),
            scored.output.select(F.lit("scores"), F.lit(kind), "test_id", F.col("item_id").cast("string"), F.col("score_item").cast("string")),
            converted.report.select(F.lit("conversion"), F.lit(kind), "id", "variable", F.substring_index(message, " ", 1))]
    return rounded(reduce(DataFrame.union, parts))


_CHANGE = f"""
WITH s AS ({STUDENTS_SQL}), m AS ({MASTER_SQL}),
md AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY dcrxid_c ORDER BY bcrxid_c) = 1),
r AS (SELECT id AS rid, lithocode, CASE WHEN id % 4 = 0 THEN 'F' ELSE 'M' END AS g FROM s WHERE id % 3 <> 0)
SELECT s.id, s.lithocode, CASE WHEN r.rid IS NULL THEN ucrxgen WHEN g = 'F' THEN '1' ELSE '2' END AS ucrxgen,
  CASE WHEN s.dcrxid_home = '000003' THEN '000004' ELSE s.dcrxid_home END AS dcrxid_home, md.dcrxnm AS dcrxnm_home, a.dcrxnm AS dcrxnm_attend
FROM s LEFT JOIN r ON s.lithocode = r.lithocode LEFT JOIN md ON md.dcrxid_c = CASE WHEN s.dcrxid_home = '000003' THEN '000004' ELSE s.dcrxid_home END
LEFT JOIN m a ON a.bcrxid_c = s.bcrxid_attend AND a.dcrxid_c = s.dcrxid_attend"""


@query("record_change_pipeline", _CHANGE)
def record_change_pipeline(t: Tables):
    names = ("id", "lithocode", "ucrxgen", "studentmid", "grade", "dcrxid_home", "dcrxnm_home", "bcrxid_home", "bcrxnm_home", "distrtype_home",
             "dcrxid_attend", "dcrxnm_attend", "bcrxid_attend", "bcrxnm_attend", "schtype_attend", "dcxx_county", "migrant")
    scores = students(t).select(*names).withColumn("schtype_home", F.lit(""))
    registration = students(t).where("id % 3 <> 0").select(
        F.col("id").alias("rid"), "lithocode", F.when(F.col("id") % 4 == 0, "F").otherwise("M").alias("ucrxgen"),
        "migrant", "grade", *[F.lit("").alias(c) for c in ("dcrxid_home", "bcrxid_home", "dcrxnm_home", "bcrxnm_home", "dcrxid_attend", "bcrxid_attend")])
    fields = [MergeField(c, c, "ucrxgen" if c == "ucrxgen" else None, "R" if c == "ucrxgen" else "LO") for c in scores.columns]
    spec = MergeSpec(fields, [("lithocode", "lithocode")], [], [])
    out = plans.record_change_pipeline(scores, registration, master(t), spec, "id", "rid", {"000003": "000004"})
    return rounded(out.final.select("id", "lithocode", "ucrxgen", "dcrxid_home", "dcrxnm_home", "dcrxnm_attend"))


_CLEAN = "regexp_replace(upper(trim({})), '(\\s)\\s+', '\\1', 'g')"
_LINES = f"""
WITH s AS ({STUDENTS_SQL}),
r AS (SELECT id AS rid, lithocode, CASE WHEN id % 4 = 0 THEN '1' ELSE '2' END AS g, CASE WHEN id % 5 = 0 THEN 'someone else' ELSE ucrxlnm END AS lnm, ucrxfnm AS fnm,
    CASE WHEN id % 2 = 0 THEN ssid ELSE 'other' END AS known FROM s WHERE id % 3 <> 0),
n AS (SELECT s.id, g, {_CLEAN.format('ucrxlnm')} || ' ' || {_CLEAN.format('ucrxfnm')} AS a, {_CLEAN.format('ucrxfnm')} || ' ' || {_CLEAN.format('ucrxlnm')} AS b,
    {_CLEAN.format('lnm')} || ' ' || {_CLEAN.format('fnm')} AS c FROM s JOIN r ON s.lithocode = r.lithocode),
m AS (SELECT id, g FROM n WHERE 1.0 - least(levenshtein(a, c), levenshtein(b, c))::DOUBLE / greatest(length(a), length(c)) > 0.8),
f AS (SELECT s.lithocode, schtype_attend, coalesce(g, ucrxgen) AS gen, grade, CASE WHEN dcrxid_home = '000003' THEN '000004' ELSE dcrxid_home END AS home,
    CASE WHEN ssid IN (SELECT known FROM r) THEN ssid ELSE '' END AS ss FROM s LEFT JOIN m ON m.id = s.id)
SELECT 'unknown' AS part, ssid AS value FROM (SELECT DISTINCT ssid FROM s WHERE ssid <> '' AND ssid NOT IN (SELECT known FROM r))
UNION ALL SELECT 'line', lithocode || rpad(ss, 10, ' ') || CASE gen WHEN '1' THEN 'F' WHEN '2' THEN 'M' ELSE left(gen, 1) END
  || CASE WHEN grade = '' THEN ' .' ELSE lpad(grade::DOUBLE::INT::VARCHAR, 2, '0') END || '  ' || rpad(home, 6, ' ') FROM f WHERE schtype_attend <> 'H'"""


@query("record_change_lines", _LINES)
def record_change_lines(t: Tables):
    """Names of two columns decide what the registration may change; ids it lacks are blanked and listed; fixed-width lines."""
    names = ("id", "lithocode", "ssid", "ucrxlnm", "ucrxfnm", "ucrxgen", "studentmid", "grade", "dcrxid_home", "dcrxnm_home", "bcrxid_home", "bcrxnm_home", "distrtype_home",
             "dcrxid_attend", "dcrxnm_attend", "bcrxid_attend", "bcrxnm_attend", "schtype_attend", "dcxx_county", "migrant")
    scores = students(t).select(*names).withColumn("schtype_home", F.lit(""))
    k = F.col("id")
    registration = students(t).where("id % 3 <> 0").select(
        k.alias("rid"), "lithocode", F.when(k % 4 == 0, "F").otherwise("M").alias("ucrxgen"), F.when(k % 5 == 0, "someone else").otherwise(F.col("ucrxlnm")).alias("lnm"),
        F.col("ucrxfnm").alias("fnm"), F.when(k % 2 == 0, F.col("ssid")).otherwise("other").alias("ssid"), "migrant", "grade",
        *[F.lit("").alias(c) for c in ("dcrxid_home", "bcrxid_home", "dcrxnm_home", "bcrxnm_home", "dcrxid_attend", "bcrxid_attend")])
    fields = [MergeField(c, c, "ucrxgen" if c == "ucrxgen" else None, "R" if c == "ucrxgen" else "LO") for c in scores.columns]
    spec = MergeSpec(fields, [("lithocode", "lithocode")], [], [[("ucrxlnm", "lnm"), ("ucrxfnm", "fnm")]])
    layout = [{"name": n, "start": a, "end": b, "length": b - a + 1, "type": "alpha"} for n, a, b in (
        ("lithocode", 1, 8), ("ssid", 9, 18), ("ucrxgen", 19, 19), ("grade", 20, 21), ("filler", 22, 23), ("dcrxid_home", 24, 29))]
    out = plans.record_change_pipeline(scores, registration, master(t), spec, "id", "rid", {"000003": "000004"}, id_column="ssid", layout=layout)
    return out.unknown_ids.select(F.lit("unknown").alias("part"), F.col("ssid").alias("value")).unionByName(out.lines.select(F.lit("line").alias("part"), "value"))
