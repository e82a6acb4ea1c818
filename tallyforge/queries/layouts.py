"""Layout checks, typing, recoding, item rows."""

from pyspark.sql import functions as F

from ..operators import layout as lo
from .registry import Tables, query, rounded

# A layout table derived from the parts: one row per part, with rule breaks.
_LAYOUT = {
    "import_order": "p_partkey + 1", "start": "CASE WHEN p_partkey % 9 = 0 THEN '' WHEN p_partkey % 31 = 0 THEN '-1' ELSE cast(p_partkey * 10 AS STRING) END",
    "end": "CASE WHEN p_partkey % 9 = 0 THEN '' WHEN p_partkey % 37 = 0 THEN '' WHEN p_partkey % 41 = 0 THEN '1' WHEN p_partkey % 43 = 0 THEN cast(p_partkey * 10 + 25 AS STRING) ELSE cast(p_partkey * 10 + 9 AS STRING) END",
    "type": "CASE WHEN p_partkey % 9 = 0 THEN '' WHEN p_partkey % 47 = 0 THEN '' WHEN p_partkey % 53 = 0 THEN 'blob' WHEN p_partkey % 2 = 0 THEN 'integer' ELSE 'nominal' END",
    "min": "''", "max": "''", "nominal_values": "CASE WHEN p_partkey % 90 = 0 THEN '' ELSE 'x' END",
    "std_code": "CASE WHEN p_partkey % 18 = 0 THEN '1.5' WHEN p_partkey % 27 = 0 THEN 'bad' ELSE '' END",
    "variable_name": "CASE WHEN p_partkey % 9 = 0 THEN '' WHEN p_partkey % 59 = 0 THEN 'bad name' WHEN p_partkey % 61 = 0 THEN concat('bad_', cast(p_partkey AS STRING)) ELSE concat('v', cast(p_partkey % 1900 AS STRING)) END",
    "description": "p_name", "comments": "''", "counts_needed": "''",
}
_LAYOUT_CTE = ", ".join(f'{e} AS "{n}"' for n, e in _LAYOUT.items())


@query("check_layout", f"""
WITH l AS (SELECT {_LAYOUT_CTE} FROM part),
x AS (SELECT *, try_cast("start" AS DOUBLE) s, try_cast("end" AS DOUBLE) e, variable_name <> '' AS named,
  CASE WHEN variable_name <> '' THEN count(*) OVER (PARTITION BY variable_name) END AS dups,
  lower(last_value(nullif("type", '') IGNORE NULLS) OVER (ORDER BY import_order ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS vt FROM l),
n AS (SELECT import_order, e, lead(s) OVER (ORDER BY import_order) AS nxt FROM x WHERE named)
SELECT 'blank row' AS rule, import_order FROM x WHERE "start" = '' AND nominal_values = '' AND comments = ''
UNION ALL SELECT 'name has a space', import_order FROM x WHERE named AND contains(variable_name, ' ')
UNION ALL SELECT 'name starts with bad_', import_order FROM x WHERE starts_with(variable_name, 'bad_')
UNION ALL SELECT 'duplicate name', import_order FROM x WHERE dups > 1
UNION ALL SELECT 'start without end', import_order FROM x WHERE named AND s IS NOT NULL AND e IS NULL
UNION ALL SELECT 'start after end', import_order FROM x WHERE named AND s > e
UNION ALL SELECT 'negative start', import_order FROM x WHERE named AND s < 0
UNION ALL SELECT 'type missing', import_order FROM x WHERE named AND s IS NOT NULL AND "type" = ''
UNION ALL SELECT 'unknown type', import_order FROM x WHERE s IS NOT NULL AND "type" = 'blob'
UNION ALL SELECT 'code not numeric', import_order FROM x WHERE std_code = 'bad' AND "type" = '' AND vt = 'integer'
UNION ALL SELECT 'overlaps next', import_order FROM n WHERE e > nxt""")
def check_layout(t: Tables):
    return rounded(lo.check_layout(t.derived("part", _LAYOUT)).select("rule", "import_order"))


_VALUES = [
    {"varname": "l_returnflag", "type": "char", "length": 1, "regex": "[AN]", "min": None, "max": None},
    {"varname": "l_quantity", "type": "num", "length": 8, "regex": "", "min": 3, "max": 45},
    {"varname": "l_linenumber", "type": "int", "length": None, "regex": "[1-6]", "min": None, "max": 5},
]


@query("check_values", """
SELECT l_orderkey AS line_number, l_partkey, variable, value, point_of_failure FROM (
  SELECT *, 'l_returnflag' AS variable, l_returnflag AS value, 'Regular Expression' AS point_of_failure FROM lineitem WHERE NOT regexp_matches(l_returnflag, '^(?:[AN])')
  UNION ALL SELECT *, 'l_quantity', cast(l_quantity::DECIMAL(9, 1) AS VARCHAR), 'Min value check' FROM lineitem WHERE l_quantity < 3
  UNION ALL SELECT *, 'l_quantity', cast(l_quantity::DECIMAL(9, 1) AS VARCHAR), 'Max value check' FROM lineitem WHERE l_quantity > 45
  UNION ALL SELECT *, 'l_linenumber', l_linenumber::VARCHAR, 'Regular Expression' FROM lineitem WHERE l_linenumber > 6
  UNION ALL SELECT *, 'l_linenumber', l_linenumber::VARCHAR, 'Max value check' FROM lineitem WHERE l_linenumber > 5)""")
def check_values(t: Tables):
    rows = t.lineitem.withColumn("line", F.struct("l_orderkey", "l_partkey"))
    out = lo.check_values(rows, _VALUES, "line")
    return out.select(F.col("line.l_orderkey").alias("line_number"), F.col("line.l_partkey").alias("l_partkey"), "variable", "value", "point_of_failure")


_TYPED = ("SELECT o_orderkey AS line_number, CASE WHEN o_orderkey % 7 = 0 THEN 'n/a' WHEN o_orderkey % 8 = 0 THEN '.' ELSE concat(cast(o_custkey AS STRING), '.0') END AS cust, "
          "concat(' ', o_orderpriority, ' ') AS pri, CASE WHEN o_orderkey % 9 = 0 THEN '13322000' ELSE '02282012' END AS seen FROM orders")
_TYPED_LAYOUT = [{"varname": "cust", "type": "int", "length": None}, {"varname": "pri", "type": "char", "length": 4},
                 {"varname": "seen", "type": "datetime", "length": None, "informat": "mmddyy8."}]


@query("apply_layout_types", f"""
SELECT line_number, CASE WHEN cust IN ('n/a', '.') THEN NULL ELSE cust::DOUBLE::INT END AS cust, left(trim(pri), 4) AS pri, CASE WHEN seen = '02282012' THEN DATE '2012-02-28' END AS seen FROM ({_TYPED})""")
def apply_layout_types(t: Tables):
    raw = t.spark.sql(_TYPED.replace("FROM orders", "FROM {o}"), o=t.orders)
    return rounded(lo.apply_layout_types(raw, _TYPED_LAYOUT).data.withColumn("seen", F.to_date("seen")))


@query("apply_layout_errors", f"""
SELECT line_number, 'cust' AS variable, cust AS value FROM ({_TYPED}) WHERE cust = 'n/a' UNION ALL SELECT line_number, 'seen', seen FROM ({_TYPED}) WHERE seen <> '02282012'""")
def apply_layout_errors(t: Tables):
    raw = t.spark.sql(_TYPED.replace("FROM orders", "FROM {o}"), o=t.orders)
    return lo.apply_layout_types(raw, _TYPED_LAYOUT).errors.drop("point_of_failure")


@query("parse_us_date", "SELECT o_orderkey, o_orderdate::DATE AS parsed FROM orders")
def parse_us_date(t: Tables):
    return t.orders.select("o_orderkey", F.to_date(lo.parse_us_date(F.date_format("o_orderdate", "MMddyyyy"))).alias("parsed"))


_CODES = [
    {"import_order": 1, "variable_name": "flag", "start": 1, "end": 1, "type": "nominal", "nominal_values": "A", "std_code": "1"},
    {"import_order": 2, "variable_name": "", "start": None, "end": None, "type": "", "nominal_values": "N", "std_code": "2"},
    {"import_order": 3, "variable_name": "number", "start": 2, "end": 3, "type": "integer", "nominal_values": "7", "std_code": "."},
    {"import_order": 4, "variable_name": "raw", "start": 4, "end": 6, "type": "ID1", "nominal_values": "", "std_code": ""},
]
_CODED = ("SELECT l_orderkey, l_linenumber AS n, l_partkey, l_returnflag AS flag, CASE WHEN l_linenumber = 3 THEN 'x' ELSE cast(l_linenumber AS STRING) END AS number, "
          "CASE WHEN l_linenumber = 2 THEN '-' ELSE cast(cast(l_quantity AS INT) * 10 + 5 AS STRING) END AS raw FROM lineitem")


def _coded(t: Tables):
    return t.spark.sql(_CODED.replace("FROM lineitem", "FROM {l}"), l=t.lineitem)


@query("recode_values", f"""
SELECT l_orderkey, n, l_partkey, CASE flag WHEN 'A' THEN '1' WHEN 'N' THEN '2' ELSE flag END AS flag, CASE WHEN number = '7' OR number = 'x' THEN ' ' ELSE number END AS number,
  CASE WHEN raw = '-' THEN ' ' ELSE cast(raw::DOUBLE / 10 AS VARCHAR) END AS raw FROM ({_CODED})""")
def recode_values(t: Tables):
    return rounded(lo.recode_values(_coded(t), _CODES))


@query("implied_decimal", f"SELECT l_orderkey, n, l_partkey, CASE WHEN raw = '-' THEN raw ELSE cast(raw::DOUBLE / 10 AS VARCHAR) END AS score FROM ({_CODED})")
def implied_decimal(t: Tables):
    return rounded(_coded(t).select("l_orderkey", "n", "l_partkey", lo.implied_decimal("raw", "NOMINAL_ID2").alias("score")))


@query("missing_flag_columns", f"SELECT l_orderkey, n, l_partkey, number, CASE WHEN number = '7' THEN '1' ELSE ' ' END AS \"MISSING_number\" FROM ({_CODED})")
def missing_flag_columns(t: Tables):
    rows = _coded(t).withColumn("number", F.when(F.col("number") != "7", F.col("number")))
    out = lo.missing_flag_columns(rows, _CODES, filled=True)
    return rounded(out.select("l_orderkey", "n", "l_partkey", F.coalesce("number", F.lit("7")).alias("number"), "MISSING_number"))


# Wide answer sheets made of the orders.
_WIDE = ("SELECT o_orderkey AS id, " + ", ".join(f"cast((o_custkey + {i} * o_orderkey) % 5 AS STRING) AS uprx_raw_item_{i}, cast((o_custkey + {i}) % 2 AS STRING) AS uprx_score_item_{i}"
                                                 for i in range(1, 6))
         + ", cast(o_orderkey % 6 AS STRING) AS uprx_oe_pos_1, CASE WHEN o_orderkey % 4 = 0 THEN '-' ELSE '5' END AS uprx_oe_pos_2, "
         "cast(o_custkey % 3 AS STRING) AS uprx_oe_final_1, cast(o_custkey % 4 AS STRING) AS uprx_oe_final_2, o_orderstatus AS status FROM orders")
_PATTERN = r"upr.*_item_{icnt}"


def _wide(t: Tables):
    return t.spark.sql(_WIDE.replace("FROM orders", "FROM {o}"), o=t.orders)


_LONG = " UNION ALL ".join(
    f"SELECT id AS flat_table_id, {i} AS id, uprx_raw_item_{i} AS uprx_raw_item, uprx_score_item_{i} AS uprx_score_item{{oe}} FROM w".replace("{i}", str(i)) for i in range(1, 6))


@query("itemize", f"WITH w AS ({_WIDE}) " + _LONG.replace("{oe}", ""))
def itemize(t: Tables):
    wide = _wide(t)
    return rounded(lo.itemize(wide, "id", lo.detect_item_columns(wide.columns, _PATTERN)))


@query("detect_item_columns", f"WITH w AS ({_WIDE}) SELECT id, family, item, value FROM (" + " UNION ALL ".join(
    f"SELECT id, '{family}' AS family, {i} AS item, uprx_{kind}_item_{i}::VARCHAR AS value FROM w"
    for kind, family in (("raw", "uprx_raw_item"), ("score", "uprx_score_item")) for i in range(1, 6)) + ")")
def detect_item_columns(t: Tables):
    """The values of the families that were found, as long rows."""
    wide = _wide(t)
    families = lo.detect_item_columns(wide.columns, _PATTERN)
    cells = F.array(*[F.struct(F.lit(stem).alias("family"), F.lit(i).alias("item"), F.col(c).cast("string").alias("value"))
                      for stem, columns in families.items() for i, c in enumerate(columns, start=1)])
    return rounded(wide.select("id", F.inline(cells)))


@query("attach_open_ended", f"WITH w AS ({_WIDE}) " + " UNION ALL ".join(
    f"SELECT id AS flat_table_id, {i} AS id, uprx_raw_item_{i} AS uprx_raw_item, uprx_score_item_{i} AS uprx_score_item, CASE WHEN uprx_oe_pos_1 = '{i}' THEN uprx_oe_final_1 "
    f"WHEN uprx_oe_pos_2 = '{i}' THEN uprx_oe_final_2 ELSE ' ' END AS oe_final FROM w" for i in range(1, 6)))
def attach_open_ended(t: Tables):
    wide = _wide(t)
    return rounded(lo.attach_open_ended(wide, "id", lo.detect_item_columns(wide.columns, _PATTERN), ["uprx_oe_pos_1", "uprx_oe_pos_2"],
                                        {"oe_final": ["uprx_oe_final_1", "uprx_oe_final_2"]}))


@query("flat_item_split", f"WITH w AS ({_WIDE}) SELECT id, uprx_oe_pos_1, uprx_oe_pos_2, uprx_oe_final_1, uprx_oe_final_2, status, 5 AS items FROM w")
def flat_item_split(t: Tables):
    out = lo.flat_item_split(_wide(t), "id", {"r": _PATTERN})
    n = out.items["r"].groupBy(F.col("flat_table_id").alias("id")).agg(F.count("*").alias("items"))
    return rounded(out.flat.join(n, "id"))
