"""Merges, dimension joins, complementary merge, linkage."""

from pyspark.sql import functions as F

from ..operators import attempts, complementary, linkage, merge
from .registry import BOOKMAP_SQL, ITEMS, ITEMS_SQL, MASTER_SQL, STUDENTS_SQL, Tables, bookmap, master, query, rounded, students

# Two overlapping views of the orders with made gaps, duplicates and changes.
_LEFT = ("SELECT o_orderkey AS lid, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey % 9000 END AS k, o_orderstatus AS st, o_orderpriority AS pr, "
         "CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderpriority END AS a, o_totalprice AS price FROM orders")
_RIGHT = ("SELECT o_orderkey AS rid, o_orderkey % 6000 AS k, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderstatus END AS st, "
          "CASE WHEN o_orderkey % 5 = 0 THEN concat(o_orderpriority, 'X') ELSE o_orderpriority END AS pr, o_orderpriority AS a, "
          "o_custkey AS cust FROM orders WHERE o_orderkey % 10 < 7")

_MERGE = f"""
WITH l AS ({_LEFT}), r AS ({_RIGHT}),
lc AS (SELECT k, count(*) nl FROM l WHERE k IS NOT NULL GROUP BY k), rc AS (SELECT k, count(*) nr FROM r WHERE k IS NOT NULL GROUP BY k),
i AS (SELECT coalesce(lc.k, rc.k) AS k, nl, nr, coalesce(nl > 1 AND nr > 1, false) AS both_dup FROM lc FULL JOIN rc ON lc.k = rc.k),
p AS (SELECT l.*, r.rid, r.st AS rst, r.pr AS rpr, r.a AS ra, r.cust FROM l JOIN i ON l.k = i.k AND nl IS NOT NULL AND nr IS NOT NULL AND NOT both_dup JOIN r ON r.k = i.k),
s AS (SELECT *, 1.0 - levenshtein(upper(pr) || ' NULL', upper(rpr) || ' NULL')::DOUBLE / greatest(length(pr), length(rpr)) * 0 - 0 AS dummy,
  1.0 - least(levenshtein(upper(pr) || ' NULL', upper(rpr) || ' NULL'), levenshtein('NULL ' || upper(pr), upper(rpr) || ' NULL'))::DOUBLE
    / greatest(length(pr) + 5, length(rpr) + 5) AS sim FROM p),
q AS (SELECT *, CASE WHEN st <> rst THEN 'Optional key mismatch ("' || st || '" vs "' || coalesce(rst, '{{NULL}}') || '")' END AS r1,
  CASE WHEN sim <= 0.8 THEN 'Fuzzy key mismatch ("' || pr || ' {{NULL}}" vs "' || rpr || ' {{NULL}}")' END AS r2 FROM s),
t AS (SELECT *, CASE WHEN r1 IS NOT NULL AND r2 IS NOT NULL THEN r1 || '; ' || r2 ELSE coalesce(r1, r2) END AS reason FROM q)""".replace("{{", "{").replace("}}", "}").replace(
    "1.0 - levenshtein(upper(pr) || ' NULL', upper(rpr) || ' NULL')::DOUBLE / greatest(length(pr), length(rpr)) * 0 - 0 AS dummy,\n  ", "")


def _merged(t: Tables, join_type: str = "I"):
    left = t.spark.sql(_LEFT.replace("FROM orders", "FROM {o}"), o=t.orders)
    right = t.spark.sql(_RIGHT.replace("FROM orders", "FROM {o}"), o=t.orders)
    fields = [merge.MergeField("k", "k", "k", "L"), merge.MergeField("st", "st", "st", "RN"), merge.MergeField("a", "a", "a", "LN"),
              merge.MergeField("price", "price", None, "LO"), merge.MergeField("cust", None, "cust", "RO")]
    return merge.keyed_merge(left, right, "lid", "rid", ["k"], ["st"], ["pr"], 0.8, fields, join_type,
                             allow_dups_left=True, allow_dups_right=True)


_MELD = "lid AS fk_left, rid AS fk_right, k, coalesce(rst, st) AS st, CASE WHEN a = '' THEN ra ELSE a END AS a, price, cust"


@query("keyed_merge", _MERGE + f" SELECT {_MELD} FROM t WHERE reason IS NULL")
def keyed_merge(t: Tables):
    return rounded(_merged(t).output)


@query("keyed_merge_full", _MERGE + f""" SELECT {_MELD} FROM t WHERE reason IS NULL
UNION ALL SELECT lid, NULL, k, st, a, price, NULL FROM l WHERE lid NOT IN (SELECT lid FROM t WHERE reason IS NULL)
UNION ALL SELECT NULL, rid, k, st, a, NULL, cust FROM r WHERE rid NOT IN (SELECT rid FROM t WHERE reason IS NULL)""")
def keyed_merge_full(t: Tables):
    return rounded(_merged(t, "F").output)


@query("keyed_merge_left_remainder", _MERGE + """
SELECT lid AS fk_left, k, st, a, price, cast(NULL AS BIGINT) AS cust, reason AS merge_report FROM (
  SELECT lid, k, st, a, price, 'Missing required key on left' AS reason FROM l WHERE k IS NULL
  UNION ALL SELECT lid, l.k, st, a, price, CASE WHEN both_dup THEN 'Duplicate required key on both sides' ELSE 'No required key match' END FROM l JOIN i ON l.k = i.k
    WHERE both_dup OR nr IS NULL
  UNION ALL SELECT lid, k, st, a, price, reason FROM t WHERE reason IS NOT NULL)""")
def keyed_merge_left_remainder(t: Tables):
    return rounded(_merged(t).left_remainder)


@query("keyed_merge_right_remainder", _MERGE + """
SELECT rid AS fk_right, k, st, a, cast(NULL AS DOUBLE) AS price, cust, reason AS merge_report FROM (
  SELECT rid, r.k, st, a, cust, CASE WHEN both_dup THEN 'Duplicate required key on both sides' ELSE 'No required key match' END AS reason FROM r JOIN i ON r.k = i.k
    WHERE both_dup OR nl IS NULL
  UNION ALL SELECT rid, k, rst, ra, cust, reason FROM t WHERE reason IS NOT NULL)""")
def keyed_merge_right_remainder(t: Tables):
    return rounded(_merged(t).right_remainder)


# Left keys may not repeat; names of two columns, some swapped, some changed.
_ONE_LEFT = ("SELECT o_orderkey AS lid, CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE o_orderkey % 12000 END AS k, o_orderpriority AS given, "
             "concat('c', cast(o_custkey AS VARCHAR(20))) AS family FROM orders")
_ONE_RIGHT = ("SELECT o_orderkey AS rid, o_orderkey % 11000 AS k, CASE WHEN o_orderkey % 3 = 0 THEN concat('c', cast(o_custkey AS VARCHAR(20))) ELSE o_orderpriority END AS given, "
              "CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority WHEN o_orderkey % 4 = 0 THEN concat('x', cast(o_custkey * 7 AS VARCHAR(20))) "
              "WHEN o_orderkey % 5 = 0 THEN NULL ELSE concat('c', cast(o_custkey AS VARCHAR(20))) END AS family FROM orders WHERE o_orderkey % 10 < 7")
_ONE_SIDE = f"""
WITH l AS ({_ONE_LEFT}), r AS ({_ONE_RIGHT}),
lc AS (SELECT k, count(*) AS nl FROM l WHERE k IS NOT NULL GROUP BY k), rc AS (SELECT k, count(*) AS nr FROM r GROUP BY k),
p AS (SELECT l.lid, r.rid, l.k, l.given, l.family, r.given AS rg, r.family AS rf, upper(l.given) || ' ' || upper(l.family) AS a, upper(l.family) || ' ' || upper(l.given) AS b,
    upper(r.given) || ' ' || coalesce(upper(r.family), 'NULL') AS c FROM l JOIN lc ON lc.k = l.k AND nl = 1 JOIN r ON r.k = l.k),
t AS (SELECT *, 1.0 - least(levenshtein(a, c), levenshtein(b, c))::DOUBLE / greatest(length(a), length(c)) AS sim FROM p),
bad AS (SELECT *, 'Fuzzy key mismatch ("' || given || ' ' || family || '" vs "' || rg || ' ' || coalesce(rf, '{{NULL}}') || '")' AS reason FROM t WHERE sim <= 0.8)
SELECT 'output' AS part, lid, rid, NULL AS reason FROM t WHERE sim > 0.8
UNION ALL SELECT 'left', lid, NULL, 'Missing required key on left' FROM l WHERE k IS NULL
UNION ALL SELECT 'left', lid, NULL, CASE WHEN nl > 1 THEN 'Duplicate required key on left' ELSE 'No required key match' END
  FROM l JOIN lc ON lc.k = l.k LEFT JOIN rc ON rc.k = l.k WHERE nl > 1 OR nr IS NULL
UNION ALL SELECT 'right', NULL, rid, 'No required key match' FROM r LEFT JOIN lc ON lc.k = r.k WHERE nl IS NULL OR nl > 1
UNION ALL SELECT 'left', lid, NULL, reason FROM bad UNION ALL SELECT 'right', NULL, rid, reason FROM bad""".replace("{{", "{").replace("}}", "}")


@query("keyed_merge_one_sided_duplicates", _ONE_SIDE)
def keyed_merge_one_sided_duplicates(t: Tables):
    """Output and both remainders where a repeated left key is rejected and names have two columns."""
    left, right = (t.spark.sql(x.replace("FROM orders", "FROM {o}").replace("VARCHAR(20)", "STRING"), o=t.orders) for x in (_ONE_LEFT, _ONE_RIGHT))
    out = merge.keyed_merge(left, right, "lid", "rid", ["k"], [], [["given", "family"]], 0.8, [merge.MergeField("k", "k", "k", "L")],
                            allow_dups_left=False, allow_dups_right=True)
    none = F.lit(None).cast("bigint")
    parts = [out.output.select(F.lit("output").alias("part"), F.col("fk_left").alias("lid"), F.col("fk_right").alias("rid"), F.lit(None).cast("string").alias("reason")),
             out.left_remainder.select(F.lit("left").alias("part"), F.col("fk_left").alias("lid"), none.alias("rid"), F.col("merge_report").alias("reason")),
             out.right_remainder.select(F.lit("right").alias("part"), none.alias("lid"), F.col("fk_right").alias("rid"), F.col("merge_report").alias("reason"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("keyed_merge_fuzzy_report", _MERGE + """
SELECT k, lid AS fk_left, rid AS fk_right, round(sim, 6) AS similarity_1, pr AS lfuzzykey_1_1, cast(NULL AS VARCHAR) AS lfuzzykey_1_2, rpr AS rfuzzykey_1_1,
  cast(NULL AS VARCHAR) AS rfuzzykey_1_2 FROM t WHERE r1 IS NULL""")
def keyed_merge_fuzzy_report(t: Tables):
    return rounded(_merged(t).fuzzy_report)


@query("read_merge_spec", """
SELECT l.c_custkey AS fk_left, r.s_suppkey AS fk_right, l.c_custkey AS id, coalesce(r.s_name, l.c_name) AS name, l.c_acctbal AS left_balance,
  r.s_acctbal AS right_balance FROM customer l JOIN supplier r ON l.c_custkey = r.s_suppkey AND l.c_nationkey = r.s_nationkey""")
def read_merge_spec(t: Tables):
    def row(name, new, priority="", keys=""):
        return {"variable name": name, "newname": new, "priority": priority, "keys": keys, "length": None, "vartype": None}

    left_sheet = [row("c_custkey", "id", "first", "primary1"), row("c_name", "name", "second"), row("c_nationkey", "<drop>", "", "secondary1"),
                  row("c_acctbal", "left_balance"), row("c_mktsegment", "<drop>")]
    right_sheet = [row("s_suppkey", "id", "second", "primary1"), row("s_name", "name", "first non-missing"),
                   row("s_nationkey", "<drop>", "", "secondary1"), row("s_acctbal", "right_balance")]
    spec = merge.read_merge_spec(left_sheet, right_sheet, t.customer, t.supplier)
    out = merge.keyed_merge(t.customer, t.supplier, "c_custkey", "s_suppkey", spec.required, spec.optional, fields=spec.fields)
    return rounded(out.output)


@query("sas_merge", """
WITH l AS (SELECT c_custkey AS k, c_name AS name, c_acctbal AS a FROM customer WHERE c_custkey % 3 <> 0),
r AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 2 = 0 THEN NULL ELSE s_name END AS name, s_acctbal AS b FROM supplier)
SELECT coalesce(l.k, r.k) AS k, CASE WHEN r.k IS NOT NULL THEN r.name ELSE l.name END AS name, a, b FROM l FULL JOIN r ON l.k = r.k""")
def sas_merge(t: Tables):
    left = t.customer.where("c_custkey % 3 <> 0").selectExpr("c_custkey AS k", "c_name AS name", "c_acctbal AS a")
    right = t.supplier.selectExpr("s_suppkey AS k", "CASE WHEN s_suppkey % 2 = 0 THEN NULL ELSE s_name END AS name", "s_acctbal AS b")
    return merge.sas_merge(left, right, ["k"])


@query("attach_dimension", f"""
WITH s AS ({STUDENTS_SQL}), m AS (SELECT * FROM ({MASTER_SQL}) QUALIFY row_number() OVER (PARTITION BY dcrxid_c ORDER BY bcrxid_c) = 1)
SELECT id, CASE WHEN trim(county) <> '' THEN county ELSE coalesce(m.dcxx_county, county) END AS county, m.dcrxnm AS home_name
FROM (SELECT id, dcrxid_home, CASE WHEN id % 2 = 0 THEN dcxx_county ELSE '' END AS county FROM s) x LEFT JOIN m ON x.dcrxid_home = m.dcrxid_c""")
def attach_dimension(t: Tables):
    rows = students(t).select("id", "dcrxid_home", F.when(F.col("id") % 2 == 0, F.col("dcxx_county")).otherwise("").alias("county"))
    out = merge.attach_dimension(rows, master(t), {"dcrxid_home": "dcrxid_c"}, {"home_name": "dcrxnm"}, ["bcrxid_c"], {"county": "dcxx_county"})
    return rounded(out.drop("dcrxid_home"))


@query("join_parts", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def join_parts(t: Tables):
    c = t.customer
    return merge.join_parts([c.select("c_custkey", "c_name"), c.select("c_custkey", "c_name", "c_acctbal"),
                             c.select("c_custkey", "c_mktsegment")], "c_custkey")


@query("missing_from_dimension", """
SELECT c_custkey, 'missing' AS side FROM customer WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = c_nationkey AND s_suppkey % 2 = 0)
UNION ALL SELECT c_custkey, 'present' FROM customer WHERE EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = c_nationkey AND s_suppkey % 2 = 0)""")
def missing_from_dimension(t: Tables):
    dim, on = t.supplier.where("s_suppkey % 2 = 0"), {"c_nationkey": "s_nationkey"}
    gone = merge.missing_from_dimension(t.customer, dim, on).select("c_custkey", F.lit("missing").alias("side"))
    here = merge.missing_from_dimension(t.customer, dim, on, present=True).select("c_custkey", F.lit("present").alias("side"))
    return gone.unionByName(here)


_RULES = [
    {"variable_name": "person", "resolution_rule": "common", "keys": "primary"},
    {"variable_name": "room", "resolution_rule": "common, non-missing", "keys": "secondary"},
    {"variable_name": "barcode", "resolution_rule": "common", "keys": "sort"},
    {"variable_name": "vp", "resolution_rule": "variable priority", "keys": ""},
    {"variable_name": "rp", "resolution_rule": "record priority", "keys": ""},
    *[{"variable_name": f"u{i}", "resolution_rule": f"unit {i} indicator", "keys": ""} for i in (1, 2, 3)],
    *[{"variable_name": f"s{i}", "resolution_rule": f"test unit {i}", "keys": ""} for i in (1, 2, 3)],
]


# A third of the users are one person; the others as in ``_partial_records``.
_CROWD = "CASE WHEN user_id % 3 = 0 THEN 'crowd' ELSE {} END"


def _partial_records(t: Tables, crowd: bool = False):
    """Events as partial records: a person is a user within an hour, the unit
    is the event type, the room is missing on some records."""
    person = "concat(cast(user_id AS STRING), '-', date_format(ts, 'yyyyMMddHH'))"
    kinds = {1: "('click', 'error')", 2: "('view')", 3: "('purchase', 'signup')"}
    return t.events.selectExpr(
        "event_id AS id", f"{_CROWD.format(person) if crowd else person} AS person",
        "CASE WHEN event_id % 3 = 0 THEN NULL ELSE cast(event_id % 2 AS STRING) END AS room",
        "CASE WHEN event_id % 50 = 0 THEN NULL ELSE event_id END AS barcode", "cast(event_id % 4 AS INT) AS vp",
        "CASE WHEN event_id % 40 = 0 THEN 1000 + cast(event_id % 7 AS INT) ELSE cast(event_id % 5 AS INT) END AS rp",
        *[f"CASE WHEN event_type IN {k} THEN 1 ELSE 0 END AS u{i}" for i, k in kinds.items()],
        *[f"CASE WHEN event_type IN {k} THEN value END AS s{i}" for i, k in kinds.items()])


# Items of a record: an answer, a note and a mark that is missing on some.
_PART_ITEMS = ("SELECT event_id AS flat_table_id, k AS id, concat(event_type, '-', cast((event_id * k) % 11 AS VARCHAR(20))) AS answer, "
               "cast((event_id + k) % 7 AS VARCHAR(20)) AS note, CASE WHEN (event_id * k) % 3 = 0 THEN '' ELSE concat('m', cast(event_id % 13 AS VARCHAR(20))) END AS mark")

_UNITS = {1: "('click', 'error')", 2: "('view')", 3: "('purchase', 'signup')"}


def _folded_sql(force: bool, what: str = "flat", crowd: bool = False) -> str:
    """The same rules as an ordered fold: partner groups by room, then one recursive step per record of a group."""
    def each(form: str, sep: str = ", ") -> str:
        return sep.join(form.replace("#", str(i)) for i in _UNITS)

    columns = "id, person, room, barcode, vp, rp, u1, u2, u3, s1, s2, s3"
    boxed = "arg_max({'v': %s}, seq) FILTER (%s)"

    def last(column: str, test: str) -> str:
        return f"coalesce({boxed % (column, test)}, {boxed % (column, 'base')}).v AS {column}"

    counted = """
SELECT count(*) AS matching_rows_read, (SELECT count(*) FROM leads) + count(*) FILTER (role = 'kept') AS matching_rows_written,
  count(*) FILTER (role = 'merged') AS merged_records, count(*) FILTER (overlapped) AS overlapping_records,
  count(*) FILTER (overlapped AND role <> 'kept') AS forced_records, count(*) FILTER (role IN ('base', 'picked_out')) AS picked_records,
  (SELECT count(*) FROM g WHERE cluster IS NULL OR n > 1 AND first_id IS NULL) AS missing_sort_keys FROM f"""
    items = f"""
SELECT owner AS flat_table_id, id, {last("answer", "f1")}, {last("note", "prio")},
  coalesce(arg_min({{'v': mark}}, seq) FILTER (mark <> ''), arg_max({{'v': mark}}, seq)).v AS mark
FROM m JOIN ({_PART_ITEMS} FROM events, range(1, 4) t(k) WHERE (event_id + k) % 5 <> 0) i ON i.flat_table_id = m.mid GROUP BY owner, id HAVING bool_or(base)
UNION ALL SELECT flat_table_id, id, answer, note, mark FROM ({_PART_ITEMS} FROM events, range(1, 4) t(k) WHERE (event_id + k) % 5 <> 0) i
WHERE flat_table_id IN (SELECT row_id FROM f WHERE role = 'kept' UNION ALL SELECT id FROM g WHERE cluster IS NULL OR n = 1 OR first_id IS NULL)"""
    person = "user_id || '-' || strftime(ts, '%Y%m%d%H')"
    return f"""
WITH RECURSIVE e AS (SELECT event_id AS id, {_CROWD.format(person) if crowd else person} AS person,
    CASE WHEN event_id % 3 = 0 THEN NULL ELSE (event_id % 2)::VARCHAR END AS room, CASE WHEN event_id % 50 = 0 THEN NULL ELSE event_id END AS barcode,
    event_id % 4 AS vp, CASE WHEN event_id % 40 = 0 THEN 1000 + event_id % 7 ELSE event_id % 5 END AS rp,
    {", ".join(f"CASE WHEN event_type IN {k} THEN 1 ELSE 0 END AS u{i}" for i, k in _UNITS.items())},
    {", ".join(f"CASE WHEN event_type IN {k} THEN value END AS s{i}" for i, k in _UNITS.items())} FROM events),
pat AS (SELECT person, room, min(barcode) AS fb FROM e GROUP BY person, room),
per AS (SELECT person, count(*) > 1 AND bool_or(room IS NULL) AS mixed, arg_min(coalesce(room, '~'), fb) AS lead FROM pat GROUP BY person),
cl AS (SELECT pat.person, room, CASE WHEN NOT mixed THEN person || '|' || coalesce(room, '') WHEN lead IS NULL THEN NULL WHEN lead = '~' THEN person || '|'
    WHEN room IS NULL THEN person || '|' || lead WHEN fb IS NOT NULL THEN person || '|' || room END AS cluster FROM pat JOIN per USING (person)),
g AS (SELECT e.*, cluster, count(*) OVER (PARTITION BY cluster) AS n, min(barcode) OVER (PARTITION BY cluster) AS first_id
    FROM e JOIN cl ON e.person = cl.person AND e.room IS NOT DISTINCT FROM cl.room),
r AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY id <> first_id, barcode NULLS FIRST, id) AS rn FROM g
    WHERE cluster IS NOT NULL AND n > 1 AND first_id IS NOT NULL),
f AS (
  SELECT cluster, n, rn, id AS base, barcode AS sort, rp, vp, u1, u2, u3, '' AS report, 0 AS seq, id AS row_id, 'lead' AS role, id AS kept_id,
    FALSE AS prio, {each("FALSE AS f#")}, '' AS own, FALSE AS overlapped FROM r WHERE rn = 1
  UNION ALL
  SELECT cluster, n, rn, CASE role WHEN 'base' THEN nid ELSE base END, CASE WHEN takes THEN nsort ELSE sort END, CASE WHEN takes THEN nrp ELSE rp END,
    CASE WHEN takes THEN nvp ELSE vp END, {each("CASE WHEN role = 'base' OR role = 'merged' AND n# > 0 THEN n# ELSE u# END")},
    CASE role WHEN 'base' THEN ' Picked one. (B)' || forced WHEN 'picked_out' THEN report || ' Picked one. (A)' || forced
      WHEN 'kept' THEN report || ' Records [' || st || '] and [' || nt || '] have an overlapping attempt indicator column.'
      ELSE report || ' Merged [' || st || '] with  [' || nt || '].' END,
    CASE role WHEN 'base' THEN 0 WHEN 'merged' THEN seq + 1 ELSE seq END, nid, role, CASE role WHEN 'merged' THEN base ELSE nid END,
    role = 'merged' AND second, {each("role = 'merged' AND (n# > 0 OR u# = 0 AND n# = 0 AND second)")},
    ' Records [' || nt || '] and [' || st || '] have an overlapping attempt indicator column.', overlap
  FROM (SELECT *, role = 'base' OR role = 'merged' AND second AS takes, CASE WHEN overlap THEN ' Forced.' ELSE '' END AS forced,
      coalesce(sort::VARCHAR, 'None') AS st, coalesce(nsort::VARCHAR, 'None') AS nt
    FROM (SELECT * EXCLUDE (role), CASE WHEN high OR overlap AND {force} THEN CASE WHEN rp < nrp THEN 'base' ELSE 'picked_out' END
        WHEN overlap THEN 'kept' ELSE 'merged' END AS role
      FROM (SELECT f.* EXCLUDE (rn), r.rn, r.id AS nid, r.barcode AS nsort, r.rp AS nrp, r.vp AS nvp, {each("r.u# AS n#")}, r.vp > f.vp AS second,
          f.rp >= 1000 OR r.rp >= 1000 AS high, NOT (f.rp >= 1000 OR r.rp >= 1000) AND ({each("f.u# = 1 AND r.u# = 1", " OR ")}) AS overlap
        FROM f JOIN r ON r.cluster = f.cluster AND r.rn = f.rn + 1)))),
leads AS (SELECT base, nullif(report, '') AS report FROM f WHERE rn = n),
m AS (SELECT leads.base AS owner, 0 AS seq, TRUE AS base, FALSE AS prio, {each("FALSE AS f#")}, leads.base AS mid FROM leads
  UNION ALL SELECT kept_id, seq, FALSE, prio, f1, f2, f3, row_id FROM f WHERE role = 'merged' AND kept_id IN (SELECT base FROM leads)),
merged AS (SELECT owner AS id, any_value(person) AS person,
    coalesce(arg_max(room, seq) FILTER (prio AND room IS NOT NULL), arg_min(room, seq) FILTER (room IS NOT NULL)) AS room,
    {", ".join(last(c, "prio") for c in ("barcode", "vp", "rp"))}, {", ".join(last(f"u{i}", f"NOT base AND u{i} > 0") for i in _UNITS)},
    {", ".join(last(f"s{i}", f"f{i}") for i in _UNITS)} FROM m JOIN e ON e.id = m.mid GROUP BY owner)
""" + (counted if what == "counters" else items if what == "items" else f"""
SELECT {columns.replace("id,", "merged.id,", 1)}, report AS complementary_merge_report FROM merged JOIN leads ON leads.base = merged.id
UNION ALL SELECT {columns}, own FROM e JOIN (SELECT row_id, own FROM f WHERE role = 'kept') ON row_id = id
UNION ALL SELECT {columns}, CASE WHEN n > 1 OR cluster IS NULL THEN ' Missing sort key.' END FROM g WHERE cluster IS NULL OR n = 1 OR first_id IS NULL""")


@query("complementary_merge", _folded_sql(False))
def complementary_merge(t: Tables):
    return rounded(complementary.complementary_merge(_partial_records(t), _RULES).flat)


@query("complementary_merge_forced", _folded_sql(True))
def complementary_merge_forced(t: Tables):
    return rounded(complementary.complementary_merge(_partial_records(t), _RULES, force_one=True).flat)


@query("complementary_merge_counters", _folded_sql(True, "counters"))
def complementary_merge_counters(t: Tables):
    return rounded(complementary.complementary_merge(_partial_records(t), _RULES, force_one=True).counters)


@query("complementary_merge_ranges", _folded_sql(False, crowd=True))
def complementary_merge_ranges(t: Tables):
    """One person holds a third of all records, whose partner groups are folded in many ranges."""
    return rounded(complementary.complementary_merge(_partial_records(t, crowd=True), _RULES, ranges=24).flat)


@query("complementary_merge_items", _folded_sql(False, "items", crowd=True))
def complementary_merge_items(t: Tables):
    """Item rows of merged records, by a unit rule, a common one and an 'or'."""
    rules = _RULES + [{"variable_name": "answer", "resolution_rule": "test unit 1", "keys": ""},
                      {"variable_name": "note", "resolution_rule": "common", "keys": ""},
                      {"variable_name": "mark", "resolution_rule": "or", "keys": ""}]
    items = t.spark.sql(
        f"{_PART_ITEMS} FROM (SELECT *, explode(sequence(1L, 3L)) AS k FROM {{e}}) WHERE (event_id + k) % 5 <> 0", e=t.events)
    out = complementary.complementary_merge(_partial_records(t, crowd=True), rules, items={"m": items})
    return rounded(out.items["m"])


@query("complementary_merge_pairs", """
WITH e AS (SELECT event_id AS id, 'u' || user_id || event_type AS person, value AS v, event_type AS kind,
    row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM events)
SELECT min_by(id, rn) AS id, person, min(id) AS barcode, max(id % 4) AS vp,
  max_by(v, vp2) AS v, coalesce(min_by(CASE WHEN id % 3 <> 0 THEN kind END, rn), '') AS note
FROM (SELECT *, (id % 4) * 1000000000 - rn AS vp2 FROM e) GROUP BY person""")
def complementary_merge_pairs(t: Tables):
    """No unit indicators: all records of a person fold into the first; the
    value follows the first record of the highest priority."""
    rules = [{"variable_name": "person", "resolution_rule": "common", "keys": "primary"},
             {"variable_name": "barcode", "resolution_rule": "or", "keys": "sort"},
             {"variable_name": "vp", "resolution_rule": "variable priority", "keys": ""},
             {"variable_name": "v", "resolution_rule": "common", "keys": ""},
             {"variable_name": "note", "resolution_rule": "or", "keys": ""}]
    rows = t.events.selectExpr("event_id AS id", "concat('u', cast(user_id AS STRING), event_type) AS person", "event_id + 1 AS barcode",
                               "event_id % 4 AS vp", "value AS v", "CASE WHEN event_id % 3 <> 0 THEN event_type ELSE '' END AS note")
    out = complementary.complementary_merge(rows, rules).flat
    return rounded(out.select("id", "person", (F.col("barcode") - 1).alias("barcode"), "vp", "v", "note"))


_ATTEMPTS = f"""
WITH s AS ({STUDENTS_SQL}), i AS ({ITEMS_SQL}), b AS ({BOOKMAP_SQL}),
p AS (SELECT DISTINCT "item position" AS pos, "item format" AS f FROM b),
a AS (SELECT flat_table_id, max(CASE WHEN f = 'MC' AND answer NOT IN ('', '-') OR f <> 'MC' AND oe_final NOT IN ('A', 'B', '') THEN 1 ELSE 0 END) AS hit
  FROM i JOIN p ON i.id = p.pos GROUP BY flat_table_id)"""


def _with_items(t: Tables):
    items = t.derived("lineitem", ITEMS).select("flat_table_id", "id", F.col("answer").alias("upmx_raw_item"), F.col("oe_final").alias("upmx_oe_final"))
    return students(t), {"m": items}


@query("derive_attempt_flags", _ATTEMPTS + """
SELECT s.id, CASE WHEN ufmx_invalid = '1' THEN 0 ELSE coalesce(hit, 0) END AS attempt_m,
  CASE WHEN try_cast(ucrxgen AS DOUBLE) = 1 THEN '1' WHEN try_cast(ucrxgen AS DOUBLE) = 2 THEN '2' ELSE '' END AS gender,
  try_cast(CASE WHEN dob_year = '' THEN NULL ELSE dob_year || '-' || lpad(dob_month, 2, '0') || '-' || lpad(dob_day, 2, '0') END AS DATE) AS dob,
  preidflag * 10 + CASE WHEN ufmx_invalid = '1' THEN 0 ELSE coalesce(hit, 0) END AS variable_priority
FROM s LEFT JOIN a ON s.id = a.flat_table_id""")
def derive_attempt_flags(t: Tables):
    flat, items = _with_items(t)
    out = attempts.derive_attempt_flags(flat, items, bookmap(t), grade="10")
    return rounded(out.select("id", "attempt_m", "gender", "dob", "variable_priority"))


# Needles: the suppliers; haystack: the customers.
_NEEDLES = ("SELECT s_nationkey AS nation, cast(floor(s_acctbal / 1000) AS INT) AS band, s_suppkey % 10 AS digit, replace(s_name, 'Supplier', 'Customer') AS fnm, "
            "concat('x', cast(s_suppkey AS STRING)) AS lnm FROM supplier")
_HAYSTACK = ("SELECT c_custkey AS hid, c_nationkey AS nation, cast(floor(c_acctbal / 1000) AS INT) AS band, c_custkey % 10 AS digit, "
             "c_name AS fnm, concat('x', cast(c_custkey AS STRING)) AS lnm FROM customer")
_SIM = ("round(20 * (1.0 - least(levenshtein(upper({0}.fnm) || ' ' || upper({0}.lnm), upper({1}.fnm) || ' ' || upper({1}.lnm)), "
        "levenshtein(upper({0}.lnm) || ' ' || upper({0}.fnm), upper({1}.fnm) || ' ' || upper({1}.lnm)))::DOUBLE "
        "/ greatest(length({0}.fnm || ' ' || {0}.lnm), length({1}.fnm || ' ' || {1}.lnm))))::INT")
_LINK = f"""
WITH n AS (SELECT DISTINCT * FROM ({_NEEDLES})), h AS ({_HAYSTACK}),
top AS (SELECT fnm, lnm FROM h ORDER BY hid LIMIT 20),
cal AS (SELECT {_SIM.format('top', 'h')} AS sim, count(*) c FROM top, h GROUP BY 1),
steps AS (SELECT i AS sim, pow((SELECT coalesce(sum(c), 0) FROM cal WHERE sim >= i)::DOUBLE / (SELECT sum(c) FROM cal), 1.5) AS chance FROM range(21) v(i)),
fn AS (SELECT nation, pow(count(*)::DOUBLE / (SELECT count(*) FROM h), 4.0) f FROM h GROUP BY nation),
fb AS (SELECT band, pow(count(*)::DOUBLE / (SELECT count(*) FROM h), 4.0) f FROM h GROUP BY band),
fd AS (SELECT pow(1.0 / count(DISTINCT digit), 4.0) f FROM h),
p AS (SELECT n.*, hid, CASE WHEN n.nation = h.nation THEN coalesce(fn.f, 1) ELSE 1 END * CASE WHEN n.band = h.band THEN coalesce(fb.f, 1) ELSE 1 END
    * CASE WHEN n.digit = h.digit THEN fd.f ELSE 1 END AS agree, {_SIM.format('h', 'n')} AS sim
  FROM n LEFT JOIN fn ON n.nation = fn.nation LEFT JOIN fb ON n.band = fb.band, fd, h {{}}),
q AS (SELECT p.*, agree * chance AS prob FROM p JOIN steps ON p.sim = steps.sim),
r AS (SELECT *, rank() OVER (PARTITION BY nation, band, digit, fnm, lnm ORDER BY prob) AS rank FROM q WHERE prob < {{}})
SELECT fnm AS n_fnm, hid, round(log10(prob), 6) AS log_prob, rank FROM r WHERE rank <= 2"""


def _linked(t: Tables, cut: float, **options):
    needles = t.spark.sql(_NEEDLES.replace("FROM supplier", "FROM {x}"), x=t.supplier)
    haystack = t.spark.sql(_HAYSTACK.replace("FROM customer", "FROM {x}"), x=t.customer)
    out = linkage.find_matches(needles, haystack, {"nation": 4.0, "band": 4.0}, {"digit": 4.0}, ("fnm", "lnm"), 1.5, "hid", cut, 2,
                               ["hid"], **options)
    return out.select(F.col("N_fnm").alias("n_fnm"), "hid", F.round(F.log10("prob"), 6).alias("log_prob"), F.col("rank").cast("bigint").alias("rank"))


@query("find_matches", _LINK.format("", "1e-12"))
def find_matches(t: Tables):
    return _linked(t, 1e-12)


@query("find_matches_blocked", _LINK.format("WHERE n.nation = h.nation", "1e-12"))
def find_matches_blocked(t: Tables):
    return _linked(t, 1e-12, blocking=["nation"])


@query("nominal_frequencies", """
SELECT c_mktsegment AS value, round(pow(count(*)::DOUBLE / (SELECT count(*) FROM customer), 1.5), 9) AS freq FROM customer GROUP BY c_mktsegment""")
def nominal_frequencies(t: Tables):
    return rounded(linkage.nominal_frequencies(t.customer, "c_mktsegment", 1.5), 9)
