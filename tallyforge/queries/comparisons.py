"""Comparisons of groups with parents, peers and regressions; erasures."""

from pyspark.sql import functions as F

from ..operators import cascade as cascade_op
from ..operators import erasure, peers, ttest as ttest_op
from .registry import BOOKMAP_SQL, ITEMS, ITEMS_SQL, Tables, bookmap, query, rounded

_TTEST = """
WITH d AS (SELECT c_nationkey, n_regionkey, c_acctbal AS x, {t} AS tw, {p} AS pw FROM customer JOIN nation ON c_nationkey = n_nationkey),
t AS (SELECT n_regionkey, c_nationkey, sum(x) tt, count(x) tn, var_pop(x) * count(x) tc FROM d WHERE tw GROUP BY ALL),
p AS (SELECT n_regionkey, sum(x) pt, count(x) pn, var_pop(x) * count(x) pc FROM d WHERE pw GROUP BY ALL),
j AS (SELECT *, CASE WHEN pn = tn THEN 0 ELSE greatest(0, pc - tc + pt*pt/pn - tt*tt/tn - (pt-tt)*(pt-tt)/(pn-tn)) END AS num FROM t JOIN p USING (n_regionkey)),
e AS (SELECT *, CASE WHEN pn - tn > 1 THEN sqrt(num * (pn - tn) / (pn - tn - 1)) / pn ELSE 0 END AS se FROM j),
v AS (SELECT *, CASE WHEN se > 0 THEN (tt/tn - pt/pn) / se WHEN pn - tn > 1 AND tt/tn > pt/pn THEN 10 * {c} WHEN pn - tn > 1 AND tt/tn < pt/pn THEN -10 * {c} ELSE 0 END AS tv FROM e),
r AS (SELECT *, CASE WHEN trunc(0.5 + pt/pn) = trunc(0.5 + tt/tn) THEN 2 WHEN tv < -{c} THEN 1 WHEN tv > {c} THEN 3 ELSE 2 END AS code FROM v)"""


def _customers(t: Tables):
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).withColumns({
        "even": (F.col("c_custkey") % 2 == 0).cast("int"), "third": (F.col("c_custkey") % 3).cast("int")})


@query("ttest_level", _TTEST.format(t="true", p="true", c="1.28") + """
SELECT n_regionkey, c_nationkey, code, round(tv, 6) AS ttest_value, round(se, 6) AS ttest_se, round(tt/tn, 6) AS target_mean, round(pt/pn, 6) AS parent_mean,
  tn AS target_n, pn AS parent_n FROM r""")
def ttest_level(t: Tables):
    return rounded(ttest_op.ttest_level(_customers(t), ["c_nationkey"], ["n_regionkey"], "c_acctbal", "code", 1.28, details=True))


@query("ttest", _TTEST.format(t="c_custkey % 2 = 0", p="c_custkey % 3 <> 1 AND c_custkey % 3 = 0", c="1.5").replace(
    "c_custkey % 3 <> 1 AND ", "") + " SELECT c_nationkey, code AS below_above FROM r")
def ttest(t: Tables):
    sheet = [{"outputvar": "below_above", "inputvar": "c_acctbal", "targetlevel": "nation", "targetid": "c_nationkey", "wheret": "even",
              "wheret_value": "1", "parentlevel": "region", "parentid": "n_regionkey", "wherep": "third", "wherep_value": "0", "critval": 1.5}]
    return rounded(ttest_op.ttest(_customers(t), sheet)["nation"])


@query("cascade", """
WITH g AS (SELECT l_suppkey, avg(l_quantity) AS x, avg(l_extendedprice) AS y FROM lineitem GROUP BY l_suppkey),
a AS (SELECT count(*) n, avg(x) mx, avg(y) my FROM g),
s AS (SELECT any_value(n) n, any_value(mx) mx, any_value(my) my, sum((x-mx)*(x-mx)) sxx, sum((x-mx)*(y-my)) sxy, sum((y-my)*(y-my)) syy FROM g, a),
v AS (SELECT l_suppkey, (y - my - sxy/sxx*(x-mx)) / sqrt((syy - sxy*sxy/sxx)/(n-2) * (1.0/n + (x-mx)*(x-mx)/sxx + 1)) AS ty,
  (x - mx - sxy/syy*(y-my)) / sqrt((sxx - sxy*sxy/syy)/(n-2) * (1.0/n + (y-my)*(y-my)/syy + 1)) AS tx FROM g, s)
SELECT l_suppkey, CASE WHEN tx < -1 THEN 1 WHEN tx > 1 THEN 3 ELSE 2 END AS quantity, CASE WHEN ty < -1 THEN 1 WHEN ty > 1 THEN 3 ELSE 2 END AS price FROM v""")
def cascade(t: Tables):
    sheet = [{"outputvar": o, "subject": "x", "level": "supplier", "levelvar": "l_suppkey", "inputvar": v, "criterion": 1.0, "wherevar": None,
              "wherevalue": None} for o, v in (("quantity", "l_quantity"), ("price", "l_extendedprice"))]
    return rounded(cascade_op.cascade(t.lineitem, sheet)[("supplier", "x")])


def _peer_lists(t: Tables):
    k = F.col("n_nationkey")
    return t.nation.select(k.alias("F1"), *[((k + i) % 25).alias(f"F{i + 1}") for i in range(1, 7)], ((k + 2) % 25).alias("F8"))


_PEERS = """
WITH pl AS (SELECT DISTINCT n_nationkey AS f1, (n_nationkey + i) % 25 AS peer FROM nation, (VALUES (1),(2),(3),(4),(5),(6)) v(i)),
d AS (SELECT c_nationkey, count(*) w, sum(CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_acctbal END) / count(*) AS m,
  sqrt(abs(sum(CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_acctbal END * CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_acctbal END)
    - pow(sum(CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_acctbal END), 2) / count(*)) / (count(*) - 1)) AS sd FROM customer GROUP BY c_nationkey),
p AS (SELECT f1, sum(w) n, sum(w * m) tot, sum((w - 1) * sd * sd + w * m * m) sq FROM pl JOIN d ON peer = c_nationkey GROUP BY f1),
q AS (SELECT d.*, n, tot / n AS pred, sqrt(greatest(0, (sq - n * pow(tot / n, 2)) / n / (n - 1))) AS se FROM d JOIN p ON c_nationkey = f1)"""


@query("peer_compare", _PEERS + """
SELECT c_nationkey, round(pred + 1e-10) AS peer_mean, CASE WHEN round(m) = round(pred) THEN 2 WHEN (m - pred) / se < -1.3 THEN 1 WHEN (m - pred) / se > 1.3 THEN 3 ELSE 2 END AS code
FROM q""")
def peer_compare(t: Tables):
    data = t.customer.withColumn("x", F.when(F.col("c_custkey") % 9 != 0, F.col("c_acctbal")))
    sheet = [{"outputvar": o, "inputvar": "x", "subject": "all", "wherevar": None, "wherevalue": None, "type": k}
             for o, k in (("peer_mean", "Mean"), ("code", "TTEST"))]
    return rounded(peers.peer_compare(data, sheet, _peer_lists(t), "c_nationkey", 1.3))


@query("peer_join", _PEERS + " SELECT f1 AS \"F1\", c_custkey FROM pl JOIN customer ON peer = c_nationkey")
def peer_join(t: Tables):
    out = peers.peer_join(t.customer.select("c_custkey", "c_nationkey"), _peer_lists(t), "c_nationkey")
    return rounded(out.select(F.col("F1").cast("bigint").alias("F1"), "c_custkey"))


_DECODE = "CASE {0} WHEN 'A' THEN 10 WHEN 'B' THEN 11 WHEN 'C' THEN 12 WHEN 'D' THEN 13 WHEN 'E' THEN 14 WHEN 'F' THEN 15 ELSE coalesce(try_cast({0} AS DOUBLE), 0) END"
_ERASURES = f"""
WITH i AS ({ITEMS_SQL}), b AS ({BOOKMAP_SQL}),
x AS (SELECT flat_table_id, {_DECODE.format('raw_intensity')} AS r, {_DECODE.format('second_inten')} AS s2, raw_editor = '1' AS ed, second_dark::DOUBLE AS dark,
    coalesce(try_cast(answer AS DOUBLE), 0) AS ans, coalesce(try_cast(score AS DOUBLE), 0) AS sc, "numeric key"::DOUBLE AS k
  FROM i JOIN b ON i.id = b."item position" AND b.form_values = CASE WHEN flat_table_id % 2 = 0 THEN 'A' ELSE 'B' END WHERE b."item format" = 'MC'),
y AS (SELECT *, (r > 10 AND s2 > 10) AS m1, (r >= 5 AND r - s2 < 3) AS m2 FROM x),
z AS (SELECT *, (r >= 5 AND s2 >= 3 AND NOT m1 AND NOT m2)::INT + (m1 AND ed)::INT + (m2 AND ed)::INT AS times FROM y),
c AS (SELECT flat_table_id AS sheet, 'm' AS subject, sum(times)::BIGINT AS erased, sum(CASE WHEN dark <> k AND ans = k THEN times ELSE 0 END)::BIGINT AS w_r,
  sum(CASE WHEN dark <> k AND ans <> k THEN times ELSE 0 END)::BIGINT AS w_w, sum(CASE WHEN dark = k AND ans <> k THEN times ELSE 0 END)::BIGINT AS r_w,
  sum(sc) AS raw, count(*) AS itemcount FROM z GROUP BY flat_table_id)"""


def _erasure_counts(t: Tables):
    items = t.derived("lineitem", ITEMS).select(
        F.col("flat_table_id").alias("sheet"), F.lit("m").alias("subject"), F.col("id").alias("item_position"), "raw_intensity",
        "second_inten", "raw_editor", "second_dark", F.col("answer").alias("raw_item"), F.col("score").alias("score_item"))
    sheets = t.lineitem.select(F.col("l_orderkey").alias("sheet")).distinct().select(
        "sheet", F.lit("m").alias("subject"), F.when(F.col("sheet") % 2 == 0, "A").otherwise("B").alias("form"))
    return erasure.erasure_counts(items, erasure.erasure_keys(bookmap(t)), sheets)


@query("erasure_counts", _ERASURES + " SELECT * FROM c")
def erasure_counts(t: Tables):
    return rounded(_erasure_counts(t))


# Sheets: one per order, in two vertical parts; wide items, blank where an order has no such line.
_SHEET = {
    "lithocode": "o_orderkey", "studentid": "o_custkey", "ssid": "concat('SS', cast(o_custkey AS STRING))", "grade": "'10'",
    "dcrxid_attend": "lpad(cast(o_custkey % 25 AS STRING), 6, '0')", "dcrxnm_attend": "concat('district ', cast(o_custkey % 25 AS STRING))",
    "bcrxid_attend": "lpad(cast(o_custkey % 120 AS STRING), 6, '0')", "bcrxnm_attend": "concat('school ', cast(o_custkey % 120 AS STRING))",
    "schtype_attend": "CASE WHEN o_orderkey % 11 = 0 THEN 'H' ELSE 'P' END",
    "upmxraw": "CASE WHEN o_orderkey % 13 = 0 THEN 'A' WHEN o_orderkey % 17 = 0 THEN 'I' ELSE '20' END",
    "upmxlev": "cast(o_orderkey % 6 AS STRING)",
}
_MEASURES = {"raw_intensity": "raw_intensity", "second_inten": "second_inten", "raw_editor": "raw_editor", "second_dark": "second_dark",
             "raw_item": "answer", "score_item": "score"}
_SHEET_SQL = "SELECT " + ", ".join(f'{e} AS "{n}"' for n, e in _SHEET.items()) + ", CASE WHEN o_orderkey % 2 = 0 THEN 'A' ELSE 'B' END AS form FROM orders"


@query("erasure_analysis", f"""
WITH i AS (SELECT flat_table_id, id, {', '.join(f'max({c}) AS {c}' for c in _MEASURES.values())} FROM ({ITEMS_SQL}) GROUP BY ALL), b AS ({BOOKMAP_SQL}), s AS ({_SHEET_SQL}),
x AS (SELECT lithocode AS sheet, coalesce({_DECODE.format('raw_intensity')}, 0) AS r, coalesce({_DECODE.format('second_inten')}, 0) AS s2,
    coalesce(raw_editor = '1', FALSE) AS ed, coalesce(second_dark::DOUBLE, 0) AS dark, coalesce(try_cast(answer AS DOUBLE), 0) AS ans,
    coalesce(try_cast(score AS DOUBLE), 0) AS sc, "numeric key"::DOUBLE AS k
  FROM s JOIN b ON b.form_values = s.form AND b."item format" = 'MC' LEFT JOIN i ON i.flat_table_id = s.lithocode AND i.id = b."item position"
  WHERE schtype_attend <> 'H'),
y AS (SELECT *, (r > 10 AND s2 > 10) AS m1, (r >= 5 AND r - s2 < 3) AS m2 FROM x),
z AS (SELECT *, (r >= 5 AND s2 >= 3 AND NOT m1 AND NOT m2)::INT + (m1 AND ed)::INT + (m2 AND ed)::INT AS times FROM y),
c AS (SELECT sheet, sum(times)::BIGINT AS erased, sum(CASE WHEN dark <> k AND ans = k THEN times ELSE 0 END)::BIGINT AS w_r,
  sum(CASE WHEN dark <> k AND ans <> k THEN times ELSE 0 END)::BIGINT AS w_w, sum(CASE WHEN dark = k AND ans <> k THEN times ELSE 0 END)::BIGINT AS r_w,
  sum(sc) AS raw, count(*) AS itemcount FROM z GROUP BY sheet)
SELECT lithocode, studentid, ssid, grade, dcrxid_attend, dcrxnm_attend, bcrxid_attend, bcrxnm_attend,
  CASE upmxlev WHEN '1' THEN 'L' WHEN '2' THEN 'B' WHEN '3' THEN 'P' WHEN '4' THEN 'A' WHEN '5' THEN 'AD' ELSE '' END AS pass_fail, 'm' AS subject, raw, erased, w_r, w_w, r_w
FROM s JOIN c ON s.lithocode = c.sheet WHERE upmxraw NOT IN ('A', 'I') AND erased > 4 AND w_r >= itemcount * 0.5""")
def erasure_analysis(t: Tables):
    """The whole analysis of one subject; the writing limits, because an order has few line numbers."""
    wide = t.derived("lineitem", ITEMS).groupBy(F.col("flat_table_id").alias("lithocode")).agg(*[
        F.max(F.when(F.col("id") == i, F.col(c))).alias(f"upmx_{m}_{i}") for m, c in _MEASURES.items() for i in range(1, 8)])
    sheets = t.derived("orders", _SHEET).withColumn("form_m", F.when(F.col("lithocode") % 2 == 0, "A").otherwise("B"))
    part1 = sheets.drop("upmxlev", "form_m")
    part2 = sheets.select("lithocode", "upmxlev", "form_m", "grade").join(wide, "lithocode", "left")
    out = erasure.erasure_analysis(part1, part2, bookmap(t), ["m", "q"], writing_subjects=("m",))
    return rounded(out)
