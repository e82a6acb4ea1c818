"""Group statistics, cells, cuts and the performance summary."""

from pyspark.sql import functions as F

from ..operators import longitudinal, performance, predicates, quantiles, stats
from .registry import STUDENTS_SQL, Tables, query, rounded, students

_KINDS = ("N", "MEAN", "SUM", "MIN", "MAX", "NMISS", "STD", "VAR", "SKEW", "KURT", "STDERR", "MEDIAN", "Q1", "P25", "Q3",
          "P1", "P5", "P10", "P90", "P95", "P99", "QRANGE", "RANGE", "CSS", "USS", "CV", "T")


def _sheet(level, source, where, value, kinds=_KINDS):
    return [{"variable_name": k.lower(), "levelvar": level, "inputvar": source, "wherevar": where, "wherevalue": value,
             "type": k, "rdvalue": None} for k in kinds]


# Deviations are taken first, so that the power sums do not cancel.
_GROUP_STATS = """
WITH d AS (SELECT c_nationkey, c_mktsegment = 'BUILDING' AS b, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_acctbal END AS x FROM customer),
e AS (SELECT *, x - avg(x) FILTER (WHERE b) OVER (PARTITION BY c_nationkey) AS v FROM d),
m AS (SELECT c_nationkey, count(*) FILTER (WHERE b) AS nn, count(x) FILTER (WHERE b) AS n, sum(x) FILTER (WHERE b) AS s, avg(x) FILTER (WHERE b) AS a,
    sum(v*v) FILTER (WHERE b) AS c2, sum(v*v*v) FILTER (WHERE b) AS c3, sum(v*v*v*v) FILTER (WHERE b) AS c4, sum(x*x) FILTER (WHERE b) AS uss,
    min(x) FILTER (WHERE b) AS lo, max(x) FILTER (WHERE b) AS hi,
    quantile_cont(x, [0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99]) FILTER (WHERE b) AS q
  FROM e GROUP BY c_nationkey)
SELECT c_nationkey, nn AS n, round(CASE WHEN nn > 0 THEN coalesce(s, 0) / nn END, 4) AS mean, round(coalesce(s, 0), 4) AS sum, round(lo, 4) AS min, round(hi, 4) AS max,
  nn - n AS nmiss, round(CASE WHEN nn > 1 THEN sqrt(abs(uss - s*s/nn)/(nn-1)) END, 4) AS std,
  round(CASE WHEN nn > 1 THEN (uss - s*s/nn)/(nn-1) END, 2) AS var,
  round(c3/n / pow(c2/(n-1), 1.5), 4) AS skew, round(c4/n / pow(c2/(n-1), 2) - 3, 4) AS kurt, round(sqrt(c2/(n-1)/n), 4) AS stderr,
  round(q[5], 4) AS median, round(q[4], 4) AS q1, round(q[4], 4) AS p25, round(q[6], 4) AS q3, round(q[1], 4) AS p1, round(q[2], 4) AS p5,
  round(q[3], 4) AS p10, round(q[7], 4) AS p90, round(q[8], 4) AS p95, round(q[9], 4) AS p99, round(q[6] - q[4], 4) AS qrange,
  round(hi - lo, 4) AS range, round(c2, 2) AS css, round(uss, 2) AS uss, round(sqrt(c2/(n-1))/a*100, 4) AS cv, round(a/sqrt(c2/(n-1)/n), 4) AS t
FROM m"""


def _two_digit(df):
    big = ("var", "css", "uss")
    return rounded(df.withColumns({c: F.round(c, 2) for c in big if c in df.columns}), 4)


@query("group_stats", _GROUP_STATS)
def group_stats(t: Tables):
    data = t.customer.withColumn("x", F.when(F.col("c_custkey") % 10 != 0, F.col("c_acctbal")))
    out = stats.group_stats(data, _sheet("c_nationkey", "x", "c_mktsegment", "building"))["c_nationkey"]
    return _two_digit(out)


@query("group_stats_ranges", """
WITH d AS (SELECT o_custkey, CASE WHEN o_custkey % 5 = 0 OR o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS x, o_orderstatus FROM orders)
SELECT o_custkey, round(quantile_cont(x, 0.5) FILTER (WHERE o_orderstatus = 'F'), 4) AS median,
  round(quantile_cont(x, 0.75) FILTER (WHERE o_orderstatus = 'F') - quantile_cont(x, 0.25) FILTER (WHERE o_orderstatus = 'F'), 4) AS qrange
FROM d GROUP BY o_custkey""")
def group_stats_ranges(t: Tables):
    """Quantiles alone; some groups have no value."""
    data = t.orders.withColumn("x", F.when((F.col("o_custkey") % 5 != 0) & (F.col("o_orderkey") % 7 != 0), F.col("o_totalprice")))
    sheet = _sheet("o_custkey", "x", "o_orderstatus", "f", ("MEDIAN", "QRANGE"))
    return rounded(stats.group_stats(data, sheet)["o_custkey"], 4)


# Student's t for thousands of degrees of freedom by its expansion around the normal quantile.
_HALF = "(1.959963984540054 + 2.3722712 / (count(x) - 1) + 2.8224986 / pow(count(x) - 1, 2)) * stddev_samp(x) / sqrt(count(x))"


@query("group_stats_limits", f"""
WITH d AS (SELECT l_returnflag, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_extendedprice END AS x FROM lineitem)
SELECT l_returnflag, round(avg(x) - {_HALF}, 2) AS lclm, round(avg(x) + {_HALF}, 2) AS uclm FROM d GROUP BY l_returnflag""")
def group_stats_limits(t: Tables):
    data = t.lineitem.withColumn("x", F.when(F.col("l_linenumber") != 3, F.col("l_extendedprice")))
    return rounded(stats.group_stats(data, _sheet("l_returnflag", "x", "", "", ("LCLM", "UCLM")))["l_returnflag"], 2)


# Tail areas for whole degrees of freedom v by the finite trigonometric series, whose terms are running products.
@query("group_stats_tails", """
WITH d AS (SELECT c_nationkey, CASE WHEN c_custkey % 10 <> 0 THEN c_acctbal - 4400 END AS x FROM customer),
g AS (SELECT c_nationkey, count(x) - 1 AS v, avg(x) / (stddev_samp(x) / sqrt(count(x))) AS t, count(x)::DOUBLE AS w,
    avg(x) AS m, stddev_samp(x) / sqrt(count(x)) AS e FROM d GROUP BY c_nationkey),
a AS (SELECT *, atan(abs(t) / sqrt(v)) AS angle, v % 2 AS odd FROM g),
k AS (SELECT c_nationkey, i, 1 + odd + 2 * i AS k, odd, angle FROM (SELECT *, unnest(range(0, v // 2 + 1)) AS i FROM a) WHERE 1 + odd + 2 * i < v),
p AS (SELECT c_nationkey, exp(CASE WHEN odd = 1 THEN ln(cos(angle)) ELSE 0 END + coalesce(sum(2 * ln(cos(angle)) + ln(k::DOUBLE / (k + 1)))
    OVER (PARTITION BY c_nationkey ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS term FROM k),
s AS (SELECT c_nationkey, sum(term) AS series FROM p GROUP BY c_nationkey)
SELECT a.c_nationkey, round(1 - CASE WHEN odd = 1 THEN 2 / pi() * (angle + sin(angle) * coalesce(series, 0)) ELSE sin(angle) * series END, 7) AS probt, w AS sumwgt
FROM a LEFT JOIN s ON s.c_nationkey = a.c_nationkey""")
def group_stats_tails(t: Tables):
    data = t.customer.withColumn("x", F.when(F.col("c_custkey") % 10 != 0, F.col("c_acctbal") - 4400))
    return rounded(stats.group_stats(data, _sheet("c_nationkey", "x", "", "", ("PROBT", "SUMWGT")))["c_nationkey"], 7)


@query("group_stats_clm", f"""
WITH d AS (SELECT l_returnflag, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_extendedprice END AS x FROM lineitem)
SELECT l_returnflag, round(avg(x) - {_HALF}, 2) AS clm_lclm, round(avg(x) + {_HALF}, 2) AS clm_uclm FROM d GROUP BY l_returnflag""")
def group_stats_clm(t: Tables):
    data = t.lineitem.withColumn("x", F.when(F.col("l_linenumber") != 3, F.col("l_extendedprice")))
    return rounded(stats.group_stats(data, _sheet("l_returnflag", "x", "", "", ("CLM",)))["l_returnflag"], 2)


@query("group_stats_skip_missing", """
WITH d AS (SELECT l_suppkey, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_extendedprice END AS x FROM lineitem)
SELECT l_suppkey, round(avg(x), 4) AS mean, round(stddev_samp(x), 4) AS std FROM d GROUP BY l_suppkey""")
def group_stats_skip_missing(t: Tables):
    data = t.lineitem.withColumn("x", F.when(F.col("l_linenumber") != 3, F.col("l_extendedprice")))
    return rounded(stats.group_stats(data, _sheet("l_suppkey", "x", "", "", ("MEAN", "STD")), missing="skip")["l_suppkey"], 4)


@query("group_stats_percent", """
SELECT l_suppkey, round(100.0 * count(*) FILTER (WHERE l_returnflag = 'R' AND l_linestatus = 'F') / nullif(count(*) FILTER (WHERE l_linestatus = 'F'), 0), 3) AS pct
FROM lineitem GROUP BY l_suppkey""")
def group_stats_percent(t: Tables):
    sheet = [{"variable_name": "pct", "levelvar": "l_suppkey", "numeratorvariable": "l_returnflag*l_linestatus", "numeratorvalue": "r f",
              "denominatorvariable": "l_linestatus", "denominatorvalue": "F", "rdvalue": 3}]
    return rounded(stats.group_stats(t.lineitem, percent_sheet=sheet)["l_suppkey"], 3)


@query("group_quantiles_bucketed", """
SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.5), 4) AS median, round(quantile_cont(l_extendedprice, 0.9), 4) AS p90
FROM lineitem GROUP BY l_returnflag""")
def group_quantiles_bucketed(t: Tables):
    out = quantiles.exact_group_quantiles(t.lineitem, ["l_returnflag"], F.col("l_extendedprice"), [0.5, 0.9])
    return rounded(out.select("l_returnflag", F.col("q0_5000").alias("median"), F.col("q0_9000").alias("p90")), 4)


@query("frequency_distribution", """
WITH c AS (SELECT o_orderstatus, o_orderpriority, count(*) AS freq FROM orders GROUP BY ALL)
SELECT o_orderstatus, o_orderpriority, freq, round(freq * 100.0 / sum(freq) OVER (PARTITION BY o_orderstatus), 6) AS percent_freq,
  sum(freq) OVER w::BIGINT AS cum_freq, round(sum(freq) OVER w * 100.0 / sum(freq) OVER (PARTITION BY o_orderstatus), 6) AS cum_percent_freq
FROM c WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_orderpriority)""".replace("sum(freq) OVER w::BIGINT", "cast(sum(freq) OVER w AS BIGINT)"))
def frequency_distribution(t: Tables):
    return rounded(stats.frequency_distribution(t.orders, "o_orderpriority", ["o_orderstatus"]))


@query("frequency_distribution_all", """
WITH c AS (SELECT o_totalprice, count(*) AS freq FROM orders GROUP BY ALL)
SELECT o_totalprice, freq, round(freq * 100.0 / sum(freq) OVER (), 6) AS percent_freq, cast(sum(freq) OVER (ORDER BY o_totalprice) AS BIGINT) AS cum_freq,
  round(sum(freq) OVER (ORDER BY o_totalprice) * 100.0 / sum(freq) OVER (), 6) AS cum_percent_freq FROM c""")
def frequency_distribution_all(t: Tables):
    """Without groups, and with many levels."""
    return rounded(stats.frequency_distribution(t.orders, "o_totalprice"))


_CELLS = """
WITH u AS (SELECT 0 AS s, o_orderstatus b, o_orderpriority v FROM orders WHERE o_orderkey % 2 = 0
  UNION ALL SELECT 1, o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 2 <> 0),
c AS (SELECT 0 AS report, b AS by_value, v AS value, count(*) FILTER (WHERE s = 0) AS count0, count(*) FILTER (WHERE s = 1) AS count1 FROM u GROUP BY b, v
  UNION ALL SELECT 1, '', v, count(*) FILTER (WHERE s = 0), count(*) FILTER (WHERE s = 1) FROM u GROUP BY v),
x AS (SELECT *, sum(count0) OVER (PARTITION BY report, by_value)::BIGINT AS total0, sum(count1) OVER (PARTITION BY report, by_value)::BIGINT AS total1 FROM c)"""
_CELLS = _CELLS.replace("sum(count0) OVER (PARTITION BY report, by_value)::BIGINT", "cast(sum(count0) OVER (PARTITION BY report, by_value) AS BIGINT)").replace(
    "sum(count1) OVER (PARTITION BY report, by_value)::BIGINT", "cast(sum(count1) OVER (PARTITION BY report, by_value) AS BIGINT)")


def _halves(t: Tables):
    """All orders, as two data sets."""
    even = F.col("o_orderkey") % 2 == 0
    return t.orders.where(even), t.orders.where(~even)


@query("crosstab_counts", _CELLS + " SELECT * FROM x")
def crosstab_counts(t: Tables):
    return rounded(longitudinal.crosstab_counts(*_halves(t), [("o_orderstatus", "o_orderpriority"), (None, "o_orderpriority")]))


@query("longitudinal_compare", _CELLS + """,
y AS (SELECT *, (count0 + count1)::DOUBLE / (total0 + total1) AS p, count0::DOUBLE / total0 AS p0, count1::DOUBLE / total1 AS p1 FROM x),
z AS (SELECT *, CASE WHEN report = 0 THEN count0 * ln(p0 / p) + (total0 - count0) * ln((1 - p0) / (1 - p)) + count1 * ln(p1 / p) + (total1 - count1) * ln((1 - p1) / (1 - p))
    ELSE abs(p0 - p1) * 100 END AS diff FROM y),
r AS (SELECT *, row_number() OVER (PARTITION BY report ORDER BY diff DESC, by_value, value) AS rn FROM z WHERE diff >= CASE WHEN report = 0 THEN 0.05 ELSE 0.2 END)
SELECT CASE WHEN report = 0 THEN 'o_orderstatus' ELSE '(all)' END AS "ByVariable", by_value AS "ByValue", 'o_orderpriority' AS "Variable", value AS "Value",
  CASE WHEN report = 0 THEN 'proportion-stat' ELSE 'proportion-absolute' END AS "MatchType", round(CASE WHEN report = 0 THEN count0 ELSE p0 * 100 END, 6) AS base,
  round(CASE WHEN report = 0 THEN count1 ELSE p1 * 100 END, 6) AS compare, round(diff, 6) AS diff, report + 1 AS "Comparison", total0 AS "baseN", total1 AS "compareN"
FROM r WHERE rn <= CASE WHEN report = 0 THEN 6 ELSE 3 END""")
def longitudinal_compare(t: Tables):
    base = {"variable": "o_orderpriority", "treatas": "nominal", "matchalgorithm": "proportion", "missing_counted": "yes"}
    sheet = [{**base, "by": "o_orderstatus", "tolerance": 0.05, "tolerancetype": "stat", "max_bad": 6},
             {**base, "by": "(all)", "tolerance": 0.2, "tolerancetype": "absolute", "max_bad": 3}]
    return rounded(longitudinal.longitudinal_compare(*_halves(t), sheet))


@query("distinct_cut", """
SELECT c_nationkey, c_mktsegment, c_custkey, c_name FROM customer
QUALIFY row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_acctbal, c_custkey) = 1""")
def distinct_cut(t: Tables):
    return rounded(stats.distinct_cut(t.customer, ["c_nationkey", "c_mktsegment"], ["c_custkey", "c_name"], ["c_acctbal", "c_custkey"]))


@query("count_failures", """
SELECT p_brand AS bad_variable, p_type AS bad_reason, count(*) AS count FROM part GROUP BY ALL""")
def count_failures(t: Tables):
    return rounded(stats.count_failures(t.part.select(F.col("p_brand").alias("bad_variable"), F.col("p_type").alias("bad_reason"))))


@query("list_distinct", "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")
def list_distinct(t: Tables):
    return rounded(stats.list_distinct([t.customer.select(F.col("c_nationkey").alias("nation")),
                                        t.supplier.select(F.col("s_nationkey").alias("nation"))], ["nation"]))


_PERFORMANCE = f"""
WITH s AS ({STUDENTS_SQL}),
l AS (SELECT dcrxid_attend, rtrim(schtype_attend) = 'C' AS c, 'reading' AS subject, 1 AS suborder, ufrx_attempt = '1' AS tested, uprxlev AS lev, uprxlev IN ('3','4','5') AS ok FROM s
  UNION ALL SELECT dcrxid_attend, rtrim(schtype_attend) = 'C', 'math', 2, ufmx_attempt = '1', upmxlev, upmxlev IN ('3','4','5') FROM s
  UNION ALL SELECT dcrxid_attend, rtrim(schtype_attend) = 'C', 'All Subjects', 99, ufrx_attempt = '1' AND ufmx_attempt = '1', NULL, uprxlev IN ('3','4','5') AND upmxlev IN ('3','4','5') FROM s)"""
_PERCENTS = "count(*) AS tested, " + ", ".join(
    f"round(CASE WHEN suborder <> 99 THEN count(*) FILTER (WHERE lev = '{i}') * 100.0 / count(*) END, 1) AS pct_level{i}" for i in range(1, 6)
) + ", round(count(*) FILTER (WHERE ok) * 100.0 / count(*), 1) AS pct_pass"


def _performance(t: Tables):
    rows = students(t).withColumn("grade", F.lit("10"))
    return performance.performance_summary(rows, "dcrxid_attend", "grade", "schtype_attend",
                                           {"reading": ("ufrx_attempt", "uprxlev"), "math": ("ufmx_attempt", "upmxlev")})


@query("performance_summary", _PERFORMANCE + f"""
SELECT dcrxid_attend, '10' AS grade, subject, suborder, {_PERCENTS} FROM l WHERE tested AND NOT c GROUP BY dcrxid_attend, subject, suborder""")
def performance_summary(t: Tables):
    return rounded(_performance(t).districts)


@query("performance_summary_totals", _PERFORMANCE + f"""
SELECT 'All Schools' AS label, '10' AS grade, subject, suborder, {_PERCENTS} FROM l WHERE tested GROUP BY subject, suborder
UNION ALL SELECT 'All Community Schools', '10', subject, suborder, {_PERCENTS} FROM l WHERE tested AND c GROUP BY subject, suborder""")
def performance_summary_totals(t: Tables):
    return rounded(_performance(t).totals)


# ------------------------------------------------- conditions and updates

@query("spec_predicate", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber = 2")
def spec_predicate(t: Tables):
    rows = t.lineitem.where(predicates.spec_predicate(t.lineitem, "l_returnflag*l_linenumber", "r 2"))
    return rounded(rows.select("l_orderkey", "l_linenumber", "l_partkey"))


@query("conditional_update", """
WITH a AS (SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '1%' THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders)
SELECT o_orderkey, CASE WHEN o_orderstatus = 'X' AND o_totalprice > 100000 THEN 'Y' ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderstatus = 'X' AND o_totalprice > 100000 THEN 0 ELSE o_totalprice END AS o_totalprice FROM a""")
def conditional_update(t: Tables):
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    out = predicates.conditional_update(rows, [
        ("o_orderpriority LIKE '1%'", {"o_orderstatus": F.lit("X")}),
        ("o_orderstatus = 'X' AND o_totalprice > 100000", {"o_totalprice": F.lit(0.0)}),
        ("o_totalprice = 0", {"o_orderstatus": F.lit("Y")}),
    ])
    return out.drop("o_orderpriority")


@query("lookup_update", """
SELECT c_custkey, CASE WHEN s_suppkey IS NOT NULL AND c_acctbal < s_acctbal THEN s_name ELSE c_name END AS c_name FROM customer
LEFT JOIN supplier ON c_custkey = s_suppkey""")
def lookup_update(t: Tables):
    rows = t.customer.select("c_custkey", "c_name", "c_acctbal")
    out = predicates.lookup_update(rows, t.supplier, {"c_custkey": "s_suppkey"}, {"c_name": "m_s_name"}, "c_acctbal < m_s_acctbal")
    return rounded(out.drop("c_acctbal"))


@query("split_by_flag", """
SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END = 'F', false) AS first FROM orders""")
def split_by_flag(t: Tables):
    rows = t.orders.withColumn("s", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus")))
    yes, no = predicates.split_by_flag(rows, "s = 'F'")
    return yes.select("o_orderkey", F.lit(True).alias("first")).unionByName(no.select("o_orderkey", F.lit(False).alias("first")))


@query("drop_unattempted", f"""
SELECT id FROM ({STUDENTS_SQL}) WHERE NOT (ufrx_attempt = '0' AND ufmx_attempt = '0' AND ufwx_attempt = '0' AND ufsx_attempt = '0' AND ufcx_attempt = '0')
  AND schtype_attend <> 'H'""")
def drop_unattempted(t: Tables):
    return predicates.drop_unattempted(students(t), [f"uf{s}x_attempt" for s in "rmwsc"], "schtype_attend").select("id")
