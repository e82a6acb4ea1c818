"""First rows, numbering, top-k, stacking."""

from pyspark.sql import functions as F

from ..operators import skew
from ..operators import windows as w
from .registry import Tables, query, rounded

_ORDERS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


def _orders(t: Tables):
    return t.orders.select(*_ORDERS)


@query("nodupkey", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'F'""")
def nodupkey(t: Tables):
    return rounded(w.nodupkey(_orders(t), ["o_custkey"], [F.col("o_totalprice").desc(), "o_orderkey"], "o_orderstatus = 'F'"))


@query("nodupkey2", """
WITH a AS (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1)
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM a QUALIFY row_number() OVER (PARTITION BY o_orderpriority, o_orderstatus ORDER BY o_orderkey) = 1""")
def nodupkey2(t: Tables):
    return rounded(w.nodupkey2(t.orders, ["o_custkey"], ["o_orderpriority", "o_orderstatus"], ["o_orderkey"]).select(*_ORDERS))


@query("number_in_group", """
SELECT o_orderkey, row_number() OVER w AS count, least(ceil(row_number() OVER w / 5.0), 10)::BIGINT AS page FROM orders
WINDOW w AS (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey)""")
def number_in_group(t: Tables):
    return rounded(w.number_in_group(t.orders, ["o_custkey"], ["o_totalprice", "o_orderkey"]).select("o_orderkey", "count", "page"))


@query("number_rows", "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS n FROM orders")
def number_rows(t: Tables):
    return rounded(skew.number_rows(t.orders.select("o_orderkey", "o_totalprice"), [], ["o_totalprice", "o_orderkey"], "n").select("o_orderkey", "n"))


@query("rank_in_group", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, rank() OVER (PARTITION BY l_orderkey ORDER BY l_quantity) AS rank FROM lineitem
QUALIFY rank() OVER (PARTITION BY l_orderkey ORDER BY l_quantity) <= 2""")
def rank_in_group(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return rounded(w.rank_in_group(rows, ["l_orderkey"], ["l_quantity"], 2))


@query("dedupe_report_rows", """
SELECT o_custkey, o_orderpriority, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) = 1""")
def dedupe_report_rows(t: Tables):
    return rounded(w.dedupe_report_rows(t.orders.select("o_custkey", "o_orderpriority", "o_orderkey"), ["o_custkey", "o_orderpriority"], ["o_orderkey"]))


@query("running_total", """
SELECT o_orderkey, sum(o_orderkey % 100) OVER (PARTITION BY o_custkey ORDER BY o_orderkey)::BIGINT AS running_total FROM orders""".replace(
    "sum(o_orderkey % 100) OVER (PARTITION BY o_custkey ORDER BY o_orderkey)::BIGINT", "cast(sum(o_orderkey % 100) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS BIGINT)"))
def running_total(t: Tables):
    rows = t.orders.select("o_orderkey", "o_custkey", (F.col("o_orderkey") % 100).alias("v"))
    return rounded(w.running_total(rows, "v", ["o_custkey"], ["o_orderkey"]).select("o_orderkey", "running_total"))


@query("running_total_ranges", """
SELECT o_orderkey, cast(sum(CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey % 100 END) OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS BIGINT) AS running_total FROM orders""")
def running_total_ranges(t: Tables):
    """By the route of large groups, with missing values."""
    rows = t.orders.select("o_orderkey", "o_orderstatus", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey") % 100).alias("v"))
    return rounded(w.running_total(rows, "v", ["o_orderstatus"], ["o_orderkey"], group_rows_limit=1).select("o_orderkey", "running_total"))


@query("neighbor_overlap", """
SELECT o_orderkey, next_start FROM (SELECT o_orderkey, o_orderkey % 1000 + 20 AS e, lead(o_orderkey % 1000) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS next_start FROM orders) WHERE e > next_start""")
def neighbor_overlap(t: Tables):
    rows = t.orders.select("o_orderkey", "o_custkey", (F.col("o_orderkey") % 1000).alias("s"), (F.col("o_orderkey") % 1000 + 20).alias("e"))
    return rounded(w.neighbor_overlap(rows, "s", "e", ["o_orderkey"], ["o_custkey"]).select("o_orderkey", "next_start"))


@query("group_size", "SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey) AS group_size FROM orders")
def group_size(t: Tables):
    return rounded(w.group_size(t.orders.select("o_orderkey", "o_custkey"), ["o_custkey"]).drop("o_custkey"))


@query("dense_rank", "SELECT p_partkey, dense_rank() OVER (ORDER BY p_name) AS dense_rank FROM part")
def dense_rank(t: Tables):
    return rounded(w.dense_rank_values(t.part.select("p_partkey", "p_name"), "p_name").drop("p_name"))


@query("sorted_export", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey")
def sorted_export(t: Tables):
    return w.sorted_export(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"])


@query("top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def top_n(t: Tables):
    return w.top_n(t.orders.select("o_orderkey", "o_totalprice"), [F.col("o_totalprice").desc(), "o_orderkey"])


@query("worst_n_per_report", """
SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) <= 3""")
def worst_n_per_report(t: Tables):
    rows = t.lineitem.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return rounded(w.worst_n_per_report(rows, ["l_suppkey"], "l_extendedprice", 3, ["l_orderkey", "l_linenumber", "l_partkey"]))


@query("union_all", "SELECT c_nationkey AS nation, c_name AS name FROM customer UNION ALL SELECT s_nationkey, s_name FROM supplier")
def union_all(t: Tables):
    return rounded(w.union_all([t.customer.selectExpr("c_nationkey AS nation", "c_name AS name"),
                                t.supplier.selectExpr("s_name AS name", "s_nationkey AS nation")]))


@query("union_distinct", "SELECT o_custkey AS k FROM orders UNION SELECT c_custkey FROM customer")
def union_distinct(t: Tables):
    return rounded(w.union_distinct([t.orders.selectExpr("o_custkey AS k"), t.customer.selectExpr("c_custkey AS k")]))


@query("common_columns", """
SELECT c_custkey AS k, c_name AS name, c_nationkey AS nation FROM customer UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier""")
def common_columns(t: Tables):
    left = t.customer.toDF("k", "name", "nation", "balance", "segment")
    right = t.supplier.toDF("K", "Name", "Nation", "acct")
    shared = w.common_columns(left, right).common
    return rounded(left.select(*shared).unionByName(right.select(*shared).toDF(*shared)))
