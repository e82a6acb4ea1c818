"""Readers and writers: the tables are written as files and read back."""

from pyspark.sql import functions as F

from .. import sources
from ..sources import tables
from .registry import BOOKMAP_SQL, Tables, bookmap, query, rounded

_CUSTOMER_LAYOUT = [
    {"start": 1, "end": 10, "length": 10, "name": "c_custkey", "type": "numeric"},
    {"start": 11, "end": 30, "length": 20, "name": "c_name", "type": "alpha"},
    {"start": 31, "end": 35, "length": 5, "name": "filler", "type": "alpha"},
    {"start": 36, "end": 38, "length": 3, "name": "c_nationkey", "type": "numeric"},
    {"start": 39, "end": 47, "length": 9, "name": "c_mktsegment", "type": "alphanumeric"},
]


@query("export_fixed_width", """
SELECT lpad(c_custkey::VARCHAR, 10, ' ') || rpad(c_name, 20, ' ') || '     ' || lpad(c_nationkey::VARCHAR, 3, ' ') || rpad(left(c_mktsegment, 9), 9, ' ') AS value FROM customer""")
def export_fixed_width(t: Tables):
    path = t.scratch()
    sources.export_fixed_width(t.customer, path, _CUSTOMER_LAYOUT)
    return t.spark.read.text(path)


@query("read_fixed_width", """
SELECT row_number() OVER (ORDER BY c_custkey) AS line_number, c_custkey::VARCHAR AS c_custkey, c_name, c_nationkey::VARCHAR AS c_nationkey,
  rtrim(left(c_mktsegment, 9)) AS c_mktsegment FROM customer""")
def read_fixed_width(t: Tables):
    path = t.scratch()
    sources.export_fixed_width(t.customer.orderBy("c_custkey"), path, _CUSTOMER_LAYOUT)  # many files, in order
    return rounded(sources.read_fixed_width(t.spark, path, _CUSTOMER_LAYOUT, one_text=True).data)


@query("read_fixed_width_short_lines", """
SELECT o_orderkey + 1 AS line_number, 'b' AS variable FROM orders WHERE length(o_orderstatus || left(o_orderpriority, (o_orderkey % 4 + 1)::INT)) < 4""")
def read_fixed_width_short_lines(t: Tables):
    path = t.scratch()
    lines = t.orders.orderBy("o_orderkey").select(
        F.concat("o_orderstatus", F.substring("o_orderpriority", F.lit(1), (F.col("o_orderkey") % 4 + 1).cast("int"))).alias("value"))
    lines.write.text(path)
    out = sources.read_fixed_width(t.spark, path, [{"varname": "a", "length": 1}, {"varname": "b", "length": 3}], one_text=True)
    return rounded(out.errors.select("line_number", "variable"))


@query("export_delimited", "SELECT c_custkey::VARCHAR AS c_custkey, c_name FROM customer WHERE c_nationkey < 10")
def export_delimited(t: Tables):
    path = t.scratch() + ".csv"
    n = sources.export_delimited(t.customer, path, columns=["c_custkey", "c_name"], where="c_nationkey < 10", orderby=["c_custkey"])
    back = t.spark.read.csv(path, header=True)
    return back.where(F.lit(n) >= 0)


@query("read_delimited", """
SELECT row_number() OVER (ORDER BY c_custkey) + 1 AS line_number, c_custkey::VARCHAR AS id, c_mktsegment || ', "x' AS segment,
  CASE WHEN c_custkey % 6 IN (0, 1) THEN NULL ELSE c_name END AS name FROM customer""")
def read_delimited(t: Tables):
    path = t.scratch()
    k = F.col("c_custkey")
    rows = t.customer.select(
        F.concat(F.lit('"'), F.col("c_mktsegment"), F.lit(', ""x",')).alias("a"),
        F.when(k % 6 == 0, ".").when(k % 6 == 1, " ").otherwise(F.col("c_name")).alias("b"), k.cast("string").alias("c"), k.alias("k"))
    lines = rows.select("k", F.concat(F.col("a"), F.col("b"), F.lit(","), F.col("c")).alias("value"))
    head = t.spark.range(1).select(F.lit(None).cast("long").alias("k"), F.lit("segment,name,id").alias("value"))
    # Many files in order; the first one begins with the names.
    head.union(lines).orderBy(F.col("k").asc_nulls_first()).select("value").write.text(path)
    layout = [{"varname": n} for n in ("id", "name", "segment")]
    data = sources.read_delimited(t.spark, path, layout, one_text=True).data
    return rounded(data.select("line_number", "id", F.regexp_replace("segment", '""', '"').alias("segment"), "name"))


@query("read_delimited_errors", """
SELECT line_number, variable, value, reason AS point_of_failure FROM (
  SELECT 1 AS line_number, 'extra' AS variable, 'extra' AS value, 'Variable Not Found In Layout' AS reason
  UNION ALL SELECT row_number() OVER (ORDER BY c_custkey) + 1, NULL, c_name || ',x,' || c_custkey || CASE WHEN c_custkey % 7 = 0 THEN ',more' ELSE '' END,
    CASE WHEN c_custkey % 7 = 0 THEN 'More columns than specified in layout' END FROM customer) WHERE reason IS NOT NULL""")
def read_delimited_errors(t: Tables):
    """A name the layout lacks, and lines with more cells than names."""
    path = t.scratch()
    more = F.when(F.col("c_custkey") % 7 == 0, ",more").otherwise("")
    lines = t.customer.select(F.col("c_custkey").alias("k"), F.concat("c_name", F.lit(",x,"), F.col("c_custkey").cast("string"), more).alias("value"))
    head = t.spark.range(1).select(F.lit(None).cast("long").alias("k"), F.lit("name,extra,id").alias("value"))
    head.union(lines).orderBy(F.col("k").asc_nulls_first()).select("value").write.text(path)
    return rounded(sources.read_delimited(t.spark, path, [{"varname": n} for n in ("id", "name")], one_text=True).errors)


@query("read_typed_pair", "SELECT o_orderkey, o_custkey::DOUBLE AS o_custkey, o_orderstatus FROM orders")
def read_typed_pair(t: Tables):
    values, types = t.scratch(), t.scratch()
    t.orders.select("o_orderkey", "o_custkey", "o_orderstatus").write.csv(values, sep="\t")
    schema = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus").dtypes
    t.spark.createDataFrame([(f"{n}\t{'varchar(1)' if k == 'string' else k}",) for n, k in schema], "value string").coalesce(1).write.text(types)
    return sources.read_typed_pair(t.spark, values, types, "tvp", {"o_custkey": "float"})


@query("infer_column_types", """
SELECT l_orderkey::BIGINT AS l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_quantity::BIGINT AS l_quantity, l_discount, l_returnflag FROM lineitem""")
def infer_column_types(t: Tables):
    rows = t.lineitem.select(*[F.col(c).cast("string").alias(c) for c in ("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag")])
    return rounded(sources.infer_column_types(rows)[1])


@query("drop_blank_rows", "SELECT a, b FROM (SELECT CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderstatus END AS a, CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE o_orderpriority END AS b FROM orders) WHERE trim(coalesce(a, '')) <> '' OR trim(coalesce(b, '')) <> ''")
def drop_blank_rows(t: Tables):
    k = F.col("o_orderkey")
    rows = t.orders.select(F.when(k % 3 == 0, "").otherwise(F.col("o_orderstatus")).alias("a"), F.when(k % 2 == 1, F.col("o_orderpriority")).alias("b"))
    return tables.drop_blank_rows(rows)


@query("add_import_order", "SELECT c_custkey + 1 AS import_order, c_custkey FROM customer")
def add_import_order(t: Tables):
    return rounded(sources.add_import_order(t.customer.select("*")).select("import_order", "c_custkey"))


@query("read_many", """
SELECT row_number() OVER (ORDER BY side, k) AS row_id, side, k FROM (SELECT 0 AS side, c_custkey AS k FROM customer UNION ALL SELECT 1, s_suppkey FROM supplier)""")
def read_many(t: Tables):
    def reader(path):
        side, column = (0, "c_custkey") if path.endswith("customer.parquet") else (1, "s_suppkey")
        return t.spark.read.parquet(path).select(F.lit(side).alias("side"), F.col(column).alias("k"))

    paths = [f"{t.folder}/{n}.parquet" for n in ("customer", "supplier")]
    return rounded(tables.read_many(t.spark, paths, reader, "row_id", [F.col("side"), F.col("k")]))


@query("read_table_as_text", "SELECT n_nationkey::VARCHAR AS id, trim(n_name) AS name FROM nation")
def read_table_as_text(t: Tables):
    t.nation.createOrReplaceTempView("tallyforge_nation")
    return sources.read_table_as_text(t.spark, "SELECT n_nationkey, concat('  ', n_name) FROM tallyforge_nation", ["id", "name"], query=True)


@query("copy_dataset", "SELECT n_nationkey::DOUBLE AS key, n_name AS name, n_regionkey FROM nation")
def copy_dataset(t: Tables):
    return rounded(sources.copy_dataset(t.nation, {"n_nationkey": "key", "n_name": "name"}, types={"n_nationkey": "float"}))


@query("export_partitioned", """
SELECT c_nationkey::VARCHAR AS district, rpad(c_name, 20, ' ') || 'CONST ' || lpad((c_custkey % 12 + 1)::VARCHAR, 2, '0') || '  ' AS line FROM customer""")
def export_partitioned(t: Tables):
    layout = [{"variable": "c_name", "value type": "variable", "start": 1, "length": 20, "out format": "$", "column name": "name"},
              {"variable": "'CONST'", "value type": "constant", "start": 21, "length": 5, "out format": "", "column name": "tag"},
              {"variable": "month", "value type": "variable", "start": 27, "length": 4, "out format": "padzerofmt.", "column name": "month"}]
    rows = t.customer.withColumn("month", (F.col("c_custkey") % 12 + 1).cast("string"))
    paths = sources.export_partitioned(rows, t.scratch(), layout, "c_nationkey", ["c_custkey"], skip_state=0)
    back = t.spark.read.text(paths["text"])
    return back.select(F.col("_key").cast("string").alias("district"), F.col("value").alias("line"))


_BOOK = ("item position", "role", "item format", "numeric key", "tagged for release")


def _bookmaps(t: Tables):
    """One bookmap file per form, read back through a locations sheet."""
    root = t.scratch()
    book = bookmap(t).withColumn("tagged for release", F.when(F.col("item position") % 2 == 0, "Y").otherwise("N"))
    for form in ("A", "B"):
        part = book.where(F.col("form_values") == form).select(*_BOOK)
        part.coalesce(1).write.csv(f"{root}/form_{form}", header=True)
    locations = [{"location": f"X:/keys/{f}", "grade_values": "10", "subject": "math", "subject_values": "m", "form_values": f} for f in ("A", "B")]
    return sources.read_bookmaps(locations, lambda p: t.spark.read.csv(p, header=True), [(r"^X:/keys/", f"{root}/form_")], _BOOK)


@query("read_bookmaps", f"""
SELECT "item position"::VARCHAR AS position, form_values, subject_values, grade_values, "numeric key"::VARCHAR AS key FROM ({BOOKMAP_SQL})""")
def read_bookmaps(t: Tables):
    return _bookmaps(t).select(F.col("item position").alias("position"), "form_values", "subject_values", "grade_values", F.col("numeric key").alias("key"))


@query("bookmap_item_lists", f"""
SELECT subject_values, grade_values, form_values, array_to_string(list_sort(list("item position") FILTER (WHERE "item format" = 'MC' AND "item position" % 2 = 0)), ' ') AS mc_released,
  array_to_string(list_sort(list("item position") FILTER (WHERE "item position" % 2 = 1)), ' ') AS not_released, max("item position") AS max_item FROM ({BOOKMAP_SQL}) GROUP BY ALL""")
def bookmap_item_lists(t: Tables):
    out = sources.bookmap_item_lists(_bookmaps(t))
    return rounded(out.withColumns({c: F.array_join(F.col(c).cast("array<string>"), " ") for c in ("mc_released", "not_released")}))
