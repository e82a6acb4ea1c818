"""Column functions over whole tables."""

from pyspark.sql import functions as F

from ..functions import codes, keys, names, text
from .registry import Tables, query, rounded


@query("levenshtein_distance", """
SELECT c_custkey, levenshtein(c_mktsegment, n_name) AS distance
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def levenshtein_distance(t: Tables):
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return rounded(joined.select("c_custkey", text.levenshtein_distance("c_mktsegment", "n_name").alias("distance")))


@query("name_similarity", r"""
WITH p AS (
  SELECT c_custkey, coalesce(regexp_replace(upper(trim(c_name)), '(\s)\s+', '\1', 'g'), 'NULL') f1,
    coalesce(regexp_replace(upper(trim(CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END)), '(\s)\s+', '\1', 'g'), 'NULL') l1,
    coalesce(regexp_replace(upper(trim(lower(c_mktsegment))), '(\s)\s+', '\1', 'g'), 'NULL') f2,
    coalesce(regexp_replace(upper(trim(n_name || '  x')), '(\s)\s+', '\1', 'g'), 'NULL') l2
  FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT c_custkey, round(1.0 - least(levenshtein(f1 || ' ' || l1, f2 || ' ' || l2),
    levenshtein(l1 || ' ' || f1, f2 || ' ' || l2))::DOUBLE
  / greatest(length(f1 || ' ' || l1), length(f2 || ' ' || l2)), 6) AS similarity FROM p""")
def name_similarity(t: Tables):
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    last = F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment"))
    value = text.name_similarity("c_name", last, F.lower("c_mktsegment"), F.concat("n_name", F.lit("  x")))
    return rounded(joined.select("c_custkey", value.alias("similarity")))


@query("compress_whitespace", r"""
SELECT doc_id, length(regexp_replace(text, '(\s)\s+', '\1', 'g')) AS n, md5(regexp_replace(text, '(\s)\s+', '\1', 'g')) AS digest
FROM documents""")
def compress_whitespace(t: Tables):
    clean = text.compress_whitespace("text")
    return rounded(t.documents.select("doc_id", F.length(clean).alias("n"), F.md5(clean).alias("digest")))


_WORD = ("CASE WHEN w IN ({romans}) THEN upper(w) WHEN w[1:2] = 'mc' THEN 'Mc' || upper(w[3:3]) || w[4:] "
         "ELSE upper(w[1:1]) || w[2:] END")
_ROMANS = ", ".join(f"'{text.roman_numeral(n)}'" for n in range(1, 11))


@query("to_proper_case", f"""
SELECT p_partkey, array_to_string(list_transform(
  string_split(lower(p_name || ' MC' || p_type || ' ' || CASE WHEN p_size % 2 = 0 THEN 'IV' ELSE 'XL' END), ' '),
  lambda w: {_WORD.format(romans=_ROMANS)}), ' ') AS name FROM part""")
def to_proper_case(t: Tables):
    raw = F.concat("p_name", F.lit(" MC"), "p_type", F.lit(" "), F.when(F.col("p_size") % 2 == 0, "IV").otherwise("XL"))
    return t.part.select("p_partkey", text.to_proper_case(raw, 10).alias("name"))


@query("proper_case_words", f"""
SELECT p_partkey, array_to_string(list_transform(
  string_split(lower(p_name || ' ' || p_type || ' ' || CASE WHEN p_size % 2 = 0 THEN 'IX' ELSE 'XX' END), ' '),
  lambda w: CASE WHEN w IN ({_ROMANS}) THEN upper(w) ELSE upper(w[1:1]) || w[2:] END), ' ') AS name FROM part""")
def proper_case_words(t: Tables):
    raw = F.concat_ws(" ", "p_name", "p_type", F.when(F.col("p_size") % 2 == 0, "IX").otherwise("XX"))
    return t.part.select("p_partkey", text.proper_case_words(raw).alias("name"))


@query("apply_value_format", """
WITH v AS (SELECT c_custkey, cast(c_custkey % 15 AS VARCHAR) a, cast(c_custkey % 1200 AS VARCHAR) b,
    CASE WHEN c_custkey % 6 = 0 THEN '.A' ELSE cast(c_custkey % 6 AS VARCHAR) END c, cast((c_custkey % 1100) / 10.0 AS VARCHAR) d
  FROM customer)
SELECT c_custkey,
  CASE WHEN a::INT BETWEEN 1 AND 12 THEN lpad(a, 2, '0') ELSE '! ' END AS padzero,
  CASE WHEN b::INT BETWEEN 0 AND 998 THEN lpad(b, 3, '0') WHEN b = '999' THEN 'INV' ELSE '!' END AS scale,
  CASE c WHEN '1' THEN '15' WHEN '2' THEN '14' WHEN '3' THEN '13' WHEN '4' THEN '12' WHEN '5' THEN '11' WHEN '.A' THEN '  ' ELSE '!' END AS perflev,
  CASE WHEN cast(trunc(d::DOUBLE * 10) AS INT) BETWEEN 0 AND 999 THEN lpad(cast(cast(trunc(d::DOUBLE * 10) AS INT) AS VARCHAR), 3, '0') ELSE '!' END AS rawscore
FROM v""")
def apply_value_format(t: Tables):
    k = F.col("c_custkey")
    level = F.when(k % 6 == 0, ".A").otherwise((k % 6).cast("string"))
    tenths = F.concat(F.floor((k % 1100) / 10).cast("string"), F.lit("."), ((k % 1100) % 10).cast("string"))
    return t.customer.select(
        "c_custkey", codes.apply_value_format((k % 15).cast("string"), "padzerofmt").alias("padzero"),
        codes.apply_value_format((k % 1200).cast("string"), "scalefmt").alias("scale"),
        codes.apply_value_format(level, "perflevfmt").alias("perflev"),
        codes.apply_value_format(tenths, "rawfmt").alias("rawscore"))


@query("is_numeric", """
WITH v AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN '-' WHEN 1 THEN cast(value AS VARCHAR) WHEN 2 THEN event_type WHEN 3 THEN NULL ELSE ' 12 ' END x, value FROM events)
SELECT event_id, try_cast(trim(x) AS DOUBLE) IS NOT NULL AS numeric_text, round(coalesce(try_cast(trim(x) AS DOUBLE), 0), 6) AS number
FROM v""")
def is_numeric(t: Tables):
    k = F.col("event_id") % 5
    x = F.when(k == 0, "-").when(k == 1, F.col("value").cast("string")).when(k == 2, F.col("event_type")).when(k == 4, " 12 ")
    return rounded(t.events.select("event_id", codes.is_numeric(x).alias("numeric_text"), codes.to_number_or_zero(x).alias("number")))


@query("letters_to_null", """
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_returnflag END AS l_returnflag, l_linestatus
FROM lineitem""")
def letters_to_null(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus")
    return codes.letters_to_null(rows, ["L_RETURNFLAG"])


@query("compose_name", """
SELECT c_custkey, regexp_replace(concat_ws(' ', nullif(trim(c_mktsegment || '  x'), ''), CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'q' END,
  nullif(trim(c_name), '')), ' +', ' ', 'g') AS name FROM customer""")
def compose_name(t: Tables):
    middle = F.when(F.col("c_custkey") % 3 == 0, "  ").otherwise("q")
    return t.customer.select("c_custkey", text.compose_name(F.concat("c_mktsegment", F.lit("  x")), middle, "c_name").alias("name"))


@query("compose_date", """
WITH p AS (SELECT c_custkey, 1790 + c_custkey % 330 AS y, c_custkey % 14 AS m, c_custkey % 33 AS d FROM customer),
v AS (SELECT *, try_cast(lpad(y::VARCHAR, 4, '0') || '-' || lpad(m::VARCHAR, 2, '0') || '-' || lpad(d::VARCHAR, 2, '0') AS DATE) AS date FROM p)
SELECT c_custkey, strftime(date, '%m/%d/%Y') AS text, CASE WHEN y BETWEEN 1801 AND 2100 THEN date END AS checked FROM v""")
def compose_date(t: Tables):
    k = F.col("c_custkey")
    parts = (k % 330 + 1790, k % 14, k % 33)
    return t.customer.select("c_custkey", keys.compose_date(*parts, text=True).alias("text"),
                             keys.compose_date(*parts, year_range=(1801, 2100)).alias("checked"))


@query("composite_key", """
SELECT c_custkey, coalesce(cast(CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_nationkey END AS VARCHAR), '') || '_' || c_mktsegment AS key,
  CASE WHEN c_custkey % 3 = 0 THEN '99' ELSE '10' END || '_' || c_nationkey AS grade_id FROM customer""")
def composite_key(t: Tables):
    nation = F.when(F.col("c_custkey") % 4 != 0, F.col("c_nationkey"))
    grade = keys.grade_or_default(F.when(F.col("c_custkey") % 3 == 0, "x").otherwise(" 10.0"))
    return t.customer.select("c_custkey", keys.composite_key(nation, "c_mktsegment").alias("key"),
                             keys.composite_key(grade, "c_nationkey").alias("grade_id"))


@query("decode_intensity", """
WITH v AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_quantity < 7 THEN chr(64 + l_quantity::INT) WHEN l_quantity < 20 THEN '-'
  WHEN l_quantity < 40 THEN cast(l_linenumber AS VARCHAR) ELSE l_linestatus END AS x FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, CASE x WHEN 'A' THEN 10.0 WHEN 'B' THEN 11 WHEN 'C' THEN 12 WHEN 'D' THEN 13 WHEN 'E' THEN 14
  WHEN 'F' THEN 15 ELSE coalesce(try_cast(x AS DOUBLE), 0) END::DOUBLE AS intensity FROM v""")
def decode_intensity(t: Tables):
    q = F.col("l_quantity")
    x = F.when(q < 7, F.chr((q + 64).cast("bigint"))).when(q < 20, "-").when(q < 40, F.col("l_linenumber").cast("string")).otherwise(F.col("l_linestatus"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", codes.decode_intensity(x).alias("intensity"))


@query("median3", """
SELECT l_orderkey, l_linenumber, l_partkey, list_sort([l_quantity, l_tax, l_discount])[2] AS middle FROM lineitem""")
def median3(t: Tables):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", keys.median3("l_quantity", "l_tax", "l_discount").alias("middle"))


@query("min3", "SELECT l_orderkey, l_linenumber, l_partkey, least(l_quantity, l_tax, l_discount) AS smallest FROM lineitem")
def min3(t: Tables):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", keys.min3("l_quantity", "l_tax", "l_discount").alias("smallest"))


@query("band_number", "SELECT l_orderkey, l_linenumber, l_partkey, least(ceil(l_quantity / 5), 10)::BIGINT AS band FROM lineitem")
def band_number(t: Tables):
    return rounded(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", keys.band_number("l_quantity").alias("band")))


@query("sentinel_to_null", "SELECT p_partkey, nullif(p_size, 15) AS size, nullif(p_brand, 'Brand#2') AS brand FROM part")
def sentinel_to_null(t: Tables):
    return rounded(t.part.select("p_partkey", codes.sentinel_to_null("p_size", 15).alias("size"),
                                 codes.sentinel_to_null("p_brand", "Brand#2").alias("brand")))


@query("recode_levels", """
SELECT p_partkey, CASE p_size % 7 WHEN 1 THEN 'L' WHEN 2 THEN 'B' WHEN 3 THEN 'P' WHEN 4 THEN 'A' WHEN 5 THEN 'AD' ELSE '' END AS letter,
  CASE WHEN p_size % 7 IN (3, 4, 5) THEN '1' WHEN p_size % 7 IN (1, 2) THEN '2' ELSE '3' END AS pass,
  CASE WHEN p_size % 7 BETWEEN 1 AND 5 THEN p_size % 7 END AS level FROM part""")
def recode_levels(t: Tables):
    level = F.col("p_size") % 7
    return rounded(t.part.select("p_partkey", codes.recode_levels(level).alias("letter"), codes.pass_flag(level).alias("pass"),
                                 codes.report_level(level).alias("level")))


@query("clean_label", r"""
SELECT doc_id, md5(trim(regexp_replace(replace(coalesce(text, ''), '- -', '-'), '\s+', ' ', 'g'))) AS digest FROM documents""")
def clean_label(t: Tables):
    return t.documents.select("doc_id", F.md5(keys.clean_label("text")).alias("digest"))


@query("trim_float_text", """
WITH v AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN cast(o_custkey AS VARCHAR) || '.0' WHEN 1 THEN '3.50' WHEN 2 THEN NULL ELSE o_orderpriority END AS x FROM orders)
SELECT o_orderkey, CASE WHEN x IS NULL THEN '' WHEN x LIKE '%.%' AND try_cast(x AS DOUBLE) = floor(try_cast(x AS DOUBLE))
  THEN cast(cast(x AS DOUBLE)::BIGINT AS VARCHAR) ELSE x END AS level FROM v""")
def trim_float_text(t: Tables):
    k = F.col("o_orderkey") % 4
    x = F.when(k == 0, F.concat(F.col("o_custkey").cast("string"), F.lit(".0"))).when(k == 1, "3.50").when(k == 3, F.col("o_orderpriority"))
    return t.orders.select("o_orderkey", keys.trim_float_text(x).alias("level"))


@query("character_cleanup", """
SELECT p_partkey, replace(replace(replace(p_brand || '`[?', '`', ''''), '[', '('), '?', '') AS cleaned,
  CASE WHEN regexp_matches(p_type, '^[A-M]') THEN p_type ELSE '' END AS kept FROM part""")
def character_cleanup(t: Tables):
    return t.part.select("p_partkey", text.character_cleanup(F.concat("p_brand", F.lit("`[?"))).alias("cleaned"),
                         text.character_cleanup("p_type", {}, "^[A-M]").alias("kept"))


@query("normalize_column_names", "SELECT n_nationkey AS nation_key, n_name AS name, n_regionkey AS column_3 FROM nation")
def normalize_column_names(t: Tables):
    return rounded(names.normalize_column_names(t.nation.toDF("Nation Key", " NAME", "name")))


@query("select_columns_like", "SELECT c_custkey, c_nationkey FROM customer")
def select_columns_like(t: Tables):
    return rounded(names.select_columns_like(t.customer, [r"nationkey$"], ["C_CUSTKEY"]))


@query("sql_functions", r"""
SELECT p_partkey, levenshtein(p_name, p_type) AS distance, regexp_replace(p_name, '(\s)\s+', '\1', 'g') AS squeezed FROM part""")
def sql_functions(t: Tables):
    from ..functions import register_sql_functions

    register_sql_functions(t.spark)
    return rounded(t.spark.sql(
        "SELECT p_partkey, LevenshteinDistance(p_name, p_type) AS distance, CompressWhiteSpace(p_name) AS squeezed FROM {part}",
        part=t.part))
