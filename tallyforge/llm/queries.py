"""Registered queries of the text operators, each over its whole table."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, divergence, exact, importance, license, linededup, media, mixture, neardup, pii, quality, tokenfiles, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query("op1_pii")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.pii_spans(table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))

    def text_of(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count_of(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count_of(k) for k in pii.BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(text_of(base), 256).alias("base_sha256"), text_of(F.col("spans")).alias("spans"))


@query("op2_mixture", r"""
    WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                      ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT AS o FROM documents),
         t AS (SELECT source, sum(size)::BIGINT AS s, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth FROM d GROUP BY source),
         c AS (SELECT *, 3.0::DOUBLE * s AS cap, (1 + nth % 3)::DOUBLE AS w, [0.5, 0.0, -0.5][nth % 3 + 1]::DOUBLE AS tilt,
                      sum(s) OVER ()::DOUBLE AS total FROM t),
         l AS (SELECT *, (total - coalesce(sum(cap) OVER before, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS level
               FROM c WINDOW before AS (ORDER BY cap / w, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
         k AS (SELECT arg_min(level, (cap / w, nth)) AS level FROM l WHERE level <= cap / w),
         g AS (SELECT source, s, tilt, least(cap, coalesce(k.level * w, cap)) AS target FROM l, k),
         r AS (SELECT doc_id, size, s, tilt, target, round(target)::BIGINT AS budget,
                      sum(size) OVER (PARTITION BY d.source ORDER BY o, doc_id)::BIGINT - size AS b
               FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
         x AS (SELECT *, (CASE WHEN s > 0 THEN size * (budget // s) + least(greatest(budget % s - b, 0), size) ELSE 0 END)::BIGINT AS taken FROM r),
         y AS (SELECT *, least((b + least(taken, size) / 2) / target, 1) AS share FROM x)
    SELECT doc_id, size, s AS source_size, round(target, 6) AS target, taken,
           round(CASE WHEN taken > 0 THEN CASE WHEN tilt = 0 THEN share
               ELSE (tilt + 1 - sqrt((tilt + 1) * (tilt + 1) - 4 * tilt * share)) / (2 * tilt) END END, 6) AS position
    FROM y""")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return mixture.mix_plan(table(spark, folder, "documents")).withColumns(
        {"target": F.round("target", 6), "position": F.round("position", 6)})


@query("op3_quality")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_scores(table(spark, folder, "documents"))


@query("op4_line_dedup")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return linededup.line_report(table(spark, folder, "documents"), passages=True)


def _sql_list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


_LICENSE_SQL = r"""
    WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
         w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM d),
         p(label, words) AS (VALUES {phrases}),
         tpl(label, words, need) AS (VALUES {templates}),
         placed AS (
             SELECT doc_id, label, i - 1 AS start FROM w, p, range(1, len(ws) - len(words) + 2) AS r(i)
             WHERE list_contains(ws, words[1]) AND ws[i:i + len(words) - 1] = words),
         base AS (SELECT doc_id, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word,
                         list(DISTINCT label) AS labels FROM placed GROUP BY doc_id),
         blocks AS (SELECT doc_id, unnest(string_split(regexp_replace(t, '([.!?])[ \t\r]+', '\1' || chr(10), 'g'), chr(10))) AS b FROM w),
         sets AS (SELECT doc_id, list_distinct(regexp_extract_all(b, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS bs FROM blocks WHERE b <> ''),
         shared AS (SELECT doc_id, label, len(list_intersect(bs, words)) AS n, len(words) AS size, need FROM sets, tpl),
         own AS (SELECT doc_id, list(DISTINCT label) AS labels, max(n / size) AS score FROM shared WHERE n >= need GROUP BY doc_id)
    SELECT w.doc_id, len(ws) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
           coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
           coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(own.labels, [])))), ','), '') AS labels,
           CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(own.score, 0.0) END::DOUBLE AS score
    FROM w LEFT JOIN base ON base.doc_id = w.doc_id LEFT JOIN own ON own.doc_id = w.doc_id""".replace("{phrases}", ", ".join(f"('{label}', {_sql_list(phrase.split())})" for phrase, label in license.PHRASES.items())).replace(
    "{templates}", ", ".join(f"('{label}', {_sql_list(w)}, {math.ceil(license.THRESHOLD * len(w) - 1e-9)})"
                             for label, w in ((label, license.template_words(t)) for label, t in license.TEMPLATES.items())))


@query("op5_license", _LICENSE_SQL)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    found = license.scan_licenses(table(spark, folder, "documents"))
    starts = F.transform("places", lambda p: p["start"])
    base = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
    own = F.transform("matches", lambda m: m["label"])
    best = F.coalesce(F.array_max(F.transform("matches", lambda m: m["score"])), F.lit(0.0))
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, own)), ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(best).alias("score"))


@query("op6_toxicity")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op7_bpe")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return bpe.bpe_digests(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                           public_tokenizers.PATTERN)


@query("op8_near_dedup", r"""
    WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
         s AS (SELECT DISTINCT doc_id, array_to_string(CASE WHEN len(w) < 3 THEN w ELSE w[i:i + 2] END, ' ') AS g
               FROM d, range(1, greatest(len(w) - 1, 2)) AS r(i) WHERE len(w) > 0),
         n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
         pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
         links AS MATERIALIZED (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
         reach(doc_id, other) AS (SELECT a, b FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other),
         c AS (SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(c.other, d.doc_id)) AS component_id,
           d.doc_id = least(d.doc_id, coalesce(c.other, d.doc_id)) AS kept
    FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.doc_id = d.doc_id""")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.mark_near(table(spark, folder, "documents"))


@query("op9_exact", """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
         g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
    SELECT doc_id, keep_id, group_size,
           doc_id IS NOT DISTINCT FROM keep_id AND row_number() OVER (PARTITION BY doc_id, d.t) = 1 AS kept,
           sha256(d.t) AS text_sha256
    FROM d JOIN g ON d.t = g.t""")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return exact.mark_exact(table(spark, folder, "documents"))


@query("op10_media")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return media.media_columns(table(spark, folder, "documents")).select(
        "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature",
        "width", "height")


@query("op11_divergence", r"""
    WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS doc,
                      regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
         o AS (SELECT lang, source, doc, unnest(w) AS term FROM d),
         k AS (SELECT lang, term, count(*)::HUGEINT AS total FROM o GROUP BY lang, term HAVING count(DISTINCT doc) >= 3),
         c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM o SEMI JOIN k USING (lang, term) GROUP BY lang, source, term),
         v AS (SELECT lang, count(*)::HUGEINT AS v, sum(total)::HUGEINT AS n FROM k GROUP BY lang),
         g AS (SELECT a.lang, a.source, coalesce(sum(c.n), 0)::HUGEINT AS n FROM (SELECT DISTINCT lang, source FROM d) a
               LEFT JOIN c ON c.lang = a.lang AND c.source = a.source GROUP BY a.lang, a.source),
         f AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + 1000000000 * (coalesce(c.n, 0) + 1) // (g.n + v.v) AS p,
                      1 + 1000000000 * (k.total + 1) // (v.n + v.v) AS q
               FROM g JOIN k ON k.lang = g.lang JOIN v ON v.lang = g.lang
               LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
         pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
                   FROM f a JOIN f b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
         parts AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
                   FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
                   LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
                   UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM f WHERE n > 0 AND p > q),
         r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
    SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM r WHERE part = 'pair' OR rank <= 200""")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.divergence(table(spark, folder, "documents"))


def _half_byte(value: int) -> int:
    for _ in range(4):
        value = value >> 1 ^ 0xEDB88320 * (value & 1)
    return value


#: CRC-32 of distinct features by half bytes, the low one of each byte first.
_IMPORTANCE_SQL = r"""
    WITH d AS (SELECT doc_id, row_number() OVER () AS doc, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
         m AS (SELECT row_number() OVER () AS doc, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
         runs AS (SELECT doc, array_to_string(w[i:i + k], ' ') AS g FROM d, range(3) AS x(k), range(1, len(w) - k + 1) AS r(i)),
         goal AS (SELECT array_to_string(w[i:i + k], ' ') AS g FROM m, range(3) AS x(k), range(1, len(w) - k + 1) AS r(i)),
         hexed AS (SELECT g, hex(encode(g)) AS h FROM (SELECT g FROM runs UNION SELECT g FROM goal)),
         hashed AS MATERIALIZED (SELECT g, (xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(len(h)),
                           lambda i: (instr('0123456789ABCDEF', h[i + 2 - 2 * (i % 2)]) - 1)::UBIGINT)),
                       lambda c, x: xor(c >> 4, {table}[(xor(c, x) & 15)::INT + 1]::UBIGINT)), 4294967295::UBIGINT) % 10000)::INT AS b FROM hexed),
         s AS (SELECT b, count(*) AS s FROM runs JOIN hashed USING (g) GROUP BY b),
         t AS (SELECT b, count(*) AS t FROM goal JOIN hashed USING (g) GROUP BY b),
         gains AS (SELECT s.b, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT sum(s) FROM s) + 10000)::DOUBLE
                       / ((s + 1)::DOUBLE * (coalesce((SELECT sum(t) FROM t), 0) + 10000)::DOUBLE)))::BIGINT AS gain FROM s LEFT JOIN t ON t.b = s.b),
         f AS (SELECT doc, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM runs JOIN hashed USING (g) JOIN gains USING (b) GROUP BY doc),
         z AS (SELECT doc_id, doc, len(w) >= 20 AS large, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
                      + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
               FROM d LEFT JOIN f USING (doc)),
         r AS (SELECT *, row_number() OVER (PARTITION BY large ORDER BY score DESC, doc_id NULLS FIRST) AS nth, 5 * count(*) OVER (PARTITION BY large) // 100 AS k FROM z)
    SELECT doc_id, n_features, weight, score, CASE WHEN large AND nth <= k THEN nth END AS rank FROM r""".replace(
    "{table}", "[" + ", ".join(str(_half_byte(i)) for i in range(16)) + "]")


@query("op12_importance", _IMPORTANCE_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op13_token_files")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return tokenfiles.token_index(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
