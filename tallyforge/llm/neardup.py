"""Near duplicates by HyperMinHash sketches, verified on full shingle sets.

Sketch.  A document's set holds 64-bit hashes of its word shingles.  The top 7
bits of a hash choose one of 128 buckets; a bucket keeps the smallest rest of
its hashes, stored as the number of leading zeros and the 10 bits after the
leading one.  An empty bucket copies a full one along a fixed probe order.

Candidates.  Equal sets become one node first, so copies cost nothing more.
Four compressed registers make a band, 32 bands a node.  Nodes that share a
band form a bucket.  A pair with similarity 0.85 shares no band with a
probability near 5e-11 (at 0.8, 5e-8).  A bucket never emits all its pairs:

1. Its pivot, the member with most company over all its bands, is compared
   with each other member, so the work is linear.  The collision-corrected
   estimate from the registers decides the route: from ``NEAR`` on, the pair is
   verified on full sets and the difference to the pivot is kept.
2. A member linked to the pivot is connected.  For the others the search is
   exact: with D(x) = x xor pivot, sets x and y differ in D(x) xor D(y), so a
   linked pair that is not connected through the pivot must share elements of
   D.  These are joined on rare elements of D first, with prefix, length and
   positional filters.  One edited word changes few elements, so a group of
   thousands of variants of one text has few candidates.
3. Members far from the pivot go the same way with an empty pivot, where D(x)
   is x itself, together with the members that could be linked to them.

All candidates are verified on full sets.  Links are joined to components by
minimum labels with pointer jumping; every round is checkpointed.

Defined cases: null text is the empty text; a document without words has
n_shingles 0, is linked with nothing and is kept; with fewer words than a
shingle has, the whole sequence is one shingle; ids may repeat or be null (a
null id never names a component that has an id); repeated rows share a node; a
very long text is one set, held by its task alone; equal registers and
estimates decide nothing by themselves, since every link is confirmed on sets;
other columns pass through ``drop_near`` untouched; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import BROADCAST_LIMIT_BYTES, checkpointed
from .common import bounded_batches, columns_of, record_batch, whole_text

#: Similarity in hundredths: linked when 100 * intersection >= ABOVE * union.
ABOVE = 85
REGISTER_BITS = 7
REGISTERS = 1 << REGISTER_BITS
MANTISSA_BITS = 10
BAND = 4
#: Estimated similarity to the pivot from which a member is verified against it.
NEAR = 0.3
#: True similarity that an estimate below NEAR may hide, more than 5 deviations away.
HIDDEN = 0.55

_K = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_PROBE = np.argsort(np.random.default_rng(20240229).random((REGISTERS, REGISTERS)), axis=1)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _K[0]
    h = (h ^ (h >> np.uint64(29))) * _K[1]
    return h ^ (h >> np.uint64(32))


def shingle_set(text: str, width: int) -> np.ndarray:
    """Sorted distinct hashes (uint64) of the text's word shingles; A-Z count as a-z."""
    words = text.encode().lower().split()  # bytes: ASCII case and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < width:
        whole = xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))
        return _mix(np.array([whole], np.uint64))
    digest = xxhash.xxh3_64_intdigest
    each = np.fromiter(map(digest, words), np.uint64, len(words))
    n = len(words) - width + 1
    h = np.full(n, width, np.uint64)
    for i in range(width):
        h = _mix(h * _K[2] + each[i:i + n])
    return np.unique(h)


def registers(hashes: np.ndarray) -> np.ndarray:
    """The sketch of a sorted, non-empty set: leading zeros and mantissa per bucket (uint16)."""
    bounds = np.arange(REGISTERS, dtype=np.uint64) << np.uint64(64 - REGISTER_BITS)
    at = np.searchsorted(hashes, bounds)
    full = np.diff(np.append(at, len(hashes))) > 0
    rest = hashes[np.minimum(at, len(hashes) - 1)] << np.uint64(REGISTER_BITS)
    _, exponent = np.frexp((rest >> np.uint64(11)).astype(np.float64))
    zeros = (53 - exponent).astype(np.uint64)
    mantissa = (rest << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA_BITS)
    mantissa[zeros >= 53] = 0
    value = ((zeros << np.uint64(MANTISSA_BITS)) | mantissa).astype(np.uint16)
    if not full.all():
        donor = _PROBE[np.arange(REGISTERS), full[_PROBE].argmax(axis=1)]
        value = np.where(full, value, value[donor])
    return value


def collision_rate(n1: np.ndarray, n2: np.ndarray) -> np.ndarray:
    """Chance that registers of two disjoint sets agree: same leading zeros, then same mantissa."""
    rate = np.zeros(len(n1))
    a, b = np.maximum(n1 / REGISTERS, 1.0), np.maximum(n2 / REGISTERS, 1.0)
    for zeros in range(40):
        low, high = 2.0 ** -(zeros + 1), 2.0 ** -zeros
        rate += (np.exp(-a * low) - np.exp(-a * high)) * (np.exp(-b * low) - np.exp(-b * high))
    return rate / (1 << MANTISSA_BITS)


def estimate(a: np.ndarray, b: np.ndarray, n1: np.ndarray, n2: np.ndarray) -> np.ndarray:
    """Jaccard estimates from register rows, corrected for chance collisions."""
    same = (a == b).mean(axis=1)
    chance = collision_rate(n1, n2)
    return np.maximum(0.0, (same - chance) / (1 - chance))


# ------------------------------------------------------------------ sketches

_SKETCH = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n", pa.int64()), ("set_key", pa.binary()),
                     ("bands", pa.list_(pa.int64()))])


def _sketch(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in columns_of(batches):
            out: dict[str, list] = {f.name: [] for f in _SKETCH}
            for doc_id, text_hash, text in zip(rows["doc_id"], rows["text_hash"], rows["text"]):
                hashes = shingle_set(text, width)
                some = len(hashes) > 0
                out["doc_id"].append(doc_id)
                out["text_hash"].append(text_hash)
                out["n"].append(len(hashes))
                out["set_key"].append(xxhash.xxh3_128_digest(hashes.tobytes()) if some else None)
                out["bands"].append(registers(hashes).view(np.int64) if some else [])
            yield record_batch(_SKETCH, out)

    return run


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = whole_text(text_col)
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def sketches(docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, n (set size), set_key (128-bit hash of the set, null if empty) and bands (packed registers)."""
    bounded_batches(docs.sparkSession)
    return _keyed(docs, id_col, text_col).mapInArrow(
        _sketch(width), "doc_id long, text_hash long, n long, set_key binary, bands array<long>")


_SET = pa.schema([("node", pa.int64()), ("hashes", pa.list_(pa.int64()))])


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in columns_of(batches):
            yield record_batch(_SET, {"node": rows["node"], "hashes": [np.sort(shingle_set(t, width).view(np.int64)) for t in rows["text"]]})

    return run


def _checked_broadcast(frame: DataFrame, row_bytes: int) -> DataFrame:
    """A broadcast hint if the counted rows stay below the library's limit, else the frame as it is."""
    return F.broadcast(frame) if frame.count() * row_bytes <= BROADCAST_LIMIT_BYTES else frame


# ---------------------------------------------------------------- candidates

def _estimated(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in frames:
        if len(rows):
            a = np.stack(rows["bands_a"].to_numpy()).view(np.uint16)
            b = np.stack(rows["bands_b"].to_numpy()).view(np.uint16)
            rows["estimate"] = estimate(a, b, rows["n_a"].to_numpy(), rows["n_b"].to_numpy())
            yield rows[["a", "b", "n_a", "n_b", "estimate"]]


def _with_estimates(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs a, b with n_a, n_b and the estimated similarity."""
    side = {s: nodes.select(F.col("node").alias(s), F.col("n").alias(f"n_{s}"), F.col("bands").alias(f"bands_{s}")) for s in "ab"}
    return pairs.select("a", "b").join(side["b"], "b").join(side["a"], "a").mapInPandas(
        _estimated, "a long, b long, n_a long, n_b long, estimate double")


def _verified(with_delta: bool):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in frames:
            inter, delta = [], []
            for a, b in zip(rows["hashes_a"], rows["hashes_b"]):
                if with_delta:
                    d = np.setxor1d(a, b, assume_unique=True)
                    delta.append(d)
                    inter.append((len(a) + len(b) - len(d)) // 2)
                else:
                    inter.append(len(np.intersect1d(a, b, assume_unique=True)))
            rows["inter"] = np.array(inter, np.int64)
            if with_delta:
                rows["delta"] = delta
            yield rows[["a", "b", "n_a", "n_b", "inter"] + ["delta"] * with_delta]

    return run


def _verify(pairs: DataFrame, sets: DataFrame, with_delta: bool) -> DataFrame:
    """Exact intersections of pairs a, b (with n_a, n_b) on full sets."""
    side = {s: sets.select(F.col("node").alias(s), F.col("hashes").alias(f"hashes_{s}")) for s in "ab"}
    schema = "a long, b long, n_a long, n_b long, inter long" + ", delta array<long>" * with_delta
    return pairs.select("a", "b", "n_a", "n_b").join(side["b"], "b").join(side["a"], "a").mapInPandas(_verified(with_delta), schema)


def _linked(above: int) -> Column:
    return F.col("inter") * 100 >= F.lit(above) * (F.col("n_a") + F.col("n_b") - F.col("inter"))


def _slack(total: Column, above: int) -> Column:
    """The largest difference of two linked sets whose sizes sum up to ``total``."""
    return F.floor(total * (100 - above) / (100 + above))


def _delta_pairs(members: DataFrame, above: int) -> DataFrame:
    """Candidate pairs within groups; members: grp, node, n, open, delta.

    Two members that differ little enough must share part of their deltas.  At
    least one member of a pair is open (not linked to the group's pivot).
    """
    most = F.col("n") + F.floor(F.col("n") * 100 / above)
    members = checkpointed(members.select(
        F.monotonically_increasing_id().alias("member"), "grp", "node", "n", "open", F.size("delta").alias("d"), "delta"))
    least = F.greatest(F.lit(1), F.col("d") - _slack(most, above)).cast("int")
    tokens = members.select("member", least.alias("least"), F.explode("delta").alias("tok"), "grp").select(
        "member", "least", F.xxhash64("grp", "tok").alias("token"))
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    # 'left': shared elements of the member from this one on, rarest first; elements of its own come before them all.
    order = Window.partitionBy("member").orderBy(F.desc("df"), "token")
    prefix = tokens.join(shared, "token").withColumn("left", F.row_number().over(order)).where("left >= least").select("member", "token", "left")
    prefix = checkpointed(prefix.join(members.select("member", "node", "n", "d", "open"), "member"))
    x = prefix.where("open").select("token", *[F.col(c).alias(f"{c}_a") for c in ("node", "n", "d", "left")])
    y = prefix.select("token", "open", *[F.col(c).alias(f"{c}_b") for c in ("node", "n", "d", "left")])
    need = F.greatest(F.lit(1), F.ceil((F.col("d_a") + F.col("d_b") - _slack(F.col("n_a") + F.col("n_b"), above)) / 2))
    fits = (F.least("left_a", "left_b") >= need) & (F.least("n_a", "n_b") * 100 >= F.lit(above) * F.greatest("n_a", "n_b"))
    # Of two open members the pair is made once.
    once = F.when(F.col("open"), F.col("node_a") < F.col("node_b")).otherwise(F.col("node_a") != F.col("node_b"))
    return x.join(y, "token").where(once & fits).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"), "n_a", "n_b").distinct()


def find_links(docs: DataFrame, nodes: DataFrame, width: int, above: int, id_col: str, text_col: str) -> DataFrame:
    """Linked pairs of nodes that connect every component; nodes: node, n, bands, doc_id, text_hash."""
    bands = nodes.select("node", F.posexplode("bands").alias("band", "packed")).select(
        "node", F.xxhash64("band", "packed").alias("bucket"))
    sizes = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = checkpointed(bands.join(sizes, "bucket"))
    company = members.groupBy("node").agg(F.sum("size").alias("company"))
    # Stored, so that the join below has two plain exchanges and a hot bucket can be split.
    pivots = checkpointed(members.join(company, "node").groupBy("bucket").agg(F.max(F.struct("company", "node")).alias("best")).select(
        "bucket", F.col("best.node").alias("a")))
    starred = members.join(pivots, "bucket").where("node != a").select("a", F.col("node").alias("b")).distinct()
    near_or_far = checkpointed(_with_estimates(starred, nodes))

    # Full sets of the nodes that have company; the texts come from one row of each.
    wanted = checkpointed(nodes.join(company, "node", "left_semi").select("node", "doc_id", "text_hash"))
    rows = _keyed(docs, id_col, text_col)
    small = _checked_broadcast(wanted.withColumnRenamed("doc_id", "_id").withColumnRenamed("text_hash", "_hash"), 64)
    found = rows.join(small, (rows["text_hash"] == F.col("_hash")) & rows["doc_id"].eqNullSafe(F.col("_id"))).select("node", "text")
    sets = checkpointed(found.mapInArrow(_sets(width), "node long, hashes array<long>").dropDuplicates(["node"]))

    near = checkpointed(_verify(near_or_far.where(F.col("estimate") >= NEAR), sets, with_delta=True))
    direct = near.where(_linked(above)).select("a", "b")

    groups = near.groupBy(F.col("a").alias("grp")).agg(F.count(F.lit(1)).alias("all"), F.count_if(~_linked(above)).alias("open"))
    around_pivots = near.withColumn("grp", F.col("a")).join(groups.where("all > 1 AND open > 0").select("grp"), "grp").select(
        "grp", F.col("b").alias("node"), F.col("n_b").alias("n"), (~_linked(above)).alias("open"), "delta")
    # Members far from their pivot, with all members of the pivot's buckets that might be linked to them;
    # linked sets are at most 1 - above / 100 nearer or farther.
    member = [(-1 - F.col("a")).alias("grp"), F.col("b").alias("node"), F.col("n_b").alias("n")]
    far = near_or_far.where(F.col("estimate") < NEAR).select(*member, F.lit(True).alias("open"))
    middle = near.where(F.col("inter") < F.lit(HIDDEN + 1 - above / 100 + 0.05) * (F.col("n_a") + F.col("n_b") - F.col("inter")))
    beside = middle.select(*member, F.lit(False).alias("open")).join(far.select("grp").distinct(), "grp", "left_semi")
    apart = far.unionByName(beside).join(sets.withColumnRenamed("hashes", "delta"), "node").select("grp", "node", "n", "open", "delta")

    more = checkpointed(_delta_pairs(around_pivots.unionByName(apart), above))
    # The estimate's last word before verification, six deviations below the threshold.
    likely = _with_estimates(more, nodes).where(F.col("estimate") >= above / 100 - 0.22)
    rest = _verify(likely, sets, with_delta=False).where(_linked(above)).select("a", "b")
    return direct.unionByName(rest)


def thinned(links: DataFrame) -> DataFrame:
    """Fewer links a, b with the same components: b keeps its first partner, which stands for b towards the others."""
    first = F.min("a").over(Window.partitionBy("b"))
    chosen = links.withColumn("first", first)
    return chosen.select(F.col("first").alias("a"), "b").unionByName(
        chosen.where("a != first").select(F.col("first").alias("a"), F.col("a").alias("b"))).distinct()


def connected(links: DataFrame) -> DataFrame:
    """Components of links a, b: node and label (the smallest node of its component)."""
    links = checkpointed(thinned(links))
    edges = checkpointed(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = checkpointed(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select(
        "node", F.least("node", "m").alias("label")))
    while True:
        around = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("seen"))
        nearer = labels.join(around, "node").select("node", F.col("label").alias("old"), F.least("label", "seen").alias("new"))
        jump = labels.select(F.col("node").alias("new"), F.col("label").alias("beyond"))
        after = checkpointed(nearer.join(jump, "new").select("node", "old", F.least("new", "beyond").alias("label")))
        labels = after.select("node", "label")
        if after.where("label != old").isEmpty():
            return labels


def near_groups(docs: DataFrame, width: int = 3, above: int = ABOVE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows with their group: doc_id, text_hash, n, set_key, first_id, first_hash.

    ``first_id`` and ``first_hash`` name the group's row with the smallest id.
    """
    rows = checkpointed(sketches(docs, width, id_col, text_col))
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_hash")))
    any_row = F.min(F.struct("doc_id", "text_hash"))
    nodes = rows.where("set_key IS NOT NULL").groupBy("set_key").agg(
        F.max("n").alias("n"), F.first("bands").alias("bands"), F.coalesce(first, any_row).alias("one"))
    # Numbers are stable from the checkpoint on, and lighter than 128-bit keys in every later join.
    nodes = checkpointed(nodes.select(
        F.monotonically_increasing_id().alias("node"), "set_key", "n", "bands", F.col("one.doc_id").alias("doc_id"),
        F.col("one.text_hash").alias("text_hash")))
    labels = connected(find_links(docs, nodes, width, above, id_col, text_col))
    grouped = nodes.join(labels, "node", "left").select(
        "set_key", F.coalesce("label", "node").alias("label"), F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash").alias("one"))
    firsts = checkpointed(grouped.groupBy("label").agg(F.min("one").alias("first")))
    by_node = grouped.join(firsts, "label").select("set_key", F.col("first.doc_id").alias("first_id"), F.col("first.text_hash").alias("first_hash"))
    return rows.select("doc_id", "text_hash", "n", "set_key").join(by_node, "set_key", "left")


def mark_near(docs: DataFrame, width: int = 3, above: int = ABOVE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("first_id"))
    return near_groups(docs, width, above, id_col, text_col).select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near(docs: DataFrame, width: int = 3, above: int = ABOVE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without near copies: all columns, one row of each group and every row without words."""
    marked = near_groups(docs, width, above, id_col, text_col)
    stay = marked.where(F.col("set_key").isNull() | (F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_hash") == F.col("first_hash"))))
    stay = stay.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("set_key").isNull().alias("_empty")).distinct()
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    plain = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    key, text = F.col(names[id_col]).cast("long"), whole_text(names[text_col])
    rows = plain.withColumns({"_key": key, "_text": F.xxhash64(text)})
    rows = rows.join(stay, (F.col("_text") == F.col("_hash")) & F.col("_key").eqNullSafe(F.col("_id")))
    others = [n for c, n in names.items() if c not in (id_col, text_col)]
    nth = F.row_number().over(Window.partitionBy("_key", "_text").orderBy(F.to_json(F.struct(*others)) if others else F.lit(0)))
    return rows.withColumn("_nth", nth).where("_nth = 1 OR _empty").select(*[F.col(n).alias(c) for c, n in names.items()])
