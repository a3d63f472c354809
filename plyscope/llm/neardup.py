"""Near-duplicate groups by MinHash and odd sketches.

A text's set is its distinct word shingles. MinHash samples of the sets give band keys that
collect candidates, and fold into odd sketches: parity bitmaps whose XOR counts estimate a
high similarity closely enough to drop pairs far below the limit. What is left is confirmed
on the full sets. Equal sets are one node from the start, so copies cost nothing further.

No list of all pairs is made. Within a band bucket, members whose sketches are close are
joined into one candidate group, by fewer edges than members. The sets of a group then come
together once: all are held against its first member, and only members that are not in one
component yet are compared further, as far as sketch, size and the triangle inequality of the
Jaccard distance leave the pair a chance. No link between candidates is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from plyscope.llm.common import U64, byte_texts, components, deal_blocks, meet, mixed, runs, slices, table
from plyscope.session import land

BANDS, ROWS = 32, 4
SAMPLES = BANDS * ROWS
BITS = 512
BLOCK, SET_BLOCK = 2048, 1024
_rng = np.random.default_rng(20240229)
MULTIPLY = _rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint32) | np.uint32(1)
ADD = _rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint32)
#: Samples of a pair at the limit agree in 0.8 of 128 on average, +- 0.035; five of those below.
MARGIN = 0.18


def shingle_set(text: bytes, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles; A-Z folds to lower case.

    Fewer words than k are one shingle; no words are none.
    """
    words = text.lower().split()
    n = len(words)
    if not n:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(xxh3_64_intdigest, words), dtype=np.uint64, count=n)
    k = min(k, n)
    s = h[: n - k + 1] + U64(k)
    for i in range(1, k):
        s = mixed(s) * U64(0x9E3779B97F4A7C15) + h[i : n - k + 1 + i]
    return np.unique(mixed(s))


def minima(s: np.ndarray) -> np.ndarray:
    """The MinHash samples of a set."""
    x = (s >> U64(32)).astype(np.uint32)
    least = np.full(SAMPLES, 0xFFFFFFFF, dtype=np.uint32)
    for start in range(0, len(x), 256):
        np.minimum(least, (x[start : start + 256, None] * MULTIPLY + ADD).min(axis=0), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """One 64-bit key per band for each row of samples."""
    m = least.reshape(len(least), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), m.shape[:2])
    for i in range(ROWS):
        key = mixed(key * U64(0x9E3779B97F4A7C15) + m[:, :, i])
    return key.view(np.int64)


def odd_sketches(least: np.ndarray) -> np.ndarray:
    """Parity bitmaps of the (position, sample) pairs, as 64-bit words."""
    at = mixed((np.arange(SAMPLES, dtype=np.uint64) << U64(32)) + least.astype(np.uint64)) & U64(BITS - 1)
    row = np.arange(len(least))[:, None] * BITS
    odd = np.bincount((row + at.astype(np.int64)).ravel(), minlength=len(least) * BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).reshape(len(least), BITS // 64)


def most_differing(limit: float) -> int:
    """The XOR count at which the estimate 1 + n/4k ln(1 - 2x/n) falls to `limit`."""
    return int(BITS / 2 * (1 - np.exp(-4 * SAMPLES * (1 - limit) / BITS)))


def _lists(a: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(0, a.size + 1, a.shape[1], dtype=np.int32), a.ravel())


def sketch(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, row, n_shingles, node, bands, odd); node is a digest of the set, null if empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1024):
                sets = [shingle_set(t, shingle) for t in byte_texts(part["text"])]
                least = np.stack([minima(s) for s in sets])
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part["doc_id"],
                        "row": part["row"],
                        "n_shingles": np.array([len(s) for s in sets], dtype=np.int64),
                        "node": pa.array([xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                        "bands": _lists(band_keys(least)),
                        "odd": _lists(odd_sketches(least)),
                    }
                )

    schema = "doc_id long, row long, n_shingles long, node binary, bands array<long>, odd array<long>"
    return docs.select("doc_id", "row", "text").mapInArrow(run, schema)


def candidate_groups(nodes: DataFrame, differing: int) -> DataFrame:
    """(nid, grp): nodes that share a band bucket with a node of close sketch, by group."""
    keyed = nodes.select("nid", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("nid").alias("least"), F.max("nid").alias("most")).where("least < most")
    members = keyed.join(shared.select("key"), "key").join(nodes.selectExpr("nid", "odd AS code"), "nid")
    dealt = deal_blocks(land(members, "members"), ["key"], BLOCK, ["code"])
    edges = dealt.mapInArrow(lambda batches: meet(batches, ["key"], differing), "a long, b long")
    return components(edges).withColumnsRenamed({"node": "nid", "component": "grp"})


def group_sets(groups: DataFrame, nodes: DataFrame, docs: DataFrame, shingle: int) -> DataFrame:
    """(nid, grp, odd, items): the full sets of the grouped nodes, made again from their texts."""
    needed = groups.join(nodes.select("nid", "doc_id", "node", "odd"), "nid")
    texts = docs.select(F.col("doc_id").alias("own_id"), "text").join(needed, F.col("own_id").eqNullSafe(F.col("doc_id")))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 512):
                sets = [shingle_set(t, shingle).tobytes() for t in byte_texts(part["text"])]
                own = np.array([xxh3_128_digest(s) == n for s, n in zip(sets, part["node"].to_pylist(), strict=True)], dtype=bool)
                columns = {c: part[c] for c in ("nid", "grp", "odd")} | {"items": pa.array(sets, pa.binary())}
                yield pa.RecordBatch.from_pydict(columns).filter(pa.array(own))

    made = texts.select("nid", "grp", "odd", "node", "text").mapInArrow(make, "nid long, grp long, odd array<long>, items binary")
    return made.dropDuplicates(["nid"])


def join_by_links(sets: list[np.ndarray], odd: np.ndarray, differing: int, percent: int) -> np.ndarray:
    """For each set the first of its component; links are exact, pairs already joined are left out."""
    n, odd = np.array([len(s) for s in sets]), odd.view(np.uint64)
    same = lambda i, j: int((sets[i][np.minimum(np.searchsorted(sets[i], sets[j]), n[i] - 1)] == sets[j]).sum())
    shared = np.array([same(0, j) for j in range(len(sets))])
    apart = 1 - shared / (n[0] + n - shared)  # Jaccard distance from the first
    label = np.arange(len(sets))
    label[100 * shared >= percent * (n[0] + n - shared)] = 0
    reach = 1 - percent / 100 + 1e-9
    for i in np.flatnonzero(label != 0):
        x = np.bitwise_count(odd ^ odd[i]).sum(axis=1)
        chance = (x <= differing) & (100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i])) & (np.abs(apart - apart[i]) <= reach)
        chance &= (label == 0) | (np.arange(len(sets)) < i)  # of two such sets, the later looks at the earlier
        found = np.flatnonzero(chance & (label != label[i]))
        for j in found[np.argsort(x[found], kind="stable")]:
            if label[j] != label[i]:
                both = same(i, j)
                if 100 * both >= percent * (n[i] + n[j] - both):
                    low, high = sorted((label[i], label[j]))
                    label[label == high] = low
    return label


def link_nodes(nodes: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(node, component) of all nids that have a link; component is a nid."""
    differing = most_differing(percent / 100 - MARGIN)
    groups = candidate_groups(nodes, differing)
    sets = land(group_sets(groups, nodes, docs, shingle), "sets")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, t in runs(batches, ["grp", "lo", "hi"]):
            own = [np.frombuffer(s, dtype=np.uint64) for s in t["items"]]
            nid = t["nid"]
            hub = nid[join_by_links(own, t["odd"], differing, percent)]
            apart = hub != nid
            yield pa.RecordBatch.from_pydict({"a": np.minimum(hub, nid)[apart], "b": np.maximum(hub, nid)[apart]})

    return components(deal_blocks(sets, ["grp"], SET_BLOCK, ["odd", "items"]).mapInArrow(link, "a long, b long"))


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", row: str | None = None, shingle: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, row, n_shingles, component_id, kept, first) for every row of `docs`.

    Rows are linked when 100 * intersection >= percent * union of their shingle sets;
    component_id is the smallest doc_id reachable, kept says doc_id = component_id, and first
    marks exactly one row per component (`row` breaks ties of repeated ids; without it rows are
    numbered as they are read). Rows without words are linked with nothing and all kept. Null
    ids sort last: they name a component only if it has no other. Empty tables give no rows.
    """
    number = F.col(row) if row else F.monotonically_increasing_id()
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), number.alias("row"), F.col(text).cast("string").alias("text"))
    rows = land(sketch(docs, shingle), "sketches")
    nodes = rows.where("node IS NOT NULL").groupBy("node")
    nodes = nodes.agg(F.min("doc_id").alias("doc_id"), *[F.first(c).alias(c) for c in ("n_shingles", "bands", "odd")])
    nodes = land(nodes.withColumn("nid", F.monotonically_increasing_id()), "nodes")
    linked = link_nodes(nodes, docs, shingle, percent)
    owned = nodes.select("nid", "node", "doc_id").join(linked.withColumnRenamed("node", "nid"), "nid", "left")
    owned = land(owned.selectExpr("node", "doc_id", "coalesce(component, nid) AS component"), "owned")
    least = owned.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = land(owned.join(least, "component").select("node", "component", "component_id"), "named")
    out = rows.select("doc_id", "row", "n_shingles", "node").join(named, "node", "left")
    alone = F.col("component").isNull()
    out = out.withColumn("component_id", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")))
    out = out.withColumn("kept", alone | F.col("doc_id").eqNullSafe(F.col("component_id")))
    heads = out.where("kept AND component IS NOT NULL").groupBy("component").agg(F.min("row").alias("head"))
    if row is None:
        return out.select("doc_id", "row", "n_shingles", "component_id", "kept")
    out = out.join(heads, "component", "left")
    first = alone | (F.col("kept") & (F.col("row") == F.col("head")))
    return out.select("doc_id", "row", "n_shingles", "component_id", "kept", first.alias("first"))


def drop_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs`, all columns, of which one per group of near-duplicates is left."""
    docs = land(docs.withColumn("_near_dup_row", F.monotonically_increasing_id()), "numbered")
    found = near_duplicates(docs, text, doc_id, "_near_dup_row", shingle, percent)
    stay = found.where("first").select(F.col("row").alias("_near_dup_row"))
    return docs.join(stay, "_near_dup_row", "left_semi").drop("_near_dup_row")


def op6_odd_sketch_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


OP6_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS g FROM w),
n AS (SELECT w.doc_id, count(g) AS n FROM w LEFT JOIN s ON s.doc_id = w.doc_id GROUP BY w.doc_id),
-- a pair of that similarity has the same set, or shares one of the rarest shingles of either; counted over all
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS same FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * same >= 80 * (x.n + y.n - same)),
r(doc_id, other) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.other)
SELECT n.doc_id, n.n AS n_shingles, min(other) AS component_id, n.doc_id = min(other) AS kept
FROM n JOIN r ON r.doc_id = n.doc_id GROUP BY n.doc_id, n.n
"""
