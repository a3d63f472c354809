"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

Rotations are learnt that bring the vectors near the corners of the cube, and the signs of
the rotated vectors are the code. The code is cut into substrings, each with a table of its
own; vectors that agree on a whole substring meet there, and those whose full codes are close
by Hamming distance form a candidate group. Within groups the original vectors decide.

The substring is about log2(n/16) bits, so a table's bucket holds a few unrelated vectors at
any size, and there are as many tables as a link at the limit needs to be met in one of them
with probability `recall`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyscope.llm.common import components, deal_blocks, groups_of, meet, runs, slices, table
from plyscope.session import land

BLOCK = 1024


def learn_rotation(x: np.ndarray, seed: int, rounds: int = 30) -> np.ndarray:
    """Alternates between the signs of x R and the rotation that fits them best."""
    rng = np.random.default_rng(seed)
    r, _ = np.linalg.qr(rng.normal(size=(x.shape[1], x.shape[1])))
    for _ in range(rounds):
        u, _, vt = np.linalg.svd(x.T @ np.where(x @ r >= 0, 1.0, -1.0))
        r = u @ vt
    return r


@dataclass
class Index:
    rotations: np.ndarray  # dimension x code bits
    bits: int
    tables: int
    differing: int

    def codes(self, x: np.ndarray) -> np.ndarray:
        return (x @ self.rotations >= 0).astype(np.uint8)

    def keys(self, codes: np.ndarray) -> np.ndarray:
        """One bucket number per table."""
        cut = codes[:, : self.bits * self.tables].reshape(len(codes), self.tables, self.bits)
        return cut.astype(np.int64) @ (1 << np.arange(self.bits, dtype=np.int64))


def plan(x: np.ndarray, n: int, limit: float, recall: float) -> Index:
    """The index for `n` vectors, with rotations learnt on the unit vectors `x`."""
    differ = math.acos(limit) / math.pi
    bits = min(max(round(math.log2(max(n, 1) / 16)), 6) if n else 6, 24)
    tables = math.ceil(math.log(1 - recall) / math.log(1 - (1 - differ) ** bits))
    dims = x.shape[1]
    n_rot = -(-bits * tables // dims)
    rotations = np.concatenate([learn_rotation(x, seed) for seed in range(n_rot)], axis=1)
    total = rotations.shape[1]
    return Index(rotations, bits, tables, int(total * differ + 6 * math.sqrt(total * differ * (1 - differ))))


def near_vectors(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", limit: float = 0.9, recall: float = 0.999, sample: int = 8192) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row: links are pairs of cosine >= `limit`.

    Cosines are in double precision. Null vectors, zero vectors and vectors with a null or
    non-finite component link with nothing; a shorter vector counts as extended by zeros. Equal
    vectors are one node with a count. component_id is the smallest vec_id reachable by links;
    repeated rows count as others; null ids sort last. Rotations are learnt on at most `sample`
    vectors, those of smallest hash; all vectors are indexed. Empty tables give no rows.
    """
    rows = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.withColumn("v", F.expr("CASE WHEN size(v) > 0 AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity')) AND exists(v, x -> x <> 0) THEN v END"))
    dims = rows.agg(F.max(F.size("v"))).first()[0] or 0
    rows = land(rows.withColumn("v", F.expr(f"concat(v, array_repeat(0D, {dims} - size(v)))")).withColumn("same", F.expr("CASE WHEN v IS NOT NULL THEN sha2(CAST(CAST(v AS string) AS binary), 256) END")), "vectors")
    nodes = rows.where("v IS NOT NULL").groupBy("same").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("v").alias("v"))
    nodes = land(nodes.withColumn("nid", F.monotonically_increasing_id()), "nodes")
    n = nodes.count()
    learn = nodes.orderBy(F.xxhash64("same")).limit(sample).select("v").collect()
    if not learn:
        return rows.selectExpr("vec_id", "0L AS n_links", "vec_id AS component_id", "true AS kept")
    x = np.array([r.v for r in learn], dtype=np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    index = nodes.sparkSession.sparkContext.broadcast(plan(x / np.linalg.norm(x, axis=1, keepdims=True), n, limit, recall))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        for batch in batches:
            for part in slices(batch, 512):
                v = np.array(part["v"].to_pylist(), dtype=np.float64)
                codes = own.codes(v / np.abs(v).max(axis=1, keepdims=True))
                packed = np.packbits(np.pad(codes, ((0, 0), (0, -codes.shape[1] % 64))), axis=1).view(np.int64)
                many = np.repeat(packed, own.tables, axis=0)
                keys = own.keys(codes)
                yield pa.RecordBatch.from_pydict(
                    {
                        "at": np.tile(np.arange(own.tables), len(v)),
                        "bucket": keys.ravel(),
                        "nid": np.repeat(part["nid"].to_numpy(), own.tables),
                        "code": pa.ListArray.from_arrays(np.arange(0, many.size + 1, many.shape[1], dtype=np.int32), many.ravel()),
                    }
                )

    coded = nodes.select("nid", "v").mapInArrow(code, "at long, bucket long, nid long, code array<long>")
    keys = ["at", "bucket"]
    dealt = deal_blocks(land(coded, "codes"), keys, BLOCK, ["code"])
    met = dealt.mapInArrow(lambda batches: meet(batches, keys, index.value.differing), "a long, b long")
    candidates = land(components(met).withColumnsRenamed({"node": "nid", "component": "grp"}), "candidates")

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, lo, hi), t in runs(batches, ["grp", "lo", "hi"]):
            nid, block, copies = (t[c] for c in ("nid", "block", "copies"))
            v = t["v"] / np.abs(t["v"]).max(axis=1, keepdims=True)
            v /= np.linalg.norm(v, axis=1, keepdims=True)
            near = v @ v.T >= limit
            np.fill_diagonal(near, False)
            if lo != hi:  # pairs within one block belong to the run of that block
                near &= block[:, None] != block[None, :]
            label = nid[groups_of(near)]
            yield pa.RecordBatch.from_pydict({"nid": nid, "hub": label, "n": (near @ copies).astype(np.int64)})

    dealt = deal_blocks(candidates.join(nodes.select("nid", "copies", "v"), "nid"), ["grp"], BLOCK, ["copies", "v"])
    links = land(dealt.mapInArrow(rerank, "nid long, hub long, n long"), "links")
    joined = components(links, "nid", "hub")
    counts = links.groupBy("nid").agg(F.sum("n").alias("n"))
    known = nodes.select("nid", "same", "least", "copies").join(counts, "nid", "left").join(joined.withColumnRenamed("node", "nid"), "nid", "left")
    known = land(known.selectExpr("same", "least", "coalesce(n, 0L) + copies - 1 AS n", "coalesce(component, nid) AS component"), "known")
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    named = land(known.join(least, "component").select("same", "n", "component_id"), "named")
    out = rows.select("vec_id", "same").join(named, "same", "left")
    return out.selectExpr(
        "vec_id", "coalesce(n, 0L) AS n_links", "CASE WHEN n IS NULL THEN vec_id ELSE component_id END AS component_id",
        "n IS NULL OR vec_id <=> component_id AS kept",
    )


def op8_iterative_quantisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


OP8_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
ok AS (
  SELECT vec_id, v FROM v WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_dot_product(v, v) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id
  WHERE list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v)) / sqrt(list_dot_product(b.v, b.v)) >= 0.9),
r(vec_id, other) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.vec_id, l.b FROM r JOIN l ON l.a = r.other)
SELECT v.vec_id, (SELECT count(*) FROM l WHERE l.a = v.vec_id) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN (SELECT vec_id, min(other) AS component_id FROM r GROUP BY vec_id) c ON c.vec_id = v.vec_id
"""
