"""Nearest neighbours by inner product over balanced posting lists.

Vectors get one more component that brings all of them to one length, so the nearest of a
query by inner product are the nearest by distance. Balanced splits of a bounded sample give
centroids of about equally long lists; a vector near a boundary goes into several. Centroids
are searched by a graph held in memory, for rows and queries alike. A query visits the lists
whose centroids are within a ratio of its nearest one's distance. That ratio is measured: some
queries are held against all rows, and it is what their true neighbours' lists ask for.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyscope.llm.common import runs, slices, table
from plyscope.session import land

#: Vectors the lists are fitted on, and queries that the ratio is measured with.
SAMPLE, MEASURED = 65536, 128
#: A vector is in every list up to this many times as far as its nearest, but in `REPLICAS` at most.
BOUNDARY, REPLICAS = 1.03, 3
DEGREE, ENTRIES, REACH = 24, 32, 1.05
BLOCK = 8192
ROWS = 512
HELD = 1 << 20
FOUND = np.dtype([("id", np.int64), ("score", np.float64)])


def split(x: np.ndarray, lists: int) -> np.ndarray:
    """The list of every row: halves are cut across the line between two means, again and again."""
    out, stack, last = np.zeros(len(x), dtype=np.int64), [(np.arange(len(x)), lists)], 0
    while stack:
        rows, n = stack.pop()
        if n == 1:
            out[rows], last = last, last + 1
            continue
        own = x[rows]
        a = own[((own - own[0]) ** 2).sum(axis=1).argmax()]
        b = own[((own - a) ** 2).sum(axis=1).argmax()]
        for _ in range(4):
            nearer = own @ (a - b) > (a @ a - b @ b) / 2
            if nearer.all() or not nearer.any():
                break
            a, b = own[nearer].mean(axis=0), own[~nearer].mean(axis=0)
        order = np.argsort(own @ (b - a), kind="stable")
        cut = len(rows) * (n // 2) // n
        stack += [(rows[order[cut:]], n - n // 2), (rows[order[:cut]], n // 2)]
    return out


@dataclass
class Lists:
    """Centroids, the graph over them, and how wide a query looks."""

    centroids: np.ndarray
    length: float
    ratio: float = 1.0
    sizes: np.ndarray | None = None
    graph: np.ndarray = field(init=False)
    entries: np.ndarray = field(init=False)

    def __post_init__(self):
        k = len(self.centroids)
        self.norms = (self.centroids**2).sum(axis=1)
        self.entries = np.unique(np.linspace(0, k - 1, min(k, ENTRIES)).astype(np.int64))
        near = min(DEGREE, k - 1)
        self.graph = np.zeros((k, near), dtype=np.int64)
        for at in range(0, k, ROWS):
            d = self.norms - 2 * self.centroids[at : at + ROWS] @ self.centroids.T
            d[np.arange(len(d)), np.arange(at, at + len(d))] = -np.inf
            self.graph[at : at + ROWS] = np.argsort(d, axis=1, kind="stable")[:, 1 : 1 + near]

    def lifted(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """Rows brought to one length by one more component; a query by a factor instead."""
        if query:
            norm = np.linalg.norm(x, axis=1, keepdims=True)
            return np.c_[x * (self.length / np.where(norm, norm, 1)), np.zeros(len(x))]
        return np.c_[x, np.sqrt(np.maximum(self.length**2 - (x * x).sum(axis=1), 0))]

    def look(self, x: np.ndarray, ratio: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, list, distance) of the lists within `ratio` times the nearest one's distance,
        nearest first, found by walking the graph from fixed entries."""
        k, own = len(self.centroids), (x * x).sum(axis=1)
        floor = 1e-9 * self.length

        def far(row: np.ndarray, node: np.ndarray) -> np.ndarray:
            d = np.empty(len(row))
            for at in range(0, len(row), 1 << 15):
                r, c = row[at : at + (1 << 15)], node[at : at + (1 << 15)]
                d[at : at + (1 << 15)] = own[r] + self.norms[c] - 2 * np.einsum("ij,ij->i", x[r], self.centroids[c])
            return np.sqrt(np.maximum(d, 0)) + floor

        row, node = np.repeat(np.arange(len(x)), len(self.entries)), np.tile(self.entries, len(x))
        seen = np.zeros((len(x), k), dtype=bool)
        seen[row, node] = True
        d = far(row, node)
        best = d.reshape(len(x), -1).min(axis=1)
        found = [(row, node, d)]
        while len(row):
            opened = d <= best[row] * max(ratio, REACH)
            key = np.unique((row[opened, None] * k + self.graph[node[opened]]).ravel())
            key = key[~seen.ravel()[key]]
            row, node = key // k, key % k
            seen[row, node] = True
            d = far(row, node)
            np.minimum.at(best, row, d)
            found.append((row, node, d))
        row, node, d = (np.concatenate(c) for c in zip(*found, strict=True))
        kept = d <= best[row] * ratio
        order = np.lexsort((node[kept], d[kept], row[kept]))
        return row[kept][order], node[kept][order], d[kept][order]

    def homes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of the lists that hold each row, its own first."""
        row, node, _ = self.look(x, BOUNDARY)
        kept = np.arange(len(row)) - np.searchsorted(row, row) < REPLICAS
        return row[kept], node[kept]

    def asked(self, x: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) that each query visits: by the ratio, and wider where these lists do not
        hold `least` vectors of their own."""
        rows, nodes, left, ratio = [], [], np.arange(len(x)), self.ratio
        while len(left):
            row, node, _ = self.look(x[left], ratio)
            held = np.bincount(row, weights=self.sizes[node], minlength=len(left))
            enough = (held >= min(least, self.sizes.sum())) | (ratio > 1e12)
            rows.append(left[row[enough[row]]])
            nodes.append(node[enough[row]])
            left, ratio = left[~enough], ratio * 1.5
        return np.concatenate(rows), np.concatenate(nodes)


def fit(x: np.ndarray, n: int, length: float) -> Lists:
    """Lists for `n` rows from a sample: about 2 sqrt(n), of 16 rows of the sample at least."""
    k = max(1, min(round(2 * math.sqrt(n)), len(x) // 16))
    lists = Lists(np.zeros((1, x.shape[1] + 1)), length)
    own = lists.lifted(x)
    at = split(own, k)
    sums = np.zeros((k, own.shape[1]))
    np.add.at(sums, at, own)
    return Lists(sums / np.bincount(at, minlength=k)[:, None], length)


def merged(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each query, best first, ties to the smaller id; an id counts once, at its best."""
    order = np.lexsort((-scores, ids, query))
    query, ids, scores = query[order], ids[order], scores[order]
    fresh = np.r_[True, (query[1:] != query[:-1]) | (ids[1:] != ids[:-1])][: len(query)]
    query, ids, scores = query[fresh], ids[fresh], scores[fresh]
    order = np.lexsort((ids, -scores, query))
    query, ids, scores = query[order], ids[order], scores[order]
    kept = np.arange(len(query)) - np.searchsorted(query, query) < k
    return query[kept], ids[kept], scores[kept]


def packed(query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> pa.RecordBatch:
    """One row per query, its answers as bytes."""
    found = np.empty(len(ids), dtype=FOUND)
    found["id"], found["score"] = ids, scores
    starts = np.flatnonzero(np.r_[True, query[1:] != query[:-1]][: len(query)])
    ends = np.r_[starts[1:], len(query)]
    return pa.RecordBatch.from_pydict(
        {"nid": query[starts], "found": pa.array([found[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary())}
    )


def answers(batches: Iterator[pa.RecordBatch], kind: str, k: int) -> Iterator[pa.RecordBatch]:
    """Every cell holds rows of one list and queries that visit it; a task keeps the k best of each query."""
    held: list[tuple[np.ndarray, ...]] = []
    best = (np.zeros(0, np.int64), np.zeros(0))  # queries and their k-th score so far
    for _, t in runs(batches, ["list", "pb", "qb"]):
        asks = t["role"] == 1
        if asks.all() or not asks.any():
            continue
        rows, queries = (np.frombuffer(b"".join(t["v"][m]), dtype=kind).reshape(int(m.sum()), -1).astype(np.float64) for m in (~asks, asks))
        ids, names = t["ids"][~asks], t["nid"][asks]
        many = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 8
        ids, first = np.frombuffer(b"".join(ids), dtype=np.int64), np.cumsum(many) - many
        widest = np.linalg.norm(rows, axis=1).max()
        for at in range(0, len(queries), ROWS):
            own, name = queries[at : at + ROWS], names[at : at + ROWS]
            edge = known(best, name)
            with np.errstate(over="ignore", invalid="ignore"):
                s = own @ rows.T
                new = np.flatnonzero(np.isneginf(edge))
                if len(rows) > k and len(new):
                    edge[new] = np.partition(s[new], len(rows) - k, axis=1)[:, len(rows) - k]
                # Products differ in their last bits by how they are summed; what is that near the k-th is looked at.
                slack = 1e-9 * np.linalg.norm(own, axis=1) * widest
                q, r = np.nonzero(~(s < (edge - slack)[:, None]))
                score = (own[q] * rows[r]).sum(axis=1)
            each = many[r]
            spread = np.repeat(first[r] - np.cumsum(each) + each, each) + np.arange(each.sum())
            held.append((np.repeat(name[q], each), ids[spread], np.repeat(score, each)))
            if sum(len(h[0]) for h in held[1:]) > max(HELD // 8, len(held[0][0])):
                held = [merged(*map(np.concatenate, zip(*held, strict=True)), k)]
                if len(held[0][0]) > HELD:
                    yield packed(*held.pop())
                    best = (best[0][:0], best[1][:0])
                else:
                    best = last_scores(held[0][0], held[0][2], k)
    if held:
        yield packed(*merged(*map(np.concatenate, zip(*held, strict=True)), k))


def last_scores(query: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of merged answers: the queries that have k, and their k-th score."""
    names, counts = np.unique(query, return_counts=True)
    full = counts == k
    return names[full], scores[np.cumsum(counts)[full] - 1]


def known(best: tuple[np.ndarray, np.ndarray], names: np.ndarray) -> np.ndarray:
    """The score each query has to reach, minus infinity where it has no k answers yet."""
    out = np.full(len(names), -np.inf)
    if len(best[0]):
        at = np.minimum(np.searchsorted(best[0], names), len(best[0]) - 1)
        there = best[0][at] == names
        out[there] = best[1][at[there]]
    return out


def nearest(
    rows: DataFrame, queries: str, vec_id: str = "vec_id", vector: str = "embedding", k: int = 20, recall: float = 0.96, sample: int = SAMPLE, block: int = BLOCK
) -> DataFrame:
    """query_id, rank, vec_id, score: for every row that meets `queries` (an SQL condition on
    `vec_id`) its `k` nearest of all other rows by inner product, nearest first.

    Scores are inner products of the vectors as given, in double precision; ties go to the
    smaller vec_id. The search is approximate: the ratio by which lists are chosen is the one
    at which `MEASURED` queries, held against all rows, reach `recall`. Lists are fitted on
    about `sample` vectors chosen by hash; all are indexed. A list of more than `block` rows,
    or with more queries, is dealt in blocks that meet pairwise.

    Null and zero vectors, those with a null or non-finite component, and rows without an id
    take no part. A shorter vector counts as extended by zeros. Equal vectors are indexed once,
    with their k + 1 smallest ids: no more can be among the answers. Repeated rows count once;
    of one id with several vectors the nearest counts, and as a query each is answered. Other
    columns are not looked at. An empty table gives no rows.
    """
    spark = rows.sparkSession
    element = rows.schema[vector].dataType.elementType.simpleString()
    kind = "<f4" if element == "float" else "<f8"
    rows = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast(f"array<{'float' if kind == '<f4' else 'double'}>").alias("v"))
    rows = rows.where("vec_id IS NOT NULL AND size(v) > 0 AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity')) AND exists(v, x -> x <> 0)")
    dims = rows.agg(F.max(F.size("v"))).first()[0] or 1
    rows = rows.withColumn("v", F.expr(f"CASE WHEN size(v) < {dims} THEN concat(v, array_repeat(CAST(0 AS {'float' if kind == '<f4' else 'double'}), {dims} - size(v))) ELSE v END"))

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch["v"].flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, dims) + np.zeros(1, kind)  # no -0
            raw = [r.tobytes() for r in x]
            top = np.abs(x.astype(np.float64)).max(axis=1, initial=0)
            norm = top * np.linalg.norm(x / np.where(top, top, 1)[:, None], axis=1)
            same = [blake2b(r, digest_size=16).digest() for r in raw]
            yield pa.RecordBatch.from_pydict({"vec_id": batch["vec_id"], "same": same, "v": raw, "norm": norm})

    ready = rows.mapInArrow(prepare, "vec_id long, same binary, v binary, norm double")
    ids = land(ready.select("same", "vec_id").distinct(), "ids")
    few = ids.selectExpr("*", "row_number() OVER (PARTITION BY same ORDER BY vec_id) AS r").where(f"r <= {k + 1}")
    few = few.groupBy("same").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    nodes = ready.groupBy("same").agg(F.first("v").alias("v"), F.first("norm").alias("norm")).join(few, "same")
    nodes = land(nodes.withColumn("nid", F.monotonically_increasing_id()), "nodes")
    n, longest = nodes.agg(F.count("*"), F.max("norm")).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    def matrix(v) -> np.ndarray:
        return np.frombuffer(b"".join(v), dtype=kind).reshape(-1, dims).astype(np.float64) / longest

    def drawn(share: float, salt: int) -> DataFrame:
        return nodes.where(F.expr(f"pmod(xxhash64(same, {salt}), {1 << 30})") < F.lit((1 << 30) * min(1.0, share))).select("nid", "v")

    lists = fit(matrix([r.v for r in sorted(drawn(sample / n, 0).collect())]), n, 1.0)
    shared = spark.sparkContext.broadcast(lists)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, ROWS):
                row, node = shared.value.homes(shared.value.lifted(matrix(part["v"].to_pylist())))
                starts = np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)
                own = [np.array(x, dtype=np.int64).tobytes() for x in part["ids"].to_pylist()]
                at = pa.ListArray.from_arrays(starts, node)
                yield pa.RecordBatch.from_pydict({"nid": part["nid"], "v": part["v"], "ids": own, "lists": at})

    placed = land(nodes.select("nid", "v", "ids").mapInArrow(place, "nid long, v binary, ids binary, lists array<long>"), "placed")
    homes = placed.groupBy(F.expr("lists[0]").alias("list")).agg(F.count("*").alias("k")).collect()
    lists.sizes = np.zeros(len(lists.centroids))
    for r in homes:
        lists.sizes[r.list] = r.k
    lists.ratio = _measured_ratio(placed, matrix, lists, drawn(MEASURED / n, 1).collect(), k, recall)
    wide = spark.sparkContext.broadcast(lists)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, ROWS):
                row, node = wide.value.asked(wide.value.lifted(matrix(part["v"].to_pylist()), query=True), k + 1)
                order = np.argsort(row, kind="stable")
                starts = np.searchsorted(row[order], np.arange(part.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_pydict({"nid": part["nid"], "v": part["v"], "lists": pa.ListArray.from_arrays(starts, node[order])})

    wanted = land(ids.where(queries).join(nodes.select("same", "nid"), "same").select("vec_id", "nid"), "wanted")
    searched = placed.select("nid", "v").join(wanted.select("nid").distinct(), "nid", "left_semi")
    asked = land(searched.mapInArrow(ask, "nid long, v binary, lists array<long>"), "asked")

    blocks = _blocks(placed, "pbs", block).join(_blocks(asked, "qbs", block), "list")
    blocks = F.broadcast(land(blocks, "blocks"))  # a row per list
    held = placed.select("nid", "v", "ids", F.explode("lists").alias("list")).join(blocks, "list").selectExpr(
        "list", "pmod(xxhash64(nid), pbs) AS pb", "explode(sequence(0L, qbs - 1)) AS qb", "0 AS role", "nid", "v", "ids"
    )
    asks = asked.select("nid", "v", F.explode("lists").alias("list")).join(blocks, "list").selectExpr(
        "list", "explode(sequence(0L, pbs - 1)) AS pb", "pmod(xxhash64(nid), qbs) AS qb", "1 AS role", "nid", "v", "CAST('' AS binary) AS ids"
    )
    cells = held.unionByName(asks).repartition("list", "pb", "qb").sortWithinPartitions("list", "pb", "qb")
    some = cells.mapInArrow(lambda batches: answers(batches, kind, k + 1), "nid long, found binary")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (nid,), t in runs(batches, ["nid"]):
            found = np.frombuffer(b"".join(t["found"]), dtype=FOUND)
            _, best, scores = merged(np.zeros(len(found), np.int64), found["id"], found["score"], k + 1)
            yield pa.RecordBatch.from_pydict({"nid": [nid], "best": [best], "scores": [scores]})

    best = some.repartition("nid").sortWithinPartitions("nid").mapInArrow(merge, "nid long, best array<long>, scores array<double>")
    out = wanted.join(land(best, "best"), "nid").selectExpr(
        "vec_id AS query_id", f"posexplode(slice(filter(arrays_zip(best, scores), x -> x.best <> vec_id), 1, {k})) AS (at, x)"
    )
    return out.selectExpr("query_id", "at + 1 AS rank", "x.best AS vec_id", "x.scores AS score")


def _blocks(rows: DataFrame, name: str, block: int) -> DataFrame:
    """In how many blocks the rows of each list are dealt."""
    return rows.select(F.explode("lists").alias("list")).groupBy("list").agg(F.expr(f"CAST(ceil(count(*) / {block}) AS bigint)").alias(name))


def _measured_ratio(placed: DataFrame, matrix, lists: Lists, some: list, k: int, recall: float) -> float:
    """The ratio that takes in `recall` of the true neighbours of the queries in `some`.

    Every task holds its rows against these queries and names, for the nearest k of each, the
    ratio at which the query would visit one of their lists.
    """
    if not some or len(lists.centroids) == 1:
        return 1.0
    names, x = np.array([r.nid for r in some]), matrix([r.v for r in some])
    own = lists.lifted(x, query=True)
    far = np.sqrt(np.maximum((own * own).sum(axis=1)[:, None] + lists.norms - 2 * own @ lists.centroids.T, 0)) + 1e-9
    shared = placed.sparkSession.sparkContext.broadcast((names, x, far / far.min(axis=1, keepdims=True)))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, x, ratios = shared.value
        held = []
        for batch in batches:
            if not batch.num_rows:
                continue
            nid, at = batch["nid"].to_numpy(), batch["lists"]
            s = x @ matrix(batch["v"].to_pylist()).T
            s[names[:, None] == nid] = -np.inf
            top = np.argsort(-s, axis=1)[:, :k]
            q = np.repeat(np.arange(len(names)), top.shape[1])
            starts, flat = at.offsets.to_numpy(), at.values.to_numpy()
            need = [ratios[i, flat[starts[r] : starts[r + 1]]].min() for i, r in zip(q, top.ravel(), strict=True)]
            held.append((q, s[q, top.ravel()], np.array(need)))
        if held:
            q, s, need = map(np.concatenate, zip(*held, strict=True))
            order = np.lexsort((-s, q))
            kept = order[(np.arange(len(q)) - np.searchsorted(q[order], q[order]) < k) & np.isfinite(s[order])]
            yield pa.RecordBatch.from_pydict({"q": q[kept], "s": s[kept], "need": need[kept]})

    near = placed.select("nid", "v", "lists").mapInArrow(measure, "q long, s double, need double")
    near = near.selectExpr("*", "row_number() OVER (PARTITION BY q ORDER BY s DESC) AS r").where(f"r <= {k}").collect()
    return float(np.quantile([r.need for r in near], recall, method="higher")) if near else 1.0


def op11_balanced_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")
