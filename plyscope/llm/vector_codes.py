"""Compressed vector codes: product codebooks fitted by Lloyd rounds over cover trees.

Vectors become integers and are cut into equal parts, each with a codebook of its own. Every
task builds a cover tree for each block of its vectors and part of the vector; points are laid
out so that a subtree is a range, and cumulative sums give the total of any range. In a round
a whole subtree goes to one entry when the triangle inequality rules all others out; only the
other nodes descend, and the points of ambiguous leaves are compared one by one. What leaves a
task is a count and sums by entry, so a round shuffles no vectors.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyscope.llm.common import slices, table
from plyscope.operators.report import bounded_broadcast
from plyscope.session import land

BLOCK = 4096
LEAF = 32
#: Distances in floating point are taken as this much uncertain, relatively.
SLACK = 1e-9


def whole_parts(v: np.ndarray, scale: int, parts: int) -> np.ndarray:
    """floor(scale * x) of every component, as (parts, rows, width) integers.

    Components are held within a bound at which the squared error of a row still fits 64
    bits (134 million for vectors of up to 64 components, far beyond what vectors hold).
    """
    bound = 2.0 ** math.floor(math.log2(2.0**62 / max(v.shape[1], 1)) / 2 - 1)
    with np.errstate(over="ignore"):
        whole = np.clip(np.floor(v * scale), -bound, bound).astype(np.int64)
    return np.ascontiguousarray(whole.reshape(len(v), parts, v.shape[1] // parts).swapaxes(0, 1))


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of every row of `a` to every row of `b`."""
    out = np.zeros((len(a), len(b)), dtype=np.int64)
    for i in range(a.shape[1]):
        step = a[:, i, None] - b[None, :, i]
        out += step * step
    return out


def _far(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    apart = points - centre
    return np.einsum("ij,ij->i", apart, apart)


def cover_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the points, nodes (start, end, first child, children) and their radii.

    A node's centre is the first point of its range and its radius the distance of the
    farthest. Its children's centres are more than half that radius apart and, the first
    being its own centre, together cover all its points within half the radius.
    """
    order, points = np.arange(len(points)), points.astype(np.float64)
    nodes, radii = [[0, len(points), 0, 0]], [0.0]
    at = 0
    while at < len(nodes):
        start, end = nodes[at][:2]
        rows = order[start:end]
        own = points[rows]
        far = _far(own, own[0])
        widest = far.max()
        radii[at] = math.sqrt(widest)
        if end - start > LEAF and widest:
            cover = widest / 4
            child = np.zeros(end - start, dtype=np.int64)
            children, left = 1, np.flatnonzero(far > cover)
            rest = own[left]
            while len(left):
                beyond = _far(rest, rest[0]) > cover
                child[left] = children
                children, left, rest = children + 1, left[beyond], rest[beyond]
            order[start:end] = rows[np.argsort(child, kind="stable")]  # a centre has the least place of its child
            ends = start + np.cumsum(np.bincount(child))
            nodes[at][2:] = [len(nodes), children]
            for a, b in zip([start, *ends[:-1].tolist()], ends.tolist(), strict=True):
                nodes.append([a, b, 0, 0])
                radii.append(0.0)
        at += 1
    return order, np.array(nodes, dtype=np.int64), np.array(radii)


class Cover:
    """A cover tree over the points of one block and part, with cumulative sums."""

    def __init__(self, points: np.ndarray, nodes: np.ndarray, radii: np.ndarray):
        """`points` lie in the order of the tree."""
        self.points, self.nodes, self.radii = points, nodes, radii
        self.sums = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(points, axis=0)])

    def assign(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Settled nodes with their entries, and single points (by place) with theirs.

        Of equal entries only the first can be nearest, so the others are left out.
        """
        entries = np.sort(np.unique(book, axis=0, return_index=True)[1])
        own = book[entries]
        settled, singles = [], []
        front = np.zeros(1, dtype=np.int64)
        while len(front):
            start, end, child, children = self.nodes[front].T
            d = np.sqrt(squares(self.points[start], own))
            near = d.argmin(axis=1)
            reach = (d[np.arange(len(d)), near] + 2 * self.radii[front]) * (1 + SLACK) + SLACK
            alone = (d <= reach[:, None]).sum(axis=1) == 1
            settled.append((front[alone], entries[near[alone]]))
            leaves = ~alone & (children == 0)
            if leaves.any():
                places = ranges(start[leaves], end[leaves])
                singles.append((places, entries[squares(self.points[places], own).argmin(axis=1)]))
            deeper = ~alone & (children > 0)
            front = ranges(child[deeper], child[deeper] + children[deeper])
        none = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        joined = [[np.concatenate(x) for x in zip(none, *found, strict=True)] for found in (settled, singles)]
        return *joined[0], *joined[1]

    def totals(self, book: np.ndarray) -> np.ndarray:
        """Count and componentwise sums of the points nearest to each entry."""
        nodes, by_node, places, by_place = self.assign(book)
        out = np.zeros((len(book), 1 + book.shape[1]), dtype=np.int64)
        start, end = self.nodes[nodes, 0], self.nodes[nodes, 1]
        np.add.at(out[:, 0], by_node, end - start)
        np.add.at(out[:, 1:], by_node, self.sums[end] - self.sums[start])
        np.add.at(out[:, 0], by_place, 1)
        np.add.at(out[:, 1:], by_place, self.points[places])
        return out

    def codes(self, book: np.ndarray) -> np.ndarray:
        """The nearest entry of every point, in the order of the tree."""
        nodes, by_node, places, by_place = self.assign(book)
        start, end = self.nodes[nodes, 0], self.nodes[nodes, 1]
        out = np.empty(len(self.points), dtype=np.int64)
        out[ranges(start, end)] = np.repeat(by_node, end - start)
        out[places] = by_place
        return out


def ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one after the other."""
    sizes = ends - starts
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def plant(batches: Iterator[pa.RecordBatch], scale: int, parts: int) -> Iterator[pa.RecordBatch]:
    """One row per block: its ids and labels, and for each part the tree over its points."""
    for batch in batches:
        for block in slices(batch, BLOCK):
            n = block.num_rows
            cut = whole_parts(block["v"].flatten().to_numpy(zero_copy_only=False).reshape(n, -1), scale, parts)
            trees = [cover_tree(points) for points in cut]
            one = lambda column: pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), column)  # noqa: E731, B023
            packed = {
                "points": np.stack([p[t[0]] for p, t in zip(cut, trees, strict=True)]).astype(np.int32),
                "places": np.stack([t[0] for t in trees]).astype(np.int32),
                "nodes": np.concatenate([np.c_[np.full(len(t[1]), i), t[1]] for i, t in enumerate(trees)]).astype(np.int32),
                "radii": np.concatenate([t[2] for t in trees]),
            }
            yield pa.RecordBatch.from_pydict(
                {"vec_id": one(block["vec_id"]), "label": one(block["label"]), **{k: pa.array([x.tobytes()], pa.binary()) for k, x in packed.items()}}
            )


def grown(batches: Iterator[pa.RecordBatch], parts: int, width: int) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray, list[Cover]]]:
    """Per block: its row's batch and number in it, the rows' places by part, and the trees."""
    for batch in batches:
        for i in range(batch.num_rows):
            raw = {k: batch[k][i].as_buffer() for k in ("points", "places", "nodes", "radii")}
            places = np.frombuffer(raw["places"], np.int32).reshape(parts, -1)
            points = np.frombuffer(raw["points"], np.int32).reshape(parts, places.shape[1], width).astype(np.int64)
            nodes, radii = np.frombuffer(raw["nodes"], np.int32).reshape(-1, 5).astype(np.int64), np.frombuffer(raw["radii"])
            yield batch, i, places, [Cover(points[p], nodes[nodes[:, 0] == p, 1:], radii[nodes[:, 0] == p]) for p in range(parts)]


def compress(
    rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    scale: int = 256, parts: int = 16, entries: int = 64, rounds: int = 2,
) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 for every row with a usable vector.

    Components become floor(scale * x); vectors are cut into `parts` equal parts, each with a
    codebook of at most `entries` entries that starts as that part of the vectors of smallest
    ids. In each round every part goes to the nearest entry (squares in whole numbers, ties to
    the lower index) and each entry becomes the floored mean of its parts; an entry without
    parts stays. `code` has two hex digits per part; `error` is the sum of squared distances to
    the final entries, and `label_error` its sum over rows of one label, null being one.

    Null vectors and those with a null or non-finite component are dropped. A vector shorter
    than the longest, or a length that `parts` does not divide, counts as extended by zeros.
    Repeated rows are rows of their own, but an id starts one entry only, by its least vector;
    null ids come last. Other columns are not looked at. An empty table gives no rows.

    The driver holds the codebooks alone: parts * entries * width numbers, whatever the rows.
    """
    kind = rows.schema[label].dataType.simpleString()
    rows = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.where("v IS NOT NULL AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))")
    longest = rows.agg(F.max(F.size("v"))).first()[0]
    width = -(-(longest or 0) // parts) or 1
    rows = rows.withColumn("v", F.expr(f"CASE WHEN size(v) < {parts * width} THEN concat(v, array_repeat(0D, {parts * width} - size(v))) ELSE v END"))

    ids = [r[0] for r in rows.select("vec_id").distinct().orderBy(F.col("vec_id").asc_nulls_last()).limit(entries).collect()]
    known = [i for i in ids if i is not None]
    among = F.col("vec_id").isin(known) | (F.col("vec_id").isNull() if None in ids else F.lit(False))
    seeds = rows.where(among).groupBy("vec_id").agg(F.min("v").alias("v")).collect()
    seeds.sort(key=lambda r: (r.vec_id is None, r.vec_id or 0))
    books = whole_parts(np.array([r.v for r in seeds], dtype=np.float64).reshape(-1, parts * width), scale, parts)

    forest = land(
        rows.mapInArrow(
            lambda batches: plant(batches, scale, parts),
            f"vec_id array<long>, label array<{kind}>, points binary, places binary, nodes binary, radii binary",
        ),
        "forest",
    )
    spark = rows.sparkSession
    for _ in range(rounds):
        books = _moved(forest, books, spark.sparkContext.broadcast(books))
    final = spark.sparkContext.broadcast(books)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, i, places, trees in grown(batches, parts, width):
            codes, error = np.empty(places.shape, dtype=np.uint8), np.zeros(places.shape[1], dtype=np.int64)
            for p, tree in enumerate(trees):
                found = tree.codes(final.value[p])
                codes[p, places[p]] = found
                error[places[p]] += ((tree.points - final.value[p][found]) ** 2).sum(axis=1)
            text = codes.T.tobytes().hex()
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": batch["vec_id"][i].values,
                    "label": batch["label"][i].values,
                    "code": [text[k : k + 2 * parts] for k in range(0, len(text), 2 * parts)],
                    "error": error,
                }
            )

    coded = land(forest.mapInArrow(encode, f"vec_id long, label {kind}, code string, error long"), "codes")
    by_label = land(coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error")), "label-errors")
    by_label, _ = bounded_broadcast(by_label.withColumnRenamed("label", "_l"))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    out = coded.join(by_label, F.col("label").eqNullSafe(F.col("_l")), "left")
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _moved(forest: DataFrame, books: np.ndarray, shared) -> np.ndarray:
    """The codebooks after one round; a row per entry comes back from each task, and one to the driver."""
    parts, n, width = books.shape
    if not n:
        return books

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, n, 1 + width), dtype=np.int64)
        for *_, trees in grown(batches, parts, width):
            for p, tree in enumerate(trees):
                total[p] += tree.totals(shared.value[p])
        if total.any():
            part, entry = np.nonzero(total[:, :, 0])
            flat = total[part, entry]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (part, entry, *flat.T)], names=names)

    names = ["part", "entry", "n", *[f"s{i}" for i in range(width)]]
    folded = forest.mapInArrow(fold, ", ".join(f"{c} long" for c in names))
    sums = folded.groupBy("part", "entry").agg(*[F.sum(c).alias(c) for c in names[2:]]).collect()
    moved = books.copy()
    for r in sums:
        moved[r.part, r.entry] = [r[f"s{i}"] // r.n for i in range(width)]
    return moved


def op13_cover_tree_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(table(spark, sf_dir, "embeddings"))


def _sql(rounds: int = 2) -> str:
    """The same by plain comparison with every entry."""
    assigned = """
a{i} AS (
  SELECT x.vec_id, x.part, x.p, min(struct_pack(d := list_sum(list_transform(list_zip(x.p, c.p), lambda t: (t[1] - t[2]) * (t[1] - t[2]))), e := c.entry)) AS m
  FROM x JOIN c{i} c ON c.part = x.part GROUP BY x.vec_id, x.part, x.p)"""
    moved = """
n{i} AS (
  SELECT part, m.e AS entry, [CAST(floor(sum(p[1]) / count(*)) AS BIGINT), CAST(floor(sum(p[2]) / count(*)) AS BIGINT),
    CAST(floor(sum(p[3]) / count(*)) AS BIGINT), CAST(floor(sum(p[4]) / count(*)) AS BIGINT)] AS p FROM a{i} GROUP BY part, m.e),
c{j} AS (SELECT c.part, c.entry, coalesce(n.p, c.p) AS p FROM c{i} c LEFT JOIN n{i} n ON n.part = c.part AND n.entry = c.entry)"""
    steps = [assigned.format(i=i) + "," + moved.format(i=i, j=i + 1) for i in range(rounds)]
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS (SELECT vec_id, label, k AS part, v[4 * k + 1 : 4 * k + 4] AS p FROM kept, (SELECT unnest(range(16)) AS k)),
c0 AS (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, p FROM x
  WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 64)),
{",".join(steps)},{assigned.format(i=rounds)},
coded AS (
  SELECT vec_id, string_agg(printf('%02x', m.e), '' ORDER BY part) AS code, CAST(sum(m.d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id),
books AS (
  SELECT sha256(string_agg(array_to_string(p, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c{rounds})
SELECT c.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, b.codebooks_sha256
FROM coded c JOIN kept k ON k.vec_id = c.vec_id CROSS JOIN books b
"""


OP13_SQL = _sql()
