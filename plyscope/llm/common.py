"""Small helpers shared by the operators: hash folds, table access, byte views, components."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plyscope.session import land

U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(doc_id: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; a null id counts as the empty text."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus


def set_aside(rows: DataFrame, names: Iterable[str]) -> tuple[DataFrame, dict[str, str]]:
    """The rows with columns called as one of `names`, in any case, under names of their own, and
    how to call them again (`withColumnsRenamed`): a user's columns are never touched."""
    taken = {n.lower() for n in names}
    aside = {c: f"{c}_{uuid.uuid4().hex}" for c in rows.columns if c.lower() in taken}
    return rows.withColumnsRenamed(aside), {new: c for c, new in aside.items()}


def byte_texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; null texts are empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def slices(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of `edges`; component is the smallest node reachable.

    Each round points every node at its smallest neighbour, follows the pointers twice and
    contracts the edges, so the graph at least halves. Rounds hand over by written tables,
    and minima fold before the shuffle, so a node with very many edges is one row per task.
    """
    edges = land(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct(), "edges")
    layers = []
    while not edges.isEmpty():
        both = edges.union(edges.selectExpr("b", "a"))
        up = both.groupBy("a").agg(F.min("b").alias("m")).selectExpr("a AS v", "least(a, m) AS p")
        for _ in range(2):
            over = up.selectExpr("v AS p", "p AS q")
            up = up.join(over, "p", "left").selectExpr("v", "coalesce(q, p) AS p")
        up = land(up, "pointers")
        layers.append(up)
        edges = edges.join(up.selectExpr("v AS a", "p AS pa"), "a").join(up.selectExpr("v AS b", "p AS pb"), "b")
        edges = land(edges.where("pa <> pb").selectExpr("least(pa, pb) AS a", "greatest(pa, pb) AS b").distinct(), "edges")
    if not layers:
        return edges.selectExpr("a AS node", "b AS component")
    labels = layers[0]
    for up in layers[1:]:
        labels = labels.join(up.selectExpr("v AS p", "p AS q"), "p", "left").selectExpr("v", "coalesce(q, p) AS p")
    return land(labels.selectExpr("v AS node", "p AS component"), "components")


def deal_blocks(rows: DataFrame, keys: list[str], block: int, columns: list[str]) -> DataFrame:
    """Rows of groups of two or more, dealt so that every two of a group meet in some run.

    A group of up to `block` rows is one run of sorted rows. A larger one is cut into blocks
    by hash of `nid`, and each pair of blocks (`lo`, `hi`) is a run; `block` says whose row is.
    """
    size = rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    size = size.select(*keys, F.expr(f"ceil(n / {block})").alias("blocks"))
    own = rows.join(size, keys).withColumn("block", F.expr("pmod(xxhash64(nid), blocks)"))
    own = own.withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
    own = own.withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})
    by = [*keys, "lo", "hi"]
    return own.select(*by, "block", "nid", *columns).repartition(*by).sortWithinPartitions(*by)


def _as_array(column: pa.Array) -> np.ndarray:
    """Numbers as they are, lists of one length as a matrix, bytes as objects."""
    if pa.types.is_list(column.type):
        return np.asarray(column.flatten()).reshape(len(column), -1)
    if pa.types.is_binary(column.type):
        out = np.empty(len(column), dtype=object)
        out[:] = column.to_pylist()
        return out
    return column.to_numpy(zero_copy_only=False)


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, dict[str, np.ndarray]]]:
    """The runs of equal keys of sorted input, as arrays by column; one run is held at a time."""
    held: list[dict[str, np.ndarray]] = []
    current: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = {name: _as_array(batch.column(i)) for i, name in enumerate(batch.schema.names)}
        change = np.zeros(batch.num_rows - 1, dtype=bool)
        for k in keys:
            change |= cols[k][1:] != cols[k][:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(cols[k][a].item() for k in keys)
            if held and key != current:
                yield current, _joined(held)
                held = []
            current = key
            held.append({name: c[a:b] for name, c in cols.items()})
    if held:
        yield current, _joined(held)


def _joined(parts: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    return parts[0] if len(parts) == 1 else {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}


def groups_of(near: np.ndarray) -> np.ndarray:
    """For each row of a symmetric boolean matrix, the first row of its connected group."""
    label = np.full(len(near), -1)
    for i in range(len(near)):
        if label[i] >= 0:
            continue
        label[i], front = i, np.array([i])
        while len(front):
            front = np.flatnonzero(near[front].any(axis=0) & (label < 0))
            label[front] = i
    return label


def close_groups(codes: np.ndarray, differing: int) -> np.ndarray:
    """For each code (a row of 64-bit words) the first row of its group of close codes.

    Rows close to the first are settled by one look at it; only the rest are held against all.
    """
    codes = codes.view(np.uint64)  # of signed numbers numpy counts the bits of the absolute value
    far = lambda i: np.bitwise_count(codes ^ codes[i]).sum(axis=1) > differing
    rest = np.flatnonzero(far(0))
    if not len(rest):
        return np.zeros(len(codes), dtype=np.int64)
    place = np.zeros(len(codes), dtype=np.int64)
    place[rest] = np.arange(1, len(rest) + 1)
    near = np.zeros((len(rest) + 1, len(rest) + 1), dtype=bool)
    for k, i in enumerate(rest, 1):
        near[k, place[~far(i)]] = True
    return np.r_[0, rest][groups_of(near | near.T)][place]


def meet(batches: Iterator[pa.RecordBatch], keys: list[str], differing: int) -> Iterator[pa.RecordBatch]:
    """(a, b) edges, fewer than rows, that join the close codes of every run."""
    for _, t in runs(batches, [*keys, "lo", "hi"]):
        nid = t["nid"]
        hub = nid[close_groups(t["code"], differing)]
        apart = hub != nid
        if apart.any():
            yield pa.RecordBatch.from_pydict({"a": np.minimum(hub, nid)[apart], "b": np.maximum(hub, nid)[apart]})
