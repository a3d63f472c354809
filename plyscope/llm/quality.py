"""Quality by a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum (v_if x_i)^2)): all
pairwise interactions, in time linear in the features of a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyscope.llm.common import byte_texts, fold, mixed, table

WORD_BITS = 16
BINS = 24
#: Byte classes: 0 rest, 1 lower, 2 upper, 3 digit, 4 blank, 5 line end, 6 sentence marks, 7 symbols, 8 not ASCII.
CLASSES = np.zeros(256, dtype=np.uint8)
for _k, _chars in enumerate(
    (b"", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\x0b\x0c\r", b"\n", b".,;:?'\"-()", b"!#$%&*+/<=>@[]\\^_`{|}~")
):
    CLASSES[list(_chars)] = _k
CLASSES[128:] = 8
FIELDS = (
    "words", "word length", "upper", "digits", "blanks", "marks", "symbols", "not ASCII", "distinct words",
    "commonest word", "lines", "distinct lines", "characters by metadata",
)
WIDTH = (1 << WORD_BITS) + len(FIELDS) * BINS


def _share(x: float, of: float) -> int:
    """A bin for a share: fine near 0."""
    return min(int(np.sqrt(x / of) * (BINS - 1)), BINS - 1) if of > 0 else 0


def _log(x: float) -> int:
    return min(int(np.log2(1 + max(x, 0))), BINS - 1)


def features(text: bytes, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Feature ids, each once, and their values: the words' squares sum to 1, statistics are one-hot."""
    kinds = np.bincount(CLASSES[np.frombuffer(text, dtype=np.uint8)], minlength=9)
    words = text.lower().split()
    n = len(words)
    ids = mixed(np.fromiter(map(crc32, words), dtype=np.uint64, count=n)) & np.uint64((1 << WORD_BITS) - 1)
    ids, counts = np.unique(ids, return_counts=True)
    lines = text.split(b"\n")
    size = len(text)
    bins = (
        _log(n),
        _log(4 * (size / n)) if n else 0,
        _share(kinds[2], size),
        _share(kinds[3], size),
        _share(kinds[4], size),
        _share(kinds[6], size),
        _share(kinds[7], size),
        _share(kinds[8], size),
        _share(len(ids), n),
        _share(counts.max(initial=0), n),
        _log(len(lines)),
        _share(len(set(lines)), len(lines)),
        0 if n_chars is None else 1 + min(_log(n_chars), BINS - 2),
    )
    fields = (1 << WORD_BITS) + np.arange(len(FIELDS)) * BINS + np.array(bins)
    values = np.concatenate([np.sqrt(counts / max(n, 1)), np.ones(len(FIELDS))])
    return np.concatenate([ids.astype(np.int64), fields]), values.astype(np.float32)


@dataclass
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def margin(self, ids: np.ndarray, x: np.ndarray) -> float:
        v = self.factors[ids] * x[:, None]
        total = v.sum(axis=0)
        return float(self.bias + self.linear[ids] @ x + 0.5 * (total @ total - np.square(v).sum()))

    def score(self, text: bytes, n_chars: int | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.margin(*features(text, n_chars)), -30, 30))))


def fit(
    rows: list[tuple[np.ndarray, np.ndarray, int]],
    rank: int = 8,
    epochs: int = 12,
    batch: int = 128,
    rate: float = 0.03,
    decay: float = 1e-4,
    seed: int = 7,
) -> Machine:
    """Adam on the log loss, in batches. Without rows of both labels the score is their share."""
    y = np.array([r[2] for r in rows], dtype=np.float32)
    share = float(np.clip(y.mean(), 0.01, 0.99)) if len(rows) else 0.5
    rng = np.random.default_rng(seed)
    params = np.zeros((WIDTH, rank + 1), dtype=np.float32)  # column 0 linear, the rest factors
    if len(rows) == 0 or y.min() == y.max():
        return Machine(float(np.log(share / (1 - share))), params[:, 0], params[:, 1:])
    params[:, 1:] = rng.normal(0, 0.05, (WIDTH, rank))
    bias = float(np.log(share / (1 - share)))
    m, v, step = np.zeros_like(params), np.zeros_like(params), 0
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // batch)):
            sizes = np.array([len(rows[i][0]) for i in part])
            ids, x = (np.concatenate([rows[i][k] for i in part]) for k in (0, 1))
            row, starts = np.repeat(np.arange(len(part)), sizes), np.r_[0, np.cumsum(sizes)[:-1]]
            own = params[ids]
            vx = own[:, 1:] * x[:, None]
            total = np.add.reduceat(vx, starts, axis=0)
            f = bias + np.add.reduceat(own[:, 0] * x, starts) + 0.5 * (np.square(total).sum(1) - np.add.reduceat(np.square(vx).sum(1), starts))
            g = (1 / (1 + np.exp(-np.clip(f, -30, 30))) - y[part]) / len(part)
            gx = g[row] * x
            used, back = np.unique(ids, return_inverse=True)
            grad = np.empty((len(used), rank + 1), dtype=np.float32)
            grad[:, 0] = np.bincount(back, gx)
            slopes = gx[:, None] * (total[row] - vx)
            for k in range(rank):
                grad[:, k + 1] = np.bincount(back, slopes[:, k])
            grad += decay * params[used]
            step += 1
            m[used] = 0.9 * m[used] + 0.1 * grad
            v[used] = 0.99 * v[used] + 0.01 * grad * grad
            params[used] -= rate * (m[used] / (1 - 0.9**step)) / (np.sqrt(v[used] / (1 - 0.99**step)) + 1e-6)
            bias -= rate * float(g.sum())
    return Machine(bias, np.ascontiguousarray(params[:, 0]), np.ascontiguousarray(params[:, 1:]))


def train(
    docs: DataFrame, labels: DataFrame, text: str = "text", n_chars: str = "n_chars", doc_id: str = "doc_id",
    label: str = "quality", max_rows: int = 6000,
) -> Machine:
    """Fits on at most `max_rows` labelled documents, those of smallest id hash.

    Null labels and ids teach nothing; an id labelled twice counts by its smallest label and
    repeated documents count once. Only ids and feature vectors of the sample reach the driver.
    """
    marks = labels.select(F.col(doc_id).alias("d"), F.col(label).cast("int").alias("y")).dropna()
    marks = marks.groupBy("d").agg(F.min("y").alias("y")).orderBy(F.xxhash64("d"), "d").limit(max_rows)
    own = docs.select(F.col(doc_id).alias("d"), F.col(text).alias("t"), F.col(n_chars).cast("long").alias("n"))
    # at most max_rows pairs of numbers: a bounded broadcast
    sample = own.join(F.broadcast(marks), "d").dropDuplicates(["d"])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [features(t, n) for t, n in zip(byte_texts(b["t"]), b["n"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_pydict(
                {"d": b["d"].cast(pa.string()), "y": b["y"], "ids": [i.astype(np.int32).tobytes() for i, _ in found], "x": [x.tobytes() for _, x in found]}
            )

    got = sample.select("d", "y", "t", "n").mapInArrow(extract, "d string, y int, ids binary, x binary").collect()
    got.sort(key=lambda r: r.d)
    return fit([(np.frombuffer(r.ids, np.int32), np.frombuffer(r.x, np.float32), r.y) for r in got])


def score_quality(rows: DataFrame, machine: Machine, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """All rows with `score` added (a column of that name is replaced).

    A null text scores as an empty one, from its statistics; null metadata has its own bin.
    """
    shared = rows.sparkSession.sparkContext.broadcast(machine)

    @F.arrow_udf("double")
    def score(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        m = shared.value
        for t, n in columns:
            yield pa.array([m.score(a, b) for a, b in zip(byte_texts(t), n.to_pylist(), strict=True)], pa.float64())

    return rows.withColumn("score", score(F.col(text).cast("string"), F.col(n_chars).cast("long")))


def op1_factorisation_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0)
    machine = train(docs, labels)
    rows = docs.select("doc_id", "text", "n_chars", (fold("doc_id", 5) == 0).alias("held_out"))
    scored = score_quality(rows, machine)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
