"""Language identification by a string kernel.

The kernel is the blended spectrum: two texts compare by the letter n-grams (1 to 3) that
occur in both, presence only, cosine-normalised over the n-grams of the landmarks. Nystrom
landmarks turn it into a bounded feature map, one ridge regression per language is fitted
on that map, and whole batches are scored by two matrix products: presence by landmarks,
then kernel rows by coefficients.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyscope.llm.common import fold, set_aside, slices, table
from plyscope.operators.report import bounded_broadcast
from plyscope.session import land

BITS = 18
UNKNOWN = "und"
SPACE = 32


def _letter_table() -> np.ndarray:
    return np.array([c if chr(c).isalpha() else SPACE for c in range(0x110000)], dtype=np.uint32)


LETTERS = _letter_table()


def points(text: str) -> np.ndarray:
    """Code points in lower case with a space at either end; a run of non-letters is one space."""
    x = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    x = np.concatenate([[SPACE], LETTERS[x], [SPACE]]).astype(np.uint32)
    gap = x == SPACE
    return x[np.r_[True, ~(gap[1:] & gap[:-1])]]


def grams(x: np.ndarray, n: int) -> np.ndarray:
    """Hashed ids, in BITS bits, of the n-grams that start at each position."""
    h = x[: len(x) - n + 1] * np.uint32(0x9E3779B1) + np.uint32(n)
    for i in range(1, n):
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B) + x[i : len(x) - n + 1 + i] * np.uint32(0xC2B2AE35)
    h = (h ^ (h >> np.uint32(13))) * np.uint32(0x27D4EB2F)
    return h >> np.uint32(32 - BITS)


@dataclass
class Kernel:
    """Landmarks as a presence matrix over their own n-grams."""

    column: np.ndarray  # hashed n-gram -> column, or -1
    landmarks: np.ndarray  # landmark x column, scaled to unit length
    orders: tuple[int, ...]

    def rows(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Kernel values against every landmark, and whether a text has any letter."""
        width = self.landmarks.shape[1]
        seen = np.zeros((len(texts), width), dtype=np.float32)
        lettered = np.zeros(len(texts), dtype=bool)
        for i, text in enumerate(texts):
            x, row = points(text), seen[i]
            lettered[i] = bool((x != SPACE).any())
            for n in self.orders:
                if len(x) >= n:
                    at = self.column[grams(x, n)]
                    row[at[at >= 0]] = 1
        norm = np.sqrt(np.maximum(seen.sum(axis=1, keepdims=True), 1))
        return (seen @ self.landmarks.T) / norm, lettered


def make_kernel(texts: list[str], orders: tuple[int, ...]) -> Kernel:
    found = [np.unique(np.concatenate([grams(x, n) for n in orders if len(x) >= n])) for x in map(points, texts)]
    ids = np.unique(np.concatenate(found))
    column = np.full(1 << BITS, -1, dtype=np.int32)
    column[ids] = np.arange(len(ids))
    marks = np.zeros((len(texts), len(ids)), dtype=np.float32)
    for row, own in zip(marks, found, strict=True):
        row[column[own]] = 1 / np.sqrt(len(own))
    return Kernel(column, marks, orders)


@dataclass
class Model:
    languages: list[str]
    kernel: Kernel
    weights: np.ndarray  # landmark x language
    bias: np.ndarray
    sharpness: float

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        k, lettered = self.kernel.rows(texts)
        f = k @ self.weights + self.bias
        p = np.exp(self.sharpness * (f - f.max(axis=1, keepdims=True)))
        p /= p.sum(axis=1, keepdims=True)
        best = f.argmax(axis=1)
        names = [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered, strict=True)]
        return names, np.where(lettered, p[np.arange(len(best)), best], 0.0)


def _least_by_hash(rows: DataFrame, n: int, salts: int = 256) -> DataFrame:
    """(y, t, k): of each y the n rows of smallest hash, of id and then of text, with their place.

    Hashes are sorted out first, in two folds, so that a task sees at most n of them for each
    y and salt; only texts of the chosen rows are then shuffled. Equal rows have equal hashes:
    one text comes for all of them.
    """
    hashed = rows.select("y", "t", F.xxhash64("d").alias("a"), F.xxhash64("t").alias("b"))
    place = "row_number() OVER (PARTITION BY {} ORDER BY a, b)"
    few = hashed.selectExpr("y", "a", "b", f"pmod(b, {salts}) AS salt").selectExpr("*", f"{place.format('y, salt')} AS k").where(f"k <= {n}")
    few = few.selectExpr("y", "a", "b", f"{place.format('y')} AS k").where(f"k <= {n}")
    chosen, _ = bounded_broadcast(land(few.groupBy("y", "a", "b").agg(F.collect_list("k").alias("ks")), "chosen"))
    texts = hashed.join(chosen, ["y", "a", "b"]).groupBy("y", "a", "b").agg(F.first("t").alias("t"), F.first("ks").alias("ks"))
    return texts.select("y", "t", F.explode("ks").alias("k"))


def train(
    rows: DataFrame,
    text: str = "text",
    lang: str = "lang",
    doc_id: str = "doc_id",
    landmarks_per_language: int = 24,
    rows_per_language: int = 400,
    orders: tuple[int, ...] = (1, 2, 3),
    ridge: float = 1e-3,
    sharpness: float = 6.0,
) -> Model | None:
    """Fits on a bounded sample: the `rows_per_language` rows of smallest id hash per language.

    Whole texts count; repeated rows are rows of their own. Rows with null language, or without a letter, teach nothing; with no
    row left there is no model. Landmark texts come to the driver; of the other sampled rows
    only the kernel values do.
    """
    rows = rows.select(F.col(text).alias("t"), F.col(lang).alias("y"), F.col(doc_id).alias("d"))
    rows = rows.where("t IS NOT NULL AND y IS NOT NULL").where(F.col("t").rlike(r"\p{L}"))
    ranked = land(_least_by_hash(rows, rows_per_language), "language-sample")
    marks = ranked.where(f"k <= {landmarks_per_language}").orderBy("y", "k").select("t", "y").collect()
    if not marks:
        return None
    kernel = make_kernel([m.t for m in marks], orders)
    shared = rows.sparkSession.sparkContext.broadcast(kernel)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 256):
                k, _ = shared.value.rows(part["t"].to_pylist())
                yield pa.RecordBatch.from_pydict({"y": part["y"], "k": [r.astype(np.float32).tobytes() for r in k]})

    sample = ranked.select("t", "y").mapInArrow(features, "y string, k binary").collect()
    languages = sorted({s.y for s in sample})
    k = np.stack([np.frombuffer(s.k, dtype=np.float32) for s in sample]).astype(np.float64)
    y = np.array([languages.index(s.y) for s in sample])
    inner = (kernel.landmarks @ kernel.landmarks.T).astype(np.float64)
    values, vectors = np.linalg.eigh(inner)
    keep = values > 1e-6 * values[-1]
    root = vectors[:, keep] / np.sqrt(values[keep])  # K_mm to the power -1/2
    phi = k @ root
    share = 1 / (len(languages) * np.bincount(y)[y])  # each language weighs the same
    mean = share @ phi
    centred = phi - mean
    gram = (centred * share[:, None]).T @ centred + ridge * np.eye(phi.shape[1])
    targets = np.where(y[:, None] == np.arange(len(languages)), 1.0, -1.0)
    offset = share @ targets
    w = np.linalg.solve(gram, (centred * share[:, None]).T @ (targets - offset))
    coefficients = root @ w
    return Model(languages, kernel, coefficients.astype(np.float32), (offset - mean @ w).astype(np.float32), sharpness)


def identify(rows: DataFrame, model: Model | None, text: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """All rows with the language and its score added (columns of those names are replaced).

    The prediction is `und` with score 0 for a null text, one without a letter, or without
    a model. Texts are read whole; nothing else of a row is looked at.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)


    @F.arrow_udf("struct<name string, score double>")
    def predict(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        for column in columns:
            names, scores = [], []
            for start in range(0, len(column), 256):
                texts = [t or "" for t in column.slice(start, 256).to_pylist()]
                n, s = m.predict(texts) if m else ([UNKNOWN] * len(texts), np.zeros(len(texts)))
                names += n
                scores += s.tolist()
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["name", "score"]
            )

    found = rows.withColumn("_found_language", predict(F.col(text).cast("string")))
    added = {n: F.col(f"_found_language.{c}") for n, c in zip(names, ("name", "score"), strict=True)}
    return found.withColumns(added).drop("_found_language")


def keep_identified(rows: DataFrame, model: Model | None, text: str = "text", least: float = 0.35) -> DataFrame:
    """The rows, all columns, whose language is told with a score of `least` or more."""
    names = ("_language", "_language_score")
    rows, again = set_aside(rows, [*names, "_found_language"])
    found = identify(rows, model, text, names).where(F.col(names[0]) != UNKNOWN).where(F.col(names[1]) >= least)
    return found.drop(*names).withColumnsRenamed(again)


def learnt_rows(docs: DataFrame) -> DataFrame:
    return docs.where(fold("doc_id", 3) != 1)


def op2_string_kernel_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(learnt_rows(docs))
    rows = docs.select("doc_id", "text", (fold("doc_id", 3) == 1).alias("held_out"))
    return identify(rows, model).select("doc_id", "held_out", "lang_pred", "score")
