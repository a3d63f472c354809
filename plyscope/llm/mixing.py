"""Mixing by iterative proportional fitting: token weights raked to target marginals.

Tokens are summed by cell (source, language, topic). Each sweep scales the cells so that one
marginal after the other meets its target shares, until all do; a cell's weight over its
tokens then gives the expected copies of its documents, scaled to the wanted number of tokens.
Below 1 that is a sampling probability; a cell that asks for more than it has is repeated, so
that the marginals of what is sampled are those of the weights. Where targets contradict each
other no weights meet them all: the largest miss of a share is a column, and is warned of.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyscope.llm.common import byte_texts, set_aside, table
from plyscope.session import land

SWEEPS, TOLERANCE = 200, 1e-9
#: A miss of a target share beyond this is warned of.
MISS = 1e-6


def tokens_and_topic(text: bytes, topics: int, least_bytes: int = 4) -> tuple[int, int]:
    """The number of words, and the hashed-vocabulary topic that most longer words fall into
    (the lowest of equals; -1 without such words)."""
    words = text.lower().split()
    long_words = [w for w in words if len(w) >= least_bytes]
    if not long_words:
        return len(words), -1
    at = np.fromiter(map(crc32, long_words), dtype=np.uint32, count=len(long_words)) % np.uint32(topics)
    return len(words), int(np.bincount(at, minlength=topics).argmax())


def targets_by_power(tokens: np.ndarray, labels: np.ndarray, power: float) -> np.ndarray:
    """Target shares of a marginal: its token shares to a power below 1, which lifts the small."""
    t = np.bincount(labels, tokens)
    t = np.where(t > 0, t, 0) ** power * (t > 0)
    return t / t.sum()


def rake(tokens: np.ndarray, margins: list[np.ndarray], targets: list[np.ndarray]) -> np.ndarray:
    """Cell weights whose marginals meet the targets (shares); starts at the cells' tokens."""
    w = tokens / tokens.sum()
    for _ in range(SWEEPS):
        worst = 0.0
        for label, target in zip(margins, targets, strict=True):
            now = np.bincount(label, w, minlength=len(target))
            worst = max(worst, float(np.abs(now - target).max()))
            w = w * np.where(now > 0, target / np.where(now > 0, now, 1), 0)[label]
        if worst < TOLERANCE:
            break
    return w


def largest_miss(weights: np.ndarray, margins: list[np.ndarray], targets: list[np.ndarray]) -> float:
    """The largest distance of a marginal share of the weights from its target."""
    w = weights / weights.sum() if weights.sum() > 0 else weights
    return max(float(np.abs(np.bincount(m, w, len(t)) - t).max()) for m, t in zip(margins, targets, strict=True))


def _warn(miss: float) -> None:
    if miss > MISS:
        warnings.warn(f"no weights found that meet all targets: a share of tokens misses its target by {miss:.3g}", stacklevel=2)


def calibrate(tokens: np.ndarray, weights: np.ndarray, share: float, most: float = 1.0) -> np.ndarray:
    """Expected copies min(most, s * weight / tokens) that keep `share` of all tokens on average,
    or as many as cells of positive weight give. Only without a bound (inf), or where it does
    not bind, are the marginals those of the weights."""
    rate = np.where(tokens > 0, weights / np.where(tokens > 0, tokens, 1), 0)
    want = min(share * tokens.sum(), most * tokens[rate > 0].sum())
    order = np.argsort(-rate)
    r, t = rate[order], tokens[order]
    full = np.concatenate([[0.0], most * np.cumsum(t)])  # tokens of the cells at the bound
    rest = np.concatenate([np.cumsum((r * t)[::-1])[::-1], [0.0]])
    for k in range(len(r) + 1):  # k cells are at the bound
        left = want - full[k]
        s = left / rest[k] if rest[k] > 0 else 0.0
        if k == len(r) or r[k] * s <= most:
            p = np.full(len(r), most)
            p[k:] = np.clip(r[k:] * s, 0, most)
            break
    out = np.empty(len(r))
    out[order] = p
    return out


def _cells_on_driver(cells: DataFrame, by: list[str], power: float, share: float, most: float) -> DataFrame:
    rows = cells.orderBy(*by).collect()
    tokens = np.array([r.tokens for r in rows], dtype=np.float64)
    if tokens.sum() <= 0:
        return cells.withColumns({"weight": F.lit(0.0), "probability": F.lit(1.0), "miss": F.lit(0.0)})
    margins = [np.unique([repr(r[c]) for r in rows], return_inverse=True)[1] for c in by]
    targets = [targets_by_power(tokens, m, power) for m in margins]
    w = rake(tokens, margins, targets)
    p = np.where(tokens > 0, calibrate(tokens, w, share, most), 1.0)  # texts without words cost nothing
    miss = largest_miss(p * tokens, margins, targets)
    _warn(miss)
    schema = cells.schema
    data = [(*r, float(a), float(b), miss) for r, a, b in zip(rows, w, p, strict=True)]
    made = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return cells.sparkSession.createDataFrame(data, f"{made}, weight double, probability double, miss double")


def _cells_on_cluster(cells: DataFrame, by: list[str], power: float, share: float, most: float) -> DataFrame:
    """The same for any number of cells: each step of a sweep is one aggregation and one join."""
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    if total <= 0:
        return cells.withColumns({"weight": F.lit(0.0), "probability": F.lit(1.0), "miss": F.lit(0.0)})
    w = cells.withColumn("weight", F.col("tokens") / total)
    aims = {}
    for c in by:
        t = cells.groupBy(c).agg(F.sum("tokens").alias("t")).withColumn("aim", F.when(F.col("t") > 0, F.col("t") ** power).otherwise(0.0))
        norm = t.agg(F.sum("aim")).first()[0]
        aims[c] = land(t.select(c, (F.col("aim") / norm).alias("aim")), "aims")
    for _ in range(SWEEPS):
        worst = 0.0
        for c in by:
            now = w.groupBy(c).agg(F.sum("weight").alias("now")).alias("n")
            aim = aims[c].alias("a")
            scale = now.join(aim, F.expr(f"n.`{c}` <=> a.`{c}`")).selectExpr(f"n.`{c}` AS _label", "now", "aim")
            scale = land(scale, "scale")
            worst = max(worst, scale.agg(F.max(F.abs(F.col("now") - F.col("aim")))).first()[0] or 0.0)
            joined = w.join(scale, F.col(c).eqNullSafe(F.col("_label")))
            w = land(joined.withColumn("weight", F.when(F.col("now") > 0, F.col("weight") * F.col("aim") / F.col("now")).otherwise(0.0)).select(*w.columns), "weights")
        if worst < TOLERANCE:
            break
    w = land(w.withColumn("rate", F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0)), "weights")
    facts = w.where("rate > 0").agg(F.sum("tokens").alias("tokens"), F.min("rate").alias("least"), F.sum("weight").alias("weight")).first()
    if most == np.inf:
        high = share * total / (facts.weight or 1.0)
    else:
        want = min(share * total, most * (facts.tokens or 0))
        low, high = 0.0, most / (facts.least or 1.0)
        for _ in range(100):
            s = (low + high) / 2
            kept = w.agg(F.sum(F.least(F.lit(most), F.col("rate") * s) * F.col("tokens"))).first()[0]
            low, high = (s, high) if kept < want else (low, s)
            if high - low <= 1e-12 * high:
                break
    p = F.when(F.col("tokens") > 0, F.least(F.lit(most), F.col("rate") * high)).otherwise(1.0)
    w = land(w.withColumn("probability", p).drop("rate"), "weights")
    kept = w.agg(F.sum(F.col("tokens") * F.col("probability"))).first()[0] or 1.0
    miss = 0.0
    for c in by:
        now = w.groupBy(c).agg((F.sum(F.col("tokens") * F.col("probability")) / kept).alias("now")).alias("n")
        apart = now.join(aims[c].alias("a"), F.expr(f"n.`{c}` <=> a.`{c}`")).agg(F.max(F.abs(F.col("now") - F.col("aim")))).first()[0]
        miss = max(miss, apart or 0.0)
    _warn(miss)
    return w.withColumn("miss", F.lit(miss))


def mix(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", lang: str = "lang",
    topics: int = 8, power: float = 0.7, share: float = 0.8, driver_cells: int = 100_000, repeats: bool = True,
) -> DataFrame:
    """All rows with _tokens, _topic, _weight, _probability, _miss, _copies and _kept added.

    Targets are the token shares of each marginal to `power`, over all rows; null sources and
    languages are values of their own. _probability is the expected number of copies, above 1
    where the targets ask for more of a cell than there is: _copies is its whole part, and one
    more if the row's hash, of id and text, falls below the rest, so the choice does not depend
    on how rows are spread, and repeated rows are treated alike. A row is kept if it has copies.
    Texts without words have no tokens and are kept once. With `repeats` false no row has more
    than one copy, and what such cells lack goes to the others. _miss is the largest distance
    of a marginal's share of the expected tokens from its target, above 0 where no weights
    meet all targets or repeats that they need are not allowed. The table
    of cells is fitted on the driver up to `driver_cells` cells, beyond that on the cluster.
    Columns of the added names are replaced; no other column is touched, whatever its name.
    """

    @F.arrow_udf("struct<tokens: long, topic: int>")
    def measure(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            found = [tokens_and_topic(t, topics) for t in byte_texts(column)]
            yield pa.StructArray.from_arrays(
                [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int32())], names=["tokens", "topic"]
            )

    by = ["_source", "_lang", "_topic"]
    docs, again = set_aside(docs, ["_source", "_lang", "_measured", *[f"_cell{c}" for c in by]])
    text, doc_id, source, lang = ({c: new for new, c in again.items()}.get(x, x) for x in (text, doc_id, source, lang))
    rows = docs.withColumn("_measured", measure(F.col(text).cast("string")))
    rows = rows.withColumns({"_tokens": F.col("_measured.tokens"), "_topic": F.col("_measured.topic"), "_source": F.col(source), "_lang": F.col(lang)}).drop("_measured")
    u = F.pmod(F.xxhash64(F.col(doc_id), F.col(text), F.lit("mix")), F.lit(1 << 53)) / F.lit(float(1 << 53))
    cells = land(rows.groupBy(*by).agg(F.sum("_tokens").alias("tokens")), "cells")
    few = cells.count() <= driver_cells
    fitted = (_cells_on_driver if few else _cells_on_cluster)(cells, by, power, share, np.inf if repeats else 1.0)
    fitted = fitted.select(*[F.col(c).alias(f"_cell{c}") for c in by], F.col("weight").alias("_weight"), F.col("probability").alias("_probability"), F.col("miss").alias("_miss"))
    fitted = F.broadcast(fitted) if few else fitted
    same = [F.col(c).eqNullSafe(F.col(f"_cell{c}")) for c in by]
    out = rows.join(fitted, same[0] & same[1] & same[2], "left")
    whole = F.floor("_probability")
    out = out.withColumn("_copies", whole + (u < F.col("_probability") - whole).cast("long")).withColumn("_kept", F.col("_copies") > 0)
    return out.drop("_source", "_lang", *[f"_cell{c}" for c in by]).withColumnsRenamed(again)


#: What `mix` and `sample_mix` add.
ADDED = ("_tokens", "_topic", "_weight", "_probability", "_miss", "_copies", "_kept", "_copy")


def sample_mix(docs: DataFrame, repeats: bool = False, **options: object) -> DataFrame:
    """The rows of `docs`, all columns, that the mix keeps: with `repeats` each as often as its
    copies say, so that the targets are met, otherwise each once at most."""
    columns = docs.columns
    docs, again = set_aside(docs, ADDED)
    kept = mix(docs, repeats=repeats, **options).where("_kept")
    if repeats:
        kept = kept.withColumn("_copy", F.explode(F.expr("sequence(1L, _copies)")))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns]).withColumnsRenamed(again).select(*[F.col(f"`{c}`") for c in columns])


def op9_proportional_fitting(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    out = mix(docs)
    return out.select("doc_id", "source", "lang", *[F.col(f"_{c}").alias(c) for c in ("topic", "tokens", "weight", "probability", "miss", "copies", "kept")])
