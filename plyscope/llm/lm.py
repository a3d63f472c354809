"""Language-model scores by logistic context mixing over the bits of words.

A text is its words in order, then an end mark (the empty word). A word is its bytes and a
word end; each of these symbols is a path of bits in a prefix code, so that common symbols
are few bits. For every bit, hashed contexts (the last one to six symbols, the whole word so
far; the low orders also by regime) each predict from counts of zeros and ones. Their logits
are added under weights that a gate chooses by how often the high orders have been seen; the
weights are learnt online, by gradient steps over the words, each word taken out of the
counts it is predicted from.

Two more predictors are added to what the bits say. The counts of whole words, absolutely
discounted, leave to the bits what words seen so far do not take. And as a text is read, its
own words so far predict the next. A regime is a language of the training texts; each text's
regime is inferred as it is read, so that its probability is the sum over regimes.

No context reaches over a word's start, so a word's bits cost the same wherever it stands in
a regime. So counting, learning and scoring run over distinct words, not over texts, and the
texts then look their words up: each block of texts asks once for each distinct word it
holds. The count tables have a fixed number of slots; the words, and what is counted from
them, grow with the corpus.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plyscope.llm.common import U64, byte_texts, fold, mixed, table
from plyscope.session import land

END, START = 256, 257
#: Contexts: symbols looked back on (0: the whole word so far), and whether the regime counts.
CONTEXTS = ((1, True), (2, True), (3, True), (4, False), (6, False), (0, False))
GATED_BY = (3, 5)
SLOT_BITS = 20
CHUNK_BITS = 14
GATES = 16
DAMP = 0.35
LN10 = np.log(10.0)
WORDS_AT_ONCE, WORDS_A_STEP = 4096, 1024
DISCOUNT, OWN_WORDS, OWN_DELAY = 0.75, 0.08, 20.0
POWERS = np.cumprod(np.r_[U64(1), np.full(1 << 12, U64(0x9E3779B97F4A7C15 | 1))])
STEP = U64(0xD6E8FEB86659FD93)


@dataclass
class Code:
    """A prefix code over 256 bytes and the word end, as paths of node numbers and bits."""

    node: np.ndarray
    bit: np.ndarray
    length: np.ndarray


def make_code(counts: np.ndarray) -> Code:
    """Huffman's code; every symbol counts once more, so that any byte can be written."""
    heap = [(float(c) + 1, i, i) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    parent: dict[int, tuple[int, int]] = {}
    made = 0
    while len(heap) > 1:
        (a, _, x), (b, _, y) = heapq.heappop(heap), heapq.heappop(heap)
        up = -1 - made
        parent[x], parent[y] = (up, 0), (up, 1)
        heapq.heappush(heap, (a + b, len(counts) + made, up))
        made += 1
    paths = []
    for s in range(len(counts)):
        path, at = [], s
        while at in parent:
            at, bit = parent[at]
            path.append((-at, bit))
        paths.append(path[::-1])
    length = np.array([len(p) for p in paths])
    node, bit = (np.zeros((len(counts), length.max()), dtype=t) for t in (np.uint64, np.uint8))
    for s, path in enumerate(paths):
        for j, (n, b) in enumerate(path):
            node[s, j], bit[s, j] = n, b
    return Code(node, bit, length)


@dataclass
class Bits:
    """The bits of some words: word and symbol they belong to, tree node, value; context hashes by symbol."""

    word: np.ndarray
    symbol: np.ndarray
    node: np.ndarray
    bit: np.ndarray
    contexts: list[np.ndarray]
    starts: np.ndarray  # first bit of each word


def symbols(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All symbols of the words, word ends included, and the words' lengths in symbols."""
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    out = np.full(int(sizes.sum()), END, dtype=np.int64)
    inner = np.ones(len(out), dtype=bool)
    inner[np.cumsum(sizes) - 1] = False
    out[inner] = np.frombuffer(b"".join(words), dtype=np.uint8)
    return out, sizes


def expand(words: list[bytes], code: Code) -> Bits:
    sym, sizes = symbols(words)
    first = np.cumsum(sizes) - sizes
    word = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(sym)) - first[word]
    terms = (sym.astype(np.uint64) + U64(1)) * POWERS[place & 0xFFF]
    run = np.cumsum(terms) - terms
    hashes = {0: mixed(run - run[first][word] + place.astype(np.uint64))}
    h = np.zeros(len(sym), dtype=np.uint64)
    for j in range(1, max(n for n, _ in CONTEXTS) + 1):
        prev = np.full(len(sym), START, dtype=np.uint64)
        prev[j:] = sym[:-j]
        h = (h ^ (h >> U64(31))) * STEP + np.where(place >= j, prev, U64(START))
        hashes[j] = h
    spread = [np.full(1, 2 * k + 1, np.uint64) * STEP for k in range(len(CONTEXTS))]
    contexts = [(hashes[n] ^ (hashes[n] >> U64(29))) * spread[k] for k, (n, _) in enumerate(CONTEXTS)]
    n_bits = code.length[sym]
    symbol = np.repeat(np.arange(len(sym)), n_bits)
    at = np.arange(len(symbol)) - (np.cumsum(n_bits) - n_bits)[symbol]
    own = sym[symbol]
    starts = np.r_[0, np.cumsum(np.add.reduceat(n_bits, first))[:-1]] if len(words) else np.empty(0, np.int64)
    return Bits(word[symbol], symbol, code.node[own, at] * STEP, code.bit[own, at], contexts, starts)


def slots(b: Bits, k: int, regime: np.ndarray | int) -> np.ndarray:
    """The slot of context k for every bit; regimes by word, or one for all."""
    c = b.contexts[k][b.symbol] + b.node
    if CONTEXTS[k][1]:
        r = regime[b.word].astype(np.uint64) if isinstance(regime, np.ndarray) else np.full(1, regime, np.uint64)
        c = c ^ ((r + U64(1)) * U64(0xA0761D6478BD642F))
    return ((c * U64(0x9FB21C651E98DF25)) >> U64(64 - SLOT_BITS)).astype(np.int64)


def logit(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return np.log((n1 + DAMP) / (n0 + DAMP)).astype(np.float32)


def seen_level(n: np.ndarray) -> np.ndarray:
    return ((n > 0).astype(np.int8) + (n > 2) + (n > 20)).astype(np.int64)


@dataclass
class Mixer:
    """The trained model: code, count tables by context (slot x bit), weights by gate."""

    code: Code
    counts: np.ndarray
    weights: np.ndarray
    prior: np.ndarray

    def __post_init__(self) -> None:
        self.logits = np.stack([logit(*c.T.astype(np.float32)) for c in self.counts])
        self.levels = [seen_level(self.counts[k].sum(axis=1, dtype=np.int64)).astype(np.int8) for k in GATED_BY]

    def log_probabilities(self, words: list[bytes]) -> np.ndarray:
        """log10 P(word) under each regime (word x regime)."""
        out = np.zeros((len(words), len(self.prior)))
        for start in range(0, len(words), WORDS_AT_ONCE):
            part = words[start : start + WORDS_AT_ONCE]
            b = expand(part, self.code)
            gate, common = np.zeros(len(b.bit), dtype=np.int64), []
            for k, (_, own) in enumerate(CONTEXTS):
                if not own:
                    s = slots(b, k, 0)
                    if k in GATED_BY:
                        gate = gate * 4 + self.levels[GATED_BY.index(k)][s]
                    common.append((k, self.logits[k][s]))
            shared = sum(self.weights[:, k].take(gate) * x for k, x in common)
            sign = np.where(b.bit == 1, -1, 1).astype(np.float32)
            for r in range(len(self.prior)):
                x = shared.copy()
                for k, (_, own) in enumerate(CONTEXTS):
                    if own:
                        x += self.weights[:, k].take(gate) * self.logits[k][slots(b, k, r)]
                cost = np.logaddexp(np.float32(0), np.clip(x, -14, 14) * sign).astype(np.float64)
                out[start : start + len(part), r] = -np.add.reduceat(cost, b.starts) / LN10
        return out


def learn_weights(words: list[bytes], regime: np.ndarray, code: Code, counts: np.ndarray, weights: np.ndarray, energy: np.ndarray, rate: float) -> None:
    """One online step along the gradient of the mean cost of a bit, gate by gate."""
    b = expand(words, code)
    x, gate = np.empty((len(CONTEXTS), len(b.bit)), dtype=np.float32), np.zeros(len(b.bit), dtype=np.int64)
    one = b.bit.astype(np.float32)
    for k in range(len(CONTEXTS)):
        own = counts[k][slots(b, k, regime)].astype(np.float32)
        n1, n0 = np.maximum(own[:, 1] - one, 0), np.maximum(own[:, 0] - (1 - one), 0)
        x[k] = logit(n0, n1)
        if k in GATED_BY:
            gate = gate * 4 + seen_level(n0 + n1)
    z = sum(weights[:, k].take(gate) * x[k] for k in range(len(CONTEXTS)))
    p = 1 / (1 + np.exp(-np.clip(z, -14, 14)))
    err = p - one
    total = np.maximum(np.bincount(gate, minlength=GATES), 1)
    for k in range(len(CONTEXTS)):
        g = np.bincount(gate, err * x[k], GATES) / total
        energy[:, k] = 0.95 * energy[:, k] + 0.05 * g * g
        weights[:, k] -= rate * g / (np.sqrt(energy[:, k]) + 1e-3)


def own_words(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word of a text, the weight of the words before it and their share that equals it."""
    order = np.argsort(ids, kind="stable")
    sorted_ids, at = ids[order], np.arange(len(ids))
    first = np.maximum.accumulate(np.where(np.r_[True, sorted_ids[1:] != sorted_ids[:-1]], at, 0))
    before = np.empty(len(ids))
    before[order] = at - first
    return OWN_WORDS * at / (at + OWN_DELAY), before / np.maximum(at, 1)


def pack(ids: np.ndarray) -> bytes:
    """Numbers below 2^24 as three planes of bytes, of which the higher ones compress."""
    return ids.astype("<i4").view(np.uint8).reshape(-1, 4).T[:3].tobytes()


def unpack(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, dtype=np.uint8).reshape(3, -1).astype(np.int32)
    return planes[0] | planes[1] << 8 | planes[2] << 16


def block_words(docs: DataFrame, n_regimes: int, block_bytes: int) -> DataFrame:
    """Texts and distinct words by block: kind 1 rows are texts with their words as numbers,
    kind 0 rows are the block's words with their counts in training texts by regime."""

    def emit(block: int, index: dict[bytes, int], texts: list[tuple], learnt: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        n, m, words = len(index), len(texts), list(index)
        counts = [np.bincount(np.concatenate(own), minlength=n) if own else np.zeros(n, np.int64) for own in learnt]
        for a in range(0, n, 50_000):
            k = min(50_000, n - a)
            columns = {"block": np.full(k, block), "kind": np.zeros(k, np.int32), "id": np.arange(a, a + k, dtype=np.int32)}
            columns["word"] = pa.array(words[a : a + k], pa.binary())
            columns |= {f"c{i}": c[a : a + k] for i, c in enumerate(counts)}
            columns |= {"doc_id": pa.nulls(k, pa.int64()), "held_out": pa.nulls(k, pa.bool_()), "n_bytes": pa.nulls(k, pa.int64())}
            yield pa.RecordBatch.from_pydict(columns | {"ids": pa.nulls(k, pa.binary())})
        for a in range(0, m, 2000):
            part = texts[a : a + 2000]
            k = len(part)
            columns = {"block": np.full(k, block), "kind": np.ones(k, np.int32), "id": np.arange(a, a + k, dtype=np.int32)}
            columns |= {"word": pa.nulls(k, pa.binary())} | {f"c{i}": pa.nulls(k, pa.int64()) for i in range(n_regimes)}
            columns |= {"doc_id": pa.array([t[0] for t in part], pa.int64()), "held_out": pa.array([t[1] for t in part], pa.bool_())}
            columns["n_bytes"] = pa.array([t[2] for t in part], pa.int64())
            yield pa.RecordBatch.from_pydict(columns | {"ids": pa.array([pack(t[3]) for t in part], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = TaskContext.get().partitionId() << 32
        fresh = lambda: ({b"": 0}, [], [[] for _ in range(n_regimes)], 0)
        index, texts, learnt, size = fresh()
        for batch in batches:
            for doc_id, held, regime, text in zip(batch["doc_id"].to_pylist(), batch["held_out"].to_pylist(), batch["regime"].to_pylist(), byte_texts(batch["text"]), strict=True):
                words = text.lower().split()
                ids = np.empty(len(words) + 1, dtype=np.int32)
                ids[:-1] = [index.setdefault(w, len(index)) for w in words]
                ids[-1] = 0
                texts.append((doc_id, held, len(text), ids))
                if not held:
                    learnt[regime].append(ids)
                size += len(text) + 16
                if size >= block_bytes:
                    yield from emit(serial, index, texts, learnt)
                    serial, (index, texts, learnt, size) = serial + 1, fresh()
        if texts:
            yield from emit(serial, index, texts, learnt)

    by_regime = "".join(f"c{i} long, " for i in range(n_regimes))
    schema = f"block long, kind int, id int, word binary, {by_regime}doc_id long, held_out boolean, n_bytes long, ids binary"
    return docs.select("doc_id", "held_out", "regime", "text").mapInArrow(run, schema)


def _counts(batch: pa.RecordBatch) -> np.ndarray:
    """The counts of each word by regime, columns c0, c1 and so on."""
    names = [n for n in batch.schema.names if n[0] == "c" and n[1:].isdigit()]
    return np.stack([batch[n].to_numpy(zero_copy_only=False) for n in names], axis=1)


def _pairs(batch: pa.RecordBatch) -> tuple[list[bytes], np.ndarray]:
    """The (word, regime) pairs of a batch of vocabulary that training texts hold."""
    words = batch["word"].to_pylist()
    at, regime = np.nonzero(_counts(batch))
    return [words[i] for i in at], regime


def train(vocabulary: DataFrame, rate: float = 0.03) -> tuple[Broadcast, np.ndarray]:
    """Code and count tables, sent to the executors, and weights from the written vocabulary
    (word, c0, c1, ...), each word once.

    The driver gets the symbol counts, the summed tables and the weights: sizes that the
    parameters fix. Each task sums its own tables before the shuffle.
    """
    spark = vocabulary.sparkSession

    def count_symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(257)
        for batch in batches:
            total += np.bincount(symbols(_pairs(batch)[0])[0], minlength=257)
        yield pa.RecordBatch.from_pydict({"symbol": np.arange(257), "n": total})

    found = vocabulary.mapInArrow(count_symbols, "symbol long, n double").groupBy("symbol").agg(F.sum("n").alias("n")).collect()
    per_symbol = np.zeros(257)
    for r in found:
        per_symbol[r.symbol] = r.n
    code = make_code(per_symbol)
    chunk = 1 << CHUNK_BITS

    def count_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros((len(CONTEXTS), 2 << SLOT_BITS), dtype=np.uint32)
        for batch in batches:
            words, regime = _pairs(batch)
            for a in range(0, len(words), WORDS_AT_ONCE):
                z = slice(a, a + WORDS_AT_ONCE)
                b = expand(words[z], code)
                for k in range(len(CONTEXTS)):
                    np.add.at(own[k], 2 * slots(b, k, regime[z]) + b.bit, np.uint32(1))
        for k in range(len(CONTEXTS)):
            parts = own[k].reshape(-1, 2 * chunk)
            used = np.flatnonzero(parts.any(axis=1))
            yield pa.RecordBatch.from_pydict({"k": np.full(len(used), k), "part": used, "n": pa.array([parts[u].tobytes() for u in used], pa.binary())})

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for k, part, n in zip(*(batch[c].to_pylist() for c in ("k", "part", "n")), strict=True):
                x = np.frombuffer(n, dtype=np.uint32)
                total[k, part] = total[k, part] + x if (k, part) in total else x.astype(np.int64)
        for (k, part), x in total.items():
            yield pa.RecordBatch.from_pydict({"k": [k], "part": [part], "n": pa.array([x.tobytes()], pa.binary())})

    schema = "k long, part long, n binary"
    summed = vocabulary.mapInArrow(count_bits, schema).repartition("k", "part").mapInArrow(add_up, schema)
    # Sums are exact; rounded to 24 bits each, both sides of a slot keep their ratio at any size.
    counts = np.zeros((len(CONTEXTS), 1 << SLOT_BITS, 2), dtype=np.float32)
    for r in summed.toLocalIterator():
        counts[r.k].reshape(-1, 2 * chunk)[r.part] = np.frombuffer(r.n, dtype=np.int64)
    shared = spark.sparkContext.broadcast((code, counts))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, counts = shared.value
        weights = np.full((GATES, len(CONTEXTS)), 0.3, dtype=np.float32)
        energy, mass, step = np.full(weights.shape, 1e-2), 0.0, 0
        for batch in batches:
            words, regime = _pairs(batch)
            for a in range(0, len(words), WORDS_A_STEP):
                z = slice(a, a + WORDS_A_STEP)
                learn_weights(words[z], regime[z], code, counts, weights, energy, rate / (1 + step / 200) ** 0.5)
                mass, step = mass + len(regime[z]), step + 1
        yield pa.RecordBatch.from_pydict({"mass": [mass], "w": pa.array([weights.tobytes()], pa.binary())})

    weights, mass = np.zeros((GATES, len(CONTEXTS)), dtype=np.float64), 0.0
    for r in vocabulary.mapInArrow(learn, "mass double, w binary").collect():
        weights += r.mass * np.frombuffer(r.w, dtype=np.float32).reshape(weights.shape)
        mass += r.mass
    weights = weights / mass if mass else np.full(weights.shape, 0.3)
    return shared, weights.astype(np.float32)


def languages(docs: DataFrame) -> list[str | None]:
    """The languages of the training rows, commonest first; null is one of its own."""
    found = docs.where("NOT coalesce(held_out, false)").groupBy("lang").agg(F.count("*").alias("n"))
    return [r.lang for r in found.orderBy(F.desc("n"), "lang").collect()]


def score_texts(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang", held_out: str = "held_out",
    block_bytes: int = 64 << 20,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte for every row.

    Learns from the rows whose `held_out` is false. Words are split at ASCII white space, A-Z
    folded; a null or empty text is its end mark alone (and has null bits per byte). base_score
    is the sum of log10((c + 0.5) / (N + 0.5 (V + 1))); score is the model's log10 probability
    of the same tokens. Every language of the training rows is a regime, and so are their null
    languages together; languages of other rows are not looked at.
    Repeated rows are scored each; with no training row every bit costs one bit.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(held_out).alias("held_out"), F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    names = languages(docs) or [None]
    number = F.coalesce(*[F.when(F.col("lang").eqNullSafe(F.lit(n)), F.lit(i)) for i, n in enumerate(names)], F.lit(0))
    g = len(names)
    by = [f"c{i}" for i in range(g)]
    blocks = land(block_words(docs.withColumn("regime", number), g, block_bytes), "blocks", compression="zstd")
    # Every word of every block with its counts over all blocks; a word stands once per block.
    whole = Window.partitionBy("word")
    words = blocks.where("kind = 0").select("word", "block", "id", *by)
    words = words.withColumns({c: F.sum(c).over(whole) for c in by} | {"first": F.col("block") == F.min("block").over(whole)})
    words = land(words, "words", compression="zstd")
    vocabulary = words.where("first").select("word", *by)
    facts = vocabulary.withColumn("n", sum(F.col(c) for c in by)).agg(
        F.sum("n").alias("n"), F.count(F.when(F.col("n") > 0, 1)).alias("v"),
        *[F.max(F.when(F.expr("octet_length(word) = 0"), F.col(c))).alias(f"end_{c}") for c in by],
        *[F.sum(c).alias(f"n_{c}") for c in by], *[F.count(F.when(F.col(c) > 0, 1)).alias(f"v_{c}") for c in by],
    ).first()
    n, v = facts.n or 0, facts.v or 0
    n_by, v_by, ends = (np.array([facts[f"{kind}_{c}"] or 0 for c in by], dtype=np.float64) for kind in ("n", "v", "end"))
    rest = np.where(n_by > 0, DISCOUNT * v_by / np.maximum(n_by, 1), 1.0)  # what is left to the bits
    prior = (ends + 0.5) / (ends + 0.5).sum()
    tables, weights = train(vocabulary)

    def score_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Mixer(*tables.value, weights, prior)
        for batch in batches:  # equal words follow each other and are scored once
            coded = batch["word"].dictionary_encode()
            at = coded.indices.to_numpy()
            first = np.zeros(len(coded.dictionary), dtype=np.int64)
            first[at[::-1]] = np.arange(len(at))[::-1]
            counts = _counts(batch)
            with np.errstate(divide="ignore"):
                whole = np.log(np.maximum(counts[first] - DISCOUNT, 0) / np.maximum(n_by, 1))
                by_bits = np.log(rest) + LN10 * m.log_probabilities(coded.dictionary.to_pylist())
            lp = [r.tobytes() for r in (np.logaddexp(whole, by_bits) / LN10).astype(np.float32)]
            yield pa.RecordBatch.from_pydict(
                {"block": batch["block"], "id": batch["id"], "n": counts.sum(axis=1), "lp": pa.array(lp, pa.binary()).take(coded.indices)}
            )

    asked = words.select("word", "block", "id", *by).mapInArrow(score_words, "block long, id int, n long, lp binary")
    asked = asked.selectExpr("block", "0 AS kind", "id", "n", "lp", "CAST(NULL AS bigint) AS doc_id", "CAST(NULL AS boolean) AS held_out", "CAST(NULL AS bigint) AS n_bytes", "CAST(NULL AS binary) AS ids")
    texts = blocks.where("kind = 1").selectExpr("block", "kind", "id", "CAST(NULL AS bigint) AS n", "CAST(NULL AS binary) AS lp", "doc_id", "held_out", "n_bytes", "ids")
    log_prior = np.log10(prior)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, logs, fresh = [], [], True
        base = known = lp = None
        for batch in batches:
            kind = batch["kind"].to_numpy()
            cuts = np.r_[0, np.flatnonzero(kind[1:] != kind[:-1]) + 1, len(kind)]
            for a, z in zip(cuts[:-1], cuts[1:], strict=True):
                part = batch.slice(a, z - a)
                if not part.num_rows:
                    continue
                if kind[a] == 0:
                    if not fresh:
                        counts, logs, fresh = [], [], True
                    counts.append(part["n"].to_numpy())
                    logs.append(np.frombuffer(b"".join(part["lp"].to_pylist()), dtype=np.float32).reshape(-1, g))
                    continue
                if fresh:
                    c = np.concatenate(counts)
                    base, known, lp, fresh = np.log10((c + 0.5) / (n + 0.5 * (v + 1))), c > 0, np.concatenate(logs), False
                out = []
                for raw, size in zip(part["ids"].to_pylist(), part["n_bytes"].to_pylist(), strict=True):
                    ids = unpack(raw)
                    share, own = own_words(ids)
                    with np.errstate(divide="ignore"):
                        from_own = np.log(share * own)
                    known_before = np.log1p(-share)[:, None] + LN10 * lp[ids].astype(np.float64)
                    under = log_prior + np.logaddexp(known_before, from_own[:, None]).sum(axis=0) / LN10
                    top = under.max()
                    s = float(top + np.log10((10.0 ** (under - top)).sum()))
                    out.append((len(ids), int(known[ids].sum()), float(base[ids].sum()), s, -s / np.log10(2) / size if size else None))
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part["doc_id"], "held_out": part["held_out"], "n_tokens": pa.array(cols[0], pa.int64()),
                        "n_known": pa.array(cols[1], pa.int64()), "train_tokens": np.full(part.num_rows, n, dtype=np.int64),
                        "base_score": pa.array(cols[2], pa.float64()), "score": pa.array(cols[3], pa.float64()),
                        "bits_per_byte": pa.array(cols[4], pa.float64()),
                    }
                )

    both = asked.unionByName(texts).repartition("block").sortWithinPartitions("block", "kind", "id")
    return both.mapInArrow(
        look_up, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
    )


def op4_context_mixing_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_texts(docs.withColumn("held_out", fold("doc_id", 5) == 1))
