"""Spelling variants: words one edit apart, found by k-d trees over their letter counts.

One inserted or deleted letter moves the vector of letter counts by one, one replaced letter
by two: one count up and one down. So words near a word lie in a small box around its counts.
A k-d tree over a bounded sample cuts the words of each length into cells that hold about
equally many; a word visits the cells of its own length and of the next longer one that the
box reaches, and inside a cell a second tree prunes by box again. Pairs whose counts fit are
then held letter by letter.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyscope.llm.common import byte_texts, runs, table
from plyscope.session import land

#: Latin-1 letters lower-cased as the words want it; anything else is a space.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 192 else 32 for c in range(256))
#: Letters as Latin-1 bytes to axes of the count vector.
AXES = np.zeros(256, dtype=np.int64)
AXES[97:123] = np.arange(26)
AXES[192:256] = np.arange(26, 90)
DIMS = 90
LEAF = 32
#: Words a cell is meant to hold, words at which a cell is dealt in blocks, words in the sample.
CELL, BLOCK, SAMPLE = 8192, 32768, 65536
#: Numbers in one comparison of rows.
CHUNK = 1 << 24
HELD = 200_000


def count_words(batches: Iterator[pa.RecordBatch], every: int, shortest: int) -> Iterator[pa.RecordBatch]:
    """Words (Latin-1) with their counts, folded over many texts of a task."""
    total: defaultdict[bytes, int] = defaultdict(int)

    def out() -> pa.RecordBatch:
        kept = {w: n for w, n in total.items() if len(w) >= shortest}
        total.clear()
        return pa.RecordBatch.from_pydict({"letters": pa.array(kept.keys(), pa.binary()), "n": pa.array(kept.values(), pa.int64())})

    for batch in batches:
        for doc, text in zip(byte_texts(batch["doc"]), batch["text"].to_pylist(), strict=True):
            head = crc32(doc + b":")
            # What Latin-1 lacks becomes a question mark, which ends a run as well.
            for run, n in Counter(text.encode("latin-1", "replace").translate(LETTERS).split()).items():
                if len(run) >= shortest:
                    h = crc32(run if run.isascii() else run.decode("latin-1").encode(), head)
                    if not h % every:
                        run = run[: h % len(run)] + run[h % len(run) + 1 :]
                    total[run] += n
            if len(total) >= HELD:
                yield out()
    yield out()


def as_matrix(words: np.ndarray, length: int) -> np.ndarray:
    return np.frombuffer(b"".join(words), dtype=np.uint8).reshape(len(words), length)


def letter_counts(letters: np.ndarray) -> np.ndarray:
    n, length = letters.shape
    flat = (np.arange(n)[:, None] * DIMS + AXES[letters]).ravel()
    counts = np.bincount(flat, minlength=n * DIMS).reshape(n, DIMS)
    return counts.astype(np.int8 if length < 128 else np.int64)


def thermometers(counts: np.ndarray) -> np.ndarray:
    """Two bits per axis, set for a count of one and of two, as 64-bit words. The set bits that
    one vector has and another lacks are never more than its counts are above the other's."""
    bits = np.zeros((len(counts), 192), dtype=bool)
    bits[:, :DIMS], bits[:, 96 : 96 + DIMS] = counts > 0, counts > 1
    return np.packbits(bits, axis=1).view(np.uint64)


def beyond(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The number of bits of `a` that `b` lacks."""
    return np.bitwise_count(a & ~b).sum(axis=1, dtype=np.int64)


class KdTree:
    """Median cuts of count vectors; leaves are ranges of `order`."""

    def __init__(self, points: np.ndarray, limit: float):
        """`limit`: points a leaf may hold, unless they are all equal."""
        self.order = np.arange(len(points))
        self.nodes = [[-1, 0, 0, 0]]  # axis (-1: leaf), cut, left child (right is next), leaf's number
        self.starts, self.ends = [], []
        stack = [(0, 0, len(points))]
        while stack:
            node, start, end = stack.pop()
            own = points[self.order[start:end]]
            axis, cut = self._cut(own) if end - start > limit else (-1, 0)
            if axis < 0:
                self.nodes[node][3] = len(self.starts)
                self.starts.append(start)
                self.ends.append(end)
                continue
            right = own[:, axis] > cut
            self.order[start:end] = self.order[start:end][np.argsort(right, kind="stable")]
            middle = end - int(right.sum())
            self.nodes[node][:3] = [axis, cut, len(self.nodes)]
            stack += [(len(self.nodes) + 1, middle, end), (len(self.nodes), start, middle)]  # leaves number from left to right
            self.nodes += [[-1, 0, 0, 0], [-1, 0, 0, 0]]
        self.nodes = np.array(self.nodes, dtype=np.int64)
        self.starts, self.ends = np.array(self.starts), np.array(self.ends)

    @staticmethod
    def _cut(own: np.ndarray) -> tuple[int, int]:
        """The axis and value that halve the points best; -1 if all are equal."""
        best, axis, at = 0, -1, 0
        spread = own.var(axis=0, dtype=np.float64)
        for a in np.argsort(-spread, kind="stable")[:8]:
            if not spread[a]:
                break
            middle = int(np.median(own[:, a]))
            for cut in (middle - 1, middle):
                over = int((own[:, a] > cut).sum())
                if min(over, len(own) - over) > best:
                    best, axis, at = min(over, len(own) - over), int(a), cut
        return axis, at

    def reached(self, points: np.ndarray, down: int) -> tuple[np.ndarray, np.ndarray]:
        """(point, leaf) for the leaves whose box holds the point itself with one count more
        and `down` counts less, or is that near."""
        found = []
        row, node = np.arange(len(points)), np.zeros(len(points), dtype=np.int64)
        up, less = np.zeros((2, len(points)), dtype=np.int64)
        while len(row):
            axis, cut, child, leaf = self.nodes[node].T
            ended = axis < 0
            found.append((row[ended], leaf[ended]))
            row, up, less, axis, cut, child = (x[~ended] for x in (row, up, less, axis, cut, child))
            at = points[row, axis].astype(np.int64)
            left = less + np.maximum(at - cut, 0)
            right = up + np.maximum(cut + 1 - at, 0)
            to_left, to_right = left <= down, right <= 1
            row = np.r_[row[to_left], row[to_right]]
            node = np.r_[child[to_left], child[to_right] + 1]
            up, less = np.r_[up[to_left], right[to_right]], np.r_[left[to_left], less[to_right]]
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (row, node)

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), dtype=np.int64)
        while True:
            axis, cut, child, leaf = self.nodes[node].T
            inner = axis >= 0
            if not inner.any():
                return leaf
            over = points[np.arange(len(points)), np.maximum(axis, 0)] > cut
            node = np.where(inner, child + over, node)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of letters are one replaced letter apart, or one inserted into `a`."""
    length = a.shape[1]
    if b.shape[1] == length:
        return (a != b).sum(axis=1) == 1

    def alike(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        differ = x != y
        return np.where(differ.any(axis=1), differ.argmax(axis=1), length)

    return alike(a, b[:, :length]) + alike(a[:, ::-1], b[:, :0:-1]) >= length


def near_pairs(words: np.ndarray, targets: np.ndarray, tree: KdTree, points: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word, target) pairs one edit apart; targets are as long as the words, or by one longer.

    `tree` is over the targets' counts, whose thermometers are `points`, in the tree's order.
    """
    down = int(words.shape[1] == targets.shape[1])
    low, high = (f.reduceat(points, tree.starts) for f in (np.bitwise_and, np.bitwise_or))
    targets = targets[tree.order]
    step = max(1, CHUNK // max(DIMS * 64, words.shape[1]))
    width = max(1, CHUNK // (8 * targets.shape[1]))
    for first in range(0, len(words), step):
        counts = letter_counts(words[first : first + step])
        own = thermometers(counts)
        row, leaf = tree.reached(counts, down)
        fits = (beyond(low[leaf], own[row]) <= 1) & (beyond(own[row], high[leaf]) <= down)
        row, leaf = row[fits], leaf[fits]
        sizes = tree.ends[leaf] - tree.starts[leaf]
        total = np.cumsum(sizes)
        # Pairs are made a bounded number at a time, even where equal counts make one leaf large.
        for k in range(0, int(total[-1]) if len(total) else 0, width):
            pair = np.arange(k, min(k + width, int(total[-1])))
            of = np.searchsorted(total, pair, side="right")
            i, j = row[of], tree.ends[leaf[of]] - (total[of] - pair)
            close = np.flatnonzero((beyond(points[j], own[i]) <= 1) & (beyond(own[i], points[j]) <= down))
            i, j = i[close] + first, j[close]
            true = one_edit(words[i], targets[j])
            yield i[true], tree.order[j[true]]


def meet_in_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of every cell, each in both directions."""
    for (length, *_), t in runs(batches, ["length", "cell", "block"]):
        role, letters, n = t["role"], t["letters"], t["n"]
        own = role == 0
        if not own.any():
            continue
        targets, target_n = as_matrix(letters[own], length), n[own]
        counts = letter_counts(targets)
        tree = KdTree(counts, LEAF)
        points = thermometers(counts[tree.order])
        for kind in (0, 1, 2):
            asking = role == kind
            if not asking.any():
                continue
            words, word_n, names = as_matrix(letters[asking], length - (kind == 2)), n[asking], letters[asking]
            for a, b in near_pairs(words, targets, tree, points):
                there, back = (names[a], word_n[a]), (letters[own][b], target_n[b])
                ways = [(there, back)] if kind == 0 else [(there, back), (back, there)]
                for (word, _), (other, other_n) in ways:
                    yield pa.RecordBatch.from_pydict(
                        {"letters": pa.array(word, pa.binary()), "other": pa.array(other, pa.binary()), "other_n": other_n}
                    )


def near_words(words: DataFrame, cell: int = CELL, block: int = BLOCK, sample: int = SAMPLE) -> DataFrame:
    """letters, other, other_n: all pairs of `words` (letters, n) one edit apart, both ways.

    The trees come from about `sample` words chosen by hash; all words are placed and searched.
    A cell that holds over `block` words all the same is dealt in blocks, each of which meets
    all words that ask for the cell.
    """
    spark, n = words.sparkSession, words.count()
    slots = 1 << 30
    some = words.where(F.expr(f"pmod(xxhash64(letters), {slots})") < F.lit(slots * min(1.0, sample / max(n, 1))))
    drawn: dict[int, list[bytes]] = {}
    for (letters,) in some.select("letters").collect():
        drawn.setdefault(len(letters), []).append(bytes(letters))
    rate = n / max(sum(map(len, drawn.values())), 1)
    trees = {k: KdTree(letter_counts(as_matrix(sorted(x), k)), cell / rate) for k, x in drawn.items() if len(x) * rate > cell}
    shared = spark.sparkContext.broadcast(trees)

    def placed(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray | None, np.ndarray]]:
        """By length: the letters and their counts (where a tree needs them), and the cells."""
        letters = np.empty(batch.num_rows, dtype=object)
        letters[:] = batch["letters"].to_pylist()
        lengths = np.fromiter(map(len, letters), dtype=np.int64, count=len(letters))
        for length in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == length)
            tree = shared.value.get(length)
            counts = letter_counts(as_matrix(letters[rows], length)) if tree or length + 1 in shared.value else None
            yield length, rows, letters[rows], counts, tree.leaf_of(counts) if tree else np.zeros(len(rows), dtype=np.int64)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, _, _, _, cells in placed(batch):
                cells, k = np.unique(cells, return_counts=True)
                yield pa.RecordBatch.from_pydict({"length": np.full(len(k), length), "cell": cells, "k": k})

    held = words.select("letters").mapInArrow(tally, "length long, cell long, k long").groupBy("length", "cell").agg(F.sum("k").alias("k"))
    large = {(r.length, r.cell): -(-r.k // block) for r in held.where(F.col("k") > block).collect()}
    blocks = spark.sparkContext.broadcast(large)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(length: int, cell, block, role: int, letters, n) -> pa.RecordBatch:
            k = len(letters)
            return pa.RecordBatch.from_pydict(
                {
                    "length": np.full(k, length), "cell": cell, "block": block, "role": np.full(k, role, dtype=np.int32),
                    "letters": pa.array(letters, pa.binary()), "n": n,
                }
            )

        def to_blocks(length: int, row: np.ndarray, cell: np.ndarray, after: np.ndarray, role: int, letters, n):
            """Rows that ask for a cell, once for each of its blocks beyond `after`."""
            of = np.fromiter((blocks.value.get((length, c), 1) for c in cell.tolist()), dtype=np.int64, count=len(cell))
            for b in range(int(of.max(initial=0))):
                asks = (of > b) & (after < b)
                if asks.any():
                    yield rows(length, cell[asks], np.full(int(asks.sum()), b), role, letters[row[asks]], n[row[asks]])

        for batch in batches:
            numbers = batch["n"].to_numpy()
            for length, at, letters, counts, cells in placed(batch):
                n, everyone = numbers[at], np.arange(len(at))
                of = np.fromiter((blocks.value.get((length, c), 1) for c in cells.tolist()), dtype=np.int64, count=len(cells))
                block = np.fromiter(map(crc32, letters), dtype=np.int64, count=len(letters)) % of
                yield rows(length, cells, block, 0, letters, n)
                yield from to_blocks(length, everyone, cells, block, 1, letters, n)
                tree, longer = shared.value.get(length), shared.value.get(length + 1)
                if tree:
                    row, cell = tree.reached(counts, 1)
                    later = cell > cells[row]  # the other cell's words come the other way
                    yield from to_blocks(length, row[later], cell[later], np.full(int(later.sum()), -1), 1, letters, n)
                row, cell = longer.reached(counts, 0) if longer else (everyone, np.zeros(len(at), dtype=np.int64))
                yield from to_blocks(length + 1, row, cell, np.full(len(row), -1), 2, letters, n)

    keys = ["length", "cell", "block"]
    dealt = words.mapInArrow(deal, "length long, cell long, block long, role int, letters binary, n long")
    dealt = dealt.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(meet_in_cells, "letters binary, other binary, other_n long")


def spelling_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", every: int = 97, shortest: int = 5, least: int = 3, factor: int = 2
) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of the texts that is frequent enough.

    Words are runs of a-z and U+00C0 to U+00FF after A-Z are lower-cased. Where `every` divides
    the crc32 of `<doc_id>:<run>`, the run loses the letter at that hash modulo its length. A
    word has at least `shortest` letters and `least` occurrences. Near words differ by one
    inserted, deleted or replaced letter. A word's form is its near word of largest n (ties:
    smallest in code-point order) if that has at least `factor` times its n; root is where the
    chain of forms ends, the word itself if it has none.

    Null texts have no words, a null id counts as empty; repeated rows count again; texts and
    runs of any length are taken whole. Other columns are not looked at. Without words there
    are no rows.
    """
    docs = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("doc"), F.col(text).alias("text")).where("text IS NOT NULL")
    counted = docs.mapInArrow(lambda batches: count_words(batches, every, shortest), "letters binary, n long")
    words = land(counted.groupBy("letters").agg(F.sum("n").alias("n")).where(F.col("n") >= least), "words")
    # Least (-n, letters) is the largest n and among these the smallest word: Latin-1 sorts as code points do.
    near = near_words(words).groupBy("letters").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")
    )
    formed = words.join(near, "letters", "left").selectExpr(
        "letters", "n", "coalesce(n_near, 0L) AS n_near",
        f"CASE WHEN -best.less >= {int(factor)} * n THEN best.other END AS form", f"CASE WHEN -best.less >= {int(factor)} * n THEN -best.less END AS form_n",
    )
    formed = land(formed, "forms")
    roots = _followed(formed.where("form IS NOT NULL").selectExpr("letters AS v", "form AS p"))
    out = formed.join(roots.withColumnsRenamed({"v": "letters", "p": "root"}), "letters", "left")
    named = {c: f"decode({x}, 'ISO-8859-1') AS {c}" for c, x in (("word", "letters"), ("form", "form"), ("root", "coalesce(root, letters)"))}
    return out.selectExpr(*named.values(), "n", "n_near", "form_n")


def _followed(pointers: DataFrame) -> DataFrame:
    """Every pointer (v, p) followed to its end. Each round doubles the steps, and a form has at
    least twice the count, so there are at most about six rounds."""
    pointers = land(pointers, "pointers")
    while True:
        over = pointers.selectExpr("v AS p", "p AS q")
        moved = land(pointers.join(over, "p", "left").selectExpr("v", "coalesce(q, p) AS p", "q IS NOT NULL AS moved"), "pointers")
        pointers = moved.select("v", "p")
        if moved.where("moved").isEmpty():
            return pointers


def op12_kd_tree_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(table(spark, sf_dir, "documents"))


OP12_SQL = """
WITH RECURSIVE bits(i, k, c) AS (
  SELECT i, 0, i FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
found AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL),
hashed AS (
  SELECT run, k, xor(list_reduce(
    list_prepend(4294967295, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
      lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [195, CAST(unicode(c) - 64 AS BIGINT)] END))),
    lambda h, b: xor(h >> 8, t[1 + (xor(h, b) & 255)])), 4294967295) AS h
  FROM found, crc),
cut AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, 2 + h % length(run)) ELSE run END AS word, k FROM hashed),
w AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM cut WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
d AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM d a JOIN d b ON a.i = b.i AND a.less = b.less AND a.word <> b.word
  UNION SELECT d.word, w.word, w.n FROM d JOIN w ON d.less = w.word
  UNION SELECT w.word, d.word, d.n FROM d JOIN w ON d.less = w.word),
best AS (SELECT word, count(*) AS n_near, min(struct_pack(less := -other_n, other := other)) AS b FROM near GROUP BY word),
f AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.less >= 2 * n THEN b.other END AS form,
    CASE WHEN -b.less >= 2 * n THEN -b.less END AS form_n
  FROM w LEFT JOIN best ON best.word = w.word),
r(word, tip) AS (SELECT word, word FROM f UNION ALL SELECT r.word, f.form FROM r JOIN f ON f.word = r.tip WHERE f.form IS NOT NULL)
SELECT f.word, f.form, r.tip AS root, f.n, f.n_near, f.form_n
FROM f JOIN r ON r.word = f.word JOIN f g ON g.word = r.tip AND g.form IS NULL
"""
