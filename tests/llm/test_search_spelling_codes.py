"""Operators 11 to 13 against plain versions, and their edge cases."""

import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import pytest

from checks.compare import connect, differences
from plyscope.llm import search, spelling, vector_codes
from plyscope.llm.registry import ORACLES, QUERIES

VECTORS = "vec_id long, embedding array<float>, label int, same string, v int, nid int, lists int, best int"


def vectors_frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "s", 1, 2, 3, 4) for i, v, label in rows], VECTORS)


# 11: nearest neighbours


def plain_nearest(rows, k, every):
    """{query_id: [(vec_id, score)]} over rows (id, vector) with one vector per id."""
    ok = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok[i] = np.float32(v).astype(np.float64)
    dims = max(map(len, ok.values()), default=0)
    ok = {i: np.pad(v, (0, dims - len(v))) for i, v in ok.items()}
    out = {}
    for q in ok:
        if q % every == 0:
            near = sorted((-(ok[q] * v).sum(), i) for i, v in ok.items() if i != q)
            out[q] = [(i, -s) for s, i in near[:k]]
    return out


def found_nearest(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_nearest_neighbours_reach_their_recall(spark):
    sf = "/root/testdata/sf0.01"
    got = found_nearest(QUERIES["op11_balanced_posting_lists"](spark, sf))
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{sf}/embeddings.parquet'").fetchall()
    want = plain_nearest(rows, 20, 20)
    assert got.keys() == want.keys() and all(len(x) == 20 for x in got.values())
    scores = {q: dict(x) for q, x in plain_nearest(rows, len(rows), 20).items()}
    assert all(abs(scores[q][i] - s) < 1e-12 for q, x in got.items() for i, s in x)
    assert all(x == sorted(x, key=lambda r: (-r[1], r[0])) for x in got.values())
    share = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) / sum(map(len, want.values()))
    assert share >= 0.9


@pytest.fixture(scope="module")
def clustered():
    """Clusters of very different lengths, a large group of equal vectors, and near copies."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 8)) * rng.uniform(0.2, 4, size=(12, 1))
    x = np.concatenate([c + 0.1 * rng.normal(size=(40, 8)) for c in centres] + [np.tile(centres[0], (200, 1)), centres[1] + 1e-4 * rng.normal(size=(150, 8))])
    return [(i, v.tolist()) for i, v in enumerate(x[rng.permutation(len(x))].astype(np.float32))]


@pytest.mark.parametrize("block", [7, 8192])
def test_blocks_change_no_answer(spark, clustered, block):
    frame = vectors_frame(spark, [(i, v, None) for i, v in clustered])
    got = found_nearest(search.nearest(frame, "vec_id % 10 = 0", k=5, recall=1.0, block=block))
    want = plain_nearest(clustered, 5, 10)
    assert got.keys() == want.keys()
    alike = [{i for i, _ in got[q]} == {i for i, _ in want[q]} for q in want]
    assert sum(alike) >= 0.95 * len(want)
    # Equal vectors tie, and the smallest ids are among the answers.
    for q, x in got.items():
        assert q not in {i for i, _ in x} and len(x) == 5
        assert x == sorted(x, key=lambda r: (-r[1], r[0]))
    copies = sorted(i for i, v in clustered if sum(w == v for _, w in clustered) > 1)
    q = next(i for i in copies if i % 10 == 0)
    ties = [i for i, s in want[q]]
    assert [i for i, _ in got[q]] == ties


def test_nearest_of_few_and_broken_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (10, [1.0, 0.0], 1), (20, [2.0], 1), (3, [-1.0, 5.0], None), (5, [0.5, 0.5], 0),
        (40, None, 1), (60, [], 1), (80, [0.0, -0.0], 1), (100, [nan, 1.0], 1), (120, [inf, 1.0], 1), (140, [None, 1.0], 1), (None, [9.0, 9.0], 1),
    ]
    got = found_nearest(search.nearest(vectors_frame(spark, rows), "vec_id % 20 = 0"))
    assert got == {0: [(20, 2.0), (10, 1.0), (5, 0.5), (3, -1.0)], 20: [(0, 2.0), (10, 2.0), (5, 1.0), (3, -2.0)]}
    assert search.nearest(vectors_frame(spark, []), "vec_id % 20 = 0").collect() == []
    assert search.nearest(vectors_frame(spark, [(20, [1.0], 1)]), "vec_id % 20 = 0").collect() == []


def test_the_graph_finds_the_lists(clustered):
    x = np.array([v for _, v in clustered], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1).max()
    lists = search.fit(x, 10_000, 1.0)
    sizes = np.bincount(search.split(lists.lifted(x), len(lists.centroids)))
    assert sizes.max() <= sizes.min() + 2  # balanced
    for query in (False, True):
        own = lists.lifted(x[:100], query)
        d = np.sqrt(np.maximum(((own[:, None] - lists.centroids) ** 2).sum(axis=2), 0)) + 1e-9
        want = {(i, j) for i, j in zip(*np.nonzero(d <= 1.2 * d.min(axis=1, keepdims=True)), strict=True)}
        row, node, _ = lists.look(own, 1.2)
        assert len(set(zip(row, node, strict=True)) & want) >= 0.98 * len(want)


# 12: spelling


def plain_groups(texts, every=97, shortest=5, least=3):
    """The contract read literally, pair by pair. `texts`: (id, text)."""
    counts = Counter()
    for doc, text in texts:
        run = ""
        for c in (text or "") + " ":
            if "a" <= c <= "z" or "A" <= c <= "Z" or "À" <= c <= "ÿ":
                run += c.lower() if c.isascii() else c
            elif run:
                h = spelling.crc32(f"{'' if doc is None else doc}:{run}".encode())
                counts[run if h % every else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
                run = ""
    n = {w: c for w, c in counts.items() if len(w) >= shortest and c >= least}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    around = {w: [x for x in n if near(w, x)] for w in n}
    form = {}
    for w, others in around.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(around[w]), n.get(form[w])))
    return out


def groups(spark, texts, **options):
    frame = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in texts], "doc_id long, text string, letters string, n int, word int")
    return {tuple(r) for r in spelling.spelling_groups(frame, **options).select("word", "form", "root", "n", "n_near", "form_n").collect()}


def garbled(seed, words=60, texts=120):
    rng = random.Random(seed)
    base = ["".join(rng.choices("abcdé", k=rng.randint(4, 8))) for _ in range(words)]

    def typo(w):
        i = rng.randrange(len(w))
        return rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("abÀÿ") + w[i:], w[:i] + rng.choice("xyz") + w[i + 1 :], w, w, w.upper()])

    return [(i, " ".join(typo(rng.choice(base)) + rng.choice(["", "!", "-", "Ā"]) for _ in range(60))) for i in range(texts)]


@pytest.mark.parametrize("cell, block", [(8192, 32768), (8, 5), (3, 10**6)])
def test_spelling_groups_equal_the_plain_version(spark, monkeypatch, cell, block):
    monkeypatch.setattr(spelling.near_words, "__defaults__", (cell, block, 65536))
    monkeypatch.setattr(spelling, "LEAF", 3)
    texts = garbled(1)
    want = plain_groups(texts)
    assert any(f and f != root for _, f, root, *_ in want) and len(want) > 100
    assert groups(spark, texts) == want


def test_spelling_equals_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert differences(QUERIES["op12_kd_tree_spelling"](spark, sf), connect(sf), ORACLES["op12_kd_tree_spelling"]) == []


def test_spelling_edge_cases(spark):
    long = "ab" * 40_000
    texts = [
        (None, "hello Hello HELLO hellos hellos hellos"), (None, "hello hello hello"), (1, None), (2, ""), (3, "5 ? 中 İ ab"),
        (4, f"{long} {long} {long}x {long} {long}x {long}x"), (4, "cafÉs cafÉs cafÉs cafés cafés cafés"),
        (5, "××××× " * 3),
    ]
    assert groups(spark, texts, every=2**33) == plain_groups(texts, every=2**33)
    assert groups(spark, texts, every=1) == plain_groups(texts, every=1)
    assert groups(spark, texts + texts) == plain_groups(texts + texts)
    assert groups(spark, []) == set() and groups(spark, [(1, None)]) == set()


def test_letters_lost_per_axis():
    tree = spelling.KdTree(spelling.letter_counts(np.array([[97, 97, 98], [97, 98, 98], [99, 99, 99]], dtype=np.uint8)), 1)
    assert sorted(tree.order.tolist()) == [0, 1, 2] and len(tree.starts) == 3


# 13: vector codes


def plain_codes(rows, scale=256, parts=16, entries=64, rounds=2):
    """{(vec_id, code, error, label_error)} and the digest by comparing with every entry."""
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = max(1, -(-max((len(v) for _, v, _ in kept), default=0) // parts))
    whole = [[int(np.floor(scale * float(np.float32(x)))) for x in v] + [0] * (parts * width - len(v)) for _, v, _ in kept]
    first = {}
    for (i, v, _), w in zip(kept, whole, strict=True):
        key = (i is None, i or 0)
        raw = [float(np.float32(x)) for x in v] + [0.0] * (parts * width - len(v))
        if key not in first or raw < first[key][0]:
            first[key] = (raw, w)
    seeds = [first[k][1] for k in sorted(first)[:entries]]
    books = [[w[p * width : (p + 1) * width] for w in seeds] for p in range(parts)]

    def assign():
        for w in whole:
            out = []
            for p in range(parts):
                x = w[p * width : (p + 1) * width]
                out.append(min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(books[p])))
            yield w, out

    for _ in range(rounds):
        sums = [{} for _ in range(parts)]
        for w, out in assign():
            for p, (_, k) in enumerate(out):
                sums[p].setdefault(k, []).append(w[p * width : (p + 1) * width])
        for p in range(parts):
            for k, xs in sums[p].items():
                books[p][k] = [sum(c) // len(xs) for c in zip(*xs, strict=True)]
    coded = [("".join(f"{k:02x}" for _, k in out), sum(d for d, _ in out)) for _, out in assign()]
    by_label = Counter()
    for (_, _, label), (_, error) in zip(kept, coded, strict=True):
        by_label[label] += error
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return Counter((i, code, error, by_label[label], digest) for (i, _, label), (code, error) in zip(kept, coded, strict=True))


def codes(spark, rows, **options):
    return Counter(tuple(r) for r in vector_codes.compress(vectors_frame(spark, rows), **options).collect())


def test_codes_equal_the_plain_version(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), rng.normal(size=35).astype(np.float32).tolist(), [None, 1, 2][i % 3]) for i in rng.permutation(150)]
    rows += rows[:20] + [(rows[0][0], [0.5] * 35, 7), (None, [0.25] * 3, None)]
    assert codes(spark, rows) == plain_codes(rows)


def test_codes_equal_their_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert differences(QUERIES["op13_cover_tree_codes"](spark, sf), connect(sf), ORACLES["op13_cover_tree_codes"]) == []


def test_codes_of_few_equal_and_broken_rows(spark):
    nan = float("nan")
    rows = [(5, [1.0] * 16, 1), (1, [1.0] * 16, None), (2, [-0.001] * 16, None), (3, None, 1), (4, [nan] * 16, 1), (6, [None] * 16, 1), (7, [], 2)]
    assert codes(spark, rows) == plain_codes(rows)
    assert codes(spark, []) == Counter() and codes(spark, [(1, None, 1)]) == Counter()
    assert codes(spark, [(1, [], 1)]) == plain_codes([(1, [], 1)])
    far = codes(spark, [(1, [3e38] * 64, 1), (2, [-3e38] * 64, 1), (3, [0.0] * 64, 1)], entries=1)
    assert len(far) == 3 and all(0 <= error < 2**63 for _, _, error, *_ in far)


def test_trees_settle_whole_subtrees():
    rng = np.random.default_rng(1)
    book = rng.integers(-500, 500, size=(20, 4))
    points = book[rng.integers(0, 20, size=4000)] + rng.integers(-3, 4, size=(4000, 4))
    order, nodes, radii = vector_codes.cover_tree(points)
    assert sorted(order.tolist()) == list(range(4000))
    tree = vector_codes.Cover(points[order], nodes, radii)
    want = vector_codes.squares(points[order], book).argmin(axis=1)
    assert (tree.codes(book) == want).all()
    assert len(tree.assign(book)[2]) < 400  # points compared one by one
    totals = tree.totals(book)
    assert (totals[:, 0] == np.bincount(want, minlength=20)).all()
    assert all((totals[k, 1:] == points[order][want == k].sum(axis=0)).all() for k in range(20))
    for start, end, child, children in nodes:
        own = points[order[start:end]]
        if children:
            heads = points[order[nodes[child : child + children, 0]]]
            widest = ((own - own[0]) ** 2).sum(axis=1).max()
            apart = vector_codes.squares(heads, heads)[~np.eye(children, dtype=bool)]
            assert (apart > widest / 4).all()  # more than half the radius
            assert (vector_codes.squares(own, heads).min(axis=1) <= widest / 4).all()


def test_equal_entries_go_to_the_first():
    points = np.array([[5, 5], [5, 6], [0, 0]])
    order, nodes, radii = vector_codes.cover_tree(points)
    book = np.array([[9, 9], [5, 5], [5, 5], [0, 0], [0, 0]])
    codes = vector_codes.Cover(points[order], nodes, radii).codes(book)
    assert codes[np.argsort(order)].tolist() == [1, 1, 3]
