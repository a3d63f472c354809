"""Operators on documents against brute force, and on odd input: nulls, empty and very long
texts, ties, repeated rows, empty tables, extra columns of clashing names."""

import hashlib
import math
import random
import re
import string
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.compare import connect, differences
from plyscope.llm import chat, decontaminate, langid, lm, mixing, neardup, quality, sharding
from plyscope.llm.common import components, fold
from plyscope.llm.registry import ORACLES, QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def vocabulary(seed, n=60):
    rnd = random.Random(seed)
    letters = {"en": "etaoinsh", "fr": "éèaulcr", "de": "ßüönktz"}
    return {l: ["".join(rnd.choice(c) for _ in range(rnd.randint(2, 7))) for _ in range(n)] for l, c in letters.items()}


def corpus(n=160, seed=1):
    rnd, words = random.Random(seed), vocabulary(seed)
    rows = []
    for i in range(n):
        lang = rnd.choice(["en", "en", "fr", "de"])
        body = [rnd.choice(words[lang]) for _ in range(rnd.randint(5, 120))]
        if rows and rnd.random() < 0.25:
            old = rows[rnd.randrange(len(rows))]
            lang, body = old[2], old[1].split(" ")
            for _ in range(rnd.randint(0, 3)):
                body[rnd.randrange(len(body))] = rnd.choice(words[lang])
        text = " ".join(body)
        rows.append((i, text, lang, f"s{i % 3}", len(text)))
    return rows


#: Every odd case at once; ids 900 and up.
ODD = [
    (900, None, "en", "s0", None),
    (901, "", None, None, 0),
    (902, " \n\t ", "fr", "s0", 4),
    (903, "One", "de", None, 3),
    (904, "ONE", "de", "s1", 3),
    (905, "12 345 -- !!", "en", "s1", 12),
    (906, "long words " * 20000, "en", "s2", 220000),
    (906, "long words " * 20000, "en", "s2", 220000),
    (None, "no id here at all but some words to go on with for a while", "en", "s0", 58),
    (907, "é è \U0001f600 ｗｉｄｅ", None, "s0", 10),
]


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="module")
def rows():
    return corpus() + ODD


@pytest.fixture(scope="module")
def docs(spark, rows):
    """The rows, with columns whose names operators use inside."""
    return frame(spark, rows).withColumns({c: F.lit("x") for c in ("node", "row", "bands", "m", "at", "weight", "topic", "block")})


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_oracle(spark, sf, con, name):
    assert differences(QUERIES[name](spark, sf), con, ORACLES[name]) == []


@pytest.mark.parametrize("name", [n for n in QUERIES if re.match(r"op(1|2|3|4|6|9|10)_", n)])
def test_a_row_for_every_document(spark, sf, name):
    assert QUERIES[name](spark, sf).count() == spark.read.parquet(f"{sf}/documents.parquet").count()


# --- components ---------------------------------------------------------------


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(50, 90)]
    star = [(7, i) for i in range(100, 160)] + [(3, 120), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain + star, "a long, b long")).collect()}
    assert all(got[i] == 50 for i in range(50, 91)) and all(got[i] == 3 for i in (3, 7, *range(100, 160)))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- quality ------------------------------------------------------------------


def test_interactions_by_squares_equal_all_pairs():
    rng = np.random.default_rng(0)
    machine = quality.Machine(0.3, rng.normal(size=quality.WIDTH), rng.normal(size=(quality.WIDTH, 4)))
    ids, x = quality.features(b"Some words, some more words.\nAnd 12 more", 40)
    v = machine.factors[ids] * x[:, None]
    pairs = sum(float(v[i] @ v[j]) for i in range(len(ids)) for j in range(i))
    assert math.isclose(machine.margin(ids, x), 0.3 + machine.linear[ids] @ x + pairs, rel_tol=1e-6)


def test_quality_on_held_out_rows(spark, sf):
    sf = sf.replace("sf0.001", "sf0.01")
    got = {r.doc_id: r for r in QUERIES["op1_factorisation_quality"](spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    right = [(got[l.doc_id].predicted == l.quality) for l in labels if got[l.doc_id].held_out]
    assert sum(right) >= 0.85 * len(right)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())


def test_quality_of_odd_rows(spark, docs, none):
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(3, 0), (None, 1), (5, None)], "doc_id long, quality int")
    machine = quality.train(docs, labels)
    scored = quality.score_quality(docs, machine).select("doc_id", "score").collect()
    assert len(scored) == docs.count() and all(0 <= r.score <= 1 for r in scored)
    assert quality.score_quality(none, machine).count() == 0
    assert quality.train(none, labels).bias == 0 and quality.train(docs, labels.where("quality = 1")).bias > 0


# --- language -----------------------------------------------------------------


def test_language_on_held_out_rows(spark, docs, rows):
    model = langid.train(docs.where("doc_id % 3 <> 0"), landmarks_per_language=6)
    got = langid.identify(docs, model).select("doc_id", "lang_pred", "score").collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    want = {r[0]: r[2] for r in rows if r[0] is not None and r[0] < 900}
    held = [r for r in got if r.doc_id in want and r.doc_id % 3 == 0]
    assert sum(r.lang_pred == want[r.doc_id] for r in held) >= 0.95 * len(held)
    of = {r.doc_id: r for r in got}
    assert all(of[i].lang_pred == "und" and of[i].score == 0 for i in (900, 901, 902, 905))
    assert of[907].lang_pred != "und"


def test_symbols_beyond_the_first_plane_are_no_letters(spark, docs):
    texts = ["\U0001f600\U0001f680 \U0001f4a9", "\U0001d7d8", "a\U0001f600b", "\U00020000"]
    assert [bool((langid.points(t) != langid.SPACE).any()) for t in texts] == [False, False, True, True]
    assert (langid.points("a\U0001f600b") == langid.points("a b")).all()
    odd = frame(spark, [(i, t, None, "s", 3) for i, t in enumerate(texts[:2])])
    assert {r.lang_pred for r in langid.identify(odd, langid.train(docs, landmarks_per_language=6)).collect()} == {"und"}


def test_kernel_counts_shared_grams():
    kernel = langid.make_kernel(["aba", "zz"], (1, 2))
    k, lettered = kernel.rows(["Aba!", "", "zz zz"])
    assert lettered.tolist() == [True, False, True]
    assert np.isclose(k[0, 0], 1) and np.isclose(k[2, 1], 1) and 0 < k[1, 1] < 0.5 and k[0, 1] < 0.5


def test_language_without_teachers(spark, docs, none):
    assert langid.train(none) is None and langid.train(docs.where("lang IS NULL")) is None
    assert {r.lang_pred for r in langid.identify(docs, None).collect()} == {"und"}
    assert langid.keep_identified(docs, langid.train(docs)).columns == docs.columns


# --- sharding -----------------------------------------------------------------


@pytest.mark.parametrize("cell_bytes", [1 << 30, 2000])
def test_shards_are_even_and_slots_gapless(spark, docs, rows, cell_bytes):
    got = sharding.shard(docs, n_shards=4, cell_bytes=cell_bytes).collect()
    assert len(got) == len(rows)
    for r in got:
        raw = (r.text or "").encode()
        assert r["size"] == len(raw) + 1 and r.text_crc32 == zlib.crc32(raw)
    total, largest = sum(r["size"] for r in got), max(r["size"] for r in got)
    for s in range(4):
        own = [r for r in got if r.shard == s]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / 4) <= largest + 0.001 * total


def test_a_hot_text_is_cut_between_shards(spark):
    rows = [(i % 50, "the same text" if i % 3 else f"other {i}") for i in range(900)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string")).groupBy("shard").agg(F.sum("size").alias("b")).collect()
    assert len(got) == 8 and max(r.b for r in got) - min(r.b for r in got) <= 28


def test_shards_of_nothing_and_of_one(spark, none):
    assert sharding.shard(none).count() == 0
    assert [(r.shard, r.slot) for r in sharding.shard(frame(spark, ODD[:1])).collect()][0][1] == 0


# --- language model -----------------------------------------------------------


@pytest.fixture(scope="module")
def scored(docs):
    return lm.score_texts(docs.withColumn("held_out", fold("doc_id", 5) == 1)).collect()


def test_base_scores_and_counts(rows, scored):
    held = lambda r: zlib.crc32(str(r[0] if r[0] is not None else "").encode()) % 5 == 1
    split = lambda t: [w for w in re.split(r"[\x20\x09-\x0D]+", (t or "").translate(LOWER)) if w] + [""]
    c = Counter(w for r in rows if not held(r) for w in split(r[1]))
    n, v = sum(c.values()), len(c)
    want = sorted(
        (r[0] if r[0] is not None else -1, len(split(r[1])), sum(c[w] > 0 for w in split(r[1])),
         round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in split(r[1])), 6)) for r in rows
    )
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in scored)
    assert got == want and {r.train_tokens for r in scored} == {n}
    assert all(r.score < 0 and (r.bits_per_byte is None) == (r.doc_id in (900, 901)) for r in scored)


def test_model_beats_the_base_on_held_out_text(scored):
    held = [r for r in scored if r.held_out and r.doc_id is not None and r.doc_id < 900]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_bit_probabilities_sum_to_one():
    """Over all words of one symbol and all longer ones: what is left after each first symbol."""
    words = [b"abc", b"abd", b"", b"xyz"]
    code = lm.make_code(np.bincount(lm.symbols(words)[0], minlength=257))
    assert np.isclose((0.5 ** code.length).sum(), 1)
    counts = np.zeros((len(lm.CONTEXTS), 1 << lm.SLOT_BITS, 2), dtype=np.float32)
    b = lm.expand(words, code)
    for k in range(len(lm.CONTEXTS)):
        np.add.at(counts[k], (lm.slots(b, k, np.zeros(4, int)), b.bit), 1)
    model = lm.Mixer(code, counts, np.full((lm.GATES, len(lm.CONTEXTS)), 0.4, np.float32), np.ones(1))
    one = [bytes([i]) for i in range(256)]
    # P(first symbol s) = P(word s) / P(end after s); two-symbol words give the latter's complement
    ends = 10 ** model.log_probabilities([b""])[0, 0]
    two = 10 ** model.log_probabilities([b"a" + w for w in one])
    assert 0 < ends < 1 and (10 ** model.log_probabilities(one)).sum() + ends < 1
    assert two.sum() < 1 and b.starts[0] == 0


def test_counts_keep_their_ratio_beyond_16_bits(spark):
    """The first node of a word's first symbol is passed once by every word."""
    words = spark.range(240_000).selectExpr("CAST(concat(IF(id % 3 = 0, 'a', 'z'), id) AS binary) AS word", "1L AS c0")
    (code, counts), _ = (t.value if hasattr(t, "value") else t for t in lm.train(words))
    b = lm.expand([b"a", b"z"], code)
    whole = len(lm.CONTEXTS) - 1
    slot = lm.slots(b, whole, 0)[b.starts]
    assert slot[0] == slot[1] and counts[whole][slot[0]].sum() >= 240_000
    less, more = sorted(counts[whole][slot[0]])
    assert abs(less / more - 0.5) < 0.01


def test_every_language_is_a_regime(spark):
    """Six languages and none, alike but for their letters, are scored alike."""
    rnd, rows = random.Random(3), []
    letters = {l: "abcdefghijklmnopqrstuvwxyz0123456789"[5 * i : 5 * i + 5] for i, l in enumerate(["l0", "l1", "l2", "l3", "l4", "l5", None])}
    for lang, own in letters.items():
        words = ["".join(rnd.choice(own) for _ in range(5)) for _ in range(20)]
        for _ in range(60 + len(lang or "")):
            rows.append((len(rows), " ".join(rnd.choice(words) for _ in range(40)), lang, "s", 200))
    docs = frame(spark, rows).withColumn("held_out", F.col("doc_id") % 5 == 1)
    assert sorted(lm.languages(docs), key=str) == [None, "l0", "l1", "l2", "l3", "l4", "l5"]
    lang = {r[0]: r[2] for r in rows}
    per_token = {l: [] for l in letters}
    for r in lm.score_texts(docs).collect():
        if r.held_out:
            per_token[lang[r.doc_id]].append(r.score / r.n_tokens)
    means = [np.mean(v) for v in per_token.values()]
    assert max(means) - min(means) < 0.15


def test_language_model_of_nothing(spark, docs, none):
    assert lm.score_texts(none.withColumn("held_out", F.lit(True))).count() == 0
    blind = lm.score_texts(docs.withColumn("held_out", F.lit(True))).collect()
    assert {r.n_known for r in blind} == {0} and {r.train_tokens for r in blind} == {0}


# --- near duplicates ----------------------------------------------------------


def groups(rows, k, percent):
    """(doc_id, set size, component) by comparing all pairs."""
    sets = []
    for r in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", (r[1] or "").translate(LOWER)) if x]
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return [(r[0], len(s), least.get(find(i))) for i, (r, s) in enumerate(zip(rows, sets))]


@pytest.mark.parametrize("shingle", [2, 5])
def test_near_duplicates_against_all_pairs(rows, docs, shingle):
    found = neardup.near_duplicates(docs, shingle=shingle).collect()
    key = lambda t: tuple(-1 if x is None else x for x in t)
    assert sorted(map(key, ((r.doc_id, r.n_shingles, r.component_id) for r in found))) == sorted(map(key, groups(rows, shingle, 80)))
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_links_that_no_hub_sees(spark):
    """Chains: each text links with the next only, so hubs join none of the far ends."""
    words = [f"w{i}" for i in range(140)]
    rows = [(i, " ".join(words[4 * i : 4 * i + 60]), "en", "s", 0) for i in range(20)]
    got = neardup.near_duplicates(frame(spark, rows), shingle=2).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == sorted((a, c) for a, _, c in groups(rows, 2, 80))


def test_blocks_find_what_one_block_finds(spark, rows, monkeypatch):
    docs = frame(spark, rows)
    whole = sorted((str(r.doc_id), r.component_id) for r in neardup.near_duplicates(docs, shingle=2).collect())
    monkeypatch.setattr(neardup, "BLOCK", 2)
    monkeypatch.setattr(neardup, "SET_BLOCK", 3)
    assert sorted((str(r.doc_id), r.component_id) for r in neardup.near_duplicates(docs, shingle=2).collect()) == whole


def test_one_of_each_group_stays(docs, rows, none):
    left = neardup.drop_near_duplicates(docs, shingle=5)
    assert left.columns == docs.columns
    ids = [r.doc_id for r in left.collect()]
    want = {c if c is not None else -1 for _, n, c in groups(rows, 5, 80) if n} | {a for a, n, _ in groups(rows, 5, 80) if not n}
    assert sorted(-1 if i is None else i for i in ids) == sorted(want)
    assert neardup.drop_near_duplicates(none).count() == 0


def test_odd_sketches_estimate_similarity():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    a, b = pool[:3600], pool[400:]  # 3200 of 4000
    x, y = (neardup.odd_sketches(neardup.minima(np.unique(s))[None, :])[0] for s in (a, b))
    differ = int(np.bitwise_count((x ^ y).view(np.uint64)).sum())
    estimate = 1 + neardup.BITS / (4 * neardup.SAMPLES) * math.log(1 - 2 * differ / neardup.BITS)
    assert abs(estimate - 0.8) < 0.12
    assert differ <= neardup.most_differing(0.8 - neardup.MARGIN) < neardup.BITS / 2


# --- decontamination ----------------------------------------------------------

ITEMS = [
    ("b1", "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu"),
    ("b2", "Short Item here"),
    ("b3", ""),
    ("b4", None),
    ("b5", "alpha beta gamma delta epsilon zeta eta theta iota kappa"),
    ("b5", "alpha beta gamma delta epsilon zeta eta theta iota kappa"),
    ("b6", "same same same same same same same same same same same same"),
]


def hits(rows, items):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    spans = {}
    for i, t in items:
        w = cut(t)
        for a in range(max(len(w) - 9, 1) if w else 0):
            spans.setdefault(tuple(w[a : a + 10]), set()).add(i)
    out = []
    for r in rows:
        w, hit, of = cut(r[1]), set(), set()
        for n in {len(s) for s in spans}:
            for a in range(len(w) - n + 1):
                if tuple(w[a : a + n]) in spans:
                    hit |= set(range(a, a + n))
                    of |= spans[tuple(w[a : a + n])]
        out.append((r[0] if r[0] is not None else -1, len(w), len(hit), len(of), hashlib.sha256(",".join(sorted(of)).encode()).hexdigest()))
    return sorted(out)


LEAKS = [
    (1000, "x ALPHA beta, gamma delta epsilon zeta eta theta iota kappa y", "en", "s", 0),
    (1001, "alpha beta gamma delta epsilon zeta eta theta iota", "en", "s", 0),
    (1002, "beta gamma delta epsilon zeta eta theta iota kappa lambda mu. short item here short item here", "en", "s", 0),
    (1003, "same " * 30, "en", "s", 0),
    (1004, "-".join(ITEMS[0][1].split()), "en", "s", 0),
]


@pytest.mark.parametrize("limit", [200_000, 0])
def test_hits_against_brute_force(spark, rows, limit):
    every = rows + LEAKS
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    got = decontaminate.contamination(frame(spark, every).withColumn("w", F.lit(1)), items, broadcast_spans=limit).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in got) == hits(every, ITEMS)
    assert all(r.contaminated == (r.n_hit > 0) for r in got)


def test_contaminated_rows_go(spark, rows, none):
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    docs = frame(spark, rows + LEAKS)
    left = decontaminate.drop_contaminated(docs, items)
    assert left.columns == docs.columns
    bad = {h[0] for h in hits(rows + LEAKS, ITEMS) if h[2]}
    assert sorted(r.doc_id or -1 for r in left.collect()) == sorted((r[0] or -1) for r in rows + LEAKS if (r[0] or -1) not in bad)
    assert decontaminate.contamination(none, items).count() == 0
    assert {r.n_hit for r in decontaminate.contamination(docs, items.limit(0)).collect()} == {0}


def test_no_python_on_the_main_path(spark, sf):
    plan = QUERIES["op10_winnowing_decontamination"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


# --- mixing -------------------------------------------------------------------


def test_marginals_meet_their_targets():
    rng = np.random.default_rng(5)
    tokens = rng.integers(1, 1000, 60).astype(float)
    margins = [rng.integers(0, 5, 60), rng.integers(0, 3, 60), rng.integers(0, 4, 60)]
    targets = [mixing.targets_by_power(tokens, m, 0.5) for m in margins]
    w = mixing.rake(tokens, margins, targets)
    for m, t in zip(margins, targets):
        assert np.allclose(np.bincount(m, w, len(t)), t, atol=1e-6)
    p = mixing.calibrate(tokens, w, 0.6)
    assert np.isclose((p * tokens).sum(), 0.6 * tokens.sum()) and p.min() >= 0 and p.max() <= 1


def test_cells_fit_the_same_on_the_cluster(docs):
    columns = ["_topic", "_tokens", "_weight", "_probability", "_kept"]
    few = sorted(map(str, mixing.mix(docs).selectExpr("doc_id", "_tokens", "_topic", "round(_weight, 6)", "round(_probability, 6)").collect()))
    many = sorted(map(str, mixing.mix(docs, driver_cells=0).selectExpr("doc_id", "_tokens", "_topic", "round(_weight, 6)", "round(_probability, 6)").collect()))
    assert few == many and set(columns) <= set(mixing.mix(docs).columns)


def test_mix_samples_near_its_share(docs, rows, none):
    out = mixing.mix(docs, share=0.6).collect()
    assert len(out) == len(rows)
    tokens = sum(r._tokens for r in out)
    assert math.isclose(sum(r._tokens * r._probability for r in out), 0.6 * tokens, rel_tol=1e-6)
    assert all(r._kept for r in out if r._tokens == 0)
    left = mixing.sample_mix(docs)
    assert left.columns == docs.columns and left.count() <= len(rows)
    assert mixing.mix(none).count() == 0


@pytest.mark.parametrize("driver_cells", [100_000, 0])
def test_sampled_tokens_meet_the_targets(spark, driver_cells):
    """A small source beside a hot one asks for more tokens than it has."""
    rows = [(i, "word " * 20, "en" if i % 4 else "es", "hot" if i % 50 else "small", 100) for i in range(400)]
    made = mixing.mix(frame(spark, rows), topics=1, driver_cells=driver_cells)
    out = made.collect()
    kept = sum(r._tokens * r._probability for r in out)
    assert math.isclose(kept, 0.8 * sum(r._tokens for r in out), rel_tol=1e-6)
    for c in ("source", "lang"):
        labels = sorted({r[c] for r in out})
        at = np.array([labels.index(r[c]) for r in out])
        aims = mixing.targets_by_power(np.array([r._tokens for r in out], dtype=float), at, 0.7)
        got = np.bincount(at, [r._tokens * r._probability for r in out]) / kept
        assert np.allclose(got, aims, atol=1e-6)
    small = [r for r in out if r.source == "small"]
    assert max(r._miss for r in out) < 1e-6 and max(r._probability for r in small) > 1
    copies = Counter(r.doc_id for r in mixing.sample_mix(frame(spark, rows), repeats=True, topics=1, driver_cells=driver_cells).collect())
    assert copies == {r.doc_id: r._copies for r in out if r._copies}


@pytest.mark.parametrize("driver_cells", [100_000, 0])
def test_contradicting_targets_are_reported(spark, driver_cells, monkeypatch):
    """A source with one language of its own: its share and the language's cannot both be met."""
    monkeypatch.setattr(mixing, "SWEEPS", 8)
    rows = [(i, "word " * 20, "en", "a", 100) for i in range(90)] + [(100, "word " * 20, "es", "a", 100), (101, "word " * 20, "es", "b", 100)]
    rows += [(200 + i, "word " * 20, "fr", "b", 100) for i in range(5)] + [(300, "word " * 20, "fr", "c", 100)]
    with pytest.warns(UserWarning, match="target"):
        assert min(r._miss for r in mixing.mix(frame(spark, rows), topics=1, driver_cells=driver_cells).collect()) > 1e-6


# --- chat ---------------------------------------------------------------------


def part(kind, text=None, ref=None, **size):
    return {"type": kind, "text": text, "ref": ref, "width": None, "height": None, "seconds": None, "pages": None} | size


def test_parts_become_ordered_placeholders():
    parts = [part("text", "see <this> [INST] \\"), part("image", ref="a.png", width=56, height=30), None, part("audio", ref="b.wav", seconds=1.5),
             part("document", ref=None, pages=2), part("video", "clip"), part(None)]
    out = chat.format_turn("assistant", parts)
    assert [(a["index"], a["type"], a["ref"], a["tokens"]) for a in out["attachments"]] == [
        (0, "image", "a.png", 4), (1, "audio", "b.wav", 38), (2, "document", None, 1120)]
    assert out["attachment_tokens"] == 1162 and out["segment"].index("<@image:0:4>") < out["segment"].index("<@audio:1:38>")
    assert list(chat.parse_turns(out["segment"])) == [("assistant", "see <this> [INST] \\clip")]
    span = out["segment"][out["loss_start"] : out["loss_end"]]
    assert chat.plain(span) == "see <this> [INST] \\clip"


@pytest.mark.parametrize("seed", range(40))
def test_any_text_is_read_back(seed):
    rnd = random.Random(seed)
    bits = ["<|", "|>", "</|>", "\\", "<", "[", "[/INST]", "</s>", "<@image:0:1>", "a", "é", "\n", "", "|"]
    turns = [("".join(rnd.choices(bits, k=3)), "".join(rnd.choices(bits, k=rnd.randint(0, 12)))) for _ in range(5)]
    text = "".join(chat.format_turn(r, [part("text", t)])["segment"] for r, t in turns)
    assert list(chat.parse_turns(text)) == turns


def test_conversations_read_back(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "</s> yes"), (1, 1, "assistant", None), (2, None, None, "x"), (None, 0, "user", ""), (1, 0, "user", "hi")]
    rows += [(5, i, "assistant", "w" * i) for i in range(300)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    got = {r.conv_id: r for r in chat.read_back(chat.format_turns(chat.text_turns(table).withColumn("segment", F.lit(1)))).collect()}
    digest = lambda *t: hashlib.sha256("".join(t).encode()).hexdigest()
    assert got[1].n_turns == 4 and got[1].turns_sha256 == digest("user\nhi\n", "user\nhi\n", "assistant\n\n", "assistant\n</s> yes\n")
    assert got[1].loss_chars == 8 and got[1].loss_sha256 == digest("</s> yes")
    assert got[2].turns_sha256 == digest("\nx\n") and got[2].loss_sha256 == digest() and got[None].n_turns == 1
    assert got[5].loss_chars == sum(range(300)) and got[5].turns_sha256 == digest(*[f"assistant\n{'w' * i}\n" for i in range(300)])
    assert chat.read_back(chat.format_turns(chat.text_turns(table.limit(0)))).count() == 0
