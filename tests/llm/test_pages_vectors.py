import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from plyscope.llm import embeddings, html_text
from plyscope.llm.registry import QUERIES

BODY = "".join(f"<p>Paragraph {i} has quite a few words in it, so that it is plainly text.</p>" for i in range(6))
WANT = " ".join(f"Paragraph {i} has quite a few words in it, so that it is plainly text." for i in range(6))
NAV = '<nav><ul><li><a href="/a">A</a></li><li><a href="/b">B</a></li></ul></nav>'


@pytest.mark.parametrize(
    "html, want",
    [
        (None, ""),
        ("", ""),
        ("<html><body></body></html>", ""),
        ("just text &amp; more", "just text & more"),
        (f"<html><head><title>T</title></head><body>{NAV}<article><h1>Head</h1>{BODY}</article><footer>f</footer></body></html>", f"Head {WANT}"),
        (f"<body><div id=sidebar><p>Buy now</p></div><div id=content><h1>Head</h1>{BODY}<p>Short.</p></div></body>", f"Head {WANT} Short."),
        (f"<body>{NAV}<main>{BODY}<section class='comments'><p>I like it</p></section><form>Mail <input></form></main></body>", WANT),
        ("<article><p><b>a<br><p>b&eacute;&#33; c\n\t d</p><script>var t='</p>';</script><style>p{}</style><p>e<i>f</i>g</article>", "a bé! c d efg"),
        (f"<div class='cookie-notice'>We use cookies</div>{BODY}<div class=ad>Buy</div><aside>More</aside>", WANT),
        ("<article>" + "<div>" * 400 + "deep" + "</div>" * 400 + "</article>", "deep"),
        ("<article><p>one</p><!-- no --><p>two<p>three</article><nav>never closed <p>x", "one two three"),
    ],
)
def test_main_text(html, want):
    assert html_text.main_text(html) == want


@pytest.mark.parametrize(
    "html, want",
    [
        (f"<body>{NAV}<div id=story><h1>Head</h1><p>A lead of some words, all of them told.</p><div class=body>{BODY * 4}</div></div></body>",
         f"Head A lead of some words, all of them told. {' '.join([WANT] * 4)}"),
        (f"<body><article><h3>Teaser</h3><p>See this one too.</p></article><div id=text>{BODY * 2}</div></body>", f"{WANT} {WANT}"),
        (f"<body>{NAV}<article><h1>Head</h1>{BODY}<ul><li><a href=1>Ref one</a><li><a href=2>Ref two</a><li><a href=3>Ref three</a></ul></article></body>",
         f"Head {WANT} Ref one Ref two Ref three"),
    ],
)
def test_the_region_holds_the_whole_text(html, want):
    assert want in html_text.main_text(html)


LINKS = "".join(f"<li><a href={i}>Ref {i}</a>" for i in range(5))
REFS = " ".join(f"Ref {i}" for i in range(5))


@pytest.mark.parametrize(
    "page, want",
    [
        ("<p>a</p><![foo[x]]>", "a"),
        ("<![ <p>", ""),
        ("<p>a<![CDATA[x]]>b</p><!-->c<!--->d<!-- e --!>f", "ab cdf"),
        ("<p>a &lt; b &amp; c <a href='x", "a < b & c"),
        ("<p>x<!-- never closed <p>y", "x"),
        (f"<form id=f><div id=main>{BODY}<label>Name <input></label></div></form>", WANT),
        (f"<body><aside>{BODY}</aside></body>", WANT),
        (f"<body><div role=banner>{BODY}</div></body>", WANT),
        (f"<body><header>Site</header><article><header><h1>Head</h1></header>{BODY}</article></body>", f"Head {WANT}"),
        (f"<body><div>{NAV}<h1>Head</h1><article>{BODY}</article></div></body>", f"Head {WANT}"),
        (f"<body>{BODY}<label>Mail <input><p>After it some more text.</p>{BODY}</body>", f"{WANT} After it some more text. {WANT}"),
        (f"<body>{BODY}<ul>{LINKS}</ul>{BODY}</body>", f"{WANT} {REFS} {WANT}"),
        (f"<body><ul>{LINKS}</ul><h1>Head</h1>{BODY}<p>Short.</p><div><p>Copyright 2024 me</p></div></body>", f"Head {WANT} Short."),
        (f"<body><article><p>Nd.</p></article><footer>{'A long footer here. ' * 9}</footer><header>{'Slogan. ' * 9}</header></body>", "Nd."),
        (f"<body><article>{BODY}<footer>By line</footer></article></body>", WANT),
    ],
)
def test_odd_pages(page, want):
    assert html_text.main_text(page) == want


def generated(rng):
    """A page with one known main text, and the text."""
    words = lambda n: " ".join(rng.choice(["lorem", "ipsum", "dolor", "amet", "sit"]) for _ in range(n))
    paragraphs = [words(rng.randint(20, 60)) for _ in range(rng.randint(5, 15))]
    told = "".join(f"<p>{p}</p>" if rng.random() < 0.8 else f"<p>{p}" for p in paragraphs)
    title = words(4)
    main = rng.choice(["<article><h1>{t}</h1>{p}</article>", "<main><h1>{t}</h1>{p}</main>", "<div class=body><h1>{t}</h1>{p}</div>", "<div><h1>{t}</h1><article>{p}</article></div>", "<article><header><h1>{t}</h1></header>{p}</article>"])
    frames = ["<nav><ul><li><a href=/>Home</a><li><a href=/a>About</a></ul></nav>", "<div class=ad>Buy it now</div>", "<aside><h2>See also</h2><a href=x>Other</a></aside>", "<script>var a = '<p>';</script>", "<header><a href=/>Site</a></header>"]
    before = "".join(rng.sample(frames, rng.randint(0, 4)))
    wrap = rng.choice(["{}", "<form method=post>{}</form>", "<div id=page><div id=inner>{}</div></div>"])
    page = wrap.format(before + main.format(t=title, p=told) + "<footer>All rights</footer>")
    return f"<html><head><title>x</title></head><body>{page}</body></html>", " ".join([title, *paragraphs])


def test_generated_pages():
    rng = random.Random(2)
    for _ in range(150):
        page, want = generated(rng)
        assert html_text.main_text(page) == want, page


def test_no_page_raises():
    rng = random.Random(3)
    parts = ["<", ">", "<!", "<![", "]]>", "<!--", "-->", "</", "<p>", "</p>", "<a href='", '"', "'", "&", "&#x", ";", "<form>", "<label>", "</form>", "\x00", "text ", "<script>", "</script", "<?", "é", "<td>", "<header role=banner>", "<article>", "<textarea>", "</article>", "<svg/>"]
    for _ in range(3000):
        assert isinstance(html_text.main_text("".join(rng.choices(parts, k=rng.randint(1, 40)))), str)
    whole, _ = generated(rng)
    for i in range(0, len(whole), 7):
        html_text.main_text(whole[:i])
        html_text.main_text(whole[i:])


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 3000 + "<p>text of a paragraph</p>" * 3000, "<b>" * 20000 + "<p>x y z</p>" * 3000, "<a " * 40000, "<a " * 40000 + ">", "<!--" * 40000,
        "<" * 100_000, "</p" * 30000 + ">", "</i>" * 50000, "<div class=ad>" * 3000 + "text " * 3000, "<![ " * 30000 + ">", "&" * 100_000,
    ],
)
def test_time_is_in_proportion(page):
    start = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - start < 10


@pytest.mark.parametrize(
    "page",
    [
        "<body class=has-sidebar><div class=content-sidebar-wrap>{}</div></body>",
        "<body><article class='post category-legal tag-social'>{}</article></body>",
        "<body><div class=widget>{}</div><p>x</p></body>",
        "<body><main id=main class=social>{}</main><div class=sidebar>Buy</div></body>",
    ],
)
def test_hints_do_not_cut_the_main_text(page):
    got = html_text.main_text(page.format(BODY))
    assert WANT in got and "Buy" not in got


def test_a_long_thread_beside_an_article_goes():
    assert html_text.main_text(f"<body><div id=text>{BODY}</div><div class=comments>{BODY * 3}</div></body>") == WANT


def test_extract_keeps_all_rows(spark):
    rows = [(1, "u", "<p>a</p>"), (1, "u", "<p>a</p>"), (None, None, None), (2, "u", f"<article>{BODY * 300}</article>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("old"))
    got = html_text.extract(pages).orderBy("page_id").collect()
    assert [r.text for r in got[:3]] == ["", "a", "a"] and got[3].n_chars == len(" ".join([WANT] * 300))
    assert html_text.extract(pages.limit(0)).count() == 0


def test_pages_of_the_table(spark, sf):
    import html
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in QUERIES["op7_text_to_tag_extraction"](spark, sf).collect():
        inner = re.sub(r"</?b>", "", re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1])
        assert r.text == re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", " ", inner))).strip()
        assert r.n_chars == len(r.text)


def links(rows, limit=0.9):
    ok = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    n, parent = {i: 0 for i in range(len(rows))}, list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    width = max((len(rows[i][1]) for i in ok), default=0)
    m = np.array([list(rows[i][1]) + [0.0] * (width - len(rows[i][1])) for i in ok])
    m = m / np.abs(m).max(axis=1, keepdims=True)
    m = m / np.linalg.norm(m, axis=1, keepdims=True)
    near = m @ m.T >= limit
    for a, i in enumerate(ok):
        for b in range(a):
            if near[a, b]:
                n[i] += 1
                n[ok[b]] += 1
                parent[find(i)] = find(ok[b])
    least = {}
    for i, (v, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), 10**9), 10**9 if v is None else v)
    return sorted((-1 if v is None else v, n[i], -1 if least[find(i)] == 10**9 else least[find(i)]) for i, (v, _) in enumerate(rows))


def vectors(n, dims=24, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 8, dims))
    out = []
    for i in range(n):
        v = centres[i % len(centres)] + rng.normal(size=dims) * rng.choice([0.05, 0.2, 2.0])
        out.append((i, [float(x) for x in v]))
    return out


@pytest.mark.parametrize("seed", [0, 1])
def test_links_against_all_pairs(spark, seed):
    rows = vectors(400, seed=seed)
    rows += [(500, rows[0][1]), (501, rows[0][1]), (501, rows[0][1]), (502, [2 * x for x in rows[0][1]]), (503, None), (504, []), (505, [0.0] * 24),
             (506, [float("nan")] * 24), (507, [None] + rows[0][1][1:]), (508, [float("inf")] * 24), (509, [1.0]), (510, [3.0]), (None, rows[1][1]), (511, [1e200] * 24), (512, [1e-200] * 24)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit("x") for c in ("nid", "grp", "v", "same")})
    got = embeddings.near_vectors(frame.repartition(3)).collect()
    assert sorted((-1 if r.vec_id is None else r.vec_id, r.n_links, -1 if r.component_id is None else r.component_id) for r in got) == links(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_a_hot_group_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=32)
    rows = [(i, [float(x) for x in (centre + rng.normal(size=32) * 0.05 if i % 3 == 0 else rng.normal(size=32))]) for i in range(240)]
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    got = embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    want = links([(i, [float(np.float32(x)) for x in v]) for i, v in rows])
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == want


def test_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embeddings.near_vectors(empty).count() == 0
    odd = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in embeddings.near_vectors(odd).collect()) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_rotations_keep_lengths_and_balance_bits():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 16)) * np.linspace(3, 0.2, 16)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    r = embeddings.learn_rotation(x, 1)
    assert np.allclose(r.T @ r, np.eye(16), atol=1e-8)
    quantised = lambda y: np.square(np.sign(y) / 4 - y).sum()
    assert quantised(x @ r) < quantised(x)
