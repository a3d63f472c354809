"""Columns of the input that are called like an operator's own; sizes that are no sizes."""

import math

import pytest

from plyscope.llm import chat, langid, mixing, sharding

OWN = ["_source", "_lang", "_topic", "_copies", "_Kept", "_language", "_language_score", "_found_language", "_d", "_h", "_r", "_size", "_cell", "_measured"]


@pytest.fixture(scope="module")
def clashing(spark):
    words = {"aa": "unus duo tres quattuor quinque", "bb": "een twee drie vier vijf"}
    rows = [(i, f"{words[lang]} {words[lang][i % 7:]} {i}", lang, f"s{i % 3}", *[f"{c}{i}" for c in OWN]) for i in range(60) for lang in words]
    return spark.createDataFrame(rows, ", ".join(["doc_id long", "text string", "lang string", "source string", *[f"{c} string" for c in OWN]]))


def same(df, want):
    assert df.columns == want.columns
    assert sorted(map(str, df.collect())) == sorted(map(str, want.collect()))


def test_language_keeps_user_columns(clashing):
    same(langid.keep_identified(clashing, langid.train(clashing), least=0.0), clashing)


def test_mix_keeps_user_columns(clashing):
    plain = clashing.drop(*OWN)
    kept = mixing.sample_mix(clashing, repeats=True)
    assert kept.columns == clashing.columns
    same(kept.drop(*OWN), mixing.sample_mix(plain, repeats=True))
    assert all(r["_topic"] == f"_topic{r.doc_id}" and r["_source"] == f"_source{r.doc_id}" for r in kept.collect())
    assert all(r["_source"] == f"_source{r.doc_id}" for r in mixing.mix(clashing.drop("_Kept")).collect())


def test_shards_keep_user_columns(clashing):
    out = sharding.shard(clashing)
    same(out.select(*clashing.columns), clashing)
    few = sharding.shard(clashing, text="_d", keep=["doc_id", "_r"])
    assert set(few.columns) == {"doc_id", "_r", "size", "text_crc32", "shard", "slot"}
    assert all(r["_r"] == f"_r{r.doc_id}" and r["size"] == len(f"_d{r.doc_id}") + 1 for r in few.collect())


@pytest.mark.parametrize("size", [math.nan, math.inf, -math.inf, -5.0, 0.0, None])
def test_sizes_that_are_no_sizes_count_as_one(size):
    parts = [{"type": kind, "text": None, "ref": None, "width": size, "height": size, "seconds": size, "pages": size} for kind in ("image", "audio", "document")]
    out = chat.format_turn("assistant", parts)
    assert [a["tokens"] for a in out["attachments"]] == [1, 25, 560]
    assert list(chat.parse_turns(out["segment"])) == [("assistant", "")]
