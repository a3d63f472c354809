"""Benchmark decontamination by winnowing, in SQL expressions only.

Of each window of consecutive k-grams the smallest hash is kept. A window of `shared - k + 1`
k-grams covers exactly `shared` words, so two texts that share so many consecutive words keep
the same hash for that span: no shared span is missed. Spans whose kept hash is in both are
then extended over all their words. Items shorter than that are one span each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyscope.llm.common import table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
NO_KEYS = "CAST(array() AS array<struct<at: int, len: int, m: bigint>>)"


def _gram_hashes(k: int) -> str:
    return (
        f"CASE WHEN size(w) >= {k} THEN transform(sequence(1, size(w) - {k - 1}), i -> xxhash64(slice(w, i, {k})))"
        " ELSE CAST(array() AS array<bigint>) END"
    )


def _long_keys(shared: int, k: int) -> str:
    """One key per span of `shared` words: the least hash of its k-grams."""
    return (
        f"CASE WHEN size(w) >= {shared} THEN transform(sequence(1, size(w) - {shared - 1}), i -> named_struct("
        f"'at', i, 'len', {shared}, 'm', array_min(slice(g, i, {shared - k + 1})))) ELSE {NO_KEYS} END"
    )


def _short_keys(length: str) -> str:
    """One key per span of `length` words, for items shorter than a full span."""
    return (
        f"CASE WHEN size(w) >= {length} THEN transform(sequence(1, size(w) - {length} + 1), i -> named_struct("
        f"'at', i, 'len', {length}, 'm', xxhash64(slice(w, i, {length})))) ELSE {NO_KEYS} END"
    )


def spans(rows: DataFrame, carried: list[str], text: str, keys: str, shared: int, k: int) -> DataFrame:
    """`carried`, n_words and one row (at, len, m, w) per span; w holds the words of the text.

    Each row of the table also gives one row with at = 0, so that it is never lost. Lambdas
    bind the words and the hashes once, which a projection could compute again per element.
    """
    words = f"regexp_extract_all(translate({text}, '{UPPER}', '{LOWER}'), '{WORD}', 0)"
    keys = f"concat(array(named_struct('at', 0, 'len', 0, 'm', CAST(NULL AS bigint))), {keys})"
    bound = f"transform(array(coalesce({words}, array())), w -> transform(array({_gram_hashes(k)}), g -> named_struct('n_words', CAST(size(w) AS bigint), 'w', w, 'keys', {keys}))[0])"
    return rows.select(*carried, F.expr(f"inline({bound})")).select(*carried, "n_words", "w", F.expr("inline(keys)"))


def item_spans(benchmark: DataFrame, text: str, item_id: str, shared: int, k: int) -> DataFrame:
    """(m, len, span, item_id): the spans that count as leaks, each with its key."""
    keys = f"CASE WHEN size(w) >= {shared} THEN {_long_keys(shared, k)} WHEN size(w) > 0 THEN {_short_keys('size(w)')} ELSE {NO_KEYS} END"
    items = benchmark.select(F.col(item_id).cast("string").alias("item_id"), F.col(text).alias("text"))
    found = spans(items, ["item_id"], "text", keys, shared, k).where("at > 0")
    return found.selectExpr("m", "len", "concat_ws(' ', slice(w, at, len)) AS span", "item_id").distinct()


def find_hits(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", item_text: str = "text",
    item_id: str = "item_id", shared: int = 10, k: int = 5, broadcast_spans: int = 200_000,
) -> DataFrame:
    """doc_id, copy, n_words, rows, n_hit, items: one row per distinct (id, text), `rows` times there.

    `copy` is xxhash64 of the text. A-Z fold to lower case; words are runs of digits, letters and anything beyond ASCII. A word
    is hit if it lies in an occurrence of a span of `shared` item words, or of a whole item of
    fewer words (but not none). Null and empty texts have no words and hit nothing; null items
    and ids count as the empty text and as the text of no id. Repeated rows are all returned,
    repeated items count once. Item spans are sent to all tasks only if they are at most
    `broadcast_spans`; beyond that both sides are shuffled by key.
    """
    leaks = item_spans(benchmark, item_text, item_id, shared, k)
    lengths = {r["len"]: r["n"] for r in leaks.groupBy("len").agg(F.count("*").alias("n")).collect()}
    keys = [_long_keys(shared, k)] + [_short_keys(str(n)) for n in sorted(lengths) if n < shared]
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("copy", F.xxhash64("text"))
    every = spans(rows, ["doc_id", "copy"], "text", f"concat({', '.join(keys)})", shared, k)
    small = sum(lengths.values()) <= broadcast_spans
    small_side = F.broadcast if small else (lambda df: df)
    marks = leaks.select("m", "len").distinct().withColumn("marked", F.lit(True))
    if small:
        # One stage of generated code, so that the words are referred to and never copied.
        every = every.join(small_side(marks), ["m", "len"], "left").where("at = 0 OR marked")
        hits = every.withColumn("span", F.expr("concat_ws(' ', slice(w, greatest(at, 1), len))"))
    else:
        narrow = every.select("doc_id", "copy", "n_words", "at", "len", "m")
        heads = narrow.where("at = 0").withColumn("span", F.lit(None).cast("string"))
        narrow = narrow.where("at > 0").join(marks, ["m", "len"], "left_semi")
        # the words of documents that have such a key, read once more
        of = narrow.groupBy("doc_id", "copy").agg(F.collect_set(F.struct("at", "len", "m")).alias("keys"))
        same = rows.dropDuplicates(["doc_id", "copy"]).alias("r").join(
            of.alias("o"), F.expr("r.doc_id <=> o.doc_id AND r.copy = o.copy")
        )
        words = f"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORD}', 0)"
        again = same.selectExpr("r.doc_id AS doc_id", "r.copy AS copy", "keys", f"{words} AS w")
        again = again.selectExpr("doc_id", "copy", "CAST(size(w) AS bigint) AS n_words", "w", "inline(keys)")
        again = again.selectExpr("doc_id", "copy", "n_words", "at", "len", "m", "concat_ws(' ', slice(w, at, len)) AS span")
        hits = heads.unionByName(again)
    hits = hits.join(small_side(leaks), ["m", "len", "span"], "left").where("at = 0 OR item_id IS NOT NULL")
    per_row = hits.groupBy("doc_id", "copy", "n_words").agg(
        F.count(F.when(F.col("at") == 0, 1)).alias("rows"),
        F.collect_set(F.when(F.col("at") > 0, F.struct("at", "len"))).alias("at"),
        F.array_sort(F.collect_set(F.when(F.col("at") > 0, F.col("item_id")))).alias("items"),
    )
    hit_words = "CAST(size(array_distinct(flatten(transform(at, a -> sequence(a.at, a.at + a.len - 1))))) AS bigint)"
    return per_row.selectExpr("doc_id", "copy", "n_words", "rows", f"{hit_words} AS n_hit", "items")


def contamination(docs: DataFrame, benchmark: DataFrame, **options: object) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated for every row of `docs`,
    repeated rows included; options and the treatment of odd input are those of `find_hits`."""
    out = find_hits(docs, benchmark, **options).withColumn("copy_no", F.expr("explode(sequence(1L, rows))"))
    return out.selectExpr(
        "doc_id", "n_words", "n_hit", "CAST(size(items) AS bigint) AS n_items",
        "sha2(concat_ws(',', items), 256) AS items_sha256", "n_hit > 0 AS contaminated",
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", **options: object) -> DataFrame:
    """The rows of `docs`, all columns, that hold no span of the benchmark."""
    bad = find_hits(docs, benchmark, text=text, doc_id=doc_id, **options).where("n_hit > 0")
    bad = bad.select(F.col("doc_id").alias("_bad_id"), F.col("copy").alias("_bad_copy")).alias("bad")
    same = F.col(f"d.{doc_id}").eqNullSafe(F.col("bad._bad_id")) & (F.xxhash64(F.col(f"d.{text}").cast("string")) == F.col("bad._bad_copy"))
    return docs.alias("d").join(bad, same, "left_anti")


def op10_winnowing_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP10_SQL = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
s AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, unnest(list_transform(range(1, greatest(len(w) - 8, 2)),
    lambda i: array_to_string(w[i : i + least(len(w), 10) - 1], ' '))) AS span FROM b WHERE len(w) > 0),
x AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, unnest(list_transform(range(1, len(w) - n + 2),
    lambda i: array_to_string(w[i : i + n - 1], ' '))) AS span FROM d, (SELECT DISTINCT n FROM s) WHERE len(w) >= n),
h AS (SELECT x.doc_id, x.i, x.n, s.item_id FROM x JOIN s ON s.span = x.span AND s.n = x.n),
p AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM h) GROUP BY doc_id),
k AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p ON p.doc_id = d.doc_id LEFT JOIN k ON k.doc_id = d.doc_id
"""
