"""Incremental refresh: only documents that are new or changed since the last run are
read, and only games not met before are scored and analysed."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plyscope.operators import games as gm
from plyscope.operators.report import bounded_broadcast
from plyscope.operators.scores import Scorer
from plyscope.plans.analysis import move_analysis
from plyscope.plans.refresh import CONTEXT
from plyscope.schemas import ANALYSIS, ARCHIVE, MOVES
from plyscope.session import land
from plyscope.sources import archive as ar
from plyscope.sources.audit import BatchCounters
from plyscope.sources.tables import exists
from plyscope.streaming.scorebook import score_from_book


def _fields(kind: T.DataType, *names: str) -> list[T.StructField]:
    return [T.StructField(n, kind) for n in names]


BATCH = T.StructField("batch", T.StringType())
#: The documents read so far. `taken` orders the runs, so the newest version of a path is known.
DOCUMENTS = T.StructType([*_fields(T.StringType(), "path"), *_fields(T.LongType(), "modified", "length", "taken"), BATCH])
#: Every copy of a game that a document holds. `digest` tells copies of one game apart.
COPY_ID = [*_fields(T.StringType(), "game_key"), *_fields(T.LongType(), "digest")]
COPY = "concat(game_key, '#', digest)"
COPIES = T.StructType([*COPY_ID, *_fields(T.LongType(), "end_time", "taken"), *_fields(T.StringType(), "path"), BATCH])
MOVE_ROWS = T.StructType([*COPY_ID, *MOVES.fields[1:], *_fields(T.StringType(), "Result"), BATCH])
ANALYSIS_ROWS = T.StructType(
    [
        *COPY_ID,
        *ANALYSIS.fields[1:],
        *_fields(T.StringType(), "Game_Link", "White", "Black", "Start_Date", "End_Date", "Result"),
        *_fields(T.DoubleType(), "delta", "wp_before"),
        BATCH,
    ]
)
SMALL_KEYS = 200_000


@dataclass
class Incremental:
    """What holds after a run: the tables of the games that count, and the run's counters.
    `numbers` and `reports` come from a run that keeps them."""

    moves: DataFrame
    analysis: DataFrame
    audit: DataFrame
    numbers: DataFrame | None = None
    reports: dict[str, DataFrame] = field(default_factory=dict)


def _table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table by batch; without rows before the first write."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _others(spark: SparkSession, path: str, schema: T.StructType, batch: str) -> DataFrame:
    """Rows other batches wrote."""
    return _table(spark, path, schema).where(F.col("batch") != batch)


def _replace(df: DataFrame, path: str, batch: str) -> None:
    """Write the batch's own partition; a replay of the batch puts its rows in that place."""
    df.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def _met(history: DataFrame, keys: DataFrame, by: list[str]) -> DataFrame:
    """The rows of `history` with one of `keys`. Few keys, by rows and bytes, go to the history,
    which is then scanned but not shuffled; with more, both are shuffled."""
    return history.join(bounded_broadcast(keys, SMALL_KEYS)[0], by, "left_semi")


def add_games(raw: DataFrame, target: str, batch: str, scorer: Scorer) -> None:
    """Adds the games of one batch that no other batch holds.

    Every copy of a game is noted in `target/games`. Moves go to `target/moves` and their
    analysis to `target/analysis`, once per different copy of a game; the scores of
    positions not met before go to buckets of `target/scores`, and what cannot be used to
    `target/quarantine`. All are partitioned by batch, and a batch never reads its own
    partition: after a crash at any point the same batch runs again and gives the same
    rows, so nothing is lost or doubled. `raw` may name each game's document (`_path`,
    `_taken`); games that do not always count.
    """
    spark = raw.sparkSession
    for c, kind in (("_path", "string"), ("_taken", "bigint")):
        if c not in raw.columns:
            raw = raw.withColumn(c, F.lit(None).cast(kind))
    clean = ar.clean_games(raw, keep=("end_time", "_path", "_taken"))
    keyed = gm.with_headers(clean).selectExpr(
        "end_time", "pgn", "_path", "_taken", f"{gm.GAME_KEY} AS game_key", "xxhash64(pgn) AS digest"
    )
    copies = land(keyed.select("game_key", "end_time", "digest", "_path", "_taken"), "copies")
    ids = copies.select("game_key", "digest").distinct()
    known = _met(_others(spark, f"{target}/games", COPIES, batch).select("game_key", "digest"), ids, ["game_key", "digest"])
    fresh = land(ids.join(known, ["game_key", "digest"], "left_anti"), "fresh")
    texts = keyed.select("game_key", "digest", "pgn").join(fresh, ["game_key", "digest"], "left_semi")
    texts = texts.dropDuplicates(["game_key", "digest"])
    good, aside = gm.split_quarantine(land(gm.tag_games(gm.parse_games(texts)), "intake"))
    moves = gm.build_moves(good, ("digest",))

    scored = score_from_book(moves, f"{target}/scores", batch, scorer).drop("position")
    stored = [f.name for f in MOVE_ROWS.fields if f.name != "batch"]
    _replace(scored.select(*stored), f"{target}/moves", batch)

    written = _moves(spark, target).where(F.col("batch") == batch).withColumn("_copy", F.expr(COPY))
    keep = ("game_key", "digest", *[c for c in CONTEXT if c != "game_key"])
    analysed = move_analysis(written, game="_copy", ordered=False, keep=keep)
    _replace(analysed.select(*[f.name for f in ANALYSIS_ROWS.fields if f.name != "batch"]), f"{target}/analysis", batch)

    unread = ar.corrupt_documents(raw).selectExpr(
        "concat(player, '/', month) AS game_key", "'corrupt_document' AS reason", "_corrupt_record AS text"
    )
    missing = good.where("missing_headers <> ''").selectExpr("game_key", "missing_headers")
    _replace(missing, f"{target}/missing_tags", batch)
    _replace(aside.selectExpr("game_key", "reason", "pgn AS text").unionByName(unread), f"{target}/quarantine", batch)
    _replace(copies.selectExpr("game_key", "end_time", "digest", "_path AS path", "_taken AS taken"), f"{target}/games", batch)


def _moves(spark: SparkSession, target: str) -> DataFrame:
    return _table(spark, f"{target}/moves", MOVE_ROWS)


def _counting(spark: SparkSession, target: str) -> DataFrame:
    """(game_key, digest) of the copy of each game that counts: of those in the newest
    version of their document, the one with the latest end, as in the batch job."""
    documents = _table(spark, f"{target}/documents", DOCUMENTS)
    newest = documents.groupBy("path").agg(F.max("taken").alias("newest"))
    copies = _table(spark, f"{target}/games", COPIES)
    live = copies.join(newest, "path", "left").where("path IS NULL OR taken = newest")
    return live.groupBy("game_key").agg(F.expr(f"max_by(digest, {gm.LATEST})").alias("digest"))


def current_tables(spark: SparkSession, target: str) -> tuple[DataFrame, DataFrame]:
    """Moves and analysis of the games that count."""
    counting = land(_counting(spark, target), "counting")
    tables = (_moves(spark, target), _table(spark, f"{target}/analysis", ANALYSIS_ROWS))
    moves, analysis = (t.join(counting, ["game_key", "digest"], "left_semi").drop("digest", "batch") for t in tables)
    return moves, analysis


def _new_documents(spark: SparkSession, landing: str, target: str) -> list[tuple[str, str, int, int]]:
    """Location, path, modification time and length of files the manifest does not have.

    A file is known by the last three, however old it is; only the folder is listed. As
    many rows come to the driver as there are new files, which it lists anyway.
    """
    if not exists(spark, landing):
        return []
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(landing)
    files = files.selectExpr(
        "path AS location", "_metadata.file_path AS path", "unix_millis(modificationTime) AS modified", "length"
    )
    known = _table(spark, f"{target}/documents", DOCUMENTS).groupBy("path")
    known = known.agg(F.max(F.struct("taken", "modified", "length")).alias("k")).selectExpr("path", "k.modified", "k.length")
    return [tuple(r) for r in files.join(known, ["path", "modified", "length"], "left_anti").select(*files.columns).collect()]


def refresh_incremental(
    spark: SparkSession, landing: str, target: str, scorer: Scorer, one_per_file: bool = True
) -> Incremental:
    """Takes in every document that is new or changed since the last call.

    The manifest `target/documents` says which have been read: by path, modification time
    and length, so documents that arrive late, or again under the same path, are read. It
    is written last; a run that failed is repeated by the next under the same batch name.
    Without the manifest all is read again, which adds nothing twice.
    """
    new = _new_documents(spark, landing, target)
    counts = []
    if new:
        batch, taken = _next_batch(spark, target), time.time_ns()
        docs = spark.read.schema(ARCHIVE).options(**ar.archive_options(one_per_file), basePath=landing).json([f[0] for f in new])
        docs = docs.select("*", F.col("_metadata.file_path").alias("_path"))
        raw = ar.flatten_archive(docs, keep=("_path",)).withColumn("_taken", F.lit(taken))
        add_games(land(raw, "raw"), target, batch, scorer)
        manifest = spark.createDataFrame([(*f[1:], taken) for f in new], "path string, modified long, length long, taken long")
        _replace(manifest.coalesce(1), f"{target}/documents", batch)
        counts = [("documents", "rows", len(new))]
        for name, schema in (("games", COPIES), ("moves", MOVE_ROWS), ("analysis", ANALYSIS_ROWS)):
            rows = _table(spark, f"{target}/{name}", schema).where(F.col("batch") == batch).count()
            counts.append((name, "rows", rows))
    moves, analysis = current_tables(spark, target)
    return Incremental(moves, analysis, spark.createDataFrame(counts, "stage string, counter string, value long"))


def _next_batch(spark: SparkSession, target: str) -> str:
    """The name of the next batch: the manifest's own id and a number that counts on."""
    last = _table(spark, f"{target}/documents", DOCUMENTS).agg(F.max("batch")).first()[0]
    if last is None:
        return f"{uuid.uuid4().hex}-{0:08d}"
    name, number = last.rsplit("-", 1)
    return f"{name}-{int(number) + 1:08d}"


def stream_games(stream: DataFrame, target: str, checkpoint: str, scorer: Scorer, audit: str | None = None):
    """A streaming query that adds the games of every micro-batch of flattened documents.

    Batch names carry the id of the stream's checkpoint, so a new checkpoint, which
    counts from 0 again, does not overwrite what an earlier one wrote. With `audit`, a
    folder, the rows of each micro-batch are counted as they are read (`stream_audit`).
    """
    spark = stream.sparkSession

    def intake(raw: DataFrame, batch_id: int) -> None:
        session = raw.sparkSession
        stream_id = session.read.json(f"{checkpoint}/metadata").first()["id"]
        add_games(land(raw, "raw"), target, f"{stream_id}-{batch_id:08d}", scorer)

    counters = None if audit is None else BatchCounters(spark, audit, "raw_games")
    counted = stream if counters is None else counters.counted(stream, ("pgn",))
    writer = counted.writeStream.foreachBatch(intake).option("checkpointLocation", checkpoint)
    query = writer.trigger(availableNow=True).start()
    if counters is not None:
        counters.watch(query)
    return query
