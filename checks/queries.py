"""The registered queries: each operator over the driver's whole tables."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import plyscope as ps
from checks import views
from plyscope.functions import scoring as sc
from plyscope.functions.text import HEADER_TAGS
from plyscope.session import shared_dir
from plyscope.sources.tables import NO_SUCCESS_FILE, SNAPSHOT, snapshot_dir

AS_OF = "2024-05-15"
PLAYER = "CUSTOMER#000000001"


def round6(name: str) -> str:
    """Six decimals; adding zero leaves no negative zero behind."""
    return f"round({name} * 1000000) / 1000000 + 0D AS {name}"


def big(name: str) -> str:
    return f"CAST({name} AS BIGINT) AS {name}"


def demo_scorer(batches):
    """Scores by arithmetic on the position's digest; one position in 32 has none."""
    for pdf in batches:
        digest = pdf["position"]

        def part(first: int, last: int) -> pd.Series:
            return digest.str.slice(first, last).map(lambda h: int(h, 16)).astype("int64")

        w, d = part(6, 12) % 801, part(12, 18) % 200
        out = pd.DataFrame(
            {
                "position": digest,
                "eval_type": "cp",
                "eval_value": part(0, 6) % 601 - 300,
                "wdl": [list(t) for t in zip(w, d, 1000 - w - d)],
            }
        )
        yield out[part(18, 20) % 32 != 0]


def ply() -> Column:
    return F.col("Move_Number").cast("bigint").alias("Move_Number")


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return ps.score_plies(views.moves(spark, sf))


def texts(spark: SparkSession, sf: str) -> DataFrame:
    return views.game_texts(spark, sf).where(F.col("pgn").isNotNull())


def parsed(spark: SparkSession, sf: str) -> DataFrame:
    return ps.parse_games(texts(spark, sf))


def analysis_out(df: DataFrame, game: str = "Game_Number") -> DataFrame:
    return df.selectExpr(
        game,
        big("Move_Number"),
        "Move",
        "CentiPawnLoss",
        "Player_To_Move",
        round6("move_accuracy"),
        "ACPL_White",
        "ACPL_Black",
        "Game_Accuracy_White",
        "Game_Accuracy_Black",
        "game_phase",
    )


def moves_flat(df: DataFrame, game: str = "Game_Number") -> DataFrame:
    """Moves without nested columns, so that two engines can compare them."""
    return df.selectExpr(
        game,
        big("Move_Number"),
        "Move",
        "Evaluation.type AS eval_type",
        "Evaluation.value AS eval_value",
        "array_join(CAST(`WDL Stats` AS ARRAY<STRING>), '/') AS wdl",
        "White",
        "Black",
        "End_Date",
    )


# --- scoring -----------------------------------------------------------------


def move_analysis(spark, sf):
    return analysis_out(ps.move_analysis(views.moves(spark, sf)))


def move_analysis_long_games(spark, sf):
    return analysis_out(ps.move_analysis(views.long_games(spark, sf), ordered=False))


def move_analysis_null_game(spark, sf):
    """A game without a number, over several chunks."""
    long = views.long_games(spark, sf).withColumn("Game_Number", F.expr("nullif(Game_Number, 1L)"))
    return analysis_out(ps.move_analysis(long, ordered=False, chunk_plies=256))


def move_analysis_long_ordered(spark, sf):
    return analysis_out(ps.move_analysis(views.long_games(spark, sf), chunk_plies=256))


def eval_fields(spark, sf):
    return views.moves(spark, sf).select(
        "Game_Number",
        ply(),
        sc.evaluation_type().alias("Evaluation_Type"),
        sc.evaluation_value().alias("Evaluation_Value"),
    )


def wdl_from_end(spark, sf):
    return views.moves(spark, sf).select(
        "Game_Number",
        ply(),
        sc.from_end("`WDL Stats`", 3).alias("w"),
        sc.from_end("`WDL Stats`", 2).alias("d"),
    )


def player_to_move(spark, sf):
    return views.moves(spark, sf).select(
        "Game_Number",
        ply(),
        sc.player_to_move().alias("Player_To_Move"),
    )


def centipawn_loss(spark, sf):
    return scored(spark, sf).selectExpr("Game_Number", big("Move_Number"), "CentiPawnLoss")


def win_probability(spark, sf):
    return scored(spark, sf).selectExpr(
        "Game_Number", big("Move_Number"), *map(round6, ("wp_before", "wp_after", "delta"))
    )


def move_accuracy(spark, sf):
    return scored(spark, sf).selectExpr("Game_Number", big("Move_Number"), round6("move_accuracy"))


def game_phase(spark, sf):
    return views.moves(spark, sf).select("Game_Number", ply(), sc.game_phase().alias("game_phase"))


def side_aggregates(spark, sf):
    return ps.side_aggregates(scored(spark, sf))


# --- reports -----------------------------------------------------------------


def move_analysis_arrays(spark, sf):
    """Games kept as arrays of at most 50 plies, so that games have up to three."""
    path = shared_dir(spark, "chunks")
    ps.game_chunks(views.moves(spark, sf), chunk_plies=50).write.parquet(path)
    return analysis_out(ps.score_chunks(spark.read.parquet(path)))


def player_filter(spark, sf):
    return analysis_out(ps.for_player(scored(spark, sf), PLAYER, ("White", "Black")))


def player_layout(spark, sf):
    """The rows of one player's games, from an analysis that is laid out by player."""
    root, analysed = shared_dir(spark, "by-player"), scored(spark, sf)
    ps.write_by_player(analysed, root, AS_OF)
    return analysis_out(ps.read_player(spark, root, PLAYER))


def phase_breakdown(spark, sf):
    return ps.phase_breakdown(scored(spark, sf))


def phase_drop(spark, sf):
    return ps.phase_drop(scored(spark, sf))


def performance_summary(spark, sf):
    return ps.performance_summary(ps.game_sheet(scored(spark, sf)))


def performance_as_of(spark, sf):
    return ps.performance_summary(ps.game_sheet(scored(spark, sf)), as_of=AS_OF)


def blunder_habits(spark, sf):
    return ps.blunder_habits(scored(spark, sf))


def blunder_plies(spark, sf):
    return ps.blunder_plies(scored(spark, sf))


def blunder_triggers(spark, sf):
    return ps.blunder_triggers(scored(spark, sf))


def opening_repertoire(spark, sf):
    plies = scored(spark, sf)
    sides = ps.opening_results(ps.game_sheet(plies), ps.first_moves(views.moves(spark, sf), plies=2))
    return ps.opening_repertoire(sides, min_games=1)


def name_openings(spark, sf):
    openings = ps.first_moves(views.moves(spark, sf), plies=6)
    return ps.name_openings(openings, views.opening_names(spark, sf))


def name_openings_shuffle(spark, sf):
    openings = ps.first_moves(views.moves(spark, sf), plies=6)
    return ps.name_openings(openings, views.opening_names(spark, sf), broadcast_rows=0)


def games_to_review(spark, sf):
    return ps.games_to_review(scored(spark, sf))


def performance_of_one(spark, sf):
    return ps.performance_summary(ps.game_sheet(scored(spark, sf)), PLAYER)


def analysis_context(spark, sf):
    mv = views.moves(spark, sf)
    joined = ps.with_game_context(ps.move_analysis(mv, ordered=False), mv)
    return joined.selectExpr(
        "Game_Number", big("Move_Number"), "CentiPawnLoss", "Game_Link", "White", "Black", "End_Date"
    )


# --- text to rows ------------------------------------------------------------


def game_headers(spark, sf):
    return ps.game_headers(parsed(spark, sf), keep=("Game_Number",)).selectExpr(
        "Game_Number", *HEADER_TAGS, big("ply_count")
    )


def game_plies(spark, sf):
    return ps.game_plies(parsed(spark, sf), keep=("Game_Number",)).selectExpr(
        "Game_Number", big("Move_Number"), "Move"
    )


def ply_count(spark, sf):
    return parsed(spark, sf).selectExpr("Game_Number", big("ply_count"))


def quarantine(spark, sf):
    good, aside = ps.split_quarantine(ps.parse_games(views.game_texts(spark, sf)))
    columns = ("Game_Number", "reason", "missing_headers")
    whole = good.selectExpr("Game_Number", "CAST(NULL AS STRING) AS reason", "missing_headers")
    return whole.unionByName(aside.select(*columns))


def moves_fact(spark, sf):
    return ps.build_moves(parsed(spark, sf), keep=("Game_Number",)).selectExpr(
        "Game_Number", "Game_Link", big("Move_Number"), "Move", "White", "Black",
        "Start_Date", "Start_Time", "End_Date", "End_Time", "Result", "position",
    )


def score_positions(spark, sf):
    moves = ps.build_moves(parsed(spark, sf), keep=("Game_Number",))
    return moves_flat(ps.score_positions(moves, demo_scorer))


def score_book(spark, sf):
    """Scores kept by a first run serve a second, which holds games of the first and others."""
    book = shared_dir(spark, "scores")
    moves = ps.build_moves(parsed(spark, sf), keep=("Game_Number",))
    ps.score_from_book(moves.where("Game_Number % 3 <> 2"), book, "a", demo_scorer).write.format("noop").mode("overwrite").save()
    second = ps.score_from_book(moves.where("Game_Number % 3 <> 0"), book, "b", demo_scorer)
    third = ps.score_from_book(moves.where("Game_Number % 3 = 0"), book, "c", no_scorer)
    return moves_flat(second.unionByName(third))


def no_scorer(batches):
    """Scores nothing: what has a score all the same has it from a run before."""
    for batch in batches:
        yield batch.head(0).assign(eval_type=None, eval_value=None, wdl=None)


def score_join(spark, sf):
    """Scores come from a table: the last event's scores for each written move."""
    mv = views.moves(spark, sf).withColumn("position", F.col("Move"))
    latest = views.table(spark, sf, "events").groupBy("event_type").agg(F.max("event_id").alias("n"))
    scores = latest.where("event_type <> 'signup'").selectExpr(
        f"{views.MOVE} AS position",
        "'cp' AS eval_type",
        "n % 601 - 300 AS eval_value",
        "array(n % 500, 200L, 800 - n % 500) AS wdl",
    )
    return moves_flat(ps.score_join(mv.drop("Evaluation", "WDL Stats"), scores))


def game_numbering(spark, sf):
    orders = views.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return ps.number_games(orders, order=("o_orderdate", "o_orderkey")).select("o_orderkey", "Game_Number")


# --- sources and sinks -------------------------------------------------------


def month_keys(spark, sf):
    players = views.table(spark, sf, "customer").select(F.col("c_name").alias("player"))
    keys = ps.month_keys(players, AS_OF)
    return keys.selectExpr("player", big("year"), "month_of_year", "month")


def archive_flatten(spark, sf):
    docs = ps.read_archive(spark, views.archive(spark, sf))
    return ps.flatten_archive(docs).selectExpr(
        "player", "month", "url", "pgn IS NOT NULL AS has_text", "end_time", "_corrupt_record AS unread"
    )


def clean_games(spark, sf):
    docs = ps.read_archive(spark, views.archive(spark, sf))
    return ps.clean_games(ps.flatten_archive(docs)).select("player", "month", "url", "end_time")


def archive_gaps(spark, sf):
    path = views.archive(spark, sf)
    players = views.moves(spark, sf).selectExpr(f"{views.CLUB} AS player").distinct()
    gaps = ps.archive_gaps(ps.month_keys(players, AS_OF), ps.read_archive(spark, path))
    return gaps.select("player", "month")


def _months(spark, sf):
    players = views.moves(spark, sf).selectExpr(f"{views.CLUB} AS player").distinct()
    return ps.read_months(spark, views.archive(spark, sf), players, AS_OF)


def archive_source(spark, sf):
    there = _months(spark, sf).where("status IN ('found', 'corrupt')")
    return ps.flatten_archive(there).selectExpr(
        "player", "month", "url", "pgn IS NOT NULL AS has_text", "end_time", "rtrim('\n', _corrupt_record) AS unread"
    )


def archive_outcomes(spark, sf):
    return ps.month_outcomes(_months(spark, sf)).select("player", "month", "status")


def _snapshots(spark, sf):
    """Three snapshots, the middle one written twice."""
    mv = views.moves(spark, sf)
    root = shared_dir(spark, "snapshots")
    for date, df in (
        ("2024-01-01", mv.where("Move_Number <= 10")),
        ("2024-01-08", mv),
        ("2024-01-15", mv.where("Move_Number > 10")),
        ("2024-01-08", mv.where("Move_Number <= 25")),
    ):
        ps.write_snapshot(df, root, date)
    return root


def latest_snapshot(spark, sf):
    return moves_flat(ps.latest_snapshot(spark, _snapshots(spark, sf)))


def _per_snapshot(spark, root):
    return (
        spark.read.parquet(root)
        .groupBy(F.date_format(SNAPSHOT, "yyyy-MM-dd").alias("snapshot"))
        .agg(F.count(F.lit(1)).alias("plies"), F.sum("Evaluation.value").alias("eval_sum"))
    )


def snapshot_overwrite(spark, sf):
    return _per_snapshot(spark, _snapshots(spark, sf))


def staging_cleanup(spark, sf):
    root = _snapshots(spark, sf)
    ps.drop_staging(spark, root, "2024-01-08")
    ps.drop_staging(spark, root, "2024-01-08")
    return _per_snapshot(spark, root)


def ndjson_roundtrip(spark, sf):
    path = shared_dir(spark, "ndjson")
    mv = views.moves(spark, sf)
    ps.write_ndjson(mv, path)
    return moves_flat(ps.read_ndjson(spark, path, mv.schema))


def snapshot_empty_rerun(spark, sf):
    """The newest date run again without rows."""
    root = _snapshots(spark, sf)
    ps.write_snapshot(views.moves(spark, sf).where("false"), root, "2024-01-15")
    return _per_snapshot(spark, root)


def snapshot_crash(spark, sf):
    """A newer date that was left half written, and runs for it and for the newest
    committed date that fail midway."""
    root, mv = _snapshots(spark, sf), views.moves(spark, sf)
    mv.where("Move_Number <= 3").write.option(NO_SUCCESS_FILE, "false").parquet(snapshot_dir(root, "2024-01-22"))
    lost = mv.withColumn("Move", F.expr("CASE WHEN Game_Number % 5 = 4 THEN CAST(raise_error('lost') AS STRING) ELSE Move END"))
    for date in ("2024-01-15", "2024-01-22"):
        try:
            ps.write_snapshot(lost, root, date)
        except (PySparkException, Py4JJavaError):
            continue
        raise AssertionError("the run should have failed")
    return moves_flat(ps.latest_snapshot(spark, root))


def moves_scan(spark, sf):
    path, mv = shared_dir(spark, "moves"), views.moves(spark, sf)
    mv.write.parquet(path)
    return moves_flat(ps.read_moves(spark, path, mv.schema))


def analysis_ndjson(spark, sf):
    path, done = shared_dir(spark, "analysis"), ps.move_analysis(views.moves(spark, sf), ordered=False)
    ps.write_ndjson(done, path)
    return analysis_out(ps.read_ndjson(spark, path, done.schema))


def ndjson_inferred(spark, sf):
    path = shared_dir(spark, "ndjson")
    ps.write_ndjson(views.moves(spark, sf), path)
    return moves_flat(ps.read_ndjson(spark, path))


def run_audit(spark, sf):
    texts_seen = ps.audited(views.game_texts(spark, sf), "games", ("pgn",))
    moves_seen = ps.audited(views.moves(spark, sf), "moves", ("Evaluation", "WDL Stats"))
    for df, _ in (texts_seen, moves_seen):
        df.write.format("noop").mode("overwrite").save()
    return ps.audit_table(spark, [("games", texts_seen[1]), ("moves", moves_seen[1])])


# --- whole jobs --------------------------------------------------------------


def _named(df: DataFrame) -> DataFrame:
    return df.withColumn("Game_Link", F.coalesce("Game_Link", F.lit("none")))


def refresh(spark, sf):
    done = ps.refresh(spark, views.archive(spark, sf), shared_dir(spark, "refresh"), AS_OF, demo_scorer)
    return analysis_out(_named(done.analysis), "Game_Link")


def refresh_backfill(spark, sf):
    """An older date run after a newer one that held other games."""
    root = shared_dir(spark, "backfill")
    third = views.game_texts(spark, sf).where("Game_Number % 3 = 0")
    ps.refresh(spark, views.write_archive(third, shared_dir(spark, "archive")), root, AS_OF, demo_scorer)
    done = ps.refresh(spark, views.archive(spark, sf), root, "2024-05-08", demo_scorer)
    return analysis_out(_named(done.analysis), "Game_Link")


def refresh_reports(spark, sf):
    done = ps.refresh(spark, views.archive(spark, sf), shared_dir(spark, "reports"), AS_OF, demo_scorer)
    return done.reports["blunder_triggers"]


def _two_drops(spark, sf):
    """Two drops that share games, then a run with nothing new."""
    text = views.game_texts(spark, sf)
    landing, target = shared_dir(spark, "landing"), shared_dir(spark, "target")
    views.write_archive(text.where("Game_Number % 3 <> 2"), landing)
    ps.refresh_incremental(spark, landing, target, demo_scorer)
    views.write_archive(text.where("Game_Number % 3 <> 0"), landing, marks=False)
    ps.refresh_incremental(spark, landing, target, demo_scorer)
    return ps.refresh_incremental(spark, landing, target, demo_scorer)


def incremental_refresh(spark, sf):
    moves = _two_drops(spark, sf).moves
    done = ps.move_analysis(moves, game="game_key", ordered=False, keep=("Game_Link",))
    return analysis_out(_named(done), "Game_Link")


def incremental_analysis(spark, sf):
    return analysis_out(_named(_two_drops(spark, sf).analysis), "Game_Link")


def incremental_relanded(spark, sf):
    """A first run with nothing landed; documents that lack games, hold games cut short,
    and hold one that is gone later; then the same documents again as they should be."""
    text = views.game_texts(spark, sf)
    landing, target = shared_dir(spark, "landing"), shared_dir(spark, "target")
    ps.refresh_incremental(spark, landing, target, demo_scorer)
    short = text.where("Game_Number % 4 <> 1").withColumn(
        "pgn", F.expr("CASE WHEN Game_Number % 4 = 2 THEN concat(substring_index(pgn, '1. ', 1), '1. a4 a5 2. h4') ELSE pgn END")
    )
    gone = text.where("Game_Number % 4 = 3").withColumn("pgn", F.lit("1. a4 a5"))
    views.land_documents(short.unionByName(gone), landing)
    ps.refresh_incremental(spark, landing, target, demo_scorer)
    views.land_documents(text, landing)
    return analysis_out(_named(ps.refresh_incremental(spark, landing, target, demo_scorer).analysis), "Game_Link")


def _streamed(spark, sf):
    """Two drops taken in by a stream over the archive source, of which the second puts other
    games into the documents of the first."""
    text = views.game_texts(spark, sf)
    landing, target, plans, checkpoint, audit = (shared_dir(spark, n) for n in ("landing", "target", "plans", "stream", "audit"))
    for drop in ("Game_Number % 3 <> 2", "Game_Number % 3 <> 0"):
        views.land_documents(text.where(drop), landing)
        months = ps.flatten_archive(ps.stream_months(spark, landing, plans))
        ps.stream_games(months, target, checkpoint, demo_scorer, audit).awaitTermination()
    return target, audit


def stream_refresh(spark, sf):
    target, _ = _streamed(spark, sf)
    return analysis_out(_named(ps.current_tables(spark, target)[1]), "Game_Link")


def stream_audit(spark, sf):
    _, audit = _streamed(spark, sf)
    return ps.stream_audit(spark, audit).select("batch", "stage", "counter", "value")


def _three_drops(spark, sf):
    """Three runs that keep numbers and reports: documents that lack games, hold texts cut short
    and ends that are too late; the same documents put right; then late games in them."""
    text = views.game_texts(spark, sf)
    landing, target = shared_dir(spark, "landing"), shared_dir(spark, "target")
    there = text.where("Game_Number % 4 <> 1")
    wrong = there.withColumns(
        {
            "end_time": F.expr("CASE WHEN Game_Number % 4 = 2 THEN end_time + 9000000 ELSE end_time END"),
            "pgn": F.expr("CASE WHEN Game_Number % 4 = 3 THEN concat(substring_index(pgn, '1. ', 1), '1. a4 a5 2. h4') ELSE pgn END"),
        }
    )
    for drop in (wrong, there, text):
        views.land_documents(drop, landing)
        done = ps.weekly_run(spark, landing, target, demo_scorer, range_games=100)
    return done


def incremental_numbering(spark, sf):
    numbers = _three_drops(spark, sf).numbers
    return numbers.selectExpr("CASE WHEN game_key LIKE 'md5:%' THEN 'none' ELSE game_key END AS Game_Link", "Game_Number")


def incremental_reports(spark, sf):
    return _three_drops(spark, sf).reports["blunder_triggers"]


def incremental_performance(spark, sf):
    return _three_drops(spark, sf).reports["performance_summary"]


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        move_analysis,
        move_analysis_long_games,
        move_analysis_null_game,
        move_analysis_long_ordered,
        move_analysis_arrays,
        eval_fields,
        wdl_from_end,
        player_to_move,
        centipawn_loss,
        win_probability,
        move_accuracy,
        game_phase,
        side_aggregates,
        player_filter,
        player_layout,
        phase_breakdown,
        phase_drop,
        performance_summary,
        performance_as_of,
        performance_of_one,
        blunder_habits,
        blunder_plies,
        blunder_triggers,
        opening_repertoire,
        name_openings,
        name_openings_shuffle,
        games_to_review,
        analysis_context,
        game_headers,
        game_plies,
        ply_count,
        quarantine,
        moves_fact,
        score_positions,
        score_book,
        score_join,
        game_numbering,
        month_keys,
        archive_flatten,
        archive_gaps,
        archive_source,
        archive_outcomes,
        clean_games,
        latest_snapshot,
        snapshot_overwrite,
        snapshot_empty_rerun,
        snapshot_crash,
        staging_cleanup,
        ndjson_roundtrip,
        moves_scan,
        analysis_ndjson,
        ndjson_inferred,
        run_audit,
        refresh,
        refresh_backfill,
        refresh_reports,
        incremental_refresh,
        incremental_analysis,
        incremental_relanded,
        incremental_numbering,
        incremental_reports,
        incremental_performance,
        stream_refresh,
        stream_audit,
    )
}
