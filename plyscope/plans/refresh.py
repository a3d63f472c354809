"""The whole refresh as one batch job: archive to moves, analysis and report tables."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from plyscope.operators import games as gm
from plyscope.operators import report as rp
from plyscope.operators.scores import Scorer, score_positions
from plyscope.operators.sequence import number_games
from plyscope.plans.analysis import move_analysis
from plyscope.session import land
from plyscope.sources import archive as ar
from plyscope.sources import tables as tb
from plyscope.sources.audit import audit_table, audited

CONTEXT = ("game_key", "Game_Link", "White", "Black", "Start_Date", "End_Date", "Result", "delta", "wp_before")


@dataclass
class Refreshed:
    moves: DataFrame
    analysis: DataFrame
    quarantine: DataFrame
    missing_tags: DataFrame
    audit: DataFrame
    reports: dict[str, DataFrame] = field(default_factory=dict)


def report_tables(
    analysis: DataFrame,
    player: str | None = None,
    as_of: dt.date | str | None = None,
    min_games: int = 3,
    names: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The report's data, as lazy tables over a written analysis.

    With `as_of` there is also `this_month`: that month against the one before. With `names`
    (moves, name) the repertoire says what its openings are called.
    """
    sheet = rp.game_sheet(analysis)
    sides = rp.opening_results(sheet, rp.first_moves(analysis))
    repertoire = rp.opening_repertoire(sides, player, min_games)
    this_month = {} if as_of is None else {"this_month": rp.performance_summary(sheet, player, as_of)}
    return this_month | {
        "performance_summary": rp.performance_summary(sheet, player),
        "blunder_habits": rp.blunder_habits(analysis, player),
        "blunder_plies": rp.blunder_plies(analysis, player),
        "blunder_triggers": rp.blunder_triggers(analysis, player),
        "opening_repertoire": repertoire if names is None else rp.name_openings(repertoire, names),
        "phase_breakdown": rp.phase_breakdown(analysis, player),
        "phase_drop": rp.phase_drop(analysis, player),
        "games_to_review": rp.games_to_review(analysis, player),
    }


def refresh(
    spark: SparkSession,
    landing: str,
    root: str,
    snapshot_date: dt.date | str,
    scorer: Scorer,
    player: str | None = None,
    one_per_file: bool = True,
    names: DataFrame | None = None,
) -> Refreshed:
    """Runs every stage and writes moves, analysis, quarantine and missing tags under `root`.

    Each stage reads what the stage before it wrote for this date, whatever other dates
    are there, so a lost executor repeats one stage at most and an older date can be run
    again. A landing without games gives empty tables. The raw snapshot goes once the
    moves are written. The reports set the snapshot's month against the month before.
    """
    staging = f"{root}/raw"
    docs, seen_docs = audited(ar.read_archive(spark, landing, one_per_file), "months", ("games",))
    raw, seen_raw = audited(ar.flatten_archive(docs), "raw_games", ("pgn",))
    tb.write_snapshot(raw, staging, snapshot_date)

    staged = tb.read_snapshot(spark, staging, snapshot_date, raw.schema)
    clean, seen_clean = audited(ar.clean_games(staged, keep=("end_time",)), "clean_games")
    # Landed, so that no text is parsed a second time by the passes that follow.
    parsed = land(gm.tag_games(gm.parse_games(gm.distinct_games(clean))), "parsed")
    good, aside = gm.split_quarantine(number_games(parsed))
    unread = ar.corrupt_documents(staged).selectExpr(
        "concat(player, '/', month) AS game_key", "'corrupt_document' AS reason", "_corrupt_record AS text"
    )
    set_aside = aside.selectExpr("game_key", "reason", "pgn AS text").unionByName(unread)
    tb.write_snapshot(set_aside, f"{root}/quarantine", snapshot_date)
    missing = good.where("missing_headers <> ''").select("game_key", "missing_headers")
    tb.write_snapshot(missing, f"{root}/missing_tags", snapshot_date)

    scored = score_positions(gm.build_moves(good, ("Game_Number",)), scorer).drop("position")
    moves, seen_moves = audited(scored, "moves", ("Evaluation", "WDL Stats"))
    tb.write_snapshot(moves, f"{root}/moves", snapshot_date)
    tb.drop_staging(spark, staging, snapshot_date)

    written = tb.read_snapshot(spark, f"{root}/moves", snapshot_date, moves.schema)
    analysed = move_analysis(written, ordered=False, keep=CONTEXT)
    analysed, seen_analysis = audited(analysed, "analysis", ("CentiPawnLoss",))
    tb.write_snapshot(analysed, f"{root}/analysis", snapshot_date, ("Game_Number", "Move_Number"))

    analysis = tb.read_snapshot(spark, f"{root}/analysis", snapshot_date, analysed.schema)
    seen = [
        ("months", seen_docs),
        ("raw_games", seen_raw),
        ("clean_games", seen_clean),
        ("moves", seen_moves),
        ("analysis", seen_analysis),
    ]
    return Refreshed(
        moves=written,
        analysis=analysis,
        quarantine=tb.read_snapshot(spark, f"{root}/quarantine", snapshot_date, set_aside.schema),
        missing_tags=tb.read_snapshot(spark, f"{root}/missing_tags", snapshot_date, missing.schema),
        audit=audit_table(spark, seen),
        reports=report_tables(analysis, player, snapshot_date, names=names),
    )
