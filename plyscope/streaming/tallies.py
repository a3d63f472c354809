"""Report tables of an arriving history, kept as sums that are added to and taken from.

Each run adds the plies and sides of the copies that now count and takes away those of copies
that no longer do; so a report folds small tables of sums, never the history. Sums are whole
numbers or decimals: they take back exactly what was added, in any order. The lists of games
come from a table with one row for each side of a game.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plyscope.functions import scoring as sc
from plyscope.operators import report as rp
from plyscope.operators.scores import Scorer
from plyscope.session import land
from plyscope.sources import tables as tb
from plyscope.streaming import intake
from plyscope.streaming.changes import Changes, changes
from plyscope.streaming.numbering import PLACE, RANGE_GAMES, game_numbers, update_numbers

#: Plies a stretch of `blunder_plies` has, moves an opening has, runs kept before they are folded.
WIDTH, OPENING_PLIES, MOST_RUNS = 10, 6, 16
#: Each kept table: what it is kept by, and what is summed.
TABLES = {
    "phases": ("player string, game_phase string", "n long, accuracy decimal(38,15)"),
    "mistakes": ("player string, kind string, game_phase string, after_move string, state string, stretch long", "n long, steps long"),
    "results": ("player string, colour string, opening string, month date", "n long, won long, accuracy long, with_accuracy long"),
    "sides": (
        "place string, game_key string, digest long, player string, colour string, opening string, lost int, accuracy double, "
        "Game_Link string, x struct<steps:long,neg_ply:int,move:string,phase:string>",
        "n long",
    ),
}


def _names(columns: str) -> list[str]:
    return [c.split()[0] for c in columns.split(", ")]


def _marks(target: str) -> str:
    return f"{target}/reports/_runs"


def _state(spark: SparkSession, target: str) -> dict:
    """The last whole run: its number, the runs in force, and the batches they hold."""
    done = [int(n) for n in tb._files(spark, _marks(target)) if n.isdigit()]
    if not done:
        return {"run": -1, "runs": [], "seen": []}
    return {"run": max(done), **tb.get_mark(spark, f"{_marks(target)}/{max(done):012d}")}


def _kept(spark: SparkSession, target: str, table: str, runs: list[str]) -> DataFrame:
    """The rows of a table in the runs in force; several may speak of the same key."""
    keys, sums = TABLES[table]
    if not runs:
        return spark.createDataFrame([], f"{keys}, {sums}")
    path = f"{target}/reports/{table}"
    return spark.read.schema(f"{keys}, {sums}, run string").parquet(path).where(F.col("run").isin(runs)).drop("run")


def _folded(rows: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """Sums by `keys`, without those that are all zero. A run may add one mistake to a key and
    take another away: the counts then cancel out, and the losses do not."""
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums]).where(" OR ".join(f"{c} <> 0" for c in sums))


def _plies_of(spark: SparkSession, target: str, change: Changes) -> DataFrame:
    """The analysed plies of the copies in `change`, with their sign; only partitions of the
    batches that hold such a copy are read."""
    copies = change.rows.groupBy("game_key", "digest").agg(F.sum("sign").cast("int").alias("sign"))
    copies = land(copies, "changed-copies")
    by = ["game_key", "digest"]
    noted = intake._table(spark, f"{target}/games", intake.COPIES)
    holding = [r.batch for r in intake._met(noted, copies.select(*by), by).select("batch").distinct().collect()]
    analysis = intake._table(spark, f"{target}/analysis", intake.ANALYSIS_ROWS).where(F.col("batch").isin(holding))
    return analysis.join(rp.bounded_broadcast(copies, intake.SMALL_KEYS)[0], by)


def _side_rows(plies: DataFrame, change: Changes) -> DataFrame:
    """Two rows per changed copy, one for each side, with what lists and results need."""
    costliest = lambda side: f"max(CASE WHEN delta > 0 AND {side('Move_Number')} THEN {rp.COSTLIEST} END)"
    constant = ("Game_Link", "White", "Black", "End_Date", "Result", "Game_Accuracy_White", "Game_Accuracy_Black")
    folds = {c: f"max({c})" for c in constant}
    folds |= {f"_{i}": f"max(CASE WHEN Move_Number = {i} THEN Move END)" for i in range(1, OPENING_PLIES + 1)}
    folds |= {"x_white": costliest(sc.white_ply_sql), "x_black": costliest(sc.black_ply_sql)}
    games = plies.groupBy("game_key", "digest").agg(*[F.expr(x).alias(c) for c, x in folds.items()])
    point = sc.white_score_sql()

    def side(name: str, won: int) -> str:
        return (
            f"named_struct('player', lower({name}), 'colour', '{name.lower()}', 'accuracy', Game_Accuracy_{name}, 'x', x_{name.lower()}, "
            f"'won', CAST({point} <=> {won}D AS INT), 'lost', CAST({point} <=> {1 - won}D AS INT))"
        )

    opening = f"concat_ws(' ', {', '.join(f'_{i}' for i in range(1, OPENING_PLIES + 1))}) AS opening"
    sides = games.selectExpr(
        "game_key", "digest", "Game_Link", opening, f"trunc(try_to_date(End_Date, '{rp.DATE_FORMAT}'), 'MM') AS month",
        f"inline(array({side('White', 1)}, {side('Black', 0)}))",
    )
    return sides.join(change.rows.selectExpr("game_key", "digest", "sign", f"{PLACE} AS place"), ["game_key", "digest"])


def update_reports(spark: SparkSession, target: str, most_runs: int = MOST_RUNS) -> dict:
    """Takes in what has changed since the last call.

    Reads the notes on copies, and the plies of copies that began or ceased to count. The sums
    are written under a run of their own and its mark last, so a run that failed changes
    nothing and is repeated. After `most_runs` runs the kept sums are folded into one.
    """
    state = _state(spark, target)
    change = changes(spark, target, state["seen"])
    if change.batches == state["seen"]:
        return state
    runs, number = [] if change.afresh else state["runs"], state["run"] + 1
    plies = land(_plies_of(spark, target, change), "changed-plies")
    whole = plies.where("sign <> 0")
    sides = land(_side_rows(plies, change), "changed-sides")
    mistakes = rp.mistakes_in_context(whole, game="concat(game_key, '#', digest)", keep=("sign",))
    new = {
        "phases": whole.selectExpr(
            "lower(Player_To_Move) AS player", "game_phase", "CAST(sign AS BIGINT) AS n", "sign * CAST(move_accuracy AS DECIMAL(20, 15)) AS accuracy"
        ),
        "mistakes": mistakes.selectExpr(
            "player", "kind", "game_phase", "after_move", "state", f"CAST((_ply - 1) div {WIDTH} AS BIGINT) AS stretch", "CAST(sign AS BIGINT) AS n", "sign * steps AS steps"
        ),
        "results": sides.selectExpr(
            "player", "colour", "opening", "month", "sign AS n", "sign * won AS won",
            "sign * CAST(round(accuracy * 100) AS BIGINT) AS accuracy", "CASE WHEN accuracy IS NOT NULL THEN sign ELSE 0L END AS with_accuracy",
        ),
        "sides": sides.withColumnRenamed("sign", "n"),
    }
    fold = len(runs) >= most_runs
    run = f"{number:012d}"
    for table, (keys, sums) in TABLES.items():
        keys, sums = _names(keys), _names(sums)
        rows = new[table].select(*keys, *sums)
        if fold:
            rows = rows.unionByName(_kept(spark, target, table, runs))
        out = _folded(rows, keys, sums)
        wanted = _kept(spark, target, table, []).schema
        out.select(*[F.col(f.name).cast(f.dataType) for f in wanted]).write.mode("overwrite").parquet(f"{target}/reports/{table}/run={run}")
    runs = [run] if fold else [*runs, run]
    state = {"runs": runs, "seen": change.batches}
    tb.put_mark(spark, _marks(target), run, state)
    return {"run": number, **state}


def _live_sides(spark: SparkSession, target: str, runs: list[str]) -> DataFrame:
    """The sides of games that count. Rows of a game that was ever taken away are summed; all
    others are as they were written, and are not shuffled for it."""
    rows = _kept(spark, target, "sides", runs)
    taken = land(rows.where("n < 0").select("game_key").distinct(), "taken-away")
    taken, _ = rp.bounded_broadcast(taken, intake.SMALL_KEYS)
    columns = [c for c in rows.columns if c != "n"]
    summed = rows.join(taken, "game_key", "left_semi").groupBy(*columns).agg(F.sum("n").alias("n")).where("n > 0")
    return rows.join(taken, "game_key", "left_anti").unionByName(summed.select(*rows.columns)).drop("n")


def _of(player: str | None) -> Column:
    return F.lit(True) if player is None else F.col("player") == player.lower()


def kept_reports(
    spark: SparkSession,
    target: str,
    player: str | None = None,
    as_of: dt.date | str | None = None,
    min_games: int = 3,
    names: DataFrame | None = None,
    review: int = 3,
    k: int = 5,
) -> dict[str, DataFrame]:
    """The tables of `report_tables`, from what `update_reports` and `update_numbers` keep."""
    runs = _state(spark, target)["runs"]
    phases = _kept(spark, target, "phases", runs).where(_of(player)).groupBy("player", "game_phase")
    phases = phases.agg(F.sum("n").alias("n"), F.sum("accuracy").alias("accuracy")).where("n > 0")
    phases = phases.selectExpr("player", "game_phase", f"{sc.round2_sql('CAST(accuracy AS DOUBLE) / n')} AS avg_accuracy")
    by_phase = {p: F.max(F.when(F.col("game_phase") == p, F.col("avg_accuracy"))).alias(p) for p in rp.PHASES}

    mistakes = _folded(
        _kept(spark, target, "mistakes", runs).where(_of(player)), _names(TABLES["mistakes"][0]), ["n", "steps"]
    )
    per_kind = mistakes.groupBy("player", "kind").agg(
        F.sum("n").alias("n"),
        F.expr("round(sum(steps) * 5 / sum(n)) / 10000").alias("avg_loss"),
        *[F.expr(f"coalesce(sum(n) FILTER (WHERE game_phase = '{p}'), 0L)").alias(f"in_{p}") for p in rp.PHASES],
    )
    stretches = mistakes.groupBy("player", "kind", F.col("stretch").alias("_s")).agg(F.sum("n").alias("n"))
    triggers = mistakes.groupBy("player", "kind", "after_move", "state", "game_phase").agg(F.sum("n").alias("n"))

    results = _kept(spark, target, "results", runs).where(_of(player))
    mean = "round(CAST(sum(accuracy) AS DOUBLE) / nullif(sum(with_accuracy), 0)) / 100"
    monthly = results
    if as_of is not None:
        this = f"trunc(DATE '{dt.date.fromisoformat(str(as_of))}', 'MM')"
        this_month = results.where(f"month IN ({this}, add_months({this}, -1))")
    by_month = lambda rows: rows.groupBy("player", "colour", F.col("month").alias("_month")).agg(
        F.sum("n").alias("n"), F.sum("won").alias("w"), F.expr(mean).alias("a")
    ).where("n > 0")
    openings = results.groupBy("player", "opening").agg(
        F.sum("n").alias("games"), F.expr("round(sum(won) / nullif(sum(n), 0), 4)").alias("win_rate"), F.expr(mean).alias("avg_accuracy")
    )
    openings = openings.where(f"games > 0 AND games >= {int(min_games)}")

    sides = _live_sides(spark, target, runs).where(_of(player))
    # Places sort as numbers do, so the numbers are only looked up for the games that are listed.
    weak = rp.weak_games(sides, review, "place").select("player", "opening", "_n", "game_key")
    listed = rp.best_and_worst(openings, 3)
    weak = weak.join(listed.where("side = 'worst'").select("player", "opening"), ["player", "opening"], "left_semi")
    weak = _numbered(spark, target, weak).selectExpr("player", "opening", "_n", "CAST(Game_Number AS STRING) AS _g")
    repertoire = rp.with_weak_games(listed, weak)

    costly = sides.where("x IS NOT NULL").groupBy("player", "game_key", "place", "Game_Link").agg(F.max("x").alias("x"))
    place = "row_number() OVER (PARTITION BY player ORDER BY x.steps DESC, place)"
    costly = costly.selectExpr("*", f"{place} AS _k").where(f"_k <= {int(k)}")
    review_list = rp.costliest_plies(_numbered(spark, target, costly), ("Game_Number",))
    out = {} if as_of is None else {"this_month": rp.month_by_month(by_month(this_month), as_of)}
    return out | {
        "performance_summary": rp.month_by_month(by_month(monthly)),
        "blunder_habits": rp.habit_shares(per_kind),
        "blunder_plies": rp.top_stretches(stretches, 3, WIDTH),
        "blunder_triggers": rp.trigger_shares(triggers),
        "opening_repertoire": repertoire if names is None else rp.name_openings(repertoire, names),
        "phase_breakdown": phases.orderBy("player", "game_phase"),
        "phase_drop": rp.worst_phases(phases.groupBy("player").agg(*by_phase.values())),
        "games_to_review": review_list,
    }


def _numbered(spark: SparkSession, target: str, listed: DataFrame) -> DataFrame:
    """Adds the numbers of the few games in `listed`; the table of numbers is scanned, not shuffled."""
    listed = land(listed, "listed-games")
    numbers = intake._met(game_numbers(spark, target), listed.select("game_key").distinct(), ["game_key"])
    return listed.join(numbers, "game_key")


def weekly_run(
    spark: SparkSession, landing: str, target: str, scorer: Scorer, one_per_file: bool = True, range_games: int = RANGE_GAMES, **reports
) -> intake.Incremental:
    """The whole incremental job: takes in new documents, then brings numbers and reports up to
    date. `reports` are options of `kept_reports`."""
    done = intake.refresh_incremental(spark, landing, target, scorer, one_per_file)
    state = update_numbers(spark, target, range_games)
    update_reports(spark, target)
    done.numbers, done.reports = game_numbers(spark, target, state), kept_reports(spark, target, **reports)
    return done
