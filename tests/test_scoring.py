import random

import pytest
from pyspark.sql import functions as F

import plyscope as ps
from plyscope.functions import scoring as sc
from plyscope.operators import sequence
from tests.helpers import check_scored, moves

GAME1 = [
    (1, 1, 30, [80, 850, 70]),
    (1, 2, 20, [100, 840, 60]),
    (1, 3, 50, [60, 800, 140]),
    (1, 4, 250, [700, 250, 50]),
    (1, 5, -40, [150, 500, 350]),
]
GAME2 = [(2, 1, 30, [80, 850, 70]), (2, 2, None, None), (2, 3, 50, [60, 800, 140]), (2, 4, 250, [700, 250, 50])]
GAME3 = [(3, 1, 5, [5, 5, 990])]


def rounded(df):
    return {
        (r.Game_Number, r.Move_Number): (
            r.CentiPawnLoss,
            None if r.delta is None else round(r.delta, 6),
            round(r.move_accuracy, 6),
            (r.ACPL_White, r.ACPL_Black, r.Game_Accuracy_White, r.Game_Accuracy_Black),
        )
        for r in df.collect()
    }


@pytest.mark.parametrize("chunk", [1, 2, 3, 4096])
def test_golden_games(spark, chunk):
    got = rounded(ps.score_plies(moves(spark, GAME1 + GAME2 + GAME3), chunk_plies=chunk))
    means = (96.67, 100.0, 78.52, 58.01)
    assert got[(1, 1)] == (None, None, 100.0, means)
    assert got[(1, 2)] == (-10, 0.025, 89.359786, means)
    assert got[(1, 3)] == (-30, -0.02, 100.0, means)
    assert got[(1, 4)] == (200, 0.285, 26.661385, means)
    assert got[(1, 5)] == (290, 0.225, 35.566299, means)
    means = (0.0, 100.0, 100.0, 63.33)
    assert got[(2, 1)] == got[(2, 2)] == got[(2, 3)] == (None, None, 100.0, means)
    assert got[(2, 4)] == (200, 0.285, 26.661385, means)
    assert got[(3, 1)] == (None, None, 100.0, (0.0, None, 100.0, None))


def random_rows(seed, games=12, longest=60):
    rnd = random.Random(seed)
    rows = []
    for g in range(1, games + 1):
        numbers = rnd.sample(range(-5, 200), rnd.randint(1, longest))
        for n in numbers:
            ev = None if rnd.random() < 0.1 else rnd.randint(-300, 300)
            w, d = rnd.randint(0, 700), rnd.randint(0, 300)
            wdl = rnd.choice([[w, d, 1000 - w - d]] * 8 + [[w, d], [d], None])
            rows.append((g, n, ev, wdl))
        if rnd.random() < 0.4:
            rows.append((g, None, rnd.randint(-300, 300), [100, 200, 700]))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("mode", ["check", "all"])
@pytest.mark.parametrize("chunk", [1, 3, 16, 4096])
def test_gaps_nulls_and_chunks_match_brute_force(spark, chunk, mode):
    rows = random_rows(chunk)
    check_scored(ps.score_plies(moves(spark, rows), chunk_plies=chunk, long_games=mode), rows)


@pytest.mark.parametrize("chunk", [3, 4096])
def test_skip_first(spark, chunk):
    rows = random_rows(7)
    df = ps.score_plies(moves(spark, rows), chunk_plies=chunk, skip_first=True)
    check_scored(df, rows, skip_first=True)


def test_many_long_games_take_the_path_without_broadcast(spark, monkeypatch):
    from plyscope.operators import sequence

    monkeypatch.setattr(sequence, "BROADCAST_GAMES", 2)
    rows = random_rows(11)
    check_scored(ps.score_plies(moves(spark, rows), chunk_plies=4), rows)


def test_one_game_with_most_rows(spark):
    rows = [(1, n, n * 37 % 601 - 300, [n * 13 % 700, n % 300, 0]) for n in range(1, 4001)]
    rows += [(g, n, g * n % 300, [g * n % 700, 100, 0]) for g in range(2, 40) for n in range(1, 30)]
    check_scored(ps.score_plies(moves(spark, rows), chunk_plies=64), rows)


def test_short_games_may_be_asserted(spark):
    rows = [r for r in random_rows(3) if r[1] is not None]
    check_scored(ps.score_plies(moves(spark, rows), long_games="none"), rows)


def test_a_broken_promise_of_short_games_fails(spark):
    rows = random_rows(3)
    with pytest.raises(Exception, match="beyond the first chunk"):
        ps.score_plies(moves(spark, rows), long_games="none", chunk_plies=3).collect()


@pytest.mark.parametrize("ordered", [False, True])
@pytest.mark.parametrize("mode", ["check", "all"])
def test_a_null_game_over_several_chunks(spark, mode, ordered):
    rows = [(g, n, n * 37 % 601 - 300, [n * 13 % 700, n % 300, 0]) for g in (None, 1, 2) for n in range(1, 30)]
    df = ps.score_plies(moves(spark, rows), chunk_plies=4, long_games=mode, ordered=ordered)
    check_scored(df, rows)
    if ordered:
        got = [(r.Game_Number, r.Move_Number) for r in df.collect()]
        assert got == sorted(got, key=lambda x: (x[0] is None, x[0] or 0, x[1]))


def test_result_does_not_depend_on_partitions(spark):
    df = moves(spark, random_rows(5))
    one = sorted(map(str, ps.score_plies(df.coalesce(1), chunk_plies=8).collect()))
    many = sorted(map(str, ps.score_plies(df.repartition(7), chunk_plies=8).collect()))
    assert one == many


def test_total_order_puts_nulls_last(spark):
    rows = random_rows(9)
    got = [(r.Game_Number, r.Move_Number) for r in ps.move_analysis(moves(spark, rows), chunk_plies=16).collect()]
    assert got == sorted(got, key=lambda x: (x[0], x[1] is None, x[1] or 0))


def test_analysis_columns(spark):
    from plyscope.schemas import ANALYSIS_COLUMNS

    assert ps.move_analysis(moves(spark, GAME1)).columns == ANALYSIS_COLUMNS


def test_mate_policy(spark):
    df = spark.createDataFrame(
        [(("mate", -3),), (("mate", 2),), (("cp", 40),), (None,)], "Evaluation struct<type:string,value:long>"
    )
    clamped = [r[0] for r in df.select(sc.evaluation_value(mate_policy="clamp")).collect()]
    assert clamped == [-1000, 1000, 40, None]
    assert [r[0] for r in df.select(sc.evaluation_value()).collect()] == [-3, 2, 40, None]


def test_from_end_on_short_lists(spark):
    df = spark.createDataFrame([([7, 8, 9],), ([7, 8],), ([7],), ([],), (None,)], "a array<long>")
    got = [tuple(r) for r in df.select(sc.from_end("a", 3), sc.from_end("a", 2)).collect()]
    assert got == [(7, 8), (None, 7), (None, None), (None, None), (None, None)]


def test_phase_bounds_and_null_ply(spark):
    df = spark.createDataFrame([(n,) for n in (1, 10, 11, 25, 26, 0, None)], "n int")
    row = df.select(sc.game_phase("n"), sc.player_to_move("n", "'w'", "'b'")).collect()
    assert [r[0] for r in row] == ["opening", "opening", "middlegame", "middlegame", "endgame", "endgame", "endgame"]
    assert [r[1] for r in row] == ["w", "b", "w", "w", "b", "b", "b"]


def test_round2_keeps_halves(spark):
    df = spark.createDataFrame([(1.005,), (0.285,), (2.675,), (None,)], "x double")
    duck = __import__("duckdb").sql("SELECT round(x, 2) FROM (VALUES (1.005::DOUBLE), (0.285), (2.675), (NULL)) t(x)")
    assert [r[0] for r in df.select(sc.round2("x")).collect()] == [r[0] for r in duck.fetchall()]


def test_accuracy_is_bounded_and_falls(spark):
    df = spark.range(-200, 201).select((F.col("id") / 200).alias("d"))
    acc = [r[0] for r in df.orderBy("d").select(sc.move_accuracy("d")).collect()]
    assert all(0 <= a <= 100 for a in acc) and acc == sorted(acc, reverse=True)


def test_perspectives(spark):
    rows = [(1, 1, 30, [80, 850, 70]), (1, 2, 20, [100, 840, 60])]
    df = moves(spark, rows)
    turned = ps.normalise_scores(df, eval_perspective="mover", wdl_perspective="white")
    got = {r.Move_Number: (r.Evaluation.value, r["WDL Stats"]) for r in turned.collect()}
    assert got == {1: (-30, [70, 850, 80]), 2: (20, [100, 840, 60])}
    same = ps.normalise_scores(df)
    assert same.collect() == df.collect()
    with pytest.raises(ValueError):
        ps.normalise_scores(df, eval_perspective="up")


@pytest.mark.parametrize("wide, mode", [(2, "check"), (3, "check"), (3, "all"), (64, "all")])
def test_carry_over_blocks_of_chunks(spark, monkeypatch, wide, mode):
    """Long games with gaps, rows without a ply and a NULL game, over two levels of blocks."""
    monkeypatch.setattr(sequence, "WIDE", wide)
    rnd = random.Random(wide)
    rows = []
    for game, n in ((1, 90), (None, 61), (3, 7), (4, 1)):
        for ply in sorted(rnd.sample(range(1, 2 * n), n - 1)) + [None]:
            w, d = rnd.randint(0, 700), rnd.randint(0, 300)
            rows.append((game, ply, rnd.choice([None, rnd.randint(-300, 300)]), rnd.choice([None, [w, d, 1000 - w - d]])))
    cut = moves(spark, rows).selectExpr("*", "coalesce(Move_Number, 9223372036854775807) AS _o").selectExpr("*", "(_o - 1) div 2 AS _chunk")
    assert sequence._levels(cut, "Move_Number", 2, mode) == 2
    check_scored(ps.score_plies(moves(spark, rows), chunk_plies=2, long_games=mode), rows)


def test_no_task_holds_a_very_long_game(spark):
    """The chunks of one game of fifty million plies: no window sees more than a hundredth."""
    n = 50_000_000 // sequence.CHUNK_PLIES
    chunks = spark.range(n).selectExpr("1L AS g", "id AS _chunk", "struct(id AS ev) AS _tail", "1L AS k")
    told = sequence.tails_before(chunks, "g", "_chunk", 2)
    assert told.where("NOT (_before.ev <=> IF(_chunk = 0, NULL, _chunk - 1))").count() == 0
    assert sequence.with_totals(chunks.drop("_tail"), "g", "_chunk", ("k",), 2).where(f"k <> {n}").count() == 0
    plan = told._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") >= 3
    for level in (1, 2):
        per_key = chunks.selectExpr(f"_chunk div {sequence.WIDE ** (level - 1)} AS at").distinct().groupBy(F.expr(f"at div {sequence.WIDE}")).count()
        assert per_key.agg(F.max("count")).first()[0] <= n / 100
    assert n // sequence.WIDE**2 + 1 <= n / 100  # the blocks at the top


@pytest.mark.parametrize("chunk", [1, 3, 16, 4096])
@pytest.mark.parametrize("skip_first", [False, True])
def test_arrays_of_plies_match_brute_force(spark, chunk, skip_first):
    rows = [r for r in random_rows(chunk + 20) if r[1] is not None]
    rows += [(None, n, n * 37 % 601 - 300, [n * 13 % 700, n % 300, 0]) for n in range(1, 12)] + [(99, None, 4, [1, 2, 3])]
    df = ps.score_chunks(ps.game_chunks(moves(spark, rows), chunk_plies=chunk), skip_first=skip_first)
    check_scored(df, rows, skip_first=skip_first)


def test_arrays_are_scored_without_a_shuffle_of_plies(spark, tmp_path, monkeypatch):
    from plyscope.operators import arrays

    path = str(tmp_path / "chunks")
    rows = [(g, n, n * 37 % 601 - 300, [n * 13 % 700, n % 300, 0]) for g in range(1, 30) for n in range(1, 20 if g < 28 else 60)]
    ps.game_chunks(moves(spark, rows), chunk_plies=20).write.parquet(path)
    df = ps.score_chunks(spark.read.parquet(path))
    assert df.count() == len(rows)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # Only the bridge is shuffled: the scan that gives the plies is joined to a broadcast.
    plies = plan[plan.index("Generate inline"):].split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in plies and "Exchange" not in plies and "Window" not in plies and "Sort" not in plies
    short = ps.score_chunks(spark.read.parquet(path).where("Game_Number < 28"))
    assert "Exchange" not in short._jdf.queryExecution().executedPlan().toString()
    check_scored(df, rows)
    monkeypatch.setattr(arrays, "bounded_broadcast", lambda df: (df, False))  # beyond a broadcast
    check_scored(ps.score_chunks(spark.read.parquet(path)), rows)
    assert ps.score_chunks(spark.read.parquet(path).where("false")).count() == 0
