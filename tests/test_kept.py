"""Numbers and report states kept by increments, against what the batch job says."""

import random

import pytest
from pyspark.sql import functions as F

import plyscope as ps
from checks import views
from checks.queries import demo_scorer
from plyscope.session import shared_dir
from plyscope.sources import tables
from plyscope.streaming import changes as ch
from plyscope.streaming import numbering as nb
from plyscope.streaming import scorebook
from plyscope.streaming import tallies


def put_batch(spark, target, i, documents, copies):
    """documents: path -> taken; copies: (game_key, end_time, digest, path, taken)"""
    kinds = {"documents": "path string, modified long, length long, taken long", "games": "game_key string, end_time long, digest long, path string, taken long"}
    rows = {"documents": [(p, 1, 1, t) for p, t in documents.items()], "games": copies}
    for name, kind in kinds.items():
        spark.createDataFrame(rows[name], kind).write.mode("overwrite").parquet(f"{target}/{name}/batch=u-{i:08d}")


class History:
    """The notes of random runs in memory, with the numbers they should give."""

    def __init__(self, spark, target, seed):
        self.spark, self.target, self.rng, self.documents, self.copies, self.runs = spark, target, random.Random(seed), {}, [], 0

    def run(self, games=120, ends=(None, -5, 3)):
        self.runs += 1
        rng, documents = self.rng, {f"p{self.rng.randrange(6)}": self.runs for _ in range(2)}
        pick = lambda: rng.choice([*ends, rng.randrange(400), rng.randrange(400)])
        copies = [(f"g'\"\\{rng.randrange(150)}", pick(), rng.randrange(3), p, self.runs) for p in documents for _ in range(games // 2)]
        put_batch(self.spark, self.target, self.runs, documents, copies)
        self.documents |= documents
        self.copies += copies

    def numbers(self):
        best = {}
        for key, end, digest, path, taken in self.copies:
            if self.documents[path] == taken:
                order = (-(10**17) if end is None else end, digest)
                best[key] = max(best.get(key, (order, end)), (order, end), key=lambda x: x[0])
        ordered = sorted((end is None, end or 0, key) for key, (_, end) in best.items())
        return {key: i for i, (_, _, key) in enumerate(ordered, 1)}


def numbers(spark, target):
    return {r.game_key: r.Game_Number for r in ps.game_numbers(spark, target).collect()}


def test_numbers_of_a_changing_history(spark, tmp_path):
    target = str(tmp_path)
    history = History(spark, target, 1)
    assert ps.game_numbers(spark, target).count() == 0 and ps.update_numbers(spark, target).rows == []
    for _ in range(3):
        history.run()
        state = ps.update_numbers(spark, target, range_games=25)
        assert numbers(spark, target) == history.numbers()
        assert sum(n for _, _, n, _ in state.rows) == len(history.numbers()) and len(state.rows) >= 2
    assert ps.update_numbers(spark, target).run == state.run  # nothing new: nothing is written
    history.run()
    history.run()
    ps.update_numbers(spark, target, range_games=25)  # two runs taken in at once
    assert numbers(spark, target) == history.numbers()


def test_a_late_game_touches_its_range_only(spark, tmp_path, monkeypatch):
    target = str(tmp_path)
    put_batch(spark, target, 1, {"p": 1}, [(f"g{i:04d}", i, 0, "p", 1) for i in range(1000)])
    first = ps.update_numbers(spark, target, range_games=100)
    assert len(first.rows) >= 8
    put_batch(spark, target, 2, {"q": 2}, [("late", 250, 0, "q", 2)])
    read = []
    real = nb._written
    monkeypatch.setattr(nb, "_written", lambda spark, target: Seen(real(spark, target), read))
    state = ps.update_numbers(spark, target, range_games=100)
    monkeypatch.setattr(nb, "_written", real)
    assert len(read) == 1 and read[0].count("range IN") == 1 and read[0].count(",") == 0  # one range of one run
    plan = real(spark, target).where(read[0])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(run" in plan.replace("isnotnull(run#", "(run#") or "PartitionFilters" in plan
    assert sum(r in first.rows for r in state.rows) == len(first.rows) - 1
    got = numbers(spark, target)
    assert got["g0250"] == 251 and got["late"] == 252 and got["g0251"] == 253 and got["g0999"] == 1001


class Seen:
    """A frame that notes what it is filtered by."""

    def __init__(self, df, conditions):
        self.df, self.conditions = df, conditions

    def where(self, condition):
        self.conditions.append(condition)
        return self.df.where(condition)


def test_a_numbering_that_crashed_is_repeated(spark, tmp_path, monkeypatch):
    target = str(tmp_path)
    history = History(spark, target, 7)
    history.run()
    ps.update_numbers(spark, target, range_games=25)
    before = numbers(spark, target)
    history.run()
    with monkeypatch.context() as m:
        m.setattr(tables, "put_mark", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ps.update_numbers(spark, target, range_games=25)
    assert numbers(spark, target) == before
    ps.update_numbers(spark, target, range_games=25)
    assert numbers(spark, target) == history.numbers()


def test_a_lost_manifest_numbers_afresh(spark, tmp_path):
    target = str(tmp_path)
    history = History(spark, target, 3)
    history.run()
    ps.update_numbers(spark, target, range_games=25)
    fs, path = tables.filesystem(spark, f"{target}/documents")
    fs.delete(path, True)
    history.documents, history.copies = {}, []
    history.run()
    assert ch.changes(spark, target, ["u-00000001"]).afresh
    ps.update_numbers(spark, target, range_games=25)
    assert numbers(spark, target) == history.numbers()


def rounded(df, columns):
    return sorted(str(tuple(round(x, 9) if isinstance(x, float) else x for x in r)) for r in df.select(*columns).collect())


def check_reports(spark, done, landing, **options):
    whole = ps.refresh(spark, landing, shared_dir(spark, "whole"), "2024-05-15", demo_scorer)
    want = ps.report_tables(whole.analysis, **options)
    assert want.keys() == done.reports.keys()
    for name, table in want.items():
        assert rounded(done.reports[name], table.columns) == rounded(table, table.columns), name
    numbered = {r.game_key: r.Game_Number for r in done.numbers.collect()}
    assert {(r.game_key, r.Game_Number) for r in whole.moves.select("game_key", "Game_Number").distinct().collect()} <= numbered.items()
    return want


def test_kept_reports_equal_the_batch(spark, sf, monkeypatch):
    """Texts and ends are put right, games come late and go, and the kept sums are folded."""
    monkeypatch.setattr(tallies.update_reports, "__defaults__", (2,))
    text = views.game_texts(spark, sf).cache()
    landing, target = shared_dir(spark, "landing"), shared_dir(spark, "target")
    options = {"as_of": "2023-06-01", "min_games": 1}
    wrong = text.withColumns(
        {
            "end_time": F.expr("CASE WHEN Game_Number % 4 = 2 THEN end_time + 9000000 ELSE end_time END"),
            "pgn": F.expr("CASE WHEN Game_Number % 4 = 3 THEN concat(substring_index(pgn, '1. ', 1), '1. a4 a5 2. h4') ELSE pgn END"),
        }
    )
    for drop in (wrong.where("Game_Number % 4 <> 1"), text.where("Game_Number % 4 <> 0"), text):
        views.land_documents(drop, landing)
        done = ps.weekly_run(spark, landing, target, demo_scorer, range_games=5, **options)
    want = check_reports(spark, done, landing, **options)
    assert all(t.count() > 0 for t in want.values())
    assert len(tallies._state(spark, target)["runs"]) <= 2
    one = tallies.kept_reports(spark, target, player="Customer#000000001", min_games=1)
    assert {r.player for t in one.values() for r in t.select("player").collect()} == {"customer#000000001"}
    text.unpersist()


def test_reports_read_changed_batches_and_kept_sums_only(spark, tmp_path, monkeypatch):
    target, landing = str(tmp_path / "target"), tmp_path / "landing"
    texts = spark.createDataFrame(
        [(i, "p", f"2024-0{1 + i % 3}", f"u{i}", f'[Link "g{i}"]\n[White "A"]\n[Black "B"]\n\n1. e4 e5 2. Nf3', i) for i in range(9)],
        "Game_Number long, player string, month string, url string, pgn string, end_time long",
    )
    for month in (1, 2, 3):
        views.land_documents(texts.where(f"month = '2024-0{month}'"), str(landing))
        ps.refresh_incremental(spark, str(landing), target, demo_scorer)
        ps.update_reports(spark, target)
    views.land_documents(texts.where("month = '2024-02' AND Game_Number <> 4"), str(landing))  # a game is gone
    ps.refresh_incremental(spark, str(landing), target, demo_scorer)
    change = ch.changes(spark, target, tallies._state(spark, target)["seen"])
    assert [(r.game_key, r.sign) for r in change.rows.collect()] == [("g4", -1)]
    plan = tallies._plies_of(spark, target, change)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch" in plan and "BroadcastHashJoin" in plan
    assert sum(batch in plan for batch in ch.batch_folders(spark, f"{target}/analysis")) == 1
    ps.update_reports(spark, target)
    games = {r.month: r.games for r in ps.kept_reports(spark, target)["performance_summary"].where("colour = 'white'").collect()}
    assert sum(games.values()) == 8


def test_a_report_run_that_crashed_is_repeated(spark, tmp_path, monkeypatch):
    target, landing = str(tmp_path / "target"), str(tmp_path / "landing")
    text = spark.createDataFrame(
        [(i, "p", "2024-01", f"u{i}", f'[Link "g{i}"]\n[White "A"]\n[Black "B"]\n\n1. e4 e5 2. Nf3', i) for i in range(3)],
        "Game_Number long, player string, month string, url string, pgn string, end_time long",
    )
    views.land_documents(text, landing)
    ps.refresh_incremental(spark, landing, target, demo_scorer)
    with monkeypatch.context() as m:
        m.setattr(tables, "put_mark", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ps.update_reports(spark, target)
    assert ps.kept_reports(spark, target)["phase_breakdown"].count() == 0
    ps.update_reports(spark, target)
    done = ps.weekly_run(spark, landing, target, demo_scorer)
    check_reports(spark, done, landing)


def test_streamed_games_are_numbered_and_reported(spark, tmp_path):
    target = str(tmp_path / "target")
    columns = "player string, month string, pgn string, end_time long, _corrupt_record string"
    for i, end in enumerate((9, 3)):
        games = spark.createDataFrame([("a", "m", f'[Link "g{i}"]\n[White "A"]\n[Black "B"]\n\n1. e4 e5 2. d4', end, None)], columns)
        ps.add_games(games, target, f"s-{i}", demo_scorer)
        ps.update_numbers(spark, target)
        ps.update_reports(spark, target)
    assert numbers(spark, target) == {"g1": 1, "g0": 2}
    assert {r.games for r in ps.kept_reports(spark, target)["performance_summary"].collect()} == {2}


def test_only_the_buckets_of_a_drop_are_opened(spark, tmp_path):
    book = str(tmp_path / "scores")
    moves = spark.range(400).selectExpr("CAST(id AS STRING) AS game_key", "1 AS Move_Number", "md5(CAST(id AS STRING)) AS position")
    first = ps.score_from_book(moves, book, "a", demo_scorer, buckets=32)
    assert first.count() == 400
    few = moves.where("game_key IN ('3', '7')").selectExpr("position", "CAST(pmod(xxhash64(position), 32) AS INT) AS bucket")
    kept = scorebook.kept_scores(spark, book, "b", few)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    buckets = sorted({r.bucket for r in few.collect()})
    assert f"bucket#" in plan and "PartitionFilters" in plan and "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    opened = {f.split("bucket=")[1].split("/")[0] for f in kept.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}
    assert opened <= {str(b) for b in buckets} and len(buckets) <= 2
    assert kept.count() <= 2
    # The number of buckets stays as the store has it, and a batch never reads its own scores.
    assert scorebook.bucket_count(spark, book, 99) == 32
    assert scorebook.kept_scores(spark, book, "a", few).count() == 0
    again = ps.score_from_book(moves.where("game_key = '3'"), book, "b", demo_scorer)
    assert again.first()["WDL Stats"] == first.where("game_key = '3'").first()["WDL Stats"]
    empty = ps.score_from_book(moves.where("false"), book, "c", demo_scorer)
    assert empty.count() == 0
    none = moves.limit(1).withColumn("position", F.lit(None).cast("string"))
    assert ps.score_from_book(none, str(tmp_path / "new"), "a", demo_scorer).first().Evaluation is None
