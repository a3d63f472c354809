import json
import os
import time

import pytest
from pyspark.sql import functions as F

import plyscope as ps
from checks import views
from checks.queries import demo_scorer
from plyscope.schemas import ARCHIVE
from plyscope.session import shared_dir
from plyscope.sources.archive import archive_options
from plyscope.sources.tables import filesystem
from plyscope.streaming import intake, scorebook

COLUMNS = ("game_key", "Move_Number", "Move", "Evaluation", "WDL Stats", "White", "Black", "End_Date", "Result")


def rows(df):
    return sorted(str(tuple(r)) for r in df.select(*[f"`{c}`" for c in COLUMNS]).collect())


@pytest.fixture(scope="module")
def whole(spark, sf):
    return ps.refresh(spark, views.archive(spark, sf), shared_dir(spark, "whole"), "2024-05-15", demo_scorer)


def test_refresh_writes_every_stage(spark, sf, whole):
    texts = views.game_texts(spark, sf)
    readable = texts.where("pgn IS NOT NULL AND Game_Number % 13 <> 0").count()
    assert whole.moves.select("game_key").distinct().count() == readable
    assert whole.analysis.count() == whole.moves.count()
    assert {(r.reason, r.text) for r in whole.quarantine.collect()} == {
        ("no_moves", views.NO_GAME_TEXT), ("corrupt_document", '{"games": [{"pgn\n'),
    }
    audit = {(r.stage, r.counter): r.value for r in whole.audit.collect()}
    assert audit["months", "null_games"] == 1
    assert audit["raw_games", "rows"] == texts.count() + 2
    assert audit["clean_games", "rows"] == texts.where("pgn IS NOT NULL").count()
    assert audit["moves", "rows"] == audit["analysis", "rows"] == whole.moves.count()
    assert audit["moves", "null_Evaluation"] > 0
    numbers = [r[0] for r in whole.moves.select("Game_Number").distinct().collect()]
    assert len(numbers) == readable
    for name, table in whole.reports.items():
        assert table.count() > 0 or name in ("opening_repertoire", "this_month"), name


def test_refresh_drops_its_staging(spark, sf):
    root = shared_dir(spark, "staging")
    ps.refresh(spark, views.archive(spark, sf), root, "2024-05-15", demo_scorer)
    assert ps.snapshot_dates(spark, f"{root}/raw") == []
    assert ps.snapshot_dates(spark, f"{root}/moves") == ["2024-05-15"]


def test_incremental_equals_batch(spark, sf, whole):
    texts = views.game_texts(spark, sf)
    landing, target = (shared_dir(spark, n) for n in ("landing", "target"))
    nothing = ps.refresh_incremental(spark, landing, target, demo_scorer)
    assert nothing.moves.count() == nothing.analysis.count() == nothing.audit.count() == 0
    for drop, marks in (("Game_Number % 3 <> 2", True), ("Game_Number % 3 <> 0", False)):
        views.write_archive(texts.where(drop), landing, marks=marks)
        done = ps.refresh_incremental(spark, landing, target, demo_scorer)
        assert {r.stage for r in done.audit.collect()} == {"documents", "games", "moves", "analysis"}
    before = sorted(os.listdir(f"{target}/analysis"))
    done = ps.refresh_incremental(spark, landing, target, demo_scorer)
    assert rows(done.moves) == rows(whole.moves) and sorted(os.listdir(f"{target}/analysis")) == before
    assert done.analysis.count() == whole.analysis.count()
    aside = spark.read.parquet(f"{target}/quarantine")
    assert {r.reason for r in aside.collect()} == {"no_moves", "corrupt_document"}
    assert spark.read.parquet(f"{target}/missing_tags").select("missing_headers").distinct().count() > 0
    scores = spark.read.parquet(f"{target}/scores")
    assert scores.count() == scores.select("position").distinct().count()
    # A lost manifest delivers every file again under new batch names.
    filesystem(spark, target)[0].delete(filesystem(spark, f"{target}/documents")[1], True)
    again = ps.refresh_incremental(spark, landing, target, demo_scorer)
    assert rows(again.moves) == rows(whole.moves) and again.analysis.count() == whole.analysis.count()


def document(folder, games, month="2024-01", age=0):
    path = folder / "player=a" / f"month={month}"
    path.mkdir(parents=True, exist_ok=True)
    (path / "doc.json").write_text(json.dumps({"games": games}))
    then = time.time() - age
    os.utime(path / "doc.json", (then, then))


def game(link, moves, end):
    return {"pgn": f'[Link "{link}"]\n\n{moves}', "url": link, "end_time": end}


def test_late_and_changed_documents_equal_the_batch(spark, tmp_path):
    landing, target = tmp_path / "landing", str(tmp_path / "target")
    steps = [
        dict(games=[game("g1", "1. e4 e5", 1), game("g2", "1. d4", 5)]),
        dict(games=[game("g3", "1. c4", 1)], month="2023-01", age=40 * 86400),  # old when it lands
        dict(games=[game("g1", "1. e4 e5 2. Nf3", 2), game("g4", "1. f4", 3)], age=-60),  # again: g1 corrected, g2 gone
        dict(games=[game("g1", "1. a4", 1), game("g2", "1. d4 d5", 4)], month="2024-02"),  # an older copy of g1
        dict(games=[], month="2024-02", age=-60),
    ]
    for i, step in enumerate(steps):
        document(landing, **step)
        done = ps.refresh_incremental(spark, str(landing), target, demo_scorer)
        if i < 2:
            continue
        batch = ps.refresh(spark, str(landing), str(tmp_path / f"batch{i}"), "2024-05-15", demo_scorer)
        assert rows(done.moves) == rows(batch.moves), i
        key = ("game_key", "Move_Number", "move_accuracy", "ACPL_White", "CentiPawnLoss")
        assert sorted(map(str, done.analysis.select(*key).collect())) == sorted(map(str, batch.analysis.select(*key).collect()))


def test_a_run_that_crashed_is_repeated(spark, tmp_path, monkeypatch):
    landing, target = tmp_path / "landing", str(tmp_path / "target")
    document(landing, [game("g1", "1. e4 e5", 1)])
    real = intake._replace

    def crash(df, path, batch):
        if path.endswith("documents"):
            raise RuntimeError("lost")
        real(df, path, batch)

    monkeypatch.setattr(intake, "_replace", crash)
    with pytest.raises(RuntimeError):
        ps.refresh_incremental(spark, str(landing), target, demo_scorer)
    monkeypatch.setattr(intake, "_replace", real)
    document(landing, [game("g2", "1. d4", 1)], month="2024-02")
    done = ps.refresh_incremental(spark, str(landing), target, demo_scorer)
    assert sorted((r.game_key, r.Move_Number) for r in done.moves.collect()) == [("g1", 1), ("g1", 2), ("g2", 1)]


def test_history_is_not_shuffled_for_few_games(spark, tmp_path):
    history = str(tmp_path / "history")
    spark.range(1000).selectExpr("CAST(id AS STRING) AS position").write.parquet(history)
    keys = spark.createDataFrame([("5",), ("7",)], "position string")
    met = intake._met(spark.read.parquet(history), keys, ["position"])
    assert met.count() == 2
    shown = met._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in shown and "Exchange hashpartitioning" not in shown


def test_a_stream_adds_games(spark, tmp_path):
    landing, target = tmp_path / "landing", str(tmp_path / "target")
    for i, moves in enumerate(("1. e4", "1. d4 d5")):
        document(landing, [game(f"g{i}", moves, 1)], month=f"2024-0{i + 1}")
        docs = spark.readStream.schema(ARCHIVE).options(**archive_options()).json(str(landing))
        ps.stream_games(ps.flatten_archive(docs), target, str(tmp_path / "stream"), demo_scorer).awaitTermination()
    moves, analysis = ps.current_tables(spark, target)
    assert sorted((r.game_key, r.Move_Number) for r in moves.collect()) == [("g0", 1), ("g1", 1), ("g1", 2)]
    assert analysis.count() == 3


def test_refresh_of_nothing(spark, tmp_path):
    done = ps.refresh(spark, str(tmp_path / "none"), str(tmp_path / "root"), "2024-05-15", demo_scorer)
    assert [t.count() for t in (done.moves, done.analysis, done.quarantine, done.missing_tags)] == [0, 0, 0, 0]
    assert all(t.count() == 0 for t in done.reports.values())
    assert {r.value for r in done.audit.collect()} <= {0}


def test_refresh_with_nothing_set_aside_and_names(spark, tmp_path):
    document(tmp_path / "landing", [game("g1", "1. e4 e5 2. Nf3", 1)])
    names = spark.createDataFrame([("e4 e5", "Open")], "moves string, name string")
    done = ps.refresh(spark, str(tmp_path / "landing"), str(tmp_path / "root"), "2024-05-15", demo_scorer, names=names)
    assert done.quarantine.count() == 0 and done.moves.count() == 3
    assert done.missing_tags.count() == 1
    assert "opening_name" in done.reports["opening_repertoire"].columns


def test_a_rerun_without_rows_empties_the_date(spark, tmp_path):
    root = str(tmp_path / "root")
    document(tmp_path / "one", [game("g1", "1. e4", 1), game("g2", "no moves at all", 2)])
    first = ps.refresh(spark, str(tmp_path / "one"), root, "2024-05-15", demo_scorer)
    assert first.quarantine.count() == 1
    again = ps.refresh(spark, str(tmp_path / "none"), root, "2024-05-15", demo_scorer)
    assert again.quarantine.count() == again.moves.count() == 0


@pytest.mark.parametrize("crash_after", ["scores", "moves"])
def test_a_batch_that_crashed_runs_again(spark, sf, whole, monkeypatch, crash_after):
    texts = views.game_texts(spark, sf)
    target = shared_dir(spark, "target")
    first = ps.flatten_archive(ps.read_archive(spark, views.write_archive(texts.where("Game_Number % 3 <> 2"), shared_dir(spark, "l"))))
    second = ps.flatten_archive(ps.read_archive(spark, views.write_archive(texts.where("Game_Number % 3 <> 0"), shared_dir(spark, "l"))))
    ps.add_games(first, target, "s-0", demo_scorer)
    real = intake._replace

    def crash(df, path, batch):
        real(df, path, batch)
        if path.endswith(crash_after):
            raise RuntimeError("lost")

    def after_scores(moves, scores):
        raise RuntimeError("lost")  # they are written, and about to be joined

    with monkeypatch.context() as m:
        if crash_after == "scores":
            m.setattr(scorebook, "score_join", after_scores)
        else:
            m.setattr(intake, "_replace", crash)
        with pytest.raises(RuntimeError):
            ps.add_games(second, target, "s-1", demo_scorer)
    ps.add_games(second, target, "s-1", demo_scorer)
    assert rows(spark.read.parquet(f"{target}/moves")) == rows(whole.moves)


def test_known_positions_are_not_scored_again(spark):
    columns = "player string, month string, pgn string, end_time long, _corrupt_record string"
    games = spark.createDataFrame([("a", "m", "1. e4 e5", 1, None)], columns)
    more = spark.createDataFrame([("a", "m", "1. e4 e5 2. d4", 2, None), ("a", "m", "1. e4 e5 2. c4", 3, None)], columns)
    target = shared_dir(spark, "target")
    ps.add_games(games, target, "a", demo_scorer)
    ps.add_games(more, target, "b", demo_scorer)
    moves = spark.read.parquet(f"{target}/moves")
    assert moves.count() == 8
    per_batch = {r["batch"]: r["count"] for r in spark.read.parquet(f"{target}/scores").groupBy("batch").count().collect()}
    assert sum(per_batch.values()) <= 4 and per_batch.get("b", 0) <= 2


def test_missing_scores_keep_the_ply(spark):
    moves = spark.createDataFrame([("g", 1, "a"), ("g", 2, "b"), ("h", 1, "a"), ("h", 2, None)],
                                  "game_key string, Move_Number int, position string")
    scores = spark.createDataFrame([("a", "cp", 5, [1, 2, 997])], ps.score_table(moves, demo_scorer).schema)
    got = {(r.game_key, r.Move_Number): (r.Evaluation, r["WDL Stats"]) for r in ps.score_join(moves, scores).collect()}
    assert got["g", 1] == got["h", 1] == ((("cp", 5)), [1, 2, 997])
    assert got["g", 2] == got["h", 2] == (None, None)


def test_each_position_is_scored_once(spark):
    moves = spark.createDataFrame([(f"{i % 3:032x}",) for i in range(300)], "position string")
    assert ps.score_table(moves.repartition(6), demo_scorer).count() <= 3
    seen = spark.sparkContext.accumulator(0)

    def counting(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf.assign(eval_type="cp", eval_value=1, wdl=[[1, 2, 3]] * len(pdf))

    assert ps.score_table(moves.repartition(6), counting, partitions=2).agg(F.count("*")).first()[0] == 3
    assert seen.value == 3


def test_landing_a_document_takes_few_calls_to_the_driver(spark, tmp_path, monkeypatch):
    """Documents come by the ten thousand; each call for one of them is paid as often."""
    client, calls = spark.sparkContext._gateway._gateway_client, []
    send = client.send_command

    def counted(command, *args, **options):
        if not command.startswith("m\n"):  # no mere release of an object
            calls.append(command)
        return send(command, *args, **options)

    monkeypatch.setattr(client, "send_command", counted)

    def land(n, version):
        texts = spark.range(n).selectExpr(
            "concat('p', id) AS player", "'2024-01' AS month", "concat('u', id) AS url", f"concat('1. e4 ', '{version}') AS pgn", "id AS end_time"
        )
        calls.clear()
        views.land_documents(texts, str(tmp_path / f"of-{n}"))
        return len(calls)

    for version in ("first", "second"):
        few, many = land(5, version), land(45, version)
        assert (many - few) / 40 <= 12, (version, few, many)
    docs = ps.flatten_archive(ps.read_archive(spark, str(tmp_path / "of-45"))).collect()
    assert sorted((d.player, d.pgn) for d in docs) == sorted((f"p{i}", "1. e4 second") for i in range(45))
    files = [f for _, _, fs in os.walk(tmp_path / "of-45") for f in fs]
    assert {f for f in files if not f.startswith(".")} == {"doc.json"}
