import datetime as dt
import os
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

import plyscope as ps
from checks.queries import demo_scorer
from plyscope.schemas import MOVES
from plyscope.session import land, shared_dir
from plyscope.sources import audit, months, tables


def put(root, player, month, text):
    folder = root / f"player={player}" / f"month={month}"
    folder.mkdir(parents=True)
    (folder / "doc.json").write_text(text)


@pytest.fixture
def landing(tmp_path):
    root = tmp_path / "landing"
    put(root, "ann", "2024-01", '{"games": [{"pgn": "1. e4", "url": "u1", "white": {"username": "ann"}},\n {"url": "u2"}]}')
    put(root, "ann", "2024-02", '{"games": []}')
    put(root, "ann", "2024-03", '{"games": [{"pgn": ')
    put(root, "bob", "2024-01", "{}")
    return str(root)


def test_archive_reads_around_a_corrupt_document(spark, landing):
    docs = ps.read_archive(spark, landing)
    games = ps.flatten_archive(docs).collect()
    assert sorted((r.player, r.month, r.url or "") for r in games) == [
        ("ann", "2024-01", "u1"), ("ann", "2024-01", "u2"), ("ann", "2024-02", ""), ("ann", "2024-03", ""), ("bob", "2024-01", ""),
    ]
    assert [r.white.username for r in games if r.url == "u1"] == ["ann"]
    clean = ps.clean_games(ps.flatten_archive(docs)).collect()
    assert [(r.player, r.url, r.pgn) for r in clean] == [("ann", "u1", "1. e4")]
    aside = ps.corrupt_documents(ps.flatten_archive(docs)).collect()
    assert [(r.player, r.month, r["_corrupt_record"]) for r in aside] == [("ann", "2024-03", '{"games": [{"pgn": ')]


def test_archive_with_one_document_per_line(spark, tmp_path):
    lines = ['{"games": [{"pgn": "1. e4"}]}', '{"games": [{"pgn": ', '{"games": [{"pgn": "1. d4"}, {"url": "u"}]}']
    put(tmp_path, "ann", "2024-01", "\n".join(lines))
    games = ps.flatten_archive(ps.read_archive(spark, str(tmp_path), one_per_file=False))
    assert sorted(r.pgn for r in ps.clean_games(games).collect()) == ["1. d4", "1. e4"]
    assert [r["_corrupt_record"] for r in ps.corrupt_documents(games).collect()] == [lines[1]]


def test_gaps_are_months_without_a_readable_document(spark, landing):
    players = spark.createDataFrame([("ann",), ("bob",)], "player string")
    keys = ps.month_keys(players, "2024-03-10", days_back=69)
    gaps = ps.archive_gaps(keys, ps.read_archive(spark, landing)).collect()
    assert sorted((r.player, r.month) for r in gaps) == [("ann", "2024-03"), ("bob", "2024-02"), ("bob", "2024-03")]


@pytest.mark.parametrize("as_of", ["2026-01-01", "2026-03-31", "2024-02-29", "2026-12-31"])
def test_month_keys_include_both_ends(spark, as_of):
    rows = ps.month_keys(spark.createDataFrame([("a",)], "player string"), as_of).orderBy("month").collect()
    day = dt.date.fromisoformat(as_of)
    start = day - dt.timedelta(days=760)
    assert rows[0].month == start.strftime("%Y-%m") and rows[-1].month == day.strftime("%Y-%m")
    assert len(rows) == (day.year - start.year) * 12 + day.month - start.month + 1
    assert all(len(r.month_of_year) == 2 for r in rows)


def sample(spark, n):
    rows = [(1, "g/1", i, "e4", ("cp", i), [1, 2, 997], "w", "b", "d", "t", "d", "t") for i in range(1, n + 1)]
    return spark.createDataFrame(rows, MOVES)


def test_snapshots(spark, tmp_path):
    root = str(tmp_path / "moves")
    with pytest.raises(FileNotFoundError):
        ps.latest_snapshot(spark, root)
    assert ps.write_snapshot(sample(spark, 5), root, "2024-01-01").endswith("snapshot_date=2024-01-01")
    ps.write_snapshot(sample(spark, 7), root, dt.date(2024, 1, 8), ("Game_Number", "Move_Number"))
    ps.write_snapshot(sample(spark, 3), root, "2024-01-01")
    assert ps.snapshot_dates(spark, root) == ["2024-01-01", "2024-01-08"]
    assert ps.latest_snapshot(spark, root, MOVES).count() == 7
    assert spark.read.parquet(root).where("snapshot_date = '2024-01-01'").count() == 3
    assert ps.drop_staging(spark, root, "2024-01-08")
    assert not ps.drop_staging(spark, root, "2024-01-08")
    assert ps.latest_snapshot(spark, root).count() == 3
    assert ps.read_snapshot(spark, root, "2024-01-01", MOVES).count() == 3
    ps.write_snapshot(sample(spark, 1).where("false"), root, "2024-01-01")
    assert ps.read_snapshot(spark, root, "2024-01-01", MOVES).count() == 0


def test_a_snapshot_counts_once_it_is_committed(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "moves")
    ps.write_snapshot(sample(spark, 5), root, "2024-01-01")
    half = f"{root}/snapshot_date=2024-01-08"
    sample(spark, 2).write.option(tables.NO_SUCCESS_FILE, "false").parquet(half)
    assert ps.snapshot_dates(spark, root) == ["2024-01-01"] and ps.latest_snapshot(spark, root).count() == 5
    with pytest.raises(FileNotFoundError):
        ps.read_snapshot(spark, root, "2024-01-08", MOVES)
    ps.write_snapshot(sample(spark, 4), root, "2024-01-08")  # what lay there half written goes
    assert ps.latest_snapshot(spark, root, MOVES).count() == 4 and spark.read.parquet(half).count() == 4

    # A run that is lost before its marker, and one between the marker and the cleaning up.
    with monkeypatch.context() as m:
        m.setattr(tables, "put_mark", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ps.write_snapshot(sample(spark, 9), root, "2024-01-08")
    assert ps.read_snapshot(spark, root, "2024-01-08", MOVES).count() == 4
    with monkeypatch.context() as m:
        m.setattr(tables, "_clear", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ps.write_snapshot(sample(spark, 6), root, "2024-01-08")
    assert ps.read_snapshot(spark, root, "2024-01-08", MOVES).count() == 6
    ps.write_snapshot(sample(spark, 7), root, "2024-01-08")
    assert spark.read.parquet(half).count() == ps.latest_snapshot(spark, root).count() == 7
    assert len(os.listdir(f"{root}/_commits/2024-01-08")) - 1 == 1  # one marker and its checksum file


def test_a_commit_whose_files_are_gone_does_not_count(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "moves")
    monkeypatch.setattr(tables, "_clear", lambda *a: None)
    for n in (3, 8):
        ps.write_snapshot(sample(spark, n), root, "2024-01-01")
    fs, folder = tables.filesystem(spark, f"{root}/snapshot_date=2024-01-01")
    newest = max(fs.listStatus(folder), key=lambda s: s.getModificationTime() if s.isFile() else 0)
    for status in fs.listStatus(folder):
        if status.getPath().getName()[:10] == newest.getPath().getName()[:10] and status.getPath().getName()[11:47] == newest.getPath().getName()[11:47]:
            fs.delete(status.getPath(), False)
    assert ps.read_snapshot(spark, root, "2024-01-01", MOVES).count() == 3


def test_two_writers_of_one_date(spark, tmp_path):
    folder = str(tmp_path / "marks")
    tables.put_mark(spark, folder, "000000000000", {"files": {}})
    with pytest.raises(FileExistsError):
        tables.put_mark(spark, folder, "000000000000", {"files": {"other": 1}})
    assert [n for n in os.listdir(folder) if not n.startswith(".")] == ["000000000000"]


def test_snapshots_of_other_tools(spark, tmp_path):
    root = str(tmp_path / "moves")
    sample(spark, 5).write.parquet(f"{root}/snapshot_date=2024-01-01")
    assert ps.snapshot_dates(spark, root) == ["2024-01-01"] and ps.latest_snapshot(spark, root, MOVES).count() == 5


def test_read_moves_as_view(spark, tmp_path):
    path = str(tmp_path / "m")
    sample(spark, 4).write.parquet(path)
    assert ps.read_moves(spark, path, view="t").schema == MOVES
    assert spark.sql("SELECT max(Move_Number) FROM t").first()[0] == 4


def test_bucketed_moves_are_scored_without_a_shuffle(spark):
    keyed = sample(spark, 50).withColumn("game_key", F.col("Game_Link"))
    ps.write_bucketed(keyed, "bucketed_moves", 4)
    scored = ps.score_plies(spark.table("bucketed_moves"), game="game_key")
    assert scored.count() == 50
    assert len(scored.collect()) == 50
    assert "Exchange" not in scored._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    spark.sql("DROP TABLE bucketed_moves")


def test_ndjson(spark, tmp_path):
    path = str(tmp_path / "nd")
    df = sample(spark, 6)
    ps.write_ndjson(df, path)
    assert sorted(map(str, ps.read_ndjson(spark, path, MOVES).collect())) == sorted(map(str, df.collect()))
    inferred = ps.read_ndjson(spark, path)
    assert inferred.select("Evaluation.value").count() == 6


def test_audit_counts_without_an_extra_pass(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, None)], "a int, `b c` int")
    watched, seen = ps.audited(df, "stage", ("b c",))
    watched.write.format("noop").mode("overwrite").save()
    got = {r.counter: r.value for r in ps.audit_table(spark, [("stage", seen)]).collect()}
    assert got == {"rows": 3, "null_b c": 2}


def test_shared_folder_comes_from_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert one.startswith(base) and one != two
    landed = land(spark.range(5), "range")
    assert landed.count() == 5 and os.listdir(base)


def test_landed_tables_can_be_cleared(spark, tmp_path, monkeypatch):
    from plyscope import session

    monkeypatch.setattr(session, "_LANDED", {})
    monkeypatch.setattr(session, "shared_dir", lambda spark, label: str(tmp_path / label))
    land(spark.range(5), "a"), land(spark.range(5), "b")
    assert sorted(p for p in os.listdir(tmp_path) if p in "ab") == ["a", "b"]
    assert ps.clear_landed(spark) == 2 and ps.clear_landed(spark) == 0
    assert not os.path.exists(tmp_path / "a")


def test_without_a_checkpoint_folder_the_warehouse_serves():
    def session(**conf):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: conf.get(key, default)))

    warehouse = {"spark.sql.warehouse.dir": "hdfs://shared/warehouse"}
    assert shared_dir(session(**warehouse), "x").startswith("hdfs://shared/warehouse/")
    assert shared_dir(session(**warehouse, **{"spark.checkpoint.dir": "/cp"}), "x").startswith("/cp/x-")
    own = {"spark.sql.warehouse.dir": "file:/home/me/spark-warehouse"}
    assert shared_dir(session(**own, **{"spark.master": "local[4]"}), "x").startswith("file:/home/me/spark-warehouse/")
    for conf in ({}, {**own, "spark.master": "yarn"}, {**own, "spark.master": "local-cluster[2,1,1024]"}):
        with pytest.raises(RuntimeError):
            shared_dir(session(**conf), "x")


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_numbering(spark, partitions):
    df = spark.range(1000).select(
        F.expr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 50 = 1 THEN NULL ELSE id % 40 END").alias("end_time"),
        F.concat(F.lit("k"), F.expr("(id * 7919) % 1000")).alias("game_key"),
    )
    rows = ps.number_games(df.repartition(5), partitions=partitions).collect()
    order = sorted(rows, key=lambda r: (r.end_time is None, r.end_time or 0, r.game_key))
    assert [r.Game_Number for r in order] == list(range(1, 1001))
    assert set(rows[0].asDict()) == {"end_time", "game_key", "Game_Number"}


def test_numbering_nothing(spark):
    assert ps.number_games(spark.createDataFrame([], "end_time long, game_key string")).count() == 0


@pytest.fixture
def awkward(landing):
    """The landing with a name that is escaped in paths, and a document that cannot be opened."""
    root = Path(landing)
    put(root, "c%3Fd", "2024-01", '{"games": [{"pgn": "1. d4"}]}')
    (root / "player=bob" / "month=2024-02").mkdir(parents=True)
    os.symlink("/nowhere/at/all", root / "player=bob" / "month=2024-02" / "doc.json")
    (root / "player=bob" / "month=2024-01" / "_SUCCESS").write_text("")
    return landing


def test_months_as_a_source(spark, awkward):
    source = months.ArchiveMonths({"path": awkward, "players": '["ann", "bob", "c?d"]', "as_of": "2024-03-15", "days_back": "60"})
    assert source.months == ["2024-01", "2024-02", "2024-03"] and len(source.partitions()) == 9
    source.most = 2
    assert sorted(x for p in source.partitions() for x in p.items) == [(p, m) for p in ("ann", "bob", "c?d") for m in source.months]
    assert len(source.partitions()) == 2
    got = ps.read_months(spark, awkward, ["ann", "bob", "c?d"], "2024-03-15", 60)
    outcome = {(r.player, r.month): r.status for r in ps.month_outcomes(got).collect()}
    assert outcome == {
        ("ann", "2024-01"): "found", ("ann", "2024-02"): "found", ("ann", "2024-03"): "corrupt",
        ("bob", "2024-01"): "found", ("bob", "2024-02"): outcome["bob", "2024-02"], ("bob", "2024-03"): "absent",
        ("c?d", "2024-01"): "found", ("c?d", "2024-02"): "absent", ("c?d", "2024-03"): "absent",
    }
    assert outcome["bob", "2024-02"] in ("absent", "failed")  # a link to nothing
    flat = ps.flatten_archive(got.where("status = 'found'"))
    same = ps.flatten_archive(ps.read_archive(spark, awkward).where("_corrupt_record IS NULL"))
    columns = ("player", "month", "url", "pgn", "white")
    assert sorted(map(str, flat.select(*columns).collect())) == sorted(map(str, same.select(*columns).collect()))


def test_a_month_that_fails_is_a_row(awkward, monkeypatch):
    reader = months.ArchiveMonths({"path": awkward, "players": '["ann"]', "as_of": "2024-02-01", "days_back": "31"})
    refused = lambda *a: (_ for _ in ()).throw(PermissionError("no"))
    monkeypatch.setattr(months, "_found", refused)
    rows = [r for p in reader.partitions() for r in reader.read(p)]
    assert [(r[1], r[2], r[3]) for r in rows] == [("2024-01", "failed", "PermissionError: no"), ("2024-02", "failed", "PermissionError: no")]
    store, root = months._store(awkward)
    rows = list(months._documents(store, "ann", "2024-01", [f"{root}/nothing.json"]))
    assert [(r[2], r[5]) for r in rows] == [("failed", None)] and "FileNotFoundError" in rows[0][3]


def test_only_named_months_are_planned(spark, awkward):
    got = ps.read_months(spark, awkward, ["ann", "bob"], "2024-03-15", 60)
    assert got.where("player = 'ann' AND month IN ('2024-01', '2024-02')").rdd.getNumPartitions() == 2
    assert got.where("player = 'ann' AND month IN ('2024-01', '2024-02') AND status = 'found'").count() == 2
    assert ps.read_months(spark, awkward, [], "2024-03-15", 60).count() == 0


def test_arrivals_are_planned_once(awkward, tmp_path):
    source = months.ArchiveArrivals({"path": awkward, "plans": str(tmp_path / "plans")})
    start = source.initialOffset()
    assert start == {"plan": 0} and [x for p in source.partitions(start, start) for x in p.items] == []
    first = source.latestOffset()
    assert first == {"plan": 1} and source.latestOffset() == first
    items = [x for p in source.partitions(start, first) for x in p.items]
    assert ("c?d", "2024-01") in {x[:2] for x in items} and not any("_SUCCESS" in x[2] for x in items)
    path = next(x[2] for x in items if x[:2] == ("ann", "2024-02"))
    with open(path, "w") as f:
        f.write('{"games": [{"pgn": "1. c4 c5"}]}')
    os.utime(path, (1, 1))  # changed, and older than all that was seen
    again = months.ArchiveArrivals({"path": awkward, "plans": str(tmp_path / "plans")})  # after a restart
    second = again.latestOffset()
    assert second == {"plan": 2}
    assert [x for p in again.partitions(first, second) for x in p.items] == [("ann", "2024-02", path)]
    both = [x for p in again.partitions(start, second) for x in p.items]
    assert len(both) == len(items)  # a document that came twice is read once
    assert [r[2] for p in again.partitions(first, second) for r in again.read(p)] == ["found"]


def test_counters_of_a_stream(spark, tmp_path):
    folder, plans, landing = (str(tmp_path / n) for n in ("audit", "plans", "landing"))
    assert ps.stream_audit(spark, folder).count() == 0
    for i in range(2):
        put(tmp_path / "landing", "ann", f"2024-0{i + 1}", '{"games": [{"pgn": "1. e4"}, {"url": "u"}]}' if i else '{"games": [{"url": "u"}]}')
        stream = ps.flatten_archive(ps.stream_months(spark, landing, plans))
        ps.stream_games(stream, str(tmp_path / "target"), str(tmp_path / "stream"), demo_scorer, folder).awaitTermination()
    got = {(r.batch, r.stage, r.counter): r.value for r in ps.stream_audit(spark, folder).collect()}
    assert got == {
        (0, "raw_games", "rows"): 1, (0, "raw_games", "null_pgn"): 1, (1, "raw_games", "rows"): 2, (1, "raw_games", "null_pgn"): 1,
    }
    assert audit._WATCHED[folder] == []


def games_of(spark, n=4000):
    """Two plies for each of n games; `Hot` is in every third of them, others in one each."""
    white = "CASE WHEN id % 3 = 0 THEN 'Hot' WHEN id = 5 THEN NULL ELSE concat('P', id) END"
    return spark.range(n).selectExpr("id AS Game_Number", f"{white} AS White", "concat('q', id) AS Black", "explode(array(1, 2)) AS Move_Number").withColumn(
        "Player_To_Move", F.expr("CASE WHEN Move_Number = 1 THEN White ELSE Black END")
    )


def test_a_layout_by_player_reads_one_player(spark, tmp_path):
    root, rows = str(tmp_path / "players"), games_of(spark)
    ps.write_by_player(rows, root, "2024-01-01", partitions=16, row_group_bytes=1 << 16)
    stored = ps.latest_snapshot(spark, root)
    assert stored.count() == 2 * (2 * 4000 - 1)  # each ply under both names, but for the one missing
    sizes = [r["count"] for r in stored.withColumn("f", F.input_file_name()).groupBy("f").count().collect()]
    assert len(sizes) >= 12 and max(sizes) < 3 * min(sizes)  # the hot player is spread
    one = ps.read_player(spark, root, "p100")
    shown = one._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(player), EqualTo(player,p100)]" in shown
    plan = one._jdf.queryExecution()
    assert {(r.Game_Number, r.Move_Number) for r in one.collect()} == {(100, 1), (100, 2)}
    leaf = plan.executedPlan().collectLeaves().apply(0)
    assert leaf.metrics().apply("numOutputRows").value() < stored.count() / 8  # other row groups are not read
    assert ps.read_player(spark, root, "HOT").count() == 2 * 1334
    assert ps.read_player(spark, root, "nobody").count() == 0
    assert ps.read_player(spark, root, "Q5", rows.schema, "2024-01-01").columns == rows.columns
    assert ps.read_player(spark, root, "Q5", rows.schema, "2024-01-01").count() == 2
    names = ps.by_player(spark.createDataFrame([(1, "A", "a"), (2, None, None)], "g int, White string, Black string"))
    assert [(r.g, r.player) for r in names.collect()] == [(1, "a")]
