"""The plans, not only the results, are part of the contract."""

import pytest

import plyscope as ps
from checks import queries, views



def plan(df):
    """Final adaptive plan, after running it."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def written(spark, sf, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("moves") / "m")
    views.moves(spark, sf).write.parquet(path)
    return path


def test_analysis_has_one_exchange(spark, written):
    moves = spark.read.parquet(written)
    unordered = plan(ps.move_analysis(moves, ordered=False))
    assert unordered.count("Exchange ") == 1 and "hashpartitioning(Game_Number" in unordered
    in_order = plan(ps.move_analysis(moves))
    assert in_order.count("Exchange ") == 1 and "rangepartitioning(Game_Number" in in_order
    assert "Python" not in in_order and "Python" not in unordered


def test_analysis_reads_only_what_it_needs(spark, written):
    text = plan(ps.move_analysis(spark.read.parquet(written), ordered=False))
    schema = [line for line in text.splitlines() if "ReadSchema" in line][0]
    assert "Evaluation:struct<value:bigint>" in schema
    for unused in ("Game_Link", "Start_Date", "End_Time", "Result"):
        assert unused not in schema


def test_look_for_long_games_is_pushed_to_the_scan(spark, written):
    moves = spark.read.parquet(written)
    probe = moves.where(moves.Move_Number.isNull() | (moves.Move_Number > 4096) | (moves.Move_Number <= -4095))
    assert "GreaterThan(Move_Number,4096)" in plan(probe.select("Game_Number"))


def test_clean_games_pushes_the_filter(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame([("1. e4", "u", 1), (None, "v", 2)], "pgn string, url string, end_time long").write.parquet(path)
    text = plan(ps.clean_games(spark.read.parquet(path), keep=()))
    assert "PushedFilters: [IsNotNull(pgn)]" in text and "ReadSchema: struct<pgn:string>" in text


def test_text_to_plies_has_no_shuffle_and_no_python(spark, sf, tmp_path):
    path = str(tmp_path / "texts")
    views.game_texts(spark, sf).write.parquet(path)
    good, _ = ps.split_quarantine(ps.parse_games(spark.read.parquet(path)))
    text = plan(ps.build_moves(good, ("Game_Number",)))
    assert "Exchange" not in text and "Python" not in text


def test_top_k_lists_are_cut_before_the_shuffle(spark, sf):
    text = plan(queries.games_to_review(spark, sf))
    assert "WindowGroupLimit" in text
    one = ps.games_to_review(queries.scored(spark, sf), queries.PLAYER)
    assert "TakeOrderedAndProject" in plan(one)
    assert "WindowGroupLimit" in plan(queries.opening_repertoire(spark, sf))
    assert "WindowGroupLimit" in plan(queries.blunder_plies(spark, sf))


def test_numbering_sends_only_counts_to_one_task(spark, sf):
    text = plan(queries.game_numbering(spark, sf))
    lines = text.splitlines()
    single = [i for i, line in enumerate(lines) if "SinglePartition" in line]
    assert len(single) == 1
    below = "\n".join(lines[single[0]:])
    assert "HashAggregate" in below and "Window" not in "\n".join(lines[single[0] + 1:])


def test_a_position_that_most_plies_share_is_split(spark, tmp_path):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        moves = spark.range(0, 60000, 1, 6).selectExpr(
            "id AS Game_Number",
            "md5(CAST(-id AS STRING)) AS Move",
            "CASE WHEN id % 3 = 0 THEN 'hot' ELSE md5(CAST(id % 6000 AS STRING)) END AS position",
        )
        path = str(tmp_path / "scores")
        moves.select("position").distinct().selectExpr(
            "position", "'cp' AS eval_type", "1L AS eval_value", "array(1L, 2L, 3L) AS wdl"
        ).write.parquet(path)
        scores = spark.read.parquet(path)
        joined = ps.score_join(moves, scores)
        assert "skew=true" in plan(joined)
        assert joined.where("Evaluation IS NOT NULL").count() == 60000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_moves_before_mistakes_are_never_broadcast(spark, sf, tmp_path):
    path = str(tmp_path / "scored")
    queries.scored(spark, sf).write.parquet(path)
    found = ps.blunder_triggers(spark.read.parquet(path))
    text = plan(found)
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
    assert sorted(found.collect()) == sorted(queries.blunder_triggers(spark, sf).collect())


def test_no_cartesian_product_anywhere(spark, sf):
    for name in ("opening_repertoire", "name_openings", "analysis_context", "score_join", "performance_summary"):
        df = queries.QUERIES[name](spark, sf)
        assert "CartesianProduct" not in optimized(df) and "NestedLoop" not in plan(df), name
