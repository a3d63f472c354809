"""Tables of the driver seen as games. See FIXTURES.md for the rules.

The views are plain projections of `events`, or keyed on a game of bounded length.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyscope.session import shared_dir
from plyscope.sources.tables import exists, filesystem

# Which written move stands for which event type.
MOVE_OF_EVENT = {
    "view": "e4",
    "click": "Nf3",
    "signup": "O-O",
    "error": "Bxc6+",
    "purchase": "e8=Q#",
}
CLUB_GAMES = 256
CLUB = f"concat('club', Game_Number div {CLUB_GAMES})"
NO_GAME_TEXT = "not a game record"
#: Documents that are moved into a landing at a time.
MOVERS = 16

MOVE = "CASE event_type " + " ".join(f"WHEN '{e}' THEN '{m}'" for e, m in MOVE_OF_EVENT.items()) + " END"

# Players, dates and result of a game, from its number alone.
_DIMENSION = {
    "White": "concat('Customer#', lpad(Game_Number div 8, 9, '0'))",
    "Black": "concat('Customer#', lpad(Game_Number div 8 + 1 + Game_Number % 5, 9, '0'))",
    "Start_Date": "date_format(_day, 'yyyy.MM.dd')",
    "Start_Time": "concat(lpad(Game_Number % 24, 2, '0'), ':00:00')",
    "End_Date": "date_format(_day, 'yyyy.MM.dd')",
    "End_Time": "concat(lpad(Game_Number % 24, 2, '0'), ':45:00')",
    "Result": "CASE Game_Number % 3 WHEN 0 THEN '1-0' WHEN 1 THEN '0-1' ELSE '1/2-1/2' END",
}
GAME_COLUMNS = ("Game_Number", "Game_Link", *_DIMENSION)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _as_moves(events: DataFrame) -> DataFrame:
    """Moves from events that already have a game and a ply number."""
    return events.selectExpr(
        "*",
        "floor(value * 10) % 601 - 300 AS _x",
        "floor(value * 100) % 801 AS _w",
        "floor(value * 1000) % 200 AS _d",
        "date_add(DATE '2023-01-01', CAST(Game_Number * 11 % 500 AS INT)) AS _day",
    ).selectExpr(
        "Game_Number",
        "concat('g/', Game_Number) AS Game_Link",
        "Move_Number",
        f"{MOVE} AS Move",
        """CASE WHEN event_id % 97 <> 0 THEN
             named_struct('type', CASE WHEN event_id % 50 = 0 THEN 'mate' ELSE 'cp' END, 'value', _x) END AS Evaluation""",
        """CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 53 = 0 THEN array(_w, _d)
             ELSE array(_w, _d, 1000 - _w - _d) END AS `WDL Stats`""",
        *[f"{x} AS {name}" for name, x in _DIMENSION.items()],
    )


def moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MV. Runs of 200 events are cut into games of 1, 12, 47 and 140 plies."""
    place = "event_id % 200"
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "event_type",
        "value",
        f"""event_id div 200 * 4 + CASE WHEN {place} < 1 THEN 1 WHEN {place} < 13 THEN 2
            WHEN {place} < 60 THEN 3 ELSE 4 END AS Game_Number""",
        f"""CAST({place} + CASE WHEN {place} < 1 THEN 1 WHEN {place} < 13 THEN 0
            WHEN {place} < 60 THEN -12 ELSE -59 END AS INT) AS Move_Number""",
    )
    return _as_moves(events)


def long_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HV. One game per event type: five games that hold all rows, with gaps between
    the ply numbers."""
    numbers = " ".join(f"WHEN '{e}' THEN {i}L" for i, e in enumerate(MOVE_OF_EVENT, 1))
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "event_type",
        "value",
        f"CASE event_type {numbers} END AS Game_Number",
        "event_id + 1 AS Move_Number",
    )
    return _as_moves(events)


def opening_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sequence of up to three first moves that occurs, but for those that
    begin with castling and have two moves; the name is the sequence, bracketed."""
    first = moves(spark, sf_dir).where("Move_Number <= 3")
    per_game = first.groupBy("Game_Number").agg(
        *[F.expr(f"max(CASE WHEN Move_Number = {i} THEN Move END)").alias(f"m{i}") for i in (1, 2, 3)]
    )
    return (
        per_game.selectExpr(
            "explode(array(m1, concat_ws(' ', m1, m2), concat_ws(' ', m1, m2, m3))) AS moves"
        )
        .distinct()
        .where("NOT (size(split(moves, ' ')) = 2 AND startswith(moves, 'O-O'))")
        .selectExpr("moves", "concat('<', moves, '>') AS name")
    )


# One ply as written in a text. The aside nests four deep and has a comment with a
# closing parenthesis in it.
_ASIDE = " (1. d4 {alt (really) 1. a3} (1. c4 (1. Nf3 d5 (1. g3)) e5) d5 $1 {)})"
_WRITTEN = f"""transform(plies, p -> concat(
  CASE WHEN p.Move_Number % 2 = 1 THEN concat((p.Move_Number + 1) div 2, '. ')
    WHEN Game_Number % 2 = 0 THEN concat((p.Move_Number + 1) div 2, '... ') ELSE '' END,
  p.Move,
  CASE WHEN Game_Number % 3 = 0 THEN '!?' ELSE '' END,
  CASE WHEN Game_Number % 2 = 0 THEN ' {{[%clk 0:09:58] fine (h3)}}' ELSE '' END,
  CASE WHEN Game_Number % 5 = 0 AND p.Move_Number = 1 THEN '{_ASIDE}' ELSE '' END,
  CASE WHEN p.Move_Number % 20 = 0 THEN '\\n' ELSE ' ' END))"""


def _tag(name: str, column: str) -> str:
    return f"""'[{name} "', {column}, '"]\\n'"""


_TEXT = f"""concat(
  CASE WHEN Game_Number % 7 = 0 THEN '[Event "Say \\\\"hi\\\\" [x]"]\\n[White "overruled"]\\n' ELSE '' END,
  {_tag("White", "White")}, {_tag("Black", "Black")}, {_tag("Date", "Start_Date")}, {_tag("StartTime", "Start_Time")},
  {_tag("EndDate", "End_Date")}, {_tag("EndTime", "End_Time")},
  CASE WHEN Game_Number % 17 = 0 THEN '' ELSE concat({_tag("Link", "Game_Link")}) END,
  {_tag("Result", "Result")}, '\\n',
  trim(array_join({_WRITTEN}, '')),
  CASE WHEN Game_Number % 9 = 0 THEN ' ; e4 is {{no part\\n' ELSE ' ' END,
  Result,
  CASE WHEN Game_Number % 10 = 0 THEN '\\n\\n[White "second game"]\\n\\n1. a4 a5 *' ELSE '\\n' END)"""


def game_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TX. One text per MV game, of at most 140 plies."""
    per_game = moves(spark, sf_dir).groupBy(*GAME_COLUMNS).agg(
        F.expr("sort_array(collect_list(struct(Move_Number, Move)))").alias("plies")
    )
    return per_game.selectExpr(
        "Game_Number",
        f"{CLUB} AS player",
        "concat(substring(End_Date, 1, 4), '-', substring(End_Date, 6, 2)) AS month",
        "concat('u/', Game_Number) AS url",
        f"""CASE WHEN Game_Number % 11 = 0 THEN NULL WHEN Game_Number % 13 = 0 THEN '{NO_GAME_TEXT}'
            ELSE {_TEXT} END AS pgn""",
        """CAST(datediff(to_date(End_Date, 'yyyy.MM.dd'), DATE '1970-01-01') AS BIGINT) * 86400
           + Game_Number % 24 * 3600 + 2700 AS end_time""",
    )


def write_archive(texts: DataFrame, path: str, marks: bool = True) -> str:
    """AJ. Lands `player=/month=` documents; with `marks` also a month without games
    and one that is not JSON. What a document costs is its file, not its bytes, so the
    documents are dealt to as many tasks as there are shuffle partitions."""
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    docs = texts.repartition(tasks, "player", "month").groupBy("player", "month").agg(
        F.expr("to_json(named_struct('games', sort_array(collect_list(struct(url, pgn, end_time)))))").alias("value")
    )
    if marks:
        extra = """SELECT * FROM VALUES ('club0', '2022-12', '{"games": []}'), ('club0', '2022-11', '{"games": [{"pgn')
            AS t(player, month, value)"""
        docs = docs.unionByName(texts.sparkSession.sql(extra))
    docs.write.mode("append").partitionBy("player", "month").text(path)
    return path


def _paths(spark: SparkSession, folder: str) -> list[str]:
    """The files below a folder; their contents are not read."""
    if not exists(spark, folder):
        return []
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return [r.path for r in files.select("path").collect()]


def land_documents(texts: DataFrame, path: str) -> str:
    """Lands each document under a name of its own; one that is there is replaced.

    The files are listed by Spark and moved by threads, a few calls for each.
    """
    spark = texts.sparkSession
    fresh = write_archive(texts, shared_dir(spark, "documents"), marks=False)
    fs, _ = filesystem(spark, path)
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    month = lambda file: "/".join(file.split("/")[-3:-1])
    there = {month(f) for f in _paths(spark, path) if f.endswith("/doc.json")}

    def move(file: str) -> None:
        to = location(f"{path}/{month(file)}/doc.json")
        if month(file) in there:
            fs.delete(to, False)
        else:
            fs.mkdirs(to.getParent())
        if not fs.rename(location(file), to):
            raise OSError(f"{file} was not moved to {to}")

    with ThreadPoolExecutor(MOVERS) as movers:
        list(movers.map(move, {month(f): f for f in _paths(spark, fresh)}.values()))
    return path


def archive(spark: SparkSession, sf_dir: str) -> str:
    return write_archive(game_texts(spark, sf_dir), shared_dir(spark, "archive"))
