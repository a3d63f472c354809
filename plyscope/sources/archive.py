"""Monthly game archives: which months are expected, and reading the landed documents."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyscope.schemas import ARCHIVE
from plyscope.session import shared_dir
from plyscope.sources.tables import exists, filesystem


def month_keys(players: DataFrame, as_of: dt.date | str, days_back: int = 760, player: str = "player") -> DataFrame:
    """One row per player and month of the look-back window, both ends included."""
    last = F.lit(str(as_of)).cast("date")
    first = F.trunc(F.date_sub(last, days_back), "MM")
    months = F.sequence(first, F.trunc(last, "MM"), F.expr("interval 1 month"))
    return players.select(F.col(player).alias("player"), F.explode(months).alias("_m")).select(
        "player",
        F.year("_m").alias("year"),
        F.lpad(F.month("_m").cast("string"), 2, "0").alias("month_of_year"),
        F.date_format("_m", "yyyy-MM").alias("month"),
    )


def archive_options(one_per_file: bool = True) -> dict[str, str]:
    """How documents are read, as a batch or as a stream."""
    return {
        "multiLine": str(one_per_file).lower(),
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": "_corrupt_record",
    }


def read_archive(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """Landed documents, laid out as `player=<p>/month=<yyyy-MM>/*.json`.

    A document that is not JSON keeps its text in `_corrupt_record` and has no
    games; the others are read all the same. With one document per file, a file is
    the unit of work. A landing of very many documents should hold one per line
    instead (`one_per_file=False`): such files can be large and are split. A landing
    that does not exist holds no documents.
    """
    if not exists(spark, path):
        path = shared_dir(spark, "nothing-landed")
        fs, location = filesystem(spark, path)
        fs.mkdirs(location)
    return spark.read.schema(ARCHIVE).options(**archive_options(one_per_file)).json(path)


def corrupt_documents(games: DataFrame) -> DataFrame:
    """The documents among flattened games that could not be read.

    Spark reads no corrupt column alone, so the other columns stay; over a written
    snapshot the scan prunes them.
    """
    return games.where("_corrupt_record IS NOT NULL")


def archive_gaps(expected: DataFrame, docs: DataFrame) -> DataFrame:
    """Expected months with no readable document.

    Spark reads no corrupt column alone, so the test names `games` as well.
    """
    found = docs.where("games IS NOT NULL OR _corrupt_record IS NULL").select("player", "month").distinct()
    return expected.join(found, ["player", "month"], "left_anti")


def flatten_archive(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per game with the game's fields as columns, and `keep` of its document.

    A month without games stays as one row of NULLs; `clean_games` drops it. A
    document that could not be read is such a row too, with its text.
    """
    own = ("player", "month", *keep, "_corrupt_record")
    return docs.select(*own, F.explode_outer("games").alias("g")).select(*own[:-1], "g.*", "_corrupt_record")


def clean_games(games: DataFrame, keep: tuple[str, ...] = ("player", "month", "url", "end_time")) -> DataFrame:
    """Games that have text, with their key columns."""
    return games.where(F.col("pgn").isNotNull()).select(
        *[c for c in keep if c in games.columns], "pgn"
    )
