"""An analysis laid out by player, so that a report on one player reads that player only."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plyscope.sources import tables as tb

PLAYER = "player"
#: Row groups are what statistics and Bloom filters leave out, so they are kept small.
ROW_GROUP_BYTES = 16 << 20


def by_player(rows: DataFrame, sides: tuple[str, ...] = ("White", "Black")) -> DataFrame:
    """Every row once for each player of its game, named in lower case in `player`; a row of a
    game without names is under no player and left out."""
    names = ", ".join(f"lower({s})" for s in sides)
    return rows.drop(PLAYER).selectExpr("*", f"explode(array_distinct(filter(array({names}), x -> x IS NOT NULL))) AS {PLAYER}")


def write_by_player(
    rows: DataFrame, root: str, snapshot_date: dt.date | str, game: str = "Game_Number", ply: str = "Move_Number",
    sides: tuple[str, ...] = ("White", "Black"), partitions: int | None = None, row_group_bytes: int = ROW_GROUP_BYTES,
) -> str:
    """Commits a snapshot clustered by player, game and ply, with a Bloom filter on the player.

    Ranges are cut by player and game, so a player who is in a third of all games is spread over
    as many files as any third of the rows, and the files of others hold none of it.
    """
    placed = by_player(rows, sides)
    order = [F.col(PLAYER), F.col(game), F.col(ply)]
    placed = placed.repartitionByRange(partitions, *order) if partitions else placed.repartitionByRange(*order)
    options = {f"parquet.bloom.filter.enabled#{PLAYER}": "true", "parquet.block.size": str(row_group_bytes)}
    return tb.write_snapshot(placed, root, snapshot_date, (PLAYER, game, ply), **options)


def read_player(spark: SparkSession, root: str, player: str, schema: T.StructType | None = None, snapshot_date: dt.date | str | None = None) -> DataFrame:
    """All rows of the games of one player, in any case, of the newest committed snapshot (or of
    one date). The test on the stored name reaches the scan, which skips what cannot hold it;
    reports of the player take the result as they take an analysis."""
    if schema is not None and PLAYER not in schema.fieldNames():
        schema = T.StructType([*schema.fields, T.StructField(PLAYER, T.StringType())])
    if snapshot_date is None:
        found = tb.latest_snapshot(spark, root, schema).drop(tb.SNAPSHOT)
    else:
        found = tb.read_snapshot(spark, root, snapshot_date, schema)
    return found.where(F.col(PLAYER) == player.lower()).drop(PLAYER)
