"""Which copies of games have begun or ceased to count since a kept state was written.

Tables kept beside the history (numbers, report states) name the batches they have taken in.
From the notes on copies and documents follows what changed since: a game is looked at only
if a new batch holds it, or a new batch holds a newer version of one of its documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyscope.operators import games as gm
from plyscope.session import land
from plyscope.sources.tables import filesystem
from plyscope.streaming import intake


@dataclass
class Changes:
    """`rows` has game_key, digest, end_time and sign: +1 for a copy that now counts, -1 for
    one that no longer does. `batches` are all that have been taken in with them."""

    rows: DataFrame
    new: list[str]
    batches: list[str]
    afresh: bool


def taken_in(spark: SparkSession, target: str) -> list[str]:
    """Names of the batches whose games may count: those the manifest has, and those of a
    stream, whose games come without documents. A name for each run, not for each game."""
    documents = intake._table(spark, f"{target}/documents", intake.DOCUMENTS).select("batch")
    streamed = intake._table(spark, f"{target}/games", intake.COPIES).where("path IS NULL").select("batch")
    return sorted(r.batch for r in documents.union(streamed).distinct().collect())


def changes(spark: SparkSession, target: str, seen: list[str]) -> Changes:
    """What has changed since the batches in `seen` were all. If some of these are gone (a
    manifest was lost), nothing kept holds any more, and everything counts as new."""
    batches = taken_in(spark, target)
    afresh = not seen or not set(seen) <= set(batches)
    seen = [] if afresh else seen
    new = sorted(set(batches) - set(seen))
    documents = intake._table(spark, f"{target}/documents", intake.DOCUMENTS).where(F.col("batch").isin(batches))
    copies = intake._table(spark, f"{target}/games", intake.COPIES).where(F.col("batch").isin(batches))
    fresh = F.col("batch").isin(new)
    if seen and new:
        paths = documents.where(fresh).select("path").distinct()
        keys = copies.where(fresh).select("game_key").union(intake._met(copies, paths, ["path"]).select("game_key"))
        copies = intake._met(copies, land(keys.distinct(), "keys"), ["game_key"])
    elif seen:
        copies = copies.where("false")
    newest = documents.groupBy("path").agg(
        F.max("taken").alias("newest"), F.max(F.when(~fresh, F.col("taken"))).alias("newest_before")
    )
    versions = copies.withColumn("fresh", fresh).join(newest, "path", "left")
    order = f"max_by(struct(digest, end_time), {gm.LATEST})"
    per_game = versions.groupBy("game_key").agg(
        F.expr(f"{order} FILTER (WHERE path IS NULL OR taken = newest)").alias("now"),
        F.expr(f"{order} FILTER (WHERE NOT fresh AND (path IS NULL OR taken = newest_before))").alias("before"),
    )
    both = "filter(array(struct(before AS copy, -1L AS sign), struct(now AS copy, 1L AS sign)), x -> x.copy IS NOT NULL)"
    rows = per_game.where("NOT (now <=> before)").selectExpr("game_key", f"inline({both})")
    return Changes(land(rows.selectExpr("game_key", "copy.digest", "copy.end_time", "sign"), "changes"), new, batches, afresh)


def batch_folders(spark: SparkSession, path: str) -> list[str]:
    """The batches a table has partitions of, from the listing alone."""
    fs, location = filesystem(spark, path)
    if not fs.exists(location):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(location) if s.isDirectory()]
    return sorted(n.removeprefix("batch=") for n in names if n.startswith("batch="))
