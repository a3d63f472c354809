"""Scores kept from run to run, in buckets of positions.

Each run writes the scores of the positions it met first, into the buckets they hash to. A run
looks its positions up in their own buckets and opens no other, so a small drop reads a small
part of the scores however long the history is. The number of buckets is fixed with the store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plyscope.operators.report import bounded_broadcast
from plyscope.operators.scores import SCORES, Scorer, score_join, score_table
from plyscope.session import land
from plyscope.sources import tables as tb

#: Set it high for a large history: buckets beyond the tasks of a run cost files, fewer cost reading.
BUCKETS = 16
KEPT = T.StructType([*SCORES.fields, T.StructField("batch", T.StringType()), T.StructField("bucket", T.IntegerType())])


def bucket_count(spark: SparkSession, path: str, wanted: int = BUCKETS) -> int:
    """The number of buckets of a store, which its first run decides."""
    marks = f"{path}/_buckets"
    if "count" not in tb._files(spark, marks):
        try:
            tb.put_mark(spark, marks, "count", {"buckets": wanted})
        except FileExistsError:
            pass  # another run was first
    return tb.get_mark(spark, f"{marks}/count")["buckets"]


def kept_scores(spark: SparkSession, path: str, batch: str, positions: DataFrame) -> DataFrame:
    """The scores that other batches keep of `positions` (position, bucket). Only the buckets of
    these positions are opened; few positions go to the scores, which are then not shuffled."""
    if not tb.exists(spark, f"{path}/batch=*"):
        return spark.createDataFrame([], SCORES)
    touched = sorted(r.bucket for r in positions.select("bucket").distinct().collect())  # as many as buckets, at most
    kept = spark.read.schema(KEPT).parquet(path).where(F.col("bucket").isin(touched) & (F.col("batch") != batch))
    keys, _ = bounded_broadcast(positions.select("bucket", "position"))
    return kept.join(keys, ["bucket", "position"], "left_semi").select(SCORES.fieldNames())


def score_from_book(moves: DataFrame, path: str, batch: str, scorer: Scorer, buckets: int = BUCKETS) -> DataFrame:
    """Moves with their scores, as `score_positions` gives them, with what `path` keeps.

    Positions that no other batch has met are scored, once each, and kept under `batch`; a
    batch never reads its own scores, so one that failed is repeated in place.
    """
    spark = moves.sparkSession
    count = bucket_count(spark, path, buckets)
    positions = moves.select("position").where("position IS NOT NULL").distinct()
    positions = land(positions.withColumn("bucket", F.expr(f"CAST(pmod(xxhash64(position), {count}) AS INT)")), "positions")
    old = land(kept_scores(spark, path, batch, positions), "old-scores")
    unmet = positions.select("position").join(old.select("position"), "position", "left_anti")
    scored = score_table(unmet, scorer).withColumn("bucket", F.expr(f"CAST(pmod(xxhash64(position), {count}) AS INT)"))
    own = f"{path}/batch={batch}"
    scored.repartition("bucket").sortWithinPartitions("bucket", "position").write.mode("overwrite").partitionBy("bucket").parquet(own)
    new = spark.read.schema(KEPT).parquet(own) if tb.exists(spark, f"{own}/bucket=*") else spark.createDataFrame([], SCORES)
    return score_join(moves, old.unionByName(new.select(SCORES.fieldNames())))
