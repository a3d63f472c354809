"""Attaching an evaluation and a W/D/L triple to every position."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plyscope.functions.scoring import white_ply_sql
from plyscope.session import land

# A scorer takes batches with a `position` column and yields, for each position it
# can score, `position, eval_type, eval_value, wdl`. It is called once per
# partition, so it can start an engine once and reuse it.
Scorer = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]

SCORES = T.StructType(
    [
        T.StructField("position", T.StringType()),
        T.StructField("eval_type", T.StringType()),
        T.StructField("eval_value", T.LongType()),
        T.StructField("wdl", T.ArrayType(T.LongType())),
    ]
)


def score_table(moves: DataFrame, scorer: Scorer, partitions: int | None = None) -> DataFrame:
    """One row per distinct position. Copies fold before the shuffle, so a position
    shared by many games travels once per task and is scored once."""
    positions = moves.select("position").where(F.col("position").isNotNull()).distinct()
    if partitions:
        positions = positions.repartition(partitions, "position")
    return positions.mapInPandas(scorer, SCORES)


def score_join(moves: DataFrame, scores: DataFrame) -> DataFrame:
    """Moves with `Evaluation` and `WDL Stats` from a score table, one row per position.

    A ply whose position has no score is kept with NULLs. The right side is
    unique, so a position that most games share makes the left side of the join
    lopsided but never multiplies rows. Adaptive execution splits such a side, given
    that the scores come from a written table: over an aggregate on `position` it
    would find no shuffle to split.
    """
    flat = scores.selectExpr(
        "position",
        "CASE WHEN eval_value IS NOT NULL THEN named_struct('type', eval_type, 'value', eval_value) END AS Evaluation",
        "wdl AS `WDL Stats`",
    )
    return moves.join(flat, "position", "left")


def score_positions(moves: DataFrame, scorer: Scorer, partitions: int | None = None) -> DataFrame:
    """Scores each distinct position once and joins the scores back.

    The scores, the dearest data there are, are written down first: no lost executor
    and no second pass makes the scorer work on a position again.
    """
    return score_join(moves, land(score_table(moves, scorer, partitions), "scores"))


def normalise_scores(
    moves: DataFrame, eval_perspective: str = "white", wdl_perspective: str = "mover", ply: str = "Move_Number"
) -> DataFrame:
    """Turn scores into what the scoring chain expects: evaluations seen from White,
    W/D/L seen from the side to move in the scored position.

    After White's ply Black is to move, so mover-relative evaluations change sign
    on odd plies; White-relative triples are turned round on the same plies.
    """
    for name in (eval_perspective, wdl_perspective):
        if name not in ("white", "mover"):
            raise ValueError(f"unknown perspective {name!r}")
    black_to_move = white_ply_sql(ply)
    out = moves
    if eval_perspective == "mover":
        turned = "named_struct('type', Evaluation.type, 'value', -Evaluation.value)"
        out = out.withColumn(
            "Evaluation",
            F.expr(f"CASE WHEN {black_to_move} AND Evaluation IS NOT NULL THEN {turned} ELSE Evaluation END"),
        )
    if wdl_perspective == "white":
        out = out.withColumn(
            "WDL Stats", F.expr(f"CASE WHEN {black_to_move} THEN reverse(`WDL Stats`) ELSE `WDL Stats` END")
        )
    return out
