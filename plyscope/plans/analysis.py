"""The composed move analysis."""

from __future__ import annotations

from pyspark.sql import DataFrame

from plyscope.operators.sequence import score_plies
from plyscope.schemas import ANALYSIS_COLUMNS


def move_analysis(
    moves: DataFrame,
    game: str = "Game_Number",
    ordered: bool = True,
    keep: tuple[str, ...] = (),
    **options,
) -> DataFrame:
    """One analysed row per ply, with the columns of the analysis table.

    `keep` carries more columns along (delta, players, dates), which spares the
    reports a join back to the moves. The total order by game and ply costs a pass
    that samples the keys; `ordered=False` spares it.
    """
    scored = score_plies(moves, game=game, ordered=ordered, **options)
    columns = [game if c == "Game_Number" else c for c in ANALYSIS_COLUMNS]
    return scored.select(*columns, *[c for c in keep if c not in columns])
