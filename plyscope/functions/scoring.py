"""Column expressions of the scoring chain. All stay JVM-side, inside codegen.

Every argument is an SQL expression, of which a column name is the simplest; the
`*_sql` functions give SQL text that can be put inside a larger expression, the
others a Column.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accuracy curve and the scales of the scores.
ACCURACY_SCALE = 103.1668
ACCURACY_DECAY = -0.04354
ACCURACY_SHIFT = 3.1669
PERMILLE = 1000
PHASE_BOUNDS = (10, 25)

# Own choices: how much win probability a mistake of each kind loses at least.
LOSS_BANDS = (("blunder", 0.30), ("mistake", 0.20), ("inaccuracy", 0.10))
MATE_VALUE = 1000


def round2_sql(x: str) -> str:
    """Two decimals by scaling, which rounds means the way DuckDB does."""
    return f"(round(({x}) * 100) / 100)"


def mean2_sql(x: str) -> str:
    """Mean of values that already have two decimals, rounded to two decimals.

    Summed as whole hundredths, so the result does not depend on the order in
    which partitions are added up.
    """
    return f"(round(avg(CAST(round(({x}) * 100) AS BIGINT))) / 100)"


def from_end_sql(items: str, k: int) -> str:
    """k-th list element counted from the end; NULL when the list is shorter."""
    return f"try_element_at({items}, {-int(k)})"


def evaluation_value_sql(evaluation: str = "Evaluation", mate_policy: str = "verbatim") -> str:
    """Evaluation value. `clamp` turns a distance to mate into +-MATE_VALUE;
    `verbatim` mixes the kinds."""
    if mate_policy == "verbatim":
        return f"{evaluation}.value"
    if mate_policy == "clamp":
        return (
            f"CASE WHEN {evaluation}.type = 'mate' THEN CAST(signum({evaluation}.value) * {MATE_VALUE} AS BIGINT) "
            f"ELSE {evaluation}.value END"
        )
    raise ValueError(f"unknown mate_policy {mate_policy!r}")


def white_ply_sql(ply: str) -> str:
    return f"({ply}) % 2 = 1"


def black_ply_sql(ply: str) -> str:
    return f"({ply}) % 2 = 0"


def player_to_move_sql(ply: str, white: str = "White", black: str = "Black") -> str:
    return f"CASE WHEN {white_ply_sql(ply)} THEN {white} ELSE {black} END"


def centipawn_loss_sql(prev_eval: str, evaluation: str, ply: str) -> str:
    """Signed loss for the side that moved, with White-relative evaluations."""
    return f"CASE WHEN {white_ply_sql(ply)} THEN {prev_eval} - {evaluation} ELSE {evaluation} - {prev_eval} END"


def expected_score_sql(w: str, d: str) -> str:
    """Share of the point. A double literal keeps the arithmetic out of DECIMAL."""
    return f"(({w} + 0.5D * {d}) / {PERMILLE})"


def win_probability_sql(prev_w: str, prev_d: str, w: str, d: str) -> tuple[str, str]:
    """Expected score of the mover (before, after) the ply."""
    return expected_score_sql(prev_w, prev_d), f"(1 - {expected_score_sql(w, d)})"


def win_delta_sql(before: str, after: str) -> str:
    return f"({before} - {after})"


def move_accuracy_sql(delta: str) -> str:
    """0-100. A NULL delta gives 100, as greatest and least skip NULL."""
    curve = f"{ACCURACY_SCALE}D * exp({ACCURACY_DECAY}D * {delta} * 100) - {ACCURACY_SHIFT}D"
    return f"greatest(0D, least(100D, {curve}))"


def charged_loss_sql(loss: str) -> str:
    """Loss as it enters a mean: a gain, or no score, counts as 0."""
    return f"greatest({loss}, 0L)"


def game_phase_sql(ply: str = "Move_Number", bounds: tuple[int, int] = PHASE_BOUNDS) -> str:
    """Phase by ply; anything past the bounds, and NULL, is `endgame`."""
    opening, middlegame = bounds
    return (
        f"CASE WHEN {ply} BETWEEN 1 AND {opening} THEN 'opening' "
        f"WHEN {ply} BETWEEN {opening + 1} AND {middlegame} THEN 'middlegame' ELSE 'endgame' END"
    )


def loss_kind_sql(delta: str, bands=LOSS_BANDS) -> str:
    """Kind of mistake by win probability lost, NULL below the lowest band."""
    cases = " ".join(f"WHEN round({delta}, 6) >= {least}D THEN '{name}'" for name, least in bands)
    return f"CASE {cases} END"


def white_score_sql(result: str = "Result") -> str:
    """White's point from the result text; NULL for an unfinished game."""
    return f"CASE {result} WHEN '1-0' THEN 1D WHEN '0-1' THEN 0D WHEN '1/2-1/2' THEN 0.5D END"


def round2(x: str) -> Column:
    return F.expr(round2_sql(x))


def mean2(x: str) -> Column:
    return F.expr(mean2_sql(x))


def from_end(items: str, k: int) -> Column:
    return F.expr(from_end_sql(items, k))


def evaluation_type(evaluation: str = "Evaluation") -> Column:
    return F.expr(f"{evaluation}.type")


def evaluation_value(evaluation: str = "Evaluation", mate_policy: str = "verbatim") -> Column:
    return F.expr(evaluation_value_sql(evaluation, mate_policy))


def player_to_move(ply: str = "Move_Number", white: str = "White", black: str = "Black") -> Column:
    return F.expr(player_to_move_sql(ply, white, black))


def centipawn_loss(prev_eval: str, evaluation: str, ply: str) -> Column:
    return F.expr(centipawn_loss_sql(prev_eval, evaluation, ply))


def win_probability(prev_w: str, prev_d: str, w: str, d: str) -> tuple[Column, Column]:
    before, after = win_probability_sql(prev_w, prev_d, w, d)
    return F.expr(before), F.expr(after)


def win_delta(before: str, after: str) -> Column:
    return F.expr(win_delta_sql(before, after))


def move_accuracy(delta: str) -> Column:
    return F.expr(move_accuracy_sql(delta))


def game_phase(ply: str = "Move_Number", bounds: tuple[int, int] = PHASE_BOUNDS) -> Column:
    return F.expr(game_phase_sql(ply, bounds))


def loss_kind(delta: str = "delta", bands=LOSS_BANDS) -> Column:
    return F.expr(loss_kind_sql(delta, bands))


def white_score(result: str = "Result") -> Column:
    return F.expr(white_score_sql(result))
