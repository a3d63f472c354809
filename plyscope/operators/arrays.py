"""Scoring of games that are held as arrays of plies, without a shuffle of plies.

A row is a chunk of a game: up to some thousand consecutive plies as an array. All that a ply
needs of the one before lies in the same array, but for the first of a chunk. Games of several
chunks are bridged by a small relation with one row per chunk, which is broadcast after a look
at its size; games of one chunk, which nearly all are, need nothing but their own row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plyscope.functions import scoring as sc
from plyscope.operators.report import bounded_broadcast
from plyscope.operators.sequence import CHUNK_PLIES, MEANS, _measures, _named, _scored, bridge_chunks

PLY = ("Move_Number", "Move", "Evaluation", "WDL Stats")


def game_chunks(moves: DataFrame, game: str = "Game_Number", chunk_plies: int = CHUNK_PLIES) -> DataFrame:
    """Moves, one row per ply, as chunks: game, `chunk`, the columns of the game, and `plies`.

    This is the one shuffle, by game and chunk; a table that is kept in this form is scored
    without any. Plies without a number come last, in a chunk of their own.
    """
    last = (2**63 - 1) // int(chunk_plies)
    chunk = f"coalesce((CAST(Move_Number AS BIGINT) - 1) div {int(chunk_plies)}, {last}L)"
    row = ", ".join(f"`{c}`" for c in PLY)
    others = [c for c in moves.columns if c not in (*PLY, game)]
    keyed = moves.selectExpr(f"`{game}`", f"{chunk} AS chunk", *[f"`{c}`" for c in others], f"struct(Move_Number IS NULL AS none, {row}) AS p")
    folds = [F.expr("transform(array_sort(collect_list(p), (a, b) -> CASE WHEN a.none <> b.none THEN IF(a.none, 1, -1) "
                    "WHEN a.Move_Number < b.Move_Number THEN -1 WHEN a.Move_Number > b.Move_Number THEN 1 ELSE 0 END), "
                    f"p -> struct({', '.join(f'p.`{c}`' for c in PLY)}))").alias("plies")]  # fmt: skip
    return keyed.groupBy(game, "chunk").agg(*[F.first(c).alias(c) for c in others], *folds)


def score_chunks(
    chunks: DataFrame, game: str = "Game_Number", mate_policy: str = "verbatim", skip_first: bool = False, levels: int = 2
) -> DataFrame:
    """One row per ply with the columns of `score_plies`, from rows of (game, chunk, plies).

    Chunks follow each other by number, plies inside a chunk by place; a game is a game also
    if it is NULL. No ply is shuffled as long as the bridge, one row for each chunk of games
    with several, fits a broadcast; beyond that the chunks are.
    """
    values = (
        f"transform(plies, p -> named_struct('ply', CAST(p.Move_Number AS BIGINT), 'ev', {sc.evaluation_value_sql('p.Evaluation', mate_policy)}, "
        f"'w', {sc.from_end_sql('p.`WDL Stats`', 3)}, 'd', {sc.from_end_sql('p.`WDL Stats`', 2)}))"
    )
    rows = chunks.where("size(plies) > 0").withColumn("_s", F.expr(values))
    rows = rows.withColumn("_game", F.expr(f"struct(`{game}` IS NULL AS none, `{game}` AS name)"))

    several = rows.where("chunk <> 0").select("_game").distinct()
    bridge = None
    if not several.isEmpty():
        several, _ = bounded_broadcast(several)
        bridge = _array_bridge(rows.select("_game", "chunk", "_s").join(several, "_game", "left_semi"), skip_first, levels)
        bridge, _ = bounded_broadcast(bridge.withColumnRenamed("_chunk", "chunk"))
        rows = rows.join(bridge, ["_game", "chunk"], "left")
    before = ["_bpev", "_bpw", "_bpd"] if bridge is not None else ["CAST(NULL AS BIGINT)"] * 3
    rows = rows.withColumn("_x", F.expr(_array_scores(*before)))
    rows = rows.selectExpr("*", *[f"{_total(x, '_s', '_x')} AS _t_{m}" for m, x in _ply_measures(skip_first).items()])
    means = {m: sc.round2_sql(f"coalesce({f'_b_{m}' if bridge is not None else 'NULL'}, _t_{m}.s / nullif(_t_{m}.n, 0))") for m in MEANS}
    own = [f"`{c}`" for c in chunks.columns if c not in ("chunk", "plies")]
    flat = rows.selectExpr(*own, *_named(means), "inline(zip_with(plies, _x, (p, x) -> named_struct(" + ", ".join(
        [*[f"'{c}', p.`{c}`" for c in PLY], *[f"'{c}', x.`{c}`" for c in ("CentiPawnLoss", "wp_before", "wp_after", "delta", "move_accuracy")]]
    ) + ")))")
    return flat.selectExpr("*", f"{sc.player_to_move_sql('Move_Number')} AS Player_To_Move", f"{sc.game_phase_sql('Move_Number')} AS game_phase")


def _array_scores(ev: str, w: str, d: str) -> str:
    """Each ply of `_s` scored against the one before; what was before the first is given."""
    head = f"array(named_struct('ply', CAST(NULL AS BIGINT), 'ev', CAST({ev} AS BIGINT), 'w', CAST({w} AS BIGINT), 'd', CAST({d} AS BIGINT)))"
    scored = _scored("p.ply", "p.ev", "p.w", "p.d", "q.ev", "q.w", "q.d")
    fields = ", ".join(f"'{name}', {x}" for name, x in scored.items())
    return f"zip_with(_s, concat({head}, slice(_s, 1, size(_s) - 1)), (p, q) -> named_struct({fields}))"


def _ply_measures(skip_first: bool) -> dict[str, str]:
    return _measures("p.ply", "x.CentiPawnLoss", "x.delta", "x.move_accuracy", skip_first)


def _total(measure: str, plies: str, scores: str) -> str:
    """Sum and count of a measure over an array of plies and their scores."""
    each = f"zip_with({plies}, {scores}, (p, x) -> CAST({measure} AS DOUBLE))"
    return f"aggregate({each}, named_struct('s', 0D, 'n', 0L), (a, v) -> IF(v IS NULL, a, named_struct('s', a.s + v, 'n', a.n + 1L)))"


def _array_bridge(rows: DataFrame, skip_first: bool, levels: int) -> DataFrame:
    """One row per chunk of games with several: the scores before it, and the game's side means."""
    rows = rows.withColumn("_x", F.expr(_array_scores("NULL", "NULL", "NULL")))
    inner = {m: _total(x, "slice(_s, 2, size(_s))", "slice(_x, 2, size(_x))") for m, x in _ply_measures(skip_first).items()}
    folded = rows.selectExpr(
        "_game", "chunk AS _chunk", "_s[0].ply AS _hply", "_s[0].ev AS _hev", "_s[0].w AS _hw", "_s[0].d AS _hd",
        "element_at(transform(_s, p -> struct(p.ev AS ev, p.w AS w, p.d AS d)), -1) AS _tail", *[f"{x} AS _i_{m}" for m, x in inner.items()],
    )
    sums = [f"_i_{m}.{c} AS _{c}_{m}" for m in inner for c in ("s", "n")]
    return bridge_chunks(folded.selectExpr("_game", "_chunk", "_hply", "_hev", "_hw", "_hd", "_tail", *sums), "_game", skip_first, levels)
