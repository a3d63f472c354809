"""Ordered work inside games that may be of any length.

A game is cut into chunks of consecutive ply numbers, and chunks, not games, are
what is hashed to tasks. So one game that holds a large part of all rows is spread
over the cluster like any other data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plyscope.functions import scoring as sc
from plyscope.session import land

CHUNK_PLIES = 4096
MAX_PLY = 2**63 - 1
GAME_KEY = "struct({game} IS NULL AS none, {game} AS name)"
BROKEN_PROMISE = "CAST(raise_error('a ply beyond the first chunk, although long_games=none') AS BIGINT)"
BROADCAST_GAMES = 100_000
#: Chunks, or blocks of chunks, that are put in order together.
WIDE = 64

MEANS = ("ACPL_White", "ACPL_Black", "Game_Accuracy_White", "Game_Accuracy_Black")


def _scored(ply: str, ev: str, w: str, d: str, pev: str, pw: str, pd: str) -> dict[str, str]:
    before, after = sc.win_probability_sql(pw, pd, w, d)
    delta = sc.win_delta_sql(before, after)
    return {
        "CentiPawnLoss": sc.centipawn_loss_sql(pev, ev, ply),
        "wp_before": before,
        "wp_after": after,
        "delta": delta,
        "move_accuracy": sc.move_accuracy_sql(delta),
    }


def _measures(ply: str, loss: str, delta: str, accuracy: str, skip_first: bool) -> dict[str, str]:
    """What each per-game mean is taken over: NULL where a row does not enter it."""
    only = f" AND {delta} IS NOT NULL" if skip_first else ""
    white, black = sc.white_ply_sql(ply) + only, sc.black_ply_sql(ply) + only
    charged = sc.charged_loss_sql(loss)
    return {
        "ACPL_White": f"CASE WHEN {white} THEN {charged} END",
        "ACPL_Black": f"CASE WHEN {black} THEN {charged} END",
        "Game_Accuracy_White": f"CASE WHEN {white} THEN {accuracy} END",
        "Game_Accuracy_Black": f"CASE WHEN {black} THEN {accuracy} END",
    }


def _named(columns: dict[str, str], prefix: str = "") -> list[str]:
    return [f"{x} AS `{prefix}{name}`" for name, x in columns.items()]


def score_plies(
    moves: DataFrame,
    game: str = "Game_Number",
    ply: str = "Move_Number",
    mate_policy: str = "verbatim",
    skip_first: bool = False,
    chunk_plies: int = CHUNK_PLIES,
    long_games: str = "check",
    ordered: bool = False,
) -> DataFrame:
    """Every ply with its loss, win probabilities, accuracy, phase and side means.

    One shuffle of the moves, by (game, chunk). Inside a chunk the previous ply
    comes from a window. Where a game has several chunks, a second, small relation
    with one row per chunk carries the last scores of each chunk to the next one
    and adds the chunks' sums up.

    `long_games` says how that relation comes about. `check` first looks for games
    of more than one chunk, a scan of two columns whose filter reaches the parquet
    statistics: with none there is no relation, and with some only their rows are
    read again. `none` promises there are none, and a ply beyond the first chunk
    fails the query; `all` builds the relation over all rows; both run nothing ahead.
    A NULL game is one game like any other.

    With `ordered` the shuffle is by range, so that it serves the total order by
    game and ply as well.

    Rows with no previous score count as loss 0 and accuracy 100, unless
    `skip_first` leaves plies without a delta out of the means.
    """
    cut = moves.selectExpr(
        "*",
        f"{sc.evaluation_value_sql('Evaluation', mate_policy)} AS _ev",
        f"{sc.from_end_sql('`WDL Stats`', 3)} AS _w",
        f"{sc.from_end_sql('`WDL Stats`', 2)} AS _d",
        f"coalesce(CAST({ply} AS BIGINT), {MAX_PLY}L) AS _ord",
    ).selectExpr("*", f"(_ord - 1) div {int(chunk_plies)} AS _chunk")
    if long_games == "none":
        cut = cut.withColumn("_chunk", F.expr(f"CASE WHEN {_elsewhere(ply, chunk_plies)} THEN {BROKEN_PROMISE} ELSE _chunk END"))

    several = _several_chunks(cut, game, ply, chunk_plies, long_games)
    key, by_game = game, F.col(game).asc_nulls_last()
    if several is not None:
        # Never NULL, so that rows meet their bridge; it sorts as the game does, NULL last.
        cut, several = (df.withColumn("_game", F.expr(GAME_KEY.format(game=game))) for df in (cut, several))
        key, by_game = "_game", F.col("_game")
    placed = cut.repartitionByRange(by_game, "_chunk") if ordered else cut
    rows, measures = _within_chunks(placed, key, ply, skip_first)
    means = {m: f"_m_{m}" for m in MEANS}
    before = {"pev": "_pev", "pw": "_pw", "pd": "_pd"}
    if several is not None:
        levels = _levels(cut, ply, chunk_plies, long_games)
        bridge = _chunk_bridge(several, measures, key, ply, skip_first, levels)
        rows = rows.join(bridge, [key, "_chunk"], "left")
        before = {c: f"_x{c}" for c in before}
        rows = rows.selectExpr("*", *[f"CASE WHEN _head THEN _b{c} ELSE _{c} END AS {x}" for c, x in before.items()])
        means = {m: f"coalesce(_b_{m}, _m_{m})" for m in MEANS}
    derived = {
        "Player_To_Move": sc.player_to_move_sql(ply),
        **_scored(ply, "_ev", "_w", "_d", **before),
        **{m: sc.round2_sql(x) for m, x in means.items()},
        "game_phase": sc.game_phase_sql(ply),
    }
    own = [f"`{c}`" for c in moves.columns if c not in derived]
    out = rows.selectExpr(*own, *_named(derived), *(["_game"] if key != game else []), "_chunk", "_ord")
    if ordered:
        out = out.orderBy(by_game, "_chunk", "_ord")
    return out.drop("_game", "_chunk", "_ord")


def _elsewhere(ply: str, chunk_plies: int) -> str:
    """A ply beyond the first chunk; on the ply itself, so that a scan can use it."""
    return f"{ply} IS NULL OR {ply} > {chunk_plies} OR {ply} <= {1 - chunk_plies}"


def _levels(cut: DataFrame, ply: str, chunk_plies: int, long_games: str) -> int:
    """How many times chunks are gathered into blocks of `WIDE`, so that no game, however long,
    has more of them in one task. Looked up as `long_games` has it; 2 serve any game of up to
    a thousand million plies."""
    if long_games == "all":
        return 2
    for level in (0, 1):
        if cut.where(_elsewhere(ply, chunk_plies * WIDE ** (level + 1))).isEmpty():
            return level
    return 2


def _several_chunks(cut: DataFrame, game: str, ply: str, chunk_plies: int, long_games: str) -> DataFrame | None:
    """Rows of games that may have more than one chunk; None if there are none.

    Few such games are broadcast, by checked count. With more than that, most rows
    belong to one of them, and no rows are left out.
    """
    if long_games == "none":
        return None
    if long_games == "all":
        return cut
    if long_games != "check":
        raise ValueError(f"unknown long_games {long_games!r}")
    plies_elsewhere = cut.where(_elsewhere(ply, chunk_plies)).select(F.col(game).alias("_name"))
    if plies_elsewhere.isEmpty():
        return None
    names = plies_elsewhere.distinct()
    if names.limit(BROADCAST_GAMES + 1).count() > BROADCAST_GAMES:
        return cut
    return cut.join(F.broadcast(names), F.col(game).eqNullSafe(F.col("_name")), "left_semi")


def _within_chunks(cut: DataFrame, game: str, ply: str, skip_first: bool) -> tuple[DataFrame, dict[str, str]]:
    """Rows with the scores of the ply before in the same chunk, and the side means of
    the chunk. Both windows share one shuffle and one sort."""
    in_chunk = f"OVER (PARTITION BY {game}, _chunk ORDER BY _ord)"
    scored = _scored(ply, "_ev", "_w", "_d", "_pev", "_pw", "_pd")
    measures = _measures(ply, "_loss", "_delta", "_acc", skip_first)
    rows = cut.selectExpr(
        "*",
        *[f"lag(_{c}) {in_chunk} AS _p{c}" for c in ("ev", "w", "d")],
        f"row_number() {in_chunk} = 1 AS _head",
    ).selectExpr(
        "*",
        f"{scored['CentiPawnLoss']} AS _loss",
        f"{scored['delta']} AS _delta",
        f"{scored['move_accuracy']} AS _acc",
    )
    over = f"OVER (PARTITION BY {game}, _chunk)"
    return rows.selectExpr("*", *[f"avg({x}) {over} AS _m_{m}" for m, x in measures.items()]), measures


def _chunk_bridge(
    several: DataFrame, measures: dict[str, str], game: str, ply: str, skip_first: bool, levels: int = 0
) -> DataFrame:
    """One row per chunk: the scores before its first ply, and the side means of the
    whole game. Heads of chunks are left out of the chunk's sums, since their loss
    is only known here."""
    rows, _ = _within_chunks(several, game, ply, skip_first)
    of_head = {"_hply": ply, "_hev": "_ev", "_hw": "_w", "_hd": "_d"}
    folds = {name: f"max(CASE WHEN _head THEN {x} END)" for name, x in of_head.items()}
    folds["_tail"] = "max_by(struct(_ev AS ev, _w AS w, _d AS d), _ord)"
    folds |= {f"_s_{m}": f"sum(CASE WHEN NOT _head THEN {x} END)" for m, x in measures.items()}
    folds |= {f"_n_{m}": f"count(CASE WHEN NOT _head THEN {x} END)" for m, x in measures.items()}
    chunks = rows.groupBy(game, "_chunk").agg(*[F.expr(x).alias(name) for name, x in folds.items()])
    return bridge_chunks(chunks, game, skip_first, levels)


def bridge_chunks(chunks: DataFrame, game: str, skip_first: bool, levels: int) -> DataFrame:
    """The bridge from one row per chunk: its head (`_hply`, `_hev`, `_hw`, `_hd`), its `_tail`,
    and sums and counts of the measures of all plies but the head (`_s_`, `_n_`)."""
    heads = _scored("_hply", "_hev", "_hw", "_hd", "_bpev", "_bpw", "_bpd")
    chunks = tails_before(chunks, game, "_chunk", levels).selectExpr("*", *[f"_before.{c} AS _bp{c}" for c in ("ev", "w", "d")])
    chunks = chunks.selectExpr("*", *_named({k: heads[k] for k in ("CentiPawnLoss", "delta", "move_accuracy")}, "_h_"))
    own = _measures("_hply", "_h_CentiPawnLoss", "_h_delta", "_h_move_accuracy", skip_first)
    sums = {f"_w_{m}": f"coalesce(_s_{m}, 0) + coalesce({x}, 0)" for m, x in own.items()}
    sums |= {f"_k_{m}": f"_n_{m} + CASE WHEN {x} IS NOT NULL THEN 1 ELSE 0 END" for m, x in own.items()}
    chunks = with_totals(chunks.selectExpr(game, "_chunk", "_bpev", "_bpw", "_bpd", *_named(sums)), game, "_chunk", tuple(sums), levels)
    means = {m: f"_w_{m} / nullif(_k_{m}, 0)" for m in own}
    return chunks.selectExpr(game, "_chunk", "_bpev", "_bpw", "_bpd", *_named(means, "_b_"))


def tails_before(rows: DataFrame, game: str, place: str, levels: int) -> DataFrame:
    """Adds to rows (game, place, _tail) the tail of the row before in the game, as `_before`.

    With levels, rows are gathered into blocks of `WIDE` places: inside a block a window tells
    what came before, and the first of a block is told by the blocks, which are rows of the
    same kind. So no task holds more of one game than a block, or the blocks at the top.
    """
    if not levels:
        return rows.selectExpr("*", f"lag(_tail) OVER (PARTITION BY {game} ORDER BY {place}) AS _before")
    block, own = f"{place}_of", rows.columns
    rows = rows.selectExpr("*", f"{place} div {WIDE} AS {block}")
    blocks = rows.groupBy(game, block).agg(F.expr(f"max_by(_tail, {place})").alias("_tail"))
    blocks = tails_before(blocks, game, block, levels - 1).selectExpr(game, block, "_before AS _carried")
    in_block = f"OVER (PARTITION BY {game}, {block} ORDER BY {place})"
    rows = rows.selectExpr("*", f"lag(_tail) {in_block} AS _near", f"row_number() {in_block} = 1 AS _edge")
    return rows.join(blocks, [game, block]).selectExpr(*own, "CASE WHEN _edge THEN _carried ELSE _near END AS _before")


def with_totals(rows: DataFrame, game: str, place: str, sums: tuple[str, ...], levels: int) -> DataFrame:
    """Rows with the sums of their game in place of their own, handed up and down by blocks."""
    if not levels:
        others = [c for c in rows.columns if c not in sums]
        return rows.selectExpr(*others, *[f"sum({c}) OVER (PARTITION BY {game}) AS {c}" for c in sums])
    block = f"{place}_of"
    rows = rows.selectExpr("*", f"{place} div {WIDE} AS {block}")
    blocks = rows.groupBy(game, block).agg(*[F.sum(c).alias(c) for c in sums])
    return rows.drop(*sums).join(with_totals(blocks, game, block, sums, levels - 1), [game, block]).drop(block)


def side_aggregates(scored: DataFrame, keys: tuple[str, ...] = ("Game_Number",)) -> DataFrame:
    """One row per game: the four side means and the number of plies.

    The means are constant inside a game, so their maximum is the value, and it
    folds before the shuffle.
    """
    return scored.groupBy(*keys).agg(
        *[F.expr(f"max({m})").alias(m) for m in MEANS], F.expr("count(*)").alias("plies")
    )


def ordered(df: DataFrame, game: str = "Game_Number", ply: str = "Move_Number") -> DataFrame:
    """Total order by game and ply, NULLs last. For display: files want no total order."""
    return df.orderBy(F.col(game).asc_nulls_last(), F.col(ply).asc_nulls_last())


def number_games(
    games: DataFrame,
    order: tuple[str, ...] = ("end_time", "game_key"),
    out: str = "Game_Number",
    partitions: int | None = None,
) -> DataFrame:
    """Numbers 1..n over all games in `order`, which must be unique.

    A window over everything would sort all games in one task. Instead the games
    are range-partitioned and sorted, each row's position inside its partition is
    written down with it, and the partitions' counts, one row each, give the
    offsets. The positions are read back from the shared folder, so the two passes
    cannot see different partitions, even if executors are lost in between.
    """
    spark = games.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_last() for c in order]
    placed = land(
        games.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_slot", F.monotonically_increasing_id()),
        "numbered",
    )
    # At most `n` rows, whatever the data: safe in one window and to broadcast.
    offsets = (
        placed.groupBy(F.expr("shiftright(_slot, 33)").alias("_part"))
        .agg(F.expr("count(*)").alias("_n"))
        .selectExpr(
            "_part",
            "coalesce(sum(_n) OVER (ORDER BY _part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _before",
        )
    )
    own = [f"`{c}`" for c in games.columns]
    return (
        placed.selectExpr("*", "shiftright(_slot, 33) AS _part")
        .join(F.broadcast(offsets), "_part")
        .selectExpr(*own, f"(_slot & {2**33 - 1}L) + _before + 1 AS `{out}`")
    )
