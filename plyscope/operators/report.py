"""Report tables. Each works for one player, or for every player at once.

All of them fold by key before the shuffle, so a player who is in a third of all
games costs no more than one partial row per task. Top-k lists use a filtered row
number, which Spark also cuts to k rows per key before the shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plyscope.functions import scoring as sc
from plyscope.operators import sequence
from plyscope.session import land

PHASES = ("opening", "middlegame", "endgame")
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 << 20
DATE_FORMAT = "yyyy.MM.dd"
STEPS = "CAST(round(delta * 2000) AS BIGINT)"


def _agg(df: DataFrame, keys: tuple[str, ...], **folds: str) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.expr(x).alias(name) for name, x in folds.items()])


def for_player(df: DataFrame, player: str, columns: tuple[str, ...] = ("Player_To_Move",)) -> DataFrame:
    """Rows where any of `columns` names the player, without regard to case."""
    name = F.lit(player.lower())
    match = F.lower(F.col(columns[0])) == name
    for c in columns[1:]:
        match = match | (F.lower(F.col(c)) == name)
    return df.where(match)


def _movers(scored: DataFrame, player: str | None) -> DataFrame:
    df = scored if player is None else for_player(scored, player)
    return df.selectExpr("*", "lower(Player_To_Move) AS player")


def phase_breakdown(scored: DataFrame, player: str | None = None, ordered: bool = True) -> DataFrame:
    """Mean accuracy per phase."""
    out = _agg(_movers(scored, player), ("player", "game_phase"), avg_accuracy=sc.round2_sql("avg(move_accuracy)"))
    return out.orderBy("player", "game_phase") if ordered else out


def phase_drop(scored: DataFrame, player: str | None = None) -> DataFrame:
    """Mean accuracy of the three phases and the phase that drops most from the last
    phase played before it. A tie goes to the earlier phase."""
    means = _agg(
        _movers(scored, player),
        ("player",),
        **{p: sc.round2_sql(f"avg(CASE WHEN game_phase = '{p}' THEN move_accuracy END)") for p in PHASES},
    )
    return worst_phases(means)


def worst_phases(means: DataFrame) -> DataFrame:
    """Adds the phase that drops most to the mean accuracy of the three phases."""
    return means.selectExpr(
        "*",
        "CAST(round((opening - middlegame) * 100) AS BIGINT) AS _m",
        "CAST(round((coalesce(middlegame, opening) - endgame) * 100) AS BIGINT) AS _e",
    ).selectExpr(
        "player",
        *PHASES,
        "CASE greatest(_m, _e) WHEN _m THEN 'middlegame' WHEN _e THEN 'endgame' END AS worst_phase",
        "greatest(_m, _e) / 100D AS accuracy_drop",
    )


def game_sheet(scored: DataFrame, keys: tuple[str, ...] = ("Game_Number",)) -> DataFrame:
    """One row per game: who played, when, the result, and the accuracy of each side."""
    dims = [c for c in ("Game_Link", "White", "Black", "End_Date", "Result") if c in scored.columns]
    sheet = _agg(
        scored,
        (*keys, *dims),
        Game_Accuracy_White="max(Game_Accuracy_White)",
        Game_Accuracy_Black="max(Game_Accuracy_Black)",
        plies="count(*)",
    )
    return sheet.selectExpr("*", f"{sc.white_score_sql()} AS white_result")


def _sides(sheet: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Two rows per game, one for each side, in one pass."""

    def side(name: str, won: int) -> str:
        return (
            f"named_struct('player', lower({name}), 'colour', '{name.lower()}', 'accuracy', Game_Accuracy_{name}, "
            f"'won', CAST(white_result <=> {won}D AS INT), 'lost', CAST(white_result <=> {1 - won}D AS INT))"
        )

    return sheet.selectExpr(*keep, f"inline(array({side('White', 1)}, {side('Black', 0)}))")


def performance_summary(
    sheet: DataFrame, player: str | None = None, as_of: dt.date | str | None = None
) -> DataFrame:
    """Each month against the month before: games, win rate and mean accuracy, per
    colour. With `as_of`, only the month of that date (and the one it is compared to).

    The monthly rows are aggregated first; each then counts for its own month and
    for the next one, so a month without games still shows what came before it.
    """
    sheet = sheet.selectExpr("*", f"trunc(try_to_date(End_Date, '{DATE_FORMAT}'), 'MM') AS _month")
    if as_of is not None:
        this = f"trunc(DATE '{dt.date.fromisoformat(str(as_of))}', 'MM')"
        sheet = sheet.where(f"_month IN ({this}, add_months({this}, -1))")
    sides = _sides(sheet, ("_month",))
    if player is not None:
        sides = for_player(sides, player, ("player",))
    return month_by_month(_agg(sides, ("player", "colour", "_month"), n="count(*)", w="sum(won)", a=sc.mean2_sql("accuracy")), as_of)


def month_by_month(monthly: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """Sets each month of (player, colour, _month, n, w, a) against the month before; with
    `as_of`, only the month of that date."""
    spread = monthly.selectExpr(
        "player", "colour", "n", "round(w / n, 4) AS r", "a",
        "inline(array(named_struct('m', _month, 'own', true), named_struct('m', add_months(_month, 1), 'own', false)))",
    )
    out = _agg(
        spread,
        ("player", "colour", "m"),
        games="coalesce(max(CASE WHEN own THEN n END), 0)",
        win_rate="max(CASE WHEN own THEN r END)",
        avg_accuracy="max(CASE WHEN own THEN a END)",
        prev_games="coalesce(max(CASE WHEN NOT own THEN n END), 0)",
        prev_win_rate="max(CASE WHEN NOT own THEN r END)",
        prev_accuracy="max(CASE WHEN NOT own THEN a END)",
    )
    if as_of is not None:
        out = out.where(f"m = trunc(DATE '{dt.date.fromisoformat(str(as_of))}', 'MM')")
    return out.selectExpr(
        "player", "colour", "date_format(m, 'yyyy-MM') AS month", "games", "win_rate", "avg_accuracy",
        "prev_games", "prev_win_rate", "prev_accuracy",
    )


def _mistakes(scored: DataFrame, player: str | None, bands) -> DataFrame:
    return _movers(scored, player).selectExpr("*", f"{sc.loss_kind_sql('delta', bands)} AS kind").where("kind IS NOT NULL")


def blunder_habits(scored: DataFrame, player: str | None = None, bands=sc.LOSS_BANDS) -> DataFrame:
    """Kinds of mistake per player, commonest first, with the phases they fall in.

    Losses are summed in steps of 1/2000, the unit of permille scores with half
    points, so the mean does not depend on the order of the sum.
    """
    per_kind = _agg(
        _mistakes(scored, player, bands),
        ("player", "kind"),
        n="count(*)",
        avg_loss=f"round(sum({STEPS}) * 5 / count(*)) / 10000",
        **{f"in_{p}": f"count(CASE WHEN game_phase = '{p}' THEN 1 END)" for p in PHASES},
    )
    return habit_shares(per_kind)


def habit_shares(per_kind: DataFrame) -> DataFrame:
    """Adds share and rank to the counts by player and kind."""
    # As many rows per player as there are bands.
    return per_kind.selectExpr(
        "*",
        "round(n / sum(n) OVER (PARTITION BY player), 4) AS share",
        "CAST(row_number() OVER (PARTITION BY player ORDER BY n DESC, kind) AS BIGINT) AS rank",
    )


def blunder_plies(
    scored: DataFrame, player: str | None = None, k: int = 3, width: int = 10, bands=sc.LOSS_BANDS
) -> DataFrame:
    """The k stretches of plies in which each kind of mistake happens most."""
    mistakes = _mistakes(scored, player, bands).selectExpr("player", "kind", f"(Move_Number - 1) div {int(width)} AS _s")
    return top_stretches(_agg(mistakes, ("player", "kind", "_s"), n="count(*)"), k, width)


def top_stretches(counts: DataFrame, k: int, width: int) -> DataFrame:
    """The k stretches with the highest counts of each player and kind."""
    return (
        counts.selectExpr("*", "CAST(row_number() OVER (PARTITION BY player, kind ORDER BY n DESC, _s) AS BIGINT) AS rank")
        .where(f"rank <= {int(k)}")
        .selectExpr("player", "kind", f"_s * {width} + 1 AS from_ply", f"(_s + 1) * {width} AS to_ply", "n", "rank")
    )


MOVE_KINDS = (
    "CASE WHEN {0} IS NULL THEN 'none' WHEN {0} LIKE 'O-O%' THEN 'castling' WHEN {0} LIKE '%=%' THEN 'promotion' "
    "WHEN {0} LIKE '%x%' THEN 'capture' WHEN {0} LIKE '%+%' OR {0} LIKE '%#%' THEN 'check' ELSE 'quiet' END"
)
STATES = "CASE WHEN wp_before IS NULL THEN 'unknown' WHEN wp_before < 0.35 THEN 'losing' WHEN wp_before > 0.65 THEN 'winning' ELSE 'even' END"


def mistakes_in_context(
    scored: DataFrame, player: str | None = None, bands=sc.LOSS_BANDS, game: str = "Game_Number", keep: tuple[str, ...] = ()
) -> DataFrame:
    """A player's mistakes, each with the kind of the move just made and how the game stood.

    The move before is met by a join on game and ply, which spreads a long game evenly. It is
    a merge, which spills: Spark takes plies in written tables for as small as their files, a
    fraction of their size, and would broadcast every ply to every task. A NULL game is a game
    like any other; of several moves at one ply the first kind by name counts.
    """
    by = sequence.GAME_KEY.format(game=game)  # never NULL, so that its rows meet
    mistakes = _mistakes(scored, player, bands).selectExpr(
        f"{by} AS _g", "Move_Number AS _ply", "player", "kind", f"{STATES} AS state", "game_phase", f"{STEPS} AS steps", *keep
    )
    moves = scored.selectExpr(f"{by} AS _g", "Move_Number + 1 AS _ply", f"{MOVE_KINDS.format('Move')} AS _kind")
    moves = _agg(moves, ("_g", "_ply"), _kind="min(_kind)").hint("merge")
    return mistakes.join(moves, ["_g", "_ply"], "left").selectExpr("*", "coalesce(_kind, 'none') AS after_move")


def blunder_triggers(
    scored: DataFrame, player: str | None = None, bands=sc.LOSS_BANDS, game: str = "Game_Number"
) -> DataFrame:
    """What comes before a player's mistakes: the kind of the move just made, how the game
    stood, and the phase; commonest first, with the share of all the player's mistakes."""
    met = mistakes_in_context(scored, player, bands, game)
    return trigger_shares(_agg(met, ("player", "kind", "after_move", "state", "game_phase"), n="count(*)"))


def trigger_shares(counted: DataFrame) -> DataFrame:
    """Adds share and rank to the counts of each combination."""
    # As many rows per player as there are combinations.
    return counted.selectExpr(
        "*",
        "round(n / sum(n) OVER (PARTITION BY player), 4) AS share",
        "CAST(row_number() OVER (PARTITION BY player ORDER BY n DESC, kind, after_move, state, game_phase) AS BIGINT) AS rank",
    )


def first_moves(moves: DataFrame, plies: int = 6, keys: tuple[str, ...] = ("Game_Number",)) -> DataFrame:
    """Opening key of each game: its first moves, joined. The filter reaches the scan,
    and each ply folds into a slot of its own, so nothing is gathered per game."""
    slots = {f"_{i}": f"max(CASE WHEN Move_Number = {i} THEN Move END)" for i in range(1, plies + 1)}
    early = moves.where(f"Move_Number BETWEEN 1 AND {int(plies)}")
    return _agg(early, keys, **slots).selectExpr(*keys, f"concat_ws(' ', {', '.join(slots)}) AS opening")


def opening_results(sheet: DataFrame, openings: DataFrame, key: str = "Game_Number") -> DataFrame:
    """One row per game and side with its opening."""
    return _sides(sheet.join(openings, key), (key, "opening"))


def opening_repertoire(
    sides: DataFrame,
    player: str | None = None,
    min_games: int = 3,
    k: int = 3,
    review: int = 3,
    key: str = "Game_Number",
) -> DataFrame:
    """The k best and k worst openings of each player by win rate, then accuracy, and
    for the worst the `review` games to look at: lost ones first, least accurate first."""
    if player is not None:
        sides = for_player(sides, player, ("player",))
    per_opening = _agg(
        sides,
        ("player", "opening"),
        games="count(*)",
        win_rate="round(avg(won), 4)",
        avg_accuracy=sc.mean2_sql("accuracy"),
    )
    numbered = weak_games(sides, review, key).selectExpr("player", "opening", "_n", f"CAST({key} AS STRING) AS _g")
    return with_weak_games(best_and_worst(per_opening.where(f"games >= {int(min_games)}"), k), numbered)


def best_and_worst(per_opening: DataFrame, k: int) -> DataFrame:
    """The k best and the k worst openings of each player."""

    # Both lists come from one pass: each opening stands once in either direction.
    def direction(name: str, sign: str) -> str:
        return f"named_struct('side', '{name}', '_rate', {sign}win_rate, '_accuracy', {sign}avg_accuracy)"

    place = "OVER (PARTITION BY player, side ORDER BY _rate, _accuracy ASC NULLS LAST, opening)"
    return (
        per_opening.selectExpr("*", f"inline(array({direction('best', '-')}, {direction('worst', '')}))")
        .selectExpr("*", f"CAST(row_number() {place} AS BIGINT) AS rank")
        .where(f"rank <= {int(k)}")
    )


def weak_games(sides: DataFrame, review: int, key: str) -> DataFrame:
    """The `review` games of each player and opening to look at, numbered by `_n`."""
    worst_first = f"lost DESC, accuracy ASC NULLS LAST, {key}, colour DESC"
    return sides.selectExpr(
        "*", f"row_number() OVER (PARTITION BY player, opening ORDER BY {worst_first}) AS _n"
    ).where(f"_n <= {int(review)}")


def with_weak_games(listed: DataFrame, numbered: DataFrame) -> DataFrame:
    """Adds the games of the worst openings, as a list of their numbers (`_g`) in order."""
    weak = _agg(
        numbered,
        ("player", "opening"),
        review_games="array_join(transform(sort_array(collect_list(named_struct('n', _n, 'g', _g))), x -> x.g), ',')",
    ).selectExpr("*", "'worst' AS side")
    return listed.join(weak, ["player", "opening", "side"], "left").select(
        "player", "side", "rank", "opening", "games", "win_rate", "avg_accuracy", "review_games"
    )


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Hints a broadcast only after a look shows that `df` is small enough, in rows and in
    the bytes of its text columns."""
    texts = [f"coalesce(octet_length(`{n}`), 0)" for n, t in df.dtypes if t == "string"]
    look = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(F.expr(" + ".join(["0", *texts])))).first()
    small = look[0] <= max_rows and (look[1] or 0) <= max_bytes
    return (F.broadcast(df) if small else df), small


def name_openings(
    openings: DataFrame, names: DataFrame, salts: int = 64, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Adds the name of the longest known sequence that begins each opening.

    `names` has `moves` and `name`; a sequence listed several times goes by the least of
    its names, and one without a name is not known. When a look shows that the list fits
    a broadcast, each length of sequence that occurs in it is one broadcast join, and
    nothing is shuffled; the answer is the same either way.
    """
    known = names.where("moves IS NOT NULL AND name IS NOT NULL").groupBy("moves").agg(F.min("name").alias("name"))
    table, small = bounded_broadcast(
        land(known, "names").selectExpr("moves", "name", "size(split(moves, ' ')) AS _len"), broadcast_rows
    )
    if not small:
        return _name_openings_by_shuffle(openings, table, salts)
    lengths = sorted((r[0] for r in table.select("_len").distinct().collect()), reverse=True)
    out = openings.selectExpr("*", "split(opening, ' ') AS _plies")
    for n in lengths:
        known = F.broadcast(table.where(f"_len = {n}").selectExpr("moves AS _moves", f"name AS _name{n}"))
        out = out.join(known, F.expr(f"size(_plies) >= {n} AND array_join(slice(_plies, 1, {n}), ' ') = _moves"), "left")
        out = out.drop("_moves")
    found = ", ".join(f"_name{n}" for n in lengths) or "CAST(NULL AS STRING)"
    plies = " ".join(f"WHEN _name{n} IS NOT NULL THEN {n}L" for n in lengths) or "WHEN false THEN 0L"
    return out.selectExpr(*openings.columns, f"coalesce({found}) AS opening_name", f"CASE {plies} END AS named_plies")


def _name_openings_by_shuffle(openings: DataFrame, names: DataFrame, salts: int) -> DataFrame:
    """For a list of names of any size. Distinct openings are looked up, not games.

    A third of all openings may share their first move, and a third of all games their
    opening; so both joins are salted, with a copy of the unique side for each salt.
    """

    def copies(df: DataFrame) -> DataFrame:
        return df.selectExpr("*", f"explode(sequence(0, {int(salts) - 1})) AS _salt")

    prefixes = (
        openings.select("opening")
        .distinct()
        .selectExpr("opening", f"CAST(pmod(xxhash64(opening), {int(salts)}) AS INT) AS _salt", "split(opening, ' ') AS _plies")
        .selectExpr(
            "opening",
            "_salt",
            "explode(transform(_plies, (_, i) -> array_join(slice(_plies, 1, i + 1), ' '))) AS moves",
        )
    )
    longest = _agg(
        prefixes.join(copies(names), ["moves", "_salt"]),
        ("opening",),
        opening_name="max_by(name, _len)",
        named_plies="CAST(max(_len) AS BIGINT)",
    )
    row = ", ".join(openings.columns)
    spread = openings.selectExpr("*", f"CAST(pmod(xxhash64({row}), {int(salts)}) AS INT) AS _salt")
    return spread.join(copies(longest), ["opening", "_salt"], "left").select(
        *openings.columns, "opening_name", "named_plies"
    )


def games_to_review(
    scored: DataFrame,
    player: str | None = None,
    k: int = 5,
    keys: tuple[str, ...] = ("Game_Number",),
    link_prefix: str = "",
) -> DataFrame:
    """The k games of each player with the costliest single ply, and that ply."""
    per_game = _agg(
        _movers(scored, player).where("delta > 0"), ("player", *keys, "Game_Link"), x=f"max({COSTLIEST})"
    )
    per_game = costliest_plies(per_game, keys, link_prefix)
    if player is not None:
        return per_game.orderBy(F.col("loss").desc(), *keys).limit(k)
    place = f"row_number() OVER (PARTITION BY player ORDER BY loss DESC, {', '.join(keys)})"
    return per_game.selectExpr("*", f"{place} AS _n").where(f"_n <= {int(k)}").drop("_n")


#: The largest of these is a game's costliest ply, the first of equals.
COSTLIEST = f"named_struct('steps', {STEPS}, 'neg_ply', -Move_Number, 'move', Move, 'phase', game_phase)"


def costliest_plies(per_game: DataFrame, keys: tuple[str, ...], link_prefix: str = "") -> DataFrame:
    """Games with their costliest ply `x` spelled out."""
    percent = "CAST(CAST(round(x.steps / 20D) AS BIGINT) AS STRING)"
    return per_game.withColumn("link", F.concat(F.lit(link_prefix), "Game_Link")).selectExpr(
        "player",
        *keys,
        "link",
        "CAST(-x.neg_ply AS BIGINT) AS ply",
        "x.move AS move",
        "x.steps / 2000D AS loss",
        f"concat('lost ', {percent}, '% with ', x.move, ' in the ', x.phase) AS summary",
    )


def with_game_context(
    analysis: DataFrame, moves: DataFrame, game: str = "Game_Number", ply: str = "Move_Number"
) -> DataFrame:
    """Link, players and dates for analysed plies that came without them."""
    context = [
        c
        for c in ("Game_Link", "White", "Black", "Start_Date", "Start_Time", "End_Date", "End_Time", "Result")
        if c in moves.columns and c not in analysis.columns
    ]
    return analysis.join(moves.select(game, ply, *context), [game, ply], "left")
