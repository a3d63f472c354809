"""Game text to rows: headers, plies, and the texts that hold no game."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plyscope.functions import text as tx

# Where each column of the moves fact comes from.
COLUMN_TAGS = {
    "Game_Link": "Link",
    "White": "White",
    "Black": "Black",
    "Start_Date": "Date",
    "Start_Time": "StartTime",
    "End_Date": "EndDate",
    "End_Time": "EndTime",
    "Result": "Result",
}


def header_sql(tag: str) -> str:
    return f"try_element_at(headers, '{tag}')"


# Stable key of a game: the link, else a digest of the text.
GAME_KEY = f"coalesce({header_sql('Link')}, concat('md5:', md5(pgn)))"

# Names of required tags a game lacks, joined; empty when none is missing.
MISSING_HEADERS = "concat_ws(',', {})".format(
    ", ".join(f"CASE WHEN {header_sql(t)} IS NULL THEN '{t}' END" for t in tx.REQUIRED_TAGS)
)

# Why a game yields no plies; NULL for a game that does. A missing tag does not cost
# the game its plies: the column is NULL there, and `missing_headers` names it.
REASON = "CASE WHEN pgn IS NULL THEN 'no_text' WHEN ply_count <= 0 THEN 'no_moves' END"


def with_headers(games: DataFrame) -> DataFrame:
    """Adds the tag map of `pgn`. Each step is a column of its own, so that no text is
    searched twice."""
    own = games.columns
    return (
        games.selectExpr("*", f"{tx.tag_block_sql('pgn')} AS _block")
        .selectExpr(*own, f"{tx.tag_names_sql('_block')} AS _names", f"{tx.tag_values_sql('_block')} AS _values")
        .selectExpr(*own, f"{tx.headers_sql('_names', '_values')} AS headers")
    )


# Orders the copies of a game: the latest end, then the larger digest of the text. One
# number of fixed width, so that a maximum over it folds in a hash table.
LATEST = (
    "CAST(coalesce(end_time, -100000000000000000L) AS DECIMAL(38, 0)) * CAST('18446744073709551616' AS DECIMAL(20, 0))"
    " + CAST(digest AS DECIMAL(20, 0))"
)


def distinct_games(games: DataFrame, latest: str = "end_time") -> DataFrame:
    """One row per game key, as two players' archives hold the same game.

    The copy with the latest `end_time` stays; of several, that of the larger text digest.
    What is compared has fixed width and folds before the shuffle; the texts are then sent
    once, and only those of the copies that stay. Equal copies are left to the last step.
    """
    own = [f"`{c}`" for c in games.columns]
    keyed = with_headers(games).selectExpr(*own, f"{GAME_KEY} AS game_key", "xxhash64(pgn) AS digest", f"{latest} AS _end")
    order = LATEST.replace("end_time", "_end")
    stay = keyed.groupBy("game_key").agg(F.expr(f"max_by(digest, {order})").alias("digest"), F.expr(f"max({order})").alias("_order"))
    copies = keyed.withColumn("_order", F.expr(order)).join(stay, ["game_key", "digest", "_order"], "left_semi")
    return copies.select("game_key", *own).dropDuplicates(["game_key"])


def parse_games(games: DataFrame) -> DataFrame:
    """Adds `headers`, `tokens`, `ply_count` and `game_key` to rows with a `pgn`.

    One game in, one row out: no shuffle.
    """
    own = [c for c in games.columns if c != "game_key"]
    return (
        with_headers(games)
        .selectExpr(*own, "headers", f"{tx.movetext_sql('pgn')} AS _movetext")
        .selectExpr(*own, "headers", f"{tx.fold_parentheses_sql('_movetext')} AS _folded")
        .selectExpr(*own, "headers", f"{GAME_KEY} AS game_key", f"{tx.move_tokens_sql('_folded')} AS tokens")
        .withColumn("ply_count", ply_count())
    )


def ply_count(tokens: str = "tokens") -> Column:
    """Half-moves of a game, before it becomes one row per half-move."""
    return F.size(tokens)


def game_headers(parsed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per game with its tags as columns; a missing tag is NULL."""
    return parsed.selectExpr(
        "game_key", *keep, *[f"{header_sql(t)} AS {t}" for t in tx.HEADER_TAGS], "ply_count"
    )


def game_plies(parsed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per half-move, numbered from 1."""
    return parsed.selectExpr("game_key", *keep, "posexplode(tokens) AS (_pos, Move)").selectExpr(
        "game_key", *keep, "_pos + 1 AS Move_Number", "Move"
    )


def tag_games(parsed: DataFrame) -> DataFrame:
    """Adds `reason`, NULL for games with plies, and `missing_headers`. The text, no
    longer needed, stays only with games that have a reason."""
    own = [c for c in parsed.columns if c != "pgn"]
    return parsed.selectExpr(
        *own,
        f"{REASON} AS reason",
        f"{MISSING_HEADERS} AS missing_headers",
        f"CASE WHEN ({REASON}) IS NOT NULL THEN pgn END AS pgn",
    )


def split_quarantine(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(games with plies, games set aside with `reason`), disjoint and complete."""
    tagged = parsed if "reason" in parsed.columns else tag_games(parsed)
    return tagged.where("reason IS NULL").drop("reason", "pgn"), tagged.where("reason IS NOT NULL")


def build_moves(parsed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The moves fact without scores: every ply with its game's headers.

    `position` names the position after the ply, so that equal openings can be
    scored once. Headers ride along through the explode; there is no join.
    """
    return parsed.selectExpr(
        "game_key",
        *keep,
        *[f"{header_sql(tag)} AS {column}" for column, tag in COLUMN_TAGS.items()],
        f"posexplode({tx.plies_sql()}) AS (_pos, _ply)",
    ).selectExpr(
        "game_key",
        *keep,
        "Game_Link",
        "_pos + 1 AS Move_Number",
        "_ply.*",
        *[c for c in COLUMN_TAGS if c != "Game_Link"],
    )
