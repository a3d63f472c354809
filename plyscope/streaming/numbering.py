"""Numbers for the games of an arriving history, kept as ranges and counts.

The games that count are kept in the order of (end_time, game_key), cut into ranges of bounded
size. A range's rows lie together and know their place in it; a small list says where each
range starts, how many games it holds and which run wrote it. A game's number is the total of
the ranges before its own, plus its place. New, late and withdrawn games touch only their own
ranges: these are read, put in order and written anew, and all later numbers move by the list.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plyscope.session import land
from plyscope.sources import tables as tb
from plyscope.streaming.changes import changes

#: Games that a range is meant to hold when it is written.
RANGE_GAMES = 200_000
#: Sorts as the end does, with a missing end last, then as the key does; one string per game.
PLACE = "concat(CASE WHEN end_time IS NULL THEN '~' ELSE lpad(hex(end_time ^ CAST('-9223372036854775808' AS BIGINT)), 16, '0') END, game_key)"
PLACED = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("place", "game_key")]
    + [T.StructField(n, T.LongType()) for n in ("end_time", "at", "range")]
    + [T.StructField("run", T.StringType())]
)


class Ranges:
    """The list of ranges after a run: (range, first place, games, run), in order."""

    def __init__(self, rows: list[tuple[int, str, int, str]] = (), seen: list[str] = (), run: int = -1, last: int = -1):
        self.rows, self.seen, self.run, self.last = [tuple(r) for r in rows], list(seen), run, last

    def range_of(self, place: str) -> str:
        """The range a place falls into, as an expression. Ranges are looked up in two steps, so
        a row costs about twice the square root of their number."""
        lows = [low for _, low, _, _ in self.rows]
        wide = max(1, round(len(lows) ** 0.5))
        blocks = [lows[i : i + wide] for i in range(0, len(lows), wide)]
        text = lambda x: "'" + json.dumps(x).replace("\\", "\\\\").replace("'", "\\'") + "'"
        block = f"size(filter(from_json({text([b[0] for b in blocks])}, 'array<string>'), x -> x <= {place})) - 1"
        within = f"size(filter(element_at(from_json({text(blocks)}, 'array<array<string>>'), b + 1), x -> x <= {place})) - 1"
        ids = f"from_json('{json.dumps([r[0] for r in self.rows])}', 'array<bigint>')"
        return f"element_at({ids}, 1 + element_at(transform(array({block}), b -> b * {wide} + {within}), 1))"

    def holding(self, ranges: set[int] | None = None) -> str:
        """A condition on run and range that holds for the rows in force, for partition pruning."""
        by_run: dict[str, list[int]] = {}
        for r, _, _, run in self.rows:
            if ranges is None or r in ranges:
                by_run.setdefault(run, []).append(r)
        return " OR ".join(f"(run = '{run}' AND range IN ({', '.join(map(str, of))}))" for run, of in by_run.items()) or "false"


def _marks(target: str) -> str:
    return f"{target}/numbers/_ranges"


def ranges_in_force(spark: SparkSession, target: str) -> Ranges:
    """The list that the last whole run left."""
    fs, folder = tb.filesystem(spark, _marks(target))
    runs = [int(n) for n in tb._files(spark, _marks(target)) if n.isdigit()] if fs.exists(folder) else []
    if not runs:
        return Ranges()
    said = tb.get_mark(spark, f"{_marks(target)}/{max(runs):012d}")
    return Ranges(said["rows"], said["seen"], max(runs), said["last"])


def update_numbers(spark: SparkSession, target: str, range_games: int = RANGE_GAMES) -> Ranges:
    """Takes in what has changed since the last call, and says how the ranges stand then.

    Only ranges that a game enters or leaves are read and sorted. Rows are written first, under
    a run of their own, and the list last, in one step; a run that failed leaves the list as it
    was and is repeated. The driver holds the list: one entry for about `range_games` games.
    """
    state = ranges_in_force(spark, target)
    change = changes(spark, target, state.seen)
    if change.batches == state.seen:
        return state
    if change.afresh:
        state = Ranges(run=state.run, last=state.last)
    run = f"{state.run + 1:012d}"
    delta = change.rows.selectExpr("game_key", "end_time", "sign", f"{PLACE} AS place")
    # A copy that only its text tells apart keeps its place.
    delta = delta.groupBy("place").agg(F.first("game_key").alias("game_key"), F.first("end_time").alias("end_time"), F.sum("sign").alias("sign"))
    delta = delta.where("sign <> 0").selectExpr("*", f"{state.range_of('place') if state.rows else '0L'} AS range")
    delta = land(delta, "number-changes")
    touched = {r.range for r in delta.select("range").distinct().collect()}
    written = _written(spark, target).where(state.holding(touched)).select("place", "game_key", "end_time", "range")
    gone, come = delta.where("sign < 0").select("place"), delta.where("sign > 0").select("place", "game_key", "end_time", "range")
    rows = land(written.join(gone, "place", "left_anti").unionByName(come), "renumbered")
    n = rows.count()
    parts = max(1, -(-n // range_games))
    ordered = rows.repartitionByRange(parts, "place").sortWithinPartitions("place")
    ordered = land(ordered.withColumn("slot", F.monotonically_increasing_id()), "renumbered")
    # One row for each touched range, and one more for each cut.
    groups = ordered.groupBy("range", F.expr("shiftright(slot, 33)").alias("part")).agg(
        F.count("*").alias("n"), F.min("place").alias("low"), F.min("slot").alias("first")
    )
    groups = sorted(groups.collect(), key=lambda g: g.low)
    kept = {r: low for r, low, _, _ in state.rows}
    after, moves, last, met = [r for r in state.rows if r[0] not in touched], [], state.last, set()
    for g in groups:
        if g.range in met or g.range not in kept:
            last += 1
            name, low = last, g.low
        else:
            name, low = g.range, kept[g.range]
        met.add(g.range)
        after.append((name, low, g.n, run))
        moves.append((g.range, g.part, name, g.first))
    after.sort(key=lambda r: r[1])
    if after:
        after[0] = (after[0][0], "", *after[0][2:])  # whatever sorts first falls into the first range
    names = spark.createDataFrame(moves, "range long, part long, name long, first long")
    out = ordered.withColumn("part", F.expr("shiftright(slot, 33)")).join(F.broadcast(names), ["range", "part"])
    out = out.selectExpr("place", "game_key", "end_time", "slot - first + 1 AS at", "name AS range")
    out.write.mode("overwrite").partitionBy("range").parquet(f"{target}/numbers/run={run}")
    state = Ranges(after, change.batches, int(run), last)
    tb.put_mark(spark, _marks(target), run, {"rows": after, "seen": change.batches, "last": last})
    _drop_old_runs(spark, target, {r[3] for r in after} | {run})
    return state


def _drop_old_runs(spark: SparkSession, target: str, needed: set[str]) -> None:
    """Runs whose ranges have all been written anew since."""
    fs, folder = tb.filesystem(spark, f"{target}/numbers")
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("run=") and name.removeprefix("run=") not in needed:
            fs.delete(status.getPath(), True)


def _written(spark: SparkSession, target: str) -> DataFrame:
    path = f"{target}/numbers"
    if not tb.exists(spark, f"{path}/run=*"):
        return spark.createDataFrame([], PLACED)
    return spark.read.schema(PLACED).parquet(path)


def game_numbers(spark: SparkSession, target: str, state: Ranges | None = None) -> DataFrame:
    """game_key, Game_Number of every game that counts: 1..n by (end_time, game_key), as the
    batch job numbers them. The rows in force are read; nothing is sorted or shuffled."""
    state = state or ranges_in_force(spark, target)
    before, offsets = 0, []
    for name, _, n, _ in state.rows:
        offsets.append((name, before))
        before += n
    offsets = F.broadcast(spark.createDataFrame(offsets, "range long, before long"))  # as short as the list
    rows = _written(spark, target).where(state.holding())
    return rows.join(offsets, "range").selectExpr("game_key", "before + at AS Game_Number")
