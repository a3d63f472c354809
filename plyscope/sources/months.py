"""The archive as a data source of its own: a month of a player is what is planned and read.

`spark.read.format("game_archive")` gives a row per document, and a row that says so for each
month that is absent or could not be read; so a month that fails is data, and the run goes on.
As a stream, the documents found by a look at the landing are written down as a plan before
any is read; an offset is the number of the last plan, and a batch can be planned again from
it after a restart. Only bytes are moved here: documents are parsed by Spark.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, In, InputPartition

from plyscope.schemas import GAME

#: What the source yields; `status` is found, absent or failed.
SCHEMA = "player string, month string, status string, reason string, file string, document string"
DAYS_BACK, PARTITIONS = 760, 10_000
_PLACED = re.compile(r"/player=([^/]*)/month=([^/]*)/")
_ESCAPED = re.compile(r"""[\x00-\x1f"#%'*/:=?\\{\[\]^\x7f]""")


@dataclass
class Documents(InputPartition):
    """Months (player, month) to look for, or files (player, month, path) that were found."""

    items: list[tuple[str, ...]]


def _store(path: str):
    """The file system of a path, and the path in it; any that pyarrow knows."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", path))


def _folder(path: str, player: str, month: str) -> str:
    """Where a month lies; names are escaped as Spark's writers do it."""
    name = _ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", player)
    return f"{path.rstrip('/')}/player={name}/month={month}"


def _visible(info) -> bool:
    return info.is_file and not info.base_name.startswith(("_", "."))


def _found(store, folder: str) -> list[str]:
    from pyarrow import fs

    return sorted(i.path for i in store.get_file_info(fs.FileSelector(folder, allow_not_found=True)) if _visible(i))


def _documents(store, player: str, month: str, files: list[str]) -> Iterator[tuple]:
    """A row per file, one with the reason if it cannot be read."""
    for file in files:
        try:
            with store.open_input_stream(file) as f:
                yield player, month, "found", None, file, f.read().decode("utf-8", "replace")
        except Exception as e:  # whatever goes wrong with one document is that document's status
            yield player, month, "failed", f"{type(e).__name__}: {e}"[:500], file, None


def _chunks(items: list, most: int) -> list[Documents]:
    """One partition per item, or, with more items than partitions wanted, per few."""
    each = max(1, -(-len(items) // most))
    return [Documents(items[i : i + each]) for i in range(0, len(items), each)] or [Documents([])]


def months_back(as_of: dt.date, days_back: int) -> list[str]:
    """The months of the look-back, both ends included, as `month_keys` has them."""
    first = as_of - dt.timedelta(days=days_back)
    return [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in range(first.year * 12 + first.month - 1, as_of.year * 12 + as_of.month)]


class ArchiveSource(DataSource):
    """Options: path; players (a JSON list), as_of and days_back for a batch; plans (a folder
    that outlives the stream) for a stream; partitions, at most; filters, true if the session
    offers filters to Python sources."""

    @classmethod
    def name(cls) -> str:
        return "game_archive"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return (NamedMonths if self.options.get("filters") == "true" else ArchiveMonths)(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return ArchiveArrivals(dict(self.options))


class ArchiveMonths(DataSourceReader):
    """Every player's expected months."""

    def __init__(self, options: dict[str, str]):
        self.path, self.most = options["path"], int(options.get("partitions", PARTITIONS))
        self.players = json.loads(options["players"])
        as_of = dt.date.fromisoformat(options["as_of"])
        self.months = months_back(as_of, int(options.get("days_back", DAYS_BACK)))

    def partitions(self) -> list[Documents]:
        return _chunks([(p, m) for p in self.players for m in self.months], self.most)

    def read(self, partition: Documents) -> Iterator[tuple]:
        store, root = _store(self.path)
        for player, month in partition.items:
            try:
                files = _found(store, _folder(root, player, month))
            except Exception as e:
                yield player, month, "failed", f"{type(e).__name__}: {e}"[:500], None, None
                continue
            if not files:
                yield player, month, "absent", None, None, None
            yield from _documents(store, player, month, files)


class NamedMonths(ArchiveMonths):
    """The same where Spark offers filters: only players and months asked for by name are planned."""

    def pushFilters(self, filters: list) -> Iterator:
        for f in filters:
            named = (f.value,) if isinstance(f, EqualTo) else f.value if isinstance(f, In) else None
            if named is not None and f.attribute == ("player",):
                self.players = [p for p in self.players if p in named]
            elif named is not None and f.attribute == ("month",):
                self.months = [m for m in self.months if m in named]
            else:
                yield f


class ArchiveArrivals(DataSourceStreamReader):
    """Documents that are new, or changed, since the last look, however old they are.

    A file is known by path, modification time and length. What a look finds is written as the
    next plan; the driver holds the list of files, as Spark's own file stream does.
    """

    def __init__(self, options: dict[str, str]):
        self.path, self.plans, self.most = options["path"], options["plans"], int(options.get("partitions", PARTITIONS))

    def initialOffset(self) -> dict:
        return {"plan": 0}

    def _plan(self, number: int) -> list[list]:
        store, root = _store(self.plans)
        with store.open_input_stream(f"{root}/{number:012d}.json") as f:
            return json.loads(f.read())

    def _last(self) -> int:
        from pyarrow import fs

        store, root = _store(self.plans)
        names = [i.base_name for i in store.get_file_info(fs.FileSelector(root, allow_not_found=True))]
        return max((int(n[:-5]) for n in names if re.fullmatch(r"\d{12}\.json", n)), default=0)

    def latestOffset(self) -> dict:
        from pyarrow import fs

        last = self._last()
        known = {tuple(x) for n in range(1, last + 1) for x in self._plan(n)}
        store, root = _store(self.path)
        infos = store.get_file_info(fs.FileSelector(root, allow_not_found=True, recursive=True))
        there = [(i.path, i.mtime_ns, i.size) for i in infos if _visible(i) and _PLACED.search(i.path)]
        new = sorted(x for x in there if x not in known)
        if not new:
            return {"plan": last}
        store, root = _store(self.plans)
        store.create_dir(root)
        aside, place = f"{root}/_{uuid.uuid4().hex}", f"{root}/{last + 1:012d}.json"
        with store.open_output_stream(aside) as f:
            f.write(json.dumps(new).encode())
        store.move(aside, place)
        return {"plan": last + 1}

    def partitions(self, start: dict, end: dict) -> list[Documents]:
        newest = {x[0]: x for n in range(start["plan"] + 1, end["plan"] + 1) for x in self._plan(n)}
        items = []
        for path in sorted(newest):
            player, month = _PLACED.search(path).groups()
            items.append((re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), player), month, path))
        return _chunks(items, self.most)

    def read(self, partition: Documents) -> Iterator[tuple]:
        store, _ = _store(self.path)
        for player, month, path in partition.items:
            yield from _documents(store, player, month, [path])

    def commit(self, end: dict) -> None:
        """Plans stay: a look needs them to tell what is new."""


def parsed_months(rows: DataFrame) -> DataFrame:
    """Documents parsed, with the columns of `read_archive` and their status: a document that is
    not JSON is `corrupt`, and its text is kept."""
    document = "from_json(document, 'games {}, _corrupt_record string', map('mode', 'PERMISSIVE', 'columnNameOfCorruptRecord', '_corrupt_record'))"
    rows = rows.withColumn("_d", F.expr(document.format(f"array<{GAME.simpleString()}>")))
    return rows.selectExpr(
        "_d.games AS games", "_d._corrupt_record AS _corrupt_record", "player", "month",
        "CASE WHEN _d._corrupt_record IS NOT NULL THEN 'corrupt' ELSE status END AS status", "reason", "file AS _path",
    )


def read_months(
    spark: SparkSession, path: str, players: DataFrame | list[str], as_of: dt.date | str, days_back: int = DAYS_BACK, partitions: int = PARTITIONS
) -> DataFrame:
    """One row for each document of the players' months, or one that says why there is none.

    `players` are the players that are followed; their names go to the driver. The columns of
    `read_archive`, so what reads that reads this, with `status` (found, corrupt, absent or
    failed), `reason` and the document's `_path`.
    """
    if not isinstance(players, list):
        players = sorted(r[0] for r in players.distinct().collect())
    spark.dataSource.register(ArchiveSource)
    options = {"path": path, "players": json.dumps(players), "as_of": str(as_of), "days_back": days_back, "partitions": partitions}
    options["filters"] = str(spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")).lower()
    return parsed_months(spark.read.format("game_archive").options(**options).load())


def stream_months(spark: SparkSession, path: str, plans: str, partitions: int = PARTITIONS) -> DataFrame:
    """The documents of a landing as they arrive or change, as `read_months` gives them."""
    spark.dataSource.register(ArchiveSource)
    options = {"path": path, "plans": plans, "partitions": partitions}
    return parsed_months(spark.readStream.format("game_archive").options(**options).load())


def month_outcomes(months: DataFrame) -> DataFrame:
    """player, month, status and reason of every month, one row each: `found` if any of its
    documents could be read, else what was wrong with the first."""
    seen = months.selectExpr(
        "player", "month", "named_struct('place', CASE status WHEN 'found' THEN 0 WHEN 'corrupt' THEN 1 WHEN 'failed' THEN 2 ELSE 3 END, 'status', status, 'reason', reason) AS s"
    )
    return seen.groupBy("player", "month").agg(F.min("s").alias("s")).selectExpr("player", "month", "s.status", "s.reason")
