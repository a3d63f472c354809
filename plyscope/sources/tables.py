"""Parquet and NDJSON tables, and dated snapshots of them."""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plyscope.schemas import MOVES

SNAPSHOT = "snapshot_date"
#: Holds a folder per date with its markers; the underscore keeps it out of partition discovery.
COMMITS = "_commits"
NO_SUCCESS_FILE = "mapreduce.fileoutputcommitter.marksuccessfuljobs"


def read_moves(spark: SparkSession, path: str, schema: T.StructType = MOVES, view: str | None = None) -> DataFrame:
    """Moves table with its declared schema; also as a named view if asked."""
    df = spark.read.schema(schema).parquet(path)
    if view:
        df.createOrReplaceTempView(view)
    return df


def read_ndjson(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """NDJSON. With no schema Spark infers one, which costs a full extra pass."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(path)


def write_ndjson(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def snapshot_dir(root: str, snapshot_date: dt.date | str) -> str:
    return f"{root.rstrip('/')}/{SNAPSHOT}={snapshot_date}"


def write_snapshot(df: DataFrame, root: str, snapshot_date: dt.date | str, sort_by: tuple[str, ...] = (), **options: str) -> str:
    """Write one dated snapshot and return its folder; `options` are those of the writer.

    A second run for the same date replaces that date and no other, also when it has
    no rows. The new files are written beside those of the last commit; then a marker
    that names them is put in place in one step, and only then do the others go. So at any
    moment readers see the last committed state of each date, and a run that fails, at
    whatever point, changes nothing. A date has one writer at a time: of two, the later
    marker is refused.
    """
    spark, folder = df.sparkSession, snapshot_dir(root, snapshot_date)
    dated = df.drop(SNAPSHOT)
    if sort_by:
        dated = dated.sortWithinPartitions(*sort_by)
    commit = (max(_commits(spark, root, snapshot_date), default=-1)) + 1
    before = _files(spark, folder)
    dated.write.mode("append").options(**options).option(NO_SUCCESS_FILE, "false").parquet(folder)
    files = {name: size for name, size in _files(spark, folder).items() if name not in before}
    put_mark(spark, f"{root.rstrip('/')}/{COMMITS}/{snapshot_date}", f"{commit:012d}", {"files": files, "schema": dated.schema.jsonValue()})
    _clear(spark, root, snapshot_date, commit, before)
    return folder


def _commits(spark: SparkSession, root: str, snapshot_date: dt.date | str) -> list[int]:
    names = _files(spark, f"{root.rstrip('/')}/{COMMITS}/{snapshot_date}")
    return [int(n) for n in names if n.isdigit()]


def _files(spark: SparkSession, folder: str) -> dict[str, int]:
    """Name and length of the files of a folder; none if it is not there."""
    fs, location = filesystem(spark, folder)
    if not fs.exists(location):
        return {}
    found = [s for s in fs.listStatus(location) if s.isFile()]
    return {s.getPath().getName(): s.getLen() for s in found if not s.getPath().getName().startswith(("_", "."))}


def put_mark(spark: SparkSession, folder: str, name: str, content: dict) -> None:
    """A small file that appears whole or not at all, and never replaces another."""
    fs, aside = filesystem(spark, f"{folder}/_{uuid.uuid4().hex}")
    fs.mkdirs(aside.getParent())
    out = fs.create(aside, False)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    _, place = filesystem(spark, f"{folder}/{name}")
    if fs.exists(place) or not fs.rename(aside, place):
        fs.delete(aside, False)
        raise FileExistsError(f"another writer has committed {folder}/{name}")


def get_mark(spark: SparkSession, path: str) -> dict:
    fs, place = filesystem(spark, path)
    stream = fs.open(place)
    content = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return json.loads(content)


def _clear(spark: SparkSession, root: str, snapshot_date: dt.date | str, commit: int, names) -> None:
    """Drop what the commit has replaced: `names` in the date's folder, and older markers."""
    folder = snapshot_dir(root, snapshot_date)
    older = [f"{root.rstrip('/')}/{COMMITS}/{snapshot_date}/{c:012d}" for c in _commits(spark, root, snapshot_date) if c < commit]
    for path in [*[f"{folder}/{n}" for n in names], *older]:
        fs, location = filesystem(spark, path)
        fs.delete(location, False)


def _committed(spark: SparkSession, root: str, snapshot_date: dt.date | str) -> tuple[list[str], T.StructType | None] | None:
    """The files of the date's newest whole commit, and their schema; None if there is none.

    A commit counts if every file that it names is there at its length. A folder that other
    tools wrote has no marker; it counts if Spark's own sign of a finished job is in it.
    """
    folder, there = snapshot_dir(root, snapshot_date), _files(spark, snapshot_dir(root, snapshot_date))
    for commit in sorted(_commits(spark, root, snapshot_date), reverse=True):
        said = get_mark(spark, f"{root.rstrip('/')}/{COMMITS}/{snapshot_date}/{commit:012d}")
        if all(there.get(name) == size for name, size in said["files"].items()):
            return [f"{folder}/{name}" for name in sorted(said["files"])], T.StructType.fromJson(said["schema"])
    if exists(spark, f"{folder}/_SUCCESS"):
        return [folder], None
    return None


def _read(spark: SparkSession, found: tuple[list[str], T.StructType | None], schema: T.StructType | None) -> DataFrame:
    files, own = found
    if not files:
        return spark.createDataFrame([], schema or own)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*files)


def read_snapshot(spark: SparkSession, root: str, snapshot_date: dt.date | str, schema: T.StructType | None = None) -> DataFrame:
    """The last committed snapshot of one date, whatever other dates there are; without the
    date column. Raises if there is none."""
    found = _committed(spark, root, snapshot_date)
    if found is None:
        raise FileNotFoundError(f"no committed snapshot of {snapshot_date} under {root}")
    return _read(spark, found, schema)


def write_bucketed(df: DataFrame, table: str, buckets: int, key: str = "game_key", ply: str = "Move_Number") -> None:
    """Catalog table bucketed by game, so scoring it needs no shuffle of its own."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key, ply).format("parquet").saveAsTable(table)


def filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    fs, location = filesystem(spark, path)
    return bool(fs.globStatus(location))


def snapshot_dates(spark: SparkSession, root: str) -> list[str]:
    """Dates with a committed snapshot, from listings and markers alone: no data is read."""
    return [d for d in _dates(spark, root) if _committed(spark, root, d) is not None]


def _dates(spark: SparkSession, root: str) -> list[str]:
    fs, location = filesystem(spark, root)
    if not fs.exists(location):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(location) if s.isDirectory()]
    prefix = SNAPSHOT + "="
    return sorted(n[len(prefix):] for n in names if n.startswith(prefix))


def latest_snapshot(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """The newest date that was committed, as its last commit left it; only its files are
    read. A newer date that is half written does not count. Raises if there is none."""
    for date in reversed(_dates(spark, root)):
        found = _committed(spark, root, date)
        if found is not None:
            return _read(spark, found, schema).withColumn(SNAPSHOT, F.lit(date).cast("date"))
    raise FileNotFoundError(f"no committed snapshot under {root}")


def drop_staging(spark: SparkSession, root: str, snapshot_date: dt.date | str) -> bool:
    """Remove one staged snapshot, its markers first; False if it was not there."""
    fs, marks = filesystem(spark, f"{root.rstrip('/')}/{COMMITS}/{snapshot_date}")
    fs.delete(marks, True)
    fs, location = filesystem(spark, snapshot_dir(root, snapshot_date))
    return bool(fs.delete(location, True))
