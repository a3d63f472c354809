"""Row counts of each stage, taken while the stage writes."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from plyscope.sources import tables as tb


def audited(df: DataFrame, stage: str, nulls: Iterable[str] = ()) -> tuple[DataFrame, Observation]:
    """`df` with counters attached: rows, and NULLs of the named columns.

    The counts come from the action that runs anyway; there is no extra pass.
    """
    seen, nulls = Observation(stage), list(nulls)
    counters = [F.count(F.lit(1)).alias("rows")]
    counters += [F.count(F.when(F.col(f"`{c}`").isNull(), 1)).alias(f"null_{c}") for c in nulls]
    seen.names = ["rows", *[f"null_{c}" for c in nulls]]
    return df.observe(seen, *counters), seen


def _values(seen: Observation) -> dict[str, int]:
    """The counters of a finished stage. A stage without rows may have been planned away,
    and its counters with it."""
    try:
        return seen.get
    except Py4JJavaError as e:
        if "AssertionError" not in str(e.java_exception):
            raise
        return dict.fromkeys(seen.names, 0)


def audit_table(spark: SparkSession, seen: Iterable[tuple[str, Observation]]) -> DataFrame:
    """One row per counter of each finished stage."""
    rows = [
        (stage, counter, int(value))
        for stage, observation in seen
        for counter, value in _values(observation).items()
    ]
    return spark.createDataFrame(rows, "stage string, counter string, value bigint")


class BatchCounters(StreamingQueryListener):
    """Counts the rows of a stream by micro-batch and writes them to a folder, once per batch.

    `counted` puts the counters into the stream, `watch` names the query that runs it. The
    counts come with the progress of each batch, after it; a batch that is repeated counts
    the same.
    """

    def __init__(self, spark: SparkSession, folder: str, stage: str):
        self.spark, self.folder, self.stage = spark, folder, stage
        self.name = f"{stage}-{uuid.uuid4().hex}"  # no other stream's counters are taken for these
        self.run: str | None = None
        self.ended: set[str] = set()
        self.done = threading.Event()
        self.failed: Exception | None = None
        spark.streams.addListener(self)

    def counted(self, stream: DataFrame, nulls: Iterable[str] = ()) -> DataFrame:
        counters = [F.count(F.lit(1)).alias("rows")]
        return stream.observe(self.name, *counters, *[F.count(F.when(F.col(f"`{c}`").isNull(), 1)).alias(f"null_{c}") for c in nulls])

    def watch(self, query) -> None:
        self.run = str(query.runId)
        _WATCHED.setdefault(self.folder, []).append(self)
        if self.run in self.ended:
            self.done.set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(self.name)
        if seen is None:
            return
        counters = [{"stage": self.stage, "counter": k, "value": v} for k, v in seen.asDict().items()]
        name = f"{event.progress.id}-{event.progress.batchId:012d}"
        try:
            tb.put_mark(self.spark, self.folder, name, {"stream": str(event.progress.id), "batch": event.progress.batchId, "counters": counters})
        except FileExistsError:
            pass  # the batch ran before
        except Exception as e:  # a listener must not raise; whoever reads the counts is told
            self.failed = e

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))
        if str(event.runId) == self.run:
            self.done.set()


#: Counters of queries that may have counts to come, by folder.
_WATCHED: dict[str, list[BatchCounters]] = {}


def stream_audit(spark: SparkSession, folder: str) -> DataFrame:
    """One row per counter and micro-batch of all streams that wrote to the folder. Counts of
    queries of this session that have ended are waited for; they come a moment after."""
    for counters in list(_WATCHED.get(folder, ())):
        if any(str(q.runId) == counters.run for q in spark.streams.active):
            continue
        told = counters.done.wait(60)
        spark.streams.removeListener(counters)
        _WATCHED[folder].remove(counters)
        if counters.failed or not told:
            raise RuntimeError(f"counters of a stream were not written to {folder}") from counters.failed
    kind = "stream string, batch long, counters array<struct<stage:string,counter:string,value:long>>"
    if not tb.exists(spark, f"{folder}/*"):
        return spark.createDataFrame([], kind).selectExpr("stream", "batch", "inline(counters)")
    return spark.read.schema(kind).json(folder).selectExpr("stream", "batch", "inline(counters)")
