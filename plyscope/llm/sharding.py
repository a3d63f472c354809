"""Histogram sort: shards of near-equal bytes, cut in one global order.

The order is (hash of the text, doc_id, row number of a written copy), so equal texts lie
side by side and a cut can fall inside a group of copies of any size. Splitters are found
by counting: each round counts the exact bytes below all probes in one pass over narrow
columns, then narrows each splitter's interval, until its byte count is within the tolerance
or no row is left between its ends. Rows are exchanged once, by cell; a shard is a run of cells.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plyscope.llm.common import set_aside, table
from plyscope.session import land

KEY = ("_h", "_d", "_r")
WIDTH = 24


@dataclass
class Cut:
    """A splitter: rows below `key` go left; `bytes` and `rows` count them."""

    target: float
    slack: float
    low: int
    high: int
    low_at: tuple[int, int]
    high_at: tuple[int, int]
    key: int | None = None
    at: tuple[int, int] = (0, 0)

    def settle(self, key: int, at: tuple[int, int]) -> None:
        self.key, self.at = key, at


def key_bytes(h: np.ndarray, d: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Fixed-width byte strings that sort as the signed triples do."""
    cols = np.stack([h, d, r], axis=1).astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return np.ascontiguousarray(cols.astype(">u8")).view(f"S{WIDTH}").ravel()


def _arrays(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [batch[k].to_numpy(zero_copy_only=False) for k in KEY]


def _as_keys(keys: list[int]) -> np.ndarray:
    return np.array([k.to_bytes(WIDTH, "big") for k in keys], dtype=f"S{WIDTH}")


def _histogram(rows: DataFrame, probes: list[int]) -> list[tuple]:
    """(gap, bytes, rows, smallest key, largest key) of each gap between probes that has rows."""
    marks = _as_keys(probes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = key_bytes(*_arrays(batch))
            order = np.argsort(keys, kind="stable")
            keys, size = keys[order], batch["_size"].to_numpy(zero_copy_only=False)[order]
            gap = np.searchsorted(marks, keys, side="right")
            starts = np.flatnonzero(np.r_[True, gap[1:] != gap[:-1]])
            ends = np.r_[starts[1:], len(gap)] - 1
            yield pa.RecordBatch.from_pydict(
                {
                    "gap": gap[starts].astype(np.int64),
                    "bytes": np.add.reduceat(size, starts),
                    "n": ends - starts + 1,
                    "least": [k.ljust(WIDTH, b"\0") for k in keys[starts].tolist()],
                    "most": [k.ljust(WIDTH, b"\0") for k in keys[ends].tolist()],
                }
            )

    parts = rows.select(*KEY, "_size").mapInArrow(count, "gap long, bytes long, n long, least binary, most binary")
    found = parts.groupBy("gap").agg(F.sum("bytes"), F.sum("n"), F.min("least"), F.max("most"))
    return sorted((g, s, n, int.from_bytes(a, "big"), int.from_bytes(b, "big")) for g, s, n, a, b in found.collect())


def find_cuts(rows: DataFrame, n_shards: int, cells_per_shard: int, tolerance: float, probes: int) -> list[Cut]:
    """The cuts between cells. What reaches the driver is one row per gap between probes."""
    whole = _histogram(rows, [])
    if not whole:
        return []
    _, total, n, least, most = whole[0]
    n_cells, shard = n_shards * cells_per_shard, total / n_shards
    cuts = [
        Cut(total * j / n_cells, (tolerance if j % cells_per_shard == 0 else 0.1 / cells_per_shard) * shard,
            least, most + 1, (0, 0), (total, n))
        for j in range(1, n_cells)
    ]
    while open_cuts := [c for c in cuts if c.key is None]:
        marks = set()
        for c in open_cuts:
            step = (c.high - c.low) / (probes + 1)
            marks |= {c.low + round(step * i) for i in range(1, probes + 1)} | {c.low, c.high}
        marks = sorted(marks)
        gaps = {g[0]: g[1:] for g in _histogram(rows, marks)}
        below, run = [], (0, 0)  # below[i]: bytes and rows below marks[i]
        for i in range(len(marks)):
            size, n, *_ = gaps.get(i, (0, 0))
            run = (run[0] + size, run[1] + n)
            below.append(run)
        sums = np.array([b[0] for b in below], dtype=np.float64)
        for c in open_cuts:
            near = int(np.argmin(np.abs(sums - c.target)))
            if abs(sums[near] - c.target) <= c.slack:
                c.settle(marks[near], below[near])
                continue
            i = max(int(np.searchsorted(sums, c.target, side="right")) - 1, 0)
            j = min(i + 1, len(marks) - 1)
            # rows lie in the gap (marks[i], marks[j]): shrink it to the keys that are there
            _, k, first, last = gaps.get(i + 1, (0, 0, marks[i], marks[j] - 1))
            c.low, c.low_at, c.high, c.high_at = first, below[i], last + 1, below[j]
            if k <= 1 or first == last:
                ends = ((c.low, c.low_at), (c.high, c.high_at))
                c.settle(*min(ends, key=lambda e: abs(e[1][0] - c.target)))
    cuts.sort(key=lambda c: c.key)
    return cuts


def shard(
    rows: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    n_shards: int = 8,
    tolerance: float = 0.0005,
    cell_bytes: int = 16 << 20,
    max_cells: int = 8192,
    probes: int = 7,
    keep: list[str] | None = None,
) -> DataFrame:
    """All rows with `size`, `text_crc32`, `shard` and `slot` added (columns of those names are replaced).

    Size is the UTF-8 bytes of the text plus 1, so that a null or empty text has size 1 and
    every row counts. Shard sizes differ from their mean by `tolerance` of it, or by one row
    where a row is larger than that. Slots run from 0 without gaps in each shard, in the global
    order; null ids come first; repeated rows are all kept. `cell_bytes` only sets how many
    tasks share a shard's exchange; `max_cells` bounds what the driver holds; `keep` names the
    columns to carry along (all). An empty table gives an empty result.
    """
    own = ("size", "text_crc32", "shard", "slot")
    rows, again = set_aside(rows, ["_size", "_cell", *KEY])
    text, doc_id = ({c: new for new, c in again.items()}.get(x, x) for x in (text, doc_id))
    body = F.coalesce(F.col(text), F.lit(""))
    carried = [c for c in rows.columns if c.lower() not in own and (keep is None or again.get(c, c) in keep)]
    rows = rows.withColumns(
        {
            "size": F.octet_length(body).cast("long") + 1,
            "text_crc32": F.crc32(body),
            "_size": F.octet_length(body).cast("long") + 1,
            "_h": F.xxhash64(body),
            "_d": F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63))),
            "_r": F.monotonically_increasing_id(),
        }
    )
    rows = land(rows.select(*[F.col(f"`{c}`") for c in carried], "size", "text_crc32", "_size", *KEY), "to-shard")
    total = rows.agg(F.sum("_size")).first()[0] or 0
    per_shard = max(1, min(-(-total // (n_shards * cell_bytes)), max_cells // n_shards))
    cuts = find_cuts(rows, n_shards, per_shard, tolerance, probes)
    marks = _as_keys([c.key for c in cuts])
    n_below = [0] + [c.at[1] for c in cuts]
    head = [n_below[c - c % per_shard] for c in range(len(n_below))]

    @F.pandas_udf("int")
    def cell_of(h, d, r):
        import pandas as pd

        return pd.Series(np.searchsorted(marks, key_bytes(h.to_numpy(), d.to_numpy(), r.to_numpy()), side="right").astype(np.int32))

    start = F.element_at(F.array(*[F.lit(n_below[c] - head[c]).cast("long") for c in range(len(n_below))]), F.col("_cell") + 1)
    place = Window.partitionBy("_cell").orderBy(*KEY)
    out = rows.withColumn("_cell", cell_of(*KEY) if cuts else F.lit(0))
    out = out.withColumn("slot", start + F.row_number().over(place) - 1)
    out = out.withColumn("shard", F.floor(F.col("_cell") / per_shard).cast("int"))
    return out.drop(*KEY, "_size", "_cell").withColumnsRenamed(again)


def op3_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
