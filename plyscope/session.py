"""Session helpers: sensible settings, and the shared folder for written tables."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

_LANDED: dict[str, list[str]] = {}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on, UTC, and the web page off.

    On a cluster leave `master` unset and let spark-submit name it. The number of
    shuffle partitions is left to the caller: adaptive execution merges small
    ones, so on a cluster it should be set high rather than low.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.python.filterPushdown.enabled": "true",
        # Call sites of column expressions cost several calls to the JVM for each.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder under the one that all executors share.

    The cluster names it in `spark.checkpoint.dir`; where that is unset it is the
    warehouse folder, which a cluster shares as well. Never a temporary folder of
    one machine: off a local master, a warehouse on the machine's own disk is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
        local = re.match(r"local(\[|$)", spark.conf.get("spark.master", None) or "local")
        if not warehouse or warehouse.startswith("file:") and not local:
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = f"{warehouse.rstrip('/')}/_landed"
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def land(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    This cuts lineage in a way that survives the loss of executors: later stages
    read files, and values such as row positions are fixed for good. The table
    stays until `clear_landed`, or the cluster's own clean-up, takes it. `options` are
    those of the parquet writer.
    """
    spark = df.sparkSession
    path = shared_dir(spark, label)
    df.write.options(**options).parquet(path)
    _LANDED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_landed(spark: SparkSession) -> int:
    """Delete the tables this session has landed; the number deleted.

    Only for when no frame built on them is needed any more.
    """
    paths = _LANDED.pop(spark.sparkContext.applicationId, [])
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        location.getFileSystem(hadoop).delete(location, True)
    return len(paths)
