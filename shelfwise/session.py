"""Session building, shared scratch storage and size-checked small tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

SMALL_TABLE_ROWS = 50_000
_LOCAL_ROOTS: dict[str, str] = {}


def build_session(app_name: str = "shelfwise", **conf: str) -> SparkSession:
    """A session with adaptive execution on; ``conf`` uses ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str | None:
    """The shared folder named in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder; on a cluster
    without the setting the answer is None.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        return None
    if context.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="shelfwise-")
    return _LOCAL_ROOTS[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    root = scratch_root(spark)
    if root is None:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return f"{root}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The columnar copy outlives lost executors and later reads prune columns.
    With no shared folder the frame is persisted with its lineage kept.
    """
    spark = df.sparkSession
    if scratch_root(spark) is None:
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Give a scan with few splits one partition per task slot.

    For CPU-heavy text work on small tables. A table with at least two splits
    per slot, such as any large one, is left as it is and not shuffled. Call it
    on a plain scan, whose split count is known without running a job.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= 2 * slots else df.repartition(slots)


def small_side(df: DataFrame, max_rows: int = SMALL_TABLE_ROWS) -> DataFrame:
    """Mark a class-level table for broadcast only after measuring it.

    At most ``max_rows + 1`` rows reach the driver. A table within the bound
    comes back as a local relation with a broadcast hint; a larger one comes
    back unchanged, so that the join is shuffled and split by AQE.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
