"""Session settings, shared scratch space and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# A lookup table is broadcast only when its counted rows stay below this.
BROADCAST_ROWS = 500_000

# A pass over fewer rows than this gains nothing from another task.
ROWS_PER_TASK = 5_000


def build_session(app: str = "pricelab", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder the cluster names; a temporary one in local mode only."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="pricelab-ckpt-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written rows."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """:func:`materialize` for input of many passes.

    A table that came out in fewer parts than its rows and the cores allow (one
    small file, say) is spread evenly first; large inputs keep their layout.
    """
    out = materialize(df)
    parts = out.rdd.getNumPartitions()
    cores = df.sparkSession.sparkContext.defaultParallelism
    if parts >= cores:
        return out
    target = min(cores, -(-out.count() // ROWS_PER_TASK))
    return materialize(out.repartition(target)) if parts < target else out


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
