"""Shared helpers: reading tables, shared-folder writes and bounded batches."""

from __future__ import annotations

import contextlib
import ctypes
import sys
import types
import uuid

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelab.session import shared_dir

#: Bytes of text that one step of an Arrow task holds at a time.
CHUNK_BYTES = 4 << 20


def ship(module: str) -> None:
    """Let task functions of ``module`` travel by value, so workers need not have the package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)


def once_per_worker(key, make):
    """``make()``, kept by the worker process for its later tasks under ``key``."""
    kept = sys.modules.setdefault("pricelab_worker_cache", types.ModuleType("pricelab_worker_cache")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int):
    """Arrow batches of ``rows`` rows in the jobs that start inside, for rows that hold several texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and continue from the written rows."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete tables of :func:`written` that nothing reads any more, and let Spark's cleaner drop the shuffles behind them."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.written_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    # Shuffle files go only when the driver collects the plans that made them.
    spark._jvm.System.gc()


def whole_text(name: str = "text") -> F.Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def give_back() -> None:
    """Return freed memory to the system: a worker waits for its next task with what it holds."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library can
        ctypes.CDLL(None).malloc_trim(0)


def chunks(batches, column: str, limit: int = CHUNK_BYTES):
    """Slices of the batches whose ``column`` holds about ``limit`` bytes; one value may hold more.

    A task that took more than a few of them gives its freed memory back at the end.
    """
    total = 0
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)
        total += int(sizes.sum())
    if total > 2 * limit:
        batch = None
        give_back()
