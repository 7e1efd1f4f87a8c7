"""What several corpus operators share: shipping the package, shared storage, and a distributed rank."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import workers
from ..workers import cut, new_path, shared_dir, sweep  # noqa: F401  the operators' own names for them

#: Rows of one broadcast at most; larger sides take the shuffled path.
BROADCAST_ROWS = workers.BROADCAST_ROWS
#: Rows and bytes of a batch sent to a Python worker at most, where the session sets none: texts may be long.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, and bound the session's batches."""
    for key, value in BATCH.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    workers.ship(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: What each operator's functions hold between a worker's tasks, as ways to let go of it.
_HELD: dict[str, Callable[[], None]] = {}


def alone(name: str, clear: Callable[[], None]) -> None:
    """In a worker: the caches of other operators are emptied before this one's tasks fill theirs."""
    others = [other for other in _HELD if other != name]
    for other in others:
        _HELD.pop(other)()
    _HELD[name] = clear
    if others:
        settle()


def settle() -> None:
    """In a worker: memory that the allocators hold for later goes back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches cut small, so that few texts are Python objects at once."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def ranked(df: DataFrame, *keys: Column | str, rank: str = "rank") -> DataFrame:
    """df with its 0-based place in the order of keys, stored.

    A range partitioning on keys and a sort inside each partition give the
    order; the partitions' row counts, one row each, are summed on the driver.
    No task gets more than its range, so keys should end in a unique column.
    """
    spark = df.sparkSession
    held = cut(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    counts = sorted(tuple(r) for r in held.groupBy(part.alias("p")).count().collect())
    starts, at = [], 0
    for p, n in counts:
        starts.append((p, at))
        at += n
    firsts = spark.createDataFrame(starts, "_part long, _first long")
    return held.withColumn("_part", part).join(F.broadcast(firsts), "_part").withColumn(rank, F.col("_first") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_part", "_first", "_at")
