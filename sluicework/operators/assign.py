"""Rendezvous assignment of streams to tasks by MurmurHash3, which Spark has only with another end of the string."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workers import ship

# The hash's constants and the seed.
SEED = 0x5F3759DF
C1, C2, ADD = 0xCC9E2D51, 0x1B873593, 0xE6546B64
MIX1, MIX2 = 0x85EBCA6B, 0xC2B2AE35


def hashed(texts: list[bytes], seed: int = SEED) -> np.ndarray:
    """Unsigned 32-bit MurmurHash3 (x86) of byte strings, all of them at once, four bytes a step."""
    n = np.array([len(t) for t in texts], np.uint32)
    width = max(4, -(-int(n.max(initial=0)) // 4) * 4)
    words = np.frombuffer(b"".join(t.ljust(width, b"\0") for t in texts), "<u4").reshape(len(texts), width // 4)
    h = np.full(len(texts), seed, np.uint32)
    whole = n // 4

    def rotated(x: np.ndarray, by: int) -> np.ndarray:
        return x << np.uint32(by) | x >> np.uint32(32 - by)

    for i in range(width // 4):
        k = rotated(words[:, i] * np.uint32(C1), 15) * np.uint32(C2)
        full = i < whole
        h = np.where(full, rotated(h ^ k, 13) * np.uint32(5) + np.uint32(ADD), np.where((i == whole) & (n % 4 > 0), h ^ k, h))
    h ^= n
    for shift, factor in ((16, MIX1), (13, MIX2)):
        h = (h ^ h >> np.uint32(shift)) * np.uint32(factor)
    return h ^ h >> np.uint32(16)


def murmur3(text: Column, seed: int = SEED) -> Column:
    """The hash of a text's UTF-8 bytes, by Arrow batches."""
    ship(SparkSession.active())

    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(hashed([t.encode() for t in texts], seed).astype(np.int64))

    return run(text)


def owner(df: DataFrame, alias: str, tasks: int) -> DataFrame:
    """df with the task that owns each alias: the highest score, the lowest index among equals."""
    ship(df.sparkSession)

    @F.pandas_udf("int")
    def best(names: pd.Series) -> pd.Series:
        scores = np.stack([hashed([f"{x}#{i}".encode() for x in names]) for i in range(tasks)])
        return pd.Series(scores.argmax(0).astype(np.int32))

    return df.withColumn("task", best(F.col(alias)))


def task_lists(aliases: list[str], max_tasks: int, spark) -> list[list[str]]:
    """Aliases of each task that gets any; there are never more tasks than aliases."""
    if not aliases:
        return []
    n = min(max_tasks, len(aliases))
    rows = owner(spark.createDataFrame([(i, a) for i, a in enumerate(aliases)], "i int, alias string"), "alias", n).orderBy("i").collect()
    out: list[list[str]] = [[] for _ in range(n)]
    for r in rows:
        out[r["task"]].append(r["alias"])
    return [x for x in out if x]
