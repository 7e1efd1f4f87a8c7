"""Sharding along a Hilbert curve over several metadata dimensions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of points, a row each, with coordinates below 2**bits; after Skilling's transform."""
    x = [points[:, i].astype(np.int64) for i in range(points.shape[1])]
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo excess work, from the high bit down
        p = q - 1
        for i in range(n):
            up = (x[i] & q) > 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(up, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):  # Gray encode
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[n - 1] & q) > 0, q - 1, 0)
        q >>= 1
    x = [v ^ t for v in x]
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for v in x:
            out = out << 1 | v >> b & 1
    return out


def on_curve(dimensions: list[Column], bits: int) -> Column:
    """A column with the curve index of integer columns, each below 2**bits."""

    @F.pandas_udf("long")
    def place(*columns: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index(np.stack([c.to_numpy(np.int64) for c in columns], 1), bits))

    return place(*dimensions)


def quantised(column: Column, kind: str, bits: int) -> Column:
    """A dimension below 2**bits: numbers by eighths of their binary logarithm, anything else by a hash; null is 0."""
    top = (1 << bits) - 1
    if kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal"):
        return F.coalesce(F.least(F.floor(F.log2(F.greatest(column.cast("double"), F.lit(0.0)) + 1) * 3), F.lit(top)), F.lit(0)).cast("long")
    return F.when(column.isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(column), F.lit(top)) + 1).cast("long")


def _on_curve(docs: DataFrame, dimensions: list[str], bits: int, *kept: Column) -> DataFrame:
    """kept, size, text_crc32 and curve of every row of docs."""
    kinds = dict(docs.dtypes)
    text = F.coalesce(F.col("text"), F.lit(""))
    own = [quantised(F.col(f"`{c}`"), kinds[c], bits).alias(f"_d{i}") for i, c in enumerate(dimensions)]
    rows = docs.select(*kept, (F.octet_length(text).cast("long") + 8).alias("size"), F.crc32(text).alias("text_crc32"), *own)
    return rows.withColumn("curve", on_curve([F.col(f"_d{i}") for i in range(len(own))], bits)).drop(*(f"_d{i}" for i in range(len(own))))


def _cut_runs(rows: DataFrame, shards: int) -> DataFrame:
    """rows, which have their rank, with shard and slot: so many runs, the first ones a row longer."""
    each, more = divmod(rows.count(), shards)
    edge, r = more * (each + 1), F.col("rank")
    early = r < edge
    shard = F.when(early, F.floor(r / (each + 1))).otherwise(more + F.floor((r - edge) / max(1, each)))
    slot = F.when(early, r % (each + 1)).otherwise((r - edge) % max(1, each))
    return rows.withColumns({"shard": shard.cast("int"), "slot": slot.cast("long")})


def assign(docs: DataFrame, dimensions: list[str], *, shards: int = 24, bits: int = 6) -> DataFrame:
    """doc_id, size, text_crc32, curve, shard and slot of every row of docs.

    The rows stand in the order of their place on the curve, then of doc_id,
    checksum and size; shard s is the s-th of so many runs whose row counts
    differ by one at most, and slot is the place in it. A shard therefore covers
    a compact piece of the space of dimensions, which its files' statistics
    show to a reader. size is the text's UTF-8 bytes plus 8; a null text has
    none and the checksum of the empty text. Equal texts, ties and repeated rows
    are placed like any others, with fewer rows than shards some stay empty, and
    a column that is not named is not read.
    """
    common.ship(docs.sparkSession)
    placed = common.cut(_on_curve(docs, dimensions, bits, F.col("doc_id")))
    rows = common.ranked(placed, "curve", "doc_id", "text_crc32", "size")
    return _cut_runs(rows, shards).select("doc_id", "size", "text_crc32", "curve", "shard", "slot")


def write_shards(docs: DataFrame, dimensions: list[str], path: str, *, shards: int = 24, bits: int = 6, rows_per_file: int = 1_000_000) -> None:
    """docs' rows, whole, in one folder for each shard under path, in the order of assign(), with slot and curve.

    Every row is written once, whatever others it equals: rows are sorted whole
    and never matched to places again. A shard's files are runs of
    rows_per_file slots, so that their statistics stay narrow and no task holds
    a whole shard. Columns called shard, slot or curve are replaced.
    """
    common.ship(docs.sparkSession)
    kept = [c for c in docs.columns if c not in ("shard", "slot", "curve")]
    whole = F.struct(*(F.col(f"`{c}`") for c in kept)).alias("_row")
    rows = common.ranked(_on_curve(docs, dimensions, bits, whole, F.col("doc_id")), "curve", "doc_id", "text_crc32", "size")
    rows = _cut_runs(rows, shards).withColumn("_run", F.floor(F.col("slot") / rows_per_file))
    rows = rows.repartition("shard", "_run").sortWithinPartitions("shard", "slot")
    rows.select(*(F.col(f"_row.`{c}`").alias(c) for c in kept), "slot", "curve", "shard").write.partitionBy("shard").parquet(path)
