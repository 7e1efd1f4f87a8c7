"""Connected components of an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Edges that one task may hold: up to so many are solved there, in about 100 MB.
LOCAL_EDGES = 1_000_000


def solve(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vertices of the edges and the smallest vertex of each one's component."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: a.size], at[a.size :]
    label = np.arange(ids.size)
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        for end in (x, y, label[x], label[y]):  # hook vertices and their labels
            np.minimum.at(new, end, low)
        new = new[new]
        if np.array_equal(new, label):
            return ids, ids[label]
        label = new


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each partition's edges replaced by one edge from every vertex to its component's smallest."""
    held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
    if held:
        ids, low = solve(*(np.concatenate(x) for x in zip(*held, strict=True)))
        yield pa.record_batch([pa.array(ids), pa.array(low)], ["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """One row per vertex of edges (a, b): id and component, the smallest id reachable.

    Up to LOCAL_EDGES edges are solved in one task. More are first contracted in
    partitions of that size, which keeps components and shortens paths, and then
    labelled in rounds: every vertex takes the smallest label around it and then
    that label's own, so labels jump further each time. Rounds are stored, so
    plans and recomputation stay short; a hub's edges are split by Spark's skew
    join, and labels are aggregated before they are shuffled.
    """
    common.ship(edges.sparkSession)
    edges = common.cut(edges.select("a", "b").filter("a != b").distinct())
    n = edges.count()
    parts = -(-n // LOCAL_EDGES)
    if parts <= 1:
        return common.cut(edges.coalesce(1).mapInArrow(_stars, "a long, b long")).select(F.col("a").alias("id"), F.col("b").alias("component"))
    stars = edges.repartition(parts, "a").mapInArrow(_stars, "a long, b long").filter("a != b")
    both = common.cut(stars.union(stars.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = common.cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("component")).select(F.col("a").alias("id"), "component"))
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "component"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        nearer = labels.join(near, "id").select("id", F.col("component").alias("old"), F.least("component", "near").alias("via"))
        hop = labels.select(F.col("id").alias("via"), F.col("component").alias("far"))
        new = common.cut(nearer.join(hop, "via", "left").select("id", "old", F.least("via", F.coalesce("far", "via")).alias("component")))
        changed = new.filter("component < old").limit(1).count()
        labels = new.select("id", "component")
        if not changed:
            return labels
