"""Keyed state over row versions in the order of their arrival: a bounded cache of seen versions, and a guard of each lane's order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..workers import ship

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _in_order(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    """A group's rows of one batch as they arrived; a batch is bounded by its trigger."""
    frames = list(rows)
    whole = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
    return whole.sort_values("sluice_arrival", kind="stable")


class SeenVersions(StatefulProcessor):
    """A queue of the versions that were first seen last, at most `size` of them, and the same as a set.

    A version that is offered again while it is in the queue keeps its place; a
    new one pushes the eldest out, which is new again when it comes back. Of a
    batch each state is read and written once.
    """

    def __init__(self, size: int):
        if size < 1:
            raise ValueError("the cache holds a version at least")
        self.size = size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ends = handle.getValueState("ends", "first bigint, next bigint")
        self.queue = handle.getMapState("queue", "at bigint", "version string")
        self.places = handle.getMapState("places", "version string", "at bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        first, after = self.ends.get() if self.ends.exists() else (0, 0)
        whole = _in_order(rows)
        known: dict[str, bool] = {}
        added: dict[int, str] = {}  # this batch's places that are still in the queue
        fresh = []
        for version in whole["sluice_version"]:
            seen = known.get(version)
            if seen is None:
                seen = self.places.containsKey((version,))
            fresh.append(not seen)
            known[version] = True
            if not seen:
                added[after] = version
                after += 1
                if after - first > self.size:
                    gone = added.pop(first, None)
                    if gone is None:
                        gone = self.queue.getValue((first,))[0]
                        self.queue.removeKey((first,))
                        self.places.removeKey((gone,))
                    known[gone] = False
                    first += 1
        for at, version in added.items():
            self.queue.updateValue((at,), (version,))
            self.places.updateValue((version,), (at,))
        self.ends.update((first, after))
        yield whole[fresh].drop(columns=["sluice_arrival", "sluice_version", "sluice_stream"])

    def close(self) -> None:
        """Nothing is held outside of the state."""


def dedup_bounded(df: DataFrame, size: int, *, stream: Column | str, version: list[str], arrival: str) -> DataFrame:
    """Rows of a stream whose version isn't among the last `size` that were new, in the order of arrival, by stream.

    stream tells the streams apart (a table, or a table and a bucket of ids where
    one table's cache should be shared by several tasks), version names the
    columns that make a version. Null cells are a value like any other, rows of
    one arrival come in any order. State is as large as the caches, lives in the
    checkpoint and survives restarts. The session's state store must be one with
    column families, see PROVIDER.
    """
    ship(df.sparkSession)
    own = F.to_json(F.struct(*version), {"ignoreNullFields": "false"})
    keyed = df.withColumns({"sluice_version": own, "sluice_arrival": F.col(arrival), "sluice_stream": (F.col(stream) if isinstance(stream, str) else stream).cast("string")})
    return keyed.groupBy("sluice_stream").transformWithStateInPandas(SeenVersions(size), df.schema, "Append", "None")


class LastPlaces(StatefulProcessor):
    """The places of the last rows of a bucket's lanes, to which their next rows are compared.

    Of a batch each bucket is one call, however many lanes it has, and each
    lane's place is read and written once.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getMapState("last", "lane string", "second bigint, id string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        whole = pd.concat(rows, ignore_index=True)
        codes, names = pd.factorize(whole["sluice_lane"].to_numpy(dtype=object), use_na_sentinel=False)
        order = whole["sluice_arrival"].sort_values(kind="stable").index.to_numpy()
        order = order[np.argsort(codes[order], kind="stable")]  # lane by lane, each as it arrived
        seconds, ids = whole["sluice_second"].to_numpy(dtype=float)[order], whole["sluice_id"].to_numpy(dtype=object)[order]
        starts = np.flatnonzero(np.diff(codes[order], prepend=-1))
        seconds0, ids0 = np.roll(seconds, 1), np.roll(ids, 1)
        for start, end, name in zip(starts, [*(starts[1:] - 1), len(order) - 1], names, strict=True):
            lane = (None if pd.isna(name) else name,)
            second, ids0[start] = self.last.getValue(lane) or (None, None)
            seconds0[start] = np.nan if second is None else second
            self.last.updateValue(lane, (None if np.isnan(seconds[end]) else int(seconds[end]), ids[end]))
        late = seconds < seconds0  # never where a second is missing
        for i in np.flatnonzero(seconds == seconds0):
            late[i] = ids[i] is not None and ids0[i] is not None and ids[i] <= ids0[i]
        violates = np.empty(len(late), dtype=bool)
        violates[order] = late
        yield whole.drop(columns=["sluice_arrival", "sluice_second", "sluice_id", "sluice_lane", "sluice_bucket"]).assign(violates=violates)

    def close(self) -> None:
        """Nothing is held outside of the state."""


def guard_order(df: DataFrame, *, lane: str, ts: str, sys_id: Column, arrival: str, keep: list[str] | None = None, buckets: int = 1024) -> DataFrame:
    """Rows of a stream with `violates`: not strictly after the (second, id) of the row that came before it in its lane.

    Ids are compared as texts, so numbers should come padded; a row without a
    second isn't late, nor is the next one, and in one second the same holds for
    ids. A lane is compared over batches and restarts; what violates is for the
    caller to route. keep names the columns to return, all by default: each
    costs its way through Python. State is one place for each lane. Lanes are
    dealt to buckets, so that a batch's calls are bounded; a task takes a
    bucket's rows of a batch into memory. A checkpoint holds for one number of
    buckets.
    """
    ship(df.sparkSession)
    kept = df.select(*(df.columns if keep is None else keep))
    own = F.col(lane).cast("string")
    keyed = df.select(
        *kept.columns, F.col(arrival).alias("sluice_arrival"), F.unix_seconds(F.col(ts).cast("timestamp")).alias("sluice_second"), sys_id.cast("string").alias("sluice_id"), own.alias("sluice_lane"),
        F.pmod(F.xxhash64(own), F.lit(buckets)).cast("int").alias("sluice_bucket"),
    )
    out = T.StructType([*kept.schema.fields, T.StructField("violates", T.BooleanType())])
    return keyed.groupBy("sluice_bucket").transformWithStateInPandas(LastPlaces(), out, "Append", "None")
