"""Keyset scans: a total order of (timestamp, id) makes a sweep restartable without offsets.

A sweep is one range predicate, which Parquet row groups can be pruned by; the
paged form is a top-k after a cursor. Ids are compared as strings throughout.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..workers import cut

SECOND = timedelta(seconds=1)


def seconds(t: datetime) -> datetime:
    return t.replace(microsecond=0)


@dataclass(frozen=True, order=True)
class Cursor:
    """A place in a scan: a whole second and an id, empty before the first of that second."""

    ts: datetime
    sys_id: str = ""

    @classmethod
    def start(cls, first: datetime) -> Cursor:
        """Before every row of first's second."""
        return cls(seconds(first) - SECOND)

    def rewound(self, overlap: timedelta, *, first: datetime | None = None) -> Cursor:
        """Where a resumed scan begins: overlap earlier, but not before first; without overlap the cursor itself."""
        if not overlap:
            return self
        back = Cursor(self.ts - overlap)
        return max(back, Cursor.start(first)) if first else back


@dataclass(frozen=True)
class Keys:
    """Names of the columns a scan goes by."""

    ts: str = "sys_updated_on"
    sys_id: str = "sys_id"
    version: str = "sys_mod_count"


def _at(t: datetime, df: DataFrame, keys: Keys) -> Column:
    return F.lit(t.isoformat(sep=" ")).cast(dict(df.dtypes)[keys.ts])


def after(df: DataFrame, cursor: Cursor, keys: Keys = Keys()) -> Column:
    """Strictly after the cursor.

    The bound that the cursor's second implies stands by itself, so a scan is
    pruned by it whatever the id is made of.
    """
    ts, start, end = F.col(keys.ts), _at(cursor.ts, df, keys), _at(cursor.ts + SECOND, df, keys)
    if not cursor.sys_id:
        return ts >= end
    return (ts >= start) & ((ts >= end) | (F.col(keys.sys_id) > cursor.sys_id))


def until(df: DataFrame, high: datetime, keys: Keys = Keys()) -> Column:
    return F.col(keys.ts) < _at(seconds(high) + SECOND, df, keys)


def next_buckets(df: DataFrame, last: datetime, high: datetime, keys: Keys = Keys()) -> DataFrame:
    """Seconds after last up to high, in order."""
    return in_order(df.filter(after(df, Cursor(last), keys) & until(df, high, keys)), keys)


def drain_bucket(df: DataFrame, cursor: Cursor, keys: Keys = Keys()) -> DataFrame:
    """The rest of the cursor's own second."""
    same = (F.col(keys.ts) >= _at(cursor.ts, df, keys)) & until(df, cursor.ts, keys)
    return df.filter(same & (F.col(keys.sys_id) > cursor.sys_id)).orderBy(keys.sys_id)


def sweep(df: DataFrame, cursor: Cursor, high: datetime, keys: Keys = Keys()) -> DataFrame:
    """Everything after the cursor up to high; unordered, so that it stays one scan."""
    return df.filter(after(df, cursor, keys) & until(df, high, keys))


def in_order(df: DataFrame, keys: Keys = Keys()) -> DataFrame:
    return df.orderBy(F.date_trunc("second", keys.ts), keys.sys_id)


def page(df: DataFrame, cursor: Cursor, high: datetime, size: int, keys: Keys = Keys()) -> DataFrame:
    """The first rows of a sweep: a top-k, so that no task sorts more than size rows for the result."""
    return in_order(sweep(df, cursor, high, keys), keys).limit(size)


def high_water_mark(now: datetime, lag: timedelta) -> datetime:
    """The last second that a sweep begun now may read; fixed for the whole sweep."""
    return seconds(now - lag)


def is_idle(cursor: Cursor, high: datetime) -> bool:
    return cursor.ts > high or cursor.ts == high and not cursor.sys_id


def phase(high: datetime, now: datetime, lag: timedelta, poll: timedelta) -> str:
    """'stream' once a sweep has reached the present, 'backfill' before."""
    return "stream" if high >= seconds(now - lag - poll) else "backfill"


def projection(fields: list[str], keys: Keys = Keys()) -> list[str]:
    """Wanted fields, each once in its order, with the cursor's own added; no wish means all."""
    wanted = list(dict.fromkeys(f.strip() for f in fields if f.strip()))
    return [*wanted, *(k for k in (keys.sys_id, keys.ts, keys.version) if k not in wanted)] if wanted else []


def check_projection(fields: list[str], keys: Keys = Keys()) -> None:
    missing = [k for k in (keys.sys_id, keys.ts) if fields and k not in fields]
    if missing:
        raise ValueError(f"a projection needs {', '.join(missing)}")


def select(df: DataFrame, fields: list[str]) -> DataFrame:
    """Wanted columns that exist; unknown names are silently absent, no wish means all."""
    return df.select(*(f"`{f}`" for f in fields if f in df.columns)) if fields else df


def order_violations(df: DataFrame, arrival: str, keys: Keys = Keys(), *, lane: str | None = None) -> DataFrame:
    """Rows that don't come strictly after the row that arrived before them, in their lane if there are lanes.

    Without lanes arrivals are dealt by ranges, so no task orders them all: rows
    are compared inside a range, and each range's first row with the last one
    before it, one small row for each range.
    """
    place = F.struct(F.date_trunc("second", keys.ts).alias("ts"), F.col(keys.sys_id).alias("id"))
    placed = df.withColumn("_place", place)
    if lane:
        w = W.partitionBy(lane).orderBy(arrival)
        return placed.withColumn("_before", F.lag("_place").over(w)).filter(F.col("_place") <= F.col("_before")).drop("_place", "_before")
    dealt = cut(placed.repartitionByRange(arrival).withColumn("_range", F.spark_partition_id()))
    ends = dealt.groupBy("_range").agg(F.max_by("_place", F.col(arrival)).alias("_end"))
    before = ends.select("_range", F.lag("_end").over(W.orderBy("_range")).alias("_end"))  # one row for each range
    inside = F.lag("_place").over(W.partitionBy("_range").orderBy(arrival))
    rows = dealt.withColumn("_before", inside).join(F.broadcast(before), "_range")
    return rows.filter(F.col("_place") <= F.coalesce("_before", "_end")).drop("_place", "_before", "_end", "_range")


def source_counters(df: DataFrame, source: str, version: Column, ts: Column, *, skipped: Column, now: int) -> DataFrame:
    """By source: rows emitted, versions among them that came again, rows skipped, and the seconds that the newest lies behind now."""
    # by version first: copies meet after each task has counted its own, and a source is never one large group of versions
    each = df.groupBy(F.col(source).alias("source"), version.alias("_version")).agg(F.count("*").alias("_n"), F.count_if(skipped).alias("_skipped"), F.max(F.date_trunc("second", ts)).alias("_newest"))
    lag = F.greatest(F.lit(0).cast("bigint"), F.lit(now) - F.unix_timestamp(F.max("_newest").cast("timestamp")))
    return each.groupBy("source").agg(F.sum("_n").alias("emitted"), (F.sum("_n") - F.count_if(F.col("_version").isNotNull())).alias("duplicates"), F.sum("_skipped").alias("skipped"), lag.alias("lag_seconds"))


def dedup_versions(df: DataFrame, arrival: str, keys: Keys = Keys()) -> DataFrame:
    """The first arrival of every row version (second, id, version): one partial aggregation, so many copies of one version are never sorted."""
    version = F.date_trunc("second", keys.ts).alias("_second"), F.col(keys.sys_id).alias("_id"), F.col(keys.version).alias("_mod")
    return df.groupBy(*version).agg(F.min_by(F.struct(*df.columns), F.col(arrival)).alias("_r")).select("_r.*")


def latest_state(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The last row of every key: one partial aggregation, not a sorted window."""
    place = F.struct(*order)
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), place).alias("_r")).select(key, "_r.*")


def lost_late_rows(df: DataFrame, committed: str, anchor: datetime, overlap: timedelta, keys: Keys = Keys()) -> DataFrame:
    """Rows that became visible after anchor's sweep, with a timestamp that no later sweep reads again."""
    edge = _at(seconds(anchor) - overlap + SECOND, df, keys)
    return df.filter((F.col(committed) > _at(anchor, df, keys)) & (F.col(keys.ts) < edge))


def first_sweeps(rows: DataFrame, sweeps: DataFrame, committed: str, *, lag: timedelta, overlap: timedelta, keys: Keys = Keys()) -> DataFrame:
    """Every row with `sweep`, the start of the first sweep that could read it, and `lost`, whether none ever does.

    sweeps has `at`, the times at which sweeps began. A sweep reads whole seconds
    up to lag before its beginning, and from overlap before the last second of
    the sweep before. A row that became visible at `committed` is read by the
    first sweep after that which reaches its second; if that sweep begins behind
    it, all later ones do. A row that no sweep has reached yet isn't lost.

    An as-of join: sweeps are gathered by hour, as many as an hour has, and the
    hours, which are few, tell what comes next; rows meet their hour by a join
    that can be broadcast or split, so a burst of rows stays dealt out.
    """
    micros = lambda d: F.lit(d // timedelta(microseconds=1))
    time = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    second = lambda us: us - F.pmod(us, F.lit(1_000_000))
    hour = lambda us: F.floor(us / 3_600_000_000)
    need = F.greatest(time(committed), second(time(keys.ts)) + micros(lag))
    r = rows.withColumns({"_need": need, "_hour": hour(need)})
    times = sweeps.select(time("at").alias("us")).filter("us IS NOT NULL")
    own = times.groupBy(hour(F.col("us")).alias("_hour")).agg(F.array_sort(F.collect_set("us")).alias("all"))
    hours = own.join(r.select("_hour").distinct(), "_hour", "full_outer")  # hours of rows without a sweep too
    later, before = W.orderBy("_hour").rowsBetween(1, W.unboundedFollowing), W.orderBy("_hour").rowsBetween(W.unboundedPreceding, -1)
    placed = hours.select("_hour", F.coalesce("all", F.array().cast("array<bigint>")).alias("all"), F.min(F.element_at("all", 1)).over(later).alias("next"), F.max(F.element_at("all", -1)).over(before).alias("last"))
    j = r.join(placed, "_hour", "left")
    at = F.coalesce(F.get(F.filter("all", lambda x: x >= F.col("_need")), F.lit(0)), F.col("next"))
    j = j.withColumn("_at", at)
    previous = F.coalesce(F.array_max(F.filter("all", lambda x: x < F.col("_at"))), F.col("last"))
    low = second(previous - micros(lag)) - micros(overlap)
    lost = F.coalesce(F.col("_at").isNotNull() & (second(time(keys.ts)) <= low), F.lit(False))
    seen = F.when(~lost, F.timestamp_micros("_at").cast("timestamp_ntz"))
    return j.select(*(F.col(f"`{c}`") for c in rows.columns), seen.alias("sweep"), lost.alias("lost"))


def valid_rows(df: DataFrame, ts: Column, keys: Keys = Keys()) -> Column:
    """Rows with an id and a timestamp that parses; ts is the parsed one."""
    return F.col(keys.sys_id).isNotNull() & (F.col(keys.sys_id) != "") & ts.isNotNull()
