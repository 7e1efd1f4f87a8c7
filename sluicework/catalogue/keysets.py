"""Queries of keyset scans, dedup and offsets."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ..plans import keyset as ks
from ..plans import offsets
from ..functions import coerce
from .base import ISSUE, Catalogue, issue, placed, table

Q = Catalogue()
_LAST, _HIGH = datetime(1995, 3, 15), datetime(1995, 9, 1)
_ID = "a0000000000000000000000000001000"
_COLUMNS = ("sys_id", "sys_updated_on", "sys_mod_count")
_EVENT = ks.Keys("ts", "event_id", "user_id")
_S = f"WITH {ISSUE} SELECT sys_id, sys_updated_on, sys_mod_count FROM issue"


_PLACED = f"WITH {ISSUE} SELECT sys_id, sys_updated_on, sys_mod_count, row_number() OVER (ORDER BY sys_updated_on, sys_id) AS place FROM issue"


@Q(f"{_PLACED} WHERE sys_updated_on > TIMESTAMP '1995-03-15' AND sys_updated_on <= TIMESTAMP '1995-09-01'")
def keyset_next(spark, sf_dir):
    return placed(ks.next_buckets(issue(spark, sf_dir), _LAST, _HIGH).select(*_COLUMNS))


@Q(f"{_PLACED} WHERE sys_updated_on = TIMESTAMP '1995-03-15' AND sys_id > '{_ID}'")
def keyset_drain(spark, sf_dir):
    return placed(ks.drain_bucket(issue(spark, sf_dir), ks.Cursor(_LAST, _ID)).select(*_COLUMNS))


_AFTER = f"(sys_updated_on > TIMESTAMP '1995-03-15' OR (sys_updated_on = TIMESTAMP '1995-03-15' AND sys_id > '{_ID}')) AND sys_updated_on <= TIMESTAMP '1995-09-01'"


@Q(f"{_S} WHERE {_AFTER}")
def keyset_sweep(spark, sf_dir):
    return ks.sweep(issue(spark, sf_dir), ks.Cursor(_LAST, _ID), _HIGH).select(*_COLUMNS)


@Q(f"{_S} WHERE {_AFTER} ORDER BY sys_updated_on, sys_id LIMIT 500")
def keyset_page(spark, sf_dir):
    return ks.page(issue(spark, sf_dir), ks.Cursor(_LAST, _ID), _HIGH, 500).select(*_COLUMNS)


@Q(f"{_S} WHERE sys_updated_on > TIMESTAMP '1995-03-13' AND sys_updated_on <= TIMESTAMP '1995-09-01'")
def overlap_rewind(spark, sf_dir):
    back = ks.Cursor(_LAST, _ID).rewound(timedelta(days=2))
    return ks.sweep(issue(spark, sf_dir), back, _HIGH).select(*_COLUMNS)


@Q(f"{_S} WHERE sys_updated_on >= TIMESTAMP '1995-03-15' AND sys_updated_on <= TIMESTAMP '1995-09-01'")
def backfill_from_start(spark, sf_dir):
    return ks.sweep(issue(spark, sf_dir), ks.Cursor.start(_LAST), _HIGH).select(*_COLUMNS)


@Q("SELECT count(*) AS rows, max(date_trunc('second', ts))::TIMESTAMP AS reached FROM events WHERE ts < TIMESTAMP '2024-01-10 11:59:59'")
def high_water_mark(spark, sf_dir):
    high = ks.high_water_mark(datetime(2024, 1, 10, 11, 59, 59, 700_000), timedelta(seconds=1))
    e = table(spark, sf_dir, "events")
    return e.filter(ks.until(e, high, _EVENT)).agg(F.count("*").alias("rows"), F.max(F.date_trunc("second", "ts")).cast("timestamp_ntz").alias("reached"))


def _versions(spark, sf_dir):
    """Events as versions of entities, every eleventh delivered twice."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("sys_id"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("sys_updated_on"), (F.col("event_id") % 3).alias("sys_mod_count"), F.col("event_id").alias("arrival"), "value")
    return e.union(e.filter("arrival % 11 = 0").withColumn("arrival", F.col("arrival") + 1_000_000_000))


_VERSIONS = """one AS (SELECT user_id AS sys_id, date_trunc('hour', ts)::TIMESTAMP AS sys_updated_on, event_id % 3 AS sys_mod_count, event_id AS arrival, value FROM events),
 versions AS (SELECT * FROM one UNION ALL SELECT sys_id, sys_updated_on, sys_mod_count, arrival + 1000000000, value FROM one WHERE arrival % 11 = 0)"""


@Q(f"WITH {_VERSIONS} SELECT sys_id, sys_updated_on, sys_mod_count, min(arrival) AS arrival FROM versions GROUP BY ALL")
def dedup_versions(spark, sf_dir):
    return ks.dedup_versions(_versions(spark, sf_dir), "arrival").select(*_COLUMNS, "arrival")


@Q(f"WITH {_VERSIONS} SELECT sys_id, sys_updated_on, sys_mod_count, arrival, value FROM versions QUALIFY row_number() OVER (PARTITION BY sys_id ORDER BY sys_updated_on DESC, sys_mod_count DESC, arrival DESC) = 1")
def latest_state(spark, sf_dir):
    return ks.latest_state(_versions(spark, sf_dir), "sys_id", "sys_updated_on", "sys_mod_count", "arrival").select(*_COLUMNS, "arrival", "value")


@Q("SELECT event_id, date_trunc('second', ts)::TIMESTAMP AS ts FROM events WHERE ts + INTERVAL (event_id % 7) HOUR > TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-09 22:00:01'")
def late_rows(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    e = e.withColumn("committed", F.expr("ts + make_dt_interval(0, cast(event_id % 7 as int))"))
    late = ks.lost_late_rows(e, "committed", datetime(2024, 1, 10), timedelta(hours=2), _EVENT)
    return late.select("event_id", F.date_trunc("second", "ts").cast("timestamp_ntz").alias("ts"))


@Q("""WITH s AS (SELECT DISTINCT ts + INTERVAL 17 MINUTE AS began FROM events WHERE event_id % 23 = 0), w AS (SELECT began, date_trunc('second', lag(began) OVER (ORDER BY began) - INTERVAL 90 SECOND) - INTERVAL 30 MINUTE AS low FROM s),
 e AS (SELECT event_id, date_trunc('second', ts) AS sec, ts + INTERVAL (event_id % 7 * 11) MINUTE AS committed FROM events),
 n AS (SELECT *, greatest(committed, sec + INTERVAL 90 SECOND) AS need FROM e)
 SELECT event_id, CASE WHEN low IS NULL OR sec > low THEN began::TIMESTAMP END AS sweep, coalesce(began IS NOT NULL AND sec <= low, false) AS lost FROM n ASOF LEFT JOIN w ON n.need <= w.began""")
def sweep_audit(spark, sf_dir):
    """By row the first of irregular sweeps that reads it, or that none does."""
    e = table(spark, sf_dir, "events")
    sweeps = e.filter("event_id % 23 = 0").select((F.col("ts") + F.expr("INTERVAL 17 MINUTES")).alias("at"))
    rows = e.withColumn("committed", F.expr("ts + make_dt_interval(0, 0, cast(event_id % 7 * 11 as int))"))
    found = ks.first_sweeps(rows, sweeps, "committed", lag=timedelta(seconds=90), overlap=timedelta(minutes=30), keys=_EVENT)
    return found.select("event_id", "sweep", "lost")


@Q("SELECT o_orderdate AS ts, count(*) AS rows FROM orders GROUP BY 1 HAVING count(*) > 1")
def same_second_buckets(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.groupBy(F.date_trunc("second", "o_orderdate").cast("timestamp_ntz").alias("ts")).agg(F.count("*").alias("rows")).filter("rows > 1")


def arrivals(spark, sf_dir):
    """Events whose every fiftieth carries a time of the day before, and every seventieth the id of an earlier one."""
    n = F.col("event_id")
    ts = F.when(n % 50 == 0, F.expr("ts - INTERVAL 1 DAY")).otherwise(F.col("ts"))
    return table(spark, sf_dir, "events").select("user_id", n.alias("arrival"), ts.alias("ts"), F.when(n % 70 == 0, n - 3).otherwise(n).alias("event_id"))


ARRIVALS = "a AS (SELECT user_id, event_id AS arrival, date_trunc('second', CASE WHEN event_id % 50 = 0 THEN ts - INTERVAL 1 DAY ELSE ts END) AS s, CASE WHEN event_id % 70 = 0 THEN event_id - 3 ELSE event_id END AS event_id FROM events)"


def _violations(lane: str | None):
    def run(spark, sf_dir):
        return ks.order_violations(arrivals(spark, sf_dir), "arrival", _EVENT, lane=lane).select("user_id", "arrival")

    part = f"PARTITION BY {lane} " if lane else ""
    return run, f"WITH {ARRIVALS}, e AS (SELECT *, lag(s) OVER w AS s0, lag(event_id) OVER w AS e0 FROM a WINDOW w AS ({part}ORDER BY arrival)) SELECT user_id, arrival FROM e WHERE s < s0 OR (s = s0 AND event_id <= e0)"


Q.add("order_violation", *_violations("user_id"))
Q.add("order_violation_whole", *_violations(None))


def _raw(spark, sf_dir):
    """Events as string cells, some without an id and some with a bad timestamp."""
    n = F.col("event_id")
    good = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    ts = F.when(n % 13 == 0, F.lit("2024-02-30 10:00:00")).when(n % 17 == 0, F.date_format("ts", "yyyy-MM-dd")).when(n % 19 == 0, F.lit("")).otherwise(good)
    return table(spark, sf_dir, "events").select("event_id", F.when(n % 23 != 0, n.cast("string")).alias("sys_id"), ts.alias("raw"))


_BAD = "event_id % 13 = 0 OR event_id % 17 = 0 OR event_id % 19 = 0 OR event_id % 23 = 0"


@Q(f"SELECT event_id, CAST(event_id AS VARCHAR) AS sys_id, date_trunc('second', ts)::TIMESTAMP AS sys_updated_on FROM events WHERE NOT ({_BAD})")
def bad_row_skip(spark, sf_dir):
    raw, ts = _raw(spark, sf_dir), coerce.to_timestamp(F.col("raw"))
    return raw.filter(ks.valid_rows(raw, ts)).select("event_id", "sys_id", ts.alias("sys_updated_on"))


@Q(f"SELECT event_id FROM events WHERE {_BAD}")
def bad_row_fail_rows(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return raw.filter(~ks.valid_rows(raw, coerce.to_timestamp(F.col("raw")))).select("event_id")


