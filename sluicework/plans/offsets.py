"""Resumable positions: all-string maps, checked before they are trusted."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import coerce
from .keyset import Cursor

VERSION = "1"
PHASES = ("backfill", "stream")
KEYS = ("version", "timestamp", "sys_id", "phase", "fingerprint")
FORMAT = "%Y-%m-%d %H:%M:%S"


class OffsetError(ValueError):
    """A stored position that cannot be used."""


def encode(cursor: Cursor, phase: str, fingerprint: str) -> dict[str, str]:
    return dict(zip(KEYS, (VERSION, cursor.ts.strftime(FORMAT), cursor.sys_id, phase, fingerprint), strict=True))


def decode(stored: dict, fingerprint: str) -> tuple[Cursor, str]:
    """The cursor and phase of a stored position; anything odd or of another stream raises."""
    for k in KEYS:
        if not isinstance(stored.get(k), str):
            raise OffsetError(f"{k} is missing or no string")
    if stored["version"] != VERSION:
        raise OffsetError(f"unknown version {stored['version']!r}")
    if stored["phase"] not in PHASES:
        raise OffsetError(f"unknown phase {stored['phase']!r}")
    if not stored["fingerprint"].strip():
        raise OffsetError("blank fingerprint")
    if stored["fingerprint"] != fingerprint:
        raise OffsetError("the position belongs to another table, query or domain")
    try:
        ts = datetime.strptime(stored["timestamp"], FORMAT)
    except ValueError as e:
        raise OffsetError(f"bad timestamp {stored['timestamp']!r}") from e
    return Cursor(ts, stored["sys_id"]), stored["phase"]


def is_valid(offset: Column) -> Column:
    """The same checks, but for the stream's identity, on a map column."""
    there = [offset[k].isNotNull() for k in KEYS]
    ok = there[0] & there[1] & there[2] & there[3] & there[4]
    ok = ok & (offset["version"] == VERSION) & offset["phase"].isin(*PHASES) & (F.trim(offset["fingerprint"]) != "")
    return F.coalesce(ok & coerce.is_timestamp(offset["timestamp"]), F.lit(False))


def partition(instance: str, table: str, fingerprint: str, timestamp_field: str) -> dict[str, str]:
    """The stream's identity."""
    return {"instance": instance, "table": table, "query_fingerprint": fingerprint, "timestamp_field": timestamp_field}


def lookup(streams: DataFrame, stored: DataFrame) -> DataFrame:
    """streams (instance, table, query_fingerprint, timestamp_field) with the offset stored for each, null where none is.

    stored has the same columns and offset; an offset that cannot be used raises
    when it is read: a stream must not begin anew unnoticed.
    """
    names = ["instance", "table", "query_fingerprint", "timestamp_field"]
    found = streams.join(stored.select(*names, "offset"), names, "left")
    usable = F.col("offset").isNull() | (is_valid(F.col("offset")) & (F.col("offset")["fingerprint"] == F.col("query_fingerprint")))
    return found.withColumn("offset", F.when(usable, F.col("offset")).otherwise(F.raise_error(F.lit("a stored offset cannot be used"))))
