"""Comparison of a table with what was delivered of it."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import is_id, reconcile_timestamp
from ..sources.files import SKIPPED, read_dump
from ..workers import cut, ship, small


def version_number(c: Column) -> Column:
    """A version as a number; -1 if it isn't one."""
    return F.coalesce(F.trim(c.cast("string")).try_cast("bigint"), F.lit(-1))


def versions(rows: DataFrame, *, since: str | None = None, until: str | None = None, arrival: str | None = None) -> DataFrame:
    """By sys_id the count and the newest (ts, mod); rows without an id or outside the window don't count.

    rows has sys_id, ts and mod. With arrival, a column that tells the order in
    which rows were read, the last row read counts instead of the newest. One
    partial aggregation per key.
    """
    ts, mod = F.coalesce(reconcile_timestamp(F.col("ts")), F.lit("")).alias("ts"), version_number(F.col("mod")).alias("mod")
    r = rows.filter(F.coalesce("sys_id", F.lit("")) != "").select("sys_id", ts, mod, *([F.col(arrival).alias("_arrival")] if arrival else []))
    version = F.struct("ts", "mod")
    return r.filter(~outside(F.col("ts"), since, until)).groupBy("sys_id").agg(F.count("*").alias("records"), (F.max_by(version, "_arrival") if arrival else F.max(version)).alias("newest"))


def outside(ts: Column, since: str | None, until: str | None) -> Column:
    out = F.lit(False)
    if since:
        out = out | (ts < since)
    if until:
        out = out | (ts > until)
    return out & (F.coalesce(ts, F.lit("")) != "")


def _stale(own: Column, seen: Column) -> Column:
    """Whether the newest version that was seen is older than the table's own; undated ones tell nothing."""
    dated = (own["ts"] != "") & (seen["ts"] != "")
    older = (seen["ts"] < own["ts"]) | ((seen["ts"] == own["ts"]) & (own["mod"] >= 0) & (seen["mod"] >= 0) & (seen["mod"] < own["mod"]))
    return F.coalesce(dated & older, F.lit(False))


def compare(table: DataFrame, dump: DataFrame, *, since: str | None = None, until: str | None = None) -> DataFrame:
    """One row per id of either side: delivered records and whether it is missing, stale, extra or duplicated."""
    t = versions(table).select("sys_id", F.col("newest").alias("own"))
    d = versions(dump, since=since, until=until).select("sys_id", "records", F.col("newest").alias("seen"))
    j = t.join(d, "sys_id", "full_outer")
    return j.select(
        "sys_id", F.coalesce("records", F.lit(0)).alias("records"), F.col("seen").isNull().alias("missing"), F.col("own").isNull().alias("extra"),
        _stale(F.col("own"), F.col("seen")).alias("stale"), (F.coalesce("records", F.lit(0)) > 1).alias("duplicated"),
    )


def digest(ids: DataFrame) -> DataFrame:
    """Order-free digest of a set of ids: SHA-256 of sorted bucket digests.

    Ids are dealt to 65,536 buckets by the first digits of their MD5 and each
    bucket's sorted ids are hashed, so no task holds the whole set; the same set
    always has the same digest.
    """
    b = ids.filter(F.coalesce("sys_id", F.lit("")) != "").select("sys_id").distinct()
    parts = b.groupBy(F.substring(F.md5("sys_id"), 1, 4).alias("b")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("sys_id")), "\n"), 256).alias("h"))
    return parts.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("b", "h"))), lambda x: x["h"]), "\n"), 256).alias("digest"))


def exact_digest(ids: DataFrame) -> DataFrame:
    """SHA-256 of all sorted ids, joined by newlines, as exchanged with other tools.

    That digest is a chain through all ids: they are sorted by ranges, in
    parallel, and stored; one task then reads the ranges in turn and keeps the
    hash's state alone. digest() has no such task.
    """
    ship(ids.sparkSession)
    ordered = cut(ids.filter(F.coalesce("sys_id", F.lit("")) != "").select("sys_id").distinct().orderBy("sys_id"))

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, first = hashlib.sha256(), True
        for b in batches:
            if b.num_rows:
                h.update((b"" if first else b"\n") + "\n".join(b.column(0).to_pylist()).encode())
                first = False
        yield pa.record_batch([pa.array([h.hexdigest()])], ["digest"])

    return ordered.coalesce(1).mapInArrow(chained, "digest string")


def summary(compared: DataFrame, dump: DataFrame, *, since: str | None = None, until: str | None = None) -> DataFrame:
    """One row of counts; loss is what is missing or stale."""
    s = compared.agg(
        F.count_if(~F.col("extra")).alias("table_rows"), F.count_if(~F.col("missing")).alias("dump_unique"), F.count_if("missing").alias("missing"), F.count_if("stale").alias("stale"),
        F.count_if("extra").alias("extra"), F.count_if("duplicated").alias("duplicates"), F.sum(F.greatest(F.col("records") - 1, F.lit(0))).alias("duplicate_records"), (F.count_if("missing") + F.count_if("stale")).alias("loss"),
    )
    ts = F.coalesce(reconcile_timestamp(F.col("ts")), F.lit(""))
    d = dump.agg(F.count("*").alias("dump_lines"), F.count_if((F.coalesce("sys_id", F.lit("")) != "") & outside(ts, since, until)).alias("out_of_window"))
    return s.join(F.broadcast(d), F.lit(True))


def parse_dump(lines: DataFrame) -> DataFrame:
    """The records of a dump's lines (value): sys_id, ts, mod. What is left out, and why, is in files.read_dump."""
    return read_dump(lines).filter("fault IS NULL").drop("fault")


def unwrap_export(lines: DataFrame) -> DataFrame:
    """JSON exports, {"result": [...]} or a bare list a line, to sys_id, ts, mod; cells may be {"value": ...}.

    Blank lines are left out; another line that is no whole export raises, as
    does a document over several lines, which files.read_export is for.
    """
    items = F.coalesce(F.from_json(F.get_json_object("value", "$.result"), "array<map<string,string>>"), F.from_json("value", "array<map<string,string>>"))
    told = lines.filter(F.trim("value") != "")
    rows = told.select(F.explode(F.when(items.isNotNull(), items).otherwise(F.raise_error(F.lit("a line is no whole export")))).alias("r"))

    def cell(name: str) -> Column:
        c = F.col("r")[name]
        return F.when(c.startswith("{"), F.get_json_object(c, "$.value")).otherwise(c)

    return rows.select(F.lower(F.trim(cell("sys_id"))).alias("sys_id"), cell("sys_updated_on").alias("ts"), cell("sys_mod_count").alias("mod")).filter(is_id(F.col("sys_id")))


# --- a comparison whose counts come with it

#: Begins the keys of rows that only count what was left out; no id does.
_MARK = "#"


def audit(table: DataFrame, dump: DataFrame, *, since: str | None = None, until: str | None = None) -> DataFrame:
    """compare(), and with it how many rows of either side were left out: kind is null for ids, else why.

    table and dump have sys_id, ts and mod and may have a fault. What is skipped,
    has no id or lies outside of the window is counted in the same aggregate
    that finds each id's newest version, under a key of its own, so either side
    is read once, and a repeated task counts nothing twice. Its rows are stored.
    """

    def side(df: DataFrame, windowed: bool) -> DataFrame:
        fault = F.col("fault") if "fault" in df.columns else F.lit(None).cast("string")
        ts, mod = F.coalesce(reconcile_timestamp(F.col("ts")), F.lit("")).alias("ts"), version_number(F.col("mod")).alias("mod")
        r = df.select("sys_id", ts, mod, fault.alias("fault"))
        why = F.when(F.col("fault").isNotNull(), F.col("fault")).when(F.coalesce("sys_id", F.lit("")) == "", "no_id")
        why = why.when(outside(F.col("ts"), since, until), "out_of_window") if windowed else why
        key = F.coalesce(F.concat(F.lit(_MARK), why), F.col("sys_id"))
        return r.groupBy(key.alias("key")).agg(F.count("*").alias("records"), F.max(F.struct("ts", "mod")).alias("newest"))

    t = side(table, False).select("key", F.col("records").alias("own_records"), F.col("newest").alias("own"))
    d = side(dump, True).select("key", "records", F.col("newest").alias("seen"))
    j = t.join(d, "key", "full_outer")
    marked = F.col("key").startswith(_MARK)
    own, seen, records = F.col("own"), F.col("seen"), F.coalesce("records", F.lit(0))
    return cut(j.select(
        F.when(~marked, F.col("key")).alias("sys_id"), F.when(marked, F.substr("key", F.lit(2))).alias("kind"), F.coalesce("own_records", F.lit(0)).alias("own_records"), records.alias("records"),
        (~marked & seen.isNull()).alias("missing"), (~marked & own.isNull()).alias("extra"), (~marked & _stale(own, seen)).alias("stale"), (~marked & (records > 1)).alias("duplicated"),
    ))


def audit_summary(audited: DataFrame) -> DataFrame:
    """The counts of an audit, as one row: those of summary(), and what was left out of either side."""

    def left_out(kind: str, side: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col(side))), F.lit(0))

    ids = F.col("kind").isNull()
    return audited.agg(
        F.count_if(ids & ~F.col("extra")).alias("table_rows"), F.count_if(ids & ~F.col("missing")).alias("dump_unique"), F.count_if("missing").alias("missing"), F.count_if("stale").alias("stale"), F.count_if("extra").alias("extra"),
        F.count_if("duplicated").alias("duplicates"), F.coalesce(F.sum(F.when(ids, F.greatest(F.col("records") - 1, F.lit(0)))), F.lit(0)).alias("duplicate_records"), (F.count_if("missing") + F.count_if("stale")).alias("loss"),
        (F.coalesce(F.sum("records"), F.lit(0)) - left_out(SKIPPED, "records")).alias("dump_lines"), left_out("out_of_window", "records").alias("out_of_window"), left_out(SKIPPED, "records").alias("unparsable_lines"), left_out(SKIPPED, "own_records").alias("unparsable_rows"),
    )


# --- reconciliation by a tree of digests

#: Hexadecimal digits of an id's digest that name a leaf; each node has a node for each digit below it.
LEVELS = 4
_SUMS = ("n", "s0", "s1", "s2", "s3")


def _leaf(c: Column | str) -> Column:
    return F.substring(F.md5(c), 1, LEVELS)


def digest_tree(rows: DataFrame) -> DataFrame:
    """A tree of digests of rows (sys_id, ts, mod): level, node, and sums that two equal sets of rows have in common.

    A leaf's sums are those of four parts of its rows' hashes and their number.
    Sums of sums are the nodes above, so a tree costs one aggregate in which each
    task sends a row for each leaf at most, however the ids are spread, and it
    can be stored, or put together from trees of parts. Rows without an id don't
    count; version cells count as compare() reads them.
    """
    ts, mod = F.coalesce(reconcile_timestamp(F.col("ts")), F.lit("")), version_number(F.col("mod"))
    one, two = F.xxhash64("sys_id", ts, mod), F.xxhash64(F.lit("second"), "sys_id", ts, mod)
    halves = {f"s{i}": x for i, x in enumerate((F.shiftrightunsigned(one, 33), one.bitwiseAND(0x7FFFFFFF), F.shiftrightunsigned(two, 33), two.bitwiseAND(0x7FFFFFFF)))}
    r = rows.filter(F.coalesce("sys_id", F.lit("")) != "").select(_leaf("sys_id").alias("leaf"), *(c.alias(k) for k, c in halves.items()))
    leaves = r.groupBy("leaf").agg(F.count("*").alias("n"), *(F.sum(k).alias(k) for k in halves))
    above = leaves.select(F.explode(F.sequence(F.lit(0), F.lit(LEVELS))).alias("level"), "*")
    return above.groupBy("level", F.substr("leaf", F.lit(1), F.col("level")).alias("node")).agg(*(F.sum(c).alias(c) for c in _SUMS))


def differing(one: DataFrame, two: DataFrame) -> DataFrame:
    """The leaves in which two trees differ: level by level, only the children of nodes that differ are compared."""
    nodes = None
    for level in range(LEVELS + 1):
        a, b = (t.filter(F.col("level") == level).select("node", F.struct(*_SUMS).alias(f"sums{i}")) for i, t in enumerate((one, two)))
        if nodes is not None:
            parent = F.substring("node", 1, level - 1)
            a, b = (t.join(nodes, parent == F.col("parent"), "left_semi") for t in (a, b))
        nodes = cut(a.join(b, "node", "full_outer").filter(~F.col("sums0").eqNullSafe(F.col("sums1"))).select(F.col("node").alias("parent")))
    return nodes.select(F.col("parent").alias("leaf"))


def drilldown(table: DataFrame, dump: DataFrame, trees: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """The ids that compare() has something to say of, at the cost of what differs.

    table has one row for each id. Only rows in leaves whose digests differ are
    joined; trees, if they are stored, spare the pass over either side that
    makes them. A dump that delivers each row once in its newest version joins
    nothing.
    """
    leaves = small(differing(*(trees or (cut(digest_tree(table)), cut(digest_tree(dump))))))
    rest = [df.join(leaves, _leaf("sys_id") == F.col("leaf"), "left_semi") for df in (table, dump)]
    return compare(*rest).filter("missing OR extra OR stale OR duplicated")


def evidence(compared: DataFrame, summed: DataFrame, *, cap: int = 100) -> DataFrame:
    """One JSON row: exact counts, and the first ids of each finding, at most cap of them.

    The lists are a report's samples, each a top-k by id. All four come from one
    pass; compared should be stored if other results are taken from it too.
    """
    kinds = ("missing", "stale", "extra", "duplicated")
    found = compared.select("sys_id", F.explode(F.array_compact(F.array(*(F.when(F.col(k), k) for k in kinds)))).alias("kind"))
    first = found.withColumn("n", F.row_number().over(W.partitionBy("kind").orderBy("sys_id"))).filter(F.col("n") <= cap)  # each task keeps cap rows a kind
    lists = first.agg(*(F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.col("sys_id")))).alias(f"{k}_ids") for k in kinds))
    out = summed.join(F.broadcast(lists), F.lit(True))
    return out.select(F.to_json(F.struct(*out.columns)).alias("report"))
