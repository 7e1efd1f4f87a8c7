"""Queries of reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import reconcile as rc
from ..sources import files
from ..workers import cut, new_path
from .base import DUMP, ISSUE, Catalogue, dump, issue

Q = Catalogue()
_SINCE, _UNTIL = "1990-06-01 00:00:00", "1998-01-01 00:00:00"


def _table(spark, sf_dir):
    return issue(spark, sf_dir).select("sys_id", F.date_format("sys_updated_on", "yyyy-MM-dd HH:mm:ss").alias("ts"), F.col("sys_mod_count").alias("mod"))


def _compared(spark, sf_dir):
    return rc.compare(_table(spark, sf_dir), dump(spark, sf_dir))


_NEW = f"""{ISSUE}, {DUMP}, own AS (SELECT sys_id, strftime(sys_updated_on, '%Y-%m-%d %H:%M:%S') AS ts, sys_mod_count AS "mod" FROM issue),
 seen AS (SELECT sys_id, count(*) AS records, max(ts) AS ts, arg_max("mod", (ts, "mod")) AS "mod" FROM dump GROUP BY sys_id)"""


@Q(f"WITH {_NEW} SELECT sys_id FROM own WHERE sys_id NOT IN (SELECT sys_id FROM seen)")
def recon_missing(spark, sf_dir):
    return _compared(spark, sf_dir).filter("missing").select("sys_id")


@Q(f"WITH {_NEW} SELECT sys_id FROM seen WHERE sys_id NOT IN (SELECT sys_id FROM own)")
def recon_extra(spark, sf_dir):
    return _compared(spark, sf_dir).filter("extra").select("sys_id")


@Q(f'WITH {_NEW} SELECT own.sys_id FROM own JOIN seen ON own.sys_id = seen.sys_id WHERE seen.ts < own.ts OR (seen.ts = own.ts AND seen."mod" < own."mod")')
def recon_stale(spark, sf_dir):
    return _compared(spark, sf_dir).filter("stale").select("sys_id")


@Q(f"WITH {_NEW} SELECT sys_id, records FROM seen WHERE records > 1")
def recon_duplicates(spark, sf_dir):
    return _compared(spark, sf_dir).filter("duplicated").select("sys_id", "records")


@Q(f'WITH {_NEW} SELECT sys_id, ts, "mod" FROM seen')
def recon_newest(spark, sf_dir):
    return rc.versions(dump(spark, sf_dir)).select("sys_id", "newest.ts", "newest.mod")


@Q(f"WITH {_NEW} SELECT sha256(string_agg(sys_id, chr(10) ORDER BY sys_id)) AS digest FROM own")
def recon_digest(spark, sf_dir):
    return rc.exact_digest(_table(spark, sf_dir))


@Q(f"WITH {_NEW}, b AS (SELECT substr(md5(sys_id), 1, 4) AS b, sha256(string_agg(sys_id, chr(10) ORDER BY sys_id)) AS h FROM (SELECT DISTINCT sys_id FROM own) GROUP BY 1) SELECT sha256(string_agg(h, chr(10) ORDER BY b)) AS digest FROM b")
def recon_bucket_digest(spark, sf_dir):
    """The form without a single large group; equal sets give equal digests."""
    return rc.digest(_table(spark, sf_dir))


@Q(f"""WITH {_NEW}, r AS (SELECT sys_id, ts, "mod", row_number() OVER (ORDER BY sys_id, ts DESC, "mod") AS arrival FROM dump) SELECT sys_id, count(*) AS records, arg_max(ts, arrival) AS ts FROM r GROUP BY sys_id""")
def recon_last_read(spark, sf_dir):
    """Of repeated ids the row that was read last counts, here the oldest one."""
    d = dump(spark, sf_dir)
    order = F.struct(F.col("ts").substr(1, 0).alias("same"), -F.unix_timestamp(F.col("ts").cast("timestamp")), F.col("mod"))
    return rc.versions(d.withColumn("arrival", order), arrival="arrival").select("sys_id", "records", "newest.ts")


@Q(f"""WITH {ISSUE}, {DUMP}, own AS (SELECT sys_id, strftime(sys_updated_on, '%Y-%m-%d %H:%M:%S') AS ts, sys_mod_count AS "mod" FROM issue),
 d AS (SELECT * FROM dump WHERE ts BETWEEN '{_SINCE}' AND '{_UNTIL}'), seen AS (SELECT sys_id, count(*) AS records, max(ts) AS ts, arg_max("mod", (ts, "mod")) AS "mod" FROM d GROUP BY sys_id),
 j AS (SELECT own.sys_id AS o, seen.sys_id AS s, records, seen.ts < own.ts OR (seen.ts = own.ts AND seen."mod" < own."mod") AS stale FROM own FULL JOIN seen ON own.sys_id = seen.sys_id)
 SELECT count(o) AS table_rows, count(s) AS dump_unique, count_if(s IS NULL) AS missing, count_if(coalesce(stale, false)) AS stale, count_if(o IS NULL) AS extra, count_if(records > 1) AS duplicates,
 CAST(sum(CASE WHEN records > 1 THEN records - 1 ELSE 0 END) AS BIGINT) AS duplicate_records, count_if(s IS NULL) + count_if(coalesce(stale, false)) AS loss, (SELECT count(*) FROM dump) AS dump_lines, (SELECT count(*) FROM dump WHERE ts < '{_SINCE}' OR ts > '{_UNTIL}') AS out_of_window FROM j""")
def recon_summary(spark, sf_dir):
    d = cut(dump(spark, sf_dir))  # read once: three parts of the result come from it
    return rc.summary(rc.compare(_table(spark, sf_dir), d, since=_SINCE, until=_UNTIL), d, since=_SINCE, until=_UNTIL)


def _lines(spark, sf_dir):
    """The dump as another tool wrote it: quotes, a header, comments, nulls, carriage returns, and lines that are no records."""
    d = dump(spark, sf_dir).withColumn("n", F.conv(F.substring("sys_id", 2, 31), 16, 10).cast("bigint"))
    ts, mod = F.when(F.col("n") % 7 == 0, "null").otherwise(F.col("ts")), F.when(F.col("n") % 5 == 0, "null").when(F.col("n") % 6 == 0, "").otherwise(F.col("mod").cast("string"))
    quoted = F.concat_ws("\t", F.concat(F.lit('"'), "sys_id", F.lit('"')), F.concat(F.lit('"'), ts, F.lit('"')), mod)
    line = F.when(F.col("n") % 3 == 0, F.concat(quoted, F.lit("\r"))).when(F.col("n") % 11 == 1, F.col("sys_id")).otherwise(F.concat_ws("\t", F.concat(F.lit(" "), "sys_id"), ts, mod))
    more = F.when(F.col("n") % 13 == 0, F.array(line, F.lit("null\t\t"), F.lit(" "), F.lit("# a comment"), F.lit("sys_id\tts\tmod"), F.concat(F.lit("bad"), F.col("n").cast("string"), F.lit("\t1")))).otherwise(F.array(line))
    path = new_path(spark, "dump")
    d.select(F.explode(more).alias("value")).write.text(path)
    return spark.read.text(path)


_LINES = f"""{_NEW}, x AS (SELECT sys_id, ts, "mod", CAST(concat('0x', substr(sys_id, 2)) AS BIGINT) AS n FROM dump),
 lines AS (SELECT sys_id, CASE WHEN n % 7 = 0 OR (n % 3 <> 0 AND n % 11 = 1) THEN NULL ELSE ts END AS ts, CASE WHEN n % 5 = 0 OR n % 6 = 0 OR (n % 3 <> 0 AND n % 11 = 1) THEN NULL ELSE CAST("mod" AS VARCHAR) END AS "mod", n FROM x)"""


@Q(f'WITH {_LINES} SELECT sys_id, ts, "mod", CAST(NULL AS VARCHAR) AS fault FROM lines UNION ALL SELECT NULL, NULL, NULL, \'skipped\' FROM lines WHERE n % 13 = 0')
def dump_parse(spark, sf_dir):
    return files.read_dump(_lines(spark, sf_dir))


#: Keys of one exported document.
_DOCUMENT = 20_000


def _export(spark, sf_dir):
    """The table as pretty-printed documents of one JSON list each, the first of whose elements has no usable id."""
    i = issue(spark, sf_dir)
    stamp = F.date_format("sys_updated_on", "yyyy-MM-dd HH:mm:ss")
    row = F.struct("sys_id", F.struct(F.lit('a "}{" b').alias("display_value"), stamp.alias("value")).alias("sys_updated_on"), F.col("sys_mod_count").cast("string").alias("sys_mod_count"), F.lit("}, {\\").alias("text"))
    part = F.floor(F.col("number") / _DOCUMENT).alias("part")
    rows = i.select(part, F.lit(1).alias("at"), F.concat(F.lit(","), F.to_json(row, {"pretty": "true"})).alias("value"))
    heads, ends = (i.select(part).distinct().select("part", F.lit(at).alias("at"), F.lit(text).alias("value")) for at, text in ((0, '{"result": ["none"'), (2, "]}")))
    path = new_path(spark, "export")
    rows.union(heads).union(ends).repartition("part").sortWithinPartitions("part", "at").select("part", "value").write.partitionBy("part").text(path)
    return files.read_export(spark, path)


@Q(f"""WITH {ISSUE} SELECT sys_id, strftime(sys_updated_on, '%Y-%m-%d %H:%M:%S') AS ts, CAST(sys_mod_count AS VARCHAR) AS "mod", CAST(NULL AS VARCHAR) AS fault FROM issue
 UNION ALL SELECT NULL, NULL, NULL, 'skipped' FROM (SELECT DISTINCT number // {_DOCUMENT} FROM issue)""")
def export_unwrap(spark, sf_dir):
    return _export(spark, sf_dir)


@Q(f"""WITH {_LINES}, d AS (SELECT * FROM lines WHERE ts IS NULL OR ts BETWEEN '{_SINCE}' AND '{_UNTIL}'),
 k AS (SELECT sys_id, count(*) AS records, max((coalesce(ts, ''), CAST(coalesce("mod", '-1') AS BIGINT))) AS v FROM d GROUP BY sys_id),
 j AS (SELECT own.sys_id AS o, k.sys_id AS s, records, v[1] <> '' AND (v[1] < own.ts OR (v[1] = own.ts AND v[2] >= 0 AND v[2] < own."mod")) AS stale FROM own FULL JOIN k ON own.sys_id = k.sys_id)
 SELECT count(o) AS table_rows, count(s) AS dump_unique, count_if(s IS NULL) AS missing, count_if(coalesce(stale, false)) AS stale, count_if(o IS NULL) AS extra, count_if(records > 1) AS duplicates,
 CAST(sum(CASE WHEN records > 1 THEN records - 1 ELSE 0 END) AS BIGINT) AS duplicate_records, count_if(s IS NULL) + count_if(coalesce(stale, false)) AS loss, (SELECT count(*) FROM lines) AS dump_lines,
 (SELECT count(*) FROM lines WHERE ts < '{_SINCE}' OR ts > '{_UNTIL}') AS out_of_window, (SELECT count(*) FROM lines WHERE n % 13 = 0) AS unparsable_lines, (SELECT count(DISTINCT number // {_DOCUMENT}) FROM issue) AS unparsable_rows FROM j""")
def recon_audit(spark, sf_dir):
    """Both sides from files, each read once; what was left out is counted on the way."""
    return rc.audit_summary(rc.audit(_export(spark, sf_dir), files.read_dump(_lines(spark, sf_dir)), since=_SINCE, until=_UNTIL))


@Q(f"""WITH {_NEW}, j AS (SELECT coalesce(own.sys_id, seen.sys_id) AS sys_id, seen.sys_id IS NULL AS missing, own.sys_id IS NULL AS extra, coalesce(seen.ts < own.ts OR (seen.ts = own.ts AND seen."mod" < own."mod"), false) AS stale,
 coalesce(records, 0) > 1 AS duplicated FROM own FULL JOIN seen ON own.sys_id = seen.sys_id) SELECT * FROM j WHERE missing OR extra OR stale OR duplicated""")
def recon_drilldown(spark, sf_dir):
    """What a full comparison finds, from the leaves of two digest trees that differ."""
    return rc.drilldown(_table(spark, sf_dir), dump(spark, sf_dir)).drop("records")


@Q(f"WITH {_NEW} SELECT count(*) AS missing, min(sys_id) AS first FROM own WHERE sys_id NOT IN (SELECT sys_id FROM seen)")
def evidence_report(spark, sf_dir):
    d = cut(dump(spark, sf_dir))
    c = cut(rc.compare(_table(spark, sf_dir), d))
    r = rc.evidence(c, rc.summary(c, d))
    return r.select(F.get_json_object("report", "$.missing").cast("bigint").alias("missing"), F.get_json_object("report", "$.missing_ids[0]").alias("first"))
