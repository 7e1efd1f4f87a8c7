"""Queries of routing, operations, change application, outcomes and offsets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import change as ch
from ..plans import keyset
from ..workers import cut
from .base import CHANGES, ISSUE, Catalogue, changes, hex_id, issue, placed, table

Q = Catalogue()
_C = f"WITH {CHANGES} SELECT"


@Q(f"{_C} \"offset\", 'incident' AS \"table\" FROM changes")
def route_fixed(spark, sf_dir):
    return changes(spark, sf_dir).select("offset", ch.route_fixed("incident").alias("table"))


@Q(f"{_C} \"offset\", CASE topic WHEN 'view' THEN 'u_view' WHEN 'click' THEN 'u_click' END AS \"table\", CASE WHEN topic NOT IN ('view', 'click') THEN concat('no table for topic ', topic) END AS error FROM changes")
def route_topic_map(spark, sf_dir):
    t, e = ch.route_topic(F.col("topic"), {"view": "u_view", "click": "u_click"})
    return changes(spark, sf_dir).select("offset", t.alias("table"), e.alias("error"))


@Q("SELECT o_orderkey, concat('a', lpad(lower(hex(o_orderkey)), 31, '0')) AS id FROM orders")
def id_normalise(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", text.normalise_id(F.concat(F.lit(" "), F.upper(hex_id("o_orderkey")), F.lit(" "))).alias("id"))


@Q(f"{_C} \"offset\", coalesce(op, 'PUT') AS op FROM changes")
def op_fixed(spark, sf_dir):
    o, _ = ch.resolve_operation(F.col("op"), mode="fixed", fixed="PUT")
    return changes(spark, sf_dir).select("offset", o.alias("op"))


@Q(f"{_C} \"offset\", CASE WHEN op IS NOT NULL THEN op WHEN \"offset\" % 2 = 0 THEN 'DELETE' WHEN \"offset\" % 3 = 0 THEN 'CREATE' ELSE 'PATCH' END AS op FROM changes")
def op_infer(spark, sf_dir):
    o, _ = ch.resolve_operation(F.col("op"), value_is_null=F.col("offset") % 2 == 0, sys_id=F.when(F.col("offset") % 3 != 0, F.col("id")))
    return changes(spark, sf_dir).select("offset", o.alias("op"))


@Q(f"{_C} \"offset\", CASE WHEN op IN ('PATCH', 'PUT', 'DELETE') AND \"offset\" % 3 = 0 THEN concat(op, ' needs an id') WHEN op <> 'DELETE' AND \"offset\" % 2 = 0 THEN concat(op, ' needs a value') END AS error FROM changes")
def op_check(spark, sf_dir):
    e = ch.check_operation(F.col("op"), F.when(F.col("offset") % 3 != 0, F.col("id")), F.col("offset") % 2 == 0)
    return changes(spark, sf_dir).select("offset", e.alias("error"))


_FIELDS = ["state", "priority"]


def _target(spark, sf_dir):
    return issue(spark, sf_dir).select("sys_id", "sys_mod_count", "sys_updated_on", *_FIELDS)


def _renamed():
    """Every fourth key is unknown to the table, the others are those of its rows."""
    return F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit("f"), F.substring(hex_id("o_orderkey"), 2, 31))).otherwise(hex_id("o_orderkey"))


def _batch(spark, sf_dir, op: str, sys_id=None):
    """One change for each order."""
    o = table(spark, sf_dir, "orders")
    at = F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")
    return o.select((_renamed() if sys_id is None else sys_id).alias("sys_id"), F.lit(op).alias("op"), F.col("o_orderkey").alias("order"), at.alias("at"), F.create_map(F.lit("state"), F.concat(F.lit("X"), (F.col("o_orderkey") % 7).cast("string"))).alias("body"))


def _apply(op: str, **how):
    def run(spark, sf_dir):
        live, _ = ch.apply_changes(_target(spark, sf_dir), _batch(spark, sf_dir, op), _FIELDS, **how)
        return live

    return run


_T = f"{ISSUE}, b AS (SELECT CASE WHEN number % 4 = 0 THEN concat('f', substr(sys_id, 2, 31)) ELSE sys_id END AS sys_id, number, concat('X', number % 7) AS x FROM issue)"
_AT = "TIMESTAMP '2026-01-01'"


def _changed(state: str, priority: str) -> str:
    return f"""WITH {_T} SELECT t.sys_id, CASE WHEN b.sys_id IS NULL THEN sys_mod_count ELSE sys_mod_count + 1 END AS sys_mod_count, CASE WHEN b.sys_id IS NULL THEN sys_updated_on ELSE {_AT} END AS sys_updated_on,
 CASE WHEN b.sys_id IS NULL THEN state ELSE {state} END AS state, CASE WHEN b.sys_id IS NULL THEN priority ELSE {priority} END AS priority FROM issue t LEFT JOIN b ON t.sys_id = b.sys_id"""


_NEW = f"SELECT sys_id, 0, {_AT}, x, '' FROM b WHERE number % 4 = 0"
_ISSUE = "SELECT sys_id, sys_mod_count, sys_updated_on, state, priority FROM issue"
Q.add("apply_create", _apply("CREATE"), f"WITH {_T} {_ISSUE} UNION ALL {_NEW}")
Q.add("apply_patch", _apply("PATCH"), _changed("x", "priority"))
Q.add("apply_put", _apply("PUT"), _changed("x", "''"))
Q.add("apply_delete", _apply("DELETE"), f"WITH {_T} {_ISSUE} WHERE number % 4 = 0")
Q.add("apply_patch_or_create", _apply("PATCH", not_found="create"), _changed("x", "priority") + f" UNION ALL {_NEW}")


@Q(f"WITH {_T} SELECT sys_id, number AS \"order\", 'not found' AS reason FROM b WHERE number % 4 = 0")
def apply_rejected(spark, sf_dir):
    _, rejected = ch.apply_changes(_target(spark, sf_dir), _batch(spark, sf_dir, "PATCH"), _FIELDS)
    return rejected.select("sys_id", "order", "reason")


@Q(f"WITH {_T} SELECT md5(concat('{{\"order\":', number, '}}')) AS sys_id, 0 AS sys_mod_count, x AS state FROM b UNION ALL SELECT sys_id, sys_mod_count, state FROM issue")
def apply_create_without_id(spark, sf_dir):
    """Every record makes a row of its own, with an id that its coordinates give."""
    live, _ = ch.apply_changes(_target(spark, sf_dir), _batch(spark, sf_dir, "CREATE", F.lit(None).cast("string")), _FIELDS)
    return live.select("sys_id", "sys_mod_count", "state")


@Q("SELECT o_orderkey AS \"order\", 'no id' AS reason FROM orders")
def apply_update_without_id(spark, sf_dir):
    _, rejected = ch.apply_changes(_target(spark, sf_dir), _batch(spark, sf_dir, "PATCH", F.lit("")), _FIELDS, not_found="create")
    return rejected.select("order", "reason")


@Q(f"""WITH {_T} SELECT b.sys_id, {_AT} AS sys_updated_on, CASE WHEN number % 4 = 0 THEN {_AT} ELSE TIMESTAMP '2020-01-01' END AS sys_created_on, CASE WHEN number % 4 = 0 THEN 'me' ELSE 'them' END AS sys_created_by, 'me' AS sys_updated_by FROM b
 UNION ALL SELECT sys_id, sys_updated_on, TIMESTAMP '2020-01-01', 'them', 'them' FROM issue WHERE number % 4 = 0""")
def apply_system_fields(spark, sf_dir):
    old = {"sys_created_on": F.lit("2020-01-01 00:00:00").cast("timestamp_ntz"), "sys_created_by": F.lit("them"), "sys_updated_by": F.lit("them")}
    live, _ = ch.apply_changes(_target(spark, sf_dir).withColumns(old), _batch(spark, sf_dir, "PATCH"), _FIELDS, not_found="create", user="me")
    return live.select("sys_id", "sys_updated_on", *old)


@Q("SELECT concat('a', lpad(lower(hex(user_id)), 31, '0')) AS sys_id, count(*) - 1 AS sys_mod_count, max(date_trunc('second', ts))::TIMESTAMP IS NOT NULL AS dated, CAST(arg_max(event_id, event_id) AS VARCHAR) AS seq FROM events GROUP BY 1")
def apply_fold(spark, sf_dir):
    """Many changes to one key in one batch: applied in order, the last wins, each counts."""
    c = changes(spark, sf_dir)
    batch = c.select(F.col("id").alias("sys_id"), F.lit("PATCH").alias("op"), F.col("offset").alias("order"), "at", F.create_map(F.lit("seq"), F.col("offset").cast("string")).alias("body"))
    none = spark.createDataFrame([], "sys_id string, sys_mod_count bigint, sys_updated_on timestamp_ntz, seq string")
    live, _ = ch.apply_changes(none, batch, ["seq"], not_found="create")
    return live.select("sys_id", "sys_mod_count", F.col("sys_updated_on").isNotNull().alias("dated"), "seq")


for _policy, _sql in (("fail", "'NOT_FOUND'"), ("ignore", "'IGNORED'"), ("create", "CASE WHEN op = 'DELETE' THEN 'IGNORED' ELSE 'CREATED' END")):

    def _missing(spark, sf_dir, policy=_policy):
        gone = F.when(F.col("offset") % 7 == 0, F.concat(F.lit("b"), F.substring("id", 2, 31))).otherwise(F.col("id"))  # every seventh names a row that isn't there
        c = changes(spark, sf_dir).select("offset", gone.alias("sys_id"), "op")
        return ch.resolve_missing(c, _target(spark, sf_dir), policy=policy).select("offset", "op", "outcome")

    Q.add(f"notfound_{_policy}", _missing, f"WITH {CHANGES}, {ISSUE} SELECT \"offset\", op, {_sql} AS outcome FROM changes WHERE op IN ('PATCH', 'PUT', 'DELETE') AND CASE WHEN \"offset\" % 7 = 0 THEN concat('b', substr(id, 2)) ELSE id END NOT IN (SELECT sys_id FROM issue)")


@Q(f"""WITH {ISSUE}, f AS (SELECT caller, count(*) AS n, min(sys_id) AS id FROM issue GROUP BY caller)
 SELECT c_custkey, CASE WHEN c_custkey % 50 = 0 THEN 'RECORD_ERROR' WHEN n IS NULL THEN 'CREATE' WHEN n = 1 THEN 'PATCH' ELSE 'AMBIGUOUS' END AS resolved, CASE WHEN c_custkey % 50 <> 0 AND n = 1 THEN id END AS target_id FROM customer LEFT JOIN f ON caller = c_custkey AND c_custkey % 50 <> 0""")
def correlation_lookup(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 50 != 0, F.col("c_custkey")).alias("caller"))
    return ch.correlate(c, issue(spark, sf_dir), "caller").select("c_custkey", "resolved", "target_id")


def _outcomes(spark, sf_dir):
    """What became of each change: some failed in each of several ways, some lost fields."""
    n = F.col("offset")
    status = F.when(n % 401 == 0, 503).when(n % 97 == 0, 403).when(n % 89 == 0, 404).when(n % 83 == 0, 409).when(n % 79 == 0, 400).otherwise(200)
    c = changes(spark, sf_dir).withColumn("op", F.coalesce("op", F.lit("PATCH"))).withColumn("status", status)
    failed = F.col("status") >= 400
    return c.select(
        "topic", "partition", "offset", "op", F.lit("issue").alias("table"), F.col("id").alias("sys_id"), "status", F.when(failed, text.classify(F.col("status"), exhausted=F.col("status") == 503)).alias("classification"),
        F.when(F.col("status") == 503, 4).otherwise(0).alias("retries"), F.when(failed, F.lit('{"token":"abc","note":1}')).alias("response"), F.when(failed, F.concat(F.lit("HTTP "), F.col("status").cast("string"))).alias("message"),
        F.when(n % 10 == 0, F.array(F.lit("u_x"))).otherwise(F.array().cast("array<string>")).alias("dropped"),
    )


_O = f"""{CHANGES}, outcomes AS (SELECT topic, partition, "offset", coalesce(op, 'PATCH') AS op, id AS sys_id, status, CASE status WHEN 503 THEN 'RETRIES_EXHAUSTED' WHEN 403 THEN 'PERMISSION' WHEN 404 THEN 'NOT_FOUND' WHEN 409 THEN 'CONFLICT' WHEN 400 THEN 'RECORD_ERROR' END AS classification
 FROM (SELECT *, CASE WHEN "offset" % 401 = 0 THEN 503 WHEN "offset" % 97 = 0 THEN 403 WHEN "offset" % 89 = 0 THEN 404 WHEN "offset" % 83 = 0 THEN 409 WHEN "offset" % 79 = 0 THEN 400 ELSE 200 END AS status FROM changes))"""


@Q(f'WITH {_O} SELECT "offset", status, classification FROM outcomes')
def classify_outcome(spark, sf_dir):
    return _outcomes(spark, sf_dir).select("offset", "status", "classification")


@Q(f'WITH {CHANGES} SELECT topic, partition, "offset", row_number() OVER (PARTITION BY topic, partition ORDER BY "offset") AS place, 1 AS tasks FROM changes')
def lane_order(spark, sf_dir):
    """A row's place in its lane is read off the place that it has after lane_order(), and a lane must lie in one task."""
    rows = cut(ch.lane_order(changes(spark, sf_dir), 4).select("topic", "partition", "offset", F.monotonically_increasing_id().alias("at")))
    lanes = rows.groupBy("topic", "partition").agg(F.min("at").alias("first"), F.countDistinct(F.shiftright("at", 33)).cast("int").alias("tasks"))
    return rows.join(lanes, ["topic", "partition"]).select("topic", "partition", "offset", (F.col("at") - F.col("first") + 1).alias("place"), "tasks")


@Q(f'WITH {CHANGES} SELECT "offset", row_number() OVER (ORDER BY "offset") AS place FROM changes')
def outcomes_in_input_order(spark, sf_dir):
    return placed(ch.in_input_order(changes(spark, sf_dir).repartition(5, "topic"), "offset").select("offset"))


@Q(f"WITH {_O} SELECT topic, partition, \"offset\", NOT coalesce(max(CASE WHEN classification = 'RETRIES_EXHAUSTED' THEN 1 ELSE 0 END) OVER (PARTITION BY topic, partition ORDER BY \"offset\" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) = 1, false) AS attempted FROM outcomes")
def lane_stop(spark, sf_dir):
    stops = F.coalesce(F.col("classification") == "RETRIES_EXHAUSTED", F.lit(False))
    return ch.with_lane_stop(_outcomes(spark, sf_dir), stops).select("topic", "partition", "offset", "attempted")


@Q(f'WITH {_O} SELECT topic, partition, max("offset") + 1 AS next_offset FROM outcomes WHERE classification IS NULL GROUP BY topic, partition')
def completed_offsets(spark, sf_dir):
    return ch.completed_offsets(_outcomes(spark, sf_dir).filter("classification is null"))


@Q(f'WITH {_O}, d AS (SELECT topic, partition, max("offset") + 1 AS n FROM outcomes WHERE classification IS NULL GROUP BY topic, partition), p AS (SELECT topic, partition, max("offset") - 100 AS position FROM outcomes WHERE partition <> 3 GROUP BY topic, partition) SELECT topic, partition, least(n, position) AS "commit" FROM d JOIN p USING (topic, partition)')
def commit_offsets(spark, sf_dir):
    o = _outcomes(spark, sf_dir)
    position = o.filter("partition != 3").groupBy("topic", "partition").agg((F.max("offset") - 100).alias("position"))
    return ch.commit_offsets(ch.completed_offsets(o.filter("classification is null")), position)


@Q(f"WITH {_O} SELECT count_if(classification IS NOT NULL) AS failures, count_if(classification = 'RETRIES_EXHAUSTED') AS retryable, (SELECT topic FROM outcomes WHERE classification IS NOT NULL ORDER BY topic, partition, \"offset\" LIMIT 1) AS first_topic, (SELECT \"offset\" FROM outcomes WHERE classification IS NOT NULL ORDER BY topic, partition, \"offset\" LIMIT 1) AS first_offset, 'retry' AS verdict FROM outcomes")
def batch_verdict(spark, sf_dir):
    return ch.batch_verdict(_outcomes(spark, sf_dir))


@Q(f'WITH {_O} SELECT sys_id AS key, op AS operation, status, "offset" FROM outcomes WHERE classification IS NULL')
def report_success(spark, sf_dir):
    r = ch.report(_outcomes(spark, sf_dir), "success")
    return r.select("key", F.get_json_object("value", "$.operation").alias("operation"), F.get_json_object("value", "$.status").cast("int").alias("status"), F.get_json_object("value", "$.source.offset").cast("bigint").alias("offset"))


@Q(f"""WITH {_O} SELECT sys_id AS key, classification, '{{"token":"***","note":1}}' AS excerpt, "offset", concat(topic, '/', partition, '/', "offset") AS place FROM outcomes WHERE classification IS NOT NULL""")
def report_error(spark, sf_dir):
    r = ch.report(_outcomes(spark, sf_dir), "error")
    place = F.concat_ws("/", *(F.col("headers")[c] for c in ("topic", "partition", "offset")))
    return r.select("key", place.alias("place"), F.col("headers")["classification"].alias("classification"), F.get_json_object("value", "$.response_excerpt").alias("excerpt"), "offset")


@Q(f'WITH {_O} SELECT sys_id AS key, \'["u_x"]\' AS dropped, "offset" FROM outcomes WHERE "offset" % 10 = 0')
def report_dropped_fields(spark, sf_dir):
    return ch.report(_outcomes(spark, sf_dir), "dropped").select("key", F.get_json_object("value", "$.dropped").alias("dropped"), "offset")


@Q(f"""WITH {_O} SELECT count_if(op = 'CREATE' AND classification IS NULL) AS "create", count_if(op = 'PATCH' AND classification IS NULL) AS patch, count_if(op = 'PUT' AND classification IS NULL) AS put, count_if(op = 'DELETE' AND classification IS NULL) AS "delete",
 count_if(classification = 'RECORD_ERROR') AS record_error, count_if(classification = 'PERMISSION') AS permission, count_if(classification = 'NOT_FOUND') AS not_found, count_if(classification = 'CONFLICT') AS conflict, count_if(classification = 'AMBIGUOUS') AS ambiguous, count_if(classification = 'RETRIES_EXHAUSTED') AS retries_exhausted FROM outcomes""")
def writer_metrics(spark, sf_dir):
    return ch.writer_metrics(_outcomes(spark, sf_dir))


@Q("SELECT event_type AS source, count(*) AS emitted, count(*) - count(DISTINCT (user_id, date_trunc('hour', ts), event_id % 3)) AS duplicates, count_if(event_id % 13 = 0) AS skipped, CAST(greatest(0, 1704931200 - max(epoch(date_trunc('second', ts)))) AS BIGINT) AS lag_seconds FROM events GROUP BY 1")
def source_metrics(spark, sf_dir):
    version = F.struct("user_id", F.date_trunc("hour", "ts"), F.col("event_id") % 3)
    return keyset.source_counters(table(spark, sf_dir, "events"), "event_type", version, F.col("ts"), skipped=F.col("event_id") % 13 == 0, now=1704931200)
