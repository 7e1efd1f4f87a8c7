"""Queries of record shapes and coercions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import coerce
from ..operators import mapping, shape
from .base import ISSUE, Catalogue, issue, table

Q = Catalogue()


@Q("SELECT p_partkey, p_name AS name, CAST(p_size AS VARCHAR) AS size, 4 AS fields FROM part")
def shape_schemaless(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_brand", F.lit(None).cast("string").alias("absent"))
    return p.select("p_partkey", shape.schemaless(p)).select("p_partkey", F.col("value")["p_name"].alias("name"), F.col("value")["p_size"].alias("size"), F.size("value").alias("fields"))


@Q("SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' ELSE 'Partly' END AS o_orderstatus_display_value FROM orders")
def shape_strings(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    s = F.col("o_orderstatus")
    return shape.strings(o, {"o_orderstatus": F.when(s == "F", "Finished").when(s == "O", "Open").otherwise("Partly")})


@Q("SELECT CAST(c_custkey AS VARCHAR) AS key, c_name AS a, NULL AS b FROM customer WHERE c_custkey <= 100 UNION ALL SELECT CAST(c_custkey AS VARCHAR), NULL, c_mktsegment FROM customer WHERE c_custkey > 100")
def schema_growth(spark, sf_dir):
    c = shape.strings(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"))
    one = c.filter(F.col("c_custkey").cast("bigint") <= 100).select(F.col("c_custkey").alias("key"), F.col("c_name").alias("a"))
    two = c.filter(F.col("c_custkey").cast("bigint") > 100).select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("b"))
    return shape.grown([one, two])


@Q("""WITH n AS (SELECT year(o_orderdate) AS batch, o_orderkey, unnest([concat('status_', o_orderstatus), o_orderpriority, concat('caller_', o_custkey % 60)]) AS field, unnest([0, 1, 2]) AS position FROM orders),
 f AS (SELECT field, min((batch, o_orderkey, position)) AS first, arg_min(batch, (batch, o_orderkey, position)) AS born FROM n GROUP BY field), b AS (SELECT DISTINCT batch FROM n)
 SELECT b.batch, CAST(1 + count(DISTINCT CASE WHEN f.born > (SELECT min(batch) FROM b) THEN f.born END) AS INTEGER) AS version, string_agg(field, ',' ORDER BY first) AS fields FROM b JOIN f ON f.born <= b.batch GROUP BY b.batch""")
def schema_versions(spark, sf_dir):
    """Orders' names of fields, a batch for each year."""
    names = F.array(F.concat(F.lit("status_"), "o_orderstatus"), F.col("o_orderpriority"), F.concat(F.lit("caller_"), (F.col("o_custkey") % 60).cast("string")))
    rows = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    return shape.field_versions(rows, "year", "o_orderkey", names).select("batch", "version", F.array_join("fields", ",").alias("fields"))


_RECORDS = """r AS (SELECT event_id, date_trunc('hour', ts)::TIMESTAMP AS batch, names FROM (SELECT event_id, ts, ['k', event_type, concat('tag_', CAST(json_extract(props, '$.k') AS BIGINT) // 7), concat('user_', user_id % 40)] AS names FROM events))"""


@Q(f"""WITH {_RECORDS}, n AS (SELECT batch, event_id, unnest(names) AS field, unnest(range(len(names))) AS position FROM r),
 f AS (SELECT field, min((batch, event_id, position)) AS first, arg_min(batch, (batch, event_id, position)) AS born FROM n GROUP BY field), b AS (SELECT DISTINCT batch FROM r)
 SELECT b.batch, CAST(1 + count(DISTINCT CASE WHEN f.born > (SELECT min(batch) FROM b) THEN f.born END) AS INTEGER) AS version, string_agg(field, ',' ORDER BY first) AS fields FROM b JOIN f ON f.born <= b.batch GROUP BY b.batch""")
def schema_growth_versions(spark, sf_dir):
    """Records' own fields, hour by hour: names that come from the data appear with the first record that has them."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    names = F.array(F.lit("k"), F.col("event_type"), F.concat(F.lit("tag_"), F.floor(k / 7).cast("string")), F.concat(F.lit("user_"), (F.col("user_id") % 40).cast("string")))
    rows = e.select("event_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"), F.map_from_arrays(names, F.transform(names, lambda n: n)).alias("record"))
    return shape.field_versions(rows, "hour", "event_id", F.map_keys("record")).select("batch", "version", F.array_join("fields", ",").alias("fields"))


def _cells(spark, sf_dir):
    """Issues as string cells, with empty and bad ones among them."""
    n = F.col("number")
    cost = F.when(n % 7 == 0, "").when(n % 11 == 0, "n/a").otherwise(F.concat(F.floor(F.col("cost") / 1000).cast("string"), F.lit(","), F.lpad((F.floor("cost") % 1000).cast("string"), 3, "0"), F.lit(".5")))
    return issue(spark, sf_dir).select(
        n.cast("string").alias("number"), F.concat(F.col("caller").cast("string"), F.lit(".0")).alias("caller"), cost.alias("cost"),
        F.when(n % 3 == 0, "Yes").when(n % 3 == 1, "0").otherwise("").alias("active"), coerce.format_timestamp(F.col("sys_updated_on")).alias("updated"),
    )


@Q(f"""WITH {ISSUE} SELECT number, CAST(caller AS INTEGER) AS caller, CASE WHEN number % 7 = 0 OR number % 11 = 0 THEN NULL ELSE CAST(floor(cost) + 0.5 AS DECIMAL(38,2)) END AS cost,
 CASE number % 3 WHEN 0 THEN true WHEN 1 THEN false END AS active, sys_updated_on AS updated, CASE WHEN number % 11 = 0 AND number % 7 <> 0 THEN 'cost: not a decimal' END AS error FROM issue""")
def shape_typed(spark, sf_dir):
    return shape.typed(_cells(spark, sf_dir), "number:int64,caller:int32,cost:decimal,active:boolean,updated:timestamp")


@Q(f"WITH {ISSUE} SELECT number, CAST(caller AS VARCHAR) || '.0' AS caller FROM issue")
def shape_typed_backward(spark, sf_dir):
    rows = _cells(spark, sf_dir).select("number", "caller")
    return shape.typed(rows, "number:int64", evolution="backward").drop("error")


@Q(f"WITH {ISSUE} SELECT sys_id, state AS after_state, 'issue' AS \"table\", 'dev.example' AS instance, 'u' AS op, CAST(epoch_ms(sys_updated_on) AS BIGINT) AS ts_ms, true AS before_is_null FROM issue")
def envelope(spark, sf_dir):
    i = issue(spark, sf_dir)
    ms = F.unix_millis(F.col("sys_updated_on").cast("timestamp"))
    e = i.select("sys_id", shape.envelope(F.struct("state", "priority"), "issue", "dev.example", ms).alias("e"))
    return e.select("sys_id", F.col("e.after.state").alias("after_state"), "e.source.table", "e.source.instance", "e.op", "e.ts_ms", F.col("e.before").isNull().alias("before_is_null"))


@Q(f"WITH {ISSUE} SELECT sys_id AS key, CAST(epoch_ms(sys_updated_on) AS BIGINT) AS \"timestamp\", 'issues' AS topic, state, 'UPSERT' AS op, 5 AS headers, strftime(sys_updated_on, '%Y-%m-%d %H:%M:%S') AS resume_at, 'stream' AS phase FROM issue")
def source_record_shape(spark, sf_dir):
    r = shape.source_record(issue(spark, sf_dir), topic="issues", table="issue", instance="dev.example", fingerprint="sha256:x", phase="stream", extracted_at=F.lit(0))
    return r.select("key", "timestamp", "topic", F.col("value")["state"].alias("state"), F.col("headers")["source.operation"].alias("op"), F.size("headers").alias("headers"), F.col("offset")["timestamp"].alias("resume_at"), F.col("offset")["phase"].alias("phase"))


@Q("SELECT event_id, event_id % 13 <> 0 AS valid FROM events")
def ts_valid(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    raw = F.when(F.col("event_id") % 13 == 0, F.date_format("ts", "yyyy-MM-dd")).otherwise(coerce.format_timestamp(F.col("ts")))
    return e.select("event_id", coerce.is_timestamp(raw).alias("valid"))


@Q("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM events")
def ts_format(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", coerce.format_timestamp(F.col("ts")).alias("at"))


@Q("SELECT l_orderkey, l_linenumber, CASE WHEN l_extendedprice = floor(l_extendedprice) THEN CAST(CAST(l_extendedprice AS BIGINT) AS VARCHAR) ELSE CAST(l_extendedprice AS VARCHAR) END AS v, strftime(l_shipdate, '%Y-%m-%d') AS shipped FROM lineitem")
def render_columns(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", coerce.render(F.col("l_extendedprice"), "double").alias("v"), coerce.render(F.col("l_shipdate").cast("date"), "date").alias("shipped"))


@Q("SELECT event_id, CAST(json_extract(props, '$.k') AS VARCHAR) AS k FROM events")
def json_value_parse(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", mapping.parse_value(F.col("props"))["k"].alias("k"))


@Q("SELECT event_id, CAST(json_extract(props, '$.k') AS VARCHAR) AS k FROM events")
def json_field_text(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))
