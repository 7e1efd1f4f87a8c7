"""Queries of functions on dirty cells: events, parts and suppliers spell their own values in every way that the functions must read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import coerce, text
from ..operators import change as ch
from ..operators import mapping as mp
from ..operators import translate
from ..operators.ingest import ingest
from ..plans import encoded_query as eq
from ..plans import keyset as ks
from ..plans import offsets
from ..plans.config import SinkConfig
from .base import Catalogue, table
from .mapping import HIERARCHY, hierarchy

Q = Catalogue()
c = F.col


def _case(ways: list[str | None], by: str = "event_id") -> str:
    """SQL that spells a row's value in one of several ways, by its id."""
    return f"CASE {by} % {len(ways)} " + " ".join(f"WHEN {i} THEN {w if w is not None else 'NULL'}" for i, w in enumerate(ways)) + " END"


def cells(name: str, spelled: dict[str, str | list], run: Callable[[], Column], want: str | list, kind: str = "VARCHAR") -> None:
    """A query over all events: cells as Spark SQL spells them, what the function makes of them, and DuckDB's own account of it."""

    def query(spark, sf_dir):
        raw = {k: F.expr(v if isinstance(v, str) else _case(v)) for k, v in spelled.items()}
        return table(spark, sf_dir, "events").withColumns(raw).select("event_id", run().alias("v"))

    Q.add(name, query, f"SELECT event_id, CAST({want if isinstance(want, str) else _case(want)} AS {kind}) AS v FROM events")


# --- typed values

cells("coerce_int", {"s": ["concat(event_id)", "concat(event_id, '.0')", "concat(' ', event_id, ' ')", "''", "concat('x', event_id)", "concat(event_id, '.5')", "concat('-', event_id)", "concat('99999999999', event_id)"]}, lambda: coerce.to_int(c("s"), "int32"),
      ["event_id", "event_id", "event_id", None, None, None, "-event_id", None], "INTEGER")
cells("coerce_long", {"s": ["concat(9007199254000001 + event_id)", "concat(event_id % 9 + 1, 'e3')", None, "concat(event_id, 'e-1x')"]}, lambda: coerce.to_int(c("s")), ["9007199254000001 + event_id", "(event_id % 9 + 1) * 1000", None, None], "BIGINT")
cells("coerce_float", {"s": ["concat(event_id, '.25')", "''", "concat(' ', event_id, ' ')", "concat('abc', event_id)", "concat('-', event_id % 1000, '.125')"]}, lambda: coerce.to_float(c("s")), ["event_id + 0.25", None, "event_id", None, "-(event_id % 1000 + 0.125)"], "DOUBLE")
cells("coerce_boolean", {"s": "concat(repeat(' ', cast(user_id % 3 as int)), " + _case(["'1'", "'No'", "'TRUE'", "'yes'", "'0'", "'t'", "''", "event_type"]) + ")"}, lambda: coerce.to_boolean(c("s")), ["true", "false", "true", "true", "false", None, None, None], "BOOLEAN")
cells("coerce_decimal", {"s": ["concat(event_id % 900 + 100, ',', lpad(cast(event_id % 1000 as string), 3, '0'), '.5')", "concat(event_id, '.345')", "concat('-', event_id, '.005')", "''", "'n/a'"]}, lambda: coerce.to_decimal(c("s")),
      ["(event_id % 900 + 100) * 1000 + event_id % 1000 + 0.5", "event_id + 0.35", "-(event_id + 0.01)", None, None], "DECIMAL(38,2)")
cells("coerce_date", {"s": ["date_format(ts, 'yyyy-MM-dd')", "concat('2025-02-', 29 + event_id % 3)", "date_format(ts, 'dd.MM.yyyy')", "''", "date_format(ts, ' yyyy-MM-dd ')"]}, lambda: coerce.to_date(c("s")), ["ts", None, None, None, "ts"], "DATE")
cells("coerce_time", {"s": ["date_format(ts, 'HH:mm:ss')", "concat(24 + event_id % 3, ':00:00')", "concat('x', event_id)", "date_format(ts, 'HH:mm')"]}, lambda: coerce.to_time(c("s")), ["hour(ts) * 3600 + minute(ts) * 60 + floor(second(ts))", None, None, None], "INTEGER")
cells("coerce_bytes", {"s": ["base64(cast(concat(event_type, '-', event_id) as binary))", "''"]}, lambda: F.decode(coerce.to_bytes(c("s")), "utf-8"), ["concat(event_type, '-', event_id)", None])
cells("ts_parse", {"s": ["date_format(ts, 'yyyy-MM-dd HH:mm:ss')", "date_format(ts, 'yyyy-MM-dd')", "concat('2025-02-3', event_id % 2, ' 10:00:00')", "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\")", "''", "date_format(ts, ' yyyy-MM-dd HH:mm:ss ')"]}, lambda: coerce.to_timestamp(c("s")),
      ["date_trunc('second', ts)", None, None, None, None, "date_trunc('second', ts)"], "TIMESTAMP")
cells("empty_to_null", {"s": ["''", "event_type", None, "' '"]}, lambda: coerce.empty_to_null(c("s")), [None, "event_type", None, "' '"])
_K = "(event_id % 9 + 1)"
cells("render_scalars", {"d": ["event_id / 8.0D", f"{_K} * 1e20D", f"cast(concat({_K}, 'E-20') as double)", "cast('NaN' as double)", "-cast(event_id as double)"]}, lambda: coerce.render(c("d"), "double"),
      ["CASE WHEN event_id % 8 = 0 THEN concat(event_id // 8) ELSE concat(event_id // 8, '.', rtrim(lpad(CAST(event_id % 8 * 125 AS VARCHAR), 3, '0'), '0')) END", f"concat({_K}, repeat('0', 20))", f"concat('0.', repeat('0', 19), {_K}, '0')", None, "CASE WHEN event_id = 0 THEN '0' ELSE concat('-', event_id) END"])

# --- texts of requests and answers

cells("percent_encode_marks", {"s": "concat('a b+', event_id, '*d~ä^&=', event_type)"}, lambda: text.percent_encode(c("s")), "concat('a%20b%2B', event_id, '%2Ad~%C3%A4%5E%26%3D', event_type)")
cells("request_url", {"q": ["concat('number=', event_id, '^state>', event_type)", "''"]}, lambda: text.request_path(c("event_type"), c("q"), fields=F.lit("sys_id,number"), limit=10, offset=20, no_domain=True),
      "concat('/api/now/table/', event_type, '?', CASE event_id % 2 WHEN 0 THEN concat('sysparm_query=number%3D', event_id, '%5Estate%3E', event_type, '&') ELSE '' END, "
      "'sysparm_fields=sys_id%2Cnumber&sysparm_limit=10&sysparm_offset=20&sysparm_display_value=false&sysparm_exclude_reference_link=true&sysparm_query_no_domain=true&sysparm_no_count=true&sysparm_suppress_pagination_header=true')")
cells("query_normalise", {"q": ["concat('  a=', event_id, ' \\n ^b=\\t', event_type, ' ')", None]}, lambda: text.normalise_query(c("q")), ["concat('a=', event_id, ' ^b= ', event_type)", "''"])
cells("valid_sys_id", {"s": ["concat('a', lpad(cast(event_id as string), 31, '0'))", "concat('A', lpad(cast(event_id as string), 31, '0'))", "lpad(cast(event_id as string), 31, '0')", None]}, lambda: text.is_id(c("s")), ["true", "false", "false", "false"], "BOOLEAN")
cells("valid_table", {"s": ["concat('u_', event_type, '_', user_id)", "initcap(event_type)", "concat(event_type, '/', user_id)", "''"]}, lambda: text.is_table(c("s")), ["true", "false", "false", "false"], "BOOLEAN")
_KEY = "concat('k', event_id, '/+=')"
cells("redact_body", {"s": ["""concat('{"client_secret": "a\\\\"', event_id, '", "x": ', event_id, '}')""", f"concat('grant=', event_id, '&password=p%20', {_KEY}, '&y=', event_type)", f"concat('Authorization was Bearer ', {_KEY}, ' ok')", "concat('nothing of ', event_type)"]}, lambda: text.redact_body(c("s")),
      ["""concat('{"client_secret": "***", "x": ', event_id, '}')""", "concat('grant=', event_id, '&password=***&y=', event_type)", "'Authorization was Bearer *** ok'", "concat('nothing of ', event_type)"])
cells("redact_more", {"s": ["""concat('{"a":{"Token" :\\n"', event_id, ' y"},"b":"', event_type, '"}')""", "concat('u=https://h/p?access_token=', event_id, '=b?c&z=', event_type, ' end')", "concat('basic  Q', event_id, '==; next')", "concat('\"password\": ', event_id)", "concat('é token=ü', event_id, '&x')", "concat('BasicX ', event_id)"]}, lambda: text.redact_body(c("s")),
      ["""concat('{"a":{"Token" :', chr(10), '"***"},"b":"', event_type, '"}')""", "concat('u=https://h/p?access_token=***&z=', event_type, ' end')", "'basic  ***; next'", "concat('\"password\": ', event_id)", "'é token=***&x'", "concat('BasicX ', event_id)"])
cells("redact_headers", {"h": ["map('X-Id', array(concat(event_id), event_type), 'authorization', array(concat('Basic ', event_id)))", "cast(map() as map<string,array<string>>)", "map('Set-COOKIE', array(event_type), 'Accept', array(concat(event_id)))"]}, lambda: text.redact_headers(c("h")),
      ["concat('{authorization=[***], X-Id=[', event_id, ', ', event_type, ']}')", "'{}'", "concat('{Accept=[', event_id, '], Set-COOKIE=[***]}')"])
cells("excerpt", {"s": ["concat(event_type, ' happened at ', user_id)", "'abc'", None, "concat('password=', event_id, ' and so on')"]}, lambda: text.excerpt(c("s"), 14), ["CASE WHEN length(event_type) + length(CAST(user_id AS VARCHAR)) + 13 > 14 THEN concat(left(concat(event_type, ' happened at ', user_id), 14), '...') ELSE concat(event_type, ' happened at ', user_id) END", "'abc'", "''", "'password=*** a...'"])
cells("error_body_parse", {"s": ["""concat('{"error":{"message":"No ', event_id, '","detail":"', event_type, '"},"status":"failure"}')""", """concat('{"error":{"message":"No ', event_id, '","detail":null}}')""", """concat('{"error":"', event_type, '","error_description":"bad ', event_id, '"}')""", "concat('<html>', event_id)"]}, lambda: text.error_text(c("s")),
      ["concat('No ', event_id, ': ', event_type)", "concat('No ', event_id)", "concat(event_type, ': bad ', event_id)", None])
cells("classify_status", {"status": ["503", "409", "409", "400", "429", "cast(500 + user_id % 6 as int)"], "error": [None, "concat('Row ', event_id, ' is LOCKED')", "concat('duplicate of ', event_id)", "'busy'", None, "event_type"]}, lambda: text.is_retryable(c("status"), c("error")),
      ["true", "true", "false", "false", "true", "user_id % 6 IN (0, 2, 3, 4)"], "BOOLEAN")
_HTTP = "concat(date_format({}, 'E, d MMM yyyy HH:mm:ss'), ' GMT')"
_NOW = "unix_timestamp(cast(ts as timestamp))"
cells("retry_after", {"s": ["concat(event_id % 500)", "concat('-', event_id)", _HTTP.format("ts + INTERVAL 90 SECONDS"), _HTTP.format("ts - INTERVAL 1 HOUR"), "event_type"], "now": _NOW}, lambda: text.retry_after(c("s"), c("now")), ["event_id % 500", "0", "90", "0", None], "BIGINT")
cells("rate_reset", {"s": ["concat(event_id % 500)", f"concat({_NOW} + 60)", _HTTP.format("ts + INTERVAL 1 HOUR"), "event_type"], "now": _NOW}, lambda: text.rate_reset(c("s"), c("now")), ["epoch(date_trunc('second', ts)) + event_id % 500", "epoch(date_trunc('second', ts)) + 60", "epoch(date_trunc('second', ts)) + 3600", None], "BIGINT")
cells("wait_for", {"w": ["10", "10", None, None, None], "o": "user_id", "now": "user_id + event_id % 20", "r": [None, None, "0", "-1", "3"], "t": "user_id + 10"}, lambda: text.wait_for(c("w"), c("o"), c("now"), remaining=c("r"), reset=c("t")), [*["greatest(10 - event_id % 20, 0)"] * 4, None], "BIGINT")
cells("remaining_fraction", {"l": ["user_id + 1", "100", "0", "100"], "r": ["event_id % 7", "-event_id - 1", "5", None]}, lambda: text.remaining_fraction(c("l"), c("r")), ["(event_id % 7)::DOUBLE / (user_id + 1)", "0.0", None, None], "DOUBLE")
cells("backoff_ceiling", {"a": "cast(event_id % 45 as int)"}, lambda: text.backoff_ceiling(c("a")), "least(30000, 500 * CAST(pow(2, greatest(event_id % 45 - 1, 0)) AS BIGINT))", "BIGINT")
cells("retry_decision", {"r": "event_id % 3 <> 0", "i": "event_id % 2 = 0", "m": "user_id % 2 = 0", "a": "cast(event_id % 7 + 1 as int)", "e": "user_id * 40000", "w": "500"}, lambda: text.retry_decision(c("r"), c("i"), c("m"), c("a"), c("e"), c("w")),
      "CASE WHEN event_id % 3 = 0 OR (event_id % 2 <> 0 AND user_id % 2 = 0) THEN 'fail' WHEN event_id % 7 + 1 >= 5 OR user_id * 40000 + 500 > 300000 THEN 'exhausted' ELSE 'retry' END")
cells("idempotent_method", {"m": ["'GET'", "'post'", "'DELETE'", "'POST'", "upper(event_type)"]}, lambda: text.is_idempotent(c("m")), ["true", "false", "true", "false", "true"], "BOOLEAN")
_ISO = "yyyy-MM-dd'T'HH:mm:ss"
cells("recon_ts_normalise", {"s": [f'date_format(ts, "{_ISO}\'Z\'")', "date_format(ts, ' yyyy-MM-dd HH:mm:ss ')", "date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSS')", "' '", "date_format(ts, 'yyyy-MM-dd')", f'concat(date_format(ts, "{_ISO}"), "+00:00")']}, lambda: text.reconcile_timestamp(c("s")),
      [*["strftime(ts, '%Y-%m-%d %H:%M:%S')"] * 3, None, "strftime(ts, '%Y-%m-%d')", "strftime(ts, '%Y-%m-%d %H:%M:%S')"])
cells("config_ts_normalise", {"s": ["date_format(ts, 'yyyy-MM-dd')", f'date_format(ts, "{_ISO}\'Z\'")', "date_format(ts, 'yyyy-MM-dd HH:mm:ss')", "concat('later ', event_id)"]}, lambda: text.config_timestamp(c("s")),
      ["strftime(ts, '%Y-%m-%d 00:00:00')", "strftime(ts, '%Y-%m-%d %H:%M:%S')", "strftime(ts, '%Y-%m-%d %H:%M:%S')", "concat('later ', event_id)"])

# --- changes

_ID = "concat('{}', lpad(cast(event_id as string), 31, '0'))"
_A, _B = _ID.format("a"), _ID.format("b")
_PLACES = {"k": [_A, f"upper({_A})", _A, None, None, None, "' '", "concat('nope', event_id)"], "v": [None, _A, _B, "concat('nope', event_id)", None, None, _B, _B], "h": [None, None, None, None, f"concat(' ', {_B}, ' ')", None, _B, None]}


def _several(name: str, spelled: dict, columns: Callable[[], dict[str, Column]], want: dict[str, str | list]) -> None:
    def query(spark, sf_dir):
        raw = {k: F.expr(v if isinstance(v, str) else _case(v)) for k, v in spelled.items()}
        return table(spark, sf_dir, "events").withColumns(raw).select("event_id", *(x.alias(k) for k, x in columns().items()))

    shown = ", ".join(f'{v if isinstance(v, str) else _case(v)} AS "{k}"' for k, v in want.items())
    Q.add(name, query, f"SELECT event_id, {shown} FROM events")


def _extracted(precedence: str) -> Callable[[], dict[str, Column]]:
    return lambda: dict(zip(("id", "error"), ch.extract_id({"key": c("k"), "value": c("v"), "header": c("h")}, precedence=precedence), strict=True))


_several("id_extract", _PLACES, _extracted("reject"), {"id": [_A, _A, None, None, _B, None, _B, None], "error": [None, None, "'ids disagree'", "'malformed id'", None, None, None, "'ids disagree'"]})
_several("id_precedence", _PLACES, _extracted("value"), {"id": [_A, _A, _B, None, _B, None, _B, _B], "error": [None, None, None, "'malformed id'", None, None, None, None]})
_several("id_agree", _PLACES, lambda: {"agree": ch.ids_agree([c("k"), c("v"), c("h")])}, {"agree": ["true", "true", "false", "true", "true", "true", "true", "false"]})
_several("route_header", {"h": ["concat(' ', event_type, ' ')", "concat('Bad-', event_type)", None, "concat('u_', user_id)", "event_type"]}, lambda: dict(zip(("table", "error"), ch.route_header(c("h"), ("click", "view")), strict=True)),
         {"table": ["CASE WHEN event_type IN ('click', 'view') THEN event_type END", None, None, None, "CASE WHEN event_type IN ('click', 'view') THEN event_type END"],
          "error": ["CASE WHEN event_type NOT IN ('click', 'view') THEN 'table not allowed' END", "'bad table name'", "'no table header'", "'table not allowed'", "CASE WHEN event_type NOT IN ('click', 'view') THEN 'table not allowed' END"]})
_several("op_header", {"h": ["'create'", "' POST '", "'Update'", "'upsert'", "'DELETE'", "event_type", None]}, lambda: dict(zip(("op", "error"), ch.resolve_operation(c("h"), mode="header"), strict=True)),
         {"op": ["'CREATE'", "'CREATE'", "'PATCH'", "'PATCH'", "'DELETE'", None, None], "error": [None, None, None, None, None, "concat('unknown operation ', upper(event_type))", "'no operation header'"]})

# --- positions

_FINGER = "concat('sha256:', event_type)"
_STORED = {"o": [
    f"map('version', '1', 'timestamp', date_format(ts, 'yyyy-MM-dd HH:mm:ss'), 'sys_id', concat(event_id), 'phase', 'stream', 'fingerprint', {_FINGER})", f"map('version', '2', 'timestamp', date_format(ts, 'yyyy-MM-dd HH:mm:ss'), 'sys_id', concat(event_id), 'phase', 'stream', 'fingerprint', {_FINGER})",
    f"map('version', '1', 'timestamp', date_format(ts, 'yyyy-MM-dd'), 'sys_id', concat(event_id), 'phase', 'stream', 'fingerprint', {_FINGER})", f"map('version', '1', 'timestamp', date_format(ts, 'yyyy-MM-dd HH:mm:ss'), 'phase', 'stream', 'fingerprint', {_FINGER})",
    f"map('version', '1', 'timestamp', date_format(ts, 'yyyy-MM-dd HH:mm:ss'), 'sys_id', concat(event_id), 'phase', event_type, 'fingerprint', {_FINGER})", "map('version', '1', 'timestamp', date_format(ts, 'yyyy-MM-dd HH:mm:ss'), 'sys_id', concat(event_id), 'phase', 'backfill', 'fingerprint', ' ')",
    f"map('version', '1', 'timestamp', date_format(ts, 'yyyy-MM-dd HH:mm:ss'), 'sys_id', '', 'phase', 'backfill', 'fingerprint', {_FINGER})",
]}
cells("offset_validate", _STORED, lambda: offsets.is_valid(c("o")), ["true", "false", "false", "false", "false", "false", "true"], "BOOLEAN")
cells("offset_compat", _STORED, lambda: offsets.is_valid(c("o")) & (c("o")["fingerprint"] == "sha256:view"), ["event_type = 'view'", *["false"] * 5, "event_type = 'view'"], "BOOLEAN")


@Q("""WITH s AS (SELECT user_id, event_type, max(date_trunc('second', ts)) AS at0 FROM events WHERE user_id % 3 <> 0 GROUP BY ALL), u AS (SELECT DISTINCT user_id, event_type FROM events)
 SELECT 'u_' || u.user_id AS "table", 'sha256:' || u.event_type AS query_fingerprint, strftime(at0, '%Y-%m-%d %H:%M:%S') AS resume_at FROM u LEFT JOIN s USING (user_id, event_type)""")
def offset_lookup(spark, sf_dir):
    """A stream for each user and kind of event; two thirds of them have a stored position."""
    e = table(spark, sf_dir, "events")
    names = [F.lit("i").alias("instance"), F.concat(F.lit("u_"), "user_id").alias("table"), F.concat(F.lit("sha256:"), "event_type").alias("query_fingerprint"), F.lit("ts").alias("timestamp_field")]
    last = e.filter("user_id % 3 <> 0").groupBy("user_id", "event_type").agg(F.max("ts").alias("ts"))
    place = F.create_map(*(F.lit(x) if isinstance(x, str) else x for x in ("version", "1", "timestamp", coerce.format_timestamp(c("ts")), "sys_id", "", "phase", "stream", "fingerprint", F.concat(F.lit("sha256:"), "event_type"))))
    found = offsets.lookup(e.select("user_id", "event_type").distinct().select(*names), last.select(*names, place.alias("offset")))
    return found.select("table", "query_fingerprint", c("offset")["timestamp"].alias("resume_at"))


@Q("""WITH d AS (SELECT DISTINCT date_trunc('hour', ts) AS h FROM events), n AS (SELECT max(ts) AS now FROM events)
 SELECT h::TIMESTAMP AS high, CASE WHEN h >= date_trunc('second', now - INTERVAL 6 HOUR) THEN 'stream' ELSE 'backfill' END AS phase FROM d, n""")
def sweep_phase(spark, sf_dir):
    """Whether a sweep that ends at each of the events' hours has reached the present, the last event's time."""
    e = table(spark, sf_dir, "events")
    from datetime import timedelta

    now = e.agg(F.max("ts")).first()[0]  # the clock of the driver that plans the sweeps
    hours = e.select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("high")).distinct()
    edge = ks.high_water_mark(now, timedelta(hours=1) + timedelta(hours=5))
    assert ks.phase(edge, now, timedelta(hours=1), timedelta(hours=5)) == "stream"
    return hours.select("high", F.when(c("high") >= F.lit(edge), "stream").otherwise("backfill").alias("phase"))


@Q("SELECT event_type, user_id % 3 AS form, count(*) AS rows, user_id % 3 > 0 AS ordered FROM events GROUP BY ALL")
def order_detection(spark, sf_dir):
    """Queries of three forms for every kind of event: whether the parsed one orders its rows, and the rows that it filters."""
    e = table(spark, sf_dir, "events").withColumn("form", c("user_id") % 3)
    out = None
    for form, order in enumerate(("", "^ORDERBYevent_id", "^ORDERBYDESCts^ORDERBYevent_id")):
        tree = eq.parse(f"form={form}{order}")
        part = eq.apply(e, tree).groupBy("event_type", "form").agg(F.count("*").alias("rows")).withColumn("ordered", F.lit(bool(tree.orders)))
        out = part if out is None else out.union(part)
    return out


# --- records to changes

_RECORD_ID = "concat('a', lpad(cast(user_id as string), 31, '0'))"


@Q("""WITH r AS (SELECT *, event_id % 10 = 0 AS gone, CASE event_type WHEN 'view' THEN 'u_view' WHEN 'click' THEN 'u_click' END AS tab,
 CASE WHEN event_id % 6 < 4 THEN concat('a', lpad(CAST(user_id AS VARCHAR), 31, '0')) END AS k, CASE WHEN event_id % 10 <> 0 AND event_id % 4 = 3 THEN concat('b', lpad(CAST(event_id AS VARCHAR), 31, '0')) END AS v,
 CASE event_id % 9 WHEN 1 THEN 'CREATE' WHEN 2 THEN 'PATCH' WHEN 3 THEN 'DELETE' WHEN 4 THEN 'MERGE' END AS h FROM events),
 i AS (SELECT *, coalesce(v, k) AS id FROM r),
 o AS (SELECT *, CASE WHEN h = 'MERGE' THEN NULL WHEN h IS NOT NULL THEN h WHEN gone THEN 'DELETE' WHEN id IS NULL THEN 'CREATE' ELSE 'PATCH' END AS op FROM i),
 s AS (SELECT *, NOT gone AND coalesce(op, '') <> 'DELETE' AS sends FROM o),
 f AS (SELECT *, CASE WHEN NOT sends THEN NULL WHEN tab = 'u_view' THEN concat('{"geo_lat":"', user_id, '","short_description":"', CASE WHEN event_id % 4 <> 0 THEN event_type ELSE '' END, '"}')
  WHEN tab = 'u_click' THEN concat('{"cost":"', event_id, '","geo_kind":"k', user_id % 3, '","geo_lat":"', user_id, '","short_description":"', CASE WHEN event_id % 4 <> 0 THEN event_type ELSE '' END, '"}') ELSE '{}' END AS body,
  CASE WHEN NOT sends THEN '' WHEN tab = 'u_view' THEN 'cost,geo_kind' WHEN tab = 'u_click' THEN '' ELSE 'cost,geo_kind,geo_lat,short_description' END AS dropped FROM s)
 SELECT event_id, op, tab AS "table", id AS sys_id, body, dropped, nullif(concat_ws('; ', CASE WHEN tab IS NULL THEN concat('no table for topic ', event_type) END, CASE WHEN h = 'MERGE' THEN 'unknown operation MERGE' END,
  CASE WHEN op IN ('PATCH', 'PUT', 'DELETE') AND id IS NULL THEN concat(op, ' needs an id') WHEN op <> 'DELETE' AND gone THEN concat(op, ' needs a value') END), '') AS error FROM f""")
def sink_ingest(spark, sf_dir):
    """Events as records of topics: every one becomes a change or tells why not."""
    value = "CASE WHEN event_id % 10 <> 0 THEN named_struct('sys_id', CASE WHEN event_id % 4 = 3 THEN concat('B', lpad(cast(event_id as string), 31, '0')) END, 'cost', event_id, 'note', CASE WHEN event_id % 4 <> 0 THEN event_type END, 'geo', named_struct('lat', user_id, 'kind', concat('k', user_id % 3)), 'secret', 'x') END"
    h = _case([None, "'create'", "' patch '", "'delete'", "'merge'", None, None, None, None])
    records = table(spark, sf_dir, "events").select(
        "event_id", c("event_type").alias("topic"), F.expr("user_id % 4").alias("partition"), c("event_id").alias("offset"), F.expr(f"CASE WHEN event_id % 6 < 4 THEN {_RECORD_ID} END").alias("key"), F.expr(value).alias("value"), F.create_map(F.lit("operation"), F.expr(h)).alias("headers"),
    )
    config = SinkConfig(routing="topic", routes={"view": "u_view", "click": "u_click"}, id_conflict="value", nulls="clear", nested="flatten", unknown="report", deny=("secret", "sys_id"), rename=(("note", "short_description"),))
    known = spark.createDataFrame([(t, e, 0) for t, names in (("u_view", "geo_lat short_description"), ("u_click", "cost geo_kind geo_lat short_description")) for e in names.split()], "name string, element string, level int")
    out = ingest(records, config, known)
    body = F.to_json(F.map_from_entries(F.array_sort(F.map_entries(F.from_json("body", "map<string,string>")))))
    return out.select(c("offset").alias("event_id"), "op", "table", "sys_id", body.alias("body"), F.array_join("dropped", ",").alias("dropped"), "error")


# --- dictionaries and configurations

@Q("SELECT p_brand AS element FROM part WHERE p_size % 20 = 7 AND p_partkey % 5 <> 0")
def dictionary_columns(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    words = p.select(F.concat(F.lit("t"), (c("p_size") % 20).cast("string")).alias("name"), F.when(c("p_partkey") % 5 != 0, c("p_brand")).otherwise("").alias("element"))
    return mp.dictionary_columns(words, "t7")


for _name, _start in (("superclass_chain", 97), ("superclass_cycle", 1)):
    Q.add(_name, lambda spark, sf_dir, start=_start: mp.superclass_chain(hierarchy(spark, sf_dir)[0], f"t{start}"), f"WITH {HIERARCHY} SELECT 't' || a AS name, level FROM chain WHERE k = {_start}")

_RULES = [("connection.url", "rename", "instance.url", None, None, None, 1), ("mode", "value", "schema.mode", "json", "schemaless", None, 5), ("mode", "manual", "schema.mode", "avro", None, "choose a schema mode", 5), ("vendor.license", "drop", None, None, None, "not needed", 9), ("since", "rename", "start", None, None, None, 6)]
#: A supplier's connector: key, value in Spark's and in DuckDB's SQL, and new key, new value, action and rank by the rules.
_ENTRIES = [
    ("connection.url", "concat('https://s', s_suppkey)", "'instance.url'", "concat('https://s', s_suppkey)", "'rename'", "1"),
    ("mode", "CASE WHEN s_suppkey % 3 = 0 THEN 'avro' ELSE 'json' END", "'schema.mode'", "CASE WHEN s_suppkey % 3 = 0 THEN 'avro' ELSE 'schemaless' END", "CASE WHEN s_suppkey % 3 = 0 THEN 'manual' ELSE 'value' END", "5"),
    ("since", "concat('2026-01-', lpad(cast(s_suppkey % 28 + 1 as string), 2, '0'))", "'start'", "concat('2026-01-', lpad(CAST(s_suppkey % 28 + 1 AS VARCHAR), 2, '0'), ' 00:00:00')", "'rename'", "6"),
    ("vendor.license", "s_name", "'vendor.license'", "NULL", "'drop'", "9"),
    ("connector.class", "concat('io.x.My', CASE s_suppkey % 4 WHEN 0 THEN 'SourceConnector' WHEN 1 THEN 'SinkConnector' WHEN 2 THEN 'Odd' ELSE 'Other' END)", "'connector.class'", "concat('io.x.My', CASE s_suppkey % 4 WHEN 0 THEN 'SourceConnector' WHEN 1 THEN 'SinkConnector' WHEN 2 THEN 'Odd' ELSE 'Other' END)", "'pass'", "1000"),
    ("tasks.max", "concat(s_suppkey % 8)", "'tasks.max'", "concat(s_suppkey % 8)", "'pass'", "1000"),
]
_CONNECTOR = "concat('s', s_suppkey)"
_MOVED = "moved AS (" + " UNION ALL ".join(f"SELECT {_CONNECTOR} AS connector, {k} AS new_key, {v} AS new_value, {a} AS action, {r} AS rank FROM supplier" for _, _, k, v, a, r in _ENTRIES) + ")"


def _config(spark, sf_dir):
    entries = F.array(*(F.struct(F.lit(k).alias("key"), F.expr(v).alias("value")) for k, v, *_ in _ENTRIES))
    return table(spark, sf_dir, "supplier").select(F.expr(_CONNECTOR).alias("connector"), F.inline(entries))


def _translated(spark, sf_dir):
    return translate.translate(_config(spark, sf_dir), spark.createDataFrame(_RULES, translate.RULES), timestamps=("since",))


@Q(f"WITH {_MOVED} SELECT * FROM moved")
def config_translate(spark, sf_dir):
    return _translated(spark, sf_dir).drop("note")


@Q(f"SELECT {_CONNECTOR} AS connector, CAST(CASE WHEN s_suppkey % 3 = 0 THEN 2 ELSE 0 END AS INTEGER) AS exit_code FROM supplier")
def config_exit_code(spark, sf_dir):
    return translate.exit_code(_translated(spark, sf_dir))


@Q(f"SELECT {_CONNECTOR} AS connector, CASE s_suppkey % 4 WHEN 0 THEN 'source' WHEN 1 THEN 'sink' WHEN 2 THEN 'legacy' END AS variant FROM supplier")
def config_variant(spark, sf_dir):
    return translate.variant(_config(spark, sf_dir), {"io.x.MyOdd": "legacy"})


@Q(f"WITH {_MOVED} SELECT connector, string_agg(concat(new_key, '=', new_value), chr(10) ORDER BY rank, new_key) AS text FROM moved WHERE new_value IS NOT NULL GROUP BY connector")
def config_properties(spark, sf_dir):
    return translate.properties(_translated(spark, sf_dir))


@Q(f"""WITH {_MOVED} SELECT connector, concat('{{', string_agg(concat('"', new_key, '":"', new_value, '"'), ',' ORDER BY rank, new_key), '}}') AS json FROM moved WHERE new_value IS NOT NULL GROUP BY connector""")
def config_json(spark, sf_dir):
    return translate.as_json(_translated(spark, sf_dir))
