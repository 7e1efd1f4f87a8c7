"""Truth tables of functions on hand-written cells; queries run the same functions on whole tables."""

import datetime
import decimal

import pytest
from pyspark.sql import functions as F

from sluicework.functions import coerce, text
from sluicework.operators import change as ch

_NOW = 1767225600  # 2026-01-01 00:00:00
c = F.col


def rows_of(name, schema, rows, expression, want):
    return pytest.param(schema, rows, expression, want, id=name)


def cells_of(name, cells, run, out, want):
    return pytest.param("raw string", [(x,) for x in cells], lambda: run(F.col("raw")).cast(out), want, id=name)


TABLES = [
    rows_of("percent_encode_marks", "s string", [("a b+c*d~e",), ("ä^&=",), ("A-Z_0.9",)], lambda: text.percent_encode(c("s")), ["a%20b%2Bc%2Ad~e", "%C3%A4%5E%26%3D", "A-Z_0.9"]),
    rows_of("request_url", "q string", [("a=1^b>2",), ("",)], lambda: text.request_path(F.lit("incident"), c("q"), fields=F.lit("sys_id,number"), limit=10, offset=20, no_domain=True), [
    f"/api/now/table/incident?{q}sysparm_fields=sys_id%2Cnumber&sysparm_limit=10&sysparm_offset=20&sysparm_display_value=false&sysparm_exclude_reference_link=true&sysparm_query_no_domain=true&sysparm_no_count=true&sysparm_suppress_pagination_header=true"
    for q in ("sysparm_query=a%3D1%5Eb%3E2&", "")]),
    rows_of("query_normalise", "q string", [("  a=1 \n ^b=2 ",), (None,)], lambda: text.normalise_query(c("q")), ["a=1 ^b=2", ""]),
    rows_of("valid_sys_id", "s string", [("a" * 32,), ("A" * 32,), ("a" * 31,), (None,)], lambda: text.is_id(c("s")), [True, False, False, False]),
    rows_of("valid_table", "s string", [("cmdb_ci",), ("Bad",), ("a/b",)], lambda: text.is_table(c("s")), [True, False, False]),
    rows_of("redact_more", "s string", [('{"a":{"Token" :\n"x y"},"b":"keep"}',), ("u=https://h/p?access_token=a=b?c&z=1 end",), ("basic  QWxh==; next",), ('"password": 5',), ("=tokenx=abc&z",), ("é token=ü&x",), ("BasicX abc",)], lambda: text.redact_body(c("s")), ['{"a":{"Token" :\n"***"},"b":"keep"}', "u=https://h/p?access_token=***&z=1 end", "basic  ***; next", '"password": 5', "=tokenx=abc&z", "é token=***&x", "BasicX abc"]),
    rows_of("redact_body", "s string", [('{"client_secret": "a\\"b", "x": 1}',), ("grant=1&password=p%20q&y=2",), ("Authorization was Bearer abc.def ok",), ("nothing",)], lambda: text.redact_body(c("s")), ['{"client_secret": "***", "x": 1}', "grant=1&password=***&y=2", "Authorization was Bearer *** ok", "nothing"]),
    rows_of("redact_headers", "h map<string,array<string>>", [({"X-Id": ["1", "2"], "authorization": ["Basic x"]},), ({},)], lambda: text.redact_headers(c("h")), ["{authorization=[***], X-Id=[1, 2]}", "{}"]),
    rows_of("excerpt", "s string", [("abcdefghij",), ("abc",), (None,)], lambda: text.excerpt(c("s"), 5), ["abcde...", "abc", ""]),
    rows_of("error_body_parse", "s string", [('{"error":{"message":"No","detail":"why"},"status":"failure"}',), ('{"error":{"message":"No","detail":null}}',), ('{"error":"invalid_client","error_description":"bad"}',), ("<html>",)], lambda: text.error_text(c("s")), ["No: why", "No", "invalid_client: bad", None]),
    rows_of("retry_after", "s string", [("120",), ("-5",), ("Thu, 01 Jan 2026 00:01:00 GMT",), ("Wed, 31 Dec 2025 23:00:00 GMT",), ("soon",)], lambda: text.retry_after(c("s"), F.lit(_NOW)), [120, 0, 60, 0, None]),
    rows_of("rate_reset", "s string", [("60",), ("1767229200",), ("Thu, 01 Jan 2026 01:00:00 GMT",), ("x",)], lambda: text.rate_reset(c("s"), F.lit(_NOW)), [_NOW + 60, 1767229200, _NOW + 3600, None]),
    rows_of("wait_for", "w int, o int, now int, r int, t int", [(10, 100, 104, None, None), (10, 100, 120, None, None), (None, 100, 104, 0, 110), (None, 100, 120, 0, 110), (None, 100, 104, 3, 110)], lambda: text.wait_for(c("w"), c("o"), c("now"), remaining=c("r"), reset=c("t")), [6, 0, 6, 0, None]),
    rows_of("remaining_fraction", "l int, r int", [(100, 25), (100, -3), (0, 5), (100, None)], lambda: text.remaining_fraction(c("l"), c("r")), [0.25, 0.0, None, None]),
    rows_of("backoff_ceiling", "a int", [(1,), (2,), (5,), (7,), (40,)], lambda: text.backoff_ceiling(c("a")), [500, 1000, 8000, 30000, 30000]),
    rows_of("retry_decision", "r boolean, i boolean, m boolean, a int, e int, w int", [(True, True, True, 1, 0, 500), (True, False, True, 1, 0, 500), (True, False, False, 5, 0, 1), (True, True, False, 2, 299_900, 500), (False, True, False, 1, 0, 0)], lambda: text.retry_decision(c("r"), c("i"), c("m"), c("a"), c("e"), c("w")), ["retry", "fail", "exhausted", "exhausted", "fail"]),
    rows_of("idempotent_method", "m string", [("GET",), ("post",), ("DELETE",)], lambda: text.is_idempotent(c("m")), [True, False, True]),
    rows_of("config_ts_normalise", "s string", [("2026-01-02",), ("2026-01-02T03:04:05Z",), ("2026-01-02 03:04:05",), ("later",)], lambda: text.config_timestamp(c("s")), ["2026-01-02 00:00:00", "2026-01-02 03:04:05", "2026-01-02 03:04:05", "later"]),
    cells_of("coerce_int", ["12", "12.0", " 7 ", "", "x", "12.5", "-3", "99999999999"], lambda c: coerce.to_int(c, "int32"), "int", [12, 12, 7, None, None, None, -3, None]),
    cells_of("coerce_long", ["9007199254740993", "1e3", None], coerce.to_int, "bigint", [9007199254740993, 1000, None]),
    cells_of("coerce_float", ["1.5", "", " 2 ", "abc", "-0.25"], coerce.to_float, "double", [1.5, None, 2.0, None, -0.25]),
    cells_of("coerce_boolean", ["1", "No", "TRUE", "yes", "0", "t", "", "maybe"], coerce.to_boolean, "boolean", [True, False, True, True, False, None, None, None]),
    cells_of("coerce_decimal", ["1,234.5", "12.345", "-0.005", "", "n/a"], coerce.to_decimal, "decimal(38,2)", ["1234.50", "12.35", "-0.01", None, None]),
    cells_of("coerce_date", ["2026-02-28", "2026-02-30", "28.02.2026", ""], coerce.to_date, "date", ["2026-02-28", None, None, None]),
    cells_of("coerce_time", ["00:00:01", "23:59:59", "24:00:00", "nope"], coerce.to_time, "int", [1, 86399, None, None]),
    cells_of("coerce_bytes", ["aGk=", ""], lambda c: F.decode(coerce.to_bytes(c), "utf-8"), "string", ["hi", None]),
    cells_of("ts_parse", ["2026-09-29 07:30:40", "2026-09-29", "2026-02-30 10:00:00", "2026-09-29T07:30:40", ""], coerce.to_timestamp, "timestamp_ntz", ["2026-09-29 07:30:40", None, None, None, None]),
    cells_of("empty_to_null", ["", "a", None, " "], coerce.empty_to_null, "string", [None, "a", None, " "]),
    rows_of("recon_ts_normalise", "raw string", [("2026-01-02T03:04:05Z",), (" 2026-01-02 03:04:05 ",), ("2026-01-02 03:04:05.678",), (" ",), ("2026-01-02",)], lambda: text.reconcile_timestamp(c("raw")), [*["2026-01-02 03:04:05"] * 3, None, "2026-01-02"]),
    rows_of("classify_status", "status int, error string", [(503, None), (409, "Row is LOCKED"), (409, "duplicate"), (400, "busy"), (429, None)], lambda: text.is_retryable(c("status"), c("error")), [True, True, False, False, True]),
    rows_of("render_scalars", "d double", [(2.0,), (0.5,), (-3.0,), (1234567.25,), (float("nan"),), (1e2,), (1e-20,), (1e22,), (-1.2345678901234568e-05,), (1.5e20,), (0.1,), (float("inf"),)], lambda: coerce.render(c("d"), "double"),
            ["2", "0.5", "-3", "1234567.25", None, "100", "0.000000000000000000010", "1" + "0" * 22, "-0.000012345678901234568", "150000000000000000000", "0.1", None]),
]


def shown(v):
    return str(v) if isinstance(v, (decimal.Decimal, datetime.date, datetime.datetime)) else v


@pytest.mark.parametrize(("schema", "rows", "expression", "want"), TABLES)
def test_truth_tables(spark, schema, rows, expression, want):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"n int, {schema}")
    got = [shown(r.v) for r in df.select("n", expression().alias("v")).orderBy("n").collect()]
    assert got == want


_A, _B = "a" + "0" * 31, "b" + "0" * 31
_IDS = [(1, _A, None, None), (2, _A.upper(), _A, None), (3, _A, _B, None), (4, None, "nope", None), (5, None, None, f" {_B} "), (6, None, None, None), (7, " ", _B, _B), (8, "nope", _B, None)]


@pytest.mark.parametrize(("precedence", "want"), [
    ("reject", [(_A, None), (_A, None), (None, "ids disagree"), (None, "malformed id"), (_B, None), (None, None), (_B, None), (None, "ids disagree")]),
    ("value", [(_A, None), (_A, None), (_B, None), (None, "malformed id"), (_B, None), (None, None), (_B, None), (_B, None)]),
])
def test_ids_of_several_places(spark, precedence, want):
    i, e = ch.extract_id({"key": c("k"), "value": c("v"), "header": c("h")}, precedence=precedence)
    assert [tuple(r) for r in spark.createDataFrame(_IDS, "n int, k string, v string, h string").orderBy("n").select(i.alias("i"), e.alias("e")).collect()] == want
