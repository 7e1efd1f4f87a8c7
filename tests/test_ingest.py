"""Records to changes under every kind of configuration."""

import json

import pytest

from sluicework.operators.ingest import ingest
from sluicework.plans.config import ConfigError, SinkConfig

A, B = "a" + "0" * 31, "b" + "0" * 31
RECORD = "topic string, partition bigint, offset bigint, key string, value struct<sys_id:string,n:int,who:struct<name:string>,sys_mod_count:int>, headers map<string,string>"


def changes(spark, rows, columns=None, **how):
    df = spark.createDataFrame([("t", 0, i, k, v, h) for i, (k, v, h) in enumerate(rows)], RECORD)
    known = spark.createDataFrame(columns, "name string, element string, level int") if columns else None
    return [(r.op, r.table, r.sys_id, None if r.body is None else json.loads(r.body), r.dropped, r.error) for r in ingest(df, SinkConfig(**{"table": "incident"} | how), known).orderBy("offset").collect()]


FULL = (None, 5, ("x",), 9)


def test_operations_and_ids(spark):
    rows = [(A, FULL, None), (None, FULL, None), (A, None, {}), (A, (B, 1, None, None), None), ("nope", FULL, {"operation": "upsert"}), (A, (A.upper(), 1, None, None), {"operation": "put"})]
    assert changes(spark, rows, nested="flatten") == [
        ("PATCH", "incident", A, {"n": "5", "who_name": "x"}, [], None), ("CREATE", "incident", None, {"n": "5", "who_name": "x"}, [], None), ("DELETE", "incident", A, None, [], None),
        ("CREATE", "incident", None, {"n": "1"}, [], "ids disagree"), ("CREATE", "incident", None, {"n": "5", "who_name": "x"}, [], "malformed id"), ("PUT", "incident", A, {"n": "1"}, [], None),
    ]
    assert changes(spark, rows[3:4], id_conflict="value")[0][:3] == ("PATCH", "incident", B)
    assert changes(spark, rows[:1], operation="fixed", fixed_operation="PUT", nested="stringify")[0][:4] == ("PUT", "incident", A, {"n": "5", "who": '{"name":"x"}'})
    assert changes(spark, rows[:1], operation="header")[0][5] == "no operation header; who: nested struct"
    assert changes(spark, [(B, FULL, {"sys_id": A, "operation": "delete"})], ids="header")[0][:4] == ("DELETE", "incident", A, None)


def test_routing_by_header(spark):
    how = dict(routing="header", table="", allowed_tables=("task", "problem"), allow=("n",))
    got = changes(spark, [(A, FULL, {"table": " task "}), (A, FULL, {"table": "user"}), (A, FULL, {})], **how)
    assert [(g[1], g[3], g[5]) for g in got] == [("task", {"n": "5"}, None), (None, {"n": "5"}, "table not allowed"), (None, {"n": "5"}, "no table header")]


def test_unknown_fields_of_each_table(spark):
    columns = [("incident", "n", 0), ("incident", "sys_id", 0)]
    how = dict(nested="flatten")
    assert changes(spark, [(A, FULL, None), (A, None, None)], columns, unknown="fail", **how) == [("PATCH", "incident", A, {"n": "5", "who_name": "x"}, [], "unknown fields: who_name"), ("DELETE", "incident", A, None, [], None)]
    assert changes(spark, [(A, FULL, None)], columns, unknown="report", **how)[0][3:] == ({"n": "5"}, ["who_name"], None)
    assert changes(spark, [(A, FULL, None)], columns, unknown="drop", **how)[0][3:] == ({"n": "5"}, [], None)
    assert changes(spark, [(A, FULL, None)], columns, unknown="fail", **how | {"table": "other"})[0][5] == "no such table: other"
    assert changes(spark, [], columns, unknown="fail") == []


def test_configurations_that_contradict_themselves():
    for how, key in (({"operation": "fixed"}, "fixed_operation"), ({"fixed_operation": "PUT"}, "fixed_operation"), ({"operation": "guess"}, "operation"), ({"routing": "topic", "table": ""}, "routes")):
        with pytest.raises(ConfigError) as e:
            ingest(None, SinkConfig(**{"table": "incident"} | how))
        assert key in e.value.errors
