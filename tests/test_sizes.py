"""Queries on keys and sizes that larger tables bring."""

import json

import oracle
from pyspark.sql import functions as F

from sluicework import catalogue, workers
from sluicework.functions import text
from sluicework.operators import mapping as mp
from sluicework.sources import files
from sluicework.workers import cut


def test_retry_decision_with_many_users(spark, tmp_path):
    spark.range(0, 70).selectExpr("id AS event_id", "if(id % 2 = 0, id % 9, id * 10001) AS user_id").write.parquet(f"{tmp_path}/events.parquet")
    query, sql = catalogue.QUERIES["retry_decision"], catalogue.ORACLE_SQL["retry_decision"]
    got = {r.event_id: r.v for r in query(spark, str(tmp_path)).collect()}
    c = oracle.duckdb.connect()
    c.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    assert got == dict(c.execute(sql).fetchall()) and set(got.values()) == {"fail", "exhausted", "retry"}


def test_elapsed_times_add_up_as_longs(spark):
    df = spark.createDataFrame([(2**31 - 1, 500)], "e int, w int")
    got = df.select(text.retry_decision(F.lit(True), F.lit(True), F.lit(False), F.lit(1), F.col("e"), F.col("w"))).first()[0]
    assert got == "exhausted"


def _dictionary(spark):
    tables = spark.createDataFrame([(str(i), f"t{i}", str(i // 3) if i else None) for i in range(60)], "sys_id string, name string, super_class string")
    return tables, spark.createDataFrame([(f"t{i}", f"u_{i % 7}") for i in range(60) for _ in range(2)], "name string, element string")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_many_tables_are_not_broadcast_nor_grouped_where_they_are_made(spark, monkeypatch):
    few = {tuple(r) for r in mp.inherited_columns(*_dictionary(spark)).collect()}
    monkeypatch.setattr(workers, "SIDE_ROWS", 59, raising=False)
    cols = mp.inherited_columns(*_dictionary(spark))
    assert "Broadcast" not in _plan(cols) and "REPARTITION_BY_COL" in _plan(cols)
    assert {tuple(r) for r in cols.collect()} == few and len(few) > 200


def test_many_tables_columns_are_not_broadcast(spark, monkeypatch):
    rows = spark.createDataFrame([(i, f"t{i}", {"u_1": "a", f"u_{i % 9}": "b", "number": "c"}) for i in range(70)], "n int, table string, body map<string,string>")
    cols = cut(mp.inherited_columns(*_dictionary(spark)))
    few = sorted((r.n, sorted(r.body), r.dropped) for r in mp.apply_dictionary(rows, cols, "report").collect())
    monkeypatch.setattr(workers, "SIDE_ROWS", 59, raising=False)
    out = mp.apply_dictionary(rows, cols, "report")
    assert "Broadcast" not in _plan(out)
    assert sorted((r.n, sorted(r.body), r.dropped) for r in out.collect()) == few


def test_an_export_is_dealt_by_its_bytes(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(files, "_DEALT", 400, raising=False)
    monkeypatch.setattr(workers, "SIDE_ROWS", 100_000)
    rows = [{"sys_id": f"{i:032x}", "sys_updated_on": {"value": f"2026-01-01 00:00:{i:02d}", "x": 'a "}{" b\\'}, "sys_mod_count": str(i), "text": "}, {\\\"[ "} for i in range(40)]
    (tmp_path / "e.json").write_text(json.dumps({"result": ["none", *rows]}, indent=1))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500b")
    try:
        out = files.read_export(spark, f"{tmp_path}/e.json")
        assert "REPARTITION_BY_NUM" in _plan(out)
        got = sorted(map(tuple, out.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == sorted([(r["sys_id"], r["sys_updated_on"]["value"], r["sys_mod_count"], None) for r in rows] + [(None, None, None, "skipped")], key=str)
