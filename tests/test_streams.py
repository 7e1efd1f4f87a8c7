"""Keyed stream state over restarts, schemas that grow, and plans of resumed scans."""

import contextlib
import io
import random
import re
from collections import OrderedDict

import oracle
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sluicework.catalogue import ORACLE_SQL, QUERIES, streams
from sluicework.operators import change, shape
from sluicework.streaming import versions


@pytest.fixture
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, versions.PROVIDER)
    yield
    spark.conf.set(key, before)


def run(stream, tmp_path):
    """One start of the stream: it reads all files that are there."""
    query = stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/progress").option("path", f"{tmp_path}/out").trigger(availableNow=True).start()
    query.awaitTermination()


def feed(spark, rows, schema, tmp_path):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")


def test_bounded_dedup_is_a_queue_over_restarts(spark, rocks, tmp_path):
    rng = random.Random(1)
    schema = "arrival long, source string, sys_id string, mod int"
    rows = [(i, rng.choice(["a", "b", None]), rng.choice([f"id{rng.randrange(90)}", f"id{rng.randrange(30)}", None]), rng.randrange(2)) for i in range(1500)]
    caches, want = {}, []
    for arrival, source, sys_id, mod in rows:
        seen = caches.setdefault(source, OrderedDict())
        if (sys_id, mod) not in seen:
            want.append(arrival)
            seen[sys_id, mod] = True  # a version that comes again keeps its old place
            if len(seen) > 50:
                seen.popitem(last=False)
    for part in range(5):  # the query ends and starts again after each two files
        for half in range(2):
            first = part * 300 + half * 150
            own = rows[first : first + 150]
            rng.shuffle(own)
            feed(spark, own, schema, tmp_path)
        source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        run(versions.dedup_bounded(source, 50, stream="source", version=["sys_id", "mod"], arrival="arrival"), tmp_path)
    got = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(r.arrival for r in got.collect()) == want and got.columns == ["arrival", "source", "sys_id", "mod"]
    with pytest.raises(ValueError, match="at least"):
        versions.SeenVersions(0)


def test_order_guard_follows_lanes_over_restarts(spark, rocks, tmp_path):
    rng = random.Random(2)
    schema = "arrival long, lane int, at timestamp, id string"
    import datetime

    start = datetime.datetime(2026, 1, 1)
    rows = [(i, rng.randrange(4), start + datetime.timedelta(seconds=i // 3 - rng.choice([0, 0, 0, 5])), f"{rng.randrange(50):03d}") for i in range(400)]
    last, want = {}, {}
    for arrival, lane, at, sys_id in rows:
        want[arrival] = lane in last and (at, sys_id) <= last[lane]
        last[lane] = at, sys_id
    for part in range(4):
        feed(spark, rows[part * 100 : part * 100 + 100], schema, tmp_path)
        source = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        run(versions.guard_order(source, lane="lane", ts="at", sys_id=F.col("id"), arrival="arrival"), tmp_path)
    assert {r.arrival: r.violates for r in spark.read.parquet(f"{tmp_path}/out").collect()} == want and any(want.values())


def test_a_batch_calls_python_once_for_many_lanes():
    class Places(dict):
        def getValue(self, key):  # noqa: N802
            return self.get(key)

        updateValue = dict.__setitem__  # noqa: N815

    guard = versions.LastPlaces()
    guard.last = Places({("b",): (7, "x")})
    names = ["n", "sluice_arrival", "sluice_second", "sluice_id", "sluice_lane", "sluice_bucket"]
    few = [(3, 9, "a", "b"), (1, 7, "x", "b"), (2, 9, "b", "b"), (4, None, "c", "b"), (5, 1, None, "b"), (6, 1, "a", "b"), (9, 5, "a", None), (8, 5, "a", None)]
    frame = pd.DataFrame([(n, n, second, sys_id, lane, 0) for n, second, sys_id, lane in few], columns=names)
    many = pd.DataFrame([(100 + i, i, 5, "a", f"l{i}", 0) for i in range(500)], columns=names)
    (out,) = guard.handleInputRows((0,), iter([frame, many]), None)
    assert set(out.n[out.violates]) == {1, 3, 9} and len(out) == 508 and list(out.columns) == ["n", "violates"]
    assert guard.last[("b",)] == (1, "a") and guard.last[(None,)] == (5, "a") and len(guard.last) == 502


def test_order_guard_over_restarts_where_cells_are_missing(spark, rocks, tmp_path):
    rng = random.Random(3)
    schema = "arrival long, lane int, at timestamp, id string"
    import datetime

    start = datetime.datetime(2026, 1, 1)
    rows = [(i, rng.choice([None, *range(9)]), rng.choice([None, start + datetime.timedelta(seconds=i // 20, milliseconds=rng.randrange(999))]), rng.choice([None, f"{rng.randrange(9)}"])) for i in range(300)]
    last, want = {}, {}
    for arrival, lane, at, sys_id in rows:
        at = at and at.replace(microsecond=0)
        at0, id0 = last.get(lane, (None, None))
        want[arrival] = bool(at and at0) and (at < at0 or at == at0 and sys_id is not None and id0 is not None and sys_id <= id0)
        last[lane] = at, sys_id
    for part in range(3):
        feed(spark, rows[part * 100 : part * 100 + 100], schema, tmp_path)
        source = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        run(versions.guard_order(source, lane="lane", ts="at", sys_id=F.col("id"), arrival="arrival", keep=["arrival"], buckets=3), tmp_path)
    got = spark.read.parquet(f"{tmp_path}/out")
    assert {r.arrival: r.violates for r in got.collect()} == want and any(want.values()) and got.columns == ["arrival", "violates"]


@pytest.mark.parametrize("name", ["order_guard", "dedup_bounded"])
def test_a_batch_is_written_by_many_tasks_and_whole(spark, monkeypatch, tmp_path, name):
    lane = "id % 7" if name == "dedup_bounded" else "if(id % 7 = 0, null, id % 7)"
    ids = "if(id = 77, null, id)"
    spark.range(0, 400, 1, 8).selectExpr(f"{ids} AS event_id", f"{lane} AS user_id", "timestamp_ntz '2026-01-01' + make_dt_interval(0, 0, 0, id) AS ts", "if(id % 2 = 0, 'a', 'b') AS event_type").write.parquet(f"{tmp_path}/events.parquet")
    paths, fresh = {}, streams.new_path
    monkeypatch.setattr(streams, "new_path", lambda spark, what: paths.setdefault(what, fresh(spark, what)))
    before = spark.conf.get("spark.sql.files.openCostInBytes"), spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000b")
    try:
        out = QUERIES[name](spark, str(tmp_path))
        got = oracle.bag(out.columns, out.collect())
        files = len(spark.read.parquet(paths["arrivals"]).inputFiles())
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before[0])
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[1])
    c = oracle.duckdb.connect()
    c.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    found = c.execute(ORACLE_SQL[name])
    assert got == oracle.bag([d[0] for d in found.description], found.fetchall()) and sum(got.values()) == (400 if name == "order_guard" else 14)
    assert files > streams.BATCHES


def test_fields_grow_with_batches(spark):
    rows = [(1, 1, ["a"]), (1, 2, ["b", "a"]), (2, 1, None), (2, 2, []), (3, 2, ["d", "c"]), (3, 1, ["c_display_value", "a"]), (4, 1, ["a"])]
    df = spark.createDataFrame(rows, "batch int, place int, names array<string>").repartition(3)
    got = {r.batch: (r.version, r.fields) for r in shape.field_versions(df, "batch", "place", F.col("names")).collect()}
    three = ["a", "b", "c_display_value", "d", "c"]
    assert got == {1: (1, ["a", "b"]), 2: (1, ["a", "b"]), 3: (2, three), 4: (2, three)}
    late = spark.createDataFrame([(1, 1, None), (2, 1, ["x"])], "batch int, place int, names array<string>")
    assert sorted((r.batch, r.version, r.fields) for r in shape.field_versions(late, "batch", "place", F.col("names")).collect()) == [(1, 1, []), (2, 2, ["x"])]
    assert not shape.field_versions(df.filter("batch > 9"), "batch", "place", F.col("names")).collect()


def explained(df):
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", ["keyset_sweep", "keyset_page"])
def test_a_resumed_scan_is_pruned_from_both_ends(spark, sf_dir, name):
    pushed = re.search(r"PushedFilters: \[(.*)\]", explained(QUERIES[name](spark, sf_dir)))[1]
    assert "GreaterThanOrEqual(o_orderdate,1995-03-15" in pushed and "LessThan(o_orderdate,1995-09-01T00:00:01" in pushed


def test_a_lookup_by_id_reaches_the_scan(spark, sf_dir):
    assert "EqualTo(o_orderkey,7)" in explained(QUERIES["point_lookup"](spark, sf_dir))


def test_lanes_stop_without_a_window(spark):
    rows = [("t", 1, o, o == 5 or o == 7) for o in range(10)] + [("t", 2, o, False) for o in range(3)] + [(None, 1, o, o == 0) for o in range(2)]
    df = spark.createDataFrame(rows, "topic string, partition int, offset long, stops boolean")
    got = change.with_lane_stop(df, F.col("stops"))
    assert {(r.topic, r.partition, r.offset) for r in got.filter("attempted").collect()} == {("t", 1, o) for o in range(6)} | {("t", 2, o) for o in range(3)} | {(None, 1, 0)}
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()
