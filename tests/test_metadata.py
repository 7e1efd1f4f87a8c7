"""Inherited columns of many tables, and the audit of sweeps, by plain Python."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from sluicework.operators import mapping as mp
from sluicework.plans import keyset as ks

TABLES = "sys_id string, name string, super_class string"


def chains(tables, depth=32):
    """A table and its ancestors, nearest first, until one repeats or isn't there."""
    by_id = {i: (n, up) for i, n, up in tables}
    out = {}
    for i, (name, _) in by_id.items():
        chain, now = [], i
        while now in by_id and now not in chain and len(chain) < depth:
            chain.append(now)
            now = by_id[now][1]
        out[name] = [by_id[x][0] for x in chain]
    return out


def test_chains_of_all_tables(spark):
    rng = random.Random(3)
    tables = [("1", "task", None), ("2", "incident", "1"), ("3", "incident_task", "2"), ("4", "a", "5"), ("5", "b", "4"), ("6", "self", "6"), ("7", "orphan", "99"), ("8", "blank", "")]
    tables += [(f"c{i}", f"chain{i}", f"c{i - 1}" if i else "3") for i in range(60)]
    tables += [(f"r{i}", f"random{i}", f"r{rng.randrange(200)}") for i in range(200)]
    df = spark.createDataFrame(tables, TABLES)
    for depth in (1, 2, 5, 32):
        got = {}
        for r in mp.inheritance(df, depth=depth).collect():
            got.setdefault(r.name, []).append((r.level, r.ancestor))
        assert {k: [a for _, a in sorted(v)] for k, v in got.items()} == chains(tables, depth)
        assert all([level for level, _ in sorted(v)] == list(range(len(v))) for v in got.values())
    for name in ("incident_task", "a", "chain40"):  # as one table's own chain has it
        assert [r.name for r in mp.superclass_chain(df, name).orderBy("level").collect()] == chains(tables)[name]
    odd = spark.createDataFrame([("1", "x", "2"), ("1", "w", None), (None, "y", "1"), ("2", None, "1")], TABLES)
    assert [tuple(r) for r in mp.inheritance(odd).collect()] == [("w", "w", 0)] and not mp.inheritance(df.limit(0)).collect()


def test_columns_of_all_tables(spark):
    tables = spark.createDataFrame([("1", "task", None), ("2", "incident", "1"), ("3", "child", "2")], TABLES)
    words = spark.createDataFrame([("task", "number"), ("task", ""), ("task", None), ("task", "state"), ("incident", "state"), ("incident", "caller"), ("incident", "caller"), ("gone", "x")], "name string, element string")
    cols = mp.inherited_columns(tables, words)
    assert sorted(tuple(r) for r in cols.filter("name = 'child'").collect()) == [("child", "caller", 1), ("child", "number", 2), ("child", "state", 1), ("child", "sys_id", 0)]
    rows = spark.createDataFrame([(1, "child", {"state": "1", "u_x": "2"}), (2, "task", {"caller": "1"}), (3, "none", {"a": "1"}), (4, None, {"a": "1"}), (5, "task", {})], "n int, table string, body map<string,string>")
    fail = {r.n: r.unknown_error for r in mp.apply_dictionary(rows, cols, "fail").collect()}
    assert fail == {1: "unknown fields: u_x", 2: "unknown fields: caller", 3: "no such table: none", 4: "no such table: ", 5: None}
    kept = {r.n: (r.body, r.dropped) for r in mp.apply_dictionary(rows, cols, "report").collect()}
    assert kept[1] == ({"state": "1"}, ["u_x"]) and kept[5] == ({}, [])


def test_first_sweeps(spark):
    rng = random.Random(5)
    start = datetime(2026, 1, 1)
    at = sorted({start + timedelta(seconds=rng.randrange(200_000), milliseconds=rng.randrange(1000)) for _ in range(40)})
    lag, overlap = timedelta(seconds=7), timedelta(seconds=600)
    rows = []
    for i in range(600):
        ts = start + timedelta(seconds=rng.randrange(205_000), milliseconds=rng.randrange(1000))
        rows.append((i, ts, ts + timedelta(seconds=rng.choice([0, 1, 30, 4000, 20_000]))))
    want = {}
    for i, ts, committed in rows:
        want[i] = (None, False)
        for n, a in enumerate(at):
            high = ks.high_water_mark(a, lag)
            if a >= committed and ks.seconds(ts) <= high:
                low = ks.Cursor(ks.high_water_mark(at[n - 1], lag)).rewound(overlap).ts if n else None
                want[i] = (a, False) if low is None or ks.seconds(ts) > low else (None, True)
                break
    df = spark.createDataFrame(rows, "id int, ts timestamp_ntz, committed timestamp_ntz").withColumn("all", F.lit("clash")).repartition(5)
    sweeps = spark.createDataFrame([(a,) for a in [*at, at[3]]] + [(None,)], "at timestamp_ntz")
    got = ks.first_sweeps(df.drop("all"), sweeps, "committed", lag=lag, overlap=overlap, keys=ks.Keys("ts", "id", "id"))
    assert {r.id: (r.sweep, r.lost) for r in got.collect()} == want and {w[1] for w in want.values()} == {True, False}
    none = ks.first_sweeps(df.drop("all"), sweeps.limit(0), "committed", lag=lag, overlap=overlap, keys=ks.Keys("ts", "id", "id"))
    assert {(r.sweep, r.lost) for r in none.collect()} == {(None, False)}
