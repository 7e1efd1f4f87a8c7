"""Dumps and exports as other tools write them, against the json module; digest trees against whole comparisons."""

import json
import random

import pytest
from pyspark.sql import functions as F

from sluicework.operators import reconcile
from sluicework.sources import files

A, B, C = ("abc"[i] + "0" * 31 for i in range(3))


def test_dump_lines(spark):
    lines = [f'"{A}"\t"2026-01-01 00:00:00"\t"3"\r', f" {B} \tnull\tnull", f"{C}", "sys_id\tts\tmod", "null\t1", "", " \t", "# comment", "  # odd", A.upper(), "bad\t1", None]
    got = [tuple(r) for r in files.read_dump(spark.createDataFrame([(x,) for x in lines], "value string")).collect()]
    assert got == [(A, "2026-01-01 00:00:00", "3", None), (B, None, None, None), (C, None, None, None), *[(None, None, None, "skipped")] * 3]
    table = spark.createDataFrame([(A, "2026-01-01 00:00:00", "3"), (B, "2026-01-01 00:00:00", "1"), (C, "2026-01-01 00:00:00", "1")], "sys_id string, ts string, mod string")
    dump = files.read_dump(spark.createDataFrame([(x,) for x in lines], "value string"))
    one = reconcile.audit_summary(reconcile.audit(table, dump, until="2026-06-01")).first()
    assert (one.missing, one.stale, one.out_of_window, one.unparsable_lines, one.dump_lines) == (0, 0, 0, 3, 3)  # a null timestamp is in every window


def document(rng, rows):
    """Rows with everything that could be taken for structure, and elements that are no rows."""
    odd = ['}\\" {[ é', 'x"y', "\\", '\\\\"', "]}", "a\nb", "", "{", '"}"']
    out = []
    for i in range(rows):
        cell = f"2026-01-{i % 28 + 1:02d} 00:00:00"
        out.append({"t": rng.choice(odd), "sys_id": rng.choice([f"{i:032x}", {"display_value": rng.choice(odd), "value": f"{i:032x}"}]), "sys_updated_on": {"value": cell, "n": {"a": [1, {"b": rng.choice(odd)}]}}, "sys_mod_count": str(i)})
        if rng.random() < 0.2:
            out.append(rng.choice([1, None, "text", True]))
        if rng.random() < 0.1:
            out.append({"sys_id": "short"})
    return out


def expected(elements):
    out = []
    for e in elements:
        value = lambda x: x["value"] if isinstance(x, dict) else x
        if not isinstance(e, dict) or len(value(e["sys_id"])) != 32:
            out.append((None, None, None, "skipped"))
        else:
            out.append((value(e["sys_id"]), value(e["sys_updated_on"]), e["sys_mod_count"], None))
    return sorted(out, key=str)


@pytest.fixture
def cut_at(spark):
    """Sets the size of the ranges that files are read by."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}

    def put(size):
        spark.conf.set(keys[0], str(size))
        spark.conf.set(keys[1], "1")

    yield put
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("form", ["list", "object", "pretty", "minified", "no end of line"])
def test_exports_however_they_are_written(spark, tmp_path, cut_at, form):
    elements = document(random.Random(form), 12)
    doc = elements if form in ("list", "no end of line") else {"meta": "a }\"b", "result": elements}
    text = json.dumps(doc, indent=2 if form in ("pretty", "no end of line") else None, separators=(",", ":") if form == "minified" else None, ensure_ascii=form == "list")
    (tmp_path / "e.json").write_text(text + ("" if form in ("minified", "no end of line") else "\n"))
    assert files.read_export(spark, f"{tmp_path}/e.json").count() == len(elements)
    for size in (37, 90, 100_000):
        cut_at(size)
        assert sorted(map(tuple, files.read_export(spark, f"{tmp_path}/e.json").collect()), key=str) == expected(elements)


def test_every_cut_of_a_small_export(spark, tmp_path, cut_at):
    elements = [{"sys_id": A, "sys_updated_on": 't}"', "sys_mod_count": "1"}, 7, {"sys_id": {"value": B}, "sys_updated_on": {"value": "u\\"}, "sys_mod_count": "2"}]
    text = json.dumps({"result": elements})
    (tmp_path / "e.json").write_text(text)
    for size in range(1, len(text) + 1, 5):
        cut_at(size)
        assert sorted(map(tuple, files.read_export(spark, f"{tmp_path}/e.json").collect()), key=str) == expected(elements), size


def test_several_exports_and_an_empty_one(spark, tmp_path):
    parts = [document(random.Random(i), 5) for i in range(3)]
    for i, p in enumerate(parts):
        (tmp_path / f"{i}.json").write_text(json.dumps(p if i else {"result": p}))
    (tmp_path / "none.json").write_text('{"result": []}\n')
    assert sorted(map(tuple, files.read_export(spark, str(tmp_path)).collect()), key=str) == sorted((x for p in parts for x in expected(p)), key=str)


@pytest.mark.parametrize("text", ['{"error": {"message": "x"}}', '[{"sys_id": "a"}', '[{"sys_id": "a"},', '{"result": [{"sys_id": {"value": "a"', "no json at all", '[{"a": "never ended}]'])
def test_what_is_no_whole_export_raises(spark, tmp_path, text):
    (tmp_path / "e.json").write_text(text)
    with pytest.raises(Exception, match="no export"):
        files.read_export(spark, f"{tmp_path}/e.json").collect()
    with pytest.raises(Exception, match="no whole export"):
        reconcile.unwrap_export(spark.createDataFrame([(text,)], "value string")).collect()


def versions(rng, n):
    return [(f"{i:032x}", f"2026-01-{rng.randrange(1, 29):02d} 00:00:00", str(rng.randrange(3))) for i in range(n)]


def test_drilldown_joins_what_differs(spark, tmp_path):
    rng = random.Random(8)
    table = versions(rng, 3000)
    dump = [r for r in table if r[0] not in {f"{i:032x}" for i in (5, 900)}] + [table[77], ("f" * 32, None, None)]
    dump[1500] = (dump[1500][0], "2020-01-01 00:00:00", "0")
    schema = "sys_id string, ts string, mod string"
    t, d = spark.createDataFrame(table, schema), spark.createDataFrame(dump, schema).repartition(5)
    got = {tuple(r) for r in reconcile.drilldown(t, d).collect()}
    assert got == {tuple(r) for r in reconcile.compare(t, d).filter("missing OR extra OR stale OR duplicated").collect()} and len(got) == 5
    leaves = reconcile.differing(reconcile.digest_tree(t), reconcile.digest_tree(d))
    assert leaves.count() <= 5
    joined = t.join(leaves, F.substring(F.md5("sys_id"), 1, reconcile.LEVELS) == F.col("leaf"), "left_semi")
    assert joined.count() <= 10  # of 3,000
    assert not reconcile.differing(reconcile.digest_tree(t), reconcile.digest_tree(t.repartition(7))).count()
    twice = d.union(d)
    assert {tuple(r) for r in reconcile.drilldown(t, twice).collect()} == {tuple(r) for r in reconcile.compare(t, twice).filter("missing OR extra OR stale OR duplicated").collect()}
    stored = []
    for name, df in (("t", t), ("d", d)):  # trees of earlier runs
        reconcile.digest_tree(df).write.partitionBy("level").parquet(f"{tmp_path}/{name}")
        stored.append(spark.read.schema("node string, n long, s0 long, s1 long, s2 long, s3 long, level int").parquet(f"{tmp_path}/{name}"))
    assert {tuple(r) for r in reconcile.drilldown(t, d, tuple(stored)).collect()} == got
    none = t.filter("sys_id = ''")
    assert {r.sys_id for r in reconcile.drilldown(none, t).collect()} == {r[0] for r in table} and not reconcile.drilldown(none, none).count()
