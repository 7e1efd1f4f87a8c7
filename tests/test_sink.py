"""The streaming sink with lost tasks and replayed batches, and batched correlation, against an in-memory table API."""

import json
import os
import urllib.parse
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_writer import Tables

from sluicework.operators.resilience import RetryPolicy
from sluicework.sources import sink, table_api, writer
from sluicework.sources.auth import Basic
from sluicework.sources.client import Client

CHANGES = "topic string, partition bigint, offset bigint, op string, table string, sys_id string, body string"


class Api(Tables):
    """Answers equality and IN queries over all rows, and fails once where it is told to."""

    def __init__(self):
        super().__init__()
        self.queries, self.break_at = [], None

    def apply(self, method, path, body):
        if method == "GET" and "sysparm_query=" in path:
            p = urllib.parse.parse_qs(path.split("?")[1])
            query, limit = p["sysparm_query"][0], int(p["sysparm_limit"][0])
            self.queries.append(query)
            key, _, value = query.partition("IN") if "IN" in query else query.partition("=")
            wanted = set(value.split(",")) if "IN" in query else {value}
            return 200, [r for r in self.rows.values() if r.get(key) in wanted][:limit]
        if self.break_at and body.get("seq") == self.break_at:
            self.break_at = None
            return 400, {}
        return super().apply(method, path, body)


@pytest.fixture
def api():
    t = Api()
    yield t
    t.http.shutdown()


def feed(spark, rows, tmp_path):
    spark.createDataFrame(rows, CHANGES).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")


def start(spark, api, tmp_path, **options):
    table_api.register(spark)
    changes = spark.readStream.schema(CHANGES).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    options = {"url": api.url, "user": "u", "password": "p", "journal": f"{tmp_path}/journal", "journal.every": "1", "retry.attempts": "1"} | options
    query = sink.by_lane(changes, 3).writeStream.format("table_api").options(**options).option("checkpointLocation", f"{tmp_path}/progress").trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def patches(first, last, lanes=4):
    return [("t", p, o, "PATCH", "incident", f"r{p}", json.dumps({"seq": f"{p}-{o}"})) for o in range(first, last) for p in range(lanes)]


def sent(api):
    return [b["seq"] for m, b in api.log if m == "PATCH"]


def test_a_stream_writes_lanes_in_order(spark, api, tmp_path):
    api.rows = {f"r{p}": {"sys_id": f"r{p}"} for p in range(4)}
    feed(spark, patches(0, 5)[::-1], tmp_path)
    feed(spark, patches(5, 8), tmp_path)
    start(spark, api, tmp_path)
    assert sorted(sent(api)) == sorted(f"{p}-{o}" for p in range(4) for o in range(8))
    for p in range(4):
        assert [x for x in sent(api) if x.startswith(f"{p}-")] == [f"{p}-{o}" for o in range(8)]
    last = json.loads(sorted(Path(tmp_path, "journal/commits").iterdir())[-1].read_text())
    assert last["batch"] == 1 and sorted(last["lanes"]) == [["t", p, 7] for p in range(4)] and last["counts"] == {"PATCH": 12}
    start(spark, api, tmp_path)  # nothing new
    assert len(sent(api)) == 32


def test_a_failed_batch_comes_again_without_what_was_done(spark, api, tmp_path):
    api.rows = {f"r{p}": {"sys_id": f"r{p}"} for p in range(4)}
    feed(spark, patches(0, 2), tmp_path)
    feed(spark, patches(2, 6), tmp_path)
    api.break_at = "1-4"
    with pytest.raises(Exception, match="lanes stopped"):
        start(spark, api, tmp_path)
    assert list(Path(tmp_path, "journal/aborts").iterdir()) and "1-4" not in [b.get("seq") for m, b in api.log if m == "PATCH" and api.rows["r1"].get("seq") == "1-4"]
    before = len(api.log)
    start(spark, api, tmp_path)
    again = [b["seq"] for m, b in api.log[before:] if m == "PATCH"]
    assert again[0] == "1-4" and "1-3" not in again and {k: r["seq"] for k, r in api.rows.items()} == {f"r{p}": f"{p}-5" for p in range(4)}
    assert [x for x in again if x.startswith("1-")] == ["1-4", "1-5"]


def test_a_batch_that_was_committed_here_only_is_not_sent_again(spark, api, tmp_path):
    """The driver is lost between the sink's commit and the stream's own."""
    api.rows = {f"r{p}": {"sys_id": f"r{p}"} for p in range(4)}
    feed(spark, patches(0, 3), tmp_path)
    start(spark, api, tmp_path)
    commits = Path(tmp_path, "progress/commits")
    for f in commits.iterdir():
        if f.name.strip(".").startswith("0"):
            os.remove(f)
    start(spark, api, tmp_path)
    assert len(sent(api)) == 12


def test_a_lost_task_repeats_nothing_that_it_wrote_down(api, tmp_path):
    """The same task begins again after it died between two records."""
    api.rows = {"r0": {"sys_id": "r0"}}
    o = {"url": api.url, "user": "u", "password": "p", "journal": f"{tmp_path}/j", "journal.every": "2", "retry.attempts": "1"}
    rows = [dict(zip(sink.COLUMNS, ("t", 0, n, "PATCH", "incident", "r0", json.dumps({"seq": str(n)})))) for n in range(7)]

    class Died(BaseException):
        pass

    def until(n):
        for r in rows:
            if r["offset"] == n:
                raise Died
            yield r

    w = sink.TableStreamWriter(o)
    with pytest.raises(Died):  # before anything is sent: rows are read first
        w.write(until(4))
    assert not api.log
    w.write(iter(rows[:4]))
    message = sink.TableStreamWriter(o).write(iter(rows))
    assert sent(api) == [str(n) for n in range(7)] and message.counts == {"REPEATED": 4, "PATCH": 3} and message.lanes == [("t", 0, 6)]
    w.commit([message, None], 0)
    assert sink.TableStreamWriter(o).write(iter(rows)).counts == {"REPEATED": 7}
    w.commit([sink.LanesWritten([("t", 1, 3)], {})], 1)
    w.commit([sink.LanesWritten([("t", 0, 1)], {})], 1)
    assert sink.Journal(o["journal"]).committed() == (1, {("t", 0): 6, ("t", 1): 3})


def test_options_are_checked(spark, tmp_path):
    with pytest.raises(ValueError, match="journal"):
        sink.TableStreamWriter({"url": "https://x"})
    with pytest.raises(ValueError, match="retry"):
        sink.TableStreamWriter({"url": "https://x", "journal": "/tmp/x", "retry.attempts": "0"})
    with pytest.raises(ValueError, match="offset"):
        table_api.TableApiSource({}).streamWriter(spark.range(1).select(*(F.lit("x").alias(c) for c in sink.COLUMNS if c != "offset")).schema, False)
    assert RetryPolicy.from_options({"retry.cap": "2"}) == RetryPolicy(cap=2.0)


def test_correlation_in_few_requests(spark, api):
    n, batch = 10_000, 250
    for i in range(0, n, 2):
        api.rows[f"a{i}"] = {"sys_id": f"a{i}", "ref": f"v{i}"}
    for i in range(0, n, 10):
        api.rows[f"b{i}"] = {"sys_id": f"b{i}", "ref": f"v{i}"}
    for k in range(3000):  # one value of very many rows
        api.rows[f"c{k}"] = {"sys_id": f"c{k}", "ref": "v7"}
    api.rows["odd"] = {"sys_id": "odd", "ref": "x,y"}
    rows = [(i, f"v{i}") for i in range(n)] + [(n, "x,y"), (n + 1, None), (n + 2, ""), (n + 3, "a^b"), (n + 4, "v2"), (n + 5, "v2")]
    url = api.url
    got = {r.n: (r.resolved, r.target_id) for r in writer.correlate_remote(spark.createDataFrame(rows, "n int, ref string"), lambda: Client(url, Basic("u", "p")), "incident", "ref", batch=batch, tasks=4).collect()}
    assert len(got) == len(rows) and len(api.queries) <= n / batch + 4 + 2
    for i in range(n):
        assert got[i] == (("AMBIGUOUS", None) if i % 10 == 0 or i == 7 else ("PATCH", f"a{i}") if i % 2 == 0 else ("CREATE", None))
    assert got[n] == ("PATCH", "odd") and {got[n + k][0] for k in (1, 2, 3)} == {"RECORD_ERROR"} and got[n + 4] == got[n + 5] == ("PATCH", "a2")


def test_lost_answers_are_settled_together(spark, api, tmp_path):
    url = api.url
    rows = [("t", 0, o, "CREATE", "incident", None, json.dumps({"ref": f"v{o}"})) for o in range(6)]
    df = spark.createDataFrame(rows, CHANGES)
    api.lose = 3
    connect = lambda: Client(url, Basic("u", "p"), retry=RetryPolicy(attempts=1, initial=0.001, cap=0.001))
    out = writer.write_changes(df, connect, str(tmp_path / "o"), lanes=1, behaviour="log")
    assert out.filter("classification = 'AMBIGUOUS'").count() == 3 and len(api.rows) == 6
    api.rows["other"] = api.rows.pop("id1") | {"sys_id": "other", "ref": "w"}  # one of them didn't arrive after all
    again = writer.settle_ambiguous(df, out, connect, str(tmp_path / "again"), "incident", "ref", tasks=1)
    assert {r.op for r in again.collect()} == {"PATCH", "CREATE"} and again.count() == 3
    assert sorted(r["ref"] for r in api.rows.values()) == [*(f"v{o}" for o in range(6)), "w"] and len(api.queries) == 1
