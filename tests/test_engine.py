"""Language, scans, policies, sources and streams against small references."""

import base64
import hashlib
import json
import random
import threading
import warnings
from collections import Counter
from datetime import datetime, timedelta
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluicework.operators import assign, change, reconcile, resilience
from sluicework.plans import config
from sluicework.plans import encoded_query as eq
from sluicework.plans import keyset as ks
from sluicework.plans import offsets
from sluicework.sources import probe, table_api
from sluicework.sources.auth import AuthError, Basic, OAuth
from sluicework.sources.client import Client
from sluicework.streaming import sync

PARCEL = {"weight": "7", "shelf": "30", "label": "Glass bowls, blue", "packed_at": "2025-04-11 18:05:09", "fragile": "yes", "courier": ""}

TRUTH = [
    ("weight=7", True), ("weight=7.00", True), ("weight=8", False), ("weight!=8", True), ("shelf>4", True), ("shelf<4", False), ("shelf>=30", True), ("shelf<=29", False),
    ("courier>a", False), ("courier!=north", True), ("courier=", True), ("weight!=", True), ("labelLIKEBOWLS, b", True), ("labelSTARTSWITHglass", True), ("labelENDSWITHBLUE", True), ("labelENDSWITHred", False),
    ("weightIN6,7", True), ("weightNOT IN6,7", False), ("courierISEMPTY", True), ("u_noneISEMPTY", True), ("fragileISNOTEMPTY", True), ("weight=8^ORweight=7", True), ("weight=8^ORweight=7^shelf=1", False),
    ("weight=8^NQshelf=30", True), ("weight=7^EQ", True), ("", True), ("packed_at>2025-04-11 18:05:08", True), ("ORweight=7", True), ("label>Fa", True), ("weight>6a", True),
]


@pytest.mark.parametrize(("query", "expected"), TRUTH)
def test_truth_table(spark, query, expected):
    df = spark.createDataFrame([tuple(PARCEL.values())], ", ".join(f"{k} string" for k in PARCEL))
    assert bool(eq.apply(df, query).count()) is expected


def test_unknown_terms():
    for q in ("state~2", "javascript:x", "state=javascript:x"):
        with pytest.raises(eq.EncodedQueryError):
            eq.parse(q)
    assert eq.parse("state~2^a=1", lenient=True) == eq.parse("a=1") == eq.parse("javascript:x^a=1", lenient=True)
    assert eq.parse("a=JavaScript:x").branches[0][0][0].value == "JavaScript:x"
    assert eq.parse("xCONTAINSy").branches[0][0][0] == eq.Term("xCONTA", "IN", "Sy")


def test_filters_reach_the_scan(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/customer.parquet")
    plan = eq.apply(df.select("c_custkey", "c_mktsegment", "c_name"), "c_custkey>10^c_mktsegment=BUILDING").select("c_custkey")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(c_custkey,10), EqualTo(c_mktse" in plan and "c_name" not in plan


def test_rewind_vector(spark):
    base = datetime(2026, 1, 1)
    df = spark.createDataFrame([(f"a{i}", base + timedelta(seconds=i)) for i in range(10)], "sys_id string, sys_updated_on timestamp_ntz")
    back = ks.Cursor(base + timedelta(seconds=5), "a5").rewound(timedelta(seconds=2))
    assert [r.sys_id for r in ks.in_order(ks.sweep(df, back, base + timedelta(minutes=1))).collect()] == [f"a{i}" for i in range(4, 10)]
    assert ks.Cursor(base, "x").rewound(timedelta(0)) == ks.Cursor(base, "x")


@given(st.datetimes(datetime(1990, 1, 1), datetime(2090, 1, 1)), st.text(max_size=8), st.sampled_from(offsets.PHASES))
def test_offsets_survive(ts, sys_id, phase):
    c = ks.Cursor(ks.seconds(ts), sys_id)
    stored = offsets.encode(c, phase, "sha256:x")
    assert offsets.decode(stored, "sha256:x") == (c, phase)
    for k in offsets.KEYS:
        with pytest.raises(offsets.OffsetError):
            offsets.decode({x: v for x, v in stored.items() if x != k}, "sha256:x")
    with pytest.raises(offsets.OffsetError):
        offsets.decode(stored, "sha256:y")


def murmur(data: bytes, seed: int) -> int:
    rot = lambda x, r: (x << r | x >> 32 - r) & 0xFFFFFFFF
    mix = lambda k: rot(k * 0xCC9E2D51 & 0xFFFFFFFF, 15) * 0x1B873593 & 0xFFFFFFFF
    h, n = seed, len(data)
    for i in range(0, n - n % 4, 4):
        h = (rot(h ^ mix(int.from_bytes(data[i : i + 4], "little")), 13) * 5 + 0xE6546B64) & 0xFFFFFFFF
    if n % 4:
        h ^= mix(int.from_bytes(data[n - n % 4 :], "little"))
    h ^= n
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    return h ^ h >> 16


def test_rendezvous(spark):
    names = ["", "a", "ab", "abc", "abcd", "incident_task", "prüf"] + [f"table_{i}" for i in range(60)]
    df = spark.createDataFrame([(x,) for x in names], "alias string")
    got = {r.alias: r.h for r in df.select("alias", assign.murmur3(F.col("alias")).alias("h")).collect()}
    assert got == {x: murmur(x.encode(), assign.SEED) for x in names}
    four, five = ({r.alias: r.task for r in assign.owner(df, "alias", n).collect()} for n in (4, 5))
    assert four == {x: max(range(4), key=lambda i: (murmur(f"{x}#{i}".encode(), assign.SEED), -i)) for x in names}
    assert all(five[x] in (four[x], 4) for x in names)
    assert sum(map(len, assign.task_lists(names[7:12], 3, spark))) == 5


def test_aimd(spark):
    rng = random.Random(3)
    events = [(lane, i, rng.random() < 0.05) for lane in "ab" for i in range(300)]
    want = {}
    for lane in "ab":
        limit = resilience.AimdLimit(every=5)
        for x, _, t in events:
            if x == lane:
                limit.throttled() if t else limit.succeeded()
        want[lane] = limit.permits
    df = spark.createDataFrame(events, "lane string, i int, t boolean")
    assert {r.lane: r.permits for r in resilience.aimd_permits(df, "lane", "i", F.col("t"), every=5).collect()} == want


def test_retry_policy():
    calls, slept = [], []

    def fail():
        calls.append(1)
        raise resilience.Retryable("no", ambiguous=len(calls) > 2, wait=1.5 if len(calls) == 1 else None)

    with pytest.raises(resilience.Retryable):
        resilience.RetryPolicy().run(fail, idempotent=False, sleep=slept.append, draw=lambda a, b: b)
    assert slept == [1.5, 1.0]
    with pytest.raises(resilience.RetriesExhausted):
        resilience.RetryPolicy(attempts=3).run(fail, idempotent=True, sleep=slept.append)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("xyz"), st.sampled_from(["CREATE", "PATCH", "PUT", "DELETE"]), st.sampled_from(["f", "g"])), max_size=25))
def test_apply_changes_folds(spark, steps):
    fields = ["f", "g"]
    state = {"x": (0, {"f": "1", "g": "2"})}
    bad = []
    for i, (key, op, name) in enumerate(steps):
        body, row = {name: str(i)}, state.get(key)
        if (row is None) != (op == "CREATE"):
            bad.append((key, i))
        elif op == "DELETE":
            del state[key]
        else:
            n, old = row or (-1, dict.fromkeys(fields, ""))
            state[key] = (n + 1, (old if op == "PATCH" else dict.fromkeys(fields, "")) | body)
    at = datetime(2026, 1, 1)
    target = spark.createDataFrame([("x", 0, at, "1", "2")], "sys_id string, sys_mod_count bigint, sys_updated_on timestamp_ntz, f string, g string")
    rows = spark.createDataFrame([(k, op, i, at, {n: str(i)}) for i, (k, op, n) in enumerate(steps)], "sys_id string, op string, order int, at timestamp_ntz, body map<string,string>")
    live, rejected = change.apply_changes(target, rows.repartition(3), fields)
    assert {r.sys_id: (r.sys_mod_count, {"f": r.f, "g": r.g}) for r in live.collect()} == state
    assert sorted((r.sys_id, r.order) for r in rejected.collect()) == sorted(bad)


class Server:
    """An in-memory table API that answers the keyset queries, page by page."""

    def __init__(self, rows):
        self.rows, self.seen, self.fail = rows, [], []
        outer = self

        class Handler(BaseHTTPRequestHandler):
            def log_message(self, *_):
                pass

            def do_GET(self):  # noqa: N802
                p = {k: v[0] for k, v in parse_qs(urlparse(self.path).query).items()}
                outer.seen.append(p)
                if outer.fail:
                    self.send_response(outer.fail.pop())
                    self.send_header("Retry-After", "0")
                    self.end_headers()
                    return
                if "sys_user" in self.path:
                    self.send_response(404)
                    self.end_headers()
                    return
                tree = eq.parse(p.get("sysparm_query", ""))

                def ok(r, t):
                    return {"=": r[t.field] == t.value, ">": r[t.field] > t.value, "<=": r[t.field] <= t.value, ">=": r[t.field] >= t.value, "<": r[t.field] < t.value}[t.operator]

                found = [r for r in outer.rows if any(all(any(ok(r, t) for t in g) for g in b) for b in tree.branches)]
                found.sort(key=lambda r: [r[o.field] for o in tree.orders])
                first = int(p.get("sysparm_offset", 0))
                body = json.dumps({"result": found[first : first + int(p["sysparm_limit"])]}).encode()
                self.send_response(200)
                self.end_headers()
                self.wfile.write(body)

        self.http = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.http.serve_forever, daemon=True).start()
        self.url = f"http://127.0.0.1:{self.http.server_port}"


def _row(i: int, second: int, mod: int = 0) -> dict:
    return {"sys_id": f"a{i:05d}", "sys_updated_on": f"{datetime(2026, 1, 1) + timedelta(seconds=second):%Y-%m-%d %H:%M:%S}", "sys_mod_count": str(mod)}


@pytest.fixture
def server():
    s = Server([_row(i, i // 300) for i in range(700)])
    yield s
    s.http.shutdown()


def test_batch_source_reads_every_row_once(spark, server):
    table_api.register(spark)
    server.fail = [503]
    o = {"url": server.url, "table": "incident", "batch.size": "64", "now": "2026-01-02 00:00:00"}
    rows = spark.read.format("table_api").options(**o).load().collect()
    assert Counter(r.sys_id for r in rows) == Counter(r["sys_id"] for r in server.rows)
    many = spark.read.format("table_api").options(**o, clients="3").load()
    assert many.rdd.getNumPartitions() == 3 and many.count() == 700
    one = spark.read.format("table_api").options(**o, query="sys_id=a00007^NQsys_id=a00008").load()
    assert sorted(r.sys_id for r in one.collect()) == ["a00007", "a00008"]
    server.seen.clear()
    late = spark.read.format("table_api").options(**o, **{"display.value": "true", "query.domain": "false", "query.category": "c"}).load().filter("ts >= timestamp_ntz'2026-01-01 00:00:02' and sys_id != 'x'")
    assert late.count() == 100
    asked = server.seen[-1]
    assert asked["sysparm_display_value"] == "all" and asked["sysparm_query_no_domain"] == "true" and asked["sysparm_query_category"] == "c" and "sys_updated_on>=2026-01-01 00:00:02" in asked["sysparm_query"]


def test_a_half_read_second_at_the_high_water_mark_is_drained(server):
    """The place lies inside the newest second that may be read: its other rows come now, not with the next second."""
    server.rows = [_row(i, i // 100) for i in range(300)]
    o = {"url": server.url, "table": "incident", "batch.size": "30", "pages.per.trigger": "1", "lag.seconds": "0", "probe": "false", "now": "2026-01-01 00:00:02", "start": "2026-01-01 00:00:00"}
    reader = table_api.TableStreamReader(o)
    at, got = reader.initialOffset(), []
    for _ in range(20):
        new = reader.latestOffset()
        if new == at:
            break
        got += [r[0] for part in reader.partitions(at, new) for r in reader.read(part)]
        at = new
    assert set(got) == {r["sys_id"] for r in server.rows}
    inside = table_api.Cursor(datetime(2026, 1, 1, 0, 0, 2), "a00250")
    reader.at = inside
    last = reader.latestOffset()
    rest = [r[0] for part in reader.partitions(table_api.offsets.encode(inside, "stream", reader.scan.fingerprint), last) for r in reader.read(part)]
    assert [x for x in rest if x > "a00250"] == [f"a{i:05d}" for i in range(251, 281)]
    reader.at = table_api.Cursor(datetime(2026, 1, 1, 0, 0, 2))
    before = len(server.seen)
    assert reader.latestOffset() == reader.latestOffset() and len(server.seen) == before  # idle


def test_requests_say_what_is_not_wanted(server):
    client = Client(server.url, Basic("u", "p"))
    client.list("incident", "sys_id=a00001^ORDERBYsys_id", fields=["sys_id"], limit=3)
    asked = server.seen[-1]
    assert asked["sysparm_no_count"] == asked["sysparm_suppress_pagination_header"] == asked["sysparm_exclude_reference_link"] == "true" and asked["sysparm_limit"] == "3"
    assert Basic("user", "päss").header() == "Basic " + base64.b64encode("user:päss".encode()).decode() and "päss" not in repr(Basic("user", "päss"))


def test_the_servers_clock_counts(monkeypatch, server):
    """Its Date header moves the client's idea of now."""
    client = Client(server.url, Basic("u", "p"))

    class Answer:
        status = 200

        def __init__(self, date):
            self.headers = {"Date": date}

        def read(self, _):
            return b"{}"

    monkeypatch.setattr("time.time", lambda: 1_767_225_600.0)  # 2026-01-01
    client._read(Answer("Thu, 01 Jan 2026 00:10:00 GMT"))
    assert client.server_now() == 1_767_225_600.0 + 600
    client._read(Answer("no date"))
    assert client.drift == 600


def test_source_guards(spark, server):
    table_api.register(spark)
    o = {"url": server.url, "table": "incident", "batch.size": "4", "now": "2026-01-02 00:00:00"}
    server.rows = [_row(i, i) for i in range(10)]
    server.rows[5]["sys_updated_on"] = "2026-01-01"
    with pytest.raises(Exception, match="bad.rows=skip"):
        spark.read.format("table_api").options(**o).load().collect()
    kept = spark.read.format("table_api").options(**o, **{"bad.rows": "skip"}).load().collect()
    assert len(kept) == 9
    for r in server.rows:
        r["sys_id"] = " "
    scan = table_api.Scan(o | {"bad.rows": "skip"})
    with pytest.raises(table_api.StuckPage):
        list(scan.sweep(scan.start(), scan.high()))
    with pytest.raises(config.ConfigError) as e:
        table_api.Scan({"url": "ftp://x", "table": "incident"})
    assert set(e.value.errors) == {"url"}
    with pytest.raises(config.ConfigError) as e:
        table_api.Scan({"table": "Bad", "query": "a=1^ORDERBYb", "batch.size": "0", "bad.rows": "lose"})
    assert set(e.value.errors) == {"tables.Bad.table", "tables.Bad.query", "batch_size", "bad_rows"} or len(e.value.errors) == 4


def test_another_query_cannot_resume(server):
    o = {"url": server.url, "table": "incident", "now": "2026-01-02 00:00:00", "probe": "false"}
    one, same, other = (table_api.TableStreamReader(o | {"query": q}) for q in ("state=1", "  state=1 ", "state=2"))
    at = one.initialOffset()
    assert same._decode(at) == one._decode(at)
    with pytest.raises(offsets.OffsetError):
        other._decode(at)


def test_stream_fetches_each_page_once(server):
    """The driver asks for one row of keys, and the ranges cover the trigger without meeting."""
    r = table_api.TableStreamReader({"url": server.url, "table": "incident", "now": "2026-01-01 00:00:10", "batch.size": "50", "pages.per.trigger": "4", "clients": "3", "start": "2026-01-01 00:00:00", "overlap.seconds": "0", "poll.interval.ms": "60000"})
    server.seen.clear()
    first, end = r.initialOffset(), r.latestOffset()
    assert [p["sysparm_limit"] for p in server.seen] == ["1"] and end["sys_id"] == "a00199"
    rows = [x[0] for part in r.partitions(first, end) for x in r.read(part)]
    assert rows == [f"a{i:05d}" for i in range(200)]
    parts = r.partitions(end, r.latestOffset())
    rows += [x[0] for part in parts for x in r.read(part)]
    last = r.latestOffset()
    while (new := r.latestOffset()) != last:
        last = new
    before = len(server.seen)
    assert r.latestOffset() == last and len(server.seen) == before  # idle until the next poll
    assert len(rows) == len(set(rows)) == 400


def test_probe(server):
    c = Client(server.url, Basic("u", "p"))
    assert probe.probe(c, "incident", "", ts="sys_updated_on", sys_id="sys_id")
    with pytest.raises(probe.ProbeError, match="missing"):
        probe.probe(c, "incident", "", ts="sys_updated_on", sys_id="u_id")
    server.rows = [_row(0, 0) | {"sys_updated_on": "01.02.2026"}]
    with pytest.raises(probe.ProbeError, match="time zone"):
        probe.probe(c, "incident", "", ts="sys_updated_on", sys_id="sys_id")
    server.rows = []
    assert not probe.probe(c, "incident", "", ts="sys_updated_on", sys_id="sys_id")
    server.fail = [403]
    with pytest.raises(probe.ProbeError, match="may not read"):
        probe.probe(c, "incident", "", ts="sys_updated_on", sys_id="sys_id")
    assert probe.is_utc(" Etc/UTC ") and not probe.is_utc("Europe/Berlin") and probe.check_time_zone(c, "u") is None


@pytest.mark.parametrize("zone", ["GMT", "Asia/Tokyo"])
def test_time_zone_only_warns(zone):
    class Users:
        def list(self, *_, **__):
            return [{"user_name": "u", "time_zone": {"value": zone}}]

    with warnings.catch_warnings(record=True) as told:
        warnings.simplefilter("always")
        assert probe.check_time_zone(Users(), "u") == zone
    assert len(told) == (zone != "GMT")


def test_stream_restarts_without_loss_or_repeats(spark, server, tmp_path):
    table_api.register(spark)
    seen = []

    def run(now: str):
        df = spark.readStream.format("table_api").options(url=server.url, table="incident", now=now, **{"batch.size": "50", "pages.per.trigger": "3", "overlap.seconds": "2", "start": "2026-01-01 00:00:00"}).load()
        out = sync.dedup_stream(df.withColumn("sys_mod_count", F.col("row")["sys_mod_count"]), "2 seconds")
        q = out.writeStream.foreachBatch(lambda b, n: seen.extend((r.sys_id, r.sys_mod_count) for r in b.collect())).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        assert q.awaitTermination(120)

    for _ in range(8):
        run("2026-01-01 00:00:10")
    assert set(seen) >= {(r["sys_id"], "0") for r in server.rows}
    assert len(seen) == len(set(seen))
    server.rows[3] = _row(3, 12, 1)
    run("2026-01-01 00:00:20")
    run("2026-01-01 00:00:20")
    assert ("a00003", "1") in seen


_CHANGES = "sys_id string, op string, order int, at timestamp_ntz, body map<string,string>, topic string, partition bigint, offset bigint"


def test_batches_apply_once(spark, tmp_path):
    table = sync.VersionedTable(spark, str(tmp_path / "t"), ["f"], buckets=8)
    run = sync.apply_batches(table, reports=str(tmp_path / "r"), dead_letters=str(tmp_path / "d"), not_found="fail")
    at = datetime(2026, 1, 1)
    rows = [("x", "CREATE", 1, at, {"f": "1"}, "t", 0, 1), ("y", "PATCH", 2, at, {"f": "2"}, "t", 0, 2), (None, "PATCH", 2, at, {"f": "3"}, "t", 1, 2), (None, "CREATE", 2, at, {"f": "4"}, "t", 2, 2), (None, "CREATE", 2, at, {"f": "5"}, "t", 3, 2)]
    first = spark.createDataFrame(rows, _CHANGES)
    run(first, 0)
    run(first, 0)
    for n in range(1, 5):
        run(spark.createDataFrame([("x", "PATCH", 3, at, {"f": str(n)}, "t", 0, 3 + n)], _CHANGES), n)
    got = table.read().collect()
    assert Counter((r.sys_mod_count, r.f) for r in got) == Counter([(4, "4"), (0, "4"), (0, "5")]) and len({r.sys_id for r in got}) == 3
    letters = spark.read.parquet(str(tmp_path / "d")).collect()
    assert Counter((r.sys_id, r.partition, r.reason) for r in letters) == Counter([("y", 0, "not found"), (None, 1, "no id")])
    told = spark.read.json(str(tmp_path / "r" / "batch=0")).collect()
    assert len(told) == 5 and sum(json.loads(r.value)["rejected"] for r in told) == 2
    assert len(table.files.names("manifests")) == 2 and len(table.files.names("data")) <= 4  # old versions are gone


def test_a_hot_key_is_folded_in_runs(spark):
    at = datetime(2026, 1, 1)
    rows = [("hot", "DELETE" if i % 7 == 3 else "CREATE" if i % 7 == 4 else "PATCH", i, at, {"f": str(i)}) for i in range(300)] + [(f"k{i}", "CREATE", i, at, {"f": "1"}) for i in range(100)]
    rows += [("hot", "PATCH", 2.5, at, {"g": "x"})]
    df = spark.createDataFrame([(a, b, float(c), d, e) for a, b, c, d, e in rows], "sys_id string, op string, order double, at timestamp_ntz, body map<string,string>").repartition(7)
    target = spark.createDataFrame([("hot", 5, at, "0", "1"), ("idle", 1, at, "a", "b")], "sys_id string, sys_mod_count bigint, sys_updated_on timestamp_ntz, f string, g string")
    live, rejected = change.apply_changes(target, df, ["f", "g"])
    got = {r.sys_id: (r.sys_mod_count, r.f, r.g) for r in live.collect()}
    state, bad = (5, "0", "1"), 0
    for _, op, i, _, body in sorted((r for r in rows if r[0] == "hot"), key=lambda r: r[2]):
        if (state is None) != (op == "CREATE"):
            bad += 1
        elif op == "DELETE":
            state = None
        else:
            n, f, g = state or (-1, "", "")
            state = (n + 1, body.get("f", f), body.get("g", g))
    assert got["hot"] == state and got["idle"] == (1, "a", "b") and len(got) == 102 and rejected.count() == bad


def test_a_failed_table_is_parked():
    class Query:
        def __init__(self, error=None):
            self.error = error

        isActive = False  # noqa: N815

        def exception(self):
            return self.error

    assert sync.await_tables({"a": Query(), "b": Query()}) == {}
    assert list(sync.await_tables({"a": Query(), "b": Query(RuntimeError("x"))})) == ["b"]
    with pytest.raises(RuntimeError):
        sync.await_tables({"b": Query(RuntimeError("x"))})
    with pytest.raises(KeyError):
        sync.run_tables({"a": lambda: {}["x"]})


def test_oauth_is_fetched_once_and_falls_back():
    posts, now = [], [0.0]

    def post(url, form):
        posts.append(form["grant_type"])
        if form["grant_type"] == "refresh_token":
            raise AuthError("expired")
        return {"access_token": f"t{len(posts)}", "refresh_token": "r", "expires_in": 100}

    auth = OAuth("u", "c", "s", post=post, clock=lambda: now[0])
    threads = [threading.Thread(target=auth.header) for _ in range(20)]
    [t.start() for t in threads], [t.join() for t in threads]
    assert posts == ["client_credentials"]
    now[0] = 80.0
    assert auth.header() == "Bearer t3" and posts[1:] == ["refresh_token", "client_credentials"]


def test_digests_are_free_of_order(spark):
    ids = [f"{i:04d}" for i in range(500)]
    want = hashlib.sha256("\n".join(ids).encode()).hexdigest()
    random.Random(1).shuffle(ids)
    df = spark.createDataFrame([(x,) for x in [*ids, ids[0], "", None]], "sys_id string")
    assert reconcile.exact_digest(df.repartition(5)).first()[0] == want
    assert reconcile.digest(df).first()[0] == reconcile.digest(df.repartition(3)).first()[0]
    assert reconcile.exact_digest(df.limit(0)).first()[0] == hashlib.sha256(b"").hexdigest()
