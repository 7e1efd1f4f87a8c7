"""Write policies against an in-memory table API, and configuration checks."""

import gzip
import json
import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from sluicework.operators.resilience import Limiter, Retryable, RetryPolicy
from sluicework.plans import config
from sluicework.sources.auth import Basic
from sluicework.sources.client import ApiError, Client, Metadata, MetadataCache, wait_of
from sluicework.sources.writer import BatchFailed, BatchRetry, Writer, send_batches, write_changes


class Tables:
    """Rows by id; `lose` answers are dropped after they were applied, `refuse` statuses come first."""

    def __init__(self):
        self.rows, self.log, self.lose, self.refuse = {}, [], 0, []
        outer = self

        class Handler(BaseHTTPRequestHandler):
            def log_message(self, *_):
                pass

            def run(self):
                size = int(self.headers.get("Content-Length") or 0)
                body = json.loads(self.rfile.read(size)) if size else {}
                with outer.lock:
                    status, answer = outer.apply(self.command, self.path, body)
                self.send_response(status)
                if status == 429:
                    self.send_header("Retry-After", "0")
                self.end_headers()
                if status != 204:
                    self.wfile.write(json.dumps({"result": answer}).encode())

            do_GET = do_POST = do_PATCH = do_PUT = do_DELETE = run

        self.lock = threading.Lock()
        self.http = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.http.serve_forever, daemon=True).start()
        self.url = f"http://127.0.0.1:{self.http.server_port}"

    def apply(self, method, path, body):
        self.log.append((method, body))
        if self.refuse:
            return self.refuse.pop(0), {}
        parts = path.split("?")[0].split("/")
        sys_id = parts[5] if len(parts) > 5 else None
        if method == "GET" and not sys_id:
            key, value = path.split("sysparm_query=")[1].split("&")[0].split("%3D")
            return 200, [r for r in self.rows.values() if r.get(key) == value][:2]
        if method == "POST":
            sys_id = body.get("sys_id") or f"id{len(self.rows)}"
            self.rows[sys_id] = body | {"sys_id": sys_id}
            status = 201
        elif sys_id not in self.rows:
            return 404, {}
        elif method == "DELETE":
            del self.rows[sys_id]
            status = 204
        else:
            self.rows[sys_id] = (self.rows[sys_id] if method == "PATCH" else {"sys_id": sys_id}) | body
            status = 200
        if self.lose:
            self.lose -= 1
            return 504, {}
        return status, self.rows.get(sys_id, {})


@pytest.fixture
def tables():
    t = Tables()
    yield t
    t.http.shutdown()


def client(t, **how):
    return Client(t.url, Basic("u", "p"), retry=RetryPolicy(initial=0.001, cap=0.001, **how))


@pytest.mark.parametrize(("policy", "rows", "posts", "classification"), [("retry", 2, 2, None), ("fail_ambiguous", 1, 1, "AMBIGUOUS"), ("correlation_lookup", 1, 1, None)])
def test_lost_answer_of_a_create(tables, policy, rows, posts, classification):
    tables.lose = 1
    w = Writer(client(tables), create=policy, correlation_field="ref")
    _, _, bad, _ = w.write("CREATE", "incident", None, {"ref": "r1"})
    assert bad == classification and len(tables.rows) == rows and sum(m == "POST" for m, _ in tables.log) == posts


def test_two_matches_are_ambiguous(tables):
    tables.rows = {i: {"sys_id": i, "ref": "r1"} for i in ("a", "b")}
    tables.refuse = [504]
    assert Writer(client(tables), create="correlation_lookup", correlation_field="ref").write("CREATE", "incident", None, {"ref": "r1"})[2] == "AMBIGUOUS"
    assert Writer(client(tables), create="correlation_lookup", correlation_field="ref").write("CREATE", "incident", None, {"ref": "x^NQy=1"})[2] == "RECORD_ERROR"
    assert len(tables.rows) == 2


def test_delete_is_sent_again(tables):
    tables.rows, tables.lose = {"a": {"sys_id": "a"}}, 1
    assert Writer(client(tables)).write("DELETE", "incident", "a", {}) == ("a", 204, None, None) and not tables.rows


@pytest.mark.parametrize("policy", ["fail", "ignore", "create"])
@pytest.mark.parametrize("op", ["PATCH", "PUT", "DELETE"])
def test_missing_rows(tables, policy, op):
    sys_id, _, bad, _ = Writer(client(tables), not_found=policy).write(op, "incident", "a1", {"f": "1"})
    assert sys_id == "a1" and bad == ("NOT_FOUND" if policy == "fail" else None) and len(tables.rows) == (policy == "create" and op != "DELETE")


def test_throttling_and_classes(tables):
    c = client(tables)
    tables.rows, tables.refuse = {"a": {"sys_id": "a"}}, [429, 503]
    assert Writer(c).write("PATCH", "incident", "a", {"f": "1"})[1] == 200 and c.limit.permits == 4 and c.stats.throttled == 1 and c.stats.retries == 2
    for status, want in ((403, "PERMISSION"), (400, "RECORD_ERROR"), (409, "CONFLICT")):
        tables.refuse = [status]
        assert Writer(c).write("PATCH", "incident", "a", {})[2] == want
    tables.refuse = [503] * 9
    assert Writer(client(tables, attempts=3)).write("PATCH", "incident", "a", {})[2] == "RETRIES_EXHAUSTED"
    tables.refuse = []
    with pytest.raises(ValueError):
        c.get("Bad/../name", "a")
    assert c.get("incident", "zz") is None and isinstance(ApiError(500, "x"), RuntimeError)


def test_waits():
    assert wait_of("5", 0) == 5 and wait_of("-1", 0) == 0 and wait_of("x", 0) is None and wait_of("Thu, 01 Jan 1970 00:01:00 GMT", 0) == 60


def test_metadata_cache():
    loads, now = [], [0.0]
    cache = MetadataCache(lambda t: loads.append(t) or [t], clock=lambda: now[0])
    assert cache.columns("a") == cache.columns("a") == ["a"] and loads == ["a"]
    now[0] = 601
    cache.columns("a")
    cache.evict()
    cache.columns("a")
    assert len(loads) == 3


def test_lanes_stop_in_order(spark, tables, tmp_path):
    tables.rows = {f"r{p}": {"sys_id": f"r{p}"} for p in range(4)}
    url = tables.url
    rows = [("t", p, o, "PATCH", "incident", "gone" if (p, o) == (1, 3) else f"r{p}", json.dumps({"seq": str(o)})) for p in range(4) for o in range(6)]
    df = spark.createDataFrame(rows[::-1], "topic string, partition bigint, offset bigint, op string, table string, sys_id string, body string")
    got = {(r.partition, r.offset): r for r in write_changes(df, lambda: Client(url, Basic("u", "p")), str(tmp_path / "o"), lanes=3).collect()}
    assert [got[1, o].attempted for o in range(6)] == [True] * 4 + [False] * 2 and got[1, 3].classification == "NOT_FOUND"
    assert {k: r["seq"] for k, r in tables.rows.items()} == {"r0": "5", "r1": "2", "r2": "5", "r3": "5"}


_SENT = "topic string, partition bigint, offset bigint, op string, table string, sys_id string, body string"


def test_requests_go_out_once(spark, tables, tmp_path):
    url = tables.url
    df = spark.createDataFrame([("t", 0, o, "CREATE", "incident", None, json.dumps({"n": str(o)})) for o in range(3)], _SENT)
    out = write_changes(df, lambda: Client(url, Basic("u", "p")), str(tmp_path / "o"))
    assert out.filter("classification is null").count() == 3 and out.filter("classification is not null").count() == 0
    assert sum(m == "POST" for m, _ in tables.log) == 3


def test_batches_are_sent_until_they_are_through(spark, tables, tmp_path):
    url = tables.url
    tables.rows = {"a": {"sys_id": "a"}}
    batch = spark.createDataFrame([("t", p, o, "PATCH", "incident", "a", json.dumps({f"f{p}": str(o)})) for p in range(2) for o in range(2)], _SENT)
    connect = lambda: Client(url, Basic("u", "p"), retry=RetryPolicy(attempts=1, initial=0.001, cap=0.001))
    run = send_batches(connect, str(tmp_path / "o"), lanes=1)
    tables.refuse = [503]
    with pytest.raises(BatchRetry):
        run(batch, 0)
    sent = len(tables.log)
    run(batch, 0)
    assert len(tables.log) - sent == 2 and tables.rows["a"] == {"sys_id": "a", "f0": "1", "f1": "1"}
    gone = spark.createDataFrame([("t", 0, 9, "PATCH", "incident", "zz", "{}")], _SENT)
    with pytest.raises(BatchFailed):
        run(gone, 1)
    send_batches(connect, str(tmp_path / "p"), behaviour="log")(gone, 1)


def test_permits_bound_requests_at_once():
    limit = Limiter(4, every=2)
    most, lock, flying = [0], threading.Lock(), [0]

    def work(i):
        with limit.permit(30):
            with lock:
                flying[0] += 1
                most[0] = max(most[0], flying[0])
            time.sleep(0.002)
            if i % 10 == 3:
                limit.throttled()
            with lock:
                flying[0] -= 1

    threads = [threading.Thread(target=work, args=(i,)) for i in range(60)]
    [t.start() for t in threads], [t.join() for t in threads]
    assert 1 <= most[0] <= 4 and limit.flying == 0 and limit.permits == 1
    with limit.permit(), pytest.raises(Retryable), limit.permit(0.01):
        pass
    for _ in range(2):
        limit.succeeded()
    assert limit.permits == 2 and Limiter.of("h", 3) is Limiter.of("h", 3) and Limiter.of("h", 5).permits == 5


def test_a_constant_limit_is_kept(tables):
    tables.rows, tables.refuse = {"a": {"sys_id": "a"}}, [429, 429]
    c = Client(tables.url, Basic("u", "p"), retry=RetryPolicy(initial=0.001, cap=0.001), adaptive=False, concurrent=6)
    assert c.write("PATCH", "incident", "a", {}) == 200 and c.limit.permits == 6 and c.stats.throttled == 2 and c.stats.last_success > 0


def test_unpacked_bodies_are_bounded():
    class Answer:
        status, headers = 200, {"Content-Encoding": "gzip"}

        def __init__(self, body):
            self.body = gzip.compress(body)

        def read(self, n):
            return self.body[:n]

    c = Client("http://x", Basic("u", "p"), max_body=10_000)
    assert c._read(Answer(b"x" * 10_000)) == b"x" * 10_000
    with pytest.raises(ApiError):
        c._read(Answer(b"x" * 5_000_000))


def test_metadata_over_the_api():
    classes = {"1": ("task", ""), "2": ("incident", "1"), "3": ("incident_task", "2"), "4": ("a", "5"), "5": ("b", "4")}
    words = {"task": ["number", "short_description"], "incident": ["caller_id"], "a": [f"c{i}" for i in range(7)]}

    class Api:
        def list(self, table, query, *, fields, limit, offset=0):
            key, value = query.split("^")[0].split("=")
            if table == "sys_dictionary":
                return [{"element": e} for e in words.get(value, [])][offset : offset + limit]
            return [{"name": n, "super_class": {"value": p}} for i, (n, p) in classes.items() if value == (n if key == "name" else i)][:limit]

    m = Metadata(Api())
    m.PAGE = 3
    assert m.chain("incident_task") == ["incident_task", "incident", "task"] and m.chain("a") == ["a", "b"]
    assert m.columns("incident_task") == ["caller_id", "number", "short_description", "sys_id"] and len(m.columns("a")) == 8
    with pytest.raises(LookupError):
        m.columns("none")


def test_configuration():
    config.check(config.SourceConfig({"a": config.TableConfig("incident", "state=1")}))
    with pytest.raises(config.ConfigError) as e:
        config.check(config.SourceConfig({"a": config.TableConfig("Bad", "x=1^ORDERBYy", ("number",), "2026", schema="typed", mapping="a:nope")}, batch_size=0, bad_rows="lose"))
    assert set(e.value.errors) == {"tables.a.table", "tables.a.query", "tables.a.fields", "tables.a.start", "tables.a.mapping", "batch_size", "bad_rows"}
    with pytest.raises(config.ConfigError) as e:
        config.check(config.SinkConfig(allow=("a",), deny=("b",), lanes=9, create="correlation_lookup"))
    assert set(e.value.errors) == {"table", "deny", "lanes", "correlation_field"}
    assert config.writer_options(config.SinkConfig(table="incident", create="retry"))["create"] == "retry"
    assert "url" in config.Connection("ftp://x").errors() and not config.Connection("https://x").errors()
