"""A client of a REST table API: lists, lookups and writes over one retrying transport."""

from __future__ import annotations

import json
import re
import ssl
import threading
import time
import urllib.error
import urllib.parse
import urllib.request
import uuid
import zlib
from dataclasses import dataclass, field
from email.utils import parsedate_to_datetime

from ..functions.text import RETRYABLE, TRANSIENT
from ..operators.resilience import Limiter, Retryable, RetryPolicy

MAX_BODY = 64 << 20


class ApiError(RuntimeError):
    """An answer that another attempt won't change."""

    def __init__(self, status: int, text: str):
        super().__init__(f"HTTP {status}: {text[:500]}")
        self.status = status


def wait_of(value: str | None, now: float) -> float | None:
    """Seconds of a Retry-After header: a delta or a date."""
    if not value:
        return None
    try:
        return max(0.0, float(int(value.strip())))
    except ValueError:
        try:
            return max(0.0, parsedate_to_datetime(value).timestamp() - now)
        except ValueError:
            return None


@dataclass
class Stats:
    """What a client has done: requests, attempts beyond the first, 429 answers, seconds waited after them, and when the last success came."""

    requests: int = 0
    retries: int = 0
    throttled: int = 0
    throttled_seconds: float = 0.0
    last_success: float = 0.0


class Throttled(Retryable):
    """The server asked for fewer requests."""


@dataclass
class Client:
    """Options: base URL, auth, timeouts, CA file, client certificate, proxy (its user and password in its URL), requests at once.

    Redirects are not followed. Without adaptive the number of requests at once stays as it is.
    """

    url: str
    auth: object
    timeout: float = 60.0
    ca_file: str | None = None
    cert_file: str | None = None
    proxy: str | None = None
    retry: RetryPolicy = field(default_factory=RetryPolicy)
    concurrent: int = 8
    adaptive: bool = True
    max_body: int = MAX_BODY

    def __post_init__(self) -> None:
        self.drift, self.stats = 0.0, Stats()
        self.limit = Limiter.of(urllib.parse.urlsplit(self.url).netloc.lower(), self.concurrent)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "limit"}

    def __setstate__(self, state: dict) -> None:
        """Elsewhere, in another process, the limiter is that process's own."""
        self.__dict__ |= state
        self.limit = Limiter.of(urllib.parse.urlsplit(self.url).netloc.lower(), self.concurrent)

    def server_now(self) -> float:
        """The server's clock, as its last answer told."""
        return time.time() + self.drift

    def _opener(self) -> urllib.request.OpenerDirector:
        class NoRedirect(urllib.request.HTTPRedirectHandler):
            def redirect_request(self, *_):
                return None

        handlers: list = [NoRedirect(), urllib.request.ProxyHandler({"http": self.proxy, "https": self.proxy} if self.proxy else {})]
        if self.url.startswith("https"):
            context = ssl.create_default_context(cafile=self.ca_file)
            if self.cert_file:
                context.load_cert_chain(self.cert_file)
            handlers.append(urllib.request.HTTPSHandler(context=context))
        return urllib.request.build_opener(*handlers)

    def _send(self, method: str, path: str, body: bytes | None) -> tuple[int, bytes]:
        headers = {"Authorization": self.auth.header(), "Accept": "application/json", "Accept-Encoding": "gzip", "X-Request-Id": uuid.uuid4().hex}
        if body is not None:
            headers["Content-Type"] = "application/json"
        request = urllib.request.Request(self.url.rstrip("/") + path, body, headers, method=method)
        with self.limit.permit(self.timeout):
            self.stats.requests += 1
            try:
                with self._opener().open(request, timeout=self.timeout) as answer:
                    status, text = answer.status, self._read(answer)
            except urllib.error.HTTPError as e:
                return self._refused(e)
            except (urllib.error.URLError, TimeoutError, ConnectionError) as e:
                refused = isinstance(getattr(e, "reason", e), ConnectionRefusedError)
                raise Retryable(str(e), ambiguous=not refused) from e
        self.stats.last_success = time.time()
        return status, text

    def _refused(self, e: urllib.error.HTTPError) -> tuple[int, bytes]:
        text = self._read(e)
        wait = wait_of(e.headers.get("Retry-After"), self.server_now())
        if e.code == 429:
            self.stats.throttled += 1
            if self.adaptive:
                self.limit.throttled()
            raise Throttled("HTTP 429", wait=wait) from e
        if e.code in RETRYABLE or e.code == 409 and re.search(TRANSIENT, text.decode(errors="replace"), re.I):
            raise Retryable(f"HTTP {e.code}", ambiguous=e.code in (500, 502, 504), wait=wait) from e
        return e.code, text

    def _read(self, answer) -> bytes:
        """The body, plain; it may not be larger than max_body, neither as it came nor unpacked."""
        if date := answer.headers.get("Date"):
            try:
                self.drift = parsedate_to_datetime(date).timestamp() - time.time()
            except ValueError:
                pass
        raw = answer.read(self.max_body + 1)
        if len(raw) <= self.max_body and answer.headers.get("Content-Encoding") == "gzip":
            raw = zlib.decompressobj(zlib.MAX_WBITS | 16).decompress(raw, self.max_body + 1)
        if len(raw) > self.max_body:
            raise ApiError(answer.status, "the body is too large")
        return raw

    def call(self, method: str, path: str, body: dict | None = None, *, idempotent: bool | None = None) -> tuple[int, dict]:
        """Status and JSON; 401 refreshes the token once, failures beyond the policy raise."""
        data = None if body is None else json.dumps(body).encode()
        may = method != "POST" if idempotent is None else idempotent

        def attempt() -> tuple[int, bytes]:
            status, text = self._send(method, path, data)
            if status == 401:
                self.auth.invalidate()
                status, text = self._send(method, path, data)
            return status, text

        def told(wait: float, cause: Exception) -> None:
            self.stats.retries += 1
            self.stats.throttled_seconds += wait if isinstance(cause, Throttled) else 0.0

        status, text = self.retry.run(attempt, idempotent=may, told=told)
        if status == 404 and method != "GET" or status == 404 and "?" not in path:
            return status, {}
        if status >= 300:
            raise ApiError(status, text.decode(errors="replace"))
        if self.adaptive:
            self.limit.succeeded()
        return status, json.loads(text) if text.strip() else {}

    def list(self, table: str, query: str, *, fields: list[str] | None = None, limit: int = 1000, offset: int = 0, display: str = "false", exclude_link: bool = True, domain: bool = True, category: str = "") -> list[dict]:
        """Rows of one page; a single object counts as one row."""
        p = {"sysparm_query": query, "sysparm_fields": ",".join(fields or []), "sysparm_limit": limit, "sysparm_offset": offset or "", "sysparm_display_value": display, "sysparm_exclude_reference_link": str(exclude_link).lower()}
        p |= {"sysparm_query_category": category, "sysparm_query_no_domain": "" if domain else "true", "sysparm_no_count": "true", "sysparm_suppress_pagination_header": "true"}
        _, answer = self.call("GET", f"/api/now/table/{_segment(table)}?" + "&".join(f"{k}={urllib.parse.quote(str(v), safe='-._~')}" for k, v in p.items() if v != ""))
        found = answer.get("result", [])
        return found if isinstance(found, list) else [found]

    def get(self, table: str, sys_id: str) -> dict | None:
        status, answer = self.call("GET", f"/api/now/table/{_segment(table)}/{_segment(sys_id)}")
        return None if status == 404 else answer.get("result")

    def create(self, table: str, body: dict) -> dict:
        return self.call("POST", f"/api/now/table/{_segment(table)}", body)[1].get("result", {})

    def write(self, method: str, table: str, sys_id: str, body: dict | None = None) -> int:
        """PATCH, PUT or DELETE of one row; the status, 404 included."""
        return self.call(method, f"/api/now/table/{_segment(table)}/{_segment(sys_id)}", body)[0]


def _segment(name: str) -> str:
    if not re.fullmatch(r"[a-z0-9_]+", name):
        raise ValueError(f"not a table or id: {name!r}")
    return name


class MetadataCache:
    """Columns by table for a while."""

    def __init__(self, load, ttl: float = 600.0, clock=time.monotonic):
        self.load, self.ttl, self.clock, self.held, self.lock = load, ttl, clock, {}, threading.Lock()

    def columns(self, table: str) -> list[str]:
        with self.lock:
            at, found = self.held.get(table, (None, None))
            if at is None or self.clock() - at > self.ttl:
                found = self.load(table)
                self.held[table] = (self.clock(), found)
            return found

    def evict(self, table: str | None = None) -> None:
        with self.lock:
            self.held = {} if table is None else {k: v for k, v in self.held.items() if k != table}


class Metadata:
    """A table's ancestors and columns, as the API's own dictionary tells them; columns are cached."""

    #: Steps up the classes and rows of a page at most.
    DEPTH, PAGE = 32, 1000

    def __init__(self, client: Client, ttl: float = 600.0):
        self.client, self.cache = client, MetadataCache(self._load, ttl)

    def chain(self, table: str) -> list[str]:
        """The table and its ancestors, nearest first; a circle ends it."""
        out: list[str] = []
        at: str | None = table
        while at and at not in out and len(out) < self.DEPTH:
            found = self.client.list("sys_db_object", f"name={at}", fields=["name", "super_class"], limit=1)
            if not found and not out:
                raise LookupError(f"no table {table!r}")
            out.append(at)
            parent = _cell(found[0].get("super_class")) if found else ""
            above = self.client.list("sys_db_object", f"sys_id={parent}", fields=["name"], limit=1) if parent else []
            at = _cell(above[0].get("name")) if above else None
        return out

    def columns(self, table: str) -> list[str]:
        return self.cache.columns(table)

    def _load(self, table: str) -> list[str]:
        found = {"sys_id"}
        for t in self.chain(table):
            offset = 0
            while True:
                rows = self.client.list("sys_dictionary", f"name={t}^elementISNOTEMPTY", fields=["element"], limit=self.PAGE, offset=offset)
                found |= {_cell(r.get("element")) for r in rows} - {""}
                offset += self.PAGE
                if len(rows) < self.PAGE:
                    break
        return sorted(found)


def _cell(v) -> str:
    return (v.get("value") or "" if isinstance(v, dict) else v) or ""
