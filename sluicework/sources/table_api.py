"""A Spark data source over a paged REST table: batch scans and a restartable keyset stream.

Options: url, table, user, password (or oauth.url, oauth.client.id,
oauth.client.secret), query, fields, start, display.value (false, true, all),
exclude.reference.link, query.domain, query.category, bad.rows (fail, skip),
probe, batch.size, overlap.seconds, lag.seconds, pages.per.trigger,
poll.interval.ms, timestamp.field, id.field, clients, concurrent, adaptive,
request.timeout, retry.attempts, retry.budget, retry.initial,
retry.cap, ca.file, cert.file, proxy. Every row is sys_id, ts and a map
of its cells. All options are checked, and all errors told, when the scan is
made.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections import Counter
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from ..operators.resilience import RetryPolicy
from ..plans import encoded_query, offsets
from ..plans.config import Connection, SourceConfig, TableConfig, check
from ..plans.keyset import Cursor, Keys, high_water_mark, is_idle, phase, projection, seconds
from ..workers import ship
from .auth import from_options
from .client import Client
from .probe import check_time_zone, probe
from .sink import COLUMNS, TableStreamWriter

SCHEMA = "sys_id string, ts timestamp_ntz, row map<string,string>"
FORMAT = offsets.FORMAT
_COMPARED = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


class BadRow(ValueError):
    """A row that has no place in the scan."""


class StuckPage(RuntimeError):
    """A full page of rows that all were skipped: the scan cannot get past it."""


class Range(InputPartition):
    """From a place, exclusive, to a place, inclusive; an empty last id means the whole last second."""

    def __init__(self, after: Cursor, until: Cursor):
        self.after, self.until = after, until


def _truth(options: dict[str, str], key: str, default: bool) -> bool:
    return options.get(key, str(default)).strip().lower() == "true"


class Scan:
    """Keyset pages of one table between two places, each request a top-k after the last row."""

    def __init__(self, options: dict[str, str]):
        self.o = o = options
        keys = Keys(o.get("timestamp.field", "sys_updated_on"), o.get("id.field", "sys_id"))
        fields = tuple(projection(o.get("fields", "").split(","), keys))
        self.config = TableConfig(
            o.get("table", ""), o.get("query", ""), fields, o.get("start", TableConfig.start), keys, o.get("display.value", "false"), _truth(o, "exclude.reference.link", True), _truth(o, "query.domain", True), o.get("query.category", ""),
        )
        self.source = SourceConfig(
            {"table": self.config}, poll_ms=int(o.get("poll.interval.ms", 0)), batch_size=int(o.get("batch.size", 5000)), overlap_seconds=int(o.get("overlap.seconds", 2)), lag_seconds=int(o.get("lag.seconds", 1)),
            bad_rows=o.get("bad.rows", "fail"), probe=_truth(o, "probe", True),
        )
        connection = Connection(o.get("url", ""), request_timeout=float(o.get("request.timeout", 60)), concurrent=int(o.get("concurrent", 8)), adaptive=_truth(o, "adaptive", True))
        check(self.source)
        check(connection)
        self.table, self.base, self.size = self.config.table, self.config.query, self.source.batch_size
        self.ts, self.id, self.fields = keys.ts, keys.sys_id, list(fields)
        self.client = Client(connection.url, from_options(o), retry=RetryPolicy.from_options(o), timeout=connection.request_timeout, ca_file=o.get("ca.file"), cert_file=o.get("cert.file"), proxy=o.get("proxy"), concurrent=connection.concurrent, adaptive=connection.adaptive)
        self.counts: Counter[str] = Counter()
        self.extra: tuple[str, ...] = ()

    @property
    def fingerprint(self) -> str:
        """Identity of the scan: its table, its query up to white space, and its domain."""
        parts = self.table, " ".join(self.base.split()), str(self.config.query_domain).lower()
        return "sha256:" + hashlib.sha256("\n".join(parts).encode()).hexdigest()

    def check(self) -> None:
        """The probes, if they are wanted."""
        if self.source.probe:
            probe(self.client, self.table, self.base, ts=self.ts, sys_id=self.id, domain=self.config.query_domain, category=self.config.category)
            check_time_zone(self.client, self.o.get("user"))

    def now(self) -> datetime:
        if "now" in self.o:
            return datetime.strptime(self.o["now"], FORMAT)
        return datetime.fromtimestamp(self.client.server_now(), timezone.utc).replace(tzinfo=None)

    def high(self) -> datetime:
        return high_water_mark(self.now(), timedelta(seconds=self.source.lag_seconds))

    def _query(self, *ways: tuple[str, ...]) -> str:
        """The base query, narrowed to any of the ways, in the order of the scan."""
        branches = self.base.split("^NQ") if self.base.strip() else [""]
        narrowed = "^NQ".join("^".join(x for x in (b, *self.extra, *w) if x) for b in branches for w in ways or ((),))
        return f"{narrowed}^ORDERBY{self.ts}^ORDERBY{self.id}"

    def _list(self, *ways: tuple[str, ...], limit: int, offset: int = 0, fields: list[str] | None = None) -> list[dict]:
        c = self.config
        display = "all" if c.display == "true" else c.display  # so that the cursor keeps its own values
        return self.client.list(self.table, self._query(*ways), fields=self.fields if fields is None else fields, limit=limit, offset=offset, display=display, exclude_link=c.exclude_link, domain=c.query_domain, category=c.category)

    def _ways(self, at: Cursor, high: datetime) -> list[tuple[str, ...]]:
        """The rest of the place's own second, and the seconds after it."""
        rest = [(f"{self.ts}={at.ts:{FORMAT}}", f"{self.id}>{at.sys_id}")] if at.sys_id else []
        return [*rest, (f"{self.ts}>{at.ts:{FORMAT}}", f"{self.ts}<={high:{FORMAT}}")]

    def page(self, at: Cursor, high: datetime) -> list[dict]:
        """The next rows after a place: the rest of its own second first, then later seconds."""
        rows: list[dict] = []
        for way in self._ways(at, high):
            if len(rows) < self.size:
                rows += self._list(way, limit=self.size - len(rows))
        self.counts["pages"] += 1
        return rows

    def place_after(self, at: Cursor, high: datetime, n: int) -> Cursor | None:
        """The place of the n-th row after another place: one row of keys is fetched; None if there are fewer."""
        rows = self._list(*self._ways(at, high), limit=1, offset=n - 1, fields=[self.id, self.ts])
        return self.place(rows[0]) if rows else None

    def place(self, row: dict) -> Cursor:
        ts, sys_id = _text(row.get(self.ts)), _text(row.get(self.id))
        if not sys_id.strip():
            raise BadRow(f"{self.table}: a row without {self.id!r}")
        try:
            return Cursor(datetime.strptime(ts, FORMAT), sys_id)
        except ValueError as e:
            raise BadRow(f"{self.table}: row {sys_id} has {ts!r} as {self.ts!r}; bad.rows=skip leaves such rows out") from e

    def sweep(self, at: Cursor, high: datetime) -> Iterator[tuple[Cursor, dict]]:
        """Rows with their places until a page isn't full; rows that don't come after their predecessor raise."""
        while True:
            rows, before = self.page(at, high), at
            for r in rows:
                try:
                    new = self.place(r)
                except BadRow:
                    if self.source.bad_rows == "fail":
                        raise
                    self.counts["skipped"] += 1
                    continue
                if new <= at:
                    raise RuntimeError(f"{self.table}: {new} came after {at}")
                at = new
                self.counts["emitted"] += 1
                yield at, r
            if len(rows) < self.size:
                return
            if at == before:
                raise StuckPage(f"{self.table}: all {len(rows)} rows of a full page after {at} were skipped")

    def start(self) -> Cursor:
        return Cursor.start(datetime.strptime(self.config.start, FORMAT))

    def cells(self, row: dict) -> dict[str, str]:
        shown = self.config.display == "true"
        return {k: _text(v, shown and k not in (self.ts, self.id)) for k, v in row.items() if v is not None}


def _text(v, display: bool = False) -> str:
    if isinstance(v, dict):
        v = (display and v.get("display_value")) or v.get("value")
    return v if isinstance(v, str) else "" if v is None else json.dumps(v)


def _rows(scan: Scan, part: Range) -> Iterator[tuple]:
    for p, r in scan.sweep(part.after, part.until.ts):
        if part.until.sys_id and p > part.until:
            return
        yield p.sys_id, p.ts, scan.cells(r)


def _split(first: Cursor, last: Cursor, n: int) -> list[Range]:
    """Equal ranges of time, which don't overlap and keep the order inside; the outer places stay exact."""
    step = (last.ts - first.ts) / n
    edges = sorted({seconds(first.ts + step * i) for i in range(1, n)} - {first.ts, last.ts})
    places = [first, *map(Cursor, (e for e in edges if first.ts < e < last.ts)), last]
    return [Range(a, b) for a, b in zip(places, places[1:], strict=False) if a.ts < b.ts or a < b]


class TableReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options, self.extra = options, ()
        Scan(options).check()

    def _scan(self) -> Scan:
        scan = Scan(self.options)
        scan.extra = self.extra
        return scan

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        """Comparisons of ids and times narrow the requests; Spark applies them again, for times are cut to seconds there."""
        scan, terms = Scan(self.options), []
        for f in filters:
            column = getattr(f, "attribute", None)
            if type(f) is EqualTo and column == ("sys_id",) and "^" not in str(f.value):
                terms.append(f"{scan.id}={f.value}")
            elif type(f) in _COMPARED and column == ("ts",) and isinstance(f.value, datetime):
                op = _COMPARED[type(f)]
                terms.append(f"{scan.ts}{ {'>': '>=', '<': '<='}.get(op, op)}{seconds(f.value):{FORMAT}}")
            yield f
        self.extra = tuple(terms)

    def partitions(self) -> list[InputPartition]:
        """Equal time ranges, as many as the clients option allows."""
        scan, n = self._scan(), int(self.options.get("clients", 1))
        first = scan.start()
        high = scan.high()
        if n > 1 and "start" not in self.options:
            oldest = scan._list(limit=1, fields=[scan.id, scan.ts])
            first = Cursor(scan.place(oldest[0]).ts - timedelta(seconds=1)) if oldest else first
        return _split(first, Cursor(high), n) if first.ts < high else []

    def read(self, partition: Range) -> Iterator[tuple]:
        return _rows(self._scan(), partition)


class TableStreamReader(DataSourceStreamReader):
    """Offsets are places; a trigger ends at the high-water mark or after pages.per.trigger full pages.

    Where it ends is found by one row's keys; only tasks fetch pages, each its
    range of the trigger. Each trigger starts overlap.seconds before its offset,
    so late rows of that time are seen; drop versions with
    dropDuplicatesWithinWatermark downstream. After a trigger that reached the
    present no request is made for poll.interval.ms.
    """

    def __init__(self, options: dict[str, str]):
        self.options, self.scan = options, Scan(options)
        self.scan.check()
        self.overlap = timedelta(seconds=self.scan.source.overlap_seconds)
        self.rows = int(options.get("pages.per.trigger", 20)) * self.scan.size
        self.at: Cursor | None = None
        self.wake = 0.0

    def _offset(self, at: Cursor, high: datetime) -> dict:
        lag, poll = timedelta(seconds=self.scan.source.lag_seconds), timedelta(seconds=5)
        return offsets.encode(at, phase(high, self.scan.now(), lag, poll), self.scan.fingerprint)

    def initialOffset(self) -> dict:  # noqa: N802
        return self._offset(self.scan.start(), self.scan.start().ts)

    def latestOffset(self) -> dict:  # noqa: N802
        at, high = self.at or self.scan.start(), self.scan.high()
        if time.monotonic() < self.wake or is_idle(at, high):
            return self._offset(at, high)
        found = self.scan.place_after(at, high, self.rows)
        self.at = found or Cursor(high)
        if found is None:
            self.wake = time.monotonic() + self.scan.source.poll_ms / 1000
        return self._offset(self.at, high)

    def _decode(self, offset: dict) -> Cursor:
        return offsets.decode(offset, self.scan.fingerprint)[0]

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        first, last = self._decode(start), self._decode(end)
        self.at = max(self.at or last, last)
        back = first.rewound(self.overlap, first=datetime.strptime(self.scan.config.start, FORMAT))
        return _split(back, last, int(self.options.get("clients", 1)))

    def read(self, partition: Range) -> Iterator[tuple]:
        return _rows(Scan(self.options), partition)

    def commit(self, end: dict) -> None:
        """The checkpoint keeps offsets; nothing is held here."""


class TableApiSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "table_api"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return TableReader(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        return TableStreamReader(dict(self.options))

    def streamWriter(self, schema, overwrite: bool) -> TableStreamWriter:  # noqa: N802
        """A sink for changes with the columns of sink.COLUMNS; its own options are journal, journal.every, create, correlation.field, not.found and behaviour."""
        missing = [c for c in COLUMNS if c not in schema.names]
        if missing:
            raise ValueError(f"a stream of changes needs {', '.join(missing)}")
        return TableStreamWriter(dict(self.options))


def register(spark) -> None:
    """Make the source known to the session, which must let sources narrow their requests by filters."""
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TableApiSource)
