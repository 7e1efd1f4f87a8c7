"""A streaming sink over the table API: one task for several lanes, a journal of outcomes, and commits by batch."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSourceStreamWriter, WriterCommitMessage

from ..operators.resilience import RetryPolicy
from ..plans.config import Connection, SinkConfig, check, writer_options
from .auth import from_options
from .client import Client
from .writer import BatchFailed, BatchRetry, Writer

#: What a stream to this sink has.
COLUMNS = ("topic", "partition", "offset", "op", "table", "sys_id", "body")


@dataclass
class LanesWritten(WriterCommitMessage):
    """What one task did: the last completed offset of each of its lanes, and its records by result."""

    lanes: list[tuple[str | None, int | None, int]] = field(default_factory=list)
    counts: dict[str, int] = field(default_factory=dict)


class Journal:
    """Outcomes and commits as small files of one folder, which every task reaches.

    Outcomes lie under the commit that they come after, so what a batch that is
    not committed has done already is one folder. A commit has the last completed
    offset of every lane so far; the last two are kept.
    """

    def __init__(self, uri: str):
        if "://" not in uri and not uri.startswith("file:"):
            self.fs, self.top = pafs.LocalFileSystem(), uri.rstrip("/")
        else:
            self.fs, top = pafs.FileSystem.from_uri(uri)
            self.top = top.rstrip("/")

    def _names(self, folder: str) -> list[str]:
        found = self.fs.get_file_info(pafs.FileSelector(f"{self.top}/{folder}", allow_not_found=True))
        return sorted(f.base_name for f in found if not f.base_name.endswith(".part"))

    def _read(self, name: str) -> str:
        with self.fs.open_input_stream(f"{self.top}/{name}") as f:
            return f.read().decode()

    def _write(self, name: str, text: str) -> None:
        """The file appears whole: it is written beside and moved."""
        path = f"{self.top}/{name}"
        self.fs.create_dir(path.rpartition("/")[0], recursive=True)
        part = f"{path}.{uuid.uuid4().hex}.part"
        with self.fs.open_output_stream(part) as f:
            f.write(text.encode())
        self.fs.move(part, path)

    def committed(self) -> tuple[int, dict[tuple, int]]:
        """The last committed batch, -1 before the first, and the last completed offset by lane."""
        names = self._names("commits")
        if not names:
            return -1, {}
        last = json.loads(self._read(f"commits/{names[-1]}"))
        return last["batch"], {(t, p): o for t, p, o in last["lanes"]}

    def commit(self, batch: int, messages: list[LanesWritten]) -> None:
        before, lanes = self.committed()
        if batch <= before:
            return  # a batch that was committed here, but not in the stream's own log, came again
        counts: dict[str, int] = {}
        for m in messages:
            lanes |= {(t, p): max(o, lanes.get((t, p), o)) for t, p, o in m.lanes}
            for k, n in m.counts.items():
                counts[k] = counts.get(k, 0) + n
        self._write(f"commits/{batch:012d}.json", json.dumps({"batch": batch, "counts": counts, "lanes": [[*k, o] for k, o in lanes.items()]}))
        for old in self._names("commits")[:-2]:
            self.fs.delete_file(f"{self.top}/commits/{old}")

    def abort(self, batch: int, done: int) -> None:
        self._write(f"aborts/{batch:012d}-{uuid.uuid4().hex[:8]}.json", json.dumps({"batch": batch, "tasks_done": done}))

    def put(self, after: int, outcomes: list[dict]) -> None:
        self._write(f"outcomes/after={after:012d}/{uuid.uuid4().hex}.jsonl", "".join(json.dumps(o) + "\n" for o in outcomes))

    def completed(self, after: int, lanes: set[tuple]) -> set[tuple]:
        """(topic, partition, offset) that were completed since a commit, of these lanes."""
        folder = f"outcomes/after={after:012d}"
        rows = (json.loads(line) for n in self._names(folder) for line in self._read(f"{folder}/{n}").splitlines())
        return {(r["topic"], r["partition"], r["offset"]) for r in rows if r["classification"] is None and (r["topic"], r["partition"]) in lanes}


class TableStreamWriter(DataSourceStreamWriter):
    """Writes a stream's changes lane by lane.

    A task reads its rows of the batch, which the trigger bounds, and sends each
    lane's in the order of their offsets. Outcomes go to the journal every
    journal.every records and when the task ends, so a task that is repeated,
    and a batch that is delivered again after a failure or a restart, leave out
    what was completed; of what was sent since the last entry, creates need the
    policy correlation_lookup. A failure that a retry may mend fails the task,
    and any failure does under the behaviour fail; the other lanes are sent
    first. Speculative tasks would send twice and must be off.
    """

    def __init__(self, options: dict[str, str]):
        o = self.options = options
        self.sink = SinkConfig(
            routing="header", lanes=1, concurrent=int(o.get("concurrent", 8)), create=o.get("create", "fail_ambiguous"), correlation_field=o.get("correlation.field", ""), not_found=o.get("not.found", "fail"), behaviour=o.get("behaviour", "fail"),
        )
        check(self.sink)
        self.connection = Connection(o.get("url", ""), request_timeout=float(o.get("request.timeout", 60)), concurrent=self.sink.concurrent)
        check(self.connection)
        if not o.get("journal"):
            raise ValueError("a sink needs a journal: a folder that driver and tasks reach")
        self.every = max(1, int(o.get("journal.every", 100)))
        self.retry = RetryPolicy.from_options(o)

    def _writer(self) -> Writer:
        o = self.options
        client = Client(self.connection.url, from_options(o), timeout=self.connection.request_timeout, ca_file=o.get("ca.file"), cert_file=o.get("cert.file"), proxy=o.get("proxy"), retry=self.retry, concurrent=self.sink.concurrent)
        how = writer_options(self.sink)
        return Writer(client, create=how["create"], correlation_field=how["correlation_field"], not_found=how["not_found"])

    def write(self, iterator: Iterator) -> LanesWritten:
        rows = sorted(([r[c] for c in COLUMNS] for r in iterator), key=lambda r: (r[0] or "", -1 if r[1] is None else r[1], r[2]))
        if not rows:
            return LanesWritten()
        journal, writer = Journal(self.options["journal"]), self._writer()
        batch, places = journal.committed()
        done = journal.completed(batch, {(r[0], r[1]) for r in rows})
        held: list[dict] = []
        lanes: dict[tuple, int] = {}
        counts: dict[str, int] = {}
        stopped: dict[tuple, str] = {}
        first = None
        try:
            for topic, partition, offset, op, table, sys_id, body in rows:
                lane = topic, partition
                if lane in stopped:
                    continue
                if offset <= places.get(lane, -1) or (topic, partition, offset) in done:
                    counts["REPEATED"] = counts.get("REPEATED", 0) + 1
                    lanes[lane] = offset
                    continue
                sys_id, status, bad, message = writer.write(op, table, sys_id, json.loads(body) if body else {})
                held.append({"topic": topic, "partition": partition, "offset": offset, "op": op, "table": table, "sys_id": sys_id, "status": status, "classification": bad, "message": message})
                counts[bad or op] = counts.get(bad or op, 0) + 1
                if bad == "RETRIES_EXHAUSTED" or bad and self.sink.behaviour == "fail":
                    stopped[lane] = bad
                    first = first or f"{topic} {partition} {offset}: {bad} {message}"
                else:
                    lanes[lane] = offset
                if len(held) >= self.every:
                    journal.put(batch, held)
                    held = []
        finally:
            if held:
                journal.put(batch, held)
        if stopped:
            raise (BatchRetry if "RETRIES_EXHAUSTED" in stopped.values() else BatchFailed)(f"{len(stopped)} lanes stopped, the first at {first}")
        return LanesWritten([(*k, o) for k, o in lanes.items()], counts)

    def commit(self, messages: list[LanesWritten | None], batchId: int) -> None:  # noqa: N803
        Journal(self.options["journal"]).commit(batchId, [m for m in messages if m])

    def abort(self, messages: list[LanesWritten | None], batchId: int) -> None:  # noqa: N803
        """Nothing that was sent can be taken back: the journal keeps it, and the batch comes again without it."""
        Journal(self.options["journal"]).abort(batchId, sum(m is not None for m in messages))


def by_lane(changes: DataFrame, tasks: int) -> DataFrame:
    """A stream's changes as the sink takes them: each lane in one of so many tasks, which bound the requests at once."""
    return changes.select(*COLUMNS).repartition(tasks, "topic", "partition")
