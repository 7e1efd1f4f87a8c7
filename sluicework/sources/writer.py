"""Writing changes through the table API: lanes in order, bounded concurrency, one outcome per record."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.change import batch_verdict, lane_order
from ..operators.resilience import RetriesExhausted, Retryable
from ..workers import Files, cut, ship, small
from .client import ApiError, Client

OUTCOME = "topic string, partition bigint, offset bigint, op string, table string, sys_id string, status int, classification string, message string, attempted boolean"
_CLASS = {403: "PERMISSION", 404: "NOT_FOUND", 409: "CONFLICT"}


class Writer:
    """One record at a time. create: retry, fail_ambiguous or correlation_lookup; not_found: fail, ignore or create."""

    def __init__(self, client: Client, *, create: str = "fail_ambiguous", correlation_field: str = "", not_found: str = "fail"):
        self.client, self.policy, self.field, self.not_found = client, create, correlation_field, not_found

    def write(self, op: str, table: str, sys_id: str | None, body: dict[str, str]) -> tuple[str | None, int | None, str | None, str | None]:
        """(sys_id, status, classification, message) of one change."""
        try:
            if op == "CREATE":
                return self._create(table, body)
            status = self._delete(table, sys_id) if op == "DELETE" else self.client.write(op, table, sys_id, body)
            if status != 404:
                return sys_id, status, None, None
            if self.not_found == "ignore" or self.not_found == "create" and op == "DELETE":
                return sys_id, 404, None, None
            if self.not_found == "create":
                return self._create(table, body | {"sys_id": sys_id})
            return sys_id, 404, "NOT_FOUND", f"{op} {table}/{sys_id}: no such row"
        except ApiError as e:
            return sys_id, e.status, _CLASS.get(e.status, "RECORD_ERROR"), str(e)
        except RetriesExhausted as e:
            return sys_id, None, "RETRIES_EXHAUSTED", str(e)
        except Retryable as e:
            return sys_id, None, "AMBIGUOUS" if e.ambiguous else "RETRIES_EXHAUSTED", str(e)

    def _create(self, table: str, body: dict[str, str]) -> tuple[str | None, int | None, str | None, str | None]:
        if self.policy == "correlation_lookup":
            value = body.get(self.field, "")
            if not value or "^" in value:
                return None, None, "RECORD_ERROR", f"no usable {self.field}"
            try:
                return self.client.create(table, body).get("sys_id"), 201, None, None
            except Retryable as e:
                if not e.ambiguous:
                    raise
            found = self.client.list(table, f"{self.field}={value}", fields=["sys_id"], limit=2)
            if len(found) > 1:
                return None, None, "AMBIGUOUS", f"{len(found)} rows with {self.field}={value}"
            if found:
                return found[0]["sys_id"], self.client.write("PATCH", table, found[0]["sys_id"], body), None, None
            return self.client.create(table, body).get("sys_id"), 201, None, None
        _, answer = self.client.call("POST", f"/api/now/table/{table}", body, idempotent=self.policy == "retry")
        return answer.get("result", {}).get("sys_id"), 201, None, None

    def _delete(self, table: str, sys_id: str) -> int:
        """Sent again after an ambiguous failure; not finding the row then is success."""
        try:
            return self.client.call("DELETE", f"/api/now/table/{table}/{sys_id}", idempotent=False)[0]
        except Retryable as e:
            if not e.ambiguous:
                raise
            status = self.client.write("DELETE", table, sys_id)
            return 204 if status == 404 else status


def write_changes(changes: DataFrame, connect: Callable[[], Client], path: str, *, lanes: int = 8, behaviour: str = "fail", **how) -> DataFrame:
    """Send every row (topic, partition, offset, op, table, sys_id, body as JSON) and store its outcome at path.

    The requests go out here, once: the returned table reads what was stored.
    A lane's records go in order of their offsets; it stops at a failure that a
    retry may mend, and at any failure when behaviour is "fail". At most `lanes`
    tasks write at once, one request each, which bounds the whole cluster. The
    rows' order within a lane comes from one sort. A task that Spark repeats
    sends its lanes again; creates need correlation_lookup to survive that
    without a second row, the other operations are idempotent.
    """
    ship(changes.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        writer, stopped = Writer(connect(), **how), set()
        for f in frames:
            out = []
            for r in f.itertuples(index=False):
                lane = r.topic, r.partition
                if lane in stopped:
                    out.append((r.topic, r.partition, r.offset, r.op, r.table, r.sys_id, None, None, None, False))
                    continue
                sys_id, status, bad, message = writer.write(r.op, r.table, r.sys_id, json.loads(r.body) if r.body else {})
                if bad == "RETRIES_EXHAUSTED" or bad and behaviour == "fail":
                    stopped.add(lane)
                out.append((r.topic, r.partition, r.offset, r.op, r.table, sys_id or r.sys_id, status, bad, message, True))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in OUTCOME.split(", ")]).astype({"status": "Int32"})

    rows = changes.select("topic", "partition", "offset", "op", "table", "sys_id", "body")
    lane_order(rows, lanes).mapInPandas(run, OUTCOME).write.mode("errorifexists").parquet(path)
    return changes.sparkSession.read.schema(OUTCOME).parquet(path)


#: The longest list of values in one request, as characters of the query.
QUERY_CHARS = 4000


def _asked(client: Client, table: str, field: str, values: list[str]) -> dict[str, tuple[int, str]]:
    """Of values that any row has the number of matches, two standing for more, and the first one's id, in few requests.

    A full page can leave values out; then one of its values has two matches at
    least, so that the next request asks for fewer.
    """
    found: dict[str, list[str]] = {}
    while values:
        limit = 2 * len(values) + 1
        query = f"{field}={values[0]}" if len(values) == 1 else f"{field}IN{','.join(values)}"
        rows = client.list(table, query, fields=["sys_id", field], limit=limit)
        wanted, now = set(values), {}
        for r in rows:
            if r.get(field) in wanted:
                now.setdefault(r[field], []).append(r["sys_id"])
        if len(rows) < limit:
            found |= now
            break
        several = {v: ids for v, ids in now.items() if len(ids) > 1}
        if not several:
            raise ApiError(200, f"{field}: a full page without two rows of one value")
        found |= several
        values = [v for v in values if v not in several]
    return {v: (min(len(ids), 2), min(ids)) for v, ids in found.items()}


def correlate_remote(changes: DataFrame, connect: Callable[[], Client], table: str, field: str, *, batch: int = 200, tasks: int = 4) -> DataFrame:
    """Creates matched to the rows of a remote table by a correlation field: `resolved` and `target_id`, as change.correlate() gives them.

    Each distinct value is asked for once, in requests of up to `batch` values,
    by at most `tasks` tasks at once; a value that a list can't hold has a
    request of its own. Answers, a row for each value that has a match, are
    stored and joined back, so a value of many changes is one of each. Null and
    blank values, and those that would end the term, are record errors.
    """
    ship(changes.sparkSession)
    value = F.col(field)
    usable = (F.coalesce(value, F.lit("")) != "") & ~F.contains(value, F.lit("^"))
    values = changes.filter(usable).select(value.alias("v")).distinct().repartition(tasks)

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client, held, size = connect(), [], 0

        def told(asked: list[str]) -> pd.DataFrame:
            return pd.DataFrame([(v, n, i) for v, (n, i) in _asked(client, table, field, asked).items()], columns=["_v", "_n", "_id"])

        for f in frames:
            for v in f["v"]:
                if "," in v:
                    yield told([v])
                    continue
                if held and (len(held) == batch or size + len(v) > QUERY_CHARS):
                    yield told(held)
                    held, size = [], 0
                held.append(v)
                size += len(v) + 1
        if held:
            yield told(held)

    found = cut(values.mapInPandas(ask, "_v string, _n int, _id string"))
    joined = changes.join(small(found), value == F.col("_v"), "left")
    op = F.when(~usable, "RECORD_ERROR").when(F.col("_n").isNull(), "CREATE").when(F.col("_n") == 1, "PATCH").otherwise("AMBIGUOUS")
    return joined.withColumn("resolved", op).withColumn("target_id", F.when(op == "PATCH", F.col("_id"))).drop("_v", "_n", "_id")


def settle_ambiguous(changes: DataFrame, outcomes: DataFrame, connect: Callable[[], Client], path: str, table: str, field: str, *, batch: int = 200, tasks: int = 4, **how) -> DataFrame:
    """Sends creates again whose answers were lost: as a change of the row that the first attempt made, or as a create where it made none.

    outcomes are stored ones of write_changes() for these changes. All lost
    creates are looked up together; those that match several rows, or have no
    usable value, are left as they are. Gives the outcomes of what was sent,
    stored at path.
    """
    lane = ["topic", "partition", "offset"]
    lost = outcomes.filter("classification = 'AMBIGUOUS' AND op = 'CREATE'").select(*lane)
    rows = changes.join(lost, lane, "left_semi").withColumn(field, F.get_json_object("body", f"$.{field}"))
    resolved = cut(correlate_remote(rows, connect, table, field, batch=batch, tasks=tasks))
    again = resolved.filter("resolved IN ('CREATE', 'PATCH')").select(*lane, F.col("resolved").alias("op"), "table", F.coalesce("target_id", "sys_id").alias("sys_id"), "body")
    return write_changes(again, connect, path, **how)


class BatchFailed(RuntimeError):
    """A record failed for good."""


class BatchRetry(RuntimeError):
    """A record's retries were used up: the batch is delivered again."""


def send_batches(connect: Callable[[], Client], path: str, *, behaviour: str = "fail", **how) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that sends each batch, stores its outcomes under path and raises what should stop the stream.

    A batch that comes again, after a retryable failure or a restart, is sent
    without the records that were completed before.
    """

    def run(batch: DataFrame, n: int) -> None:
        files = Files(batch.sparkSession, path)
        attempts = [a for a in files.names(f"batch={n}") if files.exists(f"batch={n}/{a}/_SUCCESS")]
        rows = batch
        if attempts:
            earlier = batch.sparkSession.read.schema(OUTCOME).parquet(*(f"{path}/batch={n}/{a}" for a in attempts))
            rows = batch.join(earlier.filter("attempted and classification is null").select("topic", "partition", "offset"), ["topic", "partition", "offset"], "left_anti")
        own = f"{path}/batch={n}/attempt-{len(files.names(f'batch={n}')):04d}"
        (verdict,) = batch_verdict(write_changes(rows, connect, own, behaviour=behaviour, **how), behaviour=behaviour).collect()
        told = f"batch {n}: {verdict.failures} failed, the first at {verdict.first_topic} {verdict.first_offset}"
        if verdict.verdict == "retry":
            raise BatchRetry(told)
        if verdict.verdict == "fail":
            raise BatchFailed(told)

    return run
