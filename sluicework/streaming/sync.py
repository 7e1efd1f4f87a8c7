"""Streams of row versions: deduplication, application to a table, reports and counters."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..operators import change
from ..workers import Files


def dedup_stream(df: DataFrame, overlap: str, *, ts: str = "ts", keys: tuple[str, ...] = ("sys_id", "sys_mod_count")) -> DataFrame:
    """Each version once: re-reads lie within the overlap, so state is dropped behind it.

    The state lives in the checkpoint, so a restart doesn't emit the overlap again.
    """
    at = df.schema[ts].dataType.simpleString()
    stamped = df if at == "timestamp" else df.withColumn(ts, F.col(ts).cast("timestamp"))
    return stamped.withWatermark(ts, overlap).dropDuplicatesWithinWatermark([ts, *keys])


class VersionedTable:
    """A keyed table as Parquet folders of hash buckets; a manifest, written last, names each bucket's current folder.

    A batch reads and writes only the buckets of its keys. The last `keep`
    versions stay readable; folders that none of them names are deleted.
    """

    def __init__(self, spark: SparkSession, path: str, fields: list[str], *, buckets: int = 64, keep: int = 2):
        self.spark, self.path, self.fields, self.buckets, self.keep = spark, path.rstrip("/"), fields, buckets, keep
        self.columns = {"sys_id": "string", "sys_mod_count": "bigint", "sys_updated_on": "timestamp_ntz", "sys_created_on": "timestamp_ntz", "sys_created_by": "string", "sys_updated_by": "string"} | dict.fromkeys(fields, "string")
        self.files = Files(spark, self.path)

    def bucket(self, key: str = "sys_id"):
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _manifests(self) -> list[str]:
        return [n for n in self.files.names("manifests") if n.endswith(".json")]

    def _manifest(self) -> dict:
        names = self._manifests()
        return json.loads(self.files.read(f"manifests/{names[-1]}")) if names else {"batch": -1, "folders": {}}

    def batch(self) -> int:
        """The last batch that is part of the table; -1 before the first."""
        return self._manifest()["batch"]

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """The current rows, of some buckets or all."""
        folders = [f for b, f in self._manifest()["folders"].items() if buckets is None or int(b) in buckets]
        schema = ", ".join(f"{c} {k}" for c, k in self.columns.items())
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/{f}" for f in folders)) if folders else self.spark.createDataFrame([], schema)

    def write(self, df: DataFrame, batch: int, buckets: list[int] | None = None) -> None:
        """df as the rows of these buckets, or of all, from this batch on."""
        folder = f"data/{batch:012d}-{uuid.uuid4().hex[:8]}"
        rows = df.select(*(F.col(c).cast(k).alias(c) if c in df.columns else F.lit(None).cast(k).alias(c) for c, k in self.columns.items()))
        rows.withColumn("sluice_bucket", self.bucket()).repartition("sluice_bucket").write.partitionBy("sluice_bucket").parquet(f"{self.path}/{folder}")
        old = {} if buckets is None else {b: f for b, f in self._manifest()["folders"].items() if int(b) not in buckets}
        new = {n.split("=")[1]: f"{folder}/{n}" for n in self.files.names(folder) if n.startswith("sluice_bucket=")}
        self.files.write(f"manifests/{batch:012d}.json", json.dumps({"batch": batch, "folders": old | new}))
        self._vacuum()

    def _vacuum(self) -> None:
        names = self._manifests()
        for n in names[: -self.keep]:
            self.files.delete(f"manifests/{n}")
        used = {f.split("/")[1] for n in names[-self.keep :] for f in json.loads(self.files.read(f"manifests/{n}"))["folders"].values()}
        for n in self.files.names("data"):
            if n not in used and n < names[-1].removesuffix(".json"):  # a later writer's folder may not be in a manifest yet
                self.files.delete(f"data/{n}")


def apply_batches(table: VersionedTable, *, reports: str | None = None, dead_letters: str | None = None, not_found: str = "create") -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: changes (sys_id, op, order, at, body and their coordinates) into table.

    Reports and dead letters are written before the version that commits the
    batch, and a batch that is part of the table already is left out, so a
    replay neither applies nor loses anything. Rejected changes, those without
    an id among them, are dead letters with a reason.
    """

    def run(batch: DataFrame, n: int) -> None:
        if n <= table.batch():
            return
        held = batch.persist()
        try:
            touched = [r[0] for r in change.identified(held).select(table.bucket("target_id")).distinct().collect()]  # at most as many as buckets
            live, rejected = change.apply_changes(table.read(touched), held, table.fields, not_found=not_found)
            rejected = rejected.persist()
            if dead_letters:
                rejected.write.mode("overwrite").parquet(f"{dead_letters}/batch={n}")
            if reports:
                bad = rejected.select("change_id", "reason")
                done = change.identified(held).join(bad, "change_id", "left").select(F.col("sys_id").alias("key"), F.to_json(F.struct("op", "order", F.col("reason").isNotNull().alias("rejected"), "reason")).alias("value"))
                done.write.mode("overwrite").json(f"{reports}/batch={n}")
            table.write(live, n, touched)
            rejected.unpersist()
        finally:
            held.unpersist()

    return run


class Counters(StreamingQueryListener):
    """Input rows, batches and failures of running streams by name, as their progress tells."""

    def __init__(self) -> None:
        self.rows: dict[str, int] = {}
        self.batches: dict[str, int] = {}
        self.failures: dict[str, str] = {}
        self.observed: dict[str, dict] = {}

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.rows.setdefault(event.name or str(event.id), 0)

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        name = p.name or str(p.id)
        self.rows[name] = self.rows.get(name, 0) + p.numInputRows
        self.batches[name] = self.batches.get(name, 0) + 1
        for k, row in (p.observedMetrics or {}).items():
            self.observed.setdefault(name, {})[k] = row.asDict()

    def onQueryIdle(self, event) -> None:  # noqa: N802
        """An idle trigger counts nothing."""

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        if event.exception:
            self.failures[str(event.id)] = event.exception


def run_tables(starts: dict[str, Callable]) -> dict[str, object]:
    """Start one stream per table; a table that fails to start is parked and raised only if none runs."""
    running, failed = {}, {}
    for name, start in starts.items():
        try:
            running[name] = start()
        except Exception as e:  # noqa: BLE001
            failed[name] = e
    if failed and not running:
        raise next(iter(failed.values()))
    return running


def await_tables(running: dict[str, object], *, timeout: float | None = None, poll: float = 0.2) -> dict[str, Exception]:
    """Wait until every stream has ended or time is up: failures by table, which are raised if no table is left.

    A table that fails is parked, and the others go on.
    """
    until = None if timeout is None else time.monotonic() + timeout
    failed: dict[str, Exception] = {}
    while True:
        active = [n for n, q in running.items() if q.isActive]
        failed |= {n: q.exception() for n, q in running.items() if n not in active and n not in failed and q.exception() is not None}
        if failed and len(failed) == len(running):
            raise next(iter(failed.values()))
        if not active or until is not None and time.monotonic() >= until:
            return failed
        time.sleep(poll)
