"""Queries that run as streams: the table's rows arrive in several micro-batches, and a stream over them ends when all are read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..streaming import versions
from ..workers import new_path
from .base import Catalogue, table
from .keysets import ARRIVALS, arrivals

Q = Catalogue()
BATCHES = 4


def streamed(spark: SparkSession, rows: DataFrame, arrival: str, run: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What run makes of a stream of rows that come in BATCHES batches, in the order of a whole arrival, those without one last.

    A batch is written by as many tasks as read its rows. Files of one batch have
    no order, so the stream starts again for each and takes what is new at once.
    """
    path, out, progress = new_path(spark, "arrivals"), new_path(spark, "streamed"), new_path(spark, "progress")
    lowest, highest = rows.agg(F.min(arrival), F.max(arrival)).first()
    edges = [lowest - (lowest - highest - 1) * i // BATCHES for i in range(1, BATCHES)] if lowest is not None else []
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, versions.PROVIDER)
    try:
        for low, high in zip([None, *edges], [*edges, None], strict=True):
            part = rows if low is None else rows.filter((F.col(arrival) >= low) | F.col(arrival).isNull() if high is None else F.col(arrival) >= low)
            (part if high is None else part.filter(F.col(arrival) < high)).write.mode("append").parquet(path)
            stream = run(spark.readStream.schema(rows.schema).parquet(path))
            stream.writeStream.format("parquet").option("checkpointLocation", progress).option("path", out).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(provider, before)
    return spark.read.schema(stream.schema).parquet(out)


@Q("""WITH v AS (SELECT event_type AS stream, list({'k': user_id, 'id': event_id, 'q': []::BIGINT[], 'new': []::BIGINT[]} ORDER BY event_id) AS l FROM events GROUP BY 1),
 o AS (SELECT stream, unnest(list_reduce(l, lambda s, v: CASE WHEN list_contains(s.q, v.k) THEN s ELSE {'k': v.k, 'id': v.id, 'q': list_slice(list_append(s.q, v.k), -50, -1), 'new': list_append(s.new, v.id)} END,
  {'k': 0::BIGINT, 'id': 0::BIGINT, 'q': []::BIGINT[], 'new': []::BIGINT[]}).new) AS event_id FROM v)
 SELECT event_id, user_id, event_type FROM o JOIN events USING (event_id)""")
def dedup_bounded(spark, sf_dir):
    """Versions that aren't among the last fifty new ones of their stream."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type").filter("event_id IS NOT NULL")
    return streamed(spark, e, "event_id", lambda s: versions.dedup_bounded(s, 50, stream="event_type", version=["user_id"], arrival="event_id"))


@Q(f"""WITH {ARRIVALS}, e AS (SELECT *, lag(s) OVER w AS s0, lag(event_id) OVER w AS e0 FROM a WINDOW w AS (PARTITION BY user_id ORDER BY arrival))
 SELECT user_id, arrival, coalesce(s < s0 OR (s = s0 AND event_id <= e0), false) AS violates FROM e""")
def order_guard(spark, sf_dir):
    """Every arrival, and whether it breaks its lane's order, the lane being followed over batches."""

    def guarded(s: DataFrame) -> DataFrame:
        return versions.guard_order(s, lane="user_id", ts="ts", sys_id=F.lpad(F.col("event_id").cast("string"), 20, "0"), arrival="arrival", keep=["user_id", "arrival"])

    return streamed(spark, arrivals(spark, sf_dir), "arrival", guarded)
