"""Change records: where they go, what they do, and what became of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..workers import BROADCAST_ROWS, cut

# Operation names in headers.
OPERATIONS = {"CREATE": "CREATE", "POST": "CREATE", "PATCH": "PATCH", "PUT": "PUT", "DELETE": "DELETE"}


def route_fixed(table: str) -> Column:
    return F.lit(table)


def route_topic(topic: Column, routes: dict[str, str]) -> tuple[Column, Column]:
    """(table, error) by topic; the map is a literal of the plan."""
    table = F.create_map(*(F.lit(x) for pair in routes.items() for x in pair))[topic] if routes else F.lit(None).cast("string")
    return table, F.when(table.isNull(), F.concat(F.lit("no table for topic "), topic))


def route_header(header: Column, allowed: tuple[str, ...] = ()) -> tuple[Column, Column]:
    """(table, error) from a header that must be a table name and, if tables are listed, one of them."""
    t = F.trim(header)
    error = F.when(t.isNull() | (t == ""), "no table header").when(~text.is_table(t), "bad table name")
    if allowed:
        error = error.when(~t.isin(*allowed), "table not allowed")
    return F.when(error.isNull(), t), error


def extract_id(candidates: dict[str, Column], *, precedence: str = "reject") -> tuple[Column, Column]:
    """(id, error) from the places that may hold one, in order: reject wants all to agree, key or value let theirs win.

    Only the chosen id has to be well formed.
    """
    found = {k: text.normalise_id(c) for k, c in candidates.items()}
    distinct = F.array_distinct(F.array_compact(F.array(*found.values())))
    winners = [c for k, c in found.items() if precedence != "reject" and k.startswith(precedence)]
    chosen = F.coalesce(*winners, F.when(F.size(distinct) == 1, distinct[0]))
    error = F.when(chosen.isNull() & (F.size(distinct) > 1), "ids disagree").when(chosen.isNotNull() & ~text.is_id(chosen), "malformed id")
    return F.when(error.isNull(), chosen), error


def ids_agree(candidates: list[Column]) -> Column:
    return F.size(F.array_distinct(F.array_compact(F.array(*map(text.normalise_id, candidates))))) <= 1


def resolve_operation(header: Column, *, mode: str = "infer", fixed: str | None = None, update: str = "PATCH", value_is_null: Column | None = None, sys_id: Column | None = None) -> tuple[Column, Column]:
    """(operation, error). A header always wins; without one: fixed, required (an error) or inferred.

    Inference: no value deletes, no id creates, anything else updates.
    """
    h = F.upper(F.trim(header))
    names = F.create_map(*(F.lit(x) for p in OPERATIONS.items() for x in p))
    upsert = F.when(sys_id.isNull(), "CREATE").otherwise(update) if sys_id is not None else F.lit(update)
    by_header = F.when(h == "UPDATE", F.lit(update)).when(h == "UPSERT", upsert).otherwise(names[h])
    given = h.isNotNull() & (h != "")
    if mode == "fixed":
        rest = F.lit(fixed)
    elif mode == "header":
        rest = F.lit(None).cast("string")
    else:
        rest = F.when(value_is_null, "DELETE").when(sys_id.isNull(), "CREATE").otherwise(update)
    op = F.when(given, by_header).otherwise(rest)
    return op, F.when(op.isNull(), F.when(given, F.concat(F.lit("unknown operation "), h)).otherwise("no operation header"))


def check_operation(op: Column, sys_id: Column, value_is_null: Column) -> Column:
    """An error if the operation lacks what it needs."""
    return F.when(op.isin("PATCH", "PUT", "DELETE") & sys_id.isNull(), F.concat(op, F.lit(" needs an id"))).when((op != "DELETE") & value_is_null, F.concat(op, F.lit(" needs a value")))


#: Columns that tell one change of a batch from another, as far as the batch has them.
COORDINATES = ("topic", "partition", "offset", "order")
#: System columns that a target may have besides its id, count and time of change.
#: Changes of one key that are folded as one array at most, as a power of two.
RUN_BITS = 13
_SYSTEM = ("sys_created_on", "sys_created_by", "sys_updated_by")


def identified(changes: DataFrame) -> DataFrame:
    """changes with change_id, which its coordinates give, and target_id: the row's id, or change_id where it has none."""
    own = F.md5(F.to_json(F.struct(*(c for c in COORDINATES if c in changes.columns))))
    return changes.withColumns({"change_id": own, "target_id": F.coalesce(F.nullif("sys_id", F.lit("")), own)})


def apply_changes(target: DataFrame, changes: DataFrame, fields: list[str], *, not_found: str = "fail", user: str = "integration") -> tuple[DataFrame, DataFrame]:
    """(new target, rejected changes) after folding each key's changes in their order.

    target has sys_id, sys_mod_count, sys_updated_on and fields, and may have
    sys_created_on, sys_created_by and sys_updated_by; changes has sys_id, op,
    order, at, a map body and, if order alone doesn't tell them apart, their
    topic, partition and offset. PATCH sets the body's fields, PUT also empties
    the others, both add one to sys_mod_count; a CREATE without an id gets one
    from its coordinates, the same in a replay, and any other change without an
    id is rejected. So are a CREATE of a row that exists and changes to one that
    doesn't; not_found "create" lets PATCH and PUT make the row and "ignore"
    drops them. The rejected changes have all their columns and a reason.

    A range partitioning by key and order, cut into runs of 2 ** RUN_BITS rows, deals a
    hot key to many groups of that size at most. Each run is folded twice, for a
    row that exists and one that doesn't; a key's runs are put together on top
    of the target's row. The runs are stored, as both results read them. Where
    the batch has no more than BROADCAST_ROWS keys, the target isn't shuffled:
    only rows that have a change meet their runs.
    """
    kept = [c for c in changes.columns if c not in ("change_id", "target_id", "reason")]
    place = [c for c in ("order", *COORDINATES[:3]) if c in changes.columns]
    rows = identified(changes.select(*kept)).select("target_id", "order", F.struct(*kept, "change_id").alias("c"))
    placed = rows.repartitionByRange("target_id", "order").sortWithinPartitions("target_id", *(F.col(f"c.{p}") for p in place))
    runs = placed.withColumn("run", F.shiftright(F.monotonically_increasing_id(), RUN_BITS)).groupBy("target_id", "run").agg(F.array_sort(F.collect_list("c"), _by(place)).alias("cs"))
    stamp = dict(target.dtypes)["sys_updated_on"]
    change = runs.schema["cs"].dataType.elementType
    none = F.struct(
        F.lit(False).alias("fresh"), F.lit(False).alias("reset"), F.lit(0).cast("long").alias("mod"), F.lit(None).cast(stamp).alias("at"), F.lit(None).cast(stamp).alias("made"),
        F.create_map().cast("map<string,string>").alias("body"), F.array().cast(f"array<struct<c:{change.simpleString()},reason:string>>").alias("bad"),
    )

    def step(s: Column, c: Column) -> Column:
        op, live = c["op"], s["live"]
        lost = F.coalesce(c["sys_id"], F.lit("")) == ""
        makes = (op == "CREATE") | (op.isin("PATCH", "PUT") & F.lit(not_found == "create") & ~lost)
        refused = F.when(live, op == "CREATE").otherwise(~makes)
        counts = refused & (live | lost | F.lit(not_found != "ignore"))
        reason = F.when(live, "exists").when(lost, "no id").otherwise("not found")
        whole = op.isin("PUT", "CREATE") | ~live
        changed = F.struct(
            (op != "DELETE").alias("live"), (s["fresh"] | ~live).alias("fresh"), (s["reset"] | whole).alias("reset"), F.when(live, s["mod"] + 1).otherwise(F.lit(0).cast("long")).alias("mod"),
            c["at"].alias("at"), F.when(live, s["made"]).otherwise(c["at"]).alias("made"), F.when(whole, c["body"]).otherwise(_over(s["body"], c["body"])).alias("body"), s["bad"].alias("bad"),
        )
        same = F.struct(*(s[x].alias(x) for x in ("live", "fresh", "reset", "mod", "at", "made", "body")), F.when(counts, F.array_append(s["bad"], F.struct(c.alias("c"), reason.alias("reason")))).otherwise(s["bad"]).alias("bad"))
        return F.when(refused, same).otherwise(changed)

    def folded(live: bool) -> Column:
        start = F.struct(F.lit(live).alias("live"), *(none[x].alias(x) for x in ("fresh", "reset", "mod", "at", "made", "body", "bad")))
        return F.aggregate("cs", start, step)

    runs = cut(runs.select("target_id", "run", folded(True).alias("on"), folded(False).alias("off")))
    ways = F.struct("run", F.col("on").dropFields("bad").alias("on"), F.col("off").dropFields("bad").alias("off"))
    keys = cut(runs.groupBy("target_id").agg(F.array_sort(F.collect_list(ways), _by(["run"])).alias("runs")))
    touched, rest = target, None
    if keys.count() <= BROADCAST_ROWS:  # rows without a change stay where they are
        ids = F.broadcast(keys.select("target_id"))
        touched, rest = (target.join(ids, F.col("sys_id") == F.col("target_id"), kind) for kind in ("left_semi", "left_anti"))
    own = touched.select(F.col("sys_id").alias("target_id"), F.struct(*target.columns).alias("row"))
    joined = own.join(keys, "target_id", "full_outer")
    first = F.struct(*(none[x].alias(x) for x in ("fresh", "reset", "mod", "at", "made", "body")), F.col("row").isNotNull().alias("live"), F.array().cast("array<struct<run:bigint,live:boolean>>").alias("starts"))

    def joined_run(s: Column, r: Column) -> Column:
        n = F.when(s["live"], r["on"]).otherwise(r["off"])
        new = n["fresh"]
        return F.struct(
            F.when(new, True).otherwise(s["fresh"]).alias("fresh"), F.when(new, True).otherwise(s["reset"] | n["reset"]).alias("reset"), F.when(new, n["mod"]).otherwise(s["mod"] + n["mod"]).alias("mod"),
            F.coalesce(n["at"], s["at"]).alias("at"), F.coalesce(n["made"], s["made"]).alias("made"), F.when(n["reset"], n["body"]).otherwise(_over(s["body"], n["body"])).alias("body"), n["live"].alias("live"),
            F.array_append(s["starts"], F.struct(r["run"].alias("run"), s["live"].alias("live"))).alias("starts"),
        )

    done = joined.withColumn("s", F.aggregate(F.coalesce("runs", F.array().cast(keys.schema["runs"].dataType)), first, joined_run))
    old, s = F.col("row"), F.col("s")
    system = {
        "sys_created_on": F.coalesce(s["made"], old["sys_created_on"]) if "sys_created_on" in target.columns else None,
        "sys_created_by": F.when(s["fresh"], user).otherwise(old["sys_created_by"]) if "sys_created_by" in target.columns else None,
        "sys_updated_by": F.when(s["at"].isNotNull(), user).otherwise(old["sys_updated_by"]) if "sys_updated_by" in target.columns else None,
    }
    live = done.filter("s.live").select(
        F.col("target_id").alias("sys_id"), F.when(s["fresh"], s["mod"]).otherwise(old["sys_mod_count"].cast("long") + s["mod"]).alias("sys_mod_count"), F.coalesce(s["at"], old["sys_updated_on"]).alias("sys_updated_on"),
        *(c.alias(n) for n, c in system.items() if c is not None),
        *(F.coalesce(s["body"][f], F.when(s["reset"], F.lit("")), old[f].cast("string"), F.lit("")).alias(f) for f in fields),
    )
    if rest is not None:
        same = rest.select("sys_id", F.col("sys_mod_count").cast("long").alias("sys_mod_count"), "sys_updated_on", *(c for c in _SYSTEM if c in target.columns), *(F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f) for f in fields))
        live = live.unionByName(same)
    started = done.select("target_id", F.explode("s.starts").alias("start")).select("target_id", "start.run", "start.live")
    bad = runs.select("target_id", "run", F.col("on.bad").alias("on"), F.col("off.bad").alias("off")).filter("size(on) + size(off) > 0")
    rejected = bad.join(started, ["target_id", "run"]).select(F.explode(F.when(F.col("live"), F.col("on")).otherwise(F.col("off"))).alias("b"))
    return live, rejected.select("b.c.*", "b.reason").select(*kept, "change_id", "reason")


def _over(under: Column, over: Column) -> Column:
    """Two bodies as one, the second one's values winning."""
    return F.map_concat(F.map_filter(under, lambda k, _: ~F.map_contains_key(over, k)), over)


def _by(names: list[str]):
    """A comparison of structs by some of their fields, nulls first."""

    def compare(a: Column, b: Column) -> Column:
        out = F.lit(0)
        for n in reversed(names):
            less = a[n].isNull() & b[n].isNotNull() | (a[n] < b[n])
            more = a[n].isNotNull() & b[n].isNull() | (a[n] > b[n])
            out = F.when(F.coalesce(less, F.lit(False)), -1).when(F.coalesce(more, F.lit(False)), 1).otherwise(out)
        return out

    return compare


def correlate(changes: DataFrame, target: DataFrame, field: str) -> DataFrame:
    """Creates matched to rows by a correlation field: none creates, one patches it, more are ambiguous.

    The target is counted by value before the join, so a hot value is one row of
    it; a change without a value is a record error.
    """
    found = target.groupBy(F.col(field).alias("_v")).agg(F.count("*").alias("_n"), F.min("sys_id").alias("_id"))
    joined = changes.join(found, changes[field] == F.col("_v"), "left")
    op = F.when(F.coalesce(changes[field].cast("string"), F.lit("")) == "", "RECORD_ERROR").when(F.col("_n").isNull(), "CREATE").when(F.col("_n") == 1, "PATCH").otherwise("AMBIGUOUS")
    return joined.withColumn("resolved", op).withColumn("target_id", F.when(op == "PATCH", F.col("_id"))).drop("_v", "_n", "_id")


def resolve_missing(changes: DataFrame, target: DataFrame, *, policy: str = "fail") -> DataFrame:
    """Updates and deletes of rows that aren't there, with what the policy makes of them."""
    gone = changes.filter(F.col("op").isin("PATCH", "PUT", "DELETE")).join(target.select("sys_id"), "sys_id", "left_anti")
    outcome = {"fail": F.lit("NOT_FOUND"), "ignore": F.lit("IGNORED"), "create": F.when(F.col("op") == "DELETE", "IGNORED").otherwise("CREATED")}[policy]
    return gone.withColumn("outcome", outcome)


def lane_order(df: DataFrame, tasks: int | None = None) -> DataFrame:
    """Each lane (topic, partition) in one task and in the order of its offsets; at most so many tasks, if given."""
    return df.repartition(*([tasks] if tasks else []), "topic", "partition").sortWithinPartitions("topic", "partition", "offset")


def with_lane_stop(df: DataFrame, stops: Column) -> DataFrame:
    """df with `attempted`: false after the first record of its lane that stops it.

    A lane's least stopping offset is one partial aggregation, so no task sorts
    a lane; records meet it by a join that can be broadcast or split.
    """
    first = df.filter(stops).groupBy(F.col("topic").alias("_topic"), F.col("partition").alias("_partition")).agg(F.min("offset").alias("_stop"))
    same = F.col("topic").eqNullSafe(F.col("_topic")) & F.col("partition").eqNullSafe(F.col("_partition"))
    attempted = F.col("_stop").isNull() | (F.col("offset") <= F.col("_stop"))
    return df.join(first, same, "left").withColumn("attempted", attempted).drop("_topic", "_partition", "_stop")


def completed_offsets(outcomes: DataFrame) -> DataFrame:
    """The next offset of each lane after its last completed record."""
    return outcomes.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset"))


def commit_offsets(completed: DataFrame, current: DataFrame) -> DataFrame:
    """What may be committed: never beyond the consumer's position, nothing for untouched lanes."""
    return completed.join(current, ["topic", "partition"]).select("topic", "partition", F.least("next_offset", "position").alias("commit"))


def batch_verdict(outcomes: DataFrame, *, behaviour: str = "fail") -> DataFrame:
    """One row: failures, the first of them and what the batch does: retry, fail or commit."""
    failed = F.col("classification").isNotNull()
    retry = F.col("classification") == "RETRIES_EXHAUSTED"
    row = outcomes.agg(F.count_if(failed).alias("failures"), F.count_if(retry).alias("retryable"), F.min(F.when(failed, F.struct("topic", "partition", "offset"))).alias("first"))
    verdict = F.when(F.col("retryable") > 0, "retry").when((F.col("failures") > 0) & F.lit(behaviour == "fail"), "fail").otherwise("commit")
    return row.select("failures", "retryable", F.col("first.topic").alias("first_topic"), F.col("first.offset").alias("first_offset"), verdict.alias("verdict"))


def report(outcomes: DataFrame, kind: str) -> DataFrame:
    """JSON reports: success, error, or the fields that were dropped beside a success; key is the id."""
    where = F.struct("topic", "partition", "offset")
    kept = ("topic", "partition", "offset")
    base = [F.col("op").alias("operation"), F.col("table"), F.col("sys_id"), F.col("status"), where.alias("source")]
    failed = F.col("classification").isNotNull()
    if kind == "success":
        df, parts = outcomes.filter(~failed), base
    elif kind == "error":
        df, parts = outcomes.filter(failed), [*base, F.col("classification"), F.col("retries"), text.excerpt(F.col("response")).alias("response_excerpt"), F.col("message")]
    else:
        df, parts = outcomes.filter(F.size("dropped") > 0), [*base, F.lit("DROPPED_FIELDS").alias("classification"), F.col("dropped")]
    cells = {k: F.col(k).cast("string") for k in kept} | {"table": F.col("table"), "operation": F.col("op"), "classification": F.coalesce("classification", F.lit(""))}
    head = F.create_map(*(x for k, v in cells.items() for x in (F.lit(k), v)))
    return df.select(F.col("sys_id").alias("key"), F.to_json(F.struct(*parts)).alias("value"), head.alias("headers"), *kept)


def in_input_order(outcomes: DataFrame, place: str = "input") -> DataFrame:
    """Outcomes, which lanes complete in any order, as their records came in."""
    return outcomes.orderBy(place)


def writer_metrics(outcomes: DataFrame) -> DataFrame:
    """Counters of one batch, as a single partial aggregation."""
    ok = F.col("classification").isNull()
    ops = [F.count_if(ok & (F.col("op") == o)).alias(o.lower()) for o in ("CREATE", "PATCH", "PUT", "DELETE")]
    bad = [F.count_if(F.col("classification") == c).alias(c.lower()) for c in ("RECORD_ERROR", "PERMISSION", "NOT_FOUND", "CONFLICT", "AMBIGUOUS", "RETRIES_EXHAUSTED")]
    return outcomes.agg(*ops, *bad)
