"""Record shaping: schemaless, all-string and typed rows, display values, envelope and emitted records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import coerce
from ..functions.text import reconcile_timestamp  # noqa: F401  re-exported for callers that shape dumps

RICH = "struct<value:string,display_value:string,link:string>"


def rich(value: Column, display: Column | None = None, link: Column | None = None, *, exclude_link: bool = True) -> Column:
    """A cell with its display value and, unless excluded, its link."""
    parts = [value.cast("string").alias("value"), (F.lit(None) if display is None else display).cast("string").alias("display_value")]
    return F.struct(*parts) if exclude_link else F.struct(*parts, (F.lit(None) if link is None else link).cast("string").alias("link"))


def display_true(df: DataFrame, displays: dict[str, Column], cursor: tuple[str, ...]) -> DataFrame:
    """Display values in place of values, but for the cursor's fields; a missing one falls back to the value."""
    return df.select(*(F.coalesce(displays[c], F.col(c).cast("string")).alias(c) if c in displays and c not in cursor else F.col(c) for c in df.columns))


def schemaless(df: DataFrame, name: str = "value") -> Column:
    """All columns as a map of strings; a null column is absent from it."""
    kinds = dict(df.dtypes)
    pairs = F.array(*(F.struct(F.lit(c).alias("key"), coerce.render(F.col(f"`{c}`"), kinds[c]).alias("value")) for c in df.columns))
    return F.map_from_entries(F.filter(pairs, lambda p: p["value"].isNotNull())).alias(name)


def strings(df: DataFrame, displays: dict[str, Column] | None = None) -> DataFrame:
    """Every column as text; one with a display value is followed by <name>_display_value."""
    out, kinds = [], dict(df.dtypes)
    for c in df.columns:
        out.append(coerce.render(F.col(f"`{c}`"), kinds[c]).alias(c))
        if displays and c in displays:
            out.append(displays[c].cast("string").alias(f"{c}_display_value"))
    return df.select(*out)


def grown(batches: list[DataFrame]) -> DataFrame:
    """All batches under one schema that only grows: fields in the order in which they were first seen."""
    out = batches[0]
    for b in batches[1:]:
        out = out.unionByName(b, allowMissingColumns=True)
    return out


def schema_versions(batches: list[list[str]]) -> list[tuple[int, list[str]]]:
    """After each batch of field names the schema's version, one higher for each growth, and its fields."""
    fields: list[str] = []
    version, out = 0, []
    for names in batches:
        new = [n for n in names if n not in fields]
        version += bool(new) or not version
        fields = fields + new
        out.append((version, list(fields)))
    return out


def first_seen(rows: DataFrame, batch: str, place: str, fields: Column) -> DataFrame:
    """Of every field name the first (batch, place, position) at which a row has it; fields is the row's array of names.

    One aggregate whose parts are merged, so it doesn't matter how rows are
    dealt, and each task sends a row for each name at most.
    """
    names = rows.select(F.col(batch).alias("batch"), F.col(place).alias("place"), F.posexplode(fields).alias("position", "field"))
    return names.groupBy("field").agg(F.min(F.struct("batch", "place", "position")).alias("first"))


def field_versions(rows: DataFrame, batch: str, place: str, fields: Column) -> DataFrame:
    """After each batch of rows the version of their growing schema and its fields, in the order in which they were first seen.

    The first batch begins version 1; each later batch with a new field begins
    the next. The fields of a table, with where they were first seen, are one
    small row, from which each batch takes those seen so far; a batch without
    rows, or whose rows have no fields, has what came before.
    """
    known = first_seen(rows, batch, place, fields).agg(F.array_sort(F.collect_list(F.struct("first", "field"))).alias("_known"))
    batches = rows.select(F.col(batch).alias("batch")).distinct()
    begun = rows.agg(F.min(batch).alias("_begun"))
    all_ = batches.join(F.broadcast(known), F.lit(True)).join(F.broadcast(begun), F.lit(True))  # two single rows
    so_far = F.filter("_known", lambda x: x["first"]["batch"] <= F.col("batch"))
    grown_at = F.array_distinct(F.transform(so_far, lambda x: x["first"]["batch"]))
    version = F.size(F.filter(grown_at, lambda b: b > F.col("_begun"))) + 1
    return all_.select("batch", version.alias("version"), F.transform(so_far, lambda x: x["field"]).alias("fields"))


def typed(df: DataFrame, mapping: str, *, evolution: str = "fail") -> DataFrame:
    """Declared fields as their types, with an error column for what the evolution mode refuses.

    fail refuses undeclared fields and bad values, backward keeps undeclared
    ones as strings, permissive also turns bad values into null.
    """
    declared = coerce.parse_mapping(mapping)
    names = {d.field for d in declared}
    extra = [c for c in df.columns if c not in names]
    cells = {d: F.col(f"`{d.field}`").cast("string") if d.field in df.columns else F.lit(None).cast("string") for d in declared}
    columns = [coerce.coerce(c, d).alias(d.field) for d, c in cells.items()]
    errors = []
    if evolution != "permissive":
        errors += [F.when(coerce.bad(c, d), F.lit(f"{d.field}: not a {d.type}")) for d, c in cells.items()]
    if evolution == "fail":
        errors += [F.when(F.col(f"`{c}`").isNotNull(), F.lit(f"{c}: not declared")) for c in extra]
    else:
        columns += [F.col(f"`{c}`").cast("string").alias(c) for c in extra]
    return df.select(*columns, F.nullif(F.concat_ws("; ", *errors), F.lit("")).alias("error"))


def envelope(after: Column, table: str, instance: str, ts_ms: Column) -> Column:
    """A change envelope: sources only ever update, and what was before is unknown."""
    return F.struct(F.lit(None).cast("string").alias("before"), after.alias("after"), F.struct(F.lit(table).alias("table"), F.lit(instance).alias("instance")).alias("source"), F.lit("u").alias("op"), ts_ms.alias("ts_ms"))


def headers(table: str, instance: str, extracted_at: Column, mode: str) -> Column:
    """The five headers of an emitted record."""
    pairs = {"source.table": F.lit(table), "source.instance": F.lit(instance), "source.operation": F.lit("UPSERT"), "source.extracted_at": extracted_at.cast("string"), "source.schema_mode": F.lit(mode)}
    return F.create_map(*(x for k, v in pairs.items() for x in (F.lit(k), v)))


def source_record(df: DataFrame, *, topic: str, table: str, instance: str, fingerprint: str, phase: str, extracted_at: Column, ts: str = "sys_updated_on", sys_id: str = "sys_id") -> DataFrame:
    """Rows as key, value, timestamp, topic, headers and the position to resume from."""
    at = F.date_trunc("second", ts)
    place = {"version": F.lit("1"), "timestamp": coerce.format_timestamp(at), "sys_id": F.col(sys_id), "phase": F.lit(phase), "fingerprint": F.lit(fingerprint)}
    return df.select(
        F.col(sys_id).alias("key"), schemaless(df), F.unix_millis(at.cast("timestamp")).alias("timestamp"), F.lit(topic).alias("topic"),
        headers(table, instance, extracted_at, "schemaless").alias("headers"), F.create_map(*(x for k, v in place.items() for x in (F.lit(k), v))).alias("offset"),
    )
