"""Mapping of change records to request bodies.

A body is a map of strings, built in a fixed order: rename, allow or deny,
reserved fields, nested values, nulls, rendering, unknown fields. Schemas are
known when the plan is made, so all but the unknown-field policy is a select.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import coerce
from ..workers import cut, side

# Fields that the table itself keeps.
SYSTEM = ("sys_id", "sys_created_on", "sys_updated_on", "sys_mod_count", "sys_created_by", "sys_updated_by")


@dataclass(frozen=True)
class Mapping:
    """How values become bodies. nulls: omit, clear or reject; nested: reject, flatten or stringify; unknown: fail, drop, report or passthrough."""

    rename: tuple[tuple[str, str], ...] = ()
    allow: tuple[str, ...] = ()
    deny: tuple[str, ...] = ()
    reserved: tuple[str, ...] = SYSTEM
    nulls: str = "omit"
    nested: str = "reject"
    delimiter: str = "_"
    unknown: str = "passthrough"

    def __post_init__(self) -> None:
        if self.allow and self.deny:
            raise ValueError("allow and deny exclude each other")


def renamed(columns: list[str], rename: tuple[tuple[str, str], ...]) -> dict[str, str]:
    """Names after renaming, by column; two columns of one name are a mistake of the mapping, told before any row is read."""
    wanted = dict(rename)
    names = {c: wanted.get(c, c) for c in columns}
    twice = sorted({n for n in names.values() if list(names.values()).count(n) > 1})
    if twice:
        raise ValueError(f"more than one column would be called {', '.join(twice)}")
    return names


def kept(names: list[str], m: Mapping) -> list[str]:
    """Fields that may be written; naming a reserved one in the allow-list overrides its removal."""
    if m.allow:
        return [n for n in names if n in m.allow]
    return [n for n in names if n not in m.deny and n not in m.reserved]


def leaves(c: Column, kind: T.DataType, path: str, m: Mapping) -> tuple[list[tuple[str, Column]], list[Column]]:
    """(name, rendered text) of a value's leaves, and error columns for what its policy refuses."""
    nested = isinstance(kind, (T.StructType, T.MapType, T.ArrayType))
    if not nested:
        return [(path, coerce.render(c, kind.simpleString()))], []
    if m.nested == "stringify":
        return [(path, F.to_json(c, {"ignoreNullFields": "false"}))], []
    if m.nested == "flatten" and isinstance(kind, T.StructType):
        out: list[tuple[str, Column]] = []
        errors: list[Column] = []
        for f in kind.fields:
            o, e = leaves(c[f.name], f.dataType, f"{path}{m.delimiter}{f.name}", m)
            out += o
            errors += e
        return out, errors
    name = {T.StructType: "struct", T.MapType: "map", T.ArrayType: "array"}[type(kind)]
    return [], [F.when(c.isNotNull(), F.lit(f"{path}: nested {name}"))]


def body(df: DataFrame, m: Mapping, *, exclude: tuple[str, ...] = (), value: str | None = None) -> tuple[Column, Column]:
    """A map column of the body and a column of errors, null if there are none; exclude names columns outside the value.

    With value, the name of a struct column, its fields are the value's.
    """
    kinds = {f.name: f.dataType for f in (df.schema[value].dataType if value else df.schema).fields}
    names = renamed([c for c in kinds if c not in exclude], m.rename)
    back = {v: k for k, v in names.items()}
    cells: list[tuple[str, Column]] = []
    errors: list[Column] = []
    for n in kept(list(names.values()), m):
        own, bad = leaves(F.col(value)[back[n]] if value else F.col(f"`{back[n]}`"), kinds[back[n]], n, m)
        cells += own
        errors += bad
    twice = sorted({n for n, _ in cells if sum(n == x for x, _ in cells) > 1})
    if twice:
        raise ValueError(f"more than one field would be called {', '.join(twice)}")
    if m.nulls == "clear":
        cells = [(n, F.coalesce(c, F.lit(""))) for n, c in cells]
    if m.nulls == "reject":
        errors += [F.when(c.isNull(), F.lit(f"{n}: null")) for n, c in cells]
    if not cells:
        return F.create_map().cast("map<string,string>"), F.nullif(F.concat_ws("; ", *errors), F.lit(""))
    pairs = F.array(*(F.struct(F.lit(n).alias("key"), c.alias("value")) for n, c in cells))
    return F.map_from_entries(F.filter(pairs, lambda p: p["value"].isNotNull())), F.nullif(F.concat_ws("; ", *errors), F.lit(""))


def apply_unknown(df: DataFrame, fields: list[str], policy: str, body_column: str = "body") -> DataFrame:
    """Body fields that the dictionary lacks: fail adds an error, drop and report remove them (report also lists them).

    A table's dictionary is a short list of column names.
    """
    return _unknown(df, F.array(*map(F.lit, fields)).cast("array<string>"), policy, body_column)


def _unknown(df: DataFrame, known: Column, policy: str, body_column: str) -> DataFrame:
    b = F.col(body_column)
    unknown = F.array_sort(F.array_except(F.map_keys(b), known))
    if policy == "passthrough":
        return df.withColumn("dropped", F.array().cast("array<string>")).withColumn("unknown_error", F.lit(None).cast("string"))
    inside = F.map_filter(b, lambda k, _: F.array_contains(known, k))
    new = b if policy == "fail" else inside
    error = F.when(F.size(unknown) > 0, F.concat(F.lit("unknown fields: "), F.array_join(unknown, ", "))) if policy == "fail" else F.lit(None).cast("string")
    return df.withColumns({"dropped": unknown if policy == "report" else F.array().cast("array<string>"), "unknown_error": error, body_column: new})


def parse_value(value: Column) -> Column:
    """A record's JSON value, text or bytes, as a map of texts; null unless it is an object."""
    return F.from_json(F.when(F.trim(value).startswith("{"), value), "map<string,string>")


def dictionary_columns(dictionary: DataFrame, table: str) -> DataFrame:
    return dictionary.filter((F.col("name") == table) & (F.coalesce("element", F.lit("")) != "")).select("element")


def inheritance(tables: DataFrame, *, depth: int = 32) -> DataFrame:
    """Every table with all it inherits from: name, ancestor, level (0 itself, then nearest first).

    tables has sys_id, name and super_class, the id of the table above; a table
    whose id or name is null is left out. All chains grow together by doubling:
    once each table knows those within 2^k steps and the one 2^k steps up, that
    one's own give the next 2^k, so a depth of 32 takes five joins. A chain ends
    at a repeated table, at an id that isn't there, or at depth; each ancestor
    counts once, where it is nearest. Of rows with one id the least name counts.
    """
    own = tables.filter("sys_id IS NOT NULL AND name IS NOT NULL").groupBy("sys_id").agg(F.min(F.struct("name", "super_class")).alias("t")).select("sys_id", "t.*")
    own = cut(own)
    n = own.count()  # all but known has a row for each table at most
    known = own.select("sys_id", F.col("sys_id").alias("at"), F.lit(0).alias("level"))
    jumps = own.join(side(own.select(F.col("sys_id").alias("up")), n), F.col("super_class") == F.col("up")).select("sys_id", "up")  # whose parent is there
    reach = 1
    while reach < depth:
        further = known.select(F.col("sys_id").alias("up"), "at", "level").join(side(jumps, n), "up").select("sys_id", "at", (F.col("level") + reach).alias("level"))
        known = known.union(further).filter(F.col("level") < depth).groupBy("sys_id", "at").agg(F.min("level").alias("level"))
        known, jumps = cut(known), cut(jumps.join(side(jumps.select(F.col("sys_id").alias("up"), F.col("up").alias("next")), n), "up").select("sys_id", F.col("next").alias("up")))
        reach *= 2
    names = own.select("sys_id", "name")
    above = names.select(F.col("sys_id").alias("at"), F.col("name").alias("ancestor"))
    return known.join(side(names, n), "sys_id").join(side(above, n), "at").select("name", "ancestor", "level")


def inherited_columns(tables: DataFrame, dictionary: DataFrame, *, depth: int = 32) -> DataFrame:
    """Every column of every table, its own and inherited ones: name, element, level (of the nearest table that declares it).

    dictionary has name (of a table) and element; blank elements describe tables.
    Every table has sys_id. Rows are dealt before they are grouped, so that no
    task groups what it made of few rows: a partition is as large as Spark
    makes it of the bytes that it finds.
    """
    chains = inheritance(tables, depth=depth)
    told = cut(dictionary.filter(F.coalesce(F.trim("element"), F.lit("")) != "").select(F.col("name").alias("ancestor"), "element").repartition("ancestor", "element").distinct())
    found = chains.join(side(told, told.count()), "ancestor").select("name", "element", "level")
    always = chains.filter("level = 0").select("name", F.lit("sys_id").alias("element"), "level")
    return found.union(always).repartition("name").groupBy("name", "element").agg(F.min("level").alias("level"))


def apply_dictionary(df: DataFrame, columns: DataFrame, policy: str, *, table_column: str = "table", body_column: str = "body") -> DataFrame:
    """apply_unknown() for rows of many tables: each row's fields are looked up among its own table's columns.

    columns is what inherited_columns() gives. A table's columns meet a row as
    one sorted array, of which there is one for each table. A table that isn't
    there has no columns, which is an error of its own where unknown fields fail.
    """
    known = cut(columns.groupBy(F.col("name").alias("_known_table")).agg(F.array_sort(F.collect_set("element")).alias("_known")))
    joined = df.join(side(known, known.count()), F.col(table_column) == F.col("_known_table"), "left")
    out = _unknown(joined, F.coalesce("_known", F.array().cast("array<string>")), policy, body_column)
    error = F.when(F.col("_known").isNull() & F.lit(policy == "fail"), F.concat(F.lit("no such table: "), F.coalesce(table_column, F.lit("")))).otherwise(F.col("unknown_error"))
    return out.withColumn("unknown_error", error).drop("_known_table", "_known")


def superclass_chain(tables: DataFrame, table: str, *, depth: int = 32) -> DataFrame:
    """A table and its ancestors, nearest first: name, level. Ends at a repeated table or at depth.

    tables has sys_id, name and super_class and is as small as a schema; each
    step of the recursion is a join to it.
    """
    tables.createOrReplaceTempView("_sluice_tables")
    return tables.sparkSession.sql(
        f"""WITH RECURSIVE chain(id, name, parent, level, seen) AS (
            SELECT sys_id, name, super_class, 0, array(sys_id) FROM _sluice_tables WHERE name = :table
            UNION ALL
            SELECT t.sys_id, t.name, t.super_class, c.level + 1, array_append(c.seen, t.sys_id) FROM chain c JOIN _sluice_tables t ON t.sys_id = c.parent
            WHERE c.level < {int(depth) - 1} AND NOT array_contains(c.seen, t.sys_id)
        ) SELECT name, level FROM chain""",
        {"table": table},
    )
