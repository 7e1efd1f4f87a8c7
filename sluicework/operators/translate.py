"""Translation of key-value configurations by a table of rules.

A rule has from_key, action (rename, value, drop or manual), to_key, from_value,
to_value, note and rank. Keys without a rule pass through. Rules are a table, so
that another pair of systems needs no code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import config_timestamp
from ..workers import small

RULES = "from_key string, action string, to_key string, from_value string, to_value string, note string, rank int"


def translate(config: DataFrame, rules: DataFrame, *, timestamps: tuple[str, ...] = ()) -> DataFrame:
    """config's (connector, key, value) rows with key and value translated, note and rank.

    The rules are a configuration themselves; they are counted before they are
    broadcast.
    """
    r = small(rules)
    hit = (config["key"] == r["from_key"]) & (r["from_value"].isNull() | (r["from_value"] == config["value"]))
    j = config.join(r, hit, "left")
    value = F.when(F.col("action") == "value", F.col("to_value")).when(F.col("key").isin(*timestamps), config_timestamp(F.col("value"))).otherwise(F.col("value"))
    return j.select("connector", F.coalesce("to_key", "key").alias("new_key"), F.when(F.coalesce("action", F.lit("")) != "drop", value).alias("new_value"), F.coalesce("action", F.lit("pass")).alias("action"), "note", F.coalesce("rank", F.lit(1000)).alias("rank"))


def variant(config: DataFrame, known: dict[str, str]) -> DataFrame:
    """What kind of connector each configuration is: by its class, else by keys that only one kind has, else by the class name's end."""
    cls = F.max(F.when(F.col("key") == "connector.class", F.col("value")))
    tables = F.bool_or(F.col("key").isin("tables.num", "table1.name"))
    g = config.groupBy("connector").agg(cls.alias("cls"), tables.alias("tabled"))
    simple = F.substring_index("cls", ".", -1)
    by_class = F.create_map(*(F.lit(x) for p in known.items() for x in p)) if known else F.create_map().cast("map<string,string>")
    kind = F.coalesce(by_class[F.col("cls")], by_class[simple], F.when(F.col("tabled"), "cloud-source").when(F.endswith(simple, F.lit("SinkConnector")), "sink").when(F.endswith(simple, F.lit("SourceConnector")), "source"))
    return g.select("connector", kind.alias("variant"))


def exit_code(translated: DataFrame) -> DataFrame:
    """2 for connectors that somebody must look at, else 0."""
    return translated.groupBy("connector").agg(F.when(F.bool_or(F.col("action") == "manual"), 2).otherwise(0).alias("exit_code"))


def properties(translated: DataFrame) -> DataFrame:
    """Each connector's lines key=value in order of rank and key."""
    kept = translated.filter(F.col("new_value").isNotNull())
    line = F.struct("rank", F.col("new_key").alias("k"), F.concat("new_key", F.lit("="), "new_value").alias("line"))
    return kept.groupBy("connector").agg(F.array_join(F.transform(F.array_sort(F.collect_list(line)), lambda x: x["line"]), "\n").alias("text"))


def as_json(translated: DataFrame) -> DataFrame:
    kept = translated.filter(F.col("new_value").isNotNull())
    pair = F.struct(F.col("rank"), F.col("new_key").alias("key"), F.col("new_value").alias("value"))

    def entry(x: Column) -> Column:
        return F.struct(x["key"].alias("key"), x["value"].alias("value"))

    return kept.groupBy("connector").agg(F.to_json(F.map_from_entries(F.transform(F.array_sort(F.collect_list(pair)), entry))).alias("json"))
