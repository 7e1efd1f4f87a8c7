"""Records of a topic to the changes that a sink sends: routing, ids, operations, bodies and unknown fields, as one configuration says."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.config import SinkConfig, check
from . import change
from .mapping import Mapping, apply_dictionary, body

#: What a change has beside its coordinates; sink.COLUMNS are among them.
CHANGE = ("op", "table", "sys_id", "body", "dropped", "error")


def ingest(records: DataFrame, config: SinkConfig, columns: DataFrame | None = None) -> DataFrame:
    """topic, partition, offset and CHANGE of every record.

    records has topic, partition, offset, key (text), value (a struct, null for a
    tombstone) and headers (a map of texts). columns are the tables' columns, as
    inherited_columns() gives them; without them no field is unknown. A record
    that can't be sent has an error and keeps what could be found out, all its
    errors in the order in which they are looked for; body is JSON, null where
    the operation has none. Nothing is dropped: what becomes of errors is the
    sink's behaviour.
    """
    check(config)
    header = lambda name: F.col("headers")[name]
    if config.routing == "fixed":
        table, unrouted = change.route_fixed(config.table), F.lit(None).cast("string")
    elif config.routing == "topic":
        table, unrouted = change.route_topic(F.col("topic"), config.routes)
    else:
        table, unrouted = change.route_header(header(config.table_header), config.allowed_tables)
    kind = records.schema["value"].dataType
    if not isinstance(kind, T.StructType):
        raise ValueError("a record's value is a struct")
    own = F.col("value")[config.id_field].cast("string") if config.id_field in kind.names else F.lit(None).cast("string")
    places: dict[str, Column] = {"key": F.col("key"), "value": own, "header": header(config.id_header)}
    sys_id, odd_id = change.extract_id({k: c for k, c in places.items() if config.ids == "key_value" and k != "header" or k == config.ids}, precedence=config.id_conflict)
    gone = F.col("value").isNull()
    known = records.withColumns({"_table": table, "_unrouted": unrouted, "_id": sys_id, "_odd_id": odd_id})
    op, odd_op = change.resolve_operation(header(config.operation_header), mode=config.operation, fixed=config.fixed_operation or None, update=config.update, value_is_null=gone, sys_id=F.col("_id"))
    known = known.withColumns({"_op": op, "_odd_op": odd_op})
    mapping = Mapping(rename=config.rename, allow=config.allow, deny=config.deny, nulls=config.nulls, nested=config.nested, delimiter=config.delimiter, unknown=config.unknown)
    fields, odd_body = body(known, mapping, value="value")
    sends = ~gone & (F.coalesce("_op", F.lit("")) != "DELETE")
    known = known.withColumns({"_body": F.when(sends, fields).otherwise(F.create_map().cast("map<string,string>")), "_odd_body": F.when(sends, odd_body), "_lacks": change.check_operation(F.col("_op"), F.col("_id"), gone)})
    if columns is None or config.unknown == "passthrough":
        known = known.withColumns({"dropped": F.array().cast("array<string>"), "unknown_error": F.lit(None).cast("string")})
    else:
        known = apply_dictionary(known, columns, config.unknown, table_column="_table", body_column="_body")
        known = known.withColumn("unknown_error", F.when(sends & F.col("_table").isNotNull(), F.col("unknown_error")))
    error = F.nullif(F.concat_ws("; ", "_unrouted", "_odd_id", "_odd_op", "_lacks", "_odd_body", "unknown_error"), F.lit(""))
    shown = [F.col("_op").alias("op"), F.col("_table").alias("table"), F.col("_id").alias("sys_id"), F.when(sends, F.to_json("_body")).alias("body"), "dropped", error.alias("error")]
    return known.select("topic", "partition", "offset", *shown)
