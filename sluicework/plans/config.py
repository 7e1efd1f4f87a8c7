"""Options of sources and sinks: neutral names, defaults, and all errors at once, each with its key."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from ..functions import coerce
from ..functions.text import is_table  # noqa: F401  the column form of the same rule
from . import encoded_query
from .keyset import Keys, check_projection

FORMAT = "%Y-%m-%d %H:%M:%S"


class ConfigError(ValueError):
    """Errors by key."""

    def __init__(self, errors: dict[str, str]):
        super().__init__("; ".join(f"{k}: {v}" for k, v in errors.items()))
        self.errors = errors


def _choice(errors: dict, key: str, value: str, allowed: tuple[str, ...]) -> None:
    if value not in allowed:
        errors[key] = f"{value!r} is none of {', '.join(allowed)}"


def _range(errors: dict, key: str, value: float, low: float, high: float | None = None) -> None:
    if value < low or high is not None and value > high:
        errors[key] = f"{value} is not {'at least ' + str(low) if high is None else f'between {low} and {high}'}"


@dataclass(frozen=True)
class Connection:
    """Defaults of the transport: seconds, requests at once, bytes and attempts."""

    url: str = ""
    connect_timeout: float = 10.0
    request_timeout: float = 60.0
    concurrent: int = 8
    adaptive: bool = True
    max_body: int = 64 << 20
    attempts: int = 5
    retry_budget: float = 300.0
    initial_backoff: float = 0.5
    max_backoff: float = 30.0

    def errors(self) -> dict[str, str]:
        e: dict[str, str] = {}
        if not self.url.startswith(("http://", "https://")):
            e["url"] = "must start with https:// or http://"
        elif "?" in self.url or "#" in self.url:
            e["url"] = "must not carry a query or fragment"
        for key in ("connect_timeout", "request_timeout", "retry_budget"):
            _range(e, key, getattr(self, key), 0.001)
        for key in ("concurrent", "attempts", "max_body"):
            _range(e, key, getattr(self, key), 1)
        if self.max_backoff < self.initial_backoff:
            e["max_backoff"] = "is below initial_backoff"
        return e


@dataclass(frozen=True)
class TableConfig:
    """One table's scan."""

    table: str = ""
    query: str = ""
    fields: tuple[str, ...] = ()
    start: str = "1970-01-01 00:00:00"
    keys: Keys = field(default_factory=Keys)
    display: str = "false"
    exclude_link: bool = True
    query_domain: bool = True
    category: str = ""
    schema: str = "schemaless"
    mapping: str = ""
    topic: str = ""

    def errors(self) -> dict[str, str]:
        e: dict[str, str] = {}
        if not self.table or not all(c.isascii() and (c.islower() or c.isdigit() or c == "_") for c in self.table):
            e["table"] = "is not a table name"
        try:
            if encoded_query.parse(self.query, lenient=True).orders:
                e["query"] = "must not order; the scan does"
        except encoded_query.EncodedQueryError as x:
            e["query"] = str(x)
        try:
            datetime.strptime(self.start, FORMAT)
        except ValueError:
            e["start"] = "must be yyyy-MM-dd HH:mm:ss"
        try:
            check_projection(list(self.fields), self.keys)
        except ValueError as x:
            e["fields"] = str(x)
        _choice(e, "display", self.display, ("false", "true", "all"))
        _choice(e, "schema", self.schema, ("schemaless", "strings", "typed"))
        if self.schema == "typed":
            try:
                if not coerce.parse_mapping(self.mapping):
                    e["mapping"] = "typed needs declared fields"
            except ValueError as x:
                e["mapping"] = str(x)
        return e


@dataclass(frozen=True)
class SourceConfig:
    """A source's tables and policies."""

    tables: dict[str, TableConfig] = field(default_factory=dict)
    poll_ms: int = 5000
    batch_size: int = 5000
    overlap_seconds: int = 2
    lag_seconds: int = 1
    evolution: str = "fail"
    bad_rows: str = "fail"
    probe: bool = True
    envelope: bool = False

    def errors(self) -> dict[str, str]:
        e: dict[str, str] = {}
        if not self.tables:
            e["tables"] = "must name at least one"
        for alias, t in self.tables.items():
            e |= {f"tables.{alias}.{k}": v for k, v in t.errors().items()}
        _range(e, "batch_size", self.batch_size, 1, 50_000)
        for key in ("poll_ms", "overlap_seconds", "lag_seconds"):
            _range(e, key, getattr(self, key), 0)
        _choice(e, "evolution", self.evolution, ("fail", "backward", "permissive"))
        _choice(e, "bad_rows", self.bad_rows, ("fail", "skip"))
        return e


@dataclass(frozen=True)
class SinkConfig:
    """Where changes go and what happens when they can't."""

    routing: str = "fixed"
    table: str = ""
    routes: dict[str, str] = field(default_factory=dict)
    ids: str = "key_value"
    update: str = "PATCH"
    id_conflict: str = "reject"
    nulls: str = "omit"
    unknown: str = "fail"
    nested: str = "reject"
    delimiter: str = "_"
    lanes: int = 8
    concurrent: int = 8
    create: str = "fail_ambiguous"
    correlation_field: str = ""
    not_found: str = "fail"
    behaviour: str = "fail"
    allow: tuple[str, ...] = ()
    deny: tuple[str, ...] = ()
    rename: tuple[tuple[str, str], ...] = ()
    operation: str = "infer"
    fixed_operation: str = ""
    allowed_tables: tuple[str, ...] = ()
    table_header: str = "table"
    operation_header: str = "operation"
    id_header: str = "sys_id"
    id_field: str = "sys_id"

    def errors(self) -> dict[str, str]:
        e: dict[str, str] = {}
        _choice(e, "operation", self.operation, ("infer", "header", "fixed"))
        if (self.operation == "fixed") != (self.fixed_operation in ("CREATE", "PATCH", "PUT", "DELETE")):
            e["fixed_operation"] = "belongs to the operation fixed, and is one of CREATE, PATCH, PUT and DELETE"
        _choice(e, "routing", self.routing, ("fixed", "topic", "header"))
        _choice(e, "ids", self.ids, ("key", "value", "key_value", "header"))
        _choice(e, "update", self.update, ("PATCH", "PUT"))
        _choice(e, "id_conflict", self.id_conflict, ("reject", "key", "value"))
        _choice(e, "nulls", self.nulls, ("omit", "clear", "reject"))
        _choice(e, "unknown", self.unknown, ("fail", "drop", "report", "passthrough"))
        _choice(e, "nested", self.nested, ("reject", "flatten", "stringify"))
        _choice(e, "create", self.create, ("retry", "fail_ambiguous", "correlation_lookup"))
        _choice(e, "not_found", self.not_found, ("fail", "ignore", "create"))
        _choice(e, "behaviour", self.behaviour, ("fail", "log", "ignore"))
        if self.routing == "fixed" and not self.table:
            e["table"] = "fixed routing needs one"
        if self.routing == "topic" and not self.routes:
            e["routes"] = "topic routing needs some"
        if self.allow and self.deny:
            e["deny"] = "excludes allow"
        if self.create == "correlation_lookup" and not self.correlation_field:
            e["correlation_field"] = "a lookup needs one"
        if self.lanes > self.concurrent:
            e["lanes"] = "exceed the connection's concurrent requests"
        return e


def writer_options(config: SinkConfig) -> dict:
    """What a sink's checked configuration says to write_changes() and send_batches()."""
    check(config)
    return {"lanes": config.lanes, "behaviour": config.behaviour, "create": config.create, "correlation_field": config.correlation_field, "not_found": config.not_found}


def check(config) -> None:
    """Raise all errors of a configuration at once."""
    if found := config.errors():
        raise ConfigError(found)
