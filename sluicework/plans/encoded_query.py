"""The encoded filter language: text to a small syntax tree, and the tree to Catalyst expressions.

Terms are split on ^. A term joins the conjunction of its branch; one that
starts with OR joins the group before it; NQ opens another branch. A query is
the OR of its branches, a branch the AND of its groups, a group the OR of its
terms, so Catalyst sees one predicate and can push its parts into a scan.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The operators, in the order in which they are tried at a place.
OPERATORS = ("ISNOTEMPTY", "ISEMPTY", "NOT IN", "IN", "LIKE", "STARTSWITH", "ENDSWITH", "!=", ">=", "<=", "=", ">", "<")
_TERM = re.compile(f"([A-Za-z0-9_.]+?)({'|'.join(OPERATORS)})(.*)", re.DOTALL)
_NUMBER = re.compile(r"\s*[+-]?(NaN|Infinity|(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?)[fFdD]?)\s*")
_TIMESTAMP = re.compile(r"\d{4}-\d\d-\d\d \d\d:\d\d:\d\d")
_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


class EncodedQueryError(ValueError):
    """A term that the language doesn't know."""


@dataclass(frozen=True)
class Term:
    field: str
    operator: str
    value: str = ""


@dataclass(frozen=True)
class Order:
    field: str
    descending: bool = False


@dataclass(frozen=True)
class EncodedQuery:
    """branches of groups of terms, and the sort keys in sequence."""

    branches: tuple[tuple[tuple[Term, ...], ...], ...] = ((),)
    orders: tuple[Order, ...] = ()
    string_fields: frozenset[str] = field(default=frozenset())

    def and_(self, *groups: tuple[Term, ...]) -> EncodedQuery:
        """Every branch narrowed by the groups."""
        return replace(self, branches=tuple(b + groups for b in self.branches))

    def order_by(self, name: str, *, descending: bool = False) -> EncodedQuery:
        return replace(self, orders=(*self.orders, Order(name, descending)))

    def comparing_as_text(self, *names: str) -> EncodedQuery:
        """The same query, with these fields compared as strings even where both sides look like numbers."""
        return replace(self, string_fields=self.string_fields | set(names))


SCRIPT = "javascript:"


def _words(query: str) -> Iterator[tuple[str, str]]:
    """The query's words in sequence: branch, order, and, or; each with its text."""
    for part in query.split("^"):
        if part in ("", "EQ"):
            continue
        if part.startswith("ORDERBY"):
            yield "order", part.removeprefix("ORDERBY")
            continue
        text = part.removeprefix("NQ")
        if text != part:
            yield "branch", ""
        if text.startswith("OR"):
            yield "or", text.removeprefix("OR")
        elif text:
            yield "and", text


def _read_term(text: str) -> Term | None:
    found = None if SCRIPT in text else _TERM.fullmatch(text)
    return Term(*found.groups()) if found else None


def parse(query: str | None, *, lenient: bool = False) -> EncodedQuery:
    """The tree of a query; an unknown term or a script raises, or that term alone is dropped if lenient."""
    if query is None or not query.strip():
        return EncodedQuery()
    if SCRIPT in query and not lenient:
        raise EncodedQueryError(f"scripts are not accepted: {query!r}")
    branches: list[list[list[Term]]] = [[]]
    orders: list[Order] = []
    for kind, text in _words(query):
        if kind == "order":
            orders.append(Order(text.removeprefix("DESC"), text.startswith("DESC")))
        elif kind == "branch":
            branches.append([])
        elif term := _read_term(text):
            if kind == "or" and branches[-1]:
                branches[-1][-1].append(term)
            else:
                branches[-1].append([term])
        elif not lenient:
            raise EncodedQueryError(f"unknown term {text!r}")
    return EncodedQuery(tuple(tuple(map(tuple, b)) for b in branches), tuple(orders))


def is_number(text: str) -> bool:
    return bool(_NUMBER.fullmatch(text))


def _number(text: str) -> float:
    return float(text.strip().rstrip("fFdD")) if "Infinity" not in text else float(text)


def _compare(c: Column, kind: str, op: str, value: str, as_text: bool) -> Column:
    """c against value under =, <, <=, > or >=: numbers if both sides are, strings otherwise."""
    ops = {"=": lambda a, b: a == b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b}
    run = ops[op]
    if kind.startswith("timestamp"):
        if not _TIMESTAMP.fullmatch(value):
            return run(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit(value))
        at = datetime.strptime(value, "%Y-%m-%d %H:%M:%S")  # columns count whole seconds: bounds let the scan compare raw values
        start, end = (F.lit(x.isoformat(sep=" ")).cast(kind) for x in (at, at + timedelta(seconds=1)))
        return {"=": (c >= start) & (c < end), "<": c < start, "<=": c < end, ">": c >= end, ">=": c >= start}[op]
    if as_text or not is_number(value):
        return run(c.cast("string"), F.lit(value))
    if kind in _NUMERIC or kind.startswith("decimal"):
        whole = kind in ("tinyint", "smallint", "int", "bigint") and re.fullmatch(r"[+-]?\d{1,18}", value)
        return run(c, F.lit(int(value))) if whole else run(c.cast("double"), F.lit(_number(value)))
    number = c.try_cast("double")
    return F.when(number.isNotNull(), run(number, F.lit(_number(value)))).otherwise(run(c, F.lit(value)))


def _term(t: Term, kinds: dict[str, str], as_text: bool) -> Column:
    if t.field not in kinds:  # an absent field is empty
        c, kind = F.lit(None).cast("string"), "string"
    else:
        c, kind = F.col(f"`{t.field}`"), kinds[t.field]
    text = c if kind == "string" else F.date_format(c, "yyyy-MM-dd HH:mm:ss") if kind.startswith("timestamp") else c.cast("string")
    empty = (text.isNull() | (text == "")) if kind == "string" else c.isNull()
    op, v = t.operator, t.value
    if op == "ISEMPTY" or op == "=" and not v:
        return empty
    if op == "ISNOTEMPTY" or op == "!=" and not v:
        return ~empty
    if op in ("=", "!="):  # v isn't empty, so an empty string never equals it; null is left to the filter, which scans can read
        same = _compare(c, kind, "=", v, as_text)
        return same if op == "=" else c.isNull() | ~same
    if op in ("<", "<=", ">", ">="):
        bound = _compare(c, kind, op, v, as_text)
        return F.lit(False) if not v else bound if kind != "string" else bound & (text != "")
    if op in ("IN", "NOT IN"):
        items = v.split(",")
        while len(items) > 1 and not items[-1]:
            items.pop()
        found = text.isin(items) | text.isNull() if "" in items else text.isin(items)
        return found if op == "IN" else (~text.isin(items) if "" in items else text.isNull() | ~text.isin(items))
    low, want = F.lower(text) if v else F.coalesce(F.lower(text), F.lit("")), F.lit(v.lower())
    return {"LIKE": F.contains, "STARTSWITH": F.startswith, "ENDSWITH": F.endswith}[op](low, want)


def predicate(query: EncodedQuery, df: DataFrame) -> Column:
    """The query's filter over df's columns; null counts as false, as in any filter."""
    kinds = dict(df.dtypes)

    def all_of(parts: list[Column], empty: bool, join) -> Column:
        out = None
        for p in parts:
            out = p if out is None else join(out, p)
        return F.lit(empty) if out is None else out

    def branch(groups) -> Column:
        ors = [all_of([_term(t, kinds, t.field in query.string_fields) for t in g], True, lambda a, b: a | b) for g in groups]
        return all_of(ors, True, lambda a, b: a & b)

    return all_of([branch(b) for b in query.branches], True, lambda a, b: a | b)


def ordering(query: EncodedQuery, df: DataFrame) -> list[Column]:
    """Sort keys. A field that df lacks is empty everywhere and orders nothing.

    Strings that are numbers are compared as numbers, anything else as text, and
    a number with a text as texts. That isn't transitive in general, so the
    order is: empty and what sorts before digits, then numbers by value, then
    all other text, whose first letters sort behind digits as a rule.
    """
    kinds, keys = dict(df.dtypes), []
    for o in query.orders:
        if o.field not in kinds:
            continue
        c = F.col(f"`{o.field}`")
        parts = [c]
        if kinds[o.field] == "string":
            text = F.coalesce(c, F.lit(""))
            parts = [text]
            if o.field not in query.string_fields:
                number = c.try_cast("double")
                parts = [F.when(number.isNotNull(), 1).when(text < "0", 0).otherwise(2), number, F.when(number.isNull(), text)]
        keys += [p.desc() if o.descending else p.asc() for p in parts]
    return keys


def apply(df: DataFrame, query: str | EncodedQuery | None, *, lenient: bool = False, invalid_is_empty: bool = False, arrival: str | None = None) -> DataFrame:
    """df filtered and sorted by a query; with invalid_is_empty an unknown term gives no rows instead of an error.

    Spark keeps no order of insertion: rows stand in one only if arrival names
    the column that tells it, which also decides between equal sort keys.
    """
    try:
        tree = query if isinstance(query, EncodedQuery) else parse(query, lenient=lenient)
    except EncodedQueryError:
        if not invalid_is_empty:
            raise
        return df.filter(F.lit(False))
    out = df.filter(predicate(tree, df))
    keys = ordering(tree, df) + ([F.col(f"`{arrival}`").asc()] if arrival else [])
    return out.orderBy(*keys) if keys else out
