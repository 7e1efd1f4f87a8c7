"""String-valued cells to typed values and back, as expressions that never raise on bad data.

Every coercion gives null both for the empty string and for a value that does
not fit; bad() tells the two apart.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

TIMESTAMP = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
_INTS = {"int8": ("tinyint", 2**7), "int16": ("smallint", 2**15), "int32": ("int", 2**31), "int64": ("bigint", 2**63)}
_TYPES = frozenset({"string", *_INTS, "float32", "float64", "boolean", "bytes", "timestamp", "date", "time", "decimal"})


@dataclass(frozen=True)
class Declared:
    """A field of a typed mapping."""

    field: str
    type: str
    scale: int = 2


_NAME = frozenset(string.ascii_letters + string.digits + "_.")


def _declared(part: str) -> Declared:
    """One 'field:type' or 'field:decimal(scale)'."""
    name, _, rest = (x.strip() for x in part.partition(":"))
    kind, bracket, scale = (x.strip() for x in rest.partition("("))
    scale = scale.removesuffix(")").strip() if scale.endswith(")") else "-"
    if not name or not set(name) <= _NAME or kind not in _TYPES or bracket and not (scale.isascii() and scale.isdigit()):
        raise ValueError(f"not a field declaration: {part.strip()!r}")
    if bracket and kind != "decimal":
        raise ValueError(f"only decimal has a scale: {part.strip()!r}")
    return Declared(name, kind, int(scale)) if bracket else Declared(name, kind)


def parse_mapping(text: str) -> list[Declared]:
    """'field:type,field:decimal(3)' to declarations; wrong grammar, types, scales and repeated fields raise."""
    found: dict[str, Declared] = {}
    for part in filter(str.strip, text.split(",")):
        d = _declared(part)
        if d.field in found:
            raise ValueError(f"declared twice: {d.field}")
        found[d.field] = d
    return list(found.values())


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def to_int(c: Column, kind: str = "int64") -> Column:
    """Whole numbers, also written like 12.0; beyond the type's range null rather than wrapped."""
    spark_type, top = _INTS[kind]
    n = F.trim(c).try_cast("decimal(38,10)")
    edge = F.lit(str(top)).cast("decimal(38,0)")
    whole = (n == F.floor(n)) & (n >= -edge) & (n < edge)
    return F.when(F.trim(c) != "", F.when(whole, n)).try_cast(spark_type)


def to_float(c: Column, kind: str = "float64") -> Column:
    return F.when(F.trim(c) != "", F.trim(c)).try_cast("float" if kind == "float32" else "double")


def to_boolean(c: Column) -> Column:
    low = F.lower(F.trim(c))
    return F.when(low.isin("true", "1", "yes"), True).when(low.isin("false", "0", "no"), False)


def to_decimal(c: Column, scale: int = 2) -> Column:
    """Thousands' commas are dropped; rounds half up."""
    return F.round(F.replace(F.trim(c), F.lit(","), F.lit("")).try_cast("decimal(38,18)"), scale).cast(f"decimal(38,{scale})")


def to_timestamp(c: Column) -> Column:
    """Strictly yyyy-MM-dd HH:mm:ss in UTC; a day that doesn't exist is null."""
    text = F.trim(c)
    return F.when(text.rlike(TIMESTAMP), text).try_cast("timestamp_ntz")


def is_timestamp(c: Column) -> Column:
    return to_timestamp(c).isNotNull()


def to_date(c: Column) -> Column:
    text = F.trim(c)
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text).try_cast("date")


def to_time(c: Column) -> Column:
    """Seconds of the day of HH:mm:ss."""
    text = F.trim(c)
    parts = F.split(text, ":")
    ok = text.rlike(r"^([01]\d|2[0-3]):[0-5]\d:[0-5]\d$")
    return F.when(ok, parts[0].try_cast("int") * 3600 + parts[1].try_cast("int") * 60 + parts[2].try_cast("int"))


def to_bytes(c: Column) -> Column:
    return F.when(c != "", F.try_to_binary(c, F.lit("base64")))


def coerce(c: Column, d: Declared) -> Column:
    """c as the declared type."""
    if d.type == "string":
        return c
    if d.type in _INTS:
        return to_int(c, d.type)
    if d.type.startswith("float"):
        return to_float(c, d.type)
    if d.type == "decimal":
        return to_decimal(c, d.scale)
    return {"boolean": to_boolean, "bytes": to_bytes, "timestamp": to_timestamp, "date": to_date, "time": to_time}[d.type](c)


def bad(c: Column, d: Declared) -> Column:
    """Whether c holds something that the declared type cannot."""
    return F.lit(False) if d.type == "string" else F.coalesce(c, F.lit("")).rlike(r"\S") & coerce(c, d).isNull()


def format_timestamp(c: Column) -> Column:
    """Cut to the second."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def plain(number: Column) -> Column:
    """A number's text without an exponent, every digit kept: 1.5E-7 is 0.00000015."""
    parts = F.split(number, "E")
    sign, mantissa = F.when(number.startswith("-"), "-").otherwise(""), F.replace(parts[0], F.lit("-"), F.lit(""))
    digits = F.replace(mantissa, F.lit("."), F.lit(""))
    at = F.length(F.substring_index(mantissa, ".", 1)) + F.try_element_at(parts, F.lit(2)).try_cast("int")
    whole = F.rpad(digits, F.greatest(at, F.lit(0)), F.lit("0"))
    split = F.concat(F.substr(digits, F.lit(1), at), F.lit("."), F.substr(digits, at + 1))
    moved = F.when(at <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -at), digits)).when(at >= F.length(digits), whole).otherwise(split)
    return F.when(number.contains("E"), F.concat(sign, moved)).otherwise(number)


def render(c: Column, kind: str) -> Column:
    """A typed value as the wire's text; null stays null.

    Whole doubles below 1e15 have no fraction, others are plain decimals with
    all their digits; decimals lose an exponent, not their scale; bytes become
    Base64. NaN and infinities have no rendering and give null.
    """
    if kind in ("float", "double"):
        d = c.cast("double")
        finite = ~F.isnan(d) & (F.abs(d) < float("inf"))
        return F.when(finite, F.when((d == F.floor(d)) & (F.abs(d) < 1e15), d.try_cast("bigint").cast("string")).otherwise(plain(d.cast("string"))))
    if kind == "boolean":
        return F.when(c, "true").when(~c, "false")
    if kind.startswith("decimal"):
        return plain(c.cast("string"))
    if kind.startswith("timestamp"):
        return format_timestamp(c)
    if kind == "date":
        return F.date_format(c, "yyyy-MM-dd")
    if kind == "binary":
        return F.base64(c)
    return c.cast("string")
