"""Queries of text functions, policies, assignment and configuration."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import assign, resilience
from .base import Catalogue, table

Q = Catalogue()


def c(name: str):
    return F.col(name)


@Q("SELECT p_partkey, replace(replace(replace(p_name, '%', '%25'), ' ', '%20'), '#', '%23') AS v FROM part")
def percent_encode(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", text.percent_encode(c("p_name")).alias("v"))


@Q("SELECT o_orderkey, concat('sha256:', sha256(concat('issue', chr(10), 'number=', o_orderkey, chr(10), 'false'))) AS v FROM orders")
def fingerprint(spark, sf_dir):
    q = F.concat(F.lit(" number="), c("o_orderkey").cast("string"), F.lit("  "))
    return table(spark, sf_dir, "orders").select("o_orderkey", text.fingerprint(F.lit("issue"), q, F.lit(False)).alias("v"))


@Q("SELECT page_id, lower(regexp_extract(url, '^https?://([^/:?#]+)', 1)) AS host FROM pages")
def instance_host(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.instance_host(c("url")).alias("host"))


def _times(x: str, k: int) -> str:
    return f"CAST((CAST({x} AS HUGEINT) * {k}) % 4294967296 AS BIGINT)"


def _rotated(x: str, by: int) -> str:
    return f"((({x} << {by}) & 4294967295) | ({x} >> {32 - by}))"


def _word(at: str, size: int) -> str:
    return " + ".join(f"(unicode(substr(t, {at} + {j + 1}, 1))::BIGINT << {8 * j})" for j in range(size))


def _mixed(x: str) -> str:
    return _times(_rotated(_times(f"({x})", assign.C1), 15), assign.C2)


#: The hash in SQL: blocks of four ASCII letters folded, then the rest, then the last mixing step by step.
_OWNER = f"""WITH a AS (SELECT lower(regexp_replace(c_name, '[^A-Za-z0-9]', '_', 'g')) AS alias FROM customer),
 t AS (SELECT alias, i, concat(alias, '#', i) AS t FROM a, range(5) r(i)),
 b AS (SELECT alias, i, t, len(t) AS n, list_transform(range(len(t) // 4), lambda k: {_mixed(_word('4 * k', 4))}) AS ks FROM t),
 h AS (SELECT alias, i, t, n, list_reduce(list_prepend({assign.SEED}::BIGINT, ks), lambda h, k: ({_times(_rotated('xor(h, k)', 13), 5)} + {assign.ADD}) % 4294967296) AS h FROM b),
 r AS (SELECT alias, i, xor(xor(h, CASE n % 4 WHEN 1 THEN {_mixed(_word('n - 1', 1))} WHEN 2 THEN {_mixed(_word('n - 2', 2))} WHEN 3 THEN {_mixed(_word('n - 3', 3))} ELSE 0 END), n::BIGINT) AS h FROM h),
 x AS (SELECT alias, i, {_times('xor(h, h >> 16)', assign.MIX1)} AS h FROM r), y AS (SELECT alias, i, {_times('xor(h, h >> 13)', assign.MIX2)} AS h FROM x), z AS (SELECT alias, i, xor(h, h >> 16) AS h FROM y)
 SELECT alias, CAST(i AS INTEGER) AS task FROM z QUALIFY row_number() OVER (PARTITION BY alias ORDER BY h DESC, i) = 1"""


@Q(_OWNER)
def rendezvous_owner(spark, sf_dir):
    aliases = table(spark, sf_dir, "customer").select(F.lower(F.regexp_replace("c_name", "[^A-Za-z0-9]", "_")).alias("alias"))
    return assign.owner(aliases, "alias", 5)


#: A fold whose state is 1000 times the permits plus the successes since.
_AIMD = """SELECT event_type, CAST(list_reduce(list_prepend(8000, list(CASE WHEN event_id % 97 = 0 THEN 1 ELSE 0 END ORDER BY event_id)), lambda s, t:
 CASE WHEN t = 1 THEN 1000 * greatest(1, (s // 1000) // 2) WHEN s // 1000 >= 8 THEN 1000 * (s // 1000) WHEN s % 1000 + 1 >= 5 THEN 1000 * (s // 1000 + 1) ELSE s + 1 END) // 1000 AS INTEGER) AS permits FROM events GROUP BY event_type"""


@Q(_AIMD)
def aimd_permits(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return resilience.aimd_permits(e, "event_type", "event_id", F.col("event_id") % 97 == 0, every=5)
