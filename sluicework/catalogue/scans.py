"""Queries of scans and projections."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..functions import coerce
from ..operators import shape
from ..plans import encoded_query as eq
from ..plans import keyset as ks
from ..workers import small
from .base import CHANGES, ISSUE, Catalogue, changes, hex_id, issue, number, placed, table

Q = Catalogue()


@Q(f"WITH {ISSUE}, r AS (SELECT sys_id, state, cost FROM issue WHERE state = 'F' AND cost > 100000 ORDER BY sys_id LIMIT 300) SELECT *, row_number() OVER (ORDER BY sys_id) AS place FROM r")
def scan_list(spark, sf_dir):
    rows = eq.apply(issue(spark, sf_dir), eq.parse("state=F^cost>100000^ORDERBYsys_id").comparing_as_text("sys_id"))
    return placed(ks.select(rows, ["sys_id", "state", "cost"]).limit(300))


@Q(f"WITH {ISSUE} SELECT sys_id, state, priority FROM issue WHERE sys_id = 'a0000000000000000000000000000007'||'' OR sys_id = concat('a', lpad('7', 31, '0')) LIMIT 1")
def point_lookup(spark, sf_dir):
    wanted = "a" + "7".rjust(31, "0")
    return issue(spark, sf_dir).filter((F.col("number") == number(wanted)) & (F.col("sys_id") == wanted)).select("sys_id", "state", "priority").limit(1)


@Q(f"WITH {ISSUE} SELECT number, state FROM issue")
def project_fields(spark, sf_dir):
    return ks.select(issue(spark, sf_dir), ["number", "state", "u_hidden"])


@Q(f"WITH {ISSUE} SELECT state, sys_id, sys_updated_on, sys_mod_count FROM issue")
def project_cursor(spark, sf_dir):
    return ks.select(issue(spark, sf_dir), ks.projection([" state ", "sys_id", "state"]))


@Q(f"WITH {ISSUE} SELECT sys_id AS inc_sys_id, sys_updated_on AS inc_sys_updated_on, priority AS inc_priority FROM issue WHERE sys_updated_on > TIMESTAMP '1995-03-15' AND sys_updated_on <= TIMESTAMP '1995-09-01'")
def view_cursor_scan(spark, sf_dir):
    """A view's own, prefixed cursor fields take the place of the usual ones."""
    view = issue(spark, sf_dir)
    view = view.select(*(F.col(c).alias(f"inc_{c}") for c in view.columns))
    keys = ks.Keys("inc_sys_updated_on", "inc_sys_id", "inc_sys_mod_count")
    rows = ks.next_buckets(view, datetime(1995, 3, 15), datetime(1995, 9, 1), keys)
    return ks.select(rows, ["inc_sys_id", "inc_sys_updated_on", "inc_priority"])


_NATION = "SELECT s_suppkey, CAST(s_nationkey AS VARCHAR) AS v, n_name AS d FROM supplier JOIN nation ON s_nationkey = n_nationkey"


def _suppliers(spark, sf_dir):
    return table(spark, sf_dir, "supplier").join(small(table(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))


@Q(f"SELECT s_suppkey, v AS value, d AS display_value, concat('/nation/', v) AS link FROM ({_NATION})")
def display_all(spark, sf_dir):
    cell = shape.rich(F.col("s_nationkey"), F.col("n_name"), F.concat(F.lit("/nation/"), F.col("s_nationkey").cast("string")), exclude_link=False)
    return _suppliers(spark, sf_dir).select("s_suppkey", cell.alias("c")).select("s_suppkey", "c.*")


@Q(f"SELECT s_suppkey, d AS s_nationkey FROM ({_NATION})")
def display_true(spark, sf_dir):
    df = _suppliers(spark, sf_dir)
    return shape.display_true(df, {"s_nationkey": F.col("n_name"), "s_suppkey": F.lit("never")}, ("s_suppkey",)).select("s_suppkey", "s_nationkey")


@Q(f"SELECT s_suppkey, v AS value, d AS display_value FROM ({_NATION})")
def exclude_link(spark, sf_dir):
    return _suppliers(spark, sf_dir).select("s_suppkey", shape.rich(F.col("s_nationkey"), F.col("n_name")).alias("c")).select("s_suppkey", "c.*")


@Q("SELECT count(*) = 1 AS readable, bool_and(o_orderkey IS NOT NULL) AS has_id, bool_and(o_orderdate IS NOT NULL) AS has_timestamp FROM (SELECT * FROM orders LIMIT 1)")
def probe_cursor_fields(spark, sf_dir):
    one = issue(spark, sf_dir).limit(1)
    ok = coerce.is_timestamp(coerce.format_timestamp(F.col("sys_updated_on")))
    return one.agg((F.count("*") == 1).alias("readable"), F.bool_and(F.col("sys_id").isNotNull()).alias("has_id"), F.bool_and(ok).alias("has_timestamp"))


@Q(f"WITH {ISSUE}, {CHANGES} SELECT 'issue' AS source, sys_id, sys_updated_on AS \"at\" FROM issue UNION ALL SELECT 'change', id, \"at\" FROM changes")
def multi_table_union(spark, sf_dir):
    a = issue(spark, sf_dir).select(F.lit("issue").alias("source"), "sys_id", F.col("sys_updated_on").alias("at"))
    b = changes(spark, sf_dir).select(F.lit("change").alias("source"), F.col("id").alias("sys_id"), "at")
    return a.unionByName(b)


@Q(f"WITH {ISSUE} SELECT sys_id, sys_updated_on FROM issue WHERE sys_updated_on BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-03-31'")
def window_scan(spark, sf_dir):
    q = "sys_updated_on>=1996-01-01 00:00:00^sys_updated_on<=1996-03-31 00:00:00"
    return eq.apply(issue(spark, sf_dir), q).select("sys_id", "sys_updated_on")
