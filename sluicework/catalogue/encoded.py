"""Queries of the encoded language."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import encoded_query as eq
from .base import ISSUE, Catalogue, issue, placed, table

Q = Catalogue()

_CUSTOMER = ("c_custkey", "c_name", "c_acctbal", "c_mktsegment")


_BLANK = "blank AS (SELECT c_custkey, c_name, c_acctbal, CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN c_mktsegment END AS c_mktsegment FROM customer)"


def _source(spark, sf_dir, name: str):
    """customer, issue, or blank: customers of whom some have an empty segment and some none."""
    if name == "issue":
        return issue(spark, sf_dir)
    c = table(spark, sf_dir, "customer")
    n = F.col("c_custkey") % 3
    return c if name == "customer" else c.select("c_custkey", "c_name", "c_acctbal", F.when(n == 0, "").when(n == 1, F.col("c_mktsegment")).alias("c_mktsegment"))


def _filter(name: str, query: str, where: str, source: str = "customer", **how) -> None:
    """A query over customer, issue or blank, checked by a WHERE clause."""
    columns = ("sys_id", "state", "priority") if source == "issue" else _CUSTOMER

    def run(spark, sf_dir):
        return eq.apply(_source(spark, sf_dir, source), query, **how).select(*columns)

    first = {"issue": f"WITH {ISSUE} ", "blank": f"WITH {_BLANK} ", "customer": ""}[source]
    Q.add(name, run, f"{first}SELECT {', '.join(columns)} FROM {source} WHERE {where}")


def _counted(name: str, queries: dict[str, str], **how) -> None:
    """How many customers each query finds, checked by WHERE clauses; so that one without rows shows as well."""

    def run(spark, sf_dir):
        df = table(spark, sf_dir, "customer")
        found = [eq.apply(df, q, **how).agg(F.count("*").alias("rows")).select(F.lit(q).alias("query"), "rows") for q in queries]
        return reduce(DataFrame.unionByName, found)

    Q.add(name, run, " UNION ALL ".join(f"SELECT '{q}' AS query, count(*) AS rows FROM customer WHERE {w}" for q, w in queries.items()))


_filter("eq_eq", "c_mktsegment=BUILDING", "c_mktsegment = 'BUILDING'")
_filter("eq_eq_number", "c_nationkey=07.0", "c_nationkey = 7")
_filter("eq_ne", "c_mktsegment!=BUILDING", "c_mktsegment IS NULL OR c_mktsegment <> 'BUILDING'")
_filter("eq_gt", "c_acctbal>5000", "c_acctbal > 5000")
_filter("eq_ge", "c_custkey>=700", "c_custkey >= 700")
_filter("eq_lt", "c_acctbal<0", "c_acctbal < 0")
_filter("eq_le", "c_custkey<=100", "c_custkey <= 100")
_filter("eq_gt_text", "c_mktsegment>FURNITURE", "c_mktsegment > 'FURNITURE'")
_filter("eq_timestamp", "sys_updated_on>=1995-03-15 00:00:00^sys_updated_on<1995-06-01 12:00:00", "sys_updated_on >= TIMESTAMP '1995-03-15' AND sys_updated_on < TIMESTAMP '1995-06-01 12:00:00'", "issue")
_filter("eq_like", "c_nameLIKEcustomer#00000001", "contains(lower(c_name), 'customer#00000001')")
_filter("eq_startswith", "c_mktsegmentSTARTSWITHbUi", "starts_with(lower(c_mktsegment), 'bui')")
_filter("eq_endswith", "c_nameENDSWITH7", "ends_with(lower(c_name), '7')")
_filter("eq_in", "c_mktsegmentINBUILDING,MACHINERY", "c_mktsegment IN ('BUILDING', 'MACHINERY')")
_filter("eq_not_in", "c_mktsegmentNOT INBUILDING,MACHINERY", "coalesce(c_mktsegment, '') NOT IN ('BUILDING', 'MACHINERY')")
_filter("eq_isempty", "c_mktsegmentISEMPTY", "coalesce(c_mktsegment, '') = ''", "blank")
_filter("eq_isnotempty", "c_mktsegmentISNOTEMPTY", "coalesce(c_mktsegment, '') <> ''", "blank")
_filter("eq_absent_field", "u_unknownISEMPTY^c_custkey<50", "c_custkey < 50")
_filter("eq_and", "c_mktsegment=BUILDING^c_acctbal>0^c_nationkey<10", "c_mktsegment = 'BUILDING' AND c_acctbal > 0 AND c_nationkey < 10")
_filter("eq_or", "c_mktsegment=BUILDING^ORc_mktsegment=MACHINERY^c_acctbal>0", "(c_mktsegment = 'BUILDING' OR c_mktsegment = 'MACHINERY') AND c_acctbal > 0")
_filter("eq_nq", "c_mktsegment=BUILDING^c_acctbal>9000^NQc_nationkey=3", "(c_mktsegment = 'BUILDING' AND c_acctbal > 9000) OR c_nationkey = 3")
_filter("eq_terminator", "c_nationkey=3^^EQ", "c_nationkey = 3")
_filter("eq_blank", "", "true")
_counted("eq_invalid_strict", {"c_nationkey~3": "false", "c_nationkey=3": "c_nationkey = 3", "c_custkey<40^OR": "false"}, invalid_is_empty=True)
_filter("eq_invalid_lenient", "c_nationkey~3^c_custkey<40", "c_custkey < 40", lenient=True)
_counted("eq_script", {"c_nationkey=javascript:now()": "false", "c_nameLIKEcustomer": "true"}, invalid_is_empty=True)
_counted("eq_script_lenient", {"javascript:x^c_custkey<40": "c_custkey < 40", "c_nationkey=javascript:now()^c_custkey<30": "c_custkey < 30", "javascript:x": "true"}, lenient=True)


@Q(f"WITH {ISSUE} SELECT sys_id, state, priority FROM issue WHERE (state = 'F' AND priority = '1-URGENT' AND caller < 500) OR (state = 'O' AND caller < 500)")
def eq_and_all_branches(spark, sf_dir):
    df = issue(spark, sf_dir)
    tree = eq.parse("state=F^priority=1-URGENT^NQstate=O").and_((eq.Term("caller", "<", "500"),))
    return eq.apply(df, tree).select("sys_id", "state", "priority")


@Q(f"WITH {ISSUE} SELECT sys_id FROM issue WHERE sys_id > 'a0000000000000000000000000000010a0'")
def eq_id_as_text(spark, sf_dir):
    tree = eq.parse("sys_id>a0000000000000000000000000000010a0").comparing_as_text("sys_id")
    return eq.apply(issue(spark, sf_dir), tree).select("sys_id")


def _page(name: str, query: str, order: str, limit: int, offset: int = 0) -> None:
    def run(spark, sf_dir):
        df = eq.apply(table(spark, sf_dir, "customer"), query).select("c_custkey", "c_mktsegment", "c_acctbal")
        return placed((df.offset(offset) if offset else df).limit(limit))

    Q.add(name, run, f"SELECT *, row_number() OVER (ORDER BY {order}) AS place FROM (SELECT c_custkey, c_mktsegment, c_acctbal FROM customer ORDER BY {order} LIMIT {limit} OFFSET {offset})")


def _ordered(name: str, query: str, order: str, cell: str = "c_mktsegment", **how) -> None:
    """All customers in an order; a row's number is its place, since results are compared without their order."""

    def run(spark, sf_dir):
        df = table(spark, sf_dir, "customer").withColumn("cell", F.expr(cell))
        return placed(eq.apply(df, query, **how).select("c_custkey", "cell"))

    Q.add(name, run, f"SELECT c_custkey, cell, row_number() OVER (ORDER BY {order}) AS place FROM (SELECT *, {cell} AS cell FROM customer)")


_ordered("order_asc", "ORDERBYc_custkey", "c_custkey")
_ordered("order_desc", "ORDERBYc_mktsegment^ORDERBYDESCc_custkey", "c_mktsegment, c_custkey DESC")
_MIXED = "CASE c_custkey % 4 WHEN 0 THEN cast(c_nationkey AS varchar(20)) WHEN 1 THEN concat('x', c_nationkey) WHEN 2 THEN '' ELSE concat(c_nationkey, '.5') END"
_CLASS = "CASE c_custkey % 4 WHEN 2 THEN 0 WHEN 1 THEN 2 ELSE 1 END"
_NUMBER = "CASE c_custkey % 4 WHEN 0 THEN c_nationkey WHEN 3 THEN c_nationkey + 0.5 END"
_ordered("order_mixed", "ORDERBYcell^ORDERBYc_custkey", f"{_CLASS}, {_NUMBER}, cell, c_custkey", _MIXED)
_ordered("order_mixed_desc", "ORDERBYDESCcell^ORDERBYc_custkey", f"{_CLASS} DESC, {_NUMBER} DESC NULLS LAST, cell DESC, c_custkey", _MIXED)
_ordered("order_absent", "ORDERBYu_unknown^ORDERBYDESCc_custkey", "c_custkey DESC")
_ordered("order_arrival", "c_custkey>=0", "c_custkey", arrival="c_custkey")
_page("top_k", "ORDERBYDESCc_acctbal^ORDERBYc_custkey", "c_acctbal DESC, c_custkey", 50)
_page("offset_page", "ORDERBYc_acctbal^ORDERBYc_custkey", "c_acctbal, c_custkey", 40, 60)


@Q("SELECT c_custkey, c_mktsegment, row_number() OVER (ORDER BY c_mktsegment DESC, c_custkey) AS place FROM customer WHERE c_nationkey = 3")
def ordered_by_builder(spark, sf_dir):
    tree = eq.parse("c_nationkey=3").order_by("c_mktsegment", descending=True).order_by("c_custkey")
    return placed(eq.apply(table(spark, sf_dir, "customer"), tree).select("c_custkey", "c_mktsegment"))


