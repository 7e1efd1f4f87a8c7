"""Queries of request bodies."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import mapping as mp
from .base import Catalogue, table

Q = Catalogue()


def _parts(spark, sf_dir):
    null = F.when(F.col("p_partkey") % 4 != 0, F.col("p_brand"))
    return table(spark, sf_dir, "part").select("p_partkey", "p_name", null.alias("p_brand"), "p_size", F.lit("x").alias("sys_id"))


def _body(m, *fields, where: str | None = None):
    def run(spark, sf_dir):
        df = _parts(spark, sf_dir)
        b, error = mp.body(df, m, exclude=("p_partkey",))
        out = df.select("p_partkey", b.alias("body"), error.alias("error"))
        return out.select("p_partkey", *(F.col("body")[f].alias(f) for f in fields), F.size("body").alias("fields"), "error")

    return run


_B = "CASE WHEN p_partkey % 4 <> 0 THEN p_brand END"
_N = "CASE WHEN p_partkey % 4 <> 0 THEN 1 ELSE 0 END"
_S = "CAST(p_size AS VARCHAR)"
_E = "CAST(NULL AS VARCHAR) AS error"
Q.add("map_rename", _body(mp.Mapping(rename=(("p_name", "short_description"),)), "short_description", "p_size"), f"SELECT p_partkey, p_name AS short_description, {_S} AS p_size, 2 + {_N} AS fields, {_E} FROM part")
Q.add("map_allow", _body(mp.Mapping(allow=("p_name", "sys_id")), "p_name", "sys_id"), f"SELECT p_partkey, p_name, 'x' AS sys_id, 2 AS fields, {_E} FROM part")
Q.add("map_deny", _body(mp.Mapping(deny=("p_name",)), "p_name", "p_size"), f"SELECT p_partkey, CAST(NULL AS VARCHAR) AS p_name, {_S} AS p_size, 1 + {_N} AS fields, {_E} FROM part")
Q.add("map_reserved", _body(mp.Mapping(), "sys_id", "p_size"), f"SELECT p_partkey, CAST(NULL AS VARCHAR) AS sys_id, {_S} AS p_size, 2 + {_N} AS fields, {_E} FROM part")
Q.add("null_omit", _body(mp.Mapping(), "p_brand"), f"SELECT p_partkey, {_B} AS p_brand, 2 + {_N} AS fields, {_E} FROM part")
Q.add("null_clear", _body(mp.Mapping(nulls="clear"), "p_brand"), f"SELECT p_partkey, coalesce({_B}, '') AS p_brand, 3 AS fields, {_E} FROM part")
Q.add("null_reject", _body(mp.Mapping(nulls="reject"), "p_brand"), f"SELECT p_partkey, {_B} AS p_brand, 2 + {_N} AS fields, CASE WHEN p_partkey % 4 = 0 THEN 'p_brand: null' END AS error FROM part")


def _nested(m, *fields):
    def run(spark, sf_dir):
        p = table(spark, sf_dir, "part").select("p_partkey", F.struct(F.col("p_brand").alias("city"), F.struct(F.col("p_size").alias("lat"), F.lit(None).cast("int").alias("lng")).alias("geo")).alias("location"))
        b, error = mp.body(p, m, exclude=("p_partkey",))
        out = p.select("p_partkey", b.alias("body"), error.alias("error"))
        return out.select("p_partkey", *(F.col("body")[f].alias(f) for f in fields), "error")

    return run


Q.add("nested_reject", _nested(mp.Mapping()), "SELECT p_partkey, 'location: nested struct' AS error FROM part")
Q.add("nested_flatten", _nested(mp.Mapping(nested="flatten"), "location_city", "location_geo_lat", "location_geo_lng"), f"SELECT p_partkey, p_brand AS location_city, {_S} AS location_geo_lat, CAST(NULL AS VARCHAR) AS location_geo_lng, {_E} FROM part")
Q.add("nested_stringify", _nested(mp.Mapping(nested="stringify"), "location"), "SELECT p_partkey, concat('{\"city\":\"', p_brand, '\",\"geo\":{\"lat\":', p_size, ',\"lng\":null}}') AS location, CAST(NULL AS VARCHAR) AS error FROM part")


def _unknown(policy: str):
    def run(spark, sf_dir):
        p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
        b, _ = mp.body(p, mp.Mapping(), exclude=("p_partkey",))
        out = mp.apply_unknown(p.select("p_partkey", b.alias("body")), ["p_name", "number"], policy)
        return out.select("p_partkey", F.size("body").alias("fields"), F.array_join("dropped", ",").alias("dropped"), F.col("unknown_error").alias("error"))

    return run


for _policy, _fields, _dropped, _error in (("fail", 2, "", "'unknown fields: p_size'"), ("drop", 1, "", "NULL"), ("report", 1, "p_size", "NULL"), ("passthrough", 2, "", "NULL")):
    Q.add(f"unknown_{_policy}", _unknown(_policy), f"SELECT p_partkey, {_fields} AS fields, '{_dropped}' AS dropped, CAST({_error} AS VARCHAR) AS error FROM part")


@Q("SELECT p_partkey, p_name AS short_description, concat('Brand ', p_partkey % 3) AS u_brand, 2 AS fields, 'p_size' AS dropped FROM part")
def map_full(spark, sf_dir):
    """All steps in their order: rename, deny, reserved, flatten, nulls, rendering, unknown fields."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", F.struct(F.concat(F.lit("Brand "), (F.col("p_partkey") % 3).cast("string")).alias("brand")).alias("u"), F.lit(1).alias("sys_mod_count"), F.lit(2).alias("secret"))
    m = mp.Mapping(rename=(("p_name", "short_description"),), deny=("secret",), nested="flatten")
    b, _ = mp.body(p, m, exclude=("p_partkey",))
    out = mp.apply_unknown(p.select("p_partkey", b.alias("body")), ["short_description", "u_brand"], "report")
    return out.select("p_partkey", F.col("body")["short_description"].alias("short_description"), F.col("body")["u_brand"].alias("u_brand"), F.size("body").alias("fields"), F.array_join("dropped", ",").alias("dropped"))


def hierarchy(spark, sf_dir):
    """Parts as tables: a tree, at whose root two inherit from each other, with long chains beside it; and what their dictionary says."""
    k = F.col("p_partkey")
    up = F.when(k == 1, 2).when(k == 2, 1).when(k % 100 > 40, k - 1).otherwise(F.floor(k / 3)).cast("string")
    p = table(spark, sf_dir, "part")
    tables = p.select(k.cast("string").alias("sys_id"), F.concat(F.lit("t"), k.cast("string")).alias("name"), F.when(k % 17 != 0, up).alias("super_class"))
    dictionary = p.select(F.concat(F.lit("t"), k.cast("string")).alias("name"), F.explode(F.array(F.concat(F.lit("u_"), (F.col("p_size") % 20).cast("string")), F.col("p_brand"), F.when(k % 5 == 0, "").otherwise("number"))).alias("element"))
    return tables, dictionary


HIERARCHY = """RECURSIVE t AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_partkey = 1 THEN 2 WHEN p_partkey = 2 THEN 1 WHEN p_partkey % 100 > 40 THEN p_partkey - 1 ELSE p_partkey // 3 END AS up FROM part),
 c(k, a, level) AS (SELECT k, k, 0 FROM t UNION ALL SELECT c.k, t2.k, level + 1 FROM c JOIN t t1 ON t1.k = c.a JOIN t t2 ON t2.k = t1.up WHERE level < 31),
 chain AS (SELECT k, a, min(level) AS level FROM c GROUP BY k, a),
 dict AS (SELECT DISTINCT p_partkey AS a, unnest(['u_' || (p_size % 20), p_brand, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE 'number' END]) AS element FROM part),
 cols AS (SELECT k, element, min(level) AS level FROM (SELECT k, element, level FROM chain JOIN dict USING (a) WHERE element <> '' UNION ALL SELECT k, 'sys_id', 0 FROM t) GROUP BY k, element)"""


@Q(f"WITH {HIERARCHY} SELECT 't' || k AS name, element, level FROM cols")
def inherited_dictionary(spark, sf_dir):
    """The columns of every table at once."""
    return mp.inherited_columns(*hierarchy(spark, sf_dir))


@Q(f"""WITH {HIERARCHY}, r AS (SELECT row_number() OVER () AS rn, l_orderkey, l_linenumber, l_partkey AS k, ['u_' || (l_quantity::INTEGER % 20), 'number', 'u_none'] AS fields FROM lineitem),
 x AS (SELECT rn, k, unnest(fields) AS f FROM r),
 d AS (SELECT rn, string_agg(f, ',' ORDER BY f) AS dropped, count(*) AS n FROM x LEFT JOIN cols ON cols.k = x.k AND element = f WHERE element IS NULL GROUP BY rn)
 SELECT r.l_orderkey, r.l_linenumber, coalesce(dropped, '') AS dropped, CAST(3 - coalesce(n, 0) AS INTEGER) AS fields FROM r LEFT JOIN d USING (rn)""")
def unknown_by_table(spark, sf_dir):
    """Rows for many tables, each row's fields looked up in its own table's inherited columns."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.concat(F.lit("t"), F.col("l_partkey").cast("string")).alias("table"), F.map_from_arrays(F.array(F.concat(F.lit("u_"), (F.col("l_quantity").cast("int") % 20).cast("string")), F.lit("number"), F.lit("u_none")), F.array(F.lit("1"), F.lit("2"), F.lit("3"))).alias("body"))
    out = mp.apply_dictionary(rows, mp.inherited_columns(*hierarchy(spark, sf_dir)), "report")
    return out.select("l_orderkey", "l_linenumber", F.array_join("dropped", ",").alias("dropped"), F.size("body").alias("fields"))


@Q("SELECT * FROM (VALUES ('rename', 'more than one column would be called p_name'), ('flatten', 'more than one field would be called a_b')) t(\"case\", error)")
def map_collision(spark, sf_dir):
    """Two fields of one name are told before any row is read."""
    p = table(spark, sf_dir, "part")
    cases = {
        "rename": (p.select("p_name", "p_brand"), mp.Mapping(rename=(("p_brand", "p_name"),))),
        "flatten": (p.select(F.col("p_name").alias("a_b"), F.struct(F.col("p_size").alias("b")).alias("a")), mp.Mapping(nested="flatten")),
    }
    rows = []
    for name, (df, m) in cases.items():
        try:
            mp.body(df, m)
        except ValueError as e:
            rows.append((name, str(e)))
    return spark.createDataFrame(rows, "case string, error string")
