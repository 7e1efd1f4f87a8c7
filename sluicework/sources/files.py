"""Files that other tools write: dumps of delivered records, and exports of a table as one JSON document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import is_id
from ..workers import cut, side

#: Why a line or row is left out; those that only are headers, comments or blank aren't counted at all.
SKIPPED = "skipped"
_WHITE = " \t\r\n\x0b\x0c\ufeff"


def _cell(parts: Column, n: int) -> Column:
    """A field without white space, quotes and the line's carriage return; empty and null are nothing."""
    c = F.trim(F.trim(F.try_element_at(parts, F.lit(n)), F.lit(_WHITE)), F.lit('"'))
    return F.when(~c.isin("", "null"), c)


def read_dump(lines: DataFrame) -> DataFrame:
    """Lines (value) of one to three tab-separated fields as sys_id, ts, mod and fault.

    Blank lines, comments and header or null ids are no records and are left
    out; a line whose id isn't one stays, with a fault, so that what follows can
    count it in its own pass.
    """
    value = F.rtrim(F.col("value"), F.lit("\r\n"))
    p = F.split(value, "\t")
    sys_id = F.trim(F.trim(p[0], F.lit(_WHITE)), F.lit('"'))
    told = (F.trim(value, F.lit(_WHITE)) != "") & ~value.startswith("#") & ~F.lower(sys_id).isin("null", "sys_id")
    fault = F.when(~is_id(sys_id), SKIPPED)
    return lines.filter(told).select(F.when(fault.isNull(), sys_id).alias("sys_id"), F.when(fault.isNull(), _cell(p, 2)).alias("ts"), F.when(fault.isNull(), _cell(p, 3)).alias("mod"), fault.alias("fault"))


# --- one JSON document, read by many tasks

_BLOCK = ("file", "block")


#: Bytes of text for each partition to which blocks are dealt; Spark itself would put what is compressed to 64 MB into one, and text grows much in a sort.
_DEALT = 16 << 20


def _opened(marks: Column) -> Column:
    """Brackets that a text opens, less those that it closes."""
    return (F.length(F.translate(marks, "]}", "")) - F.length(F.translate(marks, "[{", ""))).cast("long")


def fragments(spark: SparkSession, path: str) -> DataFrame:
    """Documents cut at each closing brace, which isn't shown: file, block, at (the order inside a block), text, and what a fragment does.

    A reader that takes that brace for a line's end splits a file anywhere, also
    one that has no line at all. quotes counts a fragment's own; outside and
    inside are the brackets that it opens if it begins outside or inside of a
    string. No escape reaches over a brace, as none may stand before one.
    """
    raw = spark.read.option("lineSep", "}").text(path)
    f = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("text"))
    # only quotes and brackets are left, so that what is counted is short; a select each, or each use would make them again
    f = f.withColumn("marks", F.regexp_replace("text", r"\\[\s\S]|[^\"\[\]{}\\]+", ""))
    f = f.withColumn("even", F.regexp_replace("marks", r'"[^"]*(?:"|$)', ""))
    f = f.withColumns({"quotes": (F.length("marks") - F.length(F.translate("marks", '"', ""))).cast("long"), "outside": _opened(F.col("even"))})
    return f.withColumn("inside", _opened(F.col("marks")) - F.col("outside")).drop("marks", "even")


def _sum_before(c: Column, w) -> Column:
    return F.coalesce(F.sum(c).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))


def _placed(f: DataFrame) -> DataFrame:
    """Fragments with depth (at their end, the brace left out), in_string (there), last (of their file) and sign (the file's first).

    Both states are composed: inside of a block by a running sum for either
    beginning, and over blocks, of which there are few, by sums of blocks.
    """
    own = W.partitionBy(*_BLOCK).orderBy("at")
    f = f.withColumn("odd", _sum_before(F.col("quotes"), own) % 2)
    ends_odd = (F.col("odd") + F.col("quotes")) % 2
    f = f.withColumns({"ends_odd": ends_odd, "out": F.when(F.col("odd") == 0, F.col("outside")).otherwise(F.col("inside")), "in": F.when(F.col("odd") == 1, F.col("outside")).otherwise(F.col("inside"))})
    # with the brace behind it, where that stands outside of a string
    braced = {"out": F.col("out") - F.when(F.col("ends_odd") == 0, 1).otherwise(0), "in": F.col("in") - F.when(F.col("ends_odd") == 1, 1).otherwise(0)}
    f = cut(f.withColumns({f"{k}_before": _sum_before(c, own) for k, c in braced.items()}))
    blocks = f.groupBy(*_BLOCK).agg((F.sum("quotes") % 2).alias("odd"), *(F.sum(c).alias(k) for k, c in braced.items()), F.max("at").alias("end"), F.min_by(F.nullif(F.substring(F.trim(F.col("text"), F.lit(_WHITE)), 1, 1), F.lit("")), F.when(F.trim(F.col("text"), F.lit(_WHITE)) != "", F.col("at"))).alias("sign"))
    in_file = W.partitionBy("file").orderBy("block")
    b = blocks.withColumn("begins_in", _sum_before(F.col("odd"), in_file) % 2)
    b = b.withColumn("base", _sum_before(F.when(F.col("begins_in") == 0, F.col("out")).otherwise(F.col("in")), in_file))
    whole = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    b = b.select(*_BLOCK, "begins_in", "base", F.when(F.col("block") == F.max("block").over(whole), F.col("end")).alias("end"), F.first("sign", ignorenulls=True).over(whole).alias("sign"))
    b = cut(b)
    f = f.join(side(b, b.count()), list(_BLOCK))
    outside = F.col("begins_in") == 0
    depth = F.col("base") + F.when(outside, F.col("out_before") + F.col("out")).otherwise(F.col("in_before") + F.col("in"))
    return f.select(*_BLOCK, "at", "text", depth.alias("depth"), ((F.col("begins_in") + F.col("ends_odd")) % 2 == 1).alias("in_string"), (F.col("end").isNotNull() & (F.col("at") == F.col("end"))).alias("last"), "sign")



def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows of every export under path, one JSON text each: file, n (a row's place in its file), row, junk (elements before it that are no objects).

    An export is a list of objects, or an object with such a list as its result,
    in one line or many; what else that object has comes before the list. A row
    ends at the brace that leads back to the list, so a row's fragments are put
    together by the number of rows that ended before them. Each file's last row
    of the result has no text, only the elements behind the last object. A text
    that is no export, or ends before its list does, raises.
    """
    held = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0]  # a listing: no content is read
    parts = max(spark.sparkContext.defaultParallelism, -(-(held or 0) // _DEALT))
    f = _placed(fragments(spark, path).repartition(parts, *_BLOCK))
    level = F.when(F.col("sign") == "{", 2).otherwise(1)
    f = f.withColumn("ends", ~F.col("in_string") & (F.col("depth") - 1 == level) & ~F.col("last"))
    counts = f.groupBy(*_BLOCK).agg(F.count_if("ends").alias("rows"))
    counts = counts.select(*_BLOCK, _sum_before(F.col("rows"), W.partitionBy("file").orderBy("block")).alias("first"))
    counts = cut(counts)
    n = F.col("first") + _sum_before(F.col("ends").cast("long"), W.partitionBy(*_BLOCK).orderBy("at"))
    g = f.join(side(counts, counts.count()), list(_BLOCK)).repartition(parts, *_BLOCK).withColumn("n", n).groupBy("file", "n").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "at", "text"))), lambda x: x["text"]), "}").alias("text"),
        F.max("ends").alias("whole"), F.max(F.when(F.col("last"), F.struct("in_string", "depth"))).alias("end"), F.first("sign").alias("sign"),
    )
    opening = F.when(F.col("sign") == "{", F.lit(r'^[\s\S]*?"result"\s*:\s*\[')).otherwise(F.lit(r"^[\s\ufeff]*\["))
    begun = F.regexp_replace("text", opening, F.lit(","))
    # a brace at a file's end isn't shown, so an object may seem to be open there
    ended = ~F.col("end.in_string") & ((F.col("end.depth") == 0) | (F.col("end.depth") == 1) & (F.col("sign") == "{"))
    bad = (F.col("n") == 0) & (F.col("text") == begun) | F.col("sign").isNull() | ~F.col("sign").isin("{", "[") | F.col("end").isNotNull() & ~ended
    g = g.filter(F.when(F.coalesce(bad, F.lit(True)), F.raise_error(F.concat(F.col("file"), F.lit(" is no export, or only a part of one"))).cast("boolean")).otherwise(True))
    body = F.when(F.col("n") == 0, begun).otherwise(F.col("text"))
    lead = F.when(F.col("whole"), F.regexp_extract(body, r"^([^{]*)", 1)).otherwise(F.regexp_extract(body, r"^([^\]]*)", 1))
    junk = F.size(F.filter(F.split(lead, ","), lambda x: F.trim(x, F.lit(_WHITE)) != ""))
    return g.select("file", "n", F.when(F.col("whole"), F.concat(F.substr(body, F.length(lead) + 1), F.lit("}"))).alias("row"), junk.cast("long").alias("junk"))


def read_export(spark: SparkSession, path: str, *, ts: str = "sys_updated_on", mod: str = "sys_mod_count") -> DataFrame:
    """Exports under path as sys_id, ts, mod and fault; cells may be {"value": ...}.

    What is no object, or has no id that is one, stays as a row with a fault, so
    that what follows can count it in its own pass.
    """
    rows = read_rows(spark, path).select(F.from_json("row", "map<string,string>").alias("r"), "row", "junk")

    def cell(name: str) -> Column:
        c = F.col("r")[name]
        return F.when(c.startswith("{"), F.get_json_object(c, "$.value")).otherwise(c)

    sys_id = F.trim(cell("sys_id"))
    fault = F.when(~is_id(sys_id), SKIPPED)
    own = F.when(F.col("row").isNotNull(), F.struct(F.when(fault.isNull(), sys_id).alias("sys_id"), F.when(fault.isNull(), cell(ts)).alias("ts"), F.when(fault.isNull(), cell(mod)).alias("mod"), fault.alias("fault")))
    none = F.struct(*(F.lit(None).cast("string").alias(c) for c in ("sys_id", "ts", "mod")), F.lit(SKIPPED).alias("fault"))
    return rows.select(F.explode(F.array_compact(F.concat(F.array(own), F.array_repeat(none, F.col("junk").cast("int"))))).alias("x")).select("x.*")
