"""Benchmark decontamination with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Words are runs of 0-9, a-z and everything outside ASCII; A-Z count as a-z.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """The words of a text; none for null."""
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.coalesce(F.regexp_extract_all(low, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def windows(benchmark: DataFrame, n: int) -> DataFrame:
    """Distinct windows of the items: size, hash, gram and the sorted item ids that hold it."""
    w = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    w = w.withColumn("size", F.least(F.size("w"), F.lit(n)))
    w = w.select("item", "size", "w", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("size") + 1)).alias("at"))
    w = w.select("item", "size", F.slice("w", F.col("at"), F.col("size")).alias("gram"))
    return w.groupBy("size", F.xxhash64("gram").alias("hash"), "gram").agg(F.array_sort(F.collect_set("item")).alias("items"))


def _by_text(w: Column) -> Column:
    return F.slice(w, F.col("at"), F.col("size"))


def mark(docs: DataFrame, benchmark: DataFrame, *, n: int = 10) -> DataFrame:
    """One row per row of docs: doc_id, text_md5, n_words, spans and items.

    spans are the distinct (at, size) of every benchmark window in the
    document, at counted in words from 1, in order; items are the sorted ids,
    as strings, of the items with such a window. Windows meet by hash and are
    then compared word by word. The set of windows is broadcast when it has
    common.BROADCAST_ROWS // 10 rows at most. Beyond it a document's windows are
    shuffled as (text's MD5, place, size, hash), a few bytes for each word,
    where Spark splits a hot window's rows, and what was found is taken back to
    the texts to be compared there.

    A null text has no words, an item without words no window, an item of fewer
    than n words is one window; null item ids are never reported; repeated rows
    get equal results, one each; an empty benchmark hits nothing and an empty
    table gives no rows. Other columns, whatever their names, are not read.
    """
    grams = common.cut(windows(benchmark, n))
    count = grams.count()
    sizes = sorted(r[0] for r in grams.select("size").distinct().collect()) or [n]  # n at most
    side = grams.select("hash", "gram", "items")
    if count > common.BROADCAST_ROWS // 10:
        return _mark_shuffled(docs, side, sizes)
    d = _windowed(docs.select("doc_id", F.md5("text").alias("text_md5"), words(F.col("text")).alias("w")), sizes)
    own = _by_text(F.col("w"))
    d = d.withColumn("hash", F.xxhash64(own)).join(F.broadcast(side), "hash", "left")
    first = (F.col("at") == 1) & (F.col("size") == sizes[0])  # one of these per document stays, so that clean ones are kept
    d = d.filter(first | F.col("items").isNotNull())
    hit = F.col("items").isNotNull() & (F.size("gram") == F.col("size")) & (F.col("gram") == own)  # a document's only window may be shorter than size
    d = d.select("doc_id", "text_md5", F.size("w").cast("long").alias("n_words"), first.alias("first"), F.when(hit, F.struct("at", "size")).alias("span"), F.when(hit, F.col("items")).alias("items"))
    d = d.groupBy("doc_id", "text_md5").agg(F.max("n_words").alias("n_words"), F.count_if("first").alias("n_rows"), F.array_sort(F.collect_set("span")).alias("spans"), F.collect_set("items").alias("items"))
    d = d.withColumn("items", F.array_sort(F.array_distinct(F.flatten("items"))))
    return d.withColumn("_row", F.explode(F.sequence(F.lit(1), F.col("n_rows")))).drop("_row", "n_rows")


def _windowed(d: DataFrame, sizes: list[int]) -> DataFrame:
    """A row for each window of each size of the words w; a text shorter than a window has one all the same."""
    d = d.select("*", F.explode(F.array(*map(F.lit, sizes))).alias("size"))
    last = F.greatest(F.size("w") - F.col("size") + 1, F.lit(1))
    return d.select("*", F.explode(F.sequence(F.lit(1), last)).alias("at"))


def _mark_shuffled(docs: DataFrame, side: DataFrame, sizes: list[int]) -> DataFrame:
    texts = docs.select("doc_id", F.md5("text").alias("text_md5"), words(F.col("text")).alias("w"))
    thin = _windowed(texts, sizes).select("text_md5", "at", "size", F.xxhash64(_by_text(F.col("w"))).alias("hash"))
    met = thin.join(side, "hash").filter(F.size("gram") == F.col("size"))
    met = met.groupBy("text_md5").agg(F.collect_set(F.struct("at", "size", "gram", "items")).alias("met"))
    found = texts.join(met, "text_md5", "left")
    true = F.array_sort(F.filter("met", lambda m: F.slice(F.col("w"), m["at"], m["size"]) == m["gram"]))
    found = found.select("doc_id", "text_md5", F.size("w").cast("long").alias("n_words"), F.coalesce(true, F.array().cast(met.schema["met"].dataType)).alias("met"))
    spans = F.array_distinct(F.transform("met", lambda m: F.struct(m["at"].alias("at"), m["size"].alias("size"))))
    return found.select("doc_id", "text_md5", "n_words", spans.alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.transform("met", lambda m: m["items"])))).alias("items"))


def hit_words(spans: Column) -> Column:
    """How many words lie in at least one of the sorted spans."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def step(acc: Column, s: Column) -> Column:
        end = F.greatest(acc["end"], s["at"] + s["size"] - 1)
        return F.struct(end.alias("end"), (acc["n"] + F.greatest(end - F.greatest(acc["end"], s["at"] - 1), F.lit(0))).alias("n"))

    return F.aggregate(spans, start, step, lambda acc: acc["n"])


def clean(docs: DataFrame, benchmark: DataFrame, *, n: int = 10, remove: str = "documents") -> DataFrame:
    """docs without contaminated documents, or with their hit words taken out of the text (remove="spans").

    The marked documents, without texts, are broadcast up to
    common.BROADCAST_ROWS rows and meet docs by a shuffle beyond it.
    """
    found = common.cut(mark(docs, benchmark, n=n).filter(F.size("spans") > 0).select("doc_id", "text_md5", "spans").dropDuplicates(["doc_id", "text_md5"]))
    small = found.count() <= common.BROADCAST_ROWS
    found = found.select(F.col("doc_id").alias("_doc"), F.col("text_md5").alias("_md5"), F.col("spans").alias("_spans"))
    found = F.broadcast(found) if small else found
    same = docs["doc_id"].eqNullSafe(found["_doc"]) & (F.md5(docs["text"]) == found["_md5"])
    if remove == "documents":
        return docs.join(found, same, "left_anti")
    joined = docs.join(found, same, "left")
    text = F.when(F.col("_spans").isNull(), docs["text"]).otherwise(_without(docs["text"], F.col("_spans")))
    return joined.select(*(text.alias(c) if c == "text" else docs[c] for c in docs.columns))


def _without(text: Column, spans: Column) -> Column:
    own = F.regexp_extract_all(text, F.lit(RAW_WORD), F.lit(0))
    between = F.split(text, RAW_WORD, -1)
    gone = F.array_distinct(F.flatten(F.transform(spans, lambda s: F.sequence(s["at"], s["at"] + s["size"] - 1))))
    kept = F.transform(own, lambda w, i: F.when(F.array_contains(gone, i + 1), F.lit("")).otherwise(w))
    return F.concat(F.array_join(F.transform(kept, lambda w, i: F.concat(F.element_at(between, i + 1), w)), ""), F.element_at(between, -1))
