"""Token counts through a digest cache."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common


@cache
def tokenizer_digest(path: str) -> str:
    """SHA-256 of the tokenizer's file: another version of a vocabulary never meets old counts."""
    import hashlib

    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


@cache
def _dropped(path: str) -> tuple[bool, bool]:
    """Whether the tokenizer itself lowers letters and takes runs of white space for one space."""
    if not path.endswith(".json"):
        return False, False
    with open(path, encoding="utf-8") as f:
        rule = json.load(f).get("normalizer") or {}
    steps = rule.get("normalizers") or [rule]
    spaces = any(s.get("type") == "Replace" and s.get("pattern", {}).get("Regex") == r"\s+" and s.get("content") == " " for s in steps)
    return any(s.get("type") == "Lowercase" for s in steps), spaces


def normalised(text: Column, path: str) -> Column:
    """A text's content as far as the tokenizer tells contents apart: texts of one content have one count.

    Only ASCII letters are lowered and only runs of ASCII white space joined, in
    texts of ASCII without a special token's opening, where nothing else of the
    tokenizer's rules depends on them; other texts stay as they are.
    """
    lowers, joins = _dropped(path)
    out = F.lower(text) if lowers else text
    out = F.regexp_replace(out, r"[ \t\n\x0B\f\r]+", " ") if joins else out
    return F.when((F.octet_length(text) == F.length(text)) & ~text.contains("<|"), out).otherwise(text)


def _counts(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            counts = lambda texts: [len(model.encode(t)) for t in texts.to_pylist()]
        else:
            from .encode import encoder

            one = encoder(path)
            counts = lambda texts: [len(x) // 4 for x in one.encode_all(texts)]
        for b in common.slices(batches, 2000):
            yield pa.record_batch([b.column("digest"), pa.array(counts(b.column("text")), pa.int64())], ["digest", "n_tokens"])
        common.settle()

    return run


def count_tokens(docs: DataFrame, tokenizer: str, cache_path: str, *, limit: int = 2048) -> DataFrame:
    """docs' columns plus n_bytes, n_tokens and over_limit (n_tokens > limit).

    The content digest is SHA-256 of the normalised text's UTF-8 bytes; null
    counts as the empty text. With the digest of the tokenizer's file it is the key of the
    cache, a Parquet table at cache_path that need not exist yet. Three steps:

    1. digests of all rows, without texts, are joined to the cache; of each
       digest that it lacks one row is chosen;
    2. those rows' texts alone are encoded where they were read, and their
       counts are appended to the cache;
    3. every row takes its count from the cache.

    Copies, ties and repeated rows share a count, null doc_id is an id like any
    other, an empty table gives an empty result, and docs may have columns of
    any name: those that clash with the three added ones are replaced. The
    chosen rows' ids are broadcast up to common.BROADCAST_ROWS and joined by a
    shuffle beyond it.
    """
    spark = docs.sparkSession
    common.ship(spark)
    version = tokenizer_digest(tokenizer)
    others = [c for c in docs.columns if c not in ("text", "n_bytes", "n_tokens", "over_limit")]
    full = F.coalesce(F.col("text"), F.lit(""))
    named = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), full.alias("text"), F.sha2(normalised(full, tokenizer), 256).alias("digest"))
    key = F.xxhash64(F.col("_row.doc_id"), "digest")
    thin = common.cut(named.select("digest", key.alias("_key")).groupBy("digest").agg(F.min("_key").alias("_key")))
    known = _read_cache(spark, cache_path, version)
    misses = common.cut(thin.join(known, "digest", "left_anti"))
    n = misses.count()
    if n:
        keys = misses.select("_key")
        if n <= common.BROADCAST_ROWS:
            keys = F.broadcast(keys)
        texts = named.select("text", "digest", key.alias("_key")).join(keys, "_key", "left_semi").select("digest", "text")
        fresh = texts.mapInArrow(_counts(tokenizer), "digest string, n_tokens long").dropDuplicates(["digest"])
        fresh.withColumn("version", F.lit(version)).write.mode("append").parquet(cache_path)
    known = common.cut(_read_cache(spark, cache_path, version))  # stored, so that the join below is a plain one, whose hot digests Spark splits
    rows = named.select("_row", F.octet_length("text").cast("long").alias("n_bytes"), "digest")
    return rows.join(known, "digest").select(*(F.col(f"_row.`{c}`").alias(c) for c in others), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def _read_cache(spark: SparkSession, path: str, version: str) -> DataFrame:
    """Counts of one tokenizer version: one row per digest, also if two writers added the same one."""
    schema = "digest string, n_tokens long, version string"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], schema).drop("version")
    return spark.read.schema(schema).parquet(path).filter(F.col("version") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
