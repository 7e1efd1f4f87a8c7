"""A training-data pipeline over documents: each stage works on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.llm import common
from sluicework.llm.decontaminate import clean
from sluicework.llm.jaccard import without_near_copies
from sluicework.llm.packing import pack
from sluicework.llm.pii import personal_data
from sluicework.llm.toxicity import fit, held_out, without_toxic

#: A document goes when its toxicity score is this or more, as op4 predicts it.
TOXIC = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below TOXIC; the labels learnt from are those of the operator's query."""
    model = fit(docs, common.table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id"))))
    return without_toxic(docs, model, threshold=TOXIC)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of links at a Jaccard similarity of 0.8 over five words."""
    return without_near_copies(docs, k=5, percent=80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of ten words of a benchmark item."""
    return clean(docs, common.table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and secrets in their texts replaced by the kind's name; n_chars follows the text."""
    rows = personal_data(docs, *docs.columns, clean=True)
    new = {"text": F.col("clean"), "n_chars": F.when(F.size("spans") > 0, F.length("clean").cast("long")).otherwise(F.col("n_chars"))}
    return rows.select(*(new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 2048 tokens."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]

#: SQL can express neither the classifier nor the tokenizer; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each but the last is written to the shared folder and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = common.new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
