"""The pipeline's stages on a small table whose outcome is known."""

import random

from pyspark.sql import functions as F

import corpus_pipeline


def test_stages(spark, sf_dir, make_docs, tmp_path):
    rng = random.Random(2)
    vocabulary = [f"word{i}" for i in range(500)]

    def text(n=60):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    docs = [(i, text()) for i in range(400)]
    toxic = {i for i in range(0, 400, 8)}
    docs = [(i, " ".join(f"{w} vile scum" if k % 9 == 0 else w for k, w in enumerate(t.split())) if i in toxic else t) for i, t in docs]
    item = text(15)
    docs += [(1000, docs[1][1]), (1001, f"{docs[1][1]} more"), (1002, f"{text(20)} {item} {text(20)}"), (1003, f"{text(20)} mail me@here.org {text(5)}"), (1004, None), (1005, "")]
    d = str(tmp_path)
    make_docs(spark, docs).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(400)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    table = spark.read.parquet(f"{d}/documents.parquet")
    kept, columns = [], table.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, table, d).write.parquet(f"{d}/{name}")
        table = spark.read.parquet(f"{d}/{name}")
        assert table.columns == columns
        kept.append({r.doc_id for r in table.select("doc_id").collect()})
    every = {i for i, _ in docs}
    assert kept[0] == every - toxic
    assert kept[1] == kept[0] - {1000, 1001}
    assert kept[2] == kept[1] - {1002}
    assert kept[3] == kept[2]
    (mail,) = table.filter("doc_id = 1003").select("text", "n_chars").collect()
    assert "<EMAIL>" in mail.text and "@" not in mail.text and mail.n_chars == len(mail.text)
    packed = corpus_pipeline.run(spark, d)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == kept[3]
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0


def test_near_copies_by_five_words_at_four_fifths(spark, sf_dir, make_docs):
    """Four scattered changes in 200 words: 176 of 216 shingles of five words, but only 186 of 210 of three."""
    first = [f"a{i}" for i in range(200)]
    near = [f"b{i}" if i in (30, 80, 130, 180) else w for i, w in enumerate(first)]
    far = [f"c{i}" if i in (30, 70, 110, 150, 190) else w for i, w in enumerate(first)]
    docs = make_docs(spark, [(i, " ".join(w)) for i, w in ((1, first), (2, near), (3, far))])
    assert {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, sf_dir).collect()} == {1, 3}


def test_toxicity_drops_what_op4_predicts(spark, sf_dir, make_docs, monkeypatch):
    class Scored:
        """A model whose probability is the text itself."""

        def passages(self, text):
            return (float(text),)

        def evidence(self, x):
            return x

        def probability(self, x):
            return x

    monkeypatch.setattr(corpus_pipeline, "fit", lambda docs, labels: Scored())
    docs = make_docs(spark, [(i, f"0.{i}") for i in range(1, 8)])
    assert {r.doc_id for r in corpus_pipeline.drop_toxic(spark, docs, sf_dir).collect()} == {1, 2}
