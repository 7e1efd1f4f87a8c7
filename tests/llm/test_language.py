"""Language identification against sums over all segmentations, and on held-out documents."""

import itertools

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sluicework.llm import common, language
from sluicework.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    m = language.uniform(PATH, ["a", "b"])
    m.table = np.random.default_rng(1).random(m.table.shape) / 500
    return m


def segmentations(word):
    """Every way to cut a word, with its start sign, into pieces, as piece numbers."""
    ids = {n: i for i, n in enumerate(language.pieces(PATH), 1)}
    s = language.START + word
    for cuts in itertools.product((0, 1), repeat=len(s) - 1):
        ends = [i + 1 for i, c in enumerate(cuts) if c] + [len(s)]
        parts = [s[a:b] for a, b in zip([0, *ends], ends)]
        if all(p in ids or len(p) == 1 for p in parts):
            yield [ids.get(p, 0) for p in parts]


WORDS = ["the", "straße", "einschlu", "zzq", "internation", "a", "ß中文", "überraschung", "trementdansch"]


def test_forward_sums_all_segmentations(model):
    got = model.log_words(pa.array(WORDS, pa.large_string()))
    for word, row in zip(WORDS, got, strict=True):
        want = np.log(sum(model.table[x].prod(0) for x in segmentations(word)))
        assert np.allclose(row, want, rtol=1e-12)


def test_expected_counts(model):
    times = np.arange(1.0, len(WORDS) + 1)
    for k in (0, 1):
        want = np.zeros(len(model.table))
        for word, n in zip(WORDS, times, strict=True):
            ways = [(x, model.table[x, k].prod()) for x in segmentations(word)]
            for x, p in ways:
                np.add.at(want, x, n * p / sum(p for _, p in ways))
        assert np.allclose(model.expected(pa.array(WORDS, pa.large_string()), times, k), want)


def test_words_of_any_length(model):
    long = "trementdansch" * 4000
    (got,) = model.log_words(pa.array([long], pa.large_string()))
    assert np.isfinite(got).all()
    assert np.isclose(model.expected(pa.array([long], pa.large_string()), np.ones(1), 0) @ np.array([0, *map(len, language.pieces(PATH))]) , len(long) + 1)


def test_words_are_runs_of_letters():
    of, names, codes = language.words(pa.array([" Éa-b1C\n", None, "", "12 !", "x"]))
    assert of.tolist() == [0, 0, 0, 4] and [names[i].as_py() for i in codes.tolist()] == ["éa", "b", "c", "x"]


def test_predictions(spark, make_docs, texts):
    pairs = {"en": "the house of that old man was near an empty road and this is what they said", "de": "das Haus von dem alten Mann stand nicht weit von einer Straße und das ist was sie sagten"}
    rows = [(i, f"{pairs[k]} {i}", k) for i in range(60) for k in pairs] + [(500, "und das ist nicht", None), (None, "the man", None), (501, "the old road and this", ""), (502, None, "en")]
    docs = make_docs(spark, [(i, t) for i, t, _ in rows]).withColumns({"lang_pred": F.lit("x")})
    tagged = spark.createDataFrame([(i, t, k) for i, t, k in rows if k != ""], "doc_id long, text string, lang string")
    model = language.fit(tagged, PATH)
    assert model.languages == ["de", "en"] and np.allclose(model.table.sum(0), 1)
    got = language.predict(docs, model, "doc_id", "lang_pred", "score", "lang").collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    found = [(r.doc_id, r.lang_pred) for r in got]
    assert (500, "de") in found and (None, "en") in found and (501, "en") in found and (502, "und") in found
    odd = language.predict(make_docs(spark, list(enumerate(texts))), model, "doc_id").collect()
    assert len(odd) == len(texts) and {r.lang_pred for r in odd if not any(c.isalpha() for c in texts[r.doc_id] or "")} == {"und"}
    empty = language.fit(tagged.filter("lang = 'zz'"), PATH)
    assert {(r.lang_pred, r.score) for r in language.predict(docs, empty, "doc_id").collect()} == {("und", 0.0)}
    assert not language.predict(make_docs(spark, []), model, "doc_id").collect()


def test_held_out_documents(spark, sf_dir):
    truth = {r.doc_id: r.lang for r in common.table(spark, sf_dir, "documents").collect()}
    rows = QUERIES["op13_language"](spark, sf_dir).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out and truth[r.doc_id] and r.lang_pred != "und"]
    assert len(held) > 20 and sum(truth[r.doc_id] == r.lang_pred for r in held) >= 0.97 * len(held)
