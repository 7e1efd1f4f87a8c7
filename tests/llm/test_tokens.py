"""Packing, counts and the token file against the libraries themselves."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sluicework.llm import packing, token_counts, token_file
from sluicework.llm.encode import encoder

WORD, BYTE, PIECE = (P.path(x) for x in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))


def ids(path: str, text: str | None) -> list[int]:
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [WORD, BYTE])
@settings(max_examples=400, deadline=None)
@given(text=st.lists(st.sampled_from(["a", "B", "É", "ç", "ß", " ", "  ", "\n", "\t", "'s", "'", "1", "23", ".", ",", "!?", "<|endoftext|>", "<|", "…", "\xa0", "́", "J̌", "ﬁ", "İ", "Σ", "中", "😀", "the", " The", "\x1c", "\x85", "×"]), max_size=9).map("".join))
def test_cached_encoding_is_the_librarys(path, text):
    one = encoder(path)
    assert np.frombuffer(one.encode(text), "<u4").tolist() == one.tokenizer.encode(text, add_special_tokens=False).ids


def test_counts_with_a_cache(spark, make_docs, texts, tmp_path):
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "one"), (5, "the quick")]
    cache = str(tmp_path / "cache")
    for path, count in ((WORD, lambda t: len(ids(WORD, t))), (PIECE, lambda t: len(__import__("sentencepiece").SentencePieceProcessor(model_file=PIECE).encode(t or "")))):
        got = token_counts.count_tokens(make_docs(spark, rows), path, cache, limit=50).collect()
        assert Counter((r.doc_id, r.n_tokens, r.n_bytes, r.over_limit) for r in got) == Counter((i, count(t), len((t or "").encode()), count(t) > 50) for i, t in rows)
    before = spark.read.parquet(cache).count()
    token_counts.count_tokens(make_docs(spark, rows), WORD, cache).collect()
    assert spark.read.parquet(cache).count() == before
    contents = make_docs(spark, rows).select(F.coalesce("text", F.lit("")).alias("text"))
    assert before == sum(contents.select(token_counts.normalised(F.col("text"), path)).distinct().count() for path in (WORD, PIECE))
    assert not token_counts.count_tokens(make_docs(spark, []), WORD, str(tmp_path / "none")).collect()


@settings(max_examples=300, deadline=None)
@given(text=st.lists(st.sampled_from(["a", "B", "The", "É", "ß", " ", "  ", "\n", "\t", "\x0b", "\x1c", "'s", "'S", "1", "23", "!?", "<|endoftext|>", "<|ENDOFTEXT|>", "\xa0", "J̌", "İ"]), max_size=9).map("".join))
def test_normalised_texts_have_the_same_count(text):
    """By the same steps in Python."""
    if text.isascii() and "<|" not in text:
        assert len(ids(WORD, __import__("re").sub(r"[ \t\n\x0b\f\r]+", " ", text.lower()))) == len(ids(WORD, text))


def test_content_is_normalised(spark):
    rows = ["A b", "a  B", "a\tb\n", "É b", "é b", "<|endoftext|> A", "<|endoftext|> a"]
    df = spark.createDataFrame([(x,) for x in rows], "text string")
    got = [r[0] for r in df.select(token_counts.normalised(F.col("text"), WORD)).collect()]
    assert got == ["a b", "a b", "a b ", "É b", "é b", "<|endoftext|> A", "<|endoftext|> a"]
    assert [r[0] for r in df.select(token_counts.normalised(F.col("text"), BYTE)).collect()] == rows


def check_packed(rows, docs, cap):
    by_doc, by_bin = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id, r.piece].append(r)
        by_bin[r.sequence_id].append((r.offset, r.length))
    for spans in by_bin.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= cap
    want = Counter()
    for i, t in docs:
        own = np.array([*ids(WORD, t), 0], "<u4")
        for k in range(0, own.size, cap):
            want[i, k // cap, k, own[k : k + cap].size, zlib.crc32(own[k : k + cap].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    return len(by_bin)


def test_packing(spark, make_docs, texts):
    docs = [(i % 40 or None, t) for i, t in enumerate(texts * 6)]
    rows = packing.pack(make_docs(spark, docs), WORD, cap=64).collect()
    bins = check_packed(rows, docs, 64)
    assert bins <= 1.02 * -(-sum(r.length for r in rows) // 64) + 1
    assert not packing.pack(make_docs(spark, []), WORD).collect()


def best_number(sizes: list[int], cap: int) -> int:
    """The least number of bins, by trying all."""
    best = len(sizes)

    def go(i: int, open_: list[int]) -> None:
        nonlocal best
        if len(open_) >= best:
            return
        if i == len(sizes):
            best = len(open_)
            return
        for j in {r: j for j, r in enumerate(open_) if r >= sizes[i]}.values():
            go(i + 1, [*open_[:j], open_[j] - sizes[i], *open_[j + 1 :]])
        go(i + 1, [*open_, cap - sizes[i]])

    sizes = sorted(sizes, reverse=True)
    go(0, [])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_reduction_keeps_the_least_number(sizes):
    counts = dict(Counter(sizes))
    fixed = packing.reduce_dominated(counts, 20)
    rest = [s for s, n in counts.items() for _ in range(n)]
    assert all(sum(f) <= 20 for f, _ in fixed)
    assert Counter(s for f, n in fixed for s in f * n) + Counter(rest) == Counter(sizes)
    assert sum(n for _, n in fixed) + best_number(rest, 20) == best_number(sizes, 20)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 2000), max_size=30))
def test_plan_uses_every_length(counts):
    placed = packing.plan(counts, 50)
    assert all(sum(s * k for s, k in p) <= 50 for p, _ in placed)
    used = Counter()
    for p, n in placed:
        for s, k in p:
            used[s] += k * n
    assert used == Counter(counts)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=1500))
def test_codes_survive(values):
    data = token_file.dac_encode(np.array(values, np.uint32))
    read = token_file.Dac(data)
    assert len(read) == len(values) and read.all().tolist() == values
    for i in random.Random(1).sample(range(len(values)), min(40, len(values))):
        assert read.get(i) == values[i]


def test_token_file(spark, make_docs, texts, tmp_path, monkeypatch):
    docs = [(97 * i % 31, t) for i, t in enumerate(texts)] + [(100, "tail")]
    path = str(tmp_path / "ids")
    token_file.write_tokens(make_docs(spark, docs), BYTE, path, end_id=2)
    at, want, all_ids = 0, {}, []
    for i, t in sorted(docs, key=lambda x: x[0]):
        own = [*ids(BYTE, t), 2]
        want[i] = (at, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
        at += len(own)
        all_ids += own
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_file.read_documents(spark, path).collect()} == want
    for place in (0, 17, at - 1):
        assert token_file.token_at(spark, path, place) == all_ids[place]
    assert token_file.token_at(spark, path, at) is None
    token_file.write_tokens(make_docs(spark, []), BYTE, str(tmp_path / "none"), end_id=2)
    assert not token_file.read_documents(spark, str(tmp_path / "none")).collect()
