"""Codes against plain Lloyd rounds in Python's integers."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluicework.llm import vector_codes as vc
from sluicework.llm.queries import QUERIES


def brute(rows):
    """(key, vector, label) rows to the contract's rows, by definition."""
    kept = [(k, [x.numerator * 1024 // x.denominator if isinstance(x, int) else (lambda n, d: n * 1024 // d)(*float(x).as_integer_ratio()) for x in v], label) for k, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // 4
    cut = [[v[m * width : (m + 1) * width] for m in range(4)] for _, v, _ in kept]
    books = [[list(x[m]) for x in cut[:256]] for m in range(4)]

    def near(m, p):
        return min((sum((a - b) ** 2 for a, b in zip(p, e)), j) for j, e in enumerate(books[m]))

    for _ in range(4):
        for m in range(4):
            of = [near(m, x[m])[1] for x in cut]
            for j in range(len(books[m])):
                own = [x[m] for x, i in zip(cut, of) if i == j]
                if own:
                    books[m][j] = [sum(c) // len(own) for c in zip(*own)]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    out = [(k, [near(m, x[m]) for m in range(4)], label) for (k, _, label), x in zip(kept, cut)]
    errors = {}
    for _, n, label in out:
        errors[label] = errors.get(label, 0) + sum(d for d, _ in n)
    return sorted(((k, "".join(f"{j:02x}" for _, j in n), sum(d for d, _ in n), errors[label], digest) for k, n, label in out), key=str)


def encoded(spark, rows, kind="float"):
    table = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").withColumns({"code": F.lit("x"), "key": F.lit(1), "_label": F.lit(2), "error": F.lit(3)})
    return sorted((tuple(r) for r in vc.encode(table, "embedding", "vec_id", "label").collect()), key=str)


def some(n, d, seed, grid=64):
    rng = random.Random(seed)
    return [(i, [rng.randint(-grid, grid) / 128 for _ in range(d)], rng.choice([None, 1, 1, 2])) for i in range(n)]


def test_codes_are_those_of_plain_rounds(spark):
    rows = some(700, 8, 1, grid=9)  # a coarse grid has many ties
    rows += [(i + 2000, rows[3][1], 1) for i in range(200)] + [(9000, None, 1), (9001, [None] * 8, 1), (9002, [float("nan")] * 8, 2), (9003, [float("inf")] + [0.0] * 7, 2)]
    assert encoded(spark, rows) == brute(rows)


def test_bounds_save_distances():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 32))
    x = np.floor((centres[rng.integers(0, 40, 3000)] + 0.05 * rng.normal(size=(3000, 32))) * 1024).astype(np.int64)
    book, cut = vc.Codebooks.first(x[:256]), vc.parts(x)
    asked, state = 0, [vc.assign(cut[m], book, m, None)[:3] for m in range(4)]
    for _ in range(4):
        sums = {(m, j): (int((state[m][0] == j).sum()), cut[m][state[m][0] == j].sum(0).tolist()) for m in range(4) for j in range(256) if (state[m][0] == j).any()}
        book = book.moved(sums)
        for m in range(4):
            *state[m], n = vc.assign(cut[m], book, m, state[m])
            asked += n
            full = vc.squared(cut[m], book.entries[m])
            assert (state[m][0] == full.argmin(1)).all()
            near = np.sqrt(full)
            assert (state[m][1] >= near.min(1)).all()
            near[np.arange(len(near)), state[m][0]] = np.inf
            for g in range(vc.GROUPS):
                own = book.groups[m] == g
                assert not own.any() or (state[m][2][:, g] <= near[:, own].min(1)).all()
    assert asked < 0.25 * 4 * 4 * 3000 * 256


def test_wide_components_are_exact(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([1e300, -1e300, 3.5, 1e15, 0.1]) * rng.randint(1, 3) for _ in range(4)], i % 3) for i in range(60)]
    want = brute(rows)
    got = encoded(spark, rows, "double")
    assert [(r[0], r[1], r[4]) for r in got] == [(r[0], r[1], r[4]) for r in want]
    assert [r[2] for r in got] == [r[2] if r[2] < 1 << 63 else None for r in want]


def test_odd_tables(spark):
    assert encoded(spark, []) == [] == encoded(spark, [(1, None, 1)])
    few = some(3, 4, 6) + [(None, [0.25] * 4, None), (7, [0.5] * 5, 1), (1, [0.125] * 4, 3), (1, [0.125] * 4, 3)]
    assert encoded(spark, few) == brute([r for r in few if len(r[1]) == 4])
    assert [r[1] for r in encoded(spark, [(1, [0.5, -0.5, 0.25, 1.0, 2.0], 1), (2, [0.5, -0.5, 0.25, 1.0, 2.5], 1)])] == ["00000000", "00000001"[:4] + "01" + "00"]


def test_query_is_the_plain_form(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").limit(400)
    got = sorted((tuple(r) for r in vc.encode(table, "embedding", "vec_id", "label").collect()), key=str)
    assert got == brute([(r.vec_id, r.embedding, r.label) for r in table.collect()])
    assert QUERIES["op11_vector_codes"](spark, sf_dir).count() == spark.read.parquet(f"{sf_dir}/embeddings.parquet").count()
