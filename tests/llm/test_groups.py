"""Decontamination, sharding and the Jaccard join against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluicework.llm import common, components, decontaminate, jaccard, sharding
from sluicework.llm.queries import QUERIES

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(t):
    return WORD.findall(t.translate(LOWER)) if t else []


def hits(text, items, n=10):
    w, spans, found = words(text), set(), set()
    for i, t in items:
        v = words(t)
        k = min(n, len(v))
        for a in range(len(v) - k + 1) if v else ():
            for b in range(len(w) - k + 1):
                if w[b : b + k] == v[a : a + k]:
                    spans.add((b + 1, k))
                    if i is not None:
                        found.add(str(i))
    hit = {p for b, k in spans for p in range(b, b + k)}
    return len(w), len(hit), sorted(found), sorted(spans)


@pytest.fixture
def items():
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    own = [(i, " ".join(rng.choice(base) for _ in range(rng.choice((3, 9, 10, 14, 25))))) for i in range(12)]
    return [*own, (12, None), (13, "  "), (14, own[3][1].upper()), (3, own[3][1])]


def test_decontamination(spark, make_docs, items, texts):
    rng = random.Random(9)
    docs = [(i, t) for i, t in enumerate(texts)]
    for i in range(40):
        w = [f"w{rng.randrange(60)}" for _ in range(rng.randrange(60))]
        w[len(w) // 2 : len(w) // 2] = words(rng.choice(items)[1])[: rng.randrange(30)]
        docs.append((100 + i, ", ".join(w).title()))
    docs += [docs[-1], (None, docs[-1][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    table = make_docs(spark, docs)
    for limit in (common.BROADCAST_ROWS, 0):
        common.BROADCAST_ROWS, kept = limit, common.BROADCAST_ROWS
        got = decontaminate.mark(table, bench).withColumn("n_hit", decontaminate.hit_words(F.col("spans"))).collect()
        clean = decontaminate.clean(table, bench).collect()
        common.BROADCAST_ROWS = kept
        assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), tuple(map(tuple, r.spans))) for r in got) == Counter((i, *(tuple(x) if isinstance(x, list) else x for x in hits(t, items))) for i, t in docs)
        assert Counter((r.doc_id, r.text) for r in clean) == Counter((i, t) for i, t in docs if not hits(t, items)[1])
    cut = {r.doc_id: r.text for r in decontaminate.clean(table, bench, remove="spans").collect()}
    for i, t in docs:
        n, hit, _, spans = hits(t, items)
        gone = {p for b, k in spans for p in range(b, b + k)}
        assert words(cut[i]) == [w for p, w in enumerate(words(t), 1) if p not in gone]
        assert hit or cut[i] == t
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.clean(table, none).count() == len(docs) and not decontaminate.mark(make_docs(spark, []), bench).collect()


def test_a_long_document_is_shuffled_thin(spark, make_docs, monkeypatch):
    """Beyond the broadcast a document's windows are a few bytes a word, however long it is."""
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    rng = random.Random(6)
    item = " ".join(f"i{k}" for k in range(12))
    long = " ".join([f"x{rng.randrange(10**6)}" for _ in range(20_000)] + [item] + ["y"] * 5)
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    (row,) = decontaminate.mark(make_docs(spark, [(7, long)]), bench).collect()
    assert (row.n_words, [tuple(s) for s in row.spans], row["items"]) == (20_017, [(20_001 + k, 10) for k in range(3)], ["1"])
    plan = decontaminate.mark(make_docs(spark, [(7, long)]), bench)._jdf.queryExecution().optimizedPlan().toString()
    shuffled = plan.split("Join Inner")[1].split("\n")[1]
    assert re.search(r"Project \[text_md5#\d+, at#\d+, size#\d+, xxhash64\(.* AS hash#\d+L?\]", shuffled) and not re.search("Python|Pandas|Arrow", plan)


def test_decontamination_is_native(spark, sf_dir):
    plan = QUERIES["op1_decontamination"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and "BroadcastHashJoin" in plan


@pytest.mark.parametrize(("n", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_neighbours(n, bits):
    points = np.array(list(itertools.product(range(1 << bits), repeat=n)))
    place = sharding.hilbert_index(points, bits)
    assert sorted(place.tolist()) == list(range(len(points)))
    assert np.abs(np.diff(points[np.argsort(place)], axis=0)).sum(1).max() == 1


def test_sharding(spark, make_docs, texts, tmp_path):
    docs = [(i if i % 9 else None, t) for i, t in enumerate(texts * 5)] + [(1, "")] * 3
    table = make_docs(spark, docs)
    rows = sharding.assign(table, ["source", "lang", "n_chars"], shards=7).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in docs)
    by = Counter(r.shard for r in rows)
    assert set(by) == set(range(7)) and max(by.values()) - min(by.values()) <= 1
    assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(n)) for s, n in by.items())
    order = sorted(rows, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in order] == sorted(r.curve for r in rows)
    few = sharding.assign(make_docs(spark, docs[:3]), ["lang"], shards=7).collect()
    assert sorted(r.shard for r in few) == [0, 1, 2]
    assert not sharding.assign(make_docs(spark, []), ["lang"]).collect()
    sharding.write_shards(table, ["source"], str(tmp_path / "s"), shards=7, rows_per_file=5)
    written = spark.read.parquet(str(tmp_path / "s"))
    assert Counter((r.doc_id, r.text, r.source) for r in written.collect()) == Counter((r.doc_id, r.text, r.source) for r in table.collect())
    slots = {s: sorted(r.slot for r in written.filter(F.col("shard") == s).collect()) for s in range(7)}
    assert all(x == list(range(len(x))) for x in slots.values()) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_rows_that_differ_elsewhere_are_written_once(spark, make_docs, tmp_path):
    one = make_docs(spark, [(1, "same")])
    table = one.union(one.withColumn("source", F.lit("other"))).union(one)
    sharding.write_shards(table, ["n_chars"], str(tmp_path / "s"), shards=2)
    assert sorted(r.source for r in spark.read.parquet(str(tmp_path / "s")).collect()) == ["other", "src1", "src1"]


def shingle_set(t):
    w = re.findall(r"[^\x20\x09-\x0d]+", (t or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))) if w else frozenset()


def brute(docs, percent):
    sets = [(i, shingle_set(t)) for i, t in docs]
    root = {i: i for i, _ in docs if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (i, a), (j, b) in itertools.combinations([x for x in sets if x[0] is not None and x[1]], 2):
        if 100 * len(a & b) >= percent * len(a | b):
            x, y = find(i), find(j)
            root[max(x, y)] = min(x, y)
    return Counter((i, len(s), None if i is None else find(i)) for i, s in sets)


def near_copies(seed, groups, copies, size):
    rng = random.Random(seed)
    out = []
    for g in range(groups):
        base = [f"w{rng.randrange(400)}" for _ in range(size)]
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randrange(5)):
                w[rng.randrange(size)] = f"z{rng.randrange(10**6)}"
            out.append(" ".join(w))
    rng.shuffle(out)
    return list(enumerate(out, 1000))


@pytest.mark.parametrize(("block", "paired", "local", "broadcast"), [(100, 32, 10**6, 10**6), (7, 4, 10**6, 10**6), (5, 2, 30, 0)])
def test_jaccard_join(spark, make_docs, texts, monkeypatch, block, paired, local, broadcast):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "PAIRED", paired)
    monkeypatch.setattr(components, "LOCAL_EDGES", local)
    monkeypatch.setattr(common, "BROADCAST_ROWS", broadcast)
    docs = [(i, t) for i, t in enumerate(texts)] + near_copies(1, 3, 30, 60) + [(50, "One"), (51, "two words"), (None, "one"), (5, texts[5])]
    got = jaccard.jaccard_components(make_docs(spark, docs), k=3, percent=90).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(docs, 90)


def test_templates_of_unlinked_texts(spark, make_docs, monkeypatch):
    """Texts of all sizes that share most of their words form one large group, in which few are linked."""
    monkeypatch.setattr(jaccard, "BLOCK", 6)
    monkeypatch.setattr(jaccard, "PAIRED", 3)
    rng = random.Random(8)
    common_words = [f"c{i}" for i in range(60)]
    docs = []
    for i in range(70):
        own = [f"u{rng.randrange(10**6)}" for _ in range(rng.choice((3, 8, 12, 25, 60)))]
        docs.append((i, " ".join(common_words + own)))
        if i % 9 == 0:
            docs.append((1000 + i, " ".join([*common_words, *own, "z"])))
    got = jaccard.jaccard_components(make_docs(spark, docs), k=3, percent=90).collect()
    want = brute(docs, 90)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want


def test_jaccard_keeps_one_of_each(spark, make_docs, texts):
    docs = [(i, t) for i, t in enumerate(texts)] + near_copies(3, 2, 6, 50) + [(5, texts[5]), (None, "one"), (None, None)]
    kept = jaccard.without_near_copies(make_docs(spark, docs), k=3, percent=90).collect()
    want = {i for i, _, c in brute(docs, 90) if i is not None and i == c}
    assert Counter(r.doc_id for r in kept if r.doc_id is not None) == Counter(want) and sum(r.doc_id is None for r in kept) == 2
    assert list(kept[0].asDict()) == make_docs(spark, []).columns
    assert not jaccard.jaccard_components(make_docs(spark, [])).collect()


def test_of_one_id_the_least_text_stays(spark, make_docs):
    words = [" ".join(f"{a}{i}" for i in range(30)) for a in "zab"]
    docs = make_docs(spark, [(7, t) for t in words] + [(7, words[1]), (8, words[2])]).withColumn("extra", F.create_map(F.lit("k"), F.rand(3)))
    for n in (1, 4):
        kept = jaccard.without_near_copies(docs.repartition(n)).collect()
        assert [(r.doc_id, r.text) for r in kept] == [(7, words[1])]


def test_word_splitting_is_the_contracts():
    for t in ("A\x0bb\x0cC d e f", "É É  x", "\x1ca\x1db"):
        w = re.findall(r"[^\x20\x09-\x0d]+", t.translate(LOWER))
        assert t.encode().lower().split() == [x.encode() for x in w]


def test_items_digest(spark, sf_dir):
    (r,) = QUERIES["op1_decontamination"](spark, sf_dir).filter("n_items = 0").limit(1).collect()
    assert r.items_sha256 == hashlib.sha256(b"").hexdigest()


def _filled(rng, own, template):
    """A template with words of its own in the middle, of one kind or another."""
    return " ".join([*template[:60], *own, *template[60:]])


@pytest.mark.parametrize(("paired", "block"), [(32, 100), (3, 8)])
def test_templates_with_few_links(spark, make_docs, monkeypatch, paired, block):
    """Large candidate groups of hardly linked sets of many sizes, against all pairs."""
    from sluicework.llm import jaccard

    monkeypatch.setattr(jaccard, "PAIRED", paired)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rng = random.Random(paired)
    template = [f"t{i}" for i in range(150)]
    texts = []
    for i in range(160):
        own = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([2, 5, 9, 14, 20]))]
        texts.append(_filled(rng, own, template))
        if i % 9 == 0:  # a near copy of its own
            at = rng.randrange(len(own))
            texts.append(_filled(rng, [*own[:at], "x", *own[at + 1 :]], template))
        if i % 13 == 0:
            texts.append(_filled(rng, own, template[: 150 - rng.randrange(25)]))
    order = list(range(len(texts)))
    rng.shuffle(order)
    texts = [texts[i] for i in order]
    sets = [frozenset(zip(w, w[1:], w[2:])) for w in (t.split() for t in texts)]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(sets)), 2):
        both = len(sets[a] & sets[b])
        if 100 * both >= 90 * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(make_docs(spark, list(enumerate(texts))), k=3, percent=90).collect()}
    assert got == {i: find(i) for i in range(len(texts))} and 20 < len(set(got.values())) < len(texts)


def test_a_template_costs_what_its_texts_cost(spark, make_docs):
    """No two of these are linked; four times as many once took four times four as long."""
    import time

    from sluicework.llm import jaccard

    def seconds(n):
        rng = random.Random(n)
        template = [f"t{i}" for i in range(184)]
        docs = [(i, _filled(rng, [f"w{rng.randrange(10**9)}" for _ in range(16)], template)) for i in range(n)]
        began = time.time()
        assert jaccard.jaccard_components(make_docs(spark, docs), k=3, percent=90).select("component_id").distinct().count() == n
        return time.time() - began

    seconds(200)
    assert seconds(6000) < 4 * max(seconds(1500), 5)
