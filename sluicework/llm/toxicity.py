"""Toxic passages: maximum-scoring segments over token log-odds, calibrated by extreme values."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Labelled rows that a model is fitted on at most: those with the smallest hash of their doc_id.
MAX_LABELLED = 40_000
#: Least z of a feature's log-odds, to choose from: many features are tried, and how many are chance depends on the corpus.
MIN_Z = (3.0, 4.0, 5.0, 6.0, 8.0, 10.0)
#: One in so many labelled documents is kept from the counts, to choose and calibrate on.
KEPT_BACK = 3
#: A feature stands in so many of the counted documents at least: with fewer, no prior keeps chance from looking like toxicity.
LEAST_DOCUMENTS = 3
#: A feature's log-odds count up to this, and a text's evidence: beyond it nothing changes in a probability.
MOST_ODDS, MOST_EVIDENCE = 8.0, 200.0
#: Total count of the Dirichlet prior as a share of the documents counted; features get it by their share of both classes.
PRIOR = 0.05
#: Lengths of the word beginnings that are features beside whole words.
STEMS = (4, 5, 6)
#: What every token costs, so that a passage must be dense to be found.
DRIFT = 0.25
#: Chance in a clean text up to which a passage is significant.
SIGNIFICANT = 0.05
#: Words whose scores a worker keeps.
CACHE_WORDS = 200_000

_EDGE = re.compile(r"^[\W_]+|[\W_]+$")


def features(word: str) -> list[str]:
    """Of a lower-case chunk without white space: its word and the word's beginnings."""
    w = _EDGE.sub("", word)
    return [w, *(w[:k] + "*" for k in STEMS if len(w) > k)] if w else []


@dataclass
class Model:
    """Log-odds by feature, the extreme-value law of clean documents, and the logistic calibration."""

    odds: dict[str, float]
    rate: float = 1.0  # lambda
    scale: float = 0.1  # K
    bias: float = -2.0
    slope: float = 1.0
    room: int = CACHE_WORDS
    _held: dict[str, float] = field(default_factory=dict, repr=False)

    def token(self, word: str) -> float:
        found = self._held.get(word)
        if found is None:
            if len(self._held) >= self.room:
                self._held.clear()
            known = [self.odds[f] for f in features(word) if f in self.odds]
            found = self._held[word] = max(known, default=0.0) - DRIFT
        return found

    def passages(self, text: str) -> tuple[int, list[tuple[int, int, float]]]:
        """The number of words, and every maximal segment (first word, end, score)."""
        words = text.lower().split()
        get, miss = self._held.get, self.token
        scores = np.array([miss(w) if (s := get(w)) is None else s for w in words], np.float64)
        return len(words), segments(scores)

    def chance(self, n: int, score: float) -> float:
        """That a clean text of n words has a segment of this score or more."""
        return -math.expm1(-self.scale * n * math.exp(-min(700.0, self.rate * score)))

    def evidence(self, n: int, found: list[tuple[int, int, float]]) -> float:
        """-log of the chance that a clean text of n words has a segment as good as the best, plus those of the others beyond 1 in 20."""
        total = 0.0
        for k, s in enumerate(sorted((s for _, _, s in found), reverse=True)):
            x = -math.log(max(1e-300, self.chance(n, s)))
            total += x if not k else max(0.0, x - 3.0)
        return min(total, MOST_EVIDENCE)

    def probability(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.bias + self.slope * math.log1p(evidence)))))


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments, in linear time after Ruzzo and Tompa: (first, end, score)."""
    up = np.flatnonzero(scores > 0)
    if not up.size:
        return []
    total = np.concatenate([[0.0], np.cumsum(scores)])
    held: list[tuple[int, int, float, float]] = []  # first, end, total before, total after
    links: list[int] = []  # of each: the last earlier one whose total before is less
    for i in up.tolist():
        first, end, low, high = i, i + 1, total[i], total[i + 1]
        j = len(held) - 1
        while True:
            while j >= 0 and held[j][2] >= low:
                j = links[j]
            if j < 0 or held[j][3] >= high:
                held.append((first, end, low, high))
                links.append(j)
                break
            first, low = held[j][0], held[j][2]
            at = links[j]
            del held[j:], links[j:]
            j = at
    return [(a, b, float(y - x)) for a, b, x, y in held]


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of either class by feature, summed over what a worker has read."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())

    def out() -> pa.RecordBatch:
        names = list(counts[0].keys() | counts[1].keys())
        sums = [pa.array([c[f] for f in names], pa.int64()) for c in counts]
        for c in counts:
            c.clear()
        return pa.record_batch([pa.array(names, pa.string()), *sums], ["feature", "clean", "toxic"])

    common.alone("toxicity", lambda: None)
    for b in common.slices(batches):
        for text, toxic in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(), strict=True):
            own = {f for w in set((text or "").lower().split()) for f in features(w)}
            counts[toxic].update(own)
        if len(counts[0]) + len(counts[1]) > 500_000:
            yield out()
    yield out()


def _tallied(models: list[Model]):
    """For calibration: of each labelled document the words and the passages' scores under each model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.list_(pa.float64()))
        common.alone("toxicity", lambda: None)
        for b in common.slices(batches):
            rows = [[m.passages(t or "") for m in models] for t in b.column("text").to_pylist()]
            yield pa.record_batch(
                [b.column("toxic"), pa.array([r[0][0] for r in rows], pa.int64()), pa.array([[[s for *_, s in found] for _, found in r] for r in rows], kind)],
                ["toxic", "n", "scores"],
            )

    return run


def candidates(found: list[tuple[str, float, float]]) -> list[Model]:
    """Models of the features (name, log-odds, z) beyond each least z; a feature counts by its odds less two standard errors."""
    return [Model({f: min(MOST_ODDS, odds * (1 - 2 / z)) for f, odds, z in found if z >= least}, room=CACHE_WORDS // len(MIN_Z)) for least in MIN_Z]


def choose(models: list[Model], rows: list[tuple[int, int, list[list[float]]]]) -> Model:
    """The calibrated model with the least logarithmic loss on rows (toxic, words, scores by model) that none has seen."""
    best, least = models[0], math.inf
    for k, m in enumerate(models):
        own = [(toxic, n, scores[k]) for toxic, n, scores in rows]
        _calibrate(m, own)
        loss = -sum(math.log(max(1e-6, p if toxic else 1 - p)) for toxic, n, s in own for p in [m.probability(m.evidence(n, [(0, 0, x) for x in s]))])
        if loss < least:
            best, least = m, loss
    best.room = CACHE_WORDS
    return best


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from labelled documents; labels has doc_id and toxic, and a null label counts as none.

    Of several labels of one doc_id the largest holds. At most MAX_LABELLED
    labelled ids are used, and only they are broadcast. One in KEPT_BACK of them
    is not counted: the least z is chosen and the scores are calibrated on it.
    Every word of LEAST_DOCUMENTS counted texts or more whose z is beyond the
    least is a feature, and so is every such beginning of words.
    """
    common.ship(docs.sparkSession)
    chosen = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)
    chosen = common.cut(chosen.withColumn("back", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(KEPT_BACK)) == 0))
    known = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic", "back")
    learnt = known.filter("not back")
    sizes = {r["toxic"]: r["count"] for r in learnt.groupBy("toxic").count().collect()}
    n0, n1 = (max(1, sizes.get(x, 0)) for x in (0, 1))
    counts = learnt.mapInArrow(_feature_counts, "feature string, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("y0"), F.sum("toxic").alias("y1"))
    total = PRIOR * (n0 + n1)
    prior = F.lit(total) * (F.col("y0") + F.col("y1") + 1) / (n0 + n1 + 2)  # never all of it, so that no odds are infinite

    def logit(y, n: int):
        return F.log((y + prior) / (n + total - y - prior))

    odds = logit(F.col("y1"), n1) - logit(F.col("y0"), n0)
    z = odds / F.sqrt(1 / (F.col("y1") + prior) + 1 / (F.col("y0") + prior))
    scored = counts.filter(F.col("y0") + F.col("y1") >= LEAST_DOCUMENTS).select("feature", odds.alias("odds"), z.alias("z")).filter(F.col("z") >= MIN_Z[0])
    models = candidates([tuple(r) for r in scored.orderBy(F.col("z").desc(), "feature").collect()])  # words of at most MAX_LABELLED texts
    rows = known.filter("back").mapInArrow(_tallied(models), "toxic int, n long, scores array<array<double>>").collect()  # a part of MAX_LABELLED
    return choose(models, [tuple(r) for r in rows])


def _calibrate(model: Model, rows: list[tuple[int, int, list[float]]]) -> None:
    """lambda and K from clean documents, after Karlin and Altschul, then a logistic law of the evidence."""
    clean = [(n, s) for toxic, n, s in rows if not toxic]
    words = sum(n for n, _ in clean) + 1.0
    gains = [x for _, s in clean for x in s] + [1.0]
    lo, hi = 1e-3, 20.0
    for _ in range(60):  # sum of p(s) exp(lambda s) = 1
        mid = (lo + hi) / 2
        p = sum(math.exp(min(50.0, mid * s)) for s in gains) / words + (1 - len(gains) / words) * math.exp(-mid * DRIFT)
        lo, hi = (mid, hi) if p < 1 else (lo, mid)
    model.rate = max(0.05, min(lo, 3.0))
    best = [(n, max(s, default=0.0)) for n, s in clean if n]
    model.scale = max(1e-6, min(1.0, (len(best) + 1) / (1 + sum(n * math.exp(-model.rate * m) for n, m in best))))
    x = np.array([math.log1p(model.evidence(n, [(0, 0, v) for v in s])) for _, n, s in rows] or [0.0])
    y = np.array([toxic for toxic, _, _ in rows] or [0], float)
    design = np.stack([np.ones_like(x), x], 1)
    w = np.zeros(2)
    for _ in range(50):  # Newton's method with a small ridge
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (y - p) - np.array([0.0, 0.1]) * w
        hess = (design * (p * (1 - p))[:, None]).T @ design + np.diag([1e-3, 0.1])
        step = np.linalg.solve(hess, grad)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    model.bias, model.slope = float(w[0]), float(max(0.0, w[1]))


def _scored(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("chance", pa.float64()), ("significant", pa.bool_())]))
        common.alone("toxicity", lambda: None)
        for b in common.slices(batches):
            scores, spans = [], []
            for text in b.column("text").to_pylist():
                n, found = model.passages(text or "")
                scores.append(model.probability(model.evidence(n, found)))
                told = ((*x, p := model.chance(n, x[2]), p <= SIGNIFICANT) for x in found)
                spans.append([dict(zip(("first", "end", "score", "chance", "significant"), x, strict=True)) for x in told])
            yield pa.record_batch([b.column("_row"), pa.array(scores, pa.float64()), pa.array(spans, kind)], ["_row", "score", "passages"])

    return run


def score(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """The columns keep of every row of docs with score (0 to 1) and passages (first word, end, score, chance, significant).

    Passages are all maximal segments; chance is that of a clean text of the
    same length to have one as good, by the extreme-value law, and a significant
    passage has SIGNIFICANT at most. Only the text is an input of a score. A null or empty text has no passages
    and the score of no evidence; repeated rows and ties get equal scores; an
    empty table gives no rows; columns called score or passages are replaced.
    """
    common.ship(docs.sparkSession)
    keep = tuple(c for c in keep if c not in ("score", "passages"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("_row"), "text")
    out = rows.select("_row").schema.add("score", "double").add("passages", T.ArrayType(T.StructType().add("first", "long").add("end", "long").add("score", "double").add("chance", "double").add("significant", "boolean")))
    return rows.mapInArrow(_scored(model), out).select(*(F.col(f"_row.`{c}`").alias(c) for c in keep), "score", "passages")


def held_out(doc_id):
    """The fourth of the documents whose labels are never learnt."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def without_toxic(docs: DataFrame, model: Model, *, threshold: float) -> DataFrame:
    """docs' rows, whole, whose score is below threshold."""
    common.ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.alone("toxicity", lambda: None)
        for b in common.slices(batches):
            found = (model.passages(t or "") for t in b.column("text").to_pylist())
            yield b.filter(pa.array([model.probability(model.evidence(*x)) < threshold for x in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
