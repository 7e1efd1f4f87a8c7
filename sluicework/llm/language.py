"""Language identification by segmentation-marginalised unigrams.

A language gives every piece of a fixed public vocabulary a probability. A
word's probability is the sum over all its segmentations into pieces of their
product, which a forward algorithm computes; a text's is the product over its
words. Piece probabilities are learnt by expectation maximisation on all
labelled rows: forward and backward sums give each piece's expected count.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: What stands before a word, as in the vocabulary's own pieces.
START = "▁"
#: Pieces of more characters are left out of the vocabulary; every single character is a piece, if only the unknown one.
LONGEST = 8
#: Rounds of expectation maximisation, each one scan of the labelled rows.
ROUNDS = 2
#: What every piece has seen beforehand in every language.
PRIOR = 0.05
#: Texts, and characters of distinct words, that are worked on at once.
TEXTS, HELD_CHARS = 1024, 1 << 20
#: The prediction for texts without a letter.
UNDETERMINED = "und"

_SHIFT, _FACTOR = np.uint64(45), np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


@cache
def pieces(path: str) -> tuple[str, ...]:
    """The vocabulary's pieces of letters in lower case, with or without the sign of a word's start, sorted."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {model.id_to_piece(i).lower() for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
    return tuple(sorted(p for p in found if len(p) <= LONGEST and (p == START or p.removeprefix(START).isalpha())))


#: What the characters of one number of pieces' characters have: flat places (first character times words plus word) in order, and the pieces that begin there.
Found = tuple[np.ndarray, np.ndarray]


def _mixed(h: np.ndarray, code: np.ndarray) -> np.ndarray:
    h = (h ^ code) * _FACTOR
    return h ^ (h >> np.uint64(29))


class Vocabulary:
    """Pieces of all substrings of words, by a hash table of the pieces' beginnings that whole arrays are looked up in."""

    def __init__(self, names: tuple[str, ...]):
        starts: dict[str, int] = {}
        for i, n in enumerate(names, 1):
            for k in range(1, len(n)):
                starts.setdefault(n[:k], -1)
            starts[n] = i
        size = 1 << (64 - int(_SHIFT))
        self.hashes, self.ids, self.used = np.zeros(size, np.uint64), np.full(size, -1, np.int32), np.zeros(size, bool)
        for n, i in starts.items():
            h = np.zeros(1, np.uint64)
            for c in n:
                h = _mixed(h, np.array([ord(c)], np.uint64))
            at = int(h[0] >> _SHIFT)
            while self.used[at]:
                at = (at + 1) % size
            self.hashes[at], self.ids[at], self.used[at] = h[0], i, True

    def _slots(self, h: np.ndarray) -> np.ndarray:
        """Where each hash stands; -1 if it doesn't."""
        at = (h >> _SHIFT).astype(np.int64)
        open_ = np.flatnonzero((self.hashes[at] != h) & self.used[at])
        while open_.size:  # a slot further for those that met another one
            at[open_] = (at[open_] + 1) % len(self.ids)
            open_ = open_[(self.hashes[at[open_]] != h[open_]) & self.used[at[open_]]]
        at[~self.used[at]] = -1
        return at

    def lookup(self, codes: np.ndarray) -> list[Found]:
        """Of words of one length, as (character, word), the pieces of 1 to LONGEST characters. Where no character's piece is known its number is 0.

        A substring is looked at only where the one without its last character
        begins a piece.
        """
        t, w = codes.shape
        flat = codes.ravel()
        places, h = np.arange(t * w), np.zeros(t * w, np.uint64)
        out: list[Found] = []
        for n in range(1, min(LONGEST, t) + 1):
            if n > 1:
                inside = int(np.searchsorted(places, (t - n + 1) * w))
                places, h = places[:inside], h[:inside]
            h = _mixed(h, flat[places + (n - 1) * w])
            at = self._slots(h)
            known = at >= 0
            if n == 1:
                out.append((places, np.where(known, np.maximum(self.ids[at], 0), 0)))
                places, h = places[known], h[known]
            else:
                places, h, ids = places[known], h[known], self.ids[at[known]]
                whole = ids > 0
                out.append((places[whole], ids[whole]))
        return out


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(pieces(path))


def words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Of texts in lower case cut at all but letters: each word's text, the distinct words, and each word's place among them."""
    low = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    lists = pc.ascii_split_whitespace(pc.replace_substring_regex(low, r"\P{L}+", " "))
    flat = lists.flatten().dictionary_encode()
    sizes = np.diff(np.asarray(lists.offsets))
    of = np.repeat(np.arange(len(texts)), sizes)
    codes = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    empty = pc.index(flat.dictionary, pa.scalar("", pa.large_string())).as_py()
    if empty >= 0:  # before a leading and behind a trailing space
        keep = codes != empty
        of, codes = of[keep], codes[keep]
    return of, flat.dictionary, codes


def by_length(names: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Groups of words of one length: their places, and their characters behind a start sign as (character, word)."""
    lengths = pc.utf8_length(names).to_numpy(zero_copy_only=False).astype(np.int64)
    order = np.argsort(lengths, kind="stable")
    sizes = lengths[order]
    first = int(np.searchsorted(sizes, 1))
    codes = np.frombuffer("".join(names.take(pa.array(order)).to_pylist()).encode("utf-32-le"), np.uint32)
    at = 0
    while first < order.size:
        n = int(sizes[first])
        last = min(int(np.searchsorted(sizes, n, "right")), first + max(1, HELD_CHARS // (n + 1)))
        full = np.full((n + 1, last - first), ord(START), np.uint64)
        full[1:] = codes[at : at + n * (last - first)].reshape(last - first, n).T
        yield order[first:last], full
        at += n * (last - first)
        first = last


@dataclass
class Model:
    """Piece probabilities by language: table[i, l] for piece i (0 unknown, the last one no piece at all) in languages[l]."""

    path: str
    languages: list[str]
    table: np.ndarray

    @cached_property
    def vocabulary(self) -> Vocabulary:
        return vocabulary(self.path)

    def _summed(self, found: list[Found], t: int, w: int, table: np.ndarray, back: bool) -> tuple[np.ndarray, np.ndarray]:
        """Sums over the segmentations of every beginning (or, backwards, end) of words of one length, and the logarithms that scale them.

        Row i belongs to what lies before (behind) character i.
        """
        k = table.shape[1]
        sums, scale = np.zeros((t + 1, w, k)), np.zeros((t + 1, w, k))
        long = t > LONGEST  # short words cannot leave the range of numbers
        sums[t if back else 0] = 1.0
        cuts = [np.searchsorted(places, np.arange(t + 1) * w) for places, _ in found]
        chances = [table[ids] for _, ids in found]
        for step in range(1, t + 1):
            to = t - step if back else step
            before = to + 1 if back else to - 1
            for n in range(1, min(LONGEST, step) + 1):
                start = to if back else to - n
                come = to + n if back else start
                lo, hi = cuts[n - 1][start], cuts[n - 1][start + 1]
                if lo == hi:
                    continue
                rows = found[n - 1][0][lo:hi] - start * w
                more = sums[come, rows] * chances[n - 1][lo:hi]
                if long:
                    more *= np.exp(scale[come, rows] - scale[before, rows])
                sums[to, rows] += more
            if long:
                scale[to] = scale[before] + np.log(sums[to])
                sums[to] = 1.0
        return sums, scale

    def log_words(self, names: pa.Array) -> np.ndarray:
        """Logarithms of the words' probabilities in every language."""
        out = np.zeros((len(names), len(self.languages)))
        for group, codes in by_length(names):
            sums, scale = self._summed(self.vocabulary.lookup(codes), *codes.shape, self.table, False)
            out[group] = np.log(sums[-1]) + scale[-1]
        return out

    def expected(self, names: pa.Array, counts: np.ndarray, language: int) -> np.ndarray:
        """Every piece's expected count in segmentations of words that occur so often, under one language."""
        table = self.table[:, language : language + 1]
        out = np.zeros(len(self.table))
        for group, codes in by_length(names):
            t, w = codes.shape
            found = self.vocabulary.lookup(codes)
            (fore, up), (aft, down) = (self._summed(found, t, w, table, back) for back in (False, True))
            total = np.log(fore[-1, :, 0]) + up[-1, :, 0]
            weight = counts[group]
            fore, up, aft, down = (x.reshape(-1) for x in (fore, up, aft, down))
            for n, (places, ids) in enumerate(found, 1):
                word = places % w
                share = fore[places] * table[ids, 0] * aft[places + n * w] * np.exp(up[places] + down[places + n * w] - total[word])
                out += np.bincount(ids, share * weight[word], len(out))
        return out

    def log_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Logarithms of the texts' probabilities in every language, and the number of their words."""
        of, names, codes = words(texts)
        log = self.log_words(names)
        n = np.bincount(of, minlength=len(texts))
        return np.stack([np.bincount(of, log[codes, k], len(texts)) for k in range(len(self.languages))], 1) if self.languages else np.zeros((len(texts), 0)), n


def uniform(path: str, languages: list[str]) -> Model:
    size = len(pieces(path)) + 1
    return Model(path, languages, np.full((size, len(languages)), 1.0 / size))


def _counted(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.alone("language", lambda: None)
        at = {name: i for i, name in enumerate(model.languages)}
        sums = np.zeros(model.table.shape)
        for b in batches:
            for part in common.slices(iter([b]), TEXTS):
                lang = np.array([at[x] for x in part.column("lang").to_pylist()])
                of, names, codes = words(part.column("text"))
                for k in np.unique(lang[of]) if of.size else ():
                    n = np.bincount(codes[lang[of] == k], minlength=len(names))
                    seen = np.flatnonzero(n)
                    sums[:, k] += model.expected(names.take(pa.array(seen)), n[seen].astype(float), int(k))
        piece, k = np.nonzero(sums)
        yield pa.record_batch([pa.array(piece, pa.int32()), pa.array(k, pa.int32()), pa.array(sums[piece, k])], ["piece", "k", "n"])

    return run


def fit(docs: DataFrame, path: str, *, rounds: int = ROUNDS, prior: float = PRIOR) -> Model:
    """A model of the languages that rows of docs have in lang; rows of null lang or text teach nothing.

    Every labelled row counts in every round. A round's tasks each send at most
    a number for each piece and language, which Spark adds up, so the driver
    gets a table of the size of the vocabulary times the number of languages,
    whatever the input. Without labelled rows the model has no language.
    """
    common.ship(docs.sparkSession)
    rows = docs.select("text", "lang").filter("lang IS NOT NULL AND text IS NOT NULL")
    languages = sorted(r.lang for r in rows.groupBy("lang").count().collect())
    model = uniform(path, languages)
    if not languages:
        return model
    for _ in range(rounds):
        sums = np.zeros(model.table.shape)
        found = rows.mapInArrow(_counted(model), "piece int, k int, n double").groupBy("piece", "k").agg(F.sum("n").alias("n")).toArrow()
        np.add.at(sums, (found["piece"].to_numpy(), found["k"].to_numpy()), found["n"].to_numpy())
        model = Model(path, languages, (sums + prior) / (sums.sum(0) + prior * len(sums)))
    return model


def _predicted(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.alone("language", lambda: None)
        names = pa.array([*model.languages, UNDETERMINED], pa.string())
        none = len(model.languages)
        for b in batches:
            for part in common.slices(iter([b]), TEXTS):
                log, n = model.log_texts(part.column("text"))
                best, score = np.full(len(n), none), np.zeros(len(n))
                if none:
                    share = np.exp(log - log.max(1, keepdims=True))
                    share /= share.sum(1, keepdims=True)
                    best, score = np.where(n > 0, share.argmax(1), none), np.where(n > 0, share.max(1), 0.0)
                yield pa.record_batch([part.column("_row"), names.take(pa.array(best)), pa.array(np.minimum(score, 1.0))], ["_row", "lang_pred", "score"])
        common.settle()

    return run


def predict(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """The columns keep of every row of docs with lang_pred and score.

    score is the posterior probability of the predicted language, all languages
    being as likely before; of equally likely ones the first by name is taken.
    lang_pred is und, with a score of 0, for a null text, one without letters,
    and where the model has no language. Texts are read whole, whatever their
    length; a letter is a character that Unicode calls one. Repeated rows get
    equal values, an empty table gives no rows, and kept columns called
    lang_pred or score are replaced.
    """
    common.ship(docs.sparkSession)
    keep = tuple(c for c in keep if c not in ("lang_pred", "score"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("_row"), "text")
    out = T.StructType(list(rows.select("_row").schema.fields)).add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(_predicted(model), out).select(*(F.col(f"_row.`{c}`").alias(c) for c in keep), "lang_pred", "score")
