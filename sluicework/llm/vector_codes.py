"""Vector codes by Lloyd's rounds over integer parts, with Yinyang bounds.

Each codebook's entries are dealt once into groups of near ones. Every part
keeps an upper bound of the distance to its own entry and a lower bound for
each group; when entries move, bounds drift by as much as the entries did. Only
groups whose bound doesn't stay above the part's are scanned, in exact
integers, so ties and results are those of a full scan.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

PARTS, ENTRIES, ROUNDS, UNITS = 4, 256, 4, 1024
#: Groups of a codebook's entries: each part keeps a bound for each of them.
GROUPS = 16
#: Integers up to here, and parts of up to WIDTH of them, have distances that floating-point products give exactly.
RANGE, WIDTH = 1 << 20, 1 << 10
#: Vectors that are worked on at once.
VECTORS = 2048


def usable(vector: Column) -> Column:
    """Not null and without null or non-finite components."""
    return vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))


def integers(vectors: np.ndarray, wide: bool) -> np.ndarray:
    """floor(1024 x) of every component, as exact Python integers where they are wide."""
    if not wide:
        return np.floor(vectors * UNITS).astype(np.int64)
    exact = [(n * UNITS) // d for n, d in (float(x).as_integer_ratio() for x in vectors.ravel())]
    return np.array(exact, object).reshape(vectors.shape)


def parts(x: np.ndarray) -> np.ndarray:
    """(part, vector, position); zeros fill the last part where the length isn't a multiple of the parts."""
    n, d = x.shape
    width = -(-d // PARTS)
    full = np.zeros((n, PARTS * width), x.dtype)
    full[:, :d] = x
    return full.reshape(n, PARTS, width).transpose(1, 0, 2)


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all x to all entries."""
    if x.dtype == object:
        return ((x[:, None, :] - entries[None]) ** 2).sum(2) if x.shape[1] else np.zeros((len(x), len(entries)), object)
    a, b = x.astype(float), entries.astype(float)
    return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None]).astype(np.int64)


def root(d: np.ndarray) -> np.ndarray:
    return np.sqrt(d.astype(float))


@dataclass
class Codebooks:
    """Entries by part, their groups, and how far each entry moved last."""

    entries: np.ndarray
    groups: np.ndarray
    drift: np.ndarray = field(default=None)

    @classmethod
    def first(cls, x: np.ndarray) -> Codebooks:
        """From the first vectors' integers."""
        entries = parts(x).copy()
        return cls(entries, np.stack([_grouped(scaled(e)) for e in entries]))

    def moved(self, sums: dict[tuple[int, int], tuple[int, list[int]]]) -> Codebooks:
        """Entries replaced by the floor of their parts' means; unused ones stay."""
        new = self.entries.copy()
        for (m, j), (n, total) in sums.items():
            new[m, j] = [t // n for t in total]
        step = np.zeros(new.shape[:2]) if new.dtype == object else root(((new - self.entries) ** 2).sum(2))
        return Codebooks(new, self.groups, step * (1 + 1e-12))

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def scaled(entries: np.ndarray) -> np.ndarray:
    """Entries as floating-point numbers of a common scale: only their grouping depends on it."""
    top = max((abs(int(v)) for v in entries.ravel()), default=1) or 1
    return np.array([int(v) / top for v in entries.ravel()], float).reshape(entries.shape)


def _grouped(e: np.ndarray) -> np.ndarray:
    """A group for each entry, by a few rounds of Lloyd's own from evenly chosen entries."""
    k = min(GROUPS, len(e))
    centres = e[np.linspace(0, len(e) - 1, k).astype(int)] if k else e
    near = np.zeros(len(e), int)
    for _ in range(5 if k else 0):
        near = ((e[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        centres = np.stack([e[near == g].mean(0) if (near == g).any() else centres[g] for g in range(k)])
    return near


def assign(x: np.ndarray, book: Codebooks, m: int, state: tuple[np.ndarray, np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Of part m's integers the nearest entries, their upper bounds, lower bounds by group, and how many distances were computed.

    state holds the same three of the round before; without it all entries are
    scanned. A lower bound leaves out the entry that is assigned. Exact Python
    integers are always compared with all entries.
    """
    entries, groups = book.entries[m], book.groups[m]
    members = [np.flatnonzero(groups == g) for g in range(GROUPS)]
    n = len(x)
    if x.dtype == object:  # beyond what bounds can hold
        d = squared(x, entries)
        return np.array([min(range(len(r)), key=lambda j: (r[j], j)) for r in d], int), np.zeros(n), np.zeros((n, GROUPS)), d.size
    if state is None:
        d = squared(x, entries)
        code = d.argmin(1)
        rest = root(d)
        upper = rest[np.arange(n), code]
        rest[np.arange(n), code] = np.inf
        lower = np.stack([rest[:, own].min(1) if own.size else np.full(n, np.inf) for own in members], 1)
        return code, _up(upper), _down(lower), d.size
    code, upper, lower = (a.copy() for a in state)
    upper = _up(upper + book.drift[m][code])
    lower = _down(lower - np.array([book.drift[m][own].max() if own.size else 0.0 for own in members]))
    asked = 0
    open_ = np.flatnonzero(lower.min(1) <= upper)
    if open_.size:  # first the true distance in place of the upper bound
        d = _own(x[open_], entries[code[open_]])
        asked += open_.size
        exact = np.full(n, -1, d.dtype)
        exact[open_] = d
        upper[open_] = _up(root(d))
        old, old_d = code.copy(), exact.copy()
        tight = upper.copy()
        for g, own in enumerate(members):
            rows = open_[lower[open_, g] <= tight[open_]] if own.size else open_[:0]
            if not rows.size:
                continue
            d = squared(x[rows], entries[own])
            asked += d.size
            far = root(d)
            far[own[None] == old[rows, None]] = np.inf
            lower[rows, g] = _down(far.min(1))
            best = d.argmin(1)
            least, which = d[np.arange(rows.size), best], own[best]
            better = (least < exact[rows]) | (least == exact[rows]) & (which < code[rows])
            exact[rows[better]], code[rows[better]] = least[better], which[better]
        new = open_[code[open_] != old[open_]]
        if new.size:  # the entry that was left is one of its group's others now, and the new one no longer is: its group's bound is lower than need be
            at = groups[old[new]]
            lower[new, at] = np.minimum(lower[new, at], _down(root(old_d[new])))
            upper[new] = _up(root(exact[new]))
    return code, upper, lower, asked


def _own(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of each x to its own entry."""
    return ((x - entries) ** 2).sum(1) if x.shape[1] else np.zeros(len(x), x.dtype)


def _up(v: np.ndarray) -> np.ndarray:
    """Bounds stay bounds when they are stored as smaller numbers."""
    return np.nextafter((v * (1 + 1e-9)).astype(np.float32), np.float32(np.inf))


def _down(v: np.ndarray) -> np.ndarray:
    return np.nextafter((v * np.where(v > 0, 1 - 1e-9, 1 + 1e-9)).astype(np.float32), np.float32(-np.inf))


# --- in tasks: rows are (_row, x, code, upper, lower), numbers as bytes

_STATE = ("_row", "x", "code", "upper", "lower")


def _blob(a: np.ndarray) -> pa.Array:
    data = np.ascontiguousarray(a)
    return pa.array([r.tobytes() for r in data], pa.binary())


def _matrix(column: pa.Array, kind: type, n: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(n, -1)


def _vectors(column: pa.Array, n: int, size: int) -> np.ndarray:
    return np.asarray(column.flatten(), float).reshape(n, size)


def _started(book: Codebooks, size: int, wide: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.alone("vector codes", lambda: None)
        for whole in batches:
            for b in common.slices(iter([whole]), VECTORS):
                vectors = _vectors(b.column("vector"), b.num_rows, size)
                x = parts(integers(vectors, wide))
                found = [assign(x[m], book, m, None) for m in range(PARTS)]
                stored = vectors if wide else integers(vectors, False).astype(np.int32)
                yield _state(b.column("_row"), _blob(stored), found)

    return run


def _state(row: pa.Array, x: pa.Array, found: list[tuple]) -> pa.RecordBatch:
    code, upper, lower = (np.stack([f[i] for f in found], 1) for i in range(3))
    return pa.record_batch([row, x, _blob(code.astype(np.uint8)), _blob(upper.astype(np.float32)), _blob(lower.astype(np.float32).reshape(len(row), -1))], list(_STATE))


def _read(b: pa.RecordBatch, wide: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n = b.num_rows
    x = integers(_matrix(b.column("x"), np.float64, n), True) if wide else _matrix(b.column("x"), np.int32, n).astype(np.int64)
    lower = _matrix(b.column("lower"), np.float32, n).reshape(n, PARTS, GROUPS)
    return parts(x), _matrix(b.column("code"), np.uint8, n).astype(int), _matrix(b.column("upper"), np.float32, n), lower


def _continued(book: Codebooks, wide: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in common.slices(iter([whole]), VECTORS):
                x, code, upper, lower = _read(b, wide)
                found = [assign(x[m], book, m, (code[:, m], upper[:, m], lower[:, m])) for m in range(PARTS)]
                yield _state(b.column("_row"), b.column("x"), found)

    return run


def _summed(k: int, wide: bool):
    """Of a task's parts the number and sum by part and entry, a row for each entry that is used."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for whole in batches:
            for b in common.slices(iter([whole]), VECTORS):
                x, code, _, _ = _read(b, wide)
                if sums is None:
                    sums = np.zeros((PARTS, k, 1 + x.shape[2]), object if wide else np.int64)
                for m in range(PARTS):
                    np.add.at(sums[m], code[:, m], np.concatenate([np.ones((b.num_rows, 1), x.dtype), x[m]], 1))
        used = [(m, j) for m in range(PARTS) for j in range(k) if sums is not None and sums[m, j, 0]]
        out = [[str(v) if wide else int(v) for v in sums[m, j]] for m, j in used]
        kind = pa.string() if wide else pa.int64()
        yield pa.record_batch([pa.array([m for m, _ in used], pa.int32()), pa.array([j for _, j in used], pa.int32()), pa.array(out, pa.list_(kind))], ["part", "entry", "sums"])

    return run


@F.pandas_udf(T.StringType())
def _total(values: pd.Series) -> str:
    return str(sum(map(int, values)))


def _sums(state: DataFrame, k: int, wide: bool) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """Numbers and sums by part and entry: at most PARTS * ENTRIES of them reach the driver."""
    kind = "string" if wide else "bigint"
    rows = state.mapInArrow(_summed(k, wide), f"part int, entry int, sums array<{kind}>").select("part", "entry", F.posexplode("sums").alias("at", "value"))
    added = rows.groupBy("part", "entry", "at").agg((_total("value") if wide else F.sum("value")).alias("value"))
    found: dict[tuple[int, int], dict[int, int]] = {}
    for r in added.toArrow().to_pylist():
        found.setdefault((r["part"], r["entry"]), {})[r["at"]] = int(r["value"])
    return {at: (v[0], [v[i] for i in range(1, len(v))]) for at, v in found.items()}


def _finished(book: Codebooks, wide: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in common.slices(iter([whole]), VECTORS):
                x, code, upper, lower = _read(b, wide)
                now = [assign(x[m], book, m, (code[:, m], upper[:, m], lower[:, m]))[0] for m in range(PARTS)]
                error = sum(_own(x[m], book.entries[m][now[m]]) for m in range(PARTS))
                codes = pa.array([bytes(c).hex() for c in np.stack(now, 1).astype(np.uint8)], pa.string())
                yield pa.record_batch([b.column("_row"), codes, pa.array([int(e) if e < 1 << 63 else None for e in error.tolist()], pa.int64())], ["_row", "code", "error"])

    return run


def encode(table: DataFrame, vector: str, key: str, label: str) -> DataFrame:
    """key, code, error, label_error and codebooks_sha256 of every row whose vector is usable.

    A code is the nearest entry of each part, two hexadecimal digits for each,
    after ROUNDS rounds from the vectors of the ENTRIES smallest keys; error
    the exact squared distance to them, null beyond a long; label_error the sum
    of errors over the rows of equal labels, null labels being equal. Null keys
    come after all others, and rows of one key in the order of their vectors.
    A table's vectors have the length that its smallest key's has: rows with
    another are left out like unusable ones. Where it isn't a multiple of the
    parts, zeros fill the last part. Repeated rows get equal values, an empty
    table gives no rows, and other columns don't matter.

    Rounds are jobs over a stored table of integers, codes and bounds: each
    task sends a sum for each entry at most, so no label, code or group of
    copies meets in one task, and the driver holds the codebooks only. Integers
    beyond RANGE are computed with Python's exact ones instead.
    """
    spark = table.sparkSession
    common.ship(spark)
    common.shared_dir(spark)
    rows = table.select(F.struct(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").alias("label")).alias("_row"), F.col(f"`{vector}`").cast("array<double>").alias("vector")).filter(usable(F.col("vector")))
    order = (F.col("_row.key").asc_nulls_last(), F.col("vector"))
    first = rows.orderBy(*order).limit(ENTRIES).collect()
    size = len(first[0].vector) if first else 0
    if any(len(r.vector) != size for r in first):
        first = rows.filter(F.size("vector") == size).orderBy(*order).limit(ENTRIES).collect()
    rows = rows.filter(F.size("vector") == size)
    kind = dict(table.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").alias("label")).dtypes)
    if not first:
        return spark.createDataFrame([], f"`{key}` {kind['key']}, code string, error long, label_error long, codebooks_sha256 string")
    most = rows.agg(F.max(F.array_max(F.transform("vector", F.abs))).alias("most")).first().most or 0.0
    wide = most * UNITS >= RANGE - 1 or -(-size // PARTS) > WIDTH
    book = Codebooks.first(integers(np.array([r.vector for r in first], float).reshape(len(first), size), wide))
    schema = T.StructType([rows.schema["_row"], *(T.StructField(c, T.BinaryType()) for c in _STATE[1:])])
    state = common.cut(rows.mapInArrow(_started(book, size, wide), schema))
    for i in range(ROUNDS):
        book = book.moved(_sums(state, len(first), wide))
        if i < ROUNDS - 1:
            state = common.cut(state.mapInArrow(_continued(book, wide), schema))
    done = T.StructType([rows.schema["_row"]]).add("code", "string").add("error", "long")
    coded = common.cut(state.mapInArrow(_finished(book, wide), done).select("_row.key", "_row.label", "code", "error"))
    by_label = coded.groupBy("label").agg(F.try_sum("error").alias("label_error")).select(F.col("label").alias("_label"), "label_error")
    joined = coded.join(common.workers.small(by_label), F.col("label").eqNullSafe(F.col("_label")), "left")
    return joined.select(F.col("key").alias(key), "code", "error", "label_error", F.lit(book.digest()).alias("codebooks_sha256"))
