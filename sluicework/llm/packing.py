"""Packing documents into sequences: dominance reduction over a histogram of lengths, then best fit."""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _pieces(path: str, cap: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import struct
        import zlib

        from .encode import encoder

        one, end, step = encoder(path), struct.pack("<I", end_id), 4 * cap
        for b in common.slices(batches):
            out: list[list] = [[], [], [], [], []]
            for doc, own in zip(b.column("doc_id").to_pylist(), one.encode_all(b.column("text")), strict=True):
                ids = bytes(own) + end
                for k, at in enumerate(range(0, len(ids), step)):
                    piece = ids[at : at + step]
                    for column, value in zip(out, (doc, k, at // 4, len(piece) // 4, zlib.crc32(piece)), strict=True):
                        column.append(value)
            yield pa.record_batch([pa.array(out[0], b.column("doc_id").type), pa.array(out[1], pa.int32()), *(pa.array(x, pa.int64()) for x in out[2:])], ["doc_id", "piece", "start", "length", "ids_crc32"])
        common.settle()

    return run


def reduce_dominated(counts: dict[int, int], cap: int) -> list[tuple[tuple[int, ...], int]]:
    """Fix sets of lengths that provably dominate their alternatives; counts keeps the rest.

    Martello and Toth: a feasible set dominates another if the other's items
    can be dealt into groups that each fit into one of its own items. For the
    longest item j with room r = cap - j, {j} dominates if nothing fits beside
    it; {j, k}, k the longest that fits, dominates if k fills r, or if no two
    others fit into r together, or if no two that fit are longer than k and no
    three fit. Equal lengths are fixed all at once.
    """
    fixed: list[tuple[tuple[int, ...], int]] = []
    sizes = sorted(s for s, n in counts.items() if n)
    for j in sorted(sizes, reverse=True):
        while counts.get(j, 0):
            room = cap - j
            counts[j] -= 1
            others = [s for s in sizes if counts[s]]
            at = bisect.bisect_right(others, room)
            if not at:
                fixed.append(((j,), counts[j] + 1))
                counts[j] = 0
                break
            k = others[at - 1]
            low = [s for s in others[:3] for _ in range(min(3, counts[s]))][:3]
            pair = low[0] + low[1] if len(low) > 1 else cap + 1
            three = sum(low) if len(low) > 2 else cap + 1
            if not (k == room or pair > room or three > room and _best_pair(others, counts, room) <= k):
                counts[j] += 1
                break
            n = (counts[j] + 1) // 2 if k == j else min(counts[j] + 1, counts[k])
            fixed.append(((j, k), n))
            counts[j] += 1 - n
            counts[k] -= n
    return fixed


def _best_pair(sizes: list[int], counts: dict[int, int], room: int) -> int:
    best, lo, hi = 0, 0, len(sizes) - 1
    while lo <= hi:
        total = sizes[lo] + sizes[hi]
        if total > room:
            hi -= 1
        else:
            if lo < hi or counts[sizes[lo]] > 1:
                best = max(best, total)
            lo += 1
    return best


def best_fit(counts: dict[int, int], cap: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Best fit decreasing over a histogram: patterns of (length, copies) and how many sequences follow each.

    All open sequences with one room are alike for the choice, so they are
    filled together: the tightest room first, as many copies as it takes.
    """
    open_: dict[int, list[tuple[list[tuple[int, int]], int]]] = {}
    for s in sorted((s for s, n in counts.items() if n), reverse=True):
        left = counts[s]
        for room in sorted(r for r in open_ if r >= s):
            if not left:
                break
            most, groups = room // s, open_.pop(room)
            while groups and left:
                pattern, n = groups.pop()
                full = min(n, left // most)
                if full:
                    open_.setdefault(room - most * s, []).append(([*pattern, (s, most)], full))
                    left -= full * most
                    n -= full
                if n and left:
                    open_.setdefault(room - left * s, []).append(([*pattern, (s, left)], 1))
                    left, n = 0, n - 1
                if n:
                    groups.append((pattern, n))
            if groups:
                open_.setdefault(room, []).extend(groups)
        if left:
            most = cap // s
            if full := left // most:
                open_.setdefault(cap - most * s, []).append(([(s, most)], full))
            if rest := left % most:
                open_.setdefault(cap - rest * s, []).append(([(s, rest)], 1))
    return [g for groups in open_.values() for g in groups]


def plan(counts: dict[int, int], cap: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Every length's occurrences in patterns of (length, copies), each with its number of sequences."""
    rest = dict(counts)
    whole = rest.pop(cap, 0)
    fixed = [(sorted({x: f.count(x) for x in f}.items(), reverse=True), n) for f, n in reduce_dominated(rest, cap)]
    return [([(cap, 1)], whole)] * bool(whole) + fixed + best_fit(rest, cap)


def _placed(starts: list[int], lengths: list[int], bins: list[int], copies: list[int], offsets: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        s, size, first, k, off = (np.array(x, np.int64) for x in (starts, lengths, bins, copies, offsets))
        for b in batches:
            rank = b.column("rank").to_numpy()
            at = np.searchsorted(s, rank, "right") - 1
            j = rank - s[at]
            own = b.drop_columns(["rank"])
            yield pa.record_batch([*own.columns, pa.array(first[at] + j // k[at]), pa.array(off[at] + j % k[at] * size[at])], [*own.schema.names, "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, tokenizer: str, *, cap: int = 2048, end_id: int = 0) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its text's ids and end_id; null is the empty text. Longer
    ones than cap are cut into pieces of cap. Choosing partners needs lengths
    only, so the driver plans over the histogram of at most cap lengths, which
    doesn't grow with the input, and every piece finds its place by its rank
    among the pieces in order of length. Repeated rows are packed as often as
    they occur, a null doc_id is kept, an empty table gives no rows, and other
    columns are not read.
    """
    common.ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    pieces = texts.mapInArrow(_pieces(tokenizer, cap, end_id), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")
    rows = common.ranked(common.cut(pieces), "length", "doc_id", "piece", "ids_crc32")
    counts = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}
    used, at = {}, 0
    for s in sorted(counts):
        used[s], at = at, at + counts[s]
    slots, bins = [], 0
    for pattern, n in plan(counts, cap):
        offset = 0
        for s, k in pattern:
            slots.append((used[s], s, bins, k, offset))
            used[s] += n * k
            offset += s * k
        bins += n
    columns = [list(x) for x in zip(*sorted(slots), strict=True)] or [[0]] * 5
    out = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return rows.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(_placed(*columns), out)
