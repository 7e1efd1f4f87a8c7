"""Repair of conversations by error-correcting Earley parsing.

A conversation's roles should form a sentence of a small grammar. Its
productions are left-linear, so every chart item starts at the first turn, and
a column of the chart has an item for each head at most. Error productions let
a turn be deleted, change its role, or be made up; an item keeps the least
(cost, audit), the audit being the edits' initials so far.

Columns are brought to a common form, costs less the least one and audits by
their order, of which there are few. So each step of the parser is computed
once and looked up from then on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: head -> (what stands before, role's initial): a system turn, then user and assistant in turn. A sentence is empty or ends as an "a".
GRAMMAR = {"s": (("", "s"),), "u": (("", "u"), ("s", "u"), ("a", "u")), "a": (("u", "a"),)}
COMPLETE = ("", "a")
HEADS = ("", *GRAMMAR)
ROLES = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: An item that costs more than this above another can't be part of the cheapest repair: two turns made up and one deleted lead from any head to what another could still become.
SLACK = 2 * INSERT + DELETE
#: Turns that a chart holds before it looks for a turn that all of its items have in common.
HELD = 64

Column_ = tuple[tuple[int, int] | None, ...]  # by head: cost above the least, the audit's place in their order
START: Column_ = ((0, 0), *[None] * (len(HEADS) - 1))
BLANKS = " \t\n\x0b\x0c\r"


def _inserted(items: dict[str, tuple]) -> Iterator[tuple[str, tuple]]:
    """Items (cost, audit before, edits since), and what turns that are made up turn them into."""
    for _ in range(3):
        yield from items.items()
        more = {}
        for head, (cost, before, edits) in items.items():
            for new, ways in GRAMMAR.items():
                if new in ROLES and any(left == head for left, _ in ways):
                    item = (cost + INSERT, before, edits + "I")
                    more[new] = min(more.get(new, item), item)
        items = more


@cache
def step(column: Column_, initial: str, gone: bool, truncated: bool) -> tuple[Column_, int, tuple]:
    """The next column, what its least cost is above this one's, and by head where it comes from: (head before, edits)."""
    found: dict[str, tuple] = {}
    for origin, item in zip(HEADS, column, strict=True):
        if item is None:
            continue
        for head, (cost, rank, edits) in _inserted({origin: (item[0], item[1], "")}):
            ways = [(head, cost + DELETE, "D")]
            if not gone:
                for new, lefts in GRAMMAR.items():
                    if any(left == head for left, _ in lefts):
                        if initial == new:
                            ways.append((new, cost + KEEP + TRUNCATED * truncated, "K"))
                        if new in ROLES:
                            ways.append((new, cost + REROLE + TRUNCATED * truncated, "R"))
            for new, total, edit in ways:
                # audits of one column end with a turn's edit each, so none is the beginning of another, and the order of the earlier ones decides
                way = (total, rank, edits + edit, HEADS.index(origin))
                found[new] = min(found.get(new, way), way)
    least = min(w[0] for w in found.values())
    found = {h: w for h, w in found.items() if w[0] <= least + SLACK}
    order = sorted({w[1:3] for w in found.values()})
    new = tuple((found[h][0] - least, order.index(found[h][1:3])) if h in found else None for h in HEADS)
    return new, least, tuple((found[h][3], found[h][2]) if h in found else None for h in HEADS)


@cache
def finish(column: Column_) -> tuple[int, int, int]:
    """Of the cheapest complete sentence the cost above the column's least, its head, and the turns made up at its end."""
    ends = [(cost, rank, edits, at) for at, item in enumerate(column) if item for head, (cost, rank, edits) in _inserted({HEADS[at]: (*item, "")}) if head in COMPLETE]
    cost, _, edits, at = min(ends)
    return cost, at, len(edits)


class Chart:
    """The chart of one conversation: turns go in, edited turns come out as soon as no later turn can change them."""

    def __init__(self) -> None:
        self.column, self.cost, self.base = START, 0, 0
        self.backs: list[tuple] = []
        self.turns: list[tuple[str, str]] = []
        self.audit: list[str] = []
        self.head = ""
        self.limit = HELD

    def add(self, role: str, text: str, gone: bool, truncated: bool) -> Iterator[tuple[str, str, str]]:
        """Takes a turn; gives the (role, text, edit) that are settled, deleted ones too."""
        initial = role[:1]
        self.column, more, back = step(self.column, initial if initial in GRAMMAR else "", gone, truncated)
        self.cost += more
        self.backs.append(back)
        self.turns.append((role, text))
        if len(self.backs) >= self.limit:
            yield from self._settle()

    def _settle(self) -> Iterator[tuple[str, str, str]]:
        at = {i for i, item in enumerate(self.column) if item}
        for n in range(len(self.backs) - 1, -1, -1):
            at = {self.backs[n][i][0] for i in at}
            if len(at) == 1 and n:
                (head,) = at
                yield from self._edits(head, n)
                break
        self.limit = max(HELD, 2 * len(self.backs))

    def _edits(self, head: int, n: int) -> Iterator[tuple[str, str, str]]:
        """The first n turns, as edited on the way to this head."""
        ways, at = [], head
        for back in reversed(self.backs[:n]):
            at, edits = back[at]
            ways.append(edits)
        for (role, text), edits in zip(self.turns[:n], reversed(ways), strict=True):
            self.audit.append(edits)
            for edit in edits:
                if edit == "I":
                    yield self._next(), "", edit
                elif edit == "R":
                    yield self._next(), text, edit
                else:
                    if edit == "K":
                        self.head = role[:1]
                    yield role, text, edit
        del self.backs[:n], self.turns[:n]

    def _next(self) -> str:
        """The only role besides the system's that may follow."""
        self.head = "a" if self.head == "u" else "u"
        return ROLES[self.head]

    def end(self) -> Iterator[tuple[str, str, str]]:
        cost, head, inserts = finish(self.column)
        self.cost += cost
        yield from self._edits(head, len(self.backs))
        self.audit.append("I" * inserts)
        for _ in range(inserts):
            yield self._next(), "", "I"


_SUMMARY = T.StructType().add("gaps", "long").add("blank", "long").add("duplicate", "long").add("truncated", "long").add("illegal", "long").add("cost", "long").add("audit", "string").add("repaired_sha256", "string")
_TURN = T.StructType().add("place", "long").add("role", "string").add("text", "string").add("edit", "string")
_LEGAL = frozenset(("su", "ua", "au"))


class _Conversation:
    """What is counted of a conversation's turns as they come in order, and its chart."""

    def __init__(self) -> None:
        self.chart, self.hash, self.lines, self.place = Chart(), hashlib.sha256(), 0, 0
        self.turn = self.first = self.last = None
        self.distinct = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before: tuple | None = None

    def add(self, turn: int | None, role: str, text: str, again: bool, blank: bool, cut: bool) -> Iterator[dict]:
        if turn is not None:
            self.first = turn if self.first is None else self.first
            self.distinct += turn != self.last
            self.last = turn
        again = again or self.before == (turn, role, text)
        if self.before is not None:
            self.illegal += self.before[1][:1] + role[:1] not in _LEGAL
        self.before = (turn, role, text)
        self.blank += blank
        self.duplicate += again and not blank
        cut = cut and not (again or blank)
        self.truncated += cut
        yield from self._written(self.chart.add(role, text, again or blank, cut))

    def _written(self, edited: Iterator[tuple[str, str, str]]) -> Iterator[dict]:
        for role, text, edit in edited:
            if edit != "D":
                self.hash.update(("\n" * (self.lines > 0) + f"{role}:{text}").encode())
                yield {"place": self.lines, "role": role, "text": text, "edit": edit}
                self.lines += 1

    def end(self) -> Iterator[dict]:
        yield from self._written(self.chart.end())

    def summary(self) -> dict:
        gaps = 0 if self.last is None else self.last - self.first + 1 - self.distinct
        return {"gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal, "cost": self.chart.cost, "audit": "".join(self.chart.audit), "repaired_sha256": self.hash.hexdigest()}


def _repaired(turns: bool, kind: pa.DataType):
    """Of conversations whose turns come together and in order the repaired turns, or a summary each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.alone("conversations", lambda: None)
        key, now, out = None, None, []

        def batch() -> pa.RecordBatch:
            made = pa.record_batch([pa.array([k for k, _ in out], kind), *(pa.array([r[f.name] for _, r in out], pa.int64() if f.dataType == T.LongType() else pa.string()) for f in (_TURN if turns else _SUMMARY))], ["conv", *(_TURN if turns else _SUMMARY).names])
            out.clear()
            return made

        def put(rows: Iterator[dict]) -> None:
            for r in rows:
                if turns:
                    out.append((key, r))

        for whole in batches:
            for b in common.slices(iter([whole])):
                for conv, *row in zip(*(b.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "again", "blank", "cut")), strict=True):
                    if now is None or conv != key:
                        if now is not None:
                            put(now.end())
                            if not turns:
                                out.append((key, now.summary()))
                        key, now = conv, _Conversation()
                    put(now.add(*row))
                if out:
                    yield batch()
        if now is not None:
            put(now.end())
            if not turns:
                out.append((key, now.summary()))
        yield batch()

    return run


def _crc(*parts: Column) -> Column:
    return F.crc32(F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit(" ")) for p in parts)).cast("binary"))


def damaged(turns: DataFrame) -> DataFrame:
    """The turns as a broken log would have them: by crc32 of "conv_id:turn" some missing, emptied, without sentence ends, twice, or of the wrong role.

    Nulls are one space in the digest, in roles and in texts. Every copy of a
    repeated row is damaged alike. An empty table stays empty.
    """
    kind = _crc(F.col("conv_id"), F.col("turn")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    rows = turns.select("conv_id", "turn", kind.alias("_kind"), role.alias("role"), text.alias("text")).filter("_kind <> 0")
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_kind") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("_kind") == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), times)).alias("_copy")).drop("_copy")


def _ordered(turns: DataFrame) -> DataFrame:
    """Turns with their faults, each conversation's together and in order.

    Texts that a conversation has more than once are found by an aggregate of
    digests, in which copies meet after they were counted in each task, and only
    these few are looked up again. Then a conversation's turns meet in the order
    of their sort, since a repaired text's digest is a chain over all of them;
    the task reads them one by one and holds none for longer than the chart is
    open.
    """
    rows = turns.select(F.col("conv_id").alias("conv"), "turn", *(F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")))
    rows = rows.withColumn("digest", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)))
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    twice = common.cut(rows.groupBy("conv", "digest").agg(F.count("*").alias("n"), F.min(place).alias("first")).filter("n > 1").select(F.col("conv").alias("_conv"), F.col("digest").alias("_digest"), "first"))
    joined = rows.join(common.workers.small(twice), F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("digest") == F.col("_digest")), "left")
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    again = F.col("first").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn"))
    shown = joined.select("conv", "turn", "role", "text", again.alias("again"), (bare == "").alias("blank"), (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut"))
    return shown.repartition("conv").sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text")


def _run(turns: DataFrame, rows: bool) -> DataFrame:
    common.ship(turns.sparkSession)
    ordered = _ordered(turns)
    own = ordered.schema["conv"].dataType
    schema = T.StructType([T.StructField("conv", own), *(_TURN if rows else _SUMMARY)])
    return ordered.mapInArrow(_repaired(rows, _arrow(own)), schema).withColumnRenamed("conv", "conv_id")


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def repaired_turns(turns: DataFrame) -> DataFrame:
    """The turns that the cheapest repair leaves: conv_id, place from 0, role, text, edit (K kept, R role changed, I made up)."""
    return _run(turns, True)


def repair(turns: DataFrame, every: DataFrame) -> DataFrame:
    """Of each conversation of every (conv_id) the faults of its turns, and the cost, audit and digest of their cheapest repair.

    Turns count in the order of turn, nulls first; those of one turn in that of
    role and text, so copies stand together. Null roles and texts are one space;
    rows whose conv_id is null are one conversation. A fault is the first that
    holds of blank, duplicate (role and text came before in the conversation)
    and truncated; gaps ignores null turns and is 0 without any. Among repairs
    of equal cost the audit that is least as ASCII is taken. Without turns all
    numbers are 0, the audit is empty and the digest that of the empty string.
    Repeated rows are duplicates, an empty table gives no rows, other columns
    don't matter.
    """
    found = _run(turns, False).withColumnRenamed("conv_id", "_conv")
    ids = every.select("conv_id").distinct()
    joined = ids.join(found, ids["conv_id"].eqNullSafe(found["_conv"]), "left")
    numbers = [F.coalesce(F.col(f.name), F.lit(0).cast("long")).alias(f.name) for f in _SUMMARY if f.dataType == T.LongType()]
    return joined.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
