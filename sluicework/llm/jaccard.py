"""Exact n-gram Jaccard join by grouped prefixes, with its connected components.

The order of shingles that prefixes need puts those with a low hash, a share
of all that is larger than prefixes are, first, rare ones before frequent ones,
and all others after them by hash: so prefixes hold rare shingles unless much of
a text is common. Only the counted ones' frequencies have to be shuffled, and any
fixed order keeps the prefix theorem: two sets with Jaccard t share a shingle
among the first n - ceil(t * n) + 1 of each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common
from .components import components

#: Share of the hash range whose shingles are ordered by frequency: this, and so much of the share that prefixes have.
COUNTED = 0.14, 1.1
#: Prefix lists up to this long are joined pair by pair; a longer one is taken as a candidate group whole.
PAIRED = 32
#: Sets compared at once; larger candidate groups are cut into blocks.
BLOCK = 100
#: Members of a large group's class that every block of it or of the next class is compared with first; fewer of a small class.
LEADERS = 4
#: Longs of the parity bitmap that bounds a symmetric difference from below.
PARITY = 16
#: Word hashes a worker keeps.
CACHE_WORDS = 200_000
#: Bounded memory of set digests already sent by a task.
CACHE_SETS = 100_000

_M1, _M2, _M3, _M4, _M5 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_WORDS = _Words()


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(30)) * _M4
    h = (h ^ h >> np.uint64(27)) * _M5
    return h ^ h >> np.uint64(31)


def shingles(text: str | None, k: int = 3) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct k-word shingles; of all words if there are fewer; none without words."""
    words = text.encode().lower().split() if text else []
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    a = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, n)
    h = np.full(max(1, n - k + 1), min(n, k), np.uint64)
    for i in range(min(n, k)):
        h = _mix(h * _M1 + a[i : i + h.size] * _M2 + _M3)
    return np.unique(h)


def _needed(n, percent: int):
    """Least overlap of a set of n with one that it may equal: ceil(t * n)."""
    return (percent * n + 99) // 100


def _low(percent: int) -> int:
    """Hashes below this are ordered by frequency; never more than half of them, so that they are no negative longs."""
    return int(min(0.49, COUNTED[0] + COUNTED[1] * (100 - percent) / 100) * 2**64)


def _signatures(k: int, percent: int):
    limit = np.uint64(_low(percent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        common.alone("shingles", _WORDS.clear)
        sent: dict[bytes, int] = {}
        schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("rep", pa.int64()), ("emitted", pa.int64()), ("tokens", pa.list_(pa.int64())), ("parity", pa.list_(pa.int64()))])
        for b in common.slices(batches):
            out: list[list] = [[], [], [], [], [], []]
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                h = shingles(text, k)
                n, rep, tokens, bits = h.size, doc, None, None
                if n and doc is not None:
                    digest = hashlib.blake2b(h.tobytes(), digest_size=16).digest()
                    if digest in sent:
                        rep = sent[digest]
                    else:
                        if len(sent) >= CACHE_SETS:
                            sent.clear()
                        sent[digest] = doc
                        most = max(int(np.searchsorted(h, limit)), n - int(_needed(n, percent)) + 1)
                        tokens = h[:most].view(np.int64)
                        odd = np.bincount((h >> np.uint64(54)).astype(np.int64) % (64 * PARITY), minlength=64 * PARITY) & 1
                        bits = np.packbits(odd.astype(np.uint8)).view(np.int64)
                for column, value in zip(out, (doc, n, rep, None if tokens is None else tokens.size, tokens, bits), strict=True):
                    column.append(value)
            yield pa.record_batch([pa.array(x, f.type) for x, f in zip(out, schema, strict=True)], schema=schema)

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.alone("shingles", _WORDS.clear)
        for b in common.slices(batches):
            sets = [shingles(t, k).tobytes() for t in b.column("text").to_pylist()]
            yield pa.record_batch([b.column("doc_id"), pa.array(sets, pa.binary())], ["id", "hashes"])

    return run


def _verified(percent: int):
    """Links of the sets in each run of rows with one (group, part): enough of them to connect all that are linked."""

    def links(ids: list[int], labels: list[int], sides: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
        sizes = np.array([s.size for s in sets])
        root = {x: x for x in labels}

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        found = []
        side = np.array(sides)
        for i in np.argsort(sizes, kind="stable").tolist():
            fit = (sizes >= sizes[i]) & (100 * sizes[i] >= percent * sizes) & ((side != side[i]) | (side == 2))
            for j in np.flatnonzero(fit).tolist():
                if j == i or (sizes[j] == sizes[i] and j < i):
                    continue
                x, y = find(labels[i]), find(labels[j])
                if x == y:
                    continue
                both = np.intersect1d(sets[i], sets[j], assume_unique=True).size
                if 100 * both >= percent * (sets[i].size + sets[j].size - both):
                    root[max(x, y)] = min(x, y)
                    found.append((ids[i], ids[j]))
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, ([], [], [], [])

        def flush() -> pa.RecordBatch:
            found = links(*held)
            return pa.record_batch([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("task", "id", "label", "side", "hashes")), strict=True):
                if row[0] != key:
                    if len(held[0]) > 1:
                        yield flush()
                    key, held = row[0], ([], [], [], [])
                for column, value in zip(held, (*row[1:4], np.frombuffer(row[4], np.uint64)), strict=True):
                    column.append(value)
        if len(held[0]) > 1:
            yield flush()

    return run


def candidates(sig: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) whose components hold every pair of sets that can be linked.

    sig has a row for each distinct set of a task. Prefix shingles that only one
    set has meet nobody and are left out.
    """
    own = sig.filter("tokens is not null").select(F.col("doc_id").alias("id"), "n", "emitted", "tokens", "parity")
    tokens = own.select("id", F.explode("tokens").alias("token"))
    shared = common.cut(tokens.groupBy("token").count().filter("count > 1"))
    spark = sig.sparkSession
    common.sweep(spark)
    counted = (F.col("token") >= 0) & (F.col("token") < F.lit(_low(percent)))
    place = F.struct(F.when(counted, F.col("count")).otherwise(F.lit(2**62)).alias("count"), (F.col("token").bitwiseXOR(F.lit(-(2**63)))).alias("order"), "token")
    lists = tokens.join(shared, "token").groupBy("id").agg(F.array_sort(F.collect_set(place)).alias("held"))
    alone = F.col("emitted") - F.size("held")
    first = F.col("n") - F.floor((F.col("n") * percent + 99) / 100).cast("long") + 1
    take = F.size("held") + first - F.col("emitted")
    prefix = lists.join(own.drop("tokens"), "id").filter(take > 0).select("id", "n", "parity", (alone == 0).alias("all"), F.transform(F.slice("held", F.lit(1), take.cast("int")), lambda x: x["token"]).alias("prefix"))
    prefix = common.cut(prefix.withColumn("same", F.when(F.col("all"), F.xxhash64("n", "prefix")).otherwise(F.xxhash64("id"))))
    del sig, own, tokens, shared, lists
    common.sweep(spark)
    groups = prefix.filter("all").groupBy("same").agg(F.min("id").alias("group"), F.count("*").alias("members")).filter("members > 1")
    member = F.when(F.col("all"), F.col("group"))  # others have keys of their own, so that they are dealt evenly
    grouped = common.cut(prefix.join(groups, "same", "left").withColumn("group", member).select("id", "n", F.coalesce("group", "id").alias("group"), F.when(F.col("group").isNull(), F.col("parity")).alias("parity"), "prefix"))
    del prefix, groups
    common.sweep(spark)
    members = grouped.filter("id != group").select(F.col("group").alias("a"), F.col("id").alias("b"))
    posted = grouped.filter("id = group").select("id", "n", "parity", F.explode("prefix").alias("token"))
    sizes = common.cut(posted.groupBy("token").agg(F.count("*").alias("size"), F.min("id").alias("least")).filter("size > 1"))
    posted = common.cut(posted.join(sizes, "token"))
    common.sweep(spark)
    frequent = posted.filter(F.col("size") > PAIRED).select(F.col("least").alias("a"), F.col("id").alias("b"))
    short = posted.filter(F.col("size") <= PAIRED).select("token", "id", "n", "parity")
    other = short.select("token", *(F.col(c).alias(f"{c}2") for c in ("id", "n", "parity")))
    small, large = F.least("n", "n2"), F.greatest("n", "n2")
    apart = sum((F.bit_count(F.col("parity")[i].bitwiseXOR(F.col("parity2")[i])) for i in range(PARITY)), F.lit(0))
    # |x - y| + |y - x| = |x| + |y| - 2 |x & y|, and a linked pair has |x & y| >= t (|x| + |y|) / (1 + t)
    close = F.coalesce(apart * (100 + percent) <= (F.col("n") + F.col("n2")) * (100 - percent), F.lit(True))
    pairs = short.join(other, "token").filter((F.col("id") < F.col("id2")) & (100 * small >= percent * large) & close)
    return members.union(frequent).union(pairs.select(F.col("id").alias("a"), F.col("id2").alias("b")))


def size_class(size: Column, percent: int) -> Column:
    """Classes of set sizes such that linked sets lie in one class or in two next to each other."""
    return size if percent >= 100 else F.floor(F.log(size.cast("double")) / math.log(100 / percent)).cast("long")


def jaccard_components(docs: DataFrame, *, k: int = 5, percent: int = 80) -> DataFrame:
    """docs' doc_id with n_shingles and component_id, one row for each row of docs.

    Two documents are linked when 100 * |intersection| >= percent * |union| of
    their sets of distinct k-word shingles; component_id is the smallest doc_id
    that links reach. Sets are compared by 64-bit hashes of their shingles, so
    the join is exact but for two shingles of one hash.

    Copies of a set inside one task are represented by one of them. Sets with
    the same prefix and size form one group; groups that share a prefix shingle
    and pass the size and parity bounds are candidates; components of candidates
    are expanded to their members, and those are compared set by set, in blocks
    of one class of sizes; only blocks of one class or the next meet. In a
    component of several blocks, blocks are first connected inside and to a
    few leaders, and then only parts that are still apart are compared.

    Null, empty and word-less texts have no shingles and are linked with
    nothing; so is a null doc_id, whose component is null. Rows that share a
    doc_id share their component. An empty table gives no rows; other columns
    are not read.
    """
    spark = docs.sparkSession
    common.ship(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sig = common.cut(texts.mapInArrow(_signatures(k, percent), "doc_id long, n long, rep long, emitted long, tokens array<long>, parity array<long>"))
    rows = common.cut(sig.select("doc_id", F.col("n").alias("n_shingles"), "rep"))
    held = [sig]  # its tokens take most of the room: they go as soon as the prefixes are made
    del sig
    edges = common.cut(candidates(held.pop(), percent))
    common.sweep(spark)
    groups = common.cut(components(edges).select("id", F.col("component").alias("cand")))
    count = groups.count()
    wanted = F.broadcast(groups) if count <= common.BROADCAST_ROWS else groups
    picked = texts.join(wanted.select(F.col("id").alias("doc_id")), "doc_id", "left_semi")
    sized = picked.mapInArrow(_sets(k), "id long, hashes binary").withColumn("class", size_class(F.octet_length("hashes") / 8, percent))
    sets = common.cut(sized.join(groups, "id"))
    large = sets.groupBy("cand", "class").count().withColumn("all", F.sum("count").over(W.partitionBy("cand")))
    large = common.cut(large.filter(F.col("all") > BLOCK).select("cand", "class", F.col("count").alias("members"), F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")))
    many = large.count() > 0
    place = F.when(F.col("blocks").isNotNull(), F.struct("class", F.pmod(F.xxhash64("id"), F.col("blocks")).alias("at"))).otherwise(F.struct(F.lit(-1).cast("long").alias("class"), F.lit(0).cast("long").alias("at")))
    sets = sets.join(_small(large), ["cand", "class"], "left").withColumn("block", place)
    first = sets.select(F.struct("cand", "block").alias("task"), "id", F.col("id").alias("label"), F.lit(2).alias("side"), "hashes")
    if many:
        nth = F.row_number().over(W.partitionBy("cand", "class").orderBy("id"))  # each task keeps LEADERS rows of a class
        lead = sets.filter("blocks is not null").select("cand", "class", "id").withColumn("nth", nth).filter(F.col("nth") <= LEADERS)
        lead = lead.join(_small(large), ["cand", "class"]).filter(F.col("nth") <= F.ceil(F.col("members") * LEADERS / BLOCK))
        lead = sets.join(lead.select("cand", "id"), ["cand", "id"]).select("cand", F.col("block").alias("own"), "id", "hashes", F.explode(F.array("class", F.col("class") + 1)).alias("class"))
        lead = lead.join(_small(large), ["cand", "class"]).select("cand", "own", "id", "hashes", "class", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("at"))
        block = F.struct("class", F.col("at").cast("long").alias("at"))
        lead = lead.withColumn("block", block).filter(F.col("block") != F.col("own"))
        first = first.union(lead.select(F.struct("cand", "block").alias("task"), "id", "id", F.lit(2), "hashes"))
    links = common.cut(_compare(first, percent))
    common.sweep(spark)
    if many:
        links = links.union(common.cut(_rest(sets, links, percent)))
    same = rows.filter("doc_id != rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).distinct()
    found = components(common.cut(links.union(same)))
    found = found.select(F.col("id").alias("doc_id"), "component")
    return rows.join(found, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= common.BROADCAST_ROWS else df


def _compare(tasks: DataFrame, percent: int) -> DataFrame:
    ordered = tasks.repartition("task").sortWithinPartitions("task")
    return ordered.mapInArrow(_verified(percent), "a long, b long")


def _longs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in common.slices(batches):
        sets = [np.frombuffer(h, np.int64) for h in b.column("hashes").to_pylist()]
        yield pa.record_batch([*(b.column(c) for c in ("cand", "id", "label", "n")), pa.array(sets, pa.list_(pa.int64()))], ["cand", "id", "label", "n", "tokens"])


def _compared(percent: int):
    """The pairs of rows (a, b, x, y) whose sets x and y are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for i, j, x, y in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "x", "y")), strict=True):
                one, two = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.intersect1d(one, two, assume_unique=True).size
                if 100 * both >= percent * (one.size + two.size - both):
                    a.append(i)
                    b.append(j)
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _postings(s: DataFrame, percent: int) -> DataFrame:
    """Of members of candidate groups the shingles by which linked ones of two parts meet: cand, token, id, label, n, most.

    All shingles of a group are ordered by how many of it have them. Two sets of
    n and m that are linked share at least t * (n + m) / (1 + t), so they share
    one at a place of the first for which as many lie there and behind it: a
    shingle at place i serves to meet sets of up to `most` shingles only. A
    posting goes if no set of its list is as small as that, or all are of one
    part; what the lists of a template's own words would hold goes this way.
    """
    tokens = s.select("cand", "id", "label", "n", "hashes").mapInArrow(_longs, "cand long, id long, label long, n long, tokens array<long>").select("cand", "id", "label", "n", F.explode("tokens").alias("token"))
    shared = common.cut(tokens.groupBy("cand", "token").count().filter("count > 1"))
    held = tokens.join(shared, ["cand", "token"]).groupBy("cand", "id").agg(F.max("label").alias("label"), F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("count", "token"))).alias("held"))
    place = F.col("n") - F.size("held") + F.col("at")  # those that only this set has come first
    most = F.floor((100 + percent) * (F.col("n") - place) / percent).cast("long") - F.col("n")
    posted = held.select("cand", "id", "label", "n", "held", F.posexplode("held").alias("at", "x")).select("cand", "id", "label", "n", F.col("x.token").alias("token"), most.alias("most"))
    posted = posted.filter(100 * F.col("most") >= percent * F.col("n"))
    for _ in range(2):  # what goes may leave others without a partner
        posted = common.cut(posted)
        lists = posted.groupBy("cand", "token").agg(F.min("n").alias("least"), F.min("label").alias("one"), F.max("label").alias("other"), F.count("*").alias("size"))
        kept = common.cut(lists.filter("one < other"))
        posted = posted.drop("size").join(kept, ["cand", "token"]).filter("most >= least").select("cand", "token", "id", "label", "n", "most", "size")
    return common.cut(posted)


def _rest(sets: DataFrame, links: DataFrame, percent: int) -> DataFrame:
    """Links between the parts of large candidate groups that the first round left apart.

    A group that is connected already costs nothing more. Members of the others
    are joined pair by pair where few of them share a posted shingle; those of
    longer lists are compared in blocks, of one class of sizes or the next, and
    of one part or of several small ones. Blocks meet only if their sizes allow.
    """
    part = components(links).select("id", "component")
    s = sets.filter("blocks is not null").join(part, "id", "left").select("cand", "class", "id", "hashes", F.coalesce("component", "id").alias("label"), (F.octet_length("hashes") / 8).cast("long").alias("n"))
    parts = common.cut(s.groupBy("cand").agg(F.min("label").alias("one"), F.max("label").alias("other")).filter("one < other").select("cand"))
    s = common.cut(s.join(_small(parts), "cand", "left_semi"))
    posted = _postings(s, percent)
    short = posted.filter(F.col("size") <= PAIRED)
    other = short.select("cand", "token", *(F.col(c).alias(f"{c}2") for c in ("id", "label", "n", "most")))
    met = short.join(other, ["cand", "token"]).filter("id < id2 and label != label2 and n2 <= most and n <= most2").select(F.col("id").alias("a"), F.col("id2").alias("b")).distinct()
    one, two = s.select(F.col("id").alias("a"), F.col("hashes").alias("x")), s.select(F.col("id").alias("b"), F.col("hashes").alias("y"))
    found = met.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(_compared(percent), "a long, b long")
    long = common.cut(posted.filter(F.col("size") > PAIRED).groupBy("id").agg(F.max("most").alias("most")))
    return found.union(_in_blocks(s.join(long, "id"), percent)) if long.count() else found


def _in_blocks(s: DataFrame, percent: int) -> DataFrame:
    sizes = s.groupBy("cand", "class", "label").count()
    total = sizes.filter(F.col("count") < BLOCK).groupBy("cand", "class").agg(F.ceil(F.sum("count") / BLOCK).cast("int").alias("mixed"))
    sizes = common.cut(sizes.join(total, ["cand", "class"], "left"))
    s = s.join(_small(sizes), ["cand", "class", "label"])
    alone = F.col("count") >= BLOCK
    block = F.struct(
        "class", F.when(alone, F.col("label")).alias("only"),
        F.when(alone, F.pmod(F.xxhash64("id"), F.ceil(F.col("count") / BLOCK))).otherwise(F.pmod(F.xxhash64("label"), F.coalesce("mixed", F.lit(1)))).alias("at"),
    )
    s = common.cut(s.select("cand", "id", "label", "hashes", "n", "most", block.alias("block")))
    blocks = common.cut(s.groupBy("cand", "block").agg(F.min("n").alias("n"), F.max("most").alias("most")).withColumn("class", F.col("block.class")))
    near = blocks.select("cand", F.col("block").alias("y"), F.col("n").alias("n2"), F.col("most").alias("most2"), F.explode(F.array("class", F.col("class") - 1, F.col("class") + 1)).alias("class"))
    two = blocks.select("cand", "class", F.col("block").alias("x"), "n", "most").join(near, ["cand", "class"])
    two = two.filter((F.col("x") <= F.col("y")) & ~F.coalesce(F.col("x.only") == F.col("y.only"), F.lit(False)) & (F.col("n2") <= F.col("most")) & (F.col("n") <= F.col("most2")))
    two = common.cut(two.withColumn("task", F.struct("cand", "x", "y")))
    left = two.select("cand", F.col("x").alias("block"), "task", F.when(F.col("x") == F.col("y"), 2).otherwise(0).alias("side"))
    right = two.filter("x != y").select("cand", F.col("y").alias("block"), "task", F.lit(1).alias("side"))
    dealt = s.join(left.union(right), ["cand", "block"])
    return _compare(dealt.select("task", "id", "label", "side", "hashes"), percent)


def without_near_copies(docs: DataFrame, *, k: int = 5, percent: int = 80) -> DataFrame:
    """docs' rows, whole, with one document of each component: the one with the smallest doc_id.

    Of rows that share a doc_id and have words one stays: that of the least
    text, and of equal texts the one whose columns have the least hash, so that
    a repeated task keeps the same. Documents without words and rows without
    doc_id all stay.
    """
    found = common.cut(jaccard_components(docs, k=k, percent=percent))
    gone = found.filter("doc_id != component_id").select("doc_id").distinct()
    kept = docs.join(_small(common.cut(gone)), "doc_id", "left_anti").select(*docs.columns)
    twice = common.cut(found.filter("doc_id is not null and n_shingles > 0").groupBy("doc_id").count().filter("count > 1").select("doc_id"))
    if not twice.count():
        return kept
    return kept.join(_small(twice), "doc_id", "left_anti").select(*docs.columns).union(_first_of_each(kept.join(_small(twice), "doc_id", "left_semi").select(*docs.columns)))


def _first_of_each(rows: DataFrame) -> DataFrame:
    """One row of each doc_id, by partial aggregates."""
    columns = [F.col(f"`{c}`") for c in rows.columns]
    first = rows.groupBy(F.col("doc_id").alias("_id")).agg(F.min_by(F.struct(*columns), F.struct("text", F.xxhash64(F.to_json(F.struct(*columns))))).alias("_r"))
    return first.select("_r.*")
