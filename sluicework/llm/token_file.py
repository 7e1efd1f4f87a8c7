"""Token ids in directly addressable codes: chunk levels, continuation bitmaps and rank directories."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: Bits of each level; together they hold any 32-bit id.
WIDTHS = (8, 4, 4, 16)
#: Ids of one segment at most, but for a single longer document.
SEGMENT_IDS = 1 << 18
#: Bits between two entries of a rank directory.
RANK_STEP = 512


def _pack(values: np.ndarray, width: int) -> bytes:
    if width == 8:
        return values.astype(np.uint8).tobytes()
    if width == 16:
        return values.astype("<u2").tobytes()
    v = values.astype(np.uint8)
    if v.size % 2:
        v = np.append(v, np.uint8(0))
    return (v[0::2] | v[1::2] << 4).tobytes()


def _unpack(data: memoryview, width: int, n: int) -> np.ndarray:
    if width == 8:
        return np.frombuffer(data, np.uint8, n)
    if width == 16:
        return np.frombuffer(data, "<u2", n)
    raw = np.frombuffer(data, np.uint8)
    out = np.empty(raw.size * 2, np.uint8)
    out[0::2], out[1::2] = raw & 15, raw >> 4
    return out[:n]


def dac_encode(ids: np.ndarray) -> bytes:
    """ids as levels of chunks, low bits first.

    Level l holds the l-th chunk of every id that reaches it, a bitmap that
    says which of them go on, and after every RANK_STEP bits the number of ones
    so far; an id's place on the next level is the rank of its bit.
    """
    rest, parts = ids.astype(np.uint32), []
    for width in WIDTHS:
        if not rest.size:
            break
        chunk, high = rest & np.uint32((1 << width) - 1), rest >> np.uint32(width)
        on = high > 0
        bitmap = np.packbits(on, bitorder="little").tobytes()
        ones = np.add.reduceat(on, np.arange(0, on.size, RANK_STEP), dtype=np.uint32)
        ranks = (np.cumsum(ones, dtype=np.uint32) - ones).astype("<u4").tobytes()
        parts.append(struct.pack("<Q", rest.size) + bitmap + ranks + _pack(chunk, width))
        rest = high[on]
    return struct.pack("<B", len(parts)) + b"".join(parts)


class Dac:
    """Reads what dac_encode() wrote; get(i) touches one chunk, bit and rank per level."""

    def __init__(self, data: bytes):
        view, at = memoryview(data), 1
        self.levels = []
        for width in WIDTHS[: view[0]]:
            (n,) = struct.unpack_from("<Q", view, at)
            at += 8
            sizes = (n + 7) // 8, 4 * -(-n // RANK_STEP), {8: n, 16: 2 * n, 4: (n + 1) // 2}[width]
            spans = []
            for size in sizes:
                spans.append(view[at : at + size])
                at += size
            self.levels.append((width, n, *spans))

    def __len__(self) -> int:
        return self.levels[0][1] if self.levels else 0

    def get(self, i: int) -> int:
        value = shift = 0
        for width, _, bits, ranks, chunks in self.levels:
            chunk = chunks[i] if width == 8 else struct.unpack_from("<H", chunks, 2 * i)[0] if width == 16 else chunks[i // 2] >> 4 * (i % 2) & 15
            value |= chunk << shift
            shift += width
            if not bits[i // 8] >> i % 8 & 1:
                break
            block = i // RANK_STEP
            (rank,) = struct.unpack_from("<I", ranks, 4 * block)
            before = int.from_bytes(bits[block * RANK_STEP // 8 : i // 8 + 1], "little") & ((1 << i - block * RANK_STEP) - 1)
            i = rank + before.bit_count()
        return value

    def all(self) -> np.ndarray:
        """Every id, from the last level to the first."""
        high: np.ndarray | None = None
        for width, n, bits, _, chunks in reversed(self.levels):
            low = _unpack(chunks, width, n).astype(np.uint32)
            if high is not None:
                on = np.unpackbits(np.frombuffer(bits, np.uint8), count=n, bitorder="little").view(bool)
                low[on] |= high << np.uint32(width)
            high = low
        return np.zeros(0, np.uint32) if high is None else high


_SEGMENTS = "part int, segment int, n long, doc_ids array<bigint>, lengths array<int>, codes binary"
#: Each code stands uncompressed on a page of its own, so that a reader of one segment takes its bytes as they are.
_STORED = {"compression": "none", "parquet.block.size": str(16 << 20), "parquet.page.row.count.limit": "1", "parquet.enable.dictionary": "false"}


def _segments(path: str, end_id: int, budget: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from .encode import encoder

        one, end, part, segment = encoder(path, budget), struct.pack("<I", end_id), TaskContext.get().partitionId(), 0
        schema = pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("n", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())), ("codes", pa.binary())])
        docs, lengths, ids, n = [], [], [], 0

        def block() -> pa.RecordBatch:
            return pa.record_batch([[part], [segment], [n], [docs], [lengths], [dac_encode(np.frombuffer(b"".join(ids), "<u4"))]], schema=schema)

        for b in common.slices(batches, 2000):
            for doc, own in zip(b.column("doc_id").to_pylist(), one.encode_all(b.column("text")), strict=True):
                size = len(own) // 4 + 1
                docs.append(doc)
                lengths.append(size)
                ids += own, end
                n += size
                if n >= SEGMENT_IDS:
                    yield block()
                    docs, lengths, ids, n, segment = [], [], [], 0, segment + 1
        if docs:
            yield block()

    return run


def write_tokens(docs: DataFrame, tokenizer: str, path: str, *, end_id: int, cache_bytes: int = 160 << 20) -> None:
    """Encode whole texts and write their ids, each document's end_id last, in ascending doc_id order.

    Rows with one doc_id stand in the order of their texts, null ids come
    first, a null text is empty, and an empty table writes no segment. Rows are
    dealt by ranges of doc_id, so part and segment numbers follow the order.

    path/segments has a row for each segment: its documents, their lengths and
    the codes, uncompressed and on a page of their own. path/directory has of
    each segment the place of its first id in the whole file. Texts are dealt,
    not ids, because these, at 16 bits, take as much room compressed. A worker
    keeps cache_bytes of encoded words.
    """
    spark = docs.sparkSession
    common.ship(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    texts.mapInArrow(_segments(tokenizer, end_id, cache_bytes), _SEGMENTS).write.options(**_STORED).parquet(f"{path}/segments")
    sizes = spark.read.schema(_SEGMENTS).parquet(f"{path}/segments").select("part", "segment", "n")
    totals = sorted(tuple(r) for r in sizes.groupBy("part").agg(F.sum("n")).collect())  # a row for each task that wrote
    firsts, at = [], 0
    for part, n in totals:
        firsts.append((part, at))
        at += n
    firsts = F.broadcast(spark.createDataFrame(firsts, "part int, base long"))
    before = F.sum("n").over(Window.partitionBy("part").orderBy("segment")) - F.col("n")
    sizes.withColumn("first", before).join(firsts, "part").select("part", "segment", (F.col("base") + F.col("first")).alias("first"), "n").write.parquet(f"{path}/directory")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zlib

    for whole in batches:
        for b in common.slices([whole], 1):
            ids = memoryview(Dac(b.column("codes")[0].as_buffer()).all().astype("<u4")).cast("B")
            docs, lengths = b.column("doc_ids").flatten(), b.column("lengths").flatten().to_numpy().astype(np.int64)
            ends = np.cumsum(lengths)
            crcs = [zlib.crc32(ids[4 * a : 4 * z]) for a, z in zip((ends - lengths).tolist(), ends.tolist(), strict=True)]
            k = len(crcs)
            place = [pa.array(np.full(k, b.column(c)[0].as_py(), np.int32)) for c in ("part", "segment")]
            yield pa.record_batch([*place, docs, pa.array(ends - lengths), pa.array(lengths), pa.array(crcs, pa.int64())], ["part", "segment", "doc_id", "within", "n_tokens", "ids_crc32"])


def _directory(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("part int, segment int, first long, n long").parquet(f"{path}/directory")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """From the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    The directory, one row for each SEGMENT_IDS ids, is broadcast up to
    common.BROADCAST_ROWS rows and joined by a shuffle beyond it.
    """
    common.ship(spark)
    rows = spark.read.schema(_SEGMENTS).parquet(f"{path}/segments")
    places = _directory(spark, path)
    n = places.count()
    places = places.select("part", "segment", "first")
    docs = rows.mapInArrow(_documents, "part int, segment int, doc_id long, within long, n_tokens long, ids_crc32 long")
    return docs.join(F.broadcast(places) if n <= common.BROADCAST_ROWS else places, ["part", "segment"]).select("doc_id", (F.col("first") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def token_at(spark: SparkSession, path: str, place: int) -> int | None:
    """The id at one place of the whole file, without decoding its segment; None beyond the end.

    The directory's statistics lead to one entry of it, and that one's part and
    segment to one page of codes.
    """
    found = _directory(spark, path).filter((F.col("first") <= place) & (F.col("first") + F.col("n") > place)).collect()
    if not found or place < 0:
        return None
    part, segment, first, _ = found[0]
    rows = spark.read.schema(_SEGMENTS).parquet(f"{path}/segments")
    (row,) = rows.filter((F.col("part") == part) & (F.col("segment") == segment)).select("codes").collect()
    return Dac(bytes(row[0])).get(place - first)
