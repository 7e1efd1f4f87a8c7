"""Audio features: resampling, log-mel frames as fixed-shape tensors, and energy segments with time spans."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Samples a second of the stored form and of the features.
STORED_RATE, RATE = 16000, 8000
WINDOW, HOP, MELS = 256, 128, 32
#: Frames of one tensor; a shorter last one is padded with the floor.
TENSOR_FRAMES = 64
#: Filter taps a phase, frames handled at once, and the level in dB of silence.
TAPS, BLOCK, FLOOR = 16, 4096, -100.0
#: Energies in dB at which a segment starts and ends, relative to the mean.
START_DB, END_DB = 1.0, -1.0


def wav(payload: bytes, rate: int = STORED_RATE) -> bytes:
    """8-bit mono PCM in a RIFF container; the payload's bytes are the samples."""
    pad = len(payload) % 2
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(payload) + pad, b"WAVE", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", len(payload)) + payload + b"\0" * pad


def samples(stored: bytes) -> tuple[bytes, int]:
    """The samples and the rate of an 8-bit mono RIFF file, found chunk by chunk."""
    if stored[:4] != b"RIFF" or stored[8:12] != b"WAVE":
        raise ValueError("not a RIFF WAVE file")
    at, rate = 12, 0
    while at + 8 <= len(stored):
        name, size = struct.unpack_from("<4sI", stored, at)
        if name == b"fmt ":
            kind, channels, rate, _, _, width = struct.unpack_from("<HHIIHH", stored, at + 8)
            if (kind, channels, width) != (1, 1, 8):
                raise ValueError("only 8-bit mono PCM is read")
        elif name == b"data":
            return stored[at + 8 : at + 8 + size], rate
        at += 8 + size + size % 2
    raise ValueError("no data chunk")


@cache
def _phases(up: int, down: int) -> np.ndarray:
    """A windowed-sinc low-pass filter, one row of TAPS for each of up phases."""
    n = TAPS * up
    t = np.arange(n) - (n - 1) / 2
    cut = 1 / max(up, down)
    h = up * cut * np.sinc(cut * t) * np.hamming(n)
    return np.ascontiguousarray(h.reshape(TAPS, up).T[:, ::-1]).astype(np.float32)


def resample(x: np.ndarray, up: int, down: int) -> np.ndarray:
    """x at up / down of its rate: each output sample is one phase of the filter over its own TAPS inputs."""
    bank = _phases(up, down)
    padded = np.concatenate([np.zeros(TAPS - 1, np.float32), x.astype(np.float32)])
    n = -(-x.size * up // down)
    out = np.empty(n, np.float32)
    seen = np.lib.stride_tricks.sliding_window_view(padded, TAPS)
    for first in range(min(up, n)):  # outputs first, first + up, ... use one phase and equally spaced inputs
        at = first * down
        out[first::up] = seen[at // up :: down][: out[first::up].size] @ bank[at % up]
    return out


@cache
def _mel_bank() -> np.ndarray:
    mel = np.linspace(0, 2595 * np.log10(1 + RATE / 2 / 700), MELS + 2)
    edges = 700 * (10 ** (mel / 2595) - 1) / RATE * WINDOW
    f = np.arange(WINDOW // 2 + 1)[:, None]
    rise, fall = (f - edges[:-2]) / (edges[1:-1] - edges[:-2]), (edges[2:] - f) / (edges[2:] - edges[1:-1])
    return np.maximum(0, np.minimum(rise, fall)).astype(np.float32)


_HANN = np.hanning(WINDOW + 1)[:-1].astype(np.float32)


def log_mel(x: np.ndarray) -> np.ndarray:
    """dB of MELS bands for overlapping frames of WINDOW samples every HOP; a last partial frame is padded."""
    n = max(1, -(-max(0, x.size - WINDOW) // HOP) + 1)
    padded = np.zeros((n - 1) * HOP + WINDOW, np.float32)
    padded[: x.size] = x
    frames = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::HOP]
    out = np.empty((n, MELS), np.float32)
    for at in range(0, n, BLOCK):
        power = np.abs(np.fft.rfft(frames[at : at + BLOCK] * _HANN)) ** 2
        out[at : at + BLOCK] = 10 * np.log10(power.astype(np.float32) @ _mel_bank() + 10 ** (FLOOR / 10))
    return out


def active(energy: np.ndarray) -> list[tuple[int, int]]:
    """Runs of frames by hysteresis: a run starts at START_DB above the mean and lasts until END_DB."""
    level = energy - energy.mean()
    state = np.where(level >= START_DB, 1, np.where(level < END_DB, 0, -1))
    known = np.flatnonzero(state >= 0)
    on = np.zeros(state.size, np.int8)
    if known.size:
        last = np.searchsorted(known, np.arange(state.size), "right") - 1
        on = np.where(last >= 0, state[known[np.maximum(last, 0)]], 0)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], on, [0]])))
    return list(zip(edges[0::2].tolist(), edges[1::2].tolist(), strict=True))


def features(stored: bytes) -> tuple[bytes, np.ndarray, list[tuple[float, float]]]:
    """Of a stored form its samples, tensors (n, TENSOR_FRAMES, MELS) and segments in seconds."""
    raw, rate = samples(stored)
    x = (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128
    g = np.gcd(rate, RATE)
    mel = log_mel(resample(x, RATE // g, rate // g))
    spans = [(a * HOP / RATE, b * HOP / RATE) for a, b in active(mel.mean(1))]
    short = -mel.shape[0] % TENSOR_FRAMES
    whole = np.concatenate([mel, np.full((short, MELS), FLOOR, np.float32)])
    return raw, whole.reshape(-1, TENSOR_FRAMES, MELS), spans


def payload(text: str | None) -> tuple[int, bytes]:
    """The text's UTF-8 length, and its bytes with zeros up to a positive multiple of 64."""
    raw = (text or "").encode()
    return len(raw), raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))


TENSOR = pa.fixed_shape_tensor(pa.float32(), (TENSOR_FRAMES, MELS))


def tensors(table: pa.Table, column: str = "log_mel") -> pa.Array:
    """A column of flat tensors as an Arrow fixed-shape tensor array."""
    values = table[column].combine_chunks().flatten().cast(pa.float32())
    return pa.ExtensionArray.from_storage(TENSOR, pa.FixedSizeListArray.from_arrays(values, TENSOR_FRAMES * MELS))


#: The same in half precision, as features are stored: levels of up to 128 dB keep a sixteenth.
HALF_TENSOR = pa.fixed_shape_tensor(pa.float16(), (TENSOR_FRAMES, MELS))


def pack_tensors(mel: np.ndarray, kind: pa.FixedShapeTensorType = TENSOR) -> bytes:
    """Tensors (n, TENSOR_FRAMES, MELS) with the seconds that each covers, as an Arrow stream of fixed-shape tensors."""
    step = TENSOR_FRAMES * HOP / RATE
    start = np.arange(mel.shape[0]) * step
    flat = pa.FixedSizeListArray.from_arrays(pa.array(mel.reshape(-1).astype(kind.value_type.to_pandas_dtype())), TENSOR_FRAMES * MELS)
    batch = pa.record_batch([pa.array(start), pa.array(start + step), pa.ExtensionArray.from_storage(kind, flat)], ["start", "end", "log_mel"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack_tensors(stored: bytes) -> pa.Table:
    """What pack_tensors() stored: start, end and log_mel, a fixed-shape tensor column."""
    return pa.ipc.open_stream(stored).read_all()


def _stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    common.alone("media", lambda: None)
    for b in common.slices(batches):
        own = [payload(t) for t in b.column("text").to_pylist()]
        yield pa.record_batch([b.column("_row"), pa.array([n for n, _ in own], pa.int64()), pa.array([wav(raw) for _, raw in own], pa.binary())], ["_row", "n_bytes", "media"])


def store_audio(docs: DataFrame, path: str, *keep: str) -> None:
    """Write the sound of every row of docs to a Parquet table at path: the columns keep, n_bytes and media, a WAV file.

    A text's UTF-8 bytes, with zeros up to a positive multiple of 64, are the
    samples; null is the empty text, whose payload is 64 zeros. Repeated rows
    are stored as often as they occur, an empty table writes no row, and kept
    columns called n_bytes or media are left out.
    """
    common.ship(docs.sparkSession)
    keep = tuple(c for c in keep if c not in ("n_bytes", "media"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("_row"), "text")
    out = T.StructType([*rows.select("_row").schema.fields]).add("n_bytes", "long").add("media", "binary")
    stored = rows.mapInArrow(_stored, out).select(*(F.col(f"_row.`{c}`").alias(c) for c in keep), "n_bytes", "media")
    stored.write.option("compression", "zstd").option("parquet.block.size", 16 << 20).parquet(path)


def read_audio(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


_SPAN = T.StructType().add("start", "double").add("end", "double")
_ADDED = (
    T.StructType().add("payload_bytes", "long").add("payload_sha256", "string").add("tail_crc32", "long").add("media_bytes", "long").add("media_sha256", "string")
    .add("tensors", T.ArrayType(T.ArrayType(T.FloatType()))).add("mean_level", T.ArrayType(T.FloatType())).add("segments", T.ArrayType(_SPAN))
)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib
    import zlib

    common.alone("media", lambda: None)
    span = pa.list_(pa.struct([("start", pa.float64()), ("end", pa.float64())]))
    kinds = pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.float32())), pa.list_(pa.float32()), span
    for b in common.slices(batches, 64):  # tensors are larger than texts
        out: list[list] = [[] for _ in kinds]
        for stored in b.column("media").to_pylist():
            raw, mel, spans = features(stored)
            flat = mel.reshape(mel.shape[0], -1)
            row = len(raw), hashlib.sha256(raw).hexdigest(), zlib.crc32(raw[-64:]), len(stored), hashlib.sha256(stored).hexdigest(), list(flat), mel.reshape(-1, MELS).mean(0), [{"start": s, "end": e} for s, e in spans]
            for column, value in zip(out, row, strict=True):
                column.append(value)
        yield pa.record_batch([b.column("_row"), *(pa.array(x, k) for x, k in zip(out, kinds, strict=True))], ["_row", *_ADDED.names])


def audio_features(media: DataFrame, *keep: str) -> DataFrame:
    """Of every stored sound (a column media) the columns keep and what was read back from its bytes.

    payload_bytes, payload_sha256 and tail_crc32 (of the last 64 bytes) are the
    samples', media_bytes and media_sha256 the stored form's. tensors lists the
    log-mel tensors, each TENSOR_FRAMES * MELS numbers for TENSOR_FRAMES * HOP /
    RATE seconds, the last one padded with the floor; tensor_rows() gives them
    one a row with their time spans, pack_tensors() as Arrow tensors.
    mean_level is their mean by band, segments the time spans with energy.
    Equal sounds give equal rows, an empty table none, and kept columns whose
    names clash with the added ones are left out.
    """
    common.ship(media.sparkSession)
    keep = tuple(c for c in keep if c not in _ADDED.names)
    rows = media.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("_row"), "media")
    out = T.StructType([*rows.select("_row").schema.fields, *_ADDED.fields])
    return rows.mapInArrow(_features, out).select(*(F.col(f"_row.`{c}`").alias(c) for c in keep), *_ADDED.names)


_SUMMED = ("payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "segments")
_FEATURES = T.StructType([*(f for f in _ADDED.fields if f.name in _SUMMED)]).add("tensors", "binary")
_READ = T.StructType().add("spans", T.ArrayType(_SPAN)).add("mean_level", T.ArrayType(T.FloatType())).add("log_mel_sha256", "string")
_SPANS = pa.list_(pa.struct([("start", pa.float64()), ("end", pa.float64())]))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib
    import zlib

    common.alone("media", lambda: None)
    kinds = pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), _SPANS, pa.binary()
    for b in common.slices(batches, 64):
        out: list[list] = [[] for _ in kinds]
        for stored in b.column("media").to_pylist():
            raw, mel, spans = features(stored)
            row = len(raw), hashlib.sha256(raw).hexdigest(), zlib.crc32(raw[-64:]), len(stored), hashlib.sha256(stored).hexdigest(), [{"start": s, "end": e} for s, e in spans], pack_tensors(mel, HALF_TENSOR)
            for column, value in zip(out, row, strict=True):
                column.append(value)
        yield pa.record_batch([b.column("_row"), *(pa.array(x, k) for x, k in zip(out, kinds, strict=True))], ["_row", *_FEATURES.names])


def store_features(media: DataFrame, path: str, *keep: str) -> None:
    """Write what audio_features() finds to a Parquet table at path, tensors as Arrow streams of fixed-shape tensors with their time spans.

    A row for each sound: keep, the digests of its samples and of its stored
    form, its segments, and tensors, the stream, in half precision. Nothing but
    the stream leaves a task, so a long sound is one value. Kept columns whose
    names clash with the added ones are left out.
    """
    common.ship(media.sparkSession)
    keep = tuple(c for c in keep if c not in _FEATURES.names)
    rows = media.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("_row"), "media")
    out = T.StructType([*rows.select("_row").schema.fields, *_FEATURES.fields])
    stored = rows.mapInArrow(_packed, out).select(*(F.col(f"_row.`{c}`").alias(c) for c in keep), *_FEATURES.names)
    stored.write.option("compression", "zstd").option("parquet.block.size", 16 << 20).parquet(path)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    common.alone("media", lambda: None)
    for b in common.slices(batches, 64):
        spans, levels, digests = [], [], []
        for stored in b.column("tensors").to_pylist():
            table = unpack_tensors(stored)
            if table.schema.field("log_mel").type != HALF_TENSOR:
                raise ValueError("not a stream of these tensors")
            mel = table["log_mel"].combine_chunks().to_numpy_ndarray()
            spans.append([{"start": s, "end": e} for s, e in zip(table["start"].to_pylist(), table["end"].to_pylist(), strict=True)])
            levels.append(mel.reshape(-1, MELS).mean(0, dtype=np.float32))
            digests.append(hashlib.sha256(mel.tobytes()).hexdigest())
        yield pa.record_batch([b.column("_row"), pa.array(spans, _SPANS), pa.array(levels, pa.list_(pa.float32())), pa.array(digests, pa.string())], ["_row", *_READ.names])


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """What store_features() wrote, read back: its columns but the streams, and of those spans (the seconds of each tensor), mean_level and log_mel_sha256."""
    common.ship(spark)
    stored = spark.read.parquet(path)
    rest = [c for c in stored.columns if c != "tensors"]
    rows = stored.select(F.struct(*(F.col(f"`{c}`") for c in rest)).alias("_row"), "tensors")
    out = T.StructType([*rows.select("_row").schema.fields, *_READ.fields])
    return rows.mapInArrow(_unpacked, out).select(*(F.col(f"_row.`{c}`").alias(c) for c in rest), *_READ.names)


def tensor_rows(found: DataFrame, *keep: str) -> DataFrame:
    """audio_features()' rows, a row for each tensor: keep, tensor, start and end in seconds, log_mel, and the active parts of that time."""
    step = F.lit(TENSOR_FRAMES * HOP / RATE)
    rows = found.select(*(F.col(f"`{c}`") for c in keep), "segments", F.posexplode("tensors").alias("tensor", "log_mel"))
    rows = rows.withColumns({"start": F.col("tensor") * step, "end": (F.col("tensor") + 1) * step})
    inside = F.filter("segments", lambda s: (s["start"] < F.col("end")) & (s["end"] > F.col("start")))
    active = F.transform(inside, lambda s: F.struct(F.greatest(s["start"], F.col("start")).alias("start"), F.least(s["end"], F.col("end")).alias("end")))
    return rows.select(*(F.col(f"`{c}`") for c in keep), "tensor", "start", "end", "log_mel", active.alias("active"))


def write_tensors(found: DataFrame, path: str, *keep: str) -> None:
    """audio_features()' rows as a Parquet table: keep, segments, and tensors as an Arrow stream of fixed-shape tensors with time spans."""
    common.ship(found.sparkSession)

    @F.pandas_udf("binary")
    def packed(column: pd.Series) -> pd.Series:
        return column.map(lambda x: pack_tensors(np.stack(list(x)).reshape(-1, TENSOR_FRAMES, MELS).astype(np.float32)))

    found.select(*(F.col(f"`{c}`") for c in keep), "segments", packed("tensors").alias("tensors")).write.option("compression", "zstd").parquet(path)
