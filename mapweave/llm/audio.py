"""Chroma audio fingerprints and alignment of recordings.

A recording (mono, signed 16-bit samples) becomes frames of twelve pitch-class energies. The frames' integral image gives
any rectangle's sum from four corners; FILTERS compare such rectangles over a window of frames, each comparison is
quantised to two bits in Gray code, and the sixteen of them make one packed integer per place. To align two recordings,
seeds vote for offsets; at each offset with MIN_SEEDS votes, the longest stretch of integers with few enough bit errors is looked for,
and the longest of all offsets counts.

A seed is three integers over GAP places by their stable bits (of each filter whether it is above the middle threshold), so
that it spans several notes, and melodies that share a few notes or a held one don't meet. Of a place where the integer is the same as before there is no seed but at the recording's ends: what is
aligned changes at the same places. Joins by seed are split by Spark where a seed is common.

Recordings with equal fingerprints are one class, searched once; a query gets a row per class that it aligns with, not
per copy. Null or too short samples have no integers and match nothing (class by their own). Of rows that repeat an id the
one with the smallest fingerprint counts; a null id takes part in nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared

RATE, FRAME, HOP = 2000, 512, 64
#: Frames that a packed integer looks at.
SPAN = 12
LOW_HZ, HIGH_HZ = 55.0, 950.0
THRESHOLDS = (-0.12, 0.0, 0.12)
#: (kind, first pitch class, height, width) by rule: kinds are whole, halves by pitch, halves by time, quarters, thirds by pitch, thirds by time.
FILTERS = [(k % 6, (5 * k) % 7, 3 + k % 4, 4 + (3 * k) % 9) for k in range(16)]
GRAY = np.array([0, 1, 3, 2], np.uint32)
#: A match: integers that it has at least (64 are two seconds; unrelated melodies have stretches of up to 49 in tests), share of
#: their bits that may differ.
MIN_OVERLAP, MAX_ERRORS = 64, 0.15
#: Places from a seed's first integer to its last; seeds at one offset that a candidate has at least.
GAP, MIN_SEEDS = 24, 2
#: The high one of each filter's two bits: in Gray code it says on which side of the middle threshold the value is.
STABLE = np.uint32(0xAAAAAAAA)


@cache
def _bins() -> tuple[np.ndarray, np.ndarray]:
    hz = np.fft.rfftfreq(FRAME, 1 / RATE)
    used = np.flatnonzero((hz >= LOW_HZ) & (hz <= HIGH_HZ))
    to = np.zeros((len(used), 12))
    to[np.arange(len(used)), np.round(12 * np.log2(hz[used] / 440)).astype(int) % 12] = 1
    return used, to


def chroma(samples: np.ndarray) -> np.ndarray:
    """(frames, 12): pitch-class energies, each frame of length one."""
    if len(samples) < FRAME:
        return np.empty((0, 12))
    used, to = _bins()
    frames = np.lib.stride_tricks.sliding_window_view(samples.astype(np.float32), FRAME)[::HOP] * np.hanning(FRAME).astype(np.float32)
    energy = np.abs(np.fft.rfft(frames, axis=1)[:, used]) ** 2 @ to
    norm = np.linalg.norm(energy, axis=1, keepdims=True)
    return energy / np.where(norm > 1e-6, norm, 1)


def packed(frames: np.ndarray) -> np.ndarray:
    """One 32-bit integer per place of a SPAN of frames."""
    n = len(frames) - SPAN + 1
    if n < 1:
        return np.empty(0, np.uint32)
    image = np.zeros((len(frames) + 1, 13))
    image[1:, 1:] = frames.cumsum(axis=0).cumsum(axis=1)
    at = np.arange(n)

    def area(t0: int, t1: int, p0: int, p1: int) -> np.ndarray:
        return image[at + t1, p1] - image[at + t0, p1] - image[at + t1, p0] + image[at + t0, p0]

    out = np.zeros(n, np.uint32)
    for kind, low, height, width in FILTERS:
        high = low + height
        p, t = low + height // 2, width // 2
        p3, t3 = max(1, height // 3), max(1, width // 3)
        whole = area(0, width, low, high)
        if kind == 0:
            one, two = whole, area(0, width, 0, 12) - whole
        elif kind == 1:
            one, two = area(0, width, low, p), area(0, width, p, high)
        elif kind == 2:
            one, two = area(0, t, low, high), area(t, width, low, high)
        elif kind == 3:
            one = area(0, t, low, p) + area(t, width, p, high)
            two = whole - one
        elif kind == 4:
            one = area(0, width, low + p3, high - p3)
            two = whole - one
        else:
            one = area(t3, width - t3, low, high)
            two = whole - one
        value = np.log((1 + np.maximum(one, 0)) / (1 + np.maximum(two, 0)))
        out = out << np.uint32(2) | GRAY[np.searchsorted(THRESHOLDS, value)]
    return out


def rendered(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", notes: int = 32, seconds: float = 0.16) -> DataFrame:
    """key and pcm: a stand-in for recordings where a table has none, a melody whose notes follow from the vector."""
    length = int(seconds * RATE)
    time = np.arange(length) / RATE
    envelope = np.minimum(1, np.minimum(time, time[::-1]) * 50)
    tones = np.array([(np.sin(2 * np.pi * 110 * 2 ** (k / 12) * time) + 0.4 * np.sin(2 * np.pi * 220 * 2 ** (k / 12) * time)) * envelope * 9000 for k in range(24)])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                pcm = []
                for v in part.column(1).to_pylist():
                    x = np.nan_to_num(np.array([y or 0.0 for y in v or [0.0]], float))
                    x = np.resize(x, 2 * notes)
                    which = np.floor(np.abs(x[:notes] * 1000 + x[notes:] * 377)).astype(int) % 24
                    pcm.append(None if v is None else tones[which].astype("<i2").tobytes())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(pcm, pa.binary())], [key, "pcm"])

    data = rows.select(key, vector)
    return shared.map_arrow(data, step, f"{key} {data.schema[key].dataType.simpleString()}, pcm binary")


def fingerprints(media: DataFrame, key: str = "vec_id", pcm: str = "pcm") -> DataFrame:
    """key and fp (binary: little-endian 32-bit integers) of every recording."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [packed(chroma(np.frombuffer(x.as_py() or b"", "<i2"))).astype("<u4").tobytes() for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.binary())], [key, "fp"])

    data = media.select(key, pcm)
    return shared.map_arrow(data, step, f"{key} {data.schema[key].dataType.simpleString()}, fp binary")


def seeds(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The seeds of a fingerprint (32-bit integers) and their places."""
    if len(x) <= GAP:
        return np.empty(0, np.int64), np.empty(0, np.int32)
    stable = (x & STABLE).astype(np.uint64)
    changes = np.r_[True, stable[1:-GAP] != stable[: -GAP - 1]] if len(x) > GAP + 1 else np.ones(1, bool)
    changes[-1] = True
    at = np.flatnonzero(changes)
    keys = np.zeros(len(at), np.uint64)
    for step in (0, GAP // 2, GAP):
        own = stable[at + step] >> np.uint64(1)
        for k in range(16):
            keys = keys << np.uint64(1) | own >> np.uint64(2 * k) & np.uint64(1)
    return keys.view(np.int64), at.astype(np.int32)


def _seeds(rows: DataFrame, name: str) -> DataFrame:
    """name, seed, at."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [seeds(np.frombuffer(fp, "<u4")) for fp in batch.column(1).to_pylist()]
            ids = np.repeat(batch.column(0).to_numpy(), [len(x) for x, _ in found])
            many = [np.concatenate([x[k] for x in found]) if found else np.empty(0, t) for k, t in ((0, np.int64), (1, np.int32))]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids, *many)], [name, "seed", "at"])

    return shared.map_arrow(rows, step, f"{name} long, seed long, at int")


def stretch(a: np.ndarray, b: np.ndarray, offset: int) -> tuple[int, int, float]:
    """First place in a, length and share of differing bits of the longest stretch with at most MAX_ERRORS, if place i of a
    is place i + offset of b; the first of equals."""
    low, high = max(0, -offset), min(len(a), len(b) - offset)
    if high <= low:
        return 0, 0, 1.0
    errors = np.bitwise_count(a[low:high] ^ b[low + offset : high + offset]).astype(np.int64)
    sums = np.r_[0, np.cumsum(100 * errors - round(3200 * MAX_ERRORS))]  # a stretch is good if its sum isn't above zero
    least_after = np.minimum.accumulate(sums[::-1])[::-1]
    ends = np.searchsorted(least_after, np.maximum.accumulate(sums), side="right") - 1
    sizes = np.where(sums == np.maximum.accumulate(sums), ends - np.arange(len(sums)), 0)
    begin = int(sizes.argmax())
    size = int(sizes[begin])
    return low + begin, size, float(errors[begin : begin + size].sum()) / (32 * size) if size else 1.0


def best(a: np.ndarray, b: np.ndarray, offsets: list[int]) -> tuple[int, int, int, float]:
    """Offset, first place, length and share of errors of the longest stretch; of equals that with the fewest errors, then the smallest offset."""
    found = [(offset, *stretch(a, b, offset)) for offset in offsets]
    return min(found, key=lambda x: (-x[2], x[3], abs(x[0]), x[0]))


def searched(media: DataFrame, key: str = "vec_id", every: int = 50) -> DataFrame:
    """Rows of kind member (every recording with its class_id, the smallest id with the same fingerprint) and of kind
    match: a query (id divisible by `every`) with the class of other recordings that it aligns with: offset, start (in the
    query), overlap, bit_errors."""
    rows = fingerprints(media.where(F.col(key).isNotNull()), key).select(F.col(key).cast("long").alias("id"), "fp").groupBy("id").agg(F.min("fp").alias("fp"))
    rows = shared.materialize(rows, "chroma")
    classes = shared.materialize(rows.where(F.length("fp") > 0).groupBy("fp").agg(F.min("id").alias("class_id")), "classes")
    members = rows.join(classes, "fp", "left").select("id", F.coalesce("class_id", "id").alias("class_id"), F.length("fp").alias("bytes"))
    members = shared.materialize(members, "members")
    queries = members.where((F.col("id") % every == 0) & (F.col("bytes") > 0))
    asked = shared.materialize(queries.select("class_id").distinct().join(classes, "class_id").select(F.col("class_id").alias("q"), "fp"), "asked")
    left, right = _seeds(asked, "q").withColumnRenamed("at", "q_at"), _seeds(classes.select("class_id", "fp"), "c")
    votes = left.join(right, "seed").where("q <> c").groupBy("q", "c", (F.col("at") - F.col("q_at")).alias("offset")).agg(F.count(F.lit(1)).alias("seeds"))
    offsets = votes.where(F.col("seeds") >= MIN_SEEDS).groupBy("q", "c").agg(F.collect_list("offset").alias("offsets"))
    both = offsets.join(asked.select("q", F.col("fp").alias("x")), "q").join(classes.select(F.col("class_id").alias("c"), F.col("fp").alias("y")), "c")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [best(np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4"), o) for x, y, o in zip(*(batch.column(c).to_pylist() for c in ("x", "y", "offsets")), strict=True)]
            columns = list(zip(*found, strict=True)) or [()] * 4
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.float64())
            out = pa.RecordBatch.from_arrays([batch.column("q"), batch.column("c"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["q", "c", "offset", "start", "overlap", "bit_errors"])
            yield out.filter(pa.array([x[2] >= MIN_OVERLAP for x in found], pa.bool_()))

    matches = shared.map_arrow(both.select("q", "c", "offsets", "x", "y"), verify, "q long, c long, offset int, start int, overlap int, bit_errors double")
    of_queries = queries.select("id", F.col("class_id").alias("q")).join(matches, "q").select(F.lit("match").alias("kind"), "id", F.col("c").alias("class_id"), "offset", "start", "overlap", "bit_errors")
    none = F.lit(None).cast("int")
    own = members.select(F.lit("member").alias("kind"), "id", "class_id", none.alias("offset"), none.alias("start"), none.alias("overlap"), F.lit(None).cast("double").alias("bit_errors"))
    return own.union(of_queries).withColumnRenamed("id", key)
