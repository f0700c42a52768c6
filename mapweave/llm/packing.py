"""Best-fit packing of token sequences by the sum-of-squares rule.

Documents longer than the capacity are cut into full pieces and a rest; every piece but a full one is placed in the
open sequence (or a new one) for which the sum, over all gaps, of the squared number of open sequences with that gap
becomes smallest; among equals the tightest fit wins. Pieces are dealt by a hash of their row into chunks of a bounded
number of pieces; each chunk is packed in one task, so neither the memory nor the time of a task grows with the input.
Small pieces in the order they come after large ones by size leave about one sequence of a chunk unfilled.

Null texts count as empty: their only id is the end id. Rows that repeat are
packed as often as they come. A null doc_id is kept as it is.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe, shared

CAPACITY = 2048
#: Pieces packed together in one task.
CHUNK = 24_000
#: Bytes of texts that are encoded together.
SLICE = 1 << 20


def sum_of_squares(sizes: np.ndarray, capacity: int, order: np.ndarray) -> np.ndarray:
    """Bin of each item (1 to capacity) when they are placed in this order."""
    bins = np.empty(len(sizes), np.int64)
    n_open = [0] * (capacity + 1)
    taking = np.full(capacity + 1, 1 << 40, np.int64)  # what taking a bin with this gap adds to the sum of squares
    taking[capacity] = 0  # a new bin
    giving = np.ones(capacity + 1, np.int64)  # what one more bin with this gap adds
    giving[0] = 0
    held: list[list[int]] = [[] for _ in range(capacity + 1)]
    n_bins = 0

    def count(gap: int, by: int) -> None:
        n = n_open[gap] = n_open[gap] + by
        taking[gap] = 1 - 2 * n if n else 1 << 40
        giving[gap] = 1 + 2 * n

    for at, size in zip(order.tolist(), sizes[order].tolist(), strict=True):
        gap = size + int((taking[size:] + giving[: capacity + 1 - size]).argmin())
        if gap == capacity:
            which, n_bins = n_bins, n_bins + 1
        else:
            which = held[gap].pop()
            count(gap, -1)
        bins[at] = which
        if left := gap - size:
            held[left].append(which)
            count(left, 1)
    return bins


def pack(sizes: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item (0 to capacity). Of three orders, that which needs the fewest bins counts."""
    items = np.flatnonzero((sizes > 0) & (sizes < capacity))
    rest = sizes[items]
    down = np.argsort(-rest, kind="stable")
    large = rest > capacity // 7
    orders = [down, np.concatenate([down[: large.sum()], np.flatnonzero(~large)]), np.concatenate([np.flatnonzero(large), down[large.sum() :]])]
    best = min((sum_of_squares(rest, capacity, x) for x in orders), key=lambda b: b.max(initial=-1))
    bins = np.zeros(len(sizes), np.int64)
    bins[items] = best
    full, used = np.flatnonzero(sizes == capacity), int(best.max(initial=-1)) + 1
    bins[full] = used + np.arange(len(full))
    by_bin = np.lexsort((sizes == 0, bins))  # empty ones last within a bin
    before = np.cumsum(sizes[by_bin]) - sizes[by_bin]
    first = np.r_[True, bins[by_bin][1:] != bins[by_bin][:-1]] if len(sizes) else np.zeros(0, bool)
    offsets = np.empty(len(sizes), np.int64)
    offsets[by_bin] = before - np.maximum.accumulate(np.where(first, before, 0))
    return bins, offsets


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of the pieces of every text: its ids, then end_id."""
    tail = end_id.to_bytes(4, "little")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = bpe.encoder(vocabulary)
        for part in shared.slices(batches, "text", SLICE):
            keys, columns = [], ([], [], [], [])
            for at, ids in enumerate(tool.encode_batch([t or "" for t in part.column("text").to_pylist()])):
                ids += tail
                for k, begin in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[begin : begin + 4 * capacity]
                    keys.append(at)
                    for to, value in zip(columns, (k, begin // 4, len(own) // 4, zlib.crc32(own)), strict=True):
                        to.append(value)
            yield pa.RecordBatch.from_arrays([
                part.column("key").take(pa.array(keys, pa.int64())),
                pa.array(columns[0], pa.int32()),
                *(pa.array(x, pa.int64()) for x in columns[1:]),
            ], ["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col("doc_id").alias("key"), "text")
    kind = rows.schema["key"].dataType.simpleString()
    return shared.map_arrow(rows, step, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def packed(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, chunk: int = CHUNK) -> DataFrame:
    """One row per piece with its sequence and its place there."""
    cut = shared.materialize(pieces(docs, vocabulary, capacity).withColumn("_row", F.monotonically_increasing_id()), "pieces")
    n_chunks = max(1, -(-cut.count() // chunk))
    cut = cut.withColumn("_chunk", F.pmod(F.xxhash64("_row"), F.lit(n_chunks)).cast("long"))

    def place(key, rows):
        bins, offsets = pack(rows["length"].to_numpy(), capacity)
        rows["sequence_id"] = (int(key[0]) << 32) + bins
        rows["offset"] = offsets
        return rows.drop(columns=["_row", "_chunk"])

    kind = cut.schema["doc_id"].dataType.simpleString()
    return cut.groupBy("_chunk").applyInPandas(place, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
