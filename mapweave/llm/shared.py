"""What the operators share: tables in the cluster's shared folder, Arrow batches, ids of words."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

_WRITTEN: dict[str, SparkSession] = {}
_LOCAL: dict[str, str] = {}
#: Per operator how to free the tools that a worker process keeps.
OWNED: dict[str, Callable[[], None]] = {}
#: Modules whose steps need no tools of others.
WITHOUT_TOOLS = ("substrings", "simhash", "components")
#: Bytes of one Arrow batch sent to a Python worker.
BATCH_BYTES = 4 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: spark.checkpoint.dir, else (local tests only) a folder of this machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if "root" not in _LOCAL:
            _LOCAL["root"] = tempfile.mkdtemp(prefix="mapweave-")
        root = _LOCAL["root"]
    return _with_scheme(spark, root.rstrip("/"))


def _with_scheme(spark: SparkSession, path: str) -> str:
    """The path as Spark reads it: one without a scheme is in the default file system."""
    if "://" in path:
        return path
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    whole = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(target).toString()
    return whole.replace("file:/", "file:///", 1) if whole.startswith("file:/") and not whole.startswith("file:///") else whole


def _delete(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _clean() -> None:
    for path, spark in _WRITTEN.items():
        _delete(spark, path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df once to the shared folder and read it back: the lineage ends there and lost executors lose nothing."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN[path] = spark
    out = spark.read.schema(df.schema).parquet(path)
    out._mapweave_path = path
    return out


def forget_later(spark: SparkSession, path: str) -> None:
    """Delete path when the driver's Python ends."""
    _WRITTEN[path] = spark


def release(*tables: DataFrame) -> None:
    """Delete tables made by materialize() that no later step reads."""
    for df in tables:
        path = getattr(df, "_mapweave_path", None)
        if path and _WRITTEN.pop(path, None) is not None:
            _delete(df.sparkSession, path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of one slice have about max_bytes together; a longer text is alone."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        begin, total = 0, 0
        for at, size in enumerate(sizes):
            if at > begin and total + size > max_bytes:
                yield batch.slice(begin, at - begin)
                begin, total = at, 0
            total += size
        if begin < len(sizes):
            yield batch.slice(begin)


def map_arrow(df: DataFrame, step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow with batches bounded in bytes, so that long texts don't add up. A worker that waits for its next task holds no
    freed memory, and after steps without tools none of any operator's."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    owner = step.__module__.rpartition(".")[2]

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if owner in WITHOUT_TOOLS:
            TwoGenerations.only(owner)
        yield from step(batches)
        if owner in WITHOUT_TOOLS and owner in OWNED:
            OWNED[owner]()
        trim()

    return df.mapInArrow(whole, schema)


def trim() -> None:
    """Give the system back what Arrow and the C library keep of freed memory."""
    with contextlib.suppress(Exception):
        pa.default_memory_pool().release_unused()
        ctypes.CDLL(None).malloc_trim(0)


_BLANK = bytes(c in b" \t\n\v\f\r" for c in range(256))
#: The lowest 0 to 8 bytes of a 64-bit integer.
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def split_words(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The texts' bytes one after the other, begins and ends of their words (runs without ASCII white space), and how many each text has."""
    raw = b"\n".join([*texts, b""])
    blank = np.frombuffer(raw.translate(_BLANK), np.bool_)
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if len(raw) and not blank[0]:
        edges = np.r_[0, edges]
    begins, ends = edges[::2], edges[1::2]
    until = np.searchsorted(begins, np.cumsum([len(x) + 1 for x in texts], dtype=np.int64))
    return raw, begins, ends, np.diff(np.r_[0, until])


def distinct_words(raw: bytes, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of different words among these, and for each word its place among those. Words of up to 16 bytes are told apart by
    these bytes, longer ones by a number of each; if two of them have the same hash, all are sorted by these instead."""
    padded = np.frombuffer(raw + bytes(16), np.uint8)
    eight = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
    sizes = ends - begins
    low = eight[begins] & _MASKS[np.minimum(sizes, 8)]
    high = np.where(sizes > 8, eight[np.minimum(begins + 8, len(raw))] & _MASKS[np.clip(sizes - 8, 0, 8)], np.uint64(0))
    long = np.flatnonzero(sizes > 16)
    if len(long):
        seen: dict[bytes, int] = {}
        low[long] = [seen.setdefault(raw[b:e], len(seen)) for b, e in zip(begins[long].tolist(), ends[long].tolist(), strict=True)]
        high[long] = 0
    mixed = (low ^ low >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15) ^ (high + sizes.astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(29)
    _, first, which = np.unique(mixed, return_index=True, return_inverse=True)
    of = first[which]
    if not ((low == low[of]) & (high == high[of]) & (sizes == sizes[of])).all():
        _, first, which = np.unique(np.stack([low, high, sizes.astype(np.uint64)]), axis=1, return_index=True, return_inverse=True)
    return first, which.ravel()


def rows_of(values: np.ndarray, begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The values at begins, begins + 1 and so on, as many of each as counts says, one after the other."""
    total = np.cumsum(counts)
    return values[np.repeat(begins - total + counts, counts) + np.arange(total[-1] if len(total) else 0)]


class TwoGenerations:
    """A bounded memo: when the young half is full it becomes the old one, and what is used again moves over."""

    _last = ""

    def __init__(self, limit: int) -> None:
        self.limit, self.young, self.old = limit, {}, {}

    @staticmethod
    def only(owner: str) -> None:
        """Free what other operators keep: a worker process serves one after the other."""
        if TwoGenerations._last == owner:
            return
        TwoGenerations._last = owner
        for name, clear in OWNED.items():
            if name != owner:
                clear()
        gc.collect()
        trim()

    def turn(self) -> None:
        if len(self.young) >= self.limit:
            self.young, self.old = {}, self.young

    def missing(self, keys: set) -> set:
        """Keys that neither half holds; what the old half holds moves to the young one."""
        self.turn()
        need = keys - self.young.keys()
        if self.old:
            for key in need & self.old.keys():
                self.young[key] = self.old[key]
            need -= self.young.keys()
        return need
