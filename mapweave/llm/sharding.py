"""Sharding over a fixed number of virtual slots.

Every record hashes to one of SLOTS virtual slots. The bytes of each slot are aggregated; a versioned map gives each
slot a shard so that the shards' bytes are near equal, and rebalancing edits that map only: a new version moves as few
slots as needed, and no record is hashed anew. The map and the slots' sizes have SLOTS rows whatever the input, so they
alone come to the driver; later runs read the last version from its folder and edit that. Places within a shard are gapless: each slot's records are numbered on their own, after the
records of the shard's earlier slots.

Null texts count as empty (size 8, CRC 0). Null doc_ids hash like a value; rows that repeat get places of their own.
An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import shared

SLOTS = 4096


def first_map(sizes: dict[int, int], shards: int, slots: int = SLOTS) -> list[int]:
    """Version 0: the largest slot goes to the emptiest shard."""
    heap = [(0, 0, shard) for shard in range(shards)]
    out = [0] * slots
    for slot in sorted(range(slots), key=lambda s: (-sizes.get(s, 0), s)):
        total, count, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (total + sizes.get(slot, 0), count + 1, shard))
    return out


def edited_map(old: list[int], sizes: dict[int, int], shards: int) -> list[int]:
    """The next version: slots move one at a time from the fullest shard to the emptiest while that evens them out."""
    out, totals = list(old), [0] * shards
    members: list[set[int]] = [set() for _ in range(shards)]
    for slot, shard in enumerate(out):
        totals[shard] += sizes.get(slot, 0)
        members[shard].add(slot)
    while True:
        most, least = max(range(shards), key=totals.__getitem__), min(range(shards), key=totals.__getitem__)
        gap = totals[most] - totals[least]
        fits = [s for s in members[most] if 0 < sizes.get(s, 0) < gap]
        if not fits:
            return out
        slot = min(fits, key=lambda s: (abs(gap - 2 * sizes[s]), s))
        out[slot] = least
        members[most].remove(slot)
        members[least].add(slot)
        totals[most] -= sizes[slot]
        totals[least] += sizes[slot]


_MAP = "vslot int, shard int, bytes long"


def versions(spark: SparkSession, folder: str) -> list[int]:
    """The versions of the map that the folder has, in order. A version counts once it is written as a whole."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(path):
        return []
    names = [x.getPath().getName() for x in store.listStatus(path) if store.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(x.getPath(), "_SUCCESS"))]
    return sorted(int(x.removeprefix("version=")) for x in names if x.startswith("version="))


def read_map(spark: SparkSession, folder: str, version: int) -> DataFrame:
    """vslot, shard and the bytes that the slot had when the version was made."""
    return spark.read.schema(_MAP).parquet(f"{folder}/version={version}")


def rebalanced(spark: SparkSession, folder: str, sizes: dict[int, int], shards: int, slots: int = SLOTS) -> tuple[int, list[int], int]:
    """The version that holds from now on, its shard for each slot, and how many slots moved.

    Without a version the first is made; else the last is edited for the slots' present bytes and number of shards, and
    stored as a new version if any slot moves. No record is hashed anew.
    """
    known = versions(spark, folder)
    old = None
    if known:
        held = {r["vslot"]: r["shard"] for r in read_map(spark, folder, known[-1]).collect()}  # one row a slot
        old = [held[s] for s in range(slots)]
    new = first_map(sizes, shards, slots) if old is None else edited_map(old, sizes, shards)
    moved = 0 if old is None else sum(a != b for a, b in zip(old, new, strict=True))
    if old is not None and not moved:
        return known[-1], old, 0
    version = known[-1] + 1 if known else 0
    rows = spark.createDataFrame([(slot, shard, sizes.get(slot, 0)) for slot, shard in enumerate(new)], _MAP)
    rows.coalesce(1).write.mode("overwrite").parquet(f"{folder}/version={version}")
    return version, new, moved


def sharded(docs: DataFrame, shards: int = 24, slots: int = SLOTS, folder: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot (place in the shard), grown_shard, map_version.

    folder: where the map's versions are kept; a later call with the same folder edits the last one. Without it the map is
    made anew and lives as long as the session.
    """
    spark = docs.sparkSession
    if folder is None:
        folder = f"{shared.shared_folder(spark)}/slot-map-{uuid.uuid4().hex}"
        shared.forget_later(spark, folder)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    rows = rows.withColumn("vslot", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(slots)).cast("int"))
    rows = shared.materialize(rows, "sizes")
    stats = {r["vslot"]: (r["bytes"], r["n"]) for r in rows.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).collect()}
    sizes = {slot: x[0] for slot, x in stats.items()}
    version, shard_of, _ = rebalanced(spark, folder, sizes, shards, slots)
    taken, base = [0] * shards, []
    for slot, shard in enumerate(shard_of):
        base.append((slot, taken[shard]))
        taken[shard] += stats.get(slot, (0, 0))[1]
    current = read_map(spark, folder, version).select("vslot", "shard")
    places = current.join(F.broadcast(spark.createDataFrame(base, "vslot int, base long")), "vslot")
    number = F.row_number().over(Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size"))
    return rows.withColumn("_n", number).join(F.broadcast(places), "vslot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("base") + F.col("_n") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), F.lit(version).alias("map_version"))
