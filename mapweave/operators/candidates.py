"""Candidate pairs: exact cosine top-k of every node within its pools, then one record per unordered pair.

Both ways give the same rows. by_sql() says what is meant in plain expressions. by_blocks() is the one to run: vectors are
packed into blocks of BLOCK_BYTES, once, as matrices; each pair of blocks is one cell of a grid, in which tiles of TILE rows
are multiplied and the best k of each row kept, and a window merges the cells. A vector is sent once for each block, so n
vectors of d numbers travel n * d * 8 / BLOCK_BYTES times; memory is bounded by two blocks and a tile.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mapweave.functions import text as T
from mapweave.operators.upsert import latest
from mapweave.schemas import Settings

BLOCK_BYTES = 32 << 20
#: Rows of a tile, and of the other side's.
TILE, WIDE = 512, 4096
_SCORED = "a_id string, b_id string, pool string, score double"


def targets(nodes: DataFrame, settings: Settings) -> DataFrame:
    """id, framework, doc, v of the mappable nodes with a vector."""
    good = F.col("node_type").isin(*settings.mappable_types) & (F.size("embedding") > 0)
    return nodes.where(good).select("id", "framework", F.col("extra")["doc"].alias("doc"), T.unit("embedding").alias("v"))


def assert_one_space(nodes: DataFrame) -> None:
    """All vectors come from one model and have one size."""
    found = nodes.where(F.size("embedding") > 0).agg(F.collect_set(F.size("embedding")).alias("dims"), F.collect_set("embedding_model").alias("models")).first()
    if len(found["dims"]) > 1 or len(found["models"]) > 1:
        raise ValueError(f"mixed embeddings: sizes {sorted(found['dims'])}, models {sorted(found['models'])}")


def _pool(settings: Settings, cross: bool) -> Column:
    intra = F.col("a.framework").isin(*settings.intra) if settings.intra else F.lit(False)
    same = intra & (F.col("a.framework") == F.col("b.framework")) & ~F.col("a.doc").eqNullSafe(F.col("b.doc"))
    other = (F.col("a.framework") != F.col("b.framework")) & F.lit(cross)
    return F.when(other, "cross").when(same, "intra")


def by_sql(rows: DataFrame, settings: Settings, cross: bool = True) -> DataFrame:
    """a_id, b_id, pool, score of the best k of each node and pool, floors not yet applied."""
    scored = rows.alias("a").join(rows.alias("b"), _pool(settings, cross).isNotNull()).select(
        F.col("a.id").alias("a_id"), F.col("b.id").alias("b_id"), _pool(settings, cross).alias("pool"), T.dot(F.col("a.v"), F.col("b.v")).alias("score"))
    return _best(scored, settings)


def _best(scored: DataFrame, settings: Settings) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("a_id", "pool").orderBy(F.desc("score"), "b_id"))
    k = F.when(F.col("pool") == "cross", settings.k).otherwise(settings.intra_k)
    return scored.withColumn("_rank", rank).where(F.col("_rank") <= max(settings.k, settings.intra_k)).where(F.col("_rank") <= k).drop("_rank")


def _packed(rows: DataFrame, n_blocks: int) -> DataFrame:
    """block, ids, frameworks, docs (in the order of the ids) and the vectors as one matrix of doubles, `width` numbers each."""

    def pack(table: pa.Table) -> pa.Table:
        table = table.take(pc.sort_indices(table, [("id", "ascending")]))
        vectors = table.column("v").combine_chunks()
        sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
        matrix = np.zeros((len(sizes), int(sizes.max())))
        matrix[np.arange(matrix.shape[1]) < sizes[:, None]] = pc.list_flatten(vectors).to_numpy()
        cell = {c: [table.column(c).to_pylist()] for c in ("id", "framework", "doc")}
        return pa.table({"block": table.column("block").slice(0, 1), "ids": pa.array(cell["id"], pa.list_(pa.string())), "frameworks": pa.array(cell["framework"], pa.list_(pa.string())), "docs": pa.array(cell["doc"], pa.list_(pa.string())), "width": pa.array([matrix.shape[1]], pa.int32()), "matrix": pa.array([matrix.tobytes()], pa.binary())})

    dealt = rows.select("id", "framework", "doc", "v", F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("long").alias("block"))
    return dealt.groupBy("block").applyInArrow(pack, "block long, ids array<string>, frameworks array<string>, docs array<string>, width int, matrix binary")


def _best_of(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the k highest scores of each row above minus infinity; of equal ones the first columns."""
    k = min(k, scores.shape[1])
    floor = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k] if k else np.full(len(scores), np.inf)
    row, column = np.nonzero((scores >= floor[:, None]) & (scores > -np.inf))
    order = np.lexsort((column, -scores[row, column], row))
    row, column = row[order], column[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    return row[rank < k], column[rank < k]


def by_blocks(rows: DataFrame, settings: Settings, cross: bool = True, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """As by_sql()."""
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("v")), F.lit(1)).alias("width")).first()
    n_blocks = max(1, -(-size["n"] * size["width"] * 8 // block_bytes))
    packed = _packed(rows, n_blocks)
    left = packed.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))).alias("other"), F.struct("ids", "frameworks", "docs", "width", "matrix").alias("left"))
    met = left.join(packed.select(F.col("block").alias("other"), F.struct("ids", "frameworks", "docs", "width", "matrix").alias("right")), "other")
    k_cross, k_intra, intra = settings.k, settings.intra_k, set(settings.intra)

    def unpacked(cell: pa.StructScalar) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        lists = [cell[c].values.to_numpy(zero_copy_only=False) for c in ("ids", "frameworks", "docs")]
        return *lists, np.frombuffer(cell["matrix"].as_buffer(), float).reshape(len(lists[0]), -1)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                a_ids, a_fw, a_doc, a = unpacked(batch.column(0)[at])
                b_ids, b_fw, b_doc, b = unpacked(batch.column(1)[at])
                width = min(a.shape[1], b.shape[1])
                for top in range(0, len(a), TILE):
                    own = slice(top, top + TILE)
                    held: dict[str, tuple[list, list, list]] = {"cross": ([], [], []), "intra": ([], [], [])}
                    for first in range(0, len(b), WIDE):
                        those = slice(first, first + WIDE)
                        scores, same = a[own, :width] @ b[those, :width].T, a_fw[own, None] == b_fw[None, those]
                        pools = [("cross", k_cross, ~same)] if cross else []
                        if intra:
                            pools.append(("intra", k_intra, same & np.isin(a_fw[own], list(intra))[:, None] & (a_doc[own, None] != b_doc[None, those])))
                        for pool, k, allowed in pools:
                            row, column = _best_of(np.where(allowed, scores, -np.inf), k)
                            for to, x in zip(held[pool], (row, column + first, scores[row, column]), strict=True):
                                to.append(x)
                    for pool, parts in held.items():
                        if parts[0]:
                            row, column, score = (np.concatenate(x) for x in parts)
                            yield pa.RecordBatch.from_arrays([pa.array(a_ids[own][row], pa.string()), pa.array(b_ids[column], pa.string()), pa.array([pool] * len(row), pa.string()), pa.array(score)], ["a_id", "b_id", "pool", "score"])

    return _best(met.select("left", "right").mapInArrow(step, _SCORED), settings)


def pairs_of(best: DataFrame, settings: Settings) -> DataFrame:
    """a_id, b_id, score: floors on the raw score, then the best record of each unordered pair, rounded once."""
    floor = F.when(F.col("pool") == "cross", settings.floor).otherwise(settings.intra_floor)
    good = best.where(F.col("score") >= floor)
    return good.groupBy(F.least("a_id", "b_id").alias("a_id"), F.greatest("a_id", "b_id").alias("b_id")).agg(F.round(F.max("score"), 4).alias("score"))


def candidates(nodes: DataFrame, settings: Settings, cross: bool = True) -> DataFrame:
    """The pair records, best first. With fewer than two frameworks and no intra pool there are none."""
    rows = targets(nodes, settings)
    pairs = pairs_of(by_blocks(rows, settings, cross), settings)
    return described(pairs, nodes).orderBy(F.desc("score"), "a_id", "b_id")


def described(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """pairs with framework, reference, title and intent of both sides, the lower (framework, id) first; of nodes that
    repeat an id the last counts."""
    facts = _last(nodes, "framework", F.col("native_ref").alias("ref"), "title", "canonical_intent")
    facts = facts.select("id", F.struct("id", "framework", "ref", "title", "canonical_intent").alias("_n"))
    both = pairs.join(facts.toDF("a_id", "_a"), "a_id").join(facts.toDF("b_id", "_b"), "b_id")
    swap = (F.col("_a.framework") > F.col("_b.framework")) | ((F.col("_a.framework") == F.col("_b.framework")) & (F.col("_a.id") > F.col("_b.id")))
    side = both.select("score", F.when(swap, F.col("_b")).otherwise(F.col("_a")).alias("_a"), F.when(swap, F.col("_a")).otherwise(F.col("_b")).alias("_b"))
    return side.select("score", *(F.col(f"_{s}.{c}").alias(f"{s}_{c}") for s in "ab" for c in ("id", "framework", "ref", "title", "canonical_intent")))


def _last(nodes: DataFrame, *columns: Column | str) -> DataFrame:
    seq = "seq" if "seq" in nodes.columns else None
    return latest(nodes.select("id", *columns, *([seq] if seq else [])), ["id"], seq)


def grounded(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """pairs with the verbatim text of both sides, cut at the limit; an unknown node gives an empty text."""
    texts = _last(nodes, "raw_text")
    out = pairs.join(texts.toDF("a_id", "a_text"), "a_id", "left").join(texts.toDF("b_id", "b_text"), "b_id", "left")
    return out.withColumns({c: T.shortened(F.coalesce(c, F.lit(""))) for c in ("a_text", "b_text")})


def selected(pairs: DataFrame, frameworks: list[str] | None = None, pair_class: str = "any", ref_prefix: str | None = None) -> DataFrame:
    """Pairs of which either side is in the frameworks, of a class (any, cross, intra), or with a reference prefix."""
    if frameworks:
        pairs = pairs.where(F.col("a_framework").isin(*frameworks) | F.col("b_framework").isin(*frameworks))
    if pair_class == "cross":
        pairs = pairs.where("a_framework <> b_framework")
    elif pair_class == "intra":
        pairs = pairs.where("a_framework = b_framework")
    elif pair_class != "any":
        raise ValueError(f"unknown pair class {pair_class!r}")
    if ref_prefix:
        pairs = pairs.where(F.col("a_ref").startswith(ref_prefix) | F.col("b_ref").startswith(ref_prefix))
    return pairs


def batched(pairs: DataFrame, size: int, prefix: str = "batch") -> DataFrame:
    """pairs with batch_no (from 1) and batch: so many consecutive pairs each, best score first, ties by ids.

    Scores have four decimals, so there are at most 20,001 of them: their counts say where each begins, and only pairs of
    one score are numbered together.
    """
    counts = pairs.groupBy("score").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1))
    begins = counts.select("score", F.coalesce(before, F.lit(0)).alias("_begin"))
    rank = F.row_number().over(Window.partitionBy("score").orderBy("a_id", "b_id")) - 1
    out = pairs.withColumn("_in", rank).join(F.broadcast(begins), "score")
    out = out.withColumn("batch_no", (F.floor((F.col("_begin") + F.col("_in")) / size) + 1).cast("long"))
    return out.withColumn("batch", T.batch_name(F.col("batch_no"), prefix)).drop("_in", "_begin")
