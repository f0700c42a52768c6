"""Last-wins snapshots in place of MERGE."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest(rows: DataFrame, keys: list[str], seq: str | None = None) -> DataFrame:
    """Per key the row with the highest seq, without seq; one partial aggregate, no sort.

    Without a seq the row that is the greatest as JSON, so that the same rows in any order give the same result.
    """
    rest = [c for c in rows.columns if c not in {*keys, seq}]
    if not rest:
        return rows.select(*keys).distinct()
    order = F.col(seq) if seq else F.to_json(F.struct(*rest))
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return best.select(*keys, *(F.col("_row")[c].alias(c) for c in rest))


def unique(nodes: DataFrame) -> DataFrame:
    """One row per node id: the last by `seq`, where readers have put that column."""
    return latest(nodes, ["id"], "seq" if "seq" in nodes.columns else None)


def upserted(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old with the rows of new put over them; nulls of new count, and maps keep what new doesn't name."""
    maps = [f.name for f in old.schema if f.dataType.typeName() == "map"]
    if not maps:
        both = old.withColumn("_seq", F.lit(0)).unionByName(new.withColumn("_seq", F.lit(1)))
        return latest(both, keys, "_seq")
    renamed = new.select(*keys, *(F.col(c).alias(f"_new_{c}") for c in new.columns if c not in keys), F.lit(True).alias("_is_new"))
    joined = old.withColumn("_is_old", F.lit(True)).join(renamed, keys, "full_outer")
    columns = []
    for c in old.columns:
        if c in keys:
            columns.append(F.col(c))
        elif c in maps:
            both = F.map_concat(F.map_filter(F.col(c), lambda k, _: ~F.array_contains(F.map_keys(f"_new_{c}"), k)), F.col(f"_new_{c}"))
            columns.append(F.when(F.col(c).isNull(), F.col(f"_new_{c}")).when(F.col(f"_new_{c}").isNull(), F.col(c)).otherwise(both).alias(c))
        else:
            columns.append(F.when(F.col("_is_new"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c))
    return joined.select(*columns)
