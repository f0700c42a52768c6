"""Integrity checks as tables of problems."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapweave.functions import text as T


def dangling_parents(nodes: DataFrame) -> DataFrame:
    ids = nodes.select(F.col("id").alias("parent_id")).distinct()
    return nodes.where("parent_id IS NOT NULL").join(ids, "parent_id", "left_anti").select("id", "parent_id")


def node_problems(nodes: DataFrame) -> DataFrame:
    """check, id and detail of doubled ids, dangling parents, empty titles and texts."""
    doubled = nodes.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.lit("duplicate id").alias("check"), "id", F.col("n").cast("string").alias("detail"))
    out = doubled.union(dangling_parents(nodes).select(F.lit("dangling parent"), "id", "parent_id"))
    for column in ("title", "raw_text"):
        out = out.union(nodes.where(~T.filled(F.col(column))).select(F.lit(f"empty {column}"), "id", F.lit("")))
    return out
