"""Edge tables with a header, and the comparison report."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapweave.operators import adjudicate


def edges_meta(edges: DataFrame) -> DataFrame:
    """One row: n_edges, by_relation (zero-filled), n_with_score."""
    counts = adjudicate.by_relation(edges).where("relation <> 'no_relation'").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("relation", "n")))).alias("by_relation"))
    return edges.agg(F.count(F.lit(1)).alias("n_edges"), F.count("candidate_score").alias("n_with_score")).join(counts)  # one row each


def write_edges(edges: DataFrame, path: str) -> None:
    edges.write.mode("overwrite").parquet(f"{path}/edges")
    edges_meta(edges).write.mode("overwrite").parquet(f"{path}/meta")


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/edges")


def markdown(summary: DataFrame, examples: DataFrame, coverage: DataFrame | None = None, title: str = "Comparison") -> Iterator[str]:
    """The report's lines: coverage by framework, one line a framework pair, then its examples; rows come to the driver one
    partition at a time."""
    yield f"# {title}"
    if coverage is not None:
        yield from ("", "| framework | our nodes | external | both |", "|-|-|-|-|")
        for r in coverage.orderBy("framework").toLocalIterator():
            yield f"| {r['framework']} | {r['ours']} | {r['external']} | {r['both']} |"
    yield from ("", "| frameworks | ours | external | within our nodes | agreement | ours only | external only |", "|-|-|-|-|-|-|-|")
    for r in summary.orderBy("fw_a", "fw_b").toLocalIterator():
        yield f"| {r['fw_a']} / {r['fw_b']} | {r['ours']} | {r['scf']} | {r['scf_known']} | {r['agreement']} | {r['ours_only']} | {r['scf_only']} |"
    for r in examples.orderBy("fw_a", "fw_b", "class", "rank").toLocalIterator():
        yield f"- {r['fw_a']} / {r['fw_b']}, {r['class']}: {r['text']}"


def json_summary(summary: DataFrame) -> Iterator[str]:
    """The lines of a JSON array, one object a framework pair."""
    yield "["
    before = ""
    for r in summary.orderBy("fw_a", "fw_b").toLocalIterator():
        if before:
            yield before + ","
        before = "  " + json.dumps(r.asDict(), ensure_ascii=False)
    yield from ([before] if before else [])
    yield "]"
