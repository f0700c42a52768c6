"""Edges, the property graph as two tables, and the questions asked of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapweave import schemas
from mapweave.functions import text as T
from mapweave.operators.upsert import latest, unique, upserted


def versions(nodes: DataFrame) -> DataFrame:
    """framework, version (the least), n_versions."""
    return nodes.groupBy("framework").agg(F.min("version").alias("version"), F.count_distinct("version").alias("n_versions"))


def resolved(judgments: DataFrame, nodes: DataFrame) -> DataFrame:
    """judgments with the ids and titles of both ends, null where the framework or node isn't known; of nodes that repeat
    an id the last counts."""
    known = versions(nodes).select("framework", "version")
    facts = unique(nodes.select("id", "title", *(c for c in nodes.columns if c == "seq")))
    out = judgments
    for side in ("source", "target"):
        version = known.toDF(f"{side}_fw", "_version")
        out = out.join(version, f"{side}_fw", "left").withColumn("_id", T.node_id(F.col(f"{side}_fw"), F.col("_version"), F.col(f"{side}_ref")))
        out = out.withColumn(f"_{side}_known", F.col("_version").isNotNull())
        out = out.join(facts.toDF("_id", f"{side}_title").withColumn(side, F.col("_id")), "_id", "left").drop("_id", "_version")
    return out


def edges(judgments: DataFrame, nodes: DataFrame, pairs: DataFrame | None = None, method: str = "llm", adjudicator: str = "unknown") -> DataFrame:
    """Directed, typed edges; rows with an unknown relation or end are left out, see edge_problems()."""
    rows = resolved(judgments.where(F.col("relation").isin(*schemas.RELATIONS)), nodes).where("source IS NOT NULL AND target IS NOT NULL")
    if pairs is not None:
        scores = pairs.groupBy(F.least("a_id", "b_id").alias("_lo"), F.greatest("a_id", "b_id").alias("_hi")).agg(F.max("score").alias("candidate_score"))
        rows = rows.withColumns({"_lo": F.least("source", "target"), "_hi": F.greatest("source", "target")}).join(scores, ["_lo", "_hi"], "left")
    else:
        rows = rows.withColumn("candidate_score", F.lit(None).cast("double"))
    optional = lambda c, kind, value: F.coalesce(F.col(c) if c in judgments.columns else F.lit(None).cast(kind), F.lit(value)).alias(c)
    ends = [F.col(f"{s}{x}").alias(f"{s}{y}") for s in ("source", "target") for x, y in (("", ""), ("_fw", "_framework"), ("_ref", "_ref"), ("_title", "_title"))]
    return rows.select(
        *ends, "relation", (F.col("relation") == "EQUIVALENT").alias("symmetric"), "confidence", "candidate_score", "rationale",
        optional("method", "string", method), optional("adjudicator", "string", adjudicator), optional("conflict", "boolean", False), *(c for c in judgments.columns if c == "seq"))


def edge_problems(judgments: DataFrame, nodes: DataFrame) -> DataFrame:
    """problem and detail: relations, frameworks and nodes that aren't known, frameworks in several versions."""
    rows = resolved(judgments, nodes)
    bad = rows.where(~F.col("relation").isin(*schemas.RELATIONS)).select(F.lit("bad relation").alias("problem"), F.coalesce("relation", F.lit("null")).alias("detail"))
    out = bad
    good = rows.where(F.col("relation").isin(*schemas.RELATIONS))
    for side in ("source", "target"):
        fw, known = F.col(f"{side}_fw"), F.col(f"_{side}_known")
        out = out.union(good.where(~known).select(F.lit("unknown framework"), fw))
        out = out.union(good.where(known & F.col(side).isNull()).select(F.lit("unknown node"), F.concat_ws(":", fw, F.col(f"{side}_ref"))))
    return out.union(versions(nodes).where("n_versions > 1").select(F.lit("several versions"), "framework"))


def graph_nodes(nodes: DataFrame, with_embeddings: bool = False) -> DataFrame:
    """Nodes with labels and flat properties, one per id (the last). Core columns win over extra ones; nulls go."""
    rows = unique(nodes)
    core = ["framework", "version", "native_ref", "node_type", "title", "raw_text", "canonical_intent"]
    extra = F.map_filter(F.coalesce("extra", F.create_map().cast("map<string,string>")), lambda k, v: v.isNotNull() & ~k.isin("id", *core))
    labels = F.array(F.lit("Node"), T.label(F.col("framework")), T.type_label(F.col("node_type")))
    return rows.select("id", labels.alias("labels"), *core, extra.alias("extra"), "parent_id", *(["embedding"] if with_embeddings else []))


def contains(nodes: DataFrame) -> DataFrame:
    """CONTAINS from parent to child where both exist."""
    nodes = unique(nodes.select("id", "parent_id", *(c for c in nodes.columns if c == "seq")))
    children = nodes.where("parent_id IS NOT NULL").select(F.col("parent_id").alias("src"), F.col("id").alias("dst")).distinct()
    return children.join(nodes.select(F.col("id").alias("src")).distinct(), "src").select("src", "dst", F.lit(schemas.CONTAINS).alias("type"))


def relations(edge_rows: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """Edges as relationships, one per (src, type, dst): the last by `seq` if there is one. nodes: both ends must be there."""
    seq = "seq" if "seq" in edge_rows.columns else None
    if nodes is not None:
        ids = nodes.select("id").distinct()
        edge_rows = edge_rows.join(ids.toDF("source"), "source", "left_semi").join(ids.toDF("target"), "target", "left_semi")
    props = [c for c in ("confidence", "candidate_score", "rationale", "method", "adjudicator", "conflict", "symmetric") if c in edge_rows.columns]
    rows = edge_rows.select(F.col("source").alias("src"), F.col("relation").alias("type"), F.col("target").alias("dst"), *props, *([seq] if seq else []))
    return latest(rows, ["src", "type", "dst"], seq)


def with_upserts(old: DataFrame, new: DataFrame) -> DataFrame:
    """A snapshot of relationships with new ones put over it; the same rows twice change nothing."""
    return upserted(old, new, ["src", "type", "dst"])


def gaps(nodes: DataFrame, rels: DataFrame, framework: str | None = None, node_type: str | None = None, mappable: tuple[str, ...] = schemas.MAPPABLE_TYPES, direction: str = "any") -> DataFrame:
    """Nodes without a coverage edge; direction: any, in or out. CONTAINS doesn't cover."""
    cover = rels.where(F.col("type").isin(*schemas.RELATIONS))
    ends = {"in": [cover.select(F.col("dst").alias("id"))], "out": [cover.select(F.col("src").alias("id"))]}
    covered = {"any": lambda: ends["in"][0].union(ends["out"][0]), "in": lambda: ends["in"][0], "out": lambda: ends["out"][0]}[direction]()
    rows = nodes.where(F.col("framework") == framework) if framework else nodes
    rows = rows.where(F.col("node_type") == node_type) if node_type else rows.where(F.col("node_type").isin(*mappable))
    return rows.join(covered, "id", "left_anti")


def by_label(nodes: DataFrame, label: str) -> DataFrame:
    """Graph nodes with a label."""
    return nodes.where(F.array_contains("labels", label))


def between(nodes: DataFrame, rels: DataFrame, framework_a: str, framework_b: str, types: tuple[str, ...] = schemas.RELATIONS) -> DataFrame:
    """Relationships between two frameworks whatever their direction: a, b, type, confidence."""
    facts = nodes.select("id", "framework")
    cover = rels.where(F.col("type").isin(*types))
    both = cover.select(F.col("src").alias("a"), F.col("dst").alias("b"), "type", "confidence").union(cover.select("dst", "src", "type", "confidence"))
    a, b = (facts.where(F.col("framework") == f).select(F.col("id").alias(c)) for f, c in ((framework_a, "a"), (framework_b, "b")))
    return both.join(a, "a", "left_semi").join(b, "b", "left_semi")


def impact(nodes: DataFrame, edge_rows: DataFrame, doc: Column | str) -> DataFrame:
    """Edges that touch a unit of the document."""
    units = nodes.where(F.col("extra")["doc"] == doc).select("id")
    touching = units.withColumnRenamed("id", "source"), units.withColumnRenamed("id", "target")
    out = edge_rows.join(touching[0], "source", "left_semi")
    return out.unionByName(edge_rows.join(touching[0], "source", "left_anti").join(touching[1], "target", "left_semi"))


def version_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """framework, native_ref, change (added, removed, changed, same) of two versions of the nodes."""
    keys = ["framework", "native_ref"]
    both = old.select(*keys, F.col("raw_text").alias("_old"), F.lit(True).alias("_in_old")).join(new.select(*keys, F.col("raw_text").alias("_new"), F.lit(True).alias("_in_new")), keys, "full_outer")
    change = F.when(F.col("_in_old").isNull(), "added").when(F.col("_in_new").isNull(), "removed").when(F.col("_old").eqNullSafe(F.col("_new")), "same").otherwise("changed")
    return both.select(*keys, change.alias("change"))


def type_mix(nodes: DataFrame) -> DataFrame:
    """Per document the types of its units against the type it claims."""
    rows = nodes.withColumn("doc", F.col("extra")["doc"])
    return rows.groupBy("doc").agg(F.max(F.col("extra")["claimed_type"]).alias("claimed_type"), F.array_join(F.array_sort(F.collect_set("node_type")), ",").alias("unit_types"), F.count(F.lit(1)).alias("n_units"))
