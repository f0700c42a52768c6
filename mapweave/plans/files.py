"""Queries that go through files: what is written is read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from mapweave.operators import adjudicate, candidates, embed, evaluate, graph
from mapweave.plans import fixtures as X
from mapweave.plans import written
from mapweave.plans.catalog import query
from mapweave.schemas import Settings
from mapweave.sources import judgments, mapping, nodes


def _path(spark, name: str) -> str:
    return f"{written.folder(spark)}/{name}-{uuid.uuid4().hex}"


@query(f"WITH {X.VECTOR_NODES} SELECT id, framework, ref, title, doc, len(v)::INT AS dim FROM nodes")
def node_files(spark, d):
    """Node files of one document a framework, read back strictly."""
    rows = X.vector_nodes(spark, d)
    path = _path(spark, "node-files")
    body = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    documents = rows.groupBy("framework").agg(F.concat(F.lit('{"nodes": ['), F.array_join(F.collect_list(body), ","), F.lit("]}")).alias("value"))  # ten frameworks here
    documents.select("value").write.option("maxRecordsPerFile", 1).text(path)
    out = nodes.read_json(spark, f"{path}/*.txt")
    return out.select("id", "framework", F.col("native_ref").alias("ref"), "title", F.col("extra")["doc"].alias("doc"), F.size("embedding").alias("dim"))


@query(f"WITH {X.VECTOR_NODES} SELECT id, framework, ref FROM nodes")
def node_keys(spark, d):
    return nodes.keys(X.vector_nodes(spark, d))


@query(f"WITH {X.PAIRS}, r AS (SELECT *, row_number() OVER (ORDER BY score DESC, a_id, b_id) AS rn FROM pairs) SELECT printf('batch_%03d', (rn - 1) // 35 + 1) AS batch, count(*) AS n, min(score) AS least FROM r GROUP BY 1")
def batch_files(spark, d):
    path = _path(spark, "batches")
    judgments.write_batches(candidates.batched(X.full_pairs(spark, d), 35), path)
    return judgments.read_batches(spark, path).groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))


@query(f"WITH {X.JUDGMENTS} SELECT source_fw, source_ref, target_fw, target_ref, relation, confidence FROM judgments")
def judgment_files(spark, d):
    path = _path(spark, "judgments")
    X.judgments(spark, d).drop("h", "seq").write.json(path)
    return judgments.read_json(spark, f"{path}/*.json").select("source_fw", "source_ref", "target_fw", "target_ref", "relation", "confidence")


@query(f"""WITH {X.JUDGMENTS} SELECT lower(least(source_fw, target_fw)) AS fw_lo, lower(greatest(source_fw, target_fw)) AS fw_hi, '_r2' AS round, count(*) AS n, round(sum(confidence), 2)::DOUBLE AS total
    FROM repaired WHERE relation <> 'no_relation' GROUP BY 1, 2""")
def shard_files(spark, d):
    """Two rounds side by side; the first is written twice and stays as it was."""
    path = _path(spark, "shards")
    rows = adjudicate.repaired(X.judgments(spark, d)).drop("h", "seq", "n_repaired")
    for name in ("_r1", "_r2", "_r1"):
        judgments.write_shards(adjudicate.sharded(rows, name, "tester"), path)
    back = judgments.read_shards(spark, path).where("round = '_r2'")
    return back.groupBy("fw_lo", "fw_hi", "round").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("confidence"), 2).alias("total"))


def _sheet(spark, d):
    """The external mapping as sheet rows, with blank and dropped ones."""
    strm = X.strm(spark, d)
    part = F.col("ref").cast("long")
    rel = F.when(part % 5 == 0, "No Relationship").when(part % 7 == 0, " ").otherwise("Subset Of")
    return strm.select(F.concat(F.lit(" "), "scf_id").alias("scf_id"), F.concat("ref", F.lit(" (part)")).alias("ref"), F.lit("a  name").alias("name"), rel.alias("rel"), F.when(part % 2 == 0, F.lit("7")).otherwise("n/a").alias("sor"), "framework")


_LEGS = f"""{X.STRM}, legs AS (SELECT framework, scf_id, ref, CASE WHEN ref::BIGINT % 2 = 0 THEN 7 END AS sor FROM strm WHERE ref::BIGINT % 5 <> 0 AND ref::BIGINT % 7 <> 0)"""


def _legs(spark, d):
    return mapping.legs(_sheet(spark, d), "x")


@query(f"WITH {_LEGS} SELECT scf_id, ref, 'a name' AS name, 'Subset Of' AS rel, sor FROM legs")
def sheet_legs(spark, d):
    """Rows that map nothing go; references, names and strengths are cleaned."""
    return _legs(spark, d).select("scf_id", "ref", "name", "rel", "sor")


@query(f"WITH {_LEGS}, two AS (SELECT DISTINCT CASE WHEN ref::BIGINT % 3 = 0 THEN 'P' ELSE 'Q' END AS framework, scf_id, ref, sor FROM legs) SELECT framework, scf_id, count(*) AS n, count(sor) AS n_strong FROM two GROUP BY 1, 2")
def mapping_json(spark, d):
    """The nested JSON form by control, parsed again."""
    legs = _legs(spark, d).withColumn("framework", F.when(F.col("ref").cast("long") % 3 == 0, "P").otherwise("Q")).distinct()
    kind = "array<struct<ref:string,name:string,rel:string,sor:int>>"
    return mapping.controls(legs).select("framework", "scf_id", F.from_json("legs", kind).alias("x")).select("framework", "scf_id", F.size("x").cast("long").alias("n"), F.size(F.filter("x", lambda y: y["sor"].isNotNull())).cast("long").alias("n_strong"))


@query(f"""WITH {X.COMAP}, ours AS (SELECT DISTINCT p_brand AS framework, p_partkey::VARCHAR AS ref FROM part WHERE p_partkey % 4 <> 0), theirs AS (SELECT DISTINCT framework, ref FROM strm WHERE ref::BIGINT % 9 <> 0)
    SELECT framework, count(o) AS ours, count(t) AS external, sum((o IS NOT NULL AND t IS NOT NULL)::INT)::BIGINT AS both FROM (SELECT framework, ref, 1 AS o FROM ours) a FULL JOIN (SELECT framework, ref, 1 AS t FROM theirs) b USING (framework, ref) GROUP BY 1 HAVING count(t) > 0""")
def coverage_counts(spark, d):
    known = X.table(spark, d, "part").select(F.col("p_brand").alias("framework"), F.col("p_partkey").cast("string").alias("ref")).where("ref % 4 <> 0")
    return evaluate.coverage(known, X.strm(spark, d).where("ref % 9 <> 0"))


@query(f"""WITH {X.PAIRS}, r AS (SELECT *, row_number() OVER (ORDER BY score DESC, a_id, b_id) AS rn FROM pairs), b AS (SELECT (rn - 1) // 35 + 1 AS k, split_part(a_id, ':', 3)::BIGINT AS ref FROM r)
    SELECT printf('batch_%03d', k) AS batch, count(*) AS n_pairs, sum((k % 4 <> 0)::INT)::BIGINT AS n_judged, sum((k % 4 <> 0 AND ref % 3 <> 0)::INT)::BIGINT AS n_typed, sum((k % 4 <> 0 AND ref % 3 = 0)::INT)::BIGINT AS n_no_relation, 0::BIGINT AS n_rejected FROM b GROUP BY k""")
def batch_accounting(spark, d):
    """Pairs in and judgments out; every fourth batch never came back."""
    batches = candidates.batched(X.full_pairs(spark, d), 35)
    relation = F.when(F.col("a_ref") % 3 == 0, "no_relation").otherwise("PARTIAL")
    judged = batches.where("batch_no % 4 <> 0").select("batch", relation.alias("relation"), F.lit(None).cast("string").alias("problem"))
    return adjudicate.accounting(batches, judged)


@query(f"WITH {X.PAIRS}, r AS (SELECT row_number() OVER (ORDER BY score DESC, a_id, b_id) AS rn FROM pairs) SELECT DISTINCT printf('batch_%03d', (rn - 1) // 35 + 1) AS batch FROM r WHERE ((rn - 1) // 35 + 1) % 4 = 0")
def missing_batches(spark, d):
    batches = candidates.batched(X.full_pairs(spark, d), 35)
    return adjudicate.missing_batches(batches, batches.where("batch_no % 4 <> 0"))


@query(f"""WITH {X.FULL_PAIRS} SELECT a_id, b_id, least(1.0, score * 3)::DOUBLE AS confidence, CASE WHEN b_ref::BIGINT % 5 = 0 THEN 'empty rationale' END AS problem FROM full_pairs""")
def reply_lines(spark, d):
    """Replies with fences, commas, numbers as text and too large ones, and blank rationales."""
    p = X.full_pairs(spark, d)
    fields = {"source_fw": F.col("a_framework"), "source_ref": F.col("a_id"), "target_fw": F.col("b_framework"), "target_ref": F.col("b_id"), "relation": F.lit("PARTIAL"), "confidence": (F.col("score") * 3).cast("string"), "rationale": F.when(F.col("b_ref") % 5 == 0, " ").otherwise("why")}
    reply = F.concat(F.lit("```\n`"), F.to_json(F.struct(*(v.alias(k) for k, v in fields.items()))), F.lit("`,\n```"))
    rows = adjudicate.validated(adjudicate.parsed(p.select(F.concat_ws("~", "a_id", "b_id").alias("batch"), reply.alias("reply"))))
    return rows.select(F.col("source_ref").alias("a_id"), F.col("target_ref").alias("b_id"), "confidence", "problem")


@query(f"WITH {X.EDGES} SELECT source_framework AS fw1, source_ref AS ref1, target_framework AS fw2, target_ref AS ref2, relation FROM edges WHERE source_framework < target_framework UNION ALL SELECT target_framework, target_ref, source_framework, source_ref, relation FROM edges WHERE source_framework > target_framework")
def edge_references(spark, d):
    return evaluate.own_pairs(X.edges(spark, d), X.vector_nodes(spark, d)).toDF("fw1", "ref1", "fw2", "ref2", "relation")


@query(f"""WITH {X.EDGES} SELECT source, target, CASE WHEN split_part(source, ':', 3)::BIGINT % 3 = 0 THEN 'second' ELSE source_title END AS source_title FROM edges""")
def edges_of_repeated_nodes(spark, d):
    """Nodes that a later file repeats under another title: one edge a judgment, the last title."""
    rows = X.vector_nodes(spark, d).withColumn("seq", F.lit(1))
    again = rows.where("native_ref % 3 = 0").withColumns({"title": F.lit("second"), "seq": F.lit(2)})
    return graph.edges(X.typed(spark, d).drop("seq"), rows.unionByName(again)).select("source", "target", "source_title")


@query(f"WITH {X.EDGES} SELECT source AS src, relation AS type, target AS dst FROM edges WHERE split_part(source, ':', 3)::BIGINT % 4 <> 0 AND split_part(target, ':', 3)::BIGINT % 4 <> 0")
def relations_with_known_ends(spark, d):
    few = X.vector_nodes(spark, d).where("native_ref % 4 <> 0")
    return graph.relations(X.edges(spark, d), few).select("src", "type", "dst")


@query(f"WITH {X.VECTOR_NODES} SELECT 'F3' AS label, id FROM nodes WHERE framework = 'F3'")
def nodes_by_label(spark, d):
    return graph.by_label(graph.graph_nodes(X.vector_nodes(spark, d)), "F3").select(F.lit("F3").alias("label"), "id")


@query("SELECT count(*) FILTER (length(text) > 0 AND doc_id % 3 <> 0) AS n_targets, count(*) FILTER (NOT (length(text) > 0 AND doc_id % 3 <> 0)) AS n_skipped FROM documents")
def embed_targets(spark, d):
    rows = X.table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), F.lit("requirement").alias("node_type"), F.when(F.col("doc_id") % 3 != 0, F.col("text")).alias("canonical_intent"))
    n = embed.targets(rows, Settings(), "m", "").agg(F.count(F.lit(1)).alias("n_targets"))
    return n.join(embed.skipped(rows, Settings()).agg(F.count(F.lit(1)).alias("n_skipped")))  # one row each


@query("SELECT 64 AS dim, count(*) AS n FROM embeddings WHERE len(embedding) > 0")
def embedding_sizes(spark, d):
    rows = X.vector_nodes(spark, d)
    candidates.assert_one_space(rows)
    return rows.where(F.size("embedding") > 0).groupBy(F.size("embedding").alias("dim")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH v AS (SELECT doc_id::VARCHAR AS source_ref, ['confirmed', ' Confirmed', 'downgrade', 'reject'][doc_id % 4 + 1] AS verdict FROM documents) SELECT source_ref, verdict FROM v WHERE lower(trim(verdict)) <> 'confirmed'""")
def overturned_claims(spark, d):
    names = F.array(*(F.lit(x) for x in ("confirmed", " Confirmed", "downgrade", "reject")))
    rows = X.table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("source_ref"), F.element_at(names, (F.col("doc_id") % 4 + 1).cast("int")).alias("verdict"))
    return adjudicate.overturned(rows)
