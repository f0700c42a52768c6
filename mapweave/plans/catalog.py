"""The named queries over the driver's tables and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mapweave import schemas
from mapweave.functions import text as T
from mapweave.operators import adjudicate, candidates, embed, evaluate, graph, quality
from mapweave.operators.upsert import latest
from mapweave.plans import crosscheck
from mapweave.plans import fixtures as X
from mapweave.schemas import Settings
from mapweave.sources import documents

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


# ------------------------------------------------------------------ candidates


@query(f"WITH {X.PAIRS} SELECT a_id, b_id, score FROM pairs ORDER BY score DESC, a_id, b_id")
def candidates_cross(spark, d):
    return X.pairs(spark, d).orderBy(F.desc("score"), "a_id", "b_id")


@query(f"WITH {X.VECTOR_NODES}, {X.INTRA_BEST} SELECT least(a_id, b_id) AS a_id, greatest(a_id, b_id) AS b_id, round(max(s), 4) AS score FROM intra_best WHERE s >= {X.INTRA_FLOOR} GROUP BY 1, 2")
def candidates_intra(spark, d):
    return candidates.pairs_of(X.best(spark, d, X.BOTH, cross=False), X.BOTH)


@query(f"""WITH {X.CROSS_BEST}, {X.INTRA_BEST}, u AS (SELECT * FROM cross_best WHERE s >= {X.FLOOR} UNION ALL SELECT * FROM intra_best WHERE s >= {X.INTRA_FLOOR})
    SELECT least(a_id, b_id) AS a_id, greatest(a_id, b_id) AS b_id, round(max(s), 4) AS score FROM u GROUP BY 1, 2""")
def candidates_cross_intra_union(spark, d):
    return candidates.pairs_of(X.best(spark, d, X.BOTH), X.BOTH)


@query(f"WITH {X.FULL_PAIRS} SELECT score, a_id, a_framework, a_ref, a_title, b_id, b_framework, b_ref, b_title FROM full_pairs")
def candidate_records(spark, d):
    return X.full_pairs(spark, d).drop("a_canonical_intent", "b_canonical_intent")


@query(f"WITH {X.PAIRS} SELECT a_id, b_id, score FROM pairs ORDER BY score DESC, a_id, b_id LIMIT 12")
def candidates_top(spark, d):
    return X.pairs(spark, d).orderBy(F.desc("score"), "a_id", "b_id").limit(12)


@query(f"WITH {X.PAIRS}, i AS (SELECT a_id AS id FROM pairs UNION ALL SELECT b_id FROM pairs) SELECT min(score) AS min_score, max(score) AS max_score, count(*) AS n_pairs, (SELECT count(DISTINCT id) FROM i) AS n_nodes FROM pairs")
def candidate_score_stats(spark, d):
    p = X.pairs(spark, d)
    sides = p.select(F.explode(F.array("a_id", "b_id")).alias("id"), "score", F.col("a_id").alias("_a"))
    return sides.agg(F.min("score").alias("min_score"), F.max("score").alias("max_score"), F.count_if(F.col("id") == F.col("_a")).alias("n_pairs"), F.count_distinct("id").alias("n_nodes"))


@query("SELECT 'F' || label AS framework, count(*) AS n FROM embeddings WHERE len(embedding) > 0 GROUP BY 1")
def targets_per_framework(spark, d):
    return candidates.targets(X.vector_nodes(spark, d), X.CROSS).groupBy("framework").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {X.FULL_PAIRS} SELECT least(a_framework, b_framework) AS fw_lo, greatest(a_framework, b_framework) AS fw_hi, count(*) AS n FROM full_pairs GROUP BY 1, 2 ORDER BY n DESC, 1, 2")
def pair_combo_counts(spark, d):
    rows = X.full_pairs(spark, d).groupBy(F.least("a_framework", "b_framework").alias("fw_lo"), F.greatest("a_framework", "b_framework").alias("fw_hi")).agg(F.count(F.lit(1)).alias("n"))
    return rows.orderBy(F.desc("n"), "fw_lo", "fw_hi")


@query(f"WITH {X.FULL_PAIRS} SELECT a_id, b_id, score FROM full_pairs WHERE a_framework IN ('F1', 'F2') OR b_framework IN ('F1', 'F2')")
def pair_filter_framework(spark, d):
    return candidates.selected(X.full_pairs(spark, d), ["F1", "F2"]).select("a_id", "b_id", "score")


@query(f"""WITH {X.CROSS_BEST}, {X.INTRA_BEST}, u AS (SELECT * FROM cross_best WHERE s >= {X.FLOOR} UNION ALL SELECT * FROM intra_best WHERE s >= {X.INTRA_FLOOR}),
    p AS (SELECT least(a_id, b_id) AS a_id, greatest(a_id, b_id) AS b_id, round(max(s), 4) AS score FROM u GROUP BY 1, 2)
    SELECT a_id, b_id, score FROM p WHERE split_part(a_id, ':', 1) = split_part(b_id, ':', 1)""")
def pair_filter_class(spark, d):
    both = candidates.described(candidates.pairs_of(X.best(spark, d, X.BOTH), X.BOTH), X.vector_nodes(spark, d))
    return candidates.selected(both, pair_class="intra").select("a_id", "b_id", "score")


@query(f"WITH {X.FULL_PAIRS} SELECT a_id, b_id, score FROM full_pairs WHERE starts_with(a_ref, '12') OR starts_with(b_ref, '12')")
def pair_filter_prefix(spark, d):
    return candidates.selected(X.full_pairs(spark, d), ref_prefix="12").select("a_id", "b_id", "score")


@query(f"""WITH {X.PAIRS}, cut AS (SELECT doc_id, CASE WHEN length(text) > 600 THEN left(text, 600) || ' [...]' ELSE text END AS t FROM documents)
    SELECT a_id, b_id, score, coalesce(x.t, '') AS a_text, coalesce(y.t, '') AS b_text FROM pairs
    LEFT JOIN cut x ON x.doc_id::VARCHAR = split_part(a_id, ':', 3) LEFT JOIN cut y ON y.doc_id::VARCHAR = split_part(b_id, ':', 3)""")
def pair_text_grounding(spark, d):
    nodes = X.vector_nodes(spark, d).select("id", "native_ref")
    texts = nodes.join(X.table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("native_ref"), F.col("text").alias("raw_text")), "native_ref")
    return candidates.grounded(X.pairs(spark, d), texts).select("a_id", "b_id", "score", "a_text", "b_text")


@query(f"WITH {X.PAIRS}, r AS (SELECT *, row_number() OVER (ORDER BY score DESC, a_id, b_id) AS rn FROM pairs) SELECT a_id, b_id, score, ((rn - 1) // 35 + 1)::BIGINT AS batch_no, printf('batch_%03d', (rn - 1) // 35 + 1) AS batch FROM r")
def batch_numbering(spark, d):
    return candidates.batched(X.pairs(spark, d), 35).select("a_id", "b_id", "score", "batch_no", "batch")


# ------------------------------------------------------------------ embedding

_INSTRUCTION = "Represent the intent: "


@query(f"SELECT doc_id, sha256('m' || chr(10) || 'v1' || chr(10) || '{_INSTRUCTION}' || text) AS key FROM documents WHERE length(text) > 0")
def embed_cache_key(spark, d):
    rows = X.table(spark, d, "documents").where(F.length("text") > 0)
    return rows.select("doc_id", embed.cache_key(embed.embed_input(F.col("text"), _INSTRUCTION), "m").alias("key"))


@query("""WITH k AS (SELECT DISTINCT sha256('m' || chr(10) || 'v1' || chr(10) || text) AS key FROM documents), c AS (SELECT DISTINCT sha256('m' || chr(10) || 'v1' || chr(10) || text) AS key FROM documents WHERE lang = 'en')
    SELECT count(*) AS n_keys, count(c.key) AS n_cached, count(*) - count(c.key) AS n_todo, ceil((count(*) - count(c.key)) / 16.0)::BIGINT AS n_batches FROM k LEFT JOIN c USING (key)""")
def embed_cache_hit_miss(spark, d):
    keyed = X.table(spark, d, "documents").select("lang", "text", embed.cache_key(F.col("text"), "m").alias("key"))
    keys, cache = keyed.select("key", "text"), keyed.where("lang = 'en'").select("key")
    todo = embed.to_do(keys, cache).select("key", F.lit(1).alias("_todo"))
    rows = keys.select("key").distinct().join(todo, "key", "left")
    n = F.count("_todo")
    return rows.agg(F.count(F.lit(1)).alias("n_keys"), (F.count(F.lit(1)) - n).alias("n_cached"), n.alias("n_todo"), F.ceil(n / 16).cast("long").alias("n_batches"))


@query()
def stub_embed(spark, d):
    rows = X.table(spark, d, "documents").select("text", embed.cache_key(F.col("text"), "stub").alias("key"))
    return embed.embedded(rows.dropDuplicates(["key"]), embed.hashing_embedder(), "stub")


# ------------------------------------------------------------------ judgments


@query(f"""WITH {X.JUDGMENTS}, v(relation) AS (VALUES ('EQUIVALENT'), ('PARTIAL'), ('SUPPORTS'), ('INFORMS'), ('no_relation')), c AS (SELECT relation, count(*) AS n FROM judgments GROUP BY 1)
    SELECT v.relation, coalesce(n, 0)::BIGINT AS n FROM v LEFT JOIN c USING (relation)""")
def judgments_by_relation(spark, d):
    return adjudicate.by_relation(X.judgments(spark, d))


@query(f"WITH {X.JUDGMENTS} SELECT source_fw, source_ref, target_fw, target_ref, relation, confidence FROM judgments WHERE relation <> 'no_relation'")
def judgments_drop_no_relation(spark, d):
    return adjudicate.typed(X.judgments(spark, d)).select("source_fw", "source_ref", "target_fw", "target_ref", "relation", "confidence")


@query(f"WITH {X.JUDGMENTS} SELECT r.source_fw, r.source_ref, r.target_fw, r.target_ref, (r.source_ref <> j.source_ref)::INT AS n_repaired FROM repaired r JOIN judgments j ON j.source_fw = r.source_fw AND j.target_fw = r.target_fw AND j.target_ref = r.target_ref AND split_part(j.source_ref, ':', -1) = r.source_ref")
def ref_repair(spark, d):
    return adjudicate.repaired(X.judgments(spark, d)).select("source_fw", "source_ref", "target_fw", "target_ref", "n_repaired")


@query(f"WITH {X.JUDGMENTS}, twice AS (SELECT source_fw, source_ref, target_fw, target_ref FROM repaired UNION ALL SELECT source_fw, source_ref, target_fw, target_ref FROM repaired WHERE h % 4 = 0) SELECT source_fw, source_ref, target_fw, target_ref, count(*) AS n FROM twice GROUP BY ALL HAVING count(*) > 1")
def duplicate_pair_keys(spark, d):
    return adjudicate.repeated_keys(adjudicate.repaired(X.judgments(spark, d, rounds=True)))


@query(f"WITH {X.DOWNGRADED} SELECT * FROM merged WHERE relation <> 'no_relation'")
def apply_downgrades(spark, d):
    rows = adjudicate.merged(X.judgments(spark, d), X.downgrades(spark, d), "seq")
    return rows.select(*adjudicate.KEY, "relation", "confidence", "rationale", "conflict", "downgraded")


@query(f"WITH {X.JUDGMENTS} SELECT source_fw, source_ref, target_fw, target_ref, relation, confidence FROM repaired WHERE relation = 'EQUIVALENT' OR (relation = 'PARTIAL' AND confidence >= 0.8)")
def strong_claims(spark, d):
    return adjudicate.strong(adjudicate.repaired(X.judgments(spark, d))).select(*adjudicate.KEY, "relation", "confidence")


@query(f"WITH {X.JUDGMENTS} SELECT 'edges_' || lower(least(source_fw, target_fw)) || '_' || lower(greatest(source_fw, target_fw)) || '_r2.jsonl' AS shard, count(*) AS n FROM repaired WHERE relation <> 'no_relation' GROUP BY 1 ORDER BY 1")
def shard_counts(spark, d):
    rows = adjudicate.sharded(adjudicate.repaired(X.judgments(spark, d)), "_r2", "tester")
    return rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).orderBy("shard")


@query(f"""WITH {X.DOWNGRADED} SELECT (SELECT count(*) FROM pairs) AS proposed, (SELECT count(*) FROM judgments) AS judged, (SELECT count(*) FROM judgments WHERE relation = 'no_relation') AS dropped,
    (SELECT count(*) FROM judgments WHERE relation <> 'no_relation') AS kept, (SELECT count(*) FROM downgrades) AS overturned, (SELECT count(*) FROM merged WHERE relation <> 'no_relation') AS final""")
def funnel_metrics(spark, d):
    p, j = X.pairs(spark, d), X.judgments(spark, d)
    m = adjudicate.downgraded(adjudicate.repaired(j), X.downgrades(spark, d), "seq")
    none = F.col("relation") == schemas.NO_RELATION
    one = p.agg(F.count(F.lit(1)).alias("proposed"))
    two = j.agg(F.count(F.lit(1)).alias("judged"), F.count_if(none).alias("dropped"), F.count_if(~none).alias("kept"))
    three = m.agg(F.count_if("downgraded").alias("overturned"), F.count_if(~none).alias("final"))
    return one.join(two).join(three)  # one row each


@query()
def reply_parse_validate(spark, d):
    """Replies of a careless judge to every pair: fenced, with commas, broken, with extra and missing fields."""
    p = X.full_pairs(spark, d)
    line = F.to_json(F.struct(F.col("a_framework").alias("source_fw"), F.col("a_ref").alias("source_ref"), F.col("b_framework").alias("target_fw"), F.col("b_ref").alias("target_ref"), F.lit("PARTIAL").alias("relation"), F.when(F.col("a_ref") % 3 == 0, F.lit("1.7")).otherwise(F.col("score").cast("string")).alias("confidence"), F.when(F.col("b_ref") % 5 == 0, " ").otherwise("why").alias("rationale")))
    reply = F.concat(F.lit("```json\n"), line, F.lit(",\n{broken\n[1, 2]\n```"))
    return adjudicate.validated(adjudicate.parsed(p.select(F.concat_ws("~", "a_id", "b_id").alias("batch"), reply.alias("reply")))).drop("conflict")


@query()
def stub_adjudicate(spark, d):
    """The whole way through a stand-in for the judge that calls every pair PARTIAL."""
    batches = candidates.batched(candidates.grounded(X.full_pairs(spark, d), X.vector_nodes(spark, d)), 35)

    def judge(prompt: str) -> str:
        import json

        found = json.loads(prompt.split("# Pairs\n\n", 1)[1].split("\n\n# Output", 1)[0])
        return "\n".join(json.dumps({"source_fw": p["a_framework"], "source_ref": p["a_ref"], "target_fw": p["b_framework"], "target_ref": p["b_ref"], "relation": "PARTIAL", "confidence": p["score"], "rationale": "stub"}) for p in found)

    return adjudicate.accounting(batches, adjudicate.validated(adjudicate.parsed(adjudicate.replies(adjudicate.prompts(batches, "Rubric"), judge))))


# ------------------------------------------------------------------ graph


@query("SELECT lang AS framework, min(source) AS version, count(DISTINCT source) AS n_versions FROM documents GROUP BY 1")
def version_map(spark, d):
    return graph.versions(X.table(spark, d, "documents").select(F.col("lang").alias("framework"), F.col("source").alias("version")))


@query(f"WITH {X.EDGES} SELECT * FROM edges")
def build_edges(spark, d):
    return X.edges(spark, d)


@query(f"WITH {X.EDGES}, v(relation) AS (VALUES ('EQUIVALENT'), ('PARTIAL'), ('SUPPORTS'), ('INFORMS')) SELECT v.relation, count(e.source) AS n FROM v LEFT JOIN edges e USING (relation) GROUP BY 1")
def edges_by_relation(spark, d):
    return adjudicate.by_relation(X.edges(spark, d)).where("relation <> 'no_relation'")


@query(f"""WITH {X.JUDGMENTS}, few AS (SELECT * FROM nodes WHERE framework <> 'F9' AND ref::BIGINT % 5 <> 0),
    p AS (SELECT 'bad relation' AS problem, relation AS detail FROM repaired WHERE relation = 'no_relation'
    UNION ALL SELECT 'unknown framework', source_fw FROM repaired WHERE relation <> 'no_relation' AND source_fw = 'F9' UNION ALL SELECT 'unknown framework', target_fw FROM repaired WHERE relation <> 'no_relation' AND target_fw = 'F9'
    UNION ALL SELECT 'unknown node', source_fw || ':' || source_ref FROM repaired j WHERE relation <> 'no_relation' AND source_fw <> 'F9' AND NOT EXISTS (SELECT 1 FROM few n WHERE n.framework = j.source_fw AND n.ref = j.source_ref)
    UNION ALL SELECT 'unknown node', target_fw || ':' || target_ref FROM repaired j WHERE relation <> 'no_relation' AND target_fw <> 'F9' AND NOT EXISTS (SELECT 1 FROM few n WHERE n.framework = j.target_fw AND n.ref = j.target_ref))
    SELECT problem, detail, count(*) AS n FROM p GROUP BY 1, 2""")
def edge_problems(spark, d):
    few = X.vector_nodes(spark, d).where("framework <> 'F9' AND native_ref % 5 <> 0")
    return graph.edge_problems(adjudicate.repaired(X.judgments(spark, d)), few).groupBy("problem", "detail").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {X.JUDGMENTS}, good AS (SELECT * FROM repaired WHERE relation <> 'no_relation') SELECT s.id AS src, j.relation AS type, t.id AS dst, CASE WHEN h % 4 = 0 THEN round(j.confidence / 2, 4) ELSE j.confidence END AS confidence FROM good j JOIN nodes s ON s.framework = j.source_fw AND s.ref = j.source_ref JOIN nodes t ON t.framework = j.target_fw AND t.ref = j.target_ref")
def graph_upsert(spark, d):
    """The second round's confidence replaces the first's."""
    nodes = X.vector_nodes(spark, d)
    rows = adjudicate.typed(adjudicate.repaired(X.judgments(spark, d, rounds=True)))
    one, two = (graph.relations(graph.edges(rows.where(f"seq = {k}").drop("seq"), nodes)) for k in (1, 2))
    return graph.with_upserts(one, two).select("src", "type", "dst", "confidence")


@query(f"WITH {X.PLACES} SELECT c.parent_id AS src, c.id AS dst, 'CONTAINS' AS type FROM places c JOIN places p ON p.id = c.parent_id")
def contains_edges(spark, d):
    return graph.contains(X.place_nodes(spark, d))


@query(f"WITH {X.PLACES} SELECT id, parent_id FROM places c WHERE parent_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM places p WHERE p.id = c.parent_id)")
def dangling_parents(spark, d):
    return quality.dangling_parents(X.place_nodes(spark, d))


@query("SELECT 'F' || label AS framework, 'requirement' AS node_type, count(*) AS n FROM embeddings GROUP BY 1 ORDER BY 1")
def nodes_by_type(spark, d):
    return X.vector_nodes(spark, d).groupBy("framework", "node_type").agg(F.count(F.lit(1)).alias("n")).orderBy("framework", "node_type")


@query(f"WITH {X.EDGES}, {X.PLACES}, r AS (SELECT relation AS type FROM edges UNION ALL SELECT 'CONTAINS' FROM places c JOIN places p ON p.id = c.parent_id) SELECT type, count(*) AS n FROM r GROUP BY 1 ORDER BY n DESC, 1")
def rels_by_type(spark, d):
    rows = X.rels(spark, d).select("type").union(graph.contains(X.place_nodes(spark, d)).select("type"))
    return rows.groupBy("type").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "type")


@query(f"WITH {X.EDGES} SELECT (SELECT count(*) FROM nodes) AS n_nodes, (SELECT count(*) FROM edges) AS n_relationships")
def graph_totals(spark, d):
    n = X.vector_nodes(spark, d).agg(F.count(F.lit(1)).alias("n_nodes"))
    return n.join(X.rels(spark, d).agg(F.count(F.lit(1)).alias("n_relationships")))  # one row each


@query(f"WITH {X.EDGES} SELECT id, framework, ref, title FROM nodes n WHERE NOT EXISTS (SELECT 1 FROM edges e WHERE e.source = n.id OR e.target = n.id) ORDER BY framework, ref")
def gap_nodes(spark, d):
    rows = graph.gaps(X.vector_nodes(spark, d), X.rels(spark, d))
    return rows.select("id", "framework", F.col("native_ref").alias("ref"), "title").orderBy("framework", "ref")


@query(f"WITH {X.EDGES} SELECT id, framework, ref FROM nodes n WHERE framework = 'F3' AND id NOT IN (SELECT target FROM edges) ORDER BY ref LIMIT 40")
def gap_nodes_incoming(spark, d):
    rows = graph.gaps(X.vector_nodes(spark, d), X.rels(spark, d), framework="F3", node_type="requirement", direction="in")
    return rows.select("id", "framework", F.col("native_ref").alias("ref")).orderBy("ref").limit(40)


@query(f"WITH {X.EDGES} SELECT source, target, confidence FROM edges WHERE relation = 'EQUIVALENT' ORDER BY confidence DESC NULLS FIRST, source, target LIMIT 6")
def top_equivalent(spark, d):
    return X.edges(spark, d).where("relation = 'EQUIVALENT'").orderBy(F.desc_nulls_first("confidence"), "source", "target").limit(6).select("source", "target", "confidence")


@query(f"""WITH {X.EDGES}, b AS (SELECT source AS a, target AS b, relation AS type, confidence FROM edges UNION ALL SELECT target, source, relation, confidence FROM edges)
    SELECT b.a, b.b, type, confidence FROM b JOIN nodes x ON x.id = b.a JOIN nodes y ON y.id = b.b WHERE x.framework = 'F1' AND y.framework = 'F2' ORDER BY confidence DESC, a, b""")
def undirected_pattern(spark, d):
    return graph.between(X.vector_nodes(spark, d), X.rels(spark, d), "F1", "F2").orderBy(F.desc("confidence"), "a", "b")


@query(f"WITH {X.EDGES} SELECT e.source, e.target, e.relation FROM edges e JOIN nodes s ON s.id = e.source JOIN nodes t ON t.id = e.target WHERE s.doc = '3' OR t.doc = '3'")
def decommission_impact(spark, d):
    return graph.impact(X.vector_nodes(spark, d), X.edges(spark, d), F.lit("3")).select("source", "target", "relation")


@query(f"WITH {X.EDGES} SELECT source, target, relation, confidence FROM edges WHERE conflict")
def conflict_edges(spark, d):
    return X.edges(spark, d).where("conflict").select("source", "target", "relation", "confidence")


@query("""WITH o AS (SELECT lang AS framework, doc_id::VARCHAR AS native_ref, text FROM documents WHERE doc_id % 10 <> 1), n AS (SELECT lang AS framework, doc_id::VARCHAR AS native_ref, CASE WHEN doc_id % 7 = 0 THEN text || '!' ELSE text END AS text FROM documents WHERE doc_id % 10 <> 2)
    SELECT coalesce(o.framework, n.framework) AS framework, coalesce(o.native_ref, n.native_ref) AS native_ref, CASE WHEN o.native_ref IS NULL THEN 'added' WHEN n.native_ref IS NULL THEN 'removed' WHEN o.text IS NOT DISTINCT FROM n.text THEN 'same' ELSE 'changed' END AS change
    FROM o FULL JOIN n ON o.framework = n.framework AND o.native_ref = n.native_ref""")
def version_diff(spark, d):
    """Two made-up versions of the documents: every tenth is added or removed, every seventh edited."""
    rows = X.table(spark, d, "documents").select(F.col("lang").alias("framework"), F.col("doc_id").cast("string").alias("native_ref"), F.col("text").alias("raw_text"), "doc_id")
    new = rows.where("doc_id % 10 <> 2").withColumn("raw_text", F.when(F.col("doc_id") % 7 == 0, F.concat("raw_text", F.lit("!"))).otherwise(F.col("raw_text")))
    return graph.version_diff(rows.where("doc_id % 10 <> 1"), new)


@query("SELECT conv_id::VARCHAR AS doc, min(role) AS claimed_type, string_agg(DISTINCT role, ',' ORDER BY role) AS unit_types, count(*) AS n_units FROM conversations GROUP BY 1")
def doc_type_mix(spark, d):
    rows = X.table(spark, d, "conversations")
    least = rows.groupBy("conv_id").agg(F.min("role").alias("claimed"))
    nodes = rows.join(least, "conv_id").select(F.col("role").alias("node_type"), F.create_map(F.lit("doc"), F.col("conv_id").cast("string"), F.lit("claimed_type"), F.col("claimed")).alias("extra"))
    return graph.type_mix(nodes)


@query("SELECT event_id, json_extract_string(props, '$.' || k) AS value, k AS key FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events) WHERE k <> 'id' AND json_extract_string(props, '$.' || k) IS NOT NULL")
def extra_flatten(spark, d):
    rows = X.table(spark, d, "events").select(F.col("event_id").cast("string").alias("id"), "event_id", F.from_json("props", "map<string,string>").alias("extra"), F.lit("EV").alias("framework"), F.lit("1").alias("version"), F.col("event_type").alias("native_ref"), F.col("event_type").alias("node_type"), F.lit("t").alias("title"), F.lit("t").alias("raw_text"), F.lit(None).cast("string").alias("canonical_intent"), F.lit(None).cast("string").alias("parent_id"))
    flat = graph.graph_nodes(rows)
    return flat.select(F.col("id").cast("long").alias("event_id"), F.explode("extra").alias("key", "value"))


@query("SELECT upper(left(event_type, 1)) || lower(substr(regexp_replace(event_type, '[^A-Za-z0-9_]', '_', 'g'), 2)) AS label, count(*) AS n FROM events GROUP BY 1")
def type_labels(spark, d):
    return X.table(spark, d, "events").groupBy(T.type_label(F.col("event_type")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH x AS (SELECT doc_id::VARCHAR AS id, left(text, 80) AS title, text FROM documents UNION ALL SELECT doc_id::VARCHAR, '', text FROM documents WHERE doc_id % 50 = 0)
    SELECT 'duplicate id' AS "check", id, count(*)::VARCHAR AS detail FROM x GROUP BY id HAVING count(*) > 1
    UNION ALL SELECT 'dangling parent', id, 'none' FROM x WHERE id::BIGINT % 50 = 0 UNION ALL SELECT 'empty title', id, '' FROM x WHERE length(trim(title)) = 0 UNION ALL SELECT 'empty raw_text', id, '' FROM x WHERE length(trim(text)) = 0""")
def validate_nodes(spark, d):
    rows = X.table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), F.substring("text", 1, 80).alias("title"), F.col("text").alias("raw_text"), "doc_id")
    nodes = rows.union(rows.where("doc_id % 50 = 0").withColumn("title", F.lit("")))
    return quality.node_problems(nodes.withColumn("parent_id", F.when(F.col("doc_id") % 50 == 0, "none")))


@query("SELECT user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1")
def last_wins(spark, d):
    return latest(X.table(spark, d, "events").select("user_id", "event_type", "value", "event_id"), ["user_id"], "event_id")


# ------------------------------------------------------------------ evaluation


@query(f"""WITH {X.EDGES}, {X.INTRA_BEST}, u AS (SELECT DISTINCT least(a_id, b_id) AS lo, greatest(a_id, b_id) AS hi FROM (SELECT * FROM cross_best UNION ALL SELECT * FROM intra_best)),
    odd AS (SELECT relation, source, target FROM edges UNION ALL SELECT 'PARTIAL', a.id, b.id FROM nodes a JOIN nodes b ON b.ref::BIGINT = a.ref::BIGINT + 1),
    h AS (SELECT relation, (u.lo IS NOT NULL)::INT AS hit FROM odd LEFT JOIN u ON u.lo = least(source, target) AND u.hi = greatest(source, target))
    SELECT coalesce(relation, 'ALL') AS relation, count(*) AS n, sum(hit)::BIGINT AS hits, round(100.0 * sum(hit) / count(*), 1)::DOUBLE AS recall FROM h GROUP BY ROLLUP (relation)""")
def recall_at_k(spark, d):
    """Our edges, and neighbours by number as edges that only chance finds."""
    nodes = X.vector_nodes(spark, d).select("id", "native_ref")
    n = F.col("native_ref").cast("long")
    odd = nodes.select(F.col("id").alias("source"), (n + 1).alias("k")).join(nodes.select(F.col("id").alias("target"), n.alias("k")), "k").select("source", "target", F.lit("PARTIAL").alias("relation"), F.lit("llm").alias("method"))
    rows = X.edges(spark, d).select("source", "target", "relation", "method").union(odd)
    return evaluate.recall(evaluate.truth(rows, X.vector_nodes(spark, d)), X.best(spark, d, X.BOTH))


@query(f"WITH {X.EDGES}, q AS (SELECT quantile_cont(candidate_score, [0.01, 0.05, 0.10, 0.25, 0.50]) AS p FROM edges) SELECT round(p[1], 4) AS p1, round(p[2], 4) AS p5, round(p[3], 4) AS p10, round(p[4], 4) AS p25, round(p[5], 4) AS p50, round(p[2], 4) AS suggested_floor FROM q")
def cosine_percentiles(spark, d):
    return evaluate.percentiles(X.edges(spark, d), "candidate_score")


@query(f"WITH {X.COMAP} SELECT fw_a, fw_b, count(*) AS n FROM comap GROUP BY 1, 2")
def comap_pairs(spark, d):
    return evaluate.comapped(X.strm(spark, d)).groupBy("fw_a", "fw_b").agg(F.count(F.lit(1)).alias("n"))


def _compared(spark, d):
    known = X.table(spark, d, "part").select(F.col("p_brand").alias("framework"), F.col("p_partkey").cast("string").alias("ref")).where("ref % 4 <> 0")
    strm = X.strm(spark, d)
    return evaluate.compared(X.part_pairs(spark, d).distinct(), evaluate.comapped(strm), known, strm.where("ref % 9 <> 0").select("framework", "ref"))


_COMPARED = f"""{X.COMAP}, {X.PART_PAIRS}, known AS (SELECT p_brand AS fw, p_partkey::VARCHAR AS ref FROM part WHERE p_partkey % 4 <> 0), covered AS (SELECT DISTINCT framework AS fw, ref FROM strm WHERE ref::BIGINT % 9 <> 0),
m AS (SELECT *, EXISTS (SELECT 1 FROM known k WHERE k.fw = fw_a AND k.ref = ref_a) AND EXISTS (SELECT 1 FROM known k WHERE k.fw = fw_b AND k.ref = ref_b) AS is_known,
    EXISTS (SELECT 1 FROM covered k WHERE k.fw = fw_a AND k.ref = ref_a) AND EXISTS (SELECT 1 FROM covered k WHERE k.fw = fw_b AND k.ref = ref_b) AS is_covered
    FROM (SELECT fw_a, ref_a, fw_b, ref_b, max(o) AS o, max(t) AS t FROM (SELECT *, 1 AS o, 0 AS t FROM ours UNION ALL SELECT *, 0, 1 FROM comap) GROUP BY ALL)),
c AS (SELECT *, CASE WHEN o = 1 AND t = 1 THEN 'agreement' WHEN o = 1 AND is_covered THEN 'ours_only' WHEN t = 1 AND is_known THEN 'scf_only' ELSE 'outside' END AS class FROM m)"""


@query(f"""WITH {_COMPARED} SELECT fw_a, fw_b, sum(o)::BIGINT AS ours, sum(t)::BIGINT AS scf, count(*) FILTER (t = 1 AND is_known) AS scf_known, count(*) FILTER (class = 'agreement') AS agreement,
    count(*) FILTER (class = 'ours_only') AS ours_only, count(*) FILTER (class = 'scf_only') AS scf_only FROM c GROUP BY 1, 2""")
def crosscheck_summary(spark, d):
    return crosscheck.summary(spark, d) if crosscheck.plain(spark, d) else evaluate.summary(_compared(spark, d))


@query(f"WITH {_COMPARED}, e AS (SELECT fw_a, fw_b, class, ref_a || ' ' || ref_b AS text, row_number() OVER (PARTITION BY fw_a, fw_b, class ORDER BY ref_a || ' ' || ref_b) AS rank FROM c WHERE class <> 'outside') SELECT fw_a, fw_b, class, rank::INT AS rank, text FROM e WHERE rank <= 8")
def crosscheck_examples(spark, d):
    return crosscheck.examples(spark, d) if crosscheck.plain(spark, d) else evaluate.examples(_compared(spark, d))


@query(f"""WITH {X.COMAP}, {X.PART_PAIRS}, o AS (SELECT DISTINCT fw_a, regexp_replace(ref_a[1:-2] || '.' || ref_a[-1:], '\\.[^.]*$', '') AS ref_a, fw_b, ref_b FROM ours),
    t AS (SELECT DISTINCT fw_a, regexp_replace(ref_a[1:-2] || '.' || ref_a[-1:], '\\.[^.]*$', '') AS ref_a, fw_b, ref_b FROM comap)
    SELECT fw_a, fw_b, sum(o)::BIGINT AS ours, sum(t)::BIGINT AS scf, sum((o = 1 AND t = 1)::INT)::BIGINT AS agreement FROM (SELECT fw_a, ref_a, fw_b, ref_b, max(o) AS o, max(t) AS t FROM (SELECT *, 1 AS o, 0 AS t FROM o UNION ALL SELECT *, 0, 1 FROM t) GROUP BY ALL) GROUP BY 1, 2""")
def crosscheck_rollup(spark, d):
    """Both sides with the first reference one level up: here its last digit counts as a level."""
    if crosscheck.plain(spark, d):
        return crosscheck.rollup(spark, d)
    brands = X.table(spark, d, "part").select(F.col("p_brand").alias("framework"))
    dotted = F.concat(F.expr("left(ref_a, length(ref_a) - 1)"), F.lit("."), F.expr("right(ref_a, 1)"))
    one = evaluate.rolled_up(X.part_pairs(spark, d).withColumn("ref_a", dotted).withColumn("ref_b", F.concat("ref_b", F.lit(".x"))), brands)
    two = evaluate.rolled_up(evaluate.comapped(X.strm(spark, d)).withColumn("ref_a", dotted).withColumn("ref_b", F.concat("ref_b", F.lit(".x"))), brands)
    both = one.withColumn("o", F.lit(1)).join(two.withColumn("t", F.lit(1)), ["fw_a", "ref_a", "fw_b", "ref_b"], "full_outer")
    return both.groupBy("fw_a", "fw_b").agg(F.count("o").alias("ours"), F.count("t").alias("scf"), F.count(F.col("o") + F.col("t")).alias("agreement"))


@query(f"WITH {_COMPARED} SELECT 'PARTIAL' AS relation, fw_a, fw_b, count(*) AS n FROM c WHERE class = 'agreement' GROUP BY 2, 3")
def agreement_by_relation(spark, d):
    if crosscheck.plain(spark, d):
        return crosscheck.agreement(spark, d)
    return _compared(spark, d).where(F.col("class") == "agreement").groupBy("relation", "fw_a", "fw_b").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT fw_a, fw_b FROM (SELECT DISTINCT p_brand AS fw_a FROM part) a JOIN (SELECT DISTINCT p_brand AS fw_b FROM part) b ON fw_a < fw_b")
def framework_combinations(spark, d):
    fws = X.table(spark, d, "part").select("p_brand").distinct()
    return fws.toDF("fw_a").join(fws.toDF("fw_b"), F.col("fw_a") < F.col("fw_b"))


@query(f"WITH {X.PAIRS}, q AS (SELECT quantile_cont(score, 0.25) AS lo, quantile_cont(score, 0.75) AS hi FROM pairs) SELECT CASE WHEN score >= hi THEN 'HIGH' WHEN score >= lo THEN 'MEDIUM' ELSE 'LOW' END AS band, count(*) AS n FROM pairs, q GROUP BY 1")
def triage_bands(spark, d):
    p = X.pairs(spark, d)
    bounds = p.agg(F.percentile("score", F.array(F.lit(0.25), F.lit(0.75))).alias("q")).first()["q"] or [0.0, 0.0]
    return evaluate.banded(p, F.col("score"), bounds[0], bounds[1]).groupBy("band").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {X.EDGES} SELECT round(corr(confidence, candidate_score), 4) AS r, count(*) AS n FROM edges")
def strength_correlation(spark, d):
    return X.edges(spark, d).agg(F.round(F.corr("confidence", "candidate_score"), 4).alias("r"), F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ texts

#: Style, reference as written, and what the style makes of it by hand.
_REFS = [
    ("iso", "B.7.2.1 Log retention", "B.7.2.1"), ("iso", "12.4 (withdrawn) rest", "12.4"), ("iso", "appendix", "appendix"), ("caf", "C2.b Threat hunting", "C2.b"), ("caf", "--", "--"),
    ("article", "ARTICLE 21(2)(d)", "ARTICLE 21"), ("article", "Recital 9", "Recital 9"), ("section", "section 14.6 / Backup", "section 14.6"), ("section", "part 3", "part 3"),
]


@query("SELECT * FROM (VALUES " + ", ".join(f"('{s}', '{r}', '{n}')" for s, r, n in _REFS) + ") t(style, ref, normal)")
def ref_normalise_styles(spark, d):
    rows = spark.createDataFrame([x[:2] for x in _REFS], "style string, ref string")
    normal = F.lit(None).cast("string")
    for name, style in T.REF_STYLES.items():
        normal = F.when(F.col("style") == name, style(F.col("ref"))).otherwise(normal)
    return rows.withColumn("normal", normal)


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents),
    s AS (SELECT doc_id, pos, CASE WHEN length(line) < 40 THEN pos END AS sec FROM l WHERE length(trim(line)) > 0)
    SELECT doc_id, pos::INT AS pos, last_value(sec IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos)::INT AS section FROM s""")
def section_carry_forward(spark, d):
    """Short lines as section heads; every line carries the last one."""
    texts = X.table(spark, d, "documents").select(F.col("doc_id").alias("file"), "text")
    lines = documents.numbered_lines(texts).where(F.length("line") > 0)
    head = F.when(F.length("line") < 40, F.col("pos"))
    return lines.select(F.col("file").alias("doc_id"), "pos", F.last(head, ignorenulls=True).over(Window.partitionBy("file").orderBy("pos")).alias("section"))


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents),
    k AS (SELECT *, row_number() OVER (PARTITION BY doc_id, left(line, 3) ORDER BY pos) = 1 AS accepted, line LIKE '%|%' AS is_table FROM l WHERE length(trim(line)) > 0),
    g AS (SELECT *, sum(accepted::INT) OVER (PARTITION BY doc_id ORDER BY pos) AS seg FROM k)
    SELECT doc_id, pos::INT AS pos, seg::BIGINT AS seg, bool_or(is_table) OVER (PARTITION BY doc_id, seg ORDER BY pos) AS in_table FROM g""")
def first_occurrence_and_table_flag(spark, d):
    """The first line with each three-letter start opens a segment; a line with a bar opens a table until the next one."""
    lines = documents.numbered_lines(X.table(spark, d, "documents").select(F.col("doc_id").alias("file"), "text")).where(F.length("line") > 0)
    first = F.row_number().over(Window.partitionBy("file", F.substring("line", 1, 3)).orderBy("pos")) == 1
    rows = lines.withColumn("accepted", first)
    rows = rows.withColumn("seg", F.sum(F.col("accepted").cast("int")).over(Window.partitionBy("file").orderBy("pos")))
    flag = F.max(F.col("line").contains("|")).over(Window.partitionBy("file", "seg").orderBy("pos"))
    return rows.select(F.col("file").alias("doc_id"), "pos", "seg", flag.alias("in_table"))


@query("SELECT doc_id, upper(trim(regexp_replace(text, '[^A-Za-z0-9]+', '-', 'g'), '-')) AS slug, CASE WHEN length(text) <= 80 THEN text ELSE left(text, 77) || '...' END AS title FROM documents")
def slugs_and_titles(spark, d):
    rows = X.table(spark, d, "documents")
    return rows.select("doc_id", T.slug(F.col("text")).alias("slug"), T.title_of(F.col("text")).alias("title"))


_NESTED = '{"version": "4.0", "objectives": [{"ref": "A", "title": "Managing  risk", "description": "", "principles": [{"ref": "A1", "title": "Governance", "description": "Have it.", "outcomes": [{"ref": "A1.a", "title": "Board", "description": "Direction.", "igps": {"achieved": ["First.", "Second."]}}]}]}]}'


@query("""SELECT * FROM (VALUES ('CAF:4.0:A', 'objective', 'Managing  risk', 'Managing  risk', NULL), ('CAF:4.0:A1', 'principle', 'Governance', 'Have it.', 'CAF:4.0:A'), ('CAF:4.0:A1.a', 'outcome', 'Board', 'Direction.', 'CAF:4.0:A1'),
    ('CAF:4.0:A1.a#achieved#1', 'igp', 'A1.a IGP (achieved 1)', 'First.', 'CAF:4.0:A1.a'), ('CAF:4.0:A1.a#achieved#2', 'igp', 'A1.a IGP (achieved 2)', 'Second.', 'CAF:4.0:A1.a')) t(id, node_type, title, raw_text, parent_id)""")
def nested_explode(spark, d):
    docs = spark.createDataFrame([(_NESTED,)], "j string").select(F.from_json("j", documents.NESTED).alias("x")).select("x.*")
    return documents.nested_nodes(docs).select("id", "node_type", "title", "raw_text", "parent_id")


_TEXT = ["CAF - Objective C - Seeing what goes on", "What it is for.", "7", "Principle C1 Watching", "C1.a L og Sources (all that", "matter) are known", "and kept.", "Not Achieved", "cell of the table", "C1.b Alarms", "C1.a Said again in the text", "Glossary ........ 41", "© Crown copyright", "C1.c after the end"]


@query("""SELECT * FROM (VALUES ('CAF:4.0:C', 'objective', 'Seeing what goes on', 'What it is for.', NULL), ('CAF:4.0:C1', 'principle', 'Watching', 'Watching', 'CAF:4.0:C'),
    ('CAF:4.0:C1.a', 'outcome', 'Log Sources (all that matter)', 'are known and kept.', 'CAF:4.0:C1'), ('CAF:4.0:C1.b', 'outcome', 'Alarms', 'C1.a Said again in the text', 'CAF:4.0:C1')) t(id, node_type, title, raw_text, parent_id)""")
def running_text(spark, d):
    lines = documents.numbered_lines(spark.createDataFrame([("f", "\n".join(_TEXT))], "file string, text string"))
    return documents.running_text_nodes(lines).select("id", "node_type", "title", "raw_text", "parent_id")


@query("""SELECT * FROM (VALUES ('ACME:1:ACCESS-CONTROL', 'section', 'Access control', NULL), ('ACME:1:AC-1', 'requirement', 'Review access.', 'ACME:1:ACCESS-CONTROL'), ('ACME:1:AC-2', 'requirement', 'Log it.', 'ACME:1:ACCESS-CONTROL')) t(id, node_type, title, parent_id)""")
def two_column_text(spark, d):
    text = "# Access control\n\nAC-1\tReview access.\r\nAC-2   Log it.\nstray\n"
    nodes, _ = documents.two_column_nodes(spark.createDataFrame([("f", text)], "file string, text string"), "ACME", "1")
    return nodes.select("id", "node_type", "title", "parent_id")


# ------------------------------------------------------------------ volume


@query("SELECT l_returnflag, l_linestatus, sum(l_quantity)::DOUBLE AS sum_qty, count(*) AS n FROM lineitem GROUP BY 1, 2")
def lineitem_rollup(spark, d):
    return X.table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").cast("double").alias("sum_qty"), F.count(F.lit(1)).alias("n"))
