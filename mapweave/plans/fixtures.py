"""Inputs of the catalogue's queries, derived from the driver's tables: as DataFrames and as SQL with the same expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapweave.operators import candidates, graph
from mapweave.plans import written
from mapweave.schemas import Settings

FLOOR, INTRA_FLOOR = 0.30, 0.25
CROSS = Settings(floor=FLOOR)
LABELS = tuple(f"F{k}" for k in range(10))
BOTH = Settings(floor=FLOOR, intra_floor=INTRA_FLOOR, intra=LABELS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vector_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings as nodes: framework by label, document by vec_id % 7."""
    e = table(spark, sf_dir, "embeddings")
    ref, fw = F.col("vec_id").cast("string"), F.concat(F.lit("F"), F.col("label").cast("string"))
    return e.select(
        F.concat_ws(":", fw, F.lit("1.0"), ref).alias("id"), fw.alias("framework"), F.lit("1.0").alias("version"), ref.alias("native_ref"), F.lit("requirement").alias("node_type"),
        F.concat(F.lit("Title "), ref).alias("title"), F.concat(F.lit("Text "), ref).alias("raw_text"), F.concat(F.lit("requires: "), ref).alias("canonical_intent"),
        F.lit(None).cast("string").alias("parent_id"), F.create_map(F.lit("doc"), (F.col("vec_id") % 7).cast("string")).alias("extra"), F.col("embedding").cast("array<double>").alias("embedding"),
        F.lit("m").alias("embedding_model"), F.size("embedding").alias("embedding_dim"))


VECTOR_NODES = """nodes AS (SELECT 'F' || label || ':1.0:' || vec_id AS id, 'F' || label AS framework, vec_id::VARCHAR AS ref, 'Title ' || vec_id AS title,
    'Text ' || vec_id AS raw_text, (vec_id % 7)::VARCHAR AS doc, embedding::DOUBLE[] AS v FROM embeddings)"""


def best(spark: SparkSession, sf_dir: str, settings: Settings = CROSS, cross: bool = True) -> DataFrame:
    found = lambda: candidates.by_blocks(candidates.targets(vector_nodes(spark, sf_dir), settings), settings, cross)
    return written.once(spark, sf_dir, f"best-{len(settings.intra)}-{cross}", found)


CROSS_BEST = f"""{VECTOR_NODES},
cross_scored AS (SELECT a.id AS a_id, b.id AS b_id, list_cosine_similarity(a.v, b.v) AS s FROM nodes a JOIN nodes b ON a.framework <> b.framework),
cross_best AS (SELECT a_id, b_id, s FROM (SELECT *, row_number() OVER (PARTITION BY a_id ORDER BY s DESC, b_id) AS rn FROM cross_scored) WHERE rn <= 8)"""
INTRA_BEST = """intra_scored AS (SELECT a.id AS a_id, b.id AS b_id, list_cosine_similarity(a.v, b.v) AS s FROM nodes a JOIN nodes b ON a.framework = b.framework AND a.doc IS DISTINCT FROM b.doc),
intra_best AS (SELECT a_id, b_id, s FROM (SELECT *, row_number() OVER (PARTITION BY a_id ORDER BY s DESC, b_id) AS rn FROM intra_scored) WHERE rn <= 6)"""


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a_id, b_id, score of the cross pool, found once a session."""
    return written.once(spark, sf_dir, "pairs", lambda: candidates.pairs_of(best(spark, sf_dir), CROSS))


PAIRS = f"""{CROSS_BEST},
pairs AS (SELECT least(a_id, b_id) AS a_id, greatest(a_id, b_id) AS b_id, round(max(s), 4) AS score FROM cross_best WHERE s >= {FLOOR} GROUP BY 1, 2)"""


def full_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates.described(pairs(spark, sf_dir), vector_nodes(spark, sf_dir))


FULL_PAIRS = f"""{PAIRS},
full_pairs AS (SELECT p.score, a.id AS a_id, a.framework AS a_framework, a.ref AS a_ref, a.title AS a_title, a.raw_text AS a_raw,
    b.id AS b_id, b.framework AS b_framework, b.ref AS b_ref, b.title AS b_title, b.raw_text AS b_raw
    FROM pairs p JOIN nodes a ON a.id = p.a_id JOIN nodes b ON b.id = p.b_id)"""


def judgments(spark: SparkSession, sf_dir: str, rounds: bool = False) -> DataFrame:
    """Verdicts computed from the pairs; every 11th source reference is written as a full id. rounds: a second round of some."""
    p = full_pairs(spark, sf_dir)
    h = (F.col("a_ref").cast("long") * 31 + F.col("b_ref").cast("long") * 17) % 100
    relation = F.when(F.col("h") < 5, "EQUIVALENT").when(F.col("h") < 45, "PARTIAL").when(F.col("h") < 65, "SUPPORTS").when(F.col("h") < 75, "INFORMS").otherwise("no_relation")
    ref = F.when(F.col("a_ref").cast("long") % 11 == 0, F.col("a_id")).otherwise(F.col("a_ref"))
    rows = p.withColumn("h", h).select(
        F.col("a_framework").alias("source_fw"), ref.alias("source_ref"), F.col("b_framework").alias("target_fw"), F.col("b_ref").alias("target_ref"), relation.alias("relation"),
        F.round(0.5 + (F.col("h") % 50) / 100.0, 4).alias("confidence"), F.concat(F.lit("because "), F.col("h").cast("string")).alias("rationale"), (F.col("h") % 7 == 0).alias("conflict"), F.lit(1).alias("seq"), "h")
    if rounds:
        again = rows.where("h % 4 = 0").withColumns({"confidence": F.round(F.col("confidence") / 2, 4), "seq": F.lit(2)})
        rows = rows.union(again)
    return rows


JUDGMENTS = f"""{FULL_PAIRS},
hashed AS (SELECT *, (a_ref::BIGINT * 31 + b_ref::BIGINT * 17) % 100 AS h FROM full_pairs),
judgments AS (SELECT a_framework AS source_fw, CASE WHEN a_ref::BIGINT % 11 = 0 THEN a_id ELSE a_ref END AS source_ref, b_framework AS target_fw, b_ref AS target_ref,
    CASE WHEN h < 5 THEN 'EQUIVALENT' WHEN h < 45 THEN 'PARTIAL' WHEN h < 65 THEN 'SUPPORTS' WHEN h < 75 THEN 'INFORMS' ELSE 'no_relation' END AS relation,
    round(0.5 + (h % 50) / 100.0, 4)::DOUBLE AS confidence, 'because ' || h AS rationale, h % 7 = 0 AS conflict, h FROM hashed),
repaired AS (SELECT * REPLACE (CASE WHEN regexp_matches(source_ref, '^[^:]+:[^:]+:.+$') THEN split_part(source_ref, ':', -1) ELSE source_ref END AS source_ref) FROM judgments)"""


def downgrades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verifier results on strong claims with h divisible by 3, some twice; the later one counts."""
    from mapweave.operators import adjudicate

    rows = adjudicate.strong(adjudicate.repaired(judgments(spark, sf_dir))).where("h % 3 = 0")
    new = F.when(F.col("relation") == "EQUIVALENT", "PARTIAL").otherwise("no_relation")
    one = rows.select("source_fw", "source_ref", "target_fw", "target_ref", new.alias("new_relation"), F.lit(None).cast("boolean").alias("new_conflict"), F.concat(F.lit("note "), F.col("h").cast("string")).alias("note"), F.lit(2).alias("seq"))
    return one.union(one.withColumns({"new_relation": F.lit("INFORMS"), "seq": F.lit(1)}))


DOWNGRADED = f"""{JUDGMENTS},
downgrades AS (SELECT source_fw, source_ref, target_fw, target_ref, CASE WHEN relation = 'EQUIVALENT' THEN 'PARTIAL' ELSE 'no_relation' END AS new_relation, 'note ' || h AS note
    FROM repaired WHERE h % 3 = 0 AND (relation = 'EQUIVALENT' OR (relation = 'PARTIAL' AND confidence >= 0.8))),
merged AS (SELECT j.source_fw, j.source_ref, j.target_fw, j.target_ref, coalesce(d.new_relation, j.relation) AS relation,
    CASE WHEN d.new_relation IS NOT NULL THEN least(j.confidence, 0.75) ELSE j.confidence END AS confidence,
    CASE WHEN d.new_relation IS NOT NULL THEN j.rationale || ' [downgraded from ' || j.relation || ' by verifier: ' || d.note || ']' ELSE j.rationale END AS rationale, j.conflict, d.new_relation IS NOT NULL AS downgraded
    FROM repaired j LEFT JOIN downgrades d USING (source_fw, source_ref, target_fw, target_ref))"""


def typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mapweave.operators import adjudicate

    return adjudicate.typed(adjudicate.repaired(judgments(spark, sf_dir)))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.edges(typed(spark, sf_dir).drop("seq"), vector_nodes(spark, sf_dir), pairs(spark, sf_dir))


EDGES = f"""{JUDGMENTS},
edges AS (SELECT s.id AS source, j.source_fw AS source_framework, j.source_ref, s.title AS source_title, t.id AS target, j.target_fw AS target_framework, j.target_ref, t.title AS target_title,
    j.relation, j.relation = 'EQUIVALENT' AS symmetric, j.confidence, p.score AS candidate_score, j.rationale, 'llm' AS method, 'unknown' AS adjudicator, j.conflict
    FROM repaired j JOIN nodes s ON s.framework = j.source_fw AND s.ref = j.source_ref JOIN nodes t ON t.framework = j.target_fw AND t.ref = j.target_ref
    LEFT JOIN pairs p ON p.a_id = least(s.id, t.id) AND p.b_id = greatest(s.id, t.id) WHERE j.relation <> 'no_relation')"""


def rels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.relations(edges(spark, sf_dir))


def place_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """region, nation and supplier as a hierarchy; suppliers of the last nation hang below a node that isn't there."""
    r = table(spark, sf_dir, "region").select(F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("id"), F.lit("region").alias("node_type"), F.col("r_name").alias("title"), F.lit(None).cast("string").alias("parent_id"))
    n = table(spark, sf_dir, "nation").select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("id"), F.lit("nation"), F.col("n_name"), F.concat(F.lit("R"), F.col("n_regionkey").cast("string"))).where("id <> 'N24'")
    s = table(spark, sf_dir, "supplier").select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("id"), F.lit("supplier"), F.col("s_name"), F.concat(F.lit("N"), F.col("s_nationkey").cast("string")))
    return r.union(n).union(s).withColumn("raw_text", F.col("title"))


PLACES = """places AS (SELECT 'R' || r_regionkey AS id, 'region' AS node_type, r_name AS title, NULL AS parent_id FROM region
    UNION ALL SELECT 'N' || n_nationkey, 'nation', n_name, 'R' || n_regionkey FROM nation WHERE n_nationkey <> 24
    UNION ALL SELECT 'S' || s_suppkey, 'supplier', s_name, 'N' || s_nationkey FROM supplier)"""


def strm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The external mapping: orders as controls, brands as frameworks, parts as references."""
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.select(F.col("l_orderkey").cast("string").alias("scf_id"), F.col("p_brand").alias("framework"), F.col("p_partkey").cast("string").alias("ref")).distinct()


STRM = "strm AS (SELECT DISTINCT l_orderkey::VARCHAR AS scf_id, p_brand AS framework, p_partkey::VARCHAR AS ref FROM lineitem JOIN part ON l_partkey = p_partkey)"
COMAP = f"""{STRM},
comap AS (SELECT DISTINCT a.framework AS fw_a, a.ref AS ref_a, b.framework AS fw_b, b.ref AS ref_b FROM strm a JOIN strm b ON a.scf_id = b.scf_id AND a.framework < b.framework)"""


def part_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Our edges for that comparison: parts of equal type and size and different brand."""
    p = table(spark, sf_dir, "part").select("p_type", "p_size", F.col("p_brand").alias("fw"), F.col("p_partkey").cast("string").alias("ref"))
    return p.toDF("p_type", "p_size", "fw_a", "ref_a").join(p.toDF("p_type", "p_size", "fw_b", "ref_b"), ["p_type", "p_size"]).where("fw_a < fw_b").select("fw_a", "ref_a", "fw_b", "ref_b", F.lit("PARTIAL").alias("relation"))


PART_PAIRS = """ours AS (SELECT a.p_brand AS fw_a, a.p_partkey::VARCHAR AS ref_a, b.p_brand AS fw_b, b.p_partkey::VARCHAR AS ref_b FROM part a JOIN part b ON a.p_type = b.p_type AND a.p_size = b.p_size AND a.p_brand < b.p_brand)"""
