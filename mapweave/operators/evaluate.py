"""Recall of the candidates, similarity of the judged pairs, comparison with an external mapping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mapweave.functions import text as T
from mapweave.operators.upsert import latest


def truth(edges: DataFrame, embedded: DataFrame) -> DataFrame:
    """Edges to find again: not by identity, both ends embedded."""
    ids = embedded.select("id")
    rows = edges.where(~F.coalesce("method", F.lit("")).startswith("identity"))
    return rows.join(ids.toDF("source"), "source", "left_semi").join(ids.toDF("target"), "target", "left_semi")


def recall(edges: DataFrame, best: DataFrame) -> DataFrame:
    """relation (ALL for the total), n, hits, recall: an edge is found if either end has the other among its best."""
    found = best.select(F.least("a_id", "b_id").alias("_lo"), F.greatest("a_id", "b_id").alias("_hi")).distinct().withColumn("_hit", F.lit(1))
    rows = edges.withColumns({"_lo": F.least("source", "target"), "_hi": F.greatest("source", "target")}).join(found, ["_lo", "_hi"], "left")
    out = rows.rollup("relation").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("_hit"), F.lit(0)).cast("long").alias("hits"))
    return out.select(F.coalesce("relation", F.lit("ALL")).alias("relation"), "n", "hits", T.percent(F.col("hits"), F.col("n")).alias("recall"))


def percentiles(scored: DataFrame, column: str = "score", shares: tuple[float, ...] = (0.01, 0.05, 0.10, 0.25, 0.50)) -> DataFrame:
    """One row: p1, p5 and so on, exact with linear interpolation; p5 is the suggested floor."""
    cells = scored.agg(F.percentile(column, F.array(*map(F.lit, shares))).alias("p"))
    return cells.select(*(F.round(F.col("p")[k], 4).alias(f"p{round(100 * s)}") for k, s in enumerate(shares)), F.round(F.col("p")[1], 4).alias("suggested_floor"))


def comapped(strm: DataFrame) -> DataFrame:
    """fw_a, ref_a, fw_b, ref_b (fw_a < fw_b): references of two frameworks that share an external control."""
    legs = strm.where(T.filled(F.col("ref"))).select("scf_id", "framework", "ref").distinct()
    one, two = legs.toDF("scf_id", "fw_a", "ref_a"), legs.toDF("scf_id", "fw_b", "ref_b")
    return one.join(two, "scf_id").where("fw_a < fw_b").select("fw_a", "ref_a", "fw_b", "ref_b").distinct()


def own_pairs(edges: DataFrame, nodes: DataFrame, seq: str | None = None) -> DataFrame:
    """fw_a, ref_a, fw_b, ref_b, relation of our edges across frameworks; of several edges of a pair the last (by seq)."""
    facts = latest(nodes.select("id", "framework", F.col("native_ref").alias("ref"), *(c for c in nodes.columns if c == "seq")), ["id"], "seq" if "seq" in nodes.columns else None)
    both = edges.join(facts.toDF("source", "fw1", "ref1"), "source").join(facts.toDF("target", "fw2", "ref2"), "target").where("fw1 <> fw2")
    low = F.col("fw1") < F.col("fw2")
    pick = lambda x, y: F.when(low, F.col(x)).otherwise(F.col(y))
    rows = both.select(pick("fw1", "fw2").alias("fw_a"), pick("ref1", "ref2").alias("ref_a"), pick("fw2", "fw1").alias("fw_b"), pick("ref2", "ref1").alias("ref_b"), "relation", *([seq] if seq else []))
    keys = ["fw_a", "ref_a", "fw_b", "ref_b"]
    return rows.groupBy(*keys).agg((F.max_by("relation", seq) if seq else F.max("relation")).alias("relation"))


def compared(ours: DataFrame, theirs: DataFrame, known: DataFrame, covered: DataFrame) -> DataFrame:
    """Every pair of either side with its class: agreement, ours_only, scf_only or outside.

    known and covered: (framework, ref) of our nodes and of the external mapping; a pair counts as only ours if both refs
    are covered, as only theirs if both are nodes of ours.
    """
    keys = ["fw_a", "ref_a", "fw_b", "ref_b"]
    both = ours.select(*keys, "relation", F.lit(True).alias("_ours")).join(theirs.select(*keys, F.lit(True).alias("_theirs")), keys, "full_outer")
    for table, name in ((known.distinct(), "known"), (covered.distinct(), "covered")):
        for side in ("a", "b"):
            both = both.join(table.toDF(f"fw_{side}", f"ref_{side}").withColumn(f"_{name}_{side}", F.lit(True)), [f"fw_{side}", f"ref_{side}"], "left")
    is_known = F.col("_known_a").isNotNull() & F.col("_known_b").isNotNull()
    is_covered = F.col("_covered_a").isNotNull() & F.col("_covered_b").isNotNull()
    kind = F.when(F.col("_ours").isNotNull() & F.col("_theirs").isNotNull(), "agreement").when(F.col("_ours").isNotNull() & is_covered, "ours_only")
    kind = kind.when(F.col("_theirs").isNotNull() & is_known, "scf_only").otherwise("outside")
    return both.select(*keys, "relation", F.coalesce("_ours", F.lit(False)).alias("in_ours"), F.coalesce("_theirs", F.lit(False)).alias("in_scf"), (F.col("_theirs").isNotNull() & is_known).alias("scf_known"), kind.alias("class"))


def summary(pairs: DataFrame) -> DataFrame:
    """Per framework pair the sizes of the classes; external pairs in all and within our nodes."""
    count = lambda c: F.count_if(c).alias
    return pairs.groupBy("fw_a", "fw_b").agg(
        count(F.col("in_ours"))("ours"), count(F.col("in_scf"))("scf"), count(F.col("scf_known"))("scf_known"),
        *(F.count_if(F.col("class") == k).alias(k) for k in ("agreement", "ours_only", "scf_only")))


def coverage(known: DataFrame, covered: DataFrame) -> DataFrame:
    """Per framework of the external mapping (covered: framework, ref): refs of our nodes, of the mapping, and of both."""
    ours, theirs = known.select("framework", "ref").distinct(), covered.select("framework", "ref").distinct()
    rows = ours.withColumn("_ours", F.lit(1)).join(theirs.withColumn("_theirs", F.lit(1)), ["framework", "ref"], "full_outer")
    out = rows.groupBy("framework").agg(F.count("_ours").alias("ours"), F.count("_theirs").alias("external"), F.count(F.col("_ours") + F.col("_theirs")).alias("both"))
    return out.where("external > 0")


def refs_up(refs: DataFrame, frameworks: list[str]) -> DataFrame:
    """(framework, ref) with the references of the frameworks one level up, distinct."""
    return refs.select("framework", F.when(F.col("framework").isin(*frameworks), T.rolled_up(F.col("ref"))).otherwise(F.col("ref")).alias("ref")).distinct()


def rolled_up(pairs: DataFrame, frameworks: DataFrame | list[str]) -> DataFrame:
    """(fw_a, ref_a, fw_b, ref_b) with the references of the frameworks (a list, or a table with that column) one level up, distinct."""
    if isinstance(frameworks, list):
        frameworks = pairs.sparkSession.createDataFrame([(f,) for f in frameworks], "framework string")
    named = frameworks.select("framework").distinct().withColumn("_up", F.lit(True))
    rows = pairs
    for side in "ab":
        rows = rows.join(named.toDF(f"fw_{side}", f"_up_{side}"), f"fw_{side}", "left")
    up = lambda side: F.when(F.col(f"_up_{side}"), T.rolled_up(F.col(f"ref_{side}"))).otherwise(F.col(f"ref_{side}")).alias(f"ref_{side}")
    return rows.select("fw_a", up("a"), "fw_b", up("b")).distinct()


def examples(pairs: DataFrame, n: int = 8) -> DataFrame:
    """The first n pairs of each framework pair and class by their text."""
    text = F.concat_ws(" ", "ref_a", "ref_b")
    rank = F.row_number().over(Window.partitionBy("fw_a", "fw_b", "class").orderBy("text"))
    return pairs.where("class <> 'outside'").withColumn("text", text).withColumn("rank", rank).where(F.col("rank") <= n).select("fw_a", "fw_b", "class", "rank", "text")


def banded(scored: DataFrame, column: Column, low: float, high: float) -> DataFrame:
    """scored with band LOW, MEDIUM or HIGH by two bounds."""
    return scored.withColumn("band", F.when(column >= high, "HIGH").when(column >= low, "MEDIUM").otherwise("LOW"))
