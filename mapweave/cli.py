"""The pipeline's steps as commands: `python -m mapweave.cli <step> ...`. Tables are Parquet folders unless a flag says JSON.

Exit codes: 0, 1 for rows or batches with problems (what is good is still written), 2 for a failed health check.
"""

from __future__ import annotations

import argparse
import importlib
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapweave import schemas
from mapweave.functions import text as T
from mapweave.operators import adjudicate, candidates, embed, evaluate, graph, quality
from mapweave.operators.upsert import unique, upserted
from mapweave.schemas import Settings
from mapweave.sources import documents, endpoints, judgments, mapping, nodes, reports


def env(*names: str, default: str | None = None) -> str | None:
    """The first set variable; credentials stay on the driver."""
    return next((os.environ[n] for n in names if os.environ.get(n)), default)


def plugged(spec: str) -> Callable:
    """module:function, made by calling it."""
    module, _, name = spec.partition(":")
    return getattr(importlib.import_module(module), name)()


def read_nodes(spark: SparkSession, paths: list[str], suffix: str = "", once: bool = False) -> DataFrame:
    """Node files (.json) and node tables, together. suffix: their variants; once: of an id the last of all paths."""
    out = None
    for k, path in enumerate(nodes.variant(p, suffix) if suffix else p for p in paths):
        is_json = path.endswith(".json")
        part = nodes.read_json(spark, path, sequenced=True) if is_json else spark.read.parquet(path).withColumn("seq", F.struct(F.lit("").alias("file"), F.lit(0).alias("pos")))
        part = part.withColumn("seq", F.struct(F.lit(k).alias("path"), "seq"))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return unique(out) if once else out.drop("seq")


def shown(rows: DataFrame, n: int, title: str) -> int:
    found = rows.limit(n + 1).collect()
    for r in found[:n]:
        print(f"  {title}: {', '.join(map(str, r))}")
    if len(found) > n:
        print(f"  {title}: more than {n}")
    return len(found)


def cmd_template(spark, a) -> int:
    good, rejects = documents.two_column_nodes(documents.read_texts(spark, a.source), a.framework, a.version)
    nodes.store(good, a.output)
    return int(bool(shown(rejects, 20, "unparsed line")))


def cmd_nested(spark, a) -> int:
    docs = documents.read_texts(spark, a.source).select(F.from_json("text", documents.NESTED).alias("x")).select("x.*")
    nodes.store(documents.nested_nodes(docs, a.framework, a.version), a.output)
    return 0


def cmd_text(spark, a) -> int:
    texts = documents.pdf_texts(spark, a.source) if a.source.endswith(".pdf") else documents.read_texts(spark, a.source)
    nodes.store(documents.running_text_nodes(documents.numbered_lines(texts), a.framework, a.version), a.output)
    return 0


def cmd_check(spark, a) -> int:
    return int(bool(shown(quality.node_problems(read_nodes(spark, a.nodes)), 30, "problem")))


def cmd_embed(spark, a) -> int:
    table = read_nodes(spark, a.input)
    rows = embed.targets(table, Settings(), a.model, a.instruction)
    exists = os.path.isdir(a.cache)
    cache = spark.read.parquet(a.cache) if exists and not a.force else spark.createDataFrame([], "key string, model string, vector array<double>")
    todo = embed.to_do(rows, cache)
    n = todo.count()
    print(f"{rows.count()} targets, {embed.skipped(table, Settings()).count()} without intent, {n} to do in {-(-n // a.batch)} requests")
    if a.dry_run:
        return 0
    embedder = endpoints.embedder(a.url, a.model) if a.url else plugged(a.embedder)
    if getattr(embedder, "healthy", lambda: True)() is False:
        return 2
    if a.force and exists:
        cache.sparkSession.createDataFrame([], "key string, model string, vector array<double>").write.mode("overwrite").parquet(a.cache)
    done = 0
    while done < n or not exists:  # each part is in the cache before the next is asked for, so a failed run goes on from there
        part = embed.to_do(rows, spark.read.parquet(a.cache) if exists else cache).orderBy("key").limit(a.batch * a.batches_a_write)
        embed.embedded(part, embedder, a.model, a.batch).write.mode("append").parquet(a.cache)
        done, exists = done + a.batch * a.batches_a_write, True
    nodes.store(embed.attached(table, rows, spark.read.parquet(a.cache), a.model), a.out)
    return 0


def cmd_candidates(spark, a) -> int:
    table = read_nodes(spark, a.input)
    settings = Settings(k=a.k, floor=a.floor, intra=tuple(a.intra), intra_k=a.intra_k, intra_floor=a.intra_floor)
    candidates.assert_one_space(table)
    if candidates.targets(table, settings).select("framework").distinct().limit(2).count() < 2 and not a.intra:
        print("fewer than two frameworks and no intra pool: nothing to match")
        return 0
    candidates.candidates(table, settings).write.mode("overwrite").parquet(a.out)
    shown(spark.read.parquet(a.out).orderBy(F.desc("score"), "a_id", "b_id").select("score", "a_id", "b_id"), 12, "pair")
    return 0


def cmd_prep(spark, a) -> int:
    pairs = candidates.selected(spark.read.parquet(a.input), a.frameworks, a.pair_class, a.ref_prefix)
    judgments.write_batches(candidates.batched(candidates.grounded(pairs, read_nodes(spark, a.nodes, once=True)), a.batch, a.prefix), a.dir)
    return 0


def cmd_adjudicate(spark, a) -> int:
    batches = judgments.read_batches(spark, a.batches)
    with open(a.rubric, encoding="utf-8") as file:
        prompted = adjudicate.prompts(batches, file.read())
    if a.dry_run:
        shown(prompted.select("batch", "n_pairs"), 30, "batch")
        return 0
    judge = endpoints.chat(a.provider, a.model) if a.provider else plugged(a.judge)
    if os.path.isdir(a.out) and not a.force:  # batches that have an output stay as they are
        prompted = adjudicate.missing_batches(prompted, spark.read.parquet(a.out)).join(prompted, "batch")
    judged = adjudicate.validated(adjudicate.parsed(adjudicate.replies(prompted, judge, failures=True)))
    judgments.write_outputs(judged, a.out)
    judged = spark.read.parquet(a.out)
    if shown(adjudicate.missing_batches(batches, judged.where("problem IS NULL OR problem NOT LIKE 'no reply%'")), 20, "missing batch"):
        return 1
    shown(adjudicate.accounting(batches, judged).where("n_pairs <> n_judged"), 30, "batch")
    return int(bool(shown(judged.where("problem IS NOT NULL").select("batch", "line_no", "problem"), 10, "rejected")))


def cmd_merge(spark, a) -> int:
    rows = judgments.read_json(spark, a.judgments)
    down = judgments.sequenced(judgments.read_json(spark, a.downgrades, schemas.DOWNGRADES)) if a.downgrades else None
    adjudicate.merged(rows, down, "seq").drop("seq").write.mode("overwrite").parquet(a.out)
    shown(adjudicate.by_relation(spark.read.parquet(a.out)), 10, "relation")
    if a.batches:
        name = F.regexp_extract("file", "(?:out_)?(.*?)\\.json", 1).alias("batch")
        return int(bool(shown(adjudicate.missing_batches(spark.read.json(a.batches), rows.select(name)), 20, "missing batch")))
    return 0


def cmd_shard(spark, a) -> int:
    rows = judgments.read_json(spark, a.input).drop("file", "pos")
    judgments.write_shards(adjudicate.sharded(rows, a.suffix, a.adjudicator), a.out)
    bad = adjudicate.typed(rows).where(~F.col("relation").isin(*schemas.RELATIONS) | F.col("source_ref").isNull() | F.col("target_ref").isNull())
    return int(bool(shown(bad.select(*adjudicate.KEY, "relation"), 10, "rejected")))


def cmd_edges(spark, a) -> int:
    rows = judgments.sequenced(judgments.read_json(spark, a.judgments))
    table = read_nodes(spark, a.nodes, once=True)
    pairs = spark.read.parquet(a.candidates) if a.candidates and os.path.isdir(a.candidates) else None
    reports.write_edges(graph.edges(rows, table, pairs, a.method, a.adjudicator), a.out)
    return int(bool(shown(graph.edge_problems(rows, table), 30, "problem")))


def cmd_load(spark, a) -> int:
    table, edge_rows = read_nodes(spark, a.nodes, once=True), reports.read_edges(spark, a.edges)
    if a.dry_run:
        shown(adjudicate.by_relation(edge_rows), 10, "relation")
        return 0
    parts = {"nodes": graph.graph_nodes(table, with_embeddings=a.with_embeddings), "contains": graph.contains(table), "relations": graph.relations(edge_rows, table)}
    keys = {"nodes": ["id"], "contains": ["src", "dst", "type"], "relations": ["src", "type", "dst"]}
    for name, rows in parts.items():
        old = f"{a.graph}/{name}"
        if not a.wipe and os.path.isdir(old):
            rows = upserted(spark.read.parquet(old), rows, keys[name]) if name != "contains" else spark.read.parquet(old).union(rows).distinct()
        rows.write.mode("overwrite").parquet(f"{a.out}/{name}")
    return 0


def cmd_verify(spark, a) -> int:
    table, rels = spark.read.parquet(f"{a.graph}/nodes"), spark.read.parquet(f"{a.graph}/relations")
    shown(table.groupBy("framework", "node_type").count().orderBy("framework", "node_type"), 100, "nodes")
    both = rels.select("type").union(spark.read.parquet(f"{a.graph}/contains").select("type"))
    shown(both.groupBy("type").count().orderBy(F.desc("count")), 100, "relationships")
    rows = graph.gaps(table, rels, a.framework, a.node_type, direction=a.direction)
    shown(rows.orderBy(F.asc_nulls_last("framework"), F.asc_nulls_last("node_type"), F.asc_nulls_last("native_ref")).select("framework", "node_type", "native_ref", "title"), a.limit, "gap")
    shown(rels.where("type = 'EQUIVALENT'").orderBy(F.desc_nulls_first("confidence"), "src", "dst").select("src", "dst", "confidence"), 6, "equivalent")
    return 0


def cmd_recall(spark, a) -> int:
    table = read_nodes(spark, a.nodes, a.suffix, once=True)
    settings = Settings(k=a.k_cross, intra_k=a.k_intra, intra=tuple(a.intra))
    rows = candidates.targets(table, settings)
    edge_rows = evaluate.truth(reports.read_edges(spark, a.edges), rows)
    shown(evaluate.recall(edge_rows, candidates.by_blocks(rows, settings)), 10, "recall")
    ids = rows.select("id", "v")
    scored = edge_rows.join(ids.toDF("source", "x"), "source").join(ids.toDF("target", "y"), "target").select(T.dot(F.col("x"), F.col("y")).alias("score"))
    shown(evaluate.percentiles(scored), 1, "percentiles")
    return 0


def cmd_strm(spark, a) -> int:
    styles, out = T.key_values(a.ref_style, "--ref-style"), None
    for framework, file in T.key_values(a.map, "--map").items():
        part = mapping.legs(mapping.read_workbooks(spark, os.path.join(a.dir, file)), framework, styles.get(framework, "iso"))
        out = part if out is None else out.unionByName(part)
    if a.out.endswith(".json"):
        mapping.write_nested_json(out, a.out)
        shown(mapping.read_nested_json(spark, a.out).groupBy("framework").count(), 100, "legs")
        return 0
    out.write.mode("overwrite").parquet(a.out)
    shown(spark.read.parquet(a.out).groupBy("framework").count(), 100, "legs")
    return 0


def cmd_compare(spark, a) -> int:
    table = nodes.keys(read_nodes(spark, a.nodes, once=True))
    strm = mapping.read_nested_json(spark, a.strm) if a.strm.endswith(".json") else spark.read.parquet(a.strm)
    mapping.assert_comparable(strm)
    ours = evaluate.own_pairs(reports.read_edges(spark, a.edges), table.withColumnRenamed("ref", "native_ref"))
    theirs, known, covered = evaluate.comapped(strm), table.select("framework", "ref"), strm.select("framework", "ref")
    views = [("", ours, theirs, known, covered)]
    if a.rollup:
        up = lambda refs: evaluate.refs_up(refs, a.rollup)
        relation = ours.groupBy("fw_a", "fw_b").agg(F.max("relation").alias("relation"))
        views.append(("_rollup", evaluate.rolled_up(ours, a.rollup).join(relation, ["fw_a", "fw_b"]), evaluate.rolled_up(theirs, a.rollup), up(known), up(covered)))
    os.makedirs(a.out_dir, exist_ok=True)
    for name, *tables in views:
        pairs = evaluate.compared(*tables)
        summary, few = evaluate.summary(pairs), evaluate.examples(pairs)
        for kind, lines in (("md", reports.markdown(summary, few, evaluate.coverage(*tables[2:]))), ("json", reports.json_summary(summary))):
            with open(os.path.join(a.out_dir, f"{a.out_prefix}{name}.{kind}"), "w", encoding="utf-8") as file:
                file.writelines(line + "\n" for line in lines)
    return 0


def cmd_refute(spark, a) -> int:
    """Strong claims to a second reader; its downgrades go to --out."""
    claims = adjudicate.strong(adjudicate.repaired(judgments.read_json(spark, a.judgments)))
    adjudicate.refuted(claims, plugged(a.refuter)).write.mode("overwrite").json(a.out)
    print(f"{spark.read.schema(schemas.DOWNGRADES).json(a.out).count()} of {claims.count()} overturned")
    return 0


def cmd_canonicalise(spark, a) -> int:
    nodes.store(embed.canonicalised(read_nodes(spark, a.input, once=True), plugged(a.canonicaliser)), a.out)
    return 0


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="mapweave", description=__doc__)
    steps = top.add_subparsers(dest="step", required=True)

    def step(name: str, run: Callable, *flags: tuple) -> None:
        sub = steps.add_parser(name)
        for names, options in flags:
            sub.add_argument(*names.split(), **options)
        sub.set_defaults(run=run)

    need, many = {"required": True}, {"action": "append", "required": True}
    source = [("source", {}), ("output", {}), ("--framework", {"default": "CAF"}), ("--version", {"default": "4.0"})]
    nodes_flag = ("--nodes", many)
    step("template", cmd_template, *source)
    step("nested", cmd_nested, *source)
    step("text", cmd_text, *source)
    step("check", cmd_check, nodes_flag)
    step("embed", cmd_embed, ("--in", {**many, "dest": "input"}), ("--out", need), ("--cache", need), ("--embedder", {"default": "mapweave.operators.embed:hashing_embedder"}), ("--batch", {"type": int, "default": 16}),
         ("--force", {"action": "store_true"}), ("--dry-run", {"action": "store_true"}), ("--model", {"default": "stub"}), ("--instruction", {"default": ""}), ("--url", {"default": env("MAPWEAVE_EMBED_URL")}), ("--batches-a-write", {"type": int, "default": 1000}))
    step("canonicalise", cmd_canonicalise, ("--in", {**many, "dest": "input"}), ("--canonicaliser", need), ("--out", need))
    step("candidates", cmd_candidates, ("--in", {**many, "dest": "input"}), ("--out", need), ("--k", {"type": int, "default": 8}), ("--floor", {"type": float, "default": 0.5}), ("--intra", {"action": "append", "default": []}),
         ("--intra-k", {"type": int, "default": 6}), ("--intra-floor", {"type": float, "default": 0.58}))
    step("prep", cmd_prep, ("--in", {**need, "dest": "input"}), ("--dir", need), ("--batch", {"type": int, "default": 35}), nodes_flag, ("--frameworks", {"nargs": "*"}), ("--pair-class", {"default": "any", "choices": ["any", "cross", "intra"]}),
         ("--ref-prefix", {}), ("--prefix", {"default": "batch"}))
    step("adjudicate", cmd_adjudicate, ("batches", {}), ("--judge", {"default": "mapweave.sources.endpoints:no_judge"}), ("--provider", {"choices": sorted(endpoints.PROVIDERS)}), ("--model", {}), ("--rubric", need), ("--out", need),
         ("--force", {"action": "store_true"}), ("--dry-run", {"action": "store_true"}))
    step("refute", cmd_refute, ("--judgments", many), ("--refuter", need), ("--out", need))
    step("merge", cmd_merge, ("--judgments", many), ("--downgrades", {}), ("--batches", {}), ("--out", need))
    step("shard", cmd_shard, ("--in", {**many, "dest": "input"}), ("--out", need), ("--suffix", {"default": "_r2"}), ("--adjudicator", {"default": "unknown"}))
    step("edges", cmd_edges, ("--judgments", {"nargs": "*", "default": ["data/edges_*.jsonl"]}), nodes_flag, ("--candidates", {}), ("--out", need), ("--method", {"default": "llm"}), ("--adjudicator", {"default": "unknown"}))
    step("load", cmd_load, nodes_flag, ("--edges", need), ("--graph", {"default": env("MAPWEAVE_GRAPH", default="")}), ("--out", need), ("--with-embeddings", {"action": "store_true"}), ("--wipe", {"action": "store_true"}), ("--dry-run", {"action": "store_true"}))
    step("verify", cmd_verify, ("--graph", need), ("--framework", {}), ("--node-type", {}), ("--limit", {"type": int, "default": 40}), ("--direction", {"default": "any", "choices": ["any", "in", "out"]}))
    step("recall", cmd_recall, nodes_flag, ("--edges", need), ("--k-cross", {"type": int, "default": 8}), ("--k-intra", {"type": int, "default": 6}), ("--intra", {"action": "append", "default": []}), ("--suffix", {"default": ""}))
    step("strm", cmd_strm, ("--dir", need), ("--map", many), ("--ref-style", {"action": "append", "default": []}), ("--out", need))
    step("compare", cmd_compare, ("--strm", need), nodes_flag, ("--edges", need), ("--out-dir", need), ("--out-prefix", {"default": "comparison"}), ("--rollup", {"action": "append", "default": []}))
    return top


def main(args: list[str] | None = None) -> int:
    a = parser().parse_args(args)
    return a.run(SparkSession.builder.appName(f"mapweave {a.step}").getOrCreate(), a)


if __name__ == "__main__":
    sys.exit(main())
