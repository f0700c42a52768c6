"""From batches of pairs to merged, verified judgments."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapweave import schemas
from mapweave.functions import text as T
from mapweave.operators.upsert import latest

KEY = ["source_fw", "source_ref", "target_fw", "target_ref"]
VERDICTS = (*schemas.RELATIONS, schemas.NO_RELATION)
_RULES = """Answer in JSON lines: one object a line and pair, nothing else. Fields: source_fw, source_ref, target_fw,
target_ref, relation (EQUIVALENT, PARTIAL, SUPPORTS, INFORMS or no_relation), confidence (0 to 1), rationale (one to
three sentences on the verbatim text). Leave no pair out. The source supports or informs the target; the order doesn't
matter for EQUIVALENT."""


def prompts(batches: DataFrame, rubric: str) -> DataFrame:
    """batch and prompt: the rubric, the batch's pairs as JSON, the output rules. A batch has a bounded number of pairs."""
    fields = [c for c in batches.columns if c not in ("batch", "batch_no")]
    cells = batches.groupBy("batch").agg(F.count(F.lit(1)).alias("n_pairs"), F.array_sort(F.collect_list(F.struct("score", "a_id", "b_id", F.struct(*fields).alias("pair"))), lambda x, y: F.when(x["score"] > y["score"], -1).when(x["score"] < y["score"], 1).when(x["a_id"] < y["a_id"], -1).when(x["a_id"] > y["a_id"], 1).when(x["b_id"] < y["b_id"], -1).otherwise(1)).alias("pairs"))
    body = F.to_json(F.transform("pairs", lambda x: x["pair"]))
    return cells.select("batch", "n_pairs", F.concat(F.lit(rubric.strip() + "\n\n# Pairs\n\n"), body, F.lit("\n\n# Output\n\n" + _RULES)).alias("prompt"))


#: How a reply begins that there wasn't.
FAILED = "no reply: "


class Transient(Exception):
    """Raised by a judge or embedder for what may pass: rate limits, server and transport errors."""


def with_retries(call: Callable, tries: int = 3, wait: float = 1.0) -> Callable:
    """call, tried again after Transient with doubling waits."""

    def tried(*args):
        for attempt in range(tries):
            try:
                return call(*args)
            except Transient:
                if attempt == tries - 1:
                    raise
                time.sleep(wait * 2**attempt)

    return tried


def replies(prompted: DataFrame, judge: Callable[[str], str], tries: int = 3, failures: bool = False) -> DataFrame:
    """batch and reply: one call of the judge a batch, on the executors. failures: a call that fails for good gives a reply
    that says so (a line that validated() rejects), so that the other batches' outputs are kept."""
    ask = with_retries(judge, tries)

    def answer(prompt: str) -> str:
        try:
            return ask(prompt)
        except Exception as error:
            if not failures:
                raise
            return FAILED + " ".join(str(error).split())

    def step(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame({"batch": part["batch"], "reply": [answer(p) for p in part["prompt"]]})

    return prompted.select("batch", "prompt").repartition("batch").mapInPandas(step, "batch string, reply string")


def parsed(reply: DataFrame) -> DataFrame:
    """batch, line_no, line, obj (null if the line isn't a JSON object) of every line of the replies, fences removed."""
    fenced = F.regexp_replace(F.regexp_replace(T.trim(F.col("reply")), "^```[^\\n]*\\n?", ""), "\\n?[ \\t]*```$", "")
    rows = reply.select("batch", F.posexplode(T.lines(fenced)).alias("line_no", "line"))
    line = F.regexp_replace(F.regexp_replace(T.trim(F.col("line")), "^`+|`+$", ""), ",+$", "")
    rows = rows.withColumn("line", line).where(F.length("line") > 0).withColumn("line_no", F.col("line_no") + 1)
    value = F.try_parse_json("line")
    return rows.withColumn("obj", F.when(F.schema_of_variant(value).startswith("OBJECT"), value))


def validated(lines: DataFrame) -> DataFrame:
    """The judgment fields and `problem` (null if the row is good) of parsed lines. Extra fields that are known stay."""
    get = lambda name, kind: F.try_variant_get("obj", f"$.{name}", kind)
    texts = (*KEY, "rationale")
    has = lambda name: F.schema_of_variant(F.col("obj")).rlike(f"[<, ]{name}: ")
    is_text = lambda name: F.schema_of_variant(F.try_variant_get("obj", f"$.{name}", "variant")) == "STRING"
    raw = get("confidence", "string")
    value = raw.try_cast("double")
    problem = F.when(F.col("line").startswith(FAILED), F.col("line")).when(F.col("obj").isNull(), "not an object")
    for name in (*KEY, "relation", "confidence", "rationale"):
        problem = problem.when(~has(name), f"missing {name}")
    problem = problem.when(~F.coalesce(get("relation", "string").isin(*VERDICTS), F.lit(False)), "unknown relation")
    for name in texts:
        problem = problem.when(~F.coalesce(is_text(name) & T.filled(get(name, "string")), F.lit(False)), f"empty {name}")
    problem = problem.when(value.isNull(), "confidence isn't a number")
    return lines.select(
        "batch", "line_no", *(get(c, "string").alias(c) for c in KEY), get("relation", "string").alias("relation"),
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)).alias("confidence"), get("rationale", "string").alias("rationale"),
        get("conflict", "boolean").alias("conflict"), problem.alias("problem"))


def accounting(batches: DataFrame, judged: DataFrame) -> DataFrame:
    """Per batch: pairs in, judgments out, typed, no relation, rejected."""
    n_in = batches.groupBy("batch").agg(F.count(F.lit(1)).alias("n_pairs"))
    good = F.col("problem").isNull()
    out = judged.groupBy("batch").agg(
        F.count_if(good).alias("n_judged"), F.count_if(good & (F.col("relation") != schemas.NO_RELATION)).alias("n_typed"),
        F.count_if(good & (F.col("relation") == schemas.NO_RELATION)).alias("n_no_relation"), F.count_if(~good).alias("n_rejected"))
    return n_in.join(out, "batch", "full_outer").na.fill(0)


def missing_batches(manifest: DataFrame, outputs: DataFrame) -> DataFrame:
    return manifest.select("batch").distinct().join(outputs.select("batch").distinct(), "batch", "left_anti")


def repaired(judgments: DataFrame) -> DataFrame:
    """References given as full ids put right; n_repaired counts them in the row."""
    fixed = {c: T.repaired_ref(F.col(c)) for c in ("source_ref", "target_ref")}
    count = sum((F.coalesce(fixed[c] != F.col(c), F.lit(False)).cast("int") for c in fixed), F.lit(0))
    return judgments.withColumn("n_repaired", count).withColumns(fixed)


def downgraded(judgments: DataFrame, downgrades: DataFrame, seq: str | None = None) -> DataFrame:
    """Verifier results over judgments: by the four-column key, in that orientation; of several the last (by seq) counts.

    A relation that changes caps the confidence and is noted in the rationale; a conflict flag that changes is set and noted.
    """
    down = repaired(downgrades).drop("n_repaired", "verdict")
    down = latest(down, KEY, seq)
    joined = judgments.join(down.withColumn("_hit", F.lit(True)), KEY, "left")
    hit, cap = F.coalesce("_hit", F.lit(False)), F.lit(schemas.DOWNGRADE_CONFIDENCE)
    changes = hit & F.coalesce((F.length("new_relation") > 0) & (F.col("new_relation") != F.col("relation")), F.lit(False))
    flags = hit & F.col("new_conflict").isNotNull() & (F.coalesce("conflict", F.lit(False)) != F.col("new_conflict"))
    note = F.coalesce("note", F.lit(""))
    # The two notes.
    rationale = F.col("rationale")
    rationale = F.when(changes, F.concat(rationale, F.lit(" [downgraded from "), F.col("relation"), F.lit(" by verifier: "), note, F.lit("]"))).otherwise(rationale)
    rationale = F.when(flags & ~changes, F.concat(rationale, F.lit(" [conflict flag revised by verifier: "), note, F.lit("]"))).otherwise(rationale)
    return joined.select(
        *KEY, F.when(changes, F.col("new_relation")).otherwise(F.col("relation")).alias("relation"),
        F.when(changes, F.least(F.col("confidence"), cap)).otherwise(F.col("confidence")).alias("confidence"), rationale.alias("rationale"),
        F.when(flags, F.col("new_conflict")).otherwise(F.col("conflict")).alias("conflict"), (changes | flags).alias("downgraded"),
        *(c for c in judgments.columns if c not in {*KEY, "relation", "confidence", "rationale", "conflict"}))


def typed(judgments: DataFrame) -> DataFrame:
    """Without the pairs judged to have no relation."""
    return judgments.where(F.lower(T.trim(F.col("relation"))) != schemas.NO_RELATION)


def merged(judgments: DataFrame, downgrades: DataFrame | None = None, seq: str | None = None) -> DataFrame:
    """Repair, downgrade, drop; repeated keys stay (the graph keeps the last)."""
    rows = repaired(judgments)
    return typed(downgraded(rows, downgrades, seq) if downgrades is not None else rows)


def strong(judgments: DataFrame) -> DataFrame:
    """What a second reader has to confirm."""
    return judgments.where((F.col("relation") == "EQUIVALENT") | ((F.col("relation") == "PARTIAL") & (F.col("confidence") >= schemas.STRONG_CONFIDENCE)))


def refuted(claims: DataFrame, refuter: Callable[[list[dict]], list[dict]], size: int = 35) -> DataFrame:
    """Downgrades from a second reader, who gets up to `size` claims (as dicts) and gives for each a dict with verdict, note,
    and, if it changes them, new_relation and new_conflict. Claims it confirms are left out."""
    ask, fields = with_retries(refuter), ["verdict", "new_relation", "new_conflict", "note"]

    def step(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = part.to_dict("records")
            found = [x for at in range(0, len(rows), size) for x in ask(rows[at : at + size])]
            if len(found) != len(rows):
                raise ValueError(f"{len(rows)} claims, {len(found)} verdicts")
            out = part[KEY].copy()
            for c in fields:
                out[c] = pd.Series([x.get(c) for x in found], index=out.index, dtype=object)
            yield out

    schema = ", ".join(f"{c} string" for c in [*KEY, "verdict", "new_relation"]) + ", new_conflict boolean, note string"
    return overturned(claims.select(*KEY, "relation", "confidence", "rationale").mapInPandas(step, schema))


def overturned(verdicts: DataFrame) -> DataFrame:
    """Verdicts other than confirmed."""
    return verdicts.where(F.lower(T.trim(F.coalesce("verdict", F.lit("")))) != "confirmed")


def repeated_keys(judgments: DataFrame) -> DataFrame:
    return judgments.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def by_relation(judgments: DataFrame) -> DataFrame:
    """relation and n, zero for relations that don't come."""
    known = judgments.sparkSession.createDataFrame([(r,) for r in VERDICTS], "relation string")
    counts = judgments.groupBy("relation").agg(F.count(F.lit(1)).alias("n"))
    return known.join(counts, "relation", "left").select("relation", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def sharded(judgments: DataFrame, round_name: str, adjudicator: str) -> DataFrame:
    """Rows to be persisted, with the shard they belong to: the two frameworks in order, lower case."""
    good = typed(judgments).where(F.col("relation").isin(*schemas.RELATIONS) & F.col("source_ref").isNotNull() & F.col("target_ref").isNotNull())
    low, high = F.lower(F.least("source_fw", "target_fw")), F.lower(F.greatest("source_fw", "target_fw"))
    defaults = {"method": F.lit("llm"), "adjudicator": F.lit(adjudicator)}
    for c, value in defaults.items():
        good = good.withColumn(c, F.coalesce(c, value) if c in good.columns else value)
    return good.withColumns({"fw_lo": low, "fw_hi": high, "round": F.lit(round_name), "shard": F.concat(F.lit("edges_"), low, F.lit("_"), high, F.lit(round_name), F.lit(".jsonl"))})
