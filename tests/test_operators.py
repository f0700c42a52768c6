"""Golden cases for what the tables don't show."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from mapweave.functions import text as T
from mapweave.operators import adjudicate, candidates, embed, graph, quality
from mapweave.operators.upsert import upserted
from mapweave.schemas import Settings
from mapweave.sources import documents, judgments, mapping, nodes
from mapweave.streaming import arrivals


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("given,want", [("A:1:x", "x"), ("A:1", "A:1"), ("x", "x"), ("A:1:b:c", "c")])
def test_repaired_ref(spark, given, want):
    assert one(spark, T.repaired_ref(F.col("r")), r=given) == want


def test_unicode_white_space(spark):
    assert one(spark, T.squeeze(F.col("r")), r=" a \t b ") == "a b"
    assert one(spark, F.size(T.lines(F.col("r"))).cast("string"), r="a\x0bb c\r\nd") == "4"


def test_shortened_and_title(spark):
    assert one(spark, T.shortened(F.col("r")), r="x" * 601) == "x" * 600 + " [...]"
    assert one(spark, T.title_of(F.col("r")), r="x" * 81) == "x" * 77 + "..."


def test_key_values():
    assert T.key_values(["a=b=c"], "--map") == {"a": "b=c"}
    with pytest.raises(ValueError):
        T.key_values(["a"], "--map")
    with pytest.raises(ValueError):
        T.ref_style("nope")


NODE = {"framework": "A", "version": "1", "node_type": "requirement", "title": "t", "raw_text": "r"}


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_node_files_in_both_shapes(spark, tmp_path):
    a = [{"id": "A:1:x", "native_ref": "x", "extra": {"doc": "d", "n": 1}, **NODE}]
    one_file = write(tmp_path / "a.json", json.dumps({"nodes": a}))
    two_file = write(tmp_path / "b.json", json.dumps([{**a[0], "id": "A:1:y", "canonical_intent": "é", "embedding": [1, 2.5]}]))
    rows = {r["id"]: r for r in nodes.read_json(spark, [one_file, two_file]).collect()}
    assert rows["A:1:x"]["extra"] == {"doc": "d", "n": "1"} and rows["A:1:y"]["embedding"] == [1.0, 2.5] and rows["A:1:y"]["canonical_intent"] == "é"
    bad = write(tmp_path / "c.json", json.dumps([{**a[0], "odd": 1}]))
    with pytest.raises(Exception, match="unknown fields"):
        nodes.read_json(spark, bad).collect()


def test_judgment_files(spark, tmp_path):
    row = {"source_fw": "A", "source_ref": "1", "target_fw": "B", "target_ref": "2", "relation": "PARTIAL", "confidence": "0.5", "rationale": "r"}
    files = [
        write(tmp_path / "a.json", json.dumps([row])), write(tmp_path / "b.json", json.dumps({"judgments": [row, row]})),
        write(tmp_path / "c.json", json.dumps(row) + "\n" + json.dumps(row)), write(tmp_path / "d.json", ""), write(tmp_path / "e.json", json.dumps(row)),
    ]
    rows = judgments.read_json(spark, files).collect()
    assert sorted(r["file"] for r in rows) == ["a.json", "b.json", "b.json", "c.json", "c.json", "e.json"] and {r["confidence"] for r in rows} == {0.5}


def test_replies(spark):
    good = {"source_fw": "A", "source_ref": "1", "target_fw": "B", "target_ref": "2", "relation": "PARTIAL", "confidence": 0.5, "rationale": "r"}
    lines = [json.dumps(good) + ",", "{broken", "[1]", json.dumps({**good, "confidence": 7}), json.dumps({**good, "confidence": "x"}), json.dumps({**good, "relation": "partial"}), json.dumps({**good, "rationale": " "}), json.dumps({k: v for k, v in good.items() if k != "target_fw"})]
    reply = spark.createDataFrame([("b1", "```json\n" + "\n".join(lines) + "\n```")], "batch string, reply string")
    rows = adjudicate.validated(adjudicate.parsed(reply)).orderBy("line_no").collect()
    assert [r["problem"] for r in rows] == [None, "not an object", "not an object", None, "confidence isn't a number", "unknown relation", "empty rationale", "missing target_fw"]
    assert rows[0]["confidence"] == 0.5 and rows[3]["confidence"] == 1.0


def test_downgrades_keep_orientation(spark):
    j = spark.createDataFrame([("A", "A:1:1", "B", "2", "EQUIVALENT", 0.9, "r", None), ("B", "2", "A", "1", "PARTIAL", 0.6, "r", False)], "source_fw string, source_ref string, target_fw string, target_ref string, relation string, confidence double, rationale string, conflict boolean")
    d = spark.createDataFrame([("A", "1", "B", "2", "PARTIAL", True, "n", 1)], "source_fw string, source_ref string, target_fw string, target_ref string, new_relation string, new_conflict boolean, note string, seq int")
    rows = {r["source_fw"]: r for r in adjudicate.merged(j, d, "seq").collect()}
    assert rows["A"]["relation"] == "PARTIAL" and rows["A"]["confidence"] == 0.75 and rows["A"]["conflict"] is True and rows["B"]["confidence"] == 0.6 and not rows["B"]["downgraded"]


def test_upsert_twice_changes_nothing(spark):
    old = spark.createDataFrame([("a", 1, {"x": "1", "y": "2"}), ("b", 2, {})], "id string, v int, extra map<string,string>")
    new = spark.createDataFrame([("a", None, {"y": "3"}), ("c", 5, {"z": "1"})], "id string, v int, extra map<string,string>")
    once = upserted(old, new, ["id"])
    rows = {r["id"]: (r["v"], r["extra"]) for r in once.collect()}
    assert rows == {"a": (None, {"x": "1", "y": "3"}), "b": (2, {}), "c": (5, {"z": "1"})}
    assert {r["id"]: (r["v"], r["extra"]) for r in upserted(once, new, ["id"]).collect()} == rows


def test_block_path_is_the_sql_path(spark):
    rows = [(f"F{k % 3}:1:{k}", f"F{k % 3}", None if k % 5 == 0 else str(k % 4), [float(k % 7), float(k % 11), 1.0]) for k in range(60)] + [("F0:1:z", "F0", "9", [0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "id string, framework string, doc string, v array<double>").withColumn("v", T.unit(F.col("v")))
    s = Settings(k=4, intra_k=3, intra=("F0", "F1"))
    key = lambda r: (r["a_id"], r["pool"], r["b_id"])
    want = {key(r): r["score"] for r in candidates.by_sql(df, s).collect()}
    for block_bytes in (24 * 16, 1 << 20):
        got = {key(r): r["score"] for r in candidates.by_blocks(df, s, block_bytes=block_bytes).collect()}
        assert len(got) == len(want) and sorted(round(x, 9) for x in got.values()) == sorted(round(x, 9) for x in want.values())


def test_best_of_a_tile_keeps_the_first_of_equals():
    r = np.random.default_rng(1)
    for _ in range(50):
        scores = r.integers(0, 4, (5, 9)).astype(float)
        scores[r.random(scores.shape) < 0.3] = -np.inf
        row, column = candidates._best_of(scores, 3)
        want = [(i, j) for i in range(5) for j in sorted(range(9), key=lambda j: (-scores[i, j], j))[:3] if scores[i, j] > -np.inf]
        assert list(zip(row.tolist(), column.tolist(), strict=True)) == want


def test_mixed_embeddings_are_an_error(spark):
    df = spark.createDataFrame([([1.0], "m"), ([1.0, 2.0], "m")], "embedding array<double>, embedding_model string")
    with pytest.raises(ValueError, match="mixed"):
        candidates.assert_one_space(df)


def test_36_pairs_are_two_batches(spark):
    df = spark.createDataFrame([(f"a{k:02}", "b", 0.5) for k in range(36)], "a_id string, b_id string, score double")
    assert {r["batch"]: r["n"] for r in candidates.batched(df, 35).groupBy("batch").agg(F.count(F.lit(1)).alias("n")).collect()} == {"batch_001": 35, "batch_002": 1}


def test_gap_directions(spark):
    n = spark.createDataFrame([(x, "A", "requirement") for x in "abcd"], "id string, framework string, node_type string")
    r = spark.createDataFrame([("a", "PARTIAL", "b"), ("c", "CONTAINS", "d")], "src string, type string, dst string")
    ids = lambda **k: {x["id"] for x in graph.gaps(n, r, **k).collect()}
    assert ids() == {"c", "d"} and ids(direction="in") == {"a", "c", "d"} and ids(direction="out") == {"b", "c", "d"}


def test_node_problems(spark):
    df = spark.createDataFrame([("a", "t", "r", "zz"), ("b", " ", "r", None), ("b", "t", "", "a")], "id string, title string, raw_text string, parent_id string")
    assert {(r["check"], r["id"]) for r in quality.node_problems(df).collect()} == {("duplicate id", "b"), ("dangling parent", "a"), ("empty title", "b"), ("empty raw_text", "b")}


def test_embedding_cache(spark):
    df = spark.createDataFrame([("1", "requirement", "x y"), ("2", "requirement", "x y"), ("3", "requirement", None), ("4", "other", "q")], "id string, node_type string, canonical_intent string")
    rows = embed.targets(df, Settings(), "m", "I: ")
    cache = spark.createDataFrame([], "key string, model string, vector array<double>")
    todo = embed.to_do(rows, cache)
    assert todo.count() == 1 and embed.skipped(df, Settings()).count() == 1
    new = embed.embedded(todo, embed.hashing_embedder(8), "m")
    assert embed.to_do(rows, new).count() == 0 and len(new.first()["vector"]) == 8


def test_rejected_lines_are_kept(spark):
    nodes_, rejects = documents.two_column_nodes(spark.createDataFrame([("f", "X-1  early\n# S\nodd\nX-2\tlate")], "file string, text string"), "F", "1")
    assert {(r["native_ref"], r["parent_id"]) for r in nodes_.collect()} == {("X-1", None), ("S", None), ("X-2", "F:1:S")} and [r["line"] for r in rejects.collect()] == ["odd"]


def test_workbook_header():
    assert mapping.columns_of(["SCF #", "FDE #", " FDE  Name", "STRM Relationship", "Strength of Relationship"])["ref"] == 1
    with pytest.raises(ValueError, match="SCF #"):
        mapping.columns_of(["FDE #", "FDE Name", "STRM Relationship", "Strength of Relationship"])


def test_arrivals_are_read_once(spark, tmp_path):
    row = {"source_fw": "A", "source_ref": "A:1:1", "target_fw": "B", "target_ref": "2", "relation": "PARTIAL", "confidence": 0.5, "rationale": "r"}
    (tmp_path / "in").mkdir()
    for k in range(2):
        (tmp_path / "in" / f"{k}.json").write_text(json.dumps(row) + "\n" + json.dumps({**row, "relation": "no_relation"}))
        arrivals.append_to(arrivals.judgments(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
        rows = spark.read.parquet(str(tmp_path / "out")).collect()
        assert len(rows) == k + 1 and {r["source_ref"] for r in rows} == {"1"}
