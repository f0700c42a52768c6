"""Two toy frameworks all the way through the commands."""

import json

import pytest

from mapweave import cli
from mapweave.operators import evaluate


def toy(fw, texts):
    return {"nodes": [{"id": f"{fw}:1.0:{fw[0]}-{k}", "framework": fw, "version": "1.0", "native_ref": f"{fw[0]}-{k}", "node_type": "requirement", "title": t[:20], "raw_text": t, "canonical_intent": t, "parent_id": None, "extra": {"doc": fw.lower()}} for k, t in enumerate(texts, 1)]}


def make_judge():
    def judge(prompt):
        pairs = json.loads(prompt.split("# Pairs\n\n", 1)[1].split("\n\n# Output", 1)[0])
        return "\n".join(json.dumps({"source_fw": p["a_framework"], "source_ref": p["a_ref"], "target_fw": p["b_framework"], "target_ref": p["b_ref"], "relation": "EQUIVALENT" if p["score"] > 0.9 else "no_relation", "confidence": p["score"], "rationale": "stub"}) for p in pairs)

    return judge


def test_walkthrough(spark, tmp_path, capsys):
    at = lambda name: str(tmp_path / name)
    same = "review access rights of all users every year"
    (tmp_path / "a.json").write_text(json.dumps(toy("ALPHA", [same, "encrypt data at rest", "train staff"])))
    (tmp_path / "b.json").write_text(json.dumps(toy("BETA", ["log events centrally", same])))
    (tmp_path / "rubric.md").write_text("Judge.")
    run = lambda *args: cli.main(list(args))
    assert run("check", "--nodes", at("a.json"), "--nodes", at("b.json")) == 0
    assert run("embed", "--in", at("a.json"), "--in", at("b.json"), "--out", at("nodes"), "--cache", at("cache")) == 0
    assert run("embed", "--in", at("a.json"), "--in", at("b.json"), "--out", at("nodes"), "--cache", at("cache"), "--dry-run") == 0
    assert "0 to do" in capsys.readouterr().out
    assert run("candidates", "--in", at("nodes"), "--out", at("pairs"), "--floor", "0.2") == 0
    best = spark.read.parquet(at("pairs")).orderBy("score", ascending=False).first()
    assert (best["a_ref"], best["b_ref"], best["score"]) == ("A-1", "B-2", 1.0)
    assert run("prep", "--in", at("pairs"), "--dir", at("batches"), "--nodes", at("nodes"), "--batch", "2") == 0
    assert run("adjudicate", at("batches"), "--judge", "tests.test_cli:make_judge", "--rubric", at("rubric.md"), "--out", at("judged")) == 0
    spark.read.parquet(at("judged")).drop("batch").write.json(at("out_json"))
    files = [str(p) for p in (tmp_path / "out_json").glob("*.json")]
    flags = [x for f in files for x in ("--judgments", f)]
    assert run("merge", *flags, "--out", at("merged")) == 0 and spark.read.parquet(at("merged")).count() == 1
    spark.read.parquet(at("merged")).coalesce(1).write.json(at("merged_json"))
    merged = str(next((tmp_path / "merged_json").glob("*.json")))
    assert run("shard", "--in", merged, "--out", at("shards")) == 0 and (tmp_path / "shards" / "fw_lo=alpha" / "fw_hi=beta" / "round=_r2").is_dir()
    assert run("edges", "--judgments", merged, "--nodes", at("nodes"), "--candidates", at("pairs"), "--out", at("edges")) == 0
    assert spark.read.parquet(at("edges/meta")).first()["n_edges"] == 1
    assert run("load", "--nodes", at("nodes"), "--edges", at("edges"), "--out", at("graph")) == 0
    assert run("load", "--nodes", at("nodes"), "--edges", at("edges"), "--graph", at("graph"), "--out", at("graph2")) == 0
    for name in ("nodes", "relations"):
        assert spark.read.parquet(at(f"graph/{name}")).count() == spark.read.parquet(at(f"graph2/{name}")).count()
    capsys.readouterr()
    assert run("verify", "--graph", at("graph2")) == 0
    out = capsys.readouterr().out
    assert out.count("gap:") == 3 and "equivalent: ALPHA:1.0:A-1, BETA:1.0:B-2, 1.0" in out
    assert run("recall", "--nodes", at("nodes"), "--edges", at("edges")) == 0 and "recall: ALL, 1, 1, 100.0" in capsys.readouterr().out
    strm = {"ALPHA": {"C1": [{"ref": "A-1", "name": "x", "rel": "Equal", "sor": 5}]}, "BETA": {"C1": [{"ref": "B-2", "name": "y", "rel": "Equal", "sor": 9}, {"ref": "B-1", "name": "z", "rel": "Subset", "sor": None}]}}
    (tmp_path / "strm.json").write_text(json.dumps(strm))
    assert run("compare", "--strm", at("strm.json"), "--nodes", at("nodes"), "--edges", at("edges"), "--out-dir", at("report")) == 0
    (row,) = json.loads((tmp_path / "report" / "comparison.json").read_text())
    assert (row["agreement"], row["ours_only"], row["scf_only"], row["scf"]) == (1, 0, 1, 2) and "agreement: A-1 B-2" in (tmp_path / "report" / "comparison.md").read_text()


def test_one_framework_can_not_be_compared(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"A": {"C": [{"ref": "1", "name": "", "rel": "x", "sor": 1}]}}))
    from mapweave.sources import mapping

    with pytest.raises(ValueError):
        mapping.assert_comparable(mapping.read_nested_json(spark, str(tmp_path / "s.json")))
    assert evaluate is not None
