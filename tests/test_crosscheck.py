"""The cross-check on numbers against its SQL, on tables with repeated, null and unmapped parts."""

import duckdb
import pytest
from pyspark.sql import functions as F

from mapweave.plans import catalog, crosscheck

SF = "/root/testdata/sf0.001"
NAMES = ["agreement_by_relation", "crosscheck_summary", "crosscheck_examples", "crosscheck_rollup"]


def check(spark, folder, name):
    con = duckdb.connect()
    for table in ("part", "lineitem"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    found = con.execute(catalog.ORACLE_SQL[name])
    columns = [d[0] for d in found.description]
    rows = catalog.QUERIES[name](spark, str(folder))
    assert rows.columns == columns
    assert sorted(map(str, map(tuple, rows.collect()))) == sorted(map(str, found.fetchall()))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """odd: kinds and brands that are null, lines that repeat, parts without lines; copied: a part that comes twice."""
    part, lines = spark.read.parquet(f"{SF}/part.parquet"), spark.read.parquet(f"{SF}/lineitem.parquet")
    few = part.withColumns({"p_type": F.when(F.col("p_partkey") % 7 != 0, F.concat(F.lit("t"), (F.col("p_partkey") % 3).cast("string"))), "p_size": (F.col("p_partkey") % 2).cast("int"), "p_brand": F.when(F.col("p_partkey") % 50 != 0, F.col("p_brand"))})
    out = {}
    for kind, p in (("odd", few), ("copied", few.union(few.where("p_partkey % 5 = 0")))):
        out[kind] = tmp_path_factory.mktemp(kind)
        p.write.parquet(f"{out[kind]}/part.parquet")
        lines.where("l_partkey % 6 <> 0").union(lines.where("l_orderkey % 4 = 0")).withColumn("l_orderkey", F.expr("if(l_orderkey % 10 = 3, null, l_orderkey)")).write.parquet(f"{out[kind]}/lineitem.parquet")
    return out


@pytest.mark.parametrize("name", NAMES)
@pytest.mark.parametrize("kind", ["odd", "copied"])
def test_odd_tables(spark, tables, kind, name):
    assert crosscheck.plain(spark, str(tables[kind])) == (kind == "odd")
    check(spark, tables[kind], name)


@pytest.mark.parametrize("heads", [1, 40])
def test_examples_beyond_the_first_parts(spark, tables, monkeypatch, heads):
    monkeypatch.setattr(crosscheck, "HEADS", heads)
    check(spark, tables["odd"], "crosscheck_examples")


@pytest.mark.parametrize("name", NAMES)
def test_pairs_are_not_joined_by_name(spark, name):
    """Neither all our pairs nor all external ones go through joins by names."""
    plan = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "known_" not in plan and not any("Join" in line and "ref_a" in line and "ref_b" in line for line in plan.splitlines())
