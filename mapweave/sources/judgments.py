"""Judgment and batch files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapweave import schemas
from mapweave.functions import text as T


def read_json(spark: SparkSession, paths: list[str] | str, schema: str = schemas.JUDGMENTS) -> DataFrame:
    """Rows of files that hold an array, an object with `judgments`, one object, or JSON lines; an empty file has none.

    file and pos say where a row stands: files in name order, then lines, make the order in which the last wins.
    """
    raw = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_name").alias("file"), T.trim(F.col("value")).alias("text"))
    whole = raw.withColumn("v", F.try_parse_json("text"))
    inner = F.try_variant_get("v", "$.judgments", "variant")
    kind = F.schema_of_variant("v")
    array = F.when(kind.startswith("ARRAY"), F.col("v")).when(kind.startswith("OBJECT") & inner.isNotNull(), inner)
    per_line = F.filter(F.transform(T.lines(F.col("text")), T.trim), lambda x: F.length(x) > 0)
    is_lines = (F.size(per_line) > 1) & F.try_parse_json(F.get(per_line, 0)).isNotNull()
    items = F.when(array.isNotNull() & ~is_lines, F.transform(F.try_variant_get(array, "$", "array<variant>"), lambda v: F.to_json(v)))
    items = items.when(kind.startswith("OBJECT") & ~is_lines, F.array("text"))
    rows = whole.select("file", F.posexplode(F.coalesce(items, per_line)).alias("pos", "json"))
    fields = schema.replace("confidence double", "confidence string")
    out = rows.select("file", "pos", F.from_json("json", fields).alias("j")).select("file", "pos", "j.*")
    return out.withColumn("confidence", F.col("confidence").try_cast("double")) if "confidence double" in schema else out


def sequenced(rows: DataFrame) -> DataFrame:
    """rows with seq in place of file and pos: a struct that sorts as they do."""
    return rows.withColumn("seq", F.struct("file", "pos")).drop("file", "pos")


def write_batches(batches: DataFrame, path: str) -> None:
    """One directory a batch; old ones go."""
    batches.drop("batch_no").write.mode("overwrite").partitionBy("batch").json(path)


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """Batch files: folders of write_batches(), or files that hold an array of pairs; anything else is an error."""
    folder = spark.read.option("mode", "FAILFAST").option("multiLine", not path.rstrip("/").endswith("*") and path.endswith(".json")).json(path)
    if "batch" not in folder.columns:
        folder = folder.withColumn("batch", F.regexp_extract(F.col("_metadata.file_name"), "([^/]*)\\.json", 1))
    if "a_id" not in folder.columns or "b_id" not in folder.columns:
        raise ValueError(f"{path} doesn't hold an array of pairs")
    return folder


def write_outputs(judged: DataFrame, path: str) -> None:
    """One directory a batch; those of other batches stay."""
    _replacing(judged, path, "parquet", "batch")


def _replacing(rows: DataFrame, path: str, kind: str, *keys: str) -> None:
    """Only the directories that rows have are replaced."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).format(kind).save(path)


def write_shards(rows: DataFrame, path: str) -> None:
    """JSON lines by framework pair and round; other rounds stay."""
    _replacing(rows.drop("shard"), path, "json", "fw_lo", "fw_hi", "round")


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.JUDGMENTS + ", fw_lo string, fw_hi string, round string").json(path)
