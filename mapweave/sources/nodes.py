"""Node files: JSON in two shapes, and Parquet as the store."""

from __future__ import annotations

import json
import os
import textwrap

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapweave import schemas

_NODE = schemas.NODES.replace("extra map<string,string>", "extra string")
_KNOWN = {field.split()[0] for field in _NODE.split(", ")}
_REQUIRED = ("id", "framework", "version", "native_ref", "node_type", "title", "raw_text")


def variant(path: str, suffix: str) -> str:
    """The path with the suffix before its extension."""
    stem, dot, extension = path.rpartition(".")
    return f"{stem}{suffix}.{extension}" if dot and "/" not in extension else path + suffix


def read_json(spark: SparkSession, paths: list[str] | str, strict: bool = True, sequenced: bool = False) -> DataFrame:
    """Nodes of {"nodes": [...]} or [...] files, all together; strict: unknown or missing required fields are errors.

    sequenced: with seq, the file and the place in it, which sort as the last wins.
    """
    raw = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.parse_json("value").alias("doc"))
    array = F.when(F.schema_of_variant("doc").startswith("ARRAY"), F.col("doc")).otherwise(F.try_variant_get("doc", "$.nodes", "variant"))
    items = raw.select("file", F.posexplode(F.try_variant_get(array, "$", "array<variant>")).alias("pos", "v"))
    cells = items.select("file", "pos", F.to_json("v").alias("json"))
    fields = F.json_object_keys("json")
    if strict:
        extra = F.array_except(fields, F.array(*(F.lit(x) for x in sorted(_KNOWN))))
        lacking = F.array_except(F.array(*(F.lit(x) for x in _REQUIRED)), fields)
        message = F.concat(F.lit("node with unknown fields ["), F.array_join(extra, ","), F.lit("], without ["), F.array_join(lacking, ","), F.lit("] in "), F.col("file"))
        cells = cells.withColumn("json", F.when((F.size(extra) > 0) | (F.size(lacking) > 0), F.raise_error(message).cast("string")).otherwise(F.col("json")))
    node = F.from_json("json", _NODE)
    rows = cells.select(node.alias("n"), F.struct("file", "pos").alias("seq")).select("n.*", *(["seq"] if sequenced else []))
    return rows.withColumn("extra", F.coalesce(F.from_json("extra", "map<string,string>"), F.create_map().cast("map<string,string>")))


def keys(nodes: DataFrame) -> DataFrame:
    """Only what references need."""
    return nodes.select("id", "framework", F.col("native_ref").alias("ref"))


def write_json(nodes: DataFrame, path: str) -> None:
    """A directory of JSON-lines parts; non-ASCII text as it is."""
    nodes.write.mode("overwrite").json(path)


def write_document(nodes: DataFrame, path: str) -> int:
    """One {"nodes": [...]} file, indented, non-ASCII text as it is; nodes come to the driver one partition at a time."""
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    n = 0
    with open(path, "w", encoding="utf-8") as file:
        file.write('{\n  "nodes": [')
        for n, row in enumerate(nodes.drop("seq").orderBy("id").toLocalIterator(), 1):
            body = json.dumps(row.asDict(recursive=True), ensure_ascii=False, indent=2)
            file.write((",\n" if n > 1 else "\n") + textwrap.indent(body, "    "))
        file.write("\n  ]\n}\n" if n else "]\n}\n")
    return n


def store(nodes: DataFrame, path: str) -> None:
    nodes.write.mode("overwrite").partitionBy("framework").parquet(path)
