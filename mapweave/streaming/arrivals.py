"""Batch outputs as they arrive: each file is judged once, and the graph's snapshot follows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from mapweave import schemas
from mapweave.operators import adjudicate


def judgments(spark: SparkSession, folder: str, per_trigger: int = 100) -> DataFrame:
    """A stream of JSON-line judgments from files that appear in folder."""
    rows = spark.readStream.schema(schemas.JUDGMENTS).option("maxFilesPerTrigger", per_trigger).json(folder)
    return adjudicate.typed(adjudicate.repaired(rows))


def append_to(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what has arrived so far to a Parquet table, then stop; a later start goes on from there."""
    return rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_counts(events: DataFrame, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events per type and window with a watermark."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
