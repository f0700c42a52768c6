"""Embeddings through a cache by content."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapweave.functions import text as T
from mapweave.operators.adjudicate import with_retries
from mapweave.schemas import Settings

PROMPT_VERSION = "v1"


def embed_input(intent: Column, instruction: str) -> Column:
    return F.concat(F.lit(instruction), intent)


def cache_key(text: Column, model: str, prompt_version: str = PROMPT_VERSION) -> Column:
    return F.sha2(F.concat_ws("\n", F.lit(model), F.lit(prompt_version), text), 256)


def targets(nodes: DataFrame, settings: Settings, model: str, instruction: str) -> DataFrame:
    """id, key, text of the mappable nodes with an intent."""
    rows = nodes.where(F.col("node_type").isin(*settings.mappable_types) & (F.length("canonical_intent") > 0))
    text = embed_input(F.col("canonical_intent"), instruction)
    return rows.select("id", cache_key(text, model).alias("key"), text.alias("text"))


def skipped(nodes: DataFrame, settings: Settings) -> DataFrame:
    return nodes.where(F.col("node_type").isin(*settings.mappable_types) & ~F.coalesce(F.length("canonical_intent") > 0, F.lit(False)))


def to_do(rows: DataFrame, cache: DataFrame) -> DataFrame:
    """What the cache lacks, each content once."""
    return rows.select("key", "text").dropDuplicates(["key"]).join(cache.select("key").distinct(), "key", "left_anti")


def embedded(todo: DataFrame, embedder: Callable[[list[str]], list[list[float]]], model: str, batch: int = 16) -> DataFrame:
    """New rows of the cache: key, model, vector; the embedder is called on executors with up to `batch` texts."""
    call = with_retries(embedder, 2)

    def step(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            vectors = [v for at in range(0, len(part), batch) for v in call(part["text"].iloc[at : at + batch].tolist())]
            yield pd.DataFrame({"key": part["key"], "model": model, "vector": vectors})

    return todo.mapInPandas(step, "key string, model string, vector array<double>")


def attached(nodes: DataFrame, rows: DataFrame, cache: DataFrame, model: str) -> DataFrame:
    """nodes with embedding, embedding_model and embedding_dim from the cache."""
    vectors = rows.select("id", "key").join(cache.select("key", "vector").dropDuplicates(["key"]), "key").select("id", F.col("vector").alias("_v"))
    out = nodes.join(vectors, "id", "left")
    has = F.col("_v").isNotNull()
    return out.withColumns({"embedding": F.coalesce("_v", "embedding"), "embedding_model": F.when(has, F.lit(model)).otherwise(F.col("embedding_model")), "embedding_dim": F.when(has, F.size("_v")).otherwise(F.col("embedding_dim"))}).drop("_v").select(*nodes.columns)


def canonicalised(nodes: DataFrame, canonicaliser: Callable[[list[str]], list[str]], mappable: tuple[str, ...] = Settings().mappable_types, batch: int = 16) -> DataFrame:
    """nodes with canonical_intent written from the raw text where a mappable node has none; called on executors."""
    call, empty = with_retries(canonicaliser), F.col("node_type").isin(*mappable) & ~T.filled(F.col("canonical_intent"))

    def step(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            texts = part["raw_text"].fillna("").tolist()
            yield pd.DataFrame({"raw_text": part["raw_text"], "_intent": [x for at in range(0, len(texts), batch) for x in call(texts[at : at + batch])]})

    todo = nodes.where(empty & F.col("raw_text").isNotNull()).select("raw_text").distinct()
    found = todo.mapInPandas(step, "raw_text string, _intent string")
    return nodes.join(found, "raw_text", "left").withColumn("canonical_intent", F.when(empty, F.coalesce("_intent", "canonical_intent")).otherwise(F.col("canonical_intent"))).select(*nodes.columns)


def hashing_embedder(dim: int = 64) -> Callable[[list[str]], list[list[float]]]:
    """A stand-in without a model: signed counts of hashed words, the same on every machine."""
    import zlib

    def call(texts: list[str]) -> list[list[float]]:
        out = []
        for text in texts:
            v = np.zeros(dim)
            for word in text.lower().split():
                h = zlib.crc32(word.encode())
                v[h % dim] += 1 if h >> 16 & 1 else -1
            out.append((v / (np.linalg.norm(v) or 1)).tolist())
        return out

    return call
