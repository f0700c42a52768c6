"""Schemas, vocabularies and settings."""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values that results depend on.
MAPPABLE_TYPES = ("outcome", "control", "clause", "requirement", "principle", "statement")
RELATIONS = ("EQUIVALENT", "PARTIAL", "SUPPORTS", "INFORMS")
NO_RELATION = "no_relation"
CONTAINS = "CONTAINS"
TEXT_LIMIT, TEXT_MARK = 600, " [...]"
TITLE_LIMIT = 80
DOWNGRADE_CONFIDENCE = 0.75
STRONG_CONFIDENCE = 0.8

NODES = (
    "id string, framework string, version string, native_ref string, node_type string, title string, raw_text string, canonical_intent string, "
    "parent_id string, extra map<string,string>, embedding array<double>, embedding_model string, embedding_dim int"
)
JUDGMENTS = (
    "source_fw string, source_ref string, target_fw string, target_ref string, relation string, confidence double, rationale string, "
    "conflict boolean, method string, adjudicator string"
)
DOWNGRADES = "source_fw string, source_ref string, target_fw string, target_ref string, new_relation string, new_conflict boolean, note string"
STRM = "framework string, scf_id string, ref string, name string, rel string, sor int"


@dataclass(frozen=True)
class Settings:
    """What a run may change; passed to operators instead of being global."""

    mappable_types: tuple[str, ...] = MAPPABLE_TYPES
    k: int = 8
    floor: float = 0.50
    intra_k: int = 6
    intra_floor: float = 0.58
    intra: tuple[str, ...] = field(default=())
    judge_batch: int = 35
    embed_batch: int = 16
