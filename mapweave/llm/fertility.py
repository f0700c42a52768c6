"""Quality rules from the fertility of public tokenizers.

Words are runs without ASCII white space, which neither vocabulary counts: one with byte fallback (sentencepiece) and one
at byte level (tiktoken, a space before each word). A text's measures are: characters per token of both, the share of its
tokens that are byte fallback, the entropy and the min-entropy of its tokens in bits, and the mean number of tokens a
word takes. Each language, or else script, has bands outside of which a text is rejected. The bands of languages are
fitted_bands() of good documents; those of scripts are wide and set by hand. They are parameters: no figure depends on other
rows.

Base rules: fewer than 50 words, or over half of the words in 3-word windows that come twice or more. Null texts have
no words and fail. Rows that repeat give rows that repeat; a null or unknown language takes the band of its script.
"""

from __future__ import annotations

import base64
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared

SYMBOLS = "#*$%&|<>"
MEMO = 120_000
#: Bytes of texts that are measured together.
SLICE = 1 << 20
PIECES, RANKS = "piece_bpe_32k.model", "byte_bpe_multi_50k.tiktoken"

#: Measures of which a text may have too little, or too much.
LOW, HIGH = ("chars_per_token", "chars_per_token_bytes", "entropy", "min_entropy"), ("tokens_per_word", "byte_share")
#: Of fitted_bands(): the share of good documents outside, and how far a band goes beyond, as a share of the median and at least.
OUTSIDE, MARGIN, LEAST_MARGIN = 0.001, 0.2, 0.05
#: Bands by language, as fitted_bands() gives them for the good labelled documents with an even doc_id of the test tables
#: (sf0.1; of those with an odd one all 1,665 good ones are kept and 161 of 162 bad ones rejected), and by script, wide.
BANDS: dict[str, dict[str, tuple[float, float]]] = {
    "de": {"chars_per_token": (1.605, 99.0), "chars_per_token_bytes": (1.705, 99.0), "entropy": (4.484, 99.0), "min_entropy": (2.636, 99.0), "tokens_per_word": (0.0, 3.46), "byte_share": (0.0, 0.05)},
    "en": {"chars_per_token": (1.544, 99.0), "chars_per_token_bytes": (1.615, 99.0), "entropy": (4.349, 99.0), "min_entropy": (2.638, 99.0), "tokens_per_word": (0.0, 3.158), "byte_share": (0.0, 0.05)},
    "es": {"chars_per_token": (1.413, 99.0), "chars_per_token_bytes": (1.507, 99.0), "entropy": (4.5, 99.0), "min_entropy": (2.719, 99.0), "tokens_per_word": (0.0, 3.508), "byte_share": (0.0, 0.05)},
    "fr": {"chars_per_token": (1.329, 99.0), "chars_per_token_bytes": (1.46, 99.0), "entropy": (4.437, 99.0), "min_entropy": (2.683, 99.0), "tokens_per_word": (0.0, 3.875), "byte_share": (0.0, 0.05)},
    "Latin": {"chars_per_token": (1.2, 9.0), "chars_per_token_bytes": (1.4, 9.0), "tokens_per_word": (0.0, 4.5), "byte_share": (0.0, 0.35), "entropy": (3.5, 99.0), "min_entropy": (2.0, 99.0)},
    "Cyrillic": {"chars_per_token": (1.0, 9.0), "chars_per_token_bytes": (0.8, 9.0), "tokens_per_word": (0.0, 6.0), "byte_share": (0.0, 0.5), "entropy": (3.5, 99.0), "min_entropy": (2.0, 99.0)},
    "Greek": {"chars_per_token": (0.7, 9.0), "chars_per_token_bytes": (0.6, 9.0), "tokens_per_word": (0.0, 9.0), "byte_share": (0.0, 0.6), "entropy": (3.0, 99.0), "min_entropy": (2.0, 99.0)},
    "Han": {"chars_per_token": (0.3, 9.0), "chars_per_token_bytes": (0.3, 9.0), "tokens_per_word": (0.0, 400.0), "byte_share": (0.0, 0.9), "entropy": (3.0, 99.0), "min_entropy": (2.0, 99.0)},
    "other": {"chars_per_token": (0.3, 9.0), "chars_per_token_bytes": (0.25, 9.0), "tokens_per_word": (0.0, 400.0), "byte_share": (0.0, 0.98), "entropy": (3.0, 99.0), "min_entropy": (2.0, 99.0)},
}

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "chars_per_token double, chars_per_token_bytes double, byte_share double, entropy double, min_entropy double, tokens_per_word double, kept boolean"
)


class Fertility:
    """The vocabularies with a bounded memo of words."""

    def __init__(self) -> None:
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(PIECES))
        with open(public_tokenizers.path(RANKS), "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.bytes = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.is_byte = np.array([self.pieces.is_byte(k) for k in range(self.pieces.get_piece_size())])
        self.memo = shared.TwoGenerations(MEMO)

    def words(self, words: list[bytes]) -> list[tuple[bytes, int]]:
        """Per word its piece ids (16-bit) and its number of byte-level tokens."""
        shared.TwoGenerations.only("fertility")
        need = sorted(self.memo.missing(set(words)))
        texts = [w.decode() for w in need]
        ids = self.pieces.encode(texts, num_threads=1)
        count = self.bytes.encode_ordinary
        for word, text, own in zip(need, texts, ids, strict=True):
            self.memo.young[word] = (array("H", own).tobytes(), len(count(" " + text)))
        out = list(map(self.memo.young.__getitem__, words))
        for word in need:
            if len(word) > 64:  # long ones don't stay
                del self.memo.young[word]
        return out


@cache
def fertility() -> Fertility:
    out = Fertility()
    shared.trim()
    return out


shared.OWNED["fertility"] = fertility.cache_clear


def repeated_words(ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per text the words in 3-word windows that it has twice or more; ids: its words as numbers, counts: how many each text has."""
    n = len(ids)
    text = np.repeat(np.arange(len(counts)), counts)
    at = np.flatnonzero(text[2:] == text[:-2]) if n > 2 else np.empty(0, np.int64)
    covered = np.zeros(n, bool)
    if len(at):
        _, two = np.unique(ids[:-1] * (ids.max() + 1) + ids[1:], return_inverse=True)
        _, window = np.unique(two[at] * (ids.max() + 1) + ids[at + 2], return_inverse=True)
        _, own, many = np.unique(text[at] * (window.max() + 1) + window, return_inverse=True, return_counts=True)
        twice = at[many[own] > 1]
        for k in range(3):
            covered[twice + k] = True
    return np.bincount(text[covered], minlength=len(counts))


def measured(texts: list[str | None]) -> dict[str, np.ndarray]:
    """The base figures and the fertility of every text, by column."""
    tool, texts = fertility(), [t or "" for t in texts]
    raw, begins, ends, n = shared.split_words([t.encode() for t in texts])
    first, which = shared.distinct_words(raw, begins, ends)
    words = tool.words([raw[b:e] for b, e in zip(begins[first].tolist(), ends[first].tolist(), strict=True)])
    size = np.array([len(x) // 2 for x, _ in words], np.int64)
    pieces = shared.rows_of(np.frombuffer(b"".join([x for x, _ in words]), np.uint16), (np.cumsum(size) - size)[which], size[which])
    until = np.r_[0, np.cumsum(n)]
    total = lambda x: np.diff(np.r_[0, np.cumsum(x)][until])
    n_pieces = total(size[which])
    out = {
        "n_words": n, "word_chars": np.array([len(t) - sum(map(t.count, " \t\n\v\f\r")) for t in texts], np.int64),
        "n_symbols": np.array([sum(map(t.count, SYMBOLS)) for t in texts], np.int64),
        "n_dup_lines": np.array([repeated_lines(t) for t in texts], np.int64), "n_repeat_words": repeated_words(which, n),
    }
    out["base_failed"] = (n < 50) | (100 * out["n_repeat_words"] > 50 * n)
    chars, some = out["word_chars"], np.maximum(n_pieces, 1)
    entropy = np.zeros((2, len(texts)))
    ends_of = np.cumsum(n_pieces).tolist()
    for k, (end, m) in enumerate(zip(ends_of, n_pieces.tolist(), strict=True)):
        if m:
            counts = np.bincount(pieces[end - m : end])
            counts = counts[counts > 0]
            entropy[:, k] = np.log2(m) - (counts * np.log2(counts)).sum() / m, np.log2(m / counts.max())
    byte = np.r_[0, np.cumsum(tool.is_byte[pieces])][np.r_[0, np.cumsum(n_pieces)]]
    return out | {
        "chars_per_token": chars / some, "chars_per_token_bytes": chars / np.maximum(1, total(np.array([x for _, x in words], np.int64)[which])),
        "byte_share": np.diff(byte) / some, "entropy": entropy[0], "min_entropy": entropy[1], "tokens_per_word": n_pieces / np.maximum(n, 1),
    }


def repeated_lines(text: str) -> int:
    """Lines with a word that are equal to an earlier one."""
    if "\n" not in text:
        return 0
    seen: set[str] = set()
    n = 0
    for line in text.split("\n"):
        if line in seen:
            n += bool(line.strip(" \t\n\v\f\r"))
        seen.add(line)
    return n


def script_of(text: str) -> str:
    """The script with the most characters among a few that the bands name."""
    if text.isascii():
        return "Latin"
    counts = dict.fromkeys(("Latin", "Cyrillic", "Greek", "Han", "other"), 0)
    for char, n in Counter(text).items():
        if char.isalpha():
            at = ord(char)
            name = "Latin" if at < 0x250 else "Greek" if 0x370 <= at < 0x400 else "Cyrillic" if 0x400 <= at < 0x530 else "Han" if 0x3040 <= at < 0xA000 else "other"
            counts[name] += n
    return max(counts, key=counts.__getitem__)


def verdicts(m: dict[str, np.ndarray], texts: list[str | None], langs: list[str | None], bands: dict[str, dict[str, tuple[float, float]]] = BANDS) -> np.ndarray:
    """Whether each text is kept: not base_failed, and every measure within the band of its language, else of its script."""
    kept = ~m["base_failed"]
    names = np.array([lang if lang in bands else script_of(text or "") if good else "" for text, lang, good in zip(texts, langs, kept.tolist(), strict=True)], object)
    for name in set(names) - {""}:
        own = names == name
        for measure, (low, high) in bands[name].items():
            kept[own] &= (m[measure][own] >= low) & (m[measure][own] <= high)
    return kept


def fitted_bands(rows: DataFrame, least_rows: int = 100) -> dict[str, dict[str, tuple[float, float]]]:
    """Bands per language from the measures (of rated()) and lang of good documents that pass the base rules.

    A band ends where the share OUTSIDE of them lies, and further by MARGIN of the median. Languages with fewer rows than
    least_rows get none. The quantiles come from sketches of bounded size.
    """
    quantiles = [F.percentile_approx(c, F.array(F.lit(OUTSIDE if c in LOW else 1 - OUTSIDE), F.lit(0.5)), 100_000).alias(c) for c in (*LOW, *HIGH)]
    found = rows.where("NOT base_failed AND lang IS NOT NULL").groupBy("lang").agg(F.count(F.lit(1)).alias("n"), *quantiles)
    out = {}
    for r in found.where(F.col("n") >= least_rows).collect():  # one row a language
        beyond = {c: max(MARGIN * r[c][1], LEAST_MARGIN) for c in (*LOW, *HIGH)}
        out[r["lang"]] = {c: (max(0.0, round(r[c][0] - beyond[c], 3)), 99.0) for c in LOW} | {c: (0.0, round(r[c][0] + beyond[c], 3)) for c in HIGH}
    return out


def rated(docs: DataFrame) -> DataFrame:
    """Every document with its measures, base_failed and kept. Without a column `lang` all take the band of their script."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = [x.split()[0] for x in SCHEMA.split(", ")][1:]
    kinds = [{"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}[x.split()[1]] for x in SCHEMA.split(", ")[1:]]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in shared.slices(batches, "text", SLICE):
            texts = part.column("text").to_pylist()
            m = measured(texts)
            m["kept"] = verdicts(m, texts, part.column("lang").to_pylist())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(m[c], k) for c, k in zip(names, kinds, strict=True))], ["doc_id", *names])

    return shared.map_arrow(docs.select("doc_id", "text", _lang(docs)), step, SCHEMA.replace("doc_id long", f"doc_id {kind}"))


def _lang(docs: DataFrame) -> Column:
    return (F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")).alias("lang")


def kept(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns. Without a column `lang` all take the band of their script."""
    schema = docs.schema

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in shared.slices(batches, "text", SLICE):
            texts = part.column("text").to_pylist()
            langs = part.column("lang").to_pylist() if "lang" in schema.names else [None] * len(texts)
            yield part.filter(pa.array(verdicts(measured(texts), texts, langs), pa.bool_()))

    return shared.map_arrow(docs, step, schema)
