"""BPE encoding and decoding by a tokenization automaton.

The merge list is compiled into a deterministic automaton over tokens by applying one gadget per
merge, in order. It starts as one state with a loop for every base symbol. The gadget for (u, v)
looks at the state p that u leads to: if p still has an arc for v, then u leads from now on to a copy
of p without that arc, and the new token uv leads where v led from p, from every state that had an
arc for u. All arcs of a token share one target, so the automaton is kept as a table of lost arcs.
Every string has exactly one path through it, and so has each of its prefixes.

For encoding, the automaton over tokens is turned into one over the symbols of a pre-split word: a
state is the set of tokens that are under way, each with the state of the token automaton that it
left, and the token that ends the one path of the prefix read so far. Its transitions stand in
integer tables that are filled when first taken, and all words of a batch go through them together,
symbol by symbol; the path is read from the word's end, each state naming its last token. Decoding
emits the labels of the arcs.

Null texts count as empty; an empty text has no tokens. Rows that repeat give rows that repeat.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from . import shared

#: A last symbol of a word is kept as the symbol's byte plus this.
_LAST = 0x100
#: Code points of Latin script and what goes with it; without those that libraries see differently as white space.
_PLAIN = np.array([not (0x1C <= c <= 0x1F or c in (0x85, 0xA0)) for c in range(0x250)])
_SPACE = re.compile("[ \t\n\v\f\r]")
#: Symbols of texts that go through the tables at once; a longer text is cut at white space.
BATCH = 2 << 20
#: States of the table after which it is begun anew.
STATES = 300_000
#: Kinds of characters in pre-splitting; UNKNOWN: unassigned, so the libraries' Unicode versions may differ.
SPACE, LETTER, NUMBER, OTHER, UNKNOWN = range(5)


def _byte_symbols() -> list[str]:
    """The printable stand-ins of the 256 bytes in byte-level vocabularies: printable Latin-1 stands for itself."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


@cache
def _kinds() -> np.ndarray:
    """The kind of every code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.empty(0x110000, np.uint8)
    for c in range(0x110000):
        category = unicodedata.category(chr(c))
        out[c] = UNKNOWN if category == "Cn" else kinds.get(category[0], OTHER)
    out[[9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = SPACE
    return out


class Automaton:
    """The compiled merges over tokens; `labels` are what arcs emit.

    A state is what a token leads to. It differs from the start state by the arcs that gadgets took from it: those
    of its token's own merges, and, as a merged token leads where its right part led at the time, those taken from the
    right part before the merge, and so on. `_cut` holds for each such (token, lost arc) the step of the gadget.
    """

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = "") -> None:
        self.labels = [""] * (max(vocab.values()) + 1)
        for label, token in vocab.items():
            self.labels[token] = label
        self.suffix = suffix
        self._byte = {shown: b for b, shown in enumerate(_byte_symbols())}
        self._made = [-1] * len(self.labels)
        self._left = [-1] * len(self.labels)
        self._right = [-1] * len(self.labels)
        self._cut: dict[int, int] = {}
        self._held: dict[int, bool] = {}
        known = {t for label, t in vocab.items() if len(self.symbols(label)) == 1}
        for step, (a, b) in enumerate(merges):
            u, v, w = vocab[a], vocab[b], vocab[a + b]
            if w not in known and self._has_arc(u, v):
                known.add(w)
                self._cut[u << 20 | v] = step
                self._made[w], self._left[w], self._right[w] = step, u, v
        self.tokens = sorted(known)

    def symbols(self, label: str) -> list[int]:
        """The bytes that a label stands for; the last one is marked if the label ends a word."""
        last = self.suffix and label.endswith(self.suffix) and len(label) > len(self.suffix)
        out = [self._byte.get(x, 0) for x in (label[: -len(self.suffix)] if last else label)]
        if last:
            out[-1] += _LAST
        return out

    def has_arc(self, before: int, token: int) -> bool:
        """Whether the state after `before` (-1: the start) has an arc for `token`."""
        if before < 0:
            return True
        key = before << 20 | token
        held = self._held.get(key)
        if held is None:
            if len(self._held) > 200_000:
                self._held.clear()
            held = self._held[key] = self._has_arc(before, token)
        return held

    def _has_arc(self, before: int, token: int) -> bool:
        """None of the arcs it is built on was lost in time."""
        cut, made, left, right = self._cut, self._made, self._left, self._right
        spine, above = [], 1 << 60
        while token >= 0:
            spine.append((token, above))
            above, token = made[token], left[token]
        until = 1 << 60
        while before >= 0:
            for arc, built in spine:
                when = cut.get(before << 20 | arc)
                if when is not None and when < until and when <= built:
                    return False
            until, before = made[before], right[before]
        return True


class Table:
    """The automaton over symbols, as integer arrays: `arcs` (state << 9 | symbol, then the state it leads to, 32 bits each)
    by open addressing, and per state its last token and that token's length."""

    def __init__(self, automaton: Automaton) -> None:
        self.automaton = automaton
        self._child: dict[int, int] = {}
        self._token, self._inner, self._size = [-1], [True], {}
        for token in automaton.tokens:
            node, own = 0, automaton.symbols(automaton.labels[token])
            self._size[token] = len(own)
            for symbol in own:
                key = node << 9 | symbol
                below = self._child.get(key)
                if below is None:
                    self._inner[node] = True
                    below = self._child[key] = len(self._token)
                    self._token.append(-1)
                    self._inner.append(False)
                node = below
            self._token[node] = token
        self.clear()

    def clear(self) -> None:
        self._states: list[bytes] = []
        self._known: dict[bytes, int] = {}
        self.last, self.length = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int32)
        self._n_arcs = 0
        self._empty(1 << 18)
        self._state(struct.pack("2i", 0, -1), -1)

    @property
    def n_states(self) -> int:
        return len(self._states)

    def _empty(self, size: int) -> None:
        self.arcs = np.full(size, -1, np.int64)
        self._shift = np.uint64(64 - (size.bit_length() - 1))

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self._shift).view(np.int64)

    def _state(self, what: bytes, token: int) -> int:
        state = self._known.get(what)
        if state is None:
            state = self._known[what] = len(self._states)
            self._states.append(what)
            if state >= len(self.last):
                self.last, self.length = np.r_[self.last, self.last], np.r_[self.length, self.length]
            self.last[state], self.length[state] = token, self._size.get(token, 0)
        return state

    def _made(self, state: int, symbol: int) -> int:
        """Where the symbol leads to: of the tokens that end here just one goes on the path of what stands before it."""
        under_way, token, child = [], -1, self._child
        for node, before in struct.iter_unpack("2i", self._states[state]):
            node = child.get(node << 9 | symbol, -1)
            if node < 0:
                continue
            own = self._token[node]
            if token < 0 <= own and self.automaton.has_arc(before, own):
                token = own
            if self._inner[node]:
                under_way += (node, before)
        if token < 0:
            raise ValueError("a symbol that the vocabulary lacks")
        return self._state(struct.pack(f"{len(under_way) + 2}i", *under_way, 0, token), token)

    def _add(self, keys: np.ndarray) -> None:
        arcs = np.array([key << 32 | self._made(key >> 9, key & 0x1FF) for key in keys.tolist()], np.int64)
        self._n_arcs += len(arcs)
        if 2 * self._n_arcs > len(self.arcs):
            arcs = np.r_[self.arcs[self.arcs >= 0], arcs]
            self._empty(1 << (4 * self._n_arcs - 1).bit_length())
        slots = self._slots(arcs >> 32)
        while len(arcs):
            free = self.arcs[slots] < 0
            self.arcs[slots[free]] = arcs[free]  # of several for one slot the last stays, the others go on
            on = self.arcs[slots] != arcs
            arcs, slots = arcs[on], (slots[on] + 1) & (len(self.arcs) - 1)

    def step(self, keys: np.ndarray) -> np.ndarray:
        """The states that these (state << 9 | symbol) lead to."""
        slots = self._slots(keys)
        out = self.arcs[slots]
        todo = np.flatnonzero(out >> 32 != keys)
        if len(todo):
            slots, lacking = slots[todo], []
            while len(todo):
                found = self.arcs[slots]
                out[todo] = found
                lacking.append(todo[found < 0])
                on = (found >= 0) & (found >> 32 != keys[todo])
                todo, slots = todo[on], (slots[on] + 1) & (len(self.arcs) - 1)
            lacking = np.concatenate(lacking)
            if len(lacking):
                new, which = np.unique(keys[lacking], return_inverse=True)
                self._add(new)
                out[lacking] = self.step(new)[which]
        return out & 0xFFFFFFFF

    def run(self, raw: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """For each byte the token that ends there on a word's path, else -1; words: begins and ends (excluded)."""
        order = np.argsort(begins - ends, kind="stable")
        begin, size = begins[order], (ends - begins)[order]
        at = np.zeros(len(raw), np.int32)
        state = np.zeros(len(order), np.int64)
        until = np.searchsorted(-size, -np.arange(size.max(initial=0)))
        marked = bool(self.automaton.suffix) * _LAST
        for t, n in enumerate(until.tolist()):
            place = begin[:n] + t
            symbol = raw[place] + marked * (size[:n] == t + 1)
            state = self.step(state[:n] << 9 | symbol)
            at[place] = state
        out = np.full(len(raw), -1, np.int32)
        while len(ends):
            state = at[ends - 1]
            out[ends - 1] = self.last[state]
            ends = ends - self.length[state]
            on = ends > begins
            begins, ends = begins[on], ends[on]
        return out

    def encode(self, raw: bytes, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all words, one after the other, and how many each word has. Each different word goes through the
        tables once."""
        first, which = shared.distinct_words(raw, begins, ends)
        sizes = (ends - begins)[first]
        own = np.cumsum(sizes)
        found = self.run(shared.rows_of(np.frombuffer(raw, np.uint8), begins[first], sizes).astype(np.int64), own - sizes, own)
        places = np.flatnonzero(found >= 0)
        until = np.searchsorted(places, own)
        n = np.diff(np.r_[0, until])
        return shared.rows_of(found[places], (until - n)[which], n[which]), n[which]


class Encoder:
    """Encodes whole texts as the vocabulary file says: added tokens, normalizer, pre-split words, automaton."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        kinds = [x["type"] for x in spec["normalizer"]["normalizers"]]
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or split != r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+":
            raise ValueError("made for lower-casing word-end BPE files")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.table = Table(Automaton(model["vocab"], merges, model.get("end_of_word_suffix") or ""))
        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self._added = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")") if self.added else None
        library = Tokenizer.from_file(path)
        self._normalize, self._presplit = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self._byte = {shown: b for b, shown in enumerate(_byte_symbols())}
        self.labels = [x.encode() for x in self.table.automaton.labels]
        for label, token in self.added.items():
            self.labels += [b""] * (token + 1 - len(self.labels))
            self.labels[token] = label.encode()

    def normalized(self, text: str) -> str:
        """Composed and lower-cased; runs of white space may stay."""
        if text.isascii():
            return text.lower()
        units = np.frombuffer(text.encode("utf-16-le"), "<u2")
        if units.max() < len(_PLAIN) and _PLAIN[units].all():
            return unicodedata.normalize("NFC", text).lower()
        return self._normalize(text)

    def _split(self, joined: str) -> tuple[bytes, np.ndarray, np.ndarray] | None:
        """The bytes of the text and where its words begin and end; None if there are unassigned code points."""
        raw = joined.encode()
        if len(raw) == len(joined):
            points, kind = np.frombuffer(raw, np.uint8), np.frombuffer(raw.translate(_kinds()[:256].tobytes()), np.uint8)
        else:
            points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
            kind = _kinds()[points]
        if (kind == UNKNOWN).any():
            return None
        before = np.r_[np.uint8(SPACE), kind[:-1]]
        starts = (kind != SPACE) & ((kind != before) | (kind == NUMBER))
        for i in np.flatnonzero((points == 39) & starts).tolist():  # contractions; a longer run of signs is one word
            a, b = [chr(c) for c in points[i + 1 : i + 3].tolist() + [32, 32]][:2]
            size = 2 if a in "stmd" else 3 if a + b in ("re", "ve", "ll") else 0
            if size:
                starts[i + 1] = False
                if i + size < len(kind) and kind[i + size] == LETTER:
                    starts[i + size] = True
        bounds = np.flatnonzero(starts | (kind == SPACE))
        own = starts[bounds]
        begins, ends = bounds[own], np.r_[bounds[1:], len(kind)][own] if len(bounds) else bounds
        if len(raw) != len(joined):
            width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
            places = np.r_[0, np.cumsum(width)]
            begins, ends = places[begins], places[ends]
        return raw, begins, ends

    def _units(self, units: list[str]) -> list[bytes]:
        """Ids of normalized texts without added tokens."""
        if self.table.n_states > STATES:
            self.table.clear()
        split = self._split(" ".join(units))
        if split is None:
            if len(units) > 1:
                return [self._units([x])[0] for x in units]
            words = [bytes(map(self._byte.__getitem__, shown)) for shown, _ in self._presplit(units[0])]
            ends = np.cumsum([len(x) for x in words], dtype=np.int64)
            split = b"".join(words), np.r_[np.int64(0), ends[:-1]][: len(ends)], ends
            return [self.table.encode(*split)[0].astype("<u4").tobytes()]
        tokens, n = self.table.encode(*split)
        ids, until = tokens.astype("<u4").tobytes(), np.r_[0, np.cumsum(n)]
        ends = np.cumsum([(len(x) if x.isascii() else len(x.encode())) + 1 for x in units])
        cuts = [0, *(4 * until[np.searchsorted(split[1], ends)]).tolist()]
        return [ids[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Per text its ids as little-endian unsigned 32-bit integers."""
        shared.TwoGenerations.only("bpe")
        out: list[list[bytes]] = [[] for _ in texts]
        units: list[tuple[int, int, str]] = []
        size = 0

        def flush() -> None:
            nonlocal size
            for (text, at, _), ids in zip(units, self._units([x for _, _, x in units]) if units else (), strict=True):
                out[text][at] = ids
            units.clear()
            size = 0

        for k, text in enumerate(texts):
            parts = self._added.split(text) if self._added is not None and "<|" in text else [text]
            for j, part in enumerate(parts):
                if j % 2:
                    out[k].append(self.added[part].to_bytes(4, "little"))
                    continue
                part = self.normalized(part)
                while part:
                    cut = _SPACE.search(part, BATCH) if len(part) > BATCH else None
                    piece, part = (part[: cut.start()], part[cut.end() :]) if cut else (part, "")
                    units.append((k, len(out[k]), piece))
                    out[k].append(b"")
                    size += len(piece)
                    if size > BATCH:
                        flush()
        flush()
        return [x[0] if len(x) == 1 else b"".join(x) for x in out]

    def decode(self, ids: bytes) -> bytes:
        """The labels in UTF-8; the file names no decoder, so a space stands between two."""
        return b" ".join(map(self.labels.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@cache
def encoder(path: str) -> Encoder:
    """One per worker process; what was only needed to make it is given back."""
    out = Encoder(path)
    shared.trim()
    return out


shared.OWNED["bpe"] = encoder.cache_clear


def encoded(df: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ids (binary, little-endian unsigned 32-bit) and decoded (binary, UTF-8) of every whole text."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(vocabulary)
        for part in shared.slices(batches, "text"):
            ids = tool.encode_batch([t or "" for t in part.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(ids, pa.binary()), pa.array([tool.decode(x) for x in ids], pa.binary())], ["key", "ids", "decoded"])

    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return shared.map_arrow(rows, step, f"key {kind}, ids binary, decoded binary").withColumnRenamed("key", key)


def digests(df: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """As encoded(), but only the count and digests leave the worker."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(vocabulary)
        for part in shared.slices(batches, "text"):
            ids = tool.encode_batch([t or "" for t in part.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([
                part.column("key"),
                pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                pa.array([hashlib.sha256(tool.decode(x)).hexdigest() for x in ids], pa.string()),
            ], ["key", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return shared.map_arrow(rows, step, f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("key", key)
