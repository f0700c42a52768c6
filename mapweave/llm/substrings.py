"""Near-duplicate passages by compact windows.

A text is the sequence of its shingles of five lower-cased words. For each of several hash functions the Cartesian tree
over the shingles' hashes gives compact windows (l, c, r): all subsequences within l..r that hold c have the hash of c as
their minimum. Only tree nodes wide enough for a passage of MIN_SHINGLES matter. The windows of two functions are joined
by interval within the text: where both hold for passages of that length, all these passages share a signature of two
minima. Signatures meet in an equality join over all texts, for several pairs of functions; what meets is verified on
the shingles themselves: aligned stretches of at least MIN_SHINGLES whose sets of shingles have a Jaccard similarity of
at least SIMILARITY.

Texts with the same words are one text with many documents. Texts of a crowded signature are compared with its smallest
text, so a passage shared by any number of texts gives as many links, not their square, and so does one that a text has
many times. What they have beside that text is
divided: of the rows whose passages aren't all exact repeats of an earlier text, in signatures of which some passage wasn't
found at all (a passage counts as found if all but one word's shingles are), the least pair of neighbouring shingles that the smallest text lacks is a key below the signature (under as
many functions as there are pairs), and a passage without such a pair is a key itself. Two texts with the same passage
have the same keys for it, so they are compared or the passage is found with an earlier text; and so on until no key is
crowded by what isn't found. Each round adds a pair of shingles that all texts of a key share, so they end.

In the first shuffle a signature with many rows in a batch sends one of them to the others' task; the rest go elsewhere.

Null texts count as empty; texts of fewer than 50 words have no passages. A null doc_id takes part in nothing. Of rows
that repeat a doc_id with the same words one counts; those with other words are texts of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import shared
from .simhash import _UPPER, mixed

WIDTH = 5
MIN_SHINGLES = 46
SIMILARITY = 0.8
#: Pairs of hash functions.
PAIRS = 3
#: Up to so many texts of a signature are compared each with each.
FEW = 16
#: Bytes of texts that are hashed together: arrays of about a hundred times that are held meanwhile.
SLICE = 1 << 19
#: Shingles on both sides of a candidate that are compared as well, as a passage may go on beyond an edit.
BESIDE = 23
#: Bytes up to which a table about texts or keys is sent to every executor.
SMALL_BYTES = 16 << 20


#: An odd factor and its inverse modulo 2^64.
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)


#: The longest powers made so far, up to KEPT of them; longer ones are made for one use.
_MADE: list[tuple[np.ndarray, np.ndarray]] = []
KEPT = 1 << 21


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers, or more, of the factor and of its inverse, modulo 2^64."""
    if _MADE and len(_MADE[0][0]) >= n:
        return _MADE[0]
    out = []
    for base in (_FACTOR, _INVERSE):
        x = np.full(n, base, np.uint64)
        x[0] = 1
        out.append(np.multiply.accumulate(x))
    if n <= KEPT:
        _MADE[:] = [(out[0], out[1])]
    return out[0], out[1]


shared.OWNED["substrings"] = _MADE.clear


def hashed_shingles(texts: list[str | None], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of all texts, and how many each text has (fewer words than `width`: none).

    A shingle's hash is its bytes as digits of a number modulo 2^64, mixed: the difference of two prefix sums, shifted.
    """
    joined = [b" ".join((t or "").encode().translate(_UPPER).split()) for t in texts]
    raw = np.frombuffer(b" ".join([*joined, b""]), np.uint8)
    up, down = _powers(1 << max(12, len(raw).bit_length()))
    sums = np.r_[np.uint64(0), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)])]
    ends = np.flatnonzero(raw == 32)  # of words; an empty text ends an empty word
    begins = np.r_[0, ends[:-1] + 1] if len(ends) else ends
    text_ends = np.cumsum([len(x) + 1 for x in joined]) if joined else np.empty(0, np.int64)
    words_until = np.searchsorted(ends, text_ends - 1, side="right") if joined else text_ends
    n_words = np.diff(np.r_[0, words_until])
    empty = np.array([not x for x in joined], bool)
    counts = np.where(empty, 0, np.maximum(n_words - width + 1, 0))
    first_word = np.r_[0, words_until[:-1]] if len(words_until) else words_until
    at = np.repeat(first_word - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    b, e = begins[at], ends[at + width - 1]
    h = (sums[e] - sums[b]) * down[b]
    return mixed(h + np.uint64(width), 1), counts


def minima(h: np.ndarray, width: int) -> np.ndarray:
    """For each window of that width the place of its smallest value; the places' bits replace the values' lowest ones."""
    n = len(h)
    bits = np.uint64(max(20, n.bit_length()))
    placed = (h >> bits << bits) | np.arange(n, dtype=np.uint64)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = placed
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(right[: n - width + 1], left[width - 1 : n])
    return (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def compact_windows(h: np.ndarray, width: int, counts: np.ndarray | None = None) -> np.ndarray:
    """Rows (l, c, r) of the Cartesian trees' nodes that are at least `width` wide, by c; equal values: the left one is above.

    counts: how many of the values each text has (none: one text). A node is that wide if and only if it is the minimum of
    some window of that width, and the nodes above it are wider, so the tree of these places is the top of the whole tree.
    """
    counts = np.array([len(h)]) if counts is None else counts
    text_ends = np.cumsum(counts)
    starts = _starts(counts, width)
    if not len(starts):
        return np.empty((0, 3), np.int64)
    places = minima(h, width)[starts]
    wide = places[np.r_[True, places[1:] != places[:-1]]]
    text = np.searchsorted(text_ends, wide, side="right")
    bits = np.uint64(max(20, len(h).bit_length()))
    values, first, last = (h[wide] >> bits).view(np.int64), (text_ends - counts)[text], (text_ends - 1)[text]
    before = _nearest(values, text, lambda there, here: there > here)
    after = len(wide) - 1 - _nearest(values[::-1], text[::-1], lambda there, here: there >= here)[::-1]
    left = np.where(before >= 0, wide[np.maximum(before, 0)] + 1, first)
    right = np.where(after < len(wide), wide[np.minimum(after, len(wide) - 1)] - 1, last)
    return np.stack([left, wide, right], axis=1)


def _nearest(values: np.ndarray, text: np.ndarray, passed: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """For each value the last place before it in its text that isn't passed over, or -1: the tree's links, all at once. A place
    that is passed over has passed over all between it and its own link, so the links are followed in doubling steps."""
    held = np.r_[np.int64(-1), values]  # the first place ends every text
    link = np.arange(len(values) + 1) - 1
    link[0] = 0
    link[1:][np.r_[True, text[1:] != text[:-1]][: len(values)]] = 0
    todo = np.arange(1, len(held))
    while len(todo):
        todo = todo[(link[todo] > 0) & passed(held[link[todo]], held[todo])]
        link[todo] = link[link[todo]]
    return link[1:] - 1


def _starts(counts: np.ndarray, width: int) -> np.ndarray:
    """Where passages of that width can start, of all texts one after the other."""
    n = np.maximum(counts - width + 1, 0)
    return np.repeat(np.cumsum(counts) - counts - (np.cumsum(n) - n), n) + np.arange(n.sum())


def signatures(h: np.ndarray, counts: np.ndarray, width: int, pairs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys, the text each is of, and the first and last shingle (within the text) of the passages that share it."""
    text_begins = np.cumsum(counts) - counts
    out: tuple[list, list, list, list] = ([], [], [], [])
    for pair in range(pairs):
        begins, values = [], []
        for k in (2 * pair, 2 * pair + 1):
            own = mixed(h, k + 2)
            windows = compact_windows(own, width, counts)
            begins.append(np.maximum(windows[:, 0], windows[:, 1] - width + 1))  # the first start of a passage with this minimum
            values.append(own[windows[:, 1]])
        cuts = np.union1d(*begins)
        if not len(cuts):
            continue
        held = [v[np.searchsorted(b, cuts, side="right") - 1] for b, v in zip(begins, values, strict=True)]
        text = np.searchsorted(text_begins + counts, cuts, side="right")
        last_start = np.minimum(np.r_[cuts[1:] - 1, np.iinfo(np.int64).max], (text_begins + counts - width)[text])
        for to, x in zip(out, (mixed(held[0] ^ mixed(held[1], 3), pair + 1), text, cuts - text_begins[text], last_start + width - 1 - text_begins[text]), strict=True):
            to.append(x)
    kinds = (np.uint64, np.int64, np.int64, np.int64)
    return tuple(np.concatenate(x) if x else np.empty(0, k) for x, k in zip(out, kinds, strict=True))


#: Texts are named by their document and the hash of their raw text, as a doc_id may repeat with other texts.
_ROWS = "key long, doc long, hash long, span long, kind byte"
#: The bit of keys that stand for one passage: all texts under such a key have just that passage.
_WHOLE = np.uint64(1)
#: Kinds of rows: alone in its batch, one that stands for others of its batch, one that another stands for.
ALONE, STANDS, AWAY = range(3)


def _named(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("hash"), "text")


def _texts(named: DataFrame) -> DataFrame:
    """doc, hash, words (digest of the lower-cased words) and n_words of every text that may have a passage."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in shared.slices(batches, "text", SLICE):
            split = [(t or "").encode().translate(_UPPER).split() for t in part.column("text").to_pylist()]
            n = np.array([len(x) for x in split], np.int64)
            words = [xxhash.xxh3_128_digest(b" ".join(x)) for x in split]
            out = pa.RecordBatch.from_arrays([part.column("doc"), part.column("hash"), pa.array(words, pa.binary()), pa.array(n)], ["doc", "hash", "words", "n_words"])
            yield out.filter(pa.array(n >= MIN_SHINGLES + WIDTH - 1))

    return shared.map_arrow(named, step, "doc long, hash long, words binary, n_words long")


def _dealt(keys: np.ndarray, doc: np.ndarray, hashes: np.ndarray, span: np.ndarray) -> pa.RecordBatch:
    """Rows with their kinds: of a key with more than FEW rows in the batch the smallest stands for the others, so that no
    key has more than FEW rows of a batch in the shuffle by keys."""
    kind = np.zeros(len(keys), np.int8)
    _, which, counts = np.unique(keys, return_inverse=True, return_counts=True)
    many = np.flatnonzero(counts[which] > FEW)
    many = many[np.lexsort((span[many], hashes[many], doc[many], keys[many]))]
    first = np.r_[True, keys[many][1:] != keys[many][:-1]] if len(many) else np.empty(0, bool)
    kind[many] = np.where(first, STANDS, AWAY)
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (keys.view(np.int64), doc, hashes, span, kind)], ["key", "doc", "hash", "span", "kind"])


def _windows(named: DataFrame, width: int, pairs: int) -> DataFrame:
    """The signatures of every text; span: first << 32 | last shingle of the passages that share one."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared.TwoGenerations.only("substrings")
        for part in shared.slices(batches, "text", SLICE):
            keys, text, first, last = signatures(*_plain(part), width, pairs)
            yield _dealt(keys & ~_WHOLE, part.column("doc").to_numpy()[text], part.column("hash").to_numpy()[text], first << 32 | last)

    return shared.map_arrow(named, step, _ROWS)


def _plain(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return hashed_shingles(part.column("text").to_pylist())


def _groups(batches: Iterator[pa.RecordBatch], n_keys: int, most: int = 0) -> Iterator[tuple[list[np.ndarray], np.ndarray, bool]]:
    """Sorted batches as columns and the begins of their groups (equal first n_keys columns), each group whole; with
    `most`, a longer group comes in parts: then alone, marked True."""
    held: list[np.ndarray] | None = None
    parted = False
    for batch in batches:
        own = [x.to_numpy(zero_copy_only=False) for x in batch.columns]
        if not len(own[0]):
            continue
        now = own if held is None else [np.concatenate(x) for x in zip(held, own, strict=True)]
        new = np.zeros(len(now[0]), bool)
        new[0] = True
        for x in now[:n_keys]:
            new[1:] |= x[1:] != x[:-1]
        begins = np.flatnonzero(new)
        if parted and len(begins) > 1:
            yield [x[: begins[1]] for x in now], np.zeros(1, np.int64), True
            now, begins, parted = [x[begins[1] :] for x in now], begins[1:] - begins[1], False
        cut = begins[-1]
        if cut:
            yield [x[:cut] for x in now], begins[:-1], False
        held = [x[cut:] for x in now]
        if most and len(held[0]) > most:
            yield held, np.zeros(1, np.int64), True
            held, parted = [x[-1:] for x in held], True  # one row stays, so that what follows is known as the same group
    if held is not None:
        yield held, np.zeros(1, np.int64), parted


_MET = "key long, a long, a_hash long, a_span long, b long, b_hash long, b_span long"


def _met(rows: DataFrame) -> DataFrame:
    """Of keys with few rows all pairs (a before b, key null); of crowded keys the rows as b with the key, some perhaps twice."""
    names = [x.split()[0] for x in _MET.split(", ")]

    def crowd(key: np.ndarray, *row: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(key), *[pa.nulls(len(key), pa.int64())] * 3, *map(pa.array, row)], names)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        away: list[pa.RecordBatch] = []

        def here() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                apart = batch.column("kind").to_numpy() == AWAY
                if apart.any():
                    away.append(batch.filter(pa.array(apart)))
                    batch = batch.filter(pa.array(~apart))
                yield batch

        for (key, doc, hashes, span, kind), begins, parted in _groups(here(), 1, 200_000):
            while away:
                yield crowd(*(x.to_numpy() for x in away.pop().columns[:4]))
            sizes = np.diff(np.r_[begins, len(key)])
            crowded = (sizes > FEW) | (np.maximum.reduceat(kind, begins) == STANDS) | parted
            if crowded.any():
                own = np.repeat(crowded, sizes)
                yield crowd(key[own], doc[own], hashes[own], span[own])
            ones, twos = [], []
            for size in range(2, FEW + 1):
                at = begins[~crowded & (sizes == size)]
                if len(at):
                    i, j = np.triu_indices(size, 1)
                    ones.append((at[:, None] + i).ravel())
                    twos.append((at[:, None] + j).ravel())
            if ones:
                a, b = np.concatenate(ones), np.concatenate(twos)
                before = (doc[a] < doc[b]) | (doc[a] == doc[b]) & (hashes[a] < hashes[b])
                a, b = np.where(before, a, b), np.where(before, b, a)
                good = (doc[a] != doc[b]) | (hashes[a] != hashes[b])
                a, b = a[good], b[good]
                yield pa.RecordBatch.from_arrays([pa.nulls(len(a), pa.int64()), *(pa.array(x) for x in (doc[a], hashes[a], span[a], doc[b], hashes[b], span[b]))], names)
        while away:
            yield crowd(*(x.to_numpy() for x in away.pop().columns[:4]))

    dealt = rows.repartition(F.when(F.col("kind") < AWAY, F.col("key")).otherwise(F.xxhash64("doc", "hash", "span")))
    return shared.map_arrow(dealt.sortWithinPartitions("key"), step, _MET)


_PAIR = ["a", "a_hash", "b", "b_hash"]


def _merged(met: DataFrame) -> DataFrame:
    """Candidates of a pair of texts that overlap (in a by 64 shingles nearly) as one, with BESIDE shingles on both sides."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, begins, _ in _groups(batches, 4):
            pair = np.repeat(np.arange(len(begins)), np.diff(np.r_[begins, len(columns[0])]))
            b1, b2, a1, a2 = columns[4] >> 32, columns[4] & 0xFFFFFFFF, columns[5] >> 32, columns[5] & 0xFFFFFFFF
            reach = np.maximum.accumulate(pair << 32 | b2)
            new = np.ones(len(pair), bool)
            new[1:] = (pair[1:] << 32 | b1[1:]) > reach[:-1] + 1
            new[1:] |= (a1[1:] > a2[:-1] + 64) | (a2[1:] + 64 < a1[:-1])
            at = np.flatnonzero(new)
            spans = [np.maximum(x - BESIDE, 0) << 32 | y + BESIDE for x, y in ((np.minimum.reduceat(a1, at), np.maximum.reduceat(a2, at)), (b1[at], np.maximum.reduceat(b2, at)))]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*(c[at] for c in columns[:4]), *spans)], [*_PAIR, "a_span", "b_span"])

    rows = met.select(*_PAIR, "b_span", "a_span").repartition(*_PAIR).sortWithinPartitions(*_PAIR, "b_span", "a_span")
    return shared.map_arrow(rows, step, "a long, a_hash long, b long, b_hash long, a_span long, b_span long")


def _joinable(wanted: DataFrame, weight: Column | int) -> DataFrame:
    """A written table, to be broadcast if its bytes (by weight of a row) are counted to be few, so that the texts stay where
    they are; a larger one is joined by a shuffle."""
    size = wanted.agg(F.coalesce(F.sum(F.lit(weight) if isinstance(weight, int) else weight), F.lit(0))).first()[0]
    return F.broadcast(wanted) if size <= SMALL_BYTES else wanted


def _regions(named: DataFrame, asked: DataFrame) -> DataFrame:
    """doc, hash, span, own: the shingles of every passage asked for (doc, hash, span)."""
    wanted = asked.distinct().groupBy("doc", "hash").agg(F.collect_list("span").alias("spans"))
    wanted = _joinable(shared.materialize(wanted, "wanted"), 8 * F.size("spans") + 24)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared.TwoGenerations.only("substrings")
        for part in shared.slices(batches, "text", SLICE):
            hashes, counts = _plain(part)
            begin = np.cumsum(counts) - counts
            spans = part.column("spans")
            of = pc.list_parent_indices(spans).to_numpy()
            span = pc.list_flatten(spans).to_numpy()
            first, last = span >> 32, np.minimum((span & 0xFFFFFFFF) + 1, counts[of])
            own = [hashes[b + x : b + y].tobytes() for b, x, y in zip(begin[of].tolist(), first.tolist(), last.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("doc").take(pa.array(of)), part.column("hash").take(pa.array(of)), pa.array(span), pa.array(own, pa.binary())], ["doc", "hash", "span", "own"])

    return shared.map_arrow(named.join(wanted, ["doc", "hash"]), step, "doc long, hash long, span long, own binary")


def _with_shingles(rows: DataFrame, regions: DataFrame) -> DataFrame:
    """rows with the shingles x of b and y of a."""
    x = regions.select(F.col("doc").alias("b"), F.col("hash").alias("b_hash"), F.col("span").alias("b_span"), F.col("own").alias("x"))
    y = regions.select(F.col("doc").alias("a"), F.col("hash").alias("a_hash"), F.col("span").alias("a_span"), F.col("own").alias("y"))
    return rows.join(x, ["b", "b_hash", "b_span"]).join(y, ["a", "a_hash", "a_span"])


def matched(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each shingle of x its first place in y, and whether it has one."""
    order = np.argsort(y, kind="stable")
    where = order[np.minimum(np.searchsorted(y[order], x), len(y) - 1)]
    return where, y[where] == x


def stretches(x: np.ndarray, y: np.ndarray, width: int, similarity: float, shift: int | None = None) -> list[tuple[int, int, int, int, float]]:
    """Passages of x and y that are alike: first and last shingle in x and in y, and the similarity of the two sets.

    shift: x and y are of one text, and place i of x is place i + shift of y, which doesn't match itself.
    """
    share = 2 * similarity / (1 + similarity)
    where, common = matched(x, y)
    if shift is not None:
        common &= where != np.arange(len(x)) + shift
    edges = np.flatnonzero(np.diff(np.r_[0, common.view(np.int8), 0]))
    runs_of = list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
    pieces: list[list[int]] = []  # first, after the last, matched, first run
    for k, (b, e) in enumerate(runs_of):
        pieces.append([b, e, e - b, k])
        while len(pieces) > 1 and (pieces[-2][2] + pieces[-1][2]) >= share * (pieces[-1][1] - pieces[-2][0]):
            last = pieces.pop()
            pieces[-1][1], pieces[-1][2] = last[1], pieces[-1][2] + last[2]

    def alike(b: int, e: int) -> tuple[int, int, int, int, float] | None:
        if e - b < width:
            return None
        at = b + np.flatnonzero(common[b:e])
        shift = int(np.median(where[at] - at))
        slack = (e - b) // 4
        inside = where[at]
        inside = inside[(inside >= b + shift - slack) & (inside < e + shift + slack)]
        if not len(inside):
            return None
        y_b, y_e = int(inside.min()), int(inside.max()) + 1
        one, two = np.unique(x[b:e]), np.unique(y[y_b:y_e])
        both = len(np.intersect1d(one, two, assume_unique=True))
        found = both / (len(one) + len(two) - both)
        return (b, e - 1, y_b, y_e - 1, found) if found >= similarity else None

    out = []
    for k, (b, e, _, first) in enumerate(pieces):
        found = alike(b, e)
        if found:
            out.append(found)
        elif e - b >= width:  # too many edits between its parts: each part by itself
            last = pieces[k + 1][3] if k + 1 < len(pieces) else len(runs_of)
            out += [x for x in (alike(*run) for run in runs_of[first:last]) if x]
    return out


_FOUND = "a long, a_hash long, b long, b_hash long, a_first long, a_last long, b_first long, b_last long, similarity double"


def _verified(candidates: DataFrame, named: DataFrame, width: int, similarity: float) -> DataFrame:
    """Passages of the candidates."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, out = [], []
            same = (batch.column("a").to_numpy() == batch.column("b").to_numpy()) & (batch.column("a_hash").to_numpy() == batch.column("b_hash").to_numpy())
            for k, (own, a_span, b_span, x, y) in enumerate(zip(same.tolist(), *(batch.column(c).to_pylist() for c in ("a_span", "b_span", "x", "y")), strict=True)):
                x0, y0 = b_span >> 32, a_span >> 32
                for b1, b2, a1, a2, s in stretches(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), width, similarity, x0 - y0 if own else None):
                    at.append(k)
                    out.append((a1 + y0, a2 + y0, b1 + x0, b2 + x0, s))
            columns = list(zip(*out, strict=True)) or [()] * 5
            whose = [batch.column(c).take(pa.array(at, pa.int64())) for c in _PAIR]
            yield pa.RecordBatch.from_arrays([*whose, *(pa.array(c, pa.int64()) for c in columns[:4]), pa.array(columns[4], pa.float64())], [x.split()[0] for x in _FOUND.split(", ")])

    asked = candidates.select(F.col("a").alias("doc"), F.col("a_hash").alias("hash"), F.col("a_span").alias("span")).union(candidates.select("b", "b_hash", "b_span"))
    return shared.map_arrow(_with_shingles(candidates, _regions(named, asked)).select(*_PAIR, "a_span", "b_span", "x", "y"), step, _FOUND)


def _uncovered(begin: np.ndarray, end: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and last place of begin..end that no low..high covers (first > last: all are covered)."""
    if not len(low):
        return begin, end
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.maximum.accumulate(high[order])
    new = np.flatnonzero(np.r_[True, low[1:] > high[:-1] + 1])
    low, high = low[new], high[np.r_[new[1:] - 1, len(high) - 1]]
    k = np.searchsorted(low, begin, side="right") - 1
    first = np.where((k >= 0) & (high[np.maximum(k, 0)] >= begin), high[np.maximum(k, 0)] + 1, begin)
    k = np.searchsorted(low, end, side="right") - 1
    last = np.where((k >= 0) & (high[np.maximum(k, 0)] >= end), low[np.maximum(k, 0)] - 1, end)
    return first, last


def _open(crowds: DataFrame, found: DataFrame, width: int) -> DataFrame:
    """Rows of crowded keys (key, b, b_hash, b_span) cut to the passages that no exact repeat of an earlier document
    covers; open: to be divided, as some of them no passage found covers but for one word's shingles at an end."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (b, b_hash, key, span, kind), begins, _ in _groups(batches, 2):
            doc = np.repeat(np.arange(len(begins)), np.diff(np.r_[begins, len(b)])) << 32
            row = kind == 2
            begin, end = doc + (span >> 32), doc + (span & 0xFFFFFFFF) - width + 1
            first, last = _uncovered(begin[row], end[row], begin[kind == 1], end[kind == 1])
            any_first, any_last = _uncovered(begin[row], end[row], begin[~row] - WIDTH, end[~row] + WIDTH)
            left = np.flatnonzero((first <= last) & (key[row] & 1 == 0))
            spans = first[left] - doc[row][left] << 32 | last[left] - doc[row][left] + width - 1
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key[row][left], b[row][left], b_hash[row][left], spans, (any_first <= any_last)[left])], ["key", "b", "b_hash", "b_span", "open"])

    passages = found.select("b", "b_hash", F.lit(0).cast("long").alias("key"), (F.col("b_first") * (1 << 32) + F.col("b_last")).alias("span"), F.when(F.col("similarity") == 1, 1).otherwise(0).cast("byte").alias("kind"))
    rows = passages.union(crowds.select("b", "b_hash", "key", "b_span", F.lit(2).cast("byte")))
    return shared.map_arrow(rows.repartition("b", "b_hash").sortWithinPartitions("b", "b_hash"), step, "key long, b long, b_hash long, b_span long, open boolean")


def divided(key: np.ndarray, xs: list[np.ndarray], ys: list[np.ndarray], width: int, pairs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys below `key`, the row each is of, and the first and last shingle of its x under each: of every passage the least
    pair of neighbouring shingles that y lacks; the passage itself if y has all its pairs."""
    nx, ny = (np.array([len(z) for z in zs], np.int64) for zs in (xs, ys))
    x, below = np.concatenate(xs), mixed(key.view(np.uint64), 5)

    def twos(z: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs of each row and the rows they are of."""
        inner = np.ones(len(z), bool)
        inner[np.cumsum(n)[n > 0] - 1] = False
        return mixed(z ^ mixed(np.r_[z[1:], z[:1]], 6), 7)[inner], np.repeat(np.arange(len(n)), n)[inner]

    two, of = twos(x, nx)
    two_y, of_y = twos(np.concatenate(ys), ny)
    row = mixed(np.arange(len(nx), dtype=np.uint64), 9)
    had = np.sort(two_y ^ row[of_y])
    sought = two ^ row[of]
    present = had[np.minimum(np.searchsorted(had, sought), len(had) - 1)] == sought if len(had) else np.zeros(len(two), bool)
    begin = np.cumsum(nx) - nx  # of a row's shingles; its pairs begin as many places before as there are rows before
    counts = np.maximum(nx - 1, 0)
    begin_two = np.cumsum(counts) - counts
    starts = _starts(counts, width - 1)
    out: tuple[list, list, list, list] = ([], [], [], [])
    for k in range(pairs if len(starts) else 0):
        least = minima(np.where(present, np.iinfo(np.uint64).max, mixed(two, 8 + k)), width - 1)[starts]
        least = least[np.r_[True, least[1:] != least[:-1]]]
        at = least[~present[least]]
        own = at - begin_two[of[at]]
        for to, z in zip(out, (mixed(two[at] ^ mixed(below[of[at]], 20 + k), 40) & ~_WHOLE, of[at], np.maximum(own + 2 - width, 0), np.minimum(own + width - 1, nx[of[at]] - 1)), strict=True):
            to.append(z)
    if len(starts):
        so_far = np.r_[0, np.cumsum(present)]
        at = starts[so_far[starts + width - 1] - so_far[starts] == width - 1]
        own = at - begin_two[of[at]]
        up, down = _powers(1 << max(12, len(x).bit_length()))
        sums = np.r_[np.uint64(0), np.cumsum(mixed(x, 12) * up[: len(x)])]
        place = begin[of[at]] + own
        content = mixed((sums[place + width] - sums[place]) * down[place], 13)
        for to, z in zip(out, (mixed(content ^ below[of[at]], 41) | _WHOLE, of[at], own, own + width - 1), strict=True):
            to.append(z)
    kinds = (np.uint64, np.int64, np.int64, np.int64)
    return tuple(np.concatenate(z) if z else np.empty(0, k) for z, k in zip(out, kinds, strict=True))


def _divided(rows: DataFrame, leaders: DataFrame, named: DataFrame, width: int, pairs: int) -> DataFrame:
    """The rows of crowded keys under keys below, by what their key's leader lacks."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                x, y = ([np.frombuffer(z, np.uint64) for z in batch.column(c).to_pylist()] for c in ("x", "y"))
                keys, of, first, last = divided(batch.column("key").to_numpy(), x, y, width, pairs)
                doc, hashes, span = (batch.column(c).to_numpy()[of] for c in ("b", "b_hash", "b_span"))
                yield _dealt(keys, doc, hashes, (first + (span >> 32)) << 32 | last + (span >> 32))

    rows = rows.join(_joinable(leaders, 40), "key")
    asked = rows.select(F.col("a").alias("doc"), F.col("a_hash").alias("hash"), F.col("a_span").alias("span")).union(rows.select("b", "b_hash", "b_span"))
    return shared.map_arrow(_with_shingles(rows, _regions(named, asked)).select("key", "b", "b_hash", "b_span", "x", "y"), step, _ROWS)


def _copies(named: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents whose words an earlier one has (doc, hash, n_words, first); the texts that stand for all with their words."""
    rows = shared.materialize(_texts(named).groupBy("doc", "hash", "words", "n_words").agg(F.count(F.lit(1)).alias("n")), "texts")
    kinds = rows.groupBy("words").agg(F.min(F.struct("doc", "hash")).alias("first"), F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select("words", "first")
    kinds = shared.materialize(kinds, "kinds")
    others = rows.join(_joinable(kinds, 40), "words").where("struct(doc, hash) <> first")
    others = shared.materialize(others.select("doc", "hash", "n_words", F.col("first.doc").alias("first")), "copies")
    rest = named.join(_joinable(others.select("doc", "hash"), 24), ["doc", "hash"], "left_anti")
    if rows.where("n > 1").take(1):  # rows that repeat a doc_id and its text
        rest = rest.dropDuplicates(["doc", "hash"])
    return others.where("doc > first"), rest


def _passages(docs: DataFrame, width: int, similarity: float, pairs: int) -> DataFrame:
    """doc, hash, start, end, first, first_start, similarity."""
    copies, texts = _copies(_named(docs))
    rows, found, tables = _windows(texts, width, pairs), None, []
    while True:
        met = shared.materialize(_met(rows), "met")
        crowds = met.where("key IS NOT NULL").select("key", "b", "b_hash", "b_span")
        leaders = crowds.groupBy("key").agg(F.min(F.struct("b", "b_hash", "b_span")).alias("least"), F.max(F.struct("b", "b_hash")).alias("most"))
        leaders = leaders.where("struct(least.b, least.b_hash) <> most").select("key", F.col("least.b").alias("a"), F.col("least.b_hash").alias("a_hash"), F.col("least.b_span").alias("a_span"))
        leaders = shared.materialize(leaders, "leaders")
        crowds = crowds.join(_joinable(leaders, 40), "key")
        later = "a < b OR a = b AND (a_hash < b_hash OR a_hash = b_hash AND a_span < b_span)"  # or further on in the same text
        stars = crowds.where(later).select(*_PAIR, "a_span", "b_span")
        candidates = shared.materialize(_merged(met.where("key IS NULL").select(*_PAIR, "a_span", "b_span").union(stars)), "candidates")
        passed = shared.materialize(_verified(candidates, texts, width, similarity), "passed")
        shared.release(candidates, *tables)
        found = passed if found is None else found.union(passed)
        others = crowds.where("a <> b OR a_hash <> b_hash OR a_span <> b_span")
        left = shared.materialize(_open(others, found, width), "open")
        shared.release(met)
        keys = shared.materialize(left.where("open").select("key").distinct(), "keys")
        if not keys.take(1):
            break
        again = left.join(_joinable(keys, 16), "key", "left_semi").drop("open")
        rows = shared.materialize(_divided(again, leaders, texts, width, pairs), "rows")
        shared.release(left)
        tables = [rows, leaders, keys]
    before = Window.partitionBy(*_PAIR).orderBy("b_first", F.desc("b_last"), F.desc("similarity"), "a_first", "a_last").rowsBetween(Window.unboundedPreceding, -1)
    found = found.distinct().withColumn("until", F.max("b_last").over(before)).where("until IS NULL OR b_last > until")  # a part of a passage with the same text says nothing more
    spans = found.where("a < b").select(
        F.col("b").alias("doc"), F.col("b_hash").alias("hash"), F.col("b_first").alias("start"), (F.col("b_last") + WIDTH).alias("end"), F.col("a").alias("first"), F.col("a_first").alias("first_start"), "similarity")
    zero = F.lit(0).cast("long")
    return spans.unionByName(copies.select("doc", "hash", zero.alias("start"), F.col("n_words").alias("end"), "first", zero.alias("first_start"), F.lit(1.0).alias("similarity")))


def repeats(docs: DataFrame, width: int = MIN_SHINGLES, similarity: float = SIMILARITY, pairs: int = PAIRS) -> DataFrame:
    """doc_id, start, end (words, end excluded), first_doc_id, first_start, similarity of each passage that an earlier
    document (by doc_id) has as well; also of whole texts with the same words."""
    found = _passages(docs, width, similarity, pairs)
    return found.select(F.col("doc").alias("doc_id"), "start", "end", F.col("first").alias("first_doc_id"), "first_start", "similarity").distinct()


def without_repeats(docs: DataFrame) -> DataFrame:
    """docs without the passages that an earlier document has; documents with nothing left go. n_chars is counted anew.
    Of rows that repeat a doc_id each loses what its own text repeats."""
    schema = docs.schema
    name = lambda x: next(n for k in range(len(schema) + 1) if (n := f"{x}{k}") not in schema.names)
    doc, own, mark = name("_doc"), name("_hash"), name("_spans")
    spans = _passages(docs, MIN_SHINGLES, SIMILARITY, PAIRS).groupBy(F.col("doc").alias(doc), F.col("hash").alias(own)).agg(F.collect_set(F.struct("start", "end")).alias(mark))
    spans = _joinable(shared.materialize(spans, "spans"), 16 * F.size(mark) + 24)
    joined = docs.withColumns({doc: F.col("doc_id").cast("long"), own: F.xxhash64("text")}).join(spans, [doc, own], "left")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in shared.slices(batches, "text"):
            texts = part.column("text").to_pylist()
            found = part.column(mark).to_pylist()
            new = [cut(t, [(s["start"], s["end"]) for s in x]) if x else t for t, x in zip(texts, found, strict=True)]
            keep = pa.array([not x or bool(t.split()) for t, x in zip(new, found, strict=True)], pa.bool_())
            columns = {n: part.column(n) for n in schema.names}
            columns["text"] = pa.array(new, part.column("text").type)
            if "n_chars" in columns:
                columns["n_chars"] = pa.array([n if not x else len(t) for t, x, n in zip(new, found, part.column("n_chars").to_pylist(), strict=True)], part.column("n_chars").type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), schema.names).filter(keep)

    return shared.map_arrow(joined.select(*schema.names, mark), step, schema)


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """text without the words of the spans and the white space before each."""
    raw = text.encode()
    at, begins, ends = 0, [], []
    for word in raw.split():
        at = raw.index(word, at)
        begins.append(at)
        at += len(word)
        ends.append(at)
    out, done = [], 0
    for b, e in sorted(spans):
        b, e = max(b, 0), min(e, len(begins))
        if e <= b or ends[e - 1] <= done:
            continue
        out.append(raw[done : max(done, ends[b - 1] if b else 0)])
        done = ends[e - 1]
    return b"".join([*out, raw[done:]]).decode().strip(" \t\n\v\f\r")
