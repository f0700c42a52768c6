"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint is cut into so few segments that two linked fingerprints differ by at most one bit in one of them: two
segments of 32 bits for three bits in 64. Each segment is indexed once for each of its bits, with that bit left out, so
such a pair meets in an equality join; what meets is verified on the whole fingerprint. Equal fingerprints are one node.
Within a key only the component matters: nodes that are already connected aren't compared, and the others are compared
with all nodes of the key. A key of 64-bit fingerprints with more than CROWD nodes is divided again by variants of the
remaining bits, cut in half each time; after the last division a key can't hold more than 2048 values.

Null texts count as empty; texts without words have fingerprint zero and are linked like any others. Rows that repeat
are in one component. A null doc_id is never the smallest; a component of null doc_ids alone has a null component_id.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared
from .components import Forest, components

#: Nodes of a key that one task compares among themselves.
CROWD = 20_000
#: Links that a task keeps before it hands them on.
HELD = 150_000
_UPPER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """XXH64 (seed 42) of the shingles of lower-cased words, repeats included; fewer words: of the whole sequence."""
    words = (text or "").encode().translate(_UPPER).split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.r_[0, ends[:-1] + 1]
    if len(words) > width:
        begins, ends = begins[: 1 - width], ends[width - 1 :]
    else:
        begins, ends = begins[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], 42) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)], np.uint64)


def mixed(h: np.ndarray, lane: int) -> np.ndarray:
    """Another hash of the same shingles; lane 0 is the hash itself."""
    if not lane:
        return h
    x = h + np.uint64(0x9E3779B97F4A7C15 * lane & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint(h: np.ndarray, lanes: int = 1) -> bytes:
    """lanes big-endian 64-bit words; a bit is 1 if it is set in over half the hashes."""
    out = []
    for lane in range(lanes):
        ones = np.zeros(64, np.int64)
        own = mixed(h, lane)
        for at in range(0, len(own), 4096):
            ones += np.unpackbits(own[at : at + 4096].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int32)
        out.append(np.packbits(2 * ones > len(h)).tobytes())
    return b"".join(out)


def fingerprints(docs: DataFrame, width: int, lanes: int = 1) -> DataFrame:
    """doc_id, fp (binary) of every whole text."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared.TwoGenerations.only("simhash")
        for part in shared.slices(batches, "text"):
            fps = [fingerprint(shingle_hashes(t, width), lanes) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(fps, pa.binary())], ["doc_id", "fp"])

    rows = docs.select("doc_id", "text")
    return shared.map_arrow(rows, step, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp binary")


def _without_bit(values: np.ndarray, width: int) -> np.ndarray:
    """(n, width): each value with one of its bits left out."""
    bits = np.arange(width, dtype=np.uint64)
    low = (np.uint64(1) << bits) - np.uint64(1)
    v = values[:, None]
    return (v & low) | ((v >> np.uint64(1)) & ~low)


def variant_keys(words: np.ndarray, parts: list[tuple[int, int]]) -> np.ndarray:
    """(n, keys): for each part (first bit from the lowest, width) of the words, a key for each of its bits left out."""
    out = []
    for k, (first, width) in enumerate(parts):
        value = (words[:, first // 64] >> np.uint64(first % 64)) & np.uint64((1 << width) - 1)
        tags = (np.arange(width, dtype=np.uint64) + np.uint64(64 * k)) << np.uint64(32)
        out.append(_without_bit(value, width) | tags)
    return np.concatenate(out, axis=1)


def _linked(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1) <= bits


def link_run(nodes: np.ndarray, fps: np.ndarray, bits: int, forest: Forest) -> None:
    """Connect within one key what differs by at most `bits`: exact for the components."""
    if len(nodes) == 2:
        if _linked(fps[0], fps[1], bits):
            forest.link(int(nodes[0]), int(nodes[1]))
        return
    roots = np.array([forest.root(int(x)) for x in nodes])
    if (roots == roots[0]).all():
        return
    for x in nodes[1:][_linked(fps[1:], fps[0], bits)].tolist():
        forest.link(int(nodes[0]), x)
    roots = np.array([forest.root(int(x)) for x in nodes])
    kinds, counts = np.unique(roots, return_counts=True)
    main = kinds[counts.argmax()]
    for i in np.flatnonzero(roots != main).tolist():
        near = np.flatnonzero(_linked(fps, fps[i], bits) & (roots != roots[i]))
        for j in near.tolist():
            forest.link(int(nodes[i]), int(nodes[j]))


def runs(batches: Iterator[pa.RecordBatch], crowd: int) -> Iterator[tuple[int, list[np.ndarray], bool]]:
    """Per key of sorted batches (key first) the other columns of its rows; a key with more than crowd rows comes in parts, marked True."""
    key, held, size, crowded = None, [], 0, False
    for batch in batches:
        keys = batch.column(0).to_numpy()
        if not len(keys):
            continue
        rest = [x.to_numpy(zero_copy_only=False) for x in batch.columns[1:]]
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        begins, ends = np.r_[0, cuts], np.r_[cuts, len(keys)]
        open_end = len(begins) - 1
        keep = np.flatnonzero((ends - begins > 1) | (np.arange(len(begins)) == 0) | (np.arange(len(begins)) == open_end))
        for k in keep.tolist():
            b, e = int(begins[k]), int(ends[k])
            if key is None or keys[b] != key:
                if size > 1 or crowded and size:
                    yield key, [np.concatenate(x) for x in zip(*held, strict=True)], crowded
                key, held, size, crowded = keys[b], [], 0, False
            held.append([x[b:e] for x in rest])
            size += e - b
            if size > crowd:
                crowded = True
                yield key, [np.concatenate(x) for x in zip(*held, strict=True)], True
                held, size = [], 0
            if k != open_end:
                if size > 1 or crowded and size:
                    yield key, [np.concatenate(x) for x in zip(*held, strict=True)], crowded
                key, held, size, crowded = None, [], 0, False
    if held and (size > 1 or crowded and size):
        yield key, [np.concatenate(x) for x in zip(*held, strict=True)], crowded


def _index(rows: DataFrame, width: int) -> DataFrame:
    """key, fp, free: in each half of the free bits (width of them, from bit free on) each bit left out in turn.

    The other half stays free below that key.
    """
    half = width // 2

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                key, fp, free = (x.to_numpy() for x in batch.slice(at, 2048).columns)
                below = (fp.view(np.uint64) >> free.astype(np.uint64))[:, None]
                keys = variant_keys(below, [(0, half), (half, half)])
                if width < 64:
                    keys = mixed(keys ^ mixed(key.view(np.uint64)[:, None], 1), 2)
                other = free[:, None] + np.repeat([half, 0], half).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64).ravel()), pa.array(np.repeat(fp, width)), pa.array(other.ravel().astype(np.int32))], ["key", "fp", "free"])

    return shared.map_arrow(rows.select("key", "fp", "free"), step, "key long, fp long, free int")


def _met(index: DataFrame, bits: int, crowd: int) -> DataFrame:
    """Links (a, b) among the rows of each key; of crowded keys the rows themselves (key, a, free) instead."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "a", "b", "free"]
        forest = Forest()

        def stars() -> pa.RecordBatch:
            out = forest.stars()
            return pa.RecordBatch.from_arrays([pa.nulls(out.num_rows, pa.int64()), *out.columns, pa.nulls(out.num_rows, pa.int32())], names)

        for key, (fp, free), crowded in runs(batches, crowd):
            if crowded:
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(fp), key, np.int64)), pa.array(fp), pa.nulls(len(fp), pa.int64()), pa.array(free)], names)
                continue
            link_run(fp, fp.view(np.uint64)[:, None], bits, forest)
            if len(forest.up) > HELD:
                yield stars()
                forest = Forest()
        yield stars()

    return shared.map_arrow(index.repartition("key").sortWithinPartitions("key"), step, "key long, a long, b long, free int")


def links(fps: DataFrame, bits: int = 3, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) that connect what is connected among distinct 64-bit fingerprints (fp long) at `bits` or fewer."""
    if bits > 3:
        raise ValueError("two segments suffice for three bits only")
    rows, out = fps.select(F.lit(0).cast("long").alias("key"), "fp", F.lit(0).alias("free")), None
    for width in (64, 32, 16):
        met = shared.materialize(_met(_index(rows, width), bits, crowd if width > 16 else 1 << 40), "met")
        found = met.where("key IS NULL").select("a", "b")
        out = found if out is None else out.union(found)
        rows = met.where("key IS NOT NULL").select("key", F.col("a").alias("fp"), "free")
        if not rows.take(1):
            break
    return out


def classes(docs: DataFrame, width: int = 3, bits: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id of the component)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = fingerprints(docs, width).select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"))
    high = F.conv(F.substring("fingerprint", 1, 8), 16, 10).cast("long")
    low = F.conv(F.substring("fingerprint", 9, 8), 16, 10).cast("long")
    rows = shared.materialize(rows.withColumn("fp", F.shiftleft(high, 32).bitwiseOR(low)), "fingerprints")
    distinct = shared.materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = components(links(distinct.select("fp"), bits))
    own = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = own.groupBy("root").agg(F.min("first").cast(kind).alias("component_id"))
    found = shared.materialize(own.join(least, "root").select("fp", "component_id"), "found")
    small = found.limit(SMALL_NODES + 1).count() <= SMALL_NODES  # then the rows of a common fingerprint stay where they are
    return rows.join(F.broadcast(found) if small else found, "fp").select("doc_id", "fingerprint", "component_id")


#: For whole corpora: least Jaccard similarity of the sets of five-word shingles, and 64-bit words of their fingerprints.
SIMILARITY, LANES = 0.8, 8
#: Bits of a key and keys: each takes other bits of the fingerprint. Two sets at similarity s differ in a bit with probability
#: p = arccos(2s / (1 + s)) / pi and share a key with probability 1 - (1 - (1 - p)^BITS)^KEYS or a little less: 98 % at 0.8.
BITS, KEYS = 24, 256
#: Keys whose smallest nodes are compared with the others first: what that connects isn't compared again.
FIRST_KEYS = 16
#: 64-bit words of a set's marks.
MARKS = 16
#: Differing bits, as a share, up to which the sets of a pair are compared: at the similarity 15 % differ, 19 % if the sets are tiny.
FAR = 0.27
#: Nodes of a key up to which all pairs are verified at once; with more each is compared with the smallest first.
FEW = 8
#: Nodes of each side of a cell in which what the smallest left apart is compared.
BLOCK = 512
#: Candidate nodes up to which their table is broadcast, so that the texts stay where they are.
SMALL_NODES = 200_000


def shingle_set(text: str | None, width: int) -> np.ndarray:
    return np.unique(shingle_hashes(text, width))


def set_id(own: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(own.tobytes()) - (1 << 63)


def set_fingerprint(own: np.ndarray, lanes: int = LANES) -> bytes:
    """fingerprint() of all lanes at once."""
    ones = np.zeros(64 * lanes, np.int64)
    for at in range(0, len(own), 4096):
        part = np.stack([mixed(own[at : at + 4096], k) for k in range(lanes)], axis=1).astype(">u8").view(np.uint8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.uint16)
    return np.packbits(2 * ones > len(own)).tobytes()


def sketch(own: np.ndarray) -> bytes:
    """Native 64-bit words of a set: its fingerprint, its marks (a bit is 1 if it is named by the highest bits of some hash), its size."""
    marked = np.zeros(64 * MARKS, bool)
    marked[own >> np.uint64(64 - (64 * MARKS - 1).bit_length())] = True
    return set_fingerprint(own) + np.packbits(marked).tobytes() + np.uint64(len(own)).tobytes()


def may_be_alike(x: np.ndarray, y: np.ndarray, similarity: float) -> np.ndarray:
    """Whether sets can be that similar by their sketches (n, words). Marks and sizes never reject sets that are: for each mark that
    only one of them has it has a hash that the other lacks."""
    lanes = x.shape[1] - MARKS - 1
    sizes = [z[:, -1].astype(np.int64) for z in (x, y)]
    mx, my = (z[:, lanes:-1] for z in (x, y))
    only = [np.bitwise_count(z).sum(axis=1, dtype=np.int64) for z in (mx & ~my, my & ~mx)]
    both = np.minimum(sizes[0] - only[0], sizes[1] - only[1])
    return _linked(x[:, :lanes], y[:, :lanes], int(FAR * 64 * lanes)) & (both / (sizes[0] + sizes[1] - both) >= similarity)


@cache
def _places(bits: int, n: int, width: int) -> np.ndarray:
    """(n, bits): which of the fingerprint's bits each key takes, the same in every process."""
    order = mixed(np.arange(n * width, dtype=np.uint64), 5).reshape(n, width)
    return np.argsort(order, axis=1)[:, :bits]


def sampled_keys(fps: list[bytes], bits: int = BITS, n: int = KEYS) -> np.ndarray:
    """(fingerprints, n): the key's number above its bits."""
    all_bits = np.unpackbits(np.frombuffer(b"".join(fps), np.uint8).reshape(len(fps), -1), axis=1)
    taken = np.packbits(all_bits[:, _places(bits, n, all_bits.shape[1])], axis=2)
    keys = np.broadcast_to(np.arange(n, dtype=np.int64), taken.shape[:2])
    for k in range(taken.shape[2]):
        keys = keys << 8 | taken[:, :, k]
    return keys


def _noded(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, node (id of the set of shingles) and sketch (of the set; null: an empty one), of every whole text."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared.TwoGenerations.only("simhash")
        for part in shared.slices(batches, "text"):
            sets = [shingle_set(t, width) for t in part.column("text").to_pylist()]
            columns = [part.column("doc_id"), pa.array([set_id(x) for x in sets], pa.int64()), pa.array([sketch(x) if len(x) else None for x in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "node", "sketch"])

    rows = docs.select("doc_id", "text")
    return shared.map_arrow(rows, step, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, node long, sketch binary")


def _sampled(distinct: DataFrame, n: int) -> DataFrame:
    """key, node, root: the first n keys of every node's fingerprint."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                node, root, own = whole.slice(at, 256).columns
                keys = sampled_keys([x[: 8 * LANES] for x in own.to_pylist()], n=n)
                nodes, roots = (np.repeat(x.to_numpy(), n) for x in (node, root))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(nodes), pa.array(roots)], ["key", "node", "root"])

    return shared.map_arrow(distinct.where("sketch IS NOT NULL").select("node", "root", "sketch"), step, "key long, node long, root long")


def _near(pairs: DataFrame, distinct: DataFrame, similarity: float) -> DataFrame:
    """Of the pairs (a, b) those that may be alike by their sketches, so that their sets are worth reading."""
    sketches = distinct.select("node", "sketch")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(batch.num_rows, -1) for c in "xy")
            yield batch.select(["a", "b"]).filter(pa.array(may_be_alike(x, y, similarity)))

    rows = pairs.join(sketches.toDF("a", "x"), "a").join(sketches.toDF("b", "y"), "b")
    return shared.map_arrow(rows.select("a", "b", "x", "y"), step, "a long, b long")


def _met_nodes(index: DataFrame, few: int | None) -> DataFrame:
    """Pairs (a, b) of nodes with different roots: of keys with few nodes all; of the others each node with the smallest, and the
    rows (key, a). few None: of all keys each node with the smallest, no rows."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: set[tuple[int, int]] = set()
        of, lead = None, (0, 0)

        def out() -> pa.RecordBatch:
            pairs = np.array(sorted(held), np.int64).reshape(-1, 2)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.nulls(len(pairs), pa.int64()), pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["key", "a", "b"])

        for key, (node, root), partial in runs(batches, 1_000_000):
            if not partial and (root == root[0]).all():
                continue
            if few is None or partial or len(node) > few:
                lead = lead if of == key else (int(node[0]), int(root[0]))
                of = key
                if few is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(node), key, np.int64)), pa.array(node), pa.nulls(len(node), pa.int64())], ["key", "a", "b"])
                held.update((lead[0], x) for x in node[root != lead[1]].tolist())
            else:
                nodes = list(zip(node.tolist(), root.tolist(), strict=True))
                held.update((x, y) for k, (x, r) in enumerate(nodes) for y, s in nodes[k + 1 :] if r != s)
            if len(held) > HELD:
                yield out()
        yield out()

    return shared.map_arrow(index.repartition("key").sortWithinPartitions("key", "node"), step, "key long, a long, b long")


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """node and its set (binary) of the wanted nodes (doc_id, node)."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in shared.slices(batches, "text"):
            sets = [shingle_set(t, width) for t in part.column("text").to_pylist()]
            good = pa.array([set_id(x) == n for x, n in zip(sets, part.column("node").to_pylist(), strict=True)], pa.bool_())  # a doc_id may repeat with other texts
            yield pa.RecordBatch.from_arrays([part.column("node"), pa.array([x.tobytes() for x in sets], pa.binary())], ["node", "own"]).filter(good)

    small = wanted.limit(SMALL_NODES + 1).count() <= SMALL_NODES
    rows = docs.select("doc_id", "text").join(F.broadcast(wanted) if small else wanted, "doc_id").select("node", "text")
    return shared.map_arrow(rows, step, "node long, own binary").dropDuplicates(["node"])


def jaccard(x: np.ndarray, y: np.ndarray) -> float:
    """Of two sorted sets."""
    if not len(x) or not len(y):
        return float(len(x) == len(y))
    both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
    return both / (len(x) + len(y) - both)


def _alike(pairs: DataFrame, similarity: float) -> DataFrame:
    """Of the pairs (a, b, their sets x, y) those at the similarity or more."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [jaccard(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)) >= similarity for x, y in zip(batch.column("x"), batch.column("y"), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return shared.map_arrow(pairs.select("a", "b", "x", "y"), step, "a long, b long")


def link_cell(rest: list[tuple[int, int, np.ndarray]], others: list[tuple[int, int, np.ndarray]], similarity: float, forest: Forest) -> None:
    """Connect what is alike of the rest with the others (node, root, set), but what is in one component already."""
    for node, root, _ in [*rest, *others]:
        forest.link(node, root)
    sizes = np.array([len(x) for _, _, x in others])
    kinds, codes = np.unique(np.concatenate([x for _, _, x in others]), return_inverse=True)
    begins, mark = np.cumsum(sizes) - sizes, np.zeros(len(kinds), bool)
    for node, _, own in rest:
        mine = forest.root(node)
        if all(forest.root(x) == mine for x, _, _ in others):
            continue
        at = np.minimum(np.searchsorted(kinds, own), len(kinds) - 1)
        mark[:] = False
        mark[at[kinds[at] == own]] = True
        both = np.add.reduceat(mark[codes], begins, dtype=np.int64)
        for k in np.flatnonzero(both / (len(own) + sizes - both) >= similarity).tolist():
            forest.link(node, others[k][0])


def _cells(rows: DataFrame, roots: DataFrame, sets: DataFrame, similarity: float, block: int) -> DataFrame:
    """Links that the stars of crowded keys (rows: key, node) left out: in each key every node outside the largest
    component is compared with all nodes of other components, in cells of about `block` by `block` nodes."""
    open_rows = rows.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    open_rows = shared.materialize(open_rows, "open")
    by_root = open_rows.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    keys = by_root.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("n"), F.max("n").alias("most"), F.max_by("root", F.struct("n", "root")).alias("main")).where("kinds > 1")
    parts = lambda n: F.ceil(F.col(n) / block).cast("int")
    keys = keys.select("key", "main", parts("n").alias("all_parts"), F.ceil((F.col("n") - F.col("most")) / block).cast("int").alias("rest_parts"))
    found = open_rows.join(keys, "key")
    of = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rest = found.where("root <> main").select("key", of("rest_parts").alias("i"), spread("all_parts").alias("j"), F.lit(0).alias("side"), "node", "root")
    others = found.select("key", spread("rest_parts").alias("i"), of("all_parts").alias("j"), F.lit(1).alias("side"), "node", "root")
    cells = rest.union(others).join(sets, "node").select(F.xxhash64("key", "i", "j").alias("cell"), "side", "node", "root", "own")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, of_cell, sides = Forest(), None, ([], [])

        def compare() -> None:
            if all(sides):
                link_cell(*sides, similarity, forest)
            sides[0].clear()
            sides[1].clear()

        for batch in batches:
            for cell, side, node, root, own in zip(*(batch.column(c).to_pylist() for c in ("cell", "side", "node", "root", "own")), strict=True):
                if cell != of_cell:
                    compare()
                    of_cell = cell
                    if len(forest.up) > HELD:
                        yield forest.stars()
                        forest = Forest()
                sides[side].append((node, root, np.frombuffer(own, np.uint64)))
        compare()
        yield forest.stars()

    return shared.map_arrow(cells.repartition("cell").sortWithinPartitions("cell"), step, "a long, b long")


def _verified(pairs: DataFrame, crowds: DataFrame | None, known: DataFrame, distinct: DataFrame, width: int, similarity: float) -> tuple[DataFrame, DataFrame]:
    """Links: of the pairs (a, b) those whose sets are alike; and the sets of their nodes and of the crowds' nodes."""
    near = shared.materialize(_near(pairs.distinct(), distinct, similarity), "pairs")
    wanted = near.select(F.col("a").alias("node")).union(near.select("b"))
    if crowds is not None:
        wanted = wanted.union(crowds.select("node"))
    wanted = shared.materialize(distinct.join(wanted.distinct(), "node").select(F.col("first").alias("doc_id"), "node"), "wanted")
    sets = shared.materialize(_sets(known, wanted, width), "sets")
    return shared.materialize(_alike(near.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b"), similarity), "alike"), sets


def near_duplicates(docs: DataFrame, width: int = 5, similarity: float = SIMILARITY, few: int = FEW, block: int = BLOCK) -> DataFrame:
    """doc_id and component_id of the documents whose component has a smaller doc_id; without null doc_ids.

    Candidates are sets whose SimHash fingerprints agree in all bits of a key; two documents are linked if the Jaccard
    similarity of their sets of shingles, counted exactly, is at least that. Only the component matters: a first round
    compares the nodes of FIRST_KEYS keys with the smallest of their key, the second one what is in different components.
    """
    known = docs.where(F.col("doc_id").isNotNull())
    rows = shared.materialize(_noded(known, width), "nodes")
    distinct = shared.materialize(rows.groupBy("node").agg(F.min("doc_id").alias("first"), F.first("sketch").alias("sketch")), "distinct")
    first = _met_nodes(_sampled(distinct.withColumn("root", F.col("node")), min(FIRST_KEYS, KEYS)), None).select("a", "b")
    links, _ = _verified(first, None, known, distinct, width, similarity)
    rooted = distinct.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    met = shared.materialize(_met_nodes(_sampled(rooted, KEYS), few), "met")
    crowds = met.where("key IS NOT NULL").select("key", F.col("a").alias("node"))
    more, sets = _verified(met.where("key IS NULL").select("a", "b"), crowds, known, distinct, width, similarity)
    links = links.union(more)
    roots = components(links)
    if crowds.take(1):
        roots = components(links.union(_cells(crowds, roots, sets, similarity, block)))
    own = distinct.join(roots, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    least = own.groupBy("root").agg(F.min("first").alias("component_id"))
    found = own.join(least, "root").select("node", "component_id")
    return rows.join(found, "node").where("doc_id > component_id").select("doc_id", "component_id").distinct()


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """docs without those whose component of near duplicates has a smaller doc_id. Null doc_ids stay; rows that repeat
    a doc_id stay or go together."""
    return docs.join(near_duplicates(docs).select("doc_id"), "doc_id", "left_anti").select(*docs.columns)
