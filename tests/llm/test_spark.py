"""The operators on small tables: brute-force versions, and nulls, ties, repeats, empty tables, extra columns."""

import hashlib
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from mapweave.llm import audio, bpe, components, fertility, html_extract, licenses, packing, queries, sharding, simhash, substrings, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
VOCABULARY = queries.VOCABULARY


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS)


def words(n, seed=0):
    r = np.random.default_rng(seed)
    return ["".join(r.choice(list("abcdefghij"), 6)) for _ in range(n)]


ODD = [(1, None), (2, ""), (3, "a"), (3, "a"), (None, "null id"), (4, "long " * 30000), (5, " \n ")]
ALL = {
    "bpe": lambda d: bpe.digests(d, VOCABULARY), "packing": lambda d: packing.packed(d, VOCABULARY), "fertility": fertility.rated, "kept": fertility.kept, "simhash": simhash.classes,
    "near": simhash.without_near_duplicates, "licenses": licenses.scanned, "substrings": substrings.repeats, "without": substrings.without_repeats, "sharding": sharding.sharded,
}


@pytest.mark.parametrize("name", ALL)
def test_odd_and_empty_tables(spark, name):
    d = docs(spark, ODD).withColumns({"key": F.lit(1), "fp": F.lit("x"), "slot": F.lit(2), "_row": F.lit(0), "hash": F.lit(5), "doc": F.lit("y"), "_spans0": F.lit(3)})
    got = ALL[name](d).collect()
    if name not in ("kept", "near", "substrings", "without", "packing"):
        assert len(got) == len(ODD)
    assert ALL[name](docs(spark, [])).collect() == []


PAGES = "page_id long, url string, html string"


def test_odd_and_empty_pages_and_vectors(spark):
    rows = [(1, None, None), (1, "http://a/", ""), (None, "http://a/", "<p>x<a href="), (2, "odd", "<div>" * 500 + "y"), (2, "odd", "<div>" * 500 + "y")]
    pages = spark.createDataFrame(rows, PAGES).withColumns({"key": F.lit(1), "host": F.lit("h"), "page": F.lit(2), "_part": F.lit(3), "gone": F.lit(0), "file": F.lit("f")})
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in html_extract.extracted(pages).collect()) == [(0, "x", 1), (1, "", 0), (1, "", 0), (2, "y", 1), (2, "y", 1)]
    assert warc.round_trip(pages).count() == len(rows)
    vectors = spark.createDataFrame([(50, [0.5] * 64), (50, [0.5] * 64), (7, None), (None, [1.0]), (8, [])], "vec_id long, embedding array<float>").withColumns({"id": F.lit(1), "seed": F.lit(2), "class_id": F.lit(3)})
    members = [r["vec_id"] for r in audio.searched(audio.rendered(vectors)).collect() if r["kind"] == "member"]
    assert sorted(members) == [7, 8, 50]
    assert html_extract.extracted(pages.limit(0)).collect() == [] and audio.searched(audio.rendered(vectors.limit(0))).collect() == []



def test_simhash_against_brute_force(spark):
    base = words(60)
    rows = [(k, " ".join(base)) for k in (9, 4)] + [(10 + k, " ".join([*base[: k % 60], "X", *base[k % 60 + 1 :]])) for k in range(40)] + [(80, None), (81, ""), (82, "A b"), (83, "a  B")]
    fps = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        h = [xxhash.xxh64_intdigest(" ".join(w[k : k + 3]).encode(), 42) for k in range(max(1, len(w) - 2))] if w else []
        fps.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    root = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(fps):
            for j, b in enumerate(fps):
                if bin(a ^ b).count("1") <= 3:
                    root[i] = root[j] = min(root[i], root[j])
    want = {(d, f"{fps[i]:016x}", min(rows[j][0] for j in range(len(rows)) if root[j] == root[i])) for i, (d, _) in enumerate(rows)}
    assert {tuple(r) for r in simhash.classes(docs(spark, rows)).collect()} == want


@pytest.mark.parametrize("crowd", [3, 40, 20000])
def test_links_of_crowded_keys(spark, crowd):
    r = np.random.default_rng(1)
    fps = set()
    for center in r.integers(0, 1 << 63, 3).tolist():
        for _ in range(150):
            fps.add(center ^ sum(1 << int(b) for b in r.choice(63, r.integers(0, 5), replace=False)))
    fps = np.array(sorted(fps), np.int64)
    up = {int(x): int(x) for x in fps}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[i + 1 :] ^ fps[i]) <= 3) + i + 1:
            a, b = top(int(fps[i])), top(int(fps[j]))
            up[max(a, b)] = min(a, b)
    found = components.components(simhash.links(spark.createDataFrame([(int(x),) for x in fps], "fp long"), 3, crowd))
    roots = {r["node"]: r["root"] for r in found.collect()}
    assert all(roots.get(int(x), int(x)) == top(int(x)) for x in fps)


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(300)] + [(1000, 1001)], "a long, b long").repartition(4)
    roots = {r["node"]: r["root"] for r in components.components(edges).collect()}
    assert set(roots.values()) == {0, 1000} and len(roots) == 301


def test_near_duplicates_at_five_words(spark):
    base, other = words(200), words(200, 1)
    near = [*base[:100], "changed", *base[101:]]
    rows = [(5, " ".join(base)), (3, " ".join(near)), (7, " ".join(other)), (8, " ".join(base)), (None, " ".join(base))]
    kept = {r["doc_id"] for r in simhash.without_near_duplicates(docs(spark, rows)).collect()}
    assert kept == {3, 7, None}


def test_substrings_find_shared_passages(spark):
    shared = words(60, 2)
    rows = [(k, " ".join([*words(120, 10 + k), *shared, *words(80, 50 + k)])) for k in range(25)]
    rows += [(100, " ".join(words(300, 99))), (101, " ".join(words(40, 98))), (102, " ".join(words(40, 98)))]
    line = words(30, 5)  # too short for a passage, in many texts
    rows += [(200 + k, " ".join([*words(60, 200 + k), *line, *words(60, 300 + k)])) for k in range(40)]
    two = words(40, 6)
    rows += [(300, " ".join([*words(9, 400), *line, *two])), (301, " ".join([*words(9, 401), *line, *two]))]
    got = substrings.repeats(docs(spark, rows)).collect()
    by = {r["doc_id"]: r for r in sorted(got, key=lambda r: -r["first_doc_id"])}  # the earliest of what a passage was found with
    assert set(by) == {*range(1, 25), 301}
    for k in range(1, 25):
        assert by[k]["first_doc_id"] == 0 and by[k]["start"] <= 120 + 5 and by[k]["end"] >= 175 and by[k]["similarity"] >= 0.8
    assert by[301]["first_doc_id"] == 300 and (by[301]["start"], by[301]["end"]) == (9, 79)
    left = {r["doc_id"]: r for r in substrings.without_repeats(docs(spark, rows)).collect()}
    assert len(left) == len(rows) and len(left[7]["text"].split()) <= 206 and left[7]["n_chars"] == len(left[7]["text"]) and left[0]["text"] == rows[0][1]


def test_rows_that_repeat_an_id_lose_what_their_own_text_repeats(spark):
    p, clean, tail = words(80, 60), words(90, 61), words(20, 62)
    rows = [(1, " ".join(p)), (2, " ".join(clean)), (2, " ".join([*p, *tail]))]
    d = docs(spark, rows).withColumns({"_spans0": F.lit(1), "_hash0": F.lit(2)})
    left = sorted(len(r["text"].split()) for r in substrings.without_repeats(d).collect())
    assert left == [20, 80, 90]


def test_near_passages_are_found(spark):
    """Passages of 60 words of which one is changed: 51 of 61 different shingles are common."""
    r, rows = np.random.default_rng(30), []
    for k in range(120):
        p = words(60, 3000 + k)
        at = int(r.integers(5, 55))
        q = [*p[:at], f"z{at}", *p[at + 1 :]]
        rows += [(2 * k, " ".join([*words(60, 4000 + k), *p, *words(50, 5000 + k)])), (2 * k + 1, " ".join([*words(50, 6000 + k), *q, *words(60, 7000 + k)]))]
    found = {x["doc_id"] for x in substrings.repeats(docs(spark, rows)).collect()}
    assert not any(i % 2 == 0 for i in found) and len(found) >= 0.9 * 120


def test_copies_lose_their_text(spark):
    t = " ".join(words(80))
    left = substrings.without_repeats(docs(spark, [(2, t), (1, t), (9, t.upper())])).collect()
    assert [r["doc_id"] for r in left] == [1]


def test_packing_against_the_library(spark):
    rows = [(1, " ".join(words(40))), (2, None), (3, "word " * 5000), (4, "x")]
    library = Tokenizer.from_file(VOCABULARY)
    got = packing.packed(docs(spark, rows), VOCABULARY).collect()
    for i, t in rows:
        want = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        own = sorted((r for r in got if r["doc_id"] == i), key=lambda r: r["piece"])
        assert [r["length"] for r in own] == [len(want[k : k + 2048]) for k in range(0, len(want), 2048)] and [r["start"] for r in own] == [2048 * k for k in range(len(own))]
        assert [r["ids_crc32"] for r in own] == [zlib.crc32(np.array(want[k : k + 2048], "<u4").tobytes()) for k in range(0, len(want), 2048)]
    spans = sorted((r["sequence_id"], r["offset"], r["length"]) for r in got)
    for a, b in zip(spans, spans[1:], strict=False):
        assert b[1] == (a[1] + a[2] if a[0] == b[0] else 0)


def test_bpe_digests(spark):
    library, text = Tokenizer.from_file(VOCABULARY), "Hello <|endoftext|> été!"
    own = bpe.digests(docs(spark, [(1, text)]), VOCABULARY).first()
    want = library.encode(text, add_special_tokens=False).ids
    assert own["n_tokens"] == len(want) and own["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
    assert own["decoded_sha256"] == hashlib.sha256(library.decode(want, skip_special_tokens=False).encode()).hexdigest()


def test_sharding_is_even_and_gapless(spark):
    rows = [(k, "x" * (k * 7919 % 900)) for k in range(2000)] + [(None, None)] * 3
    got = sharding.sharded(docs(spark, rows)).collect()
    total = {}
    for r in got:
        total.setdefault(r["shard"], []).append((r["slot"], r["size"]))
    assert len(got) == 2003 and set(total) == set(range(24))
    assert all(sorted(s for s, _ in x) == list(range(len(x))) for x in total.values())
    sums = [sum(n for _, n in x) for x in total.values()]
    assert max(sums) - min(sums) < 0.02 * max(sums)
    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in got} == {(i, len(t or "") + 8, zlib.crc32((t or "").encode())) for i, t in rows}


def test_slot_map_is_kept_and_edited(spark, tmp_path):
    folder = f"file://{tmp_path}/map"
    rows = [(k, "x" * (k * 7919 % 900)) for k in range(2000)]
    first = {r["doc_id"]: r["shard"] for r in sharding.sharded(docs(spark, rows), folder=folder).collect()}
    assert sharding.versions(spark, folder) == [0]
    assert {r["doc_id"]: r["shard"] for r in sharding.sharded(docs(spark, rows), folder=folder).collect()} == first and sharding.versions(spark, folder) == [0]
    more = [*rows, *((10000 + k, "y" * 4000) for k in range(40))]
    then = {r["doc_id"]: r for r in sharding.sharded(docs(spark, more), folder=folder).collect()}
    assert sharding.versions(spark, folder) == [0, 1] and {r["map_version"] for r in then.values()} == {1}
    assert sum(first[k] != then[k]["shard"] for k in first) < 400
    wide = {r["doc_id"]: r["shard"] for r in sharding.sharded(docs(spark, more), shards=25, folder=folder).collect()}
    assert sum(then[k]["shard"] != wide[k] for k in then) < 400 and set(wide.values()) == set(range(25))
    assert {r["shard"] for r in sharding.read_map(spark, folder, 0).collect()} == set(range(24))


def test_warc_round_trip(spark):
    long = "<p>é</p>" * 20
    rows = [(3, "http://a/1", long), (1, "http://a/2", long), (1, "http://a/2", long), (2, None, long), (None, "u", long), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (7, "http://é/ %", "x" * 300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted(((r["page_id"] or 99, r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.round_trip(pages).collect()))
    kind = {99: "revisit", 3: "revisit", 2: "revisit"}
    assert got == sorted((i or 99, len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest(), kind.get(i or 99, "response"), 1 if (i or 99) in kind else None) for i, _, h in rows)
    assert {r["url"] for r in warc.round_trip(pages).collect()} == {r[1] for r in rows}
    assert warc.round_trip(pages.limit(0)).collect() == []


def test_html_template_goes_and_copies_stay(spark):
    page = lambda k, body: (k, f"http://h{k % 2}.x/{k}", f"<body><div>Shop now</div><div><p>{body}</p></div><div>Imprint</div></body>")
    rows = [page(k, f"text {k}") for k in range(40)] + [page(40 + 2 * k, "same text in copies") for k in range(30)] + [(500, None, None), (501, "odd", ""), (502, "http://solo/", "<div>Shop now</div><p>solo</p>")]
    got = {r["page_id"]: r for r in html_extract.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[7]["text"] == "text 7" and got[50]["text"] == "same text in copies" and got[500]["text"] == "" and got[500]["n_chars"] == 0
    assert got[502]["text"] == "Shop now\nsolo" and len(got) == len(rows)


def test_html_of_the_pages_table(spark):
    import html

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in html_extract.extracted(pages).join(pages.select("page_id", "html"), "page_id").collect():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"</?b>|<br>", "", y)).split()) for y in re.split(r"</?(?:h1|p)>", article))
        assert r["text"] == "\n".join(x for x in blocks if x)


def test_audio_search(spark):
    r = np.random.default_rng(3)
    tune = lambda n: np.concatenate([np.sin(2 * np.pi * 110 * 2 ** (k / 12) * np.arange(320) / audio.RATE) * 9000 for k in r.integers(0, 24, n)])
    x = tune(32)
    noisy = (np.concatenate([np.zeros(1000), x]) + r.normal(0, 300, len(x) + 1000)).astype("<i2").tobytes()
    rows = [(50, x.astype("<i2").tobytes()), (7, x.astype("<i2").tobytes()), (8, noisy), (100, tune(32).astype("<i2").tobytes()), (150, None), (None, noisy), (9, b"")]
    got = audio.searched(spark.createDataFrame(rows, "vec_id long, pcm binary")).collect()
    members = {r["vec_id"]: r["class_id"] for r in got if r["kind"] == "member"}
    assert members == {50: 7, 7: 7, 8: 8, 100: 100, 150: 150, 9: 9}
    assert [(r["vec_id"], r["class_id"]) for r in got if r["kind"] == "match"] == [(50, 8)]


def test_audio_recall_against_brute_force(spark):
    """Queries with noise against all recordings and all offsets."""
    r = np.random.default_rng(21)
    tone = [(np.sin(2 * np.pi * 110 * 2 ** (k / 12) * np.arange(320) / audio.RATE) * 9000) for k in range(24)]
    pcm = lambda notes, noise: (np.concatenate([tone[k] for k in notes]) + r.normal(0, noise, 320 * len(notes))).astype("<i2").tobytes()
    tunes = [r.integers(0, 24, 40).tolist() for _ in range(30)]
    rows = [(k + 1, pcm(t, 0)) for k, t in enumerate(tunes)]
    for k, t in enumerate(tunes):
        at = int(r.integers(0, 15))
        rows.append((50 * (k + 1), pcm([*r.integers(0, 24, 6).tolist(), *t[at : at + 18], *r.integers(0, 24, 5).tolist()], 400)))
    got = {(r["vec_id"], r["class_id"]): r for r in audio.searched(spark.createDataFrame(rows, "vec_id long, pcm binary")).collect() if r["kind"] == "match"}
    fps = {i: audio.packed(audio.chroma(np.frombuffer(x, "<i2"))) for i, x in rows}
    want = {(q, c) for q in fps if q % 50 == 0 for c in fps if c != q and audio.best(fps[q], fps[c], list(range(-len(fps[q]), len(fps[c]))))[2] >= audio.MIN_OVERLAP}
    assert set(got) <= want and len(want) >= 30 and len(set(got) & want) >= 0.9 * len(want)


def test_pipeline_against_brute_force(spark):
    """Stage by stage on its own input: what must go goes, what is clean stays."""
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_dedup", "substring_dedup", "packing"]
    good = corpus_pipeline.quality_rules(spark, d, "")
    assert good.columns == d.columns
    rows = d.collect()
    m = fertility.measured([r["text"] for r in rows])
    verdicts = fertility.verdicts(m, [r["text"] for r in rows], [r["lang"] for r in rows])
    kept = {r["doc_id"]: r for r in good.collect()}
    assert set(kept) == {r["doc_id"] for r, good in zip(rows, verdicts, strict=True) if good}
    sets = {i: set(simhash.shingle_hashes(r["text"], 5).tolist()) for i, r in kept.items()}
    unique = {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, good, "").collect()}
    for i in kept:
        alike = [len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for j in kept if j < i]
        if max(alike, default=0) == 1.0:
            assert i not in unique
        if max(alike, default=0) < 0.6:
            assert i in unique
    last = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert {r["doc_id"] for r in last} <= unique and len({(r["doc_id"], r["piece"]) for r in last}) == len(last)


def exact_components(rows, similarity=0.8):
    """The smallest id that each document is connected with, by all pairs' exact Jaccard similarity."""
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in ((i, t.split()) for i, t in rows)}
    root = {i: i for i in sets}
    for _ in sets:
        before = dict(root)
        for i in sets:
            for j in sets:
                if root[i] != root[j] and len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]):
                    root[i] = root[j] = min(root[i], root[j])
        if root == before:
            return root
    return root


def copies_at(similarity, n, start, length=184):
    """n pairs of texts with the same first shingles, so many that their Jaccard similarity is just that or a little more."""
    common = int(np.ceil(2 * similarity * length / (1 + similarity) - 1e-9))
    rows = []
    for k in range(n):
        w = words(length + 4, start + 3 * k)
        rows += [(start + 2 * k, " ".join(w)), (start + 2 * k + 1, " ".join([*w[: common + 4], *words(length - common, start + 3 * k + 1)]))]
    return rows


@pytest.mark.parametrize("similarity", [0.8, 0.85, 0.9])
def test_near_duplicates_are_found_at_the_threshold(spark, similarity):
    rows = copies_at(similarity, 100, 1000)
    gone = {r["doc_id"] for r in simhash.near_duplicates(docs(spark, rows)).collect()}
    assert len(gone) >= 95 and gone <= {i for i, _ in rows if i % 2}


def test_crowded_keys_lose_no_links(spark):
    """Two chains whose ends aren't alike, and texts on a template: nearly every key is crowded, and divided into cells of a few nodes."""
    line, rows = words(600, 7), []
    for k in range(60):
        rows.append((500 - k if k % 2 else k, " ".join(line[5 * k : 5 * k + 200])))
    other = words(400, 8)
    rows += [(1000 + (7 * k) % 31, " ".join(other[6 * k : 6 * k + 200])) for k in range(31)]
    rows += [(2000 + k, " ".join([*other[:170], *words(26, 900 + k)])) for k in range(40)]
    want = exact_components(rows)
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs(spark, rows), few=2, block=3).collect()}
    assert len(set(want.values())) > 30 and {i: got.get(i, i) for i, _ in rows} == want


def test_pairs_of_near_copies_grow_with_the_group(spark, monkeypatch):
    """A large group of near copies is compared until it is one component, not pair by pair, and neither are copies too far off."""
    made = []
    for name in ("_near", "_alike"):
        monkeypatch.setattr(simhash, name, lambda *a, real=getattr(simhash, name): made.append(real(*a)) or made[-1])
    template, rng, rows = words(200, 11), np.random.default_rng(12), []
    for k in range(400):
        text = list(template)
        for at in rng.choice(200, 2 if k < 300 else 10, replace=False):
            text[at] = f"w{rng.integers(1 << 40)}"
        rows.append((k, " ".join(text)))
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs(spark, rows)).collect()}
    want = exact_components(rows)
    assert sum(x == 0 for x in want.values()) >= 300 and {i: got.get(i, i) for i, _ in rows} == want
    n_made = sum(x.count() for x in made)
    assert n_made < 20 * len(rows), n_made


def test_texts_below_the_threshold_stay(spark):
    rows = copies_at(0.7, 60, 5000) + copies_at(0.75, 60, 6000) + copies_at(0.78, 60, 7000)
    template = words(160, 9)
    rows += [(8000 + k, " ".join([*template, *words(36, 9000 + k)])) for k in range(60)]  # alike at 0.68 each
    assert set(exact_components(rows[-60:]).values()) == {i for i, _ in rows[-60:]}
    assert simhash.near_duplicates(docs(spark, rows)).collect() == []


def test_crowded_passages_lose_none(spark):
    """Each 50 words that an earlier text has are in a passage found, whatever else the texts of their keys have."""
    rows, line, behind = [], words(45, 20), words(40, 22)
    for case in range(8):  # the first has the line and what follows, the second and third five words before it as well
        ahead, x, at = words(5, 30 + case), words(10, 40 + case), 1000 * case
        a = words(45, 50 + case)
        rows += [(at, [*words(20, at), *a, *x]), (at + 1, [*words(20, at + 1), *ahead, *a, *x]), (at + 2, [*words(20, at + 2), *ahead, *a, *words(20, at + 3)])]
        rows += [(at + 10 + k, [*words(20, at + 10 + k), *a, *words(20, at + 50 + k)]) for k in range(20)]
    for k in range(25):  # two lines, and where they meet, each in many texts
        rows += [(20000 + k, [*words(30, 20000 + k), *line, *words(30, 20100 + k)]), (21000 + k, [*words(30, 21000 + k), *behind, *words(30, 21100 + k)])]
        rows.append((22000 + k, [*words(30, 22000 + k), *line[-22:], *behind[:22], *words(30, 22100 + k)]))
    rows += [(30000, [*words(30, 30000), *line, *behind, *words(30, 30001)]), (30001, [*words(30, 30002), *line, *behind, *words(30, 30003)])]
    got = substrings.repeats(docs(spark, [(i, " ".join(w)) for i, w in rows])).collect()
    of = {}
    for r in got:
        of.setdefault(r["doc_id"], set()).update(range(r["start"], r["end"]))
    seen, missed = set(), set()
    for i, w in sorted(rows):
        own = [tuple(w[k : k + 50]) for k in range(len(w) - 49)]
        missed |= {i for k, x in enumerate(own) if x in seen and not of.get(i, set()) >= set(range(k, k + 50))}
        seen |= set(own)
    assert not missed


def test_html_adjacent_template_blocks_go(spark):
    page = lambda k, host, body: (k, f"http://{host}/{k}", f"<div>Shop now</div><div>Free shipping</div><div>News</div><div><p>{body}</p></div><div>Imprint</div><div>Terms</div><div>Jobs</div>")
    rows = [page(k, "many", f"body {k}") for k in range(12)] + [page(100 + k, "few", f"body {k}") for k in range(3)] + [page(200 + k, "copies", "same in copies") for k in range(8)]
    got = {r["page_id"]: r["text"] for r in html_extract.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[k] == f"body {k}" for k in range(12)) and all(got[100 + k] == f"body {k}" for k in range(3))
    assert "same in copies" in got[200]
