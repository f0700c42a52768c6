"""The operators' parts against brute force, without Spark."""

import random
import re
import time
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from mapweave.llm import audio, bpe, fertility, html_extract, licenses, packing, shared, sharding, simhash, substrings, warc

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


def test_bpe_is_the_library():
    tool, library, r = bpe.encoder(PATH), Tokenizer.from_file(PATH), random.Random(5)
    letters = "abcdefghilmnorstuvw'0129!?-_<|>éüßñ日ΣσİḀ́ \n\t\x1c\x85\xa0"
    texts = ["", " ", "<|endoftext|>Hi<|startoftext|> x<|end", "aaaa" * 99, "!" * 70, "It's WE'LL d'accord"]
    texts += ["".join(r.choice(letters) for _ in range(r.randint(1, 80))) for _ in range(3000)]
    texts += ["".join(r.choice("aeinrst") for _ in range(r.randint(1, 40))) for _ in range(3000)]
    texts += [f"a{chr(c)}b {chr(c)}{chr(c)}" for c in [*range(1, 0x250), *range(0x370, 0x600), *range(0x2000, 0x2100), 0x1F600, 0x558, 0xA7CE]]
    for text, own, theirs in zip(texts, tool.encode_batch(texts), library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert ids(own) == theirs.ids, text
        assert tool.decode(own).decode() == library.decode(theirs.ids, skip_special_tokens=False)


def test_bpe_merges_of_equal_parts():
    vocab = {x: k for k, x in enumerate(["a", "b", "aa", "aab", "aaaa"])}
    a = bpe.Automaton(vocab, [("a", "a"), ("aa", "b"), ("aa", "aa")])
    table = bpe.Table(a)

    def names(word):
        return [a.labels[t] for t in table.encode(word.encode(), np.array([0]), np.array([len(word)]))[0]]

    assert names("aaa") == ["aa", "a"] and names("aaaab") == ["aa", "aab"] and names("aaaaa") == ["aaaa", "a"]


@pytest.mark.parametrize("seed", range(4))
def test_packing_is_gapless_and_tight(seed):
    r = np.random.default_rng(seed)
    sizes = np.concatenate([r.integers(1, 2049, 300), np.full(20, 2048), r.integers(1, 200, 400)])
    bins, offsets = packing.pack(sizes, 2048)
    for b in np.unique(bins):
        own = np.argsort(offsets[bins == b], kind="stable")
        size, offset = sizes[bins == b][own], offsets[bins == b][own]
        assert (offset == np.cumsum(size) - size).all() and size.sum() <= 2048
    assert len(np.unique(bins)) <= -(-sizes.sum() // 2048) * 1.03 + 2
    assert packing.pack(np.empty(0, np.int64))[0].size == 0


def test_sum_of_squares_takes_the_least_sum():
    sizes, capacity = np.random.default_rng(1).integers(1, 20, 200), 20
    got = packing.sum_of_squares(sizes, capacity, np.arange(200))
    gaps = []
    for size, which in zip(sizes.tolist(), got.tolist(), strict=True):
        def after(k):
            new = [*gaps, capacity - size] if k == len(gaps) else [g - size if i == k else g for i, g in enumerate(gaps)]
            counts = np.bincount(new, minlength=capacity + 1)
            return (counts[1:capacity] ** 2).sum()
        options = [k for k, g in enumerate(gaps) if g >= size] + [len(gaps)]
        assert after(which) == min(map(after, options))
        gaps = [*gaps, capacity - size] if which == len(gaps) else [g - size if i == which else g for i, g in enumerate(gaps)]


def test_slot_maps():
    r = random.Random(2)
    sizes = {k: r.randint(1, 1000) for k in range(500)}
    first = sharding.first_map(sizes, 24, 512)
    total = lambda m, n: [sum(sizes.get(s, 0) for s, x in enumerate(m) if x == k) for k in range(n)]
    assert max(total(first, 24)) - min(total(first, 24)) <= 1000
    grown = sharding.edited_map(first, sizes, 25)
    moved = [k for k in range(512) if grown[k] != first[k]]
    assert max(total(grown, 25)) - min(total(grown, 25)) <= 1000 and len(moved) < 512 / 8
    assert sharding.edited_map(first, {}, 24) == first


def test_repeated_words():
    def brute(w):
        windows = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        return len({k + j for k, x in enumerate(windows) if windows.count(x) > 1 for j in range(3)})

    r = random.Random(3)
    texts = [[r.randrange(3) for _ in range(r.randint(0, 14))] for _ in range(300)]
    found = fertility.repeated_words(np.array([w for t in texts for w in t]), np.array([len(t) for t in texts]))
    assert found.tolist() == [brute(w) for w in texts]
    assert fertility.repeated_words(np.empty(0, np.int64), np.zeros(2, np.int64)).tolist() == [0, 0]


def plain_measures(text):
    """The contract's expressions, one text at a time."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = (text or "").split("\n")
    windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    out = {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": sum(1 for k, line in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", line) and line in lines[:k]),
        "n_repeat_words": len({k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}),
    }
    out["base_failed"] = out["n_words"] < 50 or 100 * out["n_repeat_words"] > 50 * out["n_words"]
    tool = fertility.fertility()
    ids = [i for w in words for i in tool.pieces.encode(w)]
    shares = np.array(list(Counter(ids).values())) / max(1, len(ids))
    return out | {
        "chars_per_token": out["word_chars"] / max(1, len(ids)), "chars_per_token_bytes": out["word_chars"] / max(1, sum(len(tool.bytes.encode_ordinary(" " + w)) for w in words)),
        "byte_share": sum(map(tool.pieces.is_byte, ids)) / max(1, len(ids)), "entropy": float(-(shares * np.log2(shares)).sum()) if ids else 0.0,
        "min_entropy": float(-np.log2(shares.max())) if ids else 0.0, "tokens_per_word": len(ids) / max(1, len(words)),
    }


def test_fertility_against_brute_force():
    r = random.Random(13)
    table = duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()
    texts = [None, "", " \n ", "The cat sat.\nThe cat sat.\n\n\n#*$ x", "\U000e0001\U000e0002", "a\x1cb c\x0bd\u00a0e", "x" * 5000, *(t for (t,) in table[:80])]
    texts += ["".join(r.choice("ab é漢<|\n \t") for _ in range(r.randint(0, 200))) for _ in range(60)]
    found = fertility.measured(texts)
    for k, text in enumerate(texts):
        for name, value in plain_measures(text).items():
            assert found[name][k] == pytest.approx(value), (name, text)
    assert fertility.measured([])["n_words"].size == 0
    assert fertility.script_of("привет мир") == "Cyrillic" and fertility.script_of("漢字かな") == "Han"


def test_bands_hold_for_other_documents():
    """Fitted on even doc_ids of the larger table, so odd ones are held out."""
    rows = duckdb.sql("SELECT text, lang, quality FROM '/root/testdata/sf0.1/documents.parquet' JOIN '/root/testdata/sf0.1/labels.parquet' USING (doc_id) WHERE doc_id % 2 = 1 AND doc_id < 4000").fetchall()
    texts, langs, good = zip(*rows, strict=True)
    m = fertility.measured(list(texts))
    kept, good = fertility.verdicts(m, texts, langs), np.array(good) == 1
    passed = ~m["base_failed"]
    assert kept[good & passed].mean() >= 0.995 and kept[~good & passed].mean() <= 0.05 and not kept[~passed].any()


def test_license_scan():
    s = licenses.scan
    assert s(None)["n_words"] == 0 and s("")["labels"] == ""
    x = s("MIT-License; the mit LICENSE. Apache License")
    assert (x["n_words"], x["n_base"], x["first_word"], x["last_word"], x["base_labels"]) == (7, 3, 0, 5, "apache,mit")
    assert s("MIT License")["n_base"] == 0  # the space is not ASCII
    notice = licenses.NOTICES[0][1]
    assert s("x " * 500 + notice + " y" * 9)["labels"] == "mit"
    assert s(notice.replace("free of charge", "at no cost"))["labels"] == ""  # the mandatory phrase lacks
    assert s("redistribute foundation program version published")["labels"] == ""  # rare words out of place
    assert s("Licensed under CC BY-NC 4.0.")["labels"] == "cc-by-nc"
    for label, wording, phrases in licenses.NOTICES:
        assert label in s("w x y z " * 40 + wording + " q")["labels"].split(",")
        first = " ".join(p.decode() for p in licenses.words_of(wording)).replace(phrases[0], "and so on")
        assert label not in s(first)["labels"].split(",") or label in s(first)["base_labels"]


def test_license_base_against_regular_expressions():
    r = random.Random(14)
    table = duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()
    words = ["MIT", "license", "Apache", "GENERAL", "public", "License", "-", "é", "x", ",", "\u00a0"]
    texts = [None, "", *(t for (t,) in table), *(" ".join(r.choices(words, k=r.randint(0, 60))) for _ in range(300))]
    for text in texts:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        hits = [(k, label) for k in range(len(own)) for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")) if own[k : k + len(phrase.split())] == phrase.split()]
        got = licenses.scan(text)
        want = (len(own), len(hits), min((k for k, _ in hits), default=None), max((k for k, _ in hits), default=None), ",".join(sorted({x for _, x in hits})))
        assert (got["n_words"], got["n_base"], got["first_word"], got["last_word"], got["base_labels"]) == want
        assert set(got["base_labels"].split(",")) - {""} <= set(got["labels"].split(",")) and 0 <= got["score"] <= 1


PAGE = """<!DOCTYPE html><html><head><title>t</title><script>var a='</p>';</script></head><body><header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav>
<div class="cookie-notice">We use cookies</div><main><article><h1>Head &amp;
  line</h1><p><b>One.<br><p>Two &#233;<i>x</i>&nbsp;y<div class="ad">Buy</div><form><label>Mail</label></form><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article></main>
<section class="comments"><p>First!</p></section><aside>Links</aside><footer>(c)</footer></body></html>"""


def blocks(html):
    return [text for _, text in html_extract.Page(html).blocks]


def main_text(html):
    """The text of a page whose host has no other pages."""
    page = html_extract.Page(html)
    gone = html_extract.chosen(page.tree, [n for n, _ in page.blocks], [len(t) for _, t in page.blocks], set(), (), None)
    return html_extract.main_text(page, set(gone))


def test_page_blocks():
    assert main_text(PAGE).split("\n") == ["Head & line", "One.", "Two éx y", "a", "b", "c", "d"]
    assert blocks("") == [] and blocks("<p") == [] and blocks("x <p") == ["x"] and blocks("a < 1") == ["a < 1"]
    assert blocks("<div>" * 3000 + "deep") == ["deep"]
    assert blocks("a < b <!-- x --> c<script>z") == ["a < b c"]
    assert blocks("<p title='a > b'>one<p title=\"it's\">two<p title=>three") == ["one", "two", "three"]


@pytest.mark.parametrize("page", ["<p>story<a " + "".join(f"x{k}='{k}' " for k in range(100)), "<p>story" + "<a b=\"" * 3000, "<p>story" + "<a " * 20000, "<p>story<a b=\"" + "'=" * 20000, "<p>story" + "<" * 20000 + "!-"])
def test_cut_off_tags_cost_one_pass(page):
    begin = time.perf_counter()
    found = blocks(page)
    assert time.perf_counter() - begin < 0.2 and found[0].startswith("story")


def test_content_is_where_the_text_is():
    words = lambda n: " ".join(["word"] * n)
    assert main_text(f'<body><div id="content" class="with-sidebar"><article><p>{words(30)}</p></article></div></body>') == words(30)
    assert main_text(f'<body><div class="post-comment-open"><p>{words(30)}</p><div class="comments"><p>First!</p></div></div></body>') == words(30)
    assert main_text(f'<body><div class="legal-article"><p>{words(30)}</p></div><div class="sidebar"><p>Links</p></div></body>') == words(30)
    story = f'<body><div class="story"><h1>Title</h1><p>{words(200)}</p></div><article class="teaser"><p>Read this too</p></article></body>'
    assert main_text(story).startswith("Title\nword")
    assert main_text(f"<body><main><div>Lead</div><article><h1>T</h1><p>{words(40)}</p></article></main></body>") == "T\n" + words(40)
    assert main_text('<body><div class="ad">a long advert here</div><article><p>ok</p></article></body>') == "ok"


def brute_matching(a, b):
    """The size of the largest mapping that keeps labels, order and parents, by trying all."""
    kids = lambda t, p: [k for k, (_, q) in enumerate(t) if q == p]

    def same(x, y):
        return 0 if a[x][0] != b[y][0] else 1 + rows(tuple(kids(a, x)), tuple(kids(b, y)))

    def rows(xs, ys):
        if not xs or not ys:
            return 0
        return max(rows(xs[1:], ys), rows(xs, ys[1:]), (s := same(xs[0], ys[0])) and s + rows(xs[1:], ys[1:]))

    return rows(tuple(kids(a, -1)), tuple(kids(b, -1)))


def test_alignment_against_brute_force():
    r = random.Random(11)

    def tree():
        out = [("html", -1)]
        for _ in range(r.randint(1, 9)):
            new = (r.choice("abcd"), r.randrange(len(out)))
            if new not in out:
                out.append(new)
        return out

    text = lambda t: "\x1f".join(f"{x}\x1e{p}" for x, p in t)
    for _ in range(300):
        a, b = tree(), tree()
        to = html_extract.aligned(text(a), text(b))
        used = [y for y in to if y >= 0]
        assert len(set(used)) == len(used) == brute_matching(a, b)
        assert all(a[x][0] == b[y][0] and (a[x][1] < 0 or to[a[x][1]] == b[y][1]) for x, y in enumerate(to) if y >= 0)


def test_tree_matching_is_the_largest():
    tree = lambda t: "\x1f".join(f"{a}\x1e{p}" for a, p in t)
    a = [("html", -1), ("nav", 0), ("div", 0), ("p", 2), ("footer", 0)]
    b = [("html", -1), ("div", 0), ("h1", 1), ("p", 1), ("aside", 0), ("footer", 0)]
    assert html_extract.aligned(tree(a), tree(b)) == (0, -1, 1, 3, 5)


def test_warc_records():
    raw = warc.record(7, "http://x/é?q=1", "<p>\r\n\r\n</p>", "d" * 64, "response", None)
    x = warc.parse(raw)
    assert x["payload"] == b"<p>\r\n\r\n</p>" and x["x-page-id"] == "7" and raw.startswith(b"WARC/1.1\r\n")
    assert warc.parse(warc.record(8, None, None, "d", "revisit", 7))["payload"] is None
    rows = [{"file": f, "offset": o, "length": 10} for f, o in (("a", 0), ("a", 10), ("a", 1 << 20), ("b", 0))]
    assert [len(x) for x in warc.ranges(rows)] == [2, 1, 1]


def test_variants_meet_if_and_only_if_a_part_differs_by_one_bit_at_most():
    r = random.Random(4)
    for _ in range(300):
        a = r.getrandbits(64)
        b = a
        for _ in range(r.randint(0, 5)):
            b ^= 1 << r.randrange(64)
        keys = simhash.variant_keys(np.array([[a], [b]], np.uint64), [(0, 32), (32, 32)])
        near = any(bin((a ^ b) >> s & 0xFFFFFFFF).count("1") <= 1 for s in (0, 32))
        assert bool(set(keys[0].tolist()) & set(keys[1].tolist())) == near


def test_compact_windows():
    r = np.random.default_rng(5)
    for n, width in ((1, 1), (30, 7), (200, 46), (46, 46), (10, 46)):
        h = r.integers(0, 60, n).astype(np.uint64) << np.uint64(40)
        want = set()
        for c in range(n):
            lo, hi = c, c
            while lo > 0 and h[lo - 1] > h[c]:
                lo -= 1
            while hi < n - 1 and h[hi + 1] >= h[c]:
                hi += 1
            if hi - lo + 1 >= width:
                want.add((lo, c, hi))
        assert {tuple(x) for x in substrings.compact_windows(h, width).tolist()} == want


def test_signatures_are_those_of_every_passage():
    h = np.random.default_rng(6).integers(0, 1 << 62, 150).astype(np.uint64)
    keys, _, first, last = substrings.signatures(h, np.array([150]), 46, 2)
    for start in range(150 - 45):
        assert sum(1 for f, e in zip(first, last, strict=True) if f <= start and start + 45 <= e) == 2
    again = substrings.signatures(h[40:100], np.array([60]), 46, 2)[0]
    assert set(again.tolist()) <= set(keys.tolist())


def test_shingles_of_many_texts():
    texts = ["a b c d e f", None, "", "A  b\nC d E", "x y", "a b c d e f g", "é b c d e"]
    h, counts = substrings.hashed_shingles(texts)
    assert counts.tolist() == [2, 0, 0, 1, 0, 3, 1] and h[0] == h[2] == h[3] and h[1] == h[4] and len(set(h.tolist())) == 4
    assert substrings.hashed_shingles([])[0].size == 0
    r = np.random.default_rng(9)
    many = [" ".join(words) for words in (r.choice(list("abcdefgh"), n) for n in r.integers(0, 90, 30))]
    h, counts = substrings.hashed_shingles(many)
    together = substrings.signatures(h, counts, 20, 2)
    alone = []
    for k, t in enumerate(many):
        own, n = substrings.hashed_shingles([t])
        alone += [(key, k, a, b) for key, _, a, b in zip(*(x.tolist() for x in substrings.signatures(own, n, 20, 2)), strict=True)]
    assert sorted(zip(*(x.tolist() for x in together), strict=True)) == sorted(alone)


def test_stretches():
    r = np.random.default_rng(7)
    x, y = r.integers(0, 1 << 62, 200).astype(np.uint64), r.integers(0, 1 << 62, 180).astype(np.uint64)
    assert substrings.stretches(x, y, 46, 0.8) == []
    y[20:90] = x[100:170]
    assert substrings.stretches(x, y, 46, 0.8) == [(100, 169, 20, 89, 1.0)]
    y[50:55] = 1
    (found,) = substrings.stretches(x, y, 46, 0.8)
    assert found[:4] == (100, 169, 20, 89) and 0.8 <= found[4] < 1


def test_cut():
    assert substrings.cut("a b  c\nd e", [(1, 3)]) == "a\nd e" and substrings.cut("a b", [(0, 2)]) == "" and substrings.cut("é b c", [(0, 1), (0, 2)]) == "c"


def test_longest_stretch():
    r = np.random.default_rng(12)
    for _ in range(200):
        a, b = (r.integers(0, 1 << 32, r.integers(1, 40)).astype(np.uint32) for _ in "ab")
        offset = int(r.integers(-8, 9))
        low, high = max(0, -offset), min(len(a), len(b) - offset)
        for k in range(low, max(low, high - 5)):
            if r.random() < 0.7:
                b[k + offset] = a[k] ^ np.uint32(1 << r.integers(0, 32)) if r.random() < 0.5 else a[k]
        errors = [int(a[k] ^ b[k + offset]).bit_count() for k in range(low, high)]
        want = max((j - i for i in range(len(errors)) for j in range(i + 1, len(errors) + 1) if sum(errors[i:j]) <= audio.MAX_ERRORS * 32 * (j - i)), default=0)
        start, size, share = audio.stretch(a, b, offset)
        assert size == want and (not size or abs(share - sum(errors[start - low : start - low + size]) / (32 * size)) < 1e-9 and share <= audio.MAX_ERRORS)


def test_audio_alignment():
    r = np.random.default_rng(8)
    t = np.arange(320) / audio.RATE
    tune = lambda n: np.concatenate([np.sin(2 * np.pi * 110 * 2 ** (k / 12) * t) * 9000 for k in r.integers(0, 24, n)])
    x, other = tune(32), tune(32)
    late = np.concatenate([np.zeros(20 * audio.HOP), x]) + r.normal(0, 300, len(x) + 20 * audio.HOP)
    a, b, c = (audio.packed(audio.chroma(v.astype("<i2"))) for v in (x, late, other))
    assert audio.stretch(a, b, 20)[1] >= len(a) - 2 and audio.best(a, b, list(range(-60, 60)))[0] == 20
    assert max(audio.stretch(a, c, k)[1] for k in range(-30, 30)) < audio.MIN_OVERLAP
    assert len(audio.packed(audio.chroma(np.empty(0)))) == 0


@pytest.mark.parametrize("same_hash", [False, True])
def test_repeated_long_words_are_found(monkeypatch, same_hash):
    """Words of over 16 bytes are the same word wherever they come, and so are all if hashes collide."""
    if same_hash:
        unique = np.unique
        monkeypatch.setattr(shared.np, "unique", lambda x, axis=None, **k: unique(x, axis=axis, **k) if axis is not None else unique(x % np.uint64(3), **k))
    texts = [b"donaudampfschifffahrt x " * 40, b"aaaaaaaaaaaaaaaab aaaaaaaaaaaaaaaac aaaaaaaaaaaaaaaa a donaudampfschifffahrt " * 2, b"", " ".join(f"w{k}" for k in range(60)).encode()]
    raw, begins, ends, counts = shared.split_words(texts)
    first, which = shared.distinct_words(raw, begins, ends)
    own = b" ".join(texts).split()
    assert [raw[begins[k] : ends[k]] for k in first[which]] == own and len(first) == len(set(own))
    monkeypatch.undo()
    m = fertility.measured([t.decode() for t in texts])
    assert m["n_repeat_words"].tolist() == [80, 10, 0, 0] and m["base_failed"].tolist() == [True, True, True, False]


def test_near_duplicates_meet_by_their_fingerprints():
    """Keys hold bits of the SimHash fingerprint of the set, and of pairs at a similarity of 0.8 at least 95 % share one."""
    rng = np.random.default_rng(4)
    met = 0
    for k in range(200):
        h = rng.integers(0, 1 << 63, 200, dtype=np.uint64) * np.uint64(2) + np.uint64(k % 2)
        x, y = np.sort(h[:180]), np.sort(h[20:])
        fps = [simhash.set_fingerprint(z) for z in (x, y)]
        assert fps[0] == simhash.fingerprint(x, simhash.LANES)
        keys = simhash.sampled_keys(fps)
        met += bool((keys[0] == keys[1]).any())
        places = simhash._places(simhash.BITS, simhash.KEYS, 64 * simhash.LANES)
        bits = np.unpackbits(np.frombuffer(fps[0], np.uint8))
        assert [f"{v & (1 << simhash.BITS) - 1:0{simhash.BITS}b}" for v in keys[0, :3].tolist()] == ["".join(map(str, bits[p])) for p in places[:3]]
    assert simhash.jaccard(x, y) == 0.8 and met >= 190


def test_sketches_reject_no_sets_that_are_alike():
    """By marks and sizes alone, at lengths from a few shingles to more than there are marks."""
    rng = np.random.default_rng(6)
    rejected = 0
    for n in (1, 5, 40, 300, 5000):
        for k in range(60):
            h = rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64) * np.uint64(2) + np.uint64(k % 2)
            a, b = sorted(rng.integers(0, n // 3 + 1, 2).tolist())
            x, y = np.unique(h[:n]), np.unique(h[a : n + b])
            sx, sy = (np.frombuffer(simhash.sketch(z), np.uint64)[None] for z in (x, y))
            sy = np.concatenate([sx[:, : simhash.LANES], sy[:, simhash.LANES :]], axis=1)  # as if the fingerprints were the same
            for similarity in (0.8, simhash.jaccard(x, y)):
                may = bool(simhash.may_be_alike(sx, sy, similarity)[0])
                assert may or simhash.jaccard(x, y) < similarity
                rejected += not may
    assert rejected >= 40


def test_a_worker_frees_what_its_task_does_not_need(monkeypatch):
    """A task of the passages frees the vocabularies before it begins, and all trim when they end."""
    seen = []
    monkeypatch.setitem(shared.OWNED, "fertility", lambda: seen.append("freed"))
    monkeypatch.setattr(shared, "trim", lambda: seen.append("trimmed"))

    class Rows:
        sparkSession = type("Session", (), {"conf": type("Conf", (), {"set": staticmethod(lambda *_: None)})})
        mapInArrow = staticmethod(lambda step, schema: step)

    shared.TwoGenerations._last = "fertility"

    def step(batches):
        seen.append("begun")
        yield from batches

    step.__module__ = "mapweave.llm.substrings"
    assert list(shared.map_arrow(Rows, step, "x long")([1, 2])) == [1, 2]
    assert seen == ["freed", "trimmed", "begun", "trimmed"]
