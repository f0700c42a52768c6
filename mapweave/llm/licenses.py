"""License scans by a positional index of rare words.

The index holds, per license wording, the places of its rarest words: those with the highest inverse document frequency, which is
counted over all documents of the table. Of a file, the words that the index knows are looked up, rarest first; each
occurrence votes for the place in the file at which the wording would begin, and votes for one wording are intersected by that
relative place, with some slack for edits. A wording counts if enough of its rare words stand where it has them and all of its
mandatory phrases stand in the file. All occurrences of all words are looked up; nothing is capped.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. Null texts count as empty. Rows that
repeat give rows that repeat.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared

#: Phrases that give a label wherever they stand.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

_MIT_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
_MIT_TERMS = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_BSD_GRANT = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_NAME = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_TERMS = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_GNU = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name}General Public License as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name}General Public License for more details. You should have received a copy of the GNU {name}General Public License along with this program."
_CC = "This work is licensed under a Creative Commons {name} 4.0 International License"

#: Label, public wording, and its mandatory phrases, all of which must stand in the file.
NOTICES = [
    ("mit", f"{_MIT_GRANT} {_MIT_TERMS}", ["permission is hereby granted free of charge", "without warranty of any kind"]),
    ("mit", _MIT_GRANT, ["permission is hereby granted free of charge", "to deal in the software without restriction"]),
    ("mit", "released under the MIT License", ["mit license"]),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.", ["apache license version 2", "in compliance with the license"]),
    ("apache", "licensed under the Apache License, Version 2.0", ["apache license"]),
    ("apache", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions. \"License\" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document.", ["terms and conditions for use reproduction and distribution", "as defined by sections 1 through 9 of this document"]),
    ("gpl", _GNU.format(name="", version="3"), ["gnu general public license", "free software foundation"]),
    ("gpl", _GNU.format(name="", version="2"), ["gnu general public license", "free software foundation"]),
    ("gpl", "This work is licensed under the GNU General Public License, version 3", ["gnu general public license"]),
    ("lgpl", _GNU.format(name="Lesser ", version="3"), ["gnu lesser general public license", "free software foundation"]),
    ("agpl", _GNU.format(name="Affero ", version="3"), ["gnu affero general public license", "free software foundation"]),
    ("bsd", f"{_BSD_GRANT} {_BSD_NAME} {_BSD_TERMS}", ["redistribution and use in source and binary forms", "neither the name of"]),
    ("bsd", f"{_BSD_GRANT} {_BSD_TERMS}", ["redistribution and use in source and binary forms", "this list of conditions and the following disclaimer"]),
    ("bsd", _BSD_GRANT, ["redistribution and use in source and binary forms", "provided that the following conditions are met"]),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.", ["for any purpose with or without fee is hereby granted", "the author disclaims all warranties"]),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software.", ["permission is granted to anyone to use this software for any purpose", "must not be misrepresented"]),
    ("bsl", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so", ["to any person or organization obtaining a copy", "to prepare derivative works of the software"]),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.", ["mozilla public license", "this source code form is subject to"]),
    ("epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/", ["eclipse public license", "accompanying materials"]),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.", ["free and unencumbered software released into the public domain"]),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work", ["waived all copyright and related or neighboring rights"]),
    ("cc-by", _CC.format(name="Attribution"), ["creative commons attribution 4"]),
    ("cc-by-sa", _CC.format(name="Attribution-ShareAlike"), ["creative commons attribution sharealike"]),
    ("cc-by-nd", _CC.format(name="Attribution-NoDerivatives"), ["creative commons attribution noderivatives"]),
    ("cc-by-nc", _CC.format(name="Attribution-NonCommercial"), ["creative commons attribution noncommercial 4"]),
    ("cc-by-nc-sa", _CC.format(name="Attribution-NonCommercial-ShareAlike"), ["creative commons attribution noncommercial sharealike"]),
    ("cc-by", "Licensed under CC BY 4.0", ["cc by 4"]),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0", ["cc by sa"]),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0", ["cc by nd"]),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", ["cc by nc 4"]),
    ("cc-by-nc-sa", "Licensed under CC BY-NC-SA 4.0", ["cc by nc sa"]),
]
#: Different words of a wording that the index has.
RARE = 12
#: Share of a wording's places in the index that must stand in place.
LEAST = 0.7
#: Words that a place may be off, as a share of the wording's length, and at least.
SLACK, LEAST_SLACK = 0.1, 1

_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORD_BYTES).split()


class Index:
    """word -> [(wording, place)] of each wording's rarest words, and the phrases.

    idf: inverse document frequency by word; without it that among the wordings.
    """

    def __init__(self, idf: dict[bytes, float] | None = None) -> None:
        wordings = [words_of(text) for _, text, _ in NOTICES]
        if idf is None:
            df = Counter(w for words in wordings for w in set(words))
            idf = {w: math.log(len(wordings) / n) for w, n in df.items()}
        self.idf = idf
        self.length = [len(w) for w in wordings]
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.weight = [0] * len(wordings)
        for k, words in enumerate(wordings):
            rare = set(sorted(set(words), key=lambda w: (-idf[w], w))[:RARE])
            for at, word in enumerate(words):
                if word in rare:
                    self.postings[word].append((k, at))
                    self.weight[k] += 1
        self.base = {tuple(words_of(p)): label for p, label in BASE.items()}
        self.mandatory = [[tuple(words_of(p)) for p in phrases] for _, _, phrases in NOTICES]
        self.first = {p[0] for p in self.base} | {p[0] for phrases in self.mandatory for p in phrases}
        self.known = set(self.postings) | self.first


@cache
def index() -> Index:
    return Index()


@cache
def vocabulary() -> frozenset[bytes]:
    """All words of the wordings."""
    return frozenset(w for _, text, _ in NOTICES for w in words_of(text))


def stands(words: list[bytes], places: dict[bytes, list[int]], phrase: tuple[bytes, ...]) -> list[int]:
    """Places where the phrase's words stand one after the other."""
    return [at for at in places.get(phrase[0], ()) if tuple(words[at : at + len(phrase)]) == phrase]


def scan(text: str | None, tool: Index | None = None) -> dict:
    """n_words, n_base, first_word, last_word, base_labels, labels, score of one text."""
    tool, words = tool or index(), words_of(text)
    out = {"n_words": len(words), "n_base": 0, "first_word": None, "last_word": None, "base_labels": "", "labels": "", "score": 0.0}
    if not words or not tool.known.intersection(words):
        return out
    places: dict[bytes, list[int]] = defaultdict(list)
    for at, word in enumerate(words):
        if word in tool.known:
            places[word].append(at)
    found = {at: label for phrase, label in tool.base.items() for at in stands(words, places, phrase)}
    labels = set(found.values())
    if found:
        out |= {"n_base": len(found), "first_word": min(found), "last_word": max(found), "base_labels": ",".join(sorted(labels))}
    begins: dict[int, list[tuple[int, int]]] = defaultdict(list)  # wording -> (where it would begin, place in it)
    for word in sorted(places.keys() & tool.postings.keys(), key=lambda w: (-tool.idf[w], w)):
        for k, at in tool.postings[word]:
            begins[k] += [(p - at, at) for p in places[word]]
    best = 0.0
    for k, votes in begins.items():
        if len({at for _, at in votes}) < LEAST * tool.weight[k]:
            continue
        votes.sort()
        slack, low, inside, most = max(LEAST_SLACK, int(SLACK * tool.length[k])), 0, Counter(), 0
        for begin, at in votes:
            inside[at] += 1
            while begin - votes[low][0] > slack:
                inside[votes[low][1]] -= 1
                if not inside[votes[low][1]]:
                    del inside[votes[low][1]]
                low += 1
            most = max(most, len(inside))
        share = most / tool.weight[k]
        if share >= LEAST and all(stands(words, places, p) for p in tool.mandatory[k]):
            labels.add(NOTICES[k][0])
            best = max(best, share)
    out |= {"labels": ",".join(sorted(labels)), "score": max(best, 0.5 if found else 0.0)}
    return out


SCHEMA = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def rarity(docs: DataFrame) -> dict[bytes, float]:
    """Inverse document frequency, over all documents, of the wordings' words: a few hundred, whatever the input."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n, known = Counter(), 0, vocabulary()
        for part in shared.slices(batches, "text"):
            for text in part.column("text").to_pylist():
                counts.update(known.intersection(words_of(text)))
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([b"", *counts], pa.binary()), pa.array([n, *counts.values()], pa.int64())], ["word", "n"])

    rows = shared.map_arrow(docs.select("text"), step, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = {bytes(r["word"]): r["n"] for r in rows.collect()}
    n = found.pop(b"", 0)
    return {w: math.log((n + 1) / (found.get(w, 0) + 1)) for w in vocabulary()}


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id and the scan of every whole text."""
    fields = [x.split() for x in SCHEMA.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
    rows = docs.select("doc_id", "text")
    idf = rarity(rows)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Index(idf)
        for part in shared.slices(batches, "text"):
            found = [scan(t, tool) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array([x[n] for x in found], kinds[k]) for n, k in fields)], ["doc_id", *(n for n, _ in fields)])

    return shared.map_arrow(rows, step, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {SCHEMA}")
