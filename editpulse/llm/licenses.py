"""License scan with a generalised suffix automaton.

The automaton accepts every run of consecutive words of every template and
phrase. Streaming a file's words through it gives the matching statistics: at
each word, the longest run ending there that some template holds, and along the
suffix links the longest run of every other place in the templates. Runs of at least
MIN_RUN words that the next word does not extend are anchors. The chain of a template
is the largest set of its anchors' words that ascends strictly in the file and in
the template, so no word of either counts twice; it gives the share of the template
that is covered, and the spans of the file that cover it. A template of which at
least MIN_COVER is covered gives its label: the part of its name before a slash, as
whole licences stand in sections. The base phrases are read off the same pass: a
phrase ends wherever the current run ends with it.

Words are taken as in ``text``; a null or empty text has none, no label, null
places and score 0. Every row is scanned by itself: repeated rows are scanned
again. An empty table gives none. A text of any length is scanned whole; one above
the chunk size is handled alone. Further columns do not matter.

score: the largest share of a template that a chain covers, 1 for any base phrase.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editpulse.llm import text as X

MIN_RUN, MIN_COVER = 4, 0.5

# Phrases of the contract, and public licences by section: short ones
# whole, of long ones the notices that files carry.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
TEMPLATES = {
    "mit/permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
                      "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, "
                      "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
                      "furnished to do so, subject to the following conditions:",
    "mit/conditions": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit/disclaimer": "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the warranties "
                      "of merchantability, fitness for a particular purpose and noninfringement. In no event shall the authors or copyright holders be "
                      "liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or "
                      "in connection with the software or the use or other dealings in the software.",
    "mit/line": "Released under the MIT License.",
    "isc/permission": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
                      "that the above copyright notice and this permission notice appear in all copies.",
    "isc/disclaimer": "The software is provided \"as is\" and the author disclaims all warranties with regard to this software including all implied "
                      "warranties of merchantability and fitness. In no event shall the author be liable for any special, direct, indirect, or "
                      "consequential damages or any damages whatsoever resulting from loss of use, data or profits, whether in an action of contract, "
                      "negligence or other tortious action, arising out of or in connection with the use or performance of this software.",
    "bsd/permission": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
                      "conditions are met:",
    "bsd/conditions": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
                      "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in "
                      "the documentation and/or other materials provided with the distribution.",
    "bsd/endorsement": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
                       "from this software without specific prior written permission.",
    "bsd/disclaimer": "This software is provided by the copyright holders and contributors \"as is\" and any express or implied warranties, including, but "
                      "not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed. In no event shall "
                      "the copyright holder or contributors be liable for any direct, indirect, incidental, special, exemplary, or consequential damages "
                      "(including, but not limited to, procurement of substitute goods or services; loss of use, data, or profits; or business "
                      "interruption) however caused and on any theory of liability, whether in contract, strict liability, or tort (including negligence "
                      "or otherwise) arising in any way out of the use of this software, even if advised of the possibility of such damage.",
    "zlib/disclaimer": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
                       "damages arising from the use of this software.",
    "zlib/permission": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
                       "redistribute it freely, subject to the following restrictions:",
    "zlib/conditions": "The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this "
                       "software in a product, an acknowledgment in the product documentation would be appreciated but is not required. Altered source "
                       "versions must be plainly marked as such, and must not be misrepresented as being the original software. This notice may not be "
                       "removed or altered from any source distribution.",
    "unlicense/grant": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
                       "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
                       "non-commercial, and by any means.",
    "apache-2.0/notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
                         "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-2.0/disclaimer": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
                             "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
                             "language governing permissions and limitations under the License.",
    "apache-2.0/line": "Licensed under the Apache License, Version 2.0.",
    "gpl-notice/permission": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                             "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-notice/disclaimer": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
                             "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "gpl-notice/copy": "You should have received a copy of the GNU General Public License along with this program. If not, see "
                       "https://www.gnu.org/licenses/",
    "gpl-work": "This work is licensed under the GNU General Public License version 3",
    "mpl-2.0/notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
                      "this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "cc-by-work": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc-line": "Licensed under CC BY-NC 4.0.",
}
_WORD = re.compile(X.WORD_PATTERN)


class Automaton:
    """Generalised suffix automaton over word ids; templates are bounded, and
    so is its size (two states per word at most)."""

    def __init__(self, sequences: list[list[int]]):
        self.length, self.link, self.next, self.place = [0], [-1], [{}], [[]]
        for number, sequence in enumerate(sequences):
            last = 0
            for at, word in enumerate(sequence):
                last = self._extend(last, word)
                self.place[last].append((number, at))
        # Runs of a state also end where those of states that link to it end.
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.place[self.link[state]] = sorted(set(self.place[self.link[state]]) | set(self.place[state]))

    def _clone(self, p: int, q: int, word: int) -> int:
        copy = len(self.length)
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.next.append(dict(self.next[q]))
        self.place.append([])
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            q = self.next[last][word]
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, q, word)
        new, p = len(self.length), last
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        self.next.append({})
        self.place.append([])
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, word)
        return new

    def statistics(self, ids: list[int]):
        """(length, state) of the longest run ending at each word."""
        state = size = 0
        for word in ids:
            while state and word not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if word in self.next[state]:
                state, size = self.next[state][word], size + 1
            yield size, state


class Scanner:
    """Templates and phrases as word ids, and their automaton."""

    def __init__(self, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES, min_run: int = MIN_RUN, min_cover: float = MIN_COVER):
        self.min_run, self.min_cover = min_run, min_cover
        known: dict[str, int] = {}
        ids = lambda s: [known.setdefault(w, len(known)) for w in _WORD.findall(s.lower())]
        self.templates = [(label, ids(s)) for label, s in templates.items()]
        self.phrases = [(label, ids(s)) for s, label in phrases.items()]
        self.automaton = Automaton([s for _, s in self.templates] + [s for _, s in self.phrases])
        first_phrase = len(self.templates)
        #: Per state: (words, label) of phrases that its runs may end with.
        self.ends = [[] for _ in self.automaton.length]
        for state, places in enumerate(self.automaton.place):
            for label, s in self.phrases:
                if any(at + 1 >= len(s) and self._sequence(n)[at + 1 - len(s) : at + 1] == s for n, at in places):
                    self.ends[state].append((len(s), label))
        #: Per state: (template, place, words) of the longest run that ends at each place
        #: of a template; 0 words stand for the length of the current run.
        self.reach = [self._reached(state, first_phrase) for state in range(len(self.ends))]
        self.words = [w.encode() for w in known]
        joined = b" ".join(self.words)
        data = np.frombuffer(joined, np.uint8)
        starts, ends, _ = X.words(data, np.array([0, len(data)]))
        h = X.word_hashes(data, starts, ends)
        self.set, self.id_of = X.HashSet(h), dict(zip(h.tolist(), range(len(h))))

    def _sequence(self, n: int) -> list[int]:
        k = len(self.templates)
        return self.templates[n][1] if n < k else self.phrases[n - k][1]

    def _reached(self, state: int, first_phrase: int) -> list[tuple[int, int, int]]:
        a, out, seen, at = self.automaton, [], set(), state
        while at > 0 and a.length[at] >= self.min_run:
            new = [p for p in a.place[at] if p[0] < first_phrase and p not in seen]
            out += [(t, place, 0 if at == state else a.length[at]) for t, place in new]
            seen.update(new)
            at = a.link[at]
        return out

    def runs(self, low: np.ndarray, offsets: np.ndarray):
        """Word bounds of a chunk, and per text its maximal runs of at least two
        known words as (first word, ids). Only such runs can match."""
        starts, ends, first = X.words(low, offsets)
        out: dict[int, list] = {}
        if len(starts):
            h = X.word_hashes(low, starts, ends)
            at = self.set.find(h)
            owner = np.searchsorted(first, at, "right") - 1
            cut = np.flatnonzero((np.diff(at) > 1) | (np.diff(owner) > 0)) + 1
            edge = np.concatenate([[0], cut, [len(at)]])
            long = np.flatnonzero(np.diff(edge) >= 2)
            for a, b in zip(edge[long].tolist(), edge[long + 1].tolist()):
                ids = [self.id_of[x] for x in h[at[a:b]].tolist()]
                doc = int(owner[a])
                out.setdefault(doc, []).append((int(at[a] - first[doc]), ids))
        return starts, ends, first, out

    def read(self, runs) -> tuple[list[tuple[int, str]], list[tuple[int, int, int, int]]]:
        """Base places (first word, label), and anchors (template, place in it,
        place in the text, words): runs of at least ``min_run`` that end at a place of a
        template, as long as can be, and are not extended by the next word."""
        base, anchors = [], []
        for start, ids in runs:
            for i, (size, state) in enumerate(self.automaton.statistics(ids)):
                for n, label in self.ends[state]:
                    if n <= size:
                        base.append((start + i + 1 - n, label))
                if size >= self.min_run:
                    after = ids[i + 1] if i + 1 < len(ids) else None
                    for t, at, n in self.reach[state]:
                        words = self.templates[t][1]
                        if at + 1 == len(words) or words[at + 1] != after:
                            anchors.append((t, at + 1 - (n or size), start + i + 1 - (n or size), n or size))
        return base, anchors

    def covered(self, anchors) -> dict[str, tuple[float, list[tuple[int, int]]]]:
        """Share of each template that its best chain covers, and the spans (first and
        last word) of the text that cover it: the longest sequence of matched words
        that ascends strictly in text and template."""
        by_template: dict[int, set] = {}
        for t, at, place, n in anchors:
            by_template.setdefault(t, set()).update((place + i, -(at + i)) for i in range(n))
        best = {}
        for t, cells in by_template.items():
            label, words = self.templates[t]
            tops, last, chain = [], [], []
            for place, at in sorted(cells):
                k = bisect_left(tops, -at)
                tops[k:k + 1], last[k:k + 1] = [-at], [len(chain)]
                chain.append((place, last[k - 1] if k else -1))
            spans, at = [], last[-1]
            while at >= 0:
                place, at = chain[at]
                if spans and spans[-1][0] == place + 1:
                    spans[-1] = (place, spans[-1][1])
                else:
                    spans.append((place, place))
            best[label] = (len(tops) / len(words), spans[::-1])
        return best


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scanner: Scanner | None = None) -> DataFrame:
    """One row per document, see the contract of the query; further columns:
    ``chains`` (section, share covered, spans of the text as first and last word)."""
    held = docs.sparkSession.sparkContext.broadcast(scanner or Scanner())

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        s = held.value
        data, offsets = X.column_bytes(batch.column(1))
        rows = []
        for lo, hi in X.chunks(offsets):
            low = X.lowered(data[offsets[lo] : offsets[hi]])
            starts, ends, first, runs = s.runs(low, offsets[lo : hi + 1] - offsets[lo])
            for doc, n in enumerate(np.diff(first).tolist()):
                if doc not in runs:
                    rows.append((n, 0, None, None, "", "", 0.0, []))
                    continue
                true = [(a, ids) for a, ids in runs[doc] if all(
                    low[starts[first[doc] + a + i] : ends[first[doc] + a + i]].tobytes() == s.words[w] for i, w in enumerate(ids))]
                base, anchors = s.read(true)
                cover = s.covered(anchors)
                labels = sorted({label for _, label in base})
                more = sorted(set(labels) | {section.partition("/")[0] for section, (share, _) in cover.items() if share >= s.min_cover})
                places = [a for a, _ in base]
                rows.append((n, len(base), min(places, default=None), max(places, default=None), ",".join(labels), ",".join(more),
                             1.0 if base else max((share for share, _ in cover.values()), default=0.0), sorted(cover.items())))
        i, t = pa.int64(), pa.string()
        kinds = [i, i, i, i, t, t, pa.float64(), pa.list_(pa.struct([("section", t), ("share", pa.float64()), ("spans", pa.list_(pa.struct([("first", i), ("last", i)])))]))]
        chains = [[{"section": a, "share": b, "spans": [{"first": x, "last": y} for x, y in c]} for a, (b, c) in r[7]] for r in rows]
        columns = [pa.array(c, k) for c, k in zip([*zip(*[r[:7] for r in rows]), chains], kinds)]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "chains"])
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = rows.schema[0].dataType.simpleString()
    return X.map_batches(rows, run, f"doc_id {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
                                    "labels string, score double, chains array<struct<section:string,share:double,spans:array<struct<first:bigint,last:bigint>>>>")
