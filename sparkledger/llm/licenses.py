"""Licence scans with a generalised suffix automaton.

The automaton holds every run of words of the templates.  A text is streamed through it and keeps, at
each word, the longest run that ends there and occurs in a template (matching statistics).  Runs that
cannot be lengthened are chained in order within a template; a chain that covers enough of it is a span
of that licence.  Words are hashed a batch at a time, and only stretches of words that templates know
are streamed, so ordinary text costs no per-word Python.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sparkledger.llm import common

#: Phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Public licence notices, by label.
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("bsd-3-clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."""),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("boost-1.0", """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor."""),
]
#: Words are runs of digits, letters and everything beyond ASCII.
WORDS = common.byte_table([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
LEAST_RUN, LEAST_SHARE, LEAST_WORDS, WIDEST_GAP, LEAST_FILL = 3, 0.7, 20, 8, 0.5


def _hashes(text: str) -> np.ndarray:
    data = common.lower_ascii(np.frombuffer(text.encode(), np.uint8))
    starts, ends, _ = common.word_spans(data, np.array([0, len(data)]), WORDS)
    return common.word_hashes(data, starts, ends)


class Automaton:
    """The smallest automaton of all runs of the given word lists; each state knows where one of its runs ends in which list."""

    def __init__(self, lists: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size, self.ends = [-1], [0], [{}]
        for number, words in enumerate(lists):
            last = 0
            for place, word in enumerate(words):
                last = self._extend(last, word)
                self.ends[last].setdefault(number, place)
        for state in sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True):
            for number, place in self.ends[state].items():
                self.ends[self.link[state]].setdefault(number, place)

    def _state(self, size: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.size.append(size)
        self.ends.append({})
        return len(self.size) - 1

    def _split(self, before: int, word: int, state: int) -> int:
        """A state for the runs through ``before`` only, with what leads to ``state`` from there moved over."""
        copy = self._state(self.size[before] + 1, self.link[state], dict(self.next[state]))
        self.link[state] = copy
        while before >= 0 and self.next[before].get(word) == state:
            self.next[before][word] = copy
            before = self.link[before]
        return copy

    def _extend(self, last: int, word: int) -> int:
        there = self.next[last].get(word)
        if there is not None:
            return there if self.size[there] == self.size[last] + 1 else self._split(last, word, there)
        new = self._state(self.size[last] + 1, 0, {})
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = new
            last = self.link[last]
        if last >= 0:
            there = self.next[last][word]
            self.link[new] = there if self.size[there] == self.size[last] + 1 else self._split(last, word, there)
        return new

    def matches(self, words: list[int]):
        """(end, length, state) of each run that no further word lengthens, of ``LEAST_RUN`` words at least."""
        state, length, found = 0, 0, []
        for i, word in enumerate(words):
            grown = word in self.next[state]
            if not grown and length >= LEAST_RUN:
                found.append((i - 1, length, state))
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.size[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
            else:
                length = 0
        if length >= LEAST_RUN:
            found.append((len(words) - 1, length, state))
        return found


class Scanner:
    def __init__(self, templates: list[tuple[str, str]]):
        phrases = [_hashes(p) for p in PHRASES]
        texts = [_hashes(t) for _, t in templates]
        self.labels = [label for label, _ in templates]
        self.sizes = [len(t) for t in texts]
        self.vocabulary = np.unique(np.concatenate(phrases + texts))
        self.phrases = [self.number(p).tolist() for p in phrases]
        self.automaton = Automaton([self.number(t).tolist() for t in texts])

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """The vocabulary's number of each word, or -1."""
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == hashes, at, -1)

    def spans(self, runs: list[tuple[int, list[int]]]) -> list[tuple[int, int, int, int]]:
        """Template, first and last word and words covered of each chain, given a text's known stretches (start, words)."""
        open_chains: dict[int, list[int]] = {}
        done = []
        for start, words in runs:
            for end, length, state in self.automaton.matches(words):
                first, last = start + end - length + 1, start + end
                for template, place in self.automaton.ends[state].items():
                    chain = open_chains.get(template)
                    low = place - length + 1
                    if chain and 0 < first - chain[1] <= WIDEST_GAP and low > chain[2]:
                        chain[1:] = [last, place, chain[3] + length]
                    else:
                        if chain:
                            done.append((template, *chain))
                        open_chains[template] = [first, last, place, length]
        done += [(template, *chain) for template, chain in open_chains.items()]
        return [(t, a, b, n) for t, a, b, _, n in done]

    def accepts(self, template: int, first: int, last: int, covered: int) -> bool:
        """Enough of the template, and most of what the chain spans: ordinary words here and there make no licence."""
        return covered >= min(LEAST_WORDS, LEAST_SHARE * self.sizes[template]) and covered >= LEAST_FILL * (last - first + 1)

    def scan(self, text: pa.Array):
        """Of each text: words, places, first and last place of base phrases, their labels, all labels, score, spans."""
        data, offsets = common.text_bytes(text)
        data = common.lower_ascii(data)
        starts, ends, bounds = common.word_spans(data, offsets, WORDS)
        numbers = self.number(common.word_hashes(data, starts, ends))
        counts, row = np.diff(bounds), common.row_of(bounds)
        n = len(text)
        base, low, high = np.zeros(n, np.int64), np.full(n, 2**62), np.full(n, -1)
        base_labels, labels, score, spans = [set() for _ in range(n)], [set() for _ in range(n)], np.zeros(n), [[] for _ in range(n)]
        for phrase, label in zip(self.phrases, PHRASES.values()):
            at = np.flatnonzero(numbers == phrase[0])
            for k, word in enumerate(phrase[1:], 1):
                at = at[at + k < len(numbers)]
                at = at[(numbers[at + k] == word) & (row[at + k] == row[at])]
            np.add.at(base, row[at], 1)
            np.minimum.at(low, row[at], at - bounds[row[at]])
            np.maximum.at(high, row[at], at - bounds[row[at]])
            for r in np.unique(row[at]).tolist():
                base_labels[r].add(label)
        # Stretches of known words, cut at the ends of texts.
        known = numbers >= 0
        begin = known.copy()
        begin[1:] &= ~known[:-1] | (row[1:] != row[:-1])
        stop = known.copy()
        stop[:-1] &= ~known[1:] | (row[1:] != row[:-1])
        a, b = np.flatnonzero(begin), np.flatnonzero(stop) + 1
        long = b - a >= LEAST_RUN
        runs: dict[int, list[tuple[int, list[int]]]] = {}
        for x, y in zip(a[long].tolist(), b[long].tolist()):
            runs.setdefault(int(row[x]), []).append((x - int(bounds[row[x]]), numbers[x:y].tolist()))
        for r, stretches in runs.items():
            for template, first, last, covered in self.spans(stretches):
                if self.accepts(template, first, last, covered):
                    share = min(1.0, covered / self.sizes[template])
                    labels[r].add(self.labels[template])
                    score[r] = max(score[r], share)
                    spans[r].append({"label": self.labels[template], "first_word": first, "last_word": last, "share": share})
        for r in np.flatnonzero(base > 0).tolist():
            labels[r] |= base_labels[r]
            score[r] = 1.0
        none = base == 0
        joined = lambda sets: pa.array([",".join(sorted(x)) for x in sets], pa.string())
        return [pa.array(counts), pa.array(base), pa.array(low, mask=none), pa.array(high, mask=none), joined(base_labels), joined(labels), pa.array(score), pa.array(spans, pa.list_(pa.struct({"label": pa.string(), "first_word": pa.int64(), "last_word": pa.int64(), "share": pa.float64()})))]


_scanners: dict[tuple, Scanner] = {}
common.caches["licenses"] = _scanners.clear


def templates_of(table: DataFrame) -> list[tuple[str, str]]:
    """Label and text of each row of a table of licence texts, at most ``MOST_TEMPLATES`` characters in all; rows with a null are left out."""
    rows = table.select("label", "text").where("label is not null and text is not null").distinct()
    if (rows.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0) > MOST_TEMPLATES:
        raise ValueError("the licence texts are too large for every task to hold")
    return sorted((r["label"], r["text"]) for r in rows.collect())


#: Characters of licence texts that each task holds as one automaton.
MOST_TEMPLATES = 4_000_000


def scan(docs: DataFrame, templates: list[tuple[str, str]] | DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and spans.

    Words count from 0; first_word and last_word are null without a base phrase, and labels are then the
    empty string.  ``score`` is the largest share of a template that a chain covers, 1 with a base phrase.
    A null text has no words; null and repeated doc_ids are kept; other columns are ignored.  ``templates`` is a
    list of labels and texts, or a table of them (label, text), behind the shipped ones.
    """
    templates = TEMPLATES + (templates_of(templates) if isinstance(templates, DataFrame) else list(templates or []))

    def tasks(batches):
        common.begin("licenses")
        key = tuple(templates)
        if key not in _scanners:
            _scanners[key] = Scanner(templates)
        for batch in batches:
            for part in common.slices(batch, 1):
                yield pa.RecordBatch.from_arrays([part.column(0), *_scanners[key].scan(part.column(1))], names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    kind = "array<struct<label: string, first_word: long, last_word: long, share: double>>"
    return rows.mapInArrow(tasks, f"doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans {kind}")
