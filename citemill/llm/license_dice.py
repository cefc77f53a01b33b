"""Licence scans: normalised text against licence templates by Dice coefficient over word bigrams.

A document is looked at line by line, paragraph by paragraph, as a whole, and in
windows of words wherever it holds enough bigrams of one template; so a notice of
several paragraphs, wrapped lines or a sentence is found inside a longer text too.
Each such unit is normalised (lower case, words only, copyright lines out) and
compared with the templates: twice the common bigrams over the sum of both, as
multisets. A template is looked at only if its size alone allows the threshold,
``smaller / larger >= threshold / (2 - threshold)``, and if the unit holds one of
the words without which too few of its bigrams are left. Windows begin and end with
a bigram of the template. Of a template's windows that overlap the most similar one
stays, of those of different templates the one with most common bigrams; a window
within a unit that matches is not named again. Two templates that differ in a
version number or a clause are told apart by the better coefficient.

Templates are short notices, the terms of MIT and BSD and the notices of the
other usual licences; a caller may give others.

Defined cases: a null or empty text has no licence; of templates with equal
coefficients the first by name counts; a unit found twice counts once; a null id
stays null; rows with equal ids are scanned one by one; an empty table gives an
empty result; other columns are not read. One pass, no shuffle; texts of any
length, in time linear in them for given templates.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citemill.llm.common import as_bytes, map_arrow

THRESHOLD = 0.8

BSD_DISCLAIMER = (
    " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES,"
    " INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE"
    " DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,"
    " SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR"
    " SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,"
    " WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE"
    " OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)

# Licence notices as they are published, by name.
TEMPLATES: dict[str, list[str]] = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in"
        " compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,"
        " software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR"
        " CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing"
        " permissions and limitations under the License.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        " associated documentation files (the \"Software\"), to deal in the Software without restriction, including"
        " without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell"
        " copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the"
        " following conditions: The above copyright notice and this permission notice shall be included in all"
        " copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF"
        " ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR"
        " A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE"
        " FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING"
        " FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY"
        " WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See"
        " the GNU General Public License for more details.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation; either version 2 of the License, or (at your"
        " option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY"
        " WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See"
        " the GNU General Public License for more details.",
    ],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met: 1. Redistributions of source code must retain the above copyright"
        " notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must"
        " reproduce the above copyright notice, this list of conditions and the following disclaimer in the"
        " documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright"
        " holder nor the names of its contributors may be used to endorse or promote products derived from this"
        " software without specific prior written permission.",
    ],
    "BSD-2-Clause": [
        "Licensed under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met: 1. Redistributions of source code must retain the above copyright"
        " notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must"
        " reproduce the above copyright notice, this list of conditions and the following disclaimer in the"
        " documentation and/or other materials provided with the distribution.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL"
        " was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC0-1.0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to"
        " this work.",
    ],
}
for _name in ("BSD-2-Clause", "BSD-3-Clause"):
    TEMPLATES[_name].append(TEMPLATES[_name][1] + BSD_DISCLAIMER)

# Words that everyday text seldom holds; they are asked for first (see ``Templates.gate``).
TELLING = frozenset(
    "licence license licensed licenses redistribution redistributions permission waived copyright mozilla apache"
    " gnu mit bsd cc commons sublicense merchantability".split()
)

WORD = re.compile(r"[^\W_]+")
COPYRIGHT_LINE = re.compile(r"^\W*(?:copyright\b|\(c\)|©)[^\n]*\d{4}[^\n]*$", re.I | re.M)


def bigrams(text: str) -> Counter:
    """Word bigrams of the normalised text; a single word counts as one."""
    words = WORD.findall(COPYRIGHT_LINE.sub(" ", text).lower())
    return Counter(zip(words, words[1:])) if len(words) > 1 else Counter((w,) for w in words)


class Templates:
    """Templates sorted by size, for the size bound."""

    def __init__(self, texts: dict[str, list[str]] = TEMPLATES, threshold: float = THRESHOLD):
        self.threshold = threshold
        rows = [(name, bigrams(t)) for name, all_texts in sorted(texts.items()) for t in all_texts]
        self.rows = [(b.total(), name, b) for name, b in rows if b]
        # With a margin for rounding.
        self.smallest = min((n for n, _, _ in self.rows), default=0) * threshold / (2 - threshold) - 1e-6
        self.largest = max((n for n, _, _ in self.rows), default=0) * (2 - threshold) / threshold + 1e-6
        self.gate = frozenset(w for _, _, grams in self.rows for w in self.asked(grams))
        #: Which templates hold a bigram.
        self.holders: dict[tuple, list[int]] = defaultdict(list)
        for i, (_, _, grams) in enumerate(self.rows):
            for gram in grams:
                self.holders[gram].append(i)

    def least_common(self, size: int) -> int:
        """A match of a template of this size has at least so many common bigrams."""
        # 2 * common >= threshold * (own + size) and own >= common; the margin is for rounding.
        return max(1, math.ceil(size * self.threshold / (2 - self.threshold) - 1e-9))

    def asked(self, grams: Counter) -> set[str]:
        """Words of which a match must hold one: the bigrams without them are too few."""
        words = sorted({w for g in grams for w in g}, key=lambda w: (w not in TELLING, -len(w), w))
        asked, least = set(), self.least_common(grams.total())
        for word in words:
            if sum(c for g, c in grams.items() if asked.isdisjoint(g)) < least:
                break
            asked.add(word)
        return asked

    def fits(self, own: int, other: int) -> bool:
        """Whether the sizes alone allow the threshold."""
        return 2 * min(own, other) >= self.threshold * (own + other)

    def best(self, own: Counter) -> tuple[str, float] | None:
        """The most similar template at or above the threshold."""
        n, found = own.total(), None
        for size, name, grams in self.rows:
            if not self.fits(n, size):
                continue
            dice = 2 * sum(min(c, own[g]) for g, c in grams.items() if g in own) / (n + size)
            if dice >= self.threshold and (found is None or dice > found[1]):
                found = (name, dice)
        return found


def units(text: str) -> Iterator[tuple[int, int]]:
    """Lines, paragraphs (runs of lines with text) of more than one line, and the whole."""
    start, lines, paragraph = 0, 0, None
    n_paragraphs = 0
    for line in [*text.split("\n"), ""]:
        end = start + len(line)
        if line.strip():
            yield start, end
            paragraph = paragraph or (start, end)
            paragraph, lines = (paragraph[0], end), lines + 1
        elif paragraph:
            n_paragraphs += 1
            if lines > 1:
                yield paragraph
            paragraph, lines = None, 0
        start = end + 1
    if n_paragraphs > 1:
        yield 0, len(text)


def apart(windows: list[tuple], order: Callable[[tuple], tuple]) -> list[tuple]:
    """Windows (first, last bigram, ...) that do not overlap, the best in ``order`` first."""
    starts, kept = [], []
    for w in sorted(windows, key=order):
        at = bisect_right(starts, w[0])
        if (at and kept[at - 1][1] >= w[0]) or (at < len(kept) and kept[at][0] <= w[1]):
            continue
        starts.insert(at, w[0])
        kept.insert(at, w)
    return kept


def template_windows(hits: list[int], seq: list[tuple], size: int, grams: Counter, templates: Templates) -> list[tuple]:
    """(first, last bigram, common, coefficient) of the windows like one template; ``hits`` are its bigrams' places."""
    least, longest = templates.least_common(size), int(size * (2 - templates.threshold) / templates.threshold + 1e-9)
    found = []
    for i, first in enumerate(hits):
        end = bisect_left(hits, first + longest, i)
        if end - i < least:
            continue
        left, common, best = dict(grams), 0, None
        for last in hits[i:end]:
            if left[seq[last]]:
                left[seq[last]] -= 1
                common += 1
                dice = 2 * common / (last - first + 1 + size)
                if dice >= templates.threshold and (best is None or dice > best[3]):
                    best = (first, last, common, dice)
        if best:
            found.append(best)
    return apart(found, lambda w: (-w[3], w[0], w[1]))


def windows(text: str, templates: Templates) -> Iterator[tuple[str, float, int, int]]:
    """Matches anywhere in the text, without regard to lines."""
    # Copyright lines are blanked, so that places stay.
    text = COPYRIGHT_LINE.sub(lambda m: " " * len(m[0]), text)
    words = [(m[0].lower(), m.start(), m.end()) for m in WORD.finditer(text)]
    seq = [(a[0], b[0]) for a, b in zip(words, words[1:])]
    places = defaultdict(list)
    for at, gram in enumerate(seq):
        for i in templates.holders.get(gram, ()):
            places[i].append(at)
    found = []
    for i, hits in places.items():
        size, name, grams = templates.rows[i]
        if len(hits) >= templates.least_common(size):
            found += [(*w, name) for w in template_windows(hits, seq, size, grams, templates)]
    for first, last, _, dice, name in apart(found, lambda w: (-w[2], -w[3], w[4], w[0])):
        yield name, dice, words[first][1], words[last + 1][2]


def scan(text: str, templates: Templates) -> list[tuple[str, float, int, int]]:
    """(licence, coefficient, start, end) of the units that match, by place. Spans are code points."""
    if templates.gate.isdisjoint(WORD.findall(text.lower())):
        return []
    found = set()
    for start, end in units(text):
        unit = text[start:end]
        if templates.gate.isdisjoint(WORD.findall(unit.lower())):
            continue
        grams = bigrams(unit)
        if templates.smallest <= grams.total() <= templates.largest and (best := templates.best(grams)):
            found.add((best[0], round(best[1], 6), start, end))
    # The furthest end of the matches up to each start tells whether a window lies within one.
    starts, ends = [], []
    for _, _, start, end in sorted(found, key=lambda f: f[2]):
        starts.append(start)
        ends.append(max(end, ends[-1] if ends else 0))
    for name, dice, start, end in windows(text, templates):
        at = bisect_right(starts, start)
        if not at or ends[at - 1] < end:
            found.add((name, round(dice, 6), start, end))
    return sorted(found, key=lambda f: (f[2], f[3], f[0]))


def licenses(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts: dict[str, list[str]] = TEMPLATES
) -> DataFrame:
    """``doc_id, n_matches, licenses`` (names, sorted), ``best`` coefficient and ``matches``."""
    templates = Templates(texts)
    match = pa.struct([("license", pa.string()), ("dice", pa.float64()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = [scan((t or b"").decode("utf-8", "replace"), templates) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([len(r) for r in rows], type=pa.int64()),
                pa.array([",".join(sorted({m[0] for m in r})) for r in rows], type=pa.string()),
                pa.array([max((m[1] for m in r), default=0.0) for r in rows], type=pa.float64()),
                pa.array([[dict(zip(("license", "dice", "start", "end"), m)) for m in r] for r in rows], type=pa.list_(match)),
            ],
            names=["doc_id", "n_matches", "licenses", "best", "matches"],
        )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), as_bytes(text_col).alias("text"))
    return map_arrow(
        rows,
        run,
        "doc_id long, n_matches long, licenses string, best double,"
        " matches array<struct<license:string,dice:double,start:long,end:long>>",
    )


def report(docs: DataFrame) -> DataFrame:
    """Flat columns of :func:`licenses`: the spans as ``name:start:end``."""
    spans = F.transform(
        "matches", lambda m: F.concat_ws(":", m["license"], m["start"].cast("string"), m["end"].cast("string"))
    )
    return licenses(docs).select("doc_id", "n_matches", "licenses", "best", F.concat_ws(",", spans).alias("spans"))
