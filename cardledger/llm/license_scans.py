"""License scans: winnowed fingerprints pick candidates, banded alignment measures them.

Templates are cut into lower-cased words; the hashes of their runs of `GRAM` words are winnowed (of
every `WINDOW` neighbours the smallest is kept) into an inverted index: fingerprint to template and
place. A document's runs are looked up in the index, all of them, so that any stretch of GRAM +
WINDOW - 1 words of a template is found. Each look-up votes for a template at a diagonal (where in
the document the template would begin); votes close to each other are one candidate. A candidate's
words are aligned with the template's within a band around the diagonal, if enough of the
template's words stand within the band at all, which spares the texts of thousands of words most alignments. The report has the share of
the template's words that the alignment matches, and the span of the original text.

Where words are put in or left out all along a copy, its votes drift over many diagonals. A chain of votes
too wide for one band is aligned once more, in bands that hold any drift up to half the template's words,
over the words that no report has taken yet.

Licenses differ from each other in few words. The phrases that tell a template from its siblings (`KEYS`:
name and version, mostly) have to stand in the span word for word, whatever the coverage.

The index holds the templates alone, and its size is checked; documents are scanned where they lie.

Defined cases: null, empty and wordless documents have no rows. Templates of fewer than GRAM words
are one run. Null templates are refused. Of reports of one template that overlap, the one with the
higher coverage stays, the earlier one at a tie; so it does among `SIBLINGS`. Other templates may share
words (a notice and the header that it begins) and are all reported. Repeated rows give repeated reports.
"""

from __future__ import annotations

import json
import pkgutil
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from cardledger.llm.texts import Prefix, Words, as_bytes, groups

GRAM = 3
WINDOW = 2
BAND = 8  # words that may be put in or left out at a time; a quarter of a short template's words
MIN_COVERAGE = 0.8
MOST_TEMPLATE_BYTES = 32 << 20

# The notices and the short licenses that are looked for by default.
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0 header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "MIT notice": "Released under the MIT License",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF "
        "ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR "
        "A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE "
        "FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING "
        "FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version. This program is distributed in the hope that it will be useful, but "
        "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU General Public License for more details."
    ),
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0",
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "All rights reserved": "All rights reserved",
    "GPL-2.0 notice": "This work is licensed under the GNU General Public License, version 2",
    "LGPL-3.0 notice": "This work is licensed under the GNU Lesser General Public License, version 3",
    "LGPL-2.1 notice": "This work is licensed under the GNU Lesser General Public License, version 2.1",
    "AGPL-3.0 notice": "This work is licensed under the GNU Affero General Public License, version 3",
    "BSD notice": "Released under the BSD License",
    "CC-BY-4.0 short notice": "Licensed under CC BY 4.0",
    "CC-BY-SA-4.0 short notice": "Licensed under CC BY-SA 4.0",
    "CC-BY-ND-4.0 short notice": "Licensed under CC BY-ND 4.0",
    "CC-BY-NC-SA-4.0 short notice": "Licensed under CC BY-NC-SA 4.0",
    "CC-BY-NC-ND-4.0 short notice": "Licensed under CC BY-NC-ND 4.0",
    "CC-BY-SA-4.0 notice": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"
    ),
    "CC-BY-NC-4.0 long notice": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"
    ),
}
TEMPLATES |= json.loads(pkgutil.get_data(__package__, "license_texts.json"))

# What has to stand in a report's span word for word.
KEYS = {
    "0BSD": ["is hereby granted. The software is provided"],  # not in ISC
    "MIT-0": ["furnished to do so. The software is provided"],  # not in MIT
    "BSD-3-Clause": ["endorse or promote products derived from this software"],
    "Apache-2.0 text": ["Apache License, Version 2.0"],
    "GPL-1.0 text": ["Version 1, February 1989"],
    "GPL-2.0 text": ["Version 2, June 1991"],
    "GPL-3.0 text": ["Use with the GNU Affero General Public License"],  # not in AGPL-3.0
    "LGPL-2.0 text": ["GNU Library General Public License"],
    "LGPL-2.1 text": ["GNU Lesser General Public License"],
    "GFDL-1.2 text": ["Version 1.2, November 2002"],
    "GFDL-1.3 text": ["Version 1.3, 3 November 2008"],
    "GPL-2.0 header": ["GNU General Public License", "version 2 of the License"],
    "LGPL-2.1 header": ["GNU Lesser General Public License", "version 2.1 of the License"],
    "LGPL-3.0 header": ["GNU Lesser General Public License", "version 3 of the License"],
    "AGPL-3.0 header": ["GNU Affero General Public License", "version 3 of the License"],
    "MPL-2.0 header": ["Mozilla Public License, v. 2.0"],
    "Apache-2.0 notice": ["Apache License, Version 2.0"],
    "Apache-2.0 header": ["Apache License, Version 2.0"],
    "MIT notice": ["MIT License"],
    "MIT": ["shall be included in all copies"],  # not in MIT-0
    "BSD notice": ["BSD License"],
    "ISC": ["permission notice appear in all copies"],  # not in HPND
    "GPL-2.0 notice": ["GNU General Public License, version 2"],
    "GPL-3.0 notice": ["GNU General Public License, version 3"],
    "GPL-3.0 header": ["GNU General Public License", "version 3 of the License"],
    "LGPL-2.1 notice": ["GNU Lesser General Public License, version 2.1"],
    "LGPL-3.0 notice": ["GNU Lesser General Public License, version 3"],
    "AGPL-3.0 notice": ["GNU Affero General Public License, version 3"],
    "CC-BY-4.0 short notice": ["CC BY 4.0"],
    "CC-BY-SA-4.0 short notice": ["CC BY-SA 4.0"],
    "CC-BY-ND-4.0 short notice": ["CC BY-ND 4.0"],
    "CC-BY-NC-4.0 notice": ["CC BY-NC 4.0"],
    "CC-BY-NC-SA-4.0 short notice": ["CC BY-NC-SA 4.0"],
    "CC-BY-NC-ND-4.0 short notice": ["CC BY-NC-ND 4.0"],
    "CC-BY-4.0 notice": ["Creative Commons Attribution 4.0"],
    "CC-BY-SA-4.0 notice": ["Creative Commons Attribution-ShareAlike 4.0"],
    "CC-BY-NC-4.0 long notice": ["Creative Commons Attribution-NonCommercial 4.0"],
}

# Templates of different licenses that have most words in common.
SIBLINGS = [
    {name for name in TEMPLATES if "CC BY" in TEMPLATES[name]},
    {name for name in TEMPLATES if "Creative Commons" in TEMPLATES[name]},
    {"GPL-2.0 notice", "GPL-3.0 notice", "LGPL-2.1 notice", "LGPL-3.0 notice", "AGPL-3.0 notice"},
    {"MIT notice", "BSD notice"},
    {"GPL-2.0 header", "GPL-3.0 header", "LGPL-2.1 header", "LGPL-3.0 header", "AGPL-3.0 header"},
    {"LGPL-2.0 text", "LGPL-2.1 text"},
    {"GFDL-1.2 text", "GFDL-1.3 text"},
    {"BSD-2-Clause", "BSD-3-Clause"},
    {"MIT", "MIT-0"},
    {"ISC", "0BSD"},
]

REPORTS = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("license", StringType()),
        StructField("coverage", DoubleType()),
        StructField("matched_words", LongType()),
        StructField("template_words", LongType()),
        StructField("start", LongType()),  # bytes of the original UTF-8 text
        StructField("end", LongType()),
    ]
)


def winnow(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places of the smallest of every `window` neighbours, the last one at a tie."""
    if len(hashes) <= window:
        return np.flatnonzero(hashes == hashes.min())[-1:] if len(hashes) else np.zeros(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(hashes, window)[:, ::-1]
    return np.unique(np.arange(len(views)) + window - 1 - views.argmin(axis=1))


def _runs(words: np.ndarray, gram: int) -> np.ndarray:
    n = max(len(words) - gram + 1, 0)
    return Prefix(words).hashes(np.arange(n), np.arange(n) + gram)


class Index:
    """Inverted index: sorted fingerprints, each with its template and place."""

    def __init__(self, templates: dict[str, str], gram: int, window: int):
        self.names = sorted(templates)
        self.gram = gram
        self.keys = [[Words([k.encode()]).hash for k in KEYS.get(name, ())] for name in self.names]
        self.family = [next((f for f, s in enumerate(SIBLINGS) if name in s), None) for name in self.names]
        self.words, prints, of, place = [], [], [], []
        for k, name in enumerate(self.names):
            words = Words([templates[name].encode()]).hash
            if not len(words):
                raise ValueError(f"template {name!r} has no words")
            self.words.append(words)
            runs = _runs(words, min(gram, len(words)))
            kept = winnow(runs, window) if len(words) >= gram else np.zeros(1, np.int64)
            prints.append(runs[kept])
            of.append(np.full(len(kept), k))
            place.append(kept)
        self.short = sorted({len(w) for w in self.words if len(w) < gram})
        every = np.concatenate(prints)
        order = np.argsort(every, kind="stable")
        self.prints, self.of, self.place = every[order], np.concatenate(of)[order], np.concatenate(place)[order]

    def votes(self, words: np.ndarray) -> Iterator[tuple[int, int]]:
        """(template, diagonal) of every fingerprint that occurs among the words."""
        for gram in [self.gram, *self.short]:
            runs = _runs(words, gram)
            low = np.searchsorted(self.prints, runs, "left")
            high = np.searchsorted(self.prints, runs, "right")
            for at in np.flatnonzero(high > low):
                for k in range(low[at], high[at]):
                    if min(self.gram, len(self.words[self.of[k]])) == gram:
                        yield int(self.of[k]), int(at - self.place[k])


def align(template: np.ndarray, words: np.ndarray, low: int, high: int) -> tuple[int, int, int]:
    """Most words of the template matched in order, with diagonals from `low` to `high` (place in
    `words` minus place in the template): (matched, first, last) with the matched words' places."""
    width = high - low + 1
    best = np.zeros(width, np.int64)  # by diagonal: matched so far
    begin = np.full(width, -1)
    end = np.full(width, -1)
    for i in range(len(template)):
        at = np.arange(low, high + 1) + i
        inside = (at >= 0) & (at < len(words))
        hit = np.zeros(width, bool)
        hit[inside] = words[at[inside]] == template[i]
        # One template word further on the same diagonal, or left out from the next one up.
        skip = np.append(best[1:], -1)
        stay = np.where(hit, best + 1, best)
        from_up = skip > stay
        new_begin = np.where(hit & (begin < 0), at, begin)
        new_end = np.where(hit, at, end)
        up_begin, up_end = np.append(begin[1:], -1), np.append(end[1:], -1)
        best, begin, end = np.where(from_up, skip, stay), np.where(from_up, up_begin, new_begin), np.where(from_up, up_end, new_end)
        # Words put into the document: carry the best from lower diagonals upwards.
        top = np.maximum.accumulate(best)
        source = np.maximum.accumulate(np.where(best == top, np.arange(width), 0))
        best, begin, end = top, begin[source], end[source]
    top = int(best.argmax())
    return int(best[top]), int(begin[top]), int(end[top])


def has_run(words: np.ndarray, run: np.ndarray) -> bool:
    """Do the words of `run` stand among `words`, next to each other and in order?"""
    if len(words) < len(run):
        return False
    return bool((np.lib.stride_tricks.sliding_window_view(words, len(run)) == run).all(axis=1).any())


def best_siblings(index: Index, found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Without the reports that overlap a better covered one of a sibling template."""
    kept: list[tuple[int, int, int, int]] = []
    for report in sorted(found, key=lambda r: (-r[1] / len(index.words[r[0]]), -r[1], r[2], r[0])):
        template, _, first, last = report
        family = index.family[template]
        rivals = [r for r in kept if family is not None and index.family[r[0]] == family and r[0] != template]
        if all(last < r[2] or first > r[3] for r in rivals):
            kept.append(report)
    return sorted(kept, key=lambda r: (r[0], r[2]))


def may_reach(template: np.ndarray, words: np.ndarray, low: int, high: int, least: float) -> bool:
    """Do enough of the template's words, each taken alone, stand within the band that `align` looks at?"""
    if min(high + len(template), len(words)) - max(low, 0) < least * len(template):
        return False
    reached = 0
    for first in range(0, len(template), 256):  # so that memory is that of a strip of the band
        part = template[first : first + 256, None]
        at = np.arange(first, first + len(part))[:, None] + np.arange(low, high + 1)
        hit = (at >= 0) & (at < len(words)) & (words[np.clip(at, 0, len(words) - 1)] == part)
        reached += int(hit.any(axis=1).sum())
    return reached >= least * len(template)


def drifting(chain: list[int], length: int) -> list[tuple[int, int]]:
    """Bands over a chain of diagonals: any stretch of it half as long as the template lies within one."""
    step = max(1, length // 2)
    return [(low, min(low + 2 * step, chain[-1])) for low in range(chain[0], max(chain[-1] - step, chain[0]) + 1, step)]


def scan_words(index: Index, words: np.ndarray, band: int, least: float) -> list[tuple[int, int, int, int]]:
    """(template, matched, first word, last word) of a document's reports."""
    diagonals: dict[int, set[int]] = defaultdict(set)
    for template, diagonal in index.votes(words):
        diagonals[template].add(diagonal)
    found = []
    for template, seen in diagonals.items():
        mine = index.words[template]
        near = min(band, max(1, len(mine) // 4))  # copies of a short notice stand close to each other

        def report(words: np.ndarray, low: int, high: int) -> tuple[int, int, int] | None:
            low, high = low - near, high + near
            if not may_reach(mine, words, low, high, least):
                return None
            matched, first, last = align(mine, words, low, high)
            enough = matched >= least * len(mine) and all(has_run(words[first : last + 1], k) for k in index.keys[template])
            return (matched, first, last) if enough else None

        reports, chains = [], []
        ordered = sorted(seen)
        group, chain = [ordered[0]], [ordered[0]]
        for d in [*ordered[1:], None]:
            linked = d is not None and d - chain[-1] <= near
            if not linked or d - group[0] > 4 * near:
                reports.append(report(words, group[0], group[-1]))
                group = []
            if not linked:
                chains.append(chain)
                chain = []
            group.append(d)
            chain.append(d)
        reports = [r for r in reports if r]
        taken: list[tuple[int, int, int]] = []
        for matched, first, last in sorted(reports, key=lambda r: (-r[0], r[1])):
            if all(last < f or first > g for _, f, g in taken):
                taken.append((matched, first, last))
        # Copies whose words are put in or left out all along drift out of a narrow band.
        chains = [c for c in chains if c[-1] - c[0] > 4 * near]
        if chains:
            unlike = np.setdiff1d(np.arange(len(mine) + 1, dtype=np.uint64), mine)[0]
            left = words.copy()
            for _, first, last in taken:
                left[first : last + 1] = unlike
            for low, high in (b for c in chains for b in drifting(c, len(mine))):
                while more := report(left, low, high):
                    left[more[1] : more[2] + 1] = unlike
                    if all(more[2] < f or more[1] > g for _, f, g in taken):
                        taken.append(more)
        found.extend((template, *r) for r in sorted(taken, key=lambda r: r[1]))
    return best_siblings(index, found)


def scan(
    docs: DataFrame,
    templates: dict[str, str] = TEMPLATES,
    gram: int = GRAM,
    window: int = WINDOW,
    band: int = BAND,
    least: float = MIN_COVERAGE,
) -> DataFrame:
    """REPORTS of all templates in all documents (doc_id, text)."""
    if sum(len(t) for t in templates.values()) > MOST_TEMPLATE_BYTES:
        raise ValueError("the templates exceed what one index takes; scan in parts and take the union")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(templates, gram, window)
        for batch in batches:
            ids = batch["doc_id"].to_pylist()
            out: list[list] = [[] for _ in REPORTS.names]
            for first, group in groups(as_bytes(batch["text"])):
                words = Words(group)
                for k in range(len(group)):
                    a, b = words.first[k], words.first[k + 1]
                    for template, matched, begin, end in scan_words(index, words.hash[a:b], band, least):
                        size = len(index.words[template])
                        row = (
                            ids[first + k], index.names[template], matched / size, matched, size,
                            int(words.start[a + begin] - words.at[k]), int(words.end[a + end] - words.at[k]),
                        )
                        for column, value in zip(out, row):
                            column.append(value)
            kinds = [pa.int64(), pa.string(), pa.float64(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=REPORTS.names)

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, REPORTS)
