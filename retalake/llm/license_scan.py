"""Licence texts and notices in documents, by Dice coefficient over word bigrams.

Every window of consecutive lines of a document is compared, and in the stretches
where no such window is a licence, every window of words. Of two sets of a and b
bigrams, d = 2c / (a + b) for c common ones, so a coefficient of d needs
c >= b d / (2 - d) and a <= b (2 - d) / d. A template of which a document does not
hold that many bigrams is out at once, which leaves none for most documents, and
a window is followed only until it has too many. A best window begins with a
bigram of the template that does not come again in it, so the windows that are
followed from one template's bigram do not overlap, and the work is bounded by
the words times the template's size.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterable, Iterator
from importlib import resources
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST = 0.8
WORD = re.compile(r"[a-z0-9]+(?:[.'-][a-z0-9]+)*")

BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
BSD_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this "
    "list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above "
    "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
    "materials provided with the distribution. "
)
BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. "
)
ISC_DISCLAIMER = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE."
)


def full_text(name: str) -> str:
    return resources.files("retalake.llm").joinpath("licenses", f"{name}.txt").read_text("utf-8")


def gnu_header(name: str, version: str, thing: str = "program") -> str:
    """The notice at the head of a file under one of the GNU licences, with the address on the web."""
    return (
        f"This {thing} is free software: you can redistribute it and/or modify it under the terms of the {name} as published by "
        f"the Free Software Foundation, either version {version} of the License, or (at your option) any later version. This "
        f"{thing} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty "
        f"of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details. You should have received a "
        f"copy of the {name} along with this {thing}. If not, see <https://www.gnu.org/licenses/>."
    )


def gnu_header_by_post(name: str, version: str, thing: str = "program") -> str:
    """The same with the address by post, as with the older versions."""
    head = gnu_header(name, version, thing).rsplit(" If not,", 1)[0].removesuffix(".")
    return head + (
        "; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA."
    )


def gnu_notice(name: str, version: str) -> str:
    return f"This work is licensed under the {name}, version {version}."


def creative_commons(short: str, long: str) -> tuple[str, str]:
    return (
        f"Licensed under CC {short} 4.0.",
        f"This work is licensed under a Creative Commons {long} 4.0 International License.",
    )


GPL, LGPL, LESSER, AGPL = (
    f"GNU {kind} Public License" for kind in ("General", "Library General", "Lesser General", "Affero General")
)

#: Licence templates: fixed texts of public licences, the notices at the head of files, and the usual one-line notices.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
        "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License.",
        full_text("Apache-2.0"),
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details. You should have received a copy of the GNU General Public License along with this "
        "program. If not, see <https://www.gnu.org/licenses/>.",
        full_text("GPL-3.0"),
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "ISC": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. " + ISC_DISCLAIMER,
    ),
    "BSD-3-Clause": (BSD_CONDITIONS + BSD_NAMES, BSD_CONDITIONS + BSD_NAMES + BSD_DISCLAIMER),
    "BSD-2-Clause": (BSD_CONDITIONS + BSD_DISCLAIMER,),
    "0BSD": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted. " + ISC_DISCLAIMER,
    ),
    "GPL-1.0": (gnu_header_by_post(GPL, "1"), full_text("GPL-1.0")),
    "GPL-2.0": (gnu_notice(GPL, "2"), gnu_header(GPL, "2"), gnu_header_by_post(GPL, "2"), full_text("GPL-2.0")),
    "LGPL-2.0": (gnu_header_by_post(LGPL, "2", "library"), full_text("LGPL-2.0")),
    "LGPL-2.1": (
        gnu_notice(LESSER, "2.1"),
        *[f(LESSER, "2.1", thing) for f in (gnu_header, gnu_header_by_post) for thing in ("program", "library")],
        full_text("LGPL-2.1"),
    ),
    "LGPL-3.0": (
        gnu_notice(LESSER, "3"), gnu_header(LESSER, "3"), gnu_header(LESSER, "3", "library"), full_text("LGPL-3.0"),
    ),
    "AGPL-3.0": (gnu_notice(AGPL, "3"), gnu_header(AGPL, "3"), full_text("AGPL-3.0")),
    "MPL-1.1": (full_text("MPL-1.1"),),
    "MPL-2.0": (
        "Licensed under the Mozilla Public License, Version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        full_text("MPL-2.0"),
    ),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
        "which is available at https://www.eclipse.org/legal/epl-2.0/",
    ),
    "CC0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        full_text("CC0-1.0"),
    ),
    "CC-BY-SA-4.0": creative_commons("BY-SA", "Attribution-ShareAlike"),
    "CC-BY-ND-4.0": creative_commons("BY-ND", "Attribution-NoDerivatives"),
    "CC-BY-NC-SA-4.0": creative_commons("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    "CC-BY-NC-ND-4.0": creative_commons("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means.",
    ),
}


def words(text: str) -> list[str]:
    """Normalised words: lower case, without punctuation around them."""
    return WORD.findall(text.lower())


def bigrams(found: list[str]) -> frozenset[tuple[str, str]]:
    return frozenset(zip(found, found[1:], strict=False))


class Hit(NamedTuple):
    dice: float
    template: int  # place in order of size
    begin: int  # first and last word
    end: int


class Scanner:
    def __init__(self, templates: dict[str, tuple[str, ...]], least: float) -> None:
        self.least = least
        self.templates = sorted(
            ((len(b), name, b) for name, texts in templates.items() for b in map(bigrams, map(words, texts)) if b),
            key=lambda x: x[:2],
        )
        self.place = {pair: k for k, pair in enumerate(frozenset().union(*(b for _, _, b in self.templates)))}
        self.member = np.zeros((len(self.place), len(self.templates)), bool)
        for t, (_, _, b) in enumerate(self.templates):
            self.member[[self.place[pair] for pair in b], t] = True
        sizes = np.array([n for n, _, _ in self.templates], np.float64)
        self.need = sizes * least / (2 - least) - 1e-6
        self.most = sizes * (2 - least) / least + 1e-6

    def windows(self, t: int, doc: Document, starts: np.ndarray, ends: np.ndarray, stop: int) -> Iterator[Hit]:
        """For each start that has one, the best window up to ``stop`` that ends with one of ``ends`` and reaches the limit.

        starts and ends are words. A start stands for the words up to the next start, of which one at least has to begin
        a bigram of the template.
        """
        inside = self.member[doc.known, t] & (doc.known >= 0)
        at = np.flatnonzero(inside)
        ahead = np.cumsum((inside & (doc.following >= len(inside)))[::-1])[::-1]  # distinct ones from here on
        for k, a in enumerate(starts):
            low, high = np.searchsorted(at, [a, starts[k + 1] if k + 1 < len(starts) else stop])
            if low == high or ahead[a] < self.need[t]:
                continue
            limit = min(stop, int(doc.following[at[low:high]].max()))
            length = int(2 * self.most[t]) + 16
            while True:
                fresh = doc.previous[a : min(a + length, limit)] < a
                size = np.cumsum(fresh)
                if a + length >= limit or size[-1] > self.most[t]:
                    break
                length *= 2
            common = np.cumsum(fresh & inside[a : a + len(fresh)])
            low, high = np.searchsorted(ends, [a + 1, a + len(fresh) + 1])
            last = ends[low:high]
            if not len(last):
                continue
            dice = 2 * common[last - 1 - a] / (size[last - 1 - a] + self.templates[t][0])
            best = int(dice.argmax())
            if dice[best] >= self.least:
                yield Hit(float(dice[best]), t, int(a), int(last[best]))

    def scan(self, text: str | None) -> tuple[str, float, int]:
        """(name, coefficient, number of windows): the best licence of the text, '' and 0 if none reaches the limit."""
        lines = [words(x) for x in (text or "").split("\n")]
        found = [w for line in lines for w in line]
        pairs = list(zip(found, found[1:], strict=False))
        known = np.array([self.place.get(p, -1) for p in pairs], np.int64)
        used = np.unique(known[known >= 0])
        held = self.member[used].sum(axis=0)
        possible = np.flatnonzero((held >= self.need) & (held > 0))
        if not len(possible):
            return "", 0.0, 0
        doc = Document(known, *neighbours(pairs))
        after = np.cumsum([len(x) for x in lines])  # first word behind each line
        filled = np.array([len(x) > 0 for x in lines])
        ends, starts = after[filled] - 1, (after - [len(x) for x in lines])[filled]
        hits = disjoint(h for t in possible for h in self.windows(t, doc, starts, ends, len(pairs)))
        rest: list[Hit] = []
        cuts = sorted((h.begin, h.end) for h in hits)
        for low, high in zip([0, *(e + 1 for _, e in cuts)], [*(b - 1 for b, _ in cuts), len(found) - 1], strict=True):
            for t in possible if low < high else ():  # the words low to high
                at = low + np.flatnonzero(self.member[known[low:high], t] & (known[low:high] >= 0))
                if len(np.unique(known[at])) >= self.need[t]:
                    rest += self.windows(t, doc, at, at + 1, high)
        hits += disjoint(rest)
        if not hits:
            return "", 0.0, 0
        best = max(hits, key=lambda h: (h.dice, h.template))
        return self.templates[best.template][1], best.dice, len(hits)


class Document(NamedTuple):
    known: np.ndarray  # number of each bigram among those of the templates, or -1
    previous: np.ndarray  # place of the same bigram before, or -1
    following: np.ndarray  # and after, or the number of bigrams


def neighbours(pairs: list[tuple[str, str]]) -> tuple[np.ndarray, np.ndarray]:
    previous, following = np.full(len(pairs), -1, np.int64), np.full(len(pairs), len(pairs), np.int64)
    last: dict[tuple[str, str], int] = {}
    for k, pair in enumerate(pairs):
        if pair in last:
            previous[k] = last[pair]
            following[last[pair]] = k
        last[pair] = k
    return previous, following


def disjoint(hits: Iterable[Hit]) -> list[Hit]:
    """Hits of which no two share a word, the best first, of equals the larger template."""
    taken: list[tuple[int, int]] = []
    out = []
    for h in sorted(hits, key=lambda h: (-h.dice, -h.template, h.begin)):
        k = bisect.bisect(taken, (h.begin, h.end))
        if (k and taken[k - 1][1] >= h.begin) or (k < len(taken) and taken[k][0] <= h.end):
            continue
        taken.insert(k, (h.begin, h.end))
        out.append(h)
    return out


def scanned(
    docs: DataFrame, templates: dict[str, tuple[str, ...]] | None = None, least: float = LEAST
) -> DataFrame:
    """A row per document: doc_id, license, dice, n_pieces.

    ``license`` names the template with the highest coefficient of at least
    ``least`` over all windows (the last by size and name of equals), and is ''
    with dice 0 where no window reaches it; n_pieces counts the windows that do,
    the best first and none that shares a word with a better one.
    Null, empty and one-word texts have none. Nothing is shuffled.
    """
    used = TEMPLATES if templates is None else templates

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(used, least)
        for batch in batches:
            rows = [scanner.scan(t.as_py()) for t in batch.column(1)]
            names, dice, counts = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(dice, pa.float64()), pa.array(counts, pa.int64())],
                ["doc_id", "license", "dice", "n_pieces"],
            )

    schema = "doc_id long, license string, dice double, n_pieces long"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
