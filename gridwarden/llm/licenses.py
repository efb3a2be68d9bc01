"""Licence statements and texts inside documents, by the Dice coefficient of word bigrams."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

THRESHOLD = 0.8
WORD = re.compile(r"[^\W_]+")
MARKS = re.compile(r"[^\w\s]*")  # that end a sentence or a quotation

# Common licence statements and short licences, as published.
TEMPLATES = {
    "Apache-2.0 statement": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License."
    ),
    "MIT statement": "Released under the MIT License.",
    "MIT statement, licensed": "Licensed under the MIT License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
        "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
        'IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
        "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE."
    ),
    "GPL-3.0 statement": "This work is licensed under the GNU General Public License, version 3.",
    "GPL notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details. You should have received a copy of the GNU General Public License along with this "
        "program. If not, see <https://www.gnu.org/licenses/>."
    ),
    "LGPL notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public "
        "License for more details. You should have received a copy of the GNU Lesser General Public License along with this "
        "program. If not, see <https://www.gnu.org/licenses/>."
    ),
    "AGPL notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public "
        "License for more details. You should have received a copy of the GNU Affero General Public License along with this "
        "program. If not, see <https://www.gnu.org/licenses/>."
    ),
    "CC-BY-NC-4.0 statement": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 statement": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0 statement": "Licensed under CC BY-SA 4.0.",
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        'with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY '
        "EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
        "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE "
        "FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED "
        "TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
        "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
        "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used "
        "to endorse or promote products derived from this software without specific prior written permission. "
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY '
        "EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
        "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE "
        "FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED "
        "TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
        "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
        "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "MPL-2.0 notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the "
        "author or authors of this software dedicate any and all copyright interest in the software to the public domain. "
        "We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. "
        "We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to "
        "this software under copyright law. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR "
        "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
        "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
        "OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to <https://unlicense.org/>"
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you "
        "wrote the original software. If you use this software in a product, an acknowledgment in the product documentation "
        "would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not "
        "be misrepresented as being the original software. 3. This notice may not be removed or altered from any source "
        "distribution."
    ),
}


def normalised(text: str) -> list[str]:
    """Words of letters and digits in lower case; marks and blanks only separate them."""
    return WORD.findall(text.lower())


def bigrams(words: list[str]) -> list[tuple[str, str]]:
    return list(zip(words, words[1:], strict=False)) if len(words) > 1 else [(w, "") for w in words]


@dataclass(frozen=True)
class Match:
    license: str
    dice: float
    start: int
    end: int


class Templates:
    """Templates by bigram, with the counts that a text needs to reach the threshold against each.

    A window of words with ``c`` distinct bigrams of a template of ``s`` and ``u`` others scores
    2c / (c + u + s), so it needs c of s * t / (2 - t) at least and u of 2s * (1 - t) / t at most.
    """

    def __init__(self, texts: Mapping[str, str], threshold: float):
        self.sets = {name: words for name, t in texts.items() if (words := set(bigrams(normalised(t))))}
        self.threshold = threshold
        self.holders: dict[tuple[str, str], list[str]] = {}
        for name, words in self.sets.items():
            for b in words:
                self.holders.setdefault(b, []).append(name)
        slack = 1e-9  # a size right at a bound is within it, however the quotient was rounded
        self.least = {n: len(s) * threshold / (2 - threshold) - slack for n, s in self.sets.items()}
        self.others = {n: 2 * len(s) * (1 - threshold) / threshold + slack for n, s in self.sets.items()}

    def windows(self, pairs: list[tuple[str, str]], name: str) -> list[tuple[int, float, int, int]]:
        """``common, dice, first, last`` (places of bigrams) of the best window from each place, not
        overlapping, the most alike first.

        A window that starts or ends with another bigram than the template's, or holds its first or
        last one twice, scores no more than a shorter one, so only the others are looked at.
        """
        members, least, others = self.sets[name], self.least[name], self.others[name]
        found = []
        for first in [i for i, b in enumerate(pairs) if b in members]:
            seen: set[tuple[str, str]] = set()
            common, best = 0, None
            for last in range(first, len(pairs)):
                b = pairs[last]
                if b in seen:
                    if b == pairs[first]:
                        break
                    continue
                seen.add(b)
                if b in members:
                    common += 1
                    dice = 2 * common / (len(seen) + len(members))
                    if common >= least and dice >= self.threshold - 1e-12 and (best is None or dice > best[1]):
                        best = (common, dice, first, last)
                elif len(seen) - common > others:
                    break
            if best is not None:
                found.append(best)
        return apart(sorted(found, key=lambda m: (-m[1], m[2])))

    def find(self, text: str) -> list[Match]:
        """The matches of a text, not overlapping, in order of place. Of overlapping ones that with the
        most of its template stays, so a whole text stays before a statement inside it. A match is
        widened to the whole lines it stands in where they reach the threshold too."""
        present = self.holders.keys() & set(bigrams(normalised(text)))
        held = Counter(name for b in present for name in self.holders[b])
        likely = [name for name, n in held.items() if n >= self.least[name]]
        if not likely:
            return []
        places = [(w, m.start(), m.end()) for m in WORD.finditer(text) for w in normalised(m.group())]
        pairs = bigrams([w for w, _, _ in places]) if len(places) > 1 else []
        found = [(*m, name) for name in likely for m in self.windows(pairs, name)]
        kept = apart(sorted(found, key=lambda m: (-m[0], -m[1], m[2], m[4])))
        kept.sort(key=lambda m: m[2])
        out: list[Match] = []
        lines: dict[tuple[int, int], set[tuple[str, str]]] = {}
        for i, (_, dice, first, last, name) in enumerate(kept):
            start, end = places[first][1], places[last + 1][2]
            before, after = text.rfind("\n", 0, start) + 1, text.find("\n", end)
            after = len(text) if after < 0 else after
            free = (not out or out[-1].end <= before) and (i + 1 == len(kept) or after <= places[kept[i + 1][2]][1])
            if (before, after) not in lines:
                lines[before, after] = set(bigrams(normalised(text[before:after])))
            whole = self.dice(lines[before, after], name) if free else 0.0
            if whole >= self.threshold - 1e-12:
                out.append(Match(name, whole, before, after))
            else:
                out.append(Match(name, dice, start, MARKS.match(text, end).end()))
        return out

    def dice(self, words: set[tuple[str, str]], name: str) -> float:
        return 2 * len(words & self.sets[name]) / (len(words) + len(self.sets[name]))


def apart(found: list[tuple]) -> list[tuple]:
    """Those of ``..., first, last, ...`` at places 2 and 3 that share no word with one before them."""
    kept: list[tuple] = []
    ends: list[tuple[int, int]] = []  # of those kept, in order of place
    for m in found:
        at = bisect_left(ends, (m[2], m[3]))
        if (at == 0 or ends[at - 1][1] + 1 < m[2]) and (at == len(ends) or m[3] + 1 < ends[at][0]):
            ends.insert(at, (m[2], m[3]))
            kept.append(m)
    return kept


def license_scan(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    threshold: float = THRESHOLD,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, n_matches, license, dice, matches`` for every row of ``docs``.

    Compared are all windows of words, whatever lines they stand in, against each template;
    ``matches`` has ``license, dice, start, end`` (code points) of those kept, which
    don't overlap. ``license`` and ``dice`` are the best match's (of equal ones the first), null and
    0 without one. Null and empty texts match nothing; repeated rows and null ids each give a row;
    other columns are ignored. ``templates`` is a short list that the caller passes.
    """
    ship(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    match_type = pa.struct(
        [("license", pa.string()), ("dice", pa.float64()), ("start", pa.int64()), ("end", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(templates, threshold)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                found = [known.find(t) if t else [] for t in part.column(1).to_pylist()]
                best = [max(m, key=lambda x: (x.dice, -x.start)) if m else None for m in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(m) for m in found], pa.int32()),
                        pa.array([m.license if m else None for m in best], pa.string()),
                        pa.array([m.dice if m else 0.0 for m in best], pa.float64()),
                        pa.array([[vars(x) for x in m] for m in found], pa.list_(match_type)),
                    ],
                    names=["k", "n_matches", "license", "dice", "matches"],
                )

    rows = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").cast("string").alias("t"))
    return rows.mapInArrow(
        run,
        f"k {kind}, n_matches int, license string, dice double, "
        "matches array<struct<license: string, dice: double, start: bigint, end: bigint>>",
    ).withColumnRenamed("k", "doc_id")
