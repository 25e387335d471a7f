"""License scans: normalised passages compared to licence templates by the Dice coefficient over word bigrams.

A text's passages are its lines, its paragraphs (runs of lines without an empty
one), the whole text, its sentences, and windows of words wherever a template of
WINDOW words or more may stand: over several paragraphs of a long text, or inside
a line. Sentences and windows count only where at least half of their words are
in no passage found before. Windows are looked for in texts that hold enough of
a template's bigrams, from bigram to bigram that the template has. Passage and template are normalised alike: lower case,
words of letters and digits, copyright statements (not what follows them on their
line) dropped. With A and B their bags of
word bigrams the coefficient is 2 |A and B| / (|A| + |B|). It cannot reach LEAST
unless |A| lies between LEAST / (2 - LEAST) and (2 - LEAST) / LEAST times |B|, so
only templates of that size are compared, and of these only the ones that share
bigrams enough, counted by an index from bigram to templates.

Null and empty texts have no licence. Repeated rows are scanned each. Extra
columns are ignored by `scan`.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wireglass.llm.common import small_batches

LEAST = 0.8
#: Words of the shortest template that is looked for inside sentences; shorter ones are only mentioned there.
WINDOW = 5
WORD = re.compile(r"[^\W_]+")
SENTENCE = re.compile(r"(?<=[.!?;:])\s+")
# a statement at the start of a line ends with its sentence, at a bar or dash, or where a licence begins
COPYRIGHT = re.compile(
    r"^\W*(?:copyright\b(?!\s+(?:notices?|holders?|owners?|laws?|licen[cs]es?|statements?|and|or|in|is)\b)|\(c\)|©)"
    r".*?(?:(?<![\s.][a-z])[.;](?=\s)|\s[|•·](?=\s)|\s[-–—]+(?=\s+[^\W\d])|$"
    r"|(?=\b(?:(?:all|some)\s+rights\s+reserved|(?:is\s+)?(?:licensed|released|distributed)\s+under|permission\s+is\s+hereby)\b))",
    re.I | re.M,
)

# The wording of public licences and of the notices that name them.
_WARRANTY_MIT = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_START = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. "
)
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. "
)
_BSD_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
    "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_GNU_NOTICE = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published "
    "by the Free Software Foundation, either version {version} of the License, or (at your option) any later version. This "
    "program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details. You should have received a copy "
    "of the GNU {name} along with this program. If not, see <https://www.gnu.org/licenses/>."
)
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", "MIT License"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software. " + _WARRANTY_MIT,
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License.",
    ),
    ("BSD-2-Clause", _BSD_START + _BSD_WARRANTY),
    ("BSD-3-Clause", _BSD_START + _BSD_THIRD + _BSD_WARRANTY),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        'PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
        "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details. You should have received a copy of the GNU General Public License along with this "
        "program. If not, see <https://www.gnu.org/licenses/>.",
    ),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("proprietary", "All rights reserved."),
    ("GPL-2.0-or-later", _GNU_NOTICE.format(name="General Public License", version="2")),
    ("LGPL-2.1-or-later", _GNU_NOTICE.format(name="Lesser General Public License", version="2.1")),
    ("LGPL-3.0-or-later", _GNU_NOTICE.format(name="Lesser General Public License", version="3")),
    ("AGPL-3.0-or-later", _GNU_NOTICE.format(name="Affero General Public License", version="3")),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("ISC", "Licensed under the ISC License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    (
        "CC-BY-NC-SA-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    (
        "CC-BY-NC-ND-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
        "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any "
        "purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
        "restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original "
        "software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated "
        "but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being "
        "the original software. 3. This notice may not be removed or altered from any source distribution.",
    ),
)


def normalised(text: str) -> list[str]:
    return WORD.findall(COPYRIGHT.sub(" ", text).lower())


def bigrams(words: list[str]) -> Counter:
    """Bag of word pairs; a single word counts as one item."""
    return Counter(zip(words, words[1:])) if len(words) != 1 else Counter([(words[0],)])


class Matcher:
    """Templates by size, and the index from bigram to templates."""

    def __init__(self, templates=TEMPLATES, least: float = LEAST):
        self.names = [n for n, _ in templates]
        self.bags = [bigrams(normalised(t)) for _, t in templates]
        self.sizes = [sum(b.values()) for b in self.bags]
        # a hair below, so that rounding prunes nothing
        self.least, self.share = least, least / (2 - least) - 1e-9
        self.longest = max(self.sizes) / self.share
        self.index: dict[tuple, list[tuple[int, int]]] = {}
        for k, bag in enumerate(self.bags):
            for pair, n in bag.items():
                self.index.setdefault(pair, []).append((k, n))
        self.pairs = frozenset(self.index)

    def match(self, words: list[str]) -> tuple[str, float] | None:
        """Best template of a passage, if its coefficient reaches the threshold."""
        size = max(len(words) - 1, 1)
        if not words or size > self.longest:
            return None
        shared: Counter = Counter()
        index = self.index
        for pair, n in bigrams(words).items():
            for k, m in index.get(pair, ()):
                # size bounds prune the template
                if self.share * self.sizes[k] <= size <= self.sizes[k] / self.share:
                    shared[k] += min(n, m)
        best = max(((2 * n / (size + self.sizes[k]), -k) for k, n in shared.items()), default=(0.0, 0))
        return (self.names[-best[1]], best[0]) if best[0] >= self.least - 1e-12 else None

    def scan(self, text: str | None) -> list[tuple[str, float]]:
        """(licence, coefficient) of every matching passage of a text."""
        found = []
        lines = (text or "").split("\n")
        rows = [normalised(line) for line in lines]
        # the words of a row start at its place in the text; passages found are marked there
        starts = [0, *accumulate(map(len, rows))]
        taken = bytearray(starts[-1])

        def take(hit: tuple[str, float], start: int, end: int) -> None:
            found.append(hit)
            taken[start:end] = b"\1" * (end - start)

        for row, words in enumerate(rows):
            if words and (hit := self.match(words)):
                take(hit, starts[row], starts[row + 1])
        # paragraphs of several lines; the whole text if it has several paragraphs
        paragraphs, first = [], None
        for row, line in enumerate([*lines, ""]):
            if line.strip():
                first = row if first is None else first
            elif first is not None:
                paragraphs.append((first, row))
                first = None
        for first, end in paragraphs:
            if end - first > 1 and (hit := self.match(self._joined(rows[first:end]))):
                take(hit, starts[first], starts[end])
        if len(paragraphs) > 1 and (hit := self.match(self._joined(rows))):
            take(hit, 0, starts[-1])

        def free(start: int, end: int) -> bool:
            return 2 * taken.count(1, start, end) <= end - start

        words = [w for r in rows for w in r]
        pairs = list(zip(words, words[1:]))
        likely = self._likely(pairs)
        if not likely:
            return found
        for first, end in paragraphs:
            parts = SENTENCE.split(COPYRIGHT.sub(" ", "\n".join(lines[first:end])).strip())
            at = starts[first]
            for part in parts if len(parts) > 1 else ():
                sentence = WORD.findall(part.lower())
                if sentence and free(at, at + len(sentence)) and (hit := self.match(sentence)):
                    take(hit, at, at + len(sentence))
                at += len(sentence)
        windows = [w for k in likely if self.sizes[k] + 1 >= WINDOW for w in self._windows(k, pairs)]
        for dice, k, start, end in sorted(windows, key=lambda w: (-w[0], w[1], w[2])):
            if free(start, end):
                take((self.names[k], dice), start, end)
        return found

    def _likely(self, pairs: list[tuple]) -> list[int]:
        """Templates of which a text holds enough bigrams for any passage of it to match."""
        bound: Counter = Counter()
        for pair in set(pairs) & self.pairs:
            for k, n in self.index[pair]:
                bound[k] += n
        return sorted(k for k, n in bound.items() if n >= self.share * self.sizes[k])

    def _windows(self, k: int, pairs: list[tuple]) -> list[tuple[float, int, int, int]]:
        """(coefficient, template, first word, end) of the best windows of words for a template, none over another."""
        bag, size = self.bags[k], self.sizes[k]
        hits = [i for i, pair in enumerate(pairs) if pair in bag]
        best: list[tuple[float, int, int]] = []
        # as long as the template, and as much longer as a passage can be
        for longest in (size, int(size * 1.25), int(size / self.share)):
            inside: Counter = Counter()
            shared = left = 0
            peaks: list[tuple[float, int, int]] = []
            for right, at in enumerate(hits):
                inside[pairs[at]] += 1
                shared += inside[pairs[at]] <= bag[pairs[at]]
                while hits[left] <= at - longest:
                    old = pairs[hits[left]]
                    shared -= inside[old] <= bag[old]
                    inside[old] -= 1
                    left += 1
                dice = 2 * shared / (at - hits[left] + 1 + size)
                # a little less may still win when its ends are cut
                if dice < self.least / 1.5:
                    continue
                if not peaks or left > peaks[-1][2]:
                    peaks.append((dice, left, right))
                elif dice > peaks[-1][0]:
                    peaks[-1] = (dice, left, right)
            best += [self._cut(bag, size, pairs, hits, left, right) for _, left, right in peaks]
        return [(d, k, hits[a], hits[b] + 2) for d, a, b in best if d >= self.least - 1e-12]

    @staticmethod
    def _cut(bag: Counter, size: int, pairs: list[tuple], hits: list[int], left: int, right: int) -> tuple[float, int, int]:
        """The best coefficient of a window when hits at its start, then at its end, are left out."""
        inside: Counter = Counter()
        shared, best = 0, (0.0, left, right)
        for a in range(right, left - 1, -1):
            inside[pairs[hits[a]]] += 1
            shared += inside[pairs[hits[a]]] <= bag[pairs[hits[a]]]
            best = max(best, (2 * shared / (hits[right] - hits[a] + 1 + size), a, right))
        left, inside, shared = best[1], Counter(), 0
        for b in range(left, right + 1):
            inside[pairs[hits[b]]] += 1
            shared += inside[pairs[hits[b]]] <= bag[pairs[hits[b]]]
            best = max(best, (2 * shared / (hits[b] - hits[left] + 1 + size), left, b))
        return best

    def _joined(self, rows: list[list[str]]) -> list[str]:
        # a passage far too long is not put together
        return [w for r in rows for w in r] if sum(map(len, rows)) - 1 <= self.longest else []


def scan(docs: DataFrame, templates=TEMPLATES, least: float = LEAST) -> DataFrame:
    """Per row: doc_id, license (of the best passage, or null), dice (0 without), n_passages, licenses (sorted)."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("struct<license:string,dice:double,n_passages:long,licenses:array<string>>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(templates, least)
        for texts in batches:
            rows = []
            for text in texts:
                found = matcher.scan(text)
                best = max(found, key=lambda f: (f[1], f[0]), default=(None, 0.0))
                rows.append((best[0], best[1], len(found), sorted({f[0] for f in found})))
            yield pd.DataFrame(rows, columns=["license", "dice", "n_passages", "licenses"])

    return docs.select("doc_id", of("text").alias("found")).select("doc_id", "found.*")
