"""License scans: normalised text against licence templates by Dice coefficient over word bigrams.

A document is scanned in units: every line, every paragraph (what lines without
words part), and the whole text. A unit and a template are bags of word bigrams a and
b; they match when 2 |a n b| / (|a| + |b|) reaches the threshold. As |a n b| is at
most the smaller size, only templates with

    t / (2 - t) <= |b| / |a| <= (2 - t) / t

can match; sizes follow from word counts, so most units are dismissed before
any bigram is made, and of a very long unit only its words are counted. Texts
stay in their partition: one pass, no shuffle, and the templates, a fixed list,
travel with the code.

A licence that no unit matches is looked for in passages, wherever they start:
runs of words of the template's size up to the bound above, across lines and
blank lines, and runs of whole lines down to the bound below. Within a line a
passage is not shorter than the template, as a cut would take off what tells
notices apart ("Apache License, Version 1.1"). Only where enough template bigrams
lie close together is anything compared.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from itertools import pairwise

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybayes.llm._util import fresh, prepare

THRESHOLD = 0.8

# --- fixed values: licence texts and notices -----------------------------------
TEMPLATES = (
    ("all-rights-reserved", "All rights reserved."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("mit", "Released under the MIT License."),
    (
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ),
    (
        "gpl-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details. You should have received a copy of the GNU General Public "
        "License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    ),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF "
        "USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF "
        "OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software. Permission is granted to anyone to use "
        "this software for any purpose, including commercial applications, and to alter it and redistribute it "
        "freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; "
        "you must not claim that you wrote the original software. If you use this software in a product, an "
        "acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source "
        "versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. "
        "This notice may not be removed or altered from any source distribution.",
    ),
)
# ---------------------------------------------------------------------------------

_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_MARKS = re.compile(r"[\x00-/:-`{-\x7f]+")


def normalise(text: str) -> list[str]:
    """Words: A-Z lowered, every ASCII character but letters and digits a separator."""
    return _MARKS.sub(" ", text.translate(_UPPER)).split(" ")


def _lines(text: str | None) -> list[list[str]]:
    """The words of each line; none of a null or empty text."""
    return [[w for w in normalise(line) if w] for line in text.split("\n")] if text else []


def bigrams(words: list[str]) -> Counter:
    return Counter(zip(words, words[1:], strict=False))


class Scanner:
    """The templates by size, and what any of them could share with a unit."""

    def __init__(self, templates=TEMPLATES, threshold: float = THRESHOLD):
        if not 0 < threshold <= 1:
            raise ValueError("the threshold is a Dice coefficient above 0")
        made = [(name, bigrams([w for w in normalise(t) if w])) for name, t in templates]
        self.templates = sorted(((b.total(), n, b) for n, b in made if b), key=lambda x: x[:2])
        self.sizes = [s for s, _, _ in self.templates]
        self.known = set().union(*(b for _, _, b in self.templates)) if self.templates else set()
        self.threshold = threshold
        self.most = max(self.sizes, default=0) * (2 - threshold) / threshold
        self.places: dict[tuple[str, str], list[int]] = {}  # of a bigram: the templates that have it
        for i, (_, _, b) in enumerate(self.templates):
            for p in b:
                self.places.setdefault(p, []).append(i)

    def unit(self, words: list[str]) -> list[tuple[float, str]]:
        """(Dice, licence) of the templates that a unit matches."""
        size, t = len(words) - 1, self.threshold
        low, high = bisect_left(self.sizes, size * t / (2 - t) - 1e-9), bisect_right(self.sizes, size * (2 - t) / t + 1e-9)
        if size < 1 or low >= high:
            return []
        # a match shares half the threshold times both sizes at least
        if 2 * sum(p in self.known for p in zip(words, words[1:], strict=False)) < t * (size + self.sizes[low]):
            return []
        bag, out = bigrams(words), []
        for other, name, b in self.templates[low:high]:
            dice = 2 * sum(min(n, b[p]) for p, n in bag.items() if p in b) / (size + other)
            if dice >= t:
                out.append((dice, name))
        return out

    def scan(self, text: str | None) -> list[tuple[float, str]]:
        """Matches of all units of a text."""
        return self._units(_lines(text))

    def both(self, text: str | None) -> list[tuple[float, str]]:
        """Matches of all units of a text, and of its passages for licences that no unit matches."""
        lines = _lines(text)
        found = self._units(lines)
        return found + self._passages(lines, {name for _, name in found})

    def _units(self, lines: list[list[str]]) -> list[tuple[float, str]]:
        found = [m for words in lines for m in self.unit(words)]
        runs, now = [], []
        for words in [*lines, []]:
            if words:
                now.append(words)
            elif now:
                runs.append(now)
                now = []
        # longer than any match: not even put together
        for run in [*runs, lines] if len(runs) > 1 else runs:
            if len(run) > 1 and sum(map(len, run)) - 1 <= self.most:
                found += self.unit([w for words in run for w in words])
        return found


    def passages(self, text: str | None) -> list[tuple[float, str]]:
        """(Dice, licence) of the templates that a passage matches, the best passage of each."""
        return self._passages(_lines(text), set())

    def _passages(self, lines: list[list[str]], skip: set[str]) -> list[tuple[float, str]]:
        words, spans = [], []
        for line in filter(None, lines):
            spans.append((len(words), len(words) + len(line)))
            words += line
        hits: dict[int, list[int]] = {}
        for at, p in enumerate(pairwise(words)):
            if p in self.places:
                for i in self.places[p]:
                    hits.setdefault(i, []).append(at)
        out = []
        for i, where in sorted(hits.items()):
            size, name, bag = self.templates[i]
            if name not in skip and (dice := self._passage(words, where, spans, size, bag)) >= self.threshold:
                out.append((dice, name))
        return out

    def _passage(self, words: list[str], where: list[int], spans: list, size: int, bag: Counter) -> float:
        """The best Dice of a template's passages (0 if none matches); ``where``: its bigrams in the text, in order."""
        t, best = self.threshold, 0.0
        low, high = math.ceil(size * t / (2 - t) - 1e-9), math.floor(size * (2 - t) / t + 1e-9)
        # a match of any size has so many template bigrams
        if not any(b - a < high for a, b in zip(where, where[low - 1 :], strict=False)):
            return best
        # the best one of the template's size or more starts at a template bigram, or ends with the text
        if len(words) > size:
            for k, a in enumerate(where):
                if k + low > len(where) or where[k + low - 1] - a >= high:
                    continue
                seen: dict = {}
                shared = 0
                for at in where[k : bisect_left(where, a + high)]:
                    p = words[at], words[at + 1]
                    seen[p] = seen.get(p, 0) + 1
                    if seen[p] <= bag[p]:
                        shared += 1
                        best = max(best, 2 * shared / (size + max(size, at - a + 1)))
                if best == 1:
                    return best
        # runs of lines below that size
        ends = [end for _, end in spans]
        for start, _ in spans:
            k = bisect_left(where, start)
            if k + low > len(where) or where[k + low - 1] - start >= size:
                continue
            for end in ends[bisect_left(ends, start + low + 1) : bisect_left(ends, start + size + 1)]:
                own = where[k : bisect_left(where, end - 1)]
                if 2 * len(own) >= t * (size + end - start - 1):
                    shared = (Counter((words[at], words[at + 1]) for at in own) & bag).total()
                    best = max(best, 2 * shared / (size + end - start - 1))
        return best if best >= t else 0.0


def matches(text: Column, templates=TEMPLATES, threshold: float = THRESHOLD) -> Column:
    """Struct (licenses, best_dice) of each whole text: sorted distinct names, null if none; the highest coefficient."""

    @F.pandas_udf("licenses array<string>, best_dice double")
    def run(texts: pd.Series) -> pd.DataFrame:
        scanner = Scanner(templates, threshold)
        found = [scanner.both(t) for t in texts]
        return pd.DataFrame(
            {
                "licenses": pd.Series([sorted({n for _, n in f}) or None for f in found], dtype=object),
                "best_dice": pd.Series([max(f)[0] if f else None for f in found], dtype="float64"),
            }
        )

    return run(text)


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, licenses, best_dice), a row for each row of ``docs``.

    ``licenses`` is an array of names, null where nothing matches; null and
    empty texts match nothing. ``best_dice`` is over units, and over passages for
    licences that no unit matches. Several templates may carry one name. Repeated
    rows each get their row; an empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    (m,) = fresh(docs, "license_match")
    rows = docs.select("doc_id", matches(F.col("text"), templates, threshold).alias(m))
    return rows.select("doc_id", F.col(f"{m}.licenses").alias("licenses"), F.col(f"{m}.best_dice").alias("best_dice"))
