"""License scan by conditional compression.

A text is cut into sentences; runs of sentences that speak of licensing are
candidate blocks.  Each block is compressed alone and with every template as
zstandard raw dictionary: what the template already says costs almost nothing,
so the size falls most under the template that the block was taken from.
Templates are ranked by this reduction, and the first whose exact wording
differences (words to insert, delete or replace, years and names aside) are
few enough is a finding.  Words that separate a template from its siblings
(templates of other licenses of about the same wording) and version numbers
must be unchanged: they decide which license it is.  Its words are taken out of the block and the rest is
tried again, so notices that follow each other are all found.

Paragraphs that several licenses share are templates of their family (GPL,
LGPL, BSD).  Next to a notice of one license they take its name; alone they
keep the family's, as they do not say more.
"""

from __future__ import annotations

import difflib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Notices as their licenses state them.  ``*`` stands for a name
# or a year.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the "
        "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied. See the License for the specific language governing permissions "
        "and limitations under the License.",
        "SPDX-License-Identifier: Apache-2.0"),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING "
        "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
        "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        "SPDX-License-Identifier: MIT"),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written "
        "permission.",
        "SPDX-License-Identifier: BSD-3-Clause"),
    "BSD-2-Clause": (
        "Licensed under the BSD 2-Clause License.",
        "SPDX-License-Identifier: BSD-2-Clause"),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This * is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version 3 "
        "of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "SPDX-License-Identifier: GPL-3.0-only"),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This * is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation; either version 2 "
        "of the License, or (at your option) any later version.",
        "This * is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License version 2 as published by the Free Software Foundation.",
        "SPDX-License-Identifier: GPL-2.0-only",
        "SPDX-License-Identifier: GPL-2.0-or-later"),
    "LGPL-3.0": (
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This * is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU Lesser General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
        "SPDX-License-Identifier: LGPL-3.0-only"),
    "LGPL-2.1": (
        "This * is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU Lesser General Public License as published by the Free Software Foundation; either "
        "version 2.1 of the License, or (at your option) any later version.",
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "SPDX-License-Identifier: LGPL-2.1-only"),
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This * is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU Affero General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Affero General Public License along with this *",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
        "SPDX-License-Identifier: AGPL-3.0-only"),
    "GPL": (
        "This * is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
        "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
        "You should have received a copy of the GNU General Public License along with this *"),
    "LGPL": (
        "You should have received a copy of the GNU Lesser General Public License along with this *",),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0"),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0"),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related or "
        "neighboring rights to this work.",
        "This work is dedicated to the public domain.",
        "SPDX-License-Identifier: CC0-1.0"),
    "all-rights-reserved": (
        "All rights reserved.",
        "Copyright * * All rights reserved."),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions "
        "and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR "
        "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
        "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
        "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
        "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
        "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
        "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
        "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
        "POSSIBILITY OF SUCH DAMAGE."),
}
# Templates that stand for a family, and its licenses.
FAMILIES = {
    "GPL": ("GPL-3.0", "GPL-2.0", "LGPL-3.0", "LGPL-2.1", "AGPL-3.0"),
    "LGPL": ("LGPL-3.0", "LGPL-2.1"),
    "BSD": ("BSD-3-Clause", "BSD-2-Clause"),
}
TWO_CLAUSES = 3             # the first templates of BSD: without a third clause they say BSD-2-Clause
NEXT_TO = 60                # characters between notices of one license text at most
CUE = (r"(?i)licen[cs]e|copyright|rights reserved|hereby granted|redistribut|warrant|public domain|"
       r"free software|permission notice|source code form|spdx|"
       r"endorse or promote|the software is provided|this software is provided")
CUES = re.compile(CUE)
SENTENCE = re.compile(r"[^.!?\n;:]*(?:[.!?;:](?!\s|$)[^.!?\n;:]*)*[.!?;:]?[^\S\n]*\n?")
WORD = re.compile(r"\*|[^\W_]+(?:[.'-][^\W_]+)*")
YEAR = re.compile(r"(?:19|20)\d\d")
VERSION = re.compile(r"v?\d+(?:\.\d+)*")
MOST_DIFFERENT = 0.2        # of the template's words
SIBLING = 0.6               # share of the words, from which templates are siblings
SPAN = 3                # longest templates to a part of a long block
PEERS = 8                   # templates whose wording is compared at a time
LEVEL = 19


class Matcher:
    """The templates as words and as compression dictionaries."""

    def __init__(self, templates: dict[str, tuple[str, ...]]):
        import zstandard
        self.names, self.words, packed = [], [], []
        for name, notices in templates.items():
            for notice in notices:
                words = [w.lower() for w in WORD.findall(notice)]
                self.names.append(name)
                self.words.append(words)
                packed.append(" ".join(words).encode())
        self.known = frozenset(w for words in self.words for w in words)
        self.must, self.foreign = zip(*map(self._deciding, range(len(self.words)))) if self.words else ((), ())

        def compressor(data: bytes | None):
            options = {"level": LEVEL, "write_content_size": False, "write_checksum": False,
                       "write_dict_id": False}
            if data is None:
                return zstandard.ZstdCompressor(**options)
            given = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            return zstandard.ZstdCompressor(dict_data=given, **options)

        self.plain = compressor(None)
        # zstandard reads dictionaries from eight bytes on; all notices are longer.
        self.given = [compressor(d) for d in packed]

    def _deciding(self, i: int) -> tuple[set[int], list[tuple[int, int, set[str]]]]:
        """Places of a template's words that must stay, and (from, to, words)
        that must not stand between two places: what makes it a sibling."""
        mine = self.words[i]
        must, foreign = {p for p, w in enumerate(mine) if VERSION.fullmatch(w)}, []
        for name, other in zip(self.names, self.words):
            if name == self.names[i] or other == mine:
                continue
            match = difflib.SequenceMatcher(None, mine, other, autojunk=False)
            if match.real_quick_ratio() < SIBLING or match.quick_ratio() < SIBLING or match.ratio() < SIBLING:
                continue
            for tag, a, b, c, d in match.get_opcodes():
                if tag != "equal":
                    must |= {p for p in range(a, b) if mine[p] != "*"}
                    foreign.append((a, b, set(other[c:d]) - {"*"}))
        return must, foreign

    def decided(self, i: int, changes: list[tuple[int, int, list[str]]]) -> bool:
        """Whether no change (from, to, words put there) of template ``i``
        concerns a word that makes it a sibling."""
        return not any(not self.must[i].isdisjoint(range(a, b))
                       or any(a <= to and at <= b and not words.isdisjoint(extra)
                              for at, to, words in self.foreign[i]) for a, b, extra in changes)

    def reductions(self, words: list[str]) -> list[tuple[float, int]]:
        """(share of the size saved, template), the largest first."""
        block = " ".join(words).encode()
        alone = len(self.plain.compress(block))
        found = [(1 - len(c.compress(block)) / alone, i) for i, c in enumerate(self.given)]
        # Of equal savings the longer template says more.
        return sorted(found, key=lambda x: (-round(x[0], 6), -len(self.words[x[1]]), x[1]))

    def differences(self, words: list[str], template: list[str]) -> tuple:
        """Words that differ between the template and the part of ``words``
        it aligns with: their number, the part, what they are, and where in
        the template (from, to, words put there)."""
        blocks = [b for b in difflib.SequenceMatcher(None, template, words, autojunk=False)
                  .get_matching_blocks() if b.size]
        if not blocks:
            return len(template), 0, 0, [], []
        # Alignments that pull in far-off single words are cut back.
        largest = max(range(len(blocks)), key=lambda i: blocks[i].size)
        lo = hi = largest
        while lo > 0 and blocks[lo].b - blocks[lo - 1].b - blocks[lo - 1].size <= 3 + blocks[lo - 1].size:
            lo -= 1
        while (hi + 1 < len(blocks)
               and blocks[hi + 1].b - blocks[hi].b - blocks[hi].size <= 3 + blocks[hi + 1].size):
            hi += 1
        start, end = blocks[lo].b, blocks[hi].b + blocks[hi].size
        count, notes, changes = 0, [], []
        a, b = 0, start
        for m in [*blocks[lo:hi + 1], difflib.Match(len(template), end, 0)]:
            missing = [w for w in template[a:m.a] if w != "*"]
            extra = [w for w in words[b:m.b] if not YEAR.fullmatch(w)]
            names = sum(w == "*" for w in template[a:m.a])
            count += max(len(missing), len(extra) - 2 * names if names else len(extra), 0)
            if missing or extra:
                changes.append((a, m.a, extra))
                notes.append("-" + " ".join(missing) + " +" + " ".join(extra))
            a, b = m.a + m.size, m.b + m.size
        return count, start, end, notes, changes

    def winner(self, words: list[str]) -> tuple | None:
        """The template of the largest reduction that the wording confirms.

        Templates that save as much, or rank just below and are of about its
        length (another version of the same notice), go before it where they
        differ in fewer words.
        """
        ranked = [(saved, i) for saved, i in self.reductions(words) if saved > 0]
        for at, (most, first) in enumerate(ranked):
            size = len(self.words[first])
            confirmed = []
            for saved, i in ranked[at:at + PEERS]:
                if abs(len(self.words[i]) - size) * 4 <= size or most - saved < 1e-6:
                    count, lo, hi, notes, changes = self.differences(words, self.words[i])
                    if (hi > lo and count <= MOST_DIFFERENT * len(self.words[i])
                            and self.decided(i, changes)):
                        confirmed.append((saved, i, count, lo, hi, notes))
            if confirmed:
                return min(confirmed, key=lambda x: x[2])
        return None

    def notices(self, text: str, tokens: list[tuple[str, int, int]]) -> list[tuple]:
        """(first token, last token + 1, template, saved, differences,
        wording) of the notices in ``tokens`` (word, start, end), in order."""
        out, pending = [], [(0, len(tokens))]
        while pending:
            a, b = pending.pop()
            if a == b or not CUES.search(text[tokens[a][1]:tokens[b - 1][2]]):
                continue
            won = self.winner([w for w, _, _ in tokens[a:b]])
            if won:
                saved, i, count, lo, hi, notes = won
                out.append((a + lo, a + hi, i, round(saved, 4), count, "; ".join(notes)))
                pending += [(a, a + lo), (a + hi, b)]
        return sorted(out)

    def find(self, text: str) -> list[tuple]:
        """(start, end, license, reduction, differences, wording) of every
        notice in a text, in order; code points, end exclusive.

        A block longer than ``SPAN`` times the longest template is gone
        through in parts of that length, so the work grows with the text: a
        notice that begins in the first half of a part lies in it whole, and
        the next part begins after these.
        """
        out = []
        reach = SPAN * max(map(len, self.words))
        for block in self.blocks(text):
            at = 0
            while at < len(block):
                part = block[at:at + reach]
                found, last = self.notices(text, part), at + reach >= len(block)
                kept = [x for x in found if last or x[0] < reach // 2]
                out += [(part[lo][1], part[hi - 1][2], *rest) for lo, hi, *rest in kept]
                at += len(part) if last else max([reach // 2, *(hi for _, hi, *_ in kept)])
        out.sort()
        return [(start, end, name, *rest) for name, (start, end, _, *rest) in zip(self.named(out), out)]

    def named(self, found: list[tuple]) -> list[str]:
        """The licenses of findings (start, end, template, ...) in order; a
        family's paragraph takes the name of a notice in the same run."""
        names = [self.names[x[2]] for x in found]
        out, at = list(names), 0
        while at < len(found):
            upto = at + 1
            while upto < len(found) and found[upto][0] - found[upto - 1][1] <= NEXT_TO:
                upto += 1
            for i in range(at, upto):
                members = FAMILIES.get(names[i], ())
                # The nearest notice before, or else after.
                told = [n for n in names[i:at:-1] + [names[at]] + names[i:upto] if n in members]
                if told:
                    out[i] = told[0]
                elif names[i] == "BSD":
                    # The number of the template among those of its name.
                    said = {x[2] - self.names.index("BSD") for x in found[at:upto] if self.names[x[2]] == "BSD"}
                    if said >= set(range(TWO_CLAUSES)):
                        out[i] = "BSD-2-Clause"
            at = upto
        return out

    def blocks(self, text: str) -> list[list[tuple[str, int, int]]]:
        """Runs of sentences of which each has a cue or is mostly made of the
        templates' words, and one has a cue."""
        out, run, cued = [], [], False
        for m in SENTENCE.finditer(text):
            sentence = m.group()
            words = [(w.group().lower(), m.start() + w.start(), m.start() + w.end())
                     for w in WORD.finditer(sentence)]
            if not words:
                continue
            cue = CUES.search(sentence) is not None
            if cue or sum(w in self.known for w, _, _ in words) >= 0.8 * len(words):
                run += words
                cued |= cue
                continue
            if cued:
                out.append(run)
            run, cued = [], False
        return [*out, run] if cued else out


FINDING = T.StructType([
    T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("license", T.StringType()), T.StructField("reduction", T.DoubleType()),
    T.StructField("differences", T.IntegerType()), T.StructField("wording", T.StringType())])


def find_licences(docs: DataFrame, templates: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """doc_id and ``found``, the notices in order (start, end, license,
    reduction, differences, wording), of every row of ``docs`` (doc_id, text;
    other columns are not read).

    Null and empty texts have none; repeated rows each give a row; a null
    doc_id stays null; an empty table gives no rows.  Texts without any cue
    word do not leave the JVM.
    """
    given = templates or TEMPLATES
    made: list[Matcher] = []

    @F.pandas_udf(T.ArrayType(FINDING))
    def found(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if not made:
            made.append(Matcher(given))
        for batch in texts:
            yield pd.Series([[dict(zip(FINDING.names, x)) for x in made[0].find(t)] if t else []
                             for t in batch], dtype=object)

    candidate = F.when(F.col("text").rlike(CUE), F.col("text"))
    return docs.select("doc_id", found(candidate).alias("found"))


def licence_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_findings, licenses and spans (comma-joined, in order of the
    text) and the evidence for them (reduction:differences:wording)."""
    def joined(*names: str):
        return F.transform("found", lambda x: F.concat_ws(":", *(x[n].cast("string") for n in names)))

    return find_licences(docs).select(
        "doc_id", F.size("found").cast("long").alias("n_findings"),
        F.array_join(joined("license"), ",").alias("licenses"),
        F.array_join(joined("license", "start", "end"), ",").alias("spans"),
        F.array_join(joined("reduction", "differences", "wording"), "|").alias("evidence"))
