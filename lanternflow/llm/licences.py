"""Licence scans: normalised text against templates by Dice coefficient over word bigrams.

A text's segments are its lines, its paragraphs (parted by blank lines, of more than one
line) and the text as a whole.  A segment is normalised to lower-case words, and its set of
word bigrams is compared with a template's: Dice is twice the shared ones over the sum of
both sizes.  A score of t or more needs sizes within a factor of (2 - t) / t, so templates
out of these bounds are never compared.  The best template of a segment counts, if it
reaches ``threshold``.  Templates are short notices, and whole licences (``licence_texts``).

What lies between segments that match is searched further, whatever its lines and
paragraphs: windows of each template's own number of words that start at one of its
bigrams (shorter at the end) are compared in the same way.  A window is a segment if it
overlaps none that is better; of equals the last name, the longest and the first come first.
Whole licences of more than ``LONG`` words have no windows: they are found as a text or as a
paragraph, and elsewhere by their notices.

A match shares so many bigrams with its template that it can't lack all of a few words
(``anchors``); texts and segments without any of them are left out before all else.  For
whole licences the same words are asked for: a text that has none of them (license,
software, copyright and the like) is no copy of one.

All of it is DataFrame operations; the templates are one constant of the plan, sent once.
Texts with an anchor are staged, and dealt out in turn before they are searched for windows.
Segments and windows are scored in the row that holds them.  Windows that match in one text are compared with those kept there,
so a text of thousands of notices within lines takes longer than in proportion.

Cases: null and empty texts and segments of fewer than two words match nothing; very long
texts are split whole; ties between templates go to the last name; null doc_ids are kept;
rows that repeat a doc_id are reported together; an empty table gives an empty result;
extra columns are dropped.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import lru_cache
from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanternflow.llm._shared import read_table, staged

THRESHOLD, LONG = 0.8, 500
#: Texts that one task searches for windows: these are few and small, and each takes long for its bytes.
WINDOW_ROWS = 4096
#: Anchors are words of these only where a template has too few others.
COMMON = frozenset("a above all also an and any are as at be but by can conditions following for free from further if in including is it may must no not of on or other out permitted possible project provided public purpose related rights shall source special specific such terms that the their they this to under use used version warranty whether which with without work you your 0 1 2 3 4".split())
#: Notices and headers of public licences.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("BSD-2-Clause", "Use of this source code is governed by a BSD 2-Clause License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.'),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.'),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
#: Further families, and whole texts of which TEMPLATES holds a part.
FAMILIES = (
    ("BSD-2-Clause", 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'),
    ("BSD-3-Clause", 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    ("ISC", 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("Unlicense", 'This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to https://unlicense.org'),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
)


def _whole_licences() -> tuple[tuple[str, str], ...]:
    """The texts of licence_texts, named by their files."""
    folder = files("lanternflow.llm") / "licence_texts"
    return tuple((f.name.removesuffix(".txt"), f.read_text("utf-8")) for f in sorted(folder.iterdir(), key=lambda f: f.name) if f.name.endswith(".txt"))


ALL_TEMPLATES = (*TEMPLATES, *FAMILIES, *_whole_licences())


def normalised(text: Column) -> Column:
    """Lower-case words with one space between; line ends stay."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}\n]+", " ")


def bigrams(segment: Column) -> Column:
    """Distinct hashes of neighbouring words of a normalised segment."""
    w = F.split(F.trim(segment), r"[ \n]+")
    return F.array_distinct(F.transform(F.arrays_zip(w.alias("a"), F.slice(w, F.lit(2), F.greatest(F.size(w) - 1, F.lit(0))).alias("b")), lambda p: F.when(p["b"].isNotNull(), F.xxhash64(p["a"], p["b"]))))


def least_shared(m: int, threshold: float) -> int:
    """Bigrams that a match shares with a template of m, at least."""
    return math.ceil(threshold * (m + math.ceil(m * threshold / (2 - threshold) - 1e-9)) / 2 - 1e-9)


def _words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


@lru_cache(maxsize=8)
def anchors(templates=ALL_TEMPLATES, threshold: float = THRESHOLD) -> tuple[str, ...]:
    """Words of which each match of a short template has one: fewer of its bigrams are without than a match can lack."""
    words = [w for _, text in templates if len(w := _words(text)) <= LONG]
    needs = [(p, len(p) - least_shared(len(p), threshold) + 1) for p in ({*zip(w, w[1:])} for w in words) if p]

    def lacking(chosen: list[str]) -> list[tuple[list[tuple[str, str]], int]]:
        """For templates that need more words: pairs without any, and how many must still get one."""
        free = [([x for x in p if not {*x} & {*chosen}], len(p) - n) for p, n in needs]
        return [(p, len(p) - may) for p, may in free if len(p) > may]

    chosen: list[str] = []
    while open_ := lacking(chosen):
        gain = Counter()
        for pairs, lack in open_:
            gain.update({w: min(n, lack) for w, n in Counter(w for p in pairs for w in {*p}).items()})
        chosen.append(max(gain, key=lambda w: (w not in COMMON, gain[w], w)))
    for word in sorted(chosen, key=lambda w: (w not in COMMON, len(w), w)):
        if not lacking(rest := [w for w in chosen if w != word]):
            chosen = rest
    return tuple(chosen)


def anchored(text: Column, words: tuple[str, ...]) -> Column:
    """Whether a lower-case text has one of the words."""
    return F.arrays_overlap(F.split(text, r"[^\p{L}\p{N}]+"), F.array(*map(F.lit, words)))


def split_by_length(templates) -> tuple[tuple, tuple]:
    """Templates with windows, and whole licences without."""
    return tuple(t for t in templates if len(_words(t[1])) <= LONG), tuple(t for t in templates if len(_words(t[1])) > LONG)


@lru_cache(maxsize=8)
def _hashes(templates: tuple) -> tuple[str, ...]:
    """The bigrams of each template, once, as text: a constant that the optimiser folds, where a lambda would run for each row."""
    lists = F.array(*[F.array_join(F.array_compact(bigrams(F.lit(" ".join(_words(text))))).cast("array<string>"), ",") for _, text in templates])
    return tuple(SparkSession.active().range(1).select(lists.alias("x")).first()["x"])


def known(templates, threshold: float = THRESHOLD) -> Column:
    """The templates as one constant: name, words, m (bigrams), least (shared ones of a match), s (bigrams)."""
    templates = tuple(t for t in templates if len(_words(t[1])) > 1)
    rows = [(name, len(_words(text)), h.count(",") + 1, h) for (name, text), h in zip(templates, _hashes(templates))]
    return F.array(*[F.struct(F.lit(name).alias("name"), F.lit(n).alias("words"), F.lit(m).alias("m"), F.lit(least_shared(m, threshold)).alias("least"), F.split(F.lit(h), ",").cast("array<bigint>").alias("s")) for name, n, m, h in rows])


def best_match(s: Column, templates, threshold: float = THRESHOLD) -> Column:
    """struct(score, name) of the best template for a set of bigrams, among those of a size that can match."""
    ratio = (2 - threshold) / threshold
    near = F.filter(known(templates, threshold), lambda t: (F.size(s) >= t["m"] / ratio - 1e-9) & (F.size(s) <= t["m"] * ratio + 1e-9))
    return F.array_max(F.transform(near, lambda t: F.struct((F.lit(2.0) * F.size(F.array_intersect(t["s"], s)) / (t["m"] + F.size(s))).alias("score"), t["name"].alias("name"))))


def best_of_all(s: Column, templates, threshold: float = THRESHOLD) -> Column:
    """The same, with whole licences for sets that are large enough."""
    short, long = split_by_length(templates)
    if not long:
        return best_match(s, short, threshold)
    least = min(len({*zip(w := _words(text), w[1:])}) for _, text in long) * threshold / (2 - threshold)
    return F.array_max(F.array(best_match(s, short, threshold), F.when(F.size(s) >= least - 1e-9, best_match(s, long, threshold))))


BREAK, MARK = r"\n ?\n", "\x01"  # no normalised text has the mark


def sets_of(segment: Column) -> Column:
    return F.array_compact(bigrams(segment))


def held(docs: DataFrame, templates=ALL_TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, x (normalised text), whole (best match of a text of several paragraphs, if any): texts with an anchor."""
    text = docs.select("doc_id", "text").where(anchored(F.lower("text"), anchors(templates, threshold)))
    text = staged(text.select("doc_id", normalised(F.col("text")).alias("x")), "anchored-texts")
    sets = text.select("doc_id", "x", F.when(F.col("x").rlike(BREAK), sets_of(F.col("x"))).alias("s"))
    best = sets.select("doc_id", "x", best_of_all(F.col("s"), templates, threshold).alias("whole"))
    return staged(best.select("doc_id", "x", F.when(F.col("whole.score") >= threshold - 1e-9, F.col("whole")).alias("whole")), "whole-texts")


def segments(text: DataFrame) -> DataFrame:
    """doc_id, segment: lines, and paragraphs of more than one line."""
    paragraphs = F.filter(F.split(F.col("x"), BREAK), lambda p: p.contains("\n"))
    return text.select("doc_id", F.explode(F.concat(F.split(F.col("x"), "\n"), paragraphs)).alias("segment"))


def windows(text: DataFrame, templates=ALL_TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, best (score, name): windows in what no line, paragraph or whole text that matches holds."""
    words, floor, short = anchors(templates, threshold), threshold - 1e-9, split_by_length(templates)[0]
    all_ = known(short, threshold)
    text = text.where("whole is null")
    # by rows, not by the scan's bytes; dealt in turn, so that copies of one text are spread
    text = text.repartition(max(4 * text.sparkSession.sparkContext.defaultParallelism, -(-text.count() // WINDOW_ROWS)))

    def dice(t: Column, s: Column) -> Column:
        return F.lit(2.0) * F.size(F.array_intersect(t["s"], s)) / (t["m"] + F.size(F.array_distinct(s)))

    def hit(segment: Column) -> Column:
        return anchored(segment, words) & F.exists(F.array(sets_of(segment)), lambda s: F.coalesce(best_match(s, short, threshold)["score"] >= floor, F.lit(False)))

    def without_lines(paragraph: Column) -> Column:
        return F.array_join(F.transform(F.split(paragraph, "\n"), lambda x: F.when(hit(x), MARK).otherwise(x)), "\n")

    rest = F.array_join(F.transform(F.split("x", BREAK), lambda p: F.when(p.contains("\n") & hit(p), MARK).otherwise(without_lines(p))), "\n")
    stretch = text.select("doc_id", F.explode(F.split(rest, MARK)).alias("x")).where(anchored(F.col("x"), words))
    w = F.split(F.trim(F.regexp_replace("x", r"[ \n]+", " ")), " ")
    pairs = stretch.select("doc_id", w.alias("w")).where(F.size("w") > 1).select("doc_id", F.zip_with(F.slice("w", F.lit(1), F.size("w") - 1), F.slice("w", F.lit(2), F.size("w") - 1), lambda a, b: F.xxhash64(a, b)).alias("h"))
    near = pairs.withColumn("near", F.array_intersect("h", F.array_distinct(F.flatten(F.transform(all_, lambda t: t["s"])))))
    near = near.select("doc_id", "h", F.filter(all_, lambda t: F.size(F.array_intersect(t["s"], F.col("near"))) >= t["least"]).alias("may")).where(F.size("may") > 0)

    def of(t: Column) -> Column:
        at = F.array_compact(F.transform("h", lambda x, k: F.when(F.array_contains(t["s"], x), k + 1)))
        scored = F.transform(at, lambda k: F.struct(dice(t, F.slice("h", k, t["words"] - 1)).alias("score"), t["name"].alias("name"), t["words"].alias("words"), (-k).alias("at")))
        return F.filter(scored, lambda c: c["score"] >= floor)

    found = near.select("doc_id", F.sort_array(F.flatten(F.transform("may", of)), False).alias("c")).where(F.size("c") > 0)
    apart = lambda c, k: (-c["at"] >= -k["at"] + k["words"]) | (-k["at"] >= -c["at"] + c["words"])
    kept = F.aggregate("c", F.slice("c", 1, 0), lambda kept, c: F.when(F.forall(kept, lambda k: apart(c, k)), F.concat(kept, F.array(c))).otherwise(kept))
    return found.select("doc_id", F.explode(kept).alias("k")).select("doc_id", F.struct(F.col("k.score").alias("score"), F.col("k.name").alias("name")).alias("best"))


def scan(docs: DataFrame, templates=ALL_TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, license_id, score (best Dice of its segments), segments (how many match)."""
    least = min(math.ceil(m * threshold / (2 - threshold) - 1e-9) for _, text in templates if (m := len({*zip(w := _words(text), w[1:])})))
    text = held(docs, templates, threshold)
    # n bigrams take n spaces or line ends
    seen = segments(text).where(anchored(F.col("segment"), anchors(templates, threshold))).where(F.length("segment") - F.length(F.translate("segment", " \n", "")) >= least)
    best = seen.select("doc_id", sets_of(F.col("segment")).alias("s")).select("doc_id", best_of_all(F.col("s"), templates, threshold).alias("best")).where(F.col("best.score") >= threshold - 1e-9)
    best = best.union(text.where("whole is not null").select("doc_id", F.col("whole").alias("best"))).union(windows(text, templates, threshold))
    return best.groupBy("doc_id", F.col("best.name").alias("license_id")).agg(F.max("best.score").alias("score"), F.count(F.lit(1)).alias("segments"))


def op10_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read_table(spark, sf_dir, "documents"))


def _sql() -> str:
    values = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in ALL_TEMPLATES)
    return rf"""
with t0(name, text) as (values {values}
), norm as (
  select doc_id, null as name, regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}\n]+', ' ', 'g') as x from documents
), seg as (
  select doc_id, unnest(string_split(x, chr(10))) as s from norm
  union all
  select doc_id, s from (select doc_id, unnest(regexp_split_to_array(x, '\n ?\n')) as s from norm) where contains(s, chr(10))
  union all
  select doc_id, x from norm where regexp_matches(x, '\n ?\n')
), words as (
  select doc_id, null as name, list_filter(regexp_split_to_array(s, '[ \n]+'), lambda w: w <> '') as w from seg
  union all
  select null, name, list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '') from t0
), sets as (
  select doc_id, name, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as s from words where len(w) > 1
), a as (select row_number() over () as k, doc_id, s, len(s) as n from sets where name is null),
b as (select name, s, len(s) as m from sets where name is not null),
p as (
  select a.k, a.doc_id, b.name, 2.0 * len(list_intersect(a.s, b.s)) / (n + m) as score
  from a join b on n >= m * {THRESHOLD / (2 - THRESHOLD)} - 1e-9 and n <= m * {(2 - THRESHOLD) / THRESHOLD} + 1e-9
), best as (
  select k, any_value(doc_id) as doc_id, max(row(score, name)) as r from p group by k
)
select doc_id, r[2] as license_id, cast(max(r[1]) as double) as score, count(*) as segments from best where r[1] >= {THRESHOLD - 1e-9} group by 1, 2
"""


QUERIES = {"op10_licence_scan": op10_licence_scan}
SQL = {"op10_licence_scan": _sql()}
