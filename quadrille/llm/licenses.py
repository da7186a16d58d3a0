"""Licence scans by the Dice coefficient over word bigrams (built-in functions only).

The lines, the paragraphs and the whole of a document are normalised (A-Z lower-cased, everything but a-z and 0-9 a space) and become sets of
word bigrams; a single word is its own bigram. A unit matches a template of Dice ``2 * shared / (n + m)`` at or above the
threshold ``t``. As ``shared`` is at most the smaller size, only templates with ``n * t / (2 - t) <= m <= n * (2 - t) / t`` are
compared, and only bigrams that some template has are kept of a unit. All of it happens within the row: nothing is shuffled.

A match shares at least ``m * t / (2 - t)`` bigrams of its template. So each template has a few anchor words without which
too few of its bigrams are left, and a document with none of them is done at once; others aren't affected.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.llm import common
from quadrille.llm.html_text import STOP_WORDS

THRESHOLD = 0.8
#: Bounds give way by this much, as they are products of rounded numbers; the coefficient itself decides.
SLACK = 1e-9

_AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. '
_HOLDERS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. '
    "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR "
    "PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
    "POSSIBILITY OF SUCH DAMAGE."
)
_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
)

#: Notices, headers and full texts of common licences; the texts without their copyright line. Fixed values, public texts.
TEMPLATES = {
    "0bsd-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. "
    + 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    "bsd-2-clause-text": _CONDITIONS + _HOLDERS,
    "bsd-3-clause-text": _CONDITIONS + "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. " + _HOLDERS,
    "boost-1.0-text": 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: '
    + "The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor. "
    + 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "isc-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
    + 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    "mit-text": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: '
    + "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. " + _AS_IS
    + "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "unlicense-text": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. "
    + "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. " + _AS_IS
    + "IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "zlib-text": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: "
    + "The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. This notice may not be removed or altered from any source distribution.",
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
    "apache-2.0-warranty": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "bsd-conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "mit": "Released under the MIT License.",
    "mit-permission": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
}


def bigrams(text: str) -> list[str]:
    """The distinct bigrams of a template, as :func:`_units` makes them of documents."""
    lower = "".join(c.lower() if c.isascii() and c.isalnum() else " " for c in text).split()
    return list(dict.fromkeys([" ".join(x) for x in zip(lower, lower[1:], strict=False)] or lower))


def anchors(grams: list[str], threshold: float) -> list[str]:
    """Words of a template, stop words last and else the longest first, without which fewer of its bigrams are left than a match shares."""
    need, left, found = len(grams) * threshold / (2 - threshold) - SLACK, grams, []
    for word in sorted({w for g in grams for w in g.split()}, key=lambda w: (w in STOP_WORDS, -len(w), w)):
        if len(left) < need:
            break
        rest = [g for g in left if word not in g.split()]
        if len(rest) < len(left):
            left, found = rest, [*found, word]
    return found


def _units(text: Column) -> Column:
    """The distinct lines and paragraphs of a text, and all of it, as arrays of distinct bigrams; units without words are left out."""
    plain = F.regexp_replace(common.lower_ascii(text), "[^a-z0-9\n]+", " ")
    parts = F.concat(F.split(plain, "\n"), F.split(plain, "\n *\n"), F.array(plain))
    parts = F.array_distinct(F.transform(parts, lambda x: F.trim(F.translate(x, "\n", " "))))
    words = F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.split(x, " +"))
    return F.transform(words, lambda w: F.when(F.size(w) == 1, w).otherwise(F.array_distinct(F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w)), lambda a, b: F.concat(a, F.lit(" "), b)))))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, matches (array of license and dice, one a distinct unit: its best template, the first by name on a tie), license and dice of the best match (null without one), n_matches.

    Null and empty texts match nothing, and templates without words or no templates at all match no text. Other columns are not read. ``templates`` are small (hundreds of texts): they are part of the plan.
    """
    sets = {name: bigrams(text) for name, text in sorted((TEMPLATES if templates is None else templates).items())}
    sets = {name: grams for name, grams in sets.items() if grams}
    if not sets:
        none = F.array().cast("array<struct<dice:double,license:string>>")
        return docs.select(docs[id_col].alias("doc_id"), none.alias("matches"), F.lit(None).cast("string").alias("license"), F.lit(None).cast("double").alias("dice"), F.lit(0).cast("long").alias("n_matches"))
    known = sorted({g for grams in sets.values() for g in grams})
    literal = F.array(*(F.struct(F.lit(name).alias("license"), F.array(*map(F.lit, grams)).alias("grams"), F.lit(len(grams)).alias("m")) for name, grams in sets.items()))
    t = threshold
    least, most = min(map(len, sets.values())) * t / (2 - t) - SLACK, max(map(len, sets.values())) * (2 - t) / t + SLACK
    words = sorted({w for grams in sets.values() for w in anchors(grams, t)})
    sized = F.filter(_units(F.col("text")), lambda g: (F.size(g) >= least) & (F.size(g) <= most))
    hits = F.filter(F.transform(sized, lambda g: F.struct(F.size(g).alias("n"), F.filter(g, lambda x: x.isin(known)).alias("hits"))), lambda u: F.size(u["hits"]) >= t / 2 * u["n"] - SLACK)

    def best(u: Column) -> Column:
        near = F.filter(F.col("templates"), lambda x: (x["m"] >= u["n"] * F.lit(t / (2 - t)) - SLACK) & (x["m"] <= u["n"] * F.lit((2 - t) / t) + SLACK))
        scored = F.transform(near, lambda x: F.struct((F.lit(2.0) * F.size(F.array_intersect(u["hits"], x["grams"])) / (u["n"] + x["m"])).alias("dice"), x["license"].alias("license")))
        return F.reduce(scored, F.struct(F.lit(0.0).alias("dice"), F.lit("").alias("license")), lambda a, b: F.when(b["dice"] > a["dice"], b).otherwise(a))

    rows = common.ids_and_text(docs, id_col, text_col).withColumn("lower", common.lower_ascii(F.col("text")))
    tests = [F.col("lower").contains(w) for w in words if len(w) > 3]
    if short := [w for w in words if len(w) <= 3]:
        tests.append(F.col("lower").rlike(rf"(?<![a-z0-9])(?:{'|'.join(short)})(?![a-z0-9])"))
    anchored = reduce(lambda a, b: a | b, tests)
    matches = F.filter(F.transform(hits, best), lambda x: x["dice"] >= t)
    found = rows.withColumn("templates", literal).select("doc_id", F.when(anchored, matches).otherwise(F.array().cast("array<struct<dice:double,license:string>>")).alias("matches"))
    top = F.reduce("matches", F.struct(F.lit(0.0).alias("dice"), F.lit("").alias("license")), lambda a, b: F.when((b["dice"] > a["dice"]) | (b["dice"] == a["dice"]) & (b["license"] < a["license"]), b).otherwise(a))
    some = F.size("matches") > 0
    return found.withColumn("top", top).select("doc_id", "matches", F.when(some, F.col("top.license")).alias("license"), F.when(some, F.col("top.dice")).alias("dice"), F.size("matches").cast("long").alias("n_matches"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(common.table(spark, sf_dir, "documents"))
    return found.select("doc_id", "license", "dice", "n_matches", F.array_join(F.array_sort(F.array_distinct(F.transform("matches", lambda x: x["license"]))), ",").alias("licenses"))


def _sql() -> str:
    values = ", ".join("('{}', [{}])".format(name, ", ".join(f"'{g}'" for g in bigrams(text))) for name, text in sorted(TEMPLATES.items()))
    return rf"""
WITH templates(license, grams) AS (VALUES {values}),
plain AS (
    SELECT doc_id, regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9\n]+', ' ', 'g') AS plain
    FROM documents),
parts AS (
    SELECT doc_id, unnest(list_distinct(list_transform(string_split(plain, chr(10)) || string_split_regex(plain, '\n *\n') || [plain], lambda p: trim(replace(p, chr(10), ' '))))) AS part FROM plain),
units AS (SELECT doc_id, string_split_regex(part, ' +') AS w FROM parts WHERE part <> ''),
grams AS (
    SELECT doc_id, row_number() OVER () AS unit, CASE WHEN len(w) = 1 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS g
    FROM units),
scored AS (
    SELECT doc_id, unit, license, 2.0::DOUBLE * len(list_intersect(g, grams)) / (len(g) + len(grams)) AS dice
    FROM grams JOIN templates ON len(grams) BETWEEN len(g) * {THRESHOLD / (2 - THRESHOLD)!r} - {SLACK} AND len(g) * {(2 - THRESHOLD) / THRESHOLD!r} + {SLACK}),
best AS (
    SELECT doc_id, license, dice FROM (
        SELECT *, row_number() OVER (PARTITION BY unit ORDER BY dice DESC, license) AS nth FROM scored WHERE dice >= {THRESHOLD}) WHERE nth = 1),
per_doc AS (
    SELECT doc_id, count(*) AS n_matches, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses, max(dice) AS dice FROM best GROUP BY doc_id),
top AS (SELECT b.doc_id, min(b.license) AS license FROM best b JOIN per_doc p ON b.doc_id = p.doc_id AND b.dice = p.dice GROUP BY b.doc_id)
SELECT d.doc_id, t.license, p.dice, coalesce(p.n_matches, 0) AS n_matches, coalesce(p.licenses, '') AS licenses
FROM documents d LEFT JOIN per_doc p ON d.doc_id = p.doc_id LEFT JOIN top t ON d.doc_id = t.doc_id
"""


OP6_SQL = _sql()
