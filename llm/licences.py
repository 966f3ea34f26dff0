"""Licence scans: canonical digests, hash-joined with those of known licences.

A text is normalised: lower case, copyright and "all rights reserved" lines removed,
equivalent spellings made one, everything but letters and digits a space.  The digest of
the whole result is looked up among the digests of known licence texts and notices,
normalised the same way.  Documents are looked up as a whole, by paragraph and by line,
so that a notice inside a document is found under its own digest.  Whole licence texts
are also looked up as passages: from the start of a line, as long as the known text is,
where that is not the whole document.

Only built-in functions run: one pass over the text, an explode that never shuffles the
text, and a broadcast join with the table of known digests, whose size is fixed here.
A row of the result is one licence of one document in one scope, with the number of
units that matched.  Null and empty texts match nothing.  Rows with a null id are left
out.  Rows that repeat an id add up.  Other columns are ignored.
"""

from __future__ import annotations

import re
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import table

#: Lines without meaning for a licence's identity: a copyright line has a sign, a year, a placeholder or a "by" next.
COPYRIGHT = r"(?m)^[ \t#*/;]*(?:(?:portions )?copyright:?[ \t]*(?:\(c\)|©|[0-9]{4}|[<\[{]|by\b)|(?:\(c\)|©)[ \t]*(?:copyright|[0-9]{4}|[<\[{])|all rights reserved)[^\n]*$"
#: Spellings that count as one, after lower-casing.
EQUIVALENTS = [
    (r"licen[cs](e|ed|es|ing|ee|or)\b", "licens", True),
    (r"organis", "organiz", False),
    (r"sub[- ]licens", "sublicens", False),
    (r"non[- ]commercial", "noncommercial", False),
    (r"favour", "favor", False),
    (r"fulfilment", "fulfillment", False),
    (r"https?://(?:www\.)?", "", False),
]
NAMES = {
    "MIT": ["MIT License", "MIT"],
    "ISC": ["ISC License"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License", "Modified BSD License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache Software License, Version 2.0"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPL version 2", "GPLv2"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL version 3", "GPLv3"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "LGPLv2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "LGPLv3"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "AGPLv3"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0"],
    "EPL-2.0": ["Eclipse Public License, version 2.0", "Eclipse Public License 2.0"],
    "Unlicense": ["Unlicense"],
    "Zlib": ["zlib License"],
    "BSL-1.0": ["Boost Software License, Version 1.0", "Boost Software License 1.0"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal"],
} | {
    f"CC-{kind}-{v}": [f"CC {kind} {v}", f"Creative Commons {long} {v}", f"Creative Commons {long} {v} International License", f"Creative Commons {long} {v} International"]
    for v in ("3.0", "4.0")
    for kind, long in [
        ("BY", "Attribution"),
        ("BY-SA", "Attribution-ShareAlike"),
        ("BY-NC", "Attribution-NonCommercial"),
        ("BY-ND", "Attribution-NoDerivatives"),
        ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
        ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
    ]
}
VERBS = ["Licensed", "Released", "Distributed", "Published", "Available", "Made available", "Provided"]
SUBJECTS = ["", "This work is ", "This document is ", "This text is ", "This file is ", "This project is ", "This software is ", "This program is ", "This code is ", "Content is "]
FORMS = ["{subject}{verb} under the {name}", "{subject}{verb} under {name}", "{subject}{verb} under the terms of the {name}"]
TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
}

FILES = Path(__file__).with_name("licence_texts")
#: Whole texts in files, with where their terms begin, and end if something follows them that is often left out.
TERMS = {
    "0BSD": ("Permission to use", None),
    "BSD-2-Clause": ("Redistribution and use", None),
    "BSD-3-Clause": ("Redistribution and use", None),
    "Apache-2.0": ("TERMS AND CONDITIONS FOR USE", "END OF TERMS AND CONDITIONS"),
    "GPL-2.0": ("Preamble", "END OF TERMS AND CONDITIONS"),
    "GPL-3.0": ("Preamble", "END OF TERMS AND CONDITIONS"),
    "LGPL-2.1": ("Preamble", "END OF TERMS AND CONDITIONS"),
    "LGPL-3.0": ("This version of the GNU Lesser", None),
    "MPL-2.0": ("1. Definitions", None),
    "EPL-2.0": ("THE ACCOMPANYING PROGRAM", None),
    "Unlicense": ("This is free and unencumbered", "OTHER DEALINGS IN THE SOFTWARE."),
    "BSL-1.0": ("Permission is hereby granted", None),
    "CC0-1.0": ("Statement of Purpose", None),
    "CC-BY-SA-4.0": ("By exercising the Licensed Rights", "=" * 71),
}
#: Words at the start of a line by which places are chosen where a whole text is compared.
HEAD = 4


def _spelt(text: str) -> set[str]:
    """A text as it is wrapped and with each paragraph on a line, its items numbered or not, and its usual variants."""
    out = {text, re.sub(r"(?<=\S)[ \t]*\n[ \t]*(?=\S)", " ", text)}
    if text.startswith("Redistribution and use"):
        out |= {re.sub(r"(?m)^(\s*)\d\. ", r"\1", t) for t in out}
        out |= {re.sub(r"HOLDER(\s+)OR(\s+)CONTRIBUTORS", r"OWNER\1OR\2CONTRIBUTORS", t) for t in out}
    return out


def passages() -> list[tuple[str, str]]:
    """(licence, text) of the terms of every whole text, without title and appendix."""
    rows = [(licence, t) for licence, text in TEXTS.items() for t in _spelt(text)]
    for licence, (begin, end) in TERMS.items():
        text = (FILES / f"{licence}.txt").read_text()
        text = text[text.index(begin) :]
        rows += [(licence, t) for t in _spelt(text[: text.rindex(end) + len(end)] if end else text)]
    return rows


def bare() -> list[tuple[str, str]]:
    """(licence, text) of every whole text with what follows its terms, alone and as its file has it."""
    rows = []
    for licence, (begin, _) in TERMS.items():
        text = (FILES / f"{licence}.txt").read_text()
        rows += [(licence, t) for part in (text[text.index(begin) :], text) for t in _spelt(part)]
    return rows


def whole() -> list[tuple[str, str]]:
    """(licence, text) of every whole text: the terms, and all that follows, alone and under its titles."""
    rows = passages() + bare()
    titles = {licence: [f"{the}{n}{short}" for n in NAMES[licence] for the in ("", "The ") for short in ("", f" ({licence})")] for licence in dict(rows)}
    return rows + [(licence, f"{title}\n\n{text}") for licence, text in rows for title in titles[licence]]


def known() -> list[tuple[str, str]]:
    """(licence, text) of every known text and notice; a few thousand, however large the corpus."""
    rows = whole()
    for licence, names in NAMES.items():
        rows.append((licence, f"SPDX-License-Identifier: {licence}"))
        rows += [(licence, form.format(subject=s, verb=v if not s else v.lower(), name=n)) for n in names for s in SUBJECTS for v in VERBS for form in FORMS]
    return rows


def normalised(text: Column) -> Column:
    """Canonical form; lines stay apart."""
    x = F.regexp_replace(F.lower(text), COPYRIGHT, "")
    x = reduce(lambda y, e: F.regexp_replace(y, e[0], e[1] + "$1" if e[2] else e[1]), EQUIVALENTS, x)
    x = F.regexp_replace(x, r"[^\p{L}\p{N}\n]+", " ")
    return F.regexp_replace(F.regexp_replace(x, " ?\n ?", "\n"), r"^[ \n]+|[ \n]+$", "")


def flat(unit: Column) -> Column:
    return F.trim(F.regexp_replace(unit, "[ \n]+", " "))


def digest(unit: Column) -> Column:
    return F.sha2(flat(unit), 256)


def digests(spark: SparkSession) -> DataFrame:
    """(licence, digest), one row for each known digest."""
    rows = spark.createDataFrame(known(), "license_id string, text string")
    return rows.groupBy(digest(normalised(F.col("text"))).alias("digest")).agg(F.min("license_id").alias("license_id"))


def terms(spark: SparkSession, text: Column) -> Column:
    """Array of the known whole texts that stand in a normalised text from the start of a line, each as often as it does.

    The text is cut before lines that begin like a known text, so a known text begins where
    a piece does.  Most end in it; one that does not goes on in the next pieces only as long
    as these agree with it, so the work grows with the text, however often it begins anew.
    """
    found = spark.createDataFrame(passages(), "license_id string, text string").select(flat(normalised(F.col("text"))).alias("text")).distinct().collect()
    texts = sorted(r.text for r in found)
    heads = sorted({"[ \n]".join(t.split(" ")[:HEAD]) for t in texts})
    known_texts = F.array(*[F.lit(t + " ") for t in texts])
    lines = F.concat(F.regexp_replace(text, "\n+", "\n"), F.lit("\n"))
    cut = F.transform(F.split(lines, rf"(?<![^\n])(?=(?:{'|'.join(heads)})[ \n])"), lambda c: F.translate(c, "\n", " "))

    def inside(bound: Column) -> Column:
        pieces, total = bound["pieces"], bound["total"]

        def held(piece: Column, i: Column) -> Column:
            def holds(t: Column) -> Column:
                two = F.concat(piece, F.coalesce(F.get(pieces, i + 1), F.lit("")))
                more = F.reduce(F.slice(pieces, i + 3, F.length(t)), two, lambda so_far, p: F.when(F.startswith(t, so_far), F.concat(so_far, p)).otherwise(so_far))
                begins = F.startswith(piece, t) | F.when(F.startswith(t, piece), F.startswith(two, t) | F.when(F.startswith(t, two), F.startswith(more, t)).otherwise(False)).otherwise(False)
                # A text that is all of the document is no passage of it.
                return begins & ((i > 0) | (total > F.length(t)))

            return F.filter(known_texts, holds)

        return F.transform(F.flatten(F.transform(pieces, held)), F.rtrim)

    # Bound by lambdas, so that the text is cut and measured once.
    measured = F.transform(F.array(cut), lambda p: F.struct(p.alias("pieces"), F.length(F.array_join(p, "")).alias("total")))
    return F.transform(measured, inside)[0]


def scan(docs: DataFrame, licences: DataFrame | None = None) -> DataFrame:
    """(doc_id, license_id, scope, n_units); licences: (license_id, digest), the known ones by default."""
    # The known ones are a few thousand; a table of someone else's may be large.
    licences = F.broadcast(digests(docs.sparkSession)) if licences is None else licences
    texts = docs.filter("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), normalised(F.col("text").cast("string")).alias("text"))
    one = lambda scope: lambda u: F.struct(F.lit(scope).alias("scope"), u.alias("unit"))
    units = F.concat(
        F.array(one("document")(F.col("text"))),
        F.transform(F.split("text", "\n\n+"), one("paragraph")),
        F.transform(F.split("text", "\n+"), one("line")),
        F.transform(terms(docs.sparkSession, F.col("text")), one("passage")),
    )
    rows = texts.select("doc_id", F.explode(units).alias("u")).select("doc_id", "u.scope", digest(F.col("u.unit")).alias("digest"))
    found = rows.join(licences, "digest")
    return found.groupBy("doc_id", "license_id", "scope").agg(F.count("*").alias("n_units"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def oracle() -> str:
    text = lambda s: "'" + s.replace("'", "''") + "'"
    norm = f"regexp_replace(lower(text), {text(COPYRIGHT)}, '', 'g')"
    for pattern, other, group in EQUIVALENTS:
        norm = f"regexp_replace({norm}, {text(pattern)}, {text(other + (chr(92) + '1' if group else ''))}, 'g')"
    norm = f"regexp_replace({norm}, '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g')"
    norm = f"regexp_replace(regexp_replace({norm}, ' ?\\n ?', chr(10), 'g'), '^[ \\n]+|[ \\n]+$', '', 'g')"
    flat_ = lambda x: f"trim(regexp_replace({x}, '[ \\n]+', ' ', 'g'))"
    values = lambda rows: "VALUES " + ", ".join("(" + ", ".join(map(text, r)) + ")" for r in rows)
    forms = [f.replace("{subject}", "' || s || '").replace("{verb}", "' || CASE WHEN s = '' THEN v ELSE lower(v) END || '").replace("{name}", "' || n || '") for f in FORMS]
    made = " UNION ALL ".join(f"SELECT id, '{f}' AS text FROM names, subjects, verbs" for f in forms)
    # Titles are put before the texts here as whole() does.
    return f"""
WITH names(id, n) AS ({values([(i, n) for i, ns in NAMES.items() for n in ns])}),
subjects(s) AS ({values([(s,) for s in SUBJECTS])}),
verbs(v) AS ({values([(v,) for v in VERBS])}),
terms(id, text) AS ({values(dict.fromkeys(passages()))}),
bare(id, text) AS (SELECT * FROM terms UNION ALL {values(dict.fromkeys(bare()))}),
titles AS (SELECT id, p || n || q AS title FROM names, (VALUES (''), ('The ')) a(p), (SELECT id AS i, q FROM (SELECT DISTINCT id FROM names), LATERAL (VALUES (''), (' (' || id || ')')) b(q)) WHERE i = id),
known AS (SELECT id, text FROM bare UNION ALL SELECT id, title || chr(10) || chr(10) || text FROM bare JOIN titles USING (id)
  UNION ALL SELECT DISTINCT id, 'SPDX-License-Identifier: ' || id FROM names UNION ALL {made}),
licences AS (SELECT sha256({flat_('text')}) AS digest, min(id) AS license_id FROM (SELECT id, {norm} AS text FROM known) GROUP BY 1),
texts AS (SELECT doc_id, {norm} AS text FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
passages AS (SELECT DISTINCT {flat_('text')} AS p FROM (SELECT {norm} AS text FROM terms)),
near AS (SELECT doc_id, regexp_split_to_array(text, '\\n+') AS l, p FROM texts JOIN passages ON contains({flat_('text')}, p)),
starts AS (SELECT doc_id, p, i, array_to_string(l[i:], ' ') AS rest FROM (SELECT *, unnest(range(1, len(l) + 1)) AS i FROM near)),
units AS (
  SELECT doc_id, 'document' AS scope, {flat_('text')} AS unit FROM texts
  UNION ALL SELECT doc_id, 'paragraph', {flat_('unit')} FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '\\n\\n+')) AS unit FROM texts)
  UNION ALL SELECT doc_id, 'line', {flat_('unit')} FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '\\n+')) AS unit FROM texts)
  UNION ALL SELECT doc_id, 'passage', p FROM starts WHERE starts_with(rest, p) AND substr(rest, length(p) + 1, 1) IN ('', ' ') AND (i > 1 OR length(rest) > length(p)))
SELECT doc_id, license_id, scope, count(*) AS n_units
FROM (SELECT doc_id, scope, sha256(unit) AS digest FROM units) JOIN licences USING (digest)
GROUP BY ALL"""
