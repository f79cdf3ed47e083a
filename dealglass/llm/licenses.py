"""Licence scan: canonical digests of whole texts, joined to known licences.

A text is brought to a canonical form: ASCII lower case, copyright lines gone,
punctuation and runs of white space as one space, and one spelling for spellings
that count as equal (licence and license, organisation and organization, favour
and favor, a pair of words written together or apart). The SHA-256 of that form
is looked up among the digests of known licences by a hash join. Looked up are
the whole text, each paragraph and each line, so a notice at the end of a
document is found as well as a file that is nothing but its licence.

The known licences are a fixed table (or the caller's, whose size is checked before
it is broadcast): notices and short texts in this module and the whole texts in
``published/``, a file per SPDX id. A whole text is known with and without its title,
and without what follows its terms. A licence inside a document is known by its
paragraphs: of short texts by the one that grants, of long ones by each of at least
``PARAGRAPH_WORDS`` words that no other known licence has, how-to-apply notices left
out. Texts that differ by a word, such as another postal address, are others. Units are distinct per document, and
hits are few, so hot texts do not gather anywhere.

A null text has a null digest and no licence; a text whose canonical form is
empty has the digest of the empty text and no licence. Documents are known by
(id, hash of the text), so repeated rows each get their row; null ids are
ordinary values. Other columns are ignored. Empty tables give an empty result.
"""

from __future__ import annotations

import re
from collections import defaultdict
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealglass.llm.common import lower_ascii

MAX_BROADCAST_LICENSES = 100_000  # digests and ids: about 15 MB

_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, '
    "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
    "PURPOSE AND NONINFRINGEMENT."
)
_ISC_END = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO '
    "THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT "
    "SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR "
    "ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
    "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE "
    "OR PERFORMANCE OF THIS SOFTWARE."
)
# Licence texts and notices as published, by SPDX id.
SHORT = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not '
     "use this file except in compliance with the License. You may obtain a copy of the License "
     "at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
     "to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
     "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
     "for the specific language governing permissions and limitations under the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     'software and associated documentation files (the "Software"), to deal in the Software '
     "without restriction, including without limitation the rights to use, copy, modify, merge, "
     "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
     "to whom the Software is furnished to do so, subject to the following conditions: The above "
     "copyright notice and this permission notice shall be included in all copies or substantial "
     "portions of the Software. " + _AS_IS + " IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS "
     "BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT "
     "OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
     "DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with "
     "or without fee is hereby granted, provided that the above copyright notice and this "
     "permission notice appear in all copies. " + _ISC_END),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose "
     "with or without fee is hereby granted. " + _ISC_END),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no "
     "event will the authors be held liable for any damages arising from the use of this "
     "software. Permission is granted to anyone to use this software for any purpose, including "
     "commercial applications, and to alter it and redistribute it freely, subject to the "
     "following restrictions: 1. The origin of this software must not be misrepresented; you "
     "must not claim that you wrote the original software. If you use this software in a "
     "product, an acknowledgment in the product documentation would be appreciated but is not "
     "required. 2. Altered source versions must be plainly marked as such, and must not be "
     "misrepresented as being the original software. 3. This notice may not be removed or "
     "altered from any source distribution."),
)
# Title lines of short texts, and how the paragraph that grants begins
# and ends. That of BSD texts is the same with two and three clauses; the third tells.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "BSD Zero Clause License (0BSD)"),
    "Zlib": ("zlib License", "The zlib License", "zlib License (Zlib)"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "The 2-Clause BSD License",
                     'BSD 2-Clause "Simplified" License', "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "The 3-Clause BSD License",
                     'BSD 3-Clause "New" or "Revised" License', "New BSD License",
                     "Modified BSD License"),
}
GRANTS = {
    "MIT": ("Permission is hereby", "following conditions:"),
    "ISC": ("Permission to use", "in all copies."),
    "0BSD": ("Permission to use", "hereby granted."),
    "Zlib": ("Permission is granted", "following restrictions:"),
    "Apache-2.0": ("Licensed under", "copy of the License at"),
    "BSD-3-Clause": ("3. Neither the name", "written permission."),
}
RESERVED = "All rights reserved."
END_OF_TERMS = re.compile(r"^[ \t]*END OF TERMS AND CONDITIONS[ \t]*$", re.M)
PARAGRAPH_WORDS = 20
PUBLISHED = Path(__file__).parent / "published"
# A line is a copyright line if it starts like this.
COPYRIGHT = r"^[\x20\x09\x0B-\x0D/*#;]*(copyright|\(c\)|©)"
PUNCTUATION = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F©“”‘’–—…]+"  # keeps line breaks
# Spelling rules on the canonical words, alike on both sides of the lookup.
SPELLINGS = (
    ("licenc", "licens"),
    (r"is(e|ed|es|ing|ation|ations)( |\n|$)", "iz$1$2"),
    (r"our(s|ed|able)?( |\n|$)", "or$1$2"),
    (r"(^| |\n)(sub|non) (licen|infring|commercial)", "$1$2$3"),
    (r"(^| |\n)https( |\n|$)", "$1http$2"),
    ("acknowledgement", "acknowledgment"),
)


def _paragraphs(text: str) -> list[str]:
    kept = "\n".join(x for x in text.split("\n") if not re.match(COPYRIGHT, x.lower()))
    return [x for x in re.split(r"\n[ \t\f\r]*\n", kept) if x.strip()]


def _whole_texts(license_id: str, text: str) -> list[str]:
    """The text as it is, and with and without titles, rights line and appendix.

    BSD texts also with bullets for numbers, and with "owner" for "holder".
    """
    if license_id in TITLES:
        bodies = [" ".join(" ".join(_paragraphs(text)).split())]
        if license_id.startswith("BSD-"):
            bodies.append(re.sub(r" \d\. ", " * ", bodies[0]))
            bodies += [x.replace("COPYRIGHT HOLDER OR", "COPYRIGHT OWNER OR") for x in bodies]
        heads = ("", *TITLES[license_id])
        return [f"{head}\n{mark}\n{body}" for head in heads for mark in ("", RESERVED)
                for body in bodies]
    out = [text]
    if end := END_OF_TERMS.search(text):
        out += [text[:end.start()], text[:end.end()]]
    return out + ["\n\n".join(_paragraphs(x)[1:]) for x in out]


def _known() -> tuple[tuple[str, str], ...]:
    """All (id, text): notices, whole texts and the paragraphs that tell a licence."""
    files = [(f.stem, f.read_text("utf-8")) for f in sorted(PUBLISHED.glob("*.txt"))]
    out = list(SHORT)
    for license_id, text in (*SHORT, *files):
        if license_id in GRANTS and (found := re.search(
                "{}.*?{}".format(*map(re.escape, GRANTS[license_id])), text, re.S)):
            out.append((license_id, found[0]))
            if license_id in TITLES and (license_id, text) in SHORT:
                out += [(license_id, x) for x in _whole_texts(license_id, text)]
    owners: dict[str, set[str]] = defaultdict(set)
    parts = []
    for license_id, text in files:
        out += [(license_id, x) for x in _whole_texts(license_id, text)]
        end = END_OF_TERMS.search(text)
        for part in _paragraphs(text):
            form = " ".join(re.sub(PUNCTUATION, " ", part.lower()).split())
            owners[form].add(license_id)
            if len(form.split()) >= PARAGRAPH_WORDS and license_id not in TITLES and (
                    end is None or text.find(part) < end.start()):
                parts.append((license_id, part, form))
    out += [(license_id, part) for license_id, part, form in parts if len(owners[form]) == 1]
    return tuple(dict.fromkeys(out))


KNOWN = _known()


def canonical_lines(text: Column) -> Column:
    """Array of canonical lines; empty ones mark breaks. Copyright lines are gone."""
    lines = F.split(lower_ascii(text), "\n", -1)
    kept = F.filter(lines, lambda x: ~x.rlike(COPYRIGHT))
    joined = F.regexp_replace(F.array_join(kept, "\n"), PUNCTUATION, " ")
    for found, put in SPELLINGS:
        joined = F.regexp_replace(joined, found, put)
    return F.transform(F.split(joined, "\n", -1), lambda x: F.trim(x))


def whole(lines: Column) -> Column:
    return F.array_join(F.filter(lines, lambda x: x != ""), " ")


def units(lines: Column) -> Column:
    """Distinct whole text, paragraphs and lines, without empty ones."""
    text = F.array_join(F.transform(lines, lambda x: F.when(x == "", "\n").otherwise(x)), " ")
    paragraphs = F.transform(F.split(text, "\n", -1), lambda x: F.trim(x))
    every = F.concat(F.array(whole(lines)), paragraphs, lines)
    return F.filter(F.array_distinct(every), lambda x: x != "")


def known_digests(spark: SparkSession, known: DataFrame | None = None) -> DataFrame:
    """(digest, license_id), one row per canonical text: the first id by name."""
    if known is None:
        known = spark.createDataFrame(list(KNOWN), "license_id string, text string")
    form = whole(canonical_lines(F.col("text")))
    forms = known.select("license_id", form.alias("form")).filter("form <> ''")
    return forms.groupBy(F.sha2("form", 256).alias("digest")).agg(
        F.min("license_id").alias("license_id"))


def scan(
    docs: DataFrame, known: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document.

    ``text_digest`` of the whole canonical text, ``text_license`` if that is a
    known licence, and ``licenses`` (sorted) found as whole text, paragraph or line.
    """
    digests = known_digests(docs.sparkSession, known)
    if known is None or digests.limit(MAX_BROADCAST_LICENSES + 1).count() <= MAX_BROADCAST_LICENSES:
        digests = F.broadcast(digests)
    col = F.col(f"`{text}`")
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.xxhash64(F.coalesce(col, F.lit(""))).alias("text_hash"),
        canonical_lines(col).alias("__lines"),
    )
    each = rows.select("doc_id", "text_hash", F.explode(units(F.col("__lines"))).alias("unit"))
    hits = each.select("doc_id", "text_hash", F.sha2("unit", 256).alias("digest")).join(
        digests, "digest")
    hits = hits.groupBy(
        F.col("doc_id").alias("h_id"), F.col("text_hash").alias("h_hash")).agg(
        F.array_sort(F.collect_set("license_id")).alias("licenses"))
    whole_text = rows.select(
        "doc_id", "text_hash", F.sha2(whole(F.col("__lines")), 256).alias("digest"))
    found = whole_text.join(digests, "digest", "left").join(
        hits, F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("text_hash") == F.col("h_hash")),
        "left")
    none = F.array().cast("array<string>")
    return found.select(
        "doc_id",
        F.col("digest").alias("text_digest"),
        F.col("license_id").alias("text_license"),
        F.coalesce("licenses", none).alias("licenses"),
    )
