"""License scans by canonical digest, with built-in functions alone.

A text becomes canonical: lower case; copyright lines dropped; equivalent spellings made one, also
across a line break; punctuation and white space between words reduced to one space. The SHA-256 of a
canonical text is joined with those of the known licence texts. Looked up are the whole text, its
paragraphs (blocks between blank lines) and its lines, each as an entire text; also runs of consecutive
paragraphs that begin with the first paragraph of a known text and have as many.

A copyright line is one that begins with a notice: the sign ©, or the word or (c) followed by the other
sign, a year or a bracketed placeholder; a sentence whose wrapped line begins with "copyright" is none.
Where a notice shares a paragraph with the licence, as in the GPL, a new wrap moves words onto the
notice's line. So a text with such lines is looked up a second time with them left in, and known texts
have both digests: a known text is recognised however its paragraphs are wrapped.

The known texts are a table given by the caller; Spark joins it by its size. Here they are ``KNOWN``
and the full texts in the folder ``license_texts``, named by licence.

Defined results. Null or empty text has nothing to look up. Every row of the input gives one row,
repeated rows too. A unit that several known texts share lists all their ids. Further columns are
not read.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wearlens.llm.store import let, own

COPYRIGHT = (
    r"(?m)^[ \t*#/;]*(?:©|copyright[ \t,:]*(?:by[ \t]+|the[ \t]+|year[ \t]+)?(?:\(c\)|©|[0-9]{4}|[\[<{])|\(c\)[ \t,]*(?:copyright|[0-9]{4}|[\[<{]))[^\n]*$"
)
GAP = r"(?: ?\n ?| )"  # between two words: a space, or one line break
SEPARATORS = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F “”‘’–—…©®™•·]+"
#: equivalent spellings: regex over words, and what they become
SPELLINGS = (
    (r"licen[cs]", "licens"),
    (r"\b(organ|recogn|author|util|modern|general)is(e|ed|es|ing|ation|ations)\b", "$1iz$2"),
    (r"\b(fav|hon|behavi|col)our", "$1or"),
    (r"\bfulfil\b", "fulfill"),
    (rf"\bnon{GAP}commercial\b", "noncommercial"),
    (rf"\bsub{GAP}licens", "sublicens"),
    (rf"\bper{GAP}cent\b", "percent"),
    (rf"\bcopyright{GAP}(holder|owner)s?\b", "copyright holder"),
    (r"\bhttps?\b", "http"),
    (rf"\bv(?:ersion|er)?{GAP}?([0-9])", "version $1"),
)

_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
    "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
    "IN THE SOFTWARE."
)
_ISC_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
    "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
    "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
    "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
#: fixed values: public licence texts and the notices that stand for them
KNOWN = (
    ("MIT", "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
            '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, '
            "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
            "conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n" + _AS_IS),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("ISC", "ISC License\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
            "above copyright notice and this permission notice appear in all copies.\n\n" + _ISC_AS_IS),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\n" + _ISC_AS_IS),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain "
                   "a copy of the License at\n\nhttp://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software "
                   "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the "
                   "License for the specific language governing permissions and limitations under the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can "
                "obtain one at https://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("reserved", "All rights reserved."),
)


def canonical(text: Column, notices: bool = False) -> Column:
    """Canonical words, one space between; line ends stay as single \\n. With ``notices`` null if there are none to leave in."""
    lower = F.lower(text)
    c = F.when(lower.rlike(COPYRIGHT), lower) if notices else F.regexp_replace(lower, COPYRIGHT, "")
    c = F.regexp_replace(c, SEPARATORS, " ")
    for pattern, to in SPELLINGS:
        c = F.regexp_replace(c, pattern, to)
    return c


def full_texts() -> list[tuple[str, str]]:
    """(license, text) of the files in ``license_texts``; <license>.<variant>.txt are further texts of one."""
    files = sorted((Path(__file__).parent / "license_texts").glob("*.txt"))
    return [(f.stem.removesuffix(".regents"), f.read_text(encoding="utf-8")) for f in files]


def known_licenses(spark: SparkSession, texts=None) -> DataFrame:
    """Rows (license, digest, first, n), distinct: ``first`` is the digest of the first of ``n`` paragraphs."""
    texts = [*KNOWN, *full_texts()] if texts is None else list(texts)
    forms = F.explode(F.array(canonical(F.col("text")), canonical(F.col("text"), notices=True))).alias("c")
    given = spark.createDataFrame(texts, "license string, text string").select("license", forms).filter("c is not null")
    parts = given.withColumn("p", _paragraphs(F.col("c")))
    return parts.select("license", F.sha2(_whole(F.col("c")), 256).alias("digest"), F.sha2(F.get("p", F.lit(0)), 256).alias("first"), F.size("p").alias("n")).distinct()


def _whole(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, "[ \n]+", " "))


def _paragraphs(c: Column) -> Column:
    return F.array_remove(F.transform(F.split(c, r"\n *\n"), _whole), "")


def _run_digests(paragraphs: Column, digests: Column, starts: list[tuple[str, int]]) -> Column:
    """Digests of the runs of ``n`` paragraphs whose first has the digest ``first``, for each of ``starts``."""
    given = F.array(*[F.struct(F.lit(first).alias("first"), F.lit(n).alias("n")) for first, n in starts])

    def at(digest: Column, i: Column) -> Column:
        begun = F.filter(given, lambda s: (s["first"] == digest) & (i + s["n"] <= F.size(paragraphs)))
        return F.transform(begun, lambda s: F.sha2(F.array_join(F.slice(paragraphs, i + 1, s["n"]), " "), 256))

    return F.flatten(F.transform(digests, at))


def _units(c: Column) -> Column:
    """The whole text, its paragraphs and its lines, each canonical, distinct and not empty."""
    lines = F.transform(F.split(c, "\n"), lambda x: F.trim(x))
    paragraphs = F.transform(F.split(c, r"\n *\n"), _whole)
    return F.array_remove(F.array_distinct(F.concat(F.array(_whole(c)), paragraphs, lines)), "")


def scan_licenses(docs: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, digest of the whole text, whole_licenses, licenses (arrays of ids, sorted)."""
    text = F.coalesce("text", F.lit(""))
    starts = [(r["first"], r["n"]) for r in known.filter("n > 1").select("first", "n").distinct().collect()]  # as many as known texts

    def runs(c: Column) -> Column:
        return let(_paragraphs(c), lambda p: let(F.transform(p, lambda x: F.sha2(x, 256)), lambda h: _run_digests(p, h, starts)))

    def digests(c: Column) -> Column:
        units = F.transform(_units(c), lambda u: F.sha2(u, 256))
        return F.struct(F.sha2(_whole(c), 256).alias("whole"), (F.array_union(units, runs(c)) if starts else units).alias("units"))

    # computed once per row, in a generator: the steps below must not repeat it for every unit
    forms = F.filter(F.array(canonical(text), canonical(text, notices=True)), lambda c: c.isNotNull())
    once = F.explode(F.array(F.transform(forms, digests))).alias("d")
    rows = own(docs, "doc_id", "text").select("doc_id", F.monotonically_increasing_id().alias("row"), once)
    wholes, every = F.col("d.whole").alias("wholes"), F.explode_outer(F.array_distinct(F.flatten("d.units"))).alias("digest")
    units = rows.select("doc_id", "row", wholes, every).withColumn("whole", F.get("wholes", F.lit(0)))
    of_whole = F.when(F.array_contains("wholes", F.col("digest")), F.col("license")).alias("of_whole")
    hit = units.join(known.select("license", "digest").distinct(), "digest", "left").select("row", "doc_id", "whole", "license", of_whole)
    ids = lambda some: F.array_sort(F.collect_set(some))
    return (
        hit.groupBy("row", "doc_id", "whole")
        .agg(ids("of_whole").alias("whole_licenses"), ids("license").alias("licenses"))
        .select("doc_id", F.col("whole").alias("digest"), "whole_licenses", "licenses")
    )
