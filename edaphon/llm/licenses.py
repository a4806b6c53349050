"""Licence scans by canonical digest lookup.

A text is brought to a canonical form: lower case, copyright lines removed, equivalent spellings made
one, everything but letters and digits squeezed to single spaces. The SHA-256 of the whole canonical
text is joined to the digests of known licences, treated alike. Units are whole documents and whole
lines (notices usually stand on a line of their own); nothing matches on a part of a unit.

The scan turns texts into digests, so only digests meet the join; the known side is one row per
licence text and Spark decides how to join it by its size. Which texts are known stands in ``KNOWN`` and, for
entire licences, in ``entire_licenses``; a licence with other words put in (a holder's name inside
its clauses) is another text and is not found.

Defined cases: NULL and empty texts, and units that are empty in canonical form, match nothing; rows
with one id are one document; a known text listed under several names gives all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edaphon.llm.base import sha256_hex
from edaphon.llm.entire_licenses import entire_texts

# Spellings that mean the same, as they stand in canonical text.
EQUIVALENT = (
    ("licence", "license"),
    ("licenced", "licensed"),
    ("licences", "licenses"),
    ("sub license", "sublicense"),
    ("non commercial", "noncommercial"),
    ("copyright owner", "copyright holder"),
    ("copyright owners", "copyright holders"),
    ("https", "http"),
    ("acknowledgement", "acknowledgment"),
    ("favour", "favor"),
    ("organisation", "organization"),
    ("per cent", "percent"),
    ("whilst", "while"),
    ("wilful", "willful"),
    ("merchantibility", "merchantability"),
    ("version 2 0", "version 2"),
    ("version 3 0", "version 3"),
    ("v 2 0", "version 2"),
    ("v2 0", "version 2"),
    ("v2", "version 2"),
    ("v3", "version 3"),
)
MARKS = "[^\\p{L}\\p{N}]+"
COPYRIGHT_LINE = "(?m)^[^a-z0-9\\n]*(?:copyright (?:\\(c\\)|©|[0-9])|\\(c\\)|©|all rights reserved)[^\\n]*$"

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
# Licence texts and notices, by identifier.
KNOWN = (
    ("MIT", _MIT),
    ("MIT", "MIT License\n" + _MIT),
    ("MIT", "The MIT License\n" + _MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("ISC", _ISC),
    ("ISC", "ISC License\n" + _ISC),
    ("ISC", "Licensed under the ISC License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "This work is licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("proprietary", "All content is proprietary and confidential."),
    ("MIT", "The MIT License (MIT)\n" + _MIT),
    ("MIT", "MIT\n" + _MIT),
    ("MIT", "The MIT License (Expat)\n" + _MIT),
    ("ISC", "The ISC License\n" + _ISC),
    ("ISC", "ISC License (ISC)\n" + _ISC),
    *entire_texts(),
)


def canonical(text: Column) -> Column:
    """The form in which texts are compared: words between two spaces each, so that neighbours can
    both be replaced."""
    bare = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "")
    form = F.regexp_replace(F.concat(F.lit(" "), bare, F.lit(" ")), MARKS, "  ")
    for spelling, common in EQUIVALENT:
        form = F.replace(form, F.lit(_apart(spelling)), F.lit(_apart(common)))
    return F.trim(form)


def _apart(words: str) -> str:
    return " " + words.replace(" ", "  ") + " "


def canonical_sql(text: str) -> str:
    """``canonical`` in DuckDB's SQL."""
    form = f"regexp_replace(lower({text}), '{COPYRIGHT_LINE}', '', 'g')"
    form = f"regexp_replace(' ' || {form} || ' ', '{MARKS}', '  ', 'g')"
    for spelling, common in EQUIVALENT:
        form = f"replace({form}, '{_apart(spelling)}', '{_apart(common)}')"
    return f"trim({form}, ' ')"


def scan_sql(texts=KNOWN) -> str:
    """``scan_licenses`` over ``documents`` in DuckDB's SQL."""
    known = ", ".join(f"('{name}', '{text.replace(chr(39), chr(39) * 2)}')" for name, text in texts)
    return f"""
with known as (select distinct license, sha256({canonical_sql('t')}) digest from (values {known}) k(license, t)),
units as (
  select doc_id, -1 line, coalesce(text, '') unit from documents
  union all
  select doc_id, unnest(range(len(s))) line, unnest(s) unit
  from (select doc_id, string_split(coalesce(text, ''), chr(10)) s from documents)
),
hits as (
  select doc_id, line, license from (select doc_id, line, {canonical_sql('unit')} form from units) u
  join known on form <> '' and sha256(form) = digest
),
found as (
  select doc_id,
    coalesce(string_agg(distinct license, ',' order by license) filter (line < 0), '') whole_license,
    count(distinct line) filter (line >= 0) n_notices,
    string_agg(distinct license, ',' order by license) licenses
  from hits group by doc_id
)
select d.doc_id, coalesce(whole_license, '') whole_license, coalesce(n_notices, 0) n_notices, coalesce(licenses, '') licenses
from documents d left join found f on d.doc_id is not distinct from f.doc_id"""


def digest(text: Column) -> Column:
    """NULL where nothing is left of the text."""
    form = canonical(text)
    return F.when(form != "", sha256_hex(form))


def known_licenses(spark: SparkSession, texts=KNOWN) -> DataFrame:
    """Digests of the known texts; pass other (identifier, text) pairs for a longer list."""
    rows = spark.createDataFrame(list(texts), "license string, text string")
    return rows.select(digest(F.col("text")).alias("digest"), "license").distinct()


def scan_licenses(docs: DataFrame, known: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``whole_license`` (identifiers that the entire text is), ``n_notices`` (lines that
    are a known text) and ``licenses`` (all identifiers, sorted, joined by commas)."""
    body = F.coalesce(F.col(text), F.lit(""))
    digests = docs.select(
        F.col(id).alias("doc_id"),
        F.struct(digest(body).alias("digest"), F.lit(-1).alias("line")).alias("whole"),
        F.transform(F.split(body, "\n"), lambda line, i: F.struct(digest(line).alias("digest"), i.alias("line"))).alias("lines"),
    )
    units = digests.select("doc_id", F.explode(F.concat(F.array("whole"), "lines")).alias("unit")).select(
        "doc_id", "unit.digest", "unit.line"
    )
    names = known.groupBy("digest").agg(F.sort_array(F.collect_set("license")).alias("names"))
    hits = units.filter("digest is not null").join(names, "digest")
    found = hits.groupBy("doc_id").agg(
        F.array_join(F.sort_array(F.array_distinct(F.flatten(F.collect_set(F.when(F.col("line") < 0, F.col("names")))))), ",").alias("whole_license"),
        F.sum((F.col("line") >= 0).cast("long")).alias("n_notices"),
        F.array_join(F.sort_array(F.array_distinct(F.flatten(F.collect_set("names")))), ",").alias("licenses"),
    )
    found = found.withColumnRenamed("doc_id", "_id")
    return (
        docs.select(F.col(id).alias("doc_id"))
        .join(found, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
        .select(
            "doc_id",
            F.coalesce("whole_license", F.lit("")).alias("whole_license"),
            F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices"),
            F.coalesce("licenses", F.lit("")).alias("licenses"),
        )
    )
