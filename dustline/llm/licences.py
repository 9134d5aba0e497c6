"""Licence scans by canonical digests (operator 4), in column expressions only.

A text is brought into a canonical form (lower case, no copyright lines, one spelling of words that
licences spell differently, punctuation and blanks as single blanks), digested, and looked up in a
table of known licences by an equi-join on the digest. Entire units are compared: the whole
document, each of its paragraphs, each of its lines. Equal digests need equal canonical lengths, so
units of a length that no known licence has are not digested.

The known table is broadcast where a count proves it small (``KNOWN_ROWS``), else joined through a
shuffle; texts never move either way, only digests do.

Edge cases: null and empty texts, and texts of punctuation alone, have no digest and match nothing;
a document of one line is reported once per unit kind; a licence repeated within a document is one
row with its count ``n``; repeated documents give repeated rows only through their count, as rows
are grouped by doc_id; null ids form one group; two known licences of equal canonical text are both
reported; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dustline.llm.common import table
from dustline.llm.spans import let

KNOWN_ROWS = 100_000

#: Short notices and full texts in common use, by SPDX identifier.
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE
OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided
that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL
WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE
FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)

#: A line that only states who holds the copyright, and spellings taken as equal.
COPYRIGHT_LINE = r"(^|\n)[ \t]*(copyright|\(c\)|©)[^\n]*([0-9]{4}|rights reserved)[^\n]*"
SPELLINGS = (("licence", "license"), ("sub-license", "sublicense"), ("non-infringement", "noninfringement"), ("organisation", "organization"),
             ("&", " and "), ("version 2.0", "version 2"), ("version 3.0", "version 3"), ("v. 2.0", "version 2"))
MARKS = r"[^a-z0-9\n]+"


def canonical(text: Column) -> Column:
    """Canonical form with its line breaks kept; every line is trimmed."""
    t = F.lower(F.coalesce(text.cast("string"), F.lit("")))
    t = F.regexp_replace(t, COPYRIGHT_LINE, "$1")
    for a, b in SPELLINGS:
        t = F.replace(t, F.lit(a), F.lit(b))
    return F.regexp_replace(F.regexp_replace(t, MARKS, " "), r" ?\n ?", "\n")


def units(form: Column) -> Column:
    """array<struct<scope, unit>> of a canonical form: the document, its paragraphs and its lines, without line breaks."""
    flat = lambda x: F.trim(F.regexp_replace(x, r"\n+", " "))
    made = lambda scope, parts: F.transform(parts, lambda p: F.struct(F.lit(scope).alias("scope"), flat(p).alias("unit")))
    return F.concat(made("document", F.array(form)), made("paragraph", F.split(form, r"\n\n+")), made("line", F.split(form, r"\n")))


def known_table(spark: SparkSession, known: tuple[tuple[str, str], ...] = KNOWN) -> DataFrame:
    rows = F.array(*(F.struct(F.lit(name).alias("licence"), F.lit(text).alias("text")) for name, text in known))
    return spark.range(1).select(F.inline(rows))


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(doc_id, licence, scope, n) of the units of ``docs`` that are a known licence (licence, text)."""
    forms = known.select("licence", F.trim(F.regexp_replace(canonical(F.col("text")), r"\n+", " ")).alias("form")).where("form <> ''")
    digests = forms.select("licence", F.sha2("form", 256).alias("digest")).distinct()
    longest = forms.agg(F.max(F.char_length("form"))).first()[0] or 0
    found = docs.select("doc_id", F.explode(let(canonical(F.col("text")), lambda form: F.filter(units(form), lambda u: F.char_length(u["unit"]).between(1, longest)))).alias("u"))
    found = found.select("doc_id", F.col("u.scope").alias("scope"), F.sha2(F.col("u.unit"), 256).alias("digest"))
    small = digests.limit(KNOWN_ROWS + 1).count() <= KNOWN_ROWS
    return found.join(F.broadcast(digests) if small else digests, "digest").groupBy("doc_id", "licence", "scope").agg(F.count(F.lit(1)).alias("n"))


def op4_licences(spark, sf_dir: str) -> DataFrame:
    """Known licences among the documents, their paragraphs and their lines."""
    return scan(table(spark, sf_dir, "documents"), known_table(spark))


def _sql_form(text: str) -> str:
    t = f"regexp_replace(lower(coalesce({text}, '')), '{COPYRIGHT_LINE}', '\\1', 'g')".replace("\\n", "\\n")
    for a, b in SPELLINGS:
        t = f"replace({t}, '{a}', '{b}')"
    return f"regexp_replace(regexp_replace({t}, '{MARKS}', ' ', 'g'), ' ?\\n ?', chr(10), 'g')"


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


SQL = f"""
WITH known(licence, txt) AS (VALUES {', '.join(f'({_quoted(a)}, {_quoted(b)})' for a, b in KNOWN)}),
digests AS (SELECT DISTINCT licence, sha256(trim(regexp_replace({_sql_form('txt')}, '\\n+', ' ', 'g'))) AS digest FROM known),
forms AS (SELECT doc_id, {_sql_form('text')} AS form FROM documents),
units AS (SELECT doc_id, 'document' AS scope, form AS unit FROM forms
  UNION ALL SELECT doc_id, 'paragraph', unnest(regexp_split_to_array(form, '\\n\\n+')) FROM forms
  UNION ALL SELECT doc_id, 'line', unnest(string_split(form, chr(10))) FROM forms),
found AS (SELECT doc_id, scope, sha256(trim(regexp_replace(unit, '\\n+', ' ', 'g'))) AS digest FROM units)
SELECT doc_id, licence, scope, count(*) AS n FROM found JOIN digests USING (digest) GROUP BY ALL
"""
