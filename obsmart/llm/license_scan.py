"""Licences of files: declared in their headers or texts, or inherited from a directory.

Each line, each paragraph (lines up to one without letters and digits) and each
whole file is compared with licence templates, names in usual phrases, header
paragraphs and full texts, by the cosine of sparse TF-IDF vectors. Document
frequencies of all terms are counted over the whole table. A unit that holds
all the words that name a template's licence and reaches ``LEAST`` declares it;
of a file's units the one with most terms counts. A file half of whose terms
or more are in declaring units is a licence file: it licenses its directory, and every
file below without a declaration of its own inherits from the nearest
ancestor directory that a licence file licenses.

Only DataFrame functions are used. A template needs one of a few words, and
only units with one of them are taken out of their rows, so what is shuffled
is small; frequencies are added up in each task before they are shuffled.
Inheritance joins directories, not files, on the paths of their ancestors.

Cases: a null or empty text declares nothing and may inherit; a null key is a
key like any other; a null path part is written ``~``; repeated rows are scanned
alike; of units with equally many terms the largest cosine counts, then the
first licence by name, of several licence files in a directory the
largest declaring unit, likewise; a very long text is one unit among others, read whole; an empty
table gives no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsmart.llm.common import stage, table

# Names, phrases, header paragraphs and texts of common licences, by SPDX identifier.
#: Names and the words that tell them from others.
NAMES = [
    ("AGPL-3.0", "GNU Affero General Public License, version 3", "affero 3"),
    ("Apache-2.0", "Apache License, Version 2.0", "apache 2"),
    ("BSD-2-Clause", "BSD 2-Clause License", "bsd 2"),
    ("BSD-3-Clause", "BSD 3-Clause License", "bsd 3"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International License", "creative attribution 4"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International License", "creative noncommercial 4"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International License", "creative sharealike 4"),
    ("GPL-2.0", "GNU General Public License, version 2", "gnu general 2"),
    ("GPL-3.0", "GNU General Public License, version 3", "gnu general 3"),
    ("ISC", "ISC License", "isc"),
    ("LGPL-2.1", "GNU Lesser General Public License, version 2.1", "lesser 2 1"),
    ("LGPL-3.0", "GNU Lesser General Public License, version 3", "lesser 3"),
    ("MIT", "MIT License", "mit"),
    ("MPL-2.0", "Mozilla Public License, version 2.0", "mozilla 2"),
    ("Unlicense", "Unlicense", "unlicense"),
    ("Zlib", "zlib License", "zlib"),
]
#: Licences named by their identifiers, in words.
SHORT = [
    ("CC-BY-4.0", "CC BY 4.0"), ("CC-BY-NC-4.0", "CC BY-NC 4.0"), ("CC-BY-NC-ND-4.0", "CC BY-NC-ND 4.0"), ("CC-BY-NC-SA-4.0", "CC BY-NC-SA 4.0"),
    ("CC-BY-ND-4.0", "CC BY-ND 4.0"), ("CC-BY-SA-4.0", "CC BY-SA 4.0"), ("GPL-2.0", "GPL 2.0"), ("GPL-3.0", "GPL 3.0"), ("MPL-2.0", "MPL 2.0"),
]
PHRASES = [
    "{}", "Licensed under the {}", "Released under the {}", "This work is licensed under the {}", "Distributed under the {}",
    "This file is released under the {}, see LICENSE for details", "This project is licensed under the terms of the {}",
    "This file is subject to the terms of the {}",
]
_GNU = (
    "free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software "
    "Foundation, either version {} of the License, or (at your option) any later version."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met:"
)
_BSD_CLAUSES = (
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in "
    "the documentation and/or other materials provided with the distribution."
)
_BSD_THIRD = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
    "from this software without specific prior written permission."
)
_BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT "
    "NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
    "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    "(the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do "
    "so, subject to the following conditions:"
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
    "that the above copyright notice and this permission notice appear in all copies."
)
#: Header paragraphs and full texts, with words that each of them has.
TEXTS = [
    ("AGPL-3.0", "license affero foundation 3", "This program is " + _GNU.format("Affero General Public License", 3)),
    ("Apache-2.0", "license apache compliance", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
     "except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-2-Clause", "redistribution binary permitted", _BSD),
    ("BSD-2-Clause", "redistribution binary disclaimer", f"Copyright (c). All rights reserved. {_BSD} {_BSD_CLAUSES} {_BSD_DISCLAIMER}"),
    ("BSD-3-Clause", "endorse contributors neither", _BSD_THIRD),
    ("BSD-3-Clause", "endorse redistribution disclaimer",
     f"Copyright (c). All rights reserved. {_BSD} {_BSD_CLAUSES} {_BSD_THIRD} {_BSD_DISCLAIMER}"),
    ("GPL-2.0", "license gnu general foundation 2", "This program is " + _GNU.format("General Public License", 2)),
    ("GPL-3.0", "license gnu general foundation 3", "This program is " + _GNU.format("General Public License", 3)),
    ("ISC", "hereby fee", _ISC),
    ("ISC", "hereby fee author", f"ISC License Copyright (c) {_ISC} THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES "
     "WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE "
     "FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
     "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE "
     "OF THIS SOFTWARE."),
    ("LGPL-2.1", "license lesser foundation 2 1", "This library is " + _GNU.format("Lesser General Public License", "2.1")),
    ("LGPL-3.0", "license lesser foundation 3", "This library is " + _GNU.format("Lesser General Public License", 3)),
    ("MIT", "sublicense hereby charge", _MIT),
    ("MIT", "sublicense hereby charge noninfringement", f"MIT License Copyright (c) {_MIT} The above copyright notice and this permission "
     "notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF "
     "ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
     "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN "
     "AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN "
     "THE SOFTWARE."),
    ("MPL-2.0", "license mozilla mpl obtain", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy "
     "of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Zlib", "misrepresented altered", "This software is provided as-is, without any express or implied warranty. In no event will the "
     "authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
     "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
     "restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If "
     "you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. "
     "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice "
     "may not be removed or altered from any source distribution."),
]

#: Cosine from which a unit declares a licence.
LEAST = 0.6
#: Terms of declaring units among all of a licence file's, in hundredths.
LICENCE_FILE = 50
BREAK = "[^a-z0-9]+"
#: From a line's end to that of a line without letters and digits.
PARAGRAPH = r"\n[^a-z0-9]*\n"


def terms_of(text: str) -> list[str]:
    return [t for t in re.split(BREAK, text.lower()) if t]


def families() -> list[tuple[str, list[str], list[str]]]:
    """(licence, words a unit needs, templates): a name's with license or
    licensed beside it, an identifier's, a text's."""
    out = []
    for word in ("license", "licensed"):
        out += [(licence, [word, *needs.split()], [p.format(name) for p in PHRASES]) for licence, name, needs in NAMES]
        out += [(licence, [word, *dict.fromkeys(terms_of(name))], [p.format(name) for p in PHRASES]) for licence, name in SHORT]
    identifiers = sorted({licence for licence, *_ in [*NAMES, *SHORT]})
    out += [(x, ["license", "spdx", *dict.fromkeys(terms_of(x))], [f"SPDX-License-Identifier: {x}"]) for x in identifiers]
    return out + [(licence, needs.split(), [text]) for licence, needs, text in TEXTS]


FAMILIES = families()
#: Without one of these no family's needs are met.
KEYS = sorted({needs[0] for _, needs, _ in FAMILIES})


def terms(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), BREAK), "")


def whole(text: Column | str = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def literals(values: list[str]) -> Column:
    return F.array(*map(F.lit, values))


def rows_of(spark: SparkSession, values: list[tuple], names: list[str]) -> DataFrame:
    """A small fixed table as literals, whose size the optimizer sees."""
    structs = [F.struct(*(F.lit(v).alias(n) for v, n in zip(row, names, strict=True))) for row in values]
    return spark.range(1).select(F.inline(F.array(*structs)))


def needs_table(spark: SparkSession) -> DataFrame:
    rows = [(k, licence, " ".join(needs)) for k, (licence, needs, _) in enumerate(FAMILIES)]
    found = rows_of(spark, rows, ["family", "licence", "needs"]).withColumn("needs", F.split("needs", " "))
    return found.select("family", "licence", F.size("needs").alias("n_needs"), F.explode("needs").alias("term"))


def template_terms(spark: SparkSession) -> DataFrame:
    """(family, template, term, n)"""
    texts = [(k, text) for k, (_, _, own) in enumerate(FAMILIES) for text in own]
    found = rows_of(spark, [(k, i, text) for i, (k, text) in enumerate(texts)], ["family", "template", "notice"])
    return found.select("family", "template", F.explode(terms(F.col("notice"))).alias("term")).groupBy("family", "template", "term").agg(
        F.count(F.lit(1)).alias("n")
    )


def units(files: DataFrame) -> DataFrame:
    """(unit, row, key, dir, n_terms, kind, terms): lines (0), paragraphs of
    several lines (1) and files of several lines (2) with a key word."""

    def keyed(text: Column) -> Column:
        return F.arrays_overlap(F.split(text, BREAK), literals(KEYS))

    def several(text: Column) -> Column:
        return F.contains(text, F.lit("\n"))

    rows = files.select("key", "dir", F.lower(whole()).alias("text")).where(keyed(F.col("text")))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    kinds = [F.split("text", "\n"), F.filter(F.split("text", PARAGRAPH), several), F.when(several(F.col("text")), F.array("text")).otherwise(F.array())]
    found = [
        F.transform(F.filter(texts, keyed), lambda x, kind=kind: F.struct(F.lit(kind).alias("kind"), x.alias("unit_text")))
        for kind, texts in enumerate(kinds)
    ]
    found = rows.select("row", "key", "dir", F.size(terms(F.col("text"))).alias("n_terms"), F.inline(F.concat(*found)))
    found = found.select(F.monotonically_increasing_id().alias("unit"), "row", "key", "dir", "n_terms", "kind", terms(F.col("unit_text")).alias("terms"))
    return stage(found, "licence-units")


def weights(files: DataFrame, wanted: DataFrame) -> DataFrame:
    """(term, w): IDF of the wanted terms, from counts over all files."""
    counted = files.select(F.explode(F.array_distinct(terms(whole()))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    total = files.count()
    found = wanted.join(counted, "term", "left")
    return stage(found.select("term", (F.log((1 + total) / (1 + F.coalesce("df", F.lit(0)))) + 1).alias("w")), "licence-weights")


def declarations(files: DataFrame) -> DataFrame:
    """(unit, row, key, dir, n_terms, kind, n, licence, cosine) of the units that
    declare a licence, n being their terms."""
    spark = files.sparkSession
    held = units(files)
    counts = stage(held.select("unit", F.explode("terms").alias("term")).groupBy("unit", "term").agg(F.count(F.lit(1)).alias("n")), "licence-terms")
    own = template_terms(spark)
    idf = weights(files, counts.select("term").union(own.select("term")).distinct())
    own = own.join(idf, "term").select("family", "template", "term", (F.col("n") * F.col("w")).alias("v"))
    lengths = own.groupBy("template").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("length"))
    vectors = stage(own.join(lengths, "template").select("family", "template", "term", (F.col("v") / F.col("length")).alias("v")), "licence-vectors")
    needs = needs_table(spark)
    named = counts.join(needs, "term").groupBy("unit", "family", "licence", "n_needs").agg(F.count(F.lit(1)).alias("met"))
    named = named.where("met = n_needs").select("unit", "family", "licence")
    weighed = counts.join(idf, "term").select("unit", "term", (F.col("n") * F.col("w")).alias("w"))
    weighed = stage(weighed.join(named.select("unit").distinct(), "unit", "left_semi"), "licence-weighed")
    norms = weighed.groupBy("unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = weighed.join(named, "unit").join(vectors, ["family", "term"]).groupBy("unit", "licence", "template").agg(F.sum(F.col("w") * F.col("v")).alias("dot"))
    scored = dots.join(norms, "unit").select("unit", "licence", F.round(F.col("dot") / F.col("norm"), 9).alias("cosine")).where(F.col("cosine") >= LEAST)
    best = scored.groupBy("unit").agg(F.min(F.struct((-F.col("cosine")).alias("minus"), "licence")).alias("best"))
    found = held.select("unit", "row", "key", "dir", "n_terms", "kind", F.size("terms").alias("n")).join(best, "unit")
    return found.select("unit", "row", "key", "dir", "n_terms", "kind", "n", F.col("best.licence").alias("licence"), (-F.col("best.minus")).alias("cosine"))


def nearest_licence(dirs: DataFrame, licensed: DataFrame) -> DataFrame:
    """(dir, inherited, inherited_from): for each directory the licence of its
    nearest licensed ancestor, itself included, by joins on paths."""
    parts = F.split("dir", "/")
    ancestors = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    found = dirs.select("dir", F.explode(ancestors).alias("ancestor")).join(licensed.withColumnRenamed("dir", "ancestor"), "ancestor")
    return found.groupBy("dir").agg(
        F.max_by("licence", F.length("ancestor")).alias("inherited"), F.max_by("ancestor", F.length("ancestor")).alias("inherited_from")
    )


def scan(files: DataFrame) -> DataFrame:
    """(key, dir, declared, cosine, licence_file, inherited, inherited_from,
    licence) of every row of (key, dir, text). Rows that share key and
    directory are one file."""
    files = files.select("key", "dir", "text")
    order = F.struct(-F.col("n"), -F.col("cosine"), F.col("licence"))
    parts = [F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0)) for kind in range(3)]
    per_row = declarations(files).groupBy("row", "key", "dir").agg(
        F.min_by(F.struct("licence", "cosine", "n"), order).alias("best"),
        (100 * F.greatest(*parts) >= LICENCE_FILE * F.first("n_terms")).alias("licence_file"),
    )
    per_row = per_row.select("key", "dir", "best.*", "licence_file")
    declared = stage(
        per_row.groupBy("key", "dir").agg(
            F.min_by(F.struct(F.col("licence").alias("declared"), "cosine", "n"), order).alias("best"), F.bool_or("licence_file").alias("licence_file")
        ).select("key", "dir", "best.*", "licence_file"),
        "licence-declared",
    )
    licensed = declared.where("licence_file").groupBy("dir").agg(
        F.min_by("declared", F.struct(-F.col("n"), -F.col("cosine"), F.col("declared"))).alias("licence")
    )
    inherited = stage(nearest_licence(files.select("dir").distinct(), stage(licensed, "licence-dirs")), "licence-inherited")
    named = declared.select(F.col("key").alias("of_key"), F.col("dir").alias("of_dir"), "declared", "cosine", "licence_file")
    rows = files.select("key", "dir").join(named, F.col("key").eqNullSafe(F.col("of_key")) & (F.col("dir") == F.col("of_dir")), "left")
    rows = rows.drop("of_key", "of_dir").join(inherited, "dir", "left")
    rows = rows.withColumn("licence_file", F.coalesce("licence_file", F.lit(False)))
    return rows.withColumn("licence", F.coalesce("declared", "inherited"))


def document_dir() -> Column:
    """Source, language and all but the last digit of doc_id as directories."""
    tens = F.floor(F.col("doc_id") / 10)
    digits = F.when(tens != 0, F.regexp_replace(tens.cast("string"), r"(\d)(?=\d)", "$1/"))
    return F.concat_ws("/", F.coalesce("source", F.lit("~")), F.coalesce("lang", F.lit("~")), digits)


def op7_license_scan(spark, folder: str) -> DataFrame:
    """Per document: the licence it declares, or inherits from a directory above."""
    docs = table(spark, folder, "documents")
    found = scan(docs.select(F.col("doc_id").alias("key"), document_dir().alias("dir"), "text"))
    return found.select(F.col("key").alias("doc_id"), "dir", "declared", "cosine", "licence_file", "inherited", "inherited_from", "licence")


def _sql() -> str:
    def listed(values: list[str]) -> str:
        return "[" + ", ".join(f"'{v}'" for v in values) + "]"

    known = ",\n  ".join(f"({k}, '{licence}', {listed(needs)}, {listed(own)})" for k, (licence, needs, own) in enumerate(FAMILIES))
    return rf"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, lower(coalesce(text, '')) AS text,
         concat_ws('/', coalesce(source, '~'), coalesce(lang, '~'), CASE WHEN doc_id // 10 <> 0 THEN
           array_to_string(string_split(CAST(doc_id // 10 AS VARCHAR), ''), '/') END) AS dir FROM documents),
families(family, licence, needs, notices) AS (VALUES
  {known}),
notices AS (SELECT family, unnest(notices) AS notice FROM families),
template_terms AS (
  SELECT family, notice, term, count(*) AS n FROM (
    SELECT family, notice, unnest(list_filter(string_split_regex(lower(notice), '[^a-z0-9]+'), lambda t: t <> '')) AS term FROM notices)
  GROUP BY ALL),
units AS (
  SELECT row_number() OVER () AS unit, * FROM (
    SELECT rid, 0 AS kind, unnest(string_split(text, chr(10))) AS body FROM docs
    UNION ALL SELECT rid, 1, body FROM (SELECT rid, unnest(string_split_regex(text, '\n[^a-z0-9]*\n')) AS body FROM docs) WHERE contains(body, chr(10))
    UNION ALL SELECT rid, 2, text FROM docs WHERE contains(text, chr(10)))),
unit_terms AS (
  SELECT unit, term, count(*) AS n FROM (SELECT unit, unnest(string_split_regex(body, '[^a-z0-9]+')) AS term FROM units) WHERE term <> '' GROUP BY ALL),
needs AS (SELECT family, licence, len(needs) AS n_needs, unnest(needs) AS term FROM families),
named AS (
  SELECT unit, family, licence FROM unit_terms JOIN needs USING (term) GROUP BY unit, family, licence, n_needs HAVING count(*) = n_needs),
held AS (SELECT DISTINCT rid, unnest(string_split_regex(text, '[^a-z0-9]+')) AS term FROM docs),
df AS (SELECT term, count(*) AS df FROM held GROUP BY term),
total AS (SELECT count(*) AS n FROM docs),
weighed AS (
  SELECT unit, u.term, u.n * (ln((1.0 + (SELECT n FROM total)) / (1 + coalesce(df, 0))) + 1) AS w
  FROM unit_terms u LEFT JOIN df USING (term) WHERE unit IN (SELECT unit FROM named)),
template_weights AS (
  SELECT family, notice, t.term, t.n * (ln((1.0 + (SELECT n FROM total)) / (1 + coalesce(df, 0))) + 1) AS w FROM template_terms t LEFT JOIN df USING (term)),
template_lengths AS (SELECT family, notice, sqrt(sum(w * w)) AS length FROM template_weights GROUP BY ALL),
norms AS (SELECT unit, sqrt(sum(w * w)) AS norm FROM weighed GROUP BY unit),
scored AS (
  SELECT unit, licence, round(sum(u.w * t.w) / any_value(length) / any_value(norm), 9) AS cosine
  FROM named JOIN weighed u USING (unit) JOIN template_weights t USING (family, term) JOIN template_lengths USING (family, notice) JOIN norms USING (unit)
  GROUP BY unit, family, licence, notice),
best AS (SELECT unit, licence, cosine FROM scored WHERE cosine >= {LEAST} QUALIFY row_number() OVER (PARTITION BY unit ORDER BY cosine DESC, licence) = 1),
sizes AS (SELECT unit, CAST(sum(n) AS BIGINT) AS n FROM unit_terms GROUP BY unit),
hits AS (SELECT rid, kind, sizes.n, licence, cosine FROM best JOIN sizes USING (unit) JOIN units USING (unit)),
row_sizes AS (SELECT rid, len(list_filter(string_split_regex(text, '[^a-z0-9]+'), lambda t: t <> '')) AS n_terms FROM docs),
files AS (
  SELECT rid, 100 * greatest(sum(CASE WHEN kind = 0 THEN n ELSE 0 END), sum(CASE WHEN kind = 1 THEN n ELSE 0 END),
                             sum(CASE WHEN kind = 2 THEN n ELSE 0 END)) >= {LICENCE_FILE} * any_value(n_terms) AS licence_file
  FROM hits JOIN row_sizes USING (rid) GROUP BY rid),
declared AS (
  SELECT doc_id, dir, licence AS declared, cosine, n, bool_or(licence_file) OVER (PARTITION BY doc_id, dir) AS licence_file
  FROM hits JOIN files USING (rid) JOIN docs USING (rid)
  QUALIFY row_number() OVER (PARTITION BY doc_id, dir ORDER BY n DESC, cosine DESC, licence) = 1),
licensed AS (
  SELECT dir AS above, declared AS licence FROM declared WHERE licence_file
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY n DESC, cosine DESC, declared) = 1),
inherited AS (
  SELECT dir, arg_max(licence, length(above)) AS inherited, arg_max(above, length(above)) AS inherited_from
  FROM (SELECT DISTINCT dir FROM docs) JOIN licensed ON dir = above OR starts_with(dir, above || '/') GROUP BY dir)
SELECT docs.doc_id, docs.dir, declared, cosine, coalesce(licence_file, false) AS licence_file, inherited, inherited_from,
       coalesce(declared, inherited) AS licence
FROM docs LEFT JOIN declared ON docs.doc_id IS NOT DISTINCT FROM declared.doc_id AND docs.dir = declared.dir
LEFT JOIN inherited ON docs.dir = inherited.dir
"""


OP7_SQL = _sql()
