"""Licence scans: TF-IDF cosine to templates, then inheritance by directory.

Templates are SPDX identifiers, notices of one line, the headers of source
files, and licence files: whole short ones, the first paragraphs of the long ones
(which tell the licence).  Each has an anchor, a term by which it is laid over a
text: wherever the text has that term, the span of the template's length around
it is compared, whatever the lines, comment signs and blanks.  So headers,
files and notices inside long lines are compared whole.

The vectors of spans and templates have a term's frequency times
``ln((1 + N) / (1 + df)) + 1``, over the documents that hold a licence word and
the templates.  They are sparse: spans that share less than half of a template's
terms are left out first, and equal spans are compared once.  A span belongs to
a template from cosine ``least`` on; a document to the span that explains most,
``length * cosine ** 8`` (a header that also says "All rights reserved" is that
header).

A licence file is a document that starts as a long licence file does, or of whose
terms a notice is half or more, or of fewer than ``notice_words`` words with a licence
(a notice file).  Its licence holds for its directory (the file with the least
id, if there are more) and is inherited by the documents below that have no
notice of their own: every document's ancestor directories are joined to the
directories with a licence, and the deepest wins.

Defined cases: a null text has no notice; a null path has no directory and
inherits nothing; ties go to the higher cosine, the licence that comes first by
name, the place that comes first, and the least id; repeated rows get equal results; an empty
table gives an empty table; other columns are ignored.

Only DataFrame functions are used.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize, tidy
from .common import WORD, table

MARKER = "(?i)licen[cs]|copyright|spdx|creative commons|all rights reserved"
TERM = "[a-z0-9]+(?:[.-][a-z0-9]+)*"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# SPDX identifiers, with the suffixes that may follow.
SPDX = {"Apache-2.0": "", "BSD-3-Clause": "", "CC-BY-4.0": "", "CC-BY-NC-4.0": "", "CC-BY-SA-4.0": "",
        "GPL-2.0": "-only -or-later", "GPL-3.0": "-only -or-later", "LGPL-3.0": "-only -or-later", "MIT": "", "MPL-2.0": ""}
# Short notices by which the licences are known.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms are permitted under the BSD 3-Clause License"),
    ("CC-BY-4.0", "Licensed under the Creative Commons Attribution 4.0 International License, CC BY 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MPL-2.0", "Subject to the terms of the Mozilla Public License, version 2.0"),
    ("Proprietary", "All rights reserved"),
]
# The standard headers of source files.
_GNU = ("This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1} as published "
        "by the Free Software Foundation, either version {2} of the License, or (at your option) any later version. This "
        "{0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty "
        "of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1} for more details. You should have received "
        "a copy of the GNU {1} along with this {0}. If not, see <https://www.gnu.org/licenses/>.")
HEADERS = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
     "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
     "required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS "
     "IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
     "language governing permissions and limitations under the License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("GPL-2.0", _GNU.format("program", "General Public License", "2")),
    ("GPL-3.0", _GNU.format("program", "General Public License", "3")),
    ("LGPL-3.0", _GNU.format("library", "Lesser General Public License", "3")),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
     "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Proprietary", "Unauthorized copying of this file, via any medium, is strictly prohibited. Proprietary and confidential. "
     "All rights reserved."),
]
# Licence files, the short ones whole.
FILES = [
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
     "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
     "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
     "this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "
     "\"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
     "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS "
     "BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
     "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
     "that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this "
     "list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
     "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with "
     "the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
     "promote products derived from this software without specific prior written permission."),
]
# How the long licence files start.
_GNU_FILE = ("GNU {0}GENERAL PUBLIC LICENSE Version {1} Copyright (C) {2} Free Software Foundation, Inc. <https://fsf.org/> "
             "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not "
             "allowed.")
STARTS = [
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, "
     "REPRODUCTION, AND DISTRIBUTION 1. Definitions. \"License\" shall mean the terms and conditions for use, reproduction, and "
     "distribution as defined by Sections 1 through 9 of this document."),
    ("GPL-2.0", _GNU_FILE.format("", "2, June 1991", "1989, 1991")),
    ("GPL-3.0", _GNU_FILE.format("", "3, 29 June 2007", "2007")),
    ("LGPL-3.0", _GNU_FILE.format("LESSER ", "3, 29 June 2007", "2007")),
    ("MPL-2.0", "Mozilla Public License Version 2.0 1. Definitions 1.1. \"Contributor\" means each individual or legal entity "
     "that creates, contributes to the creation of, or owns Covered Software."),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International Public License By exercising the Licensed Rights (defined "
     "below), You accept and agree to be bound by the terms and conditions of this Creative Commons Attribution 4.0 "
     "International Public License (\"Public License\")."),
]
# The terms that templates are laid by, the most telling first.
ANCHORS = ["spdx-license-identifier", "redistribution", "permission", "unauthorized", "mozilla", "apache", "gnu", "creative",
           "cc", "bsd-style", "license", "licensed", "rights"]
#: A notice begins a document if it stands among its first terms.
TOP = 40


def templates() -> list[tuple[int, str, bool, list[str], str, int]]:
    """(number, licence, whether the start of a file, terms, anchor, its place)
    of all templates."""
    every = [(name, False, f"SPDX-License-Identifier: {name}{suffix}") for name, more in SPDX.items()
             for suffix in ("", *more.split())]
    every += [(name, False, text) for name, text in NOTICES + HEADERS + FILES] + [(name, True, text) for name, text in STARTS]
    out = []
    for i, (name, file, text) in enumerate(every):
        terms = re.findall(TERM, text.lower())
        anchor = next(a for a in ANCHORS if a in terms)
        out.append((i, name, file, terms, anchor, terms.index(anchor)))
    return out


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(TERM), F.lit(0))


@tidy
def own_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, least: float = 0.7) -> DataFrame:
    """``(key, license, cosine, file)`` of the documents that have a notice;
    ``key`` is a hash of id and text, ``file`` tells whether the notice
    begins the document as a file does or makes up half of it."""
    spark = docs.sparkSession
    t = templates()
    wide = max(len(x[3]) for x in t)
    rows = docs.where(F.col(text).rlike(MARKER)).select(
        F.xxhash64(doc_id, text).alias("key"), _terms(F.col(text)).alias("terms")).dropDuplicates(["key"])
    rows = materialize(rows, "license-texts")  # the few texts with a licence word
    tpl = spark.createDataFrame(t, "tid int, license string, file boolean, t_terms array<string>, anchor string, at int")
    # Around every anchor, as many terms as the longest template may reach.
    found = F.filter(F.transform("terms", lambda x, i: F.struct(i.alias("pos"), x.alias("anchor"))),
                     lambda x: x["anchor"].isin(ANCHORS))
    near = rows.select("key", F.size("terms").alias("n"), F.explode(F.transform(found, lambda x: F.struct(
        x["pos"].alias("pos"), x["anchor"].alias("anchor"), F.greatest(x["pos"] - wide, F.lit(0)).alias("base"),
        F.slice(F.col("terms"), F.greatest(x["pos"] - wide, F.lit(0)) + 1, F.lit(2 * wide)).alias("part")))).alias("x"))
    start = F.col("x.pos") - F.col("at")
    near = near.join(F.broadcast(tpl), F.col("x.anchor") == F.col("anchor"))  # a fixed number of templates
    own = F.slice(F.col("x.part"), F.greatest(start, F.lit(0)) - F.col("x.base") + 1,
                  F.size("t_terms") + F.least(start, F.lit(0)))
    spans = near.select("key", "n", "tid", F.greatest(start, F.lit(0)).alias("start"), own.alias("span"),
                        F.size("t_terms").alias("length"), F.size(F.array_distinct("t_terms")).alias("distinct"),
                        F.size(F.array_intersect(own, F.col("t_terms"))).alias("both"))
    spans = materialize(spans.where("2 * both >= distinct").select("key", "n", "tid", "start", "span", "length"),
                        "license-spans")
    n = rows.count() + len(t)
    t_tf = (tpl.select("tid", F.explode("t_terms").alias("term")).groupBy("tid", "term").agg(F.count(F.lit(1)).alias("t_tf")))
    df = (rows.select(F.explode(F.array_distinct("terms")).alias("term")).unionByName(t_tf.select("term"))
          .groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    idf = materialize(df.select("term", (F.log(F.lit(1 + n) / (1 + F.col("df"))) + 1).alias("idf")), "license-idf")
    tw = t_tf.join(idf, "term").select("tid", "term", (F.col("t_tf") * F.col("idf")).alias("tw"))
    t_norm = tw.groupBy("tid").agg(F.sqrt(F.sum(F.col("tw") * F.col("tw"))).alias("t_norm"))
    # Equal spans are compared once.
    one = materialize(spans.select("tid", "span").distinct().withColumn("sid", F.monotonically_increasing_id()), "license-one")
    tf = one.select("sid", "tid", F.explode("span").alias("term")).groupBy("sid", "tid", "term").agg(F.count(F.lit(1)).alias("tf"))
    w = tf.join(idf, "term").join(tw, ["tid", "term"], "left").select(
        "sid", "tid", (F.col("tf") * F.col("idf")).alias("w"), F.coalesce("tw", F.lit(0.0)).alias("tw"))
    per = w.groupBy("sid", "tid").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    cosine = F.round(F.col("dot") / (F.col("norm") * F.col("t_norm")), 6)
    cos = materialize(per.join(t_norm, "tid").select("sid", cosine.alias("cosine")).where(F.col("cosine") >= least)
                      .join(one, "sid").select("tid", "span", "cosine"), "license-cosines")
    hits = spans.join(cos, ["tid", "span"]).join(F.broadcast(tpl.select("tid", "license", "file")), "tid")
    score = F.round(F.col("length") * F.pow("cosine", F.lit(8)), 6)
    whole = F.col("file") & (F.col("start") < TOP) | (2 * F.col("length") >= F.col("n"))
    best = hits.groupBy("key").agg(F.min(F.struct(
        (-score).alias("s"), (-F.col("cosine")).alias("c"), "license", "start", "tid", (~whole).alias("part"))).alias("b"))
    return best.select("key", F.col("b.license").alias("license"), (-F.col("b.c")).alias("cosine"), (~F.col("b.part")).alias("file"))


@tidy
def scan_licenses(docs: DataFrame, path: Column, doc_id: str = "doc_id", text: str = "text", *,
                  least: float = 0.7, notice_words: int = 150) -> DataFrame:
    """``(doc_id, license, cosine, effective_license, inherited_from)`` for
    every row; ``path`` names each document's directory (parts by ``/``)."""
    rows = materialize(docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(doc_id, text).alias("key"), path.alias("dir"),
        (F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)) < notice_words).alias("short")), "license-rows")
    own = materialize(own_licenses(docs, doc_id, text, least=least), "license-own")
    rows = rows.join(own, "key", "left")
    by_dir = (rows.where((F.col("short") | F.col("file")) & F.col("license").isNotNull() & F.col("dir").isNotNull())
              .groupBy("dir").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "license")).alias("b"))
              .select(F.col("dir").alias("from_dir"), F.col("b.license").alias("dir_license")))
    by_dir = materialize(by_dir, "license-dirs")
    # The ancestors of every directory that occurs, joined to those with a licence.
    parts = F.split("dir", "/", -1)
    up = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.struct(
        k.alias("depth"), F.array_join(F.slice(parts, F.lit(1), k), "/").alias("from_dir")))
    dirs = rows.select("dir").where(F.col("dir").isNotNull()).distinct().select("dir", F.explode(up).alias("u"))
    near = (dirs.select("dir", "u.depth", "u.from_dir").join(by_dir, "from_dir").groupBy("dir")
            .agg(F.max(F.struct("depth", "from_dir", "dir_license")).alias("a"))
            .select("dir", F.col("a.from_dir").alias("from_dir"), F.col("a.dir_license").alias("dir_license")))
    near = materialize(near, "license-near")
    j = rows.join(near, "dir", "left")
    return j.select("doc_id", "license", "cosine", F.coalesce("license", "dir_license").alias("effective_license"),
                    F.when(F.col("license").isNull(), F.col("from_dir")).alias("inherited_from"))


def _paths() -> Column:
    """``documents`` has no paths: the source is the top directory, the
    language one below it, then one for every 50 ids; every fifth document
    stands in one of the upper two."""
    top, lang = F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none"))
    mid = F.concat_ws("/", top, lang)
    return (F.when(F.col("doc_id") % 10 == 0, top).when(F.col("doc_id") % 10 == 5, mid)
            .otherwise(F.concat_ws("/", mid, F.floor(F.col("doc_id") / 50).cast("string"))))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return scan_licenses(docs, _paths())


def _list(terms: list[str]) -> str:
    return "[" + ", ".join(f"'{x}'" for x in terms) + "]"


_ROWS = ",\n  ".join(f"({i}, '{name}', {file}, {_list(terms)}, '{anchor}', {at})" for i, name, file, terms, anchor, at in templates())
_PATH = """CASE WHEN doc_id % 10 = 0 THEN coalesce(source, 'none')
       WHEN doc_id % 10 = 5 THEN coalesce(source, 'none') || '/' || coalesce(lang, 'none')
       ELSE coalesce(source, 'none') || '/' || coalesce(lang, 'none') || '/' || CAST(doc_id // 50 AS VARCHAR) END"""
#: The same in DuckDB, with spans cut from the whole text.
ORACLE = f"""
WITH d AS (SELECT doc_id, text, {_PATH} AS dir,
                  len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) < 150 AS short FROM documents),
tpl AS (SELECT * FROM (VALUES {_ROWS}) v(tid, license, file, t_terms, anchor, place)),
texts AS (SELECT doc_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{TERM}') AS terms
          FROM d WHERE regexp_matches(text, '{MARKER}')),
places AS (SELECT doc_id, terms, unnest(range(len(terms))) AS pos FROM texts),
spans AS (SELECT doc_id, len(terms) AS n, tid, greatest(pos - place, 0) AS start, len(t_terms) AS length, t_terms,
                 list_slice(terms, greatest(pos - place, 0) + 1, pos - place + len(t_terms)) AS span
          FROM places JOIN tpl ON terms[pos + 1] = anchor),
near AS (SELECT * EXCLUDE (t_terms) FROM spans
         WHERE 2 * len(list_intersect(list_distinct(span), list_distinct(t_terms))) >= len(list_distinct(t_terms))),
one AS (SELECT row_number() OVER () AS sid, tid, span FROM (SELECT DISTINCT tid, span FROM near)),
n AS (SELECT (SELECT count(*) FROM texts) + (SELECT count(*) FROM tpl) AS n),
t_tf AS (SELECT tid, term, count(*) AS t_tf FROM (SELECT tid, unnest(t_terms) AS term FROM tpl) GROUP BY ALL),
idf AS (SELECT term, ln((1 + (SELECT n FROM n)) / (1 + count(*))) + 1 AS idf
        FROM (SELECT unnest(list_distinct(terms)) AS term FROM texts UNION ALL SELECT term FROM t_tf) u GROUP BY term),
tw AS (SELECT tid, term, t_tf * idf AS tw FROM t_tf JOIN idf USING (term)),
tn AS (SELECT tid, sqrt(sum(tw * tw)) AS t_norm FROM tw GROUP BY tid),
w AS (SELECT sid, x.tid, tf * idf AS w, coalesce(tw, 0) AS tw
      FROM (SELECT sid, tid, term, count(*) AS tf FROM (SELECT sid, tid, unnest(span) AS term FROM one) GROUP BY ALL) x
      JOIN idf USING (term) LEFT JOIN tw ON tw.tid = x.tid AND tw.term = x.term),
cos AS (SELECT sid, round(sum(w * tw) / (sqrt(sum(w * w)) * any_value(t_norm)), 6) AS cosine
        FROM w JOIN tn USING (tid) GROUP BY sid),
hits AS (SELECT near.doc_id, license, cosine, start, near.tid, round(length * pow(cosine, 8), 6) AS score,
                (file AND start < {TOP}) OR 2 * length >= near.n AS whole
         FROM near JOIN one ON one.tid = near.tid AND one.span = near.span JOIN cos USING (sid) JOIN tpl ON tpl.tid = near.tid
         WHERE cosine >= 0.7),
own AS (SELECT doc_id, license, cosine, whole FROM hits
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, cosine DESC, license, start, tid, whole DESC) = 1),
r AS (SELECT d.doc_id, dir, short OR coalesce(whole, false) AS file, license, cosine FROM d LEFT JOIN own USING (doc_id)),
dirs AS (SELECT dir AS from_dir, arg_min(license, doc_id) AS dir_license FROM r
         WHERE file AND license IS NOT NULL GROUP BY dir),
up AS (SELECT x.dir, arg_max(from_dir, length(from_dir)) AS from_dir, arg_max(dir_license, length(from_dir)) AS dir_license
         FROM (SELECT DISTINCT dir FROM r) x JOIN dirs ON x.dir = from_dir OR starts_with(x.dir, from_dir || '/')
         GROUP BY x.dir)
SELECT doc_id, license, cosine, coalesce(license, dir_license) AS effective_license,
       CASE WHEN license IS NULL THEN from_dir END AS inherited_from
FROM r LEFT JOIN up USING (dir)
"""
