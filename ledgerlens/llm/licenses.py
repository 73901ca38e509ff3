"""Licence scans by canonical digest lookup.

Known licence texts and notices are put in a canonical form: lower case,
equivalent spellings unified, copyright lines dropped, punctuation and runs of
white space made one space.  Known texts are built in, or given as a table, or read
from a folder with a file a licence (``read_texts``).  The digest of the whole form is the key.  A
document's whole text, and each of its lines and paragraphs as an entire text of its own, get
the same treatment and are hash-joined to the known digests.

Only built-in functions are used.  The known table holds a row per text and
is joined as its size allows; matches are summed by document before they meet
it again.

Defined cases: null and empty texts match nothing; a text that is only
punctuation or copyright lines has an empty form and matches nothing; repeated
rows each get the result of their own text, also where an id has several; a
text known under two names takes the smaller; a null id never gets a match;
very long texts are taken whole; other columns are not read, whatever their
names; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: fixed values: equivalent spellings in lower-case text, applied in order
SPELLINGS = (("licence", "license"), ("sub-licens", "sublicens"), ("non-commercial", "noncommercial"), ("organis", "organiz"), ("favour", "favor"), ("acknowledgement", "acknowledgment"),
             ("merchantibility", "merchantability"), ("copyright owner", "copyright holder"), ("&", " and "), ("https://", ""), ("http://", ""))
VERSION = r"(?<![a-z])v(ersion|[.])? *(?=[0-9])"
#: a copyright line: a mark and a year, or "copyright" and a holder; what goes on from an earlier line of a licence ("copyright notice ...") is none
COPYRIGHT = (r"(?m)^[^a-z0-9\n]*(copyright|\(c\)|©)([^a-z\n]|\(c\)|©)*[0-9]{4}[^\n]*$|^[^a-z0-9\n]*all rights reserved[^a-z0-9\n]*$"
             r"|^[^a-z0-9\n]*copyright(?![a-z])(?![^a-z0-9\n]*(notice|holder|owner|law|licen[cs]e|statement|interest|disclaimer|act|treat|and|or|in|to|is|as|for|of|the|protect)s?(?![a-z]))[^\n]*$")

#: fixed values: licence notices and short licence texts
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
KNOWN = {
    "MIT": [_MIT, "MIT License\n\n" + _MIT, "The MIT License (MIT)\n\n" + _MIT],
    "ISC": [_ISC, "ISC License\n\n" + _ISC],
    "Apache-2.0": [_APACHE],
}
#: fixed values: names that the notice forms below are made from
NAMES = {
    "MIT": ("MIT License", "MIT"), "ISC": ("ISC License",), "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0"),
    "BSD-2-Clause": ("BSD 2-Clause License", "BSD-2-Clause"), "BSD-3-Clause": ("BSD 3-Clause License", "BSD-3-Clause"),
    "GPL-2.0": ("GNU General Public License, version 2", "GPL-2.0"), "GPL-3.0": ("GNU General Public License, version 3", "GPL-3.0"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "LGPL-3.0"), "AGPL-3.0": ("GNU Affero General Public License, version 3", "AGPL-3.0"),
    "MPL-2.0": ("Mozilla Public License, Version 2.0", "MPL-2.0"), "Unlicense": ("Unlicense",), "CC0-1.0": ("CC0 1.0", "CC0 1.0 Universal"),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License"), "CC-BY-SA-4.0": ("CC BY-SA 4.0",),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"), "CC-BY-NC-SA-4.0": ("CC BY-NC-SA 4.0",),
    "CC-BY-ND-4.0": ("CC BY-ND 4.0",), "CC-BY-NC-ND-4.0": ("CC BY-NC-ND 4.0",),
}
FORMS = ("Licensed under {}", "Licensed under the {}", "Licensed under a {}", "Released under {}", "Released under the {}", "Distributed under the {}", "License: {}", "SPDX-License-Identifier: {}",
         "This work is licensed under {}", "This work is licensed under the {}", "This work is licensed under a {}", "This file is licensed under the {}", "This software is released under the {}",
         "This program is licensed under the {}", "This project is licensed under the {}", "Available under the {}")


def known_texts() -> list[tuple[str, str]]:
    """(license, text) of the built-in texts and of every notice form for every name."""
    return [(k, t) for k, texts in KNOWN.items() for t in texts] + [(k, f.format(n)) for k, names in NAMES.items() for n in names for f in FORMS]


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(license, text) of a folder that holds a file a licence, named after it."""
    return spark.read.text(path, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.+?)([.]txt)?$", 1).alias("license"), F.col("value").alias("text"))


def lowered(text: Column) -> Column:
    """Lower case, line ends unified."""
    return F.lower(F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n")))


def canonical_lines(text: Column) -> Column:
    """Canonical form of a lowered text with its line ends kept; the copyright pattern runs only where its words occur."""
    marked = text.contains("copyright") | text.contains("(c)") | text.contains("©") | text.contains("all rights reserved")
    text = F.when(marked, F.regexp_replace(text, COPYRIGHT, " ")).otherwise(text)
    for found, instead in SPELLINGS:
        text = F.replace(text, F.lit(found), F.lit(instead))
    return F.regexp_replace(F.regexp_replace(text, VERSION, "v"), r"[^\p{L}\p{N}\n]+", " ")


def one_line(lines: Column) -> Column:
    """Canonical form from the form with line ends."""
    return F.trim(F.regexp_replace(lines, r"\s+", " "))


def digests(spark: SparkSession, texts: DataFrame | None = None) -> DataFrame:
    """(digest, license) of known texts, built in or given as (license, text); a digest has one row."""
    if texts is None:
        texts = spark.createDataFrame(known_texts(), "license string, text string").coalesce(1)
    form = one_line(canonical_lines(lowered(F.col("text"))))
    return texts.where(F.length(form) > 0).groupBy(F.sha2(F.encode(form, "UTF-8"), 256).alias("digest")).agg(F.min("license").alias("license"))


def scan(docs: DataFrame, known: DataFrame | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: key, license (of the whole text, else null), licenses (sorted, of its lines, paragraphs or whole), n_matches."""
    known = digests(docs.sparkSession, known)
    # a column for each step, so that no step is computed again for each use of its result
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).alias("key"), F.md5(F.encode(body, "UTF-8")).alias("of"), lowered(body).alias("low"))
    rows = rows.select("key", "of", canonical_lines(F.col("low")).alias("body"))
    rows = rows.withColumn("whole", one_line(F.col("body")))
    paragraphs = F.transform(F.split("body", r"\n *\n"), lambda x: F.trim(F.replace(x, F.lit("\n"), F.lit(" "))))
    paragraphs = F.transform(paragraphs, lambda x: F.regexp_replace(x, " +", " "))
    units = F.array_distinct(F.concat(F.array("whole"), paragraphs, F.transform(F.split("body", "\n"), lambda x: F.trim(x))))
    units = rows.select("key", "of", "whole", F.explode(F.filter(units, lambda x: F.length(x) > 0)).alias("unit"))
    units = units.select("key", "of", (F.col("unit") == F.col("whole")).alias("whole"), F.sha2(F.encode("unit", "UTF-8"), 256).alias("digest"))
    # rows of one id and text have the same matches: one of them counts
    hits = units.join(known, "digest").distinct().groupBy("key", "of").agg(F.max(F.when(F.col("whole"), F.col("license"))).alias("license"),
                                                         F.sort_array(F.collect_set("license")).alias("licenses"), F.count(F.lit(1)).alias("n_matches"))
    out = docs.select(F.col(key).alias("key"), F.md5(F.encode(body, "UTF-8")).alias("of")).join(hits, ["key", "of"], "left")
    return out.select(F.col("key").alias(key), "license", F.coalesce("licenses", F.array().cast("array<string>")).alias("licenses"), F.coalesce("n_matches", F.lit(0)).cast("long").alias("n_matches"))
