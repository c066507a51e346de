"""License texts found by a canonical digest, native."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adfeat.llm.common import let, on_doc, small, text_key

_PERMISSION = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom
the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License."""

#: licenses' own texts and the usual one-line notices.
KNOWN: list[tuple[str, str]] = [
    ("MIT", _PERMISSION),
    ("MIT", "MIT License\n" + _PERMISSION),
    ("MIT", "The MIT License (MIT)\n" + _PERMISSION),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("ISC", _ISC),
    ("ISC", "ISC License\n" + _ISC),
    ("Apache-2.0", _APACHE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0-only", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
]

#: Spellings that matching treats as equal, as whole words of canonical text.
EQUIVALENT: list[tuple[str, str]] = [
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sublicence", "sublicense"),
    ("non infringement", "noninfringement"), ("organisation", "organization"), ("favour", "favor"), ("honour", "honor"),
    ("acknowledgement", "acknowledgment"), ("merchantibility", "merchantability"), ("wilful", "willful"), ("fulfilment", "fulfillment"),
    ("v", "version"), ("https", "http"),
]

COPYRIGHT = r"(?m)^[^A-Za-z0-9\n]*(?:copyright|\(c\)|©|all rights reserved)[^\n]*$"


def canonical(text: Column) -> Column:
    """Lower case without copyright lines, punctuation and extra space, in one spelling. Null: empty."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace(lowered, COPYRIGHT, ""), "&", " and "), r"[^a-z0-9\x{80}-\x{10FFFF}]+", " ")
    out = F.concat(F.lit(" "), F.trim(plain), F.lit(" "))
    for other, usual in EQUIVALENT:
        out = F.replace(out, F.lit(f" {other} "), F.lit(f" {usual} "))
    return F.trim(out)


def digest(text: Column) -> Column:
    """SHA-256 of the canonical text; null where nothing is left."""
    return let(canonical(text), lambda made: F.when(made != "", F.sha2(made, 256)))


def known_digests(spark: SparkSession, licenses: list[tuple[str, str]]) -> DataFrame:
    """(digest, license): one row per digest; the least id wins if two licenses have one canonical text."""
    rows = spark.createDataFrame(licenses, "license string, text string")
    return rows.select(digest(F.col("text")).alias("digest"), "license").filter("digest is not null").groupBy("digest").agg(F.min("license").alias("license"))


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """The license that a whole text is, and those that whole paragraphs or lines of it are.

    The canonical text is hashed and joined to `known` (digest, license) by equality. Besides the whole text, each of its
    paragraphs (between empty lines) and lines is looked up, as notices stand inside other text. Columns: doc_id,
    text_digest (null without words), license (of the whole text or null), notices (sorted ids found in it, the whole
    included), n_notices. Null and empty texts have none; repeated rows come out once; null doc_ids are kept; an empty table
    gives no rows; other columns are ignored.
    """
    base = docs.select("doc_id", "text", text_key().alias("text_key"))
    text = F.coalesce(F.col("text"), F.lit(""))
    units = F.array_distinct(F.concat(F.array(text), F.split(text, r"\n[\x20\t\r]*\n"), F.split(text, "\n")))
    made = F.array_distinct(F.transform(units, canonical))
    digests = F.transform(F.filter(made, lambda m: m != ""), lambda m: F.sha2(m, 256))
    known = small(known, known.count(), 128)
    rows = base.select("doc_id", "text_key", F.explode(digests).alias("digest"))
    found = rows.join(known, "digest").groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set("license")).alias("notices"))
    whole = base.select("doc_id", "text_key", F.coalesce(digest(F.col("text")), F.lit("")).alias("digest")).distinct()
    own = whole.join(known, "digest", "left")
    return on_doc(own, found).select(
        "doc_id", F.when(F.col("digest") != "", F.col("digest")).alias("text_digest"), "license",
        F.coalesce("notices", F.array().cast("array<string>")).alias("notices"), F.coalesce(F.size("notices"), F.lit(0)).cast("long").alias("n_notices"))
