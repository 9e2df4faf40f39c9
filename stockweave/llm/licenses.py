"""Licence scans by canonical digest.

A text is put into a canonical form (lower case; no punctuation; copyright
lines left out; one spelling for equivalent words; single spaces) and its
SHA-256 is hash-joined with the digests of known licences and notices. Whole
texts are looked up, and every line as a text of its own, as notices mostly
stand on a line. DataFrame functions only. The known table is fixed in this
module and its folder ``license_texts`` (a few hundred rows), so broadcasting
it has a proven bound; a caller's own table of texts is joined without a hint.

A copyright line is told by how the text is broken into lines. The texts of
the folder are known as published and with each paragraph on one line, both
with and without what follows the terms; other line breaks within a clause
that speaks of copyright give another digest.

Defined cases: a null text is empty; an empty canonical form has no licence;
a line is counted as often as it stands in the text; equal rows get equal
results, rows that share a key are kept apart; an empty table gives an empty
result; other input columns are ignored.
"""

from __future__ import annotations

import re
from functools import lru_cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stockweave.llm import common as C

# Published licence texts, names and equivalent spellings.
MIT_BODY = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
ISC_NOTICE = ", provided that the above copyright notice and this permission notice appear in all copies"
ISC_END = """.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
TEXTS = [
    ("MIT", MIT_BODY), ("MIT", "MIT License\n" + MIT_BODY), ("MIT", "The MIT License (MIT)\n" + MIT_BODY),
    ("ISC", ISC_GRANT + ISC_NOTICE + ISC_END), ("ISC", "ISC License\n" + ISC_GRANT + ISC_NOTICE + ISC_END),
    ("0BSD", ISC_GRANT + ISC_END), ("0BSD", "BSD Zero Clause License\n" + ISC_GRANT + ISC_END),
    ("BSD-2-Clause", BSD_HEAD + BSD_END), ("BSD-2-Clause", "BSD 2-Clause License\n" + BSD_HEAD + BSD_END),
    ("BSD-3-Clause", BSD_HEAD + BSD_THIRD + BSD_END), ("BSD-3-Clause", "BSD 3-Clause License\n" + BSD_HEAD + BSD_THIRD + BSD_END),
    ("Zlib", ZLIB), ("Zlib", "zlib License\n" + ZLIB),
]
NAMES = {
    "MIT": ["MIT License", "MIT"],
    "ISC": ["ISC License"],
    "Zlib": ["zlib License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0"],
    "MPL-2.0": ["Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "MPL-2.0"],
    "EPL-2.0": ["Eclipse Public License, Version 2.0", "Eclipse Public License 2.0", "EPL-2.0"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPL v2", "GPL-2.0"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL v3", "GPL-3.0"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "GNU LGPL v3", "LGPL-3.0"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "GNU AGPL v3", "AGPL-3.0"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "CC-BY-NC-SA-4.0": ["CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"],
}
NOTICES = [
    "{}", "Licensed under {}", "Licensed under the {}", "Released under {}", "Released under the {}",
    "This work is licensed under {}", "This work is licensed under the {}", "This work is licensed under a {}",
    "This software is licensed under the {}", "This project is licensed under the {}", "SPDX-License-Identifier: {}",
]
SPELLINGS = [
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sub license", "sublicense"), ("sub licence", "sublicense"),
    ("sublicence", "sublicense"), ("copyright owner", "copyright holder"), ("copyright owners", "copyright holders"),
    ("non commercial", "noncommercial"), ("non infringement", "noninfringement"), ("acknowledgement", "acknowledgment"),
    ("favour", "favor"), ("organisation", "organization"), ("programme", "program"), ("whilst", "while"), ("per cent", "percent"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("recognised", "recognized"), ("wilful", "willful"),
    ("fulfil", "fulfill"), ("judgement", "judgment"), ("defence", "defense"), ("centre", "center"),
]
#: A line that states a copyright or reserves all rights says nothing of the terms.
COPYRIGHT_LINE = r"(?m)^[^\p{L}\p{N}\n]*(?:copyright(?![\p{L} ]*(?:holder|owner|notice))|\(c\)|©|all rights reserved)[^\n]*$"
PUNCTUATION = r"[^\p{L}\p{N}\n]+"


def canonical(text: Column) -> Column:
    """Canonical lines of a text, newlines kept between them."""
    low = F.lower(text)
    plain = F.regexp_replace(low, COPYRIGHT_LINE, "")
    # Most texts have no such line: a look is cheaper than a rewrite.
    low = F.when(low.rlike("copyright|©|\\(c\\)|all rights reserved"), plain).otherwise(low)
    bare = F.regexp_replace(low, PUNCTUATION, " ")
    # Each word stands between spaces of its own, so neighbours can both be replaced.
    alike = F.concat(F.lit(" "), F.replace(F.replace(bare, F.lit(" "), F.lit("  ")), F.lit("\n"), F.lit(" \n ")), F.lit(" "))
    for variant, usual in SPELLINGS:
        alike = F.replace(alike, F.lit(f" {variant.replace(' ', '  ')} "), F.lit(f" {usual.replace(' ', '  ')} "))
    return F.when(bare.rlike("|".join(v for v, _ in SPELLINGS)), alike).otherwise(bare)


def digest(lines: Column) -> Column:
    """Digest of canonical lines as one text; null if nothing is left."""
    one = F.trim(F.regexp_replace(lines, r"[ \n]+", " "))
    return F.when(one != "", F.sha2(one, 256))


@lru_cache(maxsize=1)
def full_texts() -> tuple[tuple[str, str], ...]:
    """(license, text) of the published texts in ``license_texts``, in the forms they are met in."""
    out = []
    for file in sorted((Path(__file__).parent / "license_texts").glob("*.txt")):
        whole = file.read_text(encoding="utf-8")
        terms = re.split(r"(?m)^.*END OF TERMS AND CONDITIONS.*$", whole)[0]
        marked = re.match(r"(?s).*?END OF TERMS AND CONDITIONS", whole)
        for text in dict.fromkeys([whole, terms, marked.group() if marked else whole]):
            out += [(file.stem, text), (file.stem, re.sub(r"(?<!\n)\n[ \t]*(?![ \t\n])", " ", text))]
    return tuple(out)


def known(spark: SparkSession, texts: DataFrame | None = None) -> DataFrame:
    """license, digest of every known text and notice; ``texts`` (license, text) come on top."""
    rows = TEXTS + list(full_texts()) + [(k, n.format(name)) for k, names in NAMES.items() for name in names for n in NOTICES]
    table = F.array(*[F.struct(F.lit(k).alias("license"), F.lit(t).alias("text")) for k, t in rows])
    own = spark.range(1).select(F.explode(table).alias("r")).select("r.license", "r.text")
    if texts is not None:
        own = own.unionByName(texts.select("license", "text"))
    digests = own.select(digest(canonical(F.col("text"))).alias("digest"), "license").filter("digest is not null")
    return digests.groupBy("digest").agg(F.min("license").alias("license"))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", texts: DataFrame | None = None) -> DataFrame:
    """Per document: doc_id, canonical_sha256, license (of the whole text, or null), line_licenses (distinct, sorted,
    joined by a space, null if none) and n_license_lines.

    One pass over the texts leaves a row for each whole text and each line
    that matched; only those are grouped, by a row number given in that pass.
    ``texts``: license, text of further known licences, however many.
    """
    lined = docs.select(
        F.col(key).alias("doc_id"),
        F.monotonically_increasing_id().alias("__row"),
        canonical(F.coalesce(F.col(text), F.lit(""))).alias("__lines"),
    )
    lines = F.filter(F.transform(F.split("__lines", "\n"), digest), lambda d: d.isNotNull())
    units = lined.select("doc_id", "__row", F.posexplode(F.concat(F.array(digest(F.col("__lines"))), lines)).alias("__unit", "digest"))
    table = known(docs.sparkSession, texts)
    matched = units.join(F.broadcast(table) if texts is None else table, "digest", "left").filter("__unit = 0 or license is not null")
    found = C.staged(matched, "licenses")
    whole = F.col("__unit") == 0
    return (
        found.groupBy("__row", "doc_id")
        .agg(
            F.max(F.when(whole, F.col("digest"))).alias("canonical_sha256"),
            F.max(F.when(whole, F.col("license"))).alias("license"),
            F.array_join(F.array_sort(F.collect_set(F.when(~whole, F.col("license")))), " ").alias("__names"),
            F.count(F.when(~whole, F.col("license"))).alias("n_license_lines"),
        )
        .select("doc_id", "canonical_sha256", "license", F.nullif("__names", F.lit("")).alias("line_licenses"), "n_license_lines")
    )
