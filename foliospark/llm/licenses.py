"""License scans: canonical texts, digested and hash-joined to known licences.

Only DataFrame functions: a text is lower-cased (A-Z), copyright lines go,
equivalent spellings become one, everything but letters and digits becomes one
space, and the SHA-256 of what is left is looked up among the digests of known
texts. A whole text is compared with whole licences; each of its lines is
compared with known licence notices. A copyright line begins with "copyright",
"(c)" or "©" and goes on with one of these signs, a year or a place for one;
other lines that begin so, as where body text is wrapped, stay. The table is
read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Patterns and what they become, in this order, on lower-cased text.
# They are written so that Java and RE2 read them alike; {1} and {2} are groups.
RULES = [
    (r"(^|\n)[^a-z0-9\n(©]*(?:copyright[ \t:]*(?:\(c\)|©|[0-9]{4}|[<\[{]*(?:year|yyyy|date))|(?:\(c\)|©)[ \t]*(?:copyright|[0-9]{4}))[^\n]*", "{1}"),
    (r"[^a-z0-9]+", " "),
    (r"(^| )all rights reserved\b", ""),
    (r"\b(sub|re)?licenc(e|es|ed|ing|ee|or)\b", "{1}licens{2}"),
    (r"\b(authori|organi|recogni|customi|utili|initiali)s(e|ed|es|ing|ation|ations)\b", "{1}z{2}"),
    (r"\b(fav|behavi|col|hon)our", "{1}or"),
    (r"\bnon infring", "noninfring"),
    (r"\bcopyright owner", "copyright holder"),
    (r"\bhttps\b", "http"),
]

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."""
_ZERO = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."""
_ISC_END = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_THREE = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""

_UNLICENSE = """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
For more information, please refer to <https://unlicense.org>"""

# Whole licences, without their titles.
LICENSES = [
    ("MIT", _MIT),
    ("MIT", "MIT License\n" + _MIT),
    ("MIT", "The MIT License (MIT)\n" + _MIT),
    ("ISC", _ISC + "\n" + _ISC_END),
    ("ISC", "ISC License\n" + _ISC + "\n" + _ISC_END),
    ("0BSD", _ZERO + "\n" + _ISC_END),
    ("BSD-2-Clause", _BSD + "\n" + _BSD_END),
    ("BSD-2-Clause", "BSD 2-Clause License\n" + _BSD + "\n" + _BSD_END),
    ("BSD-3-Clause", "\n".join([_BSD, _BSD_THREE, _BSD_END])),
    ("BSD-3-Clause", "\n".join(["BSD 3-Clause License", _BSD, _BSD_THREE, _BSD_END])),
    ("Zlib", _ZLIB),
    ("Zlib", "zlib License\n" + _ZLIB),
    ("Unlicense", _UNLICENSE),
]
# Digests of the canonical forms of long licences, as their stewards publish the texts
# (Apache-2.0 also without its appendix).
DIGESTS = [
    ("Apache-2.0", "04e64e0427d80fdde16fa8415931bf2c09bc943f13ec322a09df188bf23a3543"),
    ("Apache-2.0", "824065d72ca31b7c727341396be4cf76f464b15d9bef680a3638007ce92a009f"),
    ("Apache-2.0", "119e2da0e9ec849d113a40405b338c1bbbd2ef9194c22bf2740fa4e195411c40"),
    ("GPL-2.0", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-3.0", "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-2.0", "12274540925f246f7614a52b7ebddfbe0463ff1ab194088c554c73552c45582d"),
    ("CC0-1.0", "cccf7894e1b9f4ba9f97728bf0c5baf9e07bc2ac93da7a51556451b1fb2b868e"),
    ("Artistic-1.0", "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702"),
    ("MPL-1.1", "c723f1c8033214c990abc66d271f80fce0ec8b02e61de8e6af2f8368a0e6727b"),
    ("GPL-1.0", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("LGPL-2.0", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("GFDL-1.3", "a92fdbaeafedd9cbeb812ebbded06ee07e3b1427c81cfc333e682109c594d826"),
]
# Licence notices of one line.
NOTICES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\")"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
]


def canonical(text: Column) -> Column:
    """The canonical form of a text; null stays null."""
    text = F.translate(text, _UPPER, _LOWER)
    (lines, none), *rules = [(p, new.replace("{1}", "$1").replace("{2}", "$2")) for p, new in RULES]
    marked = F.contains(text, F.lit("copyright")) | F.contains(text, F.lit("(c)")) | F.contains(text, F.lit("©"))
    text = F.when(marked, F.regexp_replace(text, lines, none)).otherwise(text)  # the first rule looks at every line
    for pattern, new in rules:
        text = F.regexp_replace(text, pattern, new)
    return F.trim(text)


def digest(text: Column) -> Column:
    """Hex SHA-256 of the canonical form; null where nothing is left of the text."""
    form = canonical(text)
    return F.when(form != "", F.sha2(form, 256))


def known(spark: SparkSession, texts: list[tuple[str, str]]) -> DataFrame:
    """(license_id, digest) of (license_id, text) pairs; of equal digests the smallest id."""
    return spark.createDataFrame(texts, "license_id string, text string").groupBy(digest(F.col("text")).alias("digest")).agg(F.min("license_id").alias("license_id")).where("digest is not null")


def whole_licenses(spark: SparkSession) -> DataFrame:
    """(license_id, digest) of the licences that are known as whole texts."""
    return known(spark, LICENSES).select("license_id", "digest").unionByName(spark.createDataFrame(DIGESTS, "license_id string, digest string"))


def scan(docs: DataFrame, licenses: DataFrame | None = None, notices: DataFrame | None = None) -> DataFrame:
    """One row for each doc_id: doc_id, text_digest, license_id, notice_ids.

    ``license_id`` names the licence whose canonical text the whole document
    is, else null; ``notice_ids`` lists, sorted and joined by commas, the
    licences that lines of it give notice of. ``licenses`` and ``notices`` are
    DataFrames (license_id, digest), of any size; the built-in ones by default.

    Null, empty and letterless texts have a null digest and match nothing. Rows
    that repeat a doc_id count as one document (the smallest digest, the
    smallest license_id, all notices). Rows with a null doc_id make one row.
    Very long texts are matched whole. Only ``doc_id`` and ``text`` are read.
    """
    spark = docs.sparkSession
    licenses = whole_licenses(spark) if licenses is None else licenses.select("license_id", "digest")
    lines = F.split("text", "\n")
    if notices is None:  # lines that "licens", "licenc" are not in can't be a built-in notice
        notices, lines = known(spark, NOTICES), F.filter(lines, lambda x: x.rlike("(?i)licen[sc]"))
    of = lambda df, kind: df.groupBy("digest").agg(F.min("license_id").alias("id")).select(F.lit(kind).alias("of"), F.col("digest").alias("known"), "id")
    targets = of(licenses, "text").unionByName(notices.select(F.lit("line").alias("of"), F.col("digest").alias("known"), F.col("license_id").alias("id")))
    parts = F.concat(F.array(F.struct(F.lit("text").alias("kind"), F.col("text").alias("part"))), F.coalesce(F.transform(lines, lambda x: F.struct(F.lit("line").alias("kind"), x.alias("part"))), F.array()))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.explode(parts).alias("p")).select("doc_id", "p.kind", digest(F.col("p.part")).alias("digest"))
    found = rows.join(targets, (F.col("kind") == F.col("of")) & (F.col("digest") == F.col("known")), "left")
    whole = F.col("kind") == "text"
    found = found.groupBy("doc_id").agg(F.min(F.when(whole, F.col("digest"))).alias("text_digest"), F.min(F.when(whole, F.col("id"))).alias("license_id"), F.collect_set(F.when(~whole, F.col("id"))).alias("ids"))
    return found.select("doc_id", "text_digest", "license_id", F.array_join(F.array_sort("ids"), ",").alias("notice_ids"))


def sql(documents: str = "documents") -> str:
    """:func:`scan` in DuckDB's SQL."""
    quote = lambda t: "'" + t.replace("'", "''") + "'"

    def form(x: str) -> str:
        x = f"translate({x}, '{_UPPER}', '{_LOWER}')"
        for pattern, new in RULES:
            x = f"regexp_replace({x}, {quote(pattern)}, {quote(new.replace('{1}', chr(92) + '1').replace('{2}', chr(92) + '2'))}, 'g')"
        return f"trim({x})"

    def values(texts: list[tuple[str, str]]) -> str:
        return ", ".join(f"({quote(i)}, {quote(t)})" for i, t in texts)

    def held(name: str, texts: list[tuple[str, str]]) -> str:
        return f"{name} AS (SELECT sha256(form) AS digest, min(license_id) AS license_id FROM (SELECT license_id, {form('text')} AS form FROM (VALUES {values(texts)}) v(license_id, text)) GROUP BY 1)"

    return f"""
WITH {held("short_licenses", LICENSES)}, {held("notices", NOTICES)},
licenses AS (SELECT digest, min(license_id) AS license_id FROM (SELECT digest, license_id FROM short_licenses UNION ALL VALUES {", ".join(f"({quote(d)}, {quote(i)})" for i, d in DIGESTS)}) GROUP BY 1),
forms AS (SELECT doc_id, {form("text")} AS form FROM {documents}),
whole AS (SELECT doc_id, CASE WHEN form <> '' THEN sha256(form) END AS digest FROM forms),
matched AS (SELECT w.doc_id, min(w.digest) AS text_digest, min(l.license_id) AS license_id FROM whole w LEFT JOIN licenses l ON w.digest = l.digest GROUP BY w.doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM {documents}),
line_forms AS (SELECT doc_id, {form("line")} AS form FROM lines WHERE regexp_matches(line, '(?i)licen[sc]')),
found AS (SELECT f.doc_id, string_agg(DISTINCT n.license_id, ',' ORDER BY n.license_id) AS notice_ids FROM line_forms f JOIN notices n ON f.form <> '' AND sha256(f.form) = n.digest GROUP BY f.doc_id)
SELECT m.doc_id, m.text_digest, m.license_id, coalesce(f.notice_ids, '') AS notice_ids
FROM matched m LEFT JOIN found f ON m.doc_id IS NOT DISTINCT FROM f.doc_id
"""
