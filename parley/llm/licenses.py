"""License scan by canonical digest: DataFrame functions only.

A text and each of its lines are brought to a canonical form (case, punctuation, copyright lines, equivalent
spellings); entire texts are joined by digest to the known licence texts, and entire lines to the known one-line
notices. The known table has a fixed size, KNOWN and DIGESTS below, so it is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

# Public licence texts and the usual one-line notices.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
ISC_REST = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
BSD_THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
UNLICENSE = """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
For more information, please refer to <http://unlicense.org/>"""
BOOST = """Boost Software License - Version 1.0 - August 17th, 2003
Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:
The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
KNOWN = [
    ("Unlicense", UNLICENSE),
    ("BSL-1.0", BOOST),
    ("MIT", "MIT License\n" + MIT),
    ("MIT", "The MIT License (MIT)\n" + MIT),
    ("MIT", MIT),
    ("ISC", "ISC License\n" + ISC_GRANT + ", provided that the above copyright notice and this permission notice appear in all copies.\n" + ISC_REST),
    ("ISC", ISC_GRANT + ", provided that the above copyright notice and this permission notice appear in all copies.\n" + ISC_REST),
    ("0BSD", ISC_GRANT + ".\n" + ISC_REST),
    ("BSD-2-Clause", "\n".join([BSD_HEAD, BSD_TAIL])),
    ("BSD-3-Clause", "\n".join([BSD_HEAD, BSD_THIRD, BSD_TAIL])),
    ("Zlib", ZLIB),
    ("Apache-2.0", APACHE_NOTICE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License 2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License v3.0"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
]
#: Of full texts as their publishers give them: SHA-256 of the canonical words.
DIGESTS = [
    ("Apache-2.0", "1072bf8e6b124a462143825bb4174a903d78d4f02f88d6d7b21c9fe3b0d5ec37"),
    ("GPL-1.0", "b4583e68db0c858fa1b9028c689e3bddd78f836f274e963327fa158ec729531d"),
    ("GPL-2.0", "8ceef37851021afc07e4d5138e4c1c58b285e876796ca1a6cfa5eaa9ffaea599"),
    ("GPL-3.0", "b4c42912d85182abb09e39f33b791d93201ac133838d0f9972b735a3e52acbff"),
    ("LGPL-2.0", "f917eb230a461b72c0d7845f5737ef74651abb0524547082a9645bc154d5ecd4"),
    ("LGPL-2.1", "06f44ebf9515e6c412985cf8f2c6b133e91f457a1f520a900164472a54c1dc58"),
    ("LGPL-3.0", "99c1a85dc9c673acfd6a330c4a68bd319185c3d6b8f4888157bf159e2ee60285"),
    ("MPL-1.1", "0236badbb144d8d61046208ce82219cd2edde11f12de18d53139ce59e41dda4f"),
    ("MPL-2.0", "3c7d13b57944d2c12bc1828087d106d9d301aa0b3b8aaf9145d9f81cbf444e4d"),
    ("CC0-1.0", "92f195ae84ff559b03177551e6c1166f57d3cc30f5a7d806b4039e24906bd8de"),
    ("GFDL-1.2", "1dd1a849fa2dc97e0f44bcd0633120fb93af5b40e715825dfcc41c3c488b9ec7"),
    ("GFDL-1.3", "f148d4624171c7c783ac40301fe48f5ed02e4b3a205d0e4fa348b4f180a7f371"),
    ("Artistic-1.0", "4830b8c89ffe1c2d5a0734390441c41e05f2ab57847fd3e8612e425d9af2c2fe"),
]
#: Spellings that count as the same word or phrase, between single spaces.
SAME = [
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sublicence", "sublicense"), ("sub license", "sublicense"),
    ("acknowledgement", "acknowledgment"), ("organisation", "organization"), ("authorised", "authorized"), ("favour", "favor"), ("fulfil", "fulfill"),
    ("non commercial", "noncommercial"), ("non infringement", "noninfringement"), ("copyright owner", "copyright holder"), ("copyright owners", "copyright holders"),
    ("per cent", "percent"), ("https", "http"), ("version", "v"), ("v 3 0", "v 3"), ("v 2 0", "v 2"), ("v3 0", "v 3"), ("v3", "v 3"), ("v2", "v 2"),
]
QUOTES, PLAIN = "‘’‚“”„–—‐‑", "''''''----"
#: Capitals of the Latin, Greek and Cyrillic scripts and their small letters.
CAPITALS = "".join(chr(c) for c in range(0x41, 0x530) if len(chr(c).lower()) == 1 and chr(c).lower() != chr(c))
SMALL = CAPITALS.lower()
#: Lines that name owners, not terms, after lower-casing and the change of signs; `^` and `$` are ends of lines.
OWNER = r"^[^a-z0-9\n]*(copyright [^a-z\n]*[0-9(][^\n]*|copyright \(c\)[^\n]*|\(c\) [^\n]*|all rights reserved[^a-z0-9\n]*)$"
OWNER_SIGNS = ("copyright ", "(c)", "all rights reserved")
#: All but letters, digits and line ends; beyond Latin, blocks that hold signs only.
NOT_WORD = r"[^a-z0-9\n\x{AA}\x{B5}\x{BA}\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{1FFF}\x{2C00}-\x{2DFF}\x{3040}-\x{FDFF}\x{FE70}-\x{FEFE}\x{FF10}-\x{FF19}\x{FF21}-\x{FF3A}\x{FF41}-\x{FF5A}\x{FF66}-\x{FFDC}\x{10000}-\x{10FFFF}]+"


def doubled(phrase: str) -> str:
    return f" {phrase.replace(' ', '  ')} "


def canonical(rows: DataFrame, text: str) -> DataFrame:
    """Replaces column `text` by `lines`, the lines as words in lower case between single spaces, with one at either
    end, and `whole`, the words of all lines. Owner lines become blank. Each pass is a column of its own, made once."""
    rest = [c for c in rows.columns if c != text]
    low = F.translate(F.coalesce(F.col(text), F.lit("")), QUOTES + CAPITALS, PLAIN + SMALL)
    rows = rows.select(*rest, F.concat(F.lit("\n"), F.replace(low, F.lit("©"), F.lit("(c)")), F.lit("\n")).alias("low"))
    owned = F.contains("low", F.lit(OWNER_SIGNS[0])) | F.contains("low", F.lit(OWNER_SIGNS[1])) | F.contains("low", F.lit(OWNER_SIGNS[2]))
    rows = rows.select(*rest, F.when(owned, F.regexp_replace("low", "(?md)" + OWNER, "")).otherwise(F.col("low")).alias("low"))
    spaced = F.replace(F.regexp_replace("low", NOT_WORD, " "), F.lit("\n"), F.lit(" \n "))
    spaced = F.replace(F.replace(spaced, F.lit("   "), F.lit(" ")), F.lit("  "), F.lit(" "))  # a line without words has three
    # two spaces between words while spellings change, so that neighbours don't share one
    out = F.replace(spaced, F.lit(" "), F.lit("  "))
    for was, now in SAME:
        out = F.replace(out, F.lit(doubled(was)), F.lit(doubled(now)))
    rows = rows.select(*rest, F.replace(out, F.lit("  "), F.lit(" ")).alias("out"))
    return rows.select(*rest, F.split("out", "\n", -1).alias("lines"), F.trim(F.replace("out", F.lit("\n "), F.lit(""))).alias("whole"))


def known_licenses(spark) -> DataFrame:
    """`digest, license_id, line`: of KNOWN and DIGESTS; `line` is the canonical line of notices of one line, else null."""
    known = canonical(spark.createDataFrame(KNOWN, "license_id string, known string"), "known")
    lines = F.filter("lines", lambda x: x != " ")
    known = known.select(F.sha2("whole", 256).alias("digest"), "license_id", F.when(F.size(lines) == 1, lines[0]).alias("line"))
    return known.unionAll(spark.createDataFrame([(d, i, None) for i, d in DIGESTS], "digest string, license_id string, line string")).distinct()


def scan_licenses(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id, text_digest, license_id, notice_ids`, one row per row of `docs`.

    `license_id` names the known licence that the entire text is, or is null. `notice_ids` is the sorted array of the
    licences of which an entire line is a notice, or empty. Null and empty texts have the digest of the empty string
    and match nothing, as does a text of owner lines only. Ids may be null or repeated; other columns are not read.
    `known` must be small (here fewer than 100 rows); digests in it are distinct.
    """
    # array_intersect and map lookups work on literals of the known notices: no rows are exploded
    notices = known.filter("line IS NOT NULL").agg(
        F.map_from_entries(F.collect_list(F.struct("line", "license_id"))).alias("notice_of")
    )
    rows = canonical(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text").join(F.broadcast(notices))
    hit = F.array_intersect("lines", F.map_keys("notice_of"))
    rows = rows.select("doc_id", F.sha2("whole", 256).alias("text_digest"), hit.alias("hit"), "notice_of").select(
        "doc_id",
        "text_digest",
        F.array_sort(F.array_distinct(F.transform("hit", lambda x: F.element_at("notice_of", x)))).alias("notice_ids"),
    )
    texts = known.select(F.col("digest").alias("text_digest"), "license_id")
    return rows.join(F.broadcast(texts), "text_digest", "left").select("doc_id", "text_digest", "license_id", "notice_ids")


def op5_license_scan(spark, sf_dir):
    found = scan_licenses(table(spark, sf_dir, "documents"), known_licenses(spark))
    return found.withColumn("notice_ids", F.array_join("notice_ids", ","))


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_canonical(text: str) -> str:
    low = f"(chr(10) || replace(translate(translate(coalesce({text}, ''), {quoted(QUOTES)}, {quoted(PLAIN)}), '{CAPITALS}', '{SMALL}'), '©', '(c)') || chr(10))"
    out = f"replace(replace(replace(replace(regexp_replace(regexp_replace({low}, {quoted('(?m)' + OWNER)}, '', 'g'), '{NOT_WORD}', ' ', 'g'), chr(10), ' ' || chr(10) || ' '), '   ', ' '), '  ', ' '), ' ', '  ')"
    for was, now in SAME:
        out = f"replace({out}, '{doubled(was)}', '{doubled(now)}')"
    return f"replace({out}, '  ', ' ')"


SQL = f"""
WITH known_texts(license_id, known) AS (VALUES {", ".join(f"({quoted(i)}, {quoted(t)})" for i, t in KNOWN)}),
known_out AS (SELECT license_id, {sql_canonical("known")} AS out FROM known_texts),
known_lines AS (SELECT license_id, out, list_filter(string_split(out, chr(10)), lambda l: l <> ' ') AS lines FROM known_out),
known AS (
  SELECT DISTINCT license_id, sha256(trim(replace(out, chr(10) || ' ', ''), ' ')) AS digest, CASE WHEN len(lines) = 1 THEN lines[1] END AS line
  FROM known_lines
  UNION SELECT license_id, digest, NULL FROM (VALUES {", ".join(f"('{i}', '{d}')" for i, d in DIGESTS)}) full_texts(license_id, digest)),
doc_out AS (SELECT row_number() OVER () AS r, doc_id, {sql_canonical("text")} AS out FROM documents),
digests AS (SELECT r, doc_id, string_split(out, chr(10)) AS lines, sha256(trim(replace(out, chr(10) || ' ', ''), ' ')) AS text_digest FROM doc_out),
hits AS (
  SELECT r, string_agg(DISTINCT k.license_id, ',' ORDER BY k.license_id) AS ids
  FROM (SELECT r, unnest(lines) AS line FROM digests) d JOIN known k ON d.line = k.line GROUP BY r)
SELECT d.doc_id, d.text_digest, k.license_id, coalesce(h.ids, '') AS notice_ids
FROM digests d LEFT JOIN known k ON k.digest = d.text_digest LEFT JOIN hits h ON h.r = d.r
"""
