"""Licences recognised by digests of canonical texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Aside, cut, table, whole

# Public licence texts and one-line notices, and spellings that mean the same.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
_UNLICENSE = """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_UNLICENSE_END = "For more information, please refer to <https://unlicense.org>"
_BSL = """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:
The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_0BSD = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n" + _ISC.split("\n", 1)[1]
_MIT_0 = _MIT.split(", subject to")[0] + ".\n" + _MIT.split("\n", 2)[2]
KNOWN = {
    "MIT": [_MIT, "MIT License\n" + _MIT, "The MIT License\n" + _MIT, "The MIT License (MIT)\n" + _MIT, "Released under the MIT License."],
    "MIT-0": [_MIT_0, "MIT No Attribution\n" + _MIT_0],
    "ISC": [_ISC, "ISC License\n" + _ISC],
    "0BSD": [_0BSD, "BSD Zero Clause License\n" + _0BSD],
    "BSD-2-Clause": [_BSD_HEAD + _BSD_TAIL, "BSD 2-Clause License\n" + _BSD_HEAD + _BSD_TAIL],
    "BSD-3-Clause": [_BSD_HEAD + _BSD_THIRD + _BSD_TAIL, "BSD 3-Clause License\n" + _BSD_HEAD + _BSD_THIRD + _BSD_TAIL],
    "BSL-1.0": [_BSL, "Boost Software License - Version 1.0 - August 17th, 2003\n" + _BSL],
    "Unlicense": [_UNLICENSE, _UNLICENSE + "\n" + _UNLICENSE_END],
    "Zlib": [_ZLIB, "zlib License\n" + _ZLIB],
    "Apache-2.0": [_APACHE, "Licensed under the Apache License, Version 2.0."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
}
#: Of longer licences the digests of their canonical texts: whole, and where they have terms and an appendix, up to the end of the terms.
DIGESTS = {
    "Apache-2.0": [
        "04e64e0427d80fdde16fa8415931bf2c09bc943f13ec322a09df188bf23a3543",
        "119e2da0e9ec849d113a40405b338c1bbbd2ef9194c22bf2740fa4e195411c40",
        "824065d72ca31b7c727341396be4cf76f464b15d9bef680a3638007ce92a009f",
    ],
    "Artistic-1.0-Perl": [
        "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702",
    ],
    "CC0-1.0": [
        "cccf7894e1b9f4ba9f97728bf0c5baf9e07bc2ac93da7a51556451b1fb2b868e",
    ],
    "GFDL-1.2": [
        "15f6a8d360ffdecc988c29279c00f23e20de17f14f2a06572ab0d41de6e98b7b",
    ],
    "GFDL-1.3": [
        "2d36daeff2ad303badb6dee8149748be25e22974dd468e1e8a55cf40f16fc01d",
    ],
    "GPL-1.0": [
        "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224",
        "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc",
        "89f75ffda938e788be38679f9f83e317c2a03398fccf03ee60505d44d1bf9f70",
    ],
    "GPL-2.0": [
        "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821",
        "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34",
        "6d332dc4c3c5293a73c6c9da402f9bbc970b3bb1eb472f577e00580573469808",
    ],
    "GPL-3.0": [
        "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a",
        "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636",
        "092a7f3b82e6c22949b46388bca99e725b6e756f1c2b1e3f575447fbd44b6191",
    ],
    "LGPL-2.0": [
        "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908",
        "504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260",
        "430627da7218a92ab4a6d75d5140cdb70ee750be7a53f913299b37e0d1b0eea2",
    ],
    "LGPL-2.1": [
        "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891",
        "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4",
        "bf2f0c6bf1c47b3b1e3cbedeefecddd1e7db21d1919858d45c2f918efaf426df",
    ],
    "LGPL-3.0": [
        "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be",
    ],
    "MPL-1.1": [
        "cbbde7eeab9b4d180dc00b34252f800e97fb1cddbab38ed8c0c73b956dc2cbf6",
    ],
    "MPL-2.0": [
        "6fedd8db6adb0e102fc0f69b9e1501d2edaf25940e34910831cab46f9f5d4e4d",
    ],
}
SAME = {
    "licence": "license", "acknowledgement": "acknowledgment", "authoris": "authoriz", "organis": "organiz", "recognis": "recogniz",
    "favour": "favor", "honour": "honor", "judgement": "judgment", "https": "http", "whilst": "while",
}
#: Spellings of several words, which a line's end may divide.
SAME_ACROSS = {"fulfil ": "fulfill ", "non commercial": "noncommercial", "non infringement": "noninfringement", "sub license": "sublicense", "per cent": "percent", "copyright owner": "copyright holder"}
#: Lines that name who holds the copyright, or since when; not those of a licence that only speak of it, wherever it is wrapped.
COPYRIGHT = (
    r"(?m)^[^\p{L}\n]*(?:(?i:copyright)[ \t:,]*(?:(?i:\(c\))|©|(?i:by\b)|[\[<{]|[12][0-9]{3})|Copyright (?:The )?[A-Z][^\n]*\b(?:Authors|Contributors|Foundation|Inc|Ltd|LLC)\b"
    r"|(?i:\(c\))[ \t]*(?:(?i:copyright)|[12][0-9]{3})|©|(?i:all rights reserved)[^\p{L}\n]*$)[^\n]*$"
)
PUNCTUATION = r"[^\p{L}\p{N}\n]+"


def canonical_lines(text: Column) -> Column:
    """The lines of a text that are left, as array<string>: lower case, no copyright lines, words apart by single spaces, one spelling."""
    low = F.lower(text)
    marked = F.contains(low, F.lit("copyright")) | F.contains(low, F.lit("(c)")) | F.contains(low, F.lit("©")) | F.contains(low, F.lit("all rights reserved"))
    c = F.regexp_replace(F.when(marked, F.lower(F.regexp_replace(text, COPYRIGHT, ""))).otherwise(low), PUNCTUATION, " ")
    for old, new in SAME.items():
        c = F.replace(c, F.lit(old), F.lit(new))
    return F.filter(F.transform(F.split(c, "\n", -1), lambda x: F.btrim(x)), lambda x: x != "")


def _one_spelling(c: Column) -> Column:
    for old, new in SAME_ACROSS.items():
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def canonical_digest(lines: Column) -> Column:
    """SHA-256 of the canonical lines as one, so that where lines end does not matter."""
    return F.sha2(_one_spelling(F.array_join(lines, " ")), 256)


def known_digests(spark: SparkSession, known: dict[str, list[str]] = KNOWN, digests: dict[str, list[str]] = DIGESTS) -> DataFrame:
    """license, text digest and, where the known text is one line, that line's hash. A row for each known text."""
    rows = [F.struct(F.lit(k).alias("license"), F.lit(t).alias("text"), F.lit(None).cast("string").alias("digest")) for k, ts in known.items() for t in ts]
    rows += [F.struct(F.lit(k).alias("license"), F.lit("").alias("text"), F.lit(d).alias("digest")) for k, ds in digests.items() for d in ds]
    given = spark.range(1).select(F.inline(F.array(*rows)))
    lines = given.select("license", "digest", canonical_lines(F.col("text")).alias("_l"))
    hashed = lines.select("license", F.coalesce("digest", canonical_digest(F.col("_l"))).alias("digest"), F.when(F.size("_l") == 1, F.xxhash64(_one_spelling(F.col("_l")[0]))).alias("line"))
    return hashed.groupBy("digest", "line").agg(F.min("license").alias("license"))


def scan_licenses(df: DataFrame, *, text: str = "text", doc_id: str = "doc_id", known: dict[str, list[str]] = KNOWN, digests: dict[str, list[str]] = DIGESTS) -> DataFrame:
    """The columns of df but the text, with digest, license (the known licence that the whole text is, or null) and notices.

    notices lists, as line:licence, the whole lines that are known one-line notices; lines count among those
    that canonical_lines leaves. A null or empty text has the digest of the empty text and is no licence; a
    long text costs its length. Rows alike in id and text get the same, null ids are ids like any other, and
    an empty table gives an empty result. Columns of df named digest, license or notices are replaced; other
    names cannot clash. The known side is a fixed list of this module or the caller's, so it is broadcast.
    Texts are read once and never exchanged: digests and 64-bit line hashes are kept in the shared folder.
    """
    given = Aside(df)
    kept = [c for c, n in zip(given.own, given.names, strict=True) if n.lower() != text.lower()]
    t = whole(given.of(text))
    lined = given.df.select(*kept, given.of(doc_id).alias("_id"), F.xxhash64(t).alias("_th"), canonical_lines(t).alias("_l"))
    units = cut(lined.select(*kept, "_id", "_th", canonical_digest(F.col("_l")).alias("digest"), F.transform("_l", lambda x: F.xxhash64(_one_spelling(x))).alias("_keys")))
    names = known_digests(df.sparkSession, known, digests)
    lines = units.select("_id", "_th", F.posexplode("_keys").alias("_pos", "line"))
    hits = lines.join(F.broadcast(names.where("line is not null").select("line", F.col("license").alias("_name"))), "line")
    notices = hits.groupBy("_id", "_th").agg(F.array_join(F.transform(F.array_sort(F.collect_set(F.struct("_pos", "_name"))), lambda x: F.concat(x["_pos"].cast("string"), F.lit(":"), x["_name"])), ",").alias("notices"))
    notices = notices.withColumnsRenamed({"_id": "_id2", "_th": "_th2"})
    texts = units.join(F.broadcast(names.select("digest", "license").distinct()), "digest", "left")
    joined = texts.join(notices, texts["_id"].eqNullSafe(F.col("_id2")) & (texts["_th"] == F.col("_th2")), "left")
    return joined.select(*given.back(text, "digest", "license", "notices"), "digest", "license", F.coalesce("notices", F.lit("")).alias("notices"))


def op2_license_scans(spark, sf_dir):
    return scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _sql() -> str:
    quoted = ",".join("('%s', '%s')" % (k, t.replace("'", "''")) for k, ts in KNOWN.items() for t in ts)
    long = ",".join(f"('{d}', '{k}')" for k, ds in DIGESTS.items() for d in ds)

    def spelt(c: str, how: dict[str, str]) -> str:
        for old, new in how.items():
            c = f"replace({c}, '{old}', '{new}')"
        return c

    c = spelt("regexp_replace(lower(regexp_replace(t, '%s', '', 'g')), '%s', ' ', 'g')" % (COPYRIGHT, PUNCTUATION), SAME)
    lines = f"[y FOR y IN [trim(x) FOR x IN string_split({c}, chr(10))] IF y <> '']"
    digest = "sha256(%s)" % spelt("array_to_string(l, ' ')", SAME_ACROSS)
    return f"""
WITH known AS (SELECT n, {lines} AS l FROM (VALUES {quoted}) v(n, t)),
digests AS (SELECT digest, min(n) AS license FROM (SELECT {digest} AS digest, n FROM known UNION ALL VALUES {long}) GROUP BY 1),
notes AS (SELECT {spelt('l[1]', SAME_ACROSS)} AS line, min(n) AS n FROM known WHERE len(l) = 1 GROUP BY 1),
d AS (SELECT doc_id, {lines} AS l FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
u AS (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos FROM d),
h AS (SELECT doc_id, string_agg(pos || ':' || n, ',' ORDER BY pos) AS notices FROM (SELECT doc_id, pos, {spelt('line', SAME_ACROSS)} AS line FROM u) JOIN notes USING (line) GROUP BY 1),
w AS (SELECT doc_id, {digest} AS digest FROM d)
SELECT w.doc_id, w.digest, license, coalesce(notices, '') AS notices
FROM w LEFT JOIN digests ON w.digest = digests.digest LEFT JOIN h ON w.doc_id = h.doc_id
"""


OP2_SQL = _sql()
