"""Licence scan: whole texts and whole lines against the digests of known licences.

Texts are brought to a canonical form: lower case, no copyright notices (paragraphs of their own, or at
the beginning), runs of anything but letters and digits as one space, and then one spelling for words that
are spelled in several ways. A digest of that form finds a text however it was wrapped, quoted or
punctuated, and a hash join with the known digests names the licence; nothing is compared text by text.

The known texts are licences given in full, long ones by their digests, headers that files carry, and
notices, one line that names a licence, built by rule from openings, names and endings. All are
canonicalised by the same expression. Their number is fixed by this file, which bounds the side that is
broadcast. A caller adds texts or digests of their own as a table.

Per row of the documents: ``digest`` of the canonical text, ``license_id`` if the whole text is a known
licence or notice, and ``notices``, the licences named by its lines, distinct, sorted, joined by a
comma, or null. A null text is empty; an empty text has the digest of the empty form and no licence.
Rows that repeat come back each; an empty table gives an empty result. A very long text is one value of
one row and is read whole. Columns other than doc_id and text, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.sources.shared import written

# Texts of licences, without their copyright lines.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
and associated documentation files (the "Software"), to deal in the Software without restriction,
including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,
and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial
portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN
NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted"""
ISC_NOTICE = """, provided that the above copyright notice and this permission notice appear in all
copies"""
ISC_WARRANTY = """.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE
FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS
OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING
OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
BSD_GRANT = """Redistribution and use in source and binary forms, with or without modification, are
permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and
the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
BSD_NAMES = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission.
"""
BSD_WARRANTY = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR
ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT
LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF
ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will
the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications,
and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
software. If you use this software in a product, an acknowledgment in the product documentation would be
appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the
original software.

3. This notice may not be removed or altered from any source distribution."""
LICENCES = {
    "MIT": ("MIT License", MIT),
    "ISC": ("ISC License", ISC_GRANT + ISC_NOTICE + ISC_WARRANTY),
    "0BSD": ("BSD Zero Clause License", ISC_GRANT + ISC_WARRANTY),
    "BSD-2-Clause": ("BSD 2-Clause License", BSD_GRANT + BSD_WARRANTY),
    "BSD-3-Clause": ("BSD 3-Clause License", BSD_GRANT + BSD_NAMES + BSD_WARRANTY),
    "Zlib": ("zlib License", ZLIB),
}
# How notices name a licence.
LICENCE_NAMES = {
    "MIT": ("MIT License", "MIT"),
    "ISC": ("ISC License", "ISC"),
    "BSD-2-Clause": ("BSD 2-Clause License", "BSD-2-Clause", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "BSD-3-Clause", "New BSD License"),
    "Apache-2.0": (
        "Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0",
    ),
    "MPL-2.0": ("Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "MPL-2.0"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU GPL v2", "GPLv2", "GPL-2.0"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU GPL v3", "GPLv3", "GPL-3.0"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "LGPLv3", "LGPL-3.0"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "AGPLv3", "AGPL-3.0"),
    "CC0-1.0": ("CC0 1.0", "Creative Commons Zero v1.0 Universal"),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": (
        "CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License",
    ),
    "CC-BY-NC-4.0": (
        "CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    "CC-BY-ND-4.0": (
        "CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License",
    ),
}
OPENINGS = tuple(
    f"{what}{how} under {article}"
    for what in ("", "this work is ", "this file is ", "this software is ", "this document is ")
    for how in ("licensed", "released", "distributed", "made available", "published")
    for article in ("", "the ", "a ", "the terms of the ")
) + ("SPDX-License-Identifier: ", "License: ")

ENDINGS = ("", ' (the "License")')
# Headers of files, whole.
HEADERS = {
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this
file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is
distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and limitations under the License.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a
copy of the MPL was not distributed with this file, You can obtain one at
http://mozilla.org/MPL/2.0/.""",
}
GNU_HEADER = """{what} is free software{stop} you can redistribute it and/or modify it under the terms of
the GNU {kind}General Public License as published by the Free Software Foundation{stop} either version
{number} of the License, or (at your option) any later version.

{what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind}General Public
License for more details."""
GNU_HEADERS = {
    "GPL-2.0": ("", "2"), "GPL-3.0": ("", "3"), "LGPL-2.1": ("Lesser ", "2.1"),
    "LGPL-3.0": ("Lesser ", "3"), "AGPL-3.0": ("Affero ", "3"),
}
GNU_ADDRESS = """

You should have received a copy of the GNU {kind}General Public License along with {what}. If not, see
<http://www.gnu.org/licenses/>."""
# Digests of the canonical forms of long licences as published, and without the appendix
# that follows the terms where there is one.
LONG_LICENCES = {
    "Apache-2.0": (
        "ef36af97727268b60fb709836c24580bed9887f649dba6f0fd9ef4b18232fd25",
        "119e2da0e9ec849d113a40405b338c1bbbd2ef9194c22bf2740fa4e195411c40",
    ),
    "CC0-1.0": (
        "cccf7894e1b9f4ba9f97728bf0c5baf9e07bc2ac93da7a51556451b1fb2b868e",
    ),
    "GPL-2.0": (
        "0bfb659bf7eeb9921df1446a6a93beba70e0dc947eec10a42d26bb310dccd498",
        "8607b1cff63e9a9dc468bf76327bdd0bb2d2abe09d6e8076427fd49236f46f29",
    ),
    "GPL-3.0": (
        "0472008b2e64866eb1db6471e76fc0cc3cf742180a15ea30a01655e5d9952441",
        "4daf25711475345bba3326eb65ac074ad13b96798bf4bd295a284f56837f3ac0",
    ),
    "LGPL-2.1": (
        "a9cc8dda4023821e198a2e1bee36afc3e68fce90828780c7bac37ffe33565e15",
        "f13ce8aa4b0cc0de7c3b73a95e705f217972ef8710e7c0a463342682e2e523de",
    ),
    "LGPL-3.0": (
        "ab1202917a49a52eb4671fc091c00933076c119053fff6e8b5849ca93d6b53b3",
    ),
    "MPL-1.1": (
        "b4fb601cd1d708fd4d48958cfaecb8bb919d60af95b4704afb85d1a886f8b303",
    ),
    "MPL-2.0": (
        "12274540925f246f7614a52b7ebddfbe0463ff1ab194088c554c73552c45582d",
    ),
}

# Spellings that count as equal, as patterns over canonical words.
SPELLINGS = (
    (r"licenc(e|es|ed|ing|ee|or)\b", "licens$1"),
    (r"\bsub licens", "sublicens"),
    (r"\bnon (commercial|infring)", "non$1"),
    (r"\b(author|organ|recogn|util|real|maxim|minim|optim|initial|emphas)is(e|ation|ing)", "$1iz$2"),
    (r"\b(fav|lab|behavi|hon)our", "$1or"),
    (r"\backnowledgement", "acknowledgment"),
    (r"\b(judg)ement", "$1ment"),
    (r"\bfulfil\b", "fulfill"),
    (r"\bwhilst\b", "while"),
    (r"\bcopyright owner", "copyright holder"),
    (r"\bhttps\b", "http"),
)
# How a copyright notice begins, and how many words it has at most.
NOTICE_SIGN = r"(?:copyright|\(c\)|©)"
NOTICE = rf"^[^\p{{L}}\p{{N}}©(]*{NOTICE_SIGN}(?:[ \t,:]*{NOTICE_SIGN})*[ \t,:]*(?:19|20)[0-9]{{2}}"
RESERVED = r"^[^\p{L}\p{N}]*all rights reserved[^\p{L}\p{N}]*$"
NOTICE_WORDS = 20


def _respelled(form: Column) -> Column:
    for pattern, spelling in SPELLINGS:
        form = F.regexp_replace(form, pattern, spelling)
    return form


def _is_notice(line: Column) -> Column:
    few = F.size(F.regexp_extract_all(line, F.lit(r"[\p{L}\p{N}]+"), F.lit(0))) <= NOTICE_WORDS
    return (line.rlike(NOTICE) & few) | line.rlike(RESERVED)


def without_notices(lower: Column) -> Column:
    """A lower-case text without paragraphs of copyright notices, and without those it begins with.

    A notice is a line of few words that begins with the sign or word and a year. Lines of running text
    stay whatever they begin with, so how a text is wrapped makes no difference.
    """
    broken = F.regexp_replace(lower, r"(?m)^[^\p{L}\p{N}\n]+$", "")
    paragraphs = F.filter(
        F.split(broken, r"\n{2,}"),
        lambda part: ~F.forall(F.split(F.trim(part, F.lit("\n")), "\n"), _is_notice),
    )
    first = F.split(F.trim(F.get(paragraphs, 0), F.lit("\n")), "\n")
    begin = F.array_position(F.transform(first, _is_notice), False).cast("int")
    head = F.array_join(F.slice(first, begin, F.size(first)), "\n")
    rest = F.slice(paragraphs, 2, F.greatest(F.size(paragraphs) - 1, F.lit(0)))
    kept = F.when(F.size(paragraphs) > 0, F.array_join(F.concat(F.array(head), rest), "\n\n"))
    return F.coalesce(kept, F.lit(""))


def canonical_forms(rows: DataFrame, text: Column, *names: str) -> DataFrame:
    """``(*names, form, by_line)``: the canonical form of the whole text, and that of each line with the
    line ends kept.

    The form are the words of the text, one spelling each, joined by single spaces. Lines are joined before
    words are respelled, so that a term that a line end cuts is found. What is read more than once is a
    column of its own before it is read, so it is computed once.
    """
    lower = rows.select(*names, F.lower(text).alias("_lower"))
    plain = lower.select(
        *names, "_lower", F.regexp_replace("_lower", r"[^\p{L}\p{N}\n]+", " ").alias("_lines")
    )
    # Most texts hold no sign of a notice.
    signs = [F.contains("_lower", F.lit(s)) for s in ("copyright", "(c)", "©", "all rights reserved")]
    some = signs[0] | signs[1] | signs[2] | signs[3]
    kept = F.regexp_replace(without_notices(F.col("_lower")), r"[^\p{L}\p{N}]+", " ")
    words = F.when(some, kept).otherwise(F.regexp_replace("_lines", r"[ \n]+", " "))
    joined = plain.select(*names, "_lines", F.trim(words).alias("_words"))
    # Few texts hold a word to respell.
    any_of = "|".join(pattern for pattern, _ in SPELLINGS)
    odd = joined.select("*", F.col("_words").rlike(any_of).alias("_odd"))

    def spelled(form: str) -> Column:
        return F.when(F.col("_odd"), _respelled(F.col(form))).otherwise(F.col(form))

    return odd.select(*names, spelled("_words").alias("form"), spelled("_lines").alias("by_line"))


def known_texts(spark: SparkSession) -> DataFrame:
    """``(license_id, form)``: every known text in canonical form."""
    rows = [
        (name, text)
        for name, (title, body) in LICENCES.items()
        for text in (body, f"{title}\n\n{body}")
    ]
    rows += [
        (name, opening + written_name + ending)
        for name, names in LICENCE_NAMES.items()
        for written_name in names
        for opening in OPENINGS
        for ending in ENDINGS
    ]
    rows += list(HEADERS.items())
    for name, (kind, number) in GNU_HEADERS.items():
        for what in ("This program", "This library", "This file"):
            given = {"what": what, "kind": kind, "number": number}
            header, address = GNU_HEADER.format(stop=";", **given), GNU_ADDRESS.format(**given)
            rows += [(name, header), (name, header + address)]
            rows += [(name, header + address.replace("with {what}".format(**given), f"with {what.lower()}"))]
    known = spark.createDataFrame(rows, "license_id string, text string")
    first = F.min("license_id").alias("license_id")
    return canonical_forms(known, F.col("text"), "license_id").groupBy("form").agg(first)


def known_digests(spark: SparkSession, known: DataFrame | None = None) -> DataFrame:
    """``(license_id, digest, line)``, a row per digest: the texts and digests of this file, and those of
    ``known (license_id, text, digest)``, where the text or the digest is null. The line is null where
    only the digest is known. An empty text names nothing."""
    long = [(name, digest) for name, digests in LONG_LICENCES.items() for digest in digests]
    digests = spark.createDataFrame(long, "license_id string, digest string")
    forms = known_texts(spark)
    if known is not None:
        given = known.where("text IS NOT NULL")
        own = canonical_forms(given, F.col("text"), "license_id")
        forms = forms.unionByName(own.select("license_id", "form"))
        digests = digests.unionByName(
            known.where("text IS NULL AND digest IS NOT NULL").select("license_id", F.lower("digest").alias("digest"))
        )
    texts = forms.where("form <> ''").select(
        "license_id",
        F.sha2(F.col("form").cast("binary"), 256).alias("digest"),
        F.xxhash64("form").alias("line"),
    )
    both = texts.unionByName(digests.withColumn("line", F.lit(None).cast("bigint")))
    return both.groupBy("digest").agg(F.min("license_id").alias("license_id"), F.max("line").alias("line"))


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``(doc_id, digest, license_id, notices)``, a row per row of ``docs``.

    ``known (license_id, text, digest)`` are further licences, see ``known_digests``.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    forms = canonical_forms(docs, text, "doc_id")
    lines = F.transform(F.split("by_line", "\n"), lambda line: F.xxhash64(F.trim(line)))
    rows = written(
        forms.select(
            "doc_id",
            F.sha2(F.col("form").cast("binary"), 256).alias("digest"),
            F.array_distinct(lines).alias("lines"),
        ),
        "canonical",
    )
    digests = known_digests(spark, known)
    by_digest = digests.select("digest", "license_id")
    by_line = digests.where("line IS NOT NULL").select("line", "license_id")
    if known is None:
        # A fixed number of rows, see above.
        by_digest, by_line = F.broadcast(by_digest), F.broadcast(by_line)
    named = (
        rows.select("doc_id", "digest", F.explode("lines").alias("line"))
        .join(by_line, "line")
        .groupBy(F.col("doc_id").alias("d"), F.col("digest").alias("g"))
        .agg(F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("notices"))
    )
    whole = rows.select("doc_id", "digest").join(by_digest, "digest", "left")
    same = whole["doc_id"].eqNullSafe(named["d"]) & (whole["digest"] == named["g"])
    return whole.join(named, same, "left").select("doc_id", "digest", "license_id", "notices")
