"""Licence texts recognised by the digest of a canonical form.  DataFrame
operations only.

A text's canonical form: A-Z lower-cased; copyright statements taken out;
punctuation, symbols and white space read as single spaces; equivalent
spellings replaced by one.  The MD5 of the canonical form of an entire text,
and of each of its lines (licence notices and SPDX tags are texts of one
line), is looked up among the digests of the known texts.

The lookup is a hash join with a table of some hundred rows whose size is fixed
by the caller's lists, so Spark broadcasts it; only matches move.  Common lines
or whole texts shared by a third of all documents therefore need no shuffle.

Cases: null and empty texts (and lines without letters or digits) match
nothing; a notice on several lines of one text gives a row for each; repeated
rows give repeated results; an empty table gives an empty result; other
columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COPYRIGHT_MARKS = ("copyright", "(c)", "©", "all rights reserved")
# A copyright statement is told by its form, not by its first word: the mark
# with "(c)", a year or its placeholder behind it, or a whole line "All rights
# reserved"; so a wrapped line of a licence's own wording stays.
COPYRIGHT_STATEMENT = (r"(?imd)^[^\p{L}\p{N}\n]*((copyright[^\p{L}\p{N}\n]*(\(c\)|©|(19|20)\d\d|yyyy|year\b)|\(c\)[^\p{L}\p{N}\n]*(copyright|(19|20)\d\d)|©)[^\n]*"
                       r"|all rights reserved[^\p{L}\p{N}\n]*$)")
NOT_WORD = r"[^\p{L}\p{N}]+"
FIRST_WORD = r"^[^\p{L}\p{N}]*([\p{L}\p{N}]+)"

# Spellings that count as the same word or phrase (whole words
# of the canonical form), the form on the right being the one kept.
SPELLINGS = [
    ("licence|lisence", "license"), ("licenced", "licensed"), ("licences", "licenses"), ("sublicence|sub license|sub licence", "sublicense"),
    ("gplv3", "gpl v3"), ("gplv2", "gpl v2"), ("version", "v"), ("ver", "v"), ("v 3 0|v3 0|v3", "v 3"), ("v 2 0|v2 0|v2", "v 2"), ("v 4 0|v4 0|v4", "v 4"),
    ("gnu general public", "gnu gpl"), ("cc by nc 4 0", "cc by nc v 4"), ("cc by 4 0", "cc by v 4"), ("cc by sa 4 0", "cc by sa v 4"),
    ("copyright owner", "copyright holder"), ("favour", "favor"), ("whilst", "while"), ("acknowledgement", "acknowledgment"),
    ("noncommercial", "non commercial"), ("per cent", "percent"), ("https", "http"),
]

# Known licence texts and one-line notices (public licences).
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_FORMS = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n"
_BSD_TERMS = ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n",
              "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n",
              "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"]
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""


def _bsd(clauses: int, title: bool, numbers: bool) -> str:
    terms = "".join((f"{i}. " if numbers else "") + t for i, t in enumerate(_BSD_TERMS[:clauses], 1))
    return (f"BSD {clauses}-Clause License\n" if title else "") + _BSD_FORMS + terms + _BSD_END


KNOWN = [(f"BSD-{n}-Clause", _bsd(n, title, numbers)) for n in (2, 3) for title in (False, True) for numbers in (False, True)] + [
    ("MIT", "MIT License\n\n" + _MIT), ("MIT", _MIT), ("ISC", "ISC License\n\n" + _ISC), ("ISC", _ISC),
    ("0BSD", _ISC.replace(", provided that the above copyright notice and this permission notice appear in all copies", "")),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."), ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"), ("ISC", "SPDX-License-Identifier: ISC"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."), ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Released under the GPLv3."), ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"), ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."), ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-4.0", "This work is licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."), ("CC-BY-SA-4.0", "This work is licensed under CC BY-SA 4.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."), ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."), ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
]

# Fixed values: (license_id, first word, MD5s of the canonical form) of entire
# licences too long to be held here, printed by ``license_digests``.
DIGESTS = [
    ("Apache-2.0", "apache", "1dc4ebb9c0eabe4c035835fdb5cc4d8f 47c44b4785fba4497366731bb81ead0b c582f81a312f86e9d6c32c064bb3f2dc"),
    ("Artistic-1.0-Perl", "the", "b12e4acbe06ab85dd42a6fa03a228fbd"),
    ("CC0-1.0", "creative", "75ab50d1b17fa1766bf6b4bf801145c3"),
    ("GFDL-1.2", "gnu", "19a2b0d3abf030b6a79c2b6490a55add 390010a516dda1aabba57f00d67e8094 ede3f62f13d007bc2a918f64c85e3aa3"),
    ("GFDL-1.3", "gnu", "15e96f0981aaff721eed7a15233da4c7 3d4ca42ff600eda8285f09f332dccd56 8ac903fb7543b34e81e37f1a1ccd192c"),
    ("GPL-1.0", "gnu", "24cc4db6a6a9e65fba0e3b14791121a2 50c1df338e1bcea44e53744f24ce569f 52ac61b51cb7d8e3e68f07e883710eeb 6f7c6cc0672cfb042c7b0edbc461e7db "
     "c1f4c5431084238120563029c7802c48 cba2027f47934e49dc154c0405f6934b"),
    ("GPL-2.0", "gnu", "0925f84f2d6196871fb5d851bca2812d 100f83dc09b4cd964d7178efeaca3090 335d2766377bebfe119ffe209b55f30b 6c89f53cc31cc701d3030ee45cffdb7b "
     "c90461b432da19a2d8894642c9cb6355 ea958cd2129ffb84557883f35ca89682"),
    ("GPL-3.0", "gnu", "4a13b5d8e26e631cef0b648c14de631c 67a503666761ee1b45df8abb13244da5 6d5f2c3086ca55de270f7d6b40a6b424 ae9307ae6fd9cc0bb169466205128754 "
     "d92fbea74cdd50d66745271bedea9b30 dc808f48cbf054c2512b3f9e939ed24a"),
    ("LGPL-2.0", "gnu", "0c6893733fcc058f895865664cc34f2e 253e4648f82a320a1e898ced30c5635b 363fe38f809c0b6ee28f230925923ec2 a4c8b77a5176ba24e67bb9afb5f91892 "
     "ac9763b143cc33779fc9a4773ba7b83e b9723512fbe5c4aa26bf5049e819ef93"),
    ("LGPL-2.1", "gnu", "64366e4adfb0c115d2431502795591e9 9f519c413e0bd9756de58cdf7ed2ec67 a510ebe760c12d0b005fcd26e3e99296 c2aa973ef077b2f2f1084d7275c2f4b1 "
     "d3d8cd9e750891c68a0d94405d2e5810 e6695b723fd6f6ba9d401b033d89bf16"),
    ("LGPL-3.0", "gnu", "27506ae5db3b467e0ff42c7b5043b784 5a89eae83aa7c3d42e71801ba59db5ee 6450214b60b9d164e97e3c0cbc530742"),
    ("MPL-1.1", "mozilla", "83be7dc04868cd87c8f372cbdf3dc917 e51e8094673bdd4ea29b4e77cecb01c8"),
    ("MPL-2.0", "mozilla", "e4af658e411a2e80ff988134536caeaf"),
    ("Unlicense", "this", "623ba9db93eda8991a1484472514bff3"),
]


def without_copyright(text: Column) -> Column:
    """The text with its copyright statements, each to the end of its line,
    taken out; line breaks stay."""
    lower, marked = F.lower(text), F.lit(False)
    for mark in COPYRIGHT_MARKS:
        marked |= F.contains(lower, F.lit(mark))
    return F.when(marked, F.regexp_replace(text, COPYRIGHT_STATEMENT, "")).otherwise(text)


def canonical(text: Column) -> Column:
    """Lower case, single spaces for all else than letters and digits, none at
    the ends; equivalent spellings replaced."""
    words = F.concat(F.lit(" "), F.btrim(F.regexp_replace(F.translate(text, UPPER, LOWER), NOT_WORD, " "), F.lit(" ")), F.lit(" "))
    for pattern, kept in SPELLINGS:
        words = F.regexp_replace(words, f" ({pattern}) ", f" {kept} ")
    return F.btrim(words, F.lit(" "))


def first_word(text: Column) -> Column:
    return F.translate(F.regexp_extract(text, FIRST_WORD, 1), UPPER, LOWER)


def leads(digests: DataFrame) -> DataFrame:
    """First words that a known text can have in the raw: that of its canonical
    form, or that of any spelling which could have been replaced there."""
    spelled = sorted({alternative.split(" ")[0] for pattern, _ in SPELLINGS for alternative in pattern.split("|")})
    return digests.select("lead").union(digests.sparkSession.createDataFrame([(x,) for x in spelled], "lead string")).distinct()


def known_digests(spark: SparkSession, known: list[tuple[str, str]], digests: list[tuple[str, str, str]] = DIGESTS) -> DataFrame:
    """(digest, license_id, lead), one row per digest: the bounded lookup table."""
    texts = spark.createDataFrame(known or [], "license_id string, text string")
    form = canonical(without_copyright(F.col("text")))
    made = (texts.select("license_id", form.alias("form")).where("form <> ''")
            .select(F.md5(F.col("form").cast("binary")).alias("digest"), "license_id", F.substring_index("form", " ", 1).alias("lead")))
    held = spark.createDataFrame([(d, i, lead) for i, lead, ds in digests for d in ds.split()], "digest string, license_id string, lead string")
    return made.union(held).groupBy("digest").agg(F.min("license_id").alias("license_id"), F.min("lead").alias("lead"))


def license_scan(docs: DataFrame, known: list[tuple[str, str]] = KNOWN, digests: list[tuple[str, str, str]] = DIGESTS) -> DataFrame:
    """Per match: doc_id, unit ('text' or 'line'), line_no (from 0; null for
    the entire text), license_id, digest.

    The first word is looked up before the canonical form is made: a text whose
    first word can begin no known text equals none."""
    lookup = known_digests(docs.sparkSession, known, digests)
    texts = docs.select("doc_id", without_copyright(F.coalesce(F.col("text"), F.lit(""))).alias("body"))
    entire = F.array(F.struct(F.lit("text").alias("unit"), F.lit(None).cast("int").alias("line_no"), F.col("body")))
    single = F.transform(F.split("body", "\n", -1), lambda x, i: F.struct(F.lit("line").alias("unit"), i.alias("line_no"), x.alias("body")))
    units = texts.select("doc_id", F.explode(F.when(F.instr("body", "\n") > 0, F.concat(entire, single)).otherwise(entire)).alias("_"))
    units = units.select("doc_id", "_.unit", "_.line_no", "_.body", first_word(F.col("_.body")).alias("lead"))
    likely = units.join(F.broadcast(leads(lookup)), "lead", "left_semi")
    likely = likely.select("doc_id", "unit", "line_no", F.md5(canonical(F.col("body")).cast("binary")).alias("digest"))
    return likely.join(F.broadcast(lookup.select("digest", "license_id")), "digest").select("doc_id", "unit", "line_no", "license_id", "digest")
