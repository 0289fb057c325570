"""Licence scans by canonical digests of entire texts.

A text is made canonical: copyright lines out, lower case, equivalent spellings replaced,
everything but letters and digits turned to single blanks. Its SHA-256 digest is joined to the
digests of known licences. The units are a document's whole text and each of its lines, as
licence statements stand in lines of their own.

The known texts are a parameter; their number is checked before their digests are broadcast, and
larger collections are joined by a shuffle. Lines without a licence never leave their task.

Defined results: a null text is an empty text, which matches nothing; a document with several
licences lists them all in order, one that repeats a line names it once but counts all; known texts that are
equal when canonical are all named; repeated rows give repeated results; an empty table gives
no rows. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of known texts up to which their digests (about 100 bytes each) are broadcast.
BROADCAST_ROWS = 10_000

# Spellings that count as equal, as whole words, and what opens a copyright line.
SPELLINGS = (
    ("licence", "license"), ("licenced", "licensed"), ("licences", "licenses"), ("acknowledgement", "acknowledgment"), ("analogue", "analog"),
    ("analyse", "analyze"), ("artefact", "artifact"), ("authorisation", "authorization"), ("authorised", "authorized"), ("behaviour", "behavior"),
    ("calibre", "caliber"), ("cancelled", "canceled"), ("capitalisations", "capitalizations"), ("catalogue", "catalog"), ("centre", "center"),
    ("customised", "customized"), ("emphasised", "emphasized"), ("favour", "favor"), ("favourite", "favorite"), ("fulfil", "fulfill"),
    ("initialise", "initialize"), ("judgement", "judgment"), ("labelling", "labeling"), ("noncommercial", "non commercial"),
    ("organisation", "organization"), ("organise", "organize"), ("practise", "practice"), ("programme", "program"), ("realise", "realize"),
    ("recognise", "recognize"), ("signalling", "signaling"), ("sublicence", "sublicense"), ("utilisation", "utilization"), ("whilst", "while"),
    ("wilful", "willful"), ("https", "http"),
)
COPYRIGHT_LINE = r"(^|\n)[ \t#*/;-]*(copyright|\(c\)|©|all rights reserved)[^\n]*"

# Public licence texts and the statements that name a licence.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
"""
_NO_WARRANTY = """
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
_BSD_WARRANTY = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
KNOWN = (
    ("MIT", _MIT),
    ("MIT", "MIT License\n\n" + _MIT),
    ("MIT", "The MIT License (MIT)\n\n" + _MIT),
    ("ISC", _ISC + _NO_WARRANTY),
    ("ISC", "ISC License\n\n" + _ISC + _NO_WARRANTY),
    ("BSD-2-Clause", _BSD + _BSD_WARRANTY),
    ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD + _BSD_WARRANTY),
    ("BSD-3-Clause", _BSD + _BSD_THIRD + _BSD_WARRANTY),
    ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD + _BSD_THIRD + _BSD_WARRANTY),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
)


def canonical(text: Column) -> Column:
    """A text's canonical form; empty for a null."""
    lower = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT_LINE, "\n")
    plain = F.concat(F.lit(" "), F.regexp_replace(lower, "[^a-z0-9]+", " "), F.lit(" "))
    usual = plain
    for odd, other in SPELLINGS:
        usual = F.replace(usual, F.lit(f" {odd} "), F.lit(f" {other} "))
    # Few texts have such a spelling; the others are searched once and not once per spelling.
    return F.trim(F.regexp_replace(F.when(plain.rlike(f" ({'|'.join(odd for odd, _ in SPELLINGS)}) "), usual).otherwise(plain), " +", " "))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_digests(known: DataFrame) -> DataFrame:
    """digest, license of known (license, text); texts without words are left out."""
    return known.where(canonical(F.col("text")) != "").select(digest(F.col("text")).alias("known"), "license").distinct()


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """doc_id, digest, license (of the whole text, else null), line_licenses (sorted), n_license_lines, for every row of docs (doc_id, text).

    Several licences of one digest are joined by " OR ".
    """
    spark = docs.sparkSession
    known = known_digests(spark.createDataFrame(KNOWN, "license string, text string") if known is None else known)
    named = known.groupBy("known").agg(F.concat_ws(" OR ", F.sort_array(F.collect_set("license"))).alias("license"))
    sized = F.broadcast(named) if known.count() <= BROADCAST_ROWS else named
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", F.struct("doc_id", F.xxhash64("text").alias("h"), F.octet_length("text").alias("n")).alias("row"))
    lines = rows.select("row", F.posexplode(F.split("text", "\n", -1)).alias("at", "line")).where(F.length("line") > 0)
    # A generator makes the digest once; as a plain column the join's null filter would make it again.
    lines = lines.select("row", "at", F.explode(F.array(digest(F.col("line")))).alias("known"))
    found = lines.join(sized, "known").groupBy("row").agg(F.sort_array(F.collect_set("license")).alias("line_licenses"), F.count_distinct("at").alias("n_license_lines"))
    whole = rows.select("doc_id", "row", digest(F.col("text")).alias("digest")).join(sized.withColumnRenamed("known", "digest"), "digest", "left")
    none = F.array().cast("array<string>")
    return whole.join(found, whole["row"].eqNullSafe(found["row"]), "left").select(
        "doc_id", "digest", "license", F.concat_ws(",", F.coalesce("line_licenses", none)).alias("line_licenses"), F.coalesce("n_license_lines", F.lit(0)).cast("long").alias("n_license_lines")
    )
