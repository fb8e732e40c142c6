"""Operator 5: licence scan by canonical digests.

A text is brought to one canonical form (copyright lines out, lower case, equivalent spellings to one,
all but letters and digits to one space) and named by the form's digest. Whole documents are hash-joined
to the digests of known licence texts, and whole lines to those of known licence notices. A text that isn't
known as it stands is tried once more by its body, without a leading title and list markers. A text and its lines
are brought to canonical form together, once, and named by two hashes of the text; the digests are written once. No text is
compared with another; only digests are joined, and the known side is broadcast only if its count is
under a bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import scratch
from docloom.llm.line_dedup import _name, _once

BROADCAST_ROWS = 200_000
COPYRIGHT = r"(?i)(^|\n)[ \t#*/;-]*(copyright|\(c\)|©|all rights reserved)[^\n]*"
TITLE = r"(?i)^\s*[#*=/ \t-]*(the )?((mit|expat|isc|zlib|0bsd|bsd)( licen[cs]e)?|(modified |new |simplified )?bsd licen[cs]e|zlib/libpng licen[cs]e|bsd zero[- ]clause licen[cs]e|zero[- ]clause bsd( licen[cs]e)?|(the )?(bsd [23][- ]clause|[23][- ]clause bsd)( licen[cs]e)?)( *\([^)\n]*\))?[ \t:.*=#-]*\n([ \t]*[=*-]{3,}[ \t]*\n)?"
MARKER = r"(^|\n)[ \t]*([0-9]{1,2}[.)]|\([0-9a-z]\)|[*•-])[ \t]+"
OTHER = r"[^\p{L}\p{N}]+"

# Equivalent spellings, the second is kept.
SPELLINGS = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact", "authorisation": "authorization",
    "authorised": "authorized", "calibre": "caliber", "cancelled": "canceled", "capitalisations": "capitalizations", "catalogue": "catalog",
    "categorise": "categorize", "centre": "center", "emphasised": "emphasized", "favour": "favor", "favourite": "favorite", "fulfil": "fulfill",
    "fulfilment": "fulfillment", "initialise": "initialize", "judgement": "judgment", "labelling": "labeling", "labour": "labor", "licence": "license",
    "licences": "licenses", "licenced": "licensed", "maximise": "maximize", "modelled": "modeled", "modelling": "modeling", "offence": "offense",
    "optimise": "optimize", "organisation": "organization", "organise": "organize", "practise": "practice", "programme": "program", "realise": "realize",
    "recognise": "recognize", "signalling": "signaling", "sublicence": "sublicense", "utilisation": "utilization", "whilst": "while", "wilful": "willful",
    "noncommercial": "non commercial", "cc by nc": "creative commons attribution non commercial", "gnu gpl": "gnu general public license",
}

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC_END = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
BSD_NAME = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""

# Public licence texts, without their titles and copyright lines.
LICENCES = {
    "MIT": MIT,
    "ISC": f"Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n{ISC_END}",
    "0BSD": f"Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n{ISC_END}",
    "BSD-2-Clause": f"{BSD}\n{BSD_END}",
    "BSD-3-Clause": f"{BSD}\n{BSD_NAME}\n{BSD_END}",
    "Zlib": ZLIB,
}
# Body digests of longer public licence texts, as Debian's common-licenses hold them, and of
# Apache-2.0 without its appendix, ending before or with "END OF TERMS AND CONDITIONS".
BODIES = {
    "a61bca3a5e70aebcd9bcca965e511dbc": "Apache-2.0",
    "b827117525bdd2384440aa29b250abe0": "Apache-2.0",
    "4377ce7f78fc5fa37bf951b9083ff639": "Apache-2.0",
    "a0e79ef18035ed3a0408083af6c9a1af": "Artistic-1.0-Perl",
    "5daf61c1ab3d835d70254af5bd4b2989": "CC0-1.0",
    "9148dbcb0ce2b52205328e2b53d27a1e": "GPL-1.0",
    "681c5ea2d1513d0a3be435e2c068f930": "GPL-2.0",
    "e4a36f4dd71cc28ab2979d16e335eb33": "GPL-3.0",
    "fe0e6158b76bb629c6bb99b54dfb5cfa": "LGPL-2.0",
    "663b4a34adfd0e300926cce02fae7958": "LGPL-2.1",
    "74bf0282b73ed1271a848801bd090145": "LGPL-3.0",
    "5017331385d6d7a2bb6d4e5148691864": "MPL-1.1",
    "4cb33a85d42c23a40cfd9b0a96de1127": "MPL-2.0",
}
# Usual one-line notices.
NOTICES = {
    "Released under the MIT License.": "MIT",
    "Licensed under the MIT License.": "MIT",
    "SPDX-License-Identifier: MIT": "MIT",
    "SPDX-License-Identifier: Apache-2.0": "Apache-2.0",
    "SPDX-License-Identifier: GPL-3.0-only": "GPL-3.0-only",
    "SPDX-License-Identifier: BSD-3-Clause": "BSD-3-Clause",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "Licensed under the Apache License, Version 2.0 (the \"License\");": "Apache-2.0",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-only",
    "Licensed under the GNU General Public License, version 3.": "GPL-3.0-only",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "Licensed under CC BY 4.0.": "CC-BY-4.0",
    "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0",
    "This work is licensed under a Creative Commons Attribution 4.0 International License.": "CC-BY-4.0",
}


#: A word or phrase of another spelling. The look ahead spares most words the list.
OTHERWISE = rf"\b(?=[{''.join(sorted({one[0] for one in SPELLINGS}))}])({'|'.join(SPELLINGS)})\b"


def _spelled(plain: Column) -> Column:
    pairs = F.array(*(F.struct(F.lit(rf"\b{one}\b").alias("one"), F.lit(other).alias("other")) for one, other in SPELLINGS.items()))
    return F.aggregate(pairs, plain, lambda x, pair: F.regexp_replace(x, pair["one"], pair["other"]))


def canonical(text: Column) -> Column:
    """The canonical form; empty for a text without a letter or digit."""
    plain = F.trim(F.regexp_replace(F.lower(F.regexp_replace(text, COPYRIGHT, "\n")), OTHER, " "))
    return F.when(plain.rlike(OTHERWISE), _spelled(plain)).otherwise(plain)


def told(texts: DataFrame) -> DataFrame:
    """For each ``text``: ``key, more`` (its name), ``digest``, ``body`` (digest) and ``lines`` (distinct digests of its lines), as ``canonical`` gives them."""
    key, more = _name("text")
    bare = _once(texts.select(key.alias("key"), more.alias("more"), F.regexp_replace("text", COPYRIGHT, "\n").alias("text")))
    # Line ends stay here. A copyright line is empty by itself as it is within the text, and no spelling reaches over a line end.
    kept = _once(bare.select("*", F.regexp_replace(F.lower("text"), r"[^\p{L}\p{N}\n]+", " ").alias("kept")))
    lines = lambda x: F.array_remove(F.transform(F.split(x, "\n"), lambda line: F.trim(line)), "")
    plain = _once(kept.select("*", lines(F.col("kept")).alias("lines")))
    plain = _once(plain.select("*", F.array_join("lines", " ").alias("plain")))
    plain = _once(plain.select("*", F.col("plain").rlike(OTHERWISE).alias("odd")))
    formed = _once(plain.select("key", "more", "text", F.when(F.col("odd"), lines(_spelled(F.col("kept")))).otherwise(F.col("lines")).alias("lines"), F.when(F.col("odd"), _spelled(F.col("plain"))).otherwise(F.col("plain")).alias("plain")))
    whole = F.md5("plain")
    body = F.when(F.col("text").rlike(TITLE) | F.col("text").rlike(MARKER), body_digest(F.col("text"))).otherwise(whole)
    return formed.select("key", "more", whole.alias("digest"), body.alias("body"), F.array_distinct(F.transform("lines", lambda line: F.md5(line))).alias("lines"))


def body_digest(text: Column) -> Column:
    """The digest of a text without copyright lines, a leading title line and list markers."""
    return digest(F.regexp_replace(F.regexp_replace(F.regexp_replace(text, COPYRIGHT, "\n"), TITLE, "\n"), MARKER, "\n"))


def digest(text: Column) -> Column:
    return F.md5(canonical(text))


def known_table(spark: SparkSession, texts: dict[str, str]) -> DataFrame:
    """``licence, text`` of given texts, as ``license_scan`` takes them."""
    return spark.createDataFrame(sorted(texts.items()), "licence string, text string")


def digests(known: DataFrame, of=digest) -> DataFrame:
    """``digest, licence`` with one row per digest (of several licences the first name). Texts without a letter or digit name none."""
    named = known.where(canonical(F.col("text")) != "").select(of(F.col("text")).alias("digest"), "licence")
    named = named.where(F.col("digest") != F.md5(F.lit(""))).groupBy("digest").agg(F.min("licence").alias("licence"))
    return F.broadcast(named) if named.count() <= BROADCAST_ROWS else named


def license_scan(docs: DataFrame, licences: DataFrame, notices: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``digest``, ``licence`` (of the whole text, else null) and ``notices`` (sorted array of distinct licences
    whose notice is a whole line of the text) to every row of ``docs``.

    ``licences`` and ``notices`` have columns ``licence`` and ``text``. A null text counts as empty and
    matches nothing. A text that isn't a known one may be one by its body digest, which further ones of
    ``BODIES`` join; ``digest`` stays that of the whole text. Repeated rows stay, also with null ids; an empty table gives an empty one; input
    columns named like the new ones are replaced.
    """
    docs = docs.drop("digest", "licence", "notices")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    with scratch.scope() as leave:
        found = leave(scratch.keep(told(docs.select(text.alias("text")))))
    # What a text holds follows from the text alone, so its lines and its copies meet by its name.
    lines = found.select("key", "more", F.explode("lines").alias("digest")).join(digests(notices), "digest")
    held = lines.groupBy("key", "more").agg(F.array_sort(F.collect_set("licence")).alias("docloom_notices"))
    more = docs.sparkSession.createDataFrame(sorted(BODIES.items()), "body string, known string")
    bodies = digests(licences, body_digest).toDF("body", "known").union(more).groupBy("body").agg(F.min("known").alias("known"))
    bodies = F.broadcast(bodies) if bodies.count() <= BROADCAST_ROWS else bodies
    known = found.select("key", "more", "digest", "body").dropDuplicates(["key", "more"])
    known = known.join(digests(licences), "digest", "left").join(bodies, "body", "left").join(held, ["key", "more"], "left")
    known = known.select(F.col("key").alias("docloom_key"), F.col("more").alias("docloom_more"), F.col("digest").alias("docloom_digest"), F.coalesce("licence", "known").alias("docloom_licence"), "docloom_notices")
    key, more = _name(text)
    out = docs.withColumns({"docloom_key": key, "docloom_more": more}).join(known, ["docloom_key", "docloom_more"], "left")
    new = [F.col("docloom_digest").alias("digest"), F.col("docloom_licence").alias("licence"), F.coalesce("docloom_notices", F.array().cast("array<string>")).alias("notices")]
    return out.select(*docs.columns, *new)
