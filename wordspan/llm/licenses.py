"""License scan by canonical digests: texts that differ only in case, punctuation, copyright lines
and equivalent spellings have one digest, and a hash join finds the known ones. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stash

#: Texts of public licences and notices, one a licence id and kind.
KNOWN = [
    ("0BSD", "licence", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("ISC", "licence", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("MIT", "licence", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("Zlib", "licence", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""),
    ("BSD-2-Clause", "licence", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("BSD-3-Clause", "licence", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("BSL-1.0", "licence", """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:
The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("Unlicense", "licence", """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
For more information, please refer to <https://unlicense.org>"""),
    ("Apache-2.0", "notice", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "notice", "Licensed under the MIT License."),
    ("MIT", "notice", "Released under the MIT License."),
    ("GPL-3.0-only", "notice", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "notice", "Licensed under the GNU General Public License, version 3 or later."),
    ("MPL-2.0", "notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC-4.0", "notice", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "notice", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "notice", "Licensed under a Creative Commons Attribution 4.0 International License."),
]

#: First lines that licence files have above these texts, or not.
TITLES = {
    "0BSD": "BSD Zero Clause License", "ISC": "ISC License", "MIT": "MIT License", "Zlib": "zlib License", "BSD-2-Clause": "BSD 2-Clause License", "BSD-3-Clause": "BSD 3-Clause License",
    "BSL-1.0": "Boost Software License - Version 1.0 - August 17th, 2003",
}

#: What begins lines that only say who holds a copyright.
COPYRIGHT_LINE = r"^[^\p{L}\p{N}]*(copyright|\(c\)|©|all rights reserved)"
#: Equivalent spellings, told apart by letters between the groups only: what isn't in a group goes.
SPELLINGS = (
    r"(?:(sub) )?(licen)[cs]|((?:author|organ|initial|maxim|minim|optim|real|recogn|util|emphas|custom|summar)i)[sz](e|ing|ation)"
    r"|((?:fav|lab|hon|behavi|col)o)u(r)|(acknowledg|judg)e(ment)|(copyright) (?:owner|holder)"
)
_GROUPS = "123456789"
#: A catalog of so many rows is copied to all tasks; a larger one is joined by its digests.
BROADCAST_ROWS = 20_000


def canonical_lines(text: Column) -> Column:
    """The text's lines in lower case, without copyright lines (empty then), punctuation and spelling variants."""
    kept = F.transform(F.split(F.lower(text), "\n"), lambda line: F.when(line.rlike(COPYRIGHT_LINE), "").otherwise(line))
    plain = F.regexp_replace(F.array_join(kept, "\n"), r"[^\p{L}\p{N}\n]+", " ")
    return F.transform(F.split(F.regexp_replace(plain, SPELLINGS, "".join(f"${g}" for g in _GROUPS)), "\n"), lambda x: F.trim(x))


def digest(plain: Column) -> Column:
    """SHA-256 of canonical words; null where there are none."""
    return F.when(plain != "", F.unhex(F.sha2(plain, 256)))


def whole(lines: Column) -> Column:
    """The words of all canonical lines."""
    return F.array_join(F.filter(lines, lambda x: x != ""), " ")


def known_texts() -> list[tuple[str, str, str]]:
    """(licence_id, kind, text) of what is built in, licences with and without their title."""
    return KNOWN + [(name, kind, f"{TITLES[name]}\n{text}") for name, kind, text in KNOWN if kind == "licence" and name in TITLES]


def catalog(texts: DataFrame) -> DataFrame:
    """(licence_id, kind, known_digest) of a table (licence_id, kind, text): kind is notice for what may stand in a line of its
    own, else licence. Of texts with one digest and kind the smallest id stays; texts without words are left out."""
    plain = texts.select("licence_id", "kind", digest(whole(canonical_lines(F.col("text")))).alias("known_digest"))
    return plain.where("known_digest is not null").groupBy("kind", "known_digest").agg(F.min("licence_id").alias("licence_id")).select("licence_id", "kind", "known_digest")


def built_in(spark: SparkSession) -> DataFrame:
    return catalog(spark.createDataFrame(known_texts(), "licence_id string, kind string, text string"))


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(doc_id, digest, licence_id, n_notices, notices) for every row of documents.

    licence_id: the known licence or notice that the entire text is (the smallest id), else null. n_notices: how many
    lines are, taken by themselves, entirely a known notice; notices: their ids, sorted, joined by commas. Null and empty
    texts have a null digest and no notice; repeated rows give repeated results, texts of any length are taken
    whole, other columns are ignored. The digests of texts and of all their lines are hash-joined with the catalog.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("row", F.xxhash64("doc_id", "text"))
    lines = rows.select("doc_id", "row", canonical_lines(F.col("text")).alias("lines"))
    found = stash(lines.select("doc_id", "row", digest(whole(F.col("lines"))).alias("digest"), F.transform(F.filter("lines", lambda x: x != ""), digest).alias("line_digests")), "digests")
    few = known.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    copied = F.broadcast if few else (lambda df: df)
    single = known.where("kind = 'notice'").select("known_digest", "licence_id")
    each = found.select("doc_id", "row", F.explode("line_digests").alias("known_digest")).join(copied(single), "known_digest")
    marked = each.groupBy("row").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_set("licence_id")), ",").alias("notices"))
    copies = found.groupBy("row").agg(F.count("*").alias("copies")).where("copies > 1")  # repeated rows are counted together
    marked = marked.join(copies, "row", "left").select("row", (F.col("n") / F.coalesce("copies", F.lit(1))).cast("long").alias("n_notices"), "notices")
    names = known.groupBy(F.col("known_digest").alias("digest")).agg(F.min("licence_id").alias("licence_id"))
    out = found.select("doc_id", "row", "digest").join(copied(names), "digest", "left").join(marked, "row", "left")
    return out.select("doc_id", F.lower(F.hex("digest")).alias("digest"), "licence_id", F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices"), F.coalesce("notices", F.lit("")).alias("notices"))


def oracle() -> str:
    def plain(line: str) -> str:
        own = f"CASE WHEN regexp_matches(lower({line}), '{COPYRIGHT_LINE}') THEN '' ELSE lower({line}) END"
        return rf"trim(regexp_replace(regexp_replace({own}, '[^\p{{L}}\p{{N}}]+', ' ', 'g'), '{SPELLINGS}', '{''.join(chr(92) + g for g in _GROUPS)}', 'g'))"

    known = ", ".join("('{}', '{}', '{}')".format(a, b, c.replace("'", "''")) for a, b, c in known_texts())
    lines = "SELECT {0}, unnest(string_split({1}, chr(10))) AS line, generate_subscripts(string_split({1}, chr(10)), 1) AS pos FROM {2}"
    return f"""
WITH listed AS (SELECT *, row_number() OVER () AS k FROM (VALUES {known}) v(id, kind, t)),
known AS (SELECT kind, d, min(id) AS id FROM (SELECT id, kind, sha256(string_agg(plain, ' ' ORDER BY pos) FILTER (plain <> '')) AS d FROM (SELECT *, {plain('line')} AS plain FROM ({lines.format('k, id, kind', 't', 'listed')})) GROUP BY k, id, kind) GROUP BY kind, d),
lines AS (SELECT doc_id, pos, {plain('line')} AS plain FROM ({lines.format('doc_id', 'text', 'documents')})),
whole AS (SELECT d.doc_id, sha256(string_agg(plain, ' ' ORDER BY pos) FILTER (plain <> '')) AS digest FROM documents d LEFT JOIN lines l USING (doc_id) GROUP BY d.doc_id),
notices AS (SELECT doc_id, count(*) AS n, string_agg(DISTINCT id, ',' ORDER BY id) AS ids FROM lines JOIN known ON kind = 'notice' AND sha256(plain) = d GROUP BY doc_id)
SELECT w.doc_id, w.digest, k.id AS licence_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_notices, coalesce(n.ids, '') AS notices
FROM whole w LEFT JOIN (SELECT d, min(id) AS id FROM known GROUP BY d) k ON k.d = w.digest LEFT JOIN notices n ON n.doc_id = w.doc_id
"""
