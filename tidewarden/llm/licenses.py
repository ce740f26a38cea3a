"""Licence scan by canonical digests.

A text is reduced to a canonical form (case, punctuation, blanks, copyright lines and equivalent spellings no longer
matter) and its SHA-256 is hash-joined with the digests of known licence texts. Entire texts are looked up, and in the
same join every line as a text of its own, since corpora mostly carry licences as one-line notices.

Scale: one pass; the known table has a stated number of rows (the rule below makes about 5,000 of 100 bytes) and is
broadcast only up to MAX_KNOWN. Lines are partially aggregated to one row a document before the shuffle; nothing is gathered by source or
by licence.

Defined results: null, empty and blank texts match nothing and have the digest of the empty form; documents repeated in
full are counted apart and returned as often as they came; a null key is a key; an empty table gives an empty result;
further columns are not read. Texts of any length are digested whole.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table

#: licence -> (class, names that notices use for it)
NAMES: dict[str, tuple[str, tuple[str, ...]]] = {
    "MIT": ("permissive", ("MIT License", "MIT", "Expat License")),
    "Apache-2.0": ("permissive", ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0", "Apache-2.0")),
    "BSD-2-Clause": ("permissive", ("BSD 2-Clause License", "BSD-2-Clause", "Simplified BSD License")),
    "BSD-3-Clause": ("permissive", ("BSD 3-Clause License", "BSD-3-Clause", "New BSD License")),
    "ISC": ("permissive", ("ISC License", "ISC")),
    "Zlib": ("permissive", ("zlib License", "zlib")),
    "Unlicense": ("public-domain", ("Unlicense",)),
    "CC0-1.0": ("public-domain", ("CC0 1.0", "CC0-1.0", "Creative Commons Zero")),
    "GPL-2.0": ("copyleft", ("GNU General Public License, version 2", "GNU General Public License v2.0", "GPL-2.0", "GPLv2")),
    "GPL-3.0": ("copyleft", ("GNU General Public License, version 3", "GNU General Public License v3.0", "GPL-3.0", "GPLv3")),
    "LGPL-3.0": ("copyleft", ("GNU Lesser General Public License, version 3", "LGPL-3.0", "LGPLv3")),
    "AGPL-3.0": ("copyleft", ("GNU Affero General Public License, version 3", "AGPL-3.0", "AGPLv3")),
    "MPL-2.0": ("weak-copyleft", ("Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "MPL-2.0", "MPL 2.0")),
    "CC-BY-4.0": ("attribution", ("CC BY 4.0", "CC-BY-4.0", "Creative Commons Attribution 4.0 International License")),
    "CC-BY-SA-4.0": ("copyleft", ("CC BY-SA 4.0", "CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International License")),
    "CC-BY-NC-4.0": ("non-commercial", ("CC BY-NC 4.0", "CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International License")),
}
OPENINGS = ("licensed under", "released under", "distributed under", "available under", "published under", "covered by", "under")
SUBJECTS = ("", "this work is ", "this file is ", "this software is ", "this document is ", "this project is ", "this text is ", "the code is ")
FULL_TEXTS: dict[str, str] = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
}
#: Digests of the canonical forms of further whole texts, as packages carry them: with and without title or appendix. Texts of
#: AGPL-3.0 and the three CC BY licences are missing. The SQL form does not have these.
FULL_DIGESTS: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "69a51938c7bc3c6ce9082ac0a28a35902fc58dbb5eb1b5cc986220794fda9118",
        "6366c4fe55cd4a3d37bfe3798a0b5d7cb972fd18662663ce3bd50855a8e6dd50",
        "2111987754ca7647fea023cb592d41a04ab9a4c46b0d50e4c729fb00cf846a51",
        "704e2bc1fe11167bf80f6ff042eae8706a53f6c24b47c72166dbccc81169e0b4",
    ),
    "BSD-2-Clause": (
        "a56fee4b2f66331ed54da4950ef9c9391453fd1490b4d8ea202bc29683bcbd30",
        "032f33a9fad178d38ba062bc5f6e47fde5eb48f13d4c8895fe1360e806c83a69",
    ),
    "BSD-3-Clause": (
        "cc65957a28f15bbcef5b0c23770aae3bd8462cb25904250f77a812ab3b2efe15",
        "9b83d3dee0616d07b82a272dd9bf5134a9f402b750f5ee6188458073b0a32ff2",
        "f94931e221f919e6cec5ca99e0ea7da1912b2c7d805cdaee8baf508c248bc1af",
        "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651",
    ),
    "MIT": (
        "35a446201226de6b27cfb7106d0f6c697f63bfeac2913dcf89024911e66ef164",
        "6c833965e9ca4cf8095655005226f24fe8bf7b1605dbe513204837a7371fa127",
        "6ad3654379e72bbdf8478d5c90fb1e2525aba033fbe675e0ef2248aac67c0f6f",
    ),
    "ISC": (
        "e00f31f158e77a60e7375307e014eeb17754967f6d6757d019567221315db4e1",
        "fa224876c62df0b2fc8bde54e6682fed261c5669e98fcbcd614754b5f1b8e4e2",
    ),
    "Zlib": (
        "1b8c5cd52eceb19ab0bc3cb40be110b1c0e7fa2671a3fe5866e59dd1502e69c7",
    ),
    "Unlicense": (
        "8d3909f4543649cfba0b0b1fc765c67acf3736106a78237ea2972f83eaa7dd3e",
    ),
    "CC0-1.0": (
        "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f",
    ),
    "GPL-2.0": (
        "b866f5427b78991db8012466b32f51c907f5e974fde5129a47372d0d0552e3a1",
        "25627449d33fbf0884598d51959715a22ffc4dfb1f8d2456afb45d8e5a146ddf",
    ),
    "GPL-3.0": (
        "504029fa408a954a900b32f989ecf668cb19b1d5f813ef39efa178fc96e2db75",
        "f3ab5ee40da170411ea6671f9845ada2aaba303ee57ba6086b373d1e66c9dc3f",
    ),
    "LGPL-3.0": (
        "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be",
    ),
    "MPL-2.0": (
        "8f0473f9c917c507827dca355168119bb065ca1a9dab0e366988bcdba5fa039b",
    ),
}
#: Equivalent spellings, applied to the lower-cased form in this order.
SPELLINGS = (("licenc", "licens"), ("isation", "ization"), ("favour", "favor"), ("copyright owner", "copyright holder"), ("non-commercial", "noncommercial"), ("sub-licens", "sublicens"), ("whilst", "while"), ("http:", "https:"))
#: A copyright line goes as a whole. Fixed pattern, also valid in RE2 for the SQL form.
COPYRIGHT_LINE = r"(?m)^[^a-z0-9\n]*(copyright[ \t]|copyright$|\(c\)|©|all rights reserved)[^\n]*$"
PUNCTUATION = r"[^\p{L}\p{N}]+"
#: A known table of up to so many rows of about 100 bytes is broadcast; the rule above makes about 5,000.
MAX_KNOWN = 100_000


def canonical(text: Column) -> Column:
    t = F.lower(F.coalesce(text, F.lit("")))
    t = F.when(F.regexp_like(t, F.lit(COPYRIGHT_LINE)), F.regexp_replace(t, COPYRIGHT_LINE, " ")).otherwise(t)
    for old, new in SPELLINGS:
        t = F.replace(t, F.lit(old), F.lit(new))
    return F.btrim(F.regexp_replace(t, PUNCTUATION, " "))


def known_texts() -> list[tuple[str, str, str]]:
    """(licence, class, text): the full texts, and every notice that the rule subject x opening x article x name makes."""
    rows = [(k, NAMES.get(k, ("permissive", ()))[0], text) for k, text in FULL_TEXTS.items()]
    for licence, (kind, names) in NAMES.items():
        for s, o, article, name in product(SUBJECTS, OPENINGS, ("", "the "), names):
            rows.append((licence, kind, f"{s}{o} {article}{name}"))
        rows += [(licence, kind, f"SPDX-License-Identifier: {licence}")]
    return rows


def known_digests(spark: SparkSession, texts: list[tuple[str, str, str]] | None = None) -> DataFrame:
    rows = known_texts() if texts is None else texts
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("licence", "licence_class", "text")])
    df = spark.createDataFrame(rows, schema)
    df = df.select(F.sha2(canonical(F.col("text")), 256).alias("digest"), "licence", "licence_class")
    if texts is None:
        more = [(d, licence, NAMES[licence][0]) for licence, digests in FULL_DIGESTS.items() for d in digests]
        df = df.union(spark.createDataFrame(more, df.schema))
    return df.groupBy("digest").agg(F.min("licence").alias("licence"), F.min_by("licence_class", "licence").alias("licence_class"))


def scan(docs: DataFrame, known: DataFrame, known_rows: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, digest of the whole text, its licence or null, and the licences of its lines.

    ``known_rows`` bounds the known table; beyond MAX_KNOWN rows it is not broadcast.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x) != "")
    whole = F.struct(F.lit(True).alias("whole"), F.sha2(canonical(F.col(text)), 256).alias("digest"))
    # A line of one line's text is that text: the whole is looked up already.
    parts = F.when(F.instr(t, "\n") > 0, F.transform(lines, lambda x: F.struct(F.lit(False).alias("whole"), F.sha2(canonical(x), 256).alias("digest"))))
    units = docs.select(F.col(key).alias("doc_id"), F.sha2(t, 256).alias("_row"), F.concat(F.array(whole), F.coalesce(parts, F.array().cast("array<struct<whole:boolean,digest:string>>"))).alias("_u"))
    units = units.select("doc_id", "_row", F.explode("_u").alias("u")).select("doc_id", "_row", "u.*")
    small = F.broadcast(known) if known_rows <= MAX_KNOWN else known
    hit = units.join(small, "digest", "left")
    out = hit.groupBy("doc_id", "_row").agg(
        F.max(F.when(F.col("whole"), F.col("digest"))).alias("text_digest"),
        F.max(F.when(F.col("whole"), F.col("licence"))).alias("text_licence"),
        F.array_sort(F.collect_set("licence")).alias("_all"),
        F.count_if(F.col("licence").isNotNull()).alias("_hits"),
        F.count_if(F.col("licence_class").isin("copyleft", "weak-copyleft", "non-commercial")).alias("_bad"),
        F.count_if("whole").alias("_copies"),
    )
    return out.select(
        "doc_id", "text_digest", "text_licence", F.array_join("_all", ",").alias("licences"),
        F.expr("_hits div _copies").alias("n_matches"), (F.col("_bad") > 0).alias("restricted"), F.explode(F.expr("array_repeat(0, cast(_copies AS int))")).alias("_i"),
    ).drop("_i")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = len(known_texts()) + sum(map(len, FULL_DIGESTS.values()))
    return scan(table(spark, sf_dir, "documents"), known_digests(spark), n)


def _sql() -> str:
    def canon(x: str) -> str:
        out = rf"regexp_replace(lower({x}), '{COPYRIGHT_LINE}', ' ', 'g')"
        for old, new in SPELLINGS:
            out = f"replace({out}, '{old}', '{new}')"
        return rf"trim(regexp_replace({out}, '{PUNCTUATION}', ' ', 'g'))"

    q = lambda s: s.replace("'", "''")
    values = ",\n".join(f"('{a}','{b}','{q(c)}')" for a, b, c in known_texts())
    return rf"""
WITH k AS (SELECT sha256({canon("t")}) AS digest, min(licence) AS licence, arg_min(kind, licence) AS kind FROM (VALUES {values}) v(licence, kind, t) GROUP BY 1),
d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
u AS (
  SELECT rid, true AS whole, sha256({canon("t")}) AS digest FROM d
  UNION ALL
  SELECT rid, false, sha256({canon("x")}) FROM (SELECT rid, unnest(string_split(t, chr(10))) AS x FROM d WHERE contains(t, chr(10))) WHERE trim(x) != ''),
a AS (
  SELECT rid, max(CASE WHEN whole THEN digest END) AS text_digest, max(CASE WHEN whole THEN licence END) AS text_licence,
         coalesce(string_agg(DISTINCT licence, ',' ORDER BY licence), '') AS licences, count(licence) AS n_matches,
         coalesce(bool_or(kind IN ('copyleft', 'weak-copyleft', 'non-commercial')), false) AS restricted
  FROM u LEFT JOIN k USING (digest) GROUP BY rid)
SELECT doc_id, text_digest, text_licence, licences, n_matches, restricted FROM d JOIN a USING (rid)
"""


OP1_SQL = _sql()
