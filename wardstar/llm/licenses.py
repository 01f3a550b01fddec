"""License scans by canonical digests.

A text is brought to a canonical form (small letters, no punctuation, no copyright lines,
one of several equivalent spellings, single spaces), and the digest of the whole of it is
looked up among the digests of known licence texts and notices. The texts of a document are
the document itself and each of its lines, as notices are usually lines of their own.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstar.llm.common import prepare, stored, with_key

# Spellings that count as one, as licence matching guidelines list them.
EQUIVALENT = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact",
    "authorisation": "authorization", "authorise": "authorize", "authorised": "authorized", "calibre": "caliber",
    "cancelled": "canceled", "catalogue": "catalog", "categorise": "categorize", "centre": "center",
    "emphasised": "emphasized", "favour": "favor", "favourite": "favorite", "fulfil": "fulfill",
    "fulfilment": "fulfillment", "initialise": "initialize", "judgement": "judgment", "labelling": "labeling",
    "labour": "labor", "licence": "license", "licenced": "licensed", "licences": "licenses",
    "maximise": "maximize", "modelled": "modeled", "modelling": "modeling", "offence": "offense",
    "optimise": "optimize", "organisation": "organization", "organise": "organize", "practise": "practice",
    "programme": "program", "realise": "realize", "recognise": "recognize", "signalling": "signaling",
    "utilisation": "utilization", "whilst": "while", "wilful": "willful", "https": "http", "v2": "version 2",
    "v3": "version 3",
}
EQUIVALENT_PHRASES = {
    "sub license": "sublicense", "sub licensed": "sublicensed", "non commercial": "noncommercial",
    "per cent": "percent", "copyright owner": "copyright holder",
}

_PERMISSIVE_END = """
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""
_ISC_END = """
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.
"""
# Licence texts and usual notices, under their SPDX identifiers.
KNOWN = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.
""" + _PERMISSIVE_END),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("ISC", """ISC License

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.
""" + _ISC_END),
    ("0BSD", "SPDX-License-Identifier: 0BSD"),
    ("0BSD", """Zero-Clause BSD

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted.
""" + _ISC_END),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License").'),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0-only", "Licensed under the GNU General Public License, version 2."),
    ("GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("LGPL-3.0-only", "Licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
]

_COPYRIGHT = re.compile(r"[^\w©]*(?:copyright|copr|\(c\)|©|all rights reserved)(?!\w)")
_NOTICE = re.compile(r"(?:\(c\)|©|[0-9]{4}|all rights reserved)")
_WORD = re.compile(r"[^\W_]+")


def _line(line: str) -> str:
    """The canonical form of one line; empty for a copyright line."""
    if _COPYRIGHT.match(line) and _NOTICE.search(line):
        return ""
    return " ".join([EQUIVALENT.get(w, w) for w in _WORD.findall(line)])


def _digest(canonical: list[str]) -> bytes:
    text = f" {' '.join(filter(None, canonical))} "
    for phrase, equal in EQUIVALENT_PHRASES.items():
        if phrase in text:
            text = text.replace(f" {phrase} ", f" {equal} ")
    return hashlib.sha256(text.strip().encode()).digest()


def digests(text: str | None) -> tuple[bytes, list[bytes], int]:
    """Digest of the whole text, the different digests of its lines, and how many lines aren't empty.

    Empty canonical texts have no digest among the lines; a null text is empty.
    """
    lines = [_line(x) for x in (text or "").lower().split("\n")]
    full = [x for x in lines if x]
    return _digest(lines), list({_digest([x]) for x in set(full)}), len(full)


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """(digest, license): the least license of each known text.

    Handed over as Arrow, its size is known to Spark, which broadcasts it: digests of lines
    that are in every document then meet it where they are made.
    """
    rows: dict[bytes, str] = {}
    for name, text in KNOWN if known is None else known:
        digest = digests(text)[0]
        rows[digest] = min(name, rows.get(digest, name))
    table = pa.table({"digest": pa.array(rows.keys(), pa.binary()), "license": pa.array(rows.values(), pa.string())})
    return spark.createDataFrame(table)


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One row per document: doc_id, n_lines, n_matches, licenses, whole_license.

    known: (digest, license), each digest once; the built-in list if none is given.
    n_lines counts lines that aren't empty in canonical form, n_matches the different ones
    of them that are known texts. licenses are those of the lines and of the whole text,
    sorted and comma-joined, empty for none; whole_license is null unless the whole text
    is known. Null texts have no lines. Rows equal in id and text get equal results, one
    row each; an empty table gives no rows.
    """
    spark = prepare(docs.sparkSession)
    known = known_digests(spark) if known is None else known
    keyed, key = with_key(docs.select(F.col("doc_id").cast("long"), "text"))

    def run(batches):
        for batch in batches:
            found = [digests(t) for t in batch.column(3).to_pylist()]
            whole = pa.array([f[0] for f in found], pa.binary())
            lines, n = pa.array([f[1] for f in found], pa.list_(pa.binary())), pa.array([f[2] for f in found], pa.int64())
            columns = [batch.column(0), batch.column(1), batch.column(2), whole, lines, n]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *key, "whole", "lines", "n_lines"])

    schema = f"doc_id long, {key[0]} string, {key[1]} long, whole binary, lines array<binary>, n_lines long"
    marked = stored(keyed.select("doc_id", *key, "text").mapInArrow(run, schema), "digests")
    whole = marked.select(*key, F.col("whole").alias("digest"), F.lit(True).alias("is_whole"))
    lines = marked.select(*key, F.explode("lines").alias("digest"), F.lit(False).alias("is_whole"))
    matches = (
        whole.union(lines)
        .join(known.select("digest", "license"), "digest")
        .groupBy(*key)
        .agg(
            F.array_join(F.array_sort(F.collect_set("license")), ",").alias("licenses"),
            F.count_distinct(F.when(~F.col("is_whole"), F.col("digest"))).alias("n_matches"),
            F.max(F.when(F.col("is_whole"), F.col("license"))).alias("whole_license"),
        )
    )
    return marked.join(matches, key, "left").select(
        "doc_id",
        "n_lines",
        F.coalesce("n_matches", F.lit(0)).cast("long").alias("n_matches"),
        F.coalesce("licenses", F.lit("")).alias("licenses"),
        "whole_license",
    )
