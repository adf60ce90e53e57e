"""License scans by canonical digests.

A text is brought to a canonical form - lower case, no copyright statements, one
spelling for equivalent ones, no punctuation, single spaces - and its SHA-256 is
joined to the digests of known license texts in the same form. The texts held
against them are each whole document and each of its lines: a one-line notice
is a license text of its own.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Equivalent spellings, applied in this order to lower-case text.
SPELLINGS = (
    ("licence", "license"), ("licensing agreement", "license"), ("sub-license", "sublicense"), ("sub license", "sublicense"),
    ("non-commercial", "noncommercial"), ("copyright holder", "copyright owner"), ("per cent", "percent"),
    ("acknowledgement", "acknowledgment"), ("organisation", "organization"), ("merchantibility", "merchantability"),
    ("version ", "v"), ("https://", "http://"), ("&", " and "),
)
# A copyright statement, also after comment marks, up to licence wording on the same line or the end of the line.
# Sentences about copyright holders, notices or law are part of a licence.
COPYRIGHT = ("(?m)^[ \\t#/*;%!>|<-]*(?:copyright(?![ \\t]+(?:holders?|owners?|notices?|statements?|laws?|licen[sc]e|interest|and|or)\\b)"
             "|\\(c\\)|©|all rights reserved)[^\\n]*?(?:(?<=[ \\t])(?=(?:released under|licen[sc]ed under|distributed under|"
             "this work is licen[sc]ed|permission is hereby|permission to use|redistribution and use|everyone is permitted)\\b)|$)")
# Runs of punctuation and spaces within a line; a single space stays as it is.
SIGNS = "\\x00-\\x09\\x0B-\\x1F\\x21-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F©“”‘’«»–—"
PUNCTUATION = f"\\x20*[{SIGNS}][{SIGNS}\\x20]*|\\x20{{2,}}"
# A catalogue up to this many rows is small enough to send to every task.
BROADCAST_ROWS = 20_000

# Public license texts and one-line notices.
MIT_TERMS = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC_TERMS = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
CATALOGUE = (
    ("MIT", "MIT License\n\n" + MIT_TERMS), ("MIT", MIT_TERMS), ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("ISC", "ISC License\n\n" + ISC_TERMS), ("ISC", ISC_TERMS), ("ISC", "Licensed under the ISC License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0-only", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0-only", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This work is licensed under the Mozilla Public License, version 2.0."),
    ("BSD-3-Clause", "Licensed under the 3-Clause BSD License."), ("BSD-2-Clause", "Licensed under the 2-Clause BSD License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
)
# Entire texts, one file a license; the files' names are the licenses'.
TEXTS = Path(__file__).with_name("license_texts")
END_OF_TERMS = "END OF TERMS AND CONDITIONS"
TITLES = {"BSD-2-Clause": "BSD 2-Clause License", "BSD-3-Clause": "BSD 3-Clause License"}
VERBS = ("Licensed under", "Released under", "Distributed under", "This work is licensed under", "This program is licensed under",
         "This software is licensed under", "This project is licensed under")
NAMES = (
    ("MIT", ("the MIT License",)), ("ISC", ("the ISC License",)),
    ("Apache-2.0", ("the Apache License, Version 2.0", "the Apache License 2.0", "Apache License 2.0", "Apache-2.0")),
    *((f"{short}-{v}.0-{kind}", tuple(f"{name}{end}" for name in (
        f"the GNU {long}General Public License, version {v}", f"the GNU {long}General Public License v{v}.0", f"the {short} version {v}", f"{short} v{v}"))
       ) for short, long, versions in (("GPL", "", (2, 3)), ("LGPL", "Lesser ", (3,)), ("AGPL", "Affero ", (3,)))
      for v in versions for kind, ends in (("only", ("", " only")), ("or-later", (" or later", " or any later version"))) for end in ends),
    ("MPL-2.0", ("the Mozilla Public License, version 2.0", "the Mozilla Public License 2.0", "MPL 2.0")),
    ("BSD-3-Clause", ("the 3-Clause BSD License", "the BSD 3-Clause License")),
    ("BSD-2-Clause", ("the 2-Clause BSD License", "the BSD 2-Clause License")),
    *((f"CC-{k}-4.0", (f"CC {k} 4.0", f"CC-{k}-4.0")) for k in ("BY", "BY-SA", "BY-NC", "BY-ND")), ("CC0-1.0", ("CC0 1.0", "CC0-1.0")),
)


def entire_licenses() -> list[tuple[str, str]]:
    """The whole texts of license_texts, with and without what follows their terms, and notices in usual forms."""
    out = []
    for path in sorted(TEXTS.glob("*.txt")):
        name, text = path.stem, path.read_text(encoding="utf-8")
        forms = [text]
        if END_OF_TERMS in text:
            terms = text[:text.index(END_OF_TERMS)]
            forms += [terms, terms + END_OF_TERMS]
        if name in TITLES:  # with bullets instead of numbers, and with the title
            forms += [re.sub(r"(?m)^\d\. ", "* ", text)]
            forms += [f"{TITLES[name]}\n\n{f}" for f in forms]
        out += [(name, f) for f in forms]
    return out + [(name, f"{verb} {form}.") for name, forms in NAMES for form in forms for verb in VERBS]


def canonical_lines(text: Column) -> Column:
    """The canonical form of each line, still with line feeds between them."""
    out = F.regexp_replace(F.lower(text), COPYRIGHT, "")
    for other, one in SPELLINGS:
        out = F.replace(out, F.lit(other), F.lit(one))
    return F.regexp_replace(out, PUNCTUATION, " ")


def digest(form: Column) -> Column:
    """SHA-256 of a canonical form on one line; null where nothing is left."""
    one_line = F.trim(F.regexp_replace(form, "\\x20*\n[\\x20\n]*", " "))
    return F.when(F.length(one_line) > 0, F.sha2(one_line, 256))


def line_digest(line: Column) -> Column:
    return F.when(F.length(F.trim(line)) > 0, F.sha2(F.trim(line), 256))


def known_licenses(spark: SparkSession, catalogue=CATALOGUE) -> DataFrame:
    return spark.createDataFrame(list(catalogue), "license string, text string")


def license_hits(docs: DataFrame, catalogue: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 license_col: str = "license", license_text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, whole (license of the entire text, or null), lines (sorted licenses of its lines).

    Defined cases: null and empty texts, and texts of copyright statements or
    punctuation only, match nothing; where several licenses have one
    canonical text the first by name counts; a repeated row gives a repeated
    row; an empty catalogue matches nothing; extra columns are not read.
    """
    known = (catalogue.select(digest(canonical_lines(F.col(license_text_col))).alias("digest"), F.col(license_col).alias("license"))
             .filter("digest IS NOT NULL").groupBy("digest").agg(F.min("license").alias("license")))
    if catalogue.count() <= BROADCAST_ROWS:
        known = F.broadcast(known)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), canonical_lines(text).alias("form"))
    # The digest of the whole text, then those of its lines.
    units = rows.select("row", "id", F.posexplode(F.concat(
        F.array(digest(F.col("form"))), F.transform(F.split("form", "\n"), line_digest))).alias("at", "digest"))
    found = units.join(known, "digest", "left")
    # All units of a row are in one task, so this is summed up before the exchange.
    done = found.groupBy("row", "id").agg(
        F.max(F.when(F.col("at") == 0, F.col("license"))).alias("whole"),
        F.sort_array(F.collect_set(F.when(F.col("at") > 0, F.col("license")))).alias("lines"))
    return done.select(F.col("id").alias(id_col), "whole", "lines")
