"""License scans by canonical digests.

A text and each of its lines are normalised: lower case, copyright lines left out, equivalent spellings made one,
punctuation and white space to one blank. The digest of the result is looked up in a table of known licences: entire texts
by a hash join on the whole text's digest, licence statements within a document by their line's digest.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firmweave.llm.common import Stages

# Equivalent spellings, as pattern and replacement, applied in this order after lower case.
SPELLINGS = (
    ("licence", "license"),
    ("licenced", "licensed"),
    ("https?", "http"),
    ("&", " and "),
    ("creative commons", "cc"),
    ("gnu general public license", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("(version |v)([0-9])", "$2"),
)

# Statements of a licence in one line, with the phrases that may come before.
OPENINGS = ("licensed under", "licensed under the", "this work is licensed under", "this work is licensed under the", "released under the", "this program is licensed under the", "this file is licensed under the", "distributed under the")
NAMES = {
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"),
    "MIT": ("MIT License", "MIT license terms", "terms of the MIT License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "New BSD License", "Modified BSD License"),
    "GPL-2.0": ("GNU General Public License, version 2", "GPL version 2", "GPLv2"),
    "GPL-3.0": ("GNU General Public License, version 3", "GPL version 3", "GPLv3"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "LGPLv3"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "AGPLv3"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "MPL 2.0"),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons BY 4.0"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons BY-SA 4.0"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons BY-NC 4.0"),
    "CC-BY-NC-SA-4.0": ("CC BY-NC-SA 4.0",),
    "CC-BY-ND-4.0": ("CC BY-ND 4.0",),
    "CC0-1.0": ("CC0 1.0", "CC0"),
}

# Entire licence texts.
_MIT_BODY = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
    '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
    "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
    "the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial "
    'portions of the Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
    "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
    "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC_BODY = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
    'above copyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL '
    "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE "
    "LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
    "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
TEXTS = {
    "MIT": ("MIT License\n\n" + _MIT_BODY, "The MIT License (MIT)\n\n" + _MIT_BODY, _MIT_BODY),
    "ISC": ("ISC License\n\n" + _ISC_BODY, _ISC_BODY),
}

# More entire texts, beside those that the SQL has. Files of this folder hold the long ones; what follows the terms (how to
# apply them) may be left out.
_BSD_TERMS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are "
    "met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
    "\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in "
    "the documentation and/or other materials provided with the distribution.\n\n"
)
_BSD_NAMES = (
    "3. Neither the name of the {} nor the names of its contributors may be used to endorse or promote products derived from this software "
    "without specific prior written permission.\n\n"
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE {} AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE {} OR CONTRIBUTORS BE "
    "LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
    "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, "
    "EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_FILES = ("Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-3.0", "MPL-2.0", "CC-BY-SA-4.0", "CC0-1.0")
_APACHE_NOTICE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may '
    "obtain a copy of the License at\n\nhttp://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, "
    'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or '
    "implied. See the License for the specific language governing permissions and limitations under the License."
)
_MPL_NOTICE = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
    "file, You can obtain one at http://mozilla.org/MPL/2.0/."
)
_GPL_NOTICE = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the {0} as published by the Free Software "
    "Foundation, either version {1} of the License, or (at your option) any later version.\n\nThis program is distributed in the hope that it "
    "will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
    "{0} for more details.\n\nYou should have received a copy of the {0} along with this program. If not, see {2}://www.gnu.org/licenses/."
)


def more_texts() -> list[tuple[str, str]]:
    """(license, text): the BSD licences, the long texts with and without what follows their terms, and the notices for single files."""
    out = []
    for name, title, third in (("BSD-2-Clause", "BSD 2-Clause License", ""), ("BSD-3-Clause", "BSD 3-Clause License", _BSD_NAMES)):
        owners = ("copyright holder", "copyright owner", "University") if third else ("",)
        for head in ("", f"{title}\n\n", f'{title.replace("License", chr(34) + ("New" if third else "Simplified") + chr(34) + " License")}\n\n'):
            for rights in ("", "All rights reserved.\n\n"):
                for owner in owners:
                    for body in (_BSD_TERMS, _BSD_TERMS.replace("\n\n1. ", " ").replace("\n\n2. ", " ")):
                        extra = third.format(owner) if body is _BSD_TERMS else third.format(owner)[3:]
                        for who in (("COPYRIGHT HOLDERS", "COPYRIGHT HOLDER"), ("COPYRIGHT HOLDERS", "COPYRIGHT OWNER"), ("REGENTS", "REGENTS")):
                            out.append((name, head + rights + body + extra + _BSD_END.format(*who)))
    for name in _FILES:
        text = (Path(__file__).parent / "licenses" / f"{name}.txt").read_text("utf-8")
        terms, mark, _ = text.partition("END OF TERMS AND CONDITIONS")
        out += [(name, text)] + ([(name, terms), (name, terms + mark)] if mark else [])
    out += [("Apache-2.0", _APACHE_NOTICE), ("MPL-2.0", _MPL_NOTICE)]
    for name, long, version in (
        ("GPL-2.0", "GNU General Public License", 2), ("GPL-3.0", "GNU General Public License", 3),
        ("LGPL-3.0", "GNU Lesser General Public License", 3), ("AGPL-3.0", "GNU Affero General Public License", 3),
    ):
        out.append((name, _GPL_NOTICE.format(long, version, "https")))
    return out


def normal(text: Column) -> Column:
    """The form of a text or line that is looked up; empty where nothing is left."""
    out = F.regexp_replace(F.lower(text), r"(^|\n)[ \t]*(copyright|\(c\)|©)[^\n]*", "\n")
    for pattern, put in SPELLINGS:
        out = F.regexp_replace(out, pattern, put)
    return F.trim(F.regexp_replace(out, r"[^0-9a-z\u0080-\x{10FFFF}]+", " "))


def known(spark: SparkSession, texts: DataFrame | None = None) -> DataFrame:
    """The known licences, normalised like the texts: kind (text or line), license, digest. A few hundred rows, besides ``texts``."""
    rows = [("text", name, text) for name, forms in TEXTS.items() for text in forms]
    rows += [("text", name, text) for name, text in more_texts()]
    for name, forms in NAMES.items():
        rows += [("line", name, form) for form in forms]
        rows += [("line", name, f"{opening} {form}") for opening in OPENINGS for form in forms]
    table = spark.createDataFrame(rows, "kind string, license string, t string")
    if texts is not None:
        table = table.unionByName(texts.select(F.lit("text").alias("kind"), "license", F.col("text").alias("t")))
    table = table.select("kind", "license", normal(F.col("t")).alias("form")).where("license is not null and form <> ''")
    table = table.select("kind", "license", F.md5("form").alias("digest")).distinct()
    # An entire text has one licence: of two with equal texts the first by name.
    one = table.where("kind = 'text'").groupBy("kind", "digest").agg(F.min("license").alias("license"))
    return one.unionByName(table.where("kind = 'line'"))


def scan_licenses(docs: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """A row per document: doc_id, text_license, line_licenses (distinct, sorted, joined by a comma), n_license_lines, n_copyright_lines.

    text_license is the licence that the entire text is, or null; ``texts`` (license, text) adds entire texts to the known ones. Null and empty texts hold none. Repeated rows each give a row."""
    spark = docs.sparkSession
    with Stages(spark) as st:
        table = st.save(known(spark, texts), "licenses")
        whole = table.where("kind = 'text'").select(F.col("license").alias("text_license"), F.col("digest").alias("whole"))
        single = table.where("kind = 'line'").select("license", "digest")
        rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
        lines = F.split(F.coalesce("text", F.lit("")), "\n")
        marked = F.filter(lines, lambda x: F.lower(x).rlike(r"^[ \t]*(copyright|\(c\)|©)"))
        rows = rows.select(
            "row", "doc_id", F.md5(normal(F.col("text"))).alias("whole"), F.size(marked).cast("long").alias("n_copyright_lines"),
            F.transform(lines, lambda x: F.md5(normal(x))).alias("digests"),
        )
        rows = st.save(rows, "digests")
        hits = rows.select("row", F.explode("digests").alias("digest")).join(F.broadcast(single), "digest")  # a few hundred rows
        hits = hits.groupBy("row").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_set("license")), ",").alias("line_licenses"))
        out = rows.join(F.broadcast(whole), "whole", "left").join(st.save(hits, "hits"), "row", "left")
        return st.save(
            out.select(
                "doc_id", "text_license", F.coalesce("line_licenses", F.lit("")).alias("line_licenses"),
                F.coalesce("n", F.lit(0)).cast("long").alias("n_license_lines"), "n_copyright_lines",
            ),
            "licenses-found", keep=True,
        )


def _sql_normal(text: str) -> str:
    out = f"regexp_replace(lower({text}), '(^|\\n)[ \\t]*(copyright|\\(c\\)|©)[^\\n]*', chr(10), 'g')"
    for pattern, put in SPELLINGS:
        out = f"regexp_replace({out}, '{pattern}', '{put.replace('$', chr(92))}', 'g')"
    return f"trim(regexp_replace({out}, '[^0-9a-z\\x{{80}}-\\x{{10FFFF}}]+', ' ', 'g'))"


def _sql() -> str:
    """The same over DuckDB's ``documents``, for unique doc_ids."""
    rows = [("text", name, text) for name, texts in TEXTS.items() for text in texts]
    for name, forms in NAMES.items():
        rows += [("line", name, f"{opening} {form}".strip()) for opening in ("", *OPENINGS) for form in forms]
    values = ", ".join("(" + ", ".join("'" + x.replace("'", "''") + "'" for x in r) + ")" for r in rows)
    return f"""
WITH known AS (SELECT DISTINCT kind, license, {_sql_normal("t")} AS form FROM (VALUES {values}) AS v(kind, license, t)),
lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
found AS (
  SELECT doc_id, count(k.license) AS n, coalesce(string_agg(DISTINCT k.license, ',' ORDER BY k.license), '') AS names,
    count(*) FILTER (regexp_matches(lower(line), '^[ \\t]*(copyright|\\(c\\)|©)')) AS c
  FROM lines LEFT JOIN known k ON k.kind = 'line' AND k.form = {_sql_normal("line")} GROUP BY doc_id
)
SELECT d.doc_id, k.license AS text_license, names AS line_licenses, n AS n_license_lines, c AS n_copyright_lines
FROM documents d JOIN found f USING (doc_id) LEFT JOIN known k ON k.kind = 'text' AND k.form = {_sql_normal("d.text")}
"""


SQL = _sql()
