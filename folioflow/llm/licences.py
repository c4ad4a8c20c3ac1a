"""Licence scan: TF-IDF cosine of headers and licence files to templates, then inheritance along paths.

Lines that speak of a licence are cut out of each file; their sparse term vectors meet those of the templates in one
equi-join on the term, and the dot products are summed per line. Leading comments, paragraphs, whole licence files and SPDX identifiers
have vectors of their own, with damped counts, against full texts, usual headers and identifiers; the join on the term alone finds their
candidates. Files named like a licence set that of their directory. A file
without a licence of its own takes that of the nearest directory above it: directories, not files, are
joined with their ancestors, and files then look up their directory. Built-in expressions only.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm.common import ascii_lower, indices, let, small, words, written

LEAST = 0.5
# Short notices by licence, in public wording.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "Apache-2.0-short": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted under the BSD 3-Clause License.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License, CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "This work is dedicated to the public domain under CC0 1.0 Universal license.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
# Notices of several lines and short whole texts; further whole texts by licence are files beside this module.
_GNU = ("This program is free software{0} you can redistribute it and/or modify it under the terms of the GNU {1} as published by the Free Software Foundation, "
        "either version {2} of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1} for more details. You should have "
        "received a copy of the GNU {1} along with this program; if not, see <https://www.gnu.org/licenses/>.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
        "and/or other materials provided with the distribution. {0}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR "
        "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT "
        "SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
        "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
        "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
        "POSSIBILITY OF SUCH DAMAGE.")
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy "
     "of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is "
     "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
     "permissions and limitations under the License."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("BSD-2-Clause", _BSD.format("")),
    ("BSD-3-Clause", _BSD.format("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
                                 "software without specific prior written permission. ")),
    ("GPL-2.0", _GNU.format(";", "General Public License", "2")),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", _GNU.format(":", "General Public License", "3")),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", _GNU.format(":", "Affero General Public License", "3")),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("LGPL-2.1", _GNU.format(";", "Lesser General Public License", "2.1")),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", _GNU.format(":", "Lesser General Public License", "3")),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice "
     "and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
     "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
     "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
     "USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the "
     "Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
     "and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be "
     "included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
     "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
     "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
     "DEALINGS IN THE SOFTWARE."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one "
     "at http://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, "
     "either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
]
SPDX = {k: [k] for k in "Apache-2.0 BSD-2-Clause BSD-3-Clause CC-BY-4.0 CC-BY-NC-4.0 CC0-1.0 ISC MIT MPL-2.0 Unlicense".split()} | {
    k: [k, f"{k}-only", f"{k}-or-later"] for k in "AGPL-3.0 GPL-2.0 GPL-3.0 LGPL-2.1 LGPL-3.0".split()}
SPDX_KNOWN = sorted({x for ids in SPDX.values() for x in ids})
#: Lines of nothing but comment marks part paragraphs; a comment at the head of a file, by its kind.
PARTING = r"\r?\n[ \t/*#;%\x22'!<>=\x2D]*+(?=\r?\n)"
IN_MARKS = r"(?s)^\s*+(?:<\?[a-z]*+\s*+)?(/\*.*?\*/|<!--.*?-->|\x22{3}.*?\x22{3})"
NO_COMMENT = r"^(?![ \t]*+(?:#|//|--|;|%))"
HINT = r"(?i)licen[sc]e|copyright|SPDX|public domain"
#: Terms end at all but letters, digits, dots and hyphens; dots and hyphens at their ends do not count.
BETWEEN = r"[^0-9A-Za-z.\x2D]+"
LICENCE_FILE = r"(?i)^(licen[sc]e|copying|notice|unlicen[sc]e)([.\x2D_].*)?$"


def terms(text: Column) -> Column:
    cut = F.transform(words(ascii_lower(text), BETWEEN), lambda w: F.regexp_replace(w, r"^[.\x2D]+|[.\x2D]+$", ""))
    return F.array_remove(cut, "")


def templates(spark: SparkSession, texts: dict[str, str] | None = None) -> tuple[DataFrame, float]:
    """(template, term, weight) with unit norm per template and (by ``idf``) the weights of terms, and that of unknown terms."""
    texts = TEMPLATES if texts is None else texts
    rows = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(k).alias("template"), F.lit(v).alias("text")) for k, v in sorted(texts.items())])))
    counted = rows.select("template", F.explode(terms(F.col("text"))).alias("term")).groupBy("template", "term").agg(F.count("*").alias("tf"))
    n = len(texts)
    seen = counted.groupBy("term").agg((F.log((F.lit(1.0) + n) / (1 + F.count("*"))) + 1).alias("idf"))
    weighed = counted.join(seen, "term").withColumn("w", F.col("tf") * F.col("idf"))
    norm = weighed.groupBy("template").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return weighed.join(norm, "template").select("template", "term", "idf", (F.col("w") / F.col("norm")).alias("weight")), n


def notices(spark: SparkSession) -> tuple[DataFrame, dict[str, list[str]], dict[str, int]]:
    """(space, term, idf, weights by template) of notices and of SPDX identifiers; by space, the licences of the templates, and their number."""
    whole = [(p.stem, p.read_text("utf-8")) for p in sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))]
    texts = {"notice": NOTICES + whole, "spdx": [(k, f"SPDX-License-Identifier: {x}") for k, ids in SPDX.items() for x in ids]}
    rows = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(space).alias("space"), F.lit(i).alias("i"), F.lit(t).alias("text"))
                                                    for space, given in texts.items() for i, (_, t) in enumerate(given)])))
    counted = rows.select("space", "i", F.explode(terms(F.col("text"))).alias("term")).groupBy("space", "i", "term").agg((1 + F.log(F.count("*"))).alias("tf"))
    n = F.when(F.col("space") == "spdx", len(texts["spdx"])).otherwise(len(texts["notice"]))
    seen = counted.groupBy("space", "term").agg(F.count("*").alias("df")).select("space", "term", F.log((1 + n) / F.col("df")).alias("idf"))
    weighed = counted.join(seen, ["space", "term"]).withColumn("w", F.col("tf") * F.col("idf"))
    norm = weighed.groupBy("space", "i").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    weights = (weighed.join(norm, ["space", "i"]).groupBy("space", "term", "idf")
               .agg(F.map_from_entries(F.collect_list(F.struct("i", F.col("w") / F.col("norm")))).alias("by")))
    most = max(map(len, texts.values()))
    known = weights.select("space", "term", "idf", F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda i: F.coalesce(F.col("by")[i], F.lit(0.0))).alias("weights"))
    return known, {k: [name for name, _ in v] for k, v in texts.items()}, {k: len(v) for k, v in texts.items()}


def _blocks(path: Column, text: Column) -> Column:
    """(space, text): every paragraph, the comment that a file begins with, the whole of a licence file, and every SPDX identifier."""
    def lead(lines: Column) -> Column:
        end = F.array_position(F.transform(lines, lambda x: F.regexp_like(x, F.lit(NO_COMMENT))), F.lit(True)).cast("int")
        return F.array_join(F.slice(lines, F.lit(1), F.when(end == 0, F.size(lines)).otherwise(end - 1)), "\n")

    licence_file = F.regexp_like(F.regexp_extract(path, r"[^/]*$", 0), F.lit(LICENCE_FILE))
    notice = F.array_distinct(F.concat(F.split(text, PARTING, -1), F.array(F.regexp_extract(text, IN_MARKS, 1)), F.array(let(F.split(F.ltrim(text), "\n"), lead)),
                                       F.when(licence_file, F.array(text)).otherwise(F.array().cast("array<string>"))))
    spdx = F.array_distinct(F.regexp_extract_all(text, F.lit(r"(SPDX-License-Identifier:[^\n]*)"), F.lit(1)))
    return F.concat(F.transform(notice, lambda t: F.struct(F.lit("notice").alias("space"), t.alias("text"))),
                    F.transform(spdx, lambda t: F.struct(F.lit("spdx").alias("space"), t.alias("text"))))


def _frequencies(of: Column) -> Column:
    """(term, damped count) of every different term: runs in the sorted list."""
    def runs(s: Column) -> Column:
        starts = F.filter(indices(F.size(s)), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        return let(starts, lambda at: F.transform(at, lambda i, j: F.struct(
            F.get(s, i).alias("term"), (1 + F.log(F.coalesce(F.get(at, j + 1), F.size(s)) - i)).alias("tf"))))

    return let(F.sort_array(of), runs)


def block_licences(files: DataFrame, path: str = "path", text: str = "text", least: float = LEAST) -> DataFrame:
    """(path, template, similarity) of blocks and notices at least that much alike. Terms are summed up in the tasks that read them: a row per block is shuffled."""
    known, names, n = notices(files.sparkSession)
    known = F.broadcast(written(known, "notices"))  # as many rows as the notices have terms
    unknown = F.when(F.col("space") == "spdx", F.log(F.lit(1.0) + n["spdx"])).otherwise(F.log(F.lit(1.0) + n["notice"]))
    blocks = (files.where(F.col(text).isNotNull()).select(F.col(path).alias("path"), F.inline(_blocks(F.col(path), F.col(text))))
              .select("path", "space", F.monotonically_increasing_id().alias("block"), _frequencies(terms(F.col("text"))).alias("tfs")))
    all_sq = F.aggregate("tfs", F.lit(0.0), lambda a, x: a + x["tf"] * x["tf"])  # before the terms become rows: once per block
    met = blocks.withColumn("all_sq", all_sq).select("path", "space", "block", "all_sq", F.inline("tfs")).join(known, ["space", "term"])
    sq, idf = F.col("tf") * F.col("tf"), F.col("idf")
    most = max(n.values())
    sums = met.groupBy("path", "space", "block", "all_sq").agg(
        F.sum(sq).alias("known_tf"), F.sum(sq * idf * idf).alias("known_sq"), *[F.sum(F.col("tf") * idf * F.col("weights")[i]).alias(f"dot{i}") for i in range(most)])
    norm = F.sqrt(F.col("known_sq") + unknown * unknown * F.greatest(F.lit(0.0), F.col("all_sq") - F.col("known_tf")))
    dots = lambda space: F.array(*[F.struct(F.lit(name).alias("template"), F.col(f"dot{i}").alias("dot")) for i, name in enumerate(names[space])])
    return (sums.select("path", norm.alias("norm"), F.inline(F.when(F.col("space") == "spdx", dots("spdx")).otherwise(dots("notice"))))
            .select("path", "template", F.round(F.col("dot") / F.col("norm"), 6).alias("similarity")).where(F.col("similarity") >= least))


def expressions(files: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """(path, template, similarity) of SPDX expressions of several identifiers, as written but for spacing; all of them must be known."""
    said = F.regexp_extract_all(F.col(text), F.lit(r"SPDX-License-Identifier:[ \t]*([^\r\n]*)"), F.lit(1))
    rows = files.where(F.contains(F.col(text), F.lit("SPDX-License-Identifier:"))).select(F.col(path).alias("path"), F.explode(said).alias("said"))
    written_out = F.regexp_replace(F.trim(F.regexp_extract("said", r"^((?:[A-Za-z0-9.+\-]+|[() \t])*)", 1)), r"[ \t]+", " ")
    ids = F.array_remove(F.split(F.regexp_replace(F.col("template"), r"[()]", " "), r"\s+(?:AND|OR|WITH)\s+|\s+", -1), "")
    known = F.forall(ids, lambda x: F.regexp_replace(x, r"\+$", "").isin(*SPDX_KNOWN))
    return (rows.select("path", written_out.alias("template")).where(F.col("template").rlike(r" (?:AND|OR|WITH) ") & known)
            .distinct().select("path", "template", F.lit(1.0).alias("similarity")))


def own_licences(files: DataFrame, path: str = "path", text: str = "text", least: float = LEAST) -> DataFrame:
    """(path, licence, similarity) of the most alike template of any licence line or block of a file; ties go to the first name.

    Files without such a line or block, null and empty texts are left out. Repeated paths are one file with all their lines and blocks.
    """
    spark = files.sparkSession
    known, n = templates(spark)
    known = written(known, "templates")
    unknown = F.log(F.lit(1.0) + n) + 1
    idf = F.broadcast(known.select("term", "idf").distinct())  # as many rows as the templates have terms
    lines = (files.where(F.col(text).rlike(HINT)).select(F.col(path).alias("path"), F.explode(F.split(text, "\n")).alias("line"))
             .where(F.col("line").rlike(HINT)).distinct())
    tf = (lines.select("path", "line", F.explode(terms(F.col("line"))).alias("term")).groupBy("path", "line", "term").agg(F.count("*").alias("tf"))
          .join(idf, "term", "left").withColumn("w", F.col("tf") * F.coalesce("idf", unknown)).select("path", "line", "term", "w"))
    tf = written(tf, "line-terms")
    norm = tf.groupBy("path", "line").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = (tf.join(F.broadcast(known.select("template", "term", "weight")), "term").groupBy("path", "line", "template")
            .agg(F.sum(F.col("w") * F.col("weight")).alias("dot")))
    cosine = dots.join(norm, ["path", "line"]).select("path", "template", F.round(F.col("dot") / F.col("norm"), 6).alias("similarity")).where(F.col("similarity") >= least)
    cosine = cosine.unionByName(block_licences(files, path, text, least)).unionByName(expressions(files, path, text))
    best = cosine.groupBy("path").agg(F.min(F.struct((-F.col("similarity")).alias("s"), "template")).alias("b"))
    return best.select("path", F.regexp_replace(F.col("b")["template"], "-short$", "").alias("licence"), (-F.col("b")["s"]).alias("similarity"))


def _directory(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def _above(directory: Column) -> Column:
    """(ancestor, up): the directory itself, up 0, and all above it, the root "" last."""
    return let(F.array_remove(F.split(directory, "/"), ""), lambda parts: F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.struct(
        F.array_join(F.slice(parts, F.lit(1), F.size(parts) - i), "/").alias("ancestor"), i.alias("up"))))


def scan(files: DataFrame, path: str = "path", text: str = "text", least: float = LEAST) -> DataFrame:
    """(path, licence, similarity, origin) for every row: ``own``, ``inherited`` or null.

    Several licence files in a directory: the most alike counts, then the first name, then the first path. A licence file that no
    template is like, empty or null ones too, ends inheritance: what lies below it has no licence, and origin ``unknown``. A null path has no
    directory and inherits nothing, but may have an own licence.
    """
    rows = files.select(F.col(path).alias("path"), F.col(text).alias("text"))
    own = written(own_licences(rows.withColumn("path", F.coalesce("path", F.lit("\u0000"))), least=least), "own-licences")
    name = F.regexp_extract("path", r"[^/]*$", 0)
    licence_files = rows.where(F.regexp_like(name, F.lit(LICENCE_FILE))).select("path").distinct().join(own, "path", "left")
    licence_files = licence_files.where(F.col("licence").isNotNull() | ~F.regexp_like(name, F.lit("(?i)^notice")))  # a mere notice ends nothing
    # Recognised ones come first, as their similarity counts negative.
    stated = (licence_files.groupBy(_directory(F.col("path")).alias("ancestor")).agg(F.min(F.struct(F.coalesce(-F.col("similarity"), F.lit(1.0)).alias("s"), "licence", "path")).alias("b"))
              .select("ancestor", F.col("b")["licence"].alias("licence"), F.when(F.col("b")["s"] <= 0, -F.col("b")["s"]).alias("similarity")))
    directories = rows.where("path IS NOT NULL").select(_directory(F.col("path")).alias("directory")).distinct()
    nearest = (directories.select("directory", F.inline(_above(F.col("directory")))).join(stated, "ancestor")
               .groupBy("directory").agg(F.min(F.struct("up", "licence", "similarity")).alias("b"))
               .select("directory", F.col("b")["licence"].alias("given"), F.col("b")["similarity"].alias("given_similarity"), F.lit(True).alias("told")))
    nearest = small(written(nearest, "directory-licences"))
    own = own.select(F.col("path").alias("key"), "licence", "similarity")
    out = (rows.select("path", F.coalesce("path", F.lit("\u0000")).alias("key"), _directory(F.col("path")).alias("directory"))
           .join(own, "key", "left").join(nearest, "directory", "left"))
    origin = F.when(F.col("licence").isNotNull(), F.lit("own")).when(F.col("given").isNotNull(), F.lit("inherited")).when(F.col("told"), F.lit("unknown"))
    return out.select("path", F.coalesce("licence", "given").alias("licence"),
                      F.when(F.col("licence").isNotNull(), F.col("similarity")).otherwise(F.col("given_similarity")).alias("similarity"), origin.alias("origin"))
