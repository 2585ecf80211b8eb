"""Licence scans: sparse TF-IDF cosine of headers, lines and licence files to templates, and inheritance along directories.

Everything is a DataFrame or SQL expression; the template weights are literals of the query.
"""

from __future__ import annotations

import functools
import math
import operator
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The notices by which common licences announce themselves.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0 Universal."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
# Paragraphs of the short licences.
MIT_TERMS = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions:")
MIT_REST = (
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE "
    "FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
    "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
BSD_TERMS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
    "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution.")
BSD_REST = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
    "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
BSD_NAMES = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission.")
# Headings of licence files and headers of source files.
HEADERS = (
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
     "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
     "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or "
     "agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS "
     "OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("BSD-3-Clause", BSD_NAMES),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
     "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
     "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
     "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", MIT_TERMS),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
     "with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
)
# Whole texts of the short licences.
WHOLE_TEXTS = (
    ("BSD-2-Clause", f"{BSD_TERMS} {BSD_REST}"),
    ("BSD-3-Clause", f"{BSD_TERMS} 3. {BSD_NAMES} {BSD_REST}"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
     "that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", f"MIT License {MIT_TERMS} {MIT_REST}"),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
     "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
     "non-commercial, and by any means."),
)
TEMPLATES = (*NOTICES, *HEADERS, *WHOLE_TEXTS, *(
    (name, f"SPDX-License-Identifier: {name}") for name in sorted({name for name, _ in (*NOTICES, *HEADERS, *WHOLE_TEXTS)})))
# Without one of these a passage is no notice, however near its other words come to a template.
MARKS = ("licens", "licenc", "permission", "permitted", "public domain", "cc0", "free software")
TOKEN = r"[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*"
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|copyright|notice)[^/]*$"
OTHER_WORD = 3.0
MARGIN = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+\z"  # comment marks and blanks around a text
GAP = r"\n(?:[^\p{L}\p{N}\n]*\n)+"  # one or more lines without letters or digits end a paragraph


def tokens_of(notice: str) -> list[str]:
    return re.findall(r"[^\W_]+(?:[.-][^\W_]+)*", notice.lower())


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def directory(path: Column) -> Column:
    """The part before the last slash; empty at the top."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def weighted(templates) -> tuple[dict[str, float], list[tuple[str, int, str, float]]]:
    """The weight of each word of the templates; and (word, template, licence, what one such word adds to the cosine).

    A word in n of T templates weighs ``ln((1 + T) / (1 + n)) + 1``; any other word weighs ``OTHER_WORD``. The
    weights hang on the templates alone, so what is found in a text does not hang on the table it stands in.
    """
    bags = [(name, Counter(tokens_of(text))) for name, text in templates]
    held = Counter(t for _, bag in bags for t in bag)
    idf = {t: math.log((1 + len(bags)) / (1 + n)) + 1 for t, n in sorted(held.items())}
    norms = [math.sqrt(sum((n * idf[t])**2 for t, n in bag.items())) for _, bag in bags]
    return idf, [(t, k, name, n * idf[t]**2 / norms[k]) for k, (name, bag) in enumerate(bags) for t, n in bag.items()]


def marked(text: Column) -> Column:
    """Whether a text holds one of the marks; within the function it is lowered once."""
    any_of = lambda low: functools.reduce(operator.or_, (low.contains(m) for m in MARKS))
    return F.exists(F.array(F.lower(text)), any_of)


def passages(files: DataFrame, whole: Column, id_col: str, text_col: str) -> DataFrame:
    """(id, at, place, text): the marked paragraphs of each text and their lines, and for a licence file its whole text.

    ``at`` numbers the paragraphs from 0 (-1 for a whole file); ``place`` is header for the first, footer for the last of several, body, or file.
    """
    texts = files.where(marked(F.col(text_col))).select(
        F.col(id_col).alias("id"), F.coalesce(whole, F.lit(False)).alias("whole"), F.regexp_replace(text_col, MARGIN, "").alias("text"))
    texts = texts.withColumn("paragraphs", F.split("text", GAP))
    last = F.size("paragraphs") - 1
    parts = F.transform("paragraphs", lambda p, i: F.struct(
        i.alias("at"), F.when(i == 0, "header").when(i == last, "footer").otherwise("body").alias("place"), p.alias("text")))
    file = F.struct(F.lit(-1).alias("at"), F.lit("file").alias("place"), F.col("text").alias("text"))
    parts = F.when(F.col("whole"), F.concat(F.array(file), parts)).otherwise(parts)
    parts = texts.select("id", F.explode(parts).alias("p")).select("id", "p.at", "p.place", "p.text").where(marked(F.col("text")))
    lines = F.when(F.col("place") == "file", F.array("text")).otherwise(F.array_distinct(F.concat(F.array("text"), F.split("text", "\n"))))
    return parts.select("id", "at", "place", F.explode(lines).alias("text")).where(marked(F.col("text")))


def matches(files: DataFrame, whole: Column, templates=TEMPLATES, least: float = 0.75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_notices, licence, score, place): for each text with passages near a template, the best of them.

    A passage is a vector of word counts times weights (``weighted``); every passage is compared with every template.
    ``n_notices`` counts paragraphs with such a passage, and the whole of a licence file (``whole``) as one more. A whole
    file goes before its passages, then the best score, the first paragraph and the first template by name.
    """
    idf, adds = weighted(templates)
    values = ", ".join(f"('{t}', {k}, '{name}', {add!r}D)" for t, k, name, add in adds)
    shares = files.sparkSession.sql(f"SELECT * FROM VALUES {values} AS (t, k, licence, adds)")  # a row for each word of each template
    weights, known = F.create_map(*(F.lit(x) for pair in idf.items() for x in pair)), F.array(*map(F.lit, idf))
    found = passages(files, whole, id_col, text_col).withColumn("words", tokens(F.col("text"))).select(
        "id", "at", "place", F.size("words").alias("n"), F.filter("words", lambda w: F.array_contains(known, w)).alias("own"))
    # The cosine can be reached only if the known words outweigh the others; the largest weight bounds them.
    others, most = (F.col("n") - F.size("own")) * OTHER_WORD**2, F.pow(F.size("own") * max(idf.values()), F.lit(2))
    found = found.where((F.size("own") > 0) & (others <= most * (1 / least**2 - 1)))
    count = lambda t: F.size(F.filter("own", lambda w: w == t))
    found = found.select("id", "at", "place", others.alias("others"), F.transform(
        F.array_distinct("own"), lambda t: F.struct(t.alias("t"), count(t).alias("n"))).alias("bag"))
    square = F.aggregate("bag", F.lit(0.0), lambda s, b: s + F.pow(b["n"] * weights[b["t"]], F.lit(2)))
    found = found.select(F.monotonically_increasing_id().alias("passage"), "id", "at", "place", F.sqrt(square + F.col("others")).alias("norm"), "bag")
    found = found.select("passage", "id", "at", "place", "norm", F.inline("bag")).join(F.broadcast(shares), "t")
    found = found.groupBy("passage", "id", "at", "place", "norm", "k", "licence").agg(F.sum(F.col("n") * F.col("adds")).alias("dot"))
    found = found.select("id", "at", "place", F.struct((-F.round(F.col("dot") / F.col("norm"), 4)).alias("rank"), "licence").alias("b"))
    found = found.where(F.col("b.rank") <= -least)
    found = found.groupBy("id", "at", "place").agg(F.min("b").alias("b"))
    first = F.min(F.struct((F.col("place") != "file").alias("later"), "b.rank", "at", "b.licence", "place"))
    return found.groupBy("id").agg(F.count("*").alias("n_notices"), first.alias("b")).select(
        F.col("id").alias(id_col), "n_notices", "b.licence", (-F.col("b.rank")).alias("score"), "b.place")


def scan(files: DataFrame, path: Column, licence_file: Column | None = None, templates=TEMPLATES, least: float = 0.75,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, path, n_notices, score, licence, origin) of every row.

    ``licence`` is the row's own notice (``origin`` is its own path) or else that of the licence file in the
    nearest directory at or above it (``origin`` is that file's path), else null. ``licence_file`` says which
    rows with a notice speak for their directory, by file name unless given; it may use the columns of
    ``files`` and ``n_notices``, ``score`` and ``place``. Of several in one directory the best score counts,
    then the smallest path.

    Null and empty texts have no notice; a row with a null path inherits nothing; rows with a null id have
    no notice of their own; rows that repeat an id share its notice. A very long text is taken whole, paragraph by
    paragraph; further columns are left out, whatever their names. Empty tables give no rows.
    """
    here = files.withColumn("_path", path)
    by_name = F.col("_path").rlike(LICENCE_FILE)
    found = matches(here, F.col("_path").rlike(LICENCE_FILE), templates, least, id_col, text_col).checkpoint()  # a row for each text with a notice; read three times
    own = here.drop(*{"n_notices", "score", "licence", "place"} & set(files.columns)).join(found, id_col, "left").select(
        F.col(id_col).alias("id"), F.col("_path").alias("path"), directory(F.col("_path")).alias("dir"), "n_notices", "score", "licence",
        F.coalesce(by_name if licence_file is None else licence_file, F.lit(False)).alias("speaks"))
    placed = own.where("speaks AND licence IS NOT NULL AND path IS NOT NULL").groupBy("dir").agg(
        F.min(F.struct((-F.col("score")).alias("rank"), "path", "licence")).alias("file"))
    steps = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(steps, 1, n), "/").alias("up")))
    nearest = (own.where("dir IS NOT NULL").select("dir").distinct().select("dir", F.explode(above).alias("a")).select("dir", "a.depth", "a.up")
               .join(placed.withColumnRenamed("dir", "up"), "up").groupBy("dir").agg(F.max_by("file", "depth").alias("file")))
    return own.join(nearest, "dir", "left").select(
        F.col("id").alias(id_col), "path", F.coalesce("n_notices", F.lit(0).cast("long")).alias("n_notices"), "score",
        F.coalesce("licence", "file.licence").alias("licence"),
        F.when(F.col("licence").isNotNull(), F.col("path")).otherwise(F.col("file.path")).alias("origin"))
