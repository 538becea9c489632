"""Licence scan: texts against licence templates by the Dice coefficient over word bigrams.  DataFrame functions only.

Each line of a document, and the document as a whole if it has several lines, is a unit.  A unit is
normalised (ASCII letters and digits, lower case, one space) and compared, as a set of word bigrams,
to every template whose size allows a coefficient of ``least``: with |A| bigrams in the template only
units of ``|A| * least / (2 - least)`` to ``|A| * (2 - least) / least`` distinct bigrams can reach it.
The bigrams of the templates are a fixed list that travels to every task; shared ones are counted by
a join on the bigram, so no unit meets a template without a common bigram.

Defined cases: null and blank texts, and units of fewer than two words, match nothing; null ids and
repeated rows are scanned like any other; of equal coefficients the template first in the list wins;
a text of any length is scanned whole; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEAST = 0.8

#: Fixed values: (licence, template text).  Short notices first, then permissive licences in full or by their grant.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License.",
    ),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope "
        "that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
        "See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. "
        "If not, see <https://www.gnu.org/licenses/>.",
    ),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        "copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD "
        "TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, "
        "OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER "
        "TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
        "and/or other materials provided with the distribution.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this "
        "software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
]


def template_bigrams(text: str) -> list[str]:
    words = re.sub(r"[^A-Za-z0-9]+", " ", text).strip().lower().split(" ")
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def scan_licenses(spark: SparkSession, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, least: float = LEAST) -> DataFrame:
    """(doc_id, unit, template, license, shared, n_bigrams, dice): the best template of every unit that reaches ``least``.

    ``unit`` is the line's number from 0, or -1 for the whole document; ``template`` the place in the list.
    """
    own = [(k, name, template_bigrams(text)) for k, (name, text) in enumerate(templates)]
    # A little wider than the bounds, which rounding may otherwise put below a size that reaches them exactly.
    low, high = least / (2 - least) - 1e-9, (2 - least) / least + 1e-9
    fewest, most = min(len(b) for _, _, b in own) * low, max(len(b) for _, _, b in own) * high
    listed = spark.createDataFrame([(k, name, len(b), x) for k, name, b in own for x in b], "template int, license string, size int, bigram string")

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    lines = F.split("text", "\n")
    units = rows.select(
        "row", "doc_id",
        F.posexplode(F.when(F.size(lines) > 1, F.concat(F.array("text"), lines)).otherwise(F.concat(F.array(F.lit("")), lines))).alias("at", "line"),
    )
    # explode(array(x)) computes x once: merged projections would work it out again wherever it is used.
    once = lambda x: F.explode(F.array(x))
    clean = F.split(F.lower(F.trim(F.regexp_replace("line", "[^A-Za-z0-9]+", " "))), " ")
    words = units.select("row", "doc_id", (F.col("at") - 1).alias("unit"), once(clean).alias("w")).where(F.size("w") - 1 >= fewest)
    pairs = F.zip_with(F.slice("w", 1, F.size("w") - 1), F.slice("w", 2, F.size("w") - 1), lambda a, b: F.concat(a, F.lit(" "), b))
    sets = words.select("row", "doc_id", "unit", once(F.array_distinct(pairs)).alias("b")).withColumn("n_bigrams", F.size("b")).where(F.col("n_bigrams").between(fewest, most))
    fits = F.col("n_bigrams").between(F.col("size") * low, F.col("size") * high)
    met = sets.select("row", "doc_id", "unit", "n_bigrams", F.explode("b").alias("bigram")).join(F.broadcast(listed), "bigram").where(fits)
    shared = met.groupBy("row", "doc_id", "unit", "n_bigrams", "template", "license", "size").agg(F.count("*").alias("shared"))
    scored = shared.withColumn("dice", 2.0 * F.col("shared") / (F.col("n_bigrams") + F.col("size"))).where(F.col("dice") >= least)
    best = scored.groupBy("row", "doc_id", "unit", "n_bigrams").agg(F.max_by(F.struct("template", "license", "shared", "dice"), F.struct("dice", -F.col("template"))).alias("x"))
    return best.select("doc_id", "unit", "x.template", "x.license", "x.shared", "n_bigrams", "x.dice")


def oracle_sql(templates=TEMPLATES, least: float = LEAST) -> str:
    """The same scan in the oracle's SQL."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({k}, {quote(name)}, {quote(text)})" for k, (name, text) in enumerate(templates))
    return f"""
        WITH t0(template, license, body) AS (VALUES {values}),
        norm AS (SELECT template, license, string_split(lower(trim(regexp_replace(body, '[^A-Za-z0-9]+', ' ', 'g'))), ' ') AS w FROM t0),
        t AS (SELECT template, license, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS b FROM norm),
        d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
        u AS (SELECT r, doc_id, -1 AS unit, text AS line FROM d WHERE contains(text, chr(10))
              UNION ALL SELECT r, doc_id, unnest(range(0, len(string_split(text, chr(10))))) AS unit, unnest(string_split(text, chr(10))) AS line FROM d),
        uw AS (SELECT r, doc_id, unit, string_split(lower(trim(regexp_replace(line, '[^A-Za-z0-9]+', ' ', 'g'))), ' ') AS w FROM u),
        ub AS (SELECT r, doc_id, unit, unnest(list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS g FROM uw WHERE len(w) > 1),
        un AS (SELECT r, unit, count(*) AS n FROM ub GROUP BY ALL),
        tb AS (SELECT template, license, len(b) AS size, unnest(b) AS g FROM t),
        m AS (SELECT r, doc_id, unit, template, license, size, count(*) AS shared FROM ub JOIN tb USING (g) GROUP BY ALL),
        s AS (SELECT m.*, n, 2.0 * shared / (n + size) AS dice FROM m JOIN un USING (r, unit)),
        k AS (SELECT *, row_number() OVER (PARTITION BY r, unit ORDER BY dice DESC, template) AS place FROM s WHERE 2 * shared >= {least} * (n + size))
        SELECT doc_id, CAST(unit AS INT) AS unit, CAST(template AS INT) AS template, license, shared, CAST(n AS INT) AS n_bigrams, CAST(dice AS DOUBLE) AS dice FROM k WHERE place = 1
    """
