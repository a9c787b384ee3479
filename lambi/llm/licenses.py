"""Licences of files: TF-IDF cosine to templates, then inheritance along paths (operator 9)."""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lambi.llm.shared import cut

# Notices, headers and licence paragraphs as they are published.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("Apache-2.0", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This file is released under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms are permitted under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
#: (licence, text): the notices, whole licence files of their paragraphs, and SPDX lines.
TEMPLATES = NOTICES + [(name, " ".join(t for n, t in NOTICES if n == name)) for name in ("Apache-2.0", "MIT", "BSD-3-Clause")] + [(name, f"SPDX-License-Identifier: {name}") for name in dict.fromkeys(n for n, _ in NOTICES)]
#: Units of at least this cosine to a template carry its licence.
LEAST_COSINE = 0.7
#: Terms from which on a unit is only scored if a bound on its cosine lets it.
UNIT_TERMS = 400
TERM = r"[a-z0-9]+(?:\.[0-9]+)*"
SENTENCE_END = r"[.!?]\s+"
#: Lines without a letter or digit part paragraphs.
PARAGRAPH_END = r"\n(?:[^A-Za-z0-9\n]*\n)+"
#: Tables of up to so many rows are broadcast; larger ones are joined with SALTS copies of a key.
BROADCAST_ROWS, SALTS = 100_000, 16
#: Path of a document in the query: source, language and two digits of the id as folders; a third
#: of the documents lies at each depth.
PATH = "concat(coalesce(source, ''), CASE WHEN doc_id % 3 > 0 THEN concat('/', coalesce(lang, '')) ELSE '' END, CASE WHEN doc_id % 3 > 1 THEN concat('/', CAST(doc_id % 100 AS STRING)) ELSE '' END, '/', CAST(doc_id AS STRING), '.txt')"


def _terms(text: str) -> Counter:
    return Counter(re.findall(TERM, text.lower()))


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def _distinctive(templates: list[Counter], idf: dict[str, float], least: float) -> list[str]:
    """Terms of which a unit must hold one to reach the cosine `least`: without them, the cosine
    is at most the norm of the template's other terms by its norm."""
    norm = lambda t, only: math.sqrt(sum((n * idf[x]) ** 2 for x, n in t.items() if x in only))
    common: set[str] = set()
    for x in sorted(idf, key=lambda x: (idf[x], x)):
        if any(norm(t, common | {x}) >= (least - 1e-6) * norm(t, set(t)) for t in templates):
            break
        common.add(x)
    return sorted(set(idf) - common)


def _can_reach(words: Column, templates: list[tuple[str, Counter]], idf: dict[str, float], least: float) -> Column:
    """Whether a unit may reach the cosine. Weights are at least 1, so its norm is at least the root of
    its number of terms; its product with a template is at most the sum over its terms of their
    largest share in any template."""
    share: dict[str, float] = {}
    for _, t in templates:
        norm = math.sqrt(sum((n * idf[x]) ** 2 for x, n in t.items()))
        for x, n in t.items():
            share[x] = max(share.get(x, 0.0), idf[x] * n * idf[x] / norm)
    table = F.create_map(*(F.lit(v) for kv in sorted(share.items()) for v in kv))
    most = F.aggregate(words, F.lit(0.0), lambda total, x: total + F.coalesce(F.try_element_at(table, x), F.lit(0.0)))
    return most >= (least - 1e-6) * F.sqrt(F.size(words))


def _units(lines: Column, body: Column) -> Column:
    """Sentences, lines, two and three lines together, paragraphs and the whole text."""
    n = F.size(lines)
    from_ = lambda x, start, less: F.slice(x, F.lit(start), F.greatest(n - less, F.lit(0)))
    joined = lambda a, b: F.zip_with(a, b, lambda x, y: F.concat_ws(" ", x, y))
    two = joined(from_(lines, 1, 1), from_(lines, 2, 1))
    three = joined(from_(two, 1, 2), from_(lines, 3, 2))
    return F.concat(F.flatten(F.transform(lines, lambda x: F.split(x, SENTENCE_END))), lines, two, three, F.split(body, PARAGRAPH_END), F.array(body))


def _join_small(many: DataFrame, few: DataFrame, key: str, how: str) -> DataFrame:
    """many joined with few on a key that may be hot in `many` and is unique in `few`."""
    if few.count() <= BROADCAST_ROWS:
        return many.join(F.broadcast(few), key, how)
    # the salt of a row is the same when a lost task runs again
    salted = many.withColumn("_salt", F.pmod(F.xxhash64(*many.columns), F.lit(SALTS)).cast("int"))
    copies = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, [key, "_salt"], how).drop("_salt")


def _notices(rows: DataFrame, templates: list[tuple[str, str]], least_cosine: float) -> DataFrame:
    """(doc_id, path, own, cosine) of files with a notice of their own."""
    spark = rows.sparkSession
    counted = [(name, _terms(text)) for name, text in templates]
    known = sorted(set().union(*(t for _, t in counted)))
    seen = cut(rows.select(F.explode(F.array_distinct(_words(F.col("body")))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    total = rows.count()
    weight = lambda df: 1 + F.log((F.lit(total + 1.0)) / (df + 1))
    df = {r["term"]: r["df"] for r in seen.where(F.col("term").isin(known)).collect()}
    idf = {x: 1 + math.log((total + 1.0) / (df.get(x, 0) + 1)) for x in known}
    need = F.array(*map(F.lit, _distinctive([t for _, t in counted], idf, least_cosine)))

    near = rows.where(F.arrays_overlap(_words(F.col("body")), need)).select("doc_id", "path", "body", F.split("body", "\n").alias("lines"))
    units = near.select("doc_id", "path", F.explode(_units(F.col("lines"), F.col("body"))).alias("unit")).select("doc_id", "path", _words(F.col("unit")).alias("words"))
    units = units.where(F.arrays_overlap("words", need) & ((F.size("words") <= UNIT_TERMS) | _can_reach(F.col("words"), counted, idf, least_cosine))).select("doc_id", "path", F.array_join(F.array_sort("words"), " ").alias("text"))
    units = cut(units.withColumn("key", F.md5("text")).distinct())

    # each distinct unit is scored once, however many files hold it
    counts = units.groupBy("key").agg(F.first("text").alias("text")).select("key", F.explode(F.split("text", " ")).alias("term")).groupBy("key", "term").agg(F.count(F.lit(1)).alias("tf"))
    weighed = cut(counts.join(seen, "term", "left").select("key", "term", (F.col("tf") * weight(F.coalesce("df", F.lit(0)))).alias("w")))
    table = []
    for i, (name, t) in enumerate(counted):
        norm = math.sqrt(sum((n * idf[x]) ** 2 for x, n in t.items()))
        table += [(i, name, x, n * idf[x] / norm) for x, n in sorted(t.items())]
    wanted = spark.createDataFrame(table, "template int, name string, term string, t double")
    dots = weighed.join(F.broadcast(wanted), "term").groupBy("key", "template", "name").agg(F.sum(F.col("w") * F.col("t")).alias("dot"))
    norms = weighed.groupBy("key").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    scored = dots.join(norms, "key").select("key", "name", F.round(F.col("dot") / F.col("norm"), 9).alias("cosine")).where(F.col("cosine") >= least_cosine)
    best = cut(scored.groupBy("key").agg(F.min(F.struct((-F.col("cosine")).alias("worse"), "name")).alias("best")))
    found = _join_small(units.select("doc_id", "path", "key"), best, "key", "inner")
    return found.groupBy("doc_id", "path").agg(F.min("best").alias("best")).select("doc_id", "path", F.col("best.name").alias("own"), F.round(-F.col("best.worse"), 4).alias("cosine"))


def scan_licenses(files: DataFrame, path: Column, templates: list[tuple[str, str]] = TEMPLATES, least_cosine: float = LEAST_COSINE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licence of every file: its own notice, or that of the nearest folder above that has one.

    The units of a text are its sentences, its lines, each two and three lines together (wrapped
    headers), its paragraphs and the whole (licence files), of any length. A term
    weighs 1 + ln((N + 1) / (df + 1)) with its document frequency over all N files. A unit's licence
    is that of the template of largest cosine, at least `least_cosine` (ties: the smaller name), a
    file's the one of its best unit. Units without any distinctive template term can't reach the
    cosine and are left out before it is computed. A folder's licence is the one most of its own
    files carry (ties: the smaller name); files without a notice inherit from the nearest ancestor
    folder with a licence, matched by joins on paths of folders.

    Result: id, path, own (licence or null), cosine (of the best unit, 4 places, null without one),
    license, origin (`own`, `inherited`, `none`) and folder (that gave it). Null and empty texts
    have no notice; a very long text is searched whole; a null path counts as the top folder; rows
    that share id and path (null ids as well) share the best notice among them and are each
    returned; further columns are not read. An empty table gives an empty result. Template terms
    are the only thing that reaches the driver.
    """
    rows = files.select(F.col(id_col).alias("doc_id"), F.coalesce(path, F.lit("")).alias("path"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("body"))
    own = cut(_notices(rows, templates, least_cosine))
    folder = F.regexp_extract("path", "^(.*)/", 1)
    votes = own.groupBy(folder.alias("folder"), "own").agg(F.count(F.lit(1)).alias("n"))
    given = cut(votes.groupBy("folder").agg(F.min(F.struct(-F.col("n"), F.col("own").alias("name")))["name"].alias("given")))
    every = rows.select(folder.alias("folder")).distinct()
    above = every.select("folder", F.explode(_ancestors(F.col("folder"))).alias("above"))
    nearest = cut(_join_small(above, given.withColumnRenamed("folder", "above"), "above", "inner").groupBy("folder").agg(F.max_by(F.struct("above", "given"), F.length("above")).alias("near")))
    mine = own.select(F.col("doc_id").alias("own_id"), F.col("path").alias("own_path"), "own", "cosine")
    out = rows.select("doc_id", "path", folder.alias("folder")).join(mine, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("path") == F.col("own_path")), "left")
    out = _join_small(out, nearest, "folder", "left")
    origin = F.when(F.col("own").isNotNull(), "own").when(F.col("near").isNotNull(), "inherited").otherwise("none")
    return out.select("doc_id", "path", "own", "cosine", F.coalesce("own", F.col("near.given")).alias("license"), origin.alias("origin"), F.when(F.col("own").isNull(), F.col("near.above")).alias("folder"))


def _ancestors(folder: Column) -> Column:
    """The folder itself, all folders above it and the top (empty)."""
    parts = F.split(folder, "/")
    inner = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    return F.array_distinct(F.concat(F.array(F.lit("")), inner))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 9 over all documents, at the paths of PATH."""
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"), F.expr(PATH))


def _sql() -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    templates = ", ".join(f"({i}, {quoted(name)}, {quoted(text)})" for i, (name, text) in enumerate(TEMPLATES))
    path = PATH.replace("AS STRING", "AS VARCHAR")
    return f"""
    WITH f AS (SELECT doc_id, {path} AS path, coalesce(text, '') AS body FROM documents),
    n AS (SELECT count(*)::DOUBLE AS total FROM f),
    tt AS (SELECT i, name, term, count(*)::DOUBLE AS tf FROM (SELECT i, name, unnest(regexp_extract_all(lower(text), '{TERM}')) AS term FROM (VALUES {templates}) v(i, name, text)) GROUP BY ALL),
    df AS (SELECT term, count(*) AS df FROM (SELECT unnest(list_distinct(regexp_extract_all(lower(body), '{TERM}'))) AS term FROM f) GROUP BY term),
    ti AS (SELECT tt.*, 1 + ln((total + 1) / (coalesce(df, 0) + 1)) AS idf FROM tt LEFT JOIN df USING (term), n),
    tn AS (SELECT i, sqrt(sum((tf * idf) ** 2)) AS norm FROM ti GROUP BY i),
    l AS (SELECT doc_id, path, body, string_split(body, chr(10)) AS lines FROM f),
    u AS (SELECT doc_id, path, unnest(list_concat(flatten(list_transform(lines, lambda x: regexp_split_to_array(x, '{SENTENCE_END}'))), lines,
            list_transform(range(1, len(lines)), lambda k: concat(lines[k], ' ', lines[k + 1])), list_transform(range(1, len(lines) - 1), lambda k: concat(lines[k], ' ', lines[k + 1], ' ', lines[k + 2])),
            regexp_split_to_array(body, '{PARAGRAPH_END}'), [body])) AS unit FROM l),
    uw AS (SELECT DISTINCT doc_id, path, list_sort(regexp_extract_all(lower(unit), '{TERM}')) AS words FROM u),
    uk AS (SELECT DISTINCT words FROM uw WHERE list_has_any(words, (SELECT list(DISTINCT term) FROM tt))),
    ut AS (SELECT words, term, count(*)::DOUBLE AS tf FROM (SELECT words, unnest(words) AS term FROM uk) GROUP BY ALL),
    uv AS (SELECT words, term, tf * (1 + ln((total + 1) / (coalesce(df, 0) + 1))) AS w FROM ut LEFT JOIN df USING (term), n),
    un AS (SELECT words, sqrt(sum(w * w)) AS norm FROM uv GROUP BY words),
    dot AS (SELECT words, ti.i, name, sum(w * tf * idf) AS dot FROM uv JOIN ti USING (term) GROUP BY ALL),
    best AS (SELECT words, arg_min(name, (-cosine, name)) AS name, max(cosine) AS cosine FROM (SELECT dot.words, name, round(dot / (un.norm * tn.norm), 9) AS cosine FROM dot JOIN un USING (words) JOIN tn USING (i)) WHERE cosine >= {LEAST_COSINE} GROUP BY words),
    own AS (SELECT doc_id, path, arg_min(name, (-cosine, name)) AS own, max(cosine) AS cosine FROM uw JOIN best USING (words) GROUP BY ALL),
    votes AS (SELECT regexp_extract(path, '^(.*)/', 1) AS folder, own, count(*) AS n FROM own GROUP BY ALL),
    given AS (SELECT folder, arg_min(own, (-n, own)) AS given FROM votes GROUP BY folder),
    near AS (SELECT d.folder, arg_max(g.folder, length(g.folder)) AS above, arg_max(given, length(g.folder)) AS given
             FROM (SELECT DISTINCT regexp_extract(path, '^(.*)/', 1) AS folder FROM f) d JOIN given g ON d.folder = g.folder OR g.folder = '' OR starts_with(d.folder, g.folder || '/') GROUP BY d.folder)
    SELECT f.doc_id, f.path, own, round(cosine, 4) AS cosine, coalesce(own, given) AS license,
           CASE WHEN own IS NOT NULL THEN 'own' WHEN given IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin, CASE WHEN own IS NULL THEN above END AS folder
    FROM f LEFT JOIN own ON f.doc_id IS NOT DISTINCT FROM own.doc_id AND f.path = own.path LEFT JOIN near ON near.folder = regexp_extract(f.path, '^(.*)/', 1)"""


ORACLE = _sql()
