"""License scans: MinHash bands over overlapping text windows.

Templates are partitioned by size: those of more than ``hi / 2`` and at most
``hi`` five-word shingles.  For each partition a text has overlapping windows
of ``hi + step - 1`` shingles, a window every ``step`` (``hi / 2``) shingles,
so each run of ``hi`` shingles lies whole in some window.  A window that holds
75 % of a template has a Jaccard of at least J with it, J known for each
partition; with single-row bands it shares a band with a probability of
1 - (1 - J)**bands, and a partition gets as many bands as make that GUARANTEE
or more.  Windows that share a band with a template are verified by the exact
share of the template's shingles.

Templates may share wording, as the notices of one family do, and a text of one
then holds much of another too.  All matches are reported; ``best`` says that
no match of a template with which it shares a shingle is better around the same
place: of a larger share, then of more shingles, then of a smaller name.

Anchors: a small set of template words such that fewer than 75 % of any
template's shingles have none of them.  A window without an anchor can match no
template, so only windows with one are signed; nothing is lost by it.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanwright.llm.common import checked_broadcast

WIDTH, PERCENT, GUARANTEE = 5, 75, 0.9999

# Notices and texts as their licensors publish them; of the longest, the opening.
TEMPLATES = {
    "agpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "apache-2.0-short": "Licensed under the Apache License 2.0",
    "apache-2.0-text": 'Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions. "License" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document. "Licensor" shall mean the copyright owner or entity authorized by the copyright owner that is granting the License.',
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-2-clause-text": 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.',
    "bsl-1.0-text": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc0-1.0": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty.",
    "epl-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "gpl-2.0-header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl-2.0-text": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed. Preamble The licenses for most software are designed to take away your freedom to share and change it. By contrast, the GNU General Public License is intended to guarantee your freedom to share and change free software--to make sure the software is free for all its users.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-3.0-short": "Licensed under the GNU General Public License v3",
    "gpl-3.0-text": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed. Preamble The GNU General Public License is a free, copyleft license for software and other kinds of works. The licenses for most software and other practical works are designed to take away your freedom to share and change the works.",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "isc-text": 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.',
    "lgpl-2.1-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "lgpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "mit": "Released under the MIT License.",
    "mit-short": "Licensed under the MIT License.",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
    "mit-whole-text": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense-text": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "zlib-text": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions",
}


def template_words(text: str) -> list[str]:
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def template_shingles(text: str) -> list[tuple[str, ...]]:
    words = template_words(text)
    if len(words) < WIDTH:
        raise ValueError(f"a template needs {WIDTH} words: {text}")
    return list(dict.fromkeys(tuple(words[i : i + WIDTH]) for i in range(len(words) - WIDTH + 1)))


def needed(n: int, percent: int = PERCENT) -> int:
    return -(-n * percent // 100)


def partition(n: int, percent: int = PERCENT) -> dict:
    """Of a template of n shingles: hi, step, window (in shingles), bands."""
    hi = 1 << (n - 1).bit_length()
    step = max(1, hi // 2)
    window = hi + step - 1
    lows = range(hi // 2 + 1, hi + 1)
    least = min(needed(m, percent) / (window + m - needed(m, percent)) for m in lows)
    bands = 1 if least >= 1 else math.ceil(math.log(1 - GUARANTEE) / math.log(1 - least))
    return {"hi": hi, "step": step, "window": window, "bands": bands, "least": least}


def anchors(templates: dict[str, str], percent: int = PERCENT) -> list[str]:
    """Words such that a match of any template has one of them in a shared shingle."""
    chosen: list[str] = []
    for text in templates.values():
        shingles = [set(s) for s in template_shingles(text)]
        while len(left := [s for s in shingles if not s & set(chosen)]) >= needed(len(shingles), percent):
            # Long words are rare ones; they come first.
            chosen.append(max(set().union(*left), key=lambda w: (len(w) > 5, sum(w in s for s in left), len(w), w)))
    return sorted(set(chosen))


def _hashes(words: Column, n: Column) -> Column:
    """Hashes of the shingles of an array of n words."""
    at = F.sequence(F.lit(0), F.greatest(n - WIDTH, F.lit(0)))
    shingle = lambda i: F.xxhash64(*(F.get(words, i + j) for j in range(WIDTH)))
    return F.when(n >= WIDTH, F.array_distinct(F.transform(at, shingle))).otherwise(F.array().cast("array<long>"))


def _signature(shingles: Column, bands: Column) -> Column:
    """The least hash of the shingles in each band."""
    return F.transform(F.sequence(F.lit(1), bands), lambda k: F.array_min(F.transform(shingles, lambda x: F.xxhash64(x, k))))


def license_matches(
    documents: DataFrame, templates: dict[str, str] = TEMPLATES, percent: int = PERCENT, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, license, n_found, n_template, first_word, best): templates in the texts.

    A row for each document and template of which some window has ``percent``
    or more of the shingles: the most in one window, the number of words before
    the first such window, and whether no related template matches better.
    Words are runs of letters and digits, lower-cased, so line breaks and
    punctuation don't matter.  Templates need five words; a shorter one raises.
    Null or empty texts match nothing; rows that repeat a key are one document;
    long texts are read whole; other columns are ignored; an empty table gives
    no rows.
    """
    spark = documents.sparkSession
    shingles = {name: template_shingles(t) for name, t in templates.items()}
    related = {a: [b for b in shingles if a != b and set(shingles[a]) & set(shingles[b])] for a in shingles}
    parts = {name: partition(len(s), percent) for name, s in shingles.items()}
    known = spark.createDataFrame(
        [(name, template_words(t), parts[name]["hi"], parts[name]["bands"], related[name]) for name, t in templates.items()],
        "license string, words array<string>, hi int, bands int, related array<string>",
    ).select("license", "hi", "bands", "related", _hashes(F.col("words"), F.size("words")).alias("t"))
    known = known.select("license", "hi", "t", "related", _signature(F.col("t"), F.col("bands")).alias("t_signature"))

    marks = anchors(templates, percent)
    any_mark = "(?i)" + "|".join(map(re.escape, marks))
    words = F.filter(F.split(F.lower(F.col(f"`{text}`")), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    held = documents.filter(F.col(f"`{text}`").rlike(any_mark)).select(F.col(f"`{key}`").alias("doc_id"), words.alias("words"))
    at = F.filter(F.transform("words", lambda w, i: F.when(w.isin(marks), i)), lambda i: i.isNotNull())
    held = held.select("doc_id", "words", at.alias("at")).filter(F.size("at") > 0)

    sizes = {p["hi"]: p for p in parts.values()}

    def starts(p: dict) -> Column:
        """Starts of the windows with a shingle around an anchor."""
        step, window = p["step"], p["window"]
        low = lambda i: F.greatest(F.ceil((i - WIDTH + 2 - window) / step) * step, F.lit(0))
        each = F.transform("at", lambda i: F.sequence(low(i).cast("int"), (F.floor(i / step) * step).cast("int"), F.lit(step)))
        return F.transform(
            F.array_distinct(F.flatten(each)),
            lambda s: F.struct(F.lit(p["hi"]).alias("hi"), F.lit(window).alias("window"), F.lit(p["bands"]).alias("bands"), s.alias("first_word")),
        )

    windows = held.select("doc_id", "words", F.explode(F.concat(*(starts(p) for p in sizes.values()))).alias("w")).select("doc_id", "words", "w.*")
    windows = windows.select("doc_id", "hi", "window", "bands", "first_word", F.slice("words", F.col("first_word") + 1, F.col("window") + WIDTH - 1).alias("words"))
    windows = windows.select("doc_id", "hi", "window", "bands", "first_word", _hashes(F.col("words"), F.size("words")).alias("shingles")).filter(F.size("shingles") > 0)
    windows = windows.withColumn("signature", _signature(F.col("shingles"), F.col("bands")))
    n_found = F.size(F.array_intersect("shingles", "t"))
    # The templates are a list of this module or of the caller's code; beyond the bound Spark shuffles.
    found = (
        windows.join(checked_broadcast(known), "hi")
        .filter(F.arrays_overlap("signature", "t_signature"))
        .select("doc_id", "license", "related", "window", n_found.alias("n_found"), F.size("t").alias("n_template"), "first_word")
        .filter(F.col("n_found") * 100 >= F.col("n_template") * percent)
        .groupBy("doc_id", "license", "related", "window", "n_template")
        .agg(F.max("n_found").alias("n_found"), F.min("first_word").alias("first_word"), F.min(F.struct((-F.col("n_found")).alias("less"), F.col("first_word").alias("at")))["at"].alias("at"))
    )
    # At most one item for each template in a document's array.
    match = ("license", "related", "window", "n_template", "n_found", "first_word", "at")
    of_document = found.groupBy("doc_id").agg(F.collect_list(F.struct(*match)).alias("all"))

    def outranked(m: Column) -> Column:
        share = lambda x: x["n_found"] / x["n_template"]
        more = lambda o: F.struct(share(o), o["n_template"]) > F.struct(share(m), m["n_template"])
        same = lambda o: (share(o) == share(m)) & (o["n_template"] == m["n_template"]) & (o["license"] < m["license"])
        near = lambda o: F.abs(o["at"] - m["at"]) < F.greatest(o["window"], m["window"])
        return F.exists("all", lambda o: F.array_contains(m["related"], o["license"]) & near(o) & (more(o) | same(o)))

    rows = of_document.select("doc_id", F.explode(F.transform("all", lambda m: F.struct(m.alias("m"), (~outranked(m)).alias("best")))).alias("r"))
    return rows.select("doc_id", *(F.col(f"r.m.{c}").alias(c) for c in ("license", "n_found", "n_template", "first_word")), "r.best")


def license_sql(templates: dict[str, str] = TEMPLATES, percent: int = PERCENT) -> str:
    """DuckDB SQL of license_matches(documents), by all windows."""
    rows, kinds = [], []
    for name, text in templates.items():
        shingles = template_shingles(text)
        p = partition(len(shingles), percent)
        kinds.append(f"('{name}', {p['step']}, {p['window']}, {len(shingles)})")
        rows += [f"('{name}', '{' '.join(s)}')" for s in shingles]
    return f"""
WITH t(license, s) AS (VALUES {", ".join(rows)}),
k(license, step, win, n_template) AS (VALUES {", ".join(kinds)}),
w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL),
n AS (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 4, 0))) AS i FROM w),
d AS (SELECT doc_id, i, array_to_string(w[i + 1:i + 5], ' ') AS s FROM n),
f AS (SELECT doc_id, license, i, d.s, step, win, n_template FROM d JOIN t ON d.s = t.s JOIN k USING (license)),
u AS (SELECT *, unnest(range(greatest(0, ceil((i - win + 1) / step)::BIGINT), i // step + 1)) * step AS first_word FROM f),
c AS (SELECT doc_id, license, win, n_template, first_word, count(DISTINCT s) AS n_found FROM u GROUP BY ALL HAVING count(DISTINCT s) * 100 >= n_template * {percent}),
m AS (SELECT doc_id, license, win, n_template, max(n_found) AS n_found, min(first_word) AS first_word, arg_min(first_word, (-n_found, first_word)) AS place FROM c GROUP BY ALL),
r AS (SELECT DISTINCT a.license AS x, b.license AS y FROM t a JOIN t b ON a.s = b.s AND a.license <> b.license)
SELECT doc_id, license, n_found::INT AS n_found, n_template::INT AS n_template, first_word::INT AS first_word,
  NOT EXISTS (SELECT 1 FROM m o JOIN r ON r.x = m.license AND r.y = o.license WHERE o.doc_id = m.doc_id AND abs(o.place - m.place) < greatest(o.win, m.win)
    AND (o.n_found / o.n_template, o.n_template, m.license) > (m.n_found / m.n_template, m.n_template, o.license)) AS best
FROM m"""
