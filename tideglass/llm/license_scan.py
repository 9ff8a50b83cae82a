"""Licence notices in documents, by the Dice coefficient of word bigrams against templates.

A document's sections are its lines, its sentences (which may run over lines), its paragraphs of more than one line, and
the document of more than one line as a whole. A section and a template compare only if their numbers of distinct bigrams
allow the wanted coefficient: with n and m of them it is at most 2 min(n, m) / (n + m). Before bigrams are made, a section
is set aside if it holds none of the templates' telling words: without all of them no template can reach the coefficient.
Of a section the best template holds, so that a notice isn't also taken for another version of its licence.

A notice inside a longer section is found by windows: wherever a telling word stands in the document, each template that
has the word is laid over the text so that the two words meet, and compares with as many words as it has itself.
All of it is DataFrame code; the templates are literals of the plan.
"""

from __future__ import annotations

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideglass.llm.common import text_of, written

THRESHOLD = 0.8
# fixed values: the usual short notices of public licences, and short licences as a whole; one name may have several
TEMPLATES = (
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("MIT", "MIT License Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("proprietary", "All rights reserved."),
    ("proprietary", "All rights reserved. Unauthorized copying of this file, via any medium, is strictly prohibited."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MIT", "This project is licensed under the MIT License - see the LICENSE file for details."),
    ("Apache-2.0", "This project is licensed under the Apache License 2.0 - see the LICENSE file for details."),
    ("Apache-2.0", "Licensed under the Apache License 2.0."),
    ("GPL-3.0", "This project is licensed under the GNU General Public License v3.0 - see the LICENSE file for details."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    *((name, f"SPDX-License-Identifier: {tag}") for name, tag in (
        ("MIT", "MIT"), ("ISC", "ISC"), ("Apache-2.0", "Apache-2.0"), ("BSD-2-Clause", "BSD-2-Clause"), ("BSD-3-Clause", "BSD-3-Clause"), ("GPL-2.0", "GPL-2.0-only"), ("GPL-2.0", "GPL-2.0-or-later"), ("GPL-3.0", "GPL-3.0-only"),
        ("GPL-3.0", "GPL-3.0-or-later"), ("LGPL-2.1", "LGPL-2.1-only"), ("LGPL-3.0", "LGPL-3.0-only"), ("AGPL-3.0", "AGPL-3.0-only"), ("MPL-2.0", "MPL-2.0"), ("CC0-1.0", "CC0-1.0"), ("Unlicense", "Unlicense"), ("EPL-2.0", "EPL-2.0"),
    )),
)
_NORMAL = "regexp_replace(regexp_replace(lower({}), '[.!?]+([ \\t\\n])', '\x01$1'), '[^\\\\p{{L}}\\\\p{{N}}\\n\x01]+', ' ')"
_BIGRAMS = "array_distinct(transform(sequence(0, greatest(size({0}) - 2, 0)), i -> concat(get({0}, i), ' ', get({0}, i + 1))))"


# fixed values: words of nearly every English text
_COMMON = frozenset("a an and any are as at be by can for in is it may no not of on or other see that the this to use with you your".split())
#: Telling words of a template, at most, at which it is laid over a text.
ANCHORS = 3


def _anchors(templates: list[tuple[int, list[str]]], telling: list[str]) -> list[tuple[int, str, int]]:
    """(template's number, word, place of the word in it) of the longest telling words of each template."""
    made = []
    for t, words in templates:
        own = sorted({*words} & {*telling}, key=lambda w: (-len(w), w))[:ANCHORS]
        made += [(t, w, at) for at, w in enumerate(words) if w in own]
    return made


def telling_words(grams: list[list[str]], threshold: float) -> list[str]:
    """Words of which every section holds one that reaches the threshold with a template of these distinct bigrams.

    With n and m bigrams, threshold * (n + m) / 2 must be shared, which is least for the least n that the size bound
    allows. Words that stand in more of a template's bigrams than it can do without are enough; long ones come first, and
    the commonest of the language last.
    """
    chosen: set[str] = set()
    for own in grams:
        m = len(own)
        spare = m - threshold * (m + m * threshold / (2 - threshold)) / 2
        left = [set(g.split(" ")) for g in own if chosen.isdisjoint(g.split(" "))]
        words = sorted({w for g in left for w in g}, key=lambda w: (w in _COMMON, -len(w), w))
        while m - len(left) <= spare + 1e-9:
            chosen.add(w := words.pop(0))
            left = [g for g in left if w not in g]
    return sorted(chosen)


def _templates(docs: DataFrame, templates) -> DataFrame:
    """(t, license, w, grams, m) for the given notices, t being a template's number: a local relation of fixed size."""
    rows = docs.sparkSession.createDataFrame([(k, *t) for k, t in enumerate(templates)], "t int, license string, notice string")
    words = rows.selectExpr("t", "license", f"split(trim(translate({_NORMAL.format('notice')}, '\x01', ' ')), ' +') AS w")
    return words.selectExpr("t", "license", "w", f"{_BIGRAMS.format('w')} AS grams").selectExpr("t", "license", "w", "grams", "size(grams) AS m")


def scan_licenses(docs: DataFrame, threshold: float = THRESHOLD, templates=TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per match: doc_id, part ('line', 'sentence', 'paragraph', 'document', 'window'), number, license, dice.

    Texts are lower-cased and all but letters, digits and line ends count as blanks; sentences end at one of . ! ? with
    white space behind it, or with their paragraph. A section matches one licence, that of the best template, of equal
    ones the first; its number counts from 0 within the document and part. A licence that windows alone find is one match,
    its number the place of the first telling word of a best window. Null and empty texts, and sections of one word, match
    nothing. Rows that repeat an id each give their matches. Other columns are not read. An empty table gives an empty result.
    """
    # what a generator makes is computed once, however often later expressions name it
    text = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(docs, text_col).alias("text")).selectExpr("doc_id", f"explode(array({_NORMAL.format('text')})) AS norm")
    parts = lambda part, cuts, whole="false": f"transform(split(norm, '{cuts}'), (x, i) -> struct('{part}' AS part, i AS number, x AS body, {whole} AS whole))"
    several = lambda sections: f"filter({sections}, s -> contains(s.body, '\\n'))"
    whole = "array(struct('document' AS part, 0 AS number, norm AS body, true AS whole))"
    lines = parts("line", chr(92) + "n", "NOT contains(norm, '\\n')")  # a text of one line is that line
    bodies = text.selectExpr("doc_id", f"inline(concat({lines}, {parts('sentence', chr(1) + '|' + chr(92) + 'n *' + chr(92) + 'n')}, {several(parts('paragraph', chr(92) + 'n *' + chr(92) + 'n'))}, {several(whole)}))")
    known = _templates(docs, templates).orderBy("t").collect()  # as many rows as templates
    least = max(1.0, min(r["m"] for r in known) * threshold / (2 - threshold))
    most = max(r["m"] for r in known) * (2 - threshold) / threshold
    quote = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    strings = lambda words: f"array({', '.join(map(quote, words))})"
    literal = ", ".join(f"named_struct('license', {quote(r['license'])}, 'grams', {strings(r['grams'])}, 'm', {r['m']}, 't', {r['t']}, 'n', {len(r['w'])})" for r in known)
    sections = bodies.selectExpr("doc_id", "part", "number", "whole", "explode(array(split(trim(translate(body, '\\n\x01', '  ')), ' +'))) AS w")
    telling = telling_words([r["grams"] for r in known], threshold)
    # few sections are held; they are read twice
    held = written(sections.filter((F.size("w") - 1 >= least) & F.arrays_overlap("w", F.array(*map(F.lit, telling)))), "sections")
    # whole sections
    sized = held.selectExpr("doc_id", "part", "number", f"explode(array({_BIGRAMS.format('w')})) AS b").filter(F.size("b").between(least, most))
    bound = f"2.0D * least(size(b), t.m) / (size(b) + t.m) >= {threshold}D"
    score = lambda b: f"struct(2.0D * size(array_intersect({b}, t.grams)) / (size({b}) + t.m) AS dice, -t.t AS first, t.license AS license)"
    best = sized.selectExpr("doc_id", "part", "number", f"array_max(transform(filter(array({literal}), t -> {bound}), t -> {score('b')})) AS best")
    # windows: (template's number, place of the word in it) of each telling word
    anchors: dict[str, list[tuple[int, int]]] = {}
    for t, w, at in _anchors([(r["t"], r["w"]) for r in known], telling):
        anchors.setdefault(w, []).append((t, at))
    places = ", ".join(f"{quote(w)}, array({', '.join(f'named_struct({chr(39)}t{chr(39)}, {t}, {chr(39)}at{chr(39)}, {at})' for t, at in own)})" for w, own in anchors.items())
    hits = held.filter("whole").selectExpr("doc_id", "w", f"explode(filter(transform(w, (x, i) -> struct(x AS word, i AS place)), s -> array_contains({strings(anchors)}, s.word))) AS hit")
    laid = hits.selectExpr("doc_id", "hit.place AS number", f"transform(element_at(map({places}), hit.word), a -> struct(a.t AS t, slice(w, greatest(hit.place - a.at, 0) + 1, element_at(array({', '.join(str(len(r['w'])) for r in known)}), a.t + 1)) AS w)) AS windows")
    grams = f"transform(windows, x -> struct(element_at(array({literal}), x.t + 1) AS t, {_BIGRAMS.format('x.w')} AS b))"
    over = laid.selectExpr("doc_id", "number", f"array_max(transform({grams}, y -> transform(array(y.t), t -> {score('y.b')})[0])) AS best")
    take = lambda df, *more: df.filter(F.col("best.dice") >= threshold).select("doc_id", *more, F.col("best.license").alias("license"), F.col("best.dice").alias("dice"))
    inside = take(best, "part", "number").groupBy("doc_id", "part", "number", "license").agg(F.max("dice").alias("dice"))
    first = F.min(F.struct((-F.col("dice")).alias("d"), "number"))
    windows = take(over, "number").groupBy("doc_id", "license").agg(first.alias("f")).select("doc_id", F.lit("window").alias("part"), F.col("f.number").alias("number"), "license", (-F.col("f.d")).alias("dice"))
    seen = inside.select(F.col("doc_id").alias("_doc"), F.col("license").alias("_license")).distinct()
    return inside.unionByName(windows.join(seen, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("license") == F.col("_license")), "left_anti"))


def license_table(docs: DataFrame, threshold: float = THRESHOLD, templates=TEMPLATES) -> DataFrame:
    """Per document id: doc_id, n_matches, best_license, best_dice, licenses (the distinct names, ascending, joined by commas).

    The best match has the greatest coefficient, then the first name. Documents without a match have 0, nulls and ''.
    """
    found = scan_licenses(docs, threshold, templates)
    none = docs.select(F.col("doc_id").cast("long")).distinct().select("doc_id", F.lit(None).cast("string").alias("license"), F.lit(None).cast("double").alias("dice"))
    both = none.unionByName(found.select("doc_id", "license", "dice"))
    best = F.min(F.when(F.col("dice").isNotNull(), F.struct((-F.col("dice")).alias("d"), "license")))
    return both.groupBy("doc_id").agg(
        F.count("license").alias("n_matches"), best.alias("b"), F.array_join(F.sort_array(F.collect_set("license")), ",").alias("licenses")
    ).select("doc_id", "n_matches", F.col("b.license").alias("best_license"), (-F.col("b.d")).alias("best_dice"), "licenses")


def license_sql(threshold: float = THRESHOLD, templates=TEMPLATES) -> str:
    """The same table in DuckDB's SQL."""
    values = ", ".join("({}, '{}', '{}')".format(k, *(x.replace("'", "''") for x in t)) for k, t in enumerate(templates))
    norm = r"regexp_replace(regexp_replace(lower({}), '[.!?]+([ \t\n])', chr(1) || '\1', 'g'), '[^\p{{L}}\p{{N}}\n\x01]+', ' ', 'g')"
    grams = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    parts = lambda part, cut: f"SELECT doc_id, '{part}' AS part, unnest(range(len({cut}))) AS number, unnest({cut}) AS body FROM n"
    cut = lambda pattern: f"regexp_split_to_array(norm, '{pattern}')"
    words = "regexp_split_to_array(trim(translate({}, chr(10) || chr(1), '  ')), ' +') AS w"
    dice = "2.0::DOUBLE * len(list_intersect(b, grams)) / (len(b) + len(grams))"
    plain = [regex.sub(r"[^\p{L}\p{N}]+", " ", t[1].lower()).split() for t in templates]
    telling = telling_words([[*dict.fromkeys(map(" ".join, zip(w, w[1:], strict=False)))] for w in plain], threshold)
    anchors = ", ".join(f"({t}, '{w}', {at})" for t, w, at in _anchors([*enumerate(plain)], telling))
    return rf"""
        WITH n AS (SELECT doc_id, {norm.format("coalesce(text, '')")} AS norm FROM documents),
        l AS ({parts("line", "string_split(norm, chr(10))")}),
        c AS ({parts("sentence", cut(r"\x01|\n *\n"))}),
        p AS ({parts("paragraph", cut(r"\n *\n"))}),
        s AS (SELECT doc_id, part, number, {words.format("body")}
              FROM (SELECT * FROM l UNION ALL SELECT * FROM c UNION ALL SELECT * FROM p WHERE contains(body, chr(10))
                    UNION ALL SELECT doc_id, 'document', 0, norm FROM n WHERE contains(norm, chr(10)))),
        b AS (SELECT doc_id, part, number, {grams} AS b FROM s WHERE len(w) >= 2),
        t AS MATERIALIZED (SELECT t, license, w, {grams} AS grams FROM (SELECT t, license, {words.format(norm.format("notice"))} FROM (VALUES {values}) AS v(t, license, notice))),
        d AS (SELECT doc_id, part, number, arg_max(license, (dice, -t)) AS license, max(dice) AS dice
              FROM (SELECT doc_id, part, number, t, license, {dice} AS dice FROM b JOIN t ON 2.0::DOUBLE * least(len(b), len(grams)) / (len(b) + len(grams)) >= {threshold})
              GROUP BY doc_id, part, number HAVING max(dice) >= {threshold}),
        g AS (SELECT t, license, w AS tw, grams, word, ofs FROM t JOIN (VALUES {anchors}) AS v(t, word, ofs) USING (t)),
        x AS (SELECT doc_id, {words.format("norm")} FROM n), h AS (SELECT doc_id, w, unnest(w) AS word, unnest(range(len(w))) AS place FROM x),
        o AS (SELECT doc_id, place, t, license, grams, list_slice(w, greatest(place - ofs, 0) + 1, greatest(place - ofs, 0) + len(tw)) AS w FROM h JOIN g USING (word)),
        q AS (SELECT doc_id, place, t, license, {dice} AS dice FROM (SELECT doc_id, place, t, license, grams, {grams} AS b FROM o)),
        k AS (SELECT doc_id, license, max(dice) AS dice FROM (SELECT doc_id, place, arg_max(license, (dice, -t)) AS license, max(dice) AS dice FROM q GROUP BY doc_id, place HAVING max(dice) >= {threshold}) GROUP BY doc_id, license),
        a AS (SELECT doc_id, license, dice FROM d UNION ALL SELECT doc_id, license, dice FROM k ANTI JOIN (SELECT DISTINCT doc_id, license FROM d) e USING (doc_id, license)),
        best AS (SELECT doc_id, count(*) AS n_matches, min_by(license, (-dice, license)) AS best_license, max(dice) AS best_dice,
                 string_agg(DISTINCT license, ',' ORDER BY license) AS licenses FROM a GROUP BY doc_id)
        SELECT doc_id, coalesce(n_matches, 0) AS n_matches, best_license, best_dice, coalesce(licenses, '') AS licenses
        FROM (SELECT DISTINCT doc_id FROM documents) LEFT JOIN best USING (doc_id)
    """
