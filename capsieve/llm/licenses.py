"""Licence scans: lines of a text against licence templates by the Dice coefficient of their word bigrams. Built-in functions only.

A line and a template are normalised alike: ASCII letters in lower case, everything but letters and digits a separator. The
likeness is 2 |A and B| / (|A| + |B|) of the sets of word pairs. As that is at most 2 min / (|A| + |B|), a line of n
different pairs can reach the threshold t only with templates of t n / (2 - t) to (2 - t) n / t pairs; others are not
compared. A line keeps its best template, ties going to the first name.

Notices that are wrapped or share a line are found in windows of the word pairs of the whole text, which begin and end at a
pair of the template and have at most (2 - t) n / t pairs. A window that touches no line that matches by itself gives a row
at the line where it begins, unless a better one (or, at the same likeness, an earlier one) overlaps it.
`sql` states the lines alone.

What matches a template of n pairs at likeness t holds t n / (2 - t) of them, so it holds one of any n - t n / (2 - t) + 1 pairs. One
pattern of the pairs that are rarest in prose, so many for each template, is searched in every text; only texts and lines with
such a pair are split into words. Windows are made from single hits: each carries the few pairs that its window can
reach, never the text. The best window at each pair of a text is a minimum per position, and a window stays where it is the
best at all its pairs.

Defined results: null and empty texts, and lines of fewer than two words, match nothing; repeated rows give repeated results;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capsieve.llm.store import written

THRESHOLD = 0.8

# The published short notices and first sentences of common licences.
TEMPLATES = {
    "AGPL-3.0": ["This program is licensed under the GNU Affero General Public License, version 3."],
    "All-rights-reserved": ["All rights reserved."],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
            "Released under the BSD License."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
                "Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
            "copyright notice and this permission notice appear in all copies."],
    "LGPL-3.0": ["This library is licensed under the GNU Lesser General Public License, version 3."],
    "MIT": ["Released under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to "
            "deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}
# End of the fixed values.

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def bigrams(line: str) -> list[str]:
    words = re.findall("[a-z0-9]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line))
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def _known(templates: dict[str, list[str]]) -> list[tuple[str, list[str]]]:
    return [(name, bigrams(text)) for name in sorted(templates) for text in templates[name] if bigrams(text)]


#: Words that stand everywhere; pairs of them say little. Used only to choose which pairs are searched first.
_COMMON = frozenset("a all and any as at be by for from in is it of on or that the this to under with work".split())


def _pattern(known: list[tuple[str, list[str]]], threshold: float) -> str:
    """A pattern that every text or line with a match holds: for each template, enough of its rarest pairs."""
    asked: dict[str, set[str]] = {}
    for _, grams in known:
        spare = len(grams) - math.ceil(len(grams) * threshold / (2 - threshold) - 1e-9) + 1
        for gram in sorted(grams, key=lambda g: (sum(w in _COMMON for w in g.split()), -len(g), g))[:spare]:
            first, second = gram.split()
            asked.setdefault(first, set()).add(second)
    by_letter: dict[str, list[str]] = {}
    for first in sorted(asked):
        by_letter.setdefault(first[0], []).append(f"{first[1:]}[^a-z0-9]+(?:{'|'.join(sorted(asked[first]))})")
    return "(?i)(?<![a-z0-9])(?:" + "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in by_letter.items()) + ")(?![a-z0-9])"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _literal(texts: list[str]) -> str:
    """Spark SQL of a constant array: one expression to build, however many texts."""
    return "array(" + ", ".join(map(_quoted, texts)) + ")"


def _normal(line: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.translate(line, _UPPER, _LOWER), "[^a-z0-9]+", " ")), " ")


def _pairs(words: Column) -> Column:
    after = F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))
    return F.array_distinct(F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), after, lambda a, b: F.concat(a, F.lit(" "), b)))


def scan(docs: DataFrame, templates: dict[str, list[str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """docs (doc_id, text) -> (doc_id, line_no from 0, license, dice), a row for each line that matches a template, or where a window that matches begins."""
    known = _known(TEMPLATES if templates is None else templates)
    if not known:
        return docs.select("doc_id", F.lit(0).alias("line_no"), F.lit("").alias("license"), F.lit(0.0).alias("dice")).limit(0)
    pattern = _pattern(known, threshold)
    near = written(docs.where(F.col("text").rlike(pattern)).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), "licence-texts")
    whole = written(_lines(near, known, threshold, pattern), "licence-lines")
    found = _windows(near, known, threshold)

    # what a line that matches by itself holds is that line's row
    touched = found.select("row", "doc_id", "w", F.explode(F.sequence("w.line", "w.last")).alias("line_no")).join(whole.select("row", "line_no"), ["row", "line_no"])
    found = found.join(touched.select("row", "w").distinct(), ["row", "w"], "left_anti")
    best = found.select("row", "doc_id", "w", F.explode(F.sequence("w.first", "w.end")).alias("at")).groupBy("row", "doc_id", "at").agg(F.min("w").alias("w"))
    best = best.groupBy("row", "doc_id", "w").agg(F.count("*").alias("n")).where("n = w.end - w.first + 1")
    windows = best.select("doc_id", F.col("w.line").alias("line_no"), F.col("w.license").alias("license"), (-F.col("w.less")).alias("dice"))
    return whole.select("doc_id", "line_no", "license", "dice").unionByName(windows)


def _lines(near: DataFrame, known: list[tuple[str, list[str]]], threshold: float, pattern: str) -> DataFrame:
    """(row, doc_id, line_no, license, dice) of the lines that match by themselves."""
    sizes = [len(b) for _, b in known]
    slack = 1e-9  # sizes at a bound count as within it
    least, most = min(sizes) * threshold / (2 - threshold) - slack, max(sizes) * (2 - threshold) / threshold + slack
    lines = near.select("row", "doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line")).where(F.col("line").rlike(pattern))
    sets = lines.select("row", "doc_id", "line_no", _pairs(_normal(F.col("line"))).alias("pairs")).where(F.size("pairs").between(least, most))
    pairs, n = F.col("pairs"), F.size("pairs")

    def likeness(name: str, template: list[str]) -> Column:
        size = len(template)
        value = F.lit(2.0) * F.size(F.array_intersect(pairs, F.expr(_literal(template)))) / (n + size)
        dice = F.when(n.between(size * threshold / (2 - threshold) - slack, size * (2 - threshold) / threshold + slack), value).otherwise(0.0)
        return F.struct((-dice).alias("less"), F.lit(name).alias("license"))

    best = sets.withColumn("best", F.array_min(F.array(*[likeness(*k) for k in known])))
    return best.select("row", "doc_id", "line_no", F.col("best.license"), (-F.col("best.less")).alias("dice")).where(F.col("dice") >= threshold)


def _windows(near: DataFrame, known: list[tuple[str, list[str]]], threshold: float) -> DataFrame:
    """(row, doc_id, w): windows that match, w (less, first, license, end, line, last): for each pair that a template shares, the best that begins there."""
    least = threshold / (2 - threshold)
    every = sorted({g for _, grams in known for g in grams})
    lines = F.transform(F.split("text", "\n", -1), lambda line, i: F.transform(F.filter(_normal(line), lambda w: w != ""), lambda w: F.struct(w.alias("w"), i.alias("i"))))
    words = near.select("row", "doc_id", F.flatten(lines).alias("words")).where(F.size("words") > 1)
    grams = F.zip_with(F.slice("words", 1, F.size("words") - 1), F.slice("words", 2, F.size("words") - 1),
                       lambda a, b: F.struct(F.concat(a["w"], F.lit(" "), b["w"]).alias("g"), a["i"].alias("line"), b["i"].alias("last")))
    listed = _literal(every).removeprefix("array")
    hits = F.expr(f"filter(transform(grams, (x, at) -> named_struct('at', at, 'g', x.g)), h -> h.g IN {listed})")
    hits = words.select("row", "doc_id", grams.alias("grams")).withColumn("hits", hits).select("row", "doc_id", "grams", F.explode("hits").alias("h"))

    # a fixed table: one row for each pair of each template
    asked = [f"named_struct('license', {_quoted(name)}, 'of', {_literal(t)})" for name, t in known]
    table = near.sparkSession.range(1).select(F.expr(f"inline(array({', '.join(asked)}))"))
    table = table.select("license", F.size("of").alias("size"), "of", F.explode("of").alias("g"))
    reach = F.floor(F.col("size") * ((2 - threshold) / threshold) + 1e-9).cast("int")
    part = hits.join(F.broadcast(table), F.col("h.g") == F.col("g")).select("row", "doc_id", F.col("h.at").alias("at"), "license", "size", "of", F.slice("grams", F.col("h.at") + 1, reach).alias("part"))
    ends = F.filter(F.transform("part", lambda x, k: F.struct(k.alias("k"), x["g"].alias("g"), x["last"].alias("last"))), lambda x: F.array_contains(F.col("of"), x["g"]))
    part = part.withColumn("ends", ends).where(F.size("ends") >= F.col("size") * least - 1e-9)

    def window(e: Column) -> Column:
        common = F.size(F.array_distinct(F.transform(F.filter("ends", lambda x: x["k"] <= e["k"]), lambda x: x["g"])))
        n = F.size(F.array_distinct(F.transform(F.slice("part", 1, e["k"] + 1), lambda x: x["g"])))
        return F.struct((-F.lit(2.0) * common / (n + F.col("size"))).alias("less"), F.col("at").alias("first"), F.col("license").alias("license"),
                        (F.col("at") + e["k"]).alias("end"), F.col("part")[0]["line"].alias("line"), e["last"].alias("last"))

    return part.select("row", "doc_id", F.array_min(F.transform("ends", window)).alias("w")).where(F.col("w.less") <= -threshold)


def sql(templates: dict[str, list[str]] | None = None, threshold: float = THRESHOLD) -> str:
    """The same scan as DuckDB SQL over `documents`, without size bounds."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    rows = ", ".join(f"({quoted(name)}, [{', '.join(map(quoted, b))}])" for name, b in _known(TEMPLATES if templates is None else templates))
    return f"""
WITH template(license, grams) AS (VALUES {rows}),
line AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents),
word AS (SELECT doc_id, line_no, string_split(trim(regexp_replace(translate(line, '{_UPPER}', '{_LOWER}'), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM line),
pair AS (SELECT doc_id, line_no, list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS grams FROM word WHERE len(w) > 1),
likeness AS (SELECT doc_id, line_no, license, 2.0::DOUBLE * len(list_intersect(p.grams, t.grams)) / (len(p.grams) + len(t.grams)) AS dice
             FROM pair p, template t WHERE len(p.grams) <= 9 * len(t.grams))
SELECT doc_id, line_no::INTEGER AS line_no, license, dice FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id, line_no ORDER BY dice DESC, license) AS place FROM likeness WHERE dice >= {threshold}::DOUBLE)
WHERE place = 1"""
