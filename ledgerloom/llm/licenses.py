"""Licence scan: lines, sentences and paragraphs against templates by Dice over word bigrams."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, table

#: Notices as licences and common practice word them.
TEMPLATES = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.",
            "This project is licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions:"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                   "in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.",
                "Licensed under the GNU General Public License, version 2.",
                "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation; either version 2 of the License, "
                "or (at your option) any later version."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "Licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                "or (at your option) any later version."],
    "LGPL-2.1": ["This work is licensed under the GNU Lesser General Public License, version 2.1."],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3."],
    "MPL-2.0": ["Licensed under the Mozilla Public License, Version 2.0.",
                "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "BSD-2-Clause": ["Released under the BSD 2-Clause License.", "Licensed under the BSD 2-Clause License."],
    "BSD-3-Clause": ["Released under the BSD 3-Clause License.", "Licensed under the BSD 3-Clause License.",
                     "Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
                     "or promote products derived from this software without specific prior written permission."],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met:"],
    "0BSD": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
             "hereby granted."],
    "MIT-0": ["Released under the MIT No Attribution License.", "Licensed under the MIT No Attribution License.",
              "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
              "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
              "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
              "copies of the Software, and to permit persons to whom the Software is furnished to do so."],
    "ISC": ["Released under the ISC License.",
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "CC0-1.0": ["Released under CC0 1.0 Universal.", "This work is dedicated to the public domain under CC0 1.0 Universal."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}
#: What the parts of a Creative Commons code stand for, and its versions.
CC_PARTS = {"BY": "Attribution", "NC": "NonCommercial", "ND": "NoDerivatives", "SA": "ShareAlike"}
CC_CODES = ["BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"]
CC_VERSIONS = {"4.0": "International", "3.0": "Unported"}
for _code in CC_CODES:
    for _version, _port in CC_VERSIONS.items():
        _words = "-".join(CC_PARTS[part] for part in _code.split("-"))
        TEMPLATES[f"CC-{_code}-{_version}"] = [
            f"Licensed under CC {_code} {_version}.", f"This work is licensed under CC {_code} {_version}.",
            f"This work is licensed under a Creative Commons {_words} {_version} {_port} License."]
#: Names of families: their texts stand in several licences, so any licence found beside them goes first.
FAMILIES = ["BSD"]
for _name in TEMPLATES:
    if _name not in FAMILIES:
        TEMPLATES[_name].append(f"SPDX-License-Identifier: {_name}")
#: Words that part licences of nearly the same wording: versions, restrictions and denials.
TELLING = [*"0123456789", "noncommercial", "noderivatives", "sharealike", "nc", "nd", "sa", "lesser", "affero",
           "conditions", "not", "no", "never"]
THRESHOLD = 0.8


def words_of(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


def bigrams_of(text: str) -> list[str]:
    words = words_of(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def telling_of(text: str) -> list[str]:
    return sorted(set(words_of(text)) & set(TELLING))


def size_bounds(n: int, threshold: float) -> tuple[int, int]:
    """Bigram counts a text may have to reach the threshold against a template of ``n`` bigrams."""
    return math.ceil(n * threshold / (2 - threshold) - 1e-9), math.floor(n * (2 - threshold) / threshold + 1e-9)


def anchors(templates: dict[str, list[str]], threshold: float = THRESHOLD) -> list[str]:
    """Words of which every text that reaches the threshold against any template has one.

    A match shares at least threshold / (2 - threshold) of the template's
    bigrams.  Words are taken until fewer bigrams than that are free of them.
    """
    chosen: list[str] = []
    for text in sorted((t for texts in templates.values() for t in texts), key=lambda t: len(bigrams_of(t))):
        grams = [g.split(" ") for g in bigrams_of(text)]
        needed = size_bounds(len(grams), threshold)[0]
        while True:
            free = [g for g in grams if not set(g) & set(chosen)]
            if len(free) < needed:
                break
            counts: dict[str, int] = {}
            for g in free:
                for w in set(g):
                    counts[w] = counts.get(w, 0) + 1
            # Long words first: short ones would let ordinary prose through.
            chosen.append(max(counts, key=lambda w: (min(len(w), 7), counts[w], w)))
    return sorted(chosen)


def _units(text: Column) -> Column:
    """Distinct lines, sentences and paragraphs of a text."""
    lines = F.split(text, "\n")
    sentences = F.split(F.regexp_replace(text, r"([.!?])[ \t\r\n]+", "$1\n"), "\n")
    paragraphs = F.split(text, r"\n[ \t\r]*\n")
    return F.array_union(F.array_union(lines, sentences), paragraphs)


def _whole_sentences(text: Column) -> Column:
    """Paragraphs and their sentences with the line ends inside them joined; lines of comment marks alone part paragraphs."""
    paragraphs = F.transform(F.split(text, r"\n(?:[ \t\r/*#;%<>!|-]*\n)+"), lambda p: F.translate(p, "\n", " "))
    sentences = F.transform(paragraphs, lambda p: F.split(F.regexp_replace(p, r"([.!?])[ \t\r]+", "$1\n"), "\n"))
    return F.array_union(paragraphs, F.flatten(sentences))


def scan_licenses(docs: DataFrame, text: str = "text", templates: dict[str, list[str]] = TEMPLATES,
                  threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``license``, ``license_dice`` and ``n_notices``.

    Lines, sentences (an end mark and white space end one) and paragraphs are
    lowered and stripped to ASCII letters and digits, sentences both as parted
    by line ends and as running over them; each is compared with
    the templates whose size allows the threshold, by the Dice coefficient of
    their sets of word bigrams.  A template whose words in ``TELLING`` are not
    those of the unit is no match: another version, a restriction more or less,
    a denial.  ``license`` has the best match of all units, ``FAMILIES`` after all
    others, ties going to the smaller name, and ``n_notices`` counts the distinct units
    that match, a sentence or paragraph over several lines only if no other unit
    has the same words.  Texts without an anchor word (see ``anchors``) can match
    nothing and are not taken apart.  Null and empty texts have no notice
    (null, null, 0); rows are judged each by itself; columns of the added names
    are replaced.
    """
    flat = [(name, bigrams_of(t), telling_of(t)) for name in sorted(templates) for t in templates[name]]
    known = F.array(*[F.struct(F.lit(name in FAMILIES).alias("family"), F.lit(name).alias("name"), F.array(*map(F.lit, grams)).alias("grams"),
                               F.array(*map(F.lit, telling)).cast("array<string>").alias("telling"),
                               F.lit(len(grams)).alias("size"), F.lit(size_bounds(len(grams), threshold)[0]).alias("low"),
                               F.lit(size_bounds(len(grams), threshold)[1]).alias("high")) for name, grams, telling in flat])
    most = max(size_bounds(len(grams), threshold)[1] for _, grams, _ in flat)
    anchor = f"(?i)(?<![a-z0-9])(?:{'|'.join(anchors(templates, threshold))})(?![a-z0-9])"
    body = F.coalesce(F.col(text), F.lit(""))

    def compared(words):
        pairs = F.zip_with(F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words) - 1),
                           lambda a, b: F.concat_ws(" ", a, b))
        return F.struct(F.array_distinct(pairs).alias("grams"),
                        F.array_sort(F.array_intersect(words, F.array(*map(F.lit, TELLING)))).alias("telling"))

    def best(unit):
        n = F.size(unit["grams"])
        fitting = F.filter(known, lambda t: (t["low"] <= n) & (n <= t["high"]) & (t["telling"] == unit["telling"]))
        dice = F.transform(fitting, lambda t: F.struct(
            t["family"].alias("family"),
            (-2.0 * F.size(F.array_intersect(t["grams"], unit["grams"])) / (t["size"] + n)).alias("minus_dice"), t["name"].alias("name")))
        return F.array_min(F.filter(dice, lambda d: d["minus_dice"] <= -threshold + 1e-9))

    # Words are a column of their own: a lambda would take the unit apart again for each pair.
    def words_in(units):
        return F.transform(F.filter(units, lambda u: u.rlike(anchor)),
                           lambda u: F.regexp_extract_all(ascii_lower(u), F.lit("[a-z0-9]+"), F.lit(0)))

    nothing = F.array().cast("array<array<string>>")
    found = docs.withColumn("__words", F.when(body.rlike(anchor), words_in(_units(body))).otherwise(nothing))
    found = found.withColumn("__words", F.when(F.size("__words") > 0, F.concat(
        "__words", F.array_except(words_in(_whole_sentences(body)), "__words"))).otherwise(nothing))
    # Size bounds come before the comparison: most units are too long or too short for every template.
    found = found.withColumn("__grams", F.filter(
        F.transform(F.filter("__words", lambda w: F.size(w) >= 2), compared), lambda g: F.size(g["grams"]) <= most))
    found = found.withColumn("__hits", F.filter(F.transform("__grams", best), lambda h: h.isNotNull()))
    found = found.withColumn("__best", F.array_min("__hits"))
    return found.withColumn("license", F.col("__best.name")).withColumn(
        "license_dice", -F.col("__best.minus_dice")).withColumn(
        "n_notices", F.size("__hits").cast("long")).drop("__words", "__grams", "__hits", "__best")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "license", "license_dice", "n_notices")


def _oracle() -> str:
    rows = ", ".join(f"({name in FAMILIES}, '{name}', {bigrams_of(t)!r}, {telling_of(t)!r}::VARCHAR[])"
                     for name, texts in TEMPLATES.items() for t in texts)
    words = """regexp_extract_all(translate(unit, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9]+')"""
    return f"""
    WITH numbered AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body FROM documents),
    templates(family, name, grams, telling) AS (VALUES {rows}),
    units AS (
      SELECT DISTINCT rid, unnest(list_concat(string_split(body, chr(10)),
        string_split(regexp_replace(body, '([.!?])[ \\t\\r\\n]+', '\\1' || chr(10), 'g'), chr(10)),
        string_split_regex(body, '\\n[ \\t\\r]*\\n'))) AS unit
      FROM numbered
    ), paragraphs AS (
      SELECT rid, replace(unnest(string_split_regex(body, '\\n(?:[ \\t\\r/*#;%<>!|-]*\\n)+')), chr(10), ' ') AS unit FROM numbered
    ), whole AS (
      SELECT rid, unit FROM paragraphs UNION ALL
      SELECT rid, unnest(string_split(regexp_replace(unit, '([.!?])[ \\t\\r]+', '\\1' || chr(10), 'g'), chr(10))) FROM paragraphs
    ), parted AS (SELECT rid, {words} AS words FROM units), joined AS (SELECT DISTINCT rid, {words} AS words FROM whole),
    worded AS (SELECT rid, words FROM parted UNION ALL (SELECT rid, words FROM joined ANTI JOIN parted USING (rid, words))),
    grams AS (
      SELECT rid, row_number() OVER () AS uid, list_sort(list_distinct(list_intersect(words, {TELLING!r}))) AS telling,
        list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS grams
      FROM worded WHERE len(words) >= 2
    ), hits AS (
      SELECT rid, uid, min(struct_pack(family := t.family,
        minus_dice := -2.0 * len(list_intersect(g.grams, t.grams)) / (len(g.grams) + len(t.grams)), name := t.name)) AS hit
      FROM grams g JOIN templates t ON g.telling = t.telling
        AND 3 * len(g.grams) >= 2 * len(t.grams) AND 2 * len(g.grams) <= 3 * len(t.grams)
      WHERE 2.0 * len(list_intersect(g.grams, t.grams)) / (len(g.grams) + len(t.grams)) >= {THRESHOLD} - 1e-9
      GROUP BY rid, uid
    ), best AS (SELECT rid, min(hit) AS hit, count(*) AS n_notices FROM hits GROUP BY rid)
    SELECT doc_id, hit.name AS license, -hit.minus_dice AS license_dice, coalesce(n_notices, 0) AS n_notices
    FROM numbered LEFT JOIN best USING (rid)"""


QUERIES = {"op1_license_scan": op1_license_scan}
ORACLES = {"op1_license_scan": _oracle()}
