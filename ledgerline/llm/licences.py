"""Licence notices in documents, by the Dice coefficient of word bigrams.

Every line and every paragraph of several lines is normalised (A-Z lowered, everything
but a-z and 0-9 one space) and compared as a set of word bigrams with the templates. A
coefficient of ``least`` is only possible between sets whose sizes differ by at most the factor
(2 - least) / least, so a unit whose number of words fits no template is dropped before
its bigrams are made, and is only compared with templates of fitting size. All of it is one pass
of built-in expressions over the texts, without a shuffle.

Defined cases: NULL or empty text has no match; paragraphs are parted by two line feeds, and a text without such has lines only; a unit with one word has no bigram and no match; repeated
rows are reported each; all templates that reach the coefficient are reported. Only id and text are read.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import plain_text

# Notices of public licences, by SPDX name.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "MIT": "Released under the MIT License.",
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions:"
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-long": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def template_bigrams(text: str) -> list[str]:
    words = re.findall(r"[a-z0-9]+", text.translate(str.maketrans(UPPER, LOWER)))
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def _normal(unit: str) -> Column:
    return F.trim(F.regexp_replace(F.translate(F.col(unit), UPPER, LOWER), "[^a-z0-9]+", " "))


def find_licences(
    docs: DataFrame, templates: dict[str, str] = TEMPLATES, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per match: id, ``kind`` of unit, its number ``unit`` from 0, ``licence`` and ``dice``."""
    grams = {name: template_bigrams(text) for name, text in templates.items()}
    # A little above the exact factor: a size that just reaches ``least`` must not fall to the rounding of a division.
    ratio = (2 - least) / least * (1 + 1e-9)
    listed = F.from_json(
        F.lit(json.dumps([{"name": n, "grams": g, "n": len(g), "lo": len(g) / ratio, "hi": len(g) * ratio} for n, g in grams.items()])),
        "array<struct<name:string,grams:array<string>,n:int,lo:double,hi:double>>",
    )
    # Repeated bigrams only make a set smaller, so the number of words bounds it from above alone.
    fewest = min(len(g) / ratio for g in grams.values()) + 1
    texts = docs.select(F.col(id_col).alias("_id"), plain_text(text_col).alias("_text"))
    lines = texts.select("_id", F.lit("line").alias("kind"), F.posexplode(F.split("_text", "\n", -1)).alias("unit", "_unit"))
    paragraphs = texts.where(F.col("_text").contains("\n\n")).select(
        "_id", F.lit("paragraph").alias("kind"), F.posexplode(F.split("_text", "\n\n", -1)).alias("unit", "_unit")
    )
    units = lines.unionByName(paragraphs.where(F.col("_unit").contains("\n")))
    # Exploding an array of one keeps Spark from repeating the expression wherever it is used.
    units = units.select("_id", "kind", "unit", F.explode(F.array(F.split(_normal("_unit"), " "))).alias("_words"))
    words = F.size("_words")
    known = F.array(*[F.lit(w) for w in sorted({w for g in grams.values() for x in g for w in x.split(" ")})])
    # At most a third of a match's bigrams (at least 0.8: 1 - least / (2 - least)) are not the template's, and
    # every different word that no template has brings one of these, but for the first.
    foreign = F.size(F.array_distinct("_words")) - F.size(F.array_intersect("_words", known))
    units = units.where((words >= fewest) & (words > 1)).where(foreign <= (1 - 1 / ratio) * (words - 1) + 1.001)
    pairs = F.zip_with(F.slice("_words", F.lit(1), words - 1), F.slice("_words", F.lit(2), words - 1), lambda a, b: F.concat(a, F.lit(" "), b))
    units = units.select("_id", "kind", "unit", F.explode(F.array(F.array_distinct(pairs))).alias("_grams")).withColumn("_n", F.size("_grams"))
    units = units.where(F.col("_n") <= max(len(g) * ratio for g in grams.values()))
    fitting = F.filter(listed, lambda t: (F.col("_n") >= t["lo"]) & (F.col("_n") <= t["hi"]))
    scored = F.transform(
        fitting,
        lambda t: F.struct(t["name"].alias("licence"), (F.lit(2.0) * F.size(F.array_intersect(F.col("_grams"), t["grams"])) / (F.col("_n") + t["n"])).alias("dice")),
    )
    hits = units.select("_id", "kind", "unit", F.inline(F.filter(scored, lambda m: m["dice"] >= least)))
    return hits.select(F.col("_id").alias(id_col), "kind", F.col("unit").cast("long").alias("unit"), "licence", "dice")
