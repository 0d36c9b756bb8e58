"""Licence scan in DataFrame operations only: Dice coefficient over word bigrams against licence templates.

Units of a document are its lines, its paragraphs (split at blank lines) and the whole text, each different one once.
Words are runs of letters and digits in lower case; a unit and a template are sets of word bigrams, and a unit holds a
licence if 2 |A and B| / (|A| + |B|) reaches THRESHOLD t. That is possible only if |A| is between t / (2 - t) and
(2 - t) / t times |B|, so units outside the bounds of all templates go before bigrams are made (a unit has at least
one bigram fewer than it has different words), and a bigram meets only the templates whose bounds the unit fits.
The bigrams of the templates are broadcast; they are a parameter with a fixed bound, TEMPLATE_BIGRAMS.

Defined results: null and empty texts hold no licence; units of fewer than two words have no bigram and match nothing;
a unit counts for its best
licence, of equal ones the last by name; a document may hold several, each reported once with its best unit; repeated rows are summed under their
doc_id; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD, TEMPLATE_BIGRAMS = 0.8, 100_000
BLANK_LINE, BETWEEN_WORDS = r"\n[ \t\r]*\n", r"[^\p{L}\p{N}]+"

#: Notices as their licences word them.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:",
        "Licensed under the BSD 3-Clause License.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
}


def template_bigrams(templates: dict[str, list[str]]) -> list[tuple[int, str, int, str]]:
    """(template number, licence, bigrams of the template, bigram)."""
    rows = []
    for number, (licence, text) in enumerate((name, t) for name, texts in templates.items() for t in texts):
        words = re.findall(r"[^\W_]+", text.lower())
        grams = sorted({f"{a} {b}" for a, b in zip(words, words[1:])})
        rows += [(number, licence, len(grams), gram) for gram in grams]
    if len(rows) > TEMPLATE_BIGRAMS:
        raise ValueError(f"more than {TEMPLATE_BIGRAMS} template bigrams; scan in several runs")
    return rows


def _units(text: Column) -> Column:
    return F.array_distinct(F.concat(F.split(text, "\n"), F.split(text, BLANK_LINE), F.array(text)))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: dict[str, list[str]] | None = None,
         threshold: float = THRESHOLD) -> DataFrame:
    """key, licence, dice of the best unit and n_units that reach the threshold, for every licence found."""
    grams = template_bigrams(TEMPLATES if templates is None else templates)
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    sizes = [n for _, _, n, _ in grams] or [0]
    spark = docs.sparkSession
    known = spark.createDataFrame(grams, "template int, licence string, template_size int, gram string")

    # outer explodes and no filter on a computed array: Spark would push it down and compute all words anew for each bigram
    units = docs.select(F.col(key).alias("key"), F.explode_outer(_units(F.col(text))).alias("unit"))
    worded = units.select(
        "key", F.filter(F.split(F.lower("unit"), BETWEEN_WORDS), lambda w: w != "").alias("words")
    )
    fitting = F.size("words").between(2, F.lit(2**31 - 1)) & (
        F.size(F.array_distinct("words")) - 1 <= F.lit(max(sizes) * high)
    ) & (F.size("words") - 1 >= F.lit(min(sizes) * low))
    pairs = F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.size("words") - 1),
        lambda i: F.concat_ws(" ", F.element_at("words", i), F.element_at("words", i + 1)),
    ))
    sets = worded.select("key", F.when(fitting, pairs).alias("grams")).select(
        "key", F.monotonically_increasing_id().alias("unit"), F.size("grams").alias("size"), "grams"
    )
    met = sets.select("key", "unit", "size", F.explode_outer("grams").alias("gram")).join(F.broadcast(known), "gram").where(
        F.col("size").between(F.col("template_size") * low, F.col("template_size") * high)
    )
    scored = met.groupBy("key", "unit", "size", "template", "licence", "template_size").agg(
        F.count("*").alias("common")
    ).withColumn("dice", F.lit(2.0) * F.col("common") / (F.col("size") + F.col("template_size")))
    best = scored.where(F.col("dice") >= threshold).groupBy("key", "unit").agg(
        F.max(F.struct("dice", "licence")).alias("best")
    ).select("key", "best.dice", "best.licence")
    return best.groupBy("key", "licence").agg(F.max("dice").alias("dice"), F.count("*").alias("n_units")).select(
        F.col("key").alias(key), "licence", "dice", "n_units"
    )
