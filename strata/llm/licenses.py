"""License scans: MinHash bands over overlapping text windows, verified by
exact shingle containment.

A template is the set of its word shingles.  Templates are put into size
classes; for each class the documents are read as overlapping windows of as many
shingles, a quarter of a window apart, and a window's MinHash values are its
band keys (one value a band, so a window that shares a share J of its shingles
with a template meets it with probability 1 - (1 - J)^bands).  The words around
a window that met a template are then compared shingle by shingle.  Everything
up to the matches happens beside the text, before any shuffle.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import PLAIN_WORD, ascii_lower, whole_text, words_of

SHINGLE = 5
BANDS = 8
SIMILARITY = 0.8

# Public notices by license identifier.
TEMPLATES = {
    "Apache-2.0/line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied."),
    "MIT/line": "Released under the MIT License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions:"),
    "GPL-3.0/line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:"),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "CC-BY-NC-4.0/line": "Licensed under CC BY-NC 4.0.",
    "GPL-2.0": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version."),
    "LGPL-2.1": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version."),
    "LGPL-3.0": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version."),
    "AGPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means."),
    "CC-BY-SA-4.0": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    **{f"{name}/spdx": f"SPDX-License-Identifier: {name}" for name in (
        "Apache-2.0", "MIT", "ISC", "Unlicense", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "MPL-2.0",
        "BSD-2-Clause", "BSD-3-Clause")},
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
}


def template_words(text: str) -> list[str]:
    return re.findall(PLAIN_WORD, "".join(c.lower() if c.isascii() else c for c in text))


def shingles(words: list[str], size: int = SHINGLE) -> list[str]:
    """Distinct shingles in order; fewer words than a shingle are one of their own."""
    grams = [" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    return list(dict.fromkeys(grams))


def _classes(sizes: list[int]) -> dict[int, int]:
    """Window size by template size: the smallest size of its class; a class
    spans sizes up to a quarter larger."""
    out: dict[int, int] = {}
    start = 0
    for n in sorted(set(sizes)):
        if n * 4 > start * 5:
            start = n
        out[n] = start
    return out


def _gram_hash(words: str | Column, first: Column, size: int) -> Column:
    """Hash of ``size`` words of an array from index ``first`` on."""
    return F.xxhash64(*[F.get(words, first + j) for j in range(size)])


def scan(docs: DataFrame, templates: dict[str, str] | None = None, shingle: int = SHINGLE,
         bands: int = BANDS, similarity: float = SIMILARITY) -> DataFrame:
    """``docs(doc_id, text)`` -> ``doc_id, license, containment, position``: per
    document and template contained to ``similarity`` or more, the best share of
    the template's shingles found and the first word of the window that holds it
    (the earliest of equals).  Repeated ids give one row per template.  NULL and
    empty texts match nothing.  Of templates that are much alike, one whose
    shingles found in a passage are all of another's that finds more there is not
    reported.  Templates of up to two shingles or fewer words are matched as a phrase.
    Templates are a parameter, not data."""
    spark = docs.sparkSession
    known = {k: shingles(template_words(t), shingle) for k, t in (templates or TEMPLATES).items()}
    # one or two shingles must be held whole, which a phrase tells without windows
    phrases = {k: " ".join(template_words(t)) for k, t in (templates or TEMPLATES).items()
               if known[k] and len(template_words(t)) < shingle + 2 and similarity > 0.5}
    phrases |= {k: g[0] for k, g in known.items() if g and len(g[0].split(" ")) < shingle}
    known = {k: g for k, g in known.items() if g and k not in phrases}
    found = []
    if known:
        found.append(_scan_shingles(docs, known, shingle, bands, similarity))
    if phrases:
        found.append(_scan_phrases(docs, phrases))
    if not found:
        return spark.createDataFrame([], "doc_id long, license string, containment double, position long")
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def _scan_phrases(docs: DataFrame, phrases: dict[str, str]) -> DataFrame:
    """Whole phrases of few words, found word by word."""
    # a text without the phrase's longest word is not read as words
    text = ascii_lower(whole_text("text"))
    may = F.lit(False)
    for word in sorted({max(p.split(" "), key=len) for p in phrases.values()}):
        may = may | text.contains(word)
    words = F.when(may, words_of(whole_text("text"), PLAIN_WORD)).otherwise(F.array().cast("array<string>"))
    said = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
    each = docs.select("doc_id", said.alias("said")).select("doc_id", "said", F.explode(F.array(*[
        F.struct(F.lit(k).alias("license"), F.lit(f" {p} ").alias("phrase")) for k, p in phrases.items()])).alias("p"))
    place = F.size(F.split(F.expr("substring(said, 1, locate(p.phrase, said))"), " ")) - 2
    return (each.where(F.col("said").contains(F.col("p.phrase")))
            .groupBy("doc_id", F.col("p.license").alias("license"))
            .agg(F.lit(1.0).alias("containment"), F.min(place.cast("long")).alias("position")))


def _scan_shingles(docs: DataFrame, known: dict[str, list[str]], shingle: int, bands: int,
                   similarity: float) -> DataFrame:
    spark = docs.sparkSession
    # templates that can hold all of what is found of another
    rivals = {k: [h for j, h in known.items() if j != k and len(set(g) & set(h)) >= similarity * len(g)]
              for k, g in known.items()}
    window_of = _classes([len(g) for g in known.values()])
    plan = spark.createDataFrame(
        [(k, g, window_of[len(g)]) for k, g in known.items()], "license string, grams array<string>, win int")
    hashed = plan.withColumn("hashes", F.transform("grams", lambda g: _gram_hash(F.split(g, " "), F.lit(0), shingle)))

    def minhash(hashes: Column, band: int) -> Column:
        return F.transform(hashes, lambda h: F.xxhash64(h, F.lit(band)))

    def least(hashes: Column, band: int) -> Column:
        """The MinHash value of a band and the shingle it comes from."""
        return F.array_min(F.transform(hashes, lambda h: F.struct(
            F.xxhash64(h, F.lit(band)).alias("low"), h.alias("anchor"))))

    found = hashed.select("license", "grams", "win", F.explode(F.array(*[
        F.struct(F.lit(b).alias("band"), least(F.col("hashes"), b).alias("least")) for b in range(bands)])).alias("key"))
    keys = found.select("license", "grams", "win", "key.band", "key.least.low")
    lows: dict[int, list[int]] = {b: [] for b in range(bands)}
    anchors: set[int] = set()
    for r in found.select("key.band", "key.least.low", "key.least.anchor").collect():      # templates x bands
        lows[r.band].append(r.low)
        anchors.add(r.anchor)
    rows = (docs.select("doc_id", words_of(whole_text("text"), PLAIN_WORD).alias("words"))
            .withColumn("hashes", F.transform(
                F.when(F.size("words") >= shingle, F.sequence(F.lit(1), F.size("words") - (shingle - 1)))
                .otherwise(F.array().cast("array<int>")), lambda i: _gram_hash("words", i - 1, shingle))))
    # a window's band key can only be a template's if the window holds the shingle
    # which that key comes from: a text with none of these shingles has no such
    # window.  An explode, as a filter would be pushed below and hash again
    anchored = F.arrays_overlap("hashes", F.array(*[F.lit(a).cast("long") for a in sorted(anchors)]))
    rows = (rows.select("*", F.explode(F.when(anchored, F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))))
            .select("doc_id", "words", "hashes", *[minhash(F.col("hashes"), b).alias(f"m{b}") for b in range(bands)]))
    wins = rows.select("*", F.explode(F.array(*[F.struct(F.lit(w).alias("win"), F.lit(max(1, w // 4)).alias("step"))
                                                for w in sorted(set(window_of.values()))])).alias("class"))
    each = wins.select("doc_id", "words", *[f"m{b}" for b in range(bands)], F.col("class.win").alias("win"), F.explode(
        F.when(F.size("hashes") > 0, F.sequence(F.lit(1), F.size("hashes"), F.col("class.step")))
        .otherwise(F.array().cast("array<int>"))).alias("at"))

    def low(b: int) -> Column:
        return F.array_min(F.slice(f"m{b}", F.col("at"), F.col("win")))

    # a class whose largest template must be held whole has few shingles, and a
    # window starts at every one: one band tells
    whole = F.col("win").isin([w for w in set(window_of.values()) if all(
        (n - 1) / n < similarity for n, v in window_of.items() if v == w)])
    others = F.lit(False)
    for b in range(1, bands):
        others = others | low(b).isin(lows[b])
    each = each.where(low(0).isin(lows[0]) | (~whole & others))
    met = each.select("doc_id", "words", "at", "win", F.explode(F.array(*[
        F.struct(F.lit(b).alias("band"), low(b).alias("low")) for b in range(bands)])).alias("key")) \
        .select("doc_id", "words", "at", "win", "key.band", "key.low")
    # templates: a fixed list of notices, far below any broadcast limit
    met = met.join(F.broadcast(keys), ["win", "band", "low"])
    # the window and as much again on either side, for templates that lie across
    start = F.greatest(F.lit(1), F.col("at") - F.col("win"))
    around = met.select("doc_id", "license", "grams", (start - 1).cast("long").alias("position"),
                        F.slice("words", start, 3 * F.col("win") + shingle).alias("near"))
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("near") - (shingle - 1))),
                        lambda i: F.array_join(F.slice("near", i, F.lit(shingle)), " "))
    read = around.select("doc_id", "license", "position", F.size("grams").alias("n"), grams.alias("read"),
                         F.array_intersect("grams", grams).alias("held"))
    # all that is found here is also a rival's, which finds more: the passage is the rival's
    outdone = F.exists("rivals", lambda r: (F.size(F.array_except("held", r)) == 0) & (
        F.size(F.array_intersect(r, F.col("read"))) > F.size("held")) & (
        F.size(F.array_intersect(r, F.col("read"))) / F.size(r) >= similarity))
    others = spark.createDataFrame(list(rivals.items()), "license string, rivals array<array<string>>").coalesce(1)
    alike = read.where(F.size("held") / F.col("n") >= similarity).join(F.broadcast(others), "license")
    matches = alike.where(~outdone).select(
        "doc_id", "license", "position", (F.size("held") / F.col("n")).alias("containment"))
    best = F.max(F.struct("containment", (-F.col("position")).alias("back")))
    return (matches.groupBy("doc_id", "license").agg(best.alias("best"))
            .select("doc_id", "license", "best.containment", (-F.col("best.back")).alias("position")))
