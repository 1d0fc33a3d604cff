"""License scan by diagonal voting.

Templates (license notices, and the base phrases) and texts are word sequences
(A-Z lower-cased; words are runs of ASCII letters and digits and non-ASCII
characters). Every word k-gram of a template has its positions; the rolling
k-grams of all texts are joined to them. A hit votes for the diagonal text
position minus template position. Diagonals of one text and template that lie
within ``NEAR`` of each other (inserted or missing words) are merged, and the
merged span is verified: the template words under its hits must make up at least
``MIN_COVERAGE`` of the template, in a text span of at most ``STRETCH`` times the
template's length (plus ``NEAR``). k is ``GRAM``, or the template's length if
that is less, so each place of a base phrase is one hit.

The templates are a fixed list in this module, so their gram table (a few
hundred rows) is broadcast; texts keep only grams whose hash falls in its 2**16
bit map and whose words are, word for word, those of a template gram before the join.
Notices of licences that are not in the list are out of reach.

Rows: null and empty texts give zero counts, null positions, empty labels and
score 0; rows are told apart by their place in a written table, so null or
repeated ids give a row each; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textkernel as tk
from .shared import written

GRAM, NEAR, MIN_COVERAGE, STRETCH = 4, 3, 0.6, 1.5

# Base phrases and labels.
BASE = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]

# Public license notices and labels.
NOTICES = [
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
     "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
     "Software, and to permit persons to whom the Software is furnished to do so", "mit"),
    ("Released under the MIT License", "mit"),
    ("Licensed under the MIT License", "mit"),
    ("Licensed under the Apache License, Version 2.0", "apache-2.0"),
    ("you may not use this file except in compliance with the License. You may obtain a copy of the License at",
     "apache-2.0"),
    ("Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
     "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied", "apache-2.0"),
    ("This work is licensed under the GNU General Public License, version 3", "gpl-3.0"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
     "option) any later version", "gpl-3.0"),
    ("under the terms of the GNU General Public License as published by the Free Software Foundation; either "
     "version 2 of the License", "gpl-2.0"),
    ("under the terms of the GNU Lesser General Public License", "lgpl"),
    ("GNU Affero General Public License", "agpl"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
     "the following conditions are met", "bsd"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies", "isc"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mpl-2.0"),
    ("This is free and unencumbered software released into the public domain", "unlicense"),
    ("Licensed under CC BY-NC 4.0", "cc-by-nc"),
    ("Licensed under CC BY-SA 4.0", "cc-by-sa"),
    ("Licensed under CC BY 4.0", "cc-by"),
    ("licensed under a Creative Commons Attribution 4.0 International License", "cc-by"),
    ("licensed under a Creative Commons Attribution NonCommercial 4.0 International License", "cc-by-nc"),
    ("licensed under a Creative Commons Attribution ShareAlike 4.0 International License", "cc-by-sa"),
    ("dedicated to the public domain under the Creative Commons CC0 1.0 Universal", "cc0"),
    ("All content is copyright of its respective owners. All rights reserved", "reserved"),
]


def templates() -> list[dict]:
    """Gram rows of all templates: template, label, base, words, k, tpos, h."""
    rows = []
    for number, (text, label) in enumerate([*BASE, *NOTICES]):
        raw = np.frombuffer(text.encode(), np.uint8)
        words = tk.Words(raw, np.array([0, len(raw)]), tk.ALNUM).hash
        k = min(GRAM, len(words))
        for pos, h in enumerate(tk.grams(words, k).view(np.int64).tolist()):
            rows.append({"template": number, "label": label, "base": number < len(BASE), "words": len(words), "k": k,
                         "tpos": pos, "h": h})
    return rows


def gram_words() -> dict[int, set[tuple[bytes, ...]]]:
    """The words of each gram hash of the templates."""
    known: dict[int, set[tuple[bytes, ...]]] = {}
    for text, _ in [*BASE, *NOTICES]:
        raw = text.encode()
        w = tk.Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), tk.ALNUM)
        words = [raw[a:b].lower() for a, b in zip(w.start.tolist(), w.end.tolist())]
        k = min(GRAM, len(words))
        for i, h in enumerate(tk.grams(w.hash, k).view(np.int64).tolist()):
            known.setdefault(h, set()).add(tuple(words[i:i + k]))
    return known


def _scan(bits: np.ndarray, sizes: list[int], known: dict[int, set[tuple[bytes, ...]]]):
    """Grams of the texts that are word for word those of a template."""
    hashes = np.array(sorted(known), np.int64).view(np.uint64)

    def same_words(words: tk.Words, raw: bytes, i: int, k: int, h: int) -> bool:
        said = tuple(raw[a:b].lower() for a, b in zip(words.start[i:i + k].tolist(), words.end[i:i + k].tolist()))
        return said in known[h]

    def run(batches):
        for batch in batches:
            counts, at, found = [], [], []
            for _, words in tk.scan(batch.column(1), tk.ALNUM):
                doc = words.doc()
                pos = np.arange(len(doc)) - words.bounds[doc]
                left = words.bounds[doc + 1] - words.bounds[doc] - pos if len(doc) else pos
                hit_doc, hit_pos, hit_h = [], [], []
                raw = words.raw.tobytes()
                for k in sizes:
                    h = tk.grams(words.hash, k)
                    i = np.flatnonzero(bits[(h >> np.uint64(48)).astype(np.int64)] & (left[:len(h)] >= k))
                    i = i[np.isin(h[i], hashes)]
                    i = i[[same_words(words, raw, x, k, y) for x, y in zip(i.tolist(), h[i].view(np.int64).tolist())]] \
                        if len(i) else i
                    hit_doc.append(doc[i])
                    hit_pos.append(pos[i])
                    hit_h.append(h[i].view(np.int64))
                of = np.concatenate(hit_doc)
                order = np.argsort(of, kind="stable")
                cut = np.searchsorted(of[order], np.arange(1, len(words.bounds) - 1))
                counts.append(np.diff(words.bounds))
                at += np.split(np.concatenate(hit_pos)[order], cut)
                found += np.split(np.concatenate(hit_h)[order], cut)
            n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), tk.list_array(at, pa.int64()),
                 tk.list_array(found, pa.int64())], names=["doc_id", "n_words", "pos", "h"])
    return run


def license_spans(rows: DataFrame) -> DataFrame:
    """Verified spans (row, template, label, base, places, first, last, score) of a
    table (row, pos, h) of candidate grams."""
    spark = rows.sparkSession
    index = F.broadcast(spark.createDataFrame(templates(), "template int, label string, base boolean, words int, k int,"
                                                           " tpos int, h long"))  # fixed list above
    hits = (rows.select("row", F.explode(F.arrays_zip("pos", "h")).alias("x")).select("row", "x.pos", "x.h")
            .join(index, "h"))
    lines = (hits.groupBy("row", "template", "label", "base", "words", "k",
                          (F.col("pos") - F.col("tpos")).alias("diagonal"))
             .agg(F.count(F.lit(1)).alias("places"), F.min("pos").alias("first"), F.max("pos").alias("last"),
                  F.collect_set("tpos").alias("at")))
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    jump = (F.col("diagonal") - F.lag("diagonal").over(order) > NEAR).cast("int")
    spans = (lines.withColumn("band", F.sum(F.coalesce(jump, F.lit(0))).over(order))
             .groupBy("row", "template", "label", "base", "words", "k", "band")
             .agg(F.sum("places").alias("places"), F.min("first").alias("first"), F.max("last").alias("last"),
                  F.array_distinct(F.flatten(F.collect_list("at"))).alias("at")))
    under = F.size(F.array_distinct(F.flatten(F.transform("at", lambda t: F.sequence(t, t + F.col("k") - 1)))))
    spans = spans.withColumn("score", under / F.col("words"))
    short = F.col("last") - F.col("first") + F.col("k") <= F.col("words") * STRETCH + NEAR
    return spans.where(F.col("base") | ((F.col("score") >= MIN_COVERAGE) & short))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score)."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = templates()
    bits = np.zeros(1 << 16, bool)
    bits[[(r["h"] >> 48) & 0xFFFF for r in rows]] = True
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.mapInArrow(tk.tidy(_scan(bits, sorted({r["k"] for r in rows}), gram_words())),
                            f"doc_id {kind}, n_words long, pos array<long>, h array<long>")
    found = written(found.withColumn("row", F.monotonically_increasing_id()), "grams")
    of_base = lambda x: F.when(F.col("base"), x)
    joined = lambda x: F.array_join(F.sort_array(F.collect_set(x)), ",")
    per = (license_spans(found.where(F.size("pos") > 0)).groupBy("row")
           .agg(F.sum(of_base(F.col("places"))).alias("n_base"), F.min(of_base(F.col("first"))).alias("first_word"),
                F.max(of_base(F.col("last"))).alias("last_word"), joined(of_base(F.col("label"))).alias("base_labels"),
                joined("label").alias("labels"), F.max("score").alias("score")))
    return (found.select("row", "doc_id", "n_words").join(per, "row", "left")
            .select("doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
                    F.col("first_word").cast("long"), F.col("last_word").cast("long"),
                    F.coalesce("base_labels", F.lit("")).alias("base_labels"),
                    F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score")))


def op2_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
