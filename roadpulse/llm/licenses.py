"""License scans by diagonal voting.

All rolling word 3-grams of every text are joined with the positions they have in license
templates. A shared passage puts its votes on one diagonal (position in the text less position
in the template). Votes are counted by diagonal, neighbouring diagonals are merged, so that a
few inserted or missing words do not break a passage, and the spans that hold enough of their
template are kept.

Column expressions only; the templates are a fixed table of a few hundred rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import texts

GRAM = 3
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Diagonals at most this far apart are merged; a span is at most this much longer than its
# template; it must hold this share of the template's 3-grams.
SLACK = 4
LONGEST = 1.5
SHARE = 0.6

# Phrases that count wherever their words stand consecutively, and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Notices of public licenses, and their labels.
NOTICES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mit", "Released under the MIT License"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd-3", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("gpl-2", "This work is licensed under the GNU General Public License, version 2"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-3", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("gpl-2", "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl-3", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by", "Creative Commons Attribution 4.0 International License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("reserved", "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any means"),
]
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: str) -> str:
    return text.translate(str.maketrans(_UPPER, _UPPER.lower()))


def template_grams(notices: list[tuple[str, str]] | None = None) -> list[tuple]:
    """(template, label, base, n_grams, place, three words) of every 3-gram of every template."""
    listed = [(label, phrase, True) for phrase, label in PHRASES.items()]
    listed += [(label, text, False) for label, text in (NOTICES if notices is None else notices)]
    rows = []
    for number, (label, text, base) in enumerate(listed):
        words = re.findall(WORD, lower_ascii(text))
        grams = len(words) - GRAM + 1
        rows += [(number, label, base, grams, i, *words[i : i + GRAM]) for i in range(grams)]
    return rows


# Every text gives one vote for this template of its own, so that all rows come through the join.
_EACH_TEXT = (-1, "", False, 0, 0, None, None, None)


def _templates(spark: SparkSession, notices) -> DataFrame:
    schema = "template int, label string, base boolean, n_grams int, place int, w0 string, w1 string, w2 string"
    rows = spark.createDataFrame([_EACH_TEXT, *template_grams(notices)], schema)
    gram = F.when(F.col("template") >= 0, F.xxhash64("w0", "w1", "w2")).otherwise(0)
    return rows.select("template", "label", "base", "n_grams", "place", gram.alias("t_gram"))


# Lower case for A-Z alone; on ASCII texts that is what lower() does, and faster.
_LOWER = f"CASE WHEN octet_length(text) = length(text) THEN lower(text) ELSE translate(text, '{_UPPER}', '{_UPPER.lower()}') END"
_SPLIT = f"split({_LOWER}, r'{GAP}')"
_WORDS = (
    f"element_at(transform(array({_SPLIT}), w -> slice(w, if(w[0] = '', 2, 1),"
    " greatest(size(w) - if(w[0] = '', 1, 0) - if(size(w) > 1 AND w[size(w) - 1] = '', 1, 0), 0))), 1)"
)
_GRAMS = (
    f"element_at(transform(array({_WORDS}), w -> named_struct('n', size(w), 'grams',"
    f" array_append(CASE WHEN size(w) < {GRAM} THEN cast(array() AS array<bigint>) ELSE"
    f" transform(sequence(0, size(w) - {GRAM}), i -> xxhash64(w[i], w[i + 1], w[i + 2])) END, 0L))), 1)"
)


def _bands(docs: DataFrame, notices: list[tuple[str, str]] | None) -> DataFrame:
    """Merged diagonals of every (text, template), and one row of template -1 for every text."""
    rows = texts(docs).select("doc_id", F.xxhash64("text").alias("text_key"), F.expr(_GRAMS).alias("cut"))
    placed = rows.select("doc_id", "text_key", F.col("cut.n").alias("n_words"), F.posexplode("cut.grams").alias("pos", "gram"))
    templates = F.broadcast(_templates(docs.sparkSession, notices))
    each = F.col("template") < 0
    votes = (
        placed.join(templates, F.col("gram") == F.col("t_gram"))
        .withColumn("diagonal", F.when(each, 0).otherwise(F.col("pos") - F.col("place")))
        .drop("gram", "t_gram")
        .repartition("doc_id", "text_key")
    )
    one = ["doc_id", "text_key", "n_words", "template", "label", "base", "n_grams"]
    diagonals = votes.groupBy(*one, "diagonal").agg(
        F.collect_set("place").alias("places"),
        F.min("pos").alias("first"),
        F.max("pos").alias("last"),
        F.count("*").alias("votes"),
    )
    along = Window.partitionBy("doc_id", "text_key").orderBy("template", "diagonal")
    apart = (F.lag("template").over(along) != F.col("template")) | (
        F.col("diagonal") - F.lag("diagonal").over(along) > SLACK
    )
    starts = F.when(F.col("base") | F.lag("template").over(along).isNull() | apart, 1).otherwise(0)
    return (
        diagonals.withColumn("starts", starts)
        .withColumn("band", F.sum("starts").over(along))
        .groupBy(*one, "band")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("held"),
            F.min("first").cast("long").alias("start"),
            (F.max("last") + GRAM).cast("long").alias("stop"),
            F.max("votes").alias("votes"),
        )
        .withColumn("share", F.col("held") / F.greatest("n_grams", F.lit(1)))
        .withColumn("verified", _verified())
    )


def _verified() -> Column:
    fits = F.col("stop") - F.col("start") <= (F.col("n_grams") + GRAM - 1) * LONGEST
    most = (F.col("share") >= SHARE) & fits
    return (F.col("template") >= 0) & F.when(F.col("base"), F.col("held") == F.col("n_grams")).otherwise(most)


def license_spans(docs: DataFrame, notices: list[tuple[str, str]] | None = None) -> DataFrame:
    """Every span that shares 3-grams with a template.

    doc_id, text_key, template, label, base, start and stop (words from 0, stop exclusive),
    share (of the template's 3-grams), verified. Spans of phrases stand on one diagonal and are
    verified when complete, so overlapping occurrences are told apart; those of notices when
    they hold enough of the template within a span of about its length. Repeated rows are one
    here; a text without 3-grams has no spans.
    """
    return _bands(docs, notices).filter("template >= 0").select(
        "doc_id", "text_key", "template", "label", "base", "start", "stop", "share", "verified"
    )


def scan_licenses(docs: DataFrame, notices: list[tuple[str, str]] | None = None) -> DataFrame:
    """One row per input row: word count, base places and labels, all labels and a score.

    Of verified spans that overlap under different labels only the best counts, but base labels
    always do. The score is the largest share of a template that one span holds. Rows without
    any shared 3-gram, null and empty texts have no labels, null places and score 0. Null ids
    and repeated rows come out as they are; further columns are left out.
    """
    base = F.col("verified") & F.col("base")
    # no verified span of a notice is longer than this, so only near ones can overlap
    longest = int(max(row[3] + GRAM - 1 for row in template_grams(notices)) * LONGEST)
    near = Window.partitionBy("doc_id", "text_key").orderBy("start").rangeBetween(-longest, longest)
    sure = F.when(F.col("verified"), F.struct("start", "stop", "share", "label"))
    better = "exists(near, o -> o.start < stop AND start < o.stop AND o.share > share AND o.label <> label)"
    bands = _bands(docs, notices).withColumn("near", F.collect_list(sure).over(near))
    kept = F.col("verified") & (F.col("base") | ~F.expr(better))
    label = lambda ok: F.array_join(F.array_sort(F.collect_set(F.when(ok, F.col("label")))), ",")
    found = bands.withColumn("kept", kept).groupBy("doc_id", "text_key", "n_words").agg(
        F.sum(base.cast("long")).alias("n_base"),
        F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"),
        label(base).alias("base_labels"),
        label(F.col("kept")).alias("labels"),
        F.max(F.when(F.col("template") < 0, 0.0).otherwise(F.col("share"))).alias("score"),
        F.max(F.when(F.col("template") < 0, F.col("votes"))).alias("copies"),
    )
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        "n_base",
        "first_word",
        "last_word",
        "base_labels",
        "labels",
        "score",
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
    ).drop("copy")
