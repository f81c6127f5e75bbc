"""License scans by diagonal voting.

Texts become words (runs of letters and digits, A-Z lower-cased), and so do license templates.
All rolling word k-grams of all texts are joined to the template places with the same k-gram: each
joined pair votes for its diagonal, the word at which the template would begin in the text. Votes
are summed by diagonal. A diagonal on which every k-gram of a template has voted is a whole copy.
For long templates, diagonals of one document that lie close to each other (a word put in or left
out shifts the rest) are merged, and the merged span counts if enough of the template's k-grams
voted within it and they lie dense enough in the text.

The join is on the words of the k-gram themselves, so equal places are equal words and spans need
no second look at the text: hash collisions, which would need one, cannot occur. Texts are not
moved; the template table, a constant of this module, is the only side that is broadcast. Only
votes are shuffled, by document and template, after adding them up by diagonal in each task.

Everything is DataFrame expressions.

Defined results: NULL and empty texts have no words, no places, NULL places and empty labels, and
score 0. Rows that repeat a ``doc_id`` and text get equal results, rows that repeat an id with
another text their own; a NULL ``doc_id`` is a row like any other. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

# The phrases whose whole copies are the base places, and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Opening or defining passages of public licenses, as words.
PASSAGES = {
    "mit": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software "
        "and associated documentation files the software to deal in the software without restriction"
    ),
    "apache-2": (
        "unless required by applicable law or agreed to in writing software distributed under the "
        "license is distributed on an as is basis without warranties or conditions of any kind"
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met"
    ),
    "isc": (
        "permission to use copy modify and or distribute this software for any purpose with or without "
        "fee is hereby granted provided that the above copyright notice"
    ),
    "gpl": (
        "this program is free software you can redistribute it and or modify it under the terms of the "
        "gnu general public license as published by the free software foundation"
    ),
    "mpl-2": (
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy "
        "of the mpl was not distributed with this file"
    ),
    "unlicense": "this is free and unencumbered software released into the public domain",
}
# Short notices, found as whole copies only.
NOTICES = {
    "licensed under the apache license": "apache-2",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl-2",
    "creative commons attribution": "cc-by",
    "licensed under cc by": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "all rights reserved": "proprietary",
}
K = 3
#: Diagonals of one template at most this far apart are merged.
NEAR = 3
#: Share of a passage's k-grams that must have voted, and votes per word of the merged span.
COVERED, DENSE = 0.5, 0.5

#: The words of a text: everything but ASCII letters, ASCII digits and non-ASCII separates them.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lowered(text: Column) -> Column:
    """A-Z in lower case, nothing else changed."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def words_of(text: Column) -> Column:
    """The words of a text in order; none for NULL."""
    return F.filter(F.split(lowered(F.coalesce(text.cast("string"), F.lit(""))), SEPARATORS, -1), lambda w: w != "")


def template_grams(spark: SparkSession) -> DataFrame:
    """(template, kind, label, grams, at, w0, w1, w2): one row for each k-gram of each template."""
    templates = [
        *(("base", phrase, label) for phrase, label in PHRASES.items()),
        *(("notice", phrase, label) for phrase, label in NOTICES.items()),
        *(("passage", passage, label) for label, passage in PASSAGES.items()),
    ]
    rows = []
    for number, (kind, text, label) in enumerate(templates):
        words = text.split()
        for at in range(len(words) - K + 1):
            rows.append((number, kind, label, len(words) - K + 1, at, *words[at : at + K]))
    fields = [("template", T.IntegerType()), ("kind", T.StringType()), ("label", T.StringType())]
    fields += [("grams", T.IntegerType()), ("at", T.IntegerType())]
    fields += [(f"w{k}", T.StringType()) for k in range(K)]
    return spark.createDataFrame(rows, T.StructType([T.StructField(n, t) for n, t in fields]))


def votes(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, template, kind, label, grams, diagonal, votes, first, last) by diagonal.

    ``first`` and ``last`` are the text's words at the first and last voting k-gram; a k-gram that
    a template holds twice votes on both diagonals.
    """
    words = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_key"),
        words_of(F.col("text")).alias("words"),
    )
    shifted = [F.slice("words", k + 1, F.greatest(F.size("words") - k, F.lit(0))) for k in range(1, K)]
    grams = words.filter(F.size("words") >= K).select(
        "doc_id", "text_key", F.posexplode(F.arrays_zip(F.col("words").alias("w0"), *(s.alias(f"w{k + 1}") for k, s in enumerate(shifted))))
    )
    grams = grams.select("doc_id", "text_key", "pos", *(F.col(f"col.w{k}").alias(f"w{k}") for k in range(K)))
    table = F.broadcast(template_grams(docs.sparkSession))
    places = grams.join(table, [f"w{k}" for k in range(K)])
    return (
        places.groupBy("doc_id", "text_key", "template", "kind", "label", "grams", (F.col("pos") - F.col("at")).alias("diagonal"))
        .agg(
            F.count_distinct("at").alias("votes"),
            F.min("pos").alias("first"),
            F.max("pos").alias("last"),
        )
    )


def spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, kind, label, first_word, last_word, score), one row for each match.

    Phrases and notices match where all their k-grams voted on one diagonal. Of a passage,
    neighbouring diagonals are merged, and the score is the share of its k-grams that voted.
    """
    found = votes(docs)
    whole = found.filter("kind <> 'passage' AND votes = grams").select(
        "doc_id", "text_key", "kind", "label",
        F.col("first").alias("first_word"), (F.col("last") + K - 1).alias("last_word"), F.lit(1.0).alias("score"),
    )
    keys = ["doc_id", "text_key", "template"]
    order = W.partitionBy(*keys).orderBy("diagonal")
    new = (F.col("diagonal") - F.lag("diagonal").over(order) > NEAR).cast("int")
    merged = (
        found.filter("kind = 'passage'")
        .withColumn("new", F.coalesce(new, F.lit(0)))
        .withColumn("cluster", F.sum("new").over(order.rowsBetween(W.unboundedPreceding, 0)))
        .groupBy(*keys, "kind", "label", "grams", "cluster")
        .agg(F.sum("votes").alias("votes"), F.min("first").alias("first"), F.max("last").alias("last"))
    )
    share = F.least(F.col("votes") / F.col("grams"), F.lit(1.0))
    dense = F.col("votes") / (F.col("last") - F.col("first") + 1)
    passages = merged.filter((share >= COVERED) & (dense >= DENSE)).select(
        "doc_id", "text_key", "kind", "label",
        F.col("first").alias("first_word"), (F.col("last") + K - 1).alias("last_word"), share.alias("score"),
    )
    return whole.unionByName(passages)


def license_scan(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score. ``score`` is the best match's."""
    base = F.col("kind") == "base"
    by_text = (
        spans(docs)
        .groupBy("doc_id", "text_key")
        .agg(
            F.count(F.when(base, 1)).alias("n_base"),
            F.min(F.when(base, F.col("first_word"))).cast("long").alias("first_word"),
            F.max(F.when(base, F.col("first_word"))).cast("long").alias("last_word"),
            F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
            F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
            F.max("score").alias("score"),
        )
        .withColumnsRenamed({"doc_id": "found_id", "text_key": "found_key"})
    )
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_key"),
        F.size(words_of(F.col("text"))).cast("long").alias("n_words"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("text_key") == F.col("found_key"))
    return own.join(by_text, same, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).cast("double").alias("score"),
    )
