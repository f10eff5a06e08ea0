"""License scan by diagonal voting, in DataFrame functions only.

Every two neighbouring words of a document are hashed and joined to the positions of the same pair in the
templates; the pair itself is compared too, so an equal hash of other words does not count. A match votes for
the diagonal ``word position - template position``. The votes of a diagonal are the set of the template
positions met, however long the template. Neighbouring diagonals, which a word more or less in the text parts, are merged, and a merged
span counts when it covers enough of the template within a span of about the template's length, or when one
of its diagonals alone covers enough. A phrase counts where one diagonal holds all of it.

Words are runs of digits, letters and all characters outside ASCII, with A-Z in lower case.

Defined cases: a null text is empty and has no words; rows that repeat an id and a text are one document, rows
of one id with different texts are different documents; a missing id is an id like others; labels without any
finding are the empty string; further columns are ignored; an empty table gives an empty table.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The phrases and their labels.
PHRASES = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)
# Usual wordings of licence notices.
NOTICES = (
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "Released under the MIT License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
COVER = 0.8  # share of a notice's word pairs that must be met
GAP = 2  # diagonals at most so far apart are neighbours
SLACK = 1.25  # a span may be so many times as long as its notice

DOC = ["id", "text_hash"]


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def pairs(rows: DataFrame) -> DataFrame:
    """Each word of ``words`` with its place, the next word, and the hash of both; one row at least."""
    placed = rows.select("*", F.posexplode_outer("words").alias("place", "word"))
    following = F.get("words", F.col("place") + 1)
    return placed.withColumn("next", following).withColumn("pair", F.xxhash64("word", "next"))


def templates(spark: SparkSession, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """The word pairs of all templates: a few hundred rows, whatever the corpus."""
    listed = [(label, text, True) for label, text in phrases] + [(label, text, False) for label, text in notices]
    row = lambda i, x: F.struct(
        F.lit(i).alias("template"), F.lit(x[0]).alias("label"), F.lit(x[1]).alias("text"), F.lit(x[2]).alias("phrase"))
    rows = spark.range(1).select(F.inline(F.array(*[row(i, x) for i, x in enumerate(listed)])))
    rows = rows.withColumn("words", words(F.col("text"))).withColumn("n_pairs", F.size("words") - 1)
    return pairs(rows).where(F.col("next").isNotNull()).select(
        "template", "label", "phrase", "n_pairs", F.col("place").alias("at"),
        F.col("word").alias("t_word"), F.col("next").alias("t_next"), F.col("pair").alias("t_pair"),
    )


def votes(docs: DataFrame, id_col: str, text_col: str, lists: DataFrame) -> DataFrame:
    """One row per document without a template, and one per document, template and diagonal that is met."""
    rows = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), words(F.col(text_col)).alias("words"),
    ).withColumn("n_words", F.size("words"))
    met = (F.col("pair") == F.col("t_pair")) & (F.col("word") == F.col("t_word")) & (F.col("next") == F.col("t_next"))
    hits = pairs(rows).join(F.broadcast(lists), met, "left")
    hits = hits.where(F.col("template").isNotNull() | F.col("place").isNull() | (F.col("place") == 0))
    # the first word stands for its document beside the matches
    first = F.when(F.coalesce("place", F.lit(0)) == 0, F.array(F.lit(False))).otherwise(F.array())
    found = F.when(F.col("template").isNotNull(), F.array(F.lit(True))).otherwise(F.array())
    hits = hits.withColumn("found", F.explode(F.concat(first, found)))
    only = lambda name: F.when(F.col("found"), F.col(name))
    return hits.groupBy(
        *DOC, "n_words", *[only(c).alias(c) for c in ("template", "label", "phrase", "n_pairs")],
        F.when(F.col("found"), F.col("place") - F.col("at")).alias("diagonal"),
    ).agg(
        F.collect_set(only("at")).alias("met"),
        F.min(only("place")).alias("begin"), F.max(only("place")).alias("stop"),
    )


def spans(voted: DataFrame) -> DataFrame:
    """Neighbouring diagonals of a notice merged, with their verified coverage; phrases stay single.

    One shuffle by document serves this and what follows.
    """
    order = Window.partitionBy(*DOC).orderBy("template", "diagonal")
    joins = (
        ~F.col("phrase") & (F.lag("template").over(order) == F.col("template"))
        & (F.col("diagonal") - F.lag("diagonal").over(order) <= GAP)
    )
    share = F.size("met") / F.col("n_pairs")
    marked = voted.withColumn("run", F.sum(F.when(joins, 0).otherwise(1)).over(order)).withColumn("share", share)
    merged = marked.groupBy(*DOC, "n_words", "template", "label", "phrase", "n_pairs", "run").agg(
        F.array_distinct(F.flatten(F.collect_list("met"))).alias("met"), F.max("share").alias("best"),
        F.min("begin").alias("begin"), F.max("stop").alias("stop"), F.min("diagonal").alias("start"),
    )
    short = F.col("stop") - F.col("begin") + 1 <= F.col("n_pairs") * SLACK
    cover = F.when(short, share).otherwise(F.col("best"))
    enough = F.when(F.col("phrase"), cover == 1).otherwise(cover >= COVER)
    return merged.withColumn("cover", F.when(enough, cover))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """Per document: the places of phrases, the labels of phrases and of verified notices, and a score.

    The score is the largest share of a template that was verified, 1 for a phrase, 0 without a finding.
    ``found`` lists the verified spans: label, first and last word, share.
    """
    found = spans(votes(docs, id_col, text_col, templates(docs.sparkSession, phrases, notices)))
    sound = F.col("cover").isNotNull()
    base = sound & F.col("phrase")
    joined = lambda label: F.array_join(F.sort_array(F.collect_set(label)), ",")
    span = F.struct("label", F.col("begin").alias("first"), (F.col("stop") + 1).alias("last"), F.col("cover").alias("share"))
    return found.groupBy(*DOC, "n_words").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        joined(F.when(base, F.col("label"))).alias("base_labels"),
        joined(F.when(sound, F.col("label"))).alias("labels"),
        F.coalesce(F.max("cover"), F.lit(0.0)).alias("score"),
        F.sort_array(F.collect_list(F.when(sound, span))).alias("found"),
    ).withColumn("n_words", F.col("n_words").cast("long")).withColumnRenamed("id", id_col).drop("text_hash")
