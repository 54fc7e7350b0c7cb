"""License scan by diagonal voting.

All rolling ``K``-word grams of the documents are hashed and joined with the grams of the license templates. A hit votes for
the diagonal of its document (place in the document less place in the template). Votes are counted by diagonal, each diagonal is merged with
those at most ``NEIGHBOURS`` words to either side, and the span is verified: its score is the share of the template's grams in the longest chain
that was found word by word in the template's order. At ``PERCENT`` percent it is accepted. So grams in another order, or strewn over more than
``2 * NEIGHBOURS`` words beyond the template's length, get no label. Base phrases are templates too: a place of a phrase is a diagonal that holds all its grams.

Templates are a parameter and small (some tens of kilobytes), so their grams are broadcast and documents are never shuffled;
only hits are, a few rows each document. One more entry behind the last gram of each document makes it appear without hits.

Defined results: a null or empty text has no words, no places, null ``first_word`` and ``last_word``, empty labels and score 0; rows with the
same ``doc_id`` are scanned one by one; an empty table gives no rows; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import row_key, stored, table
from ledgerlens.llm.words import places, words

#: Words of a gram, diagonals to either side that are merged, share of a template that must be found.
K, NEIGHBOURS, PERCENT = 3, 4, 70

# Phrases that must be found as they are, and the label of each.
PHRASES = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]

# Notices as their licenses word them, and the label of each.
NOTICES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "Released under the MIT License"),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]

_END = "end of text"


def template_words(text: str) -> list[str]:
    """Words as the scan takes them from a document."""
    lower = "".join(c.lower() if c.isascii() else c for c in text)
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def template_grams(spark: SparkSession, phrases: list[tuple[str, str]], notices: list[tuple[str, str]]) -> DataFrame:
    """``tid, label, base, n_grams, tpos, gram`` of all templates."""
    rows = []
    for tid, (label, text, base) in enumerate([(*p, True) for p in phrases] + [(*n, False) for n in notices]):
        w = template_words(text)
        if len(w) < K:
            raise ValueError(f"a template needs {K} words: {text!r}")
        rows += [(tid, label, base, len(w) - K + 1, i, w[i : i + K]) for i in range(len(w) - K + 1)]
    return spark.createDataFrame(rows, "tid int, label string, base boolean, n_grams int, tpos int, gram array<string>")


def _seed(gram: list[Column]) -> Column:
    return F.xxhash64(*gram)


def hits(docs: DataFrame, grams: DataFrame) -> DataFrame:
    """``row, doc_id, tid, tpos, place``; a row with null ``tid`` for each document, whose place is the number of words."""
    taken = docs.select(row_key().alias("row"), "doc_id", words(F.col("text")).alias("words"))
    rolling = F.transform(places(F.size("words") - (K - 1)), lambda i: _seed([F.get("words", i + j) for j in range(K)]))
    ended = F.concat(rolling, F.array(F.xxhash64(F.lit(_END))))
    # hashes in a step of their own: explode and join then run as one generated loop, which holds the words by reference
    exploded = taken.select("row", "doc_id", "words", ended.alias("seeds")).select("row", "doc_id", "words", F.posexplode_outer("seeds").alias("place", "seed"))
    seeds = grams.select("tid", "tpos", "gram", _seed([F.col("gram")[j] for j in range(K)]).alias("seed"))
    end = grams.sparkSession.range(1).select(F.lit(None).cast("int").alias("tid"), F.lit(None).cast("int").alias("tpos"), F.lit(None).cast("array<string>").alias("gram"), F.xxhash64(F.lit(_END)).alias("seed"))
    found = exploded.join(F.broadcast(seeds.union(end)), "seed")
    last = F.col("tid").isNull() & (F.col("place") == F.greatest(F.size("words") - (K - 1), F.lit(0)))
    exact = F.slice("words", F.col("place") + 1, K) == F.col("gram")
    place = F.when(F.col("tid").isNull(), F.size("words")).otherwise(F.col("place"))
    return found.filter(last | exact).select("row", "doc_id", "tid", "tpos", place.alias("place"))


def diagonals(found: DataFrame) -> DataFrame:
    """Votes of each diagonal: ``row, tid, diagonal, votes, tposes``; a diagonal holds each gram of the template at most once."""
    voted = found.filter("tid is not null").withColumn("diagonal", F.col("place") - F.col("tpos"))
    return voted.groupBy("row", "tid", "diagonal").agg(F.count("*").alias("votes"), F.collect_set("tpos").alias("tposes"))


def _chain(hits: Column, n_grams: Column) -> Column:
    """Length of the longest chain of hits ascending in both place and template place.

    ``hits`` ascend by place and descend by template place where the place is the same, so no two of one place are chained. The state holds,
    for each template place, the longest chain that ends there.
    """
    def step(best: Column, hit: Column) -> Column:
        at = -hit["back"]
        longer = 1 + F.coalesce(F.array_max(F.slice(best, F.lit(1), at)), F.lit(0))
        return F.transform(best, lambda held, i: F.when(i == at, F.greatest(held, longer)).otherwise(held))

    return F.array_max(F.aggregate(hits, F.array_repeat(F.lit(0), n_grams), step))


def spans(votes: DataFrame, templates: DataFrame) -> DataFrame:
    """Verified spans: ``row, tid, diagonal, covered, first_word, last_word``, one for each diagonal with votes.

    The diagonals at most ``NEIGHBOURS`` to either side are merged with it, so a span is at most ``2 * NEIGHBOURS`` words longer than its
    template and its hits are bounded by the template, however often the text repeats it. ``covered`` is the longest chain of those
    hits in which both the place and the template place ascend.
    """
    around = Window.partitionBy("row", "tid").orderBy("diagonal").rangeBetween(-NEIGHBOURS, NEIGHBOURS)
    merged = votes.select("row", "tid", "diagonal", "votes", F.collect_list(F.struct("diagonal", "tposes")).over(around).alias("near"))

    def placed(one: Column) -> Column:
        return F.transform(one["tposes"], lambda t: F.struct((one["diagonal"] + t).alias("place"), (-t).alias("back")))

    hits = F.array_sort(F.flatten(F.transform("near", placed)))
    listed = merged.join(templates.select("tid", "n_grams"), "tid").select("row", "tid", "diagonal", "votes", "n_grams", F.size("near").alias("n_near"), hits.alias("hits"))
    # hits of a lone diagonal are a chain as they are
    covered = F.when(F.col("n_near") == 1, F.col("votes").cast("int")).otherwise(_chain(F.col("hits"), F.col("n_grams")))
    first, last = F.get("hits", F.lit(0))["place"], F.element_at("hits", -1)["place"] + K - 1
    return listed.select("row", "tid", "diagonal", covered.alias("covered"), first.alias("first_word"), last.alias("last_word"))


def scan(docs: DataFrame, phrases: list[tuple[str, str]] | None = None, notices: list[tuple[str, str]] | None = None) -> DataFrame:
    """Per document row: ``n_words``, base places and labels, labels of accepted spans and the best coverage."""
    spark = docs.sparkSession
    grams = template_grams(spark, PHRASES if phrases is None else phrases, NOTICES if notices is None else notices)
    templates = F.broadcast(grams.filter("tpos = 0").select("tid", "label", "base", "n_grams"))
    found = stored(hits(docs, grams), "license-hits")
    votes = diagonals(found)
    base = votes.join(templates.filter("base"), "tid").filter("votes = n_grams").groupBy("row").agg(
        F.count("*").alias("n_base"), F.min("diagonal").alias("first_word"), F.max("diagonal").alias("last_word"), F.collect_set("label").alias("base_set"))
    covered = spans(votes, templates).join(templates, "tid").withColumn("share", F.col("covered") / F.col("n_grams"))
    accepted = F.when(~F.col("base") & (F.col("covered") * 100 >= F.col("n_grams") * PERCENT), F.col("label"))
    own = covered.groupBy("row").agg(F.collect_set(accepted).alias("own_set"), F.max("share").alias("score"))
    documents = found.filter("tid is null").select("row", "doc_id", F.col("place").cast("long").alias("n_words"))
    whole = documents.join(base, "row", "left").join(own, "row", "left")
    empty = F.array().cast("array<string>")
    base_set, own_set = F.coalesce("base_set", empty), F.coalesce("own_set", empty)
    return whole.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), F.col("first_word").cast("long"), F.col("last_word").cast("long"),
        F.array_join(F.sort_array(base_set), ",").alias("base_labels"), F.array_join(F.sort_array(F.array_union(base_set, own_set)), ",").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"), "row",
    )


def op10_diagonal_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).drop("row")
