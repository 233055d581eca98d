"""Licence scan by diagonal voting (built-in expressions only).

Every rolling k-gram of a text's words is hashed; those whose hash is one of the templates'
are joined, as words, to the template positions. Each match votes for
the diagonal "place in the text minus place in the template"; neighbouring diagonals are
merged, so inserted, lost or substituted words do not break a match, and a merged diagonal is
verified: enough of the template's grams must have voted in a span of about its length. A lost or
substituted word breaks k grams, an inserted one k - 1; a template of n words may miss the grams of
``edits(n)`` such edits (two, or one in seven words if that is more) but needs two votes; of a
notice under 8 words two edits may leave fewer, and it is then not found. Words that tell licences apart
(``TELLING`` and numbers) may not be edited: unless all grams voted, the span must have the template's
telling words and no others ("version 2" is no changed "version 3"). Templates may have any length, whole licence
texts among them: what a match covers is counted by grouping its votes.
The templates are a fixed list of this module, so broadcasting them is bounded.

Base phrases are templates whose every gram must sit on one diagonal: their words stand
there consecutively.

Defined cases: a NULL or empty text has no words and no label; repeated rows are scanned one by
one (rows are told apart by a row number, not by doc_id); a NULL doc_id is returned as such.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitpanel.llm.base import staged, texts

K = 3
GAP = 2                # diagonals this near are one match
LEAST_VOTES = 2        # grams of a notice that must vote, whatever edits break the others
SHIFT = 2              # words by which edits next to an end of a notice may move that end

# Phrases whose places are counted, and licence notices with their labels.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
NOTICES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software "
            "and associated documentation files the software to deal in the software without restriction"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction including without limitation the "
            "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
            "persons to whom the software is furnished to do so subject to the following conditions the above copyright "
            "notice and this permission notice shall be included in all copies or substantial portions of the software the "
            "software is provided as is without warranty of any kind express or implied including but not limited to the "
            "warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the "
            "authors or copyright holders be liable for any claim damages or other liability whether in an action of "
            "contract tort or otherwise arising from out of or in connection with the software or the use or other dealings "
            "in the software"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license "
                 "you may obtain a copy of the license at"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("gpl-3", "redistribute it and or modify it under the terms of the gnu general public license as published by "
              "the free software foundation either version 3 of the license"),
    ("gpl-2", "licensed under the gnu general public license version 2"),
    ("lgpl-3", "licensed under the gnu lesser general public license version 3"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "creative commons attribution sharealike 4 0 international license"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
            "provided that the following conditions are met"),
)
TELLING = ("mit", "bsd", "apache", "mozilla", "eclipse", "gnu", "gpl", "lgpl", "agpl", "lesser", "library", "affero",
           "cc", "nc", "sa", "nd", "creative", "commons", "attribution", "noncommercial", "sharealike", "noderivatives",
           "noderivs")
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def edits(n_words: int) -> int:
    """Lost, substituted or inserted words that a notice of so many words may have."""
    return max(2, n_words // 7)


def tells(word: str) -> bool:
    return word in TELLING or word.isdigit()


def template_rows(phrases=PHRASES, notices=NOTICES, k: int = K) -> list:
    """(template, label, base, grams in the template, place, gram) rows; k to 62 + k words each."""
    out = []
    for base, entries in ((True, phrases), (False, notices)):
        for label, text in entries:
            w = text.split()
            n = len(w) - k + 1
            if n < 1:
                raise ValueError(f"a template needs {k} words or more: {text}")
            out += [(f"{base}:{label}:{text}", label, base, n, i, " ".join(w[i:i + k])) for i in range(n)]
    return out


def hits(docs: DataFrame, rows: list, k: int = K) -> DataFrame:
    """(rid, doc_id, n_words, hits): the text's grams whose hash is a template's, with their words."""
    text = F.translate(F.col("text"), UPPER, LOWER)
    d = texts(docs).select(
        F.monotonically_increasing_id().alias("rid"), "doc_id",
        F.filter(F.split(text, SEPARATORS), lambda w: w != F.lit("")).alias("words"))
    words, n = F.col("words"), F.size("words")
    rolled = words
    for j in range(1, k):               # the hash of j + 1 words from that of j words and the next word
        rolled = F.zip_with(rolled, F.slice(words, j + 1, F.greatest(n, F.lit(1))),
                            lambda h, w: F.when(w.isNotNull(), F.xxhash64(h, w)))
    known = []
    for gram in sorted({r[5] for r in rows}):
        first, *rest = gram.split()
        h = F.lit(first)
        for w in rest:
            h = F.xxhash64(h, F.lit(w))
        known.append(h)
    found = F.filter(F.transform(rolled, lambda h, i: F.when(h.isin(*known), F.struct(
        i.cast("long").alias("pos"), F.array_join(F.slice(words, i + 1, F.lit(k)), " ").alias("gram")))),
        lambda s: s.isNotNull())
    telling = F.filter(F.transform(words, lambda w, i: F.struct(i.cast("long").alias("pos"), w.alias("word"))),
                       lambda s: s["word"].isin(*TELLING) | s["word"].rlike("^[0-9]+$"))
    return d.select("rid", "doc_id", n.cast("long").alias("n_words"), "words", F.when(n >= k, found).alias("hits")) \
        .select("rid", "doc_id", "n_words", "hits", F.when(F.size("hits") > 0, telling).alias("telling"))


def spans(spark: SparkSession, found: DataFrame, rows: list, k: int = K, gap: int = GAP) -> DataFrame:
    """(rid, label, base, start, end, cover): verified matches, in words, end exclusive."""
    templates = spark.createDataFrame(rows, "template string, label string, base boolean, n_grams int, "
                                            "place int, gram string")
    known = spark.createDataFrame(
        [(name, [w for w in name.split(":", 2)[2].split() if tells(w)],
          max(n - k * edits(n + k - 1), min(LEAST_VOTES, n))) for name, n in sorted({(r[0], r[3]) for r in rows})],
        "template string, tells array<string>, least int")
    # a place of a template and a diagonal make a place of the text: each row is another vote
    votes = (found.select("rid", F.inline("hits"))
             .join(F.broadcast(templates), "gram")
             .select("rid", "template", "label", "base", "n_grams", "place", "pos", (F.col("pos") - F.col("place")).alias("diagonal")))
    kind = ["rid", "template", "label", "base", "n_grams"]
    full = (votes.where("base").groupBy(*kind, "diagonal")
            .agg(F.count(F.lit(1)).alias("hit"), F.min("pos").alias("start"), (F.max("pos") + k).alias("end"))
            .where("hit = n_grams").withColumn("cover", F.lit(1.0)))
    w = Window.partitionBy("rid", "template").orderBy("diagonal", "place")
    merged = (votes.where("NOT base")
              .withColumn("fresh", F.when(F.col("diagonal") - F.lag("diagonal").over(w) <= gap, 0).otherwise(1))
              .withColumn("match", F.sum("fresh").over(w))
              .groupBy(*kind, "match")
              .agg(F.count_distinct("place").alias("hit"), F.min("pos").alias("start"), (F.max("pos") + k).alias("end"),
                   F.min("place").alias("first"), F.max("place").alias("last")))
    near = (merged.join(F.broadcast(known), "template")
            .where((F.col("hit") >= F.col("least"))
                   & (F.col("end") - F.col("start") <= (F.col("n_grams") + k - 1) * 1.5 + gap)))
    begin, stop = F.col("start") - F.col("first"), F.col("end") + F.col("n_grams") - 1 - F.col("last")
    shifts = F.array(*[F.lit(i) for i in range(-SHIFT, SHIFT + 1)])
    same = F.exists(shifts, lambda a: F.exists(shifts, lambda b: F.transform(
        F.filter("telling", lambda s: (s["pos"] >= begin + a) & (s["pos"] < stop + b)), lambda s: s["word"]) == F.col("tells")))
    verified = (near.join(found.select("rid", "telling"), "rid").where((F.col("hit") == F.col("n_grams")) | same)
                .withColumn("cover", F.col("hit") / F.col("n_grams")))
    cols = ["rid", "label", "base", "start", "end", "cover"]
    return full.select(*cols).unionByName(verified.select(*cols))


def scan(docs: DataFrame, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """One row per document: n_words, n_base, first_word, last_word, base_labels, labels, score
    (the best cover of a verified span, 0 without one)."""
    spark = docs.sparkSession
    rows = template_rows(phrases, notices)
    found = staged(hits(docs, rows), "licenses")
    per = spans(spark, found.where(F.size("hits") > 0), rows).groupBy("rid").agg(
        F.count(F.when(F.col("base"), 1)).alias("n_base"),
        F.min(F.when(F.col("base"), F.col("start"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("start"))).alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"),
        F.max("cover").alias("score"))
    return found.select("rid", "doc_id", "n_words").join(per, "rid", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
