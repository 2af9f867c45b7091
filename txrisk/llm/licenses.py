"""License scan by a positional rare-token index, on DataFrame functions only.

Each licence notice (template) is indexed by the positions of its rarest words,
rarity (IDF) being measured over all documents. A document looks up all its
licence words, postings are intersected by relative position
(document position minus template position), and a template counts when enough
of its weight lines up at one offset and its mandatory key phrase stands there.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import save

# The base phrases and their labels.
BASE = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"),
        ("mit license", "mit")]

# Public licence notices as (label, notice, mandatory key phrase).
TEMPLATES = [
    ("gpl", "This work is licensed under the GNU General Public License", "gnu general public license"),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3", "gnu general public license version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation", "gnu general public license"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
             "Lesser General Public License as published by the Free Software Foundation",
     "gnu lesser general public license"),
    ("apache", "Licensed under the Apache License", "apache license"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", "apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the "
                   "License at http://www.apache.org/licenses/LICENSE-2.0", "in compliance with the license"),
    ("mit", "Released under the MIT License", "mit license"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files", "permission is hereby granted free of charge"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met", "redistribution and use in source and binary forms"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
            "is hereby granted", "permission to use copy modify and or distribute this software"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
     "mozilla public license v 2 0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", "cc by nc"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0", "cc by sa"),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0", "cc by nd"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License",
     "creative commons attribution"),
    ("unlicense", "This is free and unencumbered software released into the public domain",
     "free and unencumbered software released into the public domain"),
]

# Words too plain to be looked up (they stay in the key phrases).
PLAIN = set("a an and any are as at by can for in into is it may no not of or that the this to under use used "
            "with without you".split())
INDEXED = 12     # rarest tokens a template is indexed by
SHARE = 0.5      # of a template's weight that must line up
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words_of(text: str) -> list[str]:
    return re.findall(_WORD, text.lower())


# The licence words, bounded by the templates; a document looks up all it holds.
_VOCABULARY = {w for _, t, _ in TEMPLATES for w in _words_of(t)} - PLAIN
LOOKED_UP = len(_VOCABULARY)


def _quoted(words) -> str:
    return ", ".join(f"'{w}'" for w in sorted(words))


def _located(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row: ``n_words``, licence words with places, and key-phrase starts."""
    phrases = {p for p, _ in BASE} | {p for _, _, p in TEMPLATES}
    longest = max(len(p.split()) for p in phrases)
    firsts = {p.split()[0] for p in phrases}
    any_phrase = "^(" + "|".join(sorted(phrases)) + ")( |$)"
    lowered = F.translate(F.coalesce(text_col, F.lit("")), _UPPER, _LOWER)
    rows = docs.select(F.col(id_col).alias("id"), F.regexp_extract_all(lowered, F.lit(_WORD), F.lit(0)).alias("w"))
    return rows.select(
        "id", F.size("w").cast("long").alias("n_words"),
        F.expr("filter(transform(w, (x, i) -> named_struct('word', x, 'i', i)), "
               f"s -> s.word in ({_quoted(_VOCABULARY)}))").alias("found"),
        F.expr("filter(transform(filter(transform(w, (x, i) -> named_struct('word', x, 'i', i)), "
               f"s -> s.word in ({_quoted(firsts)})), "
               f"s -> named_struct('i', s.i, 'next', array_join(slice(w, s.i + 1, {longest}), ' '))), "
               f"p -> p.next rlike '{any_phrase}')").alias("places"))


def _postings(spark, idf: DataFrame) -> DataFrame:
    """(template, label, phrase, word, at, idf, weight, size) of the rarest tokens."""
    rows = [(k, label, phrase, w, i, len(_words_of(text)))
            for k, (label, text, phrase) in enumerate(TEMPLATES)
            for i, w in enumerate(_words_of(text)) if w not in PLAIN]
    table = spark.createDataFrame(rows, "template int, label string, phrase string, word string, at int, size int")
    rare = Window.partitionBy("template").orderBy(F.desc("idf"), "word", "at")
    kept = table.join(idf, "word").withColumn("nth", F.row_number().over(rare)).where(f"nth <= {INDEXED}")
    return kept.withColumn("weight", F.sum("idf").over(Window.partitionBy("template"))).drop("nth")


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col, n_words, n_base, first_word,
    last_word, base_labels, labels, score``.

    ``score`` is the largest verified template share, 0.5 when only a base
    phrase was found, 0 when nothing was. Null and empty texts have no word and
    empty labels; null ids and repeated rows keep their own rows; other columns
    are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    at = save(_located(docs, id_col, text_col).withColumn("uid", F.monotonically_increasing_id()), "license-words")
    total = at.count()
    seen = at.select(F.explode(F.array_distinct("found.word")).alias("word")).groupBy("word").count()
    # Bounded by the templates' words, whatever the corpus.
    idf = spark.createDataFrame([(w,) for w in sorted(_VOCABULARY)], "word string").join(seen, "word", "left") \
        .select("word", F.log((F.lit(total) + 1.0) / (F.coalesce("count", F.lit(0)) + 1.0) + 1.0).alias("idf"))
    idf = save(idf, "license-idf")
    index = F.broadcast(_postings(spark, idf))

    starts = at.where(F.size("places") > 0)
    place = starts.select("uid", F.explode("places").alias("p")).select("uid", F.col("p.i").alias("i"), "p.next")
    begins = F.concat("next", F.lit(" ")).startswith(F.concat("phrase", F.lit(" ")))
    base = spark.createDataFrame(BASE, "phrase string, label string")
    base_hits = place.join(F.broadcast(base.withColumn("word", F.split("phrase", " ")[0])),
                           (F.split("next", " ")[0] == F.col("word")) & begins)
    base_docs = base_hits.groupBy("uid").agg(
        F.count("*").alias("n_base"), F.min("i").cast("long").alias("first_word"),
        F.max("i").cast("long").alias("last_word"), F.collect_set("label").alias("base_set"))

    looked_up = starts.select("uid", F.explode("found").alias("f")).select("uid", "f.word", "f.i")
    aligned = looked_up.join(index, "word") \
        .groupBy("uid", "template", "label", "phrase", "size", "weight", (F.col("i") - F.col("at")).alias("offset")) \
        .agg(F.sum("idf").alias("got")) \
        .withColumn("share", F.least(F.lit(1.0), F.col("got") / F.col("weight"))).where(F.col("share") >= SHARE)
    verified = aligned.join(place, "uid").where(
        begins & F.col("i").between(F.col("offset"), F.col("offset") + F.col("size")))
    method = verified.groupBy("uid").agg(F.max("share").alias("share"), F.collect_set("label").alias("more"))

    none = F.expr("cast(array() as array<string>)")
    joined = at.select("uid", "id", "n_words").join(base_docs, "uid", "left").join(method, "uid", "left")
    base_set, more = F.coalesce("base_set", none), F.coalesce("more", none)
    return joined.select(
        F.col("id").alias(id_col), "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word", "last_word", F.array_join(F.array_sort(base_set), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base_set, more)), ",").alias("labels"),
        F.coalesce("share", F.when(F.size(base_set) > 0, 0.5).otherwise(0.0)).alias("score"))
