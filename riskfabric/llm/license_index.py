"""Licence scan by a positional index of rare licence words, in DataFrame operations only.

Every text is cut into words; only words of the licence vocabulary are kept, with their
positions. Their inverse document frequencies come from all documents. Each template's ``RAREST``
words of the highest frequency score in its mandatory key phrase are looked up wherever they occur
(word -> template, offset); occurrences that agree on the template's first word vote for that place.
A place with the votes of all of them is verified: the template's words are compared at their positions,
enough of them and every word of the key phrase must stand there. As a verified place holds the whole
key phrase, the lookup misses none. The share of matching words is the place's score.

Base phrases are found for themselves, from consecutive positions, and are always reported.

Defined results: null and empty texts have no words, places or labels and score 0; repeated
rows are scanned each; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskfabric.llm.common import ascii_lower, scratch_table

# Base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notices of common licences as (label, words, key phrase).
TEMPLATES = [
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "hereby granted free of charge"),
    ("apache", "licensed under the apache license version 2 0", "apache license version 2"),
    ("apache", "you may not use this file except in compliance with the license", "use this file except in compliance"),
    ("gpl", "this work is licensed under the gnu general public license version", "gnu general public license"),
    ("gpl", "under the terms of the gnu general public license as published by the free software foundation", "gnu general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license", "gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    ("mpl", "subject to the terms of the mozilla public license version 2 0", "mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "modify and or distribute this software"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
]
# Words too common to be indexed; a template matches anything in their places.
COMMON = frozenset("a and any are as by for in is may not of or the this to with you 0 2 4".split())

#: Words of a template's key phrase that are looked up (all of them, if it has fewer).
RAREST = 2
#: A verified place holds this share of the template's indexed words (two words at least).
VOTES = 0.5
#: What a base phrase alone scores.
BASE_SCORE = 0.5
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

VOCABULARY = sorted({w for _, t, _ in TEMPLATES for w in t.split()} - COMMON | {w for p in BASE for w in p.split()})


def _key_offsets(words: list[str], phrase: list[str]) -> range:
    first = next(i for i in range(len(words)) if words[i : i + len(phrase)] == phrase)
    return range(first, first + len(phrase))


def postings(spark: SparkSession) -> DataFrame:
    """w, template, offset, label, n (indexed words), key (the word belongs to the key phrase), n_key: the templates' indexed words."""
    rows = []
    for k, (label, text, phrase) in enumerate(TEMPLATES):
        words = text.split()
        keys = set(_key_offsets(words, phrase.split()))
        known = [i for i, w in enumerate(words) if w not in COMMON]
        rows += [(words[i], k, i, label, len(known), i in keys, len(keys & set(known))) for i in known]
    return spark.createDataFrame(rows, "w string, template int, offset int, label string, n int, key boolean, n_key int")


def licence_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row (a number of its own), doc_id, n_words, hits (licence words with positions, in order)."""
    text = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    words = F.filter(F.split(text, _BREAK), lambda w: w != "")
    cut = docs.select(F.col(id_col).alias("doc_id"), words.alias("words"))
    known = F.filter(
        F.transform("words", lambda w, i: F.struct(w.alias("w"), i.cast("int").alias("pos"))), lambda x: x["w"].isin(VOCABULARY)
    )
    return cut.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.size("words").cast("long").alias("n_words"), known.alias("hits"))


def _places(phrase: str):
    """Start positions of a phrase among the hits: its words at consecutive positions."""
    words = phrase.split()
    here = lambda h, i: F.reduce(
        F.array(*[
            (F.get("hits", i + k)["w"] == w) & (F.get("hits", i + k)["pos"] == h["pos"] + k) for k, w in enumerate(words)
        ]), F.lit(True), lambda a, b: a & F.coalesce(b, F.lit(False)),
    )
    return F.transform(F.filter(F.transform("hits", lambda h, i: F.struct(h["pos"].alias("pos"), here(h, i).alias("ok"))), lambda x: x["ok"]), lambda x: x["pos"])


def template_matches(found: DataFrame) -> DataFrame:
    """row, label, score: verified places of templates in the files of ``licence_words`` (as a written table)."""
    spark = found.sparkSession
    index = F.broadcast(postings(spark))  # as many rows as the templates have words
    files = found.where(F.size("hits") > 1)
    n_docs = found.count()
    seen = found.select(F.explode(F.array_distinct(F.transform("hits", lambda h: h["w"]))).alias("w"))
    idf = seen.groupBy("w").agg(F.log((n_docs + 1) / (F.count(F.lit(1)) + 1)).alias("idf"))
    words = files.select("row", F.explode("hits").alias("h")).select("row", "h.w", "h.pos")
    # The vocabulary bounds the frequencies' rows, the templates those of the words looked up.
    rare = postings(spark).where("key").join(F.broadcast(idf), "w", "left").withColumn("idf", F.coalesce("idf", F.log(F.lit(n_docs + 1.0))))
    rare = rare.withColumn("rank", F.row_number().over(Window.partitionBy("template").orderBy(F.desc("idf"), "w", "offset"))).where(F.col("rank") <= RAREST)
    looked = words.join(F.broadcast(rare.select("w", "template", "offset", "n_key")), "w")
    places = looked.groupBy("row", "template", (F.col("pos") - F.col("offset")).alias("start")).agg(F.count(F.lit(1)).alias("votes"), F.first("n_key").alias("n_key"))
    places = places.where(F.col("votes") >= F.least(F.lit(RAREST), "n_key")).select("row", "template", "start")
    # Verified with all licence words of the file, rare or not.
    at = words.join(index, "w").withColumn("start", F.col("pos") - F.col("offset")).join(places, ["row", "template", "start"])
    checked = at.groupBy("row", "template", "start").agg(
        F.first("label").alias("label"), F.count(F.lit(1)).alias("words"), F.first("n").alias("n"), F.sum(F.col("key").cast("int")).alias("keys"), F.first("n_key").alias("n_key")
    )
    checked = checked.where(F.col("words") >= F.greatest(F.lit(2), F.ceil(F.col("n") * VOTES))).withColumn("score", F.col("words") / F.col("n"))
    return checked.where("keys = n_key").select("row", "label", "score")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    found = scratch_table(licence_words(docs, id_col, text_col), "licence_words")
    by_row = template_matches(found).groupBy("row").agg(F.collect_set("label").alias("own"), F.max("score").alias("best"))
    base = found.select("row", "doc_id", "n_words", *[_places(p).alias(f"at_{k}") for k, p in enumerate(BASE)])
    starts = F.concat(*[F.col(f"at_{k}") for k in range(len(BASE))])
    labels = F.array_compact(F.array(*[F.when(F.size(f"at_{k}") > 0, F.lit(label)) for k, label in enumerate(BASE.values())]))
    base = base.select("row", "doc_id", "n_words", starts.alias("starts"), F.array_sort(F.array_distinct(labels)).alias("base"))
    own = F.coalesce("own", F.array().cast("array<string>"))
    return base.join(by_row, "row", "left").select(
        "doc_id",
        "n_words",
        F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"),
        F.array_max("starts").cast("long").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", own)), ",").alias("labels"),
        F.greatest(F.coalesce("best", F.lit(0.0)), F.when(F.size("starts") > 0, BASE_SCORE).otherwise(0.0)).alias("score"),
    )
