"""License scan by diagonal voting.

Every rolling three-word hash of a document is joined to the places of that hash in license phrases. A hit votes for its
diagonal, the word of the document at which the phrase would start. Neighbouring diagonals, apart by inserted or left-out
words, are merged. Hits are verified word by word as they are found, each gram having its words with it. A phrase stands at a place where one diagonal has all of
its hashes; a phrase of which a span has three quarters gives its label too.

Only Spark functions are used. Hashes are joined to the broadcast phrases, whose number is fixed; what is grouped by
document are the hits. Null texts count as empty. Rows of the same id and text are reported alike, each once. A phrase of
fewer than three words has no hash and is refused.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import text_key
from tidemark.operators.joins import join_small_side

WIDTH = 3
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Diagonals up to so many words apart are one span; the share of a phrase's hashes that a span must have.
GAP, SHARE = 2, 0.75
#: Label, phrase, whether each of its places is counted.
PHRASES: tuple[tuple[str, str, bool], ...] = (
    ("mit", "under the mit license", True),
    ("apache-2", "apache license version 2", True),
    ("cc-by-nc", "cc by nc", True),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", False),
    ("apache-2", "licensed under the apache license version 2 0", False),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0 international", False),
    ("cc-by", "creative commons attribution 4 0 international license", False),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", False),
    ("gpl-3", "gnu general public license as published by the free software foundation either version 3", False),
    ("gpl-2", "gnu general public license as published by the free software foundation either version 2", False),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0", False),
)


def words_of(text: str = "text") -> Column:
    # only A-Z are lowered; Spark's faster function changes letters beyond ASCII too
    whole = F.coalesce(F.col(text), F.lit(""))
    lowered = F.when(F.octet_length(whole) == F.char_length(whole), F.lower(whole)).otherwise(F.translate(whole, UPPER, UPPER.lower()))
    parts = F.split(lowered, "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
    return F.array_remove(parts, "")


def rolling(rows: DataFrame, words: str, *keep: str) -> DataFrame:
    """One row for each word of an array: its place (pos), the hash (h) of it and the two after it, and these three words.

    Generated code runs from the array to the hash, and beyond it to a broadcast join; the words are not copied on the way.
    """
    after = lambda n: F.slice(words, n + 1, F.size(words))
    grams = rows.select(*keep, F.posexplode(F.arrays_zip(words, *[after(n) for n in range(1, WIDTH)])).alias("pos", "g"))
    three = [F.col("g")[words], *[F.col("g")[str(n)] for n in range(1, WIDTH)]]
    return grams.select(*keep, "pos", F.xxhash64(*three).alias("h"), *[word.alias(f"w{n}") for n, word in enumerate(three)])


def phrase_table(spark: SparkSession, phrases: Sequence[tuple[str, str, bool]]) -> DataFrame:
    """phrase (number), label, counted, phrase_words, grams."""
    short = [text for _, text, _ in phrases if len(text.split()) < WIDTH]
    if short:
        raise ValueError(f"phrases of fewer than {WIDTH} words cannot be found: {short}")
    rows = [
        F.struct(F.lit(i).alias("phrase"), F.lit(label).alias("label"), F.lit(counted).alias("counted"), F.array(*[F.lit(w) for w in text.split()]).alias("phrase_words"))
        for i, (label, text, counted) in enumerate(phrases)
    ]
    return spark.range(1).select(F.inline(F.array(*rows))).withColumn("grams", F.size("phrase_words") - (WIDTH - 1))


def _spans(docs: DataFrame, phrases: DataFrame) -> DataFrame:
    """By key, merged spans: label, the share of the phrase's hashes, and the starts where the whole of it stands."""
    places = rolling(phrases, "phrase_words", "phrase", "grams").where("pos < grams")
    places = places.select("phrase", F.col("pos").alias("at"), "h", *[F.col(f"w{n}").alias(f"v{n}") for n in range(WIDTH)])
    # the hashes of all words meet the phrases; the rare hits are verified at once
    grams = rolling(docs.select(*text_key(), words_of().alias("words")), "words", "__id", "__hash")
    same = reduce(Column.__and__, [F.col(f"w{n}") == F.col(f"v{n}") for n in range(WIDTH)])
    hits = grams.join(F.broadcast(places), "h").where(same).select("__id", "__hash", "phrase", "at", (F.col("pos") - F.col("at")).alias("diagonal"))
    votes = hits.groupBy("__id", "__hash", "phrase", "diagonal").agg(F.collect_set("at").alias("ats"))
    along = Window.partitionBy("__id", "__hash", "phrase").orderBy("diagonal")
    starts = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > GAP, F.lit(True)).cast("int")
    spans = votes.withColumn("starts", starts).withColumn("span", F.sum("starts").over(along)).join(F.broadcast(phrases.select("phrase", "label", "counted", "grams")), "phrase")
    whole = F.when(F.col("counted") & (F.size("ats") == F.col("grams")), F.col("diagonal"))
    merged = spans.groupBy("__id", "__hash", "phrase", "span", "label", "grams").agg(F.array_distinct(F.flatten(F.collect_list("ats"))).alias("ats"), F.collect_list(whole).alias("whole"))
    return merged.select("__id", "__hash", "label", (F.size("ats") / F.col("grams")).alias("share"), "whole")


def scan(docs: DataFrame, phrases: Sequence[tuple[str, str, bool]] = PHRASES) -> DataFrame:
    """One row per document: words, counted places, labels, and the best share of a phrase that a span has.

    Texts and their words stay where they are read; what is joined to the rows are spans.
    """
    spans = _spans(docs, phrase_table(docs.sparkSession, phrases))
    found = spans.groupBy("__id", "__hash").agg(F.collect_list(F.struct("label", "share", "whole")).alias("j"))
    keyed = docs.select("doc_id", *text_key(), F.size(words_of()).cast("long").alias("n_words"))
    rows = join_small_side(keyed, found, ["__id", "__hash"], "left")
    rows = rows.select("doc_id", "n_words", F.coalesce("j", F.array().cast(rows.schema["j"].dataType)).alias("j"))
    labels = lambda test: F.array_join(F.array_sort(F.array_distinct(F.transform(F.filter("j", test), lambda s: s["label"]))), ",")
    stands = lambda s: F.size(s["whole"]) > 0
    whole = F.flatten(F.transform("j", lambda s: s["whole"]))
    return rows.select(
        "doc_id", "n_words", F.size(whole).cast("long").alias("n_base"), F.array_min(whole).cast("long").alias("first_word"),
        F.array_max(whole).cast("long").alias("last_word"), labels(stands).alias("base_labels"),
        labels(lambda s: stands(s) | (s["share"] >= SHARE)).alias("labels"),
        F.coalesce(F.array_max(F.transform("j", lambda s: s["share"])), F.lit(0.0)).alias("score"),
    )
