"""Licence scan: an exact set-similarity join of text blocks with licence templates.

A block is a line of a text; a line of over ``BLOCK`` words gives overlapping blocks, so that
every run of ``BLOCK // 2`` words lies whole in one.  With ``wrapped``, the words of the whole text
give such overlapping blocks too, so a notice that is wrapped over lines is met like one on a line.
A block meets a template if it holds at least ``THRESHOLD`` of the template's distinct words.  The
join finds all such pairs:

* words of no template can't add to an overlap, so a block is the set of its template words;
* words are ordered by frequency over all blocks, rare first;
* length filter: a block needs as many words as the template asks for, c = ceil(threshold * |T|);
* prefix filter: it must share one of the first |T| - c + 1 words of the template and one of its
  own first |B| - c + 1 words;
* positional filter: from that word on, both must still hold c words;
* what is left is verified by the whole intersection.

Beside it stand the base labels: places where the words of a fixed phrase stand one after another.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_of, written

#: Words that stand consecutively, and their label.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"),
           ("cc by nc", "cc-by-nc"))
#: Licence notices in their usual wording, and their label.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by", "licensed under cc by 4 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("all-rights-reserved", "all rights reserved"),
)
THRESHOLD = 0.9
BLOCK = 64
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def wide(phrase: str) -> str:
    """A phrase as it stands in a text whose words have a space on either side."""
    return " " + phrase.replace(" ", "  ") + " "


def count_of(text: Column, phrase: str) -> Column:
    left = F.octet_length(text) - F.octet_length(F.replace(text, F.lit(wide(phrase)), F.lit("")))
    return (left / len(wide(phrase).encode())).cast("bigint")


def words_in(text: Column) -> Column:
    """Words of a text whose words have a space on either side."""
    return ((F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))) / 2).cast("bigint")


def license_scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD,
                 block: int = BLOCK, wrapped: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored): doc_id, n_words,
    n_base, first_word, last_word, base_labels, labels, score, matches (label, containment of
    each template met).  ``labels`` are the base labels and those of the templates met; ``score``
    is 1 where there is a base label, else the greatest containment, else 0.  ``wrapped`` adds the
    blocks that cross line ends.

    Null or empty text: no words, no labels, score 0.  Repeated rows and ids stay rows of their
    own.  Empty table: empty result."""
    wanted = [(label, sorted(set(re.split(r"\s+", t.strip())))) for label, t in templates]
    need = [math.ceil(threshold * len(t) - 1e-9) for _, t in wanted]
    vocabulary = sorted({w for _, t in wanted for w in t})

    def cut(line: Column) -> Column:
        words = F.split(line, "  ")
        n = F.size(words)
        starts = F.when(n > block, F.sequence(F.lit(0), n - block // 2 - 1, F.lit(block // 2))).otherwise(
            F.array(F.lit(0)))
        return F.transform(starts, lambda i: F.array_distinct(
            F.filter(F.slice(words, i + 1, block), lambda w: w.isin(vocabulary))))

    lines = F.filter(F.transform(F.split(F.lower(text_of()), "\n", -1),
                                 lambda x: F.trim(F.regexp_replace(x, GAPS, "  "))), lambda x: x != "")
    cuts = F.flatten(F.transform("lines", cut))
    if wrapped:  # where there is one line, its blocks are those of the text
        cuts = F.when(F.size("lines") > 1, F.concat(cuts, cut(F.trim("whole")))).otherwise(cuts)
    t = (docs.select("doc_id", lines.alias("lines"))
         .withColumn("whole", F.when(F.size("lines") == 0, "").otherwise(
             F.concat(F.lit(" "), F.array_join("lines", "  "), F.lit(" "))))
         .select("doc_id", "whole", words_in(F.col("whole")).alias("n_words"),
                 F.filter(cuts, lambda b: F.size(b) >= min(need)).alias("blocks"),
                 *[count_of(F.col("whole"), p).alias(f"n{i}") for i, (p, _) in enumerate(PHRASES)]))
    first, last, labels = [], [], []
    for i, (p, label) in enumerate(PHRASES):
        there, whole = F.col(f"n{i}") > 0, F.col("whole")
        first.append(F.when(there, words_in(F.substring_index(whole, wide(p), 1))))
        last.append(F.when(there, F.col("n_words") - len(p.split())
                           - words_in(F.substring_index(whole, wide(p), -1))))
        labels.append(F.when(there, label))
    least = lambda cs: F.array_min(F.array(*cs))
    t = written(t.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "n_words", "blocks",
        sum((F.col(f"n{i}") for i in range(len(PHRASES))), F.lit(0).cast("bigint")).alias("n_base"),
        least(first).alias("first_word"), F.array_max(F.array(*last)).alias("last_word"),
        F.array_compact(F.array(*labels)).alias("base")), "license-blocks")

    # frequencies of template words over all blocks: at most len(vocabulary) rows
    seen = {r["w"]: r["n"] for r in t.select(F.explode("blocks").alias("b")).select(
        F.explode("b").alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()}
    rank = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (seen.get(w, 0), w)))}
    ranks = F.create_map(*[F.lit(x) for w in vocabulary for x in (w, rank[w])])
    blocks = (t.select("row", F.explode("blocks").alias("b"))
              .select("row", F.array_sort(F.transform("b", lambda w: ranks[w])).alias("b"))
              .select("row", "b", F.size("b").alias("nb")))
    ordered = [sorted(rank[w] for w in words) for _, words in wanted]
    index = [(label, words, c, i, words[i]) for (label, _), words, c in zip(wanted, ordered, need)
             for i in range(len(words) - c + 1)]
    # one row per prefix word of a template: its size is that of the templates given, not of the data
    index = F.broadcast(docs.sparkSession.createDataFrame(
        index, "label string, t array<int>, need int, i int, token int"))
    matched = (blocks.select("row", "b", "nb", F.posexplode(F.slice("b", F.lit(1), F.col("nb") - min(need) + 1))
                             .alias("j", "token"))
               .join(index, "token")
               .filter((F.col("nb") >= F.col("need")) & (F.col("j") <= F.col("nb") - F.col("need"))
                       & (F.least(F.size("t") - F.col("i"), F.col("nb") - F.col("j")) >= F.col("need")))
               .withColumn("common", F.size(F.array_intersect("b", "t"))).filter("common >= need")
               .groupBy("row").agg(F.collect_set(F.struct("label", (F.col("common") / F.size("t")).alias("containment")))
                                   .alias("matches")))
    matched = matched.withColumnRenamed("row", "of")
    out = t.join(matched, F.col("row") == F.col("of"), "left")
    met = F.coalesce(F.col("matches.label"), F.array().cast("array<string>"))
    return out.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("base", met))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce(F.array_max("matches.containment"), F.lit(0.0)))
        .alias("score"), "matches")
