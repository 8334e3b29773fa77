"""License scans: an exact set-similarity join of text blocks with license templates.

Method. A template is a set of words, a block a stretch of BLOCK words of a text that begins at a multiple of STEP, taken as a set, too. A pair is found if the block
contains at least THRESHOLD of the template's words. Words of templates are put in one global order, the rarest among all documents first. If a block contains enough of a
template, it holds one of the template's rarest words, as many as may be missing and one more (prefix filter); it holds as many words of templates as the least
template needs (length filter); and after the first common word, enough words are left in both (positional filter). Blocks that hold no prefix word never leave the
task that reads the text; the others are joined with the templates' prefixes by word, and each pair that passes is verified by the exact intersection, once, at its first common word.

A pair gives its template's label if the block holds the words that tell the template from others alike (its marks: "affero" in a notice that shares all other words with
another license's), and if no pair of the same block holds a template with all of this one's words and more (a ShareAlike notice is no plain Attribution notice).

Besides this, places are counted where the words of a phrase of PHRASES stand consecutively; these give the base labels. Words: the text with A-Z lower-cased, cut at ASCII
characters other than letters and digits.

Defined results. Null, empty and blank texts have no words, no labels and score 0. A text shorter than a block is one block. score is the largest containment
of the pairs that give a label, 1 with a base label, else 0. Rows are numbered when they are saved, so repeated rows and rows without a doc_id each get their
own result; no documents give no rows. Only doc_id and text are read. A text of megabytes is one row to read, and its blocks are rows of their own. Templates are bounded (MAX_TEMPLATE_WORDS in all),
which is checked, and therefore broadcast; the blocks aren't.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm.shared import saved, shared_value, small_batches

BLOCK, STEP = 64, 32
THRESHOLD = 0.8
MAX_TEMPLATE_WORDS = 100_000
#: Phrases and the labels that they give.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Fixed values: (label, words of a notice, as the licenses' owners ask for them to be put, and its marks).
TEMPLATES: list[tuple[str, ...]] = [
    ("mit", "released under the mit license", "mit"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("apache", "licensed under the apache license version 2 0", "apache"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl", "licensed under the gnu general public license version 3", "gnu general"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gnu general"),
    ("lgpl", "licensed under the gnu lesser general public license", "lesser"),
    ("agpl", "licensed under the gnu affero general public license", "affero"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "released under the 3 clause bsd license", "bsd"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "fee"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered"),
    ("cc0", "dedicated to the public domain under the cc0 1 0 universal dedication", "cc0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license", "sharealike"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc nc"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license", "noncommercial"),
]
_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: bytes | None) -> list[bytes]:
    return _WORDS.findall(text.lower()) if text else []  # bytes.lower changes A-Z only


def needed(template_words: int, threshold: float) -> int:
    """How many of a template's words a block must hold; nudged, as 0.8 * 5 may come out above 4."""
    return max(1, math.ceil(threshold * template_words - 1e-9))


class Template(NamedTuple):
    label: str
    words: list[bytes]
    marks: list[bytes]


def template_sets(templates: list[tuple[str, ...]]) -> list[Template]:
    """Label, distinct words and marks of each template that has any words; a template is (label, notice) or (label, notice, marks)."""
    sets = [Template(label, sorted(set(words_of(notice.encode()))), sorted(set(words_of(" ".join(marks).encode())))) for label, notice, *marks in templates]
    if sum(len(t.words) for t in sets) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates of more than {MAX_TEMPLATE_WORDS} words")
    if any(len(t.words) > STEP for t in sets):
        raise ValueError(f"a template of more than {STEP} distinct words; cut it into sections, so that a block can hold each")
    if any(set(t.marks) - set(t.words) for t in sets):
        raise ValueError("a mark that is no word of its template")
    return [t for t in sets if t.words]


def wider(sets: list[Template]) -> list[list[int]]:
    """For each template, the numbers of those that hold all its words and more."""
    holding: dict[bytes, set[int]] = defaultdict(set)
    for k, t in enumerate(sets):
        for w in t.words:
            holding[w].add(k)
    return [sorted(k for k in set.intersection(*(holding[w] for w in t.words)) if len(sets[k].words) > len(t.words)) for t in sets]


def _utf8(text: Column | str) -> Column:
    return F.encode((F.col(text) if isinstance(text, str) else text).cast("string"), "UTF-8")


def word_order(docs: DataFrame, sets: list[Template]) -> list[bytes]:
    """The templates' words, those in the fewest documents first, then by their bytes."""
    vocabulary = {w for t in sets for w in t.words}

    @F.pandas_udf("array<binary>")
    def held(texts: pd.Series) -> pd.Series:
        return pd.Series([list(vocabulary.intersection(words_of(t))) for t in texts])

    counted = docs.select(F.explode(held(_utf8("text"))).alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()  # one row a template word at most
    n = {bytes(r["w"]): r["n"] for r in counted}
    return sorted(vocabulary, key=lambda w: (n.get(w, 0), w))


def prefix_index(spark: SparkSession, sets: list[Template], rank: dict[bytes, int], threshold: float) -> DataFrame:
    """word (its rank), place in the template, template, label, ranks of all its words and of its marks, wider templates, need: a row for each word of each template's prefix."""
    rows = []
    for t, (template, others) in enumerate(zip(sets, wider(sets), strict=True)):
        ranks, need = sorted(rank[w] for w in template.words), needed(len(template.words), threshold)
        rows += [(ranks[p], p, t, template.label, ranks, [rank[w] for w in template.marks], others, need) for p in range(len(ranks) - need + 1)]
    return spark.createDataFrame(rows, "word int, place int, template int, label string, ranks array<int>, marks array<int>, wider array<int>, need int")


def _phrase_places(words: list[bytes], phrases: list[list[bytes]]) -> list[tuple[int, int]]:
    """(start, phrase) of each place where a phrase stands; looked for at its last words only."""
    if not any(p[-1] in words for p in phrases):
        return []
    found = []
    for k, phrase in enumerate(phrases):
        at = -1
        try:
            while True:
                at = words.index(phrase[-1], at + 1)
                start = at - len(phrase) + 1
                if start >= 0 and words[start : at + 1] == phrase:
                    found.append((start, k))
        except ValueError:
            pass
    return found


def _blocks(words: list[bytes], rank: dict[bytes, int], prefixes: set[int], least: int) -> list[dict]:
    """The blocks with a prefix word and at least `least` words of templates: number, and ranks in the global order."""
    known = [(i, rank[w]) for i, w in enumerate(words) if w in rank]
    last = max(0, -(-(len(words) - BLOCK) // STEP))  # the first block that reaches the end is the last
    reached = {b for i, r in known if r in prefixes for b in range(max(0, (i - BLOCK) // STEP + 1), min(last, i // STEP) + 1)}
    if not reached:
        return []
    held: dict[int, set[int]] = {b: set() for b in reached}
    for i, r in known:
        for b in range(max(0, (i - BLOCK) // STEP + 1), min(last, i // STEP) + 1):
            if b in held:
                held[b].add(r)
    return [{"block": b, "held": sorted(held[b])} for b in sorted(held) if len(held[b]) >= least]


def read_texts(docs: DataFrame, sets: list[Template], rank: dict[bytes, int], threshold: float, phrases: dict[str, str]) -> DataFrame:
    """Saved rows: row, doc_id, n_words, n_base, first_word, last_word, base (labels), blocks (number, held ranks)."""
    small_batches(docs.sparkSession)
    needs = [needed(len(t.words), threshold) for t in sets]
    prefixes = {r for t, need in zip(sets, needs, strict=True) for r in sorted(rank[w] for w in t.words)[: len(t.words) - need + 1]}
    given = shared_value(docs.sparkSession, (rank, prefixes, min(needs, default=0), [words_of(p.encode()) for p in phrases], list(phrases.values())))

    @F.pandas_udf("n_words long, n_base long, first_word long, last_word long, base array<string>, blocks array<struct<block:int,held:array<int>>>")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        ranks, first, least, spoken, labels = given()
        for texts in batches:
            rows = []
            for text in texts:
                words = words_of(text)
                places = _phrase_places(words, spoken)
                starts = [s for s, _ in places]
                rows.append((len(words), len(places), min(starts, default=None), max(starts, default=None), sorted({labels[k] for _, k in places}), _blocks(words, ranks, first, least)))
            out = pd.DataFrame(rows, columns=["n_words", "n_base", "first_word", "last_word", "base", "blocks"])
            yield out.astype({"first_word": "Int64", "last_word": "Int64"})

    return saved(docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").alias("doc_id"), read(_utf8("text")).alias("t")).select("row", "doc_id", "t.*"))


def similar_blocks(read: DataFrame, index: DataFrame) -> DataFrame:
    """row, doc_id, block, template, label, wider, marked (all marks are held), containment of every block that holds enough of a template."""
    blocks = read.select("row", "doc_id", F.explode("blocks").alias("b")).select("row", "doc_id", "b.*")
    probes = blocks.select("row", "doc_id", "block", "held", F.posexplode("held").alias("at", "word"))
    left = lambda ranks, place: F.size(ranks) - F.col(place)  # noqa: E731  words from this one on
    pairs = probes.join(F.broadcast(index), "word").filter((F.size("held") >= F.col("need")) & (F.least(left("held", "at"), left("ranks", "place")) >= F.col("need")))
    verified = pairs.withColumn("common", F.array_intersect("ranks", "held")).filter((F.get("common", 0) == F.col("word")) & (F.size("common") >= F.col("need")))
    marked = F.size(F.array_except("marks", "common")) == 0
    return verified.select("row", "doc_id", "block", "template", "label", "wider", marked.alias("marked"), (F.size("common") / F.size("ranks")).alias("containment"))


def labelled(similar: DataFrame) -> DataFrame:
    """The pairs that give a label: row, doc_id, block, template, label, containment. A block has at most one pair with each template."""
    marked = similar.filter("marked").groupBy("row", "block").agg(F.collect_list(F.struct("doc_id", "template", "label", "wider", "containment")).alias("found"))
    told = marked.withColumn("all", F.transform("found", lambda f: f["template"])).withColumn("found", F.filter("found", lambda f: ~F.arrays_overlap(f["wider"], F.col("all"))))
    return told.select("row", "block", F.inline("found")).select("row", "doc_id", "block", "template", "label", "containment")


def license_blocks(docs: DataFrame, templates: list[tuple[str, ...]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per block and template that gives it a label: doc_id, first_word and last_word of the block, template (its number), label, containment."""
    read, index = _joined(docs, templates, threshold, PHRASES)
    last = F.least(F.col("block") * STEP + BLOCK, F.col("n_words")) - 1
    found = labelled(similar_blocks(read, index)).join(read.select("row", "n_words"), "row")
    return found.select("doc_id", (F.col("block") * STEP).cast("long").alias("first_word"), last.alias("last_word"), "template", "label", "containment")


def _joined(docs: DataFrame, templates: list[tuple[str, ...]], threshold: float, phrases: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    small_batches(docs.sparkSession)
    sets = template_sets(templates)
    rank = {w: k for k, w in enumerate(word_order(docs, sets))}
    return read_texts(docs, sets, rank, threshold, phrases), prefix_index(docs.sparkSession, sets, rank, threshold)


def scan(docs: DataFrame, templates: list[tuple[str, ...]] = TEMPLATES, threshold: float = THRESHOLD, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    read, index = _joined(docs, templates, threshold, phrases)
    found = labelled(similar_blocks(read, index)).groupBy("row").agg(F.collect_set("label").alias("own"), F.max("containment").alias("containment"))
    joined = read.drop("blocks").join(found, "row", "left")
    both = F.array_sort(F.array_union("base", F.coalesce("own", F.array().cast("array<string>"))))
    score = F.greatest(F.coalesce("containment", F.lit(0.0)), F.when(F.col("n_base") > 0, 1.0).otherwise(0.0))
    return joined.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"), F.array_join(both, ",").alias("labels"), score.alias("score"))
