"""License scan by diagonal voting over word k-grams.

Words of every whole text get two independent 64-bit hashes, computed over the
bytes of a batch at once. All rolling k-grams of a text are joined by Spark
with the positions of the templates' k-grams (phrases: pairs; longer texts:
five words). A hit at word w of a text and position p of a template votes for
the diagonal w - p, on which the template would begin.

* A phrase occurs at a place if all its grams vote for one diagonal.
* A license text may have words put in, left out or changed: the votes of
  neighbouring diagonals, up to ``slack`` words apart, are merged, and the span is
  verified by the share of the template's words that their grams cover.

A hit counts only if also the second hash agrees (128 bits in all), so texts are
read once and never shuffled; what is shuffled are hits, never grams. Rows are
told apart by a number of their own, so copies, null or repeated ids and a
line that many texts share do not meet in one task.

Defined results: a null text is empty and has no words; a null id is kept;
repeated rows are judged each; a template without words never matches; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import id_text, runs, stored, text_batches
from tidemark.llm.hashing import BASES, RunHasher, mixed

TEXT_GRAM, PHRASE_GRAM = 5, 2
SLACK = 8
LEAST_SHARE = 0.8
BATCH_BYTES = 1 << 20
LIST_GRAMS = 1 << 15        # grams of a text in one row
BROADCAST_GRAMS = 1 << 19   # template positions that a broadcast may hold

# Notices and texts of licenses, word for word.
LICENSES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
            "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
            "the above copyright notice and this permission notice appear in all copies."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
            "the Free Software Foundation"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]

# bytes of words: digits, letters (A-Z lowered) and all bytes of characters beyond ASCII; 0 elsewhere
_LOWER = np.zeros(256, np.uint8)
_LOWER[48:58], _LOWER[97:123], _LOWER[128:] = np.arange(48, 58), np.arange(97, 123), np.arange(128, 256)
_LOWER[65:91] = np.arange(97, 123)


class Hasher(RunHasher):
    """Hashes of all words of a batch of texts, from the bytes."""

    def words(self, data: np.ndarray, at: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Two hashes of every word of texts ``data[at[i]:at[i+1]]``, and the words' offsets by text."""
        low = _LOWER[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[at] = True                                    # words end with their text
        inside = low > 0
        start = inside.copy()
        start[1:] &= ~inside[:-1] | edge[1:-1]
        end = inside.copy()
        end[:-1] &= ~inside[1:] | edge[1:-1]
        starts = np.flatnonzero(start)
        return self.hashes(low, starts, np.flatnonzero(end) + 1, BATCH_BYTES), np.searchsorted(starts, at)

    def grams(self, words: list[np.ndarray], k: int) -> list[np.ndarray]:
        """Two hashes of the k words from each word on (rolling over all texts: the caller leaves out those that cross an end)."""
        n = max(0, len(words[0]) - k + 1)
        out = []
        for family, base in zip(words, BASES):
            total = np.full(n, np.uint64(k))
            for j in range(k):
                total = total * np.uint64(base) + family[j:j + n]
            out.append(mixed(total).view(np.int64))
        return out


def text_words(hasher: Hasher, text: str) -> list[np.ndarray]:
    data = np.frombuffer(text.encode(), np.uint8)
    return hasher.words(data, np.array([0, len(data)]))[0]


@dataclass(frozen=True)
class Templates:
    """Phrases (whole, in order) and license texts (by share) with their labels."""
    phrases: tuple[tuple[str, str], ...]
    texts: tuple[tuple[str, str], ...]

    def positions(self, spark: SparkSession) -> tuple[DataFrame, DataFrame, int]:
        """(gram, check, template, position), (template, label, n_words, n_grams, gram_words, phrase) and the number of positions."""
        hasher, grams, facts = Hasher(), [], []
        for phrase, pairs, most in ((True, self.phrases, PHRASE_GRAM), (False, self.texts, TEXT_GRAM)):
            for text, label in pairs:
                words = text_words(hasher, text)
                k = min(most, len(words[0]))
                if not k:
                    continue
                if k < most:
                    raise ValueError(f"a {'phrase' if phrase else 'license text'} needs {most} words or more: {text!r}")
                gram, check = hasher.grams(words, k)
                grams += [(int(g), int(c), len(facts), p) for p, (g, c) in enumerate(zip(gram, check))]
                facts.append((len(facts), label, len(words[0]), len(gram), k, phrase))
        return (spark.createDataFrame(grams, "gram long, check long, template int, position int"),
                spark.createDataFrame(facts, "template int, label string, n_words int, n_grams int, gram_words int, phrase boolean"), len(grams))


ROLLED = "row long, doc_id long, n_words long, first long, grams array<long>, checks array<long>"


def rolling_grams(docs: DataFrame, sizes: tuple[int, ...] = (PHRASE_GRAM, TEXT_GRAM)) -> DataFrame:
    """One row with ``n_words`` and no grams for each row of ``docs`` (doc_id, text),
    and all its k-grams, both hashes, in lists that start at word ``first``."""
    def roll(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, row = Hasher(), TaskContext.get().partitionId() << 40
        for batch in text_batches(batches, BATCH_BYTES):
            text = batch["text"].cast(pa.large_string())
            at = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
            data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[at[0]:at[-1]]
            words, words_at = hasher.words(data, at - at[0])
            rows = row + np.arange(len(text))
            row += len(text)
            n = np.diff(words_at)
            none = pa.array(np.zeros(len(text) + 1, np.int32))
            empty = pa.ListArray.from_arrays(none, pa.array([], pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(rows), batch["doc_id"], pa.array(n), pa.array(np.zeros(len(text), np.int64)), empty, empty], _names(ROLLED))
            ends = np.repeat(words_at[1:], n)
            for k in sizes:
                gram, check = hasher.grams(words, k)
                whole = np.arange(len(gram)) + k <= ends[:len(gram)]
                lists = np.maximum(n - k + 1, 0)
                pieces = -(-lists // LIST_GRAMS)
                owner = np.repeat(np.arange(len(lists)), pieces)
                nth = np.arange(len(owner)) - np.repeat(runs(pieces)[:-1], pieces)
                size = np.minimum(LIST_GRAMS, lists[owner] - nth * LIST_GRAMS)
                offsets = pa.array(runs(size).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[owner]), batch["doc_id"].take(pa.array(owner)), pa.nulls(len(owner), pa.int64()), pa.array(nth * LIST_GRAMS),
                     *(pa.ListArray.from_arrays(offsets, pa.array(x[whole])) for x in (gram, check))], _names(ROLLED))

    return id_text(docs).mapInArrow(roll, ROLLED)


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def hits(docs: DataFrame, positions: DataFrame, n_positions: int) -> DataFrame:
    """(row, doc_id, n_words, template, word, position): a row for each gram of a
    text that is at a template's position, and one with ``n_words`` for each text.
    Template positions are broadcast while there are ``BROADCAST_GRAMS`` at most;
    more are joined by a shuffle of the grams."""
    grams = rolling_grams(docs).select("row", "doc_id", "n_words", "first", "checks", F.posexplode_outer("grams").alias("nth", "own"))
    known = F.broadcast(positions) if n_positions <= BROADCAST_GRAMS else positions
    met = grams.join(known, F.col("own") == F.col("gram"), "left").where(
        F.col("n_words").isNotNull() | (F.col("template").isNotNull() & (F.get("checks", F.col("nth")) == F.col("check"))))
    return stored(met.select("row", "doc_id", "n_words", "template", (F.col("first") + F.col("nth")).alias("word"), "position"), "op13-hits", "snappy")


def spans(found: DataFrame, facts: DataFrame, slack: int = SLACK) -> DataFrame:
    """(row, template, label, phrase, start, share): places of phrases (share 1), and
    for license texts each diagonal that has votes, with the share of the
    template's words covered by the grams on it and on its neighbours."""
    votes = (found.where("template is not null").groupBy("row", "template", (F.col("word") - F.col("position")).alias("start"))
             .agg(F.collect_set("position").alias("positions"))          # at most the template's grams
             .join(F.broadcast(facts), "template"))
    places = votes.where("phrase and size(positions) = n_grams").select("row", "template", "label", "phrase", "start", F.lit(1.0).alias("share"))
    near = Window.partitionBy("row", "template").orderBy("start").rangeBetween(-slack, slack)     # diagonals of one text
    merged = F.array_distinct(F.flatten(F.collect_list("positions").over(near)))
    covered = F.array_distinct(F.flatten(F.transform("merged", lambda p: F.sequence(p, p + F.col("gram_words") - 1))))
    texts = (votes.where("not phrase").withColumn("merged", merged)
             .select("row", "template", "label", "phrase", "start", (F.size(covered) / F.col("n_words")).alias("share")))
    return places.unionByName(texts)


def _labels(column: Column) -> Column:
    return F.array_join(F.array_sort(F.collect_set(column)), ",")


def scan(docs: DataFrame, phrases: list[tuple[str, str]], texts: list[tuple[str, str]] | None = None, slack: int = SLACK, least_share: float = LEAST_SHARE) -> DataFrame:
    """A row for each row of ``docs`` (doc_id, text): doc_id, n_words, n_base (places
    of phrases), first_word and last_word (their smallest and largest start),
    base_labels, labels (also of license texts of which ``least_share`` is there), score
    (largest share of a template, 1 for a phrase, 0 without hits).

    ``phrases`` and ``texts`` are (words, label); label lists are distinct, sorted, comma-joined.
    """
    texts = [(text, label) for label, text in LICENSES] if texts is None else texts
    positions, facts, n = Templates(tuple(phrases), tuple(texts)).positions(docs.sparkSession)
    found = hits(docs, positions, n)
    none = {c: F.lit(None).cast(t) for c, t in (("label", "string"), ("phrase", "boolean"), ("start", "long"), ("share", "double"))}
    rows = found.where("n_words is not null").select("row", "doc_id", "n_words", *[v.alias(c) for c, v in none.items()])
    judged = spans(found, facts, slack).select("row", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("n_words"), *none)
    base, accepted = F.col("phrase"), F.col("phrase") | (F.col("share") >= least_share)
    return (rows.unionByName(judged).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("start"))).alias("first_word"), F.max(F.when(base, F.col("start"))).alias("last_word"),
        _labels(F.when(base, F.col("label"))).alias("base_labels"), _labels(F.when(accepted, F.col("label"))).alias("labels"),
        F.coalesce(F.max("share"), F.lit(0.0)).alias("score")).drop("row"))
