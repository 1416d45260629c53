"""License scans: exact set-similarity join of text blocks with license templates.

A template is a set of words; a text block contains it when at least ``percent`` of these
words are in the block. Templates are dealt to size classes 8, 16, 32, ... (the least that
holds their words); a class looks at blocks of twice as many words that begin at every
class-many words, so that whatever has a template's length lies whole in one block.

1. One pass counts in how many documents each template word occurs. Words are ranked by that
   count over the whole corpus, the rarest first.
2. A second pass joins blocks and templates. A template that needs o of its t words has its
   prefix, the t - o + 1 rarest, in an index by word; a block that contains the template has
   its first common word there (prefix filter), has o template words at all (length filter),
   and has o - 1 more words behind that first one on both sides (positional filter). What
   passes is counted exactly. Words of no template can't match and are left out of blocks.
   Where one template's words are a proper part of another's of the class, a block that
   contains both counts for the larger alone ("CC BY-NC 4.0" is not "CC BY 4.0").
3. Phrases are templates of which every word is needed; their blocks are then searched for
   places at which the words stand consecutively.

The templates are the stated query set: they are read in parts of at most ``part_bytes``,
one pass a part, with one part in a task's memory. Documents are not shuffled, so a hot
source, word or group of copies is dealt like any other rows.

Defined results: a null or empty text has no words, places or labels; templates without words
match nothing; equal templates count once a label; repeated documents get the same result
each; null ids stay null; extra columns are ignored whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .textbytes import ALNUM, Words, chunks, lean, ranges, words

PERCENT = 90
PART_BYTES = 4 << 20
CLASS = 8

# Phrases with their labels, and sentences of public licenses.
PHRASES = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]
TEMPLATES = [
    ("agpl", "GNU Affero General Public License as published by the Free Software Foundation"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("bsd", "Licensed under the BSD 3-Clause License"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
]

FOUND = "array<struct<label:string,base:boolean,word:bigint,span:bigint,share:double>>"


def template_table(spark: SparkSession) -> DataFrame:
    """(label, text, base): the phrases and license sentences above."""
    return spark.createDataFrame([(*p, True) for p in PHRASES] + [(*t, False) for t in TEMPLATES], "label string, text string, base boolean")


class Template:
    def __init__(self, label: str, base: bool, sequence: np.ndarray, percent: int):
        self.label, self.base, self.sequence = label, base, sequence  # vocabulary numbers, in order
        self.size = len(np.unique(sequence))
        self.need = self.size if base else max(1, -(-self.size * percent // 100))
        self.width = CLASS
        while self.width < len(sequence):
            self.width *= 2


class Part:
    """Some templates, their vocabulary, and (after :meth:`rank`) the prefix index."""

    def __init__(self, rows: Sequence[tuple], percent: int):
        told = sorted({(r[0] or "", bool(r[2]), r[1] or "") for r in rows})
        w = words(pa.array([t for *_, t in told], pa.large_string()), ALNUM)
        hashes = w.hashes()
        self.hash, at, number = np.unique(hashes, return_index=True, return_inverse=True)
        self.length = (w.end - w.start)[at]
        wide = int(self.length.max()) if len(at) else 0
        self.bytes = np.zeros((len(at), wide), np.uint8)
        for v, i in enumerate(at):
            self.bytes[v, :self.length[v]] = np.frombuffer(w.text(i), np.uint8)
        seqs = np.split(number.ravel(), w.offsets[1:-1]) if len(told) else []
        self.templates = [Template(label, base, s, percent) for (label, base, _), s in zip(told, seqs) if len(s)]
        self.place = np.arange(len(at))  # vocabulary number -> rank

    def numbers(self, w: Words) -> np.ndarray:
        """Vocabulary number of every word, -1 for words of no template; told by the words' bytes."""
        out = np.full(len(w.start), -1, np.int64)
        if not len(self.hash) or not len(out):
            return out
        hashes = w.hashes()
        at = np.minimum(np.searchsorted(self.hash, hashes), len(self.hash) - 1)
        i = np.flatnonzero((self.hash[at] == hashes) & (self.length[at] == w.end - w.start))
        for b in range(self.bytes.shape[1]):
            live = self.length[at[i]] > b
            same = np.ones(len(i), bool)
            same[live] = w.data[w.start[i[live]] + b] == self.bytes[at[i[live]], b]
            i = i[same]
        out[i] = at[i]
        return out

    def rank(self, documents: dict[int, int]) -> Part:
        """Order the words by the documents that have them and index the templates' prefixes."""
        order = np.lexsort((self.hash, [documents.get(v, 0) for v in range(len(self.hash))]))
        self.place[order] = np.arange(len(order))
        self.classes = {}
        for width in sorted({t.width for t in self.templates}):
            group = [t for t in self.templates if t.width == width]
            has = np.zeros((len(group), len(order)), bool)
            posting = []
            for k, t in enumerate(group):
                ranks = np.unique(self.place[t.sequence])
                has[k, ranks] = True
                posting += [(r, k, i) for i, r in enumerate(ranks[:t.size - t.need + 1])]
            posting = np.array(sorted(posting), np.int64).reshape(-1, 3)
            begin = np.searchsorted(posting[:, 0], np.arange(len(order) + 1))
            above = {k: [j for j, u in enumerate(group) if not u.base and u.size > t.size and (has[j] >= has[k]).all()]
                     for k, t in enumerate(group) if not t.base}
            self.classes[width] = group, has, posting, begin, above
        return self


def parts_of(templates: DataFrame, percent: int, part_bytes: int) -> Iterator[Part]:
    """The templates in parts: dealt by hash so that each part is expected to hold half of
    ``part_bytes``; one found larger is cut."""
    t = templates.select("label", F.coalesce("text", F.lit("")).alias("text"), "base")
    total = t.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    k = -(-2 * total // part_bytes) if total > part_bytes else 1
    t = t.withColumn("_b", F.pmod(F.xxhash64("label", "text"), F.lit(k)))
    for b in range(k):
        rows, size = [], 0
        for r in t.where(F.col("_b") == b).toLocalIterator():
            rows.append((r.label, r.text, r.base))
            size += len(r.text.encode())
            if size >= part_bytes:
                yield Part(rows, percent)
                rows, size = [], 0
        if rows:
            yield Part(rows, percent)


# --- join of a chunk of documents --------------------------------------------------------

def candidates(block: np.ndarray, rank: np.ndarray, group: Sequence[Template], posting: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """(block, template) rows that pass the prefix, length and positional filters.

    ``block`` ascends, ``rank`` ascends within a block, both without repeats."""
    need = np.array([t.need for t in group])
    size = np.array([t.size for t in group])
    first = np.searchsorted(block, block)
    behind = np.searchsorted(block, block, side="right") - np.arange(len(block))  # words of the block from here on
    many = begin[rank + 1] - begin[rank]
    at = np.repeat(np.arange(len(block)), many)
    hit = posting[ranges(begin[rank], many)]
    t, i = hit[:, 1], hit[:, 2]
    long_enough = (behind + np.arange(len(block)) - first)[at] >= need[t]
    at, t, i = at[long_enough], t[long_enough], i[long_enough]
    pair = block[at] * len(group) + t
    _, lead = np.unique(pair, return_index=True)  # the first common word; later ones tell nothing new
    at, t, i = at[lead], t[lead], i[lead]
    ok = np.minimum(size[t] - i, behind[at]) >= need[t]
    return np.stack([block[at[ok]], t[ok]], axis=1)


def overlaps(pairs: np.ndarray, block: np.ndarray, rank: np.ndarray, has: np.ndarray) -> np.ndarray:
    """Words that block and template of every pair have in common."""
    lo, hi = np.searchsorted(block, pairs[:, 0]), np.searchsorted(block, pairs[:, 0], side="right")
    of = np.repeat(np.arange(len(pairs)), hi - lo)
    common = has[pairs[of, 1], rank[ranges(lo, hi - lo)]]
    return np.bincount(of[common], minlength=len(pairs))


def join(w: Words, part: Part) -> Iterator[tuple]:
    """(document of the chunk, label, base, word, span, share) of every match, by class."""
    number = part.numbers(w)
    n = np.diff(w.offsets)
    known = np.flatnonzero(number >= 0)
    doc = np.searchsorted(w.offsets, known, side="right") - 1
    pos, rank = known - w.offsets[doc], part.place[number[known]]
    vocabulary = len(part.hash)
    for width, (group, has, posting, begin, above) in part.classes.items():
        base = np.r_[0, np.cumsum(-(-n // width))]  # blocks of the documents before
        own = base[doc] + pos // width
        before = pos >= width
        key = np.unique(np.r_[own, own[before] - 1] * vocabulary + np.r_[rank, rank[before]])
        block, r = key // vocabulary, key % vocabulary
        pairs = candidates(block, r, group, posting, begin)
        if not len(pairs):
            continue
        common = overlaps(pairs, block, r, has)
        need = np.array([t.need for t in group])
        enough = common >= need[pairs[:, 1]]
        pairs, common = pairs[enough], common[enough]
        for k, t in enumerate(group):
            mine = pairs[:, 1] == k
            b = pairs[mine, 0]
            if t.base:
                # the places that begin in a block's first half: each is in one block
                start = known[(number[known] == t.sequence[0]) & np.isin(own, b)]
                d = np.searchsorted(w.offsets, start, side="right") - 1
                ok = start + len(t.sequence) <= w.offsets[d + 1]
                start, d = start[ok], d[ok]
                for i, v in enumerate(t.sequence):
                    same = number[start + i] == v
                    start, d = start[same], d[same]
                for x, s in zip(d.tolist(), start.tolist()):
                    yield x, t.label, True, s - int(w.offsets[x]), len(t.sequence), 1.0
            else:
                alone = ~np.isin(b, pairs[np.isin(pairs[:, 1], above[k]), 0])
                b = b[alone]
                d = np.searchsorted(base, b, side="right") - 1
                word = (b - base[d]) * width
                span = np.minimum(2 * width, n[d] - word)
                for row in zip(d.tolist(), word.tolist(), span.tolist(), (common[mine][alone] / t.size).tolist()):
                    yield row[0], t.label, False, row[1], row[2], row[3]


# --- operators ---------------------------------------------------------------------------

def word_documents(docs: DataFrame, part: Part, text_col: str = "text") -> dict[int, int]:
    """Documents that have each word of the part; a task hands on one row a word, and the driver
    gets as many rows as the part has words (``part_bytes`` bound them)."""
    held = docs.sparkSession.sparkContext.broadcast(part)

    def count(batches):
        p = held.value
        total = np.zeros(len(p.hash), np.int64)
        for batch in batches:
            for rows in chunks(batch, "text"):
                w = words(rows.column(0), ALNUM)
                number = p.numbers(w)
                known = np.flatnonzero(number >= 0)
                doc = np.searchsorted(w.offsets, known, side="right") - 1
                total += np.bincount(np.unique(doc * len(total) + number[known]) % max(len(total), 1), minlength=len(total))
        v = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(v), pa.array(total[v])], names=["v", "n"])

    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(lean(count), "v long, n long")
    return {r.v: r.n for r in counted.groupBy("v").agg(F.sum("n").alias("n")).collect()}


def find(docs: DataFrame, templates: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
         part_bytes: int = PART_BYTES) -> DataFrame:
    """One row a document: ``id_col``, ``n_words`` and ``found``, its matches: ``label``, ``base``
    (a place of a phrase), first ``word`` and ``span`` of the place or block, and ``share``, the
    part of the template's words that the block contains."""
    spark = docs.sparkSession
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.lit(0).cast("long").alias("n_words"),
                      F.array().cast(FOUND).alias("found"))
    kind = out.schema["id"].dataType.simpleString()
    struct = pa.struct([("label", pa.string()), ("base", pa.bool_()), ("word", pa.int64()), ("span", pa.int64()), ("share", pa.float64())])
    parts = list(parts_of(templates, percent, part_bytes)) or [Part([], percent)]
    for part in parts:
        held = spark.sparkContext.broadcast(part.rank(word_documents(docs, part, text_col)))

        def run(batches, held=held):
            for batch in batches:
                for rows in chunks(batch, "text"):
                    w = words(rows.column(1), ALNUM)
                    told = rows.column(3).to_pylist()
                    for d, label, base, word, span, share in join(w, held.value):
                        told[d].append({"label": label, "base": base, "word": word, "span": span, "share": share})
                    yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(np.diff(w.offsets).astype(np.int64)),
                                                      pa.array(told, pa.list_(struct))], names=["id", "text", "n_words", "found"])

        out = out.mapInArrow(lean(run), f"id {kind}, text string, n_words long, found {FOUND}")
    return out.select(F.col("id").alias(id_col), "n_words", "found")


def scan(docs: DataFrame, templates: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row a document: ``id_col, n_words``; of the phrases' places ``n_base``, ``first_word``,
    ``last_word`` and ``base_labels``; ``labels`` (of places and blocks) and ``score``, the largest
    share (0 without a match)."""
    places = F.filter("found", lambda x: x["base"])
    names = lambda c: F.array_join(F.array_sort(F.array_distinct(F.transform(c, lambda x: x["label"]))), ",")
    start = F.transform(places, lambda x: x["word"])
    return find(docs, templates, id_col, text_col, **options).select(
        id_col, "n_words", F.size(places).cast("long").alias("n_base"), F.array_min(start).alias("first_word"),
        F.array_max(start).alias("last_word"), names(places).alias("base_labels"), names(F.col("found")).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda x: x["share"])), F.lit(0.0)).alias("score"))
