"""License scans with a positional rare-token index.

The index holds, for every word of the templates' mandatory key phrases, its postings
(template, position).  The words' document frequencies are counted over all documents,
which makes the words' IDF.  Of each file, only its highest-IDF licence words are looked
up: of every template whose key words the file all has, the rarest of them (ties: the one
that stands in the file least often).  Each occurrence of such a word at place p of the
file, with a posting at place q of a template, proposes the alignment p - q.  The key
phrases' words are intersected at their places relative to it, then all other words of the
template; an alignment counts if each key phrase stands whole and the agreeing share of
the template's words reaches ``AGREE``.

A place that counts has its key phrases whole, so it has the looked-up word: no place is
lost, whichever other words were altered.  Base phrases are templates that consist of
their key phrase alone.  Longer licence texts are templates by sentence, as an inserted
word moves all that follows it.

Defined results: null and empty texts have no words and no labels; repeated rows
repeat; ties in IDF are broken by the file's counts, then the word; an alignment may
reach beyond the text's borders, where nothing agrees.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words

AGREE = 0.8


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    key_phrases: tuple[str, ...]
    base: bool = False


def _base(phrase: str, label: str) -> Template:
    return Template(label, phrase, (phrase,), True)


BASE_TEMPLATES = (_base("mit license", "mit"), _base("apache license", "apache"), _base("general public license", "gpl"))
# Sentences of well-known licences and of their notices, and phrases that name them (fixed values).
TEMPLATES = BASE_TEMPLATES + (
    Template("mit-notice", "released under the mit license", ("mit license",)),
    Template("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted free of charge",)),
    Template("mit-text", "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software", ("deal in the software without restriction",)),
    Template("mit-text", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", ("permission notice shall be included",)),
    Template("mit-text", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement", ("the software is provided as is without warranty",)),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at", ("except in compliance with the license",)),
    Template("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied", ("software distributed under the license is distributed on an as is basis",)),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    Template("gpl-notice", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ("gnu general public license as published by the free software foundation",)),
    Template("gpl-notice", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose", ("distributed in the hope that it will be useful",)),
    Template("lgpl", "licensed under the gnu lesser general public license", ("lesser general public license",)),
    Template("agpl", "licensed under the gnu affero general public license", ("affero general public license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms",)),
    Template("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", ("redistributions of source code must retain",)),
    Template("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution", ("redistributions in binary form must reproduce",)),
    Template("bsd", "licensed under the bsd license", ("bsd license",)),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("mpl-2.0", "if a copy of the mpl was not distributed with this file you can obtain one at", ("copy of the mpl was not distributed with this file",)),
    Template("epl", "made available under the terms of the eclipse public license", ("eclipse public license",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("distribute this software for any purpose with or without fee",)),
    Template("isc", "provided that the above copyright notice and this permission notice appear in all copies", ("permission notice appear in all copies",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    Template("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary", ("anyone is free to copy modify publish use compile sell or distribute this software",)),
    Template("cc0", "cc0 1 0 universal public domain dedication", ("cc0 1 0 universal",)),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    Template("cc-by-nd-4.0", "licensed under cc by nd 4 0", ("cc by nd 4 0",)),
    Template("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
)


def word_hashes(text: str) -> np.ndarray:
    return next(words.blocks(pa.array([text]))).words


def vocabulary(templates: tuple[Template, ...] = TEMPLATES) -> list[str]:
    """The licence words: those of the key phrases."""
    return sorted({w for t in templates for phrase in t.key_phrases for w in phrase.split()})


def key_places(t: Template) -> list[int]:
    """The template's places that its key phrases cover."""
    own, need = t.text.split(), set()
    for phrase in t.key_phrases:
        p = phrase.split()
        q = next(i for i in range(len(own)) if own[i : i + len(p)] == p)
        need.update(range(q, q + len(p)))
    return sorted(need)


def _filter(keys: np.ndarray) -> np.ndarray:
    bits = np.zeros(1 << 16, bool)
    bits[(keys & np.uint64(0xFFFF)).astype(np.int64)] = True
    return bits


def _occurrences(block_words: np.ndarray, keys: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the block of the sorted ``keys``, and which key each is."""
    at = np.flatnonzero(bits[(block_words & np.uint64(0xFFFF)).astype(np.int64)])
    k = np.searchsorted(keys, block_words[at])
    k[k == len(keys)] = 0
    ok = keys[k] == block_words[at]
    return at[ok], k[ok]


def document_frequencies(docs: DataFrame, text_col: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> tuple[dict[str, int], int]:
    """In how many documents each licence word stands, over all of them, and the number of documents.

    As many rows as licence words come to the driver.
    """
    vocab = vocabulary(templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = word_hashes(" ".join(vocab))
        order = np.argsort(hashes)
        keys, bits = hashes[order], _filter(hashes)
        total = np.zeros(len(vocab) + 1, np.int64)
        for batch in batches:
            total[-1] += batch.num_rows
            for block in words.blocks(batch.column(0)):
                at, k = _occurrences(block.words, keys, bits)
                row = np.searchsorted(block.at, at, "right")
                pairs = np.unique(row * len(vocab) + k)
                total[:-1] += np.bincount(pairs % len(vocab), minlength=len(vocab))
        by_word = np.append(np.zeros(len(vocab), np.int64), total[-1])
        by_word[order] = total[:-1]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(by_word), dtype=np.int32)), pa.array(by_word)], names=["word", "df"])

    found = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "word int, df long").groupBy("word").agg(F.sum("df").alias("df"))
    df = {r["word"]: r["df"] for r in found.collect()}
    return {w: df.get(i, 0) for i, w in enumerate(vocab)}, df.get(len(vocab), 0)


def idf(df: dict[str, int], n_docs: int) -> dict[str, float]:
    return {w: math.log((n_docs + 1) / (x + 1)) for w, x in df.items()}


class _Index:
    """The templates' words as hashes, and the postings of their key words; made once a task."""

    def __init__(self, templates: tuple[Template, ...], rarity: dict[str, float]):
        vocab = sorted(rarity, key=lambda w: (-rarity[w], w))
        hashes = word_hashes(" ".join(vocab))
        order = np.argsort(hashes)
        self.keys, self.bits = hashes[order], _filter(hashes)
        self.rank = order  # of each key: 0 is the rarest
        self.rarity = np.array([rarity[w] for w in vocab])
        place = {w: i for i, w in enumerate(vocab)}
        self.texts = [word_hashes(t.text) for t in templates]
        self.must = [np.array(key_places(t)) for t in templates]
        #: By template, from the rarest word on: (word, its places among the key phrases).
        self.postings = []
        for t, must in zip(templates, self.must, strict=True):
            own = t.text.split()
            found: dict[int, list[int]] = {}
            for q in must.tolist():
                found.setdefault(place[own[q]], []).append(q)
            self.postings.append(sorted(found.items()))

    def places(self, block: words.Block, agree: float) -> list[tuple[int, int, int, float]]:
        """(row, template, start, agreement) of all places of a block."""
        at, k = _occurrences(block.words, self.keys, self.bits)
        if not len(at):
            return []
        word, row = self.rank[k], np.searchsorted(block.at, at, "right") - 1
        rows, own = np.unique(row, return_inverse=True)  # few rows have licence words
        counts = np.zeros((len(rows), len(self.keys)), np.int64)
        np.add.at(counts, (own, word), 1)
        out = []
        for t, postings in enumerate(self.postings):
            possible = (counts[:, [w for w, _ in postings]] > 0).all(1)
            if not possible.any():
                continue
            # Of each file its rarest key word of this template; equally rare ones by the file's own counts.
            ties = [w for w, _ in postings if self.rarity[w] == self.rarity[postings[0][0]]]
            looked_up = np.array(ties)[counts[:, ties].argmin(1)]
            take = possible[own] & (word == looked_up[own])
            starts, of = [], []
            for w, qs in postings:
                mine = take & (word == w)
                for q in qs:
                    starts.append(at[mine] - q)
                    of.append(row[mine])
            start, r = np.unique(np.stack((np.concatenate(starts), np.concatenate(of))), axis=1)
            lo, hi = block.at[r], block.at[r + 1]
            must, text = self.must[t], self.texts[t]
            for places in (must, np.arange(len(text))):  # key phrases first, then the whole template
                p = start[:, None] + places
                inside = (p >= lo[:, None]) & (p < hi[:, None])
                same = inside & (block.words[np.clip(p, 0, len(block.words) - 1)] == text[places])
                ok = same.all(1) if places is must else same.sum(1) >= agree * len(text) - 1e-9
                start, r, lo, hi, same = start[ok], r[ok], lo[ok], hi[ok], same[ok]
            out += zip((block.first + r).tolist(), [t] * len(r), (start - lo).tolist(), (same.sum(1) / len(text)).tolist(), strict=True)
        return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: tuple[Template, ...] = TEMPLATES, agree: float = AGREE) -> DataFrame:
    """doc_id, n_words, places (label, base, start, length, agreement) of every row of ``docs``; places by start, then template."""
    rarity = idf(*document_frequencies(docs, text_col, templates))
    place = T.StructType([T.StructField("label", T.StringType()), T.StructField("base", T.BooleanType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("agreement", T.DoubleType())])
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()), T.StructField("places", T.ArrayType(place))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _Index(templates, rarity)
        for batch in batches:
            n_words = np.zeros(batch.num_rows, np.int64)
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for block in words.blocks(batch.column(1)):
                n_words[block.first : block.first + block.rows] = np.diff(block.at)
                for row, t, start, share in sorted(index.places(block, agree), key=lambda x: (x[0], x[2], x[1])):
                    found[row].append({"label": templates[t].label, "base": templates[t].base, "start": start, "length": len(index.texts[t]), "agreement": share})
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words), pa.array(found, pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()), ("start", pa.int64()), ("length", pa.int64()), ("agreement", pa.float64())])))], names=schema.names)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def summary(scanned: DataFrame) -> DataFrame:
    """n_base, first_word, last_word, base_labels, labels and score from the places."""
    base = F.filter("places", lambda x: x["base"])
    names = lambda a: F.array_join(F.array_sort(F.array_distinct(F.transform(a, lambda x: x["label"]))), ",")
    starts = F.transform(base, lambda x: x["start"])
    return scanned.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        names(base).alias("base_labels"), names(F.col("places")).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda x: x["agreement"])), F.lit(0.0)).alias("score"), "places",
    )
