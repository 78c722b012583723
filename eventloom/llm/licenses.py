"""Licence scan: an exact set-similarity join of licence templates with the blocks of every text.

A template is a set of words; a block is a stretch of a text. A block is found for a template when it holds at
least the template's share of its distinct words. Words are ordered by their frequency over all documents, rare
ones first. A block that holds o of a template's m words holds one of the first m - o + 1 in that order, so only
these are looked up (prefix filter); the block needs o words that templates know at all (length filter), and a
shared word at places i and j of both orders leaves at most min(i, j) shared words before it and the shorter rest
after it (positional filter). What is left is counted exactly.

A phrase is a template of which all words must stand, in order and next to each other: a block that holds them all is
searched for the places.

The blocks of a template of up to c words (c a power of two) are 2c words long and begin every c words, so every
stretch of c words lies in the block that its beginning falls in.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.shared import prepare

#: Share of a notice's distinct words that a block must hold.
CONTAINMENT = 0.8

# The phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Openings of licence notices as their authors publish them.
NOTICES = {
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files, to deal in the software without restriction": "mit",
    "Licensed under the Apache License; you may not use this file except in compliance with the License. You may "
    "obtain a copy of the License at": "apache-2",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met": "bsd",
    "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby "
    "granted": "isc",
    "This work is licensed under the GNU General Public License, version": "gpl",
    "you can redistribute it and modify it under the terms of the GNU General Public License as published by the "
    "Free Software Foundation": "gpl",
    "This Source Code Form is subject to the terms of the Mozilla Public License": "mpl",
    "This work is licensed under a Creative Commons International License": "creative-commons",
    "To the extent possible under law the author has waived all copyright and related or neighboring rights to this "
    "work": "cc0",
    "All rights reserved. No part of this publication may be reproduced or transmitted in any form": "reserved",
}

FOUND = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        (
            "found",
            pa.list_(
                pa.struct(
                    [
                        ("label", pa.string()),
                        ("phrase", pa.bool_()),
                        ("start", pa.int64()),
                        ("end", pa.int64()),
                        ("containment", pa.float64()),
                        ("places", pa.list_(pa.int64())),
                    ]
                )
            ),
        ),
    ]
)
FOUND_DDL = (
    "doc_id long, n_words long, found array<struct<label: string, phrase: boolean, start: long, end: long, "
    "containment: double, places: array<long>>>"
)

# bytes of words as they are, A-Z lower-cased, every other byte below 128 a space
_TABLE = bytes(
    b if b in range(48, 58) or b in range(97, 123) or b >= 128 else b + 32 if b in range(65, 91) else 32
    for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a UTF-8 text with A-Z lower-cased."""
    return text.translate(_TABLE).split()


class Template(NamedTuple):
    label: str
    words: tuple[bytes, ...]
    needed: int  # distinct words that a block must hold
    phrase: bool

    @property
    def stride(self) -> int:
        return 1 << (len(self.words) - 1).bit_length()


def templates(
    phrases: Mapping[str, str] = PHRASES, notices: Mapping[str, str] = NOTICES, containment: float = CONTAINMENT
) -> list[Template]:
    """Templates of phrases (all words, in order) and of notices (that share of their distinct words)."""
    if not 0 < containment <= 1:
        raise ValueError("The containment is a share above 0")
    out = []
    for texts, phrase in ((phrases, True), (notices, False)):
        for text, label in texts.items():
            found = tuple(words_of(text.encode()))
            if not found:
                raise ValueError(f"A template without words: {text!r}")
            size = len(set(found))
            out.append(Template(label, found, size if phrase else needed(size, containment), phrase))
    return out


def needed(size: int, containment: float) -> int:
    """Smallest whole number that is at least the share of ``size``; shares are read as thousandths."""
    return -(-size * round(containment * 1000) // 1000)


class Index:
    """Prefix words of all templates, in the global order."""

    def __init__(self, found: Iterable[Template], frequencies: Mapping[bytes, int]):
        self.templates = list(found)
        vocabulary = {w for t in self.templates for w in t.words}
        order = sorted(vocabulary, key=lambda w: (frequencies.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(order)}
        self.sets = [frozenset(self.rank[w] for w in t.words) for t in self.templates]
        #: word: templates with the word in their prefix, and its place in their order
        self.prefix: dict[bytes, list[tuple[int, int]]] = {}
        for number, (t, ranks) in enumerate(zip(self.templates, self.sets, strict=True)):
            for i, r in enumerate(sorted(ranks)[: len(ranks) - t.needed + 1]):
                self.prefix.setdefault(order[r], []).append((number, i))

    def blocks(self, words: list[bytes]) -> list[dict]:
        """The blocks of a text that meet a template, by template, then place."""
        prefix, rank = self.prefix, self.rank
        held: dict[tuple[int, int], list[int]] = {}
        met: dict[tuple[int, int], int] = {}
        for at in [i for i, w in enumerate(words) if w in prefix]:
            for number, i in prefix[words[at]]:
                t = self.templates[number]
                block = at // t.stride
                for k in (block, block - 1) if block else (block,):
                    if (number, k) in met:
                        continue
                    key = (t.stride, k)
                    if key not in held:
                        part = words[k * t.stride : (k + 2) * t.stride]
                        held[key] = sorted({rank[w] for w in part if w in rank})
                    ranks, size = held[key], len(self.sets[number])
                    if len(ranks) < t.needed:
                        continue
                    j = ranks.index(rank[words[at]])
                    if j > len(ranks) - t.needed:
                        continue  # not in the block's own prefix
                    if min(i, j) + 1 + min(size - i, len(ranks) - j) - 1 < t.needed:
                        continue
                    met[number, k] = len(self.sets[number].intersection(ranks))
        out = []
        for (number, k), shared in sorted(met.items()):
            t = self.templates[number]
            if shared < t.needed:
                continue
            start, end = k * t.stride, min((k + 2) * t.stride, len(words))
            places = []
            if t.phrase:
                size, phrase = len(t.words), list(t.words)
                first = range(start, min(start + t.stride, len(words) - size + 1))
                places = [i for i in first if words[i] == phrase[0] and words[i : i + size] == phrase]
                if not places:
                    continue
            out.append(
                {
                    "label": t.label,
                    "phrase": t.phrase,
                    "start": start,
                    "end": end,
                    "containment": shared / len(self.sets[number]),
                    "places": places,
                }
            )
        return out


def _count(vocabulary: frozenset[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column("text"):
                counts.update(vocabulary.intersection(words_of(text.as_py())))
        yield pa.RecordBatch.from_pydict(
            {"word": pa.array(list(counts), pa.binary()), "n": pa.array(list(counts.values()), pa.int64())}
        )

    return run


def _scan(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, found = [], []
            for text in batch.column("text"):
                words = words_of(text.as_py())
                counts.append(len(words))
                found.append(index.blocks(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(found, FOUND.field("found").type)],
                schema=FOUND,
            )

    return run


def frequencies(docs: DataFrame, found: Iterable[Template]) -> dict[bytes, int]:
    """In how many of all documents each word of the templates stands; as many rows as they have words."""
    vocabulary = frozenset(w for t in found for w in t.words)
    rows = _bytes(docs).mapInArrow(_count(vocabulary), "word binary, n long")
    return {bytes(r["word"]): r["n"] for r in rows.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def _bytes(docs: DataFrame) -> DataFrame:
    text = F.coalesce(docs["text"], F.lit("")).cast("binary")
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"))


def scan(docs: DataFrame, found: list[Template] | None = None) -> DataFrame:
    """Every document with the blocks that meet a template: ``doc_id, n_words, found``.

    ``found`` has for each block its label, whether it is of a phrase, its first word and the word after its last,
    the share of the template's distinct words in it, and for a phrase the words where it begins (each place in one
    block only). Two passes over the documents, one for the words' frequencies; nothing is shuffled but these.

    Null or empty text: no words, nothing found. Null or repeated ``doc_id``: every row is a document by itself. No
    documents: no rows. Other columns are ignored. No templates: nothing found.
    """
    prepare(docs.sparkSession)
    found = templates() if found is None else found
    index = Index(found, frequencies(docs, found))
    return _bytes(docs).mapInArrow(_scan(index), FOUND_DDL)


def as_table(spark: SparkSession, found: list[Template]) -> DataFrame:
    """Templates as a table, for a report."""
    rows = [(t.label, b" ".join(t.words).decode(), t.needed, t.phrase) for t in found]
    return spark.createDataFrame(rows, "label string, words string, needed int, phrase boolean")
