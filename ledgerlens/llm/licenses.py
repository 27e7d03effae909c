"""Licence notices in texts by a positional index of their rarest words.

The index holds, for every licence template, its rarest words (highest inverse document frequency,
counted over all documents) with their positions in the template. In a text only the places of
indexed words are looked up. Each posting puts the template's first word at one place of the text;
places on which the postings of a template agree are candidates, and a candidate counts when all
mandatory phrases of the template stand where the template has them.

* A **phrase** template (two to four words) is mandatory as a whole. It is posted under its rarest
  word, so every place of the phrase is a candidate: nothing is lost.
* A **notice** template is longer and may be altered: of its ``POSTED`` rarest words at least
  ``AGREEING`` must agree on a place, its mandatory phrases must stand there word by word, and words
  with at least ``SHARE`` of its weight must.

Rows are independent of each other once the document frequencies (one row per licence word) are
known, so nothing but these counts is shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.staging import as_bytes, ship_package
from ledgerlens.llm.words import slices

#: Rarest words under which a notice is posted, and how many of them must agree on its place.
POSTED, AGREEING = 8, 3

#: Least share of a notice's weight that must stand at its place.
SHARE = 0.6

#: Text bytes searched as one sequence of words (a longer text is one by itself).
TOGETHER = 4 << 20

# Phrases whose places are all reported, with their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Wording of public licence notices (label, notice, mandatory phrases).
NOTICES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license version 2 0",)),
    (
        "apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License "
        "is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND",
        ("required by applicable law", "without warranties or conditions"),
    ),
    (
        "gpl-3.0",
        "This work is licensed under the GNU General Public License, version 3",
        ("gnu general public license version 3",),
    ),
    (
        "gpl-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation; either version 2 of the License",
        ("free software foundation either version 2",),
    ),
    (
        "gpl-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License",
        ("free software foundation either version 3",),
    ),
    (
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation",
        ("gnu lesser general public license",),
    ),
    (
        "agpl-3.0",
        "it under the terms of the GNU Affero General Public License as published by the Free Software "
        "Foundation, either version 3 of the License",
        ("gnu affero general public license",),
    ),
    ("mit", "Released under the MIT License", ("mit license",)),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the Software without restriction",
        ("permission is hereby granted", "without restriction"),
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
        "is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
        ("with or without fee is hereby granted",),
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    (
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        ("mozilla public license v 2 0",),
    ),
    ("cc-by-4.0", "Licensed under CC BY 4.0", ("cc by 4 0",)),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", ("cc by nc 4 0",)),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0", ("cc by sa 4 0",)),
    (
        "cc0-1.0",
        "To the extent possible under law, the author has waived all copyright and related rights to this work",
        ("waived all copyright",),
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain",
        ("free and unencumbered software",),
    ),
    ("reserved", "Copyright. All rights reserved", ("all rights reserved",)),
)

#: Every byte as it counts: A-Z in lower case, what no word holds as a space.
_FOLDED = bytes(
    code + 32 if 65 <= code <= 90 else code if 48 <= code <= 57 or 97 <= code <= 122 or code > 127 else 32
    for code in range(256)
)


def words_of(raw: bytes) -> list[bytes]:
    """The words of a text: ASCII letters in lower case, digits, and all beyond ASCII."""
    return raw.translate(_FOLDED).split()


@dataclass(frozen=True)
class Template:
    """One licence wording; a phrase is mandatory as a whole."""

    label: str
    words: tuple[bytes, ...]
    mandatory: tuple[tuple[int, int], ...]  # first position and number of words
    is_phrase: bool


def _template(label: str, wording: str, mandatory: tuple[str, ...] | None) -> Template:
    words = tuple(words_of(wording.encode()))
    parts = []
    for phrase in mandatory or (wording,):
        inner = tuple(words_of(phrase.encode()))
        at = next(at for at in range(len(words)) if words[at : at + len(inner)] == inner)
        parts.append((at, len(inner)))
    return Template(label, words, tuple(parts), mandatory is None)


def templates() -> list[Template]:
    """The templates of this module: phrases first."""
    return [_template(label, phrase, None) for phrase, label in PHRASES] + [
        _template(*notice) for notice in NOTICES
    ]


def vocabulary(some: list[Template]) -> list[bytes]:
    return sorted({word for template in some for word in template.words})


class _Coded:
    """Texts of a batch as one sequence of licence-word numbers, -1 for any other word."""

    def __init__(self, texts: list[bytes], number: dict[bytes, int]):
        codes: list[int] = []
        self.sizes: list[int] = []
        get = number.get
        for raw in texts:
            words = words_of(raw)
            self.sizes.append(len(words))
            codes.extend([get(word, -1) for word in words])
            codes.append(-1)  # no template lies across two texts
        self.codes = np.array(codes, dtype=np.int32)
        sizes = np.array(self.sizes, dtype=np.int64) + 1
        self.edges = np.concatenate([[0], np.cumsum(sizes)])
        self.text_of = np.repeat(np.arange(len(texts)), sizes)


def document_frequencies(docs: DataFrame, words: list[bytes], text: str = "text") -> tuple[int, np.ndarray]:
    """How many rows there are, and for every word how many rows hold it. All rows are read."""
    ship_package(docs.sparkSession)
    number = {word: at for at, word in enumerate(words)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = 0, np.zeros(len(words), dtype=np.int64)
        for whole in batches:
            for batch in slices(whole, TOGETHER, "_text"):
                coded = _Coded([raw.as_py() for raw in batch.column("_text")], number)
                rows += batch.num_rows
                places = np.flatnonzero(coded.codes >= 0)
                pairs = np.unique(coded.text_of[places] * len(words) + coded.codes[places])
                held += np.bincount(pairs % len(words), minlength=len(words))
        counts = np.append(held, rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(counts), dtype=np.int32)), pa.array(counts)], names=["word", "rows"]
        )

    counted = docs.select(as_bytes(text).alias("_text")).mapInArrow(count, "word int, rows bigint")
    total = np.zeros(len(words) + 1, dtype=np.int64)
    for row in counted.groupBy("word").agg(F.sum("rows").alias("rows")).collect():
        total[row["word"]] = row["rows"]
    return int(total[-1]), total[:-1]


class Index:
    """Postings of the rarest words of all templates."""

    def __init__(self, some: list[Template], words: list[bytes], weights: np.ndarray):
        self.templates, self.weights = some, weights
        self.number = {word: at for at, word in enumerate(words)}
        self.codes = [np.array([self.number[word] for word in one.words]) for one in some]
        #: word number -> (template, position) pairs
        self.postings: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.posted_at: list[set[int]] = []
        self.needed: list[int] = []
        for which, codes in enumerate(self.codes):
            rarest = sorted(range(len(codes)), key=lambda at: (-weights[codes[at]], codes[at], at))
            self.posted_at.append(set(rarest[: 1 if some[which].is_phrase else POSTED]))
            self.needed.append(1 if some[which].is_phrase else min(AGREEING, len(codes)))
            for at in self.posted_at[-1]:
                self.postings[int(codes[at])].append((which, at))
        self.posted = np.zeros(len(words) + 1, dtype=bool)  # the last entry stands for -1
        self.posted[list(self.postings)] = True

    def _candidates(self, codes: np.ndarray) -> dict[int, np.ndarray]:
        """For every template the places of its first word on which enough postings agree."""
        places = np.flatnonzero(self.posted[codes])
        found: dict[int, list[np.ndarray]] = defaultdict(list)
        if len(places):
            order = np.argsort(codes[places], kind="stable")
            places = places[order]
            kinds, first = np.unique(codes[places], return_index=True)
            for word, some in zip(kinds.tolist(), np.split(places, first[1:]), strict=True):
                for which, at in self.postings[word]:
                    found[which].append(some - at)
        agreed = {}
        for which, starts in found.items():
            place, votes = np.unique(np.concatenate(starts), return_counts=True)
            agreed[which] = place[votes >= self.needed[which]]
        return agreed

    def matches(self, codes: np.ndarray, text_of: np.ndarray) -> Iterator[tuple]:
        """Template, text, places of its first word, and the share of its weight that stands there."""
        # A notice may be cut off by the start or the end of its text.
        pad = max(map(len, self.codes), default=0)
        padded = np.pad(codes, pad, constant_values=-1)
        texts = np.pad(text_of, pad, constant_values=-1)
        for which, places in sorted(self._candidates(codes).items()):
            template, wanted = self.templates[which], self.codes[which]
            weights, places = self.weights[wanted], places + pad
            anchor = template.mandatory[0][0]
            for first, size in template.mandatory:
                # The rarest first: few places are left after it.
                for at in sorted(range(first, first + size), key=lambda at: -weights[at]):
                    same = texts[places + at] == texts[places + anchor]
                    places = places[same & (padded[places + at] == wanted[at])]
            if not len(places):
                continue
            there, agreeing = np.zeros(len(places)), np.zeros(len(places), dtype=np.int64)
            for at, word in enumerate(wanted):
                held = (padded[places + at] == word) & (texts[places + at] == texts[places + anchor])
                there += weights[at] * held
                agreeing += held & (at in self.posted_at[which])
            share = there / weights.sum()
            enough = (agreeing >= self.needed[which]) & (share >= SHARE)
            if enough.any():
                places = places[enough]
                yield which, texts[places + anchor], places - pad, np.minimum(share[enough], 1.0)


def find_licenses(
    docs: DataFrame, key: str = "doc_id", text: str = "text", wordings: list[Template] | None = None
) -> DataFrame:
    """key, ``n_words`` and ``found`` of every row: label, start, length, share and whether a phrase.

    ``start`` is the number of the template's first word in the text (it can be negative, or the
    end beyond the text, where a notice is cut off there), ``share`` the part of its weight that stands there.
    A null or empty text has no words. Row by row after the counts: repeated rows and null keys
    are kept, other columns are not read, an empty table gives an empty result.
    """
    some = templates() if wordings is None else wordings
    words = vocabulary(some)
    rows, held = document_frequencies(docs, words, text)
    # Smoothed, so that words of every row still weigh a little and none weighs nothing.
    index = Index(some, words, np.log((1.0 + rows) / (1.0 + held)) + 1.0)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, TOGETHER, "_text"):
                coded = _Coded([raw.as_py() for raw in batch.column("_text")], index.number)
                texts, starts, kinds, shares = [], [], [], []
                for which, text_of, places, share in index.matches(coded.codes, coded.text_of):
                    texts.append(text_of)
                    starts.append(places - coded.edges[text_of])
                    kinds.append(np.full(len(places), which))
                    shares.append(share)
                text_of, start, kind, share = (
                    np.concatenate([np.zeros(0), *parts]) for parts in (texts, starts, kinds, shares)
                )
                order = np.lexsort((kind, start, text_of))
                text_of, start, share = text_of[order], start[order].astype(np.int64), share[order]
                kind = kind[order].astype(np.int64).tolist()
                rows = pa.StructArray.from_arrays(
                    [
                        pa.array([some[which].label for which in kind], pa.string()),
                        pa.array(start),
                        pa.array([len(some[which].words) for which in kind], pa.int64()),
                        pa.array(share),
                        pa.array([some[which].is_phrase for which in kind], pa.bool_()),
                    ],
                    names=["label", "start", "length", "share", "is_phrase"],
                )
                ends = np.searchsorted(text_of, np.arange(batch.num_rows + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(coded.sizes, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows),
                    ],
                    names=[key, "n_words", "found"],
                )

    plain = docs.select(F.col(key), as_bytes(text).alias("_text"))
    kind = plain.schema[key].dataType.simpleString()
    return plain.mapInArrow(
        search,
        f"`{key}` {kind}, n_words bigint, "
        "found array<struct<label: string, start: bigint, length: bigint, share: double, is_phrase: boolean>>",
    )
