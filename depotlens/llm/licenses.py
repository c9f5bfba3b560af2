"""License scan: phrases, and an exact containment join with license templates.

A template is the set of words of a license notice. A block of text is any run of twice as
many words as the template has; it meets the template if it holds at least ``CONTAINMENT``
of the template's words. Template words are ordered by how often they occur in all
documents, rarest first: a block that misses every word of the prefix (the rarest words,
all but required - 1) can't meet the template, so only texts with a prefix word go on. Of
those, texts with too few distinct template words are dropped (length), and each prefix
place bounds the run of words looked at (position). The rest is counted exactly. Every block
that meets a template is found; blocks that overlap are reported as one, from its first to its
last template word, with the best containment of them.

Case table: a null or empty text has 0 words, no labels and score 0; repeated rows are
scanned each; a text may have several labels; extra columns are ignored."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotlens.llm.words import LETTERED, coded, slices, split_words

CONTAINMENT = 0.85

# Phrases and labels of the base scan.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Usual notices by label.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the software without restriction"),
    ("apache-2", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("mit", "Released under the terms of the MIT License"),
)


_BLOCKS = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("containment", pa.float64())]))


@dataclass
class Template:
    label: str
    words: list[int]  # numbers of its words, rarest first
    need: int

    @property
    def prefix(self) -> list[int]:
        return self.words[: len(self.words) - self.need + 1]


def _words_of(text: str) -> list[str]:
    return split_words(pa.array([text]), LETTERED)[1].to_pylist()


def vocabulary(templates: tuple[tuple[str, str], ...]) -> list[str]:
    return sorted({w for _, text in templates for w in _words_of(text)})


def frequencies(documents: DataFrame, words: list[str]) -> dict[str, int]:
    """How often each of ``words`` occurs in all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, wanted = np.zeros(len(words), np.int64), pa.array(words, pa.large_string())
        for batch in batches:
            for part in slices(batch):
                codes, distinct = coded(split_words(part.column("text"), LETTERED)[1])
                number = pc.fill_null(pc.index_in(distinct, value_set=wanted), len(words)).to_numpy(zero_copy_only=False)
                totals += np.bincount(number, np.bincount(codes, minlength=len(distinct)), len(words) + 1)[:-1].astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(totals)], names=["word", "n"])

    counted = documents.select("text").mapInArrow(run, "word string, n bigint")
    return {row[0]: row[1] for row in counted.groupBy("word").agg(F.sum("n")).collect()}


def ordered_templates(templates: tuple[tuple[str, str], ...], counts: dict[str, int], containment: float) -> list[Template]:
    number = {w: i for i, w in enumerate(vocabulary(templates))}
    result = []
    for label, text in templates:
        words = sorted(set(_words_of(text)), key=lambda w: (counts.get(w, 0), w))
        result.append(Template(label, [number[w] for w in words], math.ceil(containment * len(words) - 1e-9)))
    return result


def meeting_blocks(places: np.ndarray, words: np.ndarray, width: int, need: int) -> list[tuple[int, int, int]]:
    """Start, end and most distinct words of the runs of ``width`` words with at least
    ``need`` distinct ones, overlapping runs as one; ``places`` ascend."""
    inside: dict[int, int] = {}
    found: list[tuple[int, int, int]] = []
    first = 0
    for place, word in zip(places.tolist(), words.tolist(), strict=True):
        inside[word] = inside.get(word, 0) + 1
        while places[first] <= place - width:
            gone = int(words[first])
            inside[gone] -= 1
            if not inside[gone]:
                del inside[gone]
            first += 1
        if len(inside) >= need:
            start, most = int(places[first]), len(inside)
            if found and start < found[-1][1]:
                before = found.pop()
                start, most = min(start, before[0]), max(most, before[2])
            found.append((start, place + 1, most))
    return found


def contained(template: Template, number: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int, int, float]]:
    """Text, start, end (in words) and containment of every block that meets the template.
    ``number`` has the template word number of every word, or -1."""
    size, width = len(template.words), 2 * len(template.words)
    at_prefix = np.flatnonzero(np.isin(number, template.prefix))
    rows = np.searchsorted(ends, at_prefix, side="right")
    for row in np.unique(rows):
        near = at_prefix[np.searchsorted(rows, row) : np.searchsorted(rows, row, side="right")]
        text = number[starts[row] : ends[row]]
        places = np.flatnonzero(np.isin(text, template.words))
        if len(np.unique(text[places])) < template.need:
            continue
        close = np.zeros(len(text) + 1, np.int64)
        np.add.at(close, np.maximum(near - starts[row] - width + 1, 0), 1)
        np.add.at(close, np.minimum(near - starts[row] + width, len(text)), -1)
        places = places[np.cumsum(close)[places] > 0]
        for start, end, most in meeting_blocks(places, text[places], width, template.need):
            yield int(row), start, end, most / size


def phrase_places(codes: np.ndarray, distinct: pa.Array, starts: np.ndarray, ends: np.ndarray, phrase: str) -> np.ndarray:
    """Places at which the words of ``phrase`` stand consecutively in one text."""
    words = phrase.split(" ")
    wanted = pc.index_in(pa.array(words, distinct.type), value_set=distinct)
    if wanted.null_count:
        return np.empty(0, np.int64)
    first, *rest = wanted.to_pylist()
    places = np.flatnonzero(codes == first)
    row = np.searchsorted(ends, places, side="right")
    places = places[places + len(words) <= ends[row]] if len(places) else places
    for k, code in enumerate(rest, 1):
        places = places[codes[places + k] == code]
    return places


def _scan(part: pa.RecordBatch, templates: list[Template], words: list[str]) -> pa.RecordBatch:
    counts, values = split_words(part.column("text"), LETTERED)
    codes, distinct = coded(values)
    ends = np.cumsum(counts)
    starts, rows = ends - counts, part.num_rows
    base, blocks = [set() for _ in range(rows)], [{} for _ in range(rows)]
    n_base, first, last = np.zeros(rows, np.int64), np.full(rows, np.iinfo(np.int64).max), np.full(rows, -1)
    if len(distinct):
        for phrase, label in PHRASES.items():
            places = phrase_places(codes, distinct, starts, ends, phrase)
            row = np.searchsorted(ends, places, side="right")
            np.add.at(n_base, row, 1)
            np.minimum.at(first, row, places - starts[row])
            np.maximum.at(last, row, places - starts[row])
            for r in np.unique(row):
                base[r].add(label)
        number = pc.index_in(distinct, value_set=pa.array(words, distinct.type))
        number = pc.fill_null(number, -1).to_numpy(zero_copy_only=False)[codes]
        for template in templates:
            for row, *block, share in contained(template, number, starts, ends):
                key = (*block, template.label)
                blocks[row][key] = max(blocks[row].get(key, 0.0), share)
    labels = [{label for _, _, label in found} for found in blocks]
    score = np.array([max(found.values(), default=0.0) for found in blocks])
    score[n_base > 0] = 1.0
    listed = [[{"label": k[2], "start": k[0], "end": k[1], "containment": share} for k, share in sorted(found.items())] for found in blocks]
    none = n_base == 0
    return pa.RecordBatch.from_arrays(
        [
            part.column("doc_id"),
            pa.array(counts, pa.int64()),
            pa.array(n_base),
            pa.array(first, pa.int64(), mask=none),
            pa.array(last, pa.int64(), mask=none),
            pa.array([",".join(sorted(b)) for b in base], pa.string()),
            pa.array([",".join(sorted(b | more)) for b, more in zip(base, labels, strict=True)], pa.string()),
            pa.array(score, pa.float64()),
            pa.array(listed, _BLOCKS),
        ],
        names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "blocks"],
    )


def scan(
    documents: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, containment: float = CONTAINMENT
) -> DataFrame:
    """Base phrases and labels of every document. Templates are a parameter, so what is
    sent to the executors doesn't grow with the data; word counts cover all documents."""
    words = vocabulary(templates)
    ordered = ordered_templates(templates, frequencies(documents, words), containment)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield _scan(part, ordered, words)

    return documents.select("doc_id", "text").mapInArrow(
        run,
        "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint,"
        " base_labels string, labels string, score double,"
        " blocks array<struct<label: string, start: bigint, end: bigint, containment: double>>",
    )
