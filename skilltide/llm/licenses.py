"""Licence families of paragraphs by a trained classifier and templates (operator 5).

A paragraph is a line; a line of more than ``SPAN`` words is read in windows of so many that overlap by
half, so a notice inside a long line is found as well. Lines with words that follow each other are also read as
one text in such windows, so a notice wrapped over lines is found, with or without signs of a comment (no words):
it belongs to the line its first words are in, and takes the place of what its lines alone were taken for if
that is no family. Features are hashed runs of one to three words, as
far as they occur in a notice. A multinomial logistic regression is fitted on three kinds of examples: notices
(``TEMPLATES`` in different wordings and cuts, and lines of the corpus that hold one), licence-like
sentences of no known family (class ``unknown``), and at most ``LINES * MAX_DOCS`` different plain lines of about
``MAX_DOCS`` documents, both taken by their hash (class ``none``). A fifth of the examples is kept back to fit a temperature, so that
probabilities can be compared with ``LEAST``: a prediction of a family below it is ``unknown``, or nothing if ``none``
is nearly as likely. A family also has to be
confirmed: at least ``COVER`` of the word pairs of one of its templates are in the window, else it is ``unknown``.

Null or empty text: no paragraphs, no findings. Repeated rows: each by itself. Empty table: empty result; the classifier
is then fitted on the templates alone. Input columns called like an output column are replaced.
"""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skilltide.llm import _words as w
from skilltide.llm._rows import without

SPAN = 40
NGRAMS = 3
FEATURES = 1 << 14
MAX_DOCS = 2_000
LINES = 5
COPIES = 40
LEAST = 0.6
COVER = 0.6
NONE, UNKNOWN = "none", "unknown"

# Short notices of common licences, by family.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "You may not use this file except in compliance with the License. You may obtain a copy of the License at apache.org/licenses/LICENSE-2.0",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "under the terms of the GNU General Public License as published by the Free Software Foundation",
    ],
    "LGPL": [
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ],
    "AGPL": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    ],
    "BSD": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ],
    "MPL": [
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "ISC": [
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-ND": [
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ],
    "CC0": [
        "Released under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "Proprietary": ["Copyright. All rights reserved.", "No part of this publication may be reproduced without prior written permission."],
}
LEADS = ["", "This text is", "The code here is", "Note:", "Terms:", "Unless stated otherwise, all content is", "Copyright 2001 the authors."]
OTHER = [
    "Licensed under the {} license.", "Released under the {} terms of use, version 1.", "This work is distributed under the {} agreement.",
    "Use is governed by the {} licence.", "Available under a {} license, see the file.", "This software is licensed under {}.",
]
_CODES = np.random.default_rng(5).integers(1, 2**62, NGRAMS + 1).astype(np.uint64)
Findings = "findings array<struct<paragraph: int, word: int, family: string, score: double, coverage: double>>"


def _grams(h: np.ndarray, n: int) -> np.ndarray:
    """Feature of the run of ``n`` words that begins at each word but the last ``n`` - 1."""
    return ((w.chain(h, n) ^ _CODES[n]) % np.uint64(FEATURES)).astype(np.int64)


def _windows(data: np.ndarray, texts: np.ndarray):
    """Words and their hashes; first word, last word, text and paragraph of each window, and how many of the windows
    are of single lines (they come first); the paragraph of each word."""
    words = w.cut_words(data, texts, True, w.ALPHANUMERIC)
    h = w.hash_words(data, words, True)
    text = np.repeat(np.arange(len(texts) - 1), np.diff(words.first))
    line = np.searchsorted(np.flatnonzero(data == 10), words.start)
    if not len(h):
        return words, h, *(np.zeros(0, np.int64) for _ in range(4)), 0, np.zeros(0, np.int64)
    new, apart = np.ones(len(h), bool), np.ones(len(h), bool)
    new[1:] = (line[1:] != line[:-1]) | (text[1:] != text[:-1])
    apart[1:] = (line[1:] > line[:-1] + 1) | (text[1:] != text[:-1])
    first, block = np.flatnonzero(new), np.flatnonzero(apart)
    before = np.searchsorted(text[first], np.arange(len(texts)))
    of_word = (np.cumsum(new) - 1) - before[text]
    begin, end = _cut(first, len(h))
    # blocks of several lines, read over the ends of lines; a window inside a line was read already
    over, stop = _cut(block, len(h))
    several = np.searchsorted(first, over, side="right") < np.searchsorted(first, stop)
    alone = len(begin)
    begin, end = np.append(begin, over[several]), np.append(end, stop[several])
    return words, h, begin, end, text[begin], of_word[begin], alone, of_word


def _cut(first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and last of each window of the stretches of words that begin at ``first``."""
    size, half = np.diff(np.append(first, n)), SPAN // 2
    parts = np.where(size <= SPAN, 1, -(-(size - SPAN) // half) + 1)
    which = np.repeat(np.arange(len(first)), parts)
    begin = first[which] + (np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)) * half
    return begin, np.minimum(begin + SPAN, (first + size)[which])


def _features(h: np.ndarray, begin: np.ndarray, end: np.ndarray, active: np.ndarray):
    """For each length of run: the features at word places in order, their places, and where windows begin and end in that order."""
    for n in range(1, NGRAMS + 1):
        grams = _grams(h, n)
        place = np.flatnonzero(active[grams])
        yield grams[place], place, np.searchsorted(place, begin), np.searchsorted(place, np.maximum(begin, end - n + 1))


def _pairs(text: str) -> set[tuple[str, str]]:
    found = re.findall(r"[a-z0-9\x80-\U0010ffff]+", text.lower())
    return set(zip(found, found[1:], strict=False))


_TEMPLATE_PAIRS = {family: [_pairs(t) for t in texts] for family, texts in TEMPLATES.items()}


def coverage(text: str, family: str) -> float:
    """The share of word pairs of the family's best template that the text has."""
    have = _pairs(text)
    return max(len(t & have) / len(t) for t in _TEMPLATE_PAIRS[family])


def _extent(said: list[str], family: str) -> tuple[int, int]:
    """The places of the first and last word of ``said`` that belong to the family's best template: the shortest stretch with
    as many of its word pairs as there are in all."""
    pairs = list(zip(said, said[1:], strict=False))
    best = max(_TEMPLATE_PAIRS[family], key=lambda t: len(t & set(pairs)) / len(t))
    places = [i for i, p in enumerate(pairs) if p in best]
    wanted, found = len({pairs[i] for i in places}), (0, len(said) - 1)
    for i, low in enumerate(places):
        seen: set = set()
        for high in places[i:]:
            seen.add(pairs[high])
            if len(seen) == wanted:
                found = min(found, (low, high + 1), key=lambda x: x[1] - x[0])
                break
    return found


def _examples(lines: list[str], seed: int = 7) -> list[tuple[str, str]]:
    draw, out = random.Random(seed), []
    plain = [x for x in lines if x.strip()] or ["nothing to see here"]
    for family, texts in TEMPLATES.items():
        for t in texts:
            for _ in range(COPIES):
                said = t.split()
                if draw.random() < 0.3 and len(said) > 6:
                    said.pop(draw.randrange(len(said)))
                before, after = draw.choice(LEADS), ""
                if draw.random() < 0.4:
                    before, after = (" ".join(draw.choice(plain).split()[: draw.randrange(1, 25)]) for _ in range(2))
                out.append((f"{before} {' '.join(said)} {after}", family))
    for t in OTHER:
        for _ in range(COPIES):
            out.append((f"{draw.choice(LEADS)} {t.format(' '.join(draw.choice(plain).split()[: draw.randrange(1, 4)]))}", UNKNOWN))
    for x in plain:
        held = [f for f in TEMPLATES if coverage(x, f) >= 0.9]
        out.append((x, held[0] if len(held) == 1 else NONE)) if len(held) < 2 else None
    return out


def _vectors(texts: list[str], active: np.ndarray) -> list:
    out = []
    for t in texts:
        data = np.frombuffer(t.encode(), np.uint8)
        words = w.cut_words(data, np.array([0, len(data)]), True, w.ALPHANUMERIC)
        h = w.hash_words(data, words, True)
        seen = {int(g) for n in range(1, NGRAMS + 1) for g in _grams(h, n) if active[g]}
        out.append(Vectors.sparse(FEATURES, sorted((g, 1.0) for g in seen)))
    return out


def learn(docs: DataFrame, text_col: str = "text", max_docs: int = MAX_DOCS) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Classes, weights (class by feature), biases, and which features count; both divided by the fitted temperature."""
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{text_col}`").cast("string").alias("text")).filter("text IS NOT NULL")
    share = min(1.0, max_docs / max(1, texts.count()))
    mark = F.pmod(F.xxhash64("text", F.lit("licence sample")), F.lit(1_000_000))
    some = texts.filter(mark < int(share * 1_000_000)).select(F.explode(F.split("text", "\n")).alias("line")).distinct()
    lines = [r[0] for r in some.orderBy(F.xxhash64("line"), "line").limit(LINES * max_docs).collect()]
    examples = _examples(lines)
    active = np.zeros(FEATURES, bool)
    for t in [t for texts in TEMPLATES.values() for t in texts] + [x for t in OTHER for x in t.split("{}")]:
        data = np.frombuffer(t.encode(), np.uint8)
        h = w.hash_words(data, w.cut_words(data, np.array([0, len(data)]), True, w.ALPHANUMERIC), True)
        for n in range(1, NGRAMS + 1):
            active[_grams(h, n)] = True
    classes = [NONE, UNKNOWN, *TEMPLATES]
    order = list(range(len(examples)))
    random.Random(11).shuffle(order)
    kept_back = set(order[::5])
    labels = [classes.index(x[1]) for x in examples]
    vectors = _vectors([x[0] for x in examples], active)
    rows = [(float(labels[i]), vectors[i]) for i in range(len(examples)) if i not in kept_back]
    fit = LogisticRegression(featuresCol="features", labelCol="label", family="multinomial", regParam=1e-4, maxIter=60)
    model = fit.fit(spark.createDataFrame(rows, ["label", "features"]).coalesce(4))
    weights, bias = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    scores = np.array([weights[:, vectors[i].indices].sum(axis=1) + bias for i in sorted(kept_back)])
    truth = np.array([labels[i] for i in sorted(kept_back)])

    def loss(t):
        z = scores / t
        return float(np.mean(np.log(np.exp(z - z.max(1, keepdims=True)).sum(1)) + z.max(1) - z[np.arange(len(z)), truth]))

    temperature = min(np.geomspace(0.25, 8, 41), key=loss)
    return classes, weights / temperature, bias / temperature, active


def _scan(model):
    classes, weights, bias, active = model
    table = np.ascontiguousarray(weights.T).astype(np.float32)

    def run(batches):
        for batch in batches:
            data, texts = w.text_bytes(batch.column(0))
            found: list[list] = []
            paragraphs = []
            for i, j in w.slices(texts):
                part, at = data[texts[i] : texts[j]], texts[i : j + 1] - texts[i]
                words, h, begin, end, text, number, alone, of_word = _windows(part, at)
                here: list[list] = [[] for _ in range(j - i)]
                count = np.zeros(j - i, np.int64)
                np.maximum.at(count, text, number + 1)
                paragraphs.append(count)
                z = np.tile(bias.astype(np.float32), (len(begin), 1))
                for grams, _, low, high in _features(h, begin, end, active):
                    if len(grams):
                        # a feature that repeats in a window counts each time; notices hardly repeat words
                        sums = np.zeros((len(grams) + 1, len(classes)))
                        np.cumsum(table[grams], axis=0, out=sums[1:])
                        z += sums[np.maximum(high, low)] - sums[low]
                best = z.argmax(axis=1) if len(z) else np.zeros(0, np.int64)
                lines: dict[tuple[int, int], dict[str, list]] = {}  # findings of single lines, by text and line
                for k in np.flatnonzero(best != 0).tolist():
                    e = np.exp(z[k] - z[k].max())
                    family, score = classes[best[k]], float(e[best[k]] / e.sum())
                    words_here = part[words.start[begin[k]] : words.end[end[k] - 1]].tobytes().decode()
                    cover = coverage(words_here, family) if family != UNKNOWN else 0.0
                    if family == UNKNOWN or score < LEAST or cover < COVER:
                        if e[0] / e.sum() >= 1 - LEAST:  # as likely no licence at all
                            continue
                        family = UNKNOWN
                    first = words.first[text[k]]
                    found_here = {"paragraph": int(number[k]), "word": int(begin[k] - first), "family": family, "score": score, "coverage": cover}
                    if k < alone:
                        lines.setdefault((int(text[k]), int(number[k])), {}).setdefault(family, []).append(found_here)
                        here[text[k]].append(found_here)
                        continue
                    low, high = begin[k], end[k] - 1
                    if family != UNKNOWN:
                        said = [part[a:b].tobytes().decode().lower() for a, b in zip(words.start[begin[k] : end[k]], words.end[begin[k] : end[k]], strict=True)]
                        low, high = (int(begin[k]) + x for x in _extent(said, family))
                    held = [lines.get((int(text[k]), n), {}) for n in range(int(of_word[low]), int(of_word[high]) + 1)]
                    if len(held) < 2 or any(family in x for x in held) or (family == UNKNOWN and any(held)):
                        continue  # within a line, or found there
                    found_here["paragraph"], found_here["word"] = int(of_word[low]), int(low - first)
                    if any(found_here["word"] == x["word"] and family == x["family"] for x in here[text[k]]):
                        continue  # two windows hold it
                    if family != UNKNOWN:
                        for x in held:
                            for old in x.pop(UNKNOWN, []):
                                here[text[k]].remove(old)
                    here[text[k]].append(found_here)
                found += here
            kind = pa.list_(pa.struct([("paragraph", pa.int32()), ("word", pa.int32()), ("family", pa.string()), ("score", pa.float64()), ("coverage", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(np.concatenate(paragraphs) if paragraphs else [], pa.int64()), pa.array(found, kind)],
                [*batch.schema.names[1:], "n_paragraphs", "findings"],
            )

    return run


def license_findings(docs: DataFrame, text_col: str = "text", model=None) -> DataFrame:
    """``docs`` without the text, with ``n_paragraphs`` (lines that have words) and ``findings``: paragraph, first word,
    family, probability and template coverage of every window that is not ``none``, over line ends where its lines alone do not say it."""
    model = model or learn(docs, text_col)
    kept = without(docs, ["n_paragraphs", "findings", text_col])
    rows = docs.select(F.col(f"`{text_col}`").cast("string").alias("__text"), *[F.col(f"`{c}`") for c in kept.columns])
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema.fields)
    return rows.mapInArrow(_scan(model), f"{fields}n_paragraphs long, {Findings}")
