"""Language by hyperdimensional profiles (operator 4).

Every letter has a random vector of +1 and -1, drawn from its code point. A run of ``N`` letters is the
product of its letters' vectors, each rotated by its distance from the run's end; a text is the sum
of its runs, and so is a language (Joshi, Halseth and Kanerva, "Language Geometry Using Random Indexing", 2016).
Runs include the gap between words. Since a sum does not depend on order, a language's vector is made from the counts of its
runs, which are combined before their shuffle. A text's language is that of the greatest cosine,
after the mean of all languages is taken off, and its score the cosine scaled to 0..1.

Learning covers all rows given; languages that are null are left out. Predictions use the text only. Null text
or one without a letter: ``und``, score 0. Case and anything that is no letter do not matter. Ties: the first
language by name. No rows to learn from: all are ``und``. Repeated rows: each by itself. Input columns called like
an output column are replaced.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skilltide.llm._rows import without

DIMENSIONS = 1024
N = 3
BATCH_CHARS = 1_000_000
HELD_RUNS = 200_000
POINTS = 0x110000
_bits = 21  # of a code point


def _letters() -> np.ndarray:
    """For every code point the letter it counts as: itself if it is one, else 0, the gap."""
    table = np.zeros(POINTS, np.int64)
    for c in range(POINTS):
        if chr(c).isalpha():
            table[c] = c
    return table


_table: list[np.ndarray] = []


def letter_runs(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of all texts as whole numbers, the text of each, and which texts have a letter."""
    if not _table:
        _table.append(_letters())
    lengths = np.array([len(t) + 2 for t in texts], np.int64)
    codes = _table[0][np.frombuffer("".join(f" {t} " for t in texts).encode("utf-32-le", "replace"), np.uint32)]
    text = np.repeat(np.arange(len(texts)), lengths)
    solid = codes > 0
    has = np.zeros(len(texts), bool)
    has[text[solid]] = True
    # gaps count once
    keep = solid.copy()
    keep[1:] |= solid[:-1]
    keep[0] = True
    keep[1:] |= text[1:] != text[:-1]
    codes, text = codes[keep], text[keep]
    if len(codes) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), has
    m = len(codes) - n + 1
    runs = np.zeros(m, np.int64)
    for i in range(n):
        runs = (runs << _bits) | codes[i : i + m]
    ok = text[:m] == text[n - 1 :]
    return runs[ok], text[:m][ok], has


class Space:
    """Vectors of runs; those of letters are drawn once."""

    def __init__(self, dimensions: int, n: int):
        self.dimensions, self.n, self.letters = dimensions, n, {}

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            draw = np.random.default_rng([code, 20160601]).integers(0, 2, self.dimensions, dtype=np.int8)
            self.letters[code] = draw * np.int8(2) - np.int8(1)
        return self.letters[code]

    def vectors(self, runs: np.ndarray) -> np.ndarray:
        out = np.ones((len(runs), self.dimensions), np.float32)
        for i in range(self.n):
            back = self.n - 1 - i
            codes, which = np.unique((runs >> (_bits * back)) & (2**_bits - 1), return_inverse=True)
            out *= np.stack([np.roll(self.letter(int(c)), back) for c in codes])[which] if len(codes) else 1
        return out


def _groups(column: pa.Array):
    """Texts of a batch in parts of about ``BATCH_CHARS``: a batch may hold long texts."""
    part, held = [], 0
    for value in column.to_pylist():
        part.append((value or "").lower())
        held += len(part[-1])
        if held >= BATCH_CHARS:
            yield part
            part, held = [], 0
    if part:
        yield part


def _count(n: int):
    """(lang, run, c): counts of runs, passed on whenever there are many different ones."""

    def run(batches):
        held: Counter = Counter()

        def rows():
            keys = list(held)
            return pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()), pa.array(list(held.values()), pa.int64())],
                ["lang", "run", "c"],
            )

        for batch in batches:
            at = 0
            for texts in _groups(batch.column(0)):
                langs = batch.column(1).slice(at, len(texts)).to_pylist()
                at += len(texts)
                runs, text, _ = letter_runs(texts, n)
                names, number = np.unique(np.array(langs, object).astype(str), return_inverse=True)
                of = number[text]
                for k, name in enumerate(names.tolist()):
                    found, c = np.unique(runs[of == k], return_counts=True)
                    for r, x in zip(found.tolist(), c.tolist(), strict=True):
                        held[name, r] += x
                if len(held) > HELD_RUNS:
                    yield rows()
                    held.clear()
        yield rows()

    return run


def _bundle(dimensions: int, n: int):
    """(lang, at, x): parts of the languages' vectors."""

    def run(batches):
        space, sums = Space(dimensions, n), {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            runs, c = batch.column(1).to_numpy(), batch.column(2).to_numpy().astype(np.float32)
            for i in range(0, len(runs), 4096):
                v = space.vectors(runs[i : i + 4096])
                for name in set(langs[i : i + 4096].tolist()):
                    of = langs[i : i + 4096] == name
                    sums[name] = sums.get(name, 0) + (c[i : i + 4096][of] @ v[of]).astype(np.float64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k for k in sums for _ in range(dimensions)], pa.string()),
                pa.array(list(range(dimensions)) * len(sums), pa.int32()),
                pa.array(np.concatenate([*sums.values(), np.zeros(0)])),
            ],
            ["lang", "at", "x"],
        )

    return run


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", *, dimensions: int = DIMENSIONS, n: int = N) -> tuple[list[str], np.ndarray]:
    """The languages of ``docs`` and a unit vector for each: one row of ``dimensions`` numbers per language."""
    rows = docs.filter(F.col(f"`{lang_col}`").isNotNull()).select(
        F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang")
    )
    counts = rows.mapInArrow(_count(n), "lang string, run long, c long").groupBy("lang", "run").agg(F.sum("c").alias("c"))
    parts = counts.mapInArrow(_bundle(dimensions, n), "lang string, at int, x double")
    found = parts.groupBy("lang", "at").agg(F.sum("x").alias("x"))  # a number per language and dimension
    sums: dict[str, np.ndarray] = {}
    for lang, at, x in found.collect():
        sums.setdefault(lang, np.zeros(dimensions))[at] = x
    langs = sorted(sums)
    return langs, np.array([sums[k] / max(1e-12, float(np.linalg.norm(sums[k]))) for k in langs]).reshape(len(langs), dimensions)


def _predict(langs: list[str], profiles: np.ndarray, dimensions: int, n: int):
    center = profiles.mean(axis=0) if len(langs) > 1 else np.zeros(dimensions)
    away = profiles - center
    away /= np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-12)
    away, center = away.astype(np.float32), center.astype(np.float32)

    def run(batches):
        space = Space(dimensions, n)
        for batch in batches:
            names, scores = [], []
            for texts in _groups(batch.column(0)):
                runs, text, has = letter_runs(texts, n)
                kinds, which = np.unique(runs, return_inverse=True)
                sums = np.zeros((len(texts), dimensions), np.float32)
                for i in range(0, len(kinds), 4096):
                    here = (which >= i) & (which < i + 4096)
                    width = min(4096, len(kinds) - i)
                    vectors = space.vectors(kinds[i : i + 4096])
                    for a in range(0, len(texts), 1024):  # counts of runs per text, a part at a time
                        mine = here & (text >= a) & (text < a + 1024) if len(texts) > 1024 else here
                        rows = min(1024, len(texts) - a)
                        counts = np.bincount((text[mine] - a) * width + which[mine] - i, minlength=rows * width)
                        sums[a : a + rows] += counts.reshape(rows, width).astype(np.float32) @ vectors
                sums /= np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
                sums -= center
                sums /= np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
                known = has & (len(langs) > 0)
                cosine = sums @ away.T if len(langs) else np.zeros((len(texts), 1), np.float32)
                best = cosine.argmax(axis=1)
                names += [langs[b] if k else "und" for b, k in zip(best.tolist(), known.tolist(), strict=True)]
                scores += np.where(known, np.clip((cosine.max(axis=1) + 1) / 2, 0, 1), 0.0).astype(float).tolist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                [*batch.schema.names[1:], "lang_pred", "score"],
            )

    return run


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], text_col: str = "text", *, dimensions: int = DIMENSIONS, n: int = N) -> DataFrame:
    """``docs`` without the text, with ``lang_pred`` and ``score``."""
    kept = without(docs, ["lang_pred", "score", text_col])
    rows = docs.select(F.col(f"`{text_col}`").cast("string").alias("__text"), *[F.col(f"`{c}`") for c in kept.columns])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return rows.mapInArrow(_predict(*model, dimensions, n), f"{fields}{', ' if fields else ''}lang_pred string, score double")
