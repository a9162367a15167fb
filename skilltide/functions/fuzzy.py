"""X-18: token-set ratio, the one score Spark cannot express. Arrow batches, plain strings."""

from __future__ import annotations

import re
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ship this module's code with the UDF, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_NON_WORD = re.compile(r"\W")
_DROPPED = {point: None for point in range(0x80, 0x100)}


def prepare(text: str) -> str:
    return _NON_WORD.sub(" ", text.translate(_DROPPED)).lower().strip()


def _positions(text: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, char in enumerate(text):
        masks[char] = masks.get(char, 0) | (1 << i)
    return masks


def _lcs(masks: dict[str, int], length: int, other: str) -> int:
    """Length of the longest common subsequence, one word operation per character."""
    row = full = (1 << length) - 1
    for char in other:
        hits = row & masks.get(char, 0)
        row = ((row + hits) | (row - hits)) & full
    return length - row.bit_count()


def _score(shared: int, m: int, n: int) -> int:
    return round(100 * (2 * shared / (m + n))) if m and n else 0


class Prepared:
    """One side of a comparison, prepared once."""

    __slots__ = ("tokens", "text", "masks")

    def __init__(self, text: str):
        self.tokens = frozenset(prepare(text).split())
        self.text = " ".join(sorted(self.tokens))
        self.masks = _positions(self.text)


def token_set_score(a: Prepared, b: Prepared, floor: int = 0) -> int:
    """Best of the three ratios. A pair that cannot reach ``floor`` may return less than its score.

    The shared tokens are a common prefix of all three strings, so two of the ratios follow
    from lengths alone, and only the remainders are compared character by character.
    """
    if not a.tokens or not b.tokens:
        return 0
    common = a.tokens & b.tokens
    if common:
        if len(common) in (len(a.tokens), len(b.tokens)):
            return 100
        rest_a = " ".join(sorted(a.tokens - common))
        rest_b = " ".join(sorted(b.tokens - common))
        sect = len(" ".join(common))
        m, n = sect + 1 + len(rest_a), sect + 1 + len(rest_b)
        best = max(_score(sect, sect, m), _score(sect, sect, n))
        prefix = sect + 1
    else:
        rest_a, rest_b = a.text, b.text
        m, n, best, prefix = len(rest_a), len(rest_b), 0, 0
    bound = _score(prefix + min(len(rest_a), len(rest_b)), m, n)
    if bound <= best or bound < floor:
        return best
    masks = _positions(rest_a) if common else a.masks
    return max(best, _score(prefix + _lcs(masks, len(rest_a), rest_b), m, n))


@F.pandas_udf(T.IntegerType())
def _token_set_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(
        [
            None if x is None or y is None else token_set_score(Prepared(x), Prepared(y))
            for x, y in zip(a, b)
        ],
        dtype="Int32",
    )


def token_set_ratio(a: Column, b: Column) -> Column:
    return _token_set_ratio(a, b)


_BEST = T.ArrayType(
    T.StructType([T.StructField("score", T.IntegerType()), T.StructField("idx", T.IntegerType())])
)
_LETTERS = 64
_WORD = 64  # text that one machine word can hold the positions of
_LONG = 512  # candidates beyond this are compared one by one


def _letter_counts(text: str) -> np.ndarray:
    """How often each letter occurs, spaces left out, letters taken by their code point modulo 64."""
    points = np.frombuffer(text.replace(" ", "").encode("utf-32-le", "replace"), np.uint32)
    return np.bincount(points % _LETTERS, minlength=_LETTERS)


def _lcs_many(text: str, others: list[str]) -> np.ndarray:
    """``_lcs`` of one text with many, a word operation per column of characters."""
    masks = _positions(text)
    found = np.zeros(len(others), np.int64)
    if not text:
        return found
    if len(text) > _WORD or len(others) < 6:
        return np.array([_lcs(masks, len(text), x) for x in others], np.int64)
    at = [i for i, x in enumerate(others) if len(x) <= _LONG]
    if len(at) < len(others):
        for i, x in enumerate(others):
            if len(x) > _LONG:
                found[i] = _lcs(masks, len(text), x)
    if not at:
        return found
    chars = np.array([others[i] for i in at])
    codes = chars.view(np.uint32).reshape(len(at), -1)  # short texts end in zeros, which match nothing
    known = [ord(c) for c in masks]
    table = np.zeros(max(int(codes.max()), *known) + 1, np.uint64)
    table[known] = list(masks.values())
    row = np.full(len(at), (1 << len(text)) - 1, np.uint64)
    for column in codes.T:
        hits = row & table[column]
        row = (row + hits) | (row - hits)  # what is carried beyond the text is cut off below
    left = np.bitwise_count(row & np.uint64((1 << len(text)) - 1))
    found[at] = len(text) - left.astype(np.int64)
    return found


def _rounded(shared: np.ndarray, total: np.ndarray) -> np.ndarray:
    return np.rint(100 * (2 * shared / np.maximum(total, 1))).astype(np.int64)


class Chunk:
    """Candidates prepared once: an inverted index of their tokens, and the counts of their letters."""

    def __init__(self, options: list[str]):
        self.options = [Prepared(o) for o in options]
        places: dict[str, list[int]] = {}
        for i, option in enumerate(self.options):
            for token in option.tokens:
                places.setdefault(token, []).append(i)
        self.by_token = {token: np.array(at, np.int32) for token, at in places.items()}
        self.size = np.array([len(o.text) for o in self.options], np.int64)
        self.n_tokens = np.array([len(o.tokens) for o in self.options], np.int64)
        # counts fit a byte unless a candidate is long; a letter per row
        kind = np.uint8 if self.size.max(initial=0) < 256 else np.int32
        self.letters = np.zeros((_LETTERS, len(self.options)), kind)
        for i, option in enumerate(self.options):
            self.letters[:, i] = _letter_counts(option.text)

    def _letters_in_both(self, text: str) -> np.ndarray:
        both = np.zeros(len(self.options), np.int32)
        counts, most = _letter_counts(text), np.iinfo(self.letters.dtype).max
        for letter in np.flatnonzero(counts).tolist():
            both += np.minimum(self.letters[letter], self.letters.dtype.type(min(int(counts[letter]), most)))
        return both

    def best(self, value: Prepared, threshold: int) -> tuple[int, int]:
        """Score and index of the first best candidate that reaches the threshold, else (-1, -1).

        The inverted index gives the shared tokens of all candidates. With them two of the three ratios
        follow from lengths; the third is bounded by the letters that the remainders have in common.
        Candidates are compared from the highest bound on, until the bound is below the best score.
        """
        if not value.tokens:
            return -1, -1
        shared, count = (np.zeros(len(self.options), np.int32) for _ in range(2))
        for token in value.tokens:
            at = self.by_token.get(token)
            if at is not None:
                shared[at] += len(token)
                count[at] += 1
        spaces = np.minimum(self.n_tokens, len(value.tokens)) - 1 - count
        prefix = np.where(count > 0, shared + count, 0)
        common = prefix + self._letters_in_both(value.text) - shared + np.maximum(spaces, 0)
        total = self.size + len(value.text)
        bounds = np.ceil(200 * common / np.maximum(total, 1))
        met = np.flatnonzero(count)
        plain = np.zeros(len(self.options), np.int64)
        if len(met):
            sect = prefix[met] - 1
            plain[met] = np.maximum(_rounded(sect, sect + self.size[met]), _rounded(sect, sect + len(value.text)))
            whole = (count[met] == len(value.tokens)) | (count[met] == self.n_tokens[met])
            plain[met[whole]] = 100
            bounds[met] = np.maximum(bounds[met], plain[met])
        bounds[self.n_tokens == 0] = -1
        bounds = bounds.astype(np.int16)
        score, index, place, step = -1, -1, 0, 16
        order = np.flatnonzero(bounds >= max(threshold, 0))
        order = order[np.argsort(-bounds[order], kind="stable")]
        if len(met) and plain.max() >= threshold:
            score = int(plain.max())
            index = int(np.argmax(plain == score))
        while place < len(order):
            some = order[place : place + step]
            some = some[bounds[some] >= max(threshold, score)]
            if not len(some):
                break
            got = self._scores(value, some, plain, prefix, total)
            top = int(got.max())
            if top >= max(threshold, score):
                first = int(some[got == top].min())
                index = first if top > score else min(index, first)
                score = top
            place, step = place + step, min(4 * step, 4096)
        return score, index

    def _scores(self, value: Prepared, some: np.ndarray, plain: np.ndarray, prefix: np.ndarray, total: np.ndarray) -> np.ndarray:
        """The scores of some candidates: by text without common tokens, by remainders with them."""
        lcs, groups = np.zeros(len(some), np.int64), {}
        for k, i in enumerate(some.tolist()):
            option = self.options[i]
            if prefix[i] == 0:
                mine, theirs = value.text, option.text
            else:
                mine = " ".join(sorted(value.tokens - option.tokens))
                theirs = " ".join(sorted(option.tokens - value.tokens))
            places, texts = groups.setdefault(mine, ([], []))
            places.append(k)
            texts.append(theirs)
        for mine, (places, texts) in groups.items():
            lcs[places] = _lcs_many(mine, texts)
        # a whole side is shared: its remainder is empty and ``plain`` has its score
        return np.maximum(plain[some], np.where(plain[some] < 100, _rounded(prefix[some] + lcs, total[some]), 0))


def best_in_chunk(threshold: int):
    """UDF (keys, candidate keys) -> [(score, index of the first best candidate)], -1 below the
    threshold."""

    @F.pandas_udf(_BEST)
    def scorer(keys: pd.Series, candidates: pd.Series) -> pd.Series:
        out, ready = [], {}
        for group, options in zip(keys, candidates):
            # rows of a task often have the same chunk
            if (chunk := ready.get(tuple(options))) is None:
                ready = {tuple(options): Chunk(list(options))}
                (chunk,) = ready.values()
            found = [chunk.best(Prepared(key), threshold) for key in group]
            out.append([{"score": s, "idx": i} for s, i in found])
        return pd.Series(out)

    return scorer


@F.pandas_udf(T.ArrayType(T.StringType()))
def _tokens(texts: pd.Series) -> pd.Series:
    return pd.Series([None if x is None else sorted(Prepared(x).tokens) for x in texts])


def tokens_of(text: Column) -> Column:
    """The distinct tokens that the ratio compares, sorted."""
    return _tokens(text)
