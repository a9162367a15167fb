"""Token counts of every prefix of a text (operator 11).

A merge of neighbours never crosses the end of a token that stays, so the first tokens of a text are the tokens
of what they cover, and tokens in a row are the encoding of their text if every two neighbours are that of
theirs. The encoding of a prefix is therefore that of a shorter prefix and one last token: for each place the
dynamic programme finds the only token that ends there and may follow the last token of what is before it.
It runs from place to place, so its time follows the length of the text.

Neighbouring characters that stand together in no piece of the model never merge. Texts are cut there, and
each different part of a batch of texts goes through the programme once.

A document's row holds its total, and for each character the change that it makes to the count (``steps``,
one signed byte, or four where a change does not fit), with the count at every ``BLOCK`` characters (``marks``).
``prefix_tokens`` and ``longest_prefix`` answer from these, without the model. Counts can fall from one prefix to the next:
the longest prefix within a budget is the longest of all that are within it.

Null text: empty. Empty text: no tokens, no steps. Null ids and repeated rows: a row each, as given. Only the two
columns named are read, so others may be called anything. Empty table: empty result. Very long texts: a few
arrays as long as the text, in its task.
"""

from __future__ import annotations

from array import array
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skilltide.llm._rows import ship_package
from skilltide.llm._words import list_array
from skilltide.session import scratch_dir

BLOCK = 4096
SLICE_CHARS = 1 << 20
CACHE = 700_000
CACHED_CHARS = 64

_NORMAL, _BYTE, _BPE = 1, 6, 2
_SPACE = "▁"


class PieceModel:
    """The pieces and merges of a sentencepiece BPE model with byte fallback and no normalisation."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        trained, rules = model.trainer_spec, model.normalizer_spec
        plain = not rules.precompiled_charsmap and not rules.remove_extra_whitespaces and rules.add_dummy_prefix and rules.escape_whitespaces
        kinds = {p.type for p in model.pieces[3:]}
        if trained.model_type != _BPE or not trained.byte_fallback or not plain or trained.treat_whitespace_as_suffix or kinds - {_NORMAL, _BYTE}:
            raise ValueError(f"{path}: only BPE models with byte fallback, without normalisation and symbols of the user")
        self.score = {p.piece: p.score for p in model.pieces if p.type == _NORMAL}
        # the ends of pieces: a text that is none is the end of no longer token
        self.ends = {piece[i:] for piece in self.score for i in range(len(piece))}

        letters = sorted({c for piece in self.score for c in piece})
        self.letter = np.zeros(0x110000, np.uint16 if len(letters) < 65_535 else np.uint32)
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        n = {c: i + 1 for i, c in enumerate(letters)}
        self.meet = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        for piece in self.score:
            for a, b in zip(piece, piece[1:], strict=False):
                self.meet[n[a], n[b]] = True
        self.follow: dict[tuple[str, str], bool] = {}

    def merged(self, text: str) -> list[str]:
        """The parts of a short text after all merges: the best score first, the leftmost of equals."""
        parts = list(text)
        while True:
            best, at = None, 0
            for k in range(len(parts) - 1):
                score = self.score.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def may_follow(self, token: str, before: str) -> bool:
        """Whether the two are the encoding of their text. ``before`` is empty at the beginning."""
        if len(self.follow) > CACHE:
            self.follow.clear()
        known = self.merged(before + token) == ([before, token] if before else [token])
        self.follow[before, token] = known
        return known

    def counts(self, text: str) -> list[int]:
        """The number of tokens of each prefix of a part, from the empty one on."""
        score, ends, follow = self.score, self.ends, self.follow
        counts, last = [0], [""]
        for i in range(1, len(text) + 1):
            token = text[i - 1]
            start, found = i - 1, []
            while True:
                if token in score or start == i - 1:
                    found.append((start, token))
                start -= 1
                if start < 0 or (token := text[start:i]) not in ends:
                    break
            for start, token in reversed(found):
                known = follow.get((last[start], token))
                if known or known is None and self.may_follow(token, last[start]):
                    counts.append(counts[start] + (1 if token in score else len(token.encode())))
                    last.append(token)
                    break
            else:
                raise ValueError(f"no token ends at character {i} of {text[:80]!r}")
        return counts


class Counter(dict):
    """Steps of the parts of texts, as bytes; None where one does not fit into a byte."""

    def __init__(self, model: PieceModel):
        super().__init__()
        self.model = model

    def _steps(self, part: str) -> list[int]:
        counts = self.model.counts(part)
        return [b - a for a, b in pairwise(counts)]

    def __missing__(self, part: str) -> bytes | None:
        steps = self._steps(part)
        found = array("b", steps).tobytes() if max(steps) < 120 and min(steps) > -120 else None
        if len(part) <= CACHED_CHARS:
            self[part] = found
        return found

    def texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The steps of all texts in a row, and where each text begins (one more than texts)."""
        if len(self) > CACHE:
            self.clear()
        # the model puts a space before a text that is not empty
        whole = "".join([_SPACE + x for x in texts if x]).replace(" ", _SPACE)
        sizes = np.array([len(x) for x in texts], np.int64)
        at = np.concatenate([[0], np.cumsum(sizes)])
        if not whole:
            return np.zeros(0, np.int8), at
        letter = self.model.letter[np.frombuffer(whole.encode("utf-32-le"), np.uint32)]
        cut = np.ones(len(whole), bool)
        cut[1:] = ~self.model.meet[letter[:-1], letter[1:]]
        given = np.cumsum(sizes[sizes > 0] + 1) - sizes[sizes > 0] - 1
        cut[given] = True
        starts = np.flatnonzero(cut).tolist()
        parts = [whole[a:b] for a, b in zip(starts, [*starts[1:], len(whole)], strict=True)]
        found = [self[x] for x in parts]
        if None in found:
            steps = np.array([y for x in parts for y in self._steps(x)], np.int32)
        else:
            steps = np.frombuffer(b"".join(found), np.int8).copy()
        # the step of that space is the first character's
        steps[given + 1] += steps[given]
        return np.delete(steps, given), at


@lru_cache(maxsize=2)
def _counter(path: str) -> Counter:
    """One per worker process."""
    return Counter(PieceModel(path))


def _groups(texts: list[str]):
    """Ranges of texts with about ``SLICE_CHARS`` characters; a longer text is one of its own."""
    i = held = 0
    for j, text in enumerate(texts):
        if j > i and held + len(text) > SLICE_CHARS:
            yield i, j
            i, held = j, 0
        held += len(text)
    if i < len(texts):
        yield i, len(texts)


def _scan(path: str):
    def run(batches):
        counter = _counter(path)
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            for i, j in _groups(texts):
                steps, at = counter.texts(texts[i:j])
                sums = np.concatenate([[0], np.cumsum(steps, dtype=np.int64)])
                marks = -(-np.diff(at) // BLOCK)
                place = np.arange(marks.sum()) - np.repeat(np.cumsum(marks) - marks, marks)
                of = np.repeat(at[:-1], marks)
                n, width = j - i, steps.itemsize
                data = pa.Array.from_buffers(
                    pa.large_binary(), n, [None, pa.py_buffer((at * width).tobytes()), pa.py_buffer(np.ascontiguousarray(steps).tobytes())]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[i:j], batch.column(2)[i:j], pa.array(np.diff(at)), pa.array(np.diff(sums[at])), pa.array(np.full(n, width), pa.int32()),
                        list_array(sums[of + place * BLOCK] - sums[of], marks, pa.int64()), data.cast(pa.binary()),
                    ],
                    ["id", "n_bytes", "n_chars", "n_tokens", "width", "marks", "steps"],
                )

    return run


def prefix_counts(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The saved counts of all prefixes: id, n_bytes (UTF-8), n_chars (code points), n_tokens, width, marks, steps.
    ``model`` is a file that every executor has."""
    spark = docs.sparkSession
    ship_package(spark)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_bytes long, n_chars long, n_tokens long, width int, marks array<long>, steps binary"
    found, path = rows.mapInArrow(_scan(model), schema), scratch_dir(spark, "prefix-counts")
    found.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(found.schema).parquet(path)


def _count_at(batches):
    for batch in batches:
        out = []
        for steps, width, marks, at, size in zip(*(batch.column(c).to_pylist() for c in ("steps", "width", "marks", "at", "n_chars")), strict=True):
            if at is None:
                out.append(None)
                continue
            at = min(max(at, 0), size)
            block = min(at // BLOCK, max(len(marks) - 1, 0))
            part = np.frombuffer(steps, np.int8 if width == 1 else np.int32, at - block * BLOCK, block * BLOCK * width) if size else np.zeros(0)
            out.append((marks[block] if marks else 0) + int(part.sum(dtype=np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column("at"), pa.array(out, pa.int64())], ["id", "at", "tokens"])


def prefix_tokens(counts: DataFrame, at: Column | int) -> DataFrame:
    """(id, at, tokens): the tokens of the first ``at`` characters of each text, of the whole text beyond its end."""
    kind = counts.schema["id"].dataType.simpleString()
    place = (F.lit(at) if isinstance(at, int) else at).cast("long")
    rows = counts.select("id", "steps", "width", "marks", place.alias("at"), "n_chars")
    return rows.mapInArrow(_count_at, f"id {kind}, at long, tokens long")


def _cut_at(batches):
    for batch in batches:
        chars, tokens = [], []
        for steps, width, budget in zip(*(batch.column(c).to_pylist() for c in ("steps", "width", "budget")), strict=True):
            if budget is None or budget < 0:
                chars.append(None)
                tokens.append(None)
                continue
            sums = np.concatenate([[0], np.cumsum(np.frombuffer(steps, np.int8 if width == 1 else np.int32), dtype=np.int64)])
            end = int(np.flatnonzero(sums <= budget)[-1])
            chars.append(end)
            tokens.append(int(sums[end]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column("budget"), pa.array(chars, pa.int64()), pa.array(tokens, pa.int64())], ["id", "budget", "n_chars", "n_tokens"]
        )


def longest_prefix(counts: DataFrame, budget: Column | int) -> DataFrame:
    """(id, budget, n_chars, n_tokens): the longest prefix of each text that has at most ``budget`` tokens; null
    where the budget is null or negative."""
    kind = counts.schema["id"].dataType.simpleString()
    most = (F.lit(budget) if isinstance(budget, int) else budget).cast("long")
    rows = counts.select("id", "steps", "width", most.alias("budget"))
    return rows.mapInArrow(_cut_at, f"id {kind}, budget long, n_chars long, n_tokens long")
