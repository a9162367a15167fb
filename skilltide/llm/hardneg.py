"""Hard negatives by LEMP's coordinate pruning (operator 12).

Rows are dealt by the length of their vectors into buckets of about ``BUCKET`` vector elements (2,048 rows of 64). A bucket holds its greatest
length and, for each coordinate, its rows in order of the coordinate of their direction. A score that an anchor
asks for, divided by its length and the bucket's, bounds the angle to the rows that can reach it; that bounds each
coordinate of their direction (Teflioudi, Gemulla and Mykytiuk, "LEMP", 2015). The ranges of the anchor's ``FOCUS``
largest coordinates are looked up in the sorted lists, the rows of the shortest are kept if they lie in the others, and
only those get their exact integer product. Buckets come longest first, so the score asked for rises early.

Anchors are packed into blocks and meet all rows in chunks of ``CHUNK`` buckets, a group per block and chunk: a stated
query set against all rows. A group holds one block and one chunk, whatever is hot, and hands on the best of its chunk
per anchor; Spark takes the best of those. The first round finds positives, the second the negatives in the score
range of each positive.

Scores: components are floor(256 x); products are exact, in 53 bits of doubles where the lengths allow it, in Python's
integers where not. A score beyond 64 bits is an error, as is a component of which 256 x is no finite double.

Rows with a null id, label or vector, or a null or non-finite component, take no part. Vectors of different lengths are
not compared. Repeated rows are rows of their own, also of equal ids. Ties: smaller id first. Negative positive scores
leave no range, so such positives have no negatives. Empty table: empty result. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skilltide.llm._rows import ship_package
from skilltide.session import saved

BUCKET = 1 << 17
CHUNK = 16
ANCHORS = 1 << 17
FOCUS = 4
SLACK = 1e-9


class Bucket:
    """Rows of similar length: integer vectors, ids, labels, and directions in order of each coordinate."""

    def __init__(self, row, ids, labels, vectors: np.ndarray):
        self.row, self.ids, self.labels, self.vectors = row, ids, labels, vectors
        self.top = float(np.abs(vectors).max(initial=0.0))
        lengths = np.linalg.norm(vectors, axis=1)
        self.length = float(lengths.max(initial=0.0))
        self.directions = vectors / np.where(lengths > 0, lengths, 1.0)[:, None]
        self.order = np.argsort(self.directions, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.directions, self.order, axis=0)

    def candidates(self, anchor: Anchor, least: float) -> np.ndarray | None:
        """Places of the rows whose score can reach ``least``; None for all."""
        if least <= 0:
            return None
        reach = anchor.length * self.length
        if not np.isfinite(reach):
            return None
        cosine = least / reach * (1 - SLACK) if reach > 0 else 2.0
        if cosine > 1:
            return np.zeros(0, np.int64)
        spread = np.arccos(cosine)
        # the angle to an axis differs from the anchor's by the spread at most
        low = np.cos(np.minimum(anchor.angles + spread, np.pi)) - SLACK
        high = np.cos(np.maximum(anchor.angles - spread, 0.0)) + SLACK
        best, places = None, []
        for f, a, b in zip(anchor.focus, low, high, strict=True):
            i, j = np.searchsorted(self.sorted[:, f], a), np.searchsorted(self.sorted[:, f], b, side="right")
            places.append((i, j))
            if best is None or j - i < places[best][1] - places[best][0]:
                best = len(places) - 1
        if best is None or places[best][1] - places[best][0] > 0.9 * len(self.ids):
            return None
        found = self.order[slice(*places[best]), anchor.focus[best]]
        for k, f in enumerate(anchor.focus):
            if k != best:
                values = self.directions[found, f]
                found = found[(values >= low[k]) & (values <= high[k])]
        return found

    def scores(self, anchor: Anchor, at: np.ndarray) -> np.ndarray:
        some = self.vectors[at]
        if anchor.top * self.top * max(some.shape[1], 1) < 2.0**53:
            return (some @ anchor.vector).astype(np.int64)
        whole = [int(x) for x in anchor.vector]
        return np.array([sum(int(x) * y for x, y in zip(v, whole, strict=True)) for v in some], object).astype(np.int64)


class Anchor:
    def __init__(self, row: int, label: int, vector: np.ndarray, scores: list[int]):
        self.row, self.label, self.vector, self.scores = row, label, vector, scores
        self.top = float(np.abs(vector).max(initial=0.0))
        self.length = float(np.linalg.norm(vector))
        direction = vector / self.length if self.length > 0 else vector
        self.focus = np.argsort(-np.abs(direction), kind="stable")[:FOCUS]
        self.angles = np.arccos(np.clip(direction[self.focus], -1.0, 1.0))


def _best(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` first by score descending, then id."""
    if len(scores) > n:
        # no score below the n-th can be among them
        least = np.partition(scores, len(scores) - n)[len(scores) - n]
        some = np.flatnonzero(scores >= least)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort([ids[some], -scores[some]])][:n]


class Kept:
    """The first ``n`` rows so far with scores from ``low`` to ``high``."""

    def __init__(self, n: int, low: int | None = None, high: int | None = None):
        self.n, self.low, self.high = n, low, high
        self.scores, self.ids, self.rows = (np.zeros(0, np.int64) for _ in range(3))

    def least(self) -> float:
        """The score below which no row can come in."""
        full = float(self.scores[-1]) if len(self.scores) == self.n else -np.inf
        return max(full, -np.inf if self.low is None else float(self.low))

    def add(self, scores, ids, rows) -> None:
        inside = scores >= self.least()
        if self.high is not None:
            inside &= scores <= self.high
        if not inside.any():
            return
        scores, ids, rows = scores[inside], ids[inside], rows[inside]
        at = _best(scores, ids, self.n)
        scores, ids, rows = (np.concatenate([x, y[at]]) for x, y in ((self.scores, scores), (self.ids, ids), (self.rows, rows)))
        at = _best(scores, ids, self.n)
        self.scores, self.ids, self.rows = scores[at], ids[at], rows[at]


def _unpacked(binary: bytes, n: int, dim: int) -> np.ndarray:
    kind = np.int16 if len(binary) == 2 * n * dim else np.float64
    return np.frombuffer(binary, kind).reshape(n, dim).astype(np.float64)


def _buckets(table: pa.Table) -> list[Bucket]:
    found = []
    for row, ids, labels, vectors, dim in zip(*(table.column(c).to_pylist() for c in ("row", "ids", "labels", "vectors", "dim")), strict=True):
        found.append(Bucket(np.array(row, np.int64), np.array(ids, np.int64), np.array(labels, np.int64), _unpacked(vectors, len(row), dim)))
    return sorted(found, key=lambda b: -b.length)


def _anchors(table: pa.Table) -> list[Anchor]:
    found = []
    for rows, labels, vectors, dim, scores in zip(*(table.column(c).to_pylist() for c in ("row", "labels", "vectors", "dim", "scores")), strict=True):
        values = _unpacked(vectors, len(rows), dim)
        found += [Anchor(r, y, v, s or []) for r, y, v, s in zip(rows, labels, values, scores, strict=True)]
    return found


_FOUND = pa.schema([("row", pa.int64()), ("positive_score", pa.int64()), ("id", pa.int64()), ("other", pa.int64()), ("score", pa.int64())])


def _search(n: int, low: tuple[int, int] | None, high: tuple[int, int] | None):
    """The best of a chunk for each anchor of a block: of the anchor's label if no range is given, else of other
    labels with scores in the range of each distinct score of its positives."""

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        anchors = _anchors(left)
        kept = []
        for anchor in anchors:
            if low is None:
                kept.append({None: Kept(n)})
            else:
                # ceil(low s) and floor(high s), in integers
                ranges = {s: (-(-low[0] * s // low[1]), high[0] * s // high[1]) for s in set(anchor.scores)}
                kept.append({s: Kept(n, a, b) for s, (a, b) in ranges.items() if a <= b})
        for bucket in _buckets(right) if anchors else ():
            for anchor, sought in zip(anchors, kept, strict=True):
                if not sought:
                    continue
                at = bucket.candidates(anchor, min(x.least() for x in sought.values()))
                if at is not None and not len(at):
                    continue
                rows, ids, labels = (x if at is None else x[at] for x in (bucket.row, bucket.ids, bucket.labels))
                fits = (labels == anchor.label) & (rows != anchor.row) if low is None else labels != anchor.label
                at = np.flatnonzero(fits) if at is None else at[fits]
                if len(at):
                    scores = bucket.scores(anchor, at)
                    for x in sought.values():
                        x.add(scores, ids[fits], rows[fits])
        for anchor, sought in zip(anchors, kept, strict=True):
            for s, x in sought.items():
                out += [(anchor.row, s, i, r, y) for i, r, y in zip(x.ids.tolist(), x.rows.tolist(), x.scores.tolist(), strict=True)]
        columns = list(zip(*out, strict=True)) if out else [[]] * len(_FOUND)
        return pa.table([pa.array(c, t.type) for c, t in zip(columns, _FOUND, strict=True)], schema=_FOUND)

    return run


def _pack(elements: int):
    """Rows in order, in blocks of one dimension and about so many vector elements."""

    def block(rows: list) -> dict:
        packed = np.array([r["vector"] for r in rows], np.float64).reshape(len(rows), -1)
        if np.abs(packed).max(initial=0.0) < 2**15:
            vectors = packed.astype(np.int16)
        else:
            vectors = packed
        return {
            "row": [r["row"] for r in rows], "ids": [r["id"] for r in rows], "labels": [r["label"] for r in rows], "dim": packed.shape[1],
            "vectors": vectors.tobytes(), "scores": [r.get("scores") for r in rows],
        }

    def run(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for r in batch.to_pylist():
                dim = len(r["vector"])
                some = held.setdefault(dim, [])
                some.append(r)
                if len(some) * max(dim, 1) >= elements:
                    yield pa.RecordBatch.from_pylist([block(held.pop(dim))], schema=_BLOCK)
        yield pa.RecordBatch.from_pylist([block(x) for x in held.values()], schema=_BLOCK)

    return run


_BLOCK = pa.schema([
    ("row", pa.list_(pa.int64())), ("ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.int64())), ("dim", pa.int64()), ("vectors", pa.binary()),
    ("scores", pa.list_(pa.list_(pa.int64()))),
])
_BLOCK_SQL = "row array<long>, ids array<long>, labels array<long>, dim long, vectors binary, scores array<array<long>>"


def _numbered(blocks: DataFrame, per: int, name: str) -> DataFrame:
    """Saved blocks with a number per ``per`` of them within their task's file."""
    return saved(blocks.withColumn("number", F.monotonically_increasing_id()).withColumn("part", F.floor(F.col("number") / per)), name)


def _met(anchors: DataFrame, chunks: DataFrame, search) -> DataFrame:
    """Every block of anchors with every chunk of its dimension, a group each."""
    keys = chunks.select("dim", F.col("part").alias("chunk")).distinct()
    blocks = anchors.select("dim", F.col("number").alias("block")).distinct()
    # a row per block of anchors and chunk: numbers only
    pairs = saved(keys.join(blocks, "dim"), "block-pairs")
    pair = lambda side: [F.col(c).alias(f"{side}_{c}") for c in ("dim", "block", "chunk")]
    left = anchors.join(pairs.select(*pair("left")), F.col("number") == F.col("left_block")).select("left_block", "left_chunk", *_BLOCK.names)
    right = chunks.join(pairs.select(*pair("right")), (F.col("part") == F.col("right_chunk")) & (F.col("dim") == F.col("right_dim"))).select("right_block", "right_chunk", *_BLOCK.names)
    found = left.groupBy("left_block", "left_chunk").cogroup(right.groupBy("right_block", "right_chunk")).applyInArrow(
        search, "row long, positive_score long, id long, other long, score long"
    )
    return saved(found, "found")


def _whole(vector: Column) -> Column:
    """floor(256 x) of each component, as a double; doubles from 2**53 on are whole numbers."""

    def one(x):
        y = x.cast("double") * F.lit(256.0)
        small = F.abs(y) < F.lit(2.0**53)
        far = F.when(F.abs(y) < float("inf"), y).otherwise(F.raise_error(F.lit("256 times a component is no finite double")).cast("double"))
        return F.when(small, F.floor(F.when(small, y)).cast("double")).otherwise(far)

    return F.transform(vector, one)


def hard_negatives(
    rows: DataFrame, is_anchor: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", *, positives: int = 5,
    negatives: int = 3, low: tuple[int, int] = (50, 100), high: tuple[int, int] = (95, 100),
) -> DataFrame:
    """For each anchor and each of its first ``positives`` rows of its label, the first ``negatives`` rows of other labels
    with scores from ``low`` to ``high`` times the positive's: anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score. ``is_anchor`` is a condition on the columns of ``rows``; ids and labels are integers."""
    spark = rows.sparkSession
    ship_package(spark)
    vector = F.col(f"`{vector_col}`")
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    usable = rows.filter(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label_col}`").isNotNull() & vector.isNotNull() & ~F.coalesce(odd, F.lit(False)))
    named = saved(
        usable.select(
            F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"), _whole(vector).alias("vector"),
            F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
        ).withColumn("row", F.monotonically_increasing_id()).withColumn(
            "length", F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
        ),
        "vectors",
    )
    dealt = named.repartitionByRange(F.desc("length"), F.col("row")).sortWithinPartitions(F.desc("length"), "row")
    chunks = _numbered(dealt.select("id", "label", "vector", "row").mapInArrow(_pack(BUCKET), _BLOCK_SQL), CHUNK, "buckets")

    asked = named.filter("anchor").select("id", "label", "vector", "row")
    blocks = _numbered(asked.mapInArrow(_pack(ANCHORS), _BLOCK_SQL), 1, "anchors")
    by_score = Window.partitionBy("row").orderBy(F.desc("score"), "id", "other")
    best = saved(
        _met(blocks, chunks, _search(positives, None, None)).withColumn("place", F.row_number().over(by_score)).filter(F.col("place") <= positives)
        .select("row", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), "place"),
        "positives",
    )
    # at most ``positives`` scores per anchor
    scores = best.groupBy(F.col("row").alias("of")).agg(F.collect_set("positive_score").alias("scores"))
    again = asked.join(scores, F.col("row") == F.col("of")).select("id", "label", "vector", "row", "scores")
    blocks = _numbered(again.mapInArrow(_pack(ANCHORS), _BLOCK_SQL), 1, "scored-anchors")
    by_score = Window.partitionBy("row", "positive_score").orderBy(F.desc("score"), "id", "other")
    found = (
        _met(blocks, chunks, _search(negatives, low, high)).withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= negatives)
    )
    ids = asked.select(F.col("row").alias("of"), F.col("id").alias("anchor_id"))
    return (
        best.join(found.select("row", "positive_score", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")), ["row", "positive_score"])
        .join(ids, F.col("row") == F.col("of"))
        .select("anchor_id", "positive_id", F.col("rank").cast("int"), "negative_id", "positive_score", "negative_score")
    )
