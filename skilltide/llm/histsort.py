"""Shards of near equal bytes by histogram sort (operator 3).

Keys are 64 bits: 40 of the text's hash, then 24 of the id's. Equal texts stand next to each other,
so they share a shard unless they are more than one can hold, and then they are divided by id.

Splitters are found before any text moves: each round counts, in every partition of a slim
table, the bytes and rows between probe keys; the driver adds up one row per probe and
narrows the bracket of each splitter (Solomonik and Kale, "Highly Scalable Parallel Sorting", 2010).
A splitter is done when the bytes below it are within ``tolerance`` of their target, or no key is
left to separate. Then rows are exchanged once, by cell: a shard is made of as many cells as it
takes for one to fit a task, and as the rows below each splitter are known, a row's slot is its
place in its cell plus a constant.

Null text: no bytes, size is the overhead only. Null ids are a value like others. Rows equal in id
and text have one key and stay together; ties in a cell are ordered by key and id. Empty table: empty
result with all columns. Input columns called like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skilltide.llm._rows import fresh, without
from skilltide.session import saved

SHARDS = 40
OVERHEAD = 16
TOLERANCE = 0.0005  # of a shard's bytes
CELL_BYTES = 64 << 20
PROBES = 31
LOW, HIGH = -(2**63), 2**63 - 1


def sort_key(id_col: Column, text_col: Column) -> Column:
    low = 0xFFFFFF
    return F.xxhash64(text_col).bitwiseAND(F.lit(~low)).bitwiseOR(F.xxhash64(id_col).bitwiseAND(F.lit(low)))


def _histogram(probes: np.ndarray):
    """Bytes and rows per interval between probes, one batch of sums per task."""

    def run(batches):
        size, rows = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
        for batch in batches:
            at = np.searchsorted(probes, batch.column(0).to_numpy(), side="right")
            rows += np.bincount(at, minlength=len(rows))
            np.add.at(size, at, batch.column(1).to_numpy())
        there = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.array(size[there]), pa.array(rows[there])], ["at", "bytes", "rows"])

    return run


def counts_below(slim: DataFrame, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact bytes and rows with a key below each probe, then of all."""
    sums = slim.mapInArrow(_histogram(probes), "at int, bytes long, rows long").groupBy("at").agg(F.sum("bytes"), F.sum("rows"))
    out = np.zeros((2, len(probes) + 1), np.int64)
    for at, size, rows in sums.collect():
        out[:, at] = size, rows
    return tuple(np.cumsum(out, axis=1))


def splitters(slim: DataFrame, targets: list[float], slack: list[float], total: tuple[int, int]) -> list[tuple[int, int, int]]:
    """For each target the key, and the bytes and rows below it, that come nearest."""
    low = [(LOW, 0, 0)] * len(targets)
    high = [(HIGH, *total)] * len(targets)

    def nearest(i):
        return min(low[i], high[i], key=lambda x: abs(x[1] - targets[i]))

    def is_open(i):
        return abs(nearest(i)[1] - targets[i]) > slack[i] and high[i][0] - low[i][0] > 1 and high[i][2] - low[i][2] > 1

    while left := [i for i in range(len(targets)) if is_open(i)]:
        each = max(1, min(PROBES, (1 << 18) // len(left)))
        asked = sorted({
            low[i][0] + max(1, (high[i][0] - low[i][0]) * j // (each + 1)) for i in left for j in range(1, each + 1)
        })
        size, rows = counts_below(slim, np.array(asked, np.int64))
        for i in left:
            at = int(np.searchsorted(size[: len(asked)], targets[i], side="right"))
            if at and asked[at - 1] > low[i][0]:
                low[i] = (asked[at - 1], int(size[at - 1]), int(rows[at - 1]))
            if at < len(asked) and asked[at] < high[i][0]:
                high[i] = (asked[at], int(size[at]), int(rows[at]))
    return [nearest(i) for i in range(len(targets))]


def _place(keys: np.ndarray, base: np.ndarray):
    @F.pandas_udf("cell int, base long")
    def place(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for key in batches:
            cell = np.searchsorted(keys, key.to_numpy(), side="right")
            yield pd.DataFrame({"cell": cell.astype(np.int32), "base": base[cell]})

    return place


def shards(
    docs: DataFrame, n_shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", *, overhead: int = OVERHEAD,
    tolerance: float = TOLERANCE, cell_bytes: int = CELL_BYTES,
) -> DataFrame:
    """``docs`` with ``size``, ``shard`` and ``slot`` (gapless from 0 in each shard)."""
    docs = without(docs, ["size", "shard", "slot"])
    text = F.col(f"`{text_col}`")
    key, size = sort_key(F.col(f"`{id_col}`"), text), (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("long")
    slim = saved(docs.select(key.alias("key"), size.alias("size")), "keys")
    total = slim.agg(F.coalesce(F.sum("size"), F.lit(0)).cast("long"), F.count("*")).first()
    share = total[0] / n_shards
    parts = max(1, -(-int(share) // cell_bytes))
    n = n_shards * parts
    found = splitters(
        slim, [i * total[0] / n for i in range(1, n)], [share * (tolerance if i % parts == 0 else 0.2 / parts) for i in range(1, n)], tuple(total)
    )
    edges = [(LOW, 0, 0), *found]
    for i in range(1, n):  # targets rise, so must splitters
        edges[i] = max(edges[i - 1], edges[i])
    base = np.array([x[2] - edges[i // parts * parts][2] for i, x in enumerate(edges)], np.int64)
    place = _place(np.array([x[0] for x in edges[1:]], np.int64), base)
    k, at, names = fresh(docs, "key_"), fresh(docs, "at_"), [F.col(f"`{c}`") for c in docs.columns]
    placed = docs.select("*", size.alias("size"), key.alias(k)).withColumn(at, place(F.col(k)))
    cell = F.col(f"{at}.cell")
    order = Window.partitionBy(cell).orderBy(F.col(k), F.col(f"`{id_col}`"))
    return placed.select(
        *names, "size", F.floor(cell / parts).cast("int").alias("shard"),
        (F.col(f"{at}.base") + F.row_number().over(order) - 1).cast("long").alias("slot"),
    )
