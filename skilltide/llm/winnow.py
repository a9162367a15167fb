"""Benchmark decontamination by winnowing (operator 1).

A fingerprint is the hash of ``k`` neighbouring words; of every ``window - k + 1`` neighbouring
fingerprints the least are kept (Schleimer et al., "Winnowing", 2003). Two texts that share
``window`` words in a row share all fingerprints in them, so they keep the same least one: no
shared span of that length is missed. Fingerprints of documents are joined with those of the
items; a hit is extended to the spans of ``window`` words around it, which are joined with the
items' spans. An item with fewer words is one span of its own, looked up by all runs of its length.

Fingerprints of documents that are in no item are dropped before the shuffle by a bitmap of fixed
size (``2 ** BITMAP_BITS`` bits, built by a grouped OR). It never drops one that is in an item, and
the join follows whatever it lets through. Spans are unique before items are attached, so
a span that many items share costs a row per document, not one per item and occurrence.

A null text has no words; a text or item without words has no hits. Repeated rows and ids are
rows of their own. Items with a null id are named by an empty string. An empty table of items
leaves every document clean.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skilltide.llm import _words as w
from skilltide.llm._rows import fresh
from skilltide.session import saved

WINDOW = 10
K = 5
BITMAP_BITS = 24


def _runs(first: np.ndarray, total: int, n: int) -> np.ndarray:
    """Which of the ``total`` word positions begin ``n`` words of one text."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    ok = np.zeros(total, bool)
    if total >= n:
        ok[: total - n + 1] = text[: total - n + 1] == text[n - 1 :]
    return ok


def selected(h: np.ndarray, first: np.ndarray, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the kept fingerprints and all fingerprints; a tie keeps both."""
    prints = w.chain(h, k)
    span = window - k + 1
    whole = _runs(first, len(h), window)[: max(0, len(h) - window + 1)]
    kept = np.zeros(len(prints), bool)
    if len(whole):
        least = prints[: len(whole)].copy()
        for i in range(1, span):
            np.minimum(least, prints[i : i + len(whole)], out=least)
        for i in range(span):
            part = slice(i, i + len(whole))
            kept[part] |= whole & (prints[part] == least)
    return np.flatnonzero(kept), prints


def _cut(part, at):
    words = w.cut_words(part, at, True, w.ALPHANUMERIC)
    return words.first, w.hash_words(part, words, True)


def _item_scan(k: int, window: int):
    """Per item: its kept fingerprints and its spans (length, hash)."""

    def run(batches):
        for batch in batches:
            data, texts = w.text_bytes(batch.column(1))
            prints, spans, lengths = [], [], []
            for i in range(len(texts) - 1):
                first, h = _cut(data[texts[i] : texts[i + 1]], np.array([0, texts[i + 1] - texts[i]]))
                n = min(len(h), window)
                spans.append(np.unique(w.chain(h, n).view(np.int64)) if n else np.zeros(0, np.int64))
                lengths.append(n)
                at, every = selected(h, first, k, window)
                prints.append(np.unique(every[at].view(np.int64)))
            lists = [
                w.list_array(np.concatenate(x) if x else np.zeros(0, np.int64), np.array([len(y) for y in x], np.int64), pa.int64())
                for x in (prints, spans)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *lists, pa.array(lengths, pa.int32())], ["item", "prints", "spans", "length"]
            )

    return run


def _doc_scan(k: int, window: int, bits: np.ndarray, short: list[int]):
    """Per document: its number of words, and around its fingerprints that may be in an item the spans
    (print, start, length, hash). Runs as long as a short item are their own print."""
    mask = np.uint64(len(bits) * 8 - 1)

    def maybe(values):
        at = (values & mask).astype(np.int64)
        return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1

    def run(batches):
        for batch in batches:
            data, texts = w.text_bytes(batch.column(1))
            counts, found = [], []
            for i, j in w.slices(texts):
                first, h = _cut(data[texts[i] : texts[j]], texts[i : j + 1] - texts[i])
                counts.append(np.diff(first))
                at, prints = selected(h, first, k, window)
                at = at[maybe(prints[at])]
                whole, spans = _runs(first, len(h), window), w.chain(h, window)
                rows = []
                for back in range(window - k + 1):
                    start = at - back
                    ok = (start >= 0) & whole[np.maximum(start, 0)]
                    start = start[ok]
                    rows.append((prints[at[ok]], start, np.full(len(start), window), spans[start]))
                for n in short:
                    start = np.flatnonzero(_runs(first, len(h), n))
                    runs = w.chain(h, n)[start]
                    ok = maybe(runs)
                    rows.append((runs[ok], start[ok], np.full(int(ok.sum()), n), runs[ok]))
                fp, start, length, span = (np.concatenate(x) for x in zip(*rows, strict=True))
                text = np.searchsorted(first, start, side="right") - 1
                order = np.argsort(text, kind="stable")
                found.append((
                    np.bincount(text, minlength=j - i), fp[order].view(np.int64), (start - first[text])[order],
                    length[order], span[order].view(np.int64),
                ))
            n, fp, start, length, span = (
                np.concatenate([x[c] for x in found]) if found else np.zeros(0, np.int64) for c in range(5)
            )
            ends = np.zeros(len(n) + 1, np.int32)
            np.cumsum(n, out=ends[1:])
            rows = pa.StructArray.from_arrays(
                [pa.array(fp, pa.int64()), pa.array(start, pa.int64()), pa.array(length, pa.int32()), pa.array(span, pa.int64())],
                ["print", "start", "length", "span"],
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(np.concatenate(counts) if counts else [], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends), rows)],
                ["doc_id", "mark", "n_words", "near"],
            )

    return run


def _bitmap(values: DataFrame) -> np.ndarray:
    """A bit per value, at its low bits: at most ``2 ** BITMAP_BITS`` bits, whatever the table's size."""
    place = F.col("print").bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))
    words = values.groupBy(F.shiftright(place, 5).alias("at")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, CAST(print & 31 AS INT))")).alias("bits")
    )
    out = np.zeros((1 << BITMAP_BITS) // 32, np.uint32)
    for at, bits in words.collect():
        out[at] = bits
    return out.view(np.uint8)


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text", *, window: int = WINDOW, k: int = K,
) -> tuple[DataFrame, DataFrame]:
    """Per document (row, doc_id, mark, n_words, n_hit, item_ids: sorted), and the spans hit
    (row, start, length, items): whose words are in an item. ``mark`` hashes the text."""
    taken = items.select(F.col(f"`{item_col}`").alias("item"), F.col(f"`{item_text}`").cast("string").alias("text"))
    kind = taken.schema["item"].dataType.simpleString()
    read = saved(taken.mapInArrow(_item_scan(k, window), f"item {kind}, prints array<long>, spans array<long>, length int"), "items")
    # a short item is looked up by itself
    prints = saved(
        read.select(F.explode(F.when(F.col("length") < window, F.col("spans")).otherwise(F.col("prints"))).alias("print")).distinct(),
        "item-prints",
    )
    spans = saved(
        read.select("item", F.col("length"), F.explode("spans").alias("span")).distinct(), "item-spans"
    )
    short = sorted(r[0] for r in read.filter((F.col("length") > 0) & (F.col("length") < window)).select("length").distinct().collect())

    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"), F.xxhash64(F.col(f"`{text_col}`")).alias("mark")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    near = "near array<struct<print: long, start: long, length: int, span: long>>"
    scanned = saved(
        rows.mapInArrow(_doc_scan(k, window, _bitmap(prints), short), f"doc_id {kind}, mark long, n_words long, {near}")
        .withColumn("row", F.monotonically_increasing_id()),
        "prints",
    )
    around = scanned.filter(F.size("near") > 0).select("row", F.explode("near").alias("x")).select("row", "x.*")
    met = saved(around.join(prints, "print", "left_semi").select("row", "start", "length", "span").distinct(), "print-hits")
    known = spans.select("length", "span").distinct()
    hits = saved(met.join(known, ["length", "span"], "left_semi"), "span-hits")

    # words under spans, which overlap: spans in order, each counted beyond the furthest end before it
    covered = F.expr(
        "aggregate(spans, named_struct('n', 0L, 'e', 0L), (a, s) -> named_struct("
        "'n', a.n + greatest(0L, s.start + s.length - greatest(s.start, a.e)), 'e', greatest(a.e, s.start + s.length)), a -> a.n)"
    )
    words = hits.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "length"))).alias("spans")).select("row", covered.alias("n_hit"))
    items_of = (
        hits.select("row", "length", "span").distinct().join(spans, ["length", "span"])
        .select("row", F.coalesce(F.col("item").cast("string"), F.lit("")).alias("item")).distinct()
        .groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("item_ids"))
    )
    found = saved(words.join(items_of, "row"), "contaminated")
    result = scanned.select("row", "doc_id", "mark", "n_words").join(found, "row", "left").select(
        "row", "doc_id", "mark", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )
    return result, hits


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without those that have words of a benchmark item; columns stay."""
    result, _ = contamination(docs, items, id_col, text_col, **options)
    hit = saved(result.filter("n_hit > 0").select(F.col("doc_id").alias("id_hit"), F.col("mark").alias("mark_hit")).distinct(), "hit")
    mark = fresh(docs, "mark_")
    marked = docs.withColumn(mark, F.xxhash64(F.col(f"`{text_col}`")))
    same = marked[id_col].eqNullSafe(hit["id_hit"]) & (marked[mark] == hit["mark_hit"])
    return marked.join(hit, same, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
