"""Near duplicates by bottom-k sketches of one hash function (operator 9).

1. ``scan``: per text its set of word shingles (64-bit hashes), of which the ``k`` least are its
   sketch. Equal sets get one class; only a class representative goes on, so a group of copies
   costs one row whatever its size.
2. Inverted lists: a retained value that only one class has is dropped. Two sets as alike as asked
   share at least ``m`` of ``k`` retained values (``least_shared``; all but a few pairs in a million
   at the limit itself, fewer with more similarity), so if each class is listed under its rarest
   ``k - m + 1`` values only, they still meet. Passages that many texts share
   are the frequent values, and rarely among those.
3. Overlaps: in each list all classes of a size are compared with the one whose values are shared most. The
   union of two sketches gives an estimate, pairs well below the limit go, and the rest is
   confirmed on full sets. Found links make components; lists that are one component are done. So a group of
   near copies costs a comparison per member, not one per pair.
4. Classes in the other lists are listed anew under values of their full sets, again the rarest, where the
   bounds are exact: a set must share all but a known number of its values, values of no other set count as lost, and
   of two alike sets the smaller has at most a few of those. Each list is again compared with one class first, the one
   that has least to itself, and in what is still open all pairs within the bounds are confirmed (``_exact_pairs``). No list is capped and no pair above the limit is left out.

Nulls and texts without words have an empty set and are linked with nothing. A null id never is a
component's id unless all of the component's ids are null. Repeated rows have equal sets, so they
are in one class. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skilltide.llm import _words as w
from skilltide.llm._rows import fresh
from skilltide.llm.components import connected
from skilltide.session import saved

SHINGLE = 5
KEEP = 64
DEVIATIONS = 5
SLACK = 1e-9  # for sizes computed as fractions


def least_shared(num: int, den: int, keep: int) -> float:
    """The share of ``keep`` retained values that sets of similarity ``num / den`` have in common, less
    ``DEVIATIONS`` standard deviations of it: at 0.85 and 64 that is 0.627, or 41 values."""
    t = num / den
    return t - DEVIATIONS * math.sqrt(t * (1 - t) / keep)


def shingle_sets(data: np.ndarray, texts: np.ndarray, n: int):
    """The set of each text: sorted distinct hashes of its runs of ``n`` words, or of all its
    words if it has fewer."""
    for i, j in w.slices(texts):
        part, at = data[texts[i] : texts[j]], texts[i : j + 1] - texts[i]
        words = w.cut_words(part, at, True, w.NOT_SPACE)
        h = w.hash_words(part, words, True)
        runs = w.chain(h, n)
        first = words.first.tolist()
        for a, b in zip(first, first[1:], strict=False):
            found = runs[a : b - n + 1] if b - a >= n else w.chain(h[a:b], max(1, b - a))
            yield np.unique(found.view(np.int64))


def _scan(text_at: int, n: int, k: int):
    def run(batches):
        for batch in batches:
            data, texts = w.text_bytes(batch.column(text_at))
            sizes, digests, kept = [], [], []
            for found in shingle_sets(data, texts, n):
                sizes.append(len(found))
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                kept.append(found[:k])
            sketch = w.list_array(
                np.concatenate(kept) if kept else np.zeros(0, np.int64),
                np.array([len(x) for x in kept], np.int64), pa.int64(),
            )
            columns = [c for i, c in enumerate(batch.columns) if i != text_at]
            names = [x for i, x in enumerate(batch.schema.names) if i != text_at]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), sketch],
                [*names, "n", "digest", "sketch"],
            )

    return run


def _sets(n: int):
    def run(batches):
        for batch in batches:
            data, texts = w.text_bytes(batch.column(1))
            found = list(shingle_sets(data, texts, n))
            sizes = np.array([len(x) for x in found], np.int64)
            full = w.list_array(np.concatenate([np.zeros(0, np.int64), *found]), sizes, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), full], ["cls", "full"])

    return run


def _confirm(num: int, den: int):
    def run(batches):
        for batch in batches:
            (left, at), (right, to) = (
                (c.values.to_numpy(), c.offsets.to_numpy().tolist()) for c in (batch.column(2), batch.column(3))
            )
            good = []
            for i in range(batch.num_rows):
                a, b = left[at[i] : at[i + 1]], right[to[i] : to[i + 1]]
                both = len(np.intersect1d(a, b, assume_unique=True))
                good.append(den * both >= num * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def scan(docs: DataFrame, id_col: str, text_col: str, shingle: int, keep: int) -> DataFrame:
    """One saved row per document: (row, doc_id, mark, n, digest, sketch). ``mark`` hashes the text, so that
    id and mark find the document again."""
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(F.col(f"`{text_col}`")).alias("mark"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(
        _scan(2, shingle, keep), f"doc_id {kind}, mark long, n long, digest binary, sketch array<long>"
    )
    return saved(found.withColumn("row", F.monotonically_increasing_id()), "sketches")


def _inverted(reps: DataFrame, share: float, ratio: float) -> DataFrame:
    """Saved lists (value, band, cls, n, spread): each class under its rarest retained values. A band
    holds the sizes that can be alike."""
    values = reps.select("cls", "n", F.size("sketch").alias("kept"), F.explode("sketch").alias("value"))
    often = saved(values.groupBy("value").agg(F.count("*").alias("often")).filter("often > 1"), "value-counts")
    of_class = Window.partitionBy("cls")
    ranked = values.join(often, "value").select(
        "value", "cls", "n", "kept",
        F.count("*").over(of_class).alias("spread"),
        F.row_number().over(of_class.orderBy("often", "value")).alias("place"),
    )
    # Values of no other class are the rarest: they come first and are not in any list.
    alone = F.col("kept") - F.col("spread")
    listed = F.col("kept") - F.ceil(F.col("kept") * F.lit(share)) + 1
    return saved(
        ranked.filter(F.col("place") + alone <= listed).select("value", _band("n", ratio).alias("band"), "cls", "n", "spread"), "lists"
    )


def _band(n: str, ratio: float):
    return F.floor(F.log(F.col(n).cast("double")) / F.lit(-math.log(ratio))).cast("int")


def _compared(pairs: DataFrame, near: DataFrame, full: DataFrame, keep: int, num: int, den: int) -> DataFrame:
    """Of pairs (x, y) those that are links, as saved (a, b): estimated on sketches, confirmed on full sets."""
    sketch = lambda c: near.select(F.col("cls").alias(c), F.col("sketch").alias(f"s{c}"))
    whole = lambda c: full.select(F.col("cls").alias(c), F.col("full").alias(f"f{c}"))
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, keep)
    shared = F.size(F.array_intersect(F.array_intersect("sa", "sb"), union))
    likely = (
        pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        .join(sketch("a"), "a").join(sketch("b"), "b")
        .filter(shared >= F.size(union) * F.lit(least_shared(num, den, keep))).select("a", "b")
    )
    both = likely.join(whole("a"), "a").join(whole("b"), "b").select("a", "b", "fa", "fb")
    return saved(both.mapInArrow(_confirm(num, den), "a long, b long"), "links")


def _rooted(lists: DataFrame, roots: DataFrame) -> DataFrame:
    return lists.join(roots, lists["cls"] == roots["node"], "left").withColumn("root", F.coalesce("root", "cls")).drop("node")


def _full_lists(classes: DataFrame, full: DataFrame, t: float) -> DataFrame:
    """Saved lists (value, cls, n, common, place) of ``classes(cls, n)`` by the rarest values of their full sets.
    ``common`` values of the ``n`` are in another set as well, ``place`` is the value's place in the set's order: from the
    rarest value, those of no other set first. Sets of similarity ``t`` meet in the first ``n - ceil(t * n) + 1``."""
    values = saved(classes.join(full, "cls").select("cls", "n", F.explode("full").alias("value")), "full-values")
    often = saved(values.groupBy("value").agg(F.count("*").alias("often")).filter("often > 1"), "full-counts")
    of_class = Window.partitionBy("cls")
    ranked = values.join(often, "value").select(
        "value", "cls", "n", F.count("*").over(of_class).alias("common"),
        F.row_number().over(of_class.orderBy("often", "value")).alias("place"),
    ).withColumn("place", F.col("place") + F.col("n") - F.col("common"))
    return saved(ranked.filter(F.col("place") <= F.col("n") - F.ceil(F.col("n") * t - SLACK) + 1), "full-lists")


def _to_hubs(lists: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (x, y) of each class in ``lists`` with the class of its list that has least to itself."""
    hubs = saved(
        lists.groupBy("value")
        .agg(
            F.max(F.struct(F.expr("common / n").alias("shared"), F.xxhash64("cls").alias("h"), "cls", "n", "root", "common")).alias("hub"),
            F.min("root").alias("r1"), F.max("root").alias("r2"),
        )
        .filter("r1 < r2").select("value", *[F.col(f"hub.{c}").alias(f"h{c}") for c in ("cls", "n", "root", "common")]),
        "full-hubs",
    )
    enough = F.least("common", "hcommon") >= (F.col("n") + F.col("hn")) * (num / (num + den)) - SLACK
    met = lists.join(hubs, "value").filter((F.col("root") != F.col("hroot")) & enough)
    return met.select(F.col("cls").alias("x"), F.col("hcls").alias("y"))


def _exact_pairs(lists: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (x, y) of ``lists(value, cls, n, common, place, root)`` that may be alike and are not in one component.

    Sets of ``n`` and ``m`` values are alike if they share at least ``t / (1 + t) * (n + m)``. Where they meet first, no
    more than what follows is shared. The smaller of the two has at most ``(1 - t) / (1 + t)`` of its values to itself, so
    only such sets are looked up, by the sizes the other one allows.
    """
    t, share = num / den, num / (num + den)
    parts = lists.groupBy("value", "root").agg(F.count("*").alias("c"))
    main = saved(
        parts.groupBy("value").agg(F.max(F.struct("c", "root")).alias("m"), F.count("*").alias("parts")).filter("parts > 1")
        .select("value", F.col("m.root").alias("main")),
        "full-main",
    )
    open_ = saved(lists.join(main, "value").withColumn("aside", F.col("root") != F.col("main")), "full-open")
    fine = lambda c: F.floor(F.log(c.cast("double")) * 100).cast("int")
    larger = open_.select(
        "value", F.col("cls").alias("x"), F.col("n").alias("xn"), F.col("root").alias("xr"), F.col("place").alias("xp"), "aside",
        F.expr(f"least(n, common / {share} - n + 1)").alias("most"), F.expr(f"greatest(1, floor(n * {t}) - 1)").alias("fewest"),
    ).filter("most >= fewest").withColumn("size", F.explode(F.sequence(fine(F.col("fewest")), fine(F.col("most")))))
    smaller = open_.filter(F.col("common") >= F.col("n") * (2 * share) - SLACK).select(
        "value", F.col("cls").alias("y"), F.col("n").alias("yn"), F.col("root").alias("yr"), F.col("place").alias("yp"), F.col("aside").alias("y_aside"), fine(F.col("n")).alias("size"),
    )
    fits = (
        (F.col("xr") != F.col("yr")) & (F.col("yn") <= F.col("xn"))
        & (1 + F.least(F.col("xn") - F.col("xp"), F.col("yn") - F.col("yp")) >= (F.col("xn") + F.col("yn")) * share - SLACK)
    )
    # one of the two is outside the main component of the list
    met = lambda a, b: a.join(b, ["value", "size"]).filter(fits).select("x", "y")
    return met(larger.filter("aside"), smaller).union(met(larger.filter("NOT aside"), smaller.filter("y_aside")))


def _links(lists: DataFrame, near: DataFrame, full: DataFrame, keep: int, num: int, den: int) -> DataFrame:
    """(node, root) of the classes that have links."""
    hubs = saved(
        lists.groupBy("value", "band")
        .agg(F.max(F.struct("spread", F.xxhash64("cls").alias("h"), "cls", "n")).alias("hub"), F.count("*").alias("c"))
        .filter("c > 1").select("value", "band", F.col("hub.cls").alias("y"), F.col("hub.n").alias("hub_n")),
        "hubs",
    )
    alike = F.least("n", "hub_n") * den >= F.greatest("n", "hub_n") * num
    met = lists.join(hubs, ["value", "band"]).filter((F.col("cls") != F.col("y")) & alike)
    roots = connected(_compared(met.withColumnRenamed("cls", "x"), near, full, keep, num, den))
    rooted = _rooted(lists.select("value", "cls", "n"), roots)
    several = rooted.groupBy("value").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).filter("r1 < r2").select("value")
    unsettled = saved(
        lists.select("value", "cls", "n").join(saved(several, "open-lists"), "value", "left_semi").select("cls", "n").distinct(), "unsettled"
    )
    if unsettled.isEmpty():
        return roots
    whole = _full_lists(unsettled, full, num / den)

    def joined(pairs: DataFrame) -> DataFrame:
        found = _compared(pairs, near, full, keep, num, den)
        if found.isEmpty():
            return roots
        return connected(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(found))

    roots = joined(_to_hubs(_rooted(whole, roots), num, den))
    return joined(_exact_pairs(_rooted(whole, roots), num, den))


def near_duplicate_labels(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = SHINGLE,
    keep: int = KEEP, num: int = 85, den: int = 100,
) -> DataFrame:
    """One row per document: (row, doc_id, mark, n_shingles, component_id, root). Sets are linked
    where ``den`` times the shared shingles are at least ``num`` times all. ``component_id`` is the
    least id reachable, ``root`` a row number that names the component also where ids are null."""
    rows = scan(docs, id_col, text_col, shingle, keep)
    classes = saved(
        rows.filter("n > 0").groupBy("digest").agg(F.min("row").alias("cls"), F.min("doc_id").alias("first_id")), "classes"
    )
    reps = saved(
        rows.join(classes.select("cls"), F.col("row") == F.col("cls")).select("cls", "doc_id", "mark", "n", "sketch"),
        "representatives",
    )
    lists = _inverted(reps, least_shared(num, den, keep), num / den)
    near = saved(reps.join(lists.select("cls").distinct(), "cls", "left_semi"), "candidates")
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("m"), F.col(f"`{text_col}`").cast("string").alias("text"))
    found = texts.join(near, texts["id"].eqNullSafe(near["doc_id"]) & (texts["m"] == near["mark"])).select("cls", "text")
    # a repeated row is found as often as it is there
    full = saved(found.mapInArrow(_sets(shingle), "cls long, full array<long>").groupBy("cls").agg(F.first("full").alias("full")), "sets")
    roots = _links(lists, near, full, keep, num, den)
    linked = saved(roots.join(classes, roots["node"] == classes["cls"]).select("cls", "root", "first_id"), "linked")
    least = saved(linked.groupBy("root").agg(F.min("first_id").alias("component_id")), "least-ids")
    of_class = linked.join(least, "root").select(F.col("cls").alias("node"), "root", "component_id")
    alone = F.col("node").isNull()
    named = classes.join(of_class, classes["cls"] == F.col("node"), "left").select(
        "digest",
        F.when(alone, F.col("first_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(alone, F.col("cls")).otherwise(F.col("root")).alias("root"),
    )
    named = saved(named, "class-components")
    of_row = rows.join(named.withColumnRenamed("digest", "key"), F.col("digest") == F.col("key"), "left")
    empty = F.col("n") == 0
    return of_row.select(
        "row", "doc_id", "mark", F.col("n").alias("n_shingles"),
        F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(empty, F.col("row")).otherwise(F.col("root")).alias("root"),
    )


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each group, the one with the least id (of equal ids, the least text
    hash); of repeated rows one. Texts without words all stay. Columns are those of ``docs``."""
    labels = saved(near_duplicate_labels(docs, id_col, text_col, **options), "labels")
    counted = labels.groupBy("root", "doc_id", "mark").agg(F.count("*").alias("times"))
    best = saved(
        counted.groupBy("root")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark", "times")).alias("best"))
        .select("best.*")
        .groupBy(F.col("doc_id").alias("id_kept"), F.col("mark").alias("mark_kept"))
        .agg(F.max("times").alias("times")),
        "kept",
    )
    mark, only = fresh(docs, "mark_"), [F.col(f"`{c}`") for c in docs.columns]
    marked = docs.withColumn(mark, F.xxhash64(F.col(f"`{text_col}`")))
    same = marked[id_col].eqNullSafe(best["id_kept"]) & (marked[mark] == best["mark_kept"])
    # a text without words is a group of its own: there ``times`` is one, however often it is repeated
    once = marked.join(best.filter("times = 1"), same, "left_semi").select(*only)
    repeated = marked.join(best.filter("times > 1"), same, "left_semi").dropDuplicates([id_col, mark]).select(*only)
    return once.union(repeated)

