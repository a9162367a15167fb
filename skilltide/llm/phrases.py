"""Phrases whose words keep together, counted in a HAT-trie (operator 13).

A task counts its texts in a trie over word ids: the root leads by language and first word to hash containers of what
follows; a container that grows beyond ``BURST`` phrases becomes a node with a container per next word. Beyond
``HELD`` phrases a task writes whole subtrees, the largest first, as sorted runs and forgets them. Spark deals the runs by
language and the first two words, and adds them up there: a prefix of one word would put all that follows a frequent
word into one task.

Words and pairs are counted in the first pass. A phrase of n words is as frequent as asked only if both of its
parts of n - 1 words are, so each further pass counts those phrases only whose parts have their bit in a bitmap of
the frequent ones. It has a fixed size; a bit set by chance costs a count that the exact threshold drops.

A phrase is cut after each of its words but the last into two parts of l and r occurrences; its score is the least
of floor(10**6 a a / (l r)), in exact decimals (a below 10**16). A phrase that mostly stands inside one longer phrase is
dropped.

Null text: no words. Null language: ``und``. Empty texts have no words. Repeated rows count each. Very long texts are
counted whole: a task holds the text and the ids of its words. Only the two columns named are read. Empty table:
empty result. Words of any length are told apart by their text, never by a hash.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skilltide.llm import _words as w
from skilltide.llm._rows import ship_package
from skilltide.session import saved

BURST = 4096
HELD = 500_000
KNOWN_WORDS = 600_000
WORD_BITS = 21  # for the ids of the words known and those of one slice more
SLICE_CHARS = 1 << 20
SLICE_WORDS = 1 << 18
RUN_ROWS = 50_000
BITMAP_BITS = 25

_LOWER = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))
_SIGNS = frozenset(".,;:!?\n\x0b\x0c\r")
_TOKENS = re.compile(r"[^ \t.,;:!?\n-\r]+|[.,;:!?\n-\r]+")
_BETWEEN = re.compile(r"[ \t.,;:!?\n-\r]")
_U = np.uint64


class Words(dict):
    """Ids of words in the order they are met; a token that ends a piece has -1."""

    def __init__(self):
        super().__init__()
        self.names: list[str] = []

    def __missing__(self, token: str) -> int:
        if token[0] in _SIGNS:
            found = -1
        else:
            found = len(self.names)
            self.names.append(token)
        self[token] = found
        return found


class Trie:
    """Counts of phrases of ``size`` words: ids of the first word lead to containers {rest: count}, the rest being
    the other ids in one integer, 32 bits each; burst containers are nodes {next id: container or node}."""

    class Node(dict):
        pass

    def __init__(self, size: int):
        self.size, self.root, self.held = size, {}, 0

    def add(self, first: list[int], rest: list[int], counts: list[int]) -> None:
        """Phrases in order of their first word."""
        before, under, root = None, None, self.root
        for head, tail, n in zip(first, rest, counts, strict=True):
            if head != before:
                before, under = head, root.get(head)
                if under is None:
                    under = root[head] = {}
            if type(under) is not dict:
                self._add_below(under, tail, n, self.size - 1)
            elif tail in under:
                under[tail] += n
            else:
                under[tail] = n
                self.held += 1
                if len(under) > BURST and self.size > 2:
                    under = root[head] = self._burst(under, self.size - 1)

    def _burst(self, container: dict, left: int) -> Trie.Node:
        node, shift = Trie.Node(), 32 * (left - 1)
        for tail, n in container.items():
            head, tail = tail >> shift, tail & ((1 << shift) - 1)
            node.setdefault(head, {})[tail] = n
        return node

    def _add_below(self, node: Trie.Node, tail: int, n: int, left: int) -> None:
        while True:
            shift = 32 * (left - 1)
            head, tail, left = tail >> shift, tail & ((1 << shift) - 1), left - 1
            under = node.setdefault(head, {})
            if type(under) is dict:
                break
            node = under
        if tail in under:
            under[tail] += n
            return
        under[tail] = n
        self.held += 1
        if len(under) > BURST and left > 1:
            node[head] = self._burst(under, left)

    def _entries(self, under, left: int, given: int = 0):
        if type(under) is dict:
            for tail, n in under.items():
                yield given | tail, n
            return
        shift = 32 * (left - 1)
        for head, deeper in under.items():
            yield from self._entries(deeper, left - 1, given | head << shift)

    @staticmethod
    def _weight(under) -> int:
        return len(under) if type(under) is dict else sum(map(Trie._weight, under.values()))

    def taken(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Removes whole subtrees, the largest first, until at most ``most`` phrases are held: their ids (a row
        per phrase) and counts."""
        order = sorted(((self._weight(x), head) for head, x in self.root.items()), reverse=True)
        heads, sizes, rest, counts = [], [], [], []
        for weight, head in order:
            if self.held <= most:
                break
            under = self.root.pop(head)
            entries = under if type(under) is dict else dict(self._entries(under, self.size - 1))
            rest.extend(entries.keys())
            counts.extend(entries.values())
            heads.append(head)
            sizes.append(weight)
            self.held -= weight
        ids = np.empty((len(counts), self.size), np.int64)
        ids[:, 0] = np.repeat(np.array(heads, np.int64), np.array(sizes, np.int64))
        # two ids fit a word
        tails = np.array(rest, np.int64 if self.size <= 3 else object)
        for k in range(1, self.size):
            ids[:, k] = (tails >> (32 * (self.size - 1 - k))) & 0xFFFFFFFF
        return ids, np.array(counts, np.int64)


def _rows(lang: str, phrases: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(counts)), phrases, pa.array(counts, pa.int64())], ["lang", "phrase", "n"])


def _run(lang: str, names: list[str], ids: np.ndarray, counts: np.ndarray):
    """A sorted run as rows (lang, phrase, n)."""
    if not len(counts):
        return
    rank = np.empty(len(names), np.int64)
    rank[sorted(range(len(names)), key=names.__getitem__)] = np.arange(len(names))
    order = np.lexsort([rank[ids[:, k]] for k in range(ids.shape[1] - 1, -1, -1)])
    words = pa.array(names, pa.string())
    for i in range(0, len(order), RUN_ROWS):
        some = order[i : i + RUN_ROWS]
        parts = [words.take(pa.array(ids[some, k])) for k in range(ids.shape[1])]
        phrase = pc.binary_join_element_wise(*parts, " ") if len(parts) > 1 else parts[0]
        yield _rows(lang, phrase, counts[some])


def _word_hashes(names: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(x) for x in names], np.uint64)


def _marks(lang: str, hashes: list[np.ndarray]) -> np.ndarray:
    """A hash per phrase from those of its words."""
    out = np.full(len(hashes[0]), xxhash.xxh3_64_intdigest(lang), np.uint64)
    for h in hashes:
        out = w.mix(out * _U(0x9E3779B97F4A7C15) + h)
    return out


class Counted:
    """The tries of one language in a task, for phrases of the given sizes."""

    def __init__(self, lang: str, sizes: list[int], bits: np.ndarray | None):
        self.lang, self.sizes, self.bits = lang, sizes, bits
        self._clear()

    def _clear(self) -> None:
        self.words, self.tries, self.total = Words(), {n: Trie(n) for n in self.sizes if n > 1}, 0
        self.single, self.hashes = np.zeros(0, np.int64), np.zeros(0, np.uint64)

    def add(self, text: str):
        """Counts a text that begins and ends with a piece; runs that it had to write are returned."""
        ids = np.concatenate([
            np.fromiter(map(self.words.__getitem__, _TOKENS.findall(part)), np.int64) for part in _parts(text)
        ])
        known = ids[ids >= 0]
        self.total += len(known)
        if 1 in self.sizes:
            self.single = np.pad(self.single, (0, len(self.words.names) - len(self.single)))
            np.add.at(self.single, *np.unique(known, return_counts=True))
        if self.bits is not None:
            self.hashes = np.concatenate([self.hashes, _word_hashes(self.words.names[len(self.hashes) :])])
        for n, trie in self.tries.items():
            for i in range(0, len(ids) - n + 1, SLICE_WORDS):
                trie.add(*self._phrases(ids[i : i + SLICE_WORDS + n - 1], n))
                if trie.held > HELD:
                    yield from _run(self.lang, self.words.names, *trie.taken(HELD // 2))
        if len(self.words.names) > KNOWN_WORDS:
            yield from self.rest()

    def _phrases(self, ids: np.ndarray, n: int) -> tuple[list[int], list[int], list[int]]:
        last = len(ids) - n + 1
        known = ids >= 0
        parts = known[: last + 1]  # where n - 1 words begin
        for k in range(1, n - 1):
            parts = parts & known[k : last + 1 + k]
        if self.bits is not None:
            place = np.flatnonzero(parts)
            marks = _marks(self.lang, [self.hashes[ids[place + k]] for k in range(n - 1)])
            bit = (marks & _U(len(self.bits) * 8 - 1)).astype(np.int64)
            parts = np.zeros(last + 1, bool)
            parts[place] = (self.bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
        at = np.flatnonzero(parts[:-1] & parts[1:])
        if n <= 3:
            key = ids[at]
            for k in range(1, n):
                key = key << WORD_BITS | ids[at + k]
            keys, counts = np.unique(key, return_counts=True)
            one = (1 << WORD_BITS) - 1
            rest = keys & one
            if n == 3:
                rest |= (keys >> WORD_BITS & one) << 32
            return (keys >> (WORD_BITS * (n - 1))).tolist(), rest.tolist(), counts.tolist()
        rows, counts = np.unique(np.stack([ids[at + k] for k in range(n)], axis=1), axis=0, return_counts=True)
        rest = rows[:, 1].astype(object)
        for k in range(2, n):
            rest = rest * (1 << 32) + rows[:, k]
        return rows[:, 0].tolist(), rest.tolist(), counts.tolist()

    def rest(self):
        """The runs of all that is held."""
        for trie in self.tries.values():
            yield from _run(self.lang, self.words.names, *trie.taken(0))
        if 1 in self.sizes:
            met = np.flatnonzero(self.single)
            yield from _run(self.lang, self.words.names, met[:, None], self.single[met])
            yield _rows(self.lang, pa.array([""]), np.array([self.total]))
        self._clear()


def _parts(text: str):
    """A text in parts of about ``SLICE_CHARS`` characters that end between words."""
    start = 0
    while len(text) - start > SLICE_CHARS and (blank := _BETWEEN.search(text, start + SLICE_CHARS)):
        yield text[start : blank.start()]
        start = blank.start()
    yield text[start:]


def _together(texts: list[str]):
    """Texts joined, about ``SLICE_CHARS`` characters at a time; the line end between two ends a piece."""
    held, size = [], 0
    for text in texts:
        if held and size + len(text) > SLICE_CHARS:
            yield "\n".join(held)
            held, size = [], 0
        held.append(text)
        size += len(text)
    yield "\n".join(held)


def _scan(sizes: list[int], bits: np.ndarray | None):
    def run(batches):
        tries: dict[str, Counted] = {}
        for batch in batches:
            texts: dict[str, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                texts.setdefault(lang, []).append(text)
            for lang, some in texts.items():
                if lang not in tries:
                    tries[lang] = Counted(lang, sizes, bits)
                for together in _together(some):
                    yield from tries[lang].add(together.encode().translate(_LOWER).decode())
            while sum(t.held for c in tries.values() for t in c.tries.values()) > HELD:
                most = max(tries, key=lambda x: sum(t.held for t in tries[x].tries.values()))
                yield from tries.pop(most).rest()
        for counted in tries.values():
            yield from counted.rest()

    return run


def _bits(frequent: DataFrame, words: int) -> np.ndarray:
    """A bit for each frequent phrase of that many words: at most ``2 ** BITMAP_BITS`` bits, whatever their number."""

    def places(batches):
        for batch in batches:
            found = []
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                mark = _marks(lang, [_word_hashes([x]) for x in phrase.split(" ")])
                found.append(int(mark[0] & _U((1 << BITMAP_BITS) - 1)))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], ["place"])

    set_bits = (
        frequent.filter(F.col("words") == words).select("lang", "phrase").mapInArrow(places, "place long")
        .groupBy(F.shiftright("place", 5).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(place & 31 AS INT))")).alias("bits"))
    )
    out = np.zeros((1 << BITMAP_BITS) // 32, np.uint32)
    for batch in set_bits.toArrow().to_batches():
        out[batch.column(0).to_numpy()] = batch.column(1).to_numpy().astype(np.uint32)
    return out.view(np.uint8)


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", *, most_words: int = 3, least: int = 10) -> DataFrame:
    """Saved counts (lang, phrase, n, words) of the words and phrases with at least ``least`` occurrences, and of each
    language's words in all (phrase empty, words 0)."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = rows.filter("text IS NOT NULL")
    words = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " "))).alias("words")
    prefix = F.substring_index("phrase", " ", 2)
    enough = (F.col("n") >= least) | (F.col("phrase") == "")
    found = None
    for sizes in [[n for n in (1, 2) if n <= most_words], *([n] for n in range(3, most_words + 1))]:
        bits = None if found is None else _bits(found, sizes[0] - 1)
        runs = rows.mapInArrow(_scan(sizes, bits), "lang string, phrase string, n long")
        keys = ["lang", "phrase"]
        if sizes[0] > 2:
            runs, keys = runs.withColumn("prefix", prefix), ["lang", "prefix", "phrase"]
        counted = runs.repartition(*keys[:2]).groupBy(*keys).agg(F.sum("n").alias("n")).filter(enough)
        more = saved(counted.select("lang", "phrase", "n", words), "phrase-counts")
        found = more if found is None else found.unionByName(more)
    return found


def scored(counts: DataFrame) -> DataFrame:
    """The phrases of two words or more (lang, phrase, words, a, l, r, score): the cut with the lowest score counts, of
    equals the one after fewer words."""
    phrases = counts.filter("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"))
    known = counts.filter("words > 0")
    first = known.select(F.col("lang").alias("first_lang"), F.col("phrase").alias("first_phrase"), F.col("n").alias("l"))
    rest = known.select(F.col("lang").alias("rest_lang"), F.col("phrase").alias("rest_phrase"), F.col("n").alias("r"))
    cut = phrases.withColumn("k", F.explode(F.expr("sequence(1, words - 1)"))).withColumns({
        "first": F.expr("substring_index(phrase, ' ', k)"), "rest": F.expr("substring_index(phrase, ' ', k - words)")
    })
    joined = cut.join(first, (F.col("lang") == F.col("first_lang")) & (F.col("first") == F.col("first_phrase"))).join(
        rest, (F.col("lang") == F.col("rest_lang")) & (F.col("rest") == F.col("rest_phrase"))
    )
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    joined = joined.withColumns({"up": wide("a") * wide("a"), "down": wide("l") * wide("r")})
    score = F.expr("CAST((up * CAST(1000000 AS DECIMAL(7,0))) div down AS BIGINT)")
    best = joined.withColumn("score", score).groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "words", "a", "best.l", "best.r", "best.score")


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", *, most_words: int = 3, least: int = 10, inside: int = 50, top: int = 2000
) -> DataFrame:
    """Each language's ``top`` phrases of 2 to ``most_words`` words with at least ``least`` occurrences: lang, rank, phrase, a, l, r,
    n, score; by score and a descending, then phrase. Phrases of which ``inside`` of a hundred occurrences or more are
    inside one longer phrase are left out."""
    counts = phrase_counts(docs, text_col, lang_col, most_words=most_words, least=least)
    found = saved(scored(counts), "phrase-scores")
    longer = found.filter("words > 2").select(
        F.col("lang").alias("in_lang"), F.col("a").alias("n_longer"), F.expr(
            "explode(flatten(transform(sequence(2, words - 1), m -> transform(sequence(1, words - m + 1), i -> "
            "array_join(slice(split(phrase, ' '), i, m), ' ')))))"
        ).alias("part"),
    ).groupBy("in_lang", "part").agg(F.max("n_longer").alias("n_longer"))
    alone = found.join(longer, (F.col("lang") == F.col("in_lang")) & (F.col("phrase") == F.col("part")), "left").filter(
        f"n_longer IS NULL OR 100 * n_longer < {inside} * a"
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = alone.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    # a row per language
    totals = counts.filter("words = 0").select(F.col("lang").alias("of"), F.col("n"))
    return best.join(totals, F.col("lang") == F.col("of")).select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
