"""Token ids in files of directly addressable codes (operator 2).

An id is split into chunks of 8 bits, least first. The first level has a chunk per id; a bitmap says whose
code goes on, and the chunks that follow are the next level, at the place given by the number of set
bits before (Brisaboa, Ladra and Navarro, "DACs", 2013). A rank directory keeps that number every 512 bits, so any
token or range of tokens is read by its place: a few small reads per level, and no block is decoded.

A file holds segments of at most ``SEGMENT`` tokens, each with its levels, and ends with their directory. Texts are
dealt by ranges of ids and sorted in their partition, so files are in ascending order, and a saved index has a
row per document. A task holds one segment and one batch of texts.

Texts are cut before white space that follows a letter or sign, and before a sign that follows a letter or digit. A
byte-level tokenizer cuts there itself before it merges anything, so pieces can be encoded one by one, and each different piece is encoded once while it is remembered.
Whether a tokenizer does so is read from its file; where it does not, whole texts are encoded.

Null text: no tokens but the end. Null ids come first. Rows of one id are ordered by the hash of their text;
repeated rows are encoded each. Empty table: no files, empty result.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skilltide.llm import _words as w
from skilltide.llm._files import new_file, opened
from skilltide.session import saved, scratch_dir

SEGMENT = 1 << 21
BLOCK = 512
MAGIC = b"DACTOK01"
CACHE = 600_000
TOGETHER = 2_000
SLICE_BYTES = 4 << 20

# --- codes --------------------------------------------------------------------------------------


def encode_levels(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(chunks, bitmap of those that go on, set bits before each block) of each level."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little")
        ends = np.zeros(-(-len(rest) // BLOCK) * BLOCK, bool)
        ends[: len(more)] = more
        ranks = np.zeros(len(ends) // BLOCK + 1, np.uint32)
        np.cumsum(ends.reshape(-1, BLOCK).sum(axis=1), out=ranks[1:])
        levels.append(((rest & 0xFF).astype(np.uint8), bits, ranks))
        if not more.any():
            return levels
        rest = rest[more] >> np.uint32(8)


class Segment:
    """Reads ids by place from the levels of one segment in an open file."""

    def __init__(self, file, at: int):
        self.file = file
        self.n, levels = struct.unpack("<QQ", file.read_at(16, at))
        sizes = struct.unpack(f"<{levels}Q", file.read_at(8 * levels, at + 16))
        at += 16 + 8 * levels
        self.levels = []
        for n in sizes:
            chunks, bits, ranks = at, at + n, at + n + -(-n // 8)
            self.levels.append((n, chunks, bits, ranks))
            at = ranks + 4 * (-(-n // BLOCK) + 1)

    def _rank(self, level, i: int) -> int:
        """Set bits before place ``i``: the directory, and the bits of one block."""
        _, _, bits, ranks = level
        block = i // BLOCK
        known = struct.unpack("<I", self.file.read_at(4, ranks + 4 * block))[0]
        if not (left := i % BLOCK):
            return known
        part = np.frombuffer(self.file.read_at(-(-left // 8), bits + block * BLOCK // 8), np.uint8)
        return known + int(np.unpackbits(part, bitorder="little")[:left].sum())

    def read(self, start: int, n: int, level: int = 0) -> np.ndarray:
        """The ``n`` ids from place ``start`` on."""
        _, chunks, bits, _ = here = self.levels[level]
        out = np.frombuffer(self.file.read_at(n, chunks + start), np.uint8).astype(np.uint32)
        if level + 1 == len(self.levels) or not n:
            return out
        first = start // 8
        part = np.frombuffer(self.file.read_at((start + n + 7) // 8 - first, bits + first), np.uint8)
        more = np.unpackbits(part, bitorder="little")[start - 8 * first :][:n].astype(bool)
        if more.any():
            out[more] |= self.read(self._rank(here, start), int(more.sum()), level + 1) << np.uint32(8)
        return out


class TokenFile:
    """Random access to the ids of a file."""

    def __init__(self, uri: str):
        self.file = opened(uri)
        size = self.file.size()
        count, magic = struct.unpack("<Q8s", self.file.read_at(16, size - 16))
        if magic != MAGIC:
            raise ValueError(f"{uri} is no token file")
        ends = np.frombuffer(self.file.read_at(16 * count, size - 16 - 16 * count), "<u8").reshape(-1, 2)
        self.first = np.concatenate([[0], np.cumsum(ends[:, 1])]).astype(np.int64)
        self.at, self.segments = ends[:, 0].astype(int).tolist(), {}

    def read(self, start: int, n: int) -> np.ndarray:
        parts, k = [], int(np.searchsorted(self.first, start, side="right")) - 1
        while n > 0:
            if k not in self.segments:
                self.segments[k] = Segment(self.file, self.at[k])
            some = min(n, int(self.first[k + 1]) - start)
            parts.append(self.segments[k].read(start - int(self.first[k]), some))
            start, n, k = start + some, n - some, k + 1
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)

    def close(self) -> None:
        self.file.close()


class TokenFileWriter:
    def __init__(self, folder: str, segment: int = SEGMENT):
        self.out, self.uri = new_file(folder, ".dac")
        self.segment, self.held, self.n, self.at, self.ends = segment, [], 0, 0, []

    def add(self, ids: np.ndarray) -> None:
        while len(ids):
            some = ids[: self.segment - self.n]
            self.held.append(some)
            self.n, ids = self.n + len(some), ids[len(some) :]
            if self.n == self.segment:
                self._flush()

    def _flush(self) -> None:
        if self.n:
            levels = encode_levels(np.concatenate(self.held))
            parts = [struct.pack(f"<QQ{len(levels)}Q", self.n, len(levels), *(len(x[0]) for x in levels))]
            parts += [x.tobytes() for level in levels for x in level]
            self.ends.append((self.at, self.n))
            for part in parts:
                self.out.write(part)
                self.at += len(part)
        self.held, self.n = [], 0

    def close(self) -> None:
        self._flush()
        self.out.write(np.array(self.ends, "<u8").tobytes() + struct.pack("<Q8s", len(self.ends), MAGIC))
        self.out.close()


# --- tokens -------------------------------------------------------------------------------------

_SPACE = w.byte_class(lambda b: b == 32 or 9 <= b <= 13)
_SOLID = w.byte_class(lambda b: 33 <= b <= 126)
_LETTER = w.byte_class(lambda b: chr(b).isalnum() and b < 128)
_SIGN = w.byte_class(lambda b: 33 <= b <= 126 and not chr(b).isalnum())


def piece_starts(data: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where pieces begin: at the texts; at white space after a visible ASCII sign or a character of two
    bytes from U+00C0 on (none of which is white space); and at an ASCII sign after a letter or digit, which are
    looked for in ASCII and from U+00C0 to U+00FF."""
    n = len(data)
    cut = np.zeros(n + 1, bool)
    if n > 1:
        solid, letter = _SOLID[data[:-1]], _LETTER[data[:-1]]
        last, lead = data[1:-1], data[:-2]
        solid[1:] |= (last >= 128) & (lead >= 0xC3) & (lead <= 0xDF)
        letter[1:] |= (lead == 0xC3) & (last != 0x97) & (last != 0xB7)  # all but the signs of times and division
        cut[1:n] = (_SPACE[data[1:]] & solid) | (_SIGN[data[1:]] & letter)
    cut[texts] = True
    return np.flatnonzero(cut[:n])


class Encoder:
    """Ids of the texts of a batch, with the ids of pieces seen before."""

    def __init__(self, path: str, by_piece: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.by_piece, self.seen, self.before = Tokenizer.from_file(path), by_piece, {}, {}
        # a byte-level token has a character per byte; an added token is its own text
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes = np.zeros(max(vocab.values(), default=0) + 1, np.int64)
        for token, i in vocab.items():
            self.bytes[i] = len(token)
        self.added = []
        for i, added in self.tokenizer.get_added_tokens_decoder().items():
            self.added.append(added.content.encode())
            self.bytes[i] = len(self.added[-1])

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, new: list[bytes]) -> dict[bytes, bytes]:
        """Ids of each piece. Those that stand between white space and a sign are encoded in rows, which the
        tokenizer cuts at the same places, and told apart by the bytes of their tokens."""
        joined = [x for x in new if _SPACE[x[0]] and _SOLID[x[-1]]]
        single = [x for x in new if not (_SPACE[x[0]] and _SOLID[x[-1]])]
        rows = [joined[i : i + TOGETHER] for i in range(0, len(joined), TOGETHER)]
        found = {}
        for row, ids in zip(rows, self._plain([b"".join(x).decode() for x in rows]), strict=True):
            ends = np.cumsum(self.bytes[ids])
            sums = np.cumsum([len(x) for x in row])
            cut = np.searchsorted(ends, sums)
            if len(ends) == 0 or cut[-1] >= len(ends) or not np.array_equal(ends[cut], sums):
                single += row
                continue
            held, at = ids.tobytes(), [0, *(4 * cut + 4).tolist()]
            found.update(zip(row, [held[a:b] for a, b in zip(at, at[1:], strict=False)], strict=True))
        found.update(zip(single, (x.tobytes() for x in self._plain([x.decode() for x in single])), strict=True))
        return found

    def _starts(self, data: np.ndarray, texts: np.ndarray, whole: bytes) -> np.ndarray:
        """Where pieces begin, but not inside of added tokens, which the tokenizer looks for first."""
        start = piece_starts(data, texts)
        for token in self.added:
            at = whole.find(token)
            while at >= 0:
                inside = slice(np.searchsorted(start, at, "right"), np.searchsorted(start, at + len(token)))
                start = np.concatenate([start[: inside.start], np.intersect1d(start[inside], texts), start[inside.stop :]])
                at = whole.find(token, at + len(token))
        return start

    def batch(self, data: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts and how many each has."""
        if not self.by_piece:
            found = self._plain([data[a:b].tobytes().decode() for a, b in zip(texts, texts[1:], strict=False)])
            return np.concatenate([np.zeros(0, np.uint32), *found]), np.array([len(x) for x in found], np.int64)
        start = self._starts(data, texts, data.tobytes() if self.added else b"")
        ends = np.append(start[1:], len(data)) if len(start) else start
        at = np.append(start, ends[-1:]).astype(np.int32)
        # equal pieces are found by their bytes
        cut = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        which, pieces = cut.indices.to_numpy(), cut.dictionary.to_pylist()
        if len(self.seen) > CACHE:
            # what was met since the last time is kept for once more
            self.seen, self.before = {}, self.seen
        known = self.seen
        found = list(map(known.get, pieces))
        if missing := [i for i, x in enumerate(found) if x is None]:
            new, old = [pieces[i] for i in missing], self.before
            known.update((x, old[x]) for x in new if x in old)
            known.update(self._pieces([x for x in new if x not in old]))
            for i in missing:
                found[i] = known[pieces[i]]
        flat, sizes = np.frombuffer(b"".join(found), np.uint32), np.array([len(x) // 4 for x in found], np.int64)
        first, each = np.cumsum(sizes) - sizes, sizes[which]
        sums = np.concatenate([[0], np.cumsum(each)])
        place = np.arange(sums[-1]) + np.repeat(first[which] - sums[:-1], each)
        return flat[place], np.diff(sums[np.searchsorted(start, texts)])


def cuts_at_spaces(path: str) -> bool:
    """Whether the file's tokenizer cuts texts before white space that follows a visible sign and between letters or
    digits and signs, and merges bytes only after that: a byte-level pre-tokenizer with its pattern, nothing changed before it."""
    with open(path, encoding="utf-8") as file:
        said = json.load(file)
    cut = said.get("pre_tokenizer") or {}
    plain = not any(x.get("lstrip") or x.get("rstrip") or x.get("single_word") for x in said.get("added_tokens") or ())
    return plain and not said.get("normalizer") and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")


@lru_cache(maxsize=2)
def _encoder(path: str, by_piece: bool | None) -> Encoder:
    """One per worker process, with its cache."""
    return Encoder(path, cuts_at_spaces(path) if by_piece is None else by_piece)


def _writer(folder: str, path: str, end_id: int, by_piece: bool | None, segment: int):
    def run(batches):
        from pyspark import TaskContext

        encoder, out, total, part = _encoder(path, by_piece), None, 0, TaskContext.get().partitionId()
        for batch in batches:
            data, texts = w.text_bytes(batch.column(1))
            sizes = []
            for i, j in w.slices(texts, SLICE_BYTES):
                ids, counts = encoder.batch(data[texts[i] : texts[j]], texts[i : j + 1] - texts[i])
                ids = np.insert(ids, np.cumsum(counts), end_id)
                if out is None:
                    out = TokenFileWriter(folder, segment)
                out.add(ids)
                sizes.append(counts + 1)
            if not batch.num_rows:
                continue
            n = np.concatenate(sizes)
            start = total + np.cumsum(n) - n
            total += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([out.uri] * len(n)), pa.array([part] * len(n), pa.int32()), pa.array(start), pa.array(n)],
                ["id", "path", "part", "place", "n_tokens"],
            )
        if out is not None:
            out.close()

    return run


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", *, by_piece: bool | None = None,
    segment: int = SEGMENT,
) -> DataFrame:
    """Write the ids of all texts, each with ``end_id`` after it, in ascending order of ids. Returns the saved index: id,
    path of the file, part (its number in order), place of the first id in the file, n_tokens."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    kind = rows.schema["id"].dataType.simpleString()
    return saved(
        dealt.mapInArrow(_writer(folder, tokenizer, end_id, by_piece, segment), f"id {kind}, path string, part int, place long, n_tokens long"),
        "token-index",
    )


def _reader(with_ids: bool):
    def run(batches):
        file, path = None, None
        for batch in batches:
            sums, ids = [], []
            for uri, place, n in zip(*(batch.column(c).to_pylist() for c in ("path", "place", "n_tokens")), strict=True):
                if uri != path:
                    if file:
                        file.close()
                    file, path = TokenFile(uri), uri
                found = file.read(place, n).astype("<u4")
                sums.append(zlib.crc32(found.tobytes()))
                if with_ids:
                    ids.append(found)
            names = [c for c in batch.schema.names if c != "path" and c != "place"]
            columns = [*(batch.column(c) for c in names), pa.array(sums, pa.int64())]
            if with_ids:
                counts = np.array([len(x) for x in ids], np.int64)
                columns.append(w.list_array(np.concatenate([np.zeros(0, np.uint32), *ids]), counts, pa.int32()))
            yield pa.RecordBatch.from_arrays(columns, [*names, "crc32", *(["ids"] if with_ids else [])])
        if file:
            file.close()

    return run


def read_tokens(index: DataFrame, with_ids: bool = True) -> DataFrame:
    """The documents of an index, read from the files: id, start (ids of all documents before), n_tokens, ids, crc32 of
    the ids as little-endian 32-bit integers. ``with_ids=False`` leaves the ids in the task that read them."""
    # one row per file
    totals = sorted(index.groupBy("part").agg(F.sum("n_tokens")).collect())
    before = dict(zip([r[0] for r in totals], np.cumsum([0, *(r[1] for r in totals)]).tolist(), strict=False))
    starts = index.sparkSession.createDataFrame(list(before.items()), "file_no int, tokens_before long")
    kind = index.schema["id"].dataType.simpleString()
    read = index.select("id", "path", "part", "place", "n_tokens", F.col("place").alias("in_file")).mapInArrow(
        _reader(with_ids), f"id {kind}, part int, n_tokens long, in_file long, crc32 long" + (", ids array<int>" if with_ids else "")
    )
    return read.join(F.broadcast(starts), F.col("part") == F.col("file_no")).select(
        "id", (F.col("tokens_before") + F.col("in_file")).alias("start"), "n_tokens", *(["ids"] if with_ids else []), "crc32"
    )


def round_trip(
    spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", *, with_ids: bool = True, **options
) -> DataFrame:
    """Write the texts of ``docs`` to new files in the shared folder and read them."""
    return read_tokens(write_tokens(docs, scratch_dir(spark, "tokens"), tokenizer, end_id, id_col, text_col, **options), with_ids)
