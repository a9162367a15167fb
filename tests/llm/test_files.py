"""Operators 2 and 8: exact round trips."""

import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skilltide.llm import _files, tokencodes, warc
from skilltide.llm import _words as w
from skilltide.llm.queries import table
from skilltide.session import scratch_dir

PATH = public_tokenizers.path("byte_bpe_50k.json")
AWKWARD = [
    "a  b", "é  b ", "x    x", " a\n\n b\tc  ", "it's he'll  we 've", "", "日本 語 　 x", "naïve é é  e", "\x1c a \x1f b",
    "don't  \r\n stop <|endoftext|> a <|endoftext|>", "\u0085 x", "a\x7f b", "ß\n\nß", " ", " \n ", "é  x", "😀 😀  😀",
]


def test_pieces_are_encoded_like_whole_texts(documents):
    texts = AWKWARD + [r[0] for r in documents.select("text").collect()]
    data, at = w.text_bytes(pa.array(texts))
    by_piece, whole = (tokencodes.Encoder(PATH, x).batch(data, at) for x in (True, False))
    assert np.array_equal(by_piece[0], whole[0]) and np.array_equal(by_piece[1], whole[1])


def test_any_token_is_read_by_its_place(tmp_path):
    ids = np.random.default_rng(1).integers(0, 70_000, 30_000).astype(np.uint32)
    ids[:5] = [0, 255, 256, 65_535, 2**32 - 1]
    out = tokencodes.TokenFileWriter(str(tmp_path), segment=7_000)
    out.add(ids[:100])
    out.add(ids[100:])
    out.close()
    file = tokencodes.TokenFile(out.uri)
    for start, n in ((0, 30_000), (511, 3), (6_999, 2), (29_999, 1), (512, 512), (7, 20_000), (5, 0)):
        assert np.array_equal(file.read(start, n), ids[start : start + n])
    assert all(file.read(i, 1)[0] == ids[i] for i in range(0, 30_000, 97))


@pytest.mark.parametrize("which", ["documents", "odd"])
def test_token_files(spark, request, which):
    docs = request.getfixturevalue(which).select("doc_id", "text")
    rows = tokencodes.round_trip(spark, docs, PATH, 2, segment=5_000).orderBy("start").collect()
    tokenizer = Tokenizer.from_file(PATH)
    texts = {}
    for r in docs.collect():
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        texts.setdefault(r["doc_id"], []).append(ids)
    at, last = 0, None
    for r in rows:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"])
        assert r["crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        assert last is None or (r["id"] is not None and last <= r["id"])
        texts[r["id"]].remove(r["ids"])
        at, last = at + r["n_tokens"], r["id"]
    assert not any(texts.values())
    assert tokencodes.round_trip(spark, docs.limit(0), PATH, 2).count() == 0


def test_archives(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    archives = warc.write_archives(pages, scratch_dir(spark, "warc"), file_bytes=20_000)
    assert archives.count() > 1 and archives.agg({"records": "sum"}).first()[0] == pages.count()
    read = warc.read_archives(archives, range_bytes=3_000)  # records lie across ranges
    got = {r["id"]: r for r in read.collect()}
    for r in pages.collect():
        answer = got[r["page_id"]]
        whole = got[answer["refers_to"]] if answer["record_type"] == "revisit" else answer
        assert whole["payload"].decode() == r["html"] and answer["payload_bytes"] == len(r["html"].encode()) and answer["url"] == r["url"]


def test_archive_rows_of_every_kind(spark):
    rows = [
        (1, "http://a/é?x=%20", "<p>same</p>"), (2, None, "<p>same</p>"), (3, "u\r\nWARC-Type: x", "<p>same</p>"), (4, "u", None), (5, "u", ""),
        (6, "u", "x" * 300_000), (None, "u", "<p>same</p>"), (3, "u", "<p>same</p>"), (None, "u", "only"), (None, "u", "only"),
    ]
    pages = spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING")
    got = sorted(
        ((r["id"] or 0, r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.round_trip(spark, pages).collect()), key=str
    )
    assert got == sorted([
        (1, "revisit", 3, 11), (2, "revisit", 3, 11), (3, "response", None, 11), (3, "response", None, 11), (0, "revisit", 3, 11),
        (4, "revisit", 5, 0), (5, "response", None, 0), (6, "response", None, 300_000), (0, "response", None, 4), (0, "response", None, 4),
    ], key=str)
    small = warc.round_trip(spark, pages, least=12).collect()
    assert {r["record_type"] for r in small} == {"response"}
    assert warc.round_trip(spark, pages.limit(0)).count() == 0


def test_false_magic_is_no_record(tmp_path):
    out, uri = _files.new_file(str(tmp_path), ".warc.gz")
    noise = warc.MAGIC + b"\x00noise" * 10
    record = warc._record("1", "u", b"payload", b"\x00" * 20, None, False, "d")
    out.write(noise + record + noise + record)
    out.close()
    size = 2 * len(noise + record)
    assert len(list(warc.records(uri, 0, size))) == 2
    assert sum(len(list(warc.records(uri, i, i + 1))) for i in range(size)) == 2


def test_archive_urls_of_any_length(spark):
    noise = np.random.default_rng(3).bytes(1_500_000).hex()
    urls = ["data:," + "x" * 200_000, "data:," + noise[:200_000], "data:," + noise, "u"]
    pages = spark.createDataFrame([(i, u, f"<p>{i}") for i, u in enumerate(urls)], "page_id LONG, url STRING, html STRING")
    archives = warc.write_archives(pages.coalesce(1), scratch_dir(spark, "warc"))
    for range_bytes in (warc.RANGE_BYTES, 100_000):
        got = {r["id"]: (r["url"], bytes(r["payload"]).decode()) for r in warc.read_archives(archives, range_bytes=range_bytes).collect()}
        assert got == {i: (u, f"<p>{i}") for i, u in enumerate(urls)}


def test_missing_records_are_an_error(spark):
    pages = spark.createDataFrame([(1, "u", "a"), (2, "u", "b")], "page_id LONG, url STRING, html STRING")
    archives = warc.write_archives(pages.coalesce(1), scratch_dir(spark, "warc"))
    assert warc.read_archives(archives).count() == 2
    with pytest.raises(ValueError, match="3 records were written, 2 are found"):
        warc.read_archives(archives.withColumn("records", archives["records"] + 1))


def test_a_task_reads_each_range(spark):
    noise = np.random.default_rng(5)
    pages = spark.createDataFrame([(i, "u", noise.bytes(2_000).hex()) for i in range(300)], "page_id LONG, url STRING, html STRING")
    archives = warc.write_archives(pages.repartition(2), scratch_dir(spark, "warc"))
    read = warc.read_archives(archives, range_bytes=20_000)
    ranges = archives.selectExpr("sum(ceil(size / 20000))").first()[0]
    tasks = read.groupBy(F.spark_partition_id()).count().collect()
    assert ranges > 20 and read.rdd.getNumPartitions() == ranges and len(tasks) > 0.9 * ranges
    assert read.count() == 300


def test_a_record_lost_in_a_range_is_an_error(spark):
    pages = spark.createDataFrame([(i, "u", "x" * i) for i in range(40)], "page_id LONG, url STRING, html STRING")
    archives = warc.write_archives(pages.coalesce(1), scratch_dir(spark, "warc"))
    more = archives.withColumn("starts", F.array_append("starts", F.lit(5).cast("long"))).withColumn("records", F.col("records") + 1)
    with pytest.raises(Exception, match="41 records were written, 40 are found"):
        warc.read_archives(more).collect()
    assert warc.read_archives(archives.select("path", "size")).count() == 40  # a list from elsewhere


def test_tokenizers_that_cut_otherwise_encode_whole_texts(spark, tmp_path):
    assert tokencodes.cuts_at_spaces(PATH)
    assert not tokencodes.cuts_at_spaces(public_tokenizers.path("word_bpe_49k.json"))
    other = public_tokenizers.path("word_bpe_49k.json")
    docs = spark.createDataFrame([(1, "Some  Words, and more"), (2, None)], "doc_id LONG, text STRING")
    rows = {r["id"]: r["ids"] for r in tokencodes.round_trip(spark, docs, other, 7).collect()}
    assert rows == {1: [*Tokenizer.from_file(other).encode("Some  Words, and more", add_special_tokens=False).ids, 7], 2: [7]}
    assert "ids" not in tokencodes.round_trip(spark, docs, other, 7, with_ids=False).columns
