"""Operator 11: counts of all prefixes against the library, and the questions they answer."""

import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from skilltide.llm import prefixcounts
from skilltide.llm.prefixcounts import Counter, PieceModel

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def counter():
    return Counter(PieceModel(PATH))


def prefixes(counter, texts):
    steps, at = counter.texts(texts)
    found = []
    for a, b in zip(at, at[1:], strict=False):
        sums = [0]
        for x in steps[a:b].tolist():
            sums.append(sums[-1] + x)
        found.append(sums)
    return found


def test_every_prefix(library, counter):
    draw = random.Random(11)
    signs = "  ▁▁abtheing,.\n\té日本語<s>0x0A\0😀ﬁ​'"
    texts = ["", " ", "  ", "<s>", "</s><unk>", "<0x0A>", "a" * 300, " " * 300, "ab" * 200, "▁" * 40 + "x"]
    texts += ["".join(draw.choice(signs) for _ in range(draw.randint(0, 90))) for _ in range(120)]
    texts += ["".join(draw.choice("the and of ing er on") for _ in range(150)) for _ in range(30)]
    for text, found in zip(texts, prefixes(counter, texts), strict=True):
        assert found == [len(library.encode(text[:i])) for i in range(len(text) + 1)], text


def test_documents(documents, library):
    rows = prefixcounts.prefix_counts(documents, PATH).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in documents.collect()}
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r["id"]]
        assert (r["n_bytes"], r["n_chars"], r["n_tokens"]) == (len(text.encode()), len(text), len(library.encode(text)))


def test_questions(spark, library, monkeypatch):
    text = "The first of the things, and then\n" * 400 + "日本 end"
    docs = spark.createDataFrame([(1, text, 5), (2, text, 9000), (3, "", 3), (4, None, 3), (5, text, None)], "doc_id LONG, text STRING, at LONG")
    counts = prefixcounts.prefix_counts(docs, PATH)
    place = F.when(F.col("id") == 2, 9000).when(F.col("id") == 5, F.lit(None)).when(F.col("id") == 1, 5).otherwise(3)
    found = {r["id"]: r["tokens"] for r in prefixcounts.prefix_tokens(counts, place).collect()}
    assert found == {1: len(library.encode(text[:5])), 2: len(library.encode(text[:9000])), 3: 0, 4: 0, 5: None}
    for budget in (0, 1, 7, 2500, 10**6):
        cut = {r["id"]: (r["n_chars"], r["n_tokens"]) for r in prefixcounts.longest_prefix(counts, budget).collect()}
        end, n = cut[1]
        assert n == len(library.encode(text[:end])) <= budget and cut[3] == (0, 0)
        assert all(len(library.encode(text[:i])) > budget for i in range(end + 1, min(end + 40, len(text) + 1)))


def test_steps_that_do_not_fit(counter, library):
    class Wide(Counter):
        def __missing__(self, part):
            return None

    text = "some words of a text"
    steps, _ = Wide(counter.model).texts([text, "", text])
    assert steps.itemsize == 4 and steps.tolist() == counter.texts([text, "", text])[0].tolist()


def test_odd_rows(odd, none, library):
    rows = prefixcounts.prefix_counts(odd, PATH).collect()
    given = odd.select("doc_id", "text").collect()
    assert sorted((r["id"] is None, r["id"] or 0, r["n_tokens"]) for r in rows) == sorted(
        (r["doc_id"] is None, r["doc_id"] or 0, len(library.encode(r["text"] or ""))) for r in given
    )
    assert prefixcounts.prefix_counts(none, PATH).count() == 0


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as file:
        model.ParseFromString(file.read())
    model.normalizer_spec.remove_extra_whitespaces = True
    path = tmp_path / "other.model"
    path.write_bytes(model.SerializeToString())
    with pytest.raises(ValueError, match="without normalisation"):
        PieceModel(str(path))
