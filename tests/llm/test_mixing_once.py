"""Operator 7 classifies once where it can."""

from pyspark.sql import functions as F

from skilltide.llm import mixing


def test_mixing_classifies_rows_without_texts_once(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"word{i % 2} text") for i in range(20)] + [(None, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    passes, real = [], mixing.classified
    monkeypatch.setattr(mixing, "classified", lambda *a: passes.append(1) or real(*a))
    short, _ = mixing.mixture(docs, labels, carry=["doc_id"])
    assert len(passes) == 1
    whole, _ = mixing.mixture(docs, labels)
    names = ["doc_id", "n_tokens", F.round("rate", 4).alias("rate"), "copies"]
    assert sorted(map(str, short.select(*names).collect())) == sorted(map(str, whole.select(*names).collect()))
