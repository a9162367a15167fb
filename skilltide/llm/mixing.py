"""Mixing to target weights by soft membership (operator 7).

A classifier learned from the labelled table gives each document a posterior over domains, and
with it every document belongs to every domain in part. Wanted are rates ``r`` per document, none
negative, whose expected tokens per domain, ``sum(r * tokens * posterior)``, match the targets, and
which are otherwise near one. That is least squares with one unknown per document:

    sum over domains of (expected - target)^2 / present  +  RIDGE * sum of tokens * (r - 1)^2

Accelerated projected gradient steps solve it. A document's gradient needs its own posterior and the
domains' residuals only. So one step is one sum per domain over the slim table; rates are recomputed
from the residuals of earlier steps instead of stored, and a lost executor costs nothing but its tasks.

The classifier is a multinomial logistic regression over the hashed words and signs that depend on the domain most
(chi-squared), fitted on at most
about ``MAX_LABELLED`` labelled documents, taken by the hash of their id. All else covers all rows.

Null or empty text: no tokens, posterior of an empty text, no weight. A null id has no label; a row
repeated counts each time. Several labels of one id: the least counts. No labels or a single domain: its posterior
is one. Empty documents: empty result. Columns called like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, RegexTokenizer, UnivariateFeatureSelector
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skilltide.llm._rows import fresh, without
from skilltide.session import saved

MAX_LABELLED = 20_000
FEATURES = 1 << 15
TELLING = 200  # features the classifier uses
RIDGE = 1e-3
STEPS = 60
CLOSE = 0.002  # of the sum of targets
# Target tokens of a domain as a multiple of those present; a domain not named keeps its own.
MULTIPLES = {
    "quality=1,toxic=0": 1.0,
    "quality=0,toxic=0": 0.5,
    "quality=1,toxic=1": 0.25,
    "quality=0,toxic=1": 0.1,
}


def _featured(docs: DataFrame) -> DataFrame:
    """Adds ``__words`` and ``__counts`` to ``docs(__text, ...)``."""
    stages = [
        RegexTokenizer(inputCol="__text", outputCol="__words", gaps=False, toLowercase=False, minTokenLength=1, pattern=r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+"),
        HashingTF(inputCol="__words", outputCol="__counts", numFeatures=FEATURES, binary=True),
    ]
    return PipelineModel(stages).transform(docs)


def learn(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_id: str, max_labelled: int):
    """The domains, and the model that predicts them, or None if there is but one."""
    names = [c for c in labels.columns if c != label_id]
    parts = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("null"))) for c in sorted(names)]
    named = labels.filter(F.col(f"`{label_id}`").isNotNull()).groupBy(F.col(f"`{label_id}`").alias("label_id")).agg(F.min(F.concat_ws(",", *parts)).alias("domain"))
    share = min(1.0, max_labelled / max(1, labels.count()))
    bounded = named.filter(F.pmod(F.xxhash64("label_id"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))
    bounded = saved(bounded, "labels")  # at most about max_labelled short rows
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("__text"))
    joined = rows.join(F.broadcast(bounded), F.col("id") == F.col("label_id")).select("__text", "domain")
    train = saved(_featured(joined).select("__counts", "domain"), "labelled")
    domains = [r[0] for r in train.select("domain").distinct().orderBy("domain").collect()]
    if len(domains) < 2:
        return domains or ["unlabelled"], None
    number = F.array_position(F.lit(domains), F.col("domain")) - 1
    numbered = train.select("__counts", number.cast("double").alias("__label"))
    # words that say nothing about the domain only blur a posterior: keep those that depend on it most
    select = UnivariateFeatureSelector(
        featuresCol="__counts", outputCol="__features", labelCol="__label", selectionMode="numTopFeatures"
    ).setFeatureType("categorical").setLabelType("categorical").setSelectionThreshold(TELLING)
    chosen = select.fit(numbered)
    fit = LogisticRegression(
        featuresCol="__features", labelCol="__label", probabilityCol="__posterior", predictionCol="__guess",
        rawPredictionCol="__raw", family="multinomial", regParam=1e-2, maxIter=60,
    )
    return domains, PipelineModel([chosen, fit.fit(chosen.transform(numbered))])


def classified(docs: DataFrame, model, text_col: str) -> DataFrame:
    """``docs`` with ``__n`` (tokens) and ``__p`` (posteriors)."""
    rows = _featured(docs.withColumn("__text", F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))))
    if model is None:
        return rows.withColumn("__p", F.array(F.lit(1.0))).select(*[F.col(f"`{c}`") for c in docs.columns], F.size("__words").cast("long").alias("__n"), "__p")
    return model.transform(rows).select(
        *[F.col(f"`{c}`") for c in docs.columns], F.size("__words").cast("long").alias("__n"), vector_to_array("__posterior").alias("__p")
    )


def _rates(p: np.ndarray, steps: list[tuple[float, np.ndarray]]) -> np.ndarray:
    """Rates after the steps; each has its momentum and the residual per domain it saw."""
    before = r = np.ones(len(p))
    for momentum, residual in steps:
        y = r + momentum * (r - before)
        before, r = r, np.maximum(0.0, y - (p @ residual + RIDGE * (y - 1.0)) / (1.0 + RIDGE))
    return r


def _posteriors(column: pa.Array, k: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, k)


def _totals(k: int, steps):
    def run(batches):
        total = np.zeros(k)
        for batch in batches:
            p = _posteriors(batch.column(1), k)
            total += (batch.column(0).to_numpy() * _rates(p, steps)) @ p
        yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array(total)], ["domain", "tokens"])

    return run


def domain_tokens(slim: DataFrame, k: int, steps: list) -> np.ndarray:
    """Expected tokens per domain at the rates after ``steps``."""
    sums = slim.mapInArrow(_totals(k, steps), "domain int, tokens double").groupBy("domain").agg(F.sum("tokens")).collect()
    out = np.zeros(k)
    for domain, tokens in sums:
        out[domain] = tokens
    return out


def fit_rates(slim: DataFrame, multiples: np.ndarray) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
    """The steps to the rates; present, target and reached tokens per domain."""
    k = len(multiples)
    present = domain_tokens(slim, k, [])
    target, scale = present * multiples, np.maximum(present, 1.0)
    steps, before, now, t = [], present, present, 1.0
    while len(steps) < STEPS and np.abs(now - target).sum() > CLOSE * max(target.sum(), 1.0):
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        momentum, t = (t - 1) / after, after
        # tokens are linear in rates, so those at the point ahead need no pass
        steps.append((momentum, (now + momentum * (now - before) - target) / scale))
        before, now = now, domain_tokens(slim, k, steps)
    return steps, present, target, now


def _rate_column(steps, k: int, posterior: Column) -> Column:
    @F.pandas_udf("double")
    def rate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for p in batches:
            yield pd.Series(_rates(np.stack(p.to_numpy()) if len(p) else np.zeros((0, k)), steps))

    return rate(posterior)


def mixture(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", *,
    multiples: dict[str, float] | None = None, max_labelled: int = MAX_LABELLED, carry: list[str] | None = None,
) -> tuple[DataFrame, list[str]]:
    """The carried columns (all by default) with ``n_tokens``, ``posterior`` (an array over the domains
    returned beside it), ``rate`` and ``copies``: the rate rounded up with the chance of its
    fraction, drawn from the hash of id and text."""
    wanted = MULTIPLES if multiples is None else multiples
    docs = without(docs, ["n_tokens", "posterior", "rate", "copies"])
    domains, model = learn(docs, labels, id_col, text_col, label_id, max_labelled)
    keep = [F.col(f"`{c}`") for c in (carry if carry is not None else docs.columns)]
    draw = F.pmod(F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), F.lit("copies")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = docs.withColumn("__draw", draw)
    # rows without their text are kept with the posteriors; others are classified a second time, as texts cost more to store
    short = carry is not None and text_col not in carry
    first = [*[F.col(f"`{c}`") for c in dict.fromkeys(carry)], "__draw"] if short else []
    slim = saved(classified(drawn if short else docs.select(F.col(f"`{text_col}`")), model, text_col).select(*first, "__n", "__p"), "posteriors")
    steps, *_ = fit_rates(slim.select("__n", "__p"), np.array([wanted.get(d, 1.0) for d in domains]))
    rated = (slim if short else classified(drawn, model, text_col)).withColumn("__rate", _rate_column(steps, len(domains), F.col("__p")))
    whole = F.floor("__rate")
    return rated.select(
        *keep, F.col("__n").alias("n_tokens"), F.col("__p").alias("posterior"), F.col("__rate").alias("rate"),
        (whole + (F.col("__draw") < F.col("__rate") - whole).cast("long")).cast("int").alias("copies"),
    ), domains


def mix(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` as often as their copies say; columns stay."""
    names = ["n_tokens", "posterior", "rate", "copies"]
    clash = {c: fresh(docs, f"{c}_") for c in docs.columns if c.lower() in names}
    named = docs.withColumnsRenamed(clash)
    rated, _ = mixture(named, labels, id_col, text_col, **options)
    many = rated.filter("copies > 0").withColumn("copies", F.explode(F.expr("sequence(1, copies)")))
    return many.select(*named.columns).withColumnsRenamed({v: k for k, v in clash.items()})
