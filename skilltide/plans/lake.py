"""J-1..J-4: parse, lake and warehouse runs.

Layers are written tables: a run reads what the layer before wrote, so a lost executor never
costs more than the layer at hand. All layers of a run are shown to readers in one step, at its end.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skilltide.operators.extract import (
    LIST_FIELDS,
    METADATA,
    extract_entities,
    extract_levels,
    guard_size,
    model_input,
    unparsed,
)
from skilltide.operators.ingest import bronze_slice
from skilltide.operators.model import ROW_BY_ROW, gold_tables, metrics_of
from skilltide.operators.normalize import THRESHOLD, field_mapping, moves_no_row, silver_postings
from skilltide.operators.vocab import evolve_vocab, new_values
from skilltide.schemas import PARSED_POSTING, WAREHOUSE
from skilltide.session import saved
from skilltide.sources.files import Staged, commit, layer_exists, layer_path, read_layer, read_staged, stage_layer
from skilltide.sources.warehouse import load_table


def run_parse(
    raw: DataFrame,
    parsed: DataFrame,
    vocab: DataFrame,
    at: dt.date | str,
    limit: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """J-3: parsed postings of the raw ones not parsed yet, by vocabulary extraction.

    The position is the first vocabulary position named in the text, the levels are P-11's. Texts
    end at the extraction; only hits and metadata meet again. Texts are read whole; with
    ``max_bytes`` larger ones are left out and named in the column ``error`` (P-2).
    """
    todo = unparsed(raw, parsed)
    if limit is not None:
        # A limit may pick other rows each time it is read, so the batch is kept.
        batch = saved(unparsed(raw.select("_id"), parsed, limit), "batch")
        todo = raw.join(batch, "_id", "left_semi")
    if max_bytes is not None:
        todo = guard_size(todo, max_bytes)
    texts = todo.select("_id", model_input("job_title", "full_text_jd").alias("text"))
    found = extract_entities(texts, vocab, "_id", "text")

    def terms_of(category: str) -> Column:
        return F.first(F.when(F.col("category") == category, F.col("terms")), ignorenulls=True)

    fields = found.groupBy("_id").agg(
        *[terms_of(name).alias(name) for name in LIST_FIELDS if name != "seniority_level"],
        F.get(terms_of("job_position"), F.lit(0)).alias("job_position"),
    )
    metadata = todo.select(
        "_id",
        *[F.coalesce(c, F.lit("")).alias(c) for c in METADATA],
        extract_levels(model_input("job_title", "full_text_jd")).alias("seniority_level"),
        *(["error"] if max_bytes is not None else []),
    )
    stamped = metadata.join(fields, "_id", "left").withColumns(
        {"update_date": F.lit(str(at)), "salary": F.lit(None).cast("string")}
    )
    return stamped.select(*PARSED_POSTING.names, *(["error"] if max_bytes is not None else []))


def bronze(parsed: DataFrame, first: dt.date | str, last: dt.date | str | None = None) -> DataFrame:
    """Parsed postings of a month (or months) with their month. A day that does not exist
    still has a month, as dates are compared as text here."""
    rows = bronze_slice(parsed, first, "posted_date", last)
    month = F.concat(F.substring("posted_date", 1, 7), F.lit("-01"))
    return rows.withColumn("month", month.try_cast("date"))


def _at_once(writes: list[Callable[[], object]]) -> list[object]:
    """Independent small writes side by side, so their tasks share the cluster."""
    with ThreadPoolExecutor(max_workers=4) as pool:
        return list(pool.map(lambda write: write(), writes))


def _run(
    parsed: DataFrame,
    vocab: DataFrame,
    root: str,
    first: dt.date | str,
    last: dt.date | str | None,
    threshold: int | None,
) -> dict[str, dict[str, object]]:
    spark = parsed.sparkSession
    partition = str(first) if last is None else f"{first}..{last}"
    metrics: dict[str, dict[str, object]] = {}
    staged: list[Staged] = []

    def keep(df: DataFrame, layer: str, table: str, by_month: bool = False) -> DataFrame:
        observation = Observation(f"{layer}.{table}")
        staged.append(here := stage_layer(df, root, layer, table, observation, (first, last or first), by_month))
        metrics[f"{layer}.{table}"] = metrics_of(df, observation, partition)
        return read_staged(spark, root, here)

    bronze_rows = keep(bronze(parsed, first, last), "bronze", "job_descriptions")
    mapping = field_mapping(bronze_rows, vocab, threshold=threshold)
    in_row = moves_no_row(mapping)
    silver = keep(silver_postings(bronze_rows, mapping, in_row), "silver", "job_descriptions", in_row)
    gold = gold_tables(silver)
    _at_once([lambda t=t, df=df: keep(df, "gold", t, t in ROW_BY_ROW) for t, df in gold.items()])
    added = new_values(mapping)
    following = layer_path(root, "vocab", partition)
    evolve_vocab(vocab, added).write.mode("overwrite").parquet(following)
    commit(spark, root, staged)
    return metrics


def run_datalake(
    parsed: DataFrame,
    vocab: DataFrame,
    root: str,
    month: dt.date | str,
    threshold: int | None = THRESHOLD,
) -> dict[str, dict[str, object]]:
    """J-1: bronze, silver and gold of one month, and the vocabulary for the next run."""
    return _run(parsed, vocab, root, month, None, threshold)


def backfill(
    parsed: DataFrame,
    vocab: DataFrame,
    root: str,
    first: dt.date | str,
    last: dt.date | str,
    threshold: int | None = THRESHOLD,
) -> dict[str, dict[str, object]]:
    """J-4: many months in one run; the month is a column, so no loop over months."""
    return _run(parsed, vocab, root, first, last, threshold)


def run_warehouse(
    spark: SparkSession, lake: str, warehouse: str, month: dt.date | str
) -> dict[str, bool]:
    """J-2: load one month of the eight gold tables; says which had rows."""

    def load(table: str) -> bool:
        # a layer that was never written has no month
        if not layer_exists(spark, lake, "gold", table):
            return False
        return load_table(read_layer(spark, lake, "gold", table, month).drop("month"), warehouse, table, month)

    return dict(zip(WAREHOUSE, _at_once([lambda t=t: load(t) for t in WAREHOUSE])))
