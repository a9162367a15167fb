"""I-1, I-8, I-9: files, month-partitioned layers, line-delimited JSON."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan(
    spark: SparkSession,
    path: str,
    where: Column | str | None = None,
    columns: list[str] | None = None,
    limit: int | None = None,
    source: str = "parquet",
    schema: T.StructType | None = None,
    **options: str,
) -> DataFrame:
    """I-1: read a collection. Filter and columns reach the scan; no match is an empty frame.

    ``source`` is any installed data source, for example ``mongodb`` where its connector is.
    """
    reader = spark.read.format(source).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path) if path else reader.load()
    if where is not None:
        df = df.filter(where)
    if columns:
        df = df.select(*columns)
    return df if limit is None else df.limit(limit)


def read_if_exists(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame | None:
    """A Parquet folder, or None when nothing was written there yet."""
    try:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def layer_path(root: str, layer: str, table: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{table}"


def _hadoop(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def drop_months(spark: SparkSession, path: str, months: list[str]) -> None:
    """Remove the folders of months from a table kept by ``month``, on any Hadoop file system."""
    for month in months:
        drop_folder(spark, f"{path}/month={month}")


def drop_folder(spark: SparkSession, path: str) -> None:
    system, folder = _hadoop(spark, path)
    system.delete(folder, True)


# Layers ----------------------------------------------------------------------------------------
#
# A run writes the months of its tables into folders of its own, and then one manifest: a small file that says
# for each table of the lake which run holds each month. Readers take the newest manifest, so they see all of
# a run or nothing of it, and a run that fails before its manifest changed nothing.

NO_MONTH = "__HIVE_DEFAULT_PARTITION__"  # Fixed value: the folder of a null month.


@dataclass(frozen=True)
class Staged:
    """Months of a table that are written but not in a manifest yet."""

    table: str
    run: str
    schema: str
    found: tuple[str, ...]
    range: tuple[str, str] | None


def _manifests(spark: SparkSession, root: str) -> list[int]:
    system, folder = _hadoop(spark, f"{root.rstrip('/')}/_manifests")
    if not system.exists(folder):
        return []
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def _read_manifest(spark: SparkSession, root: str, version: int) -> dict:
    system, file = _hadoop(spark, f"{root.rstrip('/')}/_manifests/{version:012d}.json")
    stream = system.open(file)
    try:
        return json.loads(bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
    finally:
        stream.close()


def snapshot(spark: SparkSession, root: str) -> dict:
    """What the newest manifest says: table to its schema and its months, month to run."""
    versions = _manifests(spark, root)
    return _read_manifest(spark, root, versions[-1]) if versions else {}


def commit(spark: SparkSession, root: str, staged: list[Staged]) -> None:
    """Make the months of staged tables the ones that readers see, all in one step: the manifest is written
    under another name and renamed, which fails if a run elsewhere was first; then its months are taken in."""
    while True:
        versions = _manifests(spark, root)
        tables = _read_manifest(spark, root, versions[-1]) if versions else {}
        for s in staged:
            held = tables.get(s.table, {"months": {}})["months"]
            stays = {m: r for m, r in held.items() if not (s.range and s.range[0] <= m[:7] <= s.range[1])}
            tables[s.table] = {"schema": s.schema, "months": {**stays, **dict.fromkeys(s.found, s.run)}}
        version = (versions[-1] if versions else 0) + 1
        system, draft = _hadoop(spark, f"{root.rstrip('/')}/_manifests/.{uuid.uuid4().hex}")
        stream = system.create(draft, False)
        stream.write(bytearray(json.dumps(tables, sort_keys=True).encode()))
        stream.close()
        _, final = _hadoop(spark, f"{root.rstrip('/')}/_manifests/{version:012d}.json")
        if not system.exists(final) and system.rename(draft, final):
            return
        system.delete(draft, False)


def stage_layer(
    df: DataFrame,
    root: str,
    layer: str,
    table: str,
    observation: Observation | None = None,
    months: tuple[dt.date | str, dt.date | str] | None = None,
    by_month: bool = False,
) -> Staged:
    """Write the months of ``df`` (column ``month``) where no reader sees them before ``commit``.

    The rebalance hint sizes the files and splits a month that outgrows one task. Rows are
    observed after it, where a stage found empty is still counted. With ``by_month`` the rows are those of a
    layer, read and changed one by one: they lie by month already and are written where they are, in no more files
    than the pieces that were read.
    """
    run = uuid.uuid4().hex
    out = df if by_month else df.hint("rebalance", "month")
    if observation is not None:
        out = out.observe(observation, F.count(F.lit(1)).alias("row_count"))
    path = f"{layer_path(root, layer, table)}/run={run}"
    out.write.partitionBy("month").parquet(path)
    span = None if months is None else (str(months[0])[:7], str(months[1])[:7])
    return Staged(f"{layer}/{table}", run, df.schema.json(), _months_in(df.sparkSession, path), span)


def _months_in(spark: SparkSession, path: str) -> tuple[str, ...]:
    """The months that a written folder has."""
    system, folder = _hadoop(spark, path)
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    return tuple(sorted(n.removeprefix("month=") for n in names if n.startswith("month=")))


def write_layer(
    df: DataFrame,
    root: str,
    layer: str,
    table: str,
    observation: Observation | None = None,
    months: tuple[dt.date | str, dt.date | str] | None = None,
) -> str:
    """I-8: replace the months present in ``df`` (column ``month``) in one step, keep the others.

    ``months`` is the first and last day the run is for: a month of that range that ``df`` has no
    row of is removed, so a repeated run never leaves rows of an earlier one.
    """
    commit(df.sparkSession, root, [stage_layer(df, root, layer, table, observation, months)])
    return layer_path(root, layer, table)


def _of_runs(spark: SparkSession, path: str, months: dict[str, str], schema: T.StructType) -> DataFrame:
    if not months:
        return spark.createDataFrame([], schema)
    folders = [f"{path}/run={run}/month={month}" for month, run in sorted(months.items())]
    read = spark.read.schema(schema).option("basePath", path).parquet(*folders)
    return read.select(*schema.names)


def read_staged(spark: SparkSession, root: str, staged: Staged) -> DataFrame:
    """The rows of a staged table, for the run that staged it."""
    schema = T.StructType.fromJson(json.loads(staged.schema))
    return _of_runs(spark, f"{root.rstrip('/')}/{staged.table}", dict.fromkeys(staged.found, staged.run), schema)


def read_layer(
    spark: SparkSession,
    root: str,
    layer: str,
    table: str,
    month: dt.date | str | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """I-8: read a layer as of the newest manifest; a month prunes to its folder. With a schema a layer that was
    never written is an empty frame."""
    held = snapshot(spark, root).get(f"{layer}/{table}")
    if held is None:
        if schema is None:
            raise ValueError(f"{layer}/{table} was never written in {root}")
        return spark.createDataFrame([], schema)
    kind = schema or T.StructType.fromJson(json.loads(held["schema"]))
    df = _of_runs(spark, layer_path(root, layer, table), held["months"], kind)
    return df if month is None else df.filter(F.col("month") == F.lit(str(month)).cast("date"))


def layer_exists(spark: SparkSession, root: str, layer: str, table: str) -> bool:
    return f"{layer}/{table}" in snapshot(spark, root)


def vacuum(spark: SparkSession, root: str, keep: int = 1) -> int:
    """Delete the runs that none of the newest ``keep`` manifests names, and the older manifests. Not while a run is
    going on, whose folders are in no manifest yet. Returns the number of runs deleted."""
    versions = _manifests(spark, root)
    kept = [_read_manifest(spark, root, v) for v in versions[-keep:]]
    gone = 0
    for table in {t for manifest in kept for t in manifest}:
        live = {f"run={r}" for manifest in kept for r in manifest.get(table, {"months": {}})["months"].values()}
        system, folder = _hadoop(spark, f"{root.rstrip('/')}/{table}")
        for status in system.listStatus(folder) if system.exists(folder) else ():
            if status.getPath().getName().startswith("run=") and status.getPath().getName() not in live:
                system.delete(status.getPath(), True)
                gone += 1
    for version in versions[:-keep]:
        system, file = _hadoop(spark, f"{root.rstrip('/')}/_manifests/{version:012d}.json")
        system.delete(file, False)
    return gone


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """I-9"""
    return spark.read.schema(schema).json(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "append") -> None:
    """I-9: one object per line; null fields are kept, as readers expect every key."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)
