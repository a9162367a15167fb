"""L-1..L-3: the eight warehouse tables as Parquet or behind JDBC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skilltide.operators.titles import KEYS, TitleIndex, title_index
from skilltide.schemas import WAREHOUSE
from skilltide.sources.files import drop_folder, drop_months, read_if_exists


def _with_month(df: DataFrame, month: dt.date | str) -> DataFrame:
    return df.withColumn("month", F.lit(str(month)).cast("date"))


def load_table(
    df: DataFrame, root: str, table: str, month: dt.date | str | None = None
) -> bool:
    """L-1: write one month of a table, or the whole table when it has no months.

    A month is replaced, not appended, so a load can be repeated; an empty one is removed.
    Returns whether there were rows: they are counted as they are written, so ``df`` is computed once.
    """
    out = WAREHOUSE[table].conform(df)
    path = f"{root.rstrip('/')}/{table}"
    if month is not None:
        out = _with_month(out, month)
    spark, seen = df.sparkSession, Observation(f"load {table}")
    kept = month is None and read_if_exists(spark, path) is not None
    writer = out.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    if "month" in out.columns:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy("month")
    writer.parquet(path)
    if seen.get.get("rows"):
        return True
    if month is not None:
        drop_months(spark, path, [str(month)])
    elif not kept:
        drop_folder(spark, path)
    elif "month" in out.columns:
        out.write.mode("overwrite").parquet(path)  # no month was overwritten
    return False


def read_table(
    spark: SparkSession, root: str, table: str, month: dt.date | str | None = None
) -> DataFrame:
    """L-2: a table, or one month of it; a table that was never loaded is empty."""
    df = read_if_exists(spark, f"{root.rstrip('/')}/{table}")
    if df is None:
        fields = [T.StructField(c, T.StringType()) for c in WAREHOUSE[table].columns]
        schema = T.StructType([*fields, T.StructField("month", T.DateType())])
        return spark.createDataFrame([], schema)
    if month is None:
        return df
    return df.filter(F.col("month") == F.lit(str(month)).cast("date"))


def register_tables(spark: SparkSession, root: str, schema: str) -> None:
    """Create the schema and a catalog table over every loaded folder."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    for table in WAREHOUSE:
        df = read_if_exists(spark, f"{root.rstrip('/')}/{table}")
        if df is None:
            continue
        name = f"{schema}.{table}"
        if not spark.catalog.tableExists(name):
            spark.catalog.createTable(name, path=f"{root.rstrip('/')}/{table}", source="parquet")
        if "month" in df.columns:
            spark.catalog.recoverPartitions(name)


def load_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    month: dt.date | str | None = None,
    properties: dict[str, str] | None = None,
) -> bool:
    """L-1 against a database: replace a month, or a table without months.

    The month's rows are deleted first, so a repeated load does not double them.
    """
    out = WAREHOUSE[table.split(".")[-1]].conform(df)
    if month is not None:
        _delete_month(df.sparkSession, url, table, month, properties or {})
    if out.isEmpty():
        return False
    out = out if month is None else _with_month(out, month)
    out.write.jdbc(
        url, table, mode="overwrite" if month is None else "append", properties=properties or {}
    )
    return True


def _delete_month(
    spark: SparkSession, url: str, table: str, month: dt.date | str, properties: dict[str, str]
) -> None:
    jvm = spark.sparkContext._jvm
    given = jvm.java.util.Properties()
    for key, value in properties.items():
        given.setProperty(key, value)
    connection = jvm.java.sql.DriverManager.getConnection(url, given)
    try:
        if connection.getMetaData().getTables(None, None, table.split(".")[-1], None).next():
            statement = connection.prepareStatement(f"DELETE FROM {table} WHERE month = ?")
            statement.setDate(1, jvm.java.sql.Date.valueOf(str(month)))
            statement.executeUpdate()
    finally:
        connection.close()


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    month: dt.date | str | None = None,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """L-2 against a database: a table, or one month of it; the filter is the database's."""
    df = spark.read.jdbc(url, table, properties=properties or {})
    return df if month is None else df.filter(F.col("month") == F.lit(str(month)).cast("date"))


def save_serving(tables: dict[str, DataFrame], schema: str, root: str, buckets: int) -> None:
    """Keep the serving tables as catalog tables, with the index of the titles.

    Jobs and pairs are bucketed by the job, so the joins between them need no shuffle; each
    bucket is gathered before it is written, so it is one file. Jobs are also kept by month,
    which the date filter of the demand queries prunes by.
    """
    spark = tables["jobs"].sparkSession
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    bucketed = {"jobs": "id", "job_skills": "job_id"}
    for name, df in tables.items():
        if name == "jobs":
            df = df.withColumn("month", F.trunc("posted_date", "month"))
        key = bucketed.get(name)
        writer = (df.repartition(buckets, key) if key else df).write.mode("overwrite")
        if key:
            writer = writer.bucketBy(buckets, key).sortBy(key)
        if name == "jobs":
            writer = writer.partitionBy("month")
        writer.option("path", f"{root.rstrip('/')}/{name}").saveAsTable(f"{schema}.{name}")
    save_title_index(tables["jobs"], schema, root, buckets)


def save_title_index(jobs: DataFrame, schema: str, root: str, buckets: int) -> None:
    """Keep the index of the titles by month, each part bucketed by what it is looked up by. The months of
    ``jobs`` replace theirs; the others stay. Only postings with a date are in it."""
    spark, mode = jobs.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    index, before = title_index(jobs), spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")  # of an insert into a catalog table it is the session's
    try:
        for part, key in KEYS.items():
            name, df = f"{schema}.title_{part}", getattr(index, part).repartition(buckets, key)
            if spark.catalog.tableExists(name):
                df.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
            else:
                writer = df.write.partitionBy("month").bucketBy(buckets, key).sortBy(key)
                writer.option("path", f"{root.rstrip('/')}/title_{part}").saveAsTable(name)
    finally:
        spark.conf.set(mode, before)


def read_title_index(spark: SparkSession, schema: str) -> TitleIndex:
    return TitleIndex(**{part: spark.table(f"{schema}.title_{part}") for part in KEYS})
