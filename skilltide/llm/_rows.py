"""Column names that cannot clash, and the package's code for executors that lack it."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import skilltide

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give executors this package through Spark's own file server, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(skilltide.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="skilltide-code-"), "skilltide.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    whole = os.path.join(folder, name)
                    out.write(whole, os.path.join("skilltide", os.path.relpath(whole, root)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without its columns of these names, whatever their case."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])
