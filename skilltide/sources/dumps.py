"""I-1: dumps of a document store, one extended JSON object a line, as a data source.

``spark.read.format("extjson").schema(...).load(path)`` after ``register(spark)``. Files are cut into byte ranges, a task
each, which begin and end at line ends. Comparisons of top-level fields with values are pushed into the tasks, which drop
documents before they are converted to columns; everything else stays with Spark. Needs
``spark.sql.python.filterPushdown.enabled`` for that; ``scan_dump`` sets it.

A missing field and JSON null are null. A document that is no JSON object is an error that names file and place. Files
are opened through Arrow's filesystems (local, HDFS, S3, GCS).
"""

from __future__ import annotations

import base64
import datetime as dt
import decimal
import io
import json
import operator
import sys
from collections.abc import Iterable, Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
)

# Ship this module's code with the source, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RANGE_BYTES = 32 << 20
ROWS = 4096
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"

_COMPARED = {
    EqualTo: operator.eq, GreaterThan: operator.gt, GreaterThanOrEqual: operator.ge, LessThan: operator.lt, LessThanOrEqual: operator.le,
}


def _moment(value) -> dt.datetime:
    if isinstance(value, dict):
        value = int(value["$numberLong"])
    if isinstance(value, int):
        return dt.datetime(1970, 1, 1, tzinfo=dt.UTC) + dt.timedelta(milliseconds=value)
    found = dt.datetime.fromisoformat(value)
    return found if found.tzinfo else found.replace(tzinfo=dt.UTC)


# The wrappers of extended JSON.
_WRAPPERS = {
    "$oid": str,
    "$date": _moment,
    "$numberInt": int,
    "$numberLong": int,
    "$numberDouble": float,
    "$numberDecimal": decimal.Decimal,
    "$uuid": str,
    "$symbol": str,
    "$binary": lambda v: base64.b64decode(v["base64"] if isinstance(v, dict) else v),
    "$undefined": lambda v: None,
}


def plain(value):
    """A value of extended JSON without its wrappers."""
    if isinstance(value, list):
        return [plain(x) for x in value]
    if isinstance(value, dict):
        if len(value) == 1:
            ((name, inner),) = value.items()
            if name in _WRAPPERS:
                return _WRAPPERS[name](inner)
        return {k: plain(v) for k, v in value.items()}
    return value


def as_type(value, kind: T.DataType):
    """A plain value as a column's; null if it is of another kind, but any value fits a text."""
    if value is None:
        return None
    if isinstance(kind, T.StringType):
        if isinstance(value, str):
            return value
        if isinstance(value, dt.datetime):
            return value.isoformat()
        return json.dumps(value, default=str, ensure_ascii=False)
    if isinstance(kind, T.ArrayType):
        return [as_type(x, kind.elementType) for x in value] if isinstance(value, list) else None
    if isinstance(kind, T.StructType):
        return {f.name: as_type(value.get(f.name), f.dataType) for f in kind} if isinstance(value, dict) else None
    if isinstance(kind, T.MapType):
        return {str(k): as_type(v, kind.valueType) for k, v in value.items()} if isinstance(value, dict) else None
    if isinstance(kind, T.BooleanType):
        return value if isinstance(value, bool) else None
    if isinstance(value, bool):
        return None
    if isinstance(kind, T.IntegralType):
        return int(value) if isinstance(value, int) or (isinstance(value, float) and value.is_integer()) else None
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        return float(value) if isinstance(value, int | float | decimal.Decimal) else None
    if isinstance(kind, T.DecimalType):
        if not isinstance(value, int | float | decimal.Decimal):
            return None
        return decimal.Decimal(str(value)).quantize(decimal.Decimal(1).scaleb(-kind.scale))
    if isinstance(kind, T.TimestampType):
        return value if isinstance(value, dt.datetime) else None
    if isinstance(kind, T.DateType):
        return value.date() if isinstance(value, dt.datetime) else None
    return value if isinstance(kind, T.BinaryType) and isinstance(value, bytes) else None


def _holds(filter: Filter, value) -> bool:
    """What Spark means by a filter, on one column's value."""
    if isinstance(filter, IsNull):
        return value is None
    if isinstance(filter, EqualNullSafe):
        return value == filter.value
    if value is None:
        return False
    if isinstance(filter, IsNotNull):
        return True
    if isinstance(filter, In):
        return value in filter.value
    return _COMPARED[type(filter)](value, filter.value)


class _Raw(io.RawIOBase):
    """A file of Arrow's as one of Python's."""

    def __init__(self, file):
        self.file = file

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        found = self.file.read(len(into))
        into[: len(found)] = found
        return len(found)


class _Range(InputPartition):
    def __init__(self, uri: str, start: int, end: int):
        super().__init__((uri, start, end))


class _Reader(DataSourceReader):
    def __init__(self, schema: T.StructType, path: str, range_bytes: int):
        self.schema, self.path, self.range_bytes = schema, path, range_bytes
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        simple = {f.name: f.dataType for f in self.schema}
        kinds = (T.StringType, T.IntegralType, T.BooleanType)
        for f in filters:
            taken = type(f) in {*_COMPARED, In, IsNull, IsNotNull, EqualNullSafe} and len(f.attribute) == 1
            if taken and isinstance(simple.get(f.attribute[0]), kinds):
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[_Range]:
        from pyarrow import fs

        uri = "/" + self.path[5:].lstrip("/") if self.path.startswith("file:") else self.path.rstrip("/")
        where, path = fs.FileSystem.from_uri(uri)
        found = [where.get_file_info(path)]
        if found[0].type == fs.FileType.Directory:
            found = where.get_file_info(fs.FileSelector(path, recursive=True))
        files = [x for x in found if x.is_file and not x.base_name.startswith(("_", "."))]
        prefix = uri[: len(uri) - len(path)] if uri.endswith(path) else ""
        cut = [_Range(prefix + x.path, at, min(at + self.range_bytes, x.size)) for x in files for at in range(0, x.size, self.range_bytes)]
        return cut or [_Range("", 0, 0)]

    def _lines(self, uri: str, start: int, end: int) -> Iterator[tuple[int, bytes]]:
        """The lines that begin in a byte range, with their places."""
        from pyarrow import fs

        where, path = fs.FileSystem.from_uri(uri)
        with where.open_input_file(path) as raw:
            raw.seek(max(start - 1, 0))
            file = io.BufferedReader(_Raw(raw), 1 << 20)
            at = start
            if start:
                at = start - 1 + len(file.readline())  # the rest of a line that began before
            while at < end and (line := file.readline()):
                yield at, line
                at += len(line)

    def read(self, partition: _Range):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = [(f.name, f.dataType) for f in self.schema]
        arrow, rows = to_arrow_schema(self.schema), []
        by_name = dict(kinds)
        uri, start, end = partition.value
        for at, line in self._lines(uri, start, end) if uri else ():
            if not line.strip():
                continue
            try:
                document = json.loads(line)
            except ValueError as error:
                raise ValueError(f"{uri}, byte {at}: {error}") from None
            if not isinstance(document, dict):
                raise ValueError(f"{uri}, byte {at}: no JSON object")
            known = {}
            for f in self.filters:
                name = f.attribute[0]
                if name not in known:
                    known[name] = as_type(plain(document.get(name)), by_name[name])
                if not _holds(f, known[name]):
                    break
            else:
                rows.append({n: known[n] if n in known else as_type(plain(document.get(n)), k) for n, k in kinds})
            if len(rows) == ROWS:
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)


class ExtendedJson(DataSource):
    """Options: path, rangeBytes. The schema is the user's."""

    @classmethod
    def name(cls) -> str:
        return "extjson"

    def schema(self):
        raise ValueError("give a schema: documents have none")

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(schema, self.options["path"], int(self.options.get("rangeBytes", RANGE_BYTES)))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ExtendedJson)


def scan_dump(
    spark: SparkSession, path: str, schema: T.StructType, where: Column | str | None = None, **options: str
) -> DataFrame:
    """I-1 on a dump: the documents that meet a condition."""
    register(spark)
    spark.conf.set(PUSHDOWN, "true")
    df = spark.read.format("extjson").schema(schema).options(**options).load(path)
    return df if where is None else df.filter(where)
