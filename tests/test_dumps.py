"""I-1: dumps of a document store."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skilltide.sources import dumps

SCHEMA = (
    T.StructType().add("_id", "string").add("n", "long").add("x", "double").add("b", "boolean").add("d", "timestamp").add("day", "date")
    .add("tags", T.ArrayType(T.StringType())).add("s", "string").add("o", T.StructType().add("a", "long").add("c", "string")).add("m", T.DecimalType(10, 2))
)


def write(path, documents):
    path.mkdir(exist_ok=True)
    for k in range(3):
        (path / f"part-{k}.json").write_text("\n".join(json.dumps(x) for x in documents[k::3]) + ("\n" if k else ""), encoding="utf-8")
    (path / "_SUCCESS").write_text("no document")


@pytest.fixture()
def dump(tmp_path):
    rows = []
    for i in range(500):
        rows.append({
            "_id": {"$oid": f"{i:024x}"}, "n": {"$numberLong": str(i)}, "x": {"$numberDouble": str(i / 4)}, "b": i % 2 == 0,
            "d": {"$date": {"$numberLong": str(86_400_000 * i)}}, "day": {"$date": "2025-01-02T03:04:05+02:00"},
            "tags": ["a", {"$numberInt": str(i)}, None], "o": {"a": i, "c": {"$oid": "z"}}, "m": {"$numberDecimal": "1.5"},
            "s": ["é%d" % (i % 7), None, 3][i % 3], "more": {"deep": [1, {"x": 2}]},
        })
    rows += [{}, {"_id": 7, "n": "text", "x": [], "b": 1, "d": "2025", "tags": {}, "o": 5, "m": True, "s": {"k": 1}}, {"n": None}]
    write(tmp_path / "d", rows)
    return str(tmp_path / "d")


@pytest.mark.parametrize("size", ["100000", "97", "1024"])
def test_every_document_once_whatever_the_ranges(spark, dump, size):
    rows = {r["_id"]: r for r in dumps.scan_dump(spark, dump, SCHEMA, rangeBytes=size).collect() if r["_id"] not in (None, "7")}
    assert len(rows) == 500 and dumps.scan_dump(spark, f"file://{dump}", SCHEMA, rangeBytes=size).count() == 503
    r = rows[f"{10:024x}"]
    assert (r["n"], r["x"], r["b"], r["tags"], r["s"], tuple(r["o"]), str(r["m"])) == (10, 2.5, True, ["a", "10", None], None, (10, "z"), "1.50")
    assert r["d"] == dt.datetime(1970, 1, 11) and r["day"] == dt.date(2025, 1, 2)
    assert rows[f"{11:024x}"]["s"] == "3" and rows[f"{9:024x}"]["s"] == "é2"


def test_values_of_other_kinds_are_null(spark, dump):
    odd = [r for r in dumps.scan_dump(spark, dump, SCHEMA).collect() if r["_id"] in (None, "7")]
    assert len(odd) == 3
    seven = next(r for r in odd if r["_id"] == "7")
    assert [seven[c] for c in ("n", "x", "b", "d", "tags", "o", "m")] == [None] * 7 and seven["s"] == '{"k": 1}'


CONDITIONS = [
    "n >= 490", "n > 3 AND n < 9", "s = 'é3'", "s IN ('é1', '3')", "s IS NULL", "n IS NOT NULL AND b", "n <=> 5", "_id <= '000000000000000000000009'",
    "NOT (n = 3) AND n < 6", "x > 100 AND n < 410", "o.a = 3", "n = 3 OR n = 4", "s LIKE 'é%' AND n <= 20",
]


@pytest.mark.parametrize("where", CONDITIONS)
def test_pushed_conditions_mean_the_same(spark, dump, where):
    whole = spark.createDataFrame(dumps.scan_dump(spark, dump, SCHEMA).collect(), SCHEMA).filter(where)
    assert sorted(map(str, dumps.scan_dump(spark, dump, SCHEMA, where).collect())) == sorted(map(str, whole.collect()))


def test_what_is_pushed_leaves_the_plan(spark, dump):
    plan = lambda where: dumps.scan_dump(spark, dump, SCHEMA, where)._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan("n >= 490 AND s = 'é3'") and "Filter (" in plan("x > 1.5")
    reader = dumps._Reader(SCHEMA, dump, 1 << 20)
    left = list(reader.pushFilters([dumps.EqualTo(("n",), 3), dumps.EqualTo(("o", "a"), 3), dumps.GreaterThan(("x",), 1.0)]))
    assert len(left) == 2 and len(reader.filters) == 1
    found = [b for p in reader.partitions() for b in reader.read(p)]
    assert sum(b.num_rows for b in found) == 1  # the others were never columns


def test_no_object_is_an_error_with_its_place(spark, tmp_path):
    path = tmp_path / "bad"
    path.mkdir()
    (path / "a.json").write_text('{"n": 1}\n[1]\n')
    with pytest.raises(Exception, match="byte 9: no JSON object"):
        dumps.scan_dump(spark, str(path), SCHEMA).collect()
    (path / "a.json").write_text('\n\n{"n": 1')
    with pytest.raises(Exception, match="byte 2:"):
        dumps.scan_dump(spark, str(path), SCHEMA).collect()
    (path / "a.json").write_text("")
    assert dumps.scan_dump(spark, str(path), SCHEMA).agg(F.count("*")).first()[0] == 0
