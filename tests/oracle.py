"""Compare registered queries with their SQL: ``python -m tests.oracle SF_DIR [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

from skilltide.registry import REGISTRY
from skilltide.registry.core import TABLES


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if value is None or isinstance(value, (bool, int, str)):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return (type(value).__name__, str(value))


def _rows(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(
        tuple(_plain(row[i]) for i in order) for row in rows
    )


def compare(spark, con, name: str, sf_dir: str, look=None) -> tuple[int, str | None]:
    """Row count and the first difference, None when there is none. ``look`` sees the result."""
    entry = REGISTRY[name]
    df = entry.run(spark, sf_dir)
    if look is not None:
        look(df)
    ours_cols, ours = _rows(df.columns, df.collect())
    if entry.sql is None:
        return sum(ours.values()), None
    result = con.execute(entry.sql)
    theirs_cols, theirs = _rows([d[0] for d in result.description], result.fetchall())
    if ours_cols != theirs_cols:
        return sum(ours.values()), f"columns {ours_cols} != {theirs_cols}"
    if ours != theirs:
        extra, missing = list((ours - theirs).items()), list((theirs - ours).items())
        return sum(ours.values()), (
            f"{len(extra)} rows only here, {len(missing)} only in SQL; "
            f"{str(extra[:2])[:400]} / {str(missing[:2])[:400]}"
        )
    return sum(ours.values()), None


def main() -> int:
    from skilltide.session import local_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = local_session(8, **{"spark.ui.showConsoleProgress": "false"})
    con = database(sf_dir)
    bad = 0
    for name in sorted(REGISTRY):
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            rows, diff = compare(spark, con, name, sf_dir)
        except Exception as error:  # noqa: BLE001
            rows, diff = -1, f"{type(error).__name__}: {str(error)[:600]}"
        bad += diff is not None
        kind = "sql " if REGISTRY[name].sql else "rows"
        state = "ok  " if diff is None else "DIFF"
        print(f"{state} {kind} {name} rows={rows} {time.time() - start:.1f}s {diff or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
