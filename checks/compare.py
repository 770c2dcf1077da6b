"""Run registered queries beside their SQL twins and compare the values.

    python -m checks.compare [sf] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

from lorewell.session import get_session

from .oracles import ORACLES
from .queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def canonical(value):
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return repr(value + 0.0)
    if isinstance(value, int):
        return str(value)
    return repr(value)


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def sql_rows(sf_dir: str, sql: str) -> tuple[list[str], list]:
    con = duckdb.connect()
    for t in TABLES:
        path = Path(sf_dir) / f"{t}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    result = con.execute(sql)
    return [d[0] for d in result.description], result.fetchall()


def check(spark, sf_dir: str, name: str) -> tuple[str, int, float]:
    start = time.time()
    df = QUERIES[name](spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    took = time.time() - start
    if name not in ORACLES:
        return "rows only", len(got), took
    names, expected = sql_rows(sf_dir, ORACLES[name])
    if sorted(names) != sorted(df.columns):
        return f"COLUMNS differ {sorted(df.columns)} {sorted(names)}", len(got), took
    want = rows_of(names, expected)
    if got == want:
        return "equal", len(got), took
    extra = [r for r in got if r not in set(want)][:2]
    missing = [r for r in want if r not in set(got)][:2]
    return f"DIFFERENT {len(got)} vs {len(want)}: {str(extra)[:400]} | {str(missing)[:400]}", len(got), took


def main() -> int:
    args = sys.argv[1:]
    sf = args[0] if args else "0.01"
    chosen = args[1:] or list(QUERIES)
    spark = get_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in chosen:
        try:
            status, n, took = check(spark, f"/root/testdata/sf{sf}", name)
        except Exception as error:  # report and go on with the next query
            status, n, took = f"FAILED {type(error).__name__}: {str(error)[:1500]}", 0, 0.0
        bad += status.split()[0] not in ("equal", "rows")
        print(f"{name:28s} {n:8d} {took:6.1f}s  {status}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
