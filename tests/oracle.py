"""Run registered queries next to their SQL and compare: ``python -m tests.oracle SF_DIR [NAME ..]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{Path(sf_dir) / name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(name: str, spark, con, sf_dir: str, queries, oracles) -> str | None:
    """None when equal, else what differs."""
    df = queries[name](spark, sf_dir)
    have = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    if name not in oracles:
        return None
    cursor = con.execute(oracles[name])
    want = _sorted_rows([d[0] for d in cursor.description], cursor.fetchall())
    if have[0] != want[0]:
        return f"columns {have[0]} != {want[0]}"
    if have[1] == want[1]:
        kinds = [[tuple(type(v).__name__ for v in row) for row in rows] for rows in (have[1], want[1])]
        different = [(a, b) for a, b in zip(*kinds) if a != b]
        return f"types {different[0]}" if different else None
    only_have = [r for r in have[1] if r not in set(want[1])][:3]
    only_want = [r for r in want[1] if r not in set(have[1])][:3]
    return f"rows {len(have[1])} vs {len(want[1])}; only here {only_have}; only in SQL {only_want}"


def main(sf_dir: str, names: list[str]) -> int:
    from emberlink.plans import ORACLES, QUERIES
    from emberlink.session import build_session

    spark = build_session("oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            problem = compare(name, spark, con, sf_dir, QUERIES, ORACLES)
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        kind = "sql" if name in ORACLES else "rows"
        print(f"{'ok ' if problem is None else 'BAD'} {name} [{kind}] {time.time() - start:.1f}s {str(problem or '')[:900]}", flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
