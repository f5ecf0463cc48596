"""Runs named queries next to their SQL twins and compares schema, row count and values."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def type_name(kind: str) -> str:
    names = {"VARCHAR": "string", "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "BOOLEAN": "boolean",
             "TIMESTAMP": "timestamp_ntz", "DATE": "date"}
    return names.get(kind, kind)


def canonical(rows):
    def cell(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v)
        return repr(v)

    return sorted(tuple(cell(v) for v in row) for row in rows)


def compare(frame, con, sql: str) -> tuple[str, int]:
    """("" or the first difference, row count)."""
    columns = sorted(frame.columns)
    rows = [tuple(r) for r in frame.select(*[f"`{c}`" for c in columns]).collect()]
    cursor = con.execute(f"SELECT * FROM ({sql}) oracle")
    types = {c[0]: type_name(str(c[1])) for c in cursor.description}
    names = [c[0] for c in cursor.description]
    if sorted(names) != columns:
        return f"columns {columns} != {sorted(names)}", len(rows)
    order = [names.index(c) for c in columns]
    expected = [tuple(r[i] for i in order) for r in cursor.fetchall()]
    spark_types = dict(frame.dtypes)
    wrong = {c: (spark_types[c], types[c]) for c in columns if spark_types[c] != types[c]}
    if wrong:
        return f"types {wrong}", len(rows)
    if len(rows) != len(expected):
        return f"rows {len(rows)} != {len(expected)}", len(rows)
    for mine, theirs in zip(canonical(rows), canonical(expected)):
        if mine != theirs:
            return f"values {[(c, a, b) for c, a, b in zip(columns, mine, theirs) if a != b]}", len(rows)
    return "", len(rows)


def main() -> int:
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, failed = connect(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            frame = query(spark, sf_dir)
            if name in oracles:
                problem, rows = compare(frame, con, oracles[name])
            else:
                problem, rows = "", frame.count()
        except Exception as error:  # report and go on with the next query
            problem, rows = f"{type(error).__name__}: {str(error)[:600]}", -1
        failed += bool(problem)
        label = "FAIL" if problem else ("ok" if name in oracles else "rows")
        print(f"{label:5}{name:28}{rows:8}{time.time() - start:7.1f}s {problem}", flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main())
