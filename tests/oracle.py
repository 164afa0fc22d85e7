"""Compare queries with their SQL counterparts: ``python -m tests.oracle [sf] [names]``."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        db.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return db


def compare(df, db: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty if names, rows and values agree, else what differs."""
    expected = db.sql(sql)
    names = sorted(expected.columns)
    if sorted(df.columns) != names:
        return f"columns {sorted(df.columns)} != {names}"
    theirs = expected.select(*[f'"{n}"' for n in names]).to_arrow_table()
    ours = df.select(*names).toArrow()
    types = [str(t).replace("large_", "") for t in theirs.schema.types]
    got = [str(t).replace("large_", "") for t in ours.schema.types]
    if got != types:
        return f"types {got} != {types}"
    left, right = (
        Counter(zip(*[column.to_pylist() for column in table.columns]))
        for table in (ours, theirs)
    )
    if left != right:
        return (
            f"{ours.num_rows} rows != {theirs.num_rows}; only ours "
            f"{list((left - right).items())[:3]}, only theirs {list((right - left).items())[:3]}"
        )
    return ""


def main() -> None:
    from __spark_entry__ import oracle_sql, queries

    sf_dir = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
    spark = spark.config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "12g")
    spark = spark.config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    wanted = sys.argv[2:] or list(queries())
    for name in wanted:
        start = time.time()
        try:
            df = queries()[name](spark, sf_dir)
            result = compare(df, db, oracle_sql()[name]) or "ok"
        except Exception as error:  # noqa: BLE001 - a report over all queries
            result = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:24} {time.time() - start:6.1f} s  {result[:900]}", flush=True)


if __name__ == "__main__":
    main()
