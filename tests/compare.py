"""Compare Spark results with the SQL checks: `python tests/compare.py <data folder> [query ...]`."""

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def canonical(frame) -> list[tuple]:
    """Rows with the columns in name order, sorted, numbers as they are."""
    names = sorted(frame.columns)
    rows = [tuple(_value(v) for v in row) for row in frame[names].itertuples(index=False, name=None)]
    return sorted(rows, key=repr)


def _value(v):
    if v is pd.NA:
        return None
    if hasattr(v, "item"):
        v = v.item()
    if hasattr(v, "date") and callable(v.date):
        v = v.date()
    if isinstance(v, float) and v == 0:
        return 0.0
    return None if v is None or v != v else v


def difference(spark_frame, sql_frame) -> str | None:
    """None if both results are equal, else what differs."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} / {sorted(sql_frame.columns)}"
    ours, theirs = canonical(spark_frame), canonical(sql_frame)
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b or [type(x) for x in a] != [type(x) for x in b]]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def main() -> None:
    import __spark_entry__ as contract
    from epigrid.session import local_session

    folder, chosen = sys.argv[1], sys.argv[2:]
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    checks = contract.oracle_sql()
    for name, query in contract.queries().items():
        if chosen and not any(name.startswith(c) for c in chosen):
            continue
        start = time.time()
        try:
            ours = query(spark, folder).toPandas()
            middle = time.time()
            if name in checks:
                theirs = con.execute(checks[name]).df()
                verdict = difference(ours, theirs) or "ok"
            else:
                verdict = "no check"
            print(f"{name:34} {len(ours):7} rows {middle - start:6.1f}s {time.time() - middle:6.1f}s  {verdict[:600]}", flush=True)
        except Exception as error:  # noqa: BLE001 - a report over all queries
            print(f"{name:34} FAILED {str(error)[:700]}", flush=True)


if __name__ == "__main__":
    main()
