"""Run queries on Spark and their SQL on DuckDB and compare the rows: python -m checks.compare [sf] [name ...]."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

from checks.oracle import ORACLE
from checks.queries import QUERIES

VIEWS = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in VIEWS.split():
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def canonical(pdf: pd.DataFrame) -> list[tuple]:
    """Rows as text tuples, columns by name, in sorted order."""

    def text(v) -> str:
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v) or v is pd.NA:
            return ""
        if isinstance(v, float):
            return repr(round(v, 6) + 0.0)
        if hasattr(v, "isoformat"):
            return v.isoformat().removesuffix("T00:00:00")
        return str(v)

    ordered = pdf[sorted(pdf.columns)].astype(object)
    return sorted(tuple(text(v) for v in row) for row in ordered.itertuples(index=False, name=None))


def rows_of(records: list, columns: list[str]) -> pd.DataFrame:
    return pd.DataFrame([list(r) for r in records], columns=columns, dtype=object)


def compare(spark, sf_dir: str, name: str) -> tuple[bool, str]:
    t0 = time.time()
    df = QUERIES[name](spark, sf_dir)
    got = rows_of(df.collect(), df.columns)
    t1 = time.time()
    result = connect(sf_dir).execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    want = rows_of(result.fetchall(), columns)
    t2 = time.time()
    note = f"{len(got)} rows, spark {t1 - t0:.1f}s, duckdb {t2 - t1:.1f}s"
    if sorted(got.columns) != sorted(want.columns):
        return False, f"{note}; columns {sorted(set(got.columns) ^ set(want.columns))}"
    a, b = canonical(got), canonical(want)
    if a == b:
        return True, note
    only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
    return False, f"{note}; want {len(b)} rows; extra {len(only_a)} {only_a[:1]}; lacking {len(only_b)} {only_b[:1]}; by {sorted(got.columns)}"


def main() -> None:
    from kpi_shift.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session(8)
    bad = 0
    for name in names:
        try:
            ok, note = compare(spark, f"/root/testdata/sf{sf}", name)
        except Exception as error:  # one query's failure should not hide the others
            ok, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'BAD '} {name}: {note}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")


if __name__ == "__main__":
    main()
