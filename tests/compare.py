"""Side-by-side check of registered queries against DuckDB on the same Parquet files.

    python tests/compare.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import pathlib
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
EXACT = False
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _sorted(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    frame = frame.map(lambda v: 0.0 if isinstance(v, float) and v == 0 else v)
    keys = frame.map(lambda v: "" if pd.isna(v) else f"{v:.9g}" if isinstance(v, float) else str(v))
    order = keys.sort_values(list(keys.columns)).index if len(keys) else keys.index
    return frame.loc[order].reset_index(drop=True)


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs; empty if schema, row count and all values agree."""
    relation = con.sql(sql)
    theirs_types = dict(zip(relation.columns, map(str, relation.types)))
    ours_types = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in spark_df.schema.fields}
    found = []
    if ours_types != theirs_types:
        found.append(f"types: {sorted(ours_types.items() ^ theirs_types.items())}")
    ours, theirs = _sorted(spark_df.toPandas()), _sorted(relation.df())
    if list(ours.columns) != list(theirs.columns):
        return found
    if len(ours) != len(theirs):
        return [*found, f"rows: {len(ours)} / {len(theirs)}"]
    for column in ours.columns:
        a, b = ours[column], theirs[column]
        for i, (x, y) in enumerate(zip(a, b)):
            same = x == y or (pd.isna(x) and pd.isna(y))
            if not same and not EXACT and isinstance(x, float) and isinstance(y, (int, float)):
                same = abs(x - y) <= 1e-9 * max(1.0, abs(x))
            if not same:
                found.append(f"{column}[{i}]: {x!r} / {y!r} of {ours.iloc[i].to_dict()}")
                break
    return found


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--exact", action="store_true", help="no tolerance on doubles")
    parser.add_argument("names", nargs="*")
    options = parser.parse_args()
    global EXACT
    EXACT = options.exact
    from __spark_entry__ import oracle_sql, queries
    from tests.conftest import local_session

    spark, sf_dir = local_session(), f"/root/testdata/sf{options.sf}"
    con, sqls, bad = connect(sf_dir), oracle_sql(), 0
    for name, run in queries().items():
        if options.names and name not in options.names:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            found = differences(df, con, sqls[name]) if name in sqls else [] if df.count() else ["no rows"]
        except Exception as error:
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.2f}s", *found[:3], sep="\n     " if found else " ", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main() > 0)
