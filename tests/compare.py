"""Compare every registered query with its SQL on the given tables.

    python tests/compare.py sf0.01 [query ...]
"""

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

DATA = Path("/root/testdata")


def _plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def spark_rows(df):
    names = sorted(df.columns)
    rows = [tuple(_plain(row[n]) for n in names) for row in df.collect()]
    return names, sorted(rows, key=repr)


def duck_rows(sql, folder):
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    types = dict(zip(columns, [str(c[1]) for c in result.description]))
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(_plain(row[i]) for i in order) for row in result.fetchall()]
    return [columns[i] for i in order], sorted(rows, key=repr), types


# DuckDB type -> Spark types that count as the same
SAME_TYPE = {
    "BIGINT": {"bigint"}, "INTEGER": {"int"}, "DOUBLE": {"double"}, "VARCHAR": {"string"},
    "TIMESTAMP": {"timestamp_ntz"}, "DATE": {"date"}, "BOOLEAN": {"boolean"},
}


def difference(df, sql, folder):
    """None when names and rows agree, else a short description."""
    names, left = spark_rows(df)
    other, right, types = duck_rows(sql, folder)
    kinds = dict(df.dtypes)
    odd = {c: (kinds[c], t) for c, t in types.items()
           if c in kinds and kinds[c] not in SAME_TYPE.get(t, ())}
    if odd:
        return f"types {odd}"
    if names != other:
        return f"columns {names} != {other}"
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(left)} rows differ, first {wrong[0][0]} != {wrong[0][1]}"
    return None


def main(scale, wanted):
    from chargelake.session import build_session
    from __spark_entry__ import oracle_sql, queries

    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    folder = str(DATA / scale)
    sql = oracle_sql()
    bad = 0
    for name, run in queries().items():
        if wanted and name not in wanted:
            continue
        if name not in sql:
            print(f"{name:28s} no sql", flush=True)
            continue
        started = time.time()
        try:
            found = difference(run(spark, folder), sql[name], folder)
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:400]}"
        bad += found is not None
        print(f"{name:28s} {time.time() - started:6.1f}s {found or 'ok'}", flush=True)
    print("differences:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], set(sys.argv[2:])) else 0)
