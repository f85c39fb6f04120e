"""Run a registered query and its SQL oracle on the same tables and compare rows, columns and values."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from evidex.plans.inputs import TABLE_NAMES  # noqa: E402


def oracle_connection(sf_dir: str):
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def normal(value):
    if isinstance(value, float) and value == 0:
        return 0.0
    return str(value) if value is not None else None


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


DUCK_TO_SPARK = {
    "VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "BOOLEAN": "boolean", "DATE": "date",
}


def difference(spark_df, con, sql):
    """None when equal, else a short description."""
    found = [tuple(r) for r in spark_df.collect()]
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    wanted = cur.fetchall()
    types = {r[0]: r[1] for r in con.execute(f"describe {sql}").fetchall()}
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    other = {n: (f, types[n]) for n, f in spark_df.dtypes if DUCK_TO_SPARK.get(types[n], types[n]) != f}
    if other:
        return f"types {other}"
    a, b = rows_of(spark_df.columns, found), rows_of(names, wanted)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)} rows"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ, first: {str(bad[0][0])[:600]} != {str(bad[0][1])[:600]}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    from evidex.plans.oracles import ORACLES
    from evidex.plans.registered import QUERIES
    from evidex.session import local_session

    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf_dir)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                text = difference(df, con, ORACLES[name])
            else:
                text = None
                print("  no oracle, rows:", df.count())
        except Exception as e:
            text = f"{type(e).__name__}: {str(e)[:1500]}"
        failed += text is not None
        print(f"{'ok  ' if text is None else 'FAIL'} {name} {time.time() - start:.1f}s {text or ''}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
