"""Runs registered queries against their SQL on the same tables.

``python tests/compare.py [data folder] [query ...]`` prints one line per query.
"""

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _cell(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else (0.0 if v == 0 else v)
    if hasattr(v, "item"):
        return _cell(v.item())
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    plain = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(cols), sorted(plain, key=repr)


TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "float": "FLOAT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def compare(con, df, sql):
    """None if equal, else what differs."""
    got_types = {c: TYPES.get(t, t) for c, t in df.dtypes}
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if got_cols else "no columns"
    res = con.execute(sql)
    want_types = {d[0]: str(d[1]) for d in res.description}
    want_cols, want = rows_of([d[0] for d in res.description], res.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    if bad:
        return f"{len(bad)} rows differ, e.g. {bad[0]}"
    if got_types != want_types:
        return f"types {sorted(set(got_types.items()) ^ set(want_types.items()))}"
    return None


def main(argv):
    import __spark_entry__ as entry
    from anchorage import session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = (
        session.builder("compare")
        .master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = connect(sf_dir), entry.oracle_sql()
    wrong = 0
    for name, fn in entry.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        began = time.time()
        try:
            diff = compare(con, fn(spark, sf_dir), sqls.get(name))
        except Exception as e:  # report and go on to the next query
            diff = f"{type(e).__name__}: {str(e)[:600]}"
        wrong += diff is not None
        kind = "sql " if name in sqls else "rows"
        print(f"{'ok  ' if diff is None else 'BAD '} {kind} {time.time() - began:6.2f}s {name} {diff or ''}", flush=True)
    print("wrong:", wrong)
    return wrong


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
