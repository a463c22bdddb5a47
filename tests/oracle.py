"""Run every query beside its SQL check and compare columns and values."""

import datetime as dt
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _value(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, bool) or v is None:
        return repr(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, fn, sql):
    """(problem or None, number of rows)."""
    df = fn(spark, sf_dir)
    got = df.collect()
    if sql is None:
        return (None if got else "no rows"), len(got)
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}", len(got)
    a, b = _rows(df.columns, got), _rows(columns, want)
    if a != b:
        only_a = [x for x in a if x not in set(b)][:2]
        only_b = [x for x in b if x not in set(a)][:2]
        return f"{len(a)} vs {len(b)} rows; spark {only_a} check {only_b}", len(got)
    return (None if got else "no rows"), len(got)


if __name__ == "__main__":
    import __spark_entry__ as entry
    from boardtide.session import build_session

    sf, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("OFF")
    con, checks = connect(sf), entry.oracle_sql()
    for name, fn in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            problem, n = compare(spark, con, sf, fn, checks.get(name))
        except Exception as e:  # noqa: BLE001
            problem, n = f"{type(e).__name__}: {str(e)[:600]}", -1
        mark = "ok  " if problem is None else "FAIL"
        print(mark, name, n, "checked" if name in checks else "rows only", f"{time.time() - start:.1f}s",
              (problem or "")[:900], flush=True)
