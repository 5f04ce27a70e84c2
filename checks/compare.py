"""Run queries against their SQL and compare whole results, whatever the row order."""

from __future__ import annotations

import math
import sys
import time
import traceback
from collections import Counter
from datetime import date, datetime

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, date):
        return value.isoformat()
    return value


def _bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(con, df, sql: str) -> str | None:
    """None when equal, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    theirs = _bag(names, result.fetchall())
    ours = _bag(df.columns, [tuple(r) for r in df.collect()])
    if ours == theirs:
        return None if ours else "no rows"
    more, fewer = ours - theirs, theirs - ours
    return f"{sum(ours.values())}/{sum(theirs.values())} rows; ours {list(more)[:2]}; sql {list(fewer)[:2]}"


def main(sf_dir: str, names: list[str]) -> int:
    from checks.oracles import ORACLES
    import checks.chains  # noqa: F401  registers the chain queries
    from checks.queries import QUERIES
    from millrace.session import build_session

    spark = build_session("compare", "local[8]", 8, "8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    failed = 0
    for name, fn in QUERIES.items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            problem = compare(con, df, ORACLES[name]) if name in ORACLES else f"(no SQL) {df.count()} rows"
        except Exception as e:  # keep going, report at the end
            problem = f"{type(e).__name__}: {str(e)[:600]}"
            traceback.print_exc(limit=3)
        failed += bool(problem)
        print(f"{name:32s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
