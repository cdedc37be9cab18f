"""Run registered queries beside their SQL and compare names, types and values."""

from __future__ import annotations

import math
import sys
import time
import traceback
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (0.0 if v == 0 else v)
    return v


def sort_key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


def compare(spark, con, folder: str, fn, sql: str) -> str | None:
    """None if equal, else what differs."""
    df = fn(spark, folder)
    order = sorted(df.columns)
    s_types = dict(df.dtypes)
    s_rows = sorted([tuple(norm(r[c]) for c in order) for r in df.collect()], key=sort_key)
    desc = con.execute(f"describe {sql}").fetchall()
    d_types = {r[0]: TYPES.get(r[1], r[1]) for r in desc}
    if sorted(d_types) != order:
        return f"columns {order} vs {sorted(d_types)}"
    diff = {c: (s_types[c], d_types[c]) for c in order if s_types[c] != d_types[c]}
    if diff:
        return f"types {diff}"
    names = [r[0] for r in desc]
    at = [names.index(c) for c in order]
    d_rows = sorted([tuple(norm(r[i]) for i in at) for r in con.execute(sql).fetchall()], key=sort_key)
    if len(s_rows) != len(d_rows):
        return f"{len(s_rows)} rows vs {len(d_rows)}"
    for a, b in zip(s_rows, d_rows):
        if a != b:
            n = sum(x != y for x, y in zip(s_rows, d_rows))
            return f"{n} of {len(s_rows)} rows differ, first\n    {dict(zip(order, a))}\n    {dict(zip(order, b))}"
    return None


def main(folder: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from stratascore.session import build_session

    spark = build_session(cpus=8)
    con = connect(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        t = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, folder, queries[name], oracles[name])
                mark = "ok  " if problem is None else "DIFF"
            else:
                rows = queries[name](spark, folder).collect()
                problem, mark = None, "rows"
                if not rows:
                    problem, mark = "no rows", "DIFF"
                elif len(rows) < 6:
                    print("   ", *rows, sep="\n    ")
        except Exception as e:  # report and go on with the next query
            problem, mark = "".join(traceback.format_exception_only(e))[:1500] + traceback.format_exc()[-900:], "FAIL"
        bad += problem is not None
        print(f"{mark} {name} {time.time() - t:.1f}s {problem or ''}", flush=True)
    print(f"{bad} bad of {len(names or queries)}; {len(oracles)} with SQL of {len(queries)}")
    return bad


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1], sys.argv[2:]), 1))
