"""Run registered queries against DuckDB on the same files and compare strictly."""

import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()
KINDS = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def connect(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def canon(rows, order):
    out = []
    for r in rows:
        vals = [r[i] for i in order]
        out.append(tuple(f"{v:.6g}" if isinstance(v, float) else repr(v) for v in vals))
    return sorted(out)


def compare(df, con, sql):
    """None when equal, else a short description of the difference."""
    rel = con.sql(sql)
    theirs = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    ours = dict(df.dtypes)
    if set(theirs) != set(ours):
        return f"columns {sorted(ours)} vs {sorted(theirs)}"
    bad = {c: (ours[c], theirs[c]) for c in ours if KINDS.get(ours[c]) != theirs[c]}
    if bad:
        return f"types {bad}"
    names = sorted(ours)
    a = canon([tuple(r) for r in df.collect()], [df.columns.index(n) for n in names])
    b = canon(rel.fetchall(), [rel.columns.index(n) for n in names])
    if a == b:
        exact_a = sorted(repr(tuple(r[df.columns.index(n)] for n in names)) for r in df.collect())
        exact_b = sorted(repr(tuple(r[rel.columns.index(n)] for n in names)) for r in con.sql(sql).fetchall())
        if exact_a != exact_b:
            diff = next((x, y) for x, y in zip(exact_a, exact_b) if x != y)
            return f"LAST DIGITS {len(a)} rows {diff}"
        return None
    extra = [x for x in a if x not in set(b)][:3]
    miss = [x for x in b if x not in set(a)][:3]
    return f"rows {len(a)} vs {len(b)}; cols {names}; extra {extra}; missing {miss}"


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from tidemark.session import build_session

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session("check", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    wanted = sys.argv[1:]
    queries, sqls = entry.queries(), entry.oracle_sql()
    failed = 0
    for name, plan in queries.items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            df = plan(spark, sf)
            if name in sqls:
                problem = compare(df, con, sqls[name])
                n = "" if problem else con.sql(f"SELECT COUNT(*) FROM ({sqls[name]})").fetchall()[0][0]
                if n == 0:
                    problem = "EMPTY"
            else:
                n, problem = df.count(), None
                if n == 0:
                    problem = "EMPTY (no oracle)"
                n = f"{n} no oracle"
        except Exception as e:  # noqa: BLE001
            problem, n = f"{type(e).__name__}: {str(e)[:600]}", ""
        took = time.time() - start
        if problem:
            failed += 1
        print(f"{'FAIL' if problem else 'ok  '} {name:28s} {took:5.1f}s {n} {problem or ''}", flush=True)
    print("failed", failed)
