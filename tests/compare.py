"""Compare a Spark result with the SQL twin's result: names, types and row multisets."""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(v: object) -> object:
    if isinstance(v, float):
        return repr(v + 0.0)
    return str(v)


def differences(df, sql: str, con: duckdb.DuckDBPyConnection) -> list[str]:
    found = []
    names = sorted(df.columns)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rel = con.sql(sql)
    if sorted(rel.columns) != names:
        return [f"columns {names} against {sorted(rel.columns)}"]
    kinds = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for n in names:
        if SAME_TYPE.get(types[n]) != kinds[n]:
            found.append(f"type of {n}: {types[n]} against {kinds[n]}")
    at = [rel.columns.index(n) for n in names]
    want = Counter(tuple(_norm(r[i]) for i in at) for r in rel.fetchall())
    got = Counter(tuple(_norm(v) for v in r) for r in df.select(*names).collect())
    if want != got:
        more, less = got - want, want - got
        found.append(
            f"{sum(got.values())} rows against {sum(want.values())}; "
            f"only here {list(more.items())[:3]}; only there {list(less.items())[:3]}"
        )
    if not got:
        found.append("empty result")
    return found


def main() -> int:
    """``python -m tests.compare SF_DIR [name ...]``: check the named or all queries."""
    from __spark_entry__ import oracle_sql, queries
    from millrace.session import build_session

    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark = build_session(
        master="local[8]", spark_ui_enabled="false", spark_driver_memory="12g", spark_ui_showConsoleProgress="false"
    )
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf_dir), oracle_sql(), 0
    for name, fn in queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            found = differences(df, sqls[name], con) if name in sqls else [] if df.count() else ["empty result"]
        except Exception as e:  # report and go on with the next query
            found = [f"{type(e).__name__}: {str(e)[:1500]}"]
        bad += bool(found)
        kind = "" if name in sqls else " (rows only)"
        print(f"{'FAIL' if found else 'ok'} {name}{kind} {time.time() - start:.1f}s", *found, flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(main())
