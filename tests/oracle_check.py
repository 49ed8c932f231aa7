"""Run registered queries and their SQL side by side: python tests/oracle_check.py [sf_dir] [name ...]"""

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def plain(value):
    return float(value) if type(value).__name__ == "Decimal" else value


def compare(df, con, sql):
    """None if rows and column names are equal, else what differs."""
    columns = sorted(df.columns)
    spark_rows = sorted((tuple(plain(row[c]) for c in columns) for row in df.collect()), key=repr)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return f"columns {columns} <> {sorted(names)}"
    order = [names.index(c) for c in columns]
    sql_rows = sorted((tuple(plain(row[i]) for i in order) for row in result.fetchall()), key=repr)
    if len(spark_rows) != len(sql_rows):
        return f"{len(spark_rows)} rows <> {len(sql_rows)}"
    wrong = [(a, b) for a, b in zip(spark_rows, sql_rows) if a != b]
    return f"{len(wrong)} of {len(sql_rows)} rows differ, first {columns}: {wrong[0]}" if wrong else None


def types_differ(df, con, sql):
    """Columns whose kind of type is not the same in both engines."""
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    found = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return {c: (t, found.get(c)) for c, t in df.dtypes if kinds.get(t, t) != found.get(c)}


def main(sf, names):
    from codeloom.session import local_session

    spark = local_session(8)
    con = connect(sf)
    queries, oracle = entry.queries(), entry.oracle_sql()
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf)
            if name in oracle:
                built = time.time() - start
                verdict = compare(df, con, oracle[name]) or "equal"
                odd = types_differ(df, con, oracle[name])
                verdict += f" types {odd}" if odd else ""
                verdict += f" (built {built:.1f}s)"
            else:
                verdict = f"{df.count()} rows, no SQL"
        except Exception as error:  # noqa: BLE001
            verdict = f"FAILED {type(error).__name__}: {str(error)[:600]}"
        print(f"{name:24s} {time.time() - start:6.1f}s  {verdict}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:])
