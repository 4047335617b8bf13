"""Run registered queries next to their SQL and compare rows, types and column names."""

from __future__ import annotations

import pathlib
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = pathlib.Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def type_kind(name: str) -> str:
    name = str(name).lower()
    known = {"integer": "int", "long": "bigint", "varchar": "string", "str": "string"}
    return known.get(name, name)


def compare(spark, con, name, query, sql, sf_dir) -> dict:
    start = time.time()
    df = query(spark, sf_dir)
    columns = sorted(df.columns)
    ours = df.select(*columns).toPandas()
    seconds = time.time() - start
    theirs = con.sql(sql)
    kinds = dict(zip(theirs.columns, (type_kind(t) for t in theirs.types), strict=True))
    schema = {f.name: type_kind(f.dataType.simpleString()) for f in df.schema}
    theirs = theirs.df()
    same_columns = sorted(theirs.columns) == columns
    same = False
    if same_columns:
        x = ours.sort_values(columns).reset_index(drop=True)
        y = theirs[columns].sort_values(columns).reset_index(drop=True)
        same = len(x) == len(y) and all((x[c].values == y[c].values).all() for c in columns)
    return {
        "name": name,
        "rows": len(ours),
        "sql_rows": len(theirs),
        "types": schema == kinds,
        "schema": (schema, kinds) if schema != kinds else None,
        "same": bool(same),
        "seconds": round(seconds, 2),
    }


if __name__ == "__main__":
    import sys

    sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from linkweave.session import local_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    sqls = entry.oracle_sql()
    for key, function in entry.queries().items():
        if wanted and key not in wanted:
            continue
        try:
            result = compare(session, connection, key, function, sqls[key], sf_dir)
            print("OK  " if result["same"] and result["types"] else "BAD ", result, flush=True)
        except Exception as error:  # noqa: BLE001 - a report of all queries
            print("FAIL", key, type(error).__name__, str(error)[:600], flush=True)
