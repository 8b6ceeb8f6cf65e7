"""Run checked queries in Spark and their SQL in DuckDB and compare the rows.

    python tests/oracle_compare.py /root/testdata/sf0.01 [query ...]
"""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    return value


def _ordered(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    found = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(found, key=repr)


def compare(spark, connection, sf_dir, run, sql):
    """None if columns, their kinds and rows agree, else what differs."""
    frame = run(spark, sf_dir)
    kinds = {f.name: f.dataType.simpleString() for f in frame.schema}
    mine = _ordered(frame.columns, [tuple(r) for r in frame.collect()])
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    names = {
        "VARCHAR": "string", "BIGINT": "bigint", "BOOLEAN": "boolean", "DOUBLE": "double",
        "INTEGER": "int", "TIMESTAMP": "timestamp",
    }
    theirs_kinds = {d[0]: names.get(str(d[1]), str(d[1])) for d in result.description}
    theirs = _ordered(columns, result.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} / {theirs[0]}"
    if kinds != theirs_kinds:
        return f"types {[(c, kinds[c], theirs_kinds[c]) for c in kinds if kinds[c] != theirs_kinds[c]]}"
    if len(mine[1]) != len(theirs[1]):
        return f"{len(mine[1])} rows / {len(theirs[1])}"
    if mine[1] != theirs[1]:
        different = [(a, b) for a, b in zip(mine[1], theirs[1]) if a != b]
        return f"{len(different)} of {len(mine[1])} rows differ, first {different[0]}"[:600]
    return None


def main(sf_dir, wanted):
    import __spark_entry__ as entry
    from pergamon.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    sql = entry.oracle_sql()
    for key, run in entry.queries().items():
        if wanted and key not in wanted:
            continue
        started = time.time()
        try:
            if key in sql:
                verdict = compare(spark, connection, sf_dir, run, sql[key]) or "ok"
            else:
                verdict = f"rows only: {run(spark, sf_dir).count()}"
        except Exception as failure:
            verdict = f"FAILED {type(failure).__name__}: {str(failure)[:700]}"
        print(f"{key:32s} {time.time() - started:6.2f}s  {verdict}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
