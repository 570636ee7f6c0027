"""Compare registered queries with their SQL; also runs as a script."""

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def database(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value  # bit for bit
    return value


def _canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    lined_up = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(names), sorted(lined_up, key=repr)


def compare(result, connection, sql):
    """Differences between a Spark result and the SQL result; empty if equal."""
    mine = _canonical(result.columns, [tuple(row) for row in result.collect()])
    cursor = connection.execute(sql)
    other = _canonical([c[0] for c in cursor.description], cursor.fetchall())
    if mine[0] != other[0]:
        return f"columns {mine[0]} != {other[0]}"
    if mine[1] != other[1]:
        only_mine = [r for r in mine[1] if r not in set(other[1])][:3]
        only_other = [r for r in other[1] if r not in set(mine[1])][:3]
        return f"{len(mine[1])} vs {len(other[1])} rows; spark {only_mine}; sql {only_other}"
    return ""


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry_module

    from ludometry.session import build_session

    sf = sys.argv[1]
    chosen = sys.argv[2:]
    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = database(sf)
    oracles = entry_module.oracle_sql()
    for name, query in entry_module.queries().items():
        if chosen and name not in chosen:
            continue
        began = time.time()
        try:
            result = query(spark, sf)
            if name in oracles:
                verdict = compare(result, connection, oracles[name]) or f"ok {result.count()} rows"
            else:
                verdict = f"no oracle: {result.collect()[:3]}"
        except Exception as error:  # noqa: BLE001 - report and go on
            verdict = f"FAILED {type(error).__name__}: {str(error)[:600]}"
        print(f"{name:28s} {time.time() - began:6.1f}s  {verdict}", flush=True)
