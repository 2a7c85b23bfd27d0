"""Compare a registered query with its oracle in DuckDB: columns by name, rows as a bag."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


_KINDS = {"long": "BIGINT", "integer": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE"}


def difference(spark, con, build, sql: str, sf_dir: str) -> str | None:
    frame = build(spark, sf_dir)
    mine = rows_of(frame.columns, frame.collect())
    found = con.execute(sql)
    columns = [item[0] for item in found.description]
    kinds = {item[0]: str(item[1]) for item in found.description}
    theirs = rows_of(columns, found.fetchall())
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} vs {sorted(columns)}"
    for field in frame.schema:
        wanted = _KINDS.get(field.dataType.typeName(), field.dataType.simpleString())
        if kinds[field.name].upper() != wanted:
            return f"type of {field.name}: {wanted} vs {kinds[field.name]}"
    if not mine:
        return "no rows"
    if mine != theirs:
        return f"{sum(mine.values())} vs {sum(theirs.values())} rows; only here {list((mine - theirs))[:2]}; only there {list((theirs - mine))[:2]}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as contract

    from scorebook.session import local_session

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    session, con = local_session(8), connect(folder)
    oracles = contract.oracle_sql()
    for name, build in contract.queries().items():
        if wanted and name not in wanted:
            continue
        begun = time.time()
        try:
            if name in oracles:
                outcome = difference(session, con, build, oracles[name], folder)
            else:
                outcome = f"rows only: {build(session, folder).count()}"
        except Exception as error:  # noqa: BLE001
            outcome = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{time.time() - begun:6.2f}s {name}: {outcome or 'ok'}", flush=True)
