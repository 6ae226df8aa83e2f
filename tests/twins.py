"""Compare a registered query with its SQL twin, row by row and type by type."""

from __future__ import annotations

import datetime
import math
import sys
from collections import Counter
from pathlib import Path

import duckdb

TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty if both give the same columns, types and rows."""
    result = con.execute(sql)
    twin = {name: str(kind) for name, kind, *_ in result.description}
    twin_names = [d[0] for d in result.description]
    twin_rows = result.fetchall()
    names = sorted(df.columns)
    if names != sorted(twin_names):
        return [f"columns {names} against {sorted(twin_names)}"]
    found = [
        f"type of {name}: {kind} against {twin[name]}"
        for name, kind in df.dtypes
        if TYPES.get(kind) != twin[name]
    ]
    order = [twin_names.index(c) for c in names]
    theirs = Counter(tuple(_plain(r[i]) for i in order) for r in twin_rows)
    ours = Counter(tuple(_plain(v) for v in r) for r in df.select(*names).collect())
    if ours != theirs:
        extra, lacking = ours - theirs, theirs - ours
        found.append(
            f"{sum(ours.values())} rows against {sum(theirs.values())}; "
            f"{sum(extra.values())} extra such as {list(extra)[:3]}, "
            f"{sum(lacking.values())} lacking such as {list(lacking)[:3]}"
        )
    return found


if __name__ == "__main__":
    import time

    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from cellwise.session import local_session
    from workload.oracles import ORACLES
    from workload.queries import QUERIES

    folder, *chosen = sys.argv[1:]
    session, connection = local_session("twins"), database(folder)
    for query_name in chosen or QUERIES:
        began = time.time()
        if query_name not in ORACLES:
            print(f"{query_name}: no twin, {QUERIES[query_name](session, folder).count()} rows")
            continue
        try:
            diff = differences(
                QUERIES[query_name](session, folder), connection, ORACLES[query_name]
            )
        except Exception as error:  # noqa: BLE001
            diff = [f"failed: {error}"[:700]]
        print(f"{query_name}: {diff or 'same'} {time.time() - began:.2f}s", flush=True)
