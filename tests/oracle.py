"""Compare a query with its SQL: same column names and types, same rows, each as often, values exactly equal."""

from __future__ import annotations

import duckdb

from adapters.tpch import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def differences(df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    con.register("ours_arrow", df.toArrow())
    con.execute("CREATE OR REPLACE TEMP TABLE ours AS SELECT * FROM ours_arrow")
    con.execute(f"CREATE OR REPLACE TEMP TABLE theirs AS {sql}")
    con.unregister("ours_arrow")
    ours, theirs = ({r[0]: r[1] for r in con.sql(f"DESCRIBE {t}").fetchall()} for t in ("ours", "theirs"))
    if ours != theirs:
        return f"columns {set(ours.items()) ^ set(theirs.items())}"
    names = ", ".join(f'"{n}"' for n in sorted(ours))
    found = []
    for a, b in (("ours", "theirs"), ("theirs", "ours")):
        rest = con.sql(f"SELECT {names} FROM {a} EXCEPT ALL SELECT {names} FROM {b}")
        found += [f"only in {a}: {row}" for row in rest.limit(3).fetchall()]
    return "; ".join(found) or None
