"""Order-insensitive comparison of Spark and DuckDB results."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def duck_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    cursor = con.execute(sql)
    return [c[0] for c in cursor.description], cursor.fetchall()


def normal(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(r[i] for i in order) for r in rows)


def assert_same(df, sf_dir: str, sql: str) -> int:
    columns, rows = duck_rows(sf_dir, sql)
    want_names, want = normal(columns, rows)
    got_names, got = normal(df.columns, map(tuple, df.collect()))
    assert got_names == want_names
    missing, extra = want - got, got - want
    assert not missing and not extra, (
        f"{sum(missing.values())} rows missing, {sum(extra.values())} extra; "
        f"e.g. {list(missing)[:2]} vs {list(extra)[:2]}"
    )
    return sum(got.values())
