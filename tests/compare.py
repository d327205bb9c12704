"""Comparison of a query's result with its oracle's."""

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def database(sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for table in TABLES:
        con.execute(f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _cell(value):
    return repr(value) if isinstance(value, float) else str(value)


def rows_by_name(names: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(df, con, oracle: str) -> str | None:
    """What differs, or None."""
    cursor = con.execute(oracle)
    want_names, want = rows_by_name([d[0] for d in cursor.description], cursor.fetchall())
    got_names, got = rows_by_name(df.columns, [tuple(r) for r in df.collect()])
    if got_names != want_names:
        return f"columns {got_names} instead of {want_names}"
    if got != want:
        extra = [r for r in got if r not in set(want)][:2]
        missing = [r for r in want if r not in set(got)][:2]
        return f"{len(got)} rows instead of {len(want)}; not wanted {extra}; missing {missing}"
    return None
