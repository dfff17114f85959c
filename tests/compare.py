"""Comparison of a Spark result with a DuckDB result."""

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(
        (tuple(row[i] for i in order) for row in rows), key=lambda row: tuple(map(repr, row))
    )


def difference(df, con, sql):
    """None, or a short account of how the two results differ."""
    mine = rows_of(df.columns, [tuple(row) for row in df.collect()])
    cursor = con.execute(sql)
    theirs = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} against {theirs[0]}"
    if mine[1] == theirs[1]:
        return None if mine[1] else "both empty"
    left, right = set(mine[1]), set(theirs[1])
    return (
        f"{len(mine[1])} against {len(theirs[1])} rows; {mine[0]}; only in Spark "
        f"{sorted(left - right, key=repr)[:3]}; only in DuckDB {sorted(right - left, key=repr)[:3]}"
    )
