"""Compare a Spark result with an oracle result, order of rows and columns aside."""

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def oracle(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(r[i] + 0.0 if isinstance(r[i], float) else r[i] for i in order) for r in rows]
    return sorted(picked, key=lambda r: tuple((v is not None, str(v)) for v in r))


def assert_same(df, con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert _sorted(df.columns, [tuple(r) for r in df.collect()]) == _sorted(columns, expected)
