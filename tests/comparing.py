"""A Spark result against DuckDB."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def same(df, sql: str, folder: str) -> None:
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    answer = connection.execute(sql)
    kinds = {d[0]: str(d[1]) for d in answer.description}
    names = sorted(kinds)
    assert sorted(df.columns) == names
    assert {c: TYPES[t] for c, t in df.dtypes} == kinds
    at = [list(kinds).index(n) for n in names]
    order = lambda row: tuple((v is None, str(v)) for v in row)
    wanted = sorted((tuple(r[i] for i in at) for r in answer.fetchall()), key=order)
    assert sorted((tuple(r) for r in df.select(*names).collect()), key=order) == wanted
