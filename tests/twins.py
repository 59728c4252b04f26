"""Compare a query with its SQL twin in DuckDB, rows in any order."""

import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def normal(frame):
    def cell(v):
        if pd.isna(v):
            return "null"
        if isinstance(v, bool):
            return str(v)
        return f"{v:.6g}" if isinstance(v, float) else str(v)

    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(tuple(cell(v.item() if hasattr(v, "item") else v) for v in row) for row in frame.itertuples(index=False))


def agree(spark, build, sql, sf_dir):
    import duckdb

    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    got, want = build(spark, sf_dir).toPandas(), con.sql(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    got, want = normal(got), normal(want)
    numeric = lambda r: tuple(x.replace("True", "1").replace("False", "0").removesuffix(".0") for x in r)
    assert sorted(map(numeric, got)) == sorted(map(numeric, want))
