"""Compares a query's result with its SQL run by DuckDB."""

import os

import duckdb


def views(sf_dir):
    con = duckdb.connect()
    for t in os.listdir(sf_dir):
        path = f"{sf_dir}/{t}"
        con.execute(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def differences(spark, sf_dir, query, sql, out):
    """(rows by Spark, rows by SQL, rows in one only)."""
    df = query(spark, sf_dir)
    df = df.withColumns({c: df[c].cast("string") for c, kind in df.dtypes if kind == "void"})
    df.write.mode("overwrite").parquet(out)
    con = views(sf_dir)
    con.execute(f"CREATE TABLE own AS SELECT * FROM '{out}/*.parquet'")
    con.execute(f"CREATE TABLE other AS {sql}")
    cols = ", ".join(f'"{c}"' for c in sorted(df.columns))
    count = lambda s: con.execute(s).fetchall()[0][0]
    apart = count(f"SELECT count(*) FROM ((SELECT {cols} FROM own EXCEPT ALL SELECT {cols} FROM other) UNION ALL (SELECT {cols} FROM other EXCEPT ALL SELECT {cols} FROM own))")
    return count("SELECT count(*) FROM own"), count("SELECT count(*) FROM other"), apart
