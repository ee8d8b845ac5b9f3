import glob
import os

import duckdb


def same_rows(spark, query, sql, sf_dir):
    """Rows and columns of a query and of its SQL, as sorted lists."""
    df = query(spark, sf_dir)
    columns = sorted(df.columns)
    ours = sorted(tuple(str(r[c]) for c in columns) for r in df.collect())
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    found = con.sql(sql)
    names = list(found.columns)
    assert sorted(names) == columns
    theirs = sorted(tuple(str(r[names.index(c)]) for c in columns) for r in found.fetchall())
    assert ours == theirs
    return ours
