"""Run registered queries next to their SQL twins and compare all rows.

    python tests/compare.py [sf] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


#: twin type -> Spark type
TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "TIMESTAMP": "timestamp_ntz", "DATE": "date", "BOOLEAN": "boolean",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def differences(spark_df, con, sql: str) -> str | None:
    """None when names, types by family and all rows agree."""
    names = sorted(spark_df.columns)
    cursor = con.execute(sql)
    got = [d[0] for d in cursor.description]
    if sorted(got) != names:
        return f"columns {names} vs {sorted(got)}"
    order = [got.index(n) for n in names]
    spark_types = dict(spark_df.dtypes)
    twin_types = {d[0]: str(d[1]) for d in cursor.description}
    odd = {n: (spark_types[n], twin_types[n]) for n in names if TYPES.get(twin_types[n]) != spark_types[n]}
    if odd:
        return f"types {odd}"
    theirs = [tuple(r[i] for i in order) for r in cursor.fetchall()]
    ours = [tuple(r) for r in spark_df.select(*names).collect()]
    if len(ours) != len(theirs):
        return f"rows {len(ours)} vs {len(theirs)}"
    key = lambda r: tuple(str(v) for v in r)
    ours.sort(key=key)
    theirs.sort(key=key)
    for a, b in zip(ours, theirs):
        if key(a) != key(b):
            bad = {n: (x, y) for n, x, y in zip(names, a, b) if str(x) != str(y)}
            return f"first difference {bad} in {a}"
    return None


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, twins, queries = connect(sf_dir), entry.oracle_sql(), entry.queries()
    failed = 0
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in twins:
                result = differences(df, con, twins[name])
            else:
                result = None if df.count() else "no rows"
        except Exception as error:  # report and go on with the next query
            result = f"{type(error).__name__}: {str(error)[:600]}"
        failed += result is not None
        kind = "twin" if name in twins else "rows"
        print(f"## {name} {kind} {'OK' if result is None else 'FAIL ' + result} {time.time() - start:.1f}s", flush=True)
    print(f"## failed: {failed}")
    return failed


if __name__ == "__main__":
    sys.exit(main())
