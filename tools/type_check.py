"""Compare result column types of every query (Spark) with its oracle (DuckDB)."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

SPARK_TO_DUCK = {"IntegerType()": "INTEGER", "LongType()": "BIGINT", "DoubleType()": "DOUBLE",
                 "StringType()": "VARCHAR", "DateType()": "DATE", "TimestampType()": "TIMESTAMP",
                 "BooleanType()": "BOOLEAN", "TimestampNTZType()": "TIMESTAMP"}


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    from martspark.catalog import ORACLES, QUERIES
    from martspark.session import local_session
    spark = local_session(4)
    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem").split():
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    bad = 0
    for name in QUERIES:
        if len(sys.argv) > 2 and not any(p in name for p in sys.argv[2:]):
            continue
        sch = {f.name: SPARK_TO_DUCK.get(repr(f.dataType), repr(f.dataType)) for f in QUERIES[name](spark, sf_dir).schema}
        rel = con.sql(ORACLES[name])
        dk = {c: str(t) for c, t in zip(rel.columns, rel.types)}
        diff = {c: (sch.get(c), dk.get(c)) for c in set(sch) | set(dk) if sch.get(c) != dk.get(c)}
        if diff:
            bad += 1
            print(name, diff, flush=True)
    print("queries with type differences:", bad)


if __name__ == "__main__":
    main()
