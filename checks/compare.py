"""Run queries beside their SQL: ``python -m checks.compare <sf_dir> [name ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical(rows, names) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])

    def value(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v + 0.0)
        return str(v) if v is not None else None

    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=lambda t: tuple((x is None, x or "") for x in t))


def compare(spark: SparkSession, con, name: str, sf_dir: str) -> str:
    from checks import ORACLES, QUERIES

    start = time.perf_counter()
    df = QUERIES[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    spent = time.perf_counter() - start
    if name not in ORACLES:
        return f"rows {len(got):7d} {spent:6.2f}s {name}"
    start = time.perf_counter()
    cur = con.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    want = cur.fetchall()
    sql_spent = time.perf_counter() - start
    if sorted(names) != sorted(df.columns):
        return f"FAIL columns {name}: {sorted(df.columns)} != {sorted(names)}"
    a, b = canonical(got, df.columns), canonical(want, names)
    if a != b:
        extra, lack = sorted(set(a) - set(b), key=str)[:3], sorted(set(b) - set(a), key=str)[:3]
        return f"FAIL values {name}: rows {len(a)} != {len(b)}; only spark {extra}; only sql {lack}"
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    like = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
        "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
    }
    off = {c: (k, types[c]) for c, k in kinds.items() if like.get(k, k) != types[c]}
    note = f" TYPES {off}" if off else ""
    return f"ok   {len(got):7d} {spent:6.2f}s sql {sql_spent:5.2f}s {name}{note}"


def main() -> int:
    from checks import QUERIES

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf_dir), 0
    for name in names or QUERIES:
        try:
            line = compare(spark, con, name, sf_dir)
        except Exception as error:  # noqa: BLE001
            line = f"FAIL error {name}: {type(error).__name__} {str(error)[:700]}"
        bad += line.startswith("FAIL")
        print(line, flush=True)
    print("failures", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
