"""Run registered queries beside their SQL twins and compare the results as multisets of rows.

    python -m checks.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession
from pyspark.sql import types as T

from checks.queries import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def session(name: str = "checks", cpus: str = "8") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else (0.0 if value == 0 else value)
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _sql_type(type_: T.DataType) -> str:
    names = {"string": "VARCHAR", "int": "INTEGER", "timestamp_ntz": "TIMESTAMP"}
    name = type_.simpleString()
    return names.get(name, name.upper())


def difference(spark: SparkSession, con, name: str, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    mine = Counter(tuple(_plain(v) for v in r) for r in df.select(*columns).collect())
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return f"columns {columns} vs {sorted(names)}"
    types = {d[0]: str(d[1]) for d in result.description}
    unlike = {c: (_sql_type(df.schema[c].dataType), types[c]) for c in columns}
    unlike = {c: pair for c, pair in unlike.items() if pair[0] != pair[1]}
    if unlike:
        return f"types {unlike}"
    order = [names.index(c) for c in columns]
    theirs = Counter(tuple(_plain(r[i]) for i in order) for r in result.fetchall())
    if mine == theirs:
        return None
    return (
        f"{sum(mine.values())} vs {sum(theirs.values())} rows; only Spark {list((mine - theirs).items())[:2]}; "
        f"only SQL {list((theirs - mine).items())[:2]}"
    )


def main(sf_dir: str, names: list[str]) -> int:
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            if name in ORACLES:
                problem = difference(spark, con, name, sf_dir)
            else:
                QUERIES[name](spark, sf_dir).collect()
                problem = None
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
