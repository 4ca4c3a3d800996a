"""Runs registered queries and their SQL side by side: ``python -m checks.compare [folder] [names]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

from checks.oracle import ORACLE
from checks.queries import QUERIES
from tallyport.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(spark, connection, sf_dir: str, name: str) -> str | None:
    """What differs between a query and its SQL; None if nothing does."""
    df = QUERIES[name](spark, sf_dir)
    ours = _rows(df.columns, df.collect())
    if name not in ORACLE:
        return None if ours else "no rows"
    result = connection.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    theirs = _rows(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    if ours == theirs:
        return None if ours else "no rows on either side"
    missing, extra = theirs - ours, ours - theirs
    return (
        f"{sum(ours.values())} against {sum(theirs.values())} rows, "
        f"{sum(missing.values())} missing, e.g. {next(iter(missing), None)}, "
        f"{sum(extra.values())} extra, e.g. {next(iter(extra), None)}"
    )


def connect(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8",
                          spark__ui__enabled="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            found = differences(spark, connection, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += found is not None
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.1f}s {found or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
