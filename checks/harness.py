"""Compare every query with its oracle on one scale: python -m checks.harness SF_DIR [name ...]"""

from __future__ import annotations

import math
import sys
import time

import duckdb

from checks.oracles import ORACLES
from checks.queries import QUERIES
from checks.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return v


def normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf: str, name: str, queries=QUERIES, oracles=ORACLES) -> str | None:
    """None when query and oracle agree, else what differs."""
    df = queries[name](spark, sf)
    got = [tuple(r) for r in df.collect()]
    if name not in oracles:
        return None if got else "no rows"
    relation = con.sql(oracles[name])
    wanted, columns = relation.fetchall(), relation.columns
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    got, wanted = normal(got, df.columns), normal(wanted, columns)
    if len(got) != len(wanted):
        return f"{len(got)} rows against {len(wanted)}"
    for a, b in zip(got, wanted):
        if a != b:
            return f"\n    spark  {str(a)[:600]}\n    oracle {str(b)[:600]}"
    return None


def connection(sf: str):
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"create view {table} as select * from '{sf}/{table}.parquet'")
    return con


def main(sf: str, names: list[str]) -> int:
    spark = local_session(8)
    con = connection(sf)
    wrong = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            problem = compare(spark, con, sf, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        kind = "oracle" if name in ORACLES else "rows"
        wrong += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} ({kind}) {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("wrong:", wrong)
    return wrong


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
