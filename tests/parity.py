"""Run registered queries on Spark and their SQL on DuckDB and compare rows, column names and types.

    python tests/parity.py [-s SCALE] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import datetime
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, float) and value == 0:
        return 0.0
    if isinstance(value, datetime.datetime) and value.tzinfo:
        return value.astimezone(datetime.timezone.utc).replace(tzinfo=None)
    return value


def family(type_name: str) -> str:
    t = type_name.lower()
    for name, words in {
        "int": ("int", "long", "short"),
        "float": ("double", "float", "decimal"),
        "text": ("varchar", "string"),
        "time": ("timestamp",),
    }.items():
        if any(w in t for w in words):
            return "huge" if t == "hugeint" else ("decimal" if t.startswith("decimal") else name)
    return t


def compare(spark_rows, spark_schema, con, sql) -> list[str]:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = [str(d[1]) for d in cursor.description]
    problems = []
    mine = [f.name for f in spark_schema.fields]
    if sorted(mine) != sorted(names):
        return [f"columns {sorted(mine)} != {sorted(names)}"]
    duck = dict(zip(names, types, strict=True))
    for f in spark_schema.fields:
        a, b = family(f.dataType.simpleString()), family(duck[f.name])
        if a != b:
            problems.append(f"type of {f.name}: {f.dataType.simpleString()} / {duck[f.name]}")
    order = sorted(names)
    at_spark = [mine.index(n) for n in order]
    at_duck = [names.index(n) for n in order]
    left = Counter(tuple(plain(r[i]) for i in at_spark) for r in spark_rows)
    right = Counter(tuple(plain(r[i]) for i in at_duck) for r in cursor.fetchall())
    if left != right:
        only_left, only_right = left - right, right - left
        problems.append(f"rows {sum(left.values())}/{sum(right.values())}, differing {sum(only_left.values())}")
        problems.append(f"   columns {order}")
        for side, rows in (("spark", only_left), ("duckdb", only_right)):
            for r in sorted(rows, key=repr)[:3]:
                problems.append(f"   {side}: {r}")
    return problems


def main() -> int:
    from starmart import registry
    from starmart.session import get_session

    args = argparse.ArgumentParser()
    args.add_argument("-s", "--scale", default="0.01")
    args.add_argument("prefix", nargs="*")
    options = args.parse_args()
    folder = f"/root/testdata/sf{options.scale}"
    registry.load()
    spark = get_session("parity", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                                                 "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name, build in registry.QUERIES.items():
        if options.prefix and not any(name.startswith(p) for p in options.prefix):
            continue
        begin = time.time()
        try:
            df = build(spark, folder)
            rows = df.collect()
            problems = compare(rows, df.schema, con, registry.ORACLES[name]) if name in registry.ORACLES else []
            state = "rows" if name not in registry.ORACLES else "ok"
            if name not in registry.ORACLES and not rows:
                state = "EMPTY"
            if name in registry.ORACLES and not rows:
                state = "ok-empty"
        except Exception as e:  # noqa: BLE001
            problems, state, rows = [str(e)[:900]], "ERROR", []
        if problems:
            bad += 1
            state = "ERROR" if state == "ERROR" else "DIFF"
        print(f"{state:9s}{name:45s}{len(rows):8d} rows {time.time() - begin:6.2f}s", flush=True)
        for p in problems:
            print("      ", p, flush=True)
    print(f"{bad} with problems")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main()))
