"""Compare registered queries with their SQL on the same parquet files."""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def norm(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, Decimal):
        return round(float(value), 6) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(norm(v) for v in value)
    return value


def kind(type_name: str) -> str:
    t = str(type_name).lower()
    for short, names in {
        "long": ("bigint", "int64", "long", "ubigint"),
        "int": ("integer", "int32", "int"),
        "double": ("double",),
        "string": ("varchar", "string"),
        "bool": ("boolean", "bool"),
    }.items():
        if t in names:
            return short
    return t


def compare(spark, name, build, sql, folder, con) -> tuple[bool, str]:
    start = time.time()
    frame = build(spark, folder)
    rows = frame.collect()
    spark_seconds = time.time() - start
    columns = sorted(frame.columns)
    got = sorted((tuple(norm(r[c]) for c in columns) for r in rows), key=repr)
    if sql is None:
        return True, f"{name}: {len(got)} rows, no SQL, {spark_seconds:.1f}s"
    start = time.time()
    relation = con.sql(sql)
    sql_columns, sql_types = relation.columns, relation.types
    want_rows = relation.fetchall()
    sql_seconds = time.time() - start
    index = {c: i for i, c in enumerate(sql_columns)}
    if sorted(sql_columns) != columns:
        return False, f"{name}: columns {columns} != {sorted(sql_columns)}"
    want = sorted((tuple(norm(r[index[c]]) for c in columns) for r in want_rows), key=repr)
    types = {f.name: kind(f.dataType.simpleString()) for f in frame.schema.fields}
    wrong = {c: (types[c], kind(sql_types[index[c]])) for c in columns if types[c] != kind(sql_types[index[c]])}
    text = f"{name}: {len(got)} rows, spark {spark_seconds:.1f}s, sql {sql_seconds:.1f}s"
    if wrong:
        text += f" TYPES {wrong}"
    if got != want:
        got_set, want_set = set(got), set(want)
        only = [r for r in got if r not in want_set][:3]
        other = [r for r in want if r not in got_set][:3]
        return False, f"{text} MISMATCH {len(got)} vs {len(want)} {columns}\n   spark {only}\n   sql   {other}"
    if not got:
        text += " EMPTY"
    return not wrong, text


if __name__ == "__main__":
    sys.path.insert(0, str(__import__("pathlib").Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    folder = "/root/testdata/sf0.01"
    args = [a for a in sys.argv[1:]]
    if args and args[0].startswith("/"):
        folder = args.pop(0)
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sqls, bad, done = entry.oracle_sql(), [], 0
    for name, build in entry.queries().items():
        if args and not any(name == a or (a.endswith("*") and name.startswith(a[:-1])) for a in args):
            continue
        try:
            ok, text = compare(spark, name, build, sqls.get(name), folder, con)
        except Exception as exc:  # report and go on with the next query
            ok, text = False, f"{name}: ERROR {type(exc).__name__}: {str(exc)[:1500]}"
        done += 1
        print(("ok   " if ok else "FAIL ") + text, flush=True)
        if not ok:
            bad.append(name)
    print(done, "queries,", len(bad), "bad:", " ".join(bad))
