"""Run registered queries in Spark and their check SQL in DuckDB, side by side.

usage: python check.py [sf] [name ...]
"""

import importlib
import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession


def make_session():
    return (SparkSession.builder.master("local[8]").appName("check")
            .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
            .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
            .config("spark.sql.files.openCostInBytes", "65536").config("spark.sql.session.timeZone", "UTC")
            .getOrCreate())


def norm(v):
    if v is None or isinstance(v, (bool, int, str)):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return str(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def main(argv):
    sf = argv[0] if argv else "0.01"
    entry = importlib.import_module("__spark_entry__")
    queries, checks = entry.queries(), entry.oracle_sql()
    names = argv[1:] or list(queries)
    spark = make_session()
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    con = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
              "embeddings", "pages", "benchmark", "labels", "conversations"]:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    bad = []
    for name in names:
        if name not in queries:
            names2 = [q for q in queries if q.startswith(name)]
            print("unknown", name, names2)
            continue
        t0 = time.time()
        try:
            df = queries[name](spark, sf_dir)
            rows = [tuple(r) for r in df.toLocalIterator()] if False else [tuple(r) for r in df.collect()]
        except Exception as ex:
            print(f"FAIL {name}: spark {type(ex).__name__} {str(ex)[:600]}", flush=True)
            bad.append(name)
            continue
        t1 = time.time()
        if name not in checks:
            print(f"rows {name}: {len(rows)} rows {t1 - t0:.1f}s", flush=True)
            continue
        try:
            cur = con.execute(checks[name])
            cols = [d[0] for d in cur.description]
            types = {d[0]: str(d[1]) for d in cur.description}
            orows = cur.fetchall()
        except Exception as ex:
            print(f"FAIL {name}: duckdb {str(ex)[:600]}", flush=True)
            bad.append(name)
            continue
        t2 = time.time()
        sc, sr = canon(df.columns, rows)
        oc, orr = canon(cols, orows)
        stypes = dict(df.dtypes)
        pairs = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
        odd = [f"{c}:{stypes[c]}/{types.get(c)}" for c in df.columns
               if stypes[c] in pairs and types.get(c) != pairs[stypes[c]]]
        if sc == oc and sr == orr:
            print(f"ok   {name}: {len(sr)} rows spark {t1 - t0:.1f}s duck {t2 - t1:.1f}s {'TYPES ' + str(odd) if odd else ''}", flush=True)
            if odd:
                bad.append(name)
        else:
            bad.append(name)
            print(f"FAIL {name}: cols {sc == oc} {sc if sc != oc else ''} {oc if sc != oc else ''} rows {len(sr)}/{len(orr)} {odd}")
            diff = [(a, b) for a, b in zip(sr, orr) if a != b][:3]
            for a, b in diff:
                print("   spark", a)
                print("   duck ", b, flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
