"""Run queries next to their SQL twins in DuckDB and report differences.

    python tools/compare.py [sf_dir] [name ...]

COMPARE_CONF takes more Spark settings as key=value, comma-separated, for
example spark.sql.autoBroadcastJoinThreshold=-1 to see the shuffled joins.
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return repr(0.0 if value == 0 else value)
    return str(value)


def _kind(name: str) -> str:
    name = str(name).lower().split("(")[0]
    kinds = {
        "integer": "int", "bigint": "long", "hugeint": "huge", "varchar": "string", "double": "double",
        "float": "float", "boolean": "boolean", "timestamp": "timestamp", "timestamp_ntz": "timestamp",
        "tinyint": "tinyint", "smallint": "smallint",
    }
    return {"bigint": "long"}.get(name, kinds.get(name, name))


def compare(spark, con, name, fn, sql, sf_dir, inspect=None) -> tuple[bool, str]:
    """Names, types and the multiset of rows; ``inspect`` gets the Spark table first."""
    df = fn(spark, sf_dir)
    if inspect:
        inspect(df)
    cols = sorted(df.columns)
    ours = [tuple(_plain(r[c]) for c in cols) for r in df.collect()]
    if sql is None:
        return bool(ours), f"{len(ours)} rows, no twin"
    cur = con.execute(sql)
    described = [(d[0], d[1]) for d in cur.description]
    names = [d[0] for d in described]
    if sorted(names) != cols:
        return False, f"columns {cols} vs {sorted(names)}"
    kinds = {n: _kind(t) for n, t in described}
    mine = {f.name: _kind(f.dataType.simpleString()) for f in df.schema.fields}
    note = "" if kinds == mine else f" TYPES {[(c, mine[c], kinds[c]) for c in cols if mine[c] != kinds[c]]}"
    at = [names.index(c) for c in cols]
    theirs = [tuple(_plain(r[i]) for i in at) for r in cur.fetchall()]
    a, b = Counter(ours), Counter(theirs)
    if a == b:
        return not note, f"{len(ours)} rows equal{note}"
    return False, (
        f"{len(ours)} vs {len(theirs)} rows{note}; only ours {list((a - b).items())[:2]}; "
        f"only twin {list((b - a).items())[:2]}"[:900]
    )


def main() -> int:
    import importlib

    from corpusflow.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    entry = importlib.import_module("__spark_entry__")
    queries, oracles = entry.queries(), entry.oracle_sql()
    chosen = sys.argv[2:] or list(queries)
    extra = dict(p.split("=", 1) for p in os.environ.get("COMPARE_CONF", "").split(",") if p)
    spark = build_session(
        "compare", "local[8]", **extra | {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                  "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in chosen:
        start = time.time()
        try:
            ok, text = compare(spark, con, name, queries[name], oracles.get(name), sf_dir)
        except Exception as err:  # report and go on with the others
            ok, text = False, f"{type(err).__name__}: {str(err)[:600]}"
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {name:28s} {time.time() - start:6.2f}s {text}", flush=True)
    print(f"{len(chosen) - bad} of {len(chosen)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
