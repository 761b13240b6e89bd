"""Positions, batches, running counts, sliding windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.operators import index, windows
from workload.cleaning import LINE_ORDER
from workload.registry import query, table


@query(
    "dense_index",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
               row_number() OVER (ORDER BY l_returnflag, {", ".join(LINE_ORDER)}) - 1 AS pos FROM lineitem""",
)
def dense_index(spark, sf):
    order = ["l_returnflag", *LINE_ORDER]  # three hot leading values
    indexed = index.dense_index(table(spark, sf, "lineitem").select(*order), order)
    return indexed.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "pos")


@query(
    "hash_index",
    """SELECT doc_id, row_number() OVER (ORDER BY substr(md5('7:' || doc_id), 1, 12), doc_id) - 1 AS pos
       FROM documents""",
)
def hash_index(spark, sf):
    return index.hash_index(table(spark, sf, "documents").select("doc_id"), "doc_id", seed=7)


@query(
    "chunk",
    """SELECT *, pos // 50 + 1 AS batch FROM
         (SELECT event_id, row_number() OVER (ORDER BY user_id, event_id) - 1 AS pos FROM events)""",
)
def chunk(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id")
    return index.chunk(events, 50, ["user_id", "event_id"]).select("event_id", "pos", "batch")


@query(
    "running_progress",
    """WITH r AS (SELECT event_id, CAST('nightly' AS VARCHAR) AS run,
                         row_number() OVER (ORDER BY event_id) AS completed,
                         CAST(sum(CAST(event_type <> 'error' AS INTEGER)) OVER (ORDER BY event_id) AS BIGINT) AS success,
                         count(*) OVER () AS total FROM events)
       SELECT run, event_id, completed, success, total, completed - success AS fail
       FROM r WHERE completed % 50 = 0 OR completed = total""",
)
def running_progress(spark, sf):
    log = table(spark, sf, "events").withColumn("run", F.lit("nightly"))
    ok = F.col("event_type") != "error"
    return index.running_progress(log, "run", "event_id", ok, every=50, width=1000)


HOPS = [900, 1800, 3600]
FLOOR = 3600
HOP_SQL = """WITH e AS (SELECT event_type, ts, value, CAST(floor(epoch(ts)) AS BIGINT) AS s FROM events),
     h AS (SELECT * FROM (VALUES (900, 3600), (1800, 7200), (3600, 14400)) v(hop, size)),
     w AS (SELECT event_type, hop, size, value, (s // hop - k) * hop AS w0 FROM e, h, range(4) r(k)),
     a AS (SELECT event_type, hop, w0, w0 + size AS w1, count(*) AS n, sum(value) AS total,
                  avg(value) AS mean, max(value) AS top FROM w GROUP BY ALL)"""
HOP_COLS = """event_type, hop, strftime(make_timestamp(w0 * 1000000), '%Y-%m-%d %H:%M:%S') AS w_start,
     strftime(make_timestamp(w1 * 1000000), '%Y-%m-%d %H:%M:%S') AS w_end, n, round(total, 4) AS total, floor(mean * 1000000 + 0.3) / 1000000 AS mean, top"""


def tidy_windows(df):
    """Window bounds as clock times, sums and means cut to a fixed number of digits.

    Means are cut off the half, as the engines round exact halves differently.
    """
    clock = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("w_start", "w_end")}
    return df.withColumns(clock | {"total": F.round("total", 4), "mean": F.floor(F.col("mean") * 1000000 + 0.3) / 1000000})


@query("multires_windows", f"{HOP_SQL} SELECT {HOP_COLS} FROM a")
def multires_windows(spark, sf):
    out = windows.multires_windows(table(spark, sf, "events"), "ts", HOPS, ["event_type"], "value", FLOOR)
    return tidy_windows(out)
