"""Streaming twins of the incremental steps, run to the end of the given files."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.operators import routing
from corpusflow.operators.profile import status_class
from corpusflow.session import work_path
from corpusflow.streaming import admission, ingest
from workload.ordering import FLOOR, HOP_COLS, HOP_SQL, HOPS, tidy_windows
from workload.registry import query, table


def _stream(spark, sf, name):
    return ingest.table_stream(spark, f"{sf}/{name}.parquet", table(spark, sf, name).schema)


@query("stream_admit", "SELECT DISTINCT user_id FROM events")
def stream_admit(spark, sf):
    out = admission.stream_admit(_stream(spark, sf, "events"), "user_id", "ts", "90 days")
    rows = ingest.run_to_table(out, work_path(spark, "admit"), work_path(spark, "admit-state"))
    return rows.select("user_id")


@query("stream_admit_exact", "SELECT user_id, min(event_id) AS event_id FROM events GROUP BY 1")
def stream_admit_exact(spark, sf):
    path = work_path(spark, "keys")
    stream = _stream(spark, sf, "events").select("user_id", "event_id")
    admission.admit_to_table(stream, "user_id", ["event_id"], path, work_path(spark, "keys-state")).awaitTermination()
    return spark.read.parquet(path).select("user_id", "event_id")


@query("resume_ingest", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def resume_ingest(spark, sf):
    """Two runs over one checkpoint: the second finds nothing new."""
    path, state = work_path(spark, "ingest"), work_path(spark, "ingest-state")
    for _ in range(2):
        stream = _stream(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
        ingest.resume_ingest(stream, path, state).awaitTermination()
    return spark.read.parquet(path)


@query(
    "stream_progress",
    """SELECT CASE event_type WHEN 'purchase' THEN 'success' WHEN 'view' THEN 'skipped' WHEN 'error' THEN 'http_error'
              WHEN 'click' THEN 'network_error' ELSE 'other' END AS outcome, count(*) AS n FROM events GROUP BY 1""",
)
def stream_progress(spark, sf):
    outcome = status_class(
        F.col("event_type"), success="purchase", skipped="view", http_error="err", network_error="cl"
    )
    counts = ingest.stream_progress(_stream(spark, sf, "events"), outcome)
    return ingest.run_counts(counts, work_path(spark, "progress"), work_path(spark, "progress-state"))


@query(
    "stream_multires",
    # Append mode: a window is out once max(ts) - delay has passed its end.
    f"{HOP_SQL} SELECT {HOP_COLS} FROM a WHERE w1 <= (SELECT max(epoch(ts)) - 600 FROM events)",
)
def stream_multires(spark, sf):
    streams = ingest.stream_multires(
        _stream(spark, sf, "events"), "ts", HOPS, ["event_type"], "value", "10 minutes", FLOOR
    )
    rows = ingest.run_to_table(streams, work_path(spark, "windows"), work_path(spark, "windows-state"))
    return tidy_windows(rows)


@query(
    "stream_route",
    r"""SELECT doc_id, CASE WHEN text LIKE '%red %' THEN 'compilation' WHEN len > 6000 THEN 'compilation'
                            WHEN lang = 'en' THEN 'kept' ELSE 'foreign' END AS route
        FROM (SELECT doc_id, lang, lower(text) AS text,
                     length(regexp_replace(text, '^\s+|\s+$', '', 'g')) AS len FROM documents)""",
)
def stream_route(spark, sf):
    def route(batch):
        return routing.route_by_language(routing.content_route(batch, "text", "text", ["red "]), "en", "lang")

    path, stream = work_path(spark, "routes"), _stream(spark, sf, "documents")
    ingest.stream_route(stream, route, path, work_path(spark, "routes-state")).awaitTermination()
    # A table without rows leaves no file to take the schema from.
    stored = T.StructType([stream.schema["doc_id"]]).add("route", T.StringType())
    return spark.read.schema(stored).parquet(path).select("doc_id", "route")
