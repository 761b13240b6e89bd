"""Resumable ingestion, running counts, windows and routing on arriving files."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from math import gcd

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from corpusflow import constants as K
from corpusflow.operators.windows import frame_size
from corpusflow.streaming.admission import event_time


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    name_filter: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def table_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """A Parquet table as a stream, be it a folder of files, partitioned or not, or a single file.

    A stream takes a single file only as the match of a pattern; the files beside it are not listed.
    """
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder = at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory()
    found = path if folder else f"{at.getParent()}/{{{at.getName()}}}"
    return file_stream(spark, found, schema, files_per_batch=files_per_batch)


def resume_ingest(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Take over what has arrived since the last run, exactly once, then stop."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_progress(stream: DataFrame, outcome: Column) -> DataFrame:
    """Running number of rows per outcome; state is one row per outcome."""
    return stream.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))


def stream_multires(
    stream: DataFrame,
    ts: str,
    hops: Sequence[int],
    keys: Sequence[str],
    value: str,
    delay: str,
    floor: int = K.FRAME_FLOOR,
) -> DataFrame:
    """The sliding windows of ``multires_windows``, all hops in one streaming query.

    Two stateful operators in a chain: events are read once and become panes of the greatest common width;
    each final pane then goes to the windows of every hop. Rows later than the watermark are dropped;
    a window is final once the watermark has passed its end.
    """
    timed = event_time(stream, ts, delay)
    sizes = {hop: frame_size(hop, floor) for hop in hops}
    pane = reduce(gcd, [*sizes, *sizes.values()])
    panes = timed.groupBy(*keys, F.window(ts, f"{pane} seconds").alias("_pane")).agg(
        F.count("*").alias("_n"), F.count(value).alias("_filled"), F.sum(value).alias("_sum"), F.max(value).alias("_max")
    )
    start = F.col("_pane.start").cast("long")

    def frames(hop: int) -> Column:
        last = F.floor(start / hop) * hop
        begins = F.sequence(last, last - (sizes[hop] // hop - 1) * hop, F.lit(-hop).cast("long"))
        # A window as long as no multiple of the hop reaches back one hop more.
        begins = F.concat(begins, F.array(last - sizes[hop] // hop * hop)) if sizes[hop] % hop else begins
        met = F.filter(begins, lambda b: b + sizes[hop] > start)
        frame = lambda b: F.struct(F.timestamp_seconds(b).alias("start"), F.timestamp_seconds(b + sizes[hop]).alias("end"))
        return F.transform(met, lambda b: F.struct(F.lit(hop).alias("hop"), frame(b).alias("window")))

    # The windows of a pane have its event time, so that the watermark finishes them as well.
    late = panes.schema["_pane"].metadata
    dealt = panes.select(*keys, "_n", "_filled", "_sum", "_max", F.explode(F.concat(*map(frames, hops))).alias("_f"))
    framed = dealt.select(*keys, "_n", "_filled", "_sum", "_max", F.col("_f.hop").alias("hop"), F.col("_f.window").alias("_w", metadata=late))
    return (
        framed.groupBy(*keys, "hop", "_w")
        .agg(F.sum("_n").alias("n"), F.sum("_sum").alias("total"), F.sum("_filled").alias("_filled"), F.max("_max").alias("top"))
        .select(
            *keys,
            "hop",
            F.col("_w.start").alias("w_start"),
            F.col("_w.end").alias("w_end"),
            "n",
            "total",
            F.try_divide("total", "_filled").alias("mean"),
            "top",
        )
    )


def stream_route(
    stream: DataFrame,
    route: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
) -> StreamingQuery:
    """Route every micro-batch and store it by route.

    ``route`` gives a table with a ``route`` column. A micro-batch owns its
    folder, so a replay replaces it.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        routed = route(batch)
        routed.write.mode("overwrite").partitionBy("route").parquet(f"{path}/batch_id={batch_id}")

    return (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_to_table(
    streams: DataFrame | Sequence[DataFrame], path: str, checkpoint: str
) -> DataFrame:
    """Run append streams to the end of the available input and read their output."""
    parts = [streams] if isinstance(streams, DataFrame) else list(streams)
    running = [
        resume_ingest(part, f"{path}/{i}", f"{checkpoint}/{i}") for i, part in enumerate(parts)
    ]
    for query in running:
        query.awaitTermination()
    return reduce(
        DataFrame.unionByName,
        [p.sparkSession.read.schema(p.schema).parquet(f"{path}/{i}") for i, p in enumerate(parts)],
    )


def run_counts(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a counting stream and read its last complete result."""

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    query = (
        stream.writeStream.outputMode("complete")
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
