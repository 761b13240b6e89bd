"""Admit every key once from an endless stream.

Stored keys lie in folders, one for each micro-batch, and in parts by hash within a folder. Each folder
has Bloom filters, so a batch opens only the parts that may hold one of its keys: a batch of new keys opens
hardly any, however long the history. Small folders are merged into larger ones as they add up.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusflow.operators.dedup import admit_new, cap

# Parts of a folder: so many at least, and one for so many keys.
LEAST_PARTS, KEYS_PER_PART = 64, 1_000_000
# A filter is a number of bitmaps of this many bits, a key has PROBES bits in one of them.
BITMAP_BITS, BITS_PER_KEY, PROBES = 32_768, 10, 4
# Folders beyond which the latest are merged.
FOLDERS = 8
FILTER = "bucket int, chunk int, bits binary, parts int, chunks int, keys long"


def event_time(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    """Watermark on ``ts``; zone-less timestamps are cast, as watermarks need an instant."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def stream_admit(stream: DataFrame, key: str, ts: str, delay: str) -> DataFrame:
    """Let a key pass once within the watermark delay; state older than that is dropped."""
    return event_time(stream, ts, delay).dropDuplicatesWithinWatermark([key])


class _Files:
    """The few file operations that a table of folders needs, on whatever storage its path names."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.root = spark._jvm, path.rstrip("/")
        self.fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str = "") -> list[str]:
        return [s.getPath().getName() for s in self.fs.listStatus(self._path(folder))] if self.fs.exists(self._path(folder)) else []

    def exists(self, name: str) -> bool:
        return self.fs.exists(self._path(name))

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)

    def rename(self, name: str, to: str) -> None:
        if not self.fs.rename(self._path(name), self._path(to)):
            raise OSError(f"{self.root}: {name} could not become {to}")

    def batches(self, folder: str = "") -> list[int]:
        return sorted(int(n.removeprefix("batch_id=")) for n in self.names(folder) if n.startswith("batch_id="))


class KeyStore:
    """The table of admitted rows at ``path``: ``batch_id=…/bucket=…``, with ``_filters`` beside."""

    def __init__(self, spark: SparkSession, path: str, key: str, kind: str):
        self.spark, self.path, self.key, self.kind = spark, path.rstrip("/"), key, kind
        self.files = _Files(spark, path)
        self._finish_merge()
        for batch in self.files.batches():
            if not self.files.exists(f"_filters/batch_id={batch}/_SUCCESS"):
                self.write_filters(batch)

    def _part(self, parts: Column | int) -> Column:
        return F.pmod(F.xxhash64(self.key), parts if isinstance(parts, Column) else F.lit(parts)).cast("int")

    def _chunk(self, chunks: Column | int) -> Column:
        return F.pmod(F.xxhash64(F.lit(1), self.key), chunks if isinstance(chunks, Column) else F.lit(chunks)).cast("int")

    def _bits(self) -> list[Column]:
        return [F.pmod(F.xxhash64(F.lit(2 + i), self.key), F.lit(BITMAP_BITS)) for i in range(PROBES)]

    def stored(self, parts: list[tuple[int, list[int]]]) -> DataFrame:
        """Keys of the given parts of folders; no other file is opened."""
        rows = self.spark.read.schema(f"{self.key} {self.kind}, batch_id long, bucket int").parquet(self.path)
        own = [(F.col("batch_id") == batch) & F.col("bucket").isin(buckets) for batch, buckets in parts]
        return rows.where(reduce(lambda a, b: a | b, own, F.lit(False)))

    def write(self, rows: DataFrame, name: str, keys: int | None = None) -> None:
        """Rows in parts by key; more parts for more keys (powers of two, so that parts are refined)."""
        parts = max(LEAST_PARTS, 1 << (max(1, keys or 1) // KEYS_PER_PART).bit_length())
        dealt = rows.withColumn("bucket", self._part(parts)).repartition("bucket")
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{name}")

    def write_filters(self, batch: int) -> None:
        folder = f"{self.path}/batch_id={batch}"
        rows = self.spark.read.schema(f"{self.key} {self.kind}, bucket int").parquet(folder)
        keys = rows.count()
        parts = max(LEAST_PARTS, 1 << (max(1, keys) // KEYS_PER_PART).bit_length())
        chunks = 1 + keys * BITS_PER_KEY // (parts * BITMAP_BITS)
        bits = rows.select(self._part(parts).alias("bucket"), self._chunk(chunks).alias("chunk"), F.explode(F.array(*self._bits())).alias("bit"))
        maps = bits.groupBy("bucket", "chunk").agg(F.bitmap_construct_agg("bit").alias("bits"))
        named = maps.withColumns({"parts": F.lit(parts), "chunks": F.lit(chunks), "keys": F.lit(keys).cast("long")})
        named.write.mode("overwrite").parquet(f"{self.path}/_filters/batch_id={batch}")

    def filters(self, before: int) -> DataFrame | None:
        if not any(b < before for b in self.files.batches("_filters")):
            return None
        return self.spark.read.schema(f"{FILTER}, batch_id long").parquet(f"{self.path}/_filters").where(F.col("batch_id") < before)

    def folders(self, before: int) -> list[tuple[int, int, int, int]]:
        """(batch, parts, chunks, keys) of every folder with keys: a few rows, as folders are merged."""
        found = self.filters(before)
        return [] if found is None else sorted(tuple(r) for r in found.select("batch_id", "parts", "chunks", "keys").distinct().collect())

    def may_hold(self, keys: DataFrame, before: int) -> list[tuple[int, list[int]]]:
        """The parts of folders whose filters have a key of ``keys``."""
        folders = self.folders(before)
        if not folders:
            return []
        each = F.explode(F.array(*[F.struct(*[F.lit(x).alias(n) for n, x in zip(("batch_id", "parts", "chunks"), f)]) for f in folders]))
        asked = keys.select(self.key, each.alias("f")).select(
            F.col("f.batch_id").cast("long").alias("batch_id"), self._part(F.col("f.parts")).alias("bucket"), self._chunk(F.col("f.chunks")).alias("chunk"), *[b.alias(f"p{i}") for i, b in enumerate(self._bits())]
        )
        met = asked.join(self.filters(before).select("batch_id", "bucket", "chunk", "bits"), ["batch_id", "bucket", "chunk"])

        def is_set(name: str) -> Column:
            byte = F.conv(F.hex(F.substring("bits", (F.col(name) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
            return F.getbit(byte, (F.col(name) % 8).cast("int")) == 1

        hits = met.where(reduce(lambda a, b: a & b, [is_set(f"p{i}") for i in range(PROBES)]))
        found = hits.groupBy("batch_id").agg(F.sort_array(F.collect_set("bucket")).alias("b")).collect()
        return sorted((r["batch_id"], r["b"]) for r in found)

    def merge(self, before: int) -> None:
        """Merge the latest folders before ``before`` once there are too many.

        Taken are the last ones, back to a folder that is larger than all behind it: a key is written again
        about as often as the table doubles. The merged folder is complete before the old ones go, and
        what a failure leaves half done is ended by the next ``KeyStore``.
        """
        sizes = {b: k for b, _, _, k in self.folders(before)}
        batches = [b for b in self.files.batches() if b < before]
        if len(batches) <= FOLDERS:
            return
        first, behind = len(batches) - 2, sizes.get(batches[-1], 0)
        while first >= 0 and (sizes.get(batches[first], 0) <= behind or len(batches) - 1 - first < max(2, FOLDERS // 2)):
            behind += sizes.get(batches[first], 0)
            first -= 1
        low, high = batches[first + 1], batches[-1]
        rows = self.spark.read.parquet(self.path).where(F.col("batch_id").between(low, high))
        self.write(rows.drop("batch_id", "bucket"), f"_merge/{low}-{high}", behind)
        self._finish_merge()
        self.write_filters(high)

    def _finish_merge(self) -> None:
        for name in self.files.names("_merge"):
            if not self.files.exists(f"_merge/{name}/_SUCCESS"):
                continue  # the writer failed; the next one writes over it
            low, high = map(int, name.split("-"))
            for batch in [b for b in {*self.files.batches(), *self.files.batches("_filters")} if low <= b <= high]:
                self.files.delete(f"batch_id={batch}")
                self.files.delete(f"_filters/batch_id={batch}")
            self.files.rename(f"_merge/{name}", f"batch_id={high}")


def admit_to_table(
    stream: DataFrame,
    key: str,
    order_by: Sequence[str],
    path: str,
    checkpoint: str,
    target: int | None = None,
) -> StreamingQuery:
    """Exact first-wins admission against the keys stored so far.

    Keeps no state in the stream. Every micro-batch owns one folder that a
    replay after a failure overwrites, so no key is stored twice. A batch opens the parts of older folders
    whose Bloom filters may hold one of its keys (see ``KeyStore``); how many keys there are stands beside
    the filters. The table is read as ``spark.read.parquet(path)``, between two batches.
    """

    def admit(batch: DataFrame, batch_id: int) -> None:
        store = KeyStore(batch.sparkSession, path, key, batch.schema[key].dataType.simpleString())
        batch.persist()
        met = store.may_hold(batch.select(key).where(F.col(key).isNotNull()).distinct(), batch_id)
        seen = store.stored(met) if met else batch.select(key).limit(0)
        fresh = admit_new(batch, seen, key, order_by)
        if target is not None:
            fresh = cap(fresh, target - sum(f[3] for f in store.folders(batch_id)), order_by)
        store.write(fresh, f"batch_id={batch_id}")
        batch.unpersist()
        store.write_filters(batch_id)
        store.merge(batch_id)

    return (
        stream.writeStream.foreachBatch(admit)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
