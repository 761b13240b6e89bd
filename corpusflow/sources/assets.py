"""Listings of asset files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow import constants as K
from corpusflow.functions.columns import strip


def scan_assets(
    spark: SparkSession,
    folder: str,
    suffix: str = ".mp3",
    id_col: str = K.ID_COL,
    glob: str | None = None,
    nested: bool = False,
) -> DataFrame:
    """(id, path, size) of non-empty files with the suffix; contents are not read.

    ``glob`` names the files if not all that end in the suffix are meant.
    ``nested`` takes in folders below ``folder``; more than
    ``spark.sql.sources.parallelPartitionDiscovery.threshold`` of them are listed
    by tasks, so large collections belong into folders by a part of their name.

    The identifier is the file name without its suffix. Spark's file source
    leaves zero-length files out.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob or f"*{suffix}")
    files = reader.option("recursiveFileLookup", nested).load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    listed = files.select("path", F.col("length").alias("size"), name.alias("_name"))
    stem = F.expr(f"substring(_name, 1, char_length(_name) - {len(suffix)})")
    return listed.filter(F.col("size") > 0).select(strip(stem).alias(id_col), "path", "size")


def scan_all_assets(
    spark: SparkSession,
    folder: str,
    suffixes: list[str] = K.ASSET_EXTENSIONS,
    id_col: str = K.ID_COL,
) -> DataFrame:
    """(id, ext, path, size) of all accepted extensions, from one listing of the folder."""
    found = scan_assets(spark, folder, "", id_col, "*{" + ",".join(suffixes) + "}")
    out = found.withColumn("ext", F.lit(None).cast("string"))
    for suffix in suffixes:
        ends = F.col(id_col).endswith(suffix)
        out = out.withColumn("ext", F.coalesce("ext", F.when(ends, F.lit(suffix))))
    stem = F.substring(id_col, F.lit(1), F.length(id_col) - F.length("ext"))
    return out.select(strip(stem).alias(id_col), "path", "size", "ext")


def asset_summary(
    assets: DataFrame, inventory: DataFrame | None = None, id_col: str = K.ID_COL
) -> DataFrame:
    """Number of files, total megabytes and, against an inventory of names, the empty ones."""
    files = assets.select("size", F.lit(False).alias("_empty"))
    totals = [
        F.count_if(~F.col("_empty")).alias("files"),
        F.coalesce(F.sum("size") / F.lit(1024.0 * 1024.0), F.lit(0.0)).alias("total_mb"),
    ]
    if inventory is None:
        return files.agg(*totals)
    empty = inventory.select(id_col).distinct().join(assets.select(id_col), id_col, "left_anti")
    both = files.unionByName(
        empty.select(F.lit(None).cast("long").alias("size"), F.lit(True).alias("_empty"))
    )
    return both.agg(*totals, F.count_if("_empty").alias("empty"))
