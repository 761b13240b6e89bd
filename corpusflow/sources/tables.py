"""Tables, identifier lists and stored features."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.functions.columns import strip
from corpusflow.operators.dedup import concat_tables


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header, quoted line breaks, doubled quotes and an optional BOM.

    Quoted line breaks make a file unsplittable: give large tables as many
    files, or as Parquet. A missing path is an error at once.
    """
    reader = spark.read.schema(schema).options(
        header=True, multiLine=True, quote='"', escape='"', enforceSchema=False
    )
    try:
        return reader.csv(path)
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no table at {path}") from err
        raise


def write_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet") -> None:
    """Write the whole table as Parquet or as CSV that ``read_csv_table`` reads back."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.options(header=True, quote='"', escape='"').csv(path)
    else:
        writer.format(fmt).save(path)


def append_batch(df: DataFrame, path: str, schema: T.StructType) -> None:
    """Append rows under a fixed schema: unknown columns are an error, absent ones NULL."""
    extra = sorted(set(df.columns) - set(schema.fieldNames()))
    if extra:
        raise ValueError(f"batch has columns the table does not know: {extra}")
    empty = df.sparkSession.createDataFrame([], schema)
    fitted = concat_tables(empty, df).select(
        *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields]
    )
    fitted.write.mode("append").parquet(path)


def read_id_list(spark: SparkSession, path: str, name: str = "id") -> DataFrame:
    """One identifier per line, stripped, blank lines skipped."""
    lines = spark.read.text(path).select(strip("value").alias(name))
    return lines.filter(F.col(name) != "")


def write_id_list(df: DataFrame, key: str, path: str, mode: str = "append") -> None:
    df.select(F.col(key).cast("string").alias("value")).write.mode(mode).text(path)


def read_if_present(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame | None:
    """The Parquet table at ``path``, or None if there is nothing yet.

    A folder of Parquet files may be half a table; ``materialize_once`` asks for
    the success marker too.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as err:
        if err.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def materialize_once(
    spark: SparkSession, build: Callable[[], DataFrame], path: str
) -> DataFrame:
    """The stored table if it was finished, else build it, store it and read it back.

    Finished is what has the success marker of its writer; files that a failed
    job left are written over.
    """
    if not is_finished(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def is_finished(spark: SparkSession, path: str) -> bool:
    """Does the table's folder have the marker that a committed write leaves?"""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)
