"""The streaming queries on tables that are folders, partitioned folders, single files or empty."""

import os

import pytest
from pyspark.sql import functions as F

from corpusflow.operators.routing import content_route, route_by_language
from workload import streams  # noqa: F401
from workload.registry import QUERIES

SF = os.environ.get("TWIN_SF_DIR", "/root/testdata/sf0.001")
DOCS = "doc_id long, text string, lang string"
TEXTS = [(1, "a red car", "en"), (2, "a car", "en"), (3, "ein Auto", "de"), (4, "x" * 6001, "de"), (5, "a", None), (6, "b", "en")]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def lay_out(df, path, layout):
    """Write a table as one file, as a folder of three, or as folders of a column."""
    if layout == "file":
        df.coalesce(1).write.parquet(f"{path}.parts")
        part = next(n for n in os.listdir(f"{path}.parts") if n.startswith("part-"))
        os.link(f"{path}.parts/{part}", path)
    elif layout == "folder":
        df.repartition(3).write.parquet(path)
    else:
        df.write.partitionBy(layout).parquet(path)


@pytest.mark.parametrize("layout", ["file", "folder", "lang"])
def test_routes_of_every_layout(spark, tmp_path, layout):
    docs = spark.createDataFrame(TEXTS, DOCS)
    lay_out(docs, f"{tmp_path}/documents.parquet", layout)
    # Another table of the folder, with partitions of its own.
    lay_out(spark.range(4).withColumn("day", F.col("id") % 2), f"{tmp_path}/events.parquet", "day")
    want = route_by_language(content_route(docs, "text", "text", ["red "]), "en", "lang")
    assert rows(QUERIES["stream_route"](spark, str(tmp_path))) == rows(want.select("doc_id", "route"))


@pytest.mark.parametrize("layout", ["file", "folder"])
def test_routes_of_no_documents(spark, tmp_path, layout):
    lay_out(spark.createDataFrame([], DOCS), f"{tmp_path}/documents.parquet", layout)
    routes = QUERIES["stream_route"](spark, str(tmp_path))
    assert routes.columns == ["doc_id", "route"] and routes.collect() == []


@pytest.mark.parametrize("name, table", [
    ("stream_admit", "events"), ("stream_admit_exact", "events"), ("resume_ingest", "orders"),
    ("stream_progress", "events"), ("stream_multires", "events"),
])
def test_streams_of_a_folder_equal_those_of_a_file(spark, tmp_path, name, table):
    lay_out(spark.read.parquet(f"{SF}/{table}.parquet"), f"{tmp_path}/{table}.parquet", "folder")
    got = rows(QUERIES[name](spark, str(tmp_path)))
    assert got and got == rows(QUERIES[name](spark, SF))
