"""Sources and sinks. What is written comes from the given tables and is read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.session import work_path
from corpusflow.sources import assets, items, tables
from workload.registry import query, table


@query("csv_round_trip", "SELECT doc_id, md5(text || '\"q\", \"' || source) AS digest, lang FROM documents")
def csv_round_trip(spark, sf):
    """Multi-line texts with quotes and commas survive the CSV sink and source."""
    messy = F.concat("text", F.lit('"q", "'), "source").alias("text")
    docs = table(spark, sf, "documents").select("doc_id", messy, "lang")
    path = work_path(spark, "csv")
    tables.write_table(docs, path, fmt="csv")
    back = tables.read_csv_table(spark, path, docs.schema)
    return back.select("doc_id", F.md5("text").alias("digest"), "lang")


@query("parquet_round_trip", "SELECT * FROM orders")
def parquet_round_trip(spark, sf):
    path = work_path(spark, "table")
    tables.write_table(table(spark, sf, "orders"), path)
    return spark.read.parquet(path)


@query(
    "append_batch",
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
       UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""",
)
def append_batch(spark, sf):
    schema = T.StructType.fromDDL("id long, name string, segment string")
    path = work_path(spark, "append")
    tables.append_batch(
        table(spark, sf, "customer").selectExpr("c_mktsegment AS segment", "c_custkey AS id", "c_name AS name"),
        path, schema,
    )
    tables.append_batch(table(spark, sf, "supplier").selectExpr("s_suppkey AS id", "s_name AS name"), path, schema)
    return spark.read.schema(schema).parquet(path)


@query("id_list", "SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS id FROM lineitem")
def id_list(spark, sf):
    path = work_path(spark, "ids")
    ids = table(spark, sf, "lineitem").select("l_partkey").distinct()
    tables.write_id_list(ids, "l_partkey", path)
    tables.write_id_list(ids.select(F.lit("  ").alias("l_partkey")), "l_partkey", path)
    return tables.read_id_list(spark, path)


@query("materialize_once", "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1")
def materialize_once(spark, sf):
    path = work_path(spark, "features")
    counts = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n"))
    tables.materialize_once(spark, lambda: counts, path)
    return tables.materialize_once(spark, lambda: counts.limit(0), path)


def _page(spark, sf):
    """One response page per part, in either layout."""
    k = F.col("p_partkey") % 4
    ident = F.when(k != 3, F.concat(F.lit("id"), F.col("p_partkey").cast("string")))
    nested = F.struct(F.array(F.struct(F.struct(F.col("p_brand").alias("name")).alias("profile"))).alias("items"))
    plain = F.array(F.struct(F.col("p_brand").alias("name")), F.struct(F.col("p_type").alias("name")))
    wrapped = F.to_json(F.struct(F.struct(F.array(F.struct(F.struct(
        ident.alias("id"), F.col("p_name").alias("name"), nested.alias("artists")).alias("data"))).alias("items")).alias("tracks")))
    flat = F.to_json(F.struct(F.array(F.struct(
        ident.alias("id"), F.col("p_name").alias("name"), plain.alias("artists"))).alias("tracks")))
    bare = F.to_json(F.struct(F.array(F.struct(ident.alias("id"))).alias("tracks")))
    page = F.when(k == 0, wrapped).when(k == 2, bare).otherwise(flat)
    return table(spark, sf, "part").select("p_partkey", page.alias("page"))


@query(
    "search_pages",
    """SELECT p_partkey, CAST(0 AS INTEGER) AS item_pos, 'id' || p_partkey AS "Spotify_ID",
              CASE WHEN p_partkey % 4 = 2 THEN 'Unknown' ELSE p_name END AS "Track_Name",
              CASE p_partkey % 4 WHEN 0 THEN p_brand WHEN 1 THEN p_brand || ', ' || p_type ELSE 'Unknown' END AS "Artist"
       FROM part WHERE p_partkey % 4 <> 3""",
)
def search_pages(spark, sf):
    return items.explode_search_pages(_page(spark, sf), "page")


@query(
    "flatten_items",
    """SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS "meta.source"
       FROM events WHERE event_id % 3 = 0
       UNION ALL SELECT event_id, NULL, event_type FROM events WHERE event_id % 3 = 1""",
)
def flatten_items(spark, sf):
    k = F.col("event_id") % 3
    nested = F.to_json(F.struct(F.struct(F.col("event_type").alias("source")).alias("meta")))
    raw = F.when(k == 0, F.col("props")).when(k == 1, nested).otherwise(F.lit("null"))
    schema = T.StructType.fromDDL("k long, meta struct<source: string>")
    return items.flatten_items(table(spark, sf, "events").select("event_id", raw.alias("raw")), "raw", schema)


# Folders that the assets of a query are spread over.
FOLDERS = 40


def _assets(spark, sf):
    """The payloads of ``pages`` as files, every seventh of them empty."""
    folder = work_path(spark, "assets")

    def write(rows):
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(folder)
        for row in rows:
            place = f"{root}/{row['page_id'] % FOLDERS}"
            system.create_dir(place, recursive=True)
            with system.open_output_stream(f"{place}/{row['page_id']}.html", compression=None) as out:
                out.write((row["html"] or "").encode() if row["page_id"] % 7 else b"")

    table(spark, sf, "pages").select("page_id", "html").foreachPartition(write)
    return assets.scan_assets(spark, folder, ".html", "id", nested=True)


_ASSETS_SQL = """SELECT CAST(page_id AS VARCHAR) AS id,
                        CAST(CASE WHEN page_id % 7 = 0 THEN 0 ELSE octet_length(encode(coalesce(html, ''))) END AS BIGINT) AS size FROM pages"""


@query("scan_assets", f"SELECT id, size FROM ({_ASSETS_SQL}) WHERE size > 0")
def scan_assets(spark, sf):
    """Files by name and size; empty ones are none."""
    return _assets(spark, sf).select("id", "size")


@query(
    "asset_summary",
    f"""SELECT count(*) FILTER (WHERE size > 0) AS files, round(coalesce(sum(size), 0) / 1048576.0::DOUBLE, 9) AS total_mb,
               count(*) FILTER (WHERE size = 0) AS empty FROM ({_ASSETS_SQL})""",
)
def asset_summary(spark, sf):
    """Files, megabytes and, against the table's ids, the empty ones."""
    names = table(spark, sf, "pages").select(F.col("page_id").cast("string").alias("id"))
    summary = assets.asset_summary(_assets(spark, sf), names, "id")
    return summary.withColumn("total_mb", F.round("total_mb", 9))
