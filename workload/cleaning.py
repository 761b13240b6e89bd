"""Filters, joins, deduplication and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow import constants as K
from corpusflow.functions import text
from corpusflow.operators import dedup, joins, quality
from workload.registry import documents, query, table

LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]
_LINE_ORDER_SQL = ", ".join(LINE_ORDER)
KEYWORDS = ["red ", " ring", "blue widget", "(x)"]


@query("scan_columns", "SELECT event_id, event_type FROM events")
def scan_columns(spark, sf):
    return quality.scan_columns(table(spark, sf, "events"), ["event_id", "event_type"])


@query(
    "drop_invalid",
    "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name FROM customer WHERE c_custkey % 7 NOT IN (0, 1, 2)",
)
def drop_invalid(spark, sf):
    k = F.col("c_custkey") % 7
    rows = table(spark, sf, "customer").select(
        F.when(k == 0, "nan").when(k == 1, " \t").otherwise(F.col("c_custkey").cast("string")).alias("id"),
        F.when(k != 2, F.col("c_name")).alias("c_name"),
    )
    return quality.drop_invalid(rows, ["c_name"], "id")


@query(
    "has_text",
    "SELECT doc_id, doc_id % 4 = 3 AND length(trim(text)) > 0 AS readable FROM documents",
)
def has_text(spark, sf):
    k = F.col("doc_id") % 4
    raw = (
        F.when(k == 0, F.lit(None).cast("string"))
        .when(k == 1, F.lit(" No Lyrics\n"))
        .when(k == 2, F.lit(" \n"))
        .otherwise(F.col("text"))
    )
    return table(spark, sf, "documents").select("doc_id", text.has_text(raw).alias("readable"))


_ANY_KEYWORD = "({})".format(
    " OR ".join(f"contains(lower(trim({{0}})), '{k}')" for k in K.COMPILATION_KEYWORDS)
)


@query(
    "title_matches",
    f"""SELECT p_partkey,
               contains(p_name, 'red ') OR contains(p_name, ' ring') OR contains(p_name, 'blue widget') AS hit
        FROM part""",
)
def title_matches(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", text.title_matches(F.upper("p_name"), KEYWORDS).alias("hit")
    )


@query(
    "title_matches_text",
    f"""SELECT doc_id, {_ANY_KEYWORD.format("text")} AS hit,
               {_ANY_KEYWORD.format("text || ' Best  Of'")} AS spaced,
               {_ANY_KEYWORD.format("'The Best OF ' || text")} AS titled FROM documents""",
)
def title_matches_text(spark, sf):
    return documents(spark, sf).select(
        "doc_id",
        text.title_matches("text").alias("hit"),
        text.title_matches(F.concat("text", F.lit(" Best  Of"))).alias("spaced"),
        text.title_matches(F.concat(F.lit("The Best OF "), "text")).alias("titled"),
    )


_BRACKETED = r"""CASE WHEN doc_id % 2 = 1 THEN ' 【' || replace(text, chr(10), ')' || chr(10) || '( ') || ']'
                      ELSE text END"""


def _bracketed():
    wrapped = F.concat(F.lit(" 【"), F.replace("text", F.lit("\n"), F.lit(")\n( ")), F.lit("]"))
    return F.when(F.col("doc_id") % 2 == 1, wrapped).otherwise(F.col("text"))


@query(
    "marker_lines",
    rf"""SELECT doc_id, CAST(len(list_filter(string_split({_BRACKETED}, chr(10)),
                lambda l: regexp_full_match(l, '[\s]*[(\[【].*[)\]】][\s]*'))) AS INTEGER) AS markers
        FROM documents""",
)
def marker_lines(spark, sf):
    return documents(spark, sf).select("doc_id", text.marker_lines(_bracketed()).alias("markers"))


@query(
    "too_long",
    r"SELECT doc_id, length(regexp_replace(text, '^\s+|\s+$', '', 'g')) > 6000 AS long FROM documents",
)
def too_long(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.too_long("text").alias("long"))


@query(
    "compilation_reason",
    rf"""SELECT d.doc_id, CASE WHEN contains(p_name, 'red ') OR contains(p_name, ' ring')
                                 OR contains(p_name, 'blue widget') THEN 'title'
                WHEN len(list_filter(string_split({_BRACKETED}, chr(10)),
                     lambda l: regexp_full_match(l, '[\s]*[(\[【].*[)\]】][\s]*'))) >= 3 THEN 'markers'
                WHEN length(regexp_replace({_BRACKETED}, '^\s+|\s+$', '', 'g')) > 6000 THEN 'length' END AS reason
        FROM documents d LEFT JOIN part ON p_partkey = d.doc_id""",
)
def compilation_reason(spark, sf):
    titles = table(spark, sf, "part").select(F.col("p_partkey").alias("doc_id"), "p_name")
    docs = documents(spark, sf).join(titles, "doc_id", "left")
    reason = text.compilation_reason("p_name", _bracketed(), KEYWORDS)
    return docs.select("doc_id", reason.alias("reason"))


def _labelled(spark, sf):
    docs = documents(spark, sf).select("doc_id", "lang")
    return docs.join(table(spark, sf, "labels"), "doc_id", "left")


@query(
    "split_complete",
    """SELECT d.doc_id, l.doc_id IS NOT NULL AS complete
       FROM documents d LEFT JOIN labels l USING (doc_id)""",
)
def split_complete(spark, sf):
    valid, invalid = quality.split_complete(_labelled(spark, sf))
    return (
        valid.select("doc_id", F.lit(True).alias("complete"))
        .unionByName(invalid.select("doc_id", F.lit(False).alias("complete")))
    )


@query(
    "eligible_tasks",
    """SELECT CAST(page_id AS VARCHAR) AS track_id, 'Unknown' AS track_name, url FROM pages
       WHERE page_id % 3 <> 0""",
)
def eligible_tasks(spark, sf):
    pages = table(spark, sf, "pages").select(
        "page_id", F.when(F.col("page_id") % 3 != 0, F.col("url")).alias("url")
    )
    return quality.eligible_tasks(pages, "page_id", "title", "url")


@query(
    "enrich_left",
    """SELECT o_orderkey, o_orderstatus, l_linenumber, l_partkey, l_quantity
       FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""",
)
def enrich_left(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    items = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_linestatus").alias("o_orderstatus"),  # clashes: the left one stays
        "l_linenumber",
        "l_partkey",
        "l_quantity",
    )
    return joins.enrich_left(orders, items, "o_orderkey")


@query(
    "merge_inner",
    "SELECT doc_id, lang, source, quality, toxic FROM documents JOIN labels USING (doc_id)",
)
def merge_inner(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source")
    return joins.merge_inner(docs, table(spark, sf, "labels"), "doc_id")


@query(
    "reconcile",
    """WITH o AS (SELECT DISTINCT o_orderkey AS k FROM orders), l AS (SELECT DISTINCT l_partkey AS k FROM lineitem)
       SELECT count(*) FILTER (WHERE o.k IS NOT NULL AND l.k IS NOT NULL) AS matched,
              count(*) FILTER (WHERE l.k IS NULL) AS only_left,
              count(*) FILTER (WHERE o.k IS NULL) AS only_right
       FROM o FULL JOIN l ON o.k = l.k""",
)
def reconcile(spark, sf):
    left = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"))
    right = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("k"))
    return joins.reconcile(left, right, "k")


@query(
    "pending",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
)
def pending(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    done = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.pending(orders, done, "o_orderkey")


@query(
    "synced",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)",
)
def synced(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    done = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.synced(orders, done, "o_orderkey")


@query(
    "complete_from_request",
    """SELECT doc_id, quality, coalesce(status, 'No Lyrics') AS status
       FROM documents LEFT JOIN (SELECT doc_id, quality, 'delivered' AS status FROM labels) USING (doc_id)""",
)
def complete_from_request(spark, sf):
    got = table(spark, sf, "labels").select("doc_id", "quality", F.lit("delivered").alias("status"))
    return joins.complete_from_request(table(spark, sf, "documents"), got, "doc_id", {"status": K.NO_TEXT})


@query(
    "attach_title",
    """SELECT doc_id, source, p_name AS "Track_Name" FROM documents LEFT JOIN part ON p_partkey = doc_id""",
)
def attach_title(spark, sf):
    titles = table(spark, sf, "part").select(
        F.col("p_partkey").alias("doc_id"), F.col("p_name").alias("Track_Name")
    )
    docs = table(spark, sf, "documents").select("doc_id", "source")
    return joins.attach_title(docs, titles, "doc_id")


def document_assets(spark, sf):
    """Assets by source number: several extensions for some documents, none for others."""
    number = F.substring("source", 4, 2).cast("int")
    exts = F.filter(
        F.array(
            F.when(number % 2 == 0, ".ogg"),
            F.when(number % 3 == 0, ".mp3"),
            F.when(number % 5 == 0, ".flac"),
            F.when(number == 7, ".txt"),
        ),
        lambda x: x.isNotNull(),
    )
    rows = table(spark, sf, "documents").select("doc_id", F.explode(exts).alias("ext"))
    return rows.withColumn("path", F.concat(F.lit("/a/"), F.col("doc_id").cast("string"), F.col("ext")))


EXT_SQL = """CASE WHEN CAST(substr(source, 4) AS INTEGER) % 3 = 0 THEN '.mp3'
                  WHEN CAST(substr(source, 4) AS INTEGER) % 2 = 0 THEN '.ogg'
                  WHEN CAST(substr(source, 4) AS INTEGER) % 5 = 0 THEN '.flac' END"""


@query(
    "preferred_asset",
    f"""SELECT * FROM (SELECT doc_id, lang, {EXT_SQL} AS ext, '/a/' || doc_id || {EXT_SQL} AS path
                       FROM documents) WHERE ext IS NOT NULL""",
)
def preferred_asset(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return joins.attach_preferred_asset(docs, document_assets(spark, sf), "doc_id")


@query(
    "asset_losses",
    f"""SELECT count(*) FILTER (ext IS NOT NULL) AS with_asset, count(*) FILTER (ext IS NULL) AS without_asset
        FROM (SELECT {EXT_SQL} AS ext FROM documents)""",
)
def asset_losses(spark, sf):
    return joins.asset_losses(table(spark, sf, "documents").select("doc_id"), document_assets(spark, sf), "doc_id")


@query(
    "dedup_first",
    f"""SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, l_quantity FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY {_LINE_ORDER_SQL}) = 1""",
)
def dedup_first(spark, sf):
    first = dedup.dedup_first(table(spark, sf, "lineitem"), ["l_partkey"], LINE_ORDER)
    return first.select("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")


@query(
    "dedup_match_key",
    """SELECT min(p_partkey) AS p_partkey, count(*) AS one FROM
         (SELECT lower(p_name) AS n, lower(p_brand) AS b, min(p_partkey) AS p_partkey FROM part GROUP BY 1, 2)
       GROUP BY n, b""",
)
def dedup_match_key(spark, sf):
    odd = F.col("p_partkey") % 2 == 1
    name = F.when(odd, F.concat(F.upper("p_name"), F.lit(" "))).otherwise(F.col("p_name"))
    part = table(spark, sf, "part").withColumn("p_name", name)
    kept = dedup.dedup_by_match_key(part, ["p_name", "p_brand"], ["p_partkey"])
    return kept.select("p_partkey", F.lit(1).cast("long").alias("one"))


@query(
    "admit_new",
    """WITH first AS (SELECT user_id, min(event_id) AS event_id FROM events GROUP BY 1),
            fresh AS (SELECT * FROM first WHERE user_id NOT IN (SELECT n_nationkey FROM nation))
       SELECT event_id, user_id FROM fresh ORDER BY event_id LIMIT 75""",
)
def admit_new(spark, sf):
    seen = table(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("user_id"))
    batch = table(spark, sf, "events").select("event_id", "user_id")
    return dedup.admit_new(batch, seen, "user_id", ["event_id"], target=100)


@query(
    "distinct_ids",
    "SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS id FROM lineitem WHERE l_linenumber <> 7 AND l_orderkey % 11 <> 0 AND l_orderkey % 13 <> 0",
)
def distinct_ids(spark, sf):
    """Identifiers as texts with blanks and tabs around them; some are blank, ``nan`` or missing."""
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    padded = F.concat(F.repeat(F.lit(" "), n % 3), F.col("l_suppkey").cast("string"), F.repeat(F.lit("\t"), n % 2))
    bare = F.when(n == 7, F.lit(" NaN ")).when(k % 11 == 0, F.lit("  ")).when(k % 13 != 0, padded)
    return dedup.distinct_ids(table(spark, sf, "lineitem").select(bare.alias("id")), "id")


@query("cap", "SELECT event_id, ts, user_id FROM events ORDER BY ts, event_id LIMIT 500")
def cap(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", "user_id")
    return dedup.cap(events, 500, ["ts", "event_id"])


@query("sorted_counts", "SELECT l_shipdate, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY 1")
def sorted_counts(spark, sf):
    return dedup.sorted_counts(table(spark, sf, "lineitem"), "l_shipdate")


@query(
    "concat_tables",
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
       UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier
       UNION ALL SELECT item_id, NULL, NULL FROM benchmark""",
)
def concat_tables(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    items = table(spark, sf, "benchmark").select(F.col("item_id").alias("id"))
    return dedup.concat_tables(customers, suppliers, items)


@query(
    "id_difference",
    "SELECT l_orderkey AS k FROM lineitem EXCEPT SELECT doc_id FROM documents",
)
def id_difference(spark, sf):
    orders = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"))
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("k"))
    return dedup.id_difference(orders, docs, "k")
