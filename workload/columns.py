"""Scalar and array functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow import constants as K
from corpusflow.functions import arrays, columns, text
from corpusflow.operators import lines, quality
from corpusflow.operators.rows import apply_rows, format_people_text
from workload.registry import query, table


@query(
    "normalize_id",
    """SELECT c_custkey,
              CASE WHEN c_custkey % 4 IN (0, 3) THEN c_name END AS clean_id
       FROM customer""",
)
def normalize_id(spark, sf):
    k = F.col("c_custkey") % 4
    raw = (
        F.when(k == 0, F.concat(F.lit(" \t"), F.col("c_name"), F.lit("\n ")))
        .when(k == 1, F.lit(" NaN "))
        .when(k == 2, F.lit("  "))
        .otherwise(F.col("c_name"))
    )
    return table(spark, sf, "customer").select("c_custkey", columns.normalize_id(raw).alias("clean_id"))


@query(
    "missing_tokens",
    """SELECT doc_id, CASE WHEN doc_id % 5 = 4 OR doc_id % 5 = 3 THEN lang END AS lang,
              source FROM documents""",
)
def missing_tokens(spark, sf):
    k = F.col("doc_id") % 5
    lang = F.when(k == 0, "NA").when(k == 1, "null").when(k == 2, "").otherwise(F.col("lang"))
    docs = table(spark, sf, "documents").select("doc_id", lang.alias("lang"), "source")
    return quality.normalize_missing_tokens(docs)


@query(
    "select_and_rename",
    """SELECT p_partkey AS id, p_name AS "Track_Name", CAST(p_size AS BIGINT) AS "Popularity",
              p_retailprice AS energy FROM part""",
)
def select_and_rename(spark, sf):
    meta = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("kind"),
        F.col("p_size").cast("long").alias("popularity"),
        F.col("p_retailprice").alias("energy"),
    )
    return quality.select_and_rename(
        meta, keep=["id", "Track_Name", "Artist", "Popularity", *K.FEATURE_COLS]
    )


@query(
    "reorder_columns",
    """SELECT p_name AS "Track_Name", p_brand AS "Artist", p_size AS energy, p_partkey, p_type,
              'Track_Name,Artist,energy,p_partkey,p_type' AS layout FROM part""",
)
def reorder_columns(spark, sf):
    part = table(spark, sf, "part").select(
        "p_partkey",
        F.col("p_size").alias("energy"),
        F.col("p_brand").alias("Artist"),
        "p_type",
        F.col("p_name").alias("Track_Name"),
    )
    out = quality.reorder_columns(part)
    return out.withColumn("layout", F.lit(",".join(out.columns)))


@query(
    "coerce_numeric",
    """SELECT p_partkey,
              CASE WHEN p_partkey % 4 = 0 THEN CAST(CAST(p_retailprice AS FLOAT) AS DOUBLE)
                   WHEN p_partkey % 4 = 3 THEN CAST(CAST(p_size * 10 AS FLOAT) AS DOUBLE) END AS price,
              CASE WHEN p_partkey % 2 = 0 THEN p_size END AS size
       FROM part""",
)
def coerce_numeric(spark, sf):
    k = F.col("p_partkey") % 4
    size = F.col("p_size").cast("string")
    raw = table(spark, sf, "part").select(
        "p_partkey",
        F.when(k == 0, F.concat(F.lit(" "), F.col("p_retailprice").cast("string")))
        .when(k == 1, F.lit("1d"))
        .when(k == 2, F.lit("nan"))
        .otherwise(F.concat(size, F.lit("e1")))
        .alias("price"),
        F.when(k % 2 == 0, size).otherwise(F.concat(size, F.lit(" mm"))).alias("size"),
    )
    out = quality.coerce_numeric(raw, floats=["price", "absent"], ints=["size"])
    return out.withColumn("price", F.col("price").cast("double"))


@query(
    "format_people",
    """SELECT p_partkey,
              CASE p_partkey % 3 WHEN 0 THEN p_brand || ', ' || p_type WHEN 1 THEN p_type ELSE '' END
                AS names,
              CASE p_partkey % 3 WHEN 0 THEN p_brand ELSE p_type END AS nested FROM part""",
)
def format_people(spark, sf):
    k = F.col("p_partkey") % 3
    first = F.when(k == 0, F.concat(F.lit(" "), F.col("p_brand"))).when(k == 1, F.lit(""))
    second = F.when(k < 2, F.col("p_type"))
    person = F.struct(
        F.when(k == 0, F.col("p_brand")).alias("name"),
        F.struct(F.col("p_type").alias("name")).alias("profile"),
    )
    return table(spark, sf, "part").select(
        "p_partkey",
        columns.format_people(F.array(first, second)).alias("names"),
        columns.format_people(F.array(person), struct=True).alias("nested"),
    )


@query(
    "format_people_text",
    """SELECT p_partkey,
              CASE p_partkey % 4 WHEN 0 THEN p_brand || ', ' || p_type
                                 WHEN 1 THEN p_type || ', ' || p_brand
                                 WHEN 2 THEN p_name ELSE '' END AS names FROM part""",
)
def format_people_text_query(spark, sf):
    k = F.col("p_partkey") % 4
    raw = (
        F.when(k == 0, F.format_string("[{'name': '%s'}, {'name': '%s'}]", "p_brand", "p_type"))
        .when(k == 1, F.format_string("['%s', None, {'profile': {'name': '%s'}}]", "p_type", "p_brand"))
        .when(k == 2, F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")))
        .otherwise(F.lit("[None]"))
    )
    return table(spark, sf, "part").select("p_partkey", format_people_text(raw).alias("names"))


@query(
    "match_key",
    """SELECT lower(p_name) AS name_key, count(DISTINCT p_name || (p_partkey % 2)) AS spellings,
              count(*) AS n FROM part GROUP BY 1""",
)
def match_key(spark, sf):
    odd = F.col("p_partkey") % 2 == 1
    raw = F.when(odd, F.concat(F.lit(" "), F.upper("p_name"), F.lit("\t"))).otherwise(F.col("p_name"))
    rows = table(spark, sf, "part").select(raw.alias("raw"), columns.match_key(raw).alias("name_key"))
    return rows.groupBy("name_key").agg(
        F.countDistinct("raw").alias("spellings"), F.count("*").alias("n")
    )


@query(
    "first_present",
    "SELECT p_partkey, p_name AS title, 'Unknown' AS people FROM part",
)
def first_present(spark, sf):
    part = table(spark, sf, "part").withColumnRenamed("p_name", "Track_Name")
    return part.select(
        "p_partkey",
        quality.first_present(part, ["name", "Track_Name"]).alias("title"),
        quality.first_present(part, ["artists", "Artist"], K.UNKNOWN).alias("people"),
    )


@query(
    "valid_url",
    """SELECT page_id, CASE WHEN page_id % 4 IN (0, 1) THEN '' ELSE url END
              AS url FROM pages""",
)
def valid_url(spark, sf):
    k = F.col("page_id") % 4
    raw = (
        F.when(k == 0, F.concat(F.lit("ftp:"), F.col("url")))
        .when(k == 1, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("\n "), F.col("url"), F.lit(" ")))
    )
    return table(spark, sf, "pages").select("page_id", columns.valid_url(raw).alias("url"))


@query(
    "join_lines",
    r"""SELECT conv_id,
               string_agg(regexp_replace(text, '^\s+|\s+$', '', 'g'), chr(10) ORDER BY turn)
                 FILTER (WHERE regexp_replace(text, '^\s+|\s+$', '', 'g') <> '') AS text
        FROM conversations GROUP BY conv_id""",
)
def join_lines(spark, sf):
    return lines.join_lines(table(spark, sf, "conversations"), "conv_id", "turn", "text")


@query(
    "join_lines_parts",
    r"""WITH p AS (SELECT conv_id, turn, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) // 2 AS part,
                          regexp_replace(text, '^\s+|\s+$', '', 'g') AS line FROM conversations)
        SELECT conv_id, part, coalesce(string_agg(line, chr(10) ORDER BY turn) FILTER (line <> ''), 'No Lyrics') AS text
        FROM p GROUP BY 1, 2""",
)
def join_lines_parts(spark, sf):
    """Parts of two lines by rank; the line numbers themselves have wide gaps."""
    turns = table(spark, sf, "conversations").withColumn("turn", F.col("turn").cast("long") * 1_000_003)
    return lines.join_lines(turns, "conv_id", "turn", "text", lines_per_part=2)


@query(
    "clean_lines",
    r"""SELECT doc_id, md5(array_to_string(list_filter(list_transform(string_split(text, chr(10)),
               lambda l: regexp_replace(l, '^\s+|\s+$', '', 'g')), lambda l: l <> ''), chr(10))) AS digest
        FROM documents""",
)
def clean_lines(spark, sf):
    split = F.split("text", "\n")
    return table(spark, sf, "documents").select("doc_id", F.md5(text.clean_lines(split)).alias("digest"))


@query(
    "fill_sentinel",
    """SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'No Lyrics' ELSE md5(d.text) END AS digest
       FROM documents d LEFT JOIN labels l USING (doc_id)""",
)
def fill_sentinel(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", F.lit(True).alias("known"))
    docs = table(spark, sf, "documents").select("doc_id", F.md5("text").alias("digest"))
    joined = docs.join(labels, "doc_id", "left")
    return joined.select("doc_id", columns.fill_sentinel(F.when(F.col("known"), F.col("digest"))).alias("digest"))


@query(
    "quadrant",
    """SELECT doc_id, quality * 2 + toxic AS quadrant,
              CASE quality * 2 + toxic WHEN 0 THEN 'Buồn - Êm dịu (Low V, Low E)'
                                       WHEN 1 THEN 'Căng - Sôi động (Low V, High E)'
                                       WHEN 2 THEN 'Vui - Êm dịu (High V, Low E)'
                                       ELSE 'Vui - Sôi động (High V, High E)' END AS name
       FROM labels""",
)
def quadrant(spark, sf):
    q = columns.quadrant("quality", "toxic")
    return table(spark, sf, "labels").select(
        "doc_id", q.alias("quadrant"), columns.quadrant_name(q).alias("name")
    )


@query(
    "smooth_target",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
              round(l_quantity / 50 * 0.95 + 0.025, 9) AS target FROM lineitem""",
)
def smooth_target(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.round(columns.smooth_target(F.col("l_quantity") / 50), 9).alias("target"),
    )


def _points(df, key, arr):
    """One row per array element, so that every element is compared."""
    return df.select(key, F.posexplode(arr).alias("pos", "x")).select(
        key, "pos", F.round("x", 5).alias("x")
    )


@query(
    "pad_or_truncate",
    """SELECT vec_id, CAST(i AS INTEGER) AS pos,
              round(CAST(CASE WHEN i < 64 THEN embedding[i + 1] ELSE 0 END AS DOUBLE), 5) AS x
       FROM embeddings, range(80) r(i)
       UNION ALL
       SELECT vec_id + 1000000, CAST(i AS INTEGER), round(CAST(embedding[i + 1] AS DOUBLE), 5)
       FROM embeddings, range(10) r(i)""",
)
def pad_or_truncate(spark, sf):
    vectors = table(spark, sf, "embeddings")
    zero = F.lit(0.0).cast("float")
    padded = vectors.select("vec_id", arrays.pad_or_truncate("embedding", 80, zero).alias("a"))
    cut = vectors.select(
        (F.col("vec_id") + 1000000).alias("vec_id"),
        arrays.pad_or_truncate("embedding", 10, zero).alias("a"),
    )
    both = padded.unionByName(cut)
    return _points(both, "vec_id", F.transform("a", lambda x: x.cast("double")))


@query(
    "resample_linear",
    """WITH p AS (SELECT vec_id, embedding, CAST(i AS INTEGER) AS pos, i * CAST(63 AS DOUBLE) / 99 AS t0
                  FROM embeddings, range(100) r(i)),
            q AS (SELECT *, least(CAST(floor(t0) AS INTEGER), 63) AS lo FROM p)
       SELECT vec_id, pos,
              round(CAST(embedding[lo + 1] AS DOUBLE)
                    + (CAST(embedding[least(lo + 1, 63) + 1] AS DOUBLE) - CAST(embedding[lo + 1] AS DOUBLE))
                      * (t0 - lo), 5) AS x FROM q""",
)
def resample_linear(spark, sf):
    return _points(table(spark, sf, "embeddings"), "vec_id", arrays.resample_linear("embedding", 100))


@query(
    "minmax_scale",
    """SELECT vec_id, CAST(i AS INTEGER) AS pos,
              round((CAST(embedding[i + 1] AS DOUBLE) - list_min(embedding))
                    / (CAST(list_max(embedding) AS DOUBLE) - CAST(list_min(embedding) AS DOUBLE) + 1e-6), 5) AS x
       FROM embeddings, range(64) r(i)""",
)
def minmax_scale(spark, sf):
    return _points(table(spark, sf, "embeddings"), "vec_id", arrays.minmax_scale("embedding"))


@query(
    "power_to_db",
    """WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)) AS a
                  FROM embeddings)
       SELECT vec_id, CAST(i AS INTEGER) AS pos,
              round(greatest(10 * log10(greatest(a[i + 1], 1e-10)) - 10 * log10(greatest(list_max(a), 1e-10)),
                             -80), 5) AS x
       FROM e, range(64) r(i)""",
)
def power_to_db(spark, sf):
    power = F.transform("embedding", lambda x: x.cast("double") * x.cast("double"))
    return _points(table(spark, sf, "embeddings"), "vec_id", arrays.power_to_db(power))


@query(
    "seeded_uniform",
    """SELECT doc_id, CAST('0x' || substr(md5('42:' || doc_id), 1, 12) AS BIGINT) / 281474976710656.0::DOUBLE
              AS u FROM documents""",
)
def seeded_uniform(spark, sf):
    return table(spark, sf, "documents").select("doc_id", columns.seeded_uniform("doc_id").alias("u"))


@query(
    "apply_rows",
    "SELECT doc_id, length(text) AS n_chars, length(text) - length(replace(text, ' ', '')) AS blanks FROM documents",
)
def apply_rows_query(spark, sf):
    def measure(pdf):
        return pdf.assign(
            n_chars=pdf["text"].str.len(), blanks=pdf["text"].str.count(" ")
        )[["doc_id", "n_chars", "blanks"]]

    docs = table(spark, sf, "documents").select("doc_id", "text")
    return apply_rows(docs, measure, "doc_id long, n_chars long, blanks long")
