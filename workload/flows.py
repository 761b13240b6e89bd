"""The whole flows, from tables to training set and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.operators.language import fit_language_profiles
from corpusflow.operators.vocab import stored_vocab
from corpusflow.plans import catalog, training
from workload.cleaning import EXT_SQL, KEYWORDS, LINE_ORDER, document_assets
from workload.profiles import _NAMES, _rounded, _sql, MEASURES, PREDICTIONS, predictions
from workload.registry import dealt, documents, query, table
from workload.samples import u48
from workload.texts import WINDOWS, language_sql, vocab_sql


@query(
    "curate_catalog",
    f"""WITH f AS (SELECT * FROM lineitem QUALIFY row_number() OVER
                     (PARTITION BY l_partkey ORDER BY {", ".join(LINE_ORDER)}) = 1)
        SELECT CAST(p_partkey AS VARCHAR) AS "Spotify_ID",
               CASE WHEN p_partkey % 2 = 1 THEN upper(p_name) ELSE p_name END AS "Track_Name",
               p_brand AS "Artist", CAST(CAST(p_size AS FLOAT) AS DOUBLE) AS "Popularity",
               CAST(CAST(p_retailprice AS FLOAT) AS DOUBLE) AS "Duration_MS",
               l_discount * 10 AS energy, l_quantity / 50 AS valence
        FROM (SELECT * FROM part QUALIFY row_number() OVER (PARTITION BY lower(p_name), lower(p_brand) ORDER BY p_partkey) = 1)
        LEFT JOIN f ON p_partkey = l_partkey""",
)
def curate_catalog(spark, sf):
    odd = F.col("p_partkey") % 2 == 1
    meta = table(spark, sf, "part").select(
        F.concat(F.lit(" "), F.col("p_partkey").cast("string")).alias("id"),
        F.when(odd, F.upper("p_name")).otherwise(F.col("p_name")).alias("name"),
        F.array(F.struct(F.col("p_brand").alias("name"), F.struct(F.lit("-").alias("name")).alias("profile"))).alias("artists"),
        F.col("p_size").cast("string").alias("popularity"),
        F.col("p_retailprice").alias("duration_ms"),
        F.col("p_partkey").alias("seq"),
    )
    features = dealt(table(spark, sf, "lineitem")).select(
        F.col("l_partkey").cast("string").alias("Spotify_ID"),
        (F.col("l_discount") * 10).alias("energy"),
        (F.col("l_quantity") / 50).alias("valence"),
        F.lit(1.0).alias("duration_ms"),
        *LINE_ORDER,
    )
    out = catalog.curate_catalog(meta, features, ["seq"], LINE_ORDER)
    return out.withColumns({c: F.col(c).cast("double") for c in ("Popularity", "Duration_MS")})


@query(
    "filter_texts",
    rf"""WITH {language_sql("documents", "doc_id")}
         SELECT CAST(doc_id AS VARCHAR) AS id,
                CASE WHEN hit OR len > 6000 THEN 'compilation' WHEN coalesce(language, '') = 'fr' THEN 'kept' ELSE 'foreign' END AS route,
                CASE WHEN hit THEN 'title' WHEN len > 6000 THEN 'length'
                     WHEN coalesce(language, '') <> 'fr' THEN 'language ' || coalesce(language, 'unknown') END AS reason
         FROM (SELECT doc_id, length(regexp_replace(text, '^\s+|\s+$', '', 'g')) AS len,
                      p_name LIKE '%red %' OR p_name LIKE '% ring%' OR p_name LIKE '%blue widget%' AS hit
               FROM documents LEFT JOIN part ON p_partkey = doc_id) d LEFT JOIN best ON k = doc_id""",
)
def filter_texts(spark, sf):
    docs = documents(spark, sf)
    texts = docs.select(F.col("doc_id").cast("string").alias("Spotify_ID"), F.col("text").alias("Lyrics"))
    titles = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("Spotify_ID"), F.col("p_name").alias("Track_Name")
    )
    profiles = fit_language_profiles(docs, "text", "lang")
    routed = catalog.filter_texts(texts, titles, profiles, "fr", KEYWORDS)
    return routed.select(F.col("Spotify_ID").alias("id"), "route", "reason")


def _master_inputs(spark, sf):
    meta = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("Spotify_ID"),
        F.col("p_name").alias("Track_Name"),
        F.col("p_brand").alias("Artist"),
        F.col("p_size").cast("string").alias("Popularity"),
        F.lit(None).cast("string").alias("Release_Date"),
        F.when(F.col("p_partkey") % 3 == 0, "n/a").otherwise(F.lit("0.25")).alias("energy"),
        F.lit(" 4 ").alias("key"),
        F.col("p_partkey").alias("seq"),
    )
    texts = documents(spark, sf).select(
        F.concat(F.col("doc_id").cast("string"), F.lit(" ")).alias("Spotify_ID"),
        F.when(F.col("doc_id") % 10 == 9, "No Lyrics").otherwise(F.col("text")).alias("Lyrics"),
        F.col("doc_id").alias("line"),
    )
    return meta, texts


@query(
    "build_master",
    """SELECT CAST(p_partkey AS VARCHAR) AS "Spotify_ID", p_name AS "Track_Name", p_brand AS "Artist", md5(text) AS digest,
              CAST(p_size AS DOUBLE) AS "Popularity", CASE WHEN p_partkey % 3 <> 0 THEN CAST(0.25 AS DOUBLE) END AS energy,
              CAST(4 AS INTEGER) AS "key", p_partkey AS seq,
              'Spotify_ID,Track_Name,Artist,Lyrics,Popularity,energy,key,seq' AS layout
       FROM part JOIN documents ON doc_id = p_partkey WHERE doc_id % 10 <> 9
       QUALIFY row_number() OVER (PARTITION BY lower(p_name), lower(p_brand) ORDER BY p_partkey) = 1""",
)
def build_master(spark, sf):
    meta, texts = _master_inputs(spark, sf)
    master = catalog.build_master(meta, texts, ["seq"], ["line"]).table
    layout = ",".join(master.columns)
    out = master.withColumn("digest", F.md5("Lyrics")).drop("Lyrics").withColumn("layout", F.lit(layout))
    return out.withColumns({c: F.col(c).cast("double") for c in ("Popularity", "energy")})


@query(
    "build_master_reconciliation",
    """SELECT (SELECT count(*) FROM part JOIN documents ON doc_id = p_partkey) AS matched,
              (SELECT count(*) FROM part WHERE p_partkey NOT IN (SELECT doc_id FROM documents)) AS only_left,
              (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT p_partkey FROM part)) AS only_right""",
)
def build_master_reconciliation(spark, sf):
    meta, texts = _master_inputs(spark, sf)
    return catalog.build_master(meta, texts, ["seq"], ["line"]).reconciliation


def _fetch(spark, sf):
    pages = table(spark, sf, "pages").select(
        F.col("page_id").cast("string").alias("Spotify_ID"),
        F.when(F.col("page_id") % 3 != 0, F.col("url")).alias("Preview_Audio_URL"),
    )
    done = table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("Spotify_ID"))
    return catalog.plan_fetch(pages, done)


@query(
    "plan_fetch",
    """SELECT CAST(page_id AS VARCHAR) AS track_id, 'Unknown' AS track_name, url FROM pages
       WHERE page_id % 3 <> 0 AND page_id NOT IN (SELECT doc_id FROM labels)""",
)
def plan_fetch(spark, sf):
    return _fetch(spark, sf).tasks


@query(
    "plan_fetch_counts",
    """WITH p AS (SELECT page_id % 3 = 0 AS bad, page_id IN (SELECT doc_id FROM labels) AS done FROM pages)
       SELECT count(*) AS total, count(*) FILTER (WHERE done) AS skipped,
              count(*) FILTER (WHERE NOT done AND bad) AS no_url,
              count(*) FILTER (WHERE NOT done AND NOT bad) AS tasks FROM p""",
)
def plan_fetch_counts(spark, sf):
    return _fetch(spark, sf).counts


def _ready(spark, sf):
    labels = table(spark, sf, "labels").withColumnsRenamed({"quality": "valence", "toxic": "energy"})
    master = (
        table(spark, sf, "documents")
        .select("doc_id", F.col("source").alias("Artist"), F.lit(None).cast("string").alias("Preview_Audio_URL"))
        .join(labels, "doc_id", "left")
        .withColumn("Spotify_ID", F.col("doc_id").cast("string"))
    )
    return catalog.train_ready(master, document_assets(spark, sf).withColumnRenamed("doc_id", "Spotify_ID"))


@query(
    "train_ready",
    """SELECT CAST(d.doc_id AS VARCHAR) AS id,
              CASE WHEN NOT (n % 2 = 0 OR n % 3 = 0 OR n % 5 = 0 OR n = 7) THEN 'missing'
                   WHEN l.doc_id IS NULL THEN 'quarantine' ELSE 'ready' END AS state
       FROM (SELECT doc_id, CAST(substr(source, 4) AS INTEGER) AS n FROM documents) d LEFT JOIN labels l USING (doc_id)""",
)
def train_ready(spark, sf):
    result = _ready(spark, sf)
    states = [(result.ready, "ready"), (result.missing, "missing"), (result.quarantine, "quarantine")]
    parts = [df.select(F.col("Spotify_ID").alias("id"), F.lit(s).alias("state")) for df, s in states]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "train_ready_nulls",
    """WITH s AS (SELECT l.doc_id IS NULL AS gap FROM
                    (SELECT doc_id, CAST(substr(source, 4) AS INTEGER) AS n FROM documents) d
                  LEFT JOIN labels l USING (doc_id) WHERE n % 2 = 0 OR n % 3 = 0 OR n % 5 = 0 OR n = 7)
       SELECT c AS "column", CASE WHEN c IN ('valence', 'energy') THEN (SELECT count(*) FROM s WHERE gap) ELSE 0 END AS nulls
       FROM (VALUES ('doc_id'), ('Artist'), ('valence'), ('energy'), ('Spotify_ID')) v(c)""",
)
def train_ready_nulls(spark, sf):
    return _ready(spark, sf).nulls


@query(
    "balance_report",
    """WITH c AS (SELECT CAST(q AS INTEGER) AS quadrant, count(toxic) AS n FROM range(4) r(q)
                  LEFT JOIN labels ON quality * 2 + toxic = q GROUP BY 1),
            t AS (SELECT max(n) AS hi, sum(n) AS total, min(n) FILTER (WHERE n > 0) AS lo FROM c)
       SELECT quadrant, n, round(CAST(n AS DOUBLE) / total * 100, 9) AS pct,
              CAST(floor(CAST(n AS DOUBLE) / hi * 20) AS INTEGER) AS bar_length,
              CAST(hi AS DOUBLE) / total > 0.4 OR CAST(lo AS DOUBLE) / total < 0.1 AS imbalanced
       FROM c, t""",
)
def balance_report(spark, sf):
    labels = table(spark, sf, "labels").select(
        F.col("quality").cast("string").alias("valence"), F.col("toxic").cast("string").alias("energy")
    )
    report = catalog.balance_report(labels).report
    return report.select("quadrant", "n", F.round("pct", 9).alias("pct"), "bar_length", "imbalanced")


_READY = f"""ready AS (SELECT d.doc_id, text, quality, toxic, {EXT_SQL} AS ext
                       FROM documents d JOIN labels l USING (doc_id))"""


@query(
    "prepare_training",
    f"""WITH {_READY}, {vocab_sql(source="ready")}, {WINDOWS},
        sm AS (SELECT doc_id, '/a/' || doc_id || ext AS path, quality, toxic, quality * 2 + toxic AS quadrant
               FROM ready WHERE ext IS NOT NULL),
        c AS (SELECT quadrant, count(*) AS n FROM sm GROUP BY 1),
        f AS (SELECT doc_id, CAST((row_number() OVER (ORDER BY quadrant, {u48("'42:' || doc_id")}, doc_id) - 1) % 5 AS INTEGER) AS fold FROM sm)
        SELECT doc_id, part, path, quadrant, CAST(quality AS DOUBLE) AS v, CAST(toxic AS DOUBLE) AS e, ids, tones,
               round((SELECT count(*) FROM sm)::DOUBLE / (4 * n), 9) AS weight, fold
        FROM sm JOIN c USING (quadrant) JOIN f USING (doc_id) JOIN windows USING (doc_id)""",
)
def prepare_training(spark, sf):
    """All windows of all texts, with the weights and folds of their texts."""
    labels = table(spark, sf, "labels")
    ready = documents(spark, sf).select("doc_id", "text").join(labels, "doc_id")
    made = training.prepare_training(
        ready, document_assets(spark, sf), key="doc_id", text="text", v="quality", e="toxic"
    ).samples
    return made.select(
        "doc_id", "part", "path", "quadrant", "fold",
        F.get("labels", F.lit(0)).cast("double").alias("v"),
        F.get("labels", F.lit(1)).cast("double").alias("e"),
        F.round("weight", 9).alias("weight"),
        *[F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c) for c in ("ids", "tones")],
    )


@query(
    "assemble_samples",
    f"""WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: 10 * log10(greatest(CAST(x AS DOUBLE) * CAST(x AS DOUBLE), 1e-10))) AS a
                   FROM embeddings JOIN documents ON doc_id = vec_id JOIN labels USING (doc_id) WHERE {EXT_SQL} IS NOT NULL),
        m AS (SELECT vec_id, a, list_max(a) AS top FROM e),
        p AS (SELECT vec_id, a, top, CAST(i AS INTEGER) AS pos, i * CAST(63 AS DOUBLE) / 127 AS t0 FROM m, range(128) r(i)),
        l AS (SELECT *, least(CAST(floor(t0) AS INTEGER), 63) AS lo FROM p),
        v AS (SELECT vec_id, pos, t0 - lo AS w, greatest(a[lo + 1] - top, -80) AS x0,
                     greatest(a[least(lo + 1, 63) + 1] - top, -80) AS x1 FROM l),
        q AS (SELECT vec_id, pos, x0 + (x1 - x0) * w AS y FROM v),
        b AS (SELECT vec_id, min(y) AS lo, max(y) AS hi FROM q GROUP BY 1)
        SELECT vec_id AS doc_id, pos, round((y - lo) / (hi - lo + 1e-6), 5) AS x FROM q JOIN b USING (vec_id)""",
)
def assemble_samples(spark, sf):
    """Feature arrays of the samples: decibels, resized to 128 points, scaled."""
    power = F.transform("embedding", lambda x: x.cast("double") * x.cast("double")).alias("power")
    series = table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), power)
    docs = table(spark, sf, "documents").select("doc_id", "text")
    ready = docs.join(table(spark, sf, "labels"), "doc_id").join(series, "doc_id")
    words = stored_vocab(ready, "doc_id", "text")
    made = training.assemble_samples(
        ready, document_assets(spark, sf), words, "doc_id", "text", "quality", "toxic", series="power", points=128
    )
    # A text's features are the same in all its windows.
    return made.where("part = 0").select("doc_id", F.posexplode("features").alias("pos", "x")).withColumn("x", F.round("x", 5))


@query(
    "evaluate",
    f"""WITH {PREDICTIONS}, a AS (SELECT fold, {MEASURES} FROM m GROUP BY fold),
        d AS (SELECT fold, p_v - (y_v * 0.95 + 0.025) AS dv, p_e - (y_e * 0.95 + 0.025) AS de FROM p),
        l AS (SELECT fold, (avg(dv * dv) + avg(de * de)) / 2 + 0.1 * (avg(abs(dv)) + avg(abs(de))) / 2 AS loss FROM d GROUP BY fold)
        SELECT fold, {_sql([*_NAMES, "loss"])} FROM a JOIN l USING (fold)""",
)
def evaluate(spark, sf):
    result = training.evaluate(predictions(spark, sf))
    return _rounded(result.folds.join(result.loss, "fold"), [*_NAMES, "loss"])
