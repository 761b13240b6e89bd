"""Counts, reports, weights and evaluation measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.functions.columns import quadrant
from corpusflow.operators import audit, metrics, profile, quality
from workload.cleaning import document_assets
from workload.registry import query, table


def axes(spark, sf):
    return table(spark, sf, "labels").select(quadrant("quality", "toxic").alias("quadrant"), "doc_id")


@query("quadrant_counts", "SELECT quality * 2 + toxic AS quadrant, count(*) AS n FROM labels GROUP BY 1 ORDER BY 1")
def quadrant_counts(spark, sf):
    return profile.quadrant_counts(axes(spark, sf))


@query(
    "quadrant_counts_full",
    """SELECT CAST(q AS INTEGER) AS quadrant, count(toxic) AS n
       FROM range(4) r(q) LEFT JOIN labels ON quality * 2 = q GROUP BY 1 ORDER BY 1""",
)
def quadrant_counts_full(spark, sf):
    """All rows; the second axis is always low, so two classes are absent."""
    labels = table(spark, sf, "labels").select(quadrant("quality", F.lit(0)).alias("quadrant"))
    return profile.quadrant_counts(labels, True)


@query(
    "distribution_report",
    """WITH c AS (SELECT CAST(q AS INTEGER) AS quadrant, count(toxic) AS n FROM range(4) r(q)
                  LEFT JOIN labels ON quality * 2 + toxic = q GROUP BY 1)
       SELECT quadrant,
              CASE quadrant WHEN 0 THEN 'Buồn - Êm dịu (Low V, Low E)'
                            WHEN 1 THEN 'Căng - Sôi động (Low V, High E)'
                            WHEN 2 THEN 'Vui - Êm dịu (High V, Low E)'
                            ELSE 'Vui - Sôi động (High V, High E)' END AS name,
              n, round(CAST(n AS DOUBLE) / (SELECT sum(n) FROM c) * 100, 9) AS pct,
              CAST(floor(CAST(n AS DOUBLE) / (SELECT max(n) FROM c) * 20) AS INTEGER) AS bar_length,
              repeat('█', CAST(floor(CAST(n AS DOUBLE) / (SELECT max(n) FROM c) * 20) AS INTEGER)) AS bar
       FROM c""",
)
def distribution_report(spark, sf):
    report = profile.distribution_report(axes(spark, sf))
    return report.withColumn("pct", F.round("pct", 9))


@query(
    "imbalance",
    """WITH c AS (SELECT count(*) AS n FROM labels GROUP BY quality * 2 + toxic),
            p AS (SELECT CAST(max(n) AS DOUBLE) / sum(n) * 100 AS hi, CAST(min(n) AS DOUBLE) / sum(n) * 100 AS lo FROM c)
       SELECT round(hi, 9) AS max_pct, round(lo, 9) AS min_pct, hi > 40 OR lo < 10 AS imbalanced FROM p""",
)
def imbalance(spark, sf):
    out = profile.imbalance(axes(spark, sf))
    return out.withColumns({c: F.round(c, 9) for c in ("max_pct", "min_pct")})


@query(
    "null_profile",
    """SELECT 'doc_id' AS "column", CAST(0 AS BIGINT) AS nulls UNION ALL SELECT 'source', 0
       UNION ALL SELECT 'quality', (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))
       UNION ALL SELECT 'toxic', (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))""",
)
def null_profile(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source")
    return quality.null_profile(docs.join(table(spark, sf, "labels"), "doc_id", "left"))


@query("drop_empty_columns", "SELECT s_suppkey, s_name FROM supplier")
def drop_empty_columns(spark, sf):
    rows = table(spark, sf, "supplier").select(
        "s_suppkey", F.lit(None).cast("string").alias("gone"), "s_name", F.lit(float("nan")).alias("nan_only")
    )
    return quality.drop_empty_columns(rows)


@query(
    "status_rollup",
    """SELECT count(*) FILTER (WHERE event_type = 'purchase') AS success,
              count(*) FILTER (WHERE event_type = 'view') AS skipped,
              count(*) FILTER (WHERE event_type = 'error') AS http_error,
              count(*) FILTER (WHERE event_type = 'click') AS network_error, count(*) AS total FROM events""",
)
def status_rollup(spark, sf):
    return profile.status_rollup(
        table(spark, sf, "events"), "event_type",
        success="purchase", skipped="view", http_error="err", network_error="cl",
    )


def _outcome(spark, sf):
    events = table(spark, sf, "events").withColumn("batch", F.floor(F.col("event_id") / 10))
    return profile.batch_outcome(events, "batch", F.col("event_type") == "purchase")


@query(
    "batch_outcome",
    """SELECT event_id // 10 AS batch, count(*) AS n_rows,
              count(*) FILTER (WHERE event_type = 'purchase') AS n_valid,
              count(*) FILTER (WHERE event_type <> 'purchase') AS n_null,
              bool_or(event_type = 'purchase') AS ok FROM events GROUP BY 1""",
)
def batch_outcome(spark, sf):
    return _outcome(spark, sf)


@query(
    "batch_summary",
    """WITH b AS (SELECT bool_or(event_type = 'purchase') AS ok FROM events GROUP BY event_id // 10)
       SELECT count(*) AS batches, count(*) FILTER (WHERE ok) AS ok_batches,
              count(*) FILTER (WHERE NOT ok) AS failed_batches FROM b""",
)
def batch_summary(spark, sf):
    return profile.batch_summary(_outcome(spark, sf))


@query(
    "coverage",
    """SELECT count(*) AS n_rows, count(l.quality) AS n_energy, CAST(0 AS BIGINT) AS n_absent,
              2 AS features_present, 3 AS n_columns
       FROM documents d LEFT JOIN labels l USING (doc_id)""",
)
def coverage(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id")
    rows = docs.join(table(spark, sf, "labels"), "doc_id", "left").withColumnsRenamed(
        {"quality": "energy", "toxic": "valence"}
    )
    return profile.coverage(rows, ["energy", "absent"])


@query(
    "class_weights",
    """WITH q AS (SELECT doc_id, quality * 2 + toxic AS quadrant FROM labels),
            c AS (SELECT quadrant, count(*) AS n FROM q GROUP BY 1)
       SELECT doc_id, quadrant, round((SELECT sum(n) FROM c)::DOUBLE / (4 * n), 9) AS weight
       FROM q JOIN c USING (quadrant)""",
)
def class_weights(spark, sf):
    out = profile.attach_class_weights(axes(spark, sf), "quadrant", classes=4)
    return out.withColumn("weight", F.round("weight", 9))


@query(
    "stage_audit",
    """SELECT 'has_asset' AS stage, (SELECT count(*) FROM documents) AS rows_in,
              count(*) AS rows_out, (SELECT count(*) FROM documents) - count(*) AS removed
       FROM documents WHERE CAST(substr(source, 4) AS INTEGER) % 2 = 0
         OR CAST(substr(source, 4) AS INTEGER) % 3 = 0 OR CAST(substr(source, 4) AS INTEGER) % 5 = 0
         OR source = 'src7'""",
)
def stage_audit(spark, sf):
    log = audit.StageAudit(spark)
    assets = document_assets(spark, sf).select("doc_id")
    docs = table(spark, sf, "documents").select("doc_id")
    kept = log.stage("has_asset", docs, lambda d: d.join(assets, "doc_id", "left_semi"))
    kept.write.format("noop").mode("overwrite").save()
    return log.table()


def predictions(spark, sf):
    return table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") % 5).cast("int").alias("fold"),
        (F.col("l_quantity") / 50).alias("y_v"),
        (F.col("l_discount") * 10).alias("y_e"),
        (F.col("l_tax") * 12.5).alias("p_v"),
        (F.col("l_extendedprice") / 100000).alias("p_e"),
    )


PREDICTIONS = """p AS (SELECT CAST(l_orderkey % 5 AS INTEGER) AS fold, l_quantity / 50 AS y_v, l_discount * 10 AS y_e,
                              l_tax * CAST(12.5 AS DOUBLE) AS p_v, l_extendedprice / 100000 AS p_e FROM lineitem),
       m AS (SELECT *, CAST(y_v >= .5 AS INTEGER) * 2 + CAST(y_e >= .5 AS INTEGER) AS tq,
                    CAST(p_v >= .5 AS INTEGER) * 2 + CAST(p_e >= .5 AS INTEGER) AS pq FROM p)"""
MEASURES = """1 - sum((y_v - p_v) * (y_v - p_v)) / (var_pop(y_v) * count(*)) AS r2_v,
              1 - sum((y_e - p_e) * (y_e - p_e)) / (var_pop(y_e) * count(*)) AS r2_e,
              100.0 * count(*) FILTER (WHERE (y_v >= .5) = (p_v >= .5)) / count(*) AS acc_v,
              100.0 * count(*) FILTER (WHERE (y_e >= .5) = (p_e >= .5)) / count(*) AS acc_e,
              100.0 * count(*) FILTER (WHERE tq = pq) / count(*) AS acc_4q"""
_NAMES = ["r2_v", "r2_e", "acc_v", "acc_e", "acc_4q"]


def _rounded(df, names):
    return df.withColumns({n: F.round(n, 6) for n in names})


def _sql(names):
    return ", ".join(f"round(CAST({n} AS DOUBLE), 6) AS {n}" for n in names)


@query("regression_metrics", f"WITH {PREDICTIONS}, a AS (SELECT {MEASURES} FROM m) SELECT {_sql(_NAMES[:2])} FROM a")
def regression_metrics(spark, sf):
    return _rounded(metrics.regression_metrics(predictions(spark, sf)), _NAMES[:2])


@query("accuracy", f"WITH {PREDICTIONS}, a AS (SELECT {MEASURES} FROM m) SELECT {_sql(_NAMES[2:])} FROM a")
def accuracy(spark, sf):
    return _rounded(metrics.accuracy(predictions(spark, sf)), _NAMES[2:])


@query(
    "per_class_accuracy",
    f"""WITH {PREDICTIONS} SELECT tq AS quadrant,
        round(CAST(100.0 * count(*) FILTER (WHERE tq = pq) / count(*) AS DOUBLE), 6) AS acc, count(*) AS support
        FROM m GROUP BY 1""",
)
def per_class_accuracy(spark, sf):
    return _rounded(metrics.per_class_accuracy(predictions(spark, sf)), ["acc"])


@query(
    "fold_metrics",
    f"WITH {PREDICTIONS}, a AS (SELECT fold, {MEASURES} FROM m GROUP BY fold) SELECT fold, {_sql(_NAMES)} FROM a",
)
def fold_metrics(spark, sf):
    return _rounded(metrics.fold_metrics(predictions(spark, sf)), _NAMES)


@query(
    "fold_summary",
    f"""WITH {PREDICTIONS}, a AS (SELECT fold, {MEASURES} FROM m GROUP BY fold),
        b AS (SELECT {", ".join(f"avg({n}) AS {n}" for n in _NAMES)} FROM a) SELECT {_sql(_NAMES)} FROM b""",
)
def fold_summary(spark, sf):
    return _rounded(metrics.fold_summary(predictions(spark, sf)), _NAMES)


@query(
    "smoothed_loss",
    f"""WITH {PREDICTIONS}, d AS (SELECT fold, p_v - (y_v * 0.95 + 0.025) AS dv, p_e - (y_e * 0.95 + 0.025) AS de FROM p)
        SELECT fold, round(CAST((avg(dv * dv) + avg(de * de)) / 2 + 0.1 * (avg(abs(dv)) + avg(abs(de))) / 2 AS DOUBLE), 6)
          AS loss FROM d GROUP BY fold""",
)
def smoothed_loss(spark, sf):
    return _rounded(metrics.smoothed_loss(predictions(spark, sf), ["fold"]), ["loss"])
