"""Balanced samples, folds, mixing, batches and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.functions.columns import quadrant
from corpusflow.operators import modeling, profile, sampling
from corpusflow.session import work_path
from workload.profiles import axes
from workload.registry import query, table


def u48(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 12) AS BIGINT)"


@query(
    "balanced_sample",
    f"""WITH m AS (SELECT doc_id, quality * 2 + toxic AS quadrant FROM labels),
        x AS (SELECT *, row_number() OVER (PARTITION BY quadrant ORDER BY {u48("'42:' || doc_id")}, doc_id) - 1 AS at FROM m),
        c AS (SELECT quadrant, count(*) AS size, row_number() OVER (ORDER BY quadrant) - 1 AS class FROM m GROUP BY 1),
        k AS (SELECT count(*) AS classes FROM c),
        d AS (SELECT i AS draw, {u48("'42:class:' || i")} / 281474976710656.0::DOUBLE AS uc,
                     {u48("'42:member:' || i")} / 281474976710656.0::DOUBLE AS um
              FROM range((SELECT count(*) FROM labels)) r(i))
        SELECT draw, x.doc_id, x.quadrant FROM d, k JOIN c ON c.class = CAST(floor(uc * classes) AS BIGINT)
        JOIN x ON x.quadrant = c.quadrant AND x.at = CAST(floor(um * size) AS BIGINT)""",
)
def balanced_sample(spark, sf):
    return sampling.balanced_sample(axes(spark, sf), "doc_id", "quadrant", draws_per_key=5)


_FOLD_SQL = f"""SELECT doc_id, quality * 2 + toxic AS quadrant,
    CAST((row_number() OVER (ORDER BY quality * 2 + toxic, {u48("'42:' || doc_id")}, doc_id) - 1) % 5 AS INTEGER) AS fold
    FROM labels"""


@query("stratified_folds", _FOLD_SQL)
def stratified_folds(spark, sf):
    return sampling.stratified_folds(axes(spark, sf), "doc_id", "quadrant")


@query(
    "fold_split",
    f"""SELECT quadrant, count(*) FILTER (WHERE fold <> 2) AS train, count(*) FILTER (WHERE fold = 2) AS test
        FROM ({_FOLD_SQL}) GROUP BY 1""",
)
def fold_split(spark, sf):
    train, test = sampling.fold_split(sampling.stratified_folds(axes(spark, sf), "doc_id", "quadrant"), 2)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("quadrant").agg(
        F.count_if(F.col("part") == "train").alias("train"), F.count_if(F.col("part") == "test").alias("test")
    )


def _vectors(spark, sf):
    return table(spark, sf, "embeddings").select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("embedding"), "label",
        F.array(F.col("label") / 10.0, 1 - F.col("label") / 10.0).alias("labels"),
    )


@query(
    "mixup",
    f"""WITH b AS (SELECT *, (row_number() OVER (ORDER BY vec_id) - 1) // 64 + 1 AS batch FROM embeddings),
        p AS (SELECT *, row_number() OVER (PARTITION BY batch ORDER BY vec_id) AS i,
                     row_number() OVER (PARTITION BY batch ORDER BY {u48("'42:' || vec_id")}, vec_id) AS j FROM b)
        SELECT a.vec_id, a.batch, o.vec_id AS partner, CAST(k AS INTEGER) AS pos,
               round(0.3 * CAST(a.embedding[k + 1] AS DOUBLE) + 0.7 * CAST(o.embedding[k + 1] AS DOUBLE), 5) AS x,
               round(0.3 * a.label / 10 + 0.7 * o.label / 10, 6)::DOUBLE AS y
        FROM p a JOIN p o ON a.batch = o.batch AND a.i = o.j, range(64) r(k)""",
)
def mixup(spark, sf):
    mixed = sampling.mixup(_vectors(spark, sf), "vec_id", ["embedding", "labels"], lam=0.3)
    rows = mixed.select(
        "vec_id", "batch", "partner", F.round(F.get("labels", F.lit(0)), 6).alias("y"),
        F.posexplode("embedding").alias("pos", "x"),
    )
    return rows.withColumn("x", F.round("x", 5))


@query(
    "mixup_random_weight",
    """SELECT batch, count(*) AS n, CAST(1 AS BIGINT) AS lams, true AS in_range, true AS is_mix
       FROM (SELECT (row_number() OVER (ORDER BY vec_id) - 1) // 64 + 1 AS batch FROM embeddings) GROUP BY 1""",
)
def mixup_random_weight(spark, sf):
    """The weight is random; what has to hold of it is not: one per batch, in [0, 1], and the rows mixed by it."""
    vectors = _vectors(spark, sf)
    mixed = sampling.mixup(vectors, "vec_id", ["embedding", "labels"])
    own = vectors.select("vec_id", F.col("labels").alias("own"))
    other = vectors.select(F.col("vec_id").alias("partner"), F.col("labels").alias("other"))
    rows = mixed.join(own, "vec_id").join(other, "partner")
    want = F.col("lam") * F.get("own", F.lit(0)) + (1 - F.col("lam")) * F.get("other", F.lit(0))
    return rows.groupBy("batch").agg(
        F.count("*").alias("n"),
        F.countDistinct("lam").alias("lams"),
        F.bool_and(F.col("lam").between(0.0, 1.0)).alias("in_range"),
        F.bool_and(F.abs(F.get("labels", F.lit(0)) - want) < 1e-9).alias("is_mix"),
    )


@query(
    "eval_batches",
    """WITH b AS (SELECT vec_id, (row_number() OVER (ORDER BY vec_id) - 1) // 64 + 1 AS batch FROM embeddings)
       SELECT vec_id, batch FROM b WHERE batch <= (SELECT count(*) FROM embeddings) // 64""",
)
def eval_batches(spark, sf):
    vectors = table(spark, sf, "embeddings").select("vec_id")
    return sampling.eval_batches(vectors, "vec_id", 64, drop_last=True).select("vec_id", "batch")


def _items(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("row_id"),
        (F.col("l_quantity") / 50).alias("v"),
        (F.col("l_discount") * 10).alias("e"),
        "l_extendedprice",
    )
    return rows.withColumn("quadrant", quadrant("v", "e"))


FEATURES = ["l_extendedprice"]
# Weighted regression on one feature in closed form: sums of weight, x, y, their squares and products.
_ITEMS_SQL = """i AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_id, CAST(l_extendedprice AS DOUBLE) AS x,
                             CAST(l_quantity AS DOUBLE) / 50 AS v, CAST(l_discount AS DOUBLE) * 10 AS e FROM lineitem),
        q AS (SELECT *, CASE WHEN v >= 0.5 THEN 2 ELSE 0 END + CASE WHEN e >= 0.5 THEN 1 ELSE 0 END AS quadrant FROM i),
        w AS (SELECT *, count(*) OVER () / (4.0::DOUBLE * count(*) OVER (PARTITION BY quadrant)) AS w FROM q)"""
_SUMS_SQL = """sum(w) AS s, sum(w * x) AS sx, sum(w * x * x) AS sxx, sum(w * v) AS sv, sum(w * x * v) AS sxv,
               sum(w * e) AS se, sum(w * x * e) AS sxe"""
_LINES_SQL = """(s * sxv - sx * sv) / (s * sxx - sx * sx) AS bv, (s * sxe - sx * se) / (s * sxx - sx * sx) AS be, s, sx, sv, se"""
_PREDICTED_SQL = """least(greatest((sv - bv * sx) / s + bv * x, 0), 1) AS p_v, least(greatest((se - be * sx) / s + be * x, 0), 1) AS p_e"""


@query(
    "cross_fit",
    f"""WITH {_ITEMS_SQL},
        f AS (SELECT *, CAST((row_number() OVER (ORDER BY quadrant, {u48("'42:' || row_id")}, row_id) - 1) % 5 AS INTEGER) AS fold FROM w),
        own AS (SELECT fold, {_SUMS_SQL} FROM f GROUP BY fold), total AS (SELECT {_SUMS_SQL} FROM f),
        train AS (SELECT fold, t.s - o.s AS s, t.sx - o.sx AS sx, t.sxx - o.sxx AS sxx, t.sv - o.sv AS sv,
                         t.sxv - o.sxv AS sxv, t.se - o.se AS se, t.sxe - o.sxe AS sxe FROM own o, total t),
        line AS (SELECT fold, {_LINES_SQL} FROM train),
        p AS (SELECT f.*, {_PREDICTED_SQL} FROM f JOIN line USING (fold))
        SELECT fold, round(1 - sum((v - p_v) ** 2) / (var_pop(v) * count(*)), 6) AS r2_v,
               round(1 - sum((e - p_e) ** 2) / (var_pop(e) * count(*)), 6) AS r2_e,
               round(avg(CAST((v >= 0.5) = (p_v >= 0.5) AS DOUBLE)) * 100, 6) AS acc_v,
               round(avg(CAST((e >= 0.5) = (p_e >= 0.5) AS DOUBLE)) * 100, 6) AS acc_e,
               round(avg(CAST((v >= 0.5) = (p_v >= 0.5) AND (e >= 0.5) = (p_e >= 0.5) AS DOUBLE)) * 100, 6) AS acc_4q
        FROM p GROUP BY fold""",
)
def cross_fit(spark, sf):
    """Out-of-fold measures of weighted regressions on one feature."""
    from corpusflow.operators.metrics import fold_metrics

    weighted = profile.attach_class_weights(_items(spark, sf), "quadrant", classes=4)
    folded = sampling.stratified_folds(weighted, "row_id", "quadrant")
    measured = fold_metrics(modeling.cross_fit(folded, FEATURES, ("v", "e"), weight="weight"))
    return measured.select("fold", *[F.round(c, 6).alias(c) for c in ("r2_v", "r2_e", "acc_v", "acc_e", "acc_4q")])


@query(
    "fit_and_score",
    f"""WITH {_ITEMS_SQL}, total AS (SELECT {_SUMS_SQL} FROM w), line AS (SELECT {_LINES_SQL} FROM total),
        p AS (SELECT w.*, {_PREDICTED_SQL} FROM w, line),
        n AS (SELECT *, CAST(CASE WHEN p_v >= 0.5 THEN 2 ELSE 0 END + CASE WHEN p_e >= 0.5 THEN 1 ELSE 0 END AS INTEGER) AS side FROM p)
        SELECT side AS quadrant, count(*) AS n, round(avg(p_v), 6) AS mean_v, round(avg(p_e), 6) AS mean_e FROM n GROUP BY 1""",
)
def fit_and_score(spark, sf):
    """Fit on everything, store, load and score."""
    rows = profile.attach_class_weights(_items(spark, sf), "quadrant", classes=4)
    path = work_path(spark, "model")
    modeling.save_model(spark, modeling.fit_final(rows, FEATURES, ("v", "e"), "weight"), path, config={"features": FEATURES})
    models, _ = modeling.load_model(spark, path)
    scored = modeling.score(rows.drop("quadrant"), models)
    return scored.groupBy("quadrant").agg(
        F.count("*").alias("n"), F.round(F.avg("p_v"), 6).alias("mean_v"), F.round(F.avg("p_e"), 6).alias("mean_e")
    )
