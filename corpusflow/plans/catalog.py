"""Flows from raw tables to the training-ready table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow import constants as K
from corpusflow.functions.columns import format_people, normalize_id, quadrant, valid_url
from corpusflow.functions.text import has_text
from corpusflow.operators import dedup, joins, profile, quality
from corpusflow.operators.language import LanguageProfiles, with_language
from corpusflow.operators.routing import content_route, route_by_language
from corpusflow.operators.rows import format_people_text
from corpusflow.session import stage


def _with_id(df: DataFrame, source: str = K.ID_COL) -> DataFrame:
    renamed = df.withColumnRenamed(source, K.ID_COL) if source in df.columns else df
    return renamed.withColumn(K.ID_COL, normalize_id(K.ID_COL))


def _people(df: DataFrame) -> Column:
    name = next((c for c in ("artists", K.PEOPLE_COL) if c in df.columns), None)
    if name is None:
        return F.lit(K.UNKNOWN)
    kind = df.schema[name].dataType
    if isinstance(kind, T.ArrayType):
        return format_people(name, struct=isinstance(kind.elementType, T.StructType))
    return format_people_text(name)


def curate_catalog(
    meta: DataFrame,
    features: DataFrame,
    order_by: Sequence[str],
    feature_order: Sequence[str],
) -> DataFrame:
    """Metadata with features: valid, unique by identifier and by title + people.

    Rows are unique by identifier before the join. That keeps the same survivor
    as joining first, and a hot identifier does not fan out.
    """
    meta, features = _with_id(meta, "id"), _with_id(features)
    title = "name" if "name" in meta.columns else K.TITLE_COL
    required = [K.ID_COL, *([title] if title in meta.columns else [])]
    # Invalid identifiers are NULL by now.
    rows = dedup.dedup_first(meta.na.drop(subset=required), [K.ID_COL], order_by)
    ids = features.filter(F.col(K.ID_COL).isNotNull())
    joined = joins.enrich_left(rows, dedup.dedup_first(ids, [K.ID_COL], feature_order), K.ID_COL, hot_rows=None)
    named = joined.withColumn(K.PEOPLE_COL, _people(joined))
    if title in named.columns:
        named = dedup.dedup_by_match_key(named, [title, K.PEOPLE_COL], order_by)
    core = [c for c in K.PRIORITY_COLS if c != K.TEXT_COL]
    chosen = quality.select_and_rename(named, K.RENAMES, [*core, *K.FEATURE_COLS])
    return quality.coerce_numeric(chosen, floats=["Popularity", "Duration_MS"])


def filter_texts(
    texts: DataFrame,
    titles: DataFrame | None,
    profiles: LanguageProfiles,
    target: str,
    keywords: Sequence[str] | None = None,
    sample_chars: int | None = None,
) -> DataFrame:
    """Every text with its route and reason; language is asked only of open rows.

    A row's language is worked out from its own text, in the row: identifiers, copies and rows
    without an identifier play no part in it.
    """
    titled = joins.attach_title(_with_id(texts), None if titles is None else _with_id(titles), K.ID_COL)
    sorted_out = content_route(titled, K.TITLE_COL, K.TEXT_COL, keywords)
    asked = sorted_out.withColumn("_asked", F.when(F.col("route").isNull(), F.col(K.TEXT_COL)))
    found = with_language(asked, "_asked", profiles, sample_chars).drop("_asked")
    settled = F.when(F.col("route").isNull(), F.col("language"))
    return route_by_language(found.withColumn("language", settled), target)


@dataclass(frozen=True)
class Master:
    table: DataFrame
    reconciliation: DataFrame


def build_master(
    meta: DataFrame, texts: DataFrame, meta_order: Sequence[str], text_order: Sequence[str]
) -> Master:
    """Metadata and kept texts in one table, unique and in the fixed column order.

    Rows without an identifier can match nothing and are left out.
    """
    quality.require_columns(meta, [K.ID_COL, K.TITLE_COL, K.PEOPLE_COL], "metadata")
    quality.require_columns(texts, [K.ID_COL, K.TEXT_COL], "texts")
    meta, texts = _with_id(meta), _with_id(texts)
    left = dedup.dedup_first(meta, [K.ID_COL], meta_order)
    right = dedup.dedup_first(texts, [K.ID_COL], text_order).select(K.ID_COL, K.TEXT_COL)
    joined = joins.merge_inner(left, right, K.ID_COL)
    # The empty-column test reads the table once more than the result does.
    readable = stage(joined.filter(has_text(K.TEXT_COL)), "master")
    filled = quality.drop_empty_columns(readable)
    numbers = quality.coerce_numeric(
        filled, [*K.FLOAT_FEATURES, "Popularity", "Duration_MS"], K.INT_FEATURES
    )
    # Order columns may be gone as empty; the identifier is a full order by itself.
    order = [c for c in meta_order if c in numbers.columns] + [K.ID_COL]
    if K.TITLE_COL in numbers.columns and K.PEOPLE_COL in numbers.columns:
        numbers = dedup.dedup_by_match_key(numbers, [K.TITLE_COL, K.PEOPLE_COL], order)
    return Master(quality.reorder_columns(numbers), joins.reconcile(meta, texts, K.ID_COL))


@dataclass(frozen=True)
class FetchPlan:
    tasks: DataFrame
    counts: DataFrame


def plan_fetch(master: DataFrame, done: DataFrame, on: str = K.ID_COL) -> FetchPlan:
    """What is still to fetch, and how many rows are done or have no URL."""
    rows = master.withColumn("_id", normalize_id(on)).filter(F.col("_id").isNotNull())
    ready = done.select(normalize_id(on).alias("_id"), F.lit(True).alias("_done")).distinct()
    url = F.coalesce(valid_url(quality.first_present(master, [K.URL_COL], "")), F.lit(""))
    state = (
        F.when(F.col("_done"), F.lit("done"))
        .when(F.col("_url") == "", F.lit("no_url"))
        .otherwise(F.lit("task"))
    )
    marked = rows.withColumn("_url", url).join(ready, "_id", "left").withColumn("_state", state)
    counts = marked.agg(
        F.count("*").alias("total"),
        *[F.count_if(F.col("_state") == s).alias(n) for s, n in (("done", "skipped"), ("no_url", "no_url"), ("task", "tasks"))],
    )
    title = F.coalesce(quality.first_present(master, [K.TITLE_COL], K.UNKNOWN).cast("string"), F.lit("nan"))
    tasks = marked.filter(F.col("_state") == "task").select(
        F.col("_id").alias("track_id"), title.alias("track_name"), F.col("_url").alias("url")
    )
    return FetchPlan(tasks, counts)


@dataclass(frozen=True)
class TrainReady:
    ready: DataFrame
    missing: DataFrame
    quarantine: DataFrame
    nulls: DataFrame


def train_ready(master: DataFrame, assets: DataFrame, on: str = K.ID_COL) -> TrainReady:
    """Rows with an asset and no gap; the others as missing or quarantined.

    All-missing columns go before rows are tested, so that a useless column
    does not cost the rows.
    """
    rows = master.withColumn(on, normalize_id(on)).filter(F.col(on).isNotNull())
    available = assets.select(normalize_id(on).alias(on))
    # Read three times: for the empty columns and for both outcomes.
    present = stage(joins.synced(rows, available, on), "synced")
    filled = quality.drop_empty_columns(present)
    valid, invalid = quality.split_complete(filled)
    log = [c for c in (on, K.TITLE_COL, K.PEOPLE_COL, K.URL_COL) if c in rows.columns]
    return TrainReady(
        quality.reorder_columns(valid),
        joins.pending(rows, available, on).select(*log),
        quality.reorder_columns(invalid),
        quality.null_profile(filled),
    )


@dataclass(frozen=True)
class BalanceReport:
    report: DataFrame
    verdict: DataFrame


def balance_report(ready: DataFrame, v: str = "valence", e: str = "energy") -> BalanceReport:
    """Distribution over the four quadrants and the imbalance verdict."""
    quality.require_columns(ready, [v, e], "training table")
    numbers = quality.coerce_numeric(ready.select(v, e), floats=[v, e]).na.drop(subset=[v, e])
    binned = numbers.select(quadrant(v, e).alias("quadrant"))
    report = profile.flag_imbalance(profile.distribution_report(binned))
    return BalanceReport(report, profile.imbalance(binned))
