"""From the training-ready table to samples, folds and evaluation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow import constants as K
from corpusflow.functions.arrays import minmax_scale, power_to_db, resample_linear
from corpusflow.functions.columns import quadrant
from corpusflow.operators import joins, metrics, profile, sampling
from corpusflow.operators.quality import require_columns
from corpusflow.operators.vocab import encode_windows, stored_vocab
from corpusflow.session import stage


def scaled_features(series: str, points: int):
    """Power series to a fixed number of points in [0, 1): decibels, resize, scale."""
    return minmax_scale(resample_linear(power_to_db(series), points))


def assemble_samples(
    df: DataFrame,
    assets: DataFrame,
    vocab: DataFrame,
    key: str = K.ID_COL,
    text: str = K.TEXT_COL,
    v: str = "valence",
    e: str = "energy",
    series: str | None = None,
    points: int = 256,
    length: int = K.ENCODED_LENGTH,
) -> DataFrame:
    """Rows with an asset, as fixed-width token ids, tones, labels and features.

    The whole text counts: a row for each window of ``length`` tokens, numbered
    by ``part``. Part 0 alone is the fixed-width sample of one row a text.
    """
    with_asset = joins.attach_preferred_asset(df, assets, key)
    return _with_windows(_labelled(with_asset, key, v, e, series, points), with_asset, vocab, key, text, length)


def _labelled(df: DataFrame, key: str, v: str, e: str, series: str | None, points: int) -> DataFrame:
    labels = F.array(F.col(v).cast("float"), F.col(e).cast("float")).alias("labels")
    extra = [scaled_features(series, points).alias("features")] if series else []
    return df.select(key, "path", labels, quadrant(v, e).alias("quadrant"), *extra)


def _with_windows(rows: DataFrame, texts: DataFrame, vocab: DataFrame, key: str, text: str, length: int) -> DataFrame:
    return rows.join(encode_windows(texts, key, text, vocab, length), key)


@dataclass(frozen=True)
class TrainingSet:
    samples: DataFrame
    vocab: DataFrame


def prepare_training(
    ready: DataFrame,
    assets: DataFrame,
    key: str = K.ID_COL,
    text: str = K.TEXT_COL,
    v: str = "valence",
    e: str = "energy",
    series: str | None = None,
    vocab_tokens: int | None = None,
    folds: int = K.FOLDS,
    seed: int = K.SEED,
    points: int = 256,
    length: int = K.ENCODED_LENGTH,
) -> TrainingSet:
    """Vocabulary, encoded samples, class weights and stratified folds.

    Weights and folds belong to a text: all its windows (``part``) share them.
    They are settled on rows without texts, which meet the windows once.
    """
    require_columns(ready, [key, v, e, text], "training table")
    vocab = stored_vocab(ready, key, text, max_tokens=vocab_tokens)
    with_asset = joins.attach_preferred_asset(ready, assets, key)
    rows = stage(_labelled(with_asset, key, v, e, series, points), "samples")
    weighted = profile.attach_class_weights(rows.select(key, "quadrant"), "quadrant", classes=4)
    folded = sampling.stratified_folds(weighted, key, "quadrant", folds, seed).drop("quadrant")
    # Only texts of samples are encoded.
    texts = joins.synced(ready.select(key, text), rows, key)
    samples = _with_windows(rows.join(folded, key), texts, vocab, key, text, length)
    return TrainingSet(samples, vocab)


@dataclass(frozen=True)
class Evaluation:
    folds: DataFrame
    summary: DataFrame
    per_class: DataFrame
    loss: DataFrame


def evaluate(predictions: DataFrame, fold: str = "fold") -> Evaluation:
    """All measures of held-out predictions, by fold and on average."""
    return Evaluation(
        metrics.fold_metrics(predictions, fold),
        metrics.fold_summary(predictions, fold),
        metrics.per_class_accuracy(predictions, [fold]),
        metrics.smoothed_loss(predictions, [fold]),
    )
