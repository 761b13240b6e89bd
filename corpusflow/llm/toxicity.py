"""Toxicity by weak supervision.

Many voters look at a text: fixed lexicons, lexicons of words and word beginnings mined from labelled
rows, and patterns. A generative label model estimates from their votes alone how often each voter is
right for toxic and for clean texts (expectation maximisation), and how far voters repeat each other
beyond what the label explains; a voter that others repeat counts for less. The given label takes part
as one more voter. A linear classifier is trained on the model's posterior labels and scores all texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.language_id import LetterWords, letter_words
from corpusflow.llm.pretokens import mix, powers
from corpusflow.llm.slices import bound_batches, slices
from corpusflow.session import stage

# Labelled rows that the model is fitted on, on average, dealt over the whole table.
FIT_ROWS = 8_000
# Words and word beginnings that are mined at most.
MINED = 1024
# Letters of the word beginnings that are looked at.
BEGINNINGS = (4, 5, 6, 7)
_BASE, _INVERSE = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

# Fixed lexicons, by kind.
LEXICONS = {
    "insult": "idiot idiots moron morons stupid imbecile dumb fool loser losers clown jerk".split(),
    "contempt": "trash scum pathetic worthless disgusting garbage vermin filth useless despicable".split(),
    "threat": "kill die hurt destroy hate shoot burn rape hang murder".split(),
}
VOTERS = [*LEXICONS, "mined even", "mined odd", "some marked words", "many marked words", "dense marked words", "evidence", "exclamations", "capitals"]
ABSTAIN, CLEAN, TOXIC = -1, 0, 1


def _key(word: str) -> int:
    return int(letter_words([word]).key[0])


def token_keys(words: LetterWords) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and of their beginnings, and the word that each belongs to."""
    sums = np.zeros(len(words.points) + 1, dtype=np.uint64)
    np.cumsum(mix(words.points + np.uint64(1)) * powers(len(words.points), _BASE)[:-1], out=sums[1:])
    back = powers(len(words.points), _INVERSE)
    keys, owners = [words.key], [np.arange(len(words.key))]
    for k in BEGINNINGS:
        of = np.flatnonzero(words.end - words.start > k)
        start = words.start[of]
        keys.append(mix((sums[start + k] - sums[start]) * back[start] + np.uint64(1 << 32) + np.uint64(k)))
        owners.append(of)
    return np.concatenate(keys), np.concatenate(owners)


@dataclass
class Lexicon:
    """Mined tokens in the order of their hashes, and the evidence of each (log ratio of its rates)."""

    keys: np.ndarray
    evidence: np.ndarray

    def look(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(votes, features) of texts: a row each."""
        words = letter_words(texts)
        n = len(texts)
        owner = np.repeat(np.arange(n), np.diff(words.first))
        counts = np.zeros((n, len(self.keys)))
        marked = np.zeros(len(words.key), dtype=bool)
        if len(self.keys) and len(words.key):
            keys, of = token_keys(words)
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            hit = self.keys[at] == keys
            np.add.at(counts, (owner[of[hit]], at[hit]), 1.0)
            marked[of[hit]] = True
        total = np.diff(words.first)
        flagged = np.bincount(owner, weights=marked, minlength=n)
        density = flagged / np.maximum(total, 1)
        strong = (counts > 0) & (self.evidence > np.log(30.0))
        even = (self.keys & np.uint64(1)).astype(bool)
        evidence = np.minimum(counts, 3.0) @ self.evidence
        lexicon = [np.bincount(owner, weights=np.isin(words.key, np.array([_key(w) for w in list_], np.uint64)), minlength=n) for list_ in LEXICONS.values()]
        shouts = np.array([t.count("!") for t in texts], dtype=float) / np.maximum(total, 1)
        capitals = np.array([sum(map(str.isupper, t.split())) for t in texts], dtype=float) / np.maximum(total, 1)

        def vote(yes: np.ndarray, no: np.ndarray | None = None) -> np.ndarray:
            return np.where(yes, TOXIC, ABSTAIN if no is None else np.where(no, CLEAN, ABSTAIN))

        votes = np.stack([
            *(vote(x >= 1) for x in lexicon),
            vote(strong[:, even].any(axis=1)), vote(strong[:, ~even].any(axis=1)),
            vote(flagged >= 2, flagged == 0), vote(flagged >= 4, flagged <= 1), vote(density >= 0.02, density < 0.004),
            vote(evidence >= 12.0, evidence < 4.0), vote(shouts > 0.3), vote(capitals > 0.5),
        ], axis=1)
        features = np.concatenate(
            [np.log1p(counts), np.stack([np.log1p(flagged), np.minimum(50 * density, 5.0), np.log1p(evidence), *map(np.log1p, lexicon)], axis=1), votes], axis=1
        )
        return votes, features


def mine_lexicon(sample: DataFrame, rows: int = MINED) -> Lexicon:
    """The tokens of the sample (``text``, ``toxic``) that speak most for toxic texts.

    Tokens are counted once a text. Kept are those at least five times as frequent in toxic texts and in
    at least four of them, by their log-likelihood.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, labels = batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist(), dtype=np.int64)
            done = 0
            for part in slices(texts):
                words = letter_words(part)
                keys, of = token_keys(words)
                owner = np.repeat(np.arange(len(part)), np.diff(words.first))[of]
                order = np.lexsort((owner, keys))
                keys, owner = keys[order], owner[order]
                new = np.ones(len(keys), dtype=bool)
                new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
                keys, toxic = keys[new], labels[done + owner[new]]
                done += len(part)
                tokens, at = np.unique(keys, return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens.view(np.int64)), pa.array(np.bincount(at, weights=toxic, minlength=len(tokens)).astype(np.int64)), pa.array(np.bincount(at, weights=1 - toxic, minlength=len(tokens)).astype(np.int64))],
                    names=["token", "t", "c"],
                )

    sizes = sample.agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n")).first()
    n_toxic, n_clean = sizes["t"] or 0, (sizes["n"] or 0) - (sizes["t"] or 0)
    sums = sample.select("text", "toxic").mapInArrow(count, "token long, t long, c long").groupBy("token").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    ratio = F.log((F.col("t") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("c") + 0.5) / (n_clean + 1.0))
    speaks = sums.withColumn("e", ratio).where((F.col("t") >= 4) & (F.col("e") >= float(np.log(5.0))))
    best = speaks.orderBy(F.desc(F.col("t") * F.col("e")), "token").limit(rows).collect()
    keys = np.array([r["token"] for r in best], dtype=np.int64).view(np.uint64)
    order = np.argsort(keys)
    return Lexicon(keys[order], np.array([r["e"] for r in best], dtype=float)[order])


@dataclass
class LabelModel:
    """Log-odds of toxic before any vote, of each voter's votes (abstain, clean, toxic), and its weight."""

    prior: float
    odds: np.ndarray
    weight: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        shown = self.odds[np.arange(votes.shape[1]), votes + 1]
        return 1.0 / (1.0 + np.exp(-np.clip(self.prior + shown @ self.weight, -30, 30)))


def fit_label_model(votes: np.ndarray, start: np.ndarray, rounds: int = 30) -> LabelModel:
    """Accuracies and correlations of the voters from a matrix of votes; ``start``: first guess of the labels."""
    seen = np.stack([votes == v for v in (ABSTAIN, CLEAN, TOXIC)], axis=2).astype(float)
    p = np.clip(start.astype(float), 0.05, 0.95)
    model = LabelModel(0.0, np.zeros((votes.shape[1], 3)), np.ones(votes.shape[1]))
    for _ in range(rounds):
        rates = []
        for q in (p, 1 - p):
            rate = (seen * q[:, None, None]).sum(axis=0) + 0.5
            rates.append(rate / rate.sum(axis=1, keepdims=True))
        odds = np.log(rates[0] / rates[1])
        prior = float(np.log((p.sum() + 1) / ((1 - p).sum() + 1)))
        # What is left of each vote once the label is known: voters that still agree repeat each other.
        shown = odds[np.arange(votes.shape[1]), votes + 1]
        left = shown - p[:, None] * (rates[0] * odds).sum(axis=1) - (1 - p)[:, None] * (rates[1] * odds).sum(axis=1)
        scale = np.sqrt((left**2).sum(axis=0)) + 1e-9
        repeated = np.maximum((left / scale).T @ (left / scale), 0.0)
        np.fill_diagonal(repeated, 0.0)
        model = LabelModel(prior, odds, 1.0 / (1.0 + repeated.sum(axis=1)))
        p = model.posterior(votes)
    return model


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    weights: np.ndarray
    bias: float

    def score(self, texts: list[str]) -> np.ndarray:
        _, features = self.lexicon.look(texts)
        return 1.0 / (1.0 + np.exp(-np.clip(features @ self.weights + self.bias, -30, 30)))


def fit_toxicity(df: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = FIT_ROWS) -> ToxicityModel:
    """A model from the texts of ``df`` that ``labels`` (``doc``, ``label``) marks 0 or 1.

    Other labels, NULLs and unlabelled rows are left out; a document labelled twice counts as toxic if
    one label says so. ``rows`` labelled rows are drawn on average, by a hash of ``doc``; that bounds
    what is broadcast, joined and fitted. Without both labels every score is the share of toxic ones.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    bound_batches(df.sparkSession)
    marks = labels.select(F.col(f"`{doc}`").alias("doc"), F.col(f"`{label}`").cast("int").alias("toxic")).where("doc is not null and toxic in (0, 1)")
    share = min(1.0, rows / max(marks.count(), 1))
    drawn = marks.where(F.pmod(F.xxhash64("doc", F.lit(11)), F.lit(1 << 20)) < share * (1 << 20)).groupBy("doc").agg(F.max("toxic").alias("toxic"))
    texts = df.select(F.col(f"`{doc}`").alias("doc"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    sample = stage(texts.join(F.broadcast(drawn), "doc").select("text", "toxic").repartition(8), "toxicity-sample")
    lexicon = mine_lexicon(sample)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [lexicon.look(part) for part in slices(batch.column(0).to_pylist())]
            lists = [pa.array([row.tolist() for part in found for row in part[k]], t) for k, t in ((0, pa.list_(pa.int32())), (1, pa.list_(pa.float64())))]
            yield pa.RecordBatch.from_arrays([*lists, batch.column(1)], names=["votes", "features", "toxic"])

    seen = stage(sample.mapInArrow(look, "votes array<int>, features array<double>, toxic int"), "toxicity-votes")
    width = len(lexicon.keys) + 3 + len(LEXICONS) + len(VOTERS)
    cast = seen.select("votes", "toxic").collect()  # the bounded sample: a few small numbers a row
    gold = np.array([r["toxic"] for r in cast], dtype=np.int64)
    if not len(gold) or gold.min() == gold.max():
        mean = float(gold.mean()) if len(gold) else 0.0
        return ToxicityModel(lexicon, np.zeros(width), float(np.log((mean + 1e-9) / (1 - mean + 1e-9))))
    model = fit_label_model(np.array([[*r["votes"], r["toxic"]] for r in cast], dtype=np.int64), gold)
    odds = F.lit([[float(x) for x in row] for row in model.odds * model.weight[:, None]])
    votes = F.concat("votes", F.array("toxic"))
    sums = F.aggregate(F.transform(votes, lambda v, i: F.get(F.get(odds, i), v + 1)), F.lit(model.prior), lambda a, x: a + x)
    soft = seen.select(array_to_vector("features").alias("features"), (1 / (1 + F.exp(-sums))).alias("p"))
    both = soft.select("features", F.explode(F.array(F.struct(F.lit(1.0).alias("label"), F.col("p").alias("weight")), F.struct(F.lit(0.0).alias("label"), (1 - F.col("p")).alias("weight")))).alias("y"))
    rows_ = both.select("features", "y.label", "y.weight").where("weight > 0.001")
    fitted = LogisticRegression(weightCol="weight", regParam=0.002, elasticNetParam=0.0, maxIter=60).fit(rows_)
    return ToxicityModel(lexicon, fitted.coefficients.toArray(), float(fitted.intercept))


def toxicity_column(df: DataFrame, text: Column, model: ToxicityModel) -> Column:
    """Score of a text, 0 to 1, higher where label 1 is likelier; NULL and empty texts get the bare prior."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(np.concatenate([np.zeros(0), *(shared.value.score(part) for part in slices(batch.to_pylist()))]))

    return score(text)


def score_toxicity(df: DataFrame, model: ToxicityModel, text: str = "text", out: str = "toxicity") -> DataFrame:
    """``df`` with the score of each whole text; a column already named ``out`` is replaced. No shuffle."""
    bound_batches(df.sparkSession)
    return df.withColumn(out, toxicity_column(df, F.col(f"`{text}`"), model))
