"""From raw documents to token ids: five stages, each a table that the next one reads.

Every stage takes the rows that its predecessor kept and returns those that it keeps, with the columns of
``documents`` (the last one: token ids). Rows with NULLs, repeated rows and empty tables pass as each
stage's docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm import bpe, decontaminate, jaccard, language_id, line_dedup
from corpusflow.llm.queries import table, tokenizer_path
from corpusflow.session import stage

# Share of a text's letters that has to be in its language for the text to stay.
LEAST_SCORE = 0.25
# Words of a shingle, and similarity (80 of 100), from which texts are near duplicates.
SHINGLE, ALIKE, OF = 5, 80, 100
# Rows of the table of near duplicates up to which it is broadcast (8 bytes a row).
BROADCAST_ROWS = 1_000_000

ORACLE_SQL = None  # languages, edit distances and token ids are beyond SQL; see tests/llm


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in a language that the labelled texts of ``docs`` teach.

    Those go that have no letter (NULL and empty ones too), or of whose letters less than
    ``LEAST_SCORE`` are in words of the chosen language. Without any label no text can be told, and all go.
    """
    model = language_id.fit_model(docs, "text", "lang")
    found = language_id.identify_languages(docs, model, out="_pipeline.language")
    kept = found.where((F.col("`_pipeline.language`.lang") != "und") & (F.col("`_pipeline.language`.score") >= LEAST_SCORE))
    return kept.select(*[f"`{c}`" for c in docs.columns])


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts less the lines that stand earlier, exactly or but for one character; ``n_chars`` follows.

    Exact repeats go at every length if they have a letter or digit; one edit is allowed from 20 characters.
    A text that loses lines and has no word left goes. NULL and empty texts stay as they are.
    """
    cut = line_dedup.dedup_lines(docs, dropped="_pipeline.dropped", short_repeats=True)
    left = cut.where((F.col("`_pipeline.dropped`") == 0) | (F.trim(F.translate("text", "\t\n\x0b\f\r", "     ")) != ""))
    n_chars = F.when(F.col("`_pipeline.dropped`") == 0, F.col("n_chars")).otherwise(F.length("text").cast("long"))
    return left.withColumn("n_chars", n_chars).select(*[f"`{c}`" for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of the least ``doc_id``.

    Texts without words are near duplicates of nothing. A document is an id with a text: of different
    texts under one id each is judged by itself. Rows equal in ``doc_id`` and text are one document, and
    one of them stays. Rows without ``doc_id`` stay, each.
    """
    found = stage(jaccard.jaccard_groups(docs, width=SHINGLE, num=ALIKE, den=OF).where("doc is not null"), "near-duplicates")
    one = found.groupBy("doc", "body").agg(F.count(F.lit(1)).alias("rows"), F.min("group").alias("group"))
    first = one.where("group is not null").groupBy("group").agg(F.min(F.struct("doc", "body")).alias("first"))
    gone = one.join(first, "group").where(F.struct("doc", "body") != F.col("first")).select("doc", "body")
    gone, repeated = stage(gone, "near-duplicates-gone"), stage(one.where("rows > 1").select("doc", "body"), "repeated-rows")
    named = docs.withColumns({"_pipeline.doc": F.col("doc_id").cast("long"), "_pipeline.body": F.xxhash64("text")})
    own = {"doc": F.col("`_pipeline.doc`"), "body": F.col("`_pipeline.body`")}

    def without(rows: DataFrame, some: DataFrame, how: str) -> DataFrame:
        small = F.broadcast(some) if some.count() <= BROADCAST_ROWS else some
        return rows.join(small, (own["doc"] == small["doc"]) & own["body"].eqNullSafe(small["body"]), how)

    kept = without(named, gone, "left_anti")
    # Only rows that stand more than once have to meet their like.
    once = without(kept, repeated, "left_semi").dropDuplicates(["_pipeline.doc", "_pipeline.body"])
    return without(kept, repeated, "left_anti").unionByName(once).select(*[f"`{c}`" for c in docs.columns])


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that hold no item of ``benchmark``, word for word or within a fifth of its words in edits.

    Items of fewer than 8 words count word for word: one of a single common word takes every text that has it.
    """
    found = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"), out="_pipeline.leaks", short_items=True)
    return found.where(F.size("`_pipeline.leaks`") == 0).select(*[f"`{c}`" for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, token ids, their number, and whether they decode to the text again (NULL: as empty)."""
    coded = bpe.round_trip(docs.select("doc_id", "text"), tokenizer_path())
    same = F.col("coded.decoded") == F.coalesce("text", F.lit(""))
    return coded.select("doc_id", F.size("coded.ids").cast("long").alias("n_tokens"), "coded.ids", same.alias("round_trip"))


STAGES = [
    ("language_id", keep_known_languages),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
