"""The registered queries of this package, with their SQL where SQL can express them."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm import (
    bpe, decontaminate, hard_negatives, jaccard, language_id, lexical, line_dedup, prefix_bpe, sharding, token_counts,
    toxicity, warc,
)
from corpusflow.llm import quality_cascade as quality

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_warc")
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.read_archives(warc.archive_pages(table(spark, sf_dir, "pages")))
    return records.select(
        F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query("op2_sharding")
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        "lang",
        "source",
    )
    category = lambda c: F.crc32(F.coalesce(c, F.lit("")).cast("binary")) % 65536
    dims = [F.col("size"), category("source"), category("lang"), F.col("doc_id")]
    placed = sharding.kd_shards(docs, F.col("size"), dims, [F.col("doc_id"), F.col("text_crc32")], 24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op3_bpe")
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.round_trip(docs, tokenizer_path())
    return coded.select(
        "doc_id",
        F.size("coded.ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("coded.ids", ","), 256).alias("ids_sha256"),
        F.sha2(F.col("coded.decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op4_decontamination")
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"), short_items=True)
    return found.select(
        "doc_id",
        (F.size("leaks") > 0).alias("contaminated"),
        F.col("leaks.item").alias("item_ids"),
        F.array_min("leaks.edits").alias("least_edits"),
    )


@query("op5_language_id")
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    rest = language_id.fold(F.col("doc_id"), 3)
    model = language_id.fit_model(docs.where(rest != 1), "text", "lang")
    found = language_id.identify_languages(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id",
        F.coalesce(rest == 1, F.lit(True)).alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"),
        F.size("language.spans").alias("n_spans"),
    )


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    rest = language_id.fold(F.col("doc_id"), 4)
    model = toxicity.fit_toxicity(docs, labels.where(rest != 2))
    scored = toxicity.score_toxicity(docs, model, out="score")
    return scored.select(
        "doc_id",
        F.coalesce(rest == 2, F.lit(True)).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


@query("op7_jaccard_join")
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query(
    "op8_quality_cascade",
    r"""
    WITH w AS (
        SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS t,
               [x FOR x IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS words
        FROM documents),
    wins AS (SELECT row_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win
             FROM (SELECT row_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
    twice AS (SELECT row_id, i FROM (SELECT *, count(*) OVER (PARTITION BY row_id, win) AS n FROM wins) WHERE n > 1),
    covered AS (SELECT row_id, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY row_id),
    lines AS (SELECT row_id, count(*) - count(DISTINCT line) AS n
              FROM (SELECT row_id, unnest(string_split(t, chr(10))) AS line FROM w)
              WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row_id),
    m AS (
        SELECT doc_id, len(words)::BIGINT AS n_words,
               length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
               (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
               coalesce(l.n, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
               len(string_split(t, chr(10))) AS n_lines
        FROM w LEFT JOIN covered c USING (row_id) LEFT JOIN lines l USING (row_id)),
    b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT (base_failed OR 100 * n_symbols > 30 * n_words OR 100 * n_dup_lines > 50 * n_lines
                OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
    FROM b
    """,
)
def op8_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    text = F.col("text")
    order = [m.rule.name for m in quality.measure_rules(docs, quality.standard_rules(text), ["text"])]
    # The counts are wanted of every row, so the rules read them instead of the text.
    counts = quality.text_counts(text)
    counted = docs.select("doc_id", *[c.alias(name) for name, c in counts.items()])
    rules = quality.rules_on({name: F.col(name) for name in counts})
    judged = quality.apply_cascade(counted, sorted(rules, key=lambda r: order.index(r.name)))
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), F.col("rejected_by").isNull().alias("kept"),
    )


@query(
    "op9_line_dedup",
    """
    WITH cut AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL),
    lines AS (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos FROM cut),
    firsts AS (SELECT line, min(row(doc_id, pos)) AS first_at FROM lines WHERE length(trim(line, ' ')) >= 20 GROUP BY line),
    halves AS (
        SELECT DISTINCT line, first_at, p, side, CASE WHEN side = 'front' THEN left(line, p) ELSE right(line, p) END AS half
        FROM (SELECT line, first_at, unnest([length(line) // 2, (length(line) - 1) // 2]) AS p FROM firsts),
             (SELECT unnest(['front', 'back']) AS side)),
    near AS (
        SELECT DISTINCT b.line FROM halves a JOIN halves b USING (p, side, half)
        WHERE a.first_at < b.first_at AND abs(length(a.line) - length(b.line)) <= 1 AND levenshtein(a.line, b.line) = 1),
    judged AS (
        SELECT l.doc_id, l.pos, l.line,
               f.line IS NOT NULL AND (row(l.doc_id, l.pos) <> f.first_at OR l.line IN (SELECT line FROM near)) AS gone
        FROM lines l LEFT JOIN firsts f USING (line))
    SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.kept, '') END AS text,
           coalesce(k.n, 0)::BIGINT AS dropped_lines
    FROM documents d LEFT JOIN (
        SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone) AS kept, count(*) FILTER (gone) AS n
        FROM judged GROUP BY doc_id) k USING (doc_id)
    """,
)
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op10_token_counts")
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counted = token_counts.count_tokens(docs.select("doc_id", "text"), tokenizer_path())
    return counted.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > 512).alias("over_limit"),
    )


@query(
    "op11_lexical_search",
    rf"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                      regexp_extract_all(translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{lexical.TERM}') AS ts
               FROM documents WHERE text IS NOT NULL),
    sizes AS (SELECT r, doc_id, len(ts) AS n FROM d WHERE len(ts) > 0),
    total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes),
    tfs AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ts) AS t FROM d) GROUP BY r, t),
    weights AS (SELECT t, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tfs, total GROUP BY t, docs),
    asked AS (SELECT DISTINCT item_id, text,
                     unnest(regexp_extract_all(translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{lexical.TERM}')) AS t
              FROM benchmark),
    scores AS (SELECT item_id, text, r, doc_id,
                      sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))))::BIGINT AS score
               FROM asked JOIN tfs USING (t) JOIN weights USING (t) JOIN sizes USING (r), total
               GROUP BY item_id, text, r, doc_id)
    SELECT item_id, (row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score
    FROM scores WHERE score > 0 QUALIFY rank <= 10
    """,
)
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical.search(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


@query("op12_prefix_bpe")
def op12_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = prefix_bpe.round_trip(docs, tokenizer_path("byte_bpe_multi_50k.tiktoken"))
    return coded.select(
        "doc_id",
        F.size("coded.ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("coded.ids", ","), 256).alias("ids_sha256"),
        F.sha2(F.col("coded.decoded"), 256).alias("decoded_sha256"),
    )


@query(
    "op13_hard_negatives",
    """
    WITH e AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
        FROM (SELECT * FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
    c AS (SELECT vec_id, label, unnest(v) AS x, unnest(range(len(v))) AS k FROM e),
    s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike, sum(a.x * b.x)::BIGINT AS score
          FROM c a JOIN c b USING (k) WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id GROUP BY ALL),
    p AS (SELECT * FROM s WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT p.anchor_id, p.vec_id AS positive_id,
           (row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id))::INT AS rank,
           n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
    FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.alike AND 80 * p.score <= 100 * n.score AND n.score <= p.score
    QUALIFY rank <= 5
    """,
)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_hard_negatives(
        vectors, F.col("vec_id"), F.col("embedding"), moved, F.col("id") % 100 == 0
    )
