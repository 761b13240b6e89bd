"""Tokens, tones, vocabulary, language and routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow import constants as K
from corpusflow.functions import text
from corpusflow.operators import language, routing, vocab
from workload.cleaning import KEYWORDS
from workload.registry import documents, query, table

# Independent of the Spark side: punctuation to blanks, then split on blanks.
TOKENS = r"""list_filter(string_split_regex(regexp_replace(lower(text), '[^\p{L}\p{N}_\s]', ' ', 'g'), '\s+'),
                         lambda t: t <> '')"""


@query(
    "tokenize",
    f"""WITH t AS (SELECT doc_id, {TOKENS} AS toks FROM documents)
        SELECT doc_id, CAST(len(toks) AS INTEGER) AS n, md5(array_to_string(toks, ' ')) AS digest FROM t""",
)
def tokenize(spark, sf):
    toks = documents(spark, sf).select("doc_id", text.tokenize("text").alias("toks"))
    return toks.select(
        "doc_id", F.size("toks").alias("n"), F.md5(F.array_join("toks", " ")).alias("digest")
    )


def tone_sql(token: str) -> str:
    first = f"regexp_extract({token}, '[{''.join(K.TONE_LETTERS)}]')"
    cases = " ".join(f"WHEN {first} <> '' AND contains('{g}', {first}) THEN {i}" for i, g in enumerate(K.TONE_LETTERS, 1))
    return f"CASE {cases} ELSE 0 END"


@query(
    "tones",
    f"""WITH t AS (SELECT doc_id, unnest({TOKENS}) AS tok FROM documents)
        SELECT doc_id, {tone_sql("tok")} + 1 AS tone, count(*) AS n FROM t GROUP BY 1, 2""",
)
def tones(spark, sf):
    docs = documents(spark, sf)
    rows = docs.select("doc_id", F.explode(text.tones(text.tokenize("text"))).alias("tone"))
    return rows.groupBy("doc_id", "tone").agg(F.count("*").alias("n"))


@query(
    "token_frequency",
    f"SELECT token, count(*) AS freq FROM (SELECT unnest({TOKENS}) AS token FROM documents) GROUP BY 1",
)
def token_frequency(spark, sf):
    return vocab.token_frequency(documents(spark, sf), "text")


def vocab_sql(tokens: str = TOKENS, source: str = "documents") -> str:
    return f"""tk AS (SELECT doc_id, {tokens} AS toks FROM {source}),
        px AS (SELECT doc_id, unnest(toks) AS token, unnest(range(len(toks))) AS pos FROM tk),
        vc AS (SELECT token, count(*) AS freq, min((doc_id, pos)) AS first FROM px GROUP BY 1 HAVING count(*) >= 2),
        vocab AS (SELECT token, row_number() OVER (ORDER BY first) + 1 AS token_id, freq FROM vc)"""


@query(
    "build_vocab_text_keys",
    f"WITH {vocab_sql(source="(SELECT printf('%012d', 1000000 - doc_id) AS doc_id, text FROM documents)")} SELECT * FROM vocab",
)
def build_vocab_text_keys(spark, sf):
    """Keys that are texts, in an order of their own."""
    docs = documents(spark, sf).withColumn("name", F.format_string("%012d", 1_000_000 - F.col("doc_id")))
    return vocab.build_vocab(docs, "name", "text")


@query("build_vocab", f"WITH {vocab_sql()} SELECT * FROM vocab")
def build_vocab(spark, sf):
    return vocab.build_vocab(documents(spark, sf), "doc_id", "text")


ENCODED = f"""en AS (SELECT p.doc_id, p.pos, coalesce(v.token_id, 1) AS id, {tone_sql("p.token")} + 1 AS tone
                     FROM px p LEFT JOIN vocab v ON v.token = p.token WHERE p.pos < 200),
        ag AS (SELECT doc_id, string_agg(id, ',' ORDER BY pos) AS ids, string_agg(tone, ',' ORDER BY pos) AS tones,
                      count(*) AS n FROM en GROUP BY 1),
        full_ag AS (SELECT doc_id, coalesce(ids, '') AS ids, coalesce(tones, '') AS tones, coalesce(n, 0) AS n
                    FROM tk LEFT JOIN ag USING (doc_id)),
        encoded AS (SELECT doc_id, trim(ids || repeat(',0', CAST(200 - n AS INTEGER)), ',') AS ids,
                           trim(tones || repeat(',0', CAST(200 - n AS INTEGER)), ',') AS tones FROM full_ag)"""


@query("encode", f"WITH {vocab_sql()}, {ENCODED} SELECT * FROM encoded")
def encode(spark, sf):
    docs = documents(spark, sf).select("doc_id", "text")
    words = vocab.stored_vocab(docs, "doc_id", "text")
    out = vocab.encode(docs, "doc_id", "text", words)
    return out.select(
        "doc_id", *[F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c) for c in ("ids", "tones")]
    )


WINDOWS = f"""en AS (SELECT p.doc_id, p.pos // 200 AS part, p.pos, coalesce(v.token_id, 1) AS id, {tone_sql("p.token")} + 1 AS tone
               FROM px p LEFT JOIN vocab v ON v.token = p.token),
        ag AS (SELECT doc_id, part, string_agg(id, ',' ORDER BY pos) AS ids, string_agg(tone, ',' ORDER BY pos) AS tones,
                      count(*) AS n FROM en GROUP BY 1, 2),
        full_ag AS (SELECT doc_id, coalesce(part, 0) AS part, coalesce(ids, '') AS ids, coalesce(tones, '') AS tones,
                           coalesce(n, 0) AS n FROM tk LEFT JOIN ag USING (doc_id)),
        windows AS (SELECT doc_id, part, trim(ids || repeat(',0', CAST(200 - n AS INTEGER)), ',') AS ids,
                           trim(tones || repeat(',0', CAST(200 - n AS INTEGER)), ',') AS tones FROM full_ag)"""


@query("encode_windows", f"WITH {vocab_sql()}, {WINDOWS} SELECT * FROM windows")
def encode_windows(spark, sf):
    """Whole texts, window by window."""
    docs = documents(spark, sf).select("doc_id", "text")
    out = vocab.encode_windows(docs, "doc_id", "text", vocab.stored_vocab(docs, "doc_id", "text"))
    return out.select(
        "doc_id", "part",
        *[F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c) for c in ("ids", "tones")],
    )


def language_sql(source: str, key: str) -> str:
    """Add-one trigram model of documents.lang, applied to the texts of ``source``."""
    chars = r"string_split(' ' || trim(regexp_replace(lower(text), '[^\p{L}]+', ' ', 'g')) || ' ', '')"
    grams = "list_transform(range(1, len(c) - 1), lambda i: c[i] || c[i + 1] || c[i + 2])"
    return f"""dg AS (SELECT lang, unnest({grams}) AS gram FROM (SELECT lang, {chars} AS c FROM documents) WHERE len(c) > 2),
        ct AS (SELECT lang, gram, count(*) AS n FROM dg GROUP BY 1, 2),
        sz AS (SELECT lang, sum(n) + (SELECT count(DISTINCT gram) FROM ct) AS size FROM ct GROUP BY 1),
        sg AS (SELECT k, gram, count(*) AS m FROM
                 (SELECT k, unnest({grams}) AS gram FROM (SELECT {key} AS k, {chars} AS c FROM {source}) WHERE len(c) > 2)
               GROUP BY 1, 2),
        sc AS (SELECT k, sz.lang, sum(m * CAST(round(ln((coalesce(n, 0) + 1) / CAST(size AS DOUBLE)) * 1000000) AS BIGINT)) AS s
               FROM sg CROSS JOIN sz LEFT JOIN ct ON ct.lang = sz.lang AND ct.gram = sg.gram GROUP BY 1, 2),
        kn AS (SELECT k, 2 * coalesce(sum(m) FILTER (gram IN (SELECT gram FROM ct)), 0) < sum(m) AS strange FROM sg GROUP BY 1),
        best AS (SELECT k, CASE WHEN strange THEN 'unknown' ELSE lang END AS language FROM sc JOIN kn USING (k) QUALIFY row_number() OVER (PARTITION BY k ORDER BY s DESC, lang) = 1)"""


@query(
    "detect_language",
    f"""WITH {language_sql("documents", "doc_id")}
        SELECT doc_id, coalesce(language, 'unknown') AS language FROM documents LEFT JOIN best ON k = doc_id""",
)
def detect_language(spark, sf):
    docs = documents(spark, sf)
    profiles = language.fit_language_profiles(docs, "text", "lang")
    return language.detect_language(docs, "doc_id", "text", profiles)


@query(
    "detect_language_unlabelled",
    f"""WITH {language_sql("conversations", "conv_id * 100000 + turn")}
        SELECT conv_id * 100000 + turn AS turn_id, coalesce(language, 'unknown') AS language
        FROM conversations LEFT JOIN best ON k = conv_id * 100000 + turn""",
)
def detect_language_unlabelled(spark, sf):
    profiles = language.fit_language_profiles(documents(spark, sf), "text", "lang")
    turns = table(spark, sf, "conversations").withColumn("turn_id", F.col("conv_id") * 100000 + F.col("turn"))
    return language.detect_language(turns, "turn_id", "text", profiles)


@query(
    "route_by_language",
    r"""SELECT d.doc_id,
               CASE WHEN hit THEN 'compilation' WHEN l.doc_id IS NULL THEN 'no_text'
                    WHEN len > 6000 THEN 'compilation' WHEN lang = 'fr' THEN 'kept' ELSE 'foreign' END AS route,
               CASE WHEN hit THEN 'title' WHEN l.doc_id IS NULL THEN 'no text'
                    WHEN len > 6000 THEN 'length' WHEN lang <> 'fr' THEN 'language ' || lang END AS reason
        FROM (SELECT doc_id, lang, length(regexp_replace(text, '^\s+|\s+$', '', 'g')) AS len,
                     p_name LIKE '%red %' OR p_name LIKE '% ring%' OR p_name LIKE '%blue widget%' AS hit
              FROM documents LEFT JOIN part ON p_partkey = doc_id) d LEFT JOIN labels l USING (doc_id)""",
)
def route_by_language(spark, sf):
    """Routes with the language given; texts without a label count as missing."""
    titles = table(spark, sf, "part").select(F.col("p_partkey").alias("doc_id"), "p_name")
    known = table(spark, sf, "labels").select("doc_id", F.lit(True).alias("known"))
    docs = documents(spark, sf).join(titles, "doc_id", "left").join(known, "doc_id", "left")
    docs = docs.withColumn("text", F.when(F.col("known"), F.col("text")))
    routed = routing.route_by_language(routing.content_route(docs, "p_name", "text", KEYWORDS), "fr", "lang")
    return routed.select("doc_id", "route", "reason")
