"""Operators on hand-written tables: edge cases, skew paths, invariants."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow import constants as K
from corpusflow.operators import (
    audit, dedup, index, joins, language, lines, metrics, modeling, profile, quality, routing, sampling, vocab, windows,
)
from corpusflow.plans import catalog


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=repr)


def test_required_columns(spark):
    with pytest.raises(ValueError, match="absent"):
        quality.require_columns(spark.range(1), ["id", "absent"])
    with pytest.raises(ValueError):
        catalog.balance_report(spark.range(1))


def test_dotted_columns(spark):
    df = spark.createDataFrame([(1, "2020")], "id int, `album.release_date` string")
    assert quality.select_and_rename(df).columns == ["id", "Release_Date"]
    assert quality.reorder_columns(df).columns == df.columns
    assert rows(quality.null_profile(df)) == [("album.release_date", 0), ("id", 0)]
    assert quality.drop_empty_columns(df).columns == df.columns


def test_empty_columns_go_before_rows(spark):
    df = spark.createDataFrame([(1, None, 2.0), (2, None, float("nan"))], "a int, gone string, b double")
    filled = quality.drop_empty_columns(df)
    assert filled.columns == ["a", "b"]
    valid, invalid = quality.split_complete(filled)
    assert rows(valid, "a") == [(1,)] and rows(invalid, "a") == [(2,)]


def test_enrich_left_keeps_left_and_fans_out(spark):
    left = spark.createDataFrame([(1, "l"), (2, "m")], "id int, x string")
    right = spark.createDataFrame([(1, "r", 10), (1, "s", 11)], "id int, x string, y int")
    assert rows(joins.enrich_left(left, right, "id")) == [(1, "l", 10), (1, "l", 11), (2, "m", None)]


def test_enrich_left_deals_out_hot_right_keys(spark):
    """A third of the right rows on one key: no row changes, and no task gets them all."""
    left = spark.createDataFrame([(1, "l"), (1, "l"), (2, "m"), (3, "n"), (None, "o")], "id int, `a.b` string")
    right = spark.range(30_000).selectExpr("if(id % 3 = 0, 1, if(id % 3 = 1, cast(id as int), null)) AS id", "id AS y", "'r' AS `a.b`")
    cols = ["id", "`a.b`", "y"]
    want = rows(joins.enrich_left(left, right, "id", hot_rows=None), *cols)
    dealt = joins.enrich_left(left, right, "id", hot_rows=500)
    assert dealt.columns == ["id", "a.b", "y"] and rows(dealt, *cols) == want
    assert joins.hot_keys(right, "id", 500) == [("1", 21)]
    assert joins.enrich_left(left, right.limit(0), "id").count() == 5
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spread = joins.enrich_left(left.where("id = 1"), right, "id", 500).groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in spread) < 0.6 * 20_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_distinct_ids_are_stripped(spark):
    df = spark.createDataFrame([(" a",), ("a\t",), ("b",), ("",), ("  ",), ("NaN",), (None,)], "id string")
    assert rows(dedup.distinct_ids(df, "id")) == [("a",), ("b",)]


def test_missing_keys_match_nothing(spark):
    left = spark.createDataFrame([(None, "a"), ("1", "b")], "id string, x string")
    got = spark.createDataFrame([(None,), ("2",)], "id string")
    assert rows(joins.pending(left, got, "id")) == [("1", "b"), (None, "a")]
    assert rows(joins.reconcile(left, got, "id")) == [(0, 1, 1)]


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_dedup_survivor_does_not_depend_on_partitions(spark, partitions):
    data = [(i % 7, i, f" Song{i % 3} " if i % 2 else f"song{i % 3}") for i in range(500)]
    df = spark.createDataFrame(data, "k int, seq int, t string").repartition(partitions)
    assert rows(dedup.dedup_first(df, ["k"], ["seq"]), "k", "seq") == [(i, i) for i in range(7)]
    once = dedup.dedup_by_match_key(df, ["t"], ["seq"])
    assert rows(once, "seq") == [(0,), (1,), (2,)]
    assert rows(dedup.dedup_by_match_key(once, ["t"], ["seq"])) == rows(once)


def test_dedup_prunes_before_its_shuffle(spark):
    plan = dedup.dedup_first(spark.range(10).withColumn("k", F.col("id") % 2), ["k"], ["id"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    exchange = text.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in text[exchange:]


def test_admit_new_stops_at_target(spark):
    batch = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), ("c", 4), (None, 5), ("d", 6)], "k string, seq int")
    seen = spark.createDataFrame([("a",), ("a",)], "k string")
    assert rows(dedup.admit_new(batch, seen, "k", ["seq"])) == [("b", 2), ("c", 4), ("d", 6)]
    assert rows(dedup.admit_new(batch, seen, "k", ["seq"], target=3)) == [("b", 2), ("c", 4)]
    assert rows(dedup.admit_new(batch, seen, "k", ["seq"], target=1)) == []


def test_cap_numbers_keys_only(spark):
    df = spark.range(100).withColumn("wide", F.repeat(F.lit("x"), 1000)).repartition(5)
    assert sorted(r["id"] for r in dedup.cap(df, 30, ["id"]).collect()) == list(range(30))
    assert dedup.cap(df, 0, ["id"]).count() == 0 and dedup.cap(df, 500, ["id"]).count() == 100
    two = spark.createDataFrame([(None, 2), (1, 1), (1, 0), (0, 5)], "a int, b int")
    assert rows(dedup.cap(two, 3, ["a", "b"])) == sorted([(None, 2), (0, 5), (1, 0)], key=repr)


@pytest.mark.parametrize("partitions", [1, 6])
def test_indexes_match_row_number(spark, partitions):
    df = spark.range(1000).select("id", (F.col("id") % 3 == 0).alias("hot"), F.lit("x").alias("w")).repartition(partitions)
    got = {r["id"]: r["pos"] for r in index.dense_index(df, ["hot", "id"]).collect()}
    want = sorted(range(1000), key=lambda i: (i % 3 == 0, i))
    assert [got[i] for i in want] == list(range(1000))
    shuffled = index.hash_index(df, "id", seed=1)
    assert sorted(r["pos"] for r in shuffled.collect()) == list(range(1000))
    assert [r["id"] for r in shuffled.orderBy("pos").limit(5).collect()] != [0, 1, 2, 3, 4]
    again = index.hash_index(df.repartition(3), "id", seed=1)
    assert rows(again, "id", "pos") == rows(shuffled, "id", "pos")


def test_hash_index_keeps_rows_without_group(spark):
    df = spark.createDataFrame([(i, None if i % 2 else "g") for i in range(20)], "id int, g string")
    got = index.hash_index(df, "id", group="g", per_group=True)
    assert sorted(r["pos"] for r in got.filter("g is null").collect()) == list(range(10))
    assert sorted(r["pos"] for r in got.filter("g is not null").collect()) == list(range(10))


def test_hash_index_ranks_keys_in_buckets_and_scans_once(spark, tmp_path):
    df = spark.range(2_000).selectExpr("id", "id % 3 AS g", "repeat('x', 50) AS wide", "1 AS `a.b`")
    want = rows(index.hash_index(df, "id", group="g"), "id", "pos")
    got = index.hash_index(df, "id", group="g", bucket_rows=100)
    assert got.columns == ["id", "g", "wide", "a.b", "pos"] and rows(got, "id", "pos") == want
    df.write.parquet(str(tmp_path / "t"))
    read = spark.read.parquet(str(tmp_path / "t"))
    plan = index.hash_index(read, "id", group="g")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("wide#") and plan.count("Relation [id#") == 1
    assert index.hash_index(df.limit(0), "id").count() == 0


def test_index_has_no_wide_single_partition(spark):
    """The only one-partition exchange carries bucket counts, not rows."""
    plan = index.hash_index(spark.range(10), "id")._jdf.queryExecution().executedPlan().toString()
    single = plan.index("SinglePartition")
    assert "HashAggregate" in plan[single:single + 200]
    assert plan.count("SinglePartition") == 1


def test_running_progress(spark):
    log = spark.createDataFrame([("r", i, i % 4 != 0) for i in range(1, 131)] + [(None, 1, True)], "run string, seq int, ok boolean")
    out = index.running_progress(log, "run", "seq", F.col("ok"), every=50, width=16)
    got = rows(out, "run", "completed", "success", "fail", "total")
    assert got == sorted([("r", 50, 38, 12, 130), ("r", 100, 75, 25, 130), ("r", 130, 98, 32, 130), (None, 1, 1, 0, 1)], key=repr)


def test_running_progress_of_sparse_numbers(spark):
    """Arrival numbers as far apart as seconds: blocks follow ranks, over both levels of sums."""
    log = spark.createDataFrame([(r, 1_700_000_000 + 977 * i * i, i % 3 != 0) for i in range(300) for r in ("a", "b")], "run string, seq long, ok boolean")
    got = rows(index.running_progress(log, "run", "seq", F.col("ok"), every=100, width=4), "run", "completed", "success", "total")
    assert got == [(r, n, n - (n + 2) // 3, 300) for r in ("a", "b") for n in (100, 200, 300)]
    assert index.running_progress(log.limit(0), "run", "seq", F.col("ok")).count() == 0


def test_imbalance_and_absent_quadrants(spark):
    df = spark.createDataFrame([(0,)] * 3 + [(1,)] * 3 + [(2,)] * 3, "quadrant int")
    assert profile.imbalance(df).first()["imbalanced"] is False
    full = profile.imbalance(df, include_empty=True).first()
    assert (full["min_pct"], full["imbalanced"]) == (0.0, True)
    assert profile.imbalance(df.limit(0)).first()["imbalanced"] is False
    report = profile.distribution_report(df).collect()
    assert [(r["n"], r["bar_length"], r["bar"]) for r in report] == [(3, 20, "█" * 20)] * 3 + [(0, 0, "")]


def test_statuses(spark):
    log = [(K.STATUS_SUCCESS,), (K.STATUS_SKIP,), (K.STATUS_HTTP_ERROR + "_404",), (K.STATUS_NETWORK_ERROR + "_timeout",)]
    out = profile.status_rollup(spark.createDataFrame(log * 2, "Status string"))
    assert rows(out) == [(2, 2, 2, 2, 8)]


def test_r_squared_is_not_a_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0)], "y double, p double")
    assert df.agg(metrics.r_squared("y", "p").alias("r")).first()["r"] == -6.0


def test_audit(spark):
    log = audit.StageAudit(spark)
    out = log.stage("half", spark.range(10), lambda d: d.filter("id % 2 = 0"))
    out.write.format("noop").mode("overwrite").save()
    assert rows(log.table()) == [("half", 10, 5, 5)]


def test_join_lines_in_parts(spark):
    df = spark.createDataFrame([(1, i, f" l{i} " if i != 3 else " ") for i in range(7)] + [(2, 0, "")], "k int, o int, t string")
    whole = joins_text(lines.join_lines(df, "k", "o", "t"))
    parts = joins_text(lines.join_lines(df, "k", "o", "t", lines_per_part=2))
    assert whole[1] == "l0\nl1\nl2\nl4\nl5\nl6" and whole[2] == K.NO_TEXT
    assert "\n".join(parts[(1, p)] for p in range(4)) == whole[1]


def test_join_lines_takes_any_line_numbers(spark):
    df = spark.createDataFrame([(1, n, f"l{n}") for n in (9_999, 10_000, 1_700_000_000, -5)], "k int, o long, t string")
    want = "l-5\nl9999\nl10000\nl1700000000"
    assert joins_text(lines.join_lines(df, "k", "o", "t")) == {1: want}
    assert joins_text(lines.join_lines(df, "k", "o", "t", lines_per_part=3)) == {(1, 0): want.rpartition("\n")[0], (1, 1): "l1700000000"}


def joins_text(df):
    return {((r["k"], r["part"]) if "part" in df.columns else r["k"]): r["t"] for r in df.collect()}


def test_weights_leave_out_rows_without_a_label(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "id int, c string")
    got = {r["id"]: r["weight"] for r in profile.attach_class_weights(df, "c").collect()}
    assert got == {1: 0.75, 2: 0.75, 3: 1.5, 4: None}


def test_cross_fit_takes_its_folds_from_the_data(spark):
    df = spark.range(100).select("id", (F.col("id") % 10).cast("int").alias("fold"), (F.col("id") / 100).alias("x"))
    df = df.withColumns({"v": F.col("x"), "e": 1 - F.col("x")})
    got = modeling.cross_fit(df, ["x"], ("v", "e"), keep=["id"]).collect()
    assert sorted(r["id"] for r in got) == list(range(100))
    assert all(abs(r["p_v"] - r["y_v"]) < 1e-6 and abs(r["p_e"] - r["y_e"]) < 1e-6 for r in got)
    with pytest.raises(ValueError):
        modeling.cross_fit(df.withColumn("fold", F.when(F.col("id") > 0, F.col("fold"))), ["x"], ("v", "e"))


def test_cross_fit_rows_that_teach_nothing(spark):
    data = [(i, i % 2, i / 40, 3.0, 2 * i / 40, i / 40, None if i in (4, 5) else i / 40, 1.0 - i / 40, None if i == 7 else 1.0) for i in range(40)]
    df = spark.createDataFrame(data, "id int, fold int, x double, c double, x2 double, x3 double, v double, e double, w double")
    # A constant feature and repeated ones: the fit is the same line.
    got = modeling.cross_fit(df, ["x", "c", "x2", "x3"], ("v", "e"), weight="w", keep=["id"]).collect()
    assert len(got) == 40 and all(abs(r["p_v"] - r["id"] / 40) < 1e-6 and abs(r["p_e"] - 1 + r["id"] / 40) < 1e-6 for r in got)
    alone = modeling.cross_fit(df.filter("fold = 0"), ["x"], ("v", "e")).collect()
    assert len(alone) == 20 and all(r["p_v"] is None for r in alone)
    assert modeling.cross_fit(df.limit(0), ["x"], ("v", "e")).count() == 0
    with pytest.raises(ValueError):
        modeling.cross_fit(df, ["w"], ("v", "e"))


def test_mixup_keeps_rows_without_a_key_and_dotted_names(spark):
    df = spark.createDataFrame([(1, [1.0], "p"), (None, [2.0], "q"), (None, [3.0], "r")], "k int, v array<double>, `a.b` string")
    got = sorted((r["k"] or 0, r["v"], r["a.b"], r["batch"]) for r in sampling.mixup(df, "k", ["v"], lam=0.5).collect())
    assert [g[:3] for g in got] == [(0, [2.0], "q"), (0, [3.0], "r"), (1, [1.0], "p")] and got[0][3] is None


def test_coverage_of_dotted_names(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "id int, `a.b` string")
    row = profile.coverage(df, ["a.b", "zz"]).first().asDict()
    assert row["n_rows"] == 2 and row["n_a.b"] == 1 and row["n_zz"] == 0


def test_work_folder_off_local_masters(spark, monkeypatch):
    from types import SimpleNamespace

    from corpusflow import session

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    fake = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: None))
    with pytest.raises(RuntimeError):
        session.work_root(fake)


def test_vocab_and_encoding(spark):
    df = spark.createDataFrame([(2, "b a mất"), (1, "c b c"), (3, ""), (4, None), (5, "a mất zzz")], "id int, t string")
    words = vocab.stored_vocab(df, "id", "t")
    assert rows(words, "token", "token_id", "freq") == [("a", 4, 2), ("b", 3, 2), ("c", 2, 2), ("mất", 5, 2)]
    out = {r["id"]: (r["ids"], r["tones"]) for r in vocab.encode(df, "id", "t", words, 4).collect()}
    assert out == {
        1: ([2, 3, 2, 0], [1, 1, 1, 0]), 2: ([3, 4, 5, 0], [1, 1, 3, 0]), 3: ([0] * 4, [0] * 4),
        4: ([0] * 4, [0] * 4), 5: ([4, 5, 1, 0], [1, 3, 1, 0]),
    }
    text_keys = df.withColumn("id", F.format_string("%03d", "id"))
    assert rows(vocab.build_vocab(text_keys, "id", "t")) == rows(words)
    assert vocab.with_reserved(words).filter("token_id < 2").count() == 2


def test_encoding_with_a_vocabulary_too_large_to_broadcast(spark, monkeypatch):
    df = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(i % 9))) for i in range(40)], "id int, t string")
    words = vocab.stored_vocab(df, "id", "t")
    small = rows(vocab.encode(df, "id", "t", words, 5))
    windows = rows(vocab.encode_windows(df, "id", "t", words, 3))
    monkeypatch.setattr(vocab, "LOOKUP_TOKENS", 3)
    monkeypatch.setattr(vocab, "BROADCAST_BYTES", 10)
    monkeypatch.setattr(vocab, "HEAD_TOKENS", 2)
    assert rows(vocab.encode(df, "id", "t", words, 5)) == small
    assert rows(vocab.encode_windows(df, "id", "t", words, 3)) == windows


def test_windows_hold_whole_texts_without_a_shuffle(spark):
    df = spark.createDataFrame([(1, "a b a b a"), (2, ""), (3, None), (4, "a b c"), (5, "a")], "id int, t string")
    words = vocab.stored_vocab(df, "id", "t")
    out = vocab.encode_windows(df, "id", "t", words, 3)
    assert rows(out, "id", "part", "ids") == [
        (1, 0, [2, 3, 2]), (1, 1, [3, 2, 0]), (2, 0, [0, 0, 0]), (3, 0, [0, 0, 0]), (4, 0, [2, 3, 1]), (5, 0, [2, 0, 0])]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert rows(vocab.encode(df, "id", "t", words.limit(0), 2), "id", "ids")[0] == (1, [1, 1])
    assert vocab.encode_windows(df.limit(0), "id", "t", words).count() == 0


def test_vocabulary_of_text_keys_sorts_no_tokens(spark):
    df = spark.createDataFrame([("b", "x y x"), (None, "z y"), ("a", "w x z w")], "id string, t string")
    words = vocab.build_vocab(df, "id", "t")
    # The text without a key comes first.
    assert rows(words, "token_id", "token", "freq") == [(2, "z", 2), (3, "y", 2), (4, "w", 2), (5, "x", 3)]
    assert dict(words.dtypes)["token_id"] == "bigint"
    numbered = vocab._numbered(df, "id")
    assert rows(numbered, "_doc", "id") == [(0, None), (1, "a"), (2, "b")]


def _toy_languages(spark):
    data = [(1, "the cat the dog the", "en"), (2, "le chat le chien le", "fr"), (3, "der hund der", "de")]
    return spark.createDataFrame(data, "id int, t string, lang string")


def test_language(spark, monkeypatch):
    profiles = language.fit_language_profiles(_toy_languages(spark), "t", "lang")
    assert profiles.languages == ["de", "en", "fr"]
    texts = [(1, "the the"), (2, "le le"), (3, None), (4, ""), (5, "♪"), (6, "123 !?"), (7, "x" * 400 + " le chien le chien"), (8, "der")]
    df = spark.createDataFrame(texts, "id int, t string")
    got = dict(rows(language.detect_language(df, "id", "t", profiles)))
    assert {k: got[k] for k in (1, 2, 3, 4, 5, 6, 8)} == {1: "en", 2: "fr", 3: "unknown", 4: "unknown", 5: "unknown", 6: "unknown", 8: "de"}
    sampled = dict(rows(language.detect_language(df, "id", "t", profiles, sample_chars=300)))
    plain = spark.createDataFrame([(7, "x" * 300)], "id int, t string")
    assert sampled[7] == dict(rows(language.detect_language(plain, "id", "t", profiles)))[7]
    monkeypatch.setattr(language, "BROADCAST_BYTES", 0)
    assert dict(rows(language.detect_language(df, "id", "t", profiles))) == got


def test_language_against_brute_force(spark):
    data = _toy_languages(spark).collect()
    import math
    import re
    from collections import Counter

    def grams(t):
        t = " " + re.sub(r"[^a-z]+", " ", t).strip() + " "
        return [t[i:i + 3] for i in range(len(t) - 2)]

    counts = {r["lang"]: Counter(grams(r["t"])) for r in data}
    distinct = len(set().union(*counts.values()))
    sizes = {l: sum(c.values()) + distinct for l, c in counts.items()}
    texts = ["the chat", "le hund dog", "der cat", "chien the le", "unddog"]

    def best(t):
        score = {l: sum(round(math.log((c[g] + 1) / sizes[l]) * 1e6) for g in grams(t)) for l, c in counts.items()}
        return min(score, key=lambda l: (-score[l], l))

    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    profiles = language.fit_language_profiles(_toy_languages(spark), "t", "lang")
    assert dict(rows(language.detect_language(df, "id", "t", profiles))) == {i: best(t) for i, t in enumerate(texts)}


def test_language_is_settled_in_the_row(spark):
    profiles = language.fit_language_profiles(_toy_languages(spark), "t", "lang")
    df = spark.createDataFrame([(1, "the the", "x"), (1, "le le", "y"), (None, "der der", "z"), (None, None, "z")], "id int, t string, language string")
    found = language.with_language(df, "t", profiles)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert rows(found) == sorted([(1, "the the", "en"), (1, "le le", "fr"), (None, "der der", "de"), (None, None, "unknown")], key=repr)
    assert language.with_language(df.limit(0), "t", profiles).count() == 0
    nothing = language.fit_language_profiles(_toy_languages(spark).limit(0), "t", "lang")
    assert {r["language"] for r in language.with_language(df, "t", nothing).collect()} == {"unknown"}


def test_direct_address_table_finds_every_trigram():
    import numpy as np

    rng = np.random.default_rng(3)
    grams = np.unique(rng.integers(0, 1 << 62, 5000))
    table = language.GramTable(grams, np.arange(len(grams)).reshape(-1, 1), [-7])
    assert (table.scores[0][table.place(grams)] == np.arange(len(grams))).all()
    others = np.setdiff1d(rng.integers(0, 1 << 62, 1000), grams)
    assert (table.scores[0][table.place(others)] == -7).all()
    assert table.best(np.concatenate([grams[:3], others[:4]]), np.array([0, 3, 7])).tolist() == [-1, 0, -1]
    texts = ["", "ab", "abc", "日本語x", "𝔘𝔫𝔦"]
    packed, ends = language.packed_trigrams(texts)
    want = [t[i : i + 3] for t in texts for i in range(len(t) - 2)]
    assert ["".join(chr(g >> s & 0x1FFFFF) for s in (42, 21, 0)) for g in packed.tolist()] == want and ends.tolist() == [0, 0, 1, 3, 4]


def test_routes_add_up(spark):
    data = [("1", "Best of", "a"), ("2", "x", None), ("3", "x", " "), ("4", "x", "(a)\n(b)\n(c)"), ("5", "x", "the cat the"),
            ("6", None, "le chien le"), (None, "x", "the dog the"), (None, "x", "le chat le"), ("5", "x", "le chat le")]
    df = spark.createDataFrame(data, "Spotify_ID string, Track_Name string, Lyrics string")
    profiles = language.fit_language_profiles(_toy_languages(spark), "t", "lang")
    titles = df.select("Spotify_ID", "Track_Name").filter("Spotify_ID is not null").dropDuplicates(["Spotify_ID"])
    routed = catalog.filter_texts(df.drop("Track_Name"), titles, profiles, "en")
    got = rows(routed, "Spotify_ID", "Lyrics", "route", "reason")
    assert got == sorted([
        ("1", "a", "compilation", "title"), ("2", K.NO_TEXT, "no_text", "no text"), ("3", " ", "no_text", "no text"),
        ("4", "(a)\n(b)\n(c)", "compilation", "markers"), ("5", "the cat the", "kept", None),
        ("6", "le chien le", "foreign", "language fr"), (None, "the dog the", "kept", None),
        (None, "le chat le", "foreign", "language fr"), ("5", "le chat le", "foreign", "language fr")], key=repr)
    parts = routing.split_routes(routed)
    assert sum(p.count() for p in parts.values()) == len(data)


def test_balanced_sample_is_balanced_and_salted(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") == 0, "rare").when(F.col("id") < 300, "mid").otherwise("hot").alias("c"))
    out = sampling.balanced_sample(df, "id", "c", n=3000)
    counts = {r["c"]: r["n"] for r in out.groupBy("c").agg(F.count("*").alias("n")).collect()}
    assert sum(counts.values()) == 3000 and all(850 < n < 1150 for n in counts.values())
    salted = sampling.balanced_sample(df.repartition(7), "id", "c", n=3000, draws_per_key=3)
    assert rows(salted) == rows(out)
    assert out.select("draw").distinct().count() == 3000


def test_folds_are_even(spark):
    df = spark.range(503).select("id", (F.col("id") % 7 % 3).alias("c"))
    out = sampling.stratified_folds(df, "id", "c", k=5)
    sizes = [r["n"] for r in out.groupBy("fold").agg(F.count("*").alias("n")).collect()]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == 503
    for c in range(3):
        n = [r["n"] for r in out.filter(F.col("c") == c).groupBy("fold").agg(F.count("*").alias("n")).collect()]
        assert max(n) - min(n) <= 1
    train, test = sampling.fold_split(out, 0)
    assert train.count() + test.count() == 503


def test_mixup(spark):
    df = spark.range(10).select("id", F.array(F.col("id") * 1.0).alias("x"), F.lit("t").alias("t"))
    out = sampling.mixup(df, "id", ["x"], size=4).collect()
    assert len(out) == 10 and {r["t"] for r in out} == {"t"}
    for r in out:
        assert r["batch"] == r["id"] // 4 + 1 == r["partner"] // 4 + 1
        assert r["x"][0] == pytest.approx(r["lam"] * r["id"] + (1 - r["lam"]) * r["partner"])
    assert len({r["lam"] for r in out}) == 3
    assert sorted(r["partner"] for r in out) == list(range(10))
    same = sampling.mixup(df, "id", ["x"], size=4, alpha=0).collect()
    assert all(r["x"] == [float(r["id"])] for r in same)


def test_eval_batches(spark):
    assert sampling.eval_batches(spark.range(10), "id", 4).count() == 10
    assert sampling.eval_batches(spark.range(10), "id", 4, drop_last=True).count() == 8


def test_windows_against_brute_force(spark):
    data = [("a", t, float(t)) for t in (0, 5, 9, 10, 31, 59)] + [("b", 7, 1.0)]
    df = spark.createDataFrame(data, "k string, s int, v double").withColumn("ts", F.timestamp_seconds("s"))
    out = windows.multires_windows(df, "ts", [10, 20], ["k"], "v", floor=40)
    want = []
    for hop, size in ((10, 40), (20, 80)):
        for key in ("a", "b"):
            for start in range(-100, 100, hop):
                v = [x for k, t, x in data if k == key and start <= t < start + size]
                if v:
                    want.append((key, hop, start, len(v), sum(v), max(v)))
    got = out.select("k", "hop", F.unix_seconds("w_start").alias("s"), "n", "total", "top")
    assert rows(got) == sorted(want, key=repr)
    assert (windows.frame_size(256), windows.frame_size(512)) == (1024, 2048)


def test_cross_fit_against_least_squares(spark):
    rng = np.random.default_rng(0)
    x = rng.random((200, 2))
    v, e = 0.2 + 0.5 * x[:, 0] + 0.05 * rng.random(200), 0.1 + 0.3 * x[:, 1] + 0.05 * rng.random(200)
    w = 1 + rng.random(200)
    data = [(i, i % 5, float(x[i, 0]), float(x[i, 1]), float(v[i]), float(e[i]), float(w[i])) for i in range(200)]
    df = spark.createDataFrame(data, "id int, fold int, a double, b double, v double, e double, w double")
    out = modeling.cross_fit(df, ["a", "b"], ("v", "e"), weight="w", keep=["id"])
    got = {r["id"]: r for r in out.collect()}
    assert len(got) == 200
    train = np.arange(200) % 5 != 0
    design = np.c_[np.ones(200), x] * np.sqrt(w)[:, None]
    beta, *_ = np.linalg.lstsq(design[train], (v * np.sqrt(w))[train], rcond=None)
    for i in range(0, 200, 5):
        assert got[i]["p_v"] == pytest.approx(np.clip(beta @ np.r_[1, x[i]], 0, 1), abs=1e-6)
    assert metrics.fold_summary(out).first()["r2_v"] > 0.9


def test_fit_save_load_score(spark, tmp_path):
    df = spark.createDataFrame([(float(i), i / 10, 1 - i / 10) for i in range(10)], "x double, v double, e double")
    models = modeling.fit_final(df, ["x"], ("v", "e"))
    words = spark.createDataFrame([("a", 2, 3)], "token string, token_id int, freq long")
    modeling.save_model(spark, models, str(tmp_path / "m"), vocab.with_reserved(words), {"length": 200})
    loaded, config = modeling.load_model(spark, str(tmp_path / "m"))
    assert config == {"length": 200}
    assert spark.read.parquet(str(tmp_path / "m" / "vocab")).count() == 3
    out = {r["x"]: (r["quadrant"], r["quadrant_name"]) for r in modeling.score(df, loaded).collect()}
    assert out[9.0] == (2, K.QUADRANT_NAMES[2]) and out[0.0] == (1, K.QUADRANT_NAMES[1])


def test_staged_tables_are_deleted_together(spark):
    import os

    from corpusflow import session

    path = session.work_path(spark, "one").removeprefix("file:")
    session.stage(spark.range(3), "two")
    folder = os.path.dirname(path)
    assert any(name.startswith("two-") for name in os.listdir(folder))
    session.clear_work(spark)
    assert not os.path.exists(folder)
