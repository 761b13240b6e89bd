"""The whole flow on a small hand-written catalogue."""

import pytest
from pyspark.sql import functions as F

from corpusflow import constants as K
from corpusflow.operators.language import fit_language_profiles
from corpusflow.plans import catalog, training

VI = ["một ngày mới đã đến rồi em ơi", "tôi yêu em nhiều lắm", "đường về nhà thật xa", "mưa rơi trên phố vắng"]
EN = ["the rain falls on the street", "i love you so much my dear", "the road back home is long"]


@pytest.fixture(scope="module")
def meta(spark):
    schema = "seq int, id string, name string, artists string, popularity string, duration_ms string, preview_url string, `album.release_date` string"
    return spark.createDataFrame([
        (1, " s1 ", "Mưa", "[{'name': 'Lan'}, {'name': 'Hà'}]", "50", "1000", "http://x/1", "2020"),
        (2, "s1", "Mưa (again)", "[{'name': 'Lan'}]", "51", "1", "http://x/1b", "2021"),
        (3, "s2", " mưa", "[{'profile': {'name': 'lan'}}, {'name': 'HÀ '}]", "1", "1", None, "2020"),
        (4, "s3", "Đường", "Minh", "n/a", "2000", "https://x/3", "2019"),
        (5, "nan", "Lost", "X", "1", "1", None, None),
        (6, "s4", None, "X", "1", "1", None, None),
        (7, "s5", "Street", "[{'name': 'Bob'}]", "30", "3000", "ftp://x", "2018"),
        (8, "s6", "Liên Khúc 2", "Y", "5", "4000", "http://x/6", "2017"),
        (9, "s7", "Phố", "Z", "7", "5000", "http://x/7", None),
        (10, "s8", "Nhà", "W", "8", "6000", None, "2016"),
    ], schema)


@pytest.fixture(scope="module")
def features(spark):
    rows = [("s1", 0.9, 0.8, 1), ("s1", 0.1, 0.1, 2), ("s3", 0.2, 0.7, 3), ("s7", 0.6, 0.1, 4), ("s8", None, 0.4, 5), (" s5", 0.5, 0.5, 6)]
    return spark.createDataFrame(rows, "Spotify_ID string, valence double, energy double, line int").withColumn("duration_ms", F.lit(9.0))


@pytest.fixture(scope="module")
def songs(meta, features):
    return catalog.curate_catalog(meta, features, ["seq"], ["line"])


@pytest.fixture(scope="module")
def routed(spark, songs):
    labelled = spark.createDataFrame([(t, "vi") for t in VI] + [(t, "en") for t in EN], "t string, lang string")
    texts = spark.createDataFrame([
        ("s1", VI[0]), ("s3", VI[1] + "\n" + VI[2]), ("s5", EN[0]), ("s6", VI[3]), ("s7", VI[3]), ("s8", VI[2]), ("s9", None), ("s10", "♪"),
    ], "Spotify_ID string, Lyrics string")
    return catalog.filter_texts(texts, songs, fit_language_profiles(labelled, "t", "lang"), "vi")


@pytest.fixture(scope="module")
def master(songs, routed):
    return catalog.build_master(songs, routed.filter("route = 'kept'"), [K.ID_COL], [K.ID_COL])


def test_curated_catalogue(songs):
    assert songs.columns == ["Spotify_ID", "Track_Name", "Artist", "Popularity", "Duration_MS", "Preview_Audio_URL", "Release_Date", "energy", "valence"]
    got = {r["Spotify_ID"]: r for r in songs.collect()}
    assert sorted(got) == ["s1", "s3", "s5", "s6", "s7", "s8"]
    assert (got["s1"]["Track_Name"], got["s1"]["Artist"], got["s1"]["Duration_MS"], got["s1"]["valence"]) == ("Mưa", "Lan, Hà", 1000.0, 0.9)
    assert got["s3"]["Popularity"] is None and got["s5"]["energy"] == 0.5


def test_routes(routed):
    got = {r["Spotify_ID"]: (r["route"], r["reason"]) for r in routed.collect()}
    assert got == {
        "s1": ("kept", None), "s3": ("kept", None), "s7": ("kept", None), "s8": ("kept", None),
        "s5": ("foreign", "language en"), "s6": ("compilation", "title"), "s9": ("no_text", "no text"),
        "s10": ("foreign", "language unknown"),
    }


def test_master(master):
    assert master.table.columns[:4] == ["Spotify_ID", "Track_Name", "Artist", "Lyrics"]
    assert sorted(r[0] for r in master.table.select(K.ID_COL).collect()) == ["s1", "s3", "s7", "s8"]
    assert tuple(master.reconciliation.first()) == (4, 2, 0)


def test_fetch_plan(spark, master):
    done = spark.createDataFrame([("s3",)], f"{K.ID_COL} string")
    plan = catalog.plan_fetch(master.table, done)
    assert [tuple(r) for r in plan.tasks.orderBy("track_id").collect()] == [("s1", "Mưa", "http://x/1"), ("s7", "Phố", "http://x/7")]
    assert plan.counts.first().asDict() == {"total": 4, "skipped": 1, "no_url": 1, "tasks": 2}


def test_training_set(spark, master):
    assets = spark.createDataFrame([("s1", ".mp3"), ("s1", ".wav"), ("s3", ".wav"), ("s7", ".mp3")], f"{K.ID_COL} string, ext string")
    assets = assets.withColumn("path", F.concat(K.ID_COL, "ext"))
    result = catalog.train_ready(master.table, assets)
    # s3 lacks its popularity, s7 its release date, s8 its asset.
    assert [r[K.ID_COL] for r in result.ready.collect()] == ["s1"]
    assert sorted(r[K.ID_COL] for r in result.quarantine.collect()) == ["s3", "s7"]
    assert [tuple(r) for r in result.missing.collect()] == [("s8", "Nhà", "W", None)]
    nulls = {r["column"]: r["nulls"] for r in result.nulls.collect()}
    assert (nulls["Popularity"], nulls["Release_Date"], nulls["Lyrics"]) == (1, 1, 0)

    report = catalog.balance_report(master.table)
    assert [r["n"] for r in report.report.collect()] == [0, 1, 1, 1] and report.verdict.first()["imbalanced"] is False
    assert {r["imbalanced"] for r in report.report.collect()} == {False}

    numbered = master.table.na.drop(subset=["valence", "energy"])
    made = training.prepare_training(numbered, assets, folds=2)
    rows = {r[K.ID_COL]: r for r in made.samples.collect()}
    assert sorted(rows) == ["s1", "s3", "s7"]
    assert rows["s1"]["path"] == "s1.mp3" and rows["s3"]["path"] == "s3.wav"
    assert [rows[k]["quadrant"] for k in ("s1", "s3", "s7")] == [3, 1, 2]
    assert all(len(r["ids"]) == len(r["tones"]) == 200 and r["weight"] == 0.75 for r in rows.values())
    assert list(rows["s3"]["labels"]) == pytest.approx([0.2, 0.7])

    cut = training.prepare_training(numbered, assets, folds=2, length=2).samples
    parts = {}
    for r in cut.orderBy("part").collect():
        parts.setdefault(r[K.ID_COL], []).append(r)
    for k, windows in parts.items():
        whole = [i for r in windows for i in r["ids"]]
        assert whole[: len(whole)] == rows[k]["ids"][: len(whole)] and not any(rows[k]["ids"][len(whole):])
        assert {(r["fold"], r["weight"]) for r in windows} == {(rows[k]["fold"], 0.75)}
