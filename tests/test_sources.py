"""Files, nested items and streams."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow import constants as K
from corpusflow.operators import windows
from corpusflow.operators.routing import content_route, route_by_language
from corpusflow.sources import assets, items, tables
from corpusflow.streaming import admission, ingest


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=repr)


def test_csv_bom_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('id,text\n1,"a ""q"", b\nsecond"\n2,\n', encoding="utf-8-sig")
    out = tables.read_csv_table(spark, str(path), "id int, text string")
    assert rows(out) == [(1, 'a "q", b\nsecond'), (2, None)]
    with pytest.raises(FileNotFoundError):
        tables.read_csv_table(spark, str(tmp_path / "none.csv"), "id int")


def test_csv_written_is_read_back(spark, tmp_path):
    df = spark.createDataFrame([(1, 'x "y"\n\nz,'), (2, "\\"), (3, None)], "id int, t string")
    tables.write_table(df, str(tmp_path / "c"), fmt="csv")
    assert rows(tables.read_csv_table(spark, str(tmp_path / "c"), df.schema)) == rows(df)


def test_append_batch_fixed_schema(spark, tmp_path):
    schema = T.StructType.fromDDL("id long, a string, b double")
    path = str(tmp_path / "t")
    tables.append_batch(spark.createDataFrame([("x", 1)], "a string, id int"), path, schema)
    tables.append_batch(spark.createDataFrame([(2.5, 2)], "b double, id int"), path, schema)
    assert rows(spark.read.parquet(path)) == [(1, "x", None), (2, None, 2.5)]
    with pytest.raises(ValueError, match="other"):
        tables.append_batch(spark.createDataFrame([(1,)], "other int"), path, schema)


def test_id_list(spark, tmp_path):
    (tmp_path / "ids.txt").write_text(" a \n\nb\n \n")
    assert rows(tables.read_id_list(spark, str(tmp_path / "ids.txt"))) == [("a",), ("b",)]


def test_materialize_once_builds_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    for _ in range(2):
        assert tables.materialize_once(spark, build, str(tmp_path / "f")).count() == 3
    assert calls == [1]


def test_assets(spark, tmp_path):
    for name, size in (("a b.mp3", 3), ("empty.mp3", 0), ("c.wav", 5), ("d%20e.mp3", 2)):
        (tmp_path / name).write_bytes(b"x" * size)
    mp3 = assets.scan_assets(spark, str(tmp_path))
    assert rows(mp3, K.ID_COL, "size") == [("a b", 3), ("d%20e", 2)]
    assert rows(assets.scan_all_assets(spark, str(tmp_path)), K.ID_COL, "ext") == [
        ("a b", ".mp3"), ("c", ".wav"), ("d%20e", ".mp3")]
    names = spark.createDataFrame([("a b",), ("empty",), ("d%20e",)], f"{K.ID_COL} string")
    got = assets.asset_summary(mp3, names).first()
    assert (got["files"], got["empty"], round(got["total_mb"] * 1048576)) == (2, 1, 5)


def test_search_pages_both_layouts(spark):
    pages = [
        (1, '{"tracks": {"items": [{"data": {"id": "a", "name": "A", "artists": {"items": [{"profile": {"name": "P"}}, {"name": "Q"}]}}}, {"data": {"name": "no id"}}]}}'),
        (2, '{"tracks": [{"id": "b", "artists": [{"name": "R"}, {"name": ""}]}, {"id": "c", "name": "C"}]}'),
        (3, '{"tracks": []}'),
        (4, "{}"),
        (5, None),
        (6, '{"tracks": [{"id": "d", "name": "D", "artists": {"items": []}}]}'),
    ]
    out = items.explode_search_pages(spark.createDataFrame(pages, "page int, j string"), "j")
    assert rows(out) == [
        (1, 0, "a", "A", "P, Q"), (2, 0, "b", "Unknown", "R"), (2, 1, "c", "C", "Unknown"), (6, 0, "d", "D", "Unknown")]


def test_flatten_items(spark):
    data = [(1, '{"id": "a", "album": {"release_date": "2020", "n": 3}}'), (2, "null"), (3, "{"), (4, None), (5, "{}")]
    schema = T.StructType.fromDDL("id string, album struct<release_date: string, n: int>")
    out = items.flatten_items(spark.createDataFrame(data, "seq int, j string"), "j", schema)
    assert out.columns == ["seq", "id", "album.release_date", "album.n"]
    assert [tuple(r) for r in out.collect()] == [(1, "a", "2020", 3)]


def _arrive(spark, path, data, schema):
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(path)


SCHEMA = (
    T.StructType()
    .add("k", T.StringType())
    .add("seq", T.LongType())
    .add("ts", T.TimestampType())
    .add("v", T.DoubleType())
)


def _events(spark, path, start, n):
    base = spark.range(start, start + n).select(
        F.concat(F.lit("k"), (F.col("id") % 7).cast("string")).alias("k"), F.col("id").alias("seq"),
        F.timestamp_seconds(F.col("id") * 30).alias("ts"), (F.col("id") * 1.0).alias("v"))
    base.coalesce(1).write.mode("append").parquet(path)


def test_resume_equals_one_run(spark, tmp_path):
    src, sink, state = (str(tmp_path / n) for n in ("src", "sink", "state"))
    for start in (0, 50):
        _events(spark, src, start, 50)
        ingest.resume_ingest(ingest.file_stream(spark, src, SCHEMA), sink, state).awaitTermination()
    assert rows(spark.read.parquet(sink)) == rows(spark.read.parquet(src))


def test_exact_admission_over_batches(spark, tmp_path):
    src, sink, state = (str(tmp_path / n) for n in ("src", "sink", "state"))
    for start in (3, 0, 100):
        _events(spark, src, start, 3)
        stream = ingest.file_stream(spark, src, SCHEMA)
        admission.admit_to_table(stream, "k", ["seq"], sink, state).awaitTermination()
    got = spark.read.parquet(sink)
    assert rows(got, "k", "seq") == [("k0", 0), ("k1", 1), ("k2", 2), ("k3", 3), ("k4", 4), ("k5", 5)]


def _store(spark, path, batches):
    for batch, ids in batches.items():
        store = admission.KeyStore(spark, path, "k", "bigint")
        store.write(spark.createDataFrame([(i, f"row{i}") for i in ids], "k long, note string"), f"batch_id={batch}")
        store.write_filters(batch)
    return admission.KeyStore(spark, path, "k", "bigint")


def test_new_keys_open_no_old_part(spark, tmp_path):
    store = _store(spark, str(tmp_path / "keys"), {0: range(500), 1: range(500, 520)})
    keys = lambda ids: spark.createDataFrame([(i,) for i in ids], "k long")
    assert store.may_hold(keys(range(10_000, 10_050)), 9) == []
    met = store.may_hold(keys([3, 510]), 9)
    assert [b for b, _ in met] == [0, 1] and all(len(buckets) == 1 for _, buckets in met)
    files = store.stored(met).select(F.input_file_name()).distinct()
    assert files.count() == 2 and {3, 510} <= {r["k"] for r in store.stored(met).collect()}
    assert store.may_hold(keys([510]), 1) == []  # a batch that is done again does not meet itself
    everything = store.may_hold(keys(range(520)), 9)
    assert {r["k"] for r in store.stored(everything).collect()} == set(range(520))


def test_folders_are_merged_and_a_broken_merge_is_ended(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(admission, "FOLDERS", 3)
    monkeypatch.setattr(admission, "KEYS_PER_PART", 1)
    path = str(tmp_path / "keys")
    store = _store(spark, path, {0: range(300), 1: range(300, 310), 2: range(310, 330), 3: range(330, 340)})
    want = [(i, f"row{i}") for i in range(340)]
    finish = store._finish_merge
    store._finish_merge = lambda: (_ for _ in ()).throw(KeyboardInterrupt)  # the driver dies
    with pytest.raises(KeyboardInterrupt):
        store.merge(4)
    assert rows(spark.read.parquet(path), "k", "note") == sorted(want, key=repr)
    store.files.delete("batch_id=1")  # half way through
    store._finish_merge = finish
    again = admission.KeyStore(spark, path, "k", "bigint")
    assert again.files.batches() == [0, 3] and again.files.batches("_filters") == [0, 3]
    assert rows(spark.read.parquet(path), "k", "note") == sorted(want, key=repr)
    keys = spark.createDataFrame([(i,) for i in (305, 335)], "k long")
    assert [b for b, _ in again.may_hold(keys, 9)] == [3]
    assert [f[3] for f in again.folders(9)] == [300, 40]


def test_a_replayed_batch_stores_no_key_twice(spark, tmp_path):
    src, sink, state = (str(tmp_path / n) for n in ("src", "sink", "state"))
    _events(spark, src, 0, 5)
    admission.admit_to_table(ingest.file_stream(spark, src, SCHEMA), "k", ["seq"], sink, state).awaitTermination()
    before = rows(spark.read.parquet(sink), "k", "seq")
    admission.admit_to_table(ingest.file_stream(spark, src, SCHEMA), "k", ["seq"], sink, str(tmp_path / "other")).awaitTermination()
    assert rows(spark.read.parquet(sink), "k", "seq") == before


def test_admission_within_watermark(spark, tmp_path):
    src = str(tmp_path / "src")
    _events(spark, src, 0, 40)
    out = admission.stream_admit(ingest.file_stream(spark, src, SCHEMA), "k", "ts", "1 day")
    got = ingest.run_to_table(out, str(tmp_path / "sink"), str(tmp_path / "state"))
    assert rows(got, "k") == [(f"k{i}",) for i in range(7)]


def test_stream_windows_equal_batch_on_closed_windows(spark, tmp_path):
    src = str(tmp_path / "src")
    _events(spark, src, 0, 200)
    streams = ingest.stream_multires(ingest.file_stream(spark, src, SCHEMA), "ts", [60, 120], ["k"], "v", "0 seconds", 240)
    got = ingest.run_to_table(streams, str(tmp_path / "sink"), str(tmp_path / "state"))
    batch = windows.multires_windows(spark.read.parquet(src), "ts", [60, 120], ["k"], "v", 240)
    closed = batch.filter(F.unix_seconds("w_end") <= 199 * 30)
    assert rows(got) == rows(closed) and got.count() > 100
    # One query, in which the events are read once.
    assert streams._jdf.queryExecution().analyzed().toString().count("FileSource") == 1


@pytest.mark.parametrize("hops, floor", [([10], 25), ([7, 20], 30)])
def test_stream_windows_of_odd_lengths(spark, tmp_path, hops, floor):
    src = str(tmp_path / "src")
    _events(spark, src, 0, 60)
    streams = ingest.stream_multires(ingest.file_stream(spark, src, SCHEMA), "ts", hops, ["k"], "v", "0 seconds", floor)
    got = ingest.run_to_table(streams, str(tmp_path / "sink"), str(tmp_path / "state"))
    batch = windows.multires_windows(spark.read.parquet(src), "ts", hops, ["k"], "v", floor)
    assert rows(got) == rows(batch.filter(F.unix_seconds("w_end") <= 59 * 30))


def test_progress_and_routes(spark, tmp_path):
    src = str(tmp_path / "src")
    _events(spark, src, 0, 30)
    counts = ingest.stream_progress(ingest.file_stream(spark, src, SCHEMA), F.col("k"))
    got = ingest.run_counts(counts, str(tmp_path / "n"), str(tmp_path / "n-state"))
    assert rows(got) == rows(spark.read.parquet(src).groupBy("k").count())

    texts = str(tmp_path / "texts")
    data = [("1", "best of", "a", "en"), ("2", "x", "b", "en"), ("3", "x", None, "en"), ("4", "x", "c", "fr")]
    for part in (data[:2], data[2:]):
        _arrive(spark, texts, part, "id string, title string, text string, language string")
        stream = ingest.file_stream(spark, texts, spark.read.parquet(texts).schema)
        route = lambda b: route_by_language(content_route(b, "title", "text"), "en")
        ingest.stream_route(stream, route, str(tmp_path / "r"), str(tmp_path / "r-state")).awaitTermination()
    whole = route(spark.read.parquet(texts))
    assert rows(spark.read.parquet(str(tmp_path / "r")), "id", "route", "reason") == rows(whole, "id", "route", "reason")
