import base64
import hashlib

import pyarrow.fs as fs
from pyspark.sql import functions as F

from corpusflow.llm import warc

SCHEMA = "page_id long, url string, html string, payload string, _digest string"


def _pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows], SCHEMA)


def _read(df):
    return {r["record_id"]: r for r in warc.read_archives(warc.archive_pages(df)).collect()}


def test_records_come_back_with_their_payload_and_response(spark):
    rows = [(5, "u5", "same"), (2, "u2", "same"), (9, "u\n9", "same"), (3, None, None), (4, "u4", ""), (1, "u1", "é" * 200_000), (7, "u7", "own")]
    got = _read(_pages(spark, rows).repartition(3))
    assert len(got) == len(rows)
    for i, _, html in rows:
        payload = (html or "").encode()
        first = min(j for j, _, other in rows if (other or "").encode() == payload)
        record = got[i]
        assert record["payload_digest"] == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert record["payload_bytes"] == len(payload)
        assert (record["record_type"], record["refers_to"]) == (("response", None) if first == i else ("revisit", first))
        assert record["payload"] == (payload if first == i else None)
    assert got[3]["url"] is None and got[9]["url"] == "u%0A9"


def test_small_payloads_and_rows_without_id(spark):
    df = _pages(spark, [(1, "a", "xy"), (2, "b", "xy"), (None, "c", "long enough"), (8, "d", "long enough"), (None, "e", "alone"), (None, "f", "alone")])
    rows = df.select(F.col("page_id").alias("record_id"), F.col("html").cast("binary").alias("payload"))
    got = sorted((r["record_id"] or 0, r["refers_to"] or 0) for r in warc.refer_to_first(rows, min_bytes=5).collect())
    assert got == [(0, 0), (0, 0), (0, 8), (1, 0), (2, 0), (8, 0)]


def test_repeated_rows_and_empty_table(spark):
    df = _pages(spark, [(1, "a", "p"), (1, "a", "p"), (2, "b", "p")])
    got = sorted((r["record_id"], r["record_type"]) for r in warc.read_archives(warc.archive_pages(df)).collect())
    assert got == [(1, "response"), (1, "response"), (2, "revisit")]
    assert warc.read_archives(warc.archive_pages(df.limit(0))).count() == 0


def test_bundle_is_a_plain_zstandard_file_and_one_frame_gives_one_record(spark):
    import zstandard

    df = _pages(spark, [(i, f"u{i}", f"page {i} " * 20_000) for i in range(9)]).coalesce(1)
    index = warc.archive_pages(df)
    row = index.where("record_id = 6").first()
    system, name = fs.FileSystem.from_uri(row["bundle"])
    with system.open_input_file(name) as source:
        frames = warc.read_seek_table(source)
        begin, packed, plain = frames[row["frame"]]
        content = zstandard.ZstdDecompressor().decompressobj().decompress(source.read_at(packed, begin))
        whole = source.read_at(source.size(), 0)
    assert len(frames) > 1 and len(content) == plain
    record = warc.parse_record(content[row["offset"] : row["offset"] + row["length"]])
    assert record["record_id"] == 6 and record["payload"] == b"page 6 " * 20_000
    everything = b"".join(iter(lambda r=zstandard.ZstdDecompressor().stream_reader(whole, read_across_frames=True): r.read(1 << 20), b""))
    assert everything.count(b"WARC/1.1\r\n") == 9
