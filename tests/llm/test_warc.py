"""Archives: round trip, revisits, and odd pages."""

import base64
import gzip
import hashlib
from pathlib import Path

from aeropanel.llm import warc

SCHEMA = "page_id long, url string, html string, payload string"
PAGES = [(5, "http://a/", "<p>same</p>", "x"), (3, "http://b/", "<p>same</p>", "x"), (9, None, "<p>same</p>", "x"), (4, "http://c/\r\nX: y", "é", "x"),
         (6, "", None, None), (7, "u", "", "x"), (8, "u", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n", "x"), (None, "u", "<p>same</p>", "x"),
         (10, "u", "twin", "x"), (10, "u", "twin", "x"), (11, "u", "long " * 200_000, "x")]


def want(pages):
    digest = lambda h: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    first = {}
    for page_id, _, html, _ in pages:
        if page_id is not None:
            first[digest(html)] = min(page_id, first.get(digest(html), page_id))
    rows = []
    for page_id, _, html, _ in pages:
        original = first.get(digest(html))
        revisit = page_id is not None and page_id > original
        rows.append((page_id, len((html or "").encode()), digest(html), "revisit" if revisit else "response", original if revisit else None))
    return sorted(rows, key=repr)


def test_round_trip(spark):
    got = warc.round_trip(spark.createDataFrame(PAGES, SCHEMA).repartition(3)).collect()
    assert sorted(map(tuple, got), key=repr) == want(PAGES)


def test_payloads_of_revisits_come_from_their_responses(spark, tmp_path):
    path = str(tmp_path / "archive")
    warc.write_archives(spark.createDataFrame(PAGES, SCHEMA), path)
    rows = warc.with_originals(warc.read_archives(spark, path)).collect()
    payloads = sorted((r.page_id, r.payload) for r in rows if r.page_id is not None)
    assert payloads == sorted((i, h or "") for i, _, h, _ in PAGES if i is not None)
    stored = b"".join(gzip.decompress(p.read_bytes()) for p in Path(path).glob("part-*"))
    assert stored.count(b"<p>same</p>") == 2  # page 3, and the page without an id
    assert stored.startswith(b"WARC/1.1\r\nWARC-Type: ") and b"\r\nX: y" not in stored
    assert {r.url for r in rows if r.page_id in (6, 9)} == {"", None}


def test_payloads_stay_where_they_are(spark, tmp_path):
    marks = warc.revisits(warc.with_digest(spark.createDataFrame(PAGES, SCHEMA)).select(*warc.KEY), str(tmp_path / "marks"))
    spark.createDataFrame(PAGES, SCHEMA).write.parquet(str(tmp_path / "pages"))
    plan = warc.resolved(warc.with_digest(spark.read.parquet(str(tmp_path / "pages"))), marks)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert sorted(map(tuple, marks.select("page_id", "refers_to").collect())) == [(5, 3), (7, 6), (9, 3)]


def test_archives_are_cut_by_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 300_000)
    path = str(tmp_path / "archive")
    warc.write_archives(spark.createDataFrame(PAGES, SCHEMA).coalesce(1), path)
    assert len(list(Path(path).glob("part-*"))) > 3
    assert warc.read_archives(spark, path).count() == len(PAGES)


def test_small_payloads_are_all_stored(spark):
    df = spark.createDataFrame(PAGES, SCHEMA)
    got = {r.page_id: r.record_type for r in warc.round_trip(df, min_bytes=5).collect()}
    assert got[7] == "response" and got[5] == "revisit"


def test_a_changed_payload_is_noticed():
    assert list(warc.parse_archive(b"")) == []
    block = b"HTTP/1.1 200 OK\r\n\r\nx"
    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(block), block)
    assert [r["payload"] for r in warc.parse_archive(record * 3)] == [b"x"] * 3


def test_no_pages(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0
