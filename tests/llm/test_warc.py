"""Seekable bundles: exact round trip, seek table and index by hand, single fetches, revisits against brute force."""

import hashlib
import io
import os
from collections import defaultdict

import pytest
import zstandard

from listing_yield.llm import warc_bundles as W

LONG = "<p>" + "a long page, öß文 \U0001F642\r\n\r\n" * 9000
PAGES = [
    (1, "http://a.example/x y\r\nü", "short"), (2, None, None), (3, "", ""), (4, "http://b.example/%20", "short"),
    (5, "http://c.example/", LONG), (6, "http://c.example/2", LONG), (9, "http://c.example/3", LONG),
    (7, "u", "é" * 500), (8, "u", "é" * 500),  # 1,000 bytes: the least to be revisited
    (10, "u", "x" * 999), (11, "u", "x" * 999), (12, "u", "WARC/1.1\r\n\r\n" * 100),
    (None, "n", "y" * 2000), (13, "n", "y" * 2000), (None, "m", "z" * 2000), (None, "k", "z" * 2000),
    (20, "r", "w" * 1500), (20, "r", "w" * 1500), (19, "r", "w" * 1500),
]


def expected(rows):
    groups = defaultdict(list)
    for page, _, html in rows:
        groups[html or ""].append(page)
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        ids = [x for x in groups[html or ""] if x is not None]
        first = max(ids) if len(data) >= 1000 and ids else page
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "response" if first == page else "revisit",
                    None if first == page else first))
    return sorted(out, key=str)


def pages(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    return df.selectExpr("*", "1 as record_type", "2 as payload_digest", "3 as first", "4 as bundle")


def written(spark, rows, tmp_path, **sizes):
    path = str(tmp_path / "archive")
    W.write_archives(W.plan_records(pages(spark, rows)), path, **sizes)
    return path


@pytest.mark.parametrize("sizes", [{}, {"frame_bytes": 300, "bundle_bytes": 500}])
@pytest.mark.parametrize("most", [W.BROADCAST_ROWS, 0])
def test_round_trip(spark, tmp_path, monkeypatch, sizes, most):
    monkeypatch.setattr(W, "BROADCAST_ROWS", most)
    monkeypatch.setattr(W, "HOT", 1)
    path = written(spark, PAGES, tmp_path, **sizes)
    rows = W.read_archives(spark, path, payloads=True).collect()
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, W.page_of(r.refers_to)) for r in rows]
    assert sorted(got, key=str) == expected(PAGES)
    html = {p: h or "" for p, _, h in PAGES}
    for r in rows:
        if r.record_type == "response" and r.page_id is not None:
            assert r.payload.decode() == html[r.page_id]
    # each revisit names a record that is there
    held = {r.record_id: r.payload for r in rows if r.record_type == "response"}
    assert all(hashlib.sha1(held[r.refers_to]).hexdigest() == r.payload_digest for r in rows if r.refers_to)
    urls = {r.page_id: r.target_uri for r in rows}
    assert urls[1] == "http://a.example/x%20y%0D%0A%C3%BC" and urls[2] is None and urls[4] == "http://b.example/%20"


def test_files_are_seekable_and_plain(spark, tmp_path):
    path = written(spark, PAGES, tmp_path, frame_bytes=300, bundle_bytes=500)
    files = [f"{path}/{f}" for f in os.listdir(path) if f.startswith("part-")]
    assert len(files) > 3
    seen = 0
    for name in files:
        content = open(name, "rb").read()
        if not content:
            continue
        plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(content), read_across_frames=True).read()
        table = W.seek_table(content)
        assert sum(x[2] for x in table) == len(plain)
        starts = [0]
        for at, size, length in table:
            if length:
                one = zstandard.ZstdDecompressor().decompress(content[at: at + size])  # each frame by itself
                assert one == plain[starts[-1]: starts[-1] + length]
                starts.append(starts[-1] + length)
        entries = W.read_index(content)
        for identifier, frame, offset, length in entries:
            record = plain[starts[frame] + offset:][:length]
            assert record.startswith(b"WARC/1.1\r\n") and f"WARC-Record-ID: {identifier}\r\n".encode() in record
        assert sum(x[3] for x in entries) == len(plain)  # nothing but records
        seen += len(entries)
    assert seen == len(PAGES)


def test_fetch_by_identifier(spark, tmp_path):
    path = written(spark, PAGES, tmp_path, frame_bytes=300, bundle_bytes=500)
    index = W.archive_index(spark, path)
    ids = [W.record_id(p, hashlib.sha1(h.encode()).hexdigest()) for p, h in ((9, LONG), (1, "short"), (6, LONG))]
    got = W.fetch(spark, path, index, spark.createDataFrame([(i,) for i in [*ids, "<urn:page:77:none>"]], "record_id string"))
    rows = {r.page_id: r for r in got.collect()}
    assert set(rows) == {9, 1, 6}
    assert rows[9].payload.decode() == LONG and rows[1].payload == b"short"
    assert rows[6].record_type == "revisit" and rows[6].refers_to == ids[0]
    at = {r.record_id: r for r in index.collect()}
    assert (rows[9].frame, rows[9].offset, rows[9].length) == (at[ids[0]].frame, at[ids[0]].offset, at[ids[0]].length)


def test_empty_table(spark, tmp_path):
    path = written(spark, [], tmp_path)
    assert W.read_archives(spark, path).count() == 0 and W.archive_index(spark, path).count() == 0


def test_damage_is_an_error():
    data = W.record_bytes(1, "u", b"payload", hashlib.sha1(b"other").hexdigest(), 7, "response", None)
    with pytest.raises(ValueError):
        W.parse_record(data)
    with pytest.raises(ValueError):
        W.seek_table(b"no bundle at all")
