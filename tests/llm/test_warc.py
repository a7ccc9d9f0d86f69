"""WARC archives and their two-level index against plain Python."""

import hashlib
import random
import zlib

import pytest

from touchline.llm import warc

SCHEMA = "page_id bigint, url string, html string, digest string, first string"


def wanted_rows(pages, least=100):
    """What reading everything back must give."""
    firsts = {}
    for page_id, _, html in pages:
        data = (html or "").encode()
        if len(data) >= least and page_id is not None:
            firsts[data] = min(firsts.get(data, page_id), page_id)
    out = []
    for page_id, url, html in pages:
        data = (html or "").encode()
        first = firsts.get(data) if len(data) >= least else None
        again = first is not None and page_id != first
        out.append((page_id, url, "revisit" if again else "response", len(data), hashlib.sha256(data).hexdigest(), first if again else None))
    return sorted(out, key=str)


def read_back(index, pages, **how):
    rows = warc.fetch(warc.find(index, pages, **how), index).collect()
    number = lambda v: None if v is None else int(v)
    return sorted(((number(r.id), r.url, r.record_type, r.payload_bytes, r.payload_digest, number(r.refers_to)) for r in rows), key=str)


def build(spark, folder, pages, archive_bytes=warc.ARCHIVE_BYTES, **how):
    df = spark.createDataFrame([(*p, "x", "y") for p in pages], SCHEMA)
    return df, warc.build_index(warc.write(df, str(folder), archive_bytes=archive_bytes), str(folder), **how)


def test_random_pages(spark, tmp_path):
    rng = random.Random(5)
    bodies = ["x" * 99, "y" * 100, "é" * 60, "z" * 5000, "", None, "\r\n\r\nWARC/1.1\r\n" * 20]
    hosts = ["http://www.a.com/", "https://b.org:8080/p?q=1", "HTTP://WWW.A.COM/x y", "not a url", "", None, "http://[bad", "http://a.com/" + "l" * 3000]
    pages = [(rng.choice([None, *range(60)]), rng.choice(hosts), rng.choice(bodies)) for _ in range(400)]
    df, index = build(spark, tmp_path / "w", pages, shards=7, block_lines=4)
    assert read_back(index, df, page_id="page_id") == wanted_rows(pages)
    assert read_back(index, df) == wanted_rows(pages)
    assert len(index.shards) == 7 and sum(s[7] for s in index.shards) == 400


def test_hot_url_and_hot_payload_fill_several_shards(spark, tmp_path):
    pages = [(k % 900, "http://hot.com/", "same" * 50) for k in range(1200)] + [(5000 + k, f"http://h{k}.com/", f"{k}" * 200) for k in range(300)]
    df, index = build(spark, tmp_path / "w", pages, shards=6, block_lines=16)
    hot = [s for s in index.shards if s[1] <= "com,hot)/" <= s[3]]
    assert len(hot) >= 3
    assert read_back(index, df, page_id="page_id") == wanted_rows(pages)
    one = spark.createDataFrame([("http://h7.com/", 5007), ("http://h7.com/", 1), ("http://nowhere.com/", 2)], "url string, page_id bigint")
    assert [r[0] for r in read_back(index, one, page_id="page_id")] == [5007]
    assert len(read_back(index, spark.createDataFrame([("http://hot.com/",)], "url string"))) == 1200


def test_reopened_index_payloads_and_archive_format(spark, tmp_path):
    pages = [(k, f"http://a.com/{k}", f"<p>{k}</p>" * 40) for k in range(30)] + [(99, "http://a.com/3", "<p>3</p>" * 40)]
    build(spark, tmp_path / "w", pages, archive_bytes=500, shards=2)
    index = warc.open_index(spark, str(tmp_path / "w"))
    asked = spark.createDataFrame([("http://a.com/3",)], "url string")
    found = warc.fetch(warc.find(index, asked), index, with_payload=True).collect()
    assert sorted((r.id, r.record_type, r.payload, r.refers_to) for r in found) == [("3", "response", b"<p>3</p>" * 40, None), ("99", "revisit", b"", "3")]
    files = list((tmp_path / "w" / "archives").glob("*.warc.gz"))
    assert len(files) > 12
    text = zlib.decompressobj(31).decompress(files[0].read_bytes())
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: ") and text.endswith(b"\r\n\r\n")


def test_empty_table_and_damaged_record(spark, tmp_path):
    df, index = build(spark, tmp_path / "w", [])
    assert index.shards == () and read_back(index, df, page_id="page_id") == []
    good = warc.record("=1", "http://a.com/", hashlib.sha256(b"abc").hexdigest(), 3, None, b"abc", "2024-01-01T00:00:00Z")
    assert warc.read_record(good)[0][:4] == ("1", "http://a.com/", "response", 3)
    bad = warc.record("=1", "http://a.com/", hashlib.sha256(b"abd").hexdigest(), 3, None, b"abc", "2024-01-01T00:00:00Z")
    with pytest.raises(ValueError):
        warc.read_record(bad)


def test_url_keys_sort_hosts_together():
    assert warc.url_key("http://www.Example.com/a?b=1") == "com,example,www)/a?b=1"
    assert warc.url_key("https://example.com:8443") == "com,example:8443)/"
    assert warc.url_key(None) == warc.url_key("") == ""
    assert len(warc.url_key("http://a.com/" + "x" * 9999)) == warc.KEY_CHARS
