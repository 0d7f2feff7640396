import base64
import hashlib

from pyspark.sql import functions as F

from tapecraft.llm import warc
from tapecraft.llm.warc import archive_round_trip, lookup, read_captures, url_key, write_archives, write_index

SCHEMA = "page_id long, url string, html string, digest string, offset long, part int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", -1, -1) for r in rows], SCHEMA).repartition(3)


def brute(rows, least=0):
    first = {}
    for page_id, _, html in rows:
        payload = (html or "").encode()
        if page_id is not None:
            first[payload] = min(first.get(payload, page_id), page_id)
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        copy = page_id is not None and len(payload) >= least and first[payload] < page_id
        out.append((page_id, len(payload), digest, "revisit" if copy else "response", first[payload] if copy else None))
    return sorted(out, key=str)


def rows_of():
    bodies = ["", None, "same", "é" * 10, "<p>\r\n\r\nWARC/1.1\r\n</p>", "x" * 200_000]
    urls = ["http://a.com/x", "https://b.org:443/y?q=1#z", None, "", "http://WWW.a.com", "no scheme\tand\nbreaks"]
    rows = [(i, urls[i % 6], bodies[i * 7 % 6] if i % 3 else f"own {i}") for i in range(400)]
    # a third of all rows has one url and one payload
    return rows + [(1000 + i, "http://hot.com/", "hot") for i in range(200)] + [(None, None, "same"), (3, "http://a.com/x", "same")]


def test_round_trip(spark, tmp_path):
    got = archive_round_trip(spark, table(spark, rows_of()), str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows_of())


def test_least_bytes_and_small_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    monkeypatch.setattr(warc, "BLOCK_LINES", 7)
    monkeypatch.setattr(warc, "READ_BYTES", 500)
    got = archive_round_trip(spark, table(spark, rows_of()), str(tmp_path), least_bytes=4)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows_of(), 4)


def test_lookup_of_single_urls(spark, tmp_path):
    captures = write_archives(table(spark, rows_of()), str(tmp_path))
    parts = write_index(captures, str(tmp_path))
    asked = spark.createDataFrame([("http://hot.com",), ("https://b.org/y?q=1",), ("http://none.com/",), ("http://hot.com/",)], "u string")
    found = lookup(asked, parts)
    want = [p for p, u, _ in rows_of() if u and url_key(u) in ("com,hot)/", "org,b)/y?q=1")]
    assert sorted(r.page_id for r in found.collect()) == sorted(want)
    assert read_captures(found.filter(F.col("urlkey") == "org,b)/y?q=1"), str(tmp_path)).count() == sum(
        u == "https://b.org:443/y?q=1#z" for _, u, _ in rows_of())


def test_empty_table(spark, tmp_path):
    assert archive_round_trip(spark, table(spark, []), str(tmp_path)).collect() == []


def test_url_keys():
    assert url_key("http://www.Example.com:80/a?b#c") == "com,example,www)/a?b"
    assert url_key("https://u:p@x.y.org?q") == "org,y,x)?q"
    assert url_key(None) == url_key("") == ""
    assert url_key("http://a.b/ \t") == "b,a)/%20%09"
