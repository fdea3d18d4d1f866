import hashlib
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.llm import warc
from kpiloom.session import stage_path

PAGES = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()), T.StructField("digest", T.StringType()),
    T.StructField("time", T.StringType()),
])


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, "extra", "extra") for i, u, h in rows], PAGES).repartition(3)


def brute(rows):
    first = {}
    for i, _, html in rows:
        if i is not None and len((html or "").encode()) >= 100:
            first[html or ""] = min(i, first.get(html or "", i))
    out = []
    for i, _, html in rows:
        payload = (html or "").encode()
        to = first.get(html or "")
        to = None if to == i else to
        out.append((i, len(payload), hashlib.sha256(payload).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


ROWS = [
    (7, "http://www.Example.com/b?q=1", "x" * 120), (3, "https://example.com:443/b", "x" * 120),
    (9, "http://example.com/a", "x" * 120), (9, "http://example.com/a", "x" * 120),
    (4, None, None), (5, "", ""), (6, "not a url\r\nX: y", "short"), (8, "http://[bad", "short"),
    (10, "http://b.org", "é" * 60), (11, "http://b.org", "é" * 60), (None, "http://n.org", "é" * 60),
    (12, "http://c.org/", "WARC/1.1\r\n\r\n\r\n\r\nWARC-Type: revisit\r\n\r\n" * 9), (-2, "http://d.org:8080/X", "\r\n" * 99),
    (13, "http://e.org", "y" * 300_000), (14, "http://f.org", "a\x00b" * 60),
]


def test_rows_against_brute_force(spark):
    assert result(warc.archive(pages_of(spark, ROWS))) == brute(ROWS)


def test_order_and_files(spark):
    rng = random.Random(4)
    rows = [(i, f"http://h{rng.randrange(9)}.org/{rng.randrange(4)}", f"page {rng.randrange(50)} " * 20) for i in range(300)]
    path = stage_path(spark, "warc-test")
    index = warc.archive(pages_of(spark, rows), path)
    got = index.collect()
    keys = [(r["url_key"], r["captured"], r["page_id"]) for r in got]
    assert keys == sorted(keys) and len(keys) == 300
    assert result(index) == brute(rows)
    assert len({(r["file"], r["offset"]) for r in got}) == 300


def test_hot_payload(spark, monkeypatch):
    from kpiloom.llm import common

    monkeypatch.setattr(common, "HOT_ROWS", 5)
    rows = [(i, "http://a.org", "same page " * 30) for i in range(50)] + [(100 + i, "http://b.org", f"{i} " * 60) for i in range(9)]
    assert result(warc.archive(pages_of(spark, rows))) == brute(rows)


def test_empty_table(spark):
    assert warc.archive(pages_of(spark, [])).count() == 0


def test_own_capture_times(spark):
    pages = spark.createDataFrame(
        [(1, "http://a.org", "one", "2020-01-02 00:00:00"), (2, "http://a.org", "two", "2019-01-02 00:00:00")],
        "page_id long, url string, html string, at string")
    got = warc.archive(pages, captured="at").collect()
    assert [(r["page_id"], r["captured"]) for r in got] == [(2, "2019-01-02T00:00:00Z"), (1, "2020-01-02T00:00:00Z")]


@pytest.mark.parametrize("kind, ids", [
    ("long", [3 * 10**11, 10**14, -10, -2, 2, 10, None, 2**63 - 1, -(2**63)]), ("string", ["p1", "p10", "p2", "", None, "日本", "a b+c>\r\nX: y"]),
    ("decimal(38,0)", [Decimal(10) ** 30, Decimal(7), None]), ("int", [5, -5, None]),
])
def test_ids_of_any_type_and_size(spark, kind, ids):
    rows = [(i, "http://a.org", "the same page " * 20) for i in ids] + [(i, "http://b.org", f"page of {i}") for i in ids]
    index = warc.archive(spark.createDataFrame(rows, f"page_id {kind}, url string, html string").repartition(3))
    got = index.collect()
    first = min(i for i in ids if i is not None)
    assert sorted(((r["page_id"], r["record_type"], r["refers_to"]) for r in got if r["url_key"] == "org,a)/"), key=repr) == sorted(
        ((i, "response", None) if i == first else (i, "revisit", first) for i in ids), key=repr)
    for where in ("org,a)/", "org,b)/"):
        keys = [(r["captured"], r["page_id"] is not None, r["page_id"]) for r in got if r["url_key"] == where]
        assert keys == sorted(keys) and len(keys) == len(ids)
    assert all(re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", r["captured"]) for r in got)


def test_odd_capture_times(spark):
    times = ["0001-01-01 00:00:00", "9999-12-31 23:59:59", "+20000-01-01 00:00:00", "not a time", None, "2020-01-01 00:00:00"]
    pages = spark.createDataFrame([(i, "http://a.org", "x", t) for i, t in enumerate(times)], "page_id long, url string, html string, at string")
    got = warc.archive(pages, captured="at").collect()
    captured = [r["captured"] for r in got]
    assert captured == sorted(captured) and len(captured) == len(times)
    assert captured[0] == "0001-01-01T00:00:00Z" and captured[-1] == "9999-12-31T23:59:59Z"


def test_repeated_rows_span_ranges(spark, monkeypatch):
    monkeypatch.setattr(warc, "CAPTURES_PER_RANGE", 1000)
    rows = [(7, "http://a.org", "one page, many times " * 9)] * 10_000
    index = warc.archive(pages_of(spark, rows))
    sizes = [r["n"] for r in index.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 10 and max(sizes) < 2500 and sum(sizes) == 10_000
    assert {tuple(r) for r in index.select("page_id", "record_type", "refers_to").distinct().collect()} == {(7, "response", None)}
    assert index.select("file", "offset").distinct().count() == 10_000


def test_files_hold_few_large_records(spark):
    rows = [(i, "http://a.org", f"{i} " * (10 if i % 9 else 50_000 * (1 + i % 2 * 30))) for i in range(60)]
    path = stage_path(spark, "warc-large")
    index = warc.archive(pages_of(spark, rows), path)
    assert result(index) == brute(rows)
    by_file = index.groupBy("file").agg(F.count("*").alias("n"), F.max("payload_bytes").alias("most")).collect()
    assert all(r["n"] <= next(n for size, n in warc.RECORDS_PER_FILE.items() if size is None or r["most"] < size) for r in by_file)


@pytest.mark.parametrize("text", [" " * 10**6, "\n" * 10**6, "x" * 10**6, "\r\n" * 10**6, "!" * 10**6])
def test_long_runs(spark, text):
    rows = [(1, "http://a.org", text), (2, "http://a.org", text), (3, text, "short")]
    assert result(warc.archive(pages_of(spark, rows))) == brute(rows)


@pytest.mark.parametrize("runs", [0, 1, 2, 3, 7, 16])
def test_merge_order(runs):
    rng = random.Random(runs)
    keys = [k for _ in range(runs) for k in sorted((rng.randrange(20), "x") for _ in range(rng.randrange(1, 30)))]
    order = warc.merge_order(keys)
    assert sorted(order) == list(range(len(keys)))
    assert [keys[i] for i in order] == sorted(keys)


@pytest.mark.parametrize("url, key", [
    ("http://www.Example.com:80/A?B=1", "com,example)/a?b=1"), ("https://user@x.org", "org,x)/"),
    ("http://x.org:8080/", "org,x:8080)/"), ("", ""), ("http://[bad", "http://[bad"), (" Text ", "text"),
])
def test_url_key(url, key):
    assert warc.url_key(url) == key


def test_broken_archive_is_an_error():
    import io

    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc")))
    with pytest.raises(ValueError):
        warc.capture({"warc-payload-digest": "sha256:00", "warc-type": "response", "warc-record-id": "x"}, b"h\r\n\r\nbody")
