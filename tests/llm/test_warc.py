"""Framing, archives on disk, and payloads put together from segments, as exact round trips."""

import gzip
import hashlib
import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from emberlink.llm import warc
from emberlink.llm.common import scratch_dir


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=300), st.integers(1, 90))
def test_chunks(payload, size):
    assert warc.unframe(warc.frame(payload, size)) == payload


def test_chunks_of_others():
    head = b"HTTP/1.1 200 OK\r\nTransfer-Encoding:  gzip, Chunked\r\n\r\n"
    assert warc.unframe(head + b"3;x=y\r\nabc\r\n02 \r\nde\r\n0\r\nTrailer: 1\r\n\r\n") == b"abcde"
    assert warc.unframe(b"HTTP/1.1 200 OK\r\nX: chunked\r\n\r\nraw\r\n") == b"raw\r\n"
    for broken in (b"no head", head + b"3\r\nab", head + b"3\r\nabcd\r\n0\r\n\r\n", head + b"xyz\r\n", head + b"1\r\na\r\n0\r\n", head):
        assert warc.unframe(broken) is None


@settings(max_examples=100, deadline=None)
@given(st.binary(min_size=1, max_size=200), st.integers(1, 50), st.randoms())
def test_segments_in_any_order(block, size, rng):
    pieces = [block[i : i + size] for i in range(0, len(block), size)]
    parts = [(n, len(block) if n == len(pieces) else None, p) for n, p in enumerate(pieces, 1)]
    rng.shuffle(parts)
    assert warc.joined(*map(list, zip(*parts))) == block
    if len(parts) > 1:
        assert warc.joined(*map(list, zip(*parts[1:]))) is None
        assert warc.joined(*map(list, zip(*parts, parts[0]))) is None
    wrong = [(n, t and t + 1, p) for n, t, p in parts]
    assert warc.joined(*map(list, zip(*wrong))) is None


LONG = "x" * 1500
PAGES = [
    (1, "http://a/", LONG), (5, "http://b/ü?q=1%20", LONG), (None, "http://n/", LONG), (3, None, LONG), (5, "http://again/", LONG),
    (6, "http://c/", "short"), (7, "http://c/", "short"), (8, " a\r\nb\x00: c", ""), (9, "", None), (None, None, None),
    (10, "http://d/", "WARC/1.1\r\nContent-Length: 5\r\n\r\nabc\r\n\r\n" * 40), (2**60 + 1, "u", "\x00 日本 é\r\n" * 4000),
    (12, "u", "0\r\n\r\n" + "z" * 995), (13, "u", "é" * 500), (14, "u", "é" * 500), (None, "m", "null only " * 200), (None, "m", "null only " * 200),
    (15, "v", "".join(random.Random(2).choices("ab \n", k=2_000_000))),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "0 AS digest", "'x' AS payload").repartition(3)


def _want():
    kept = {}
    for page_id, _, html in PAGES:
        if html and len(html.encode()) >= 1000 and page_id is not None:
            kept[html] = max(page_id, kept.get(html, page_id))
    rows = []
    for page_id, _, html in PAGES:
        raw = (html or "").encode()
        top = kept.get(html)
        again = top is not None and (page_id is None or page_id < top)
        rows.append((page_id, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", top if again else None))
    return sorted(rows, key=repr)


def test_query(spark, pages, tmp_path):
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    got = [tuple(r) for r in warc.op12_warc_round_trip(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == _want()


def test_archives_hold_pages(spark, pages):
    """Small segments: most payloads come from several archives' records; targets come back as they were."""
    blocks = warc.write_archives(pages, scratch_dir(spark, "warc"), segment=700)
    got = warc.read_archives(blocks).collect()
    assert all(r["problem"] is None for r in got)
    by_id = {r["record_id"]: r for r in got}
    pairs = [(r["page_id"], r["uri"], bytes((by_id[r["refers_to"]] if r["refers_to"] else r)["payload"])) for r in got]
    assert sorted(pairs, key=repr) == sorted(((i, u, (h or "").encode()) for i, u, h in PAGES), key=repr)
    assert {r["record_type"] for r in got if r["refers_to"]} == {"revisit"}
    parts = [b for b in blocks.collect() if b["segmented"]]
    kinds = [f["warc-type"] for b in parts for f, _ in warc.records_of(gzip.open(b["path"]))]
    assert kinds.count("continuation") > 2800 and "revisit" not in kinds


def test_without_a_manifest(spark, pages):
    """Whole archives that nobody has told anything about, segments and whole records in one."""
    folder = scratch_dir(spark, "warc")
    warc.write_archives(pages, folder, segment=5000)
    paths = [b["path"] for b in warc.write_archives(pages, folder, segment=5000).select("path").distinct().collect()]
    joined = folder.replace("file://", "") + "/all.warc.gz"
    with open(joined, "wb") as out:
        for p in paths:
            out.write(open(p, "rb").read())
    blocks = spark.createDataFrame([(joined, 0, None, None)], "path string, offset long, length long, segmented boolean")
    got = warc.read_archives(blocks).collect()
    assert len(got) == len(PAGES) and all(r["problem"] is None for r in got)


def test_damage_is_reported(spark, tmp_path):
    page = lambda i, html, **k: warc.page_records(f"urn:{i}", str(i), "u", hashlib.sha1(html).hexdigest(), html, None, "d", 400)
    a, b, c, d = (page(i, bytes([65 + i]) * 1500) for i in range(4))
    wrong = [r.replace(b"D" * 50, b"E" * 50, 1) for r in d]
    chunks = [r.replace(b"5dc\r\n", b"5dx\r\n") for r in page(9, b"q" * 1500)]
    parts = [*a[::-1], *b[:1], *b[2:], *c, c[1], *wrong, *chunks]
    (tmp_path / "x.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in parts) + gzip.compress(b"WARC/1.1\r\nContent-Length: 99\r\n\r\nshort"))
    for alone in (True, None):
        blocks = spark.createDataFrame([(str(tmp_path / "x.warc.gz"), 0, None, alone)], "path string, offset long, length long, segmented boolean")
        got = {r["page_id"]: (r["problem"], r["payload"] and bytes(r["payload"])) for r in warc.read_archives(blocks).collect()}
        assert got == {0: (None, b"A" * 1500), 1: ("segments", None), 2: ("segments", None), 3: ("digest", None), 9: ("framing", None), None: ("truncated", None)}


def test_empty(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(warc.write_archives(none, scratch_dir(spark, "warc"))).count() == 0


def test_one_hot_payload(spark):
    """A third of all pages revisit one response."""
    rows = spark.range(3000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.expr("if(id % 3 = 0, repeat('h', 2000), repeat(id, 600))").alias("html"))
    got = warc.read_archives(warc.write_archives(rows, scratch_dir(spark, "warc")))
    assert got.groupBy("record_type").count().orderBy("record_type").collect() == [("response", 2001), ("revisit", 999)]
    assert got.select("refers_to").distinct().count() == 2
