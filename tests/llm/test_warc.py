"""Archives: round trip of every page, revisits by a plain rule, order of the merged index."""

import glob
import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from pagespine.llm import warc
from tests.llm.conftest import SF

PAGE = "page_id long, url string, html string, record_type string"


@pytest.fixture(scope="session")
def odd_pages(spark):
    big, other = "é<p>\r\n\r\nWARC/1.1\r\n" * 90, "ß" * 600
    rows = [
        (1, "http://a.org/x", big), (2, "http://a.org/x", big), (2, "http://a.org/x", big), (3, None, big), (None, "http://b.org", big),
        (4, "http://a.org/\nz y", None), (5, "http://www.A.org:80/q?B=1", ""), (6, "not a url [", "short"), (7, "http://a.org/x", "short"),
        (None, "u", other), (None, "u", other), (8, "http://a.org/x", "\n"), (-9, "http://ü.org", big + "1"),
    ]
    return spark.createDataFrame([(*r, "clash") for r in rows], PAGE).repartition(3)


def plain(rows):
    groups = {}
    for page, html in rows:
        groups.setdefault(html, []).append(page)
    out = []
    for page, html in rows:
        data = (html or "").encode()
        ids = [i for i in groups[html] if i is not None]
        first = max(ids) if len(data) >= 1000 and ids else page
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "response" if page == first else "revisit", None if page == first else first))
    return sorted(out, key=repr)


@pytest.mark.parametrize("name", ["odd_pages", "pages"])
def test_round_trip(spark, request, name):
    pages = spark.read.parquet(f"{SF}/pages.parquet") if name == "pages" else request.getfixturevalue(name)
    if name == "pages":
        pages = pages.union(pages.withColumn("page_id", F.col("page_id") + 100_000))
    found = warc.archive(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(tuple, found.collect()), key=repr) == plain([(r.page_id, r.html) for r in pages.collect()])


def test_archives_are_plain_records(odd_pages, tmp_path):
    warc.write(odd_pages, str(tmp_path / "w"), records_per_file=2)
    files = glob.glob(str(tmp_path / "w" / "*.gz"))
    assert len(files) > 3
    headers = [h for f in files for _, h, _ in warc._records(gzip.open(f))]
    assert len(headers) == odd_pages.count()
    assert len({h["WARC-Record-ID"] for h in headers}) == len(headers)


def test_damage_is_noticed(spark, odd_pages, tmp_path):
    warc.write(odd_pages.filter("page_id = 1"), str(tmp_path / "w"))
    (file,) = [f for f in glob.glob(str(tmp_path / "w" / "*.gz")) if gzip.open(f).read()]
    data = gzip.open(file).read()
    with open(file, "wb") as damaged:
        damaged.write(gzip.compress(data.replace("é".encode(), "è".encode())))
    for crc in glob.glob(str(tmp_path / "w" / ".*.crc")):
        open(crc, "wb").close()
    with pytest.raises(Exception, match="damaged payload"):
        warc.read(spark, str(tmp_path / "w")).count()


def test_index_is_in_order(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = warc.archive(pages).collect()
    keys = [(r.urlkey, r.captured, r.page_id) for r in rows]
    assert keys == sorted(keys) and len(keys) == pages.count()


def test_url_keys():
    assert warc.url_key("https://www.Example.org/A/b?Q=1#x") == "org,example)/a/b?q=1"
    assert warc.url_key("http://[bad") == "http://[bad"


def test_loser_tree():
    draw = random.Random(1)
    for k in range(12):
        runs = [sorted(draw.randrange(30) for _ in range(draw.randrange(8))) for _ in range(k)]
        assert list(warc.LoserTree(runs, lambda x: x)) == sorted(sum(runs, []))


def test_no_pages(odd_pages):
    assert warc.archive(odd_pages.limit(0)).count() == 0
