import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import warc
from tidemark.llm.common import scratch

LONG = "<p>" + "a\r\n\r\nWARC/1.1\r\n" * 20
PAGES = [(5, "http://www.b.example/x?b=2&a=1#f", LONG), (2, "https://b.example:443/x?a=1&b=2", LONG),
         (9, "http://a.example/", LONG), (3, None, "short"), (4, "http://a.example/", "short"), (6, "http://a.example/q", None),
         (7, "bad [url\r\nX: y", ""), (2, "http://c.example/", LONG), (None, "http://d.example/", LONG),
         (8, "http://a.example/é", "ü" * 60)]
SCHEMA = "page_id long, url string, html string"


def expected(pages):
    out = []
    for i, _, html in pages:
        data = (html or "").encode()
        same = [j for j, _, h in pages if (h or "").encode() == data and j is not None]
        first = min(same) if len(data) >= 100 and same else i
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "response" if first == i else "revisit",
                    None if first == i else first))
    return sorted(out, key=str)


def test_archives_and_index(spark):
    pages = spark.createDataFrame(PAGES, SCHEMA).withColumn("digest", F.lit("!")).withColumn("n", F.lit(1))
    place = scratch(spark, "warc-test")
    warc.write_archives(pages.repartition(3), place, seconds=F.col("page_id") * 60)
    rows = warc.capture_index(spark, place).collect()
    found = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str)
    assert found == expected(PAGES)
    keys = [(r.urlkey, r.ts) for r in rows]
    assert keys == sorted(keys)
    assert {r.url for r in rows if r.page_id == 7} == {"bad [url%0D%0AX: y"}


def test_no_pages(spark):
    assert warc.archive_and_index(spark.createDataFrame([], SCHEMA)).count() == 0


def test_url_keys():
    assert warc.url_key("http://www.b.example/x?b=2&a=1#f") == warc.url_key("https://b.example:443/x?a=1&b=2")
    assert warc.url_key("http://a.b.example:81/P/") == "example,b,a:81)/p"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 20)), max_size=9))
def test_loser_tree_merges(runs):
    runs = [sorted(r) for r in runs]
    assert list(warc.LoserTree(runs, lambda x: x)) == sorted(x for r in runs for x in r)
