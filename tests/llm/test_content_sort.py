import hashlib
from collections import Counter

from tidemark.llm.content_sort import content_sort


def check(df, rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    found = df.collect()
    assert len(found) == len(rows)
    top = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    sha = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
    assert Counter((r.doc_id, sha[r.text_sha256]) for r in found) == Counter((i, t or "") for i, t in rows)
    for r in found:
        t = sha[r.text_sha256]
        assert (r.keep_id, r.group_size) == (top[t], len(groups[t]))
        assert not r.kept or r.doc_id == r.keep_id
    assert Counter(sha[r.text_sha256] for r in found if r.kept) == Counter(list(groups))


def test_odd_rows(odd, odd_rows):
    check(content_sort(odd), odd_rows)


def test_groups_across_partitions(spark):
    rows = [(i, f"prefix of text {min(i // 40, 3)}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check(content_sort(df.repartition(5)), rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_no_rows(spark):
    assert content_sort(spark.createDataFrame([], "doc_id long, text string")).count() == 0
