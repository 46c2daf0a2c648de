"""WARC archives: round trip, revisits, rolling, determinism, leftovers of lost attempts, damage."""

import base64
import hashlib
import os

import pytest

from starloom.llm import warc

PAGES = [
    (5, "http://a/x y\r\n", "<p>é</p>" * 50), (2, None, "<p>é</p>" * 50), (9, "http://b", None), (1, "http://c", ""), (None, "http://d", "<p>é</p>" * 50),
    (7, "http://e", "only"), (7, "http://e", "only"), (3, "http://f", "big " * 40_000), (4, "http://g", "a\r\n\r\nb"), (-8, "http://h", "WARC/1.1\r\n"),
    (None, "http://i", "nulls only"), (None, "http://i", "nulls only"),
]


@pytest.fixture()
def pages(spark):
    return spark.createDataFrame([(*p, 1, "s") for p in PAGES], "page_id long, url string, html string, range int, payload string").repartition(4)


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def files(root):
    return {n: open(os.path.join(root, n), "rb").read() for n in os.listdir(root) if n.endswith(".gz") and not n.startswith(".")}


@pytest.mark.parametrize("sizes", [{}, {"file_bytes": 300, "range_bytes": 2000}])
def test_round_trip(spark, pages, sizes):
    root = warc.archive_root(spark)
    manifest = warc.write_warcs(pages, root, **sizes)
    got = warc.read_warcs(manifest, root).collect()
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest) for r in got) == sorted((str(i), len((h or "").encode()), digest(h)) for i, _, h in PAGES)
    texts = {digest(h): (h or "").encode() for _, _, h in PAGES}
    for r in got:
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == texts[r.payload_digest]
    kinds = sorted(((str(r.page_id), r.record_type, r.refers_to) for r in got), key=str)
    assert kinds == sorted([
        ("2", "response", None), ("5", "revisit", 2), ("None", "revisit", 2), ("1", "response", None), ("9", "revisit", 1), ("7", "response", None), ("7", "revisit", 7),
        ("3", "response", None), ("4", "response", None), ("-8", "response", None), ("None", "response", None), ("None", "revisit", None),
    ], key=str)
    names = {r.name for r in manifest.collect()}
    assert set(files(root)) == names and (len(names) > 3) == bool(sizes)


def test_small_payloads_can_be_excepted(spark, pages):
    root = warc.archive_root(spark)
    got = warc.read_warcs(warc.write_warcs(pages, root, min_revisit_bytes=5), root)
    assert {r.record_type for r in got.filter("payload_bytes < 5").collect()} == {"response"}
    assert got.filter("payload_bytes >= 5 AND record_type = 'revisit'").count() == 3


def test_reruns_write_the_same_files(spark, pages):
    first, second = warc.archive_root(spark), warc.archive_root(spark)
    for root, n in ((first, 2), (second, 7)):
        warc.write_warcs(pages.repartition(n), root, file_bytes=500, range_bytes=2000)
    assert files(first) == files(second) and len(files(first)) > 2


def test_lost_attempts_leave_nothing(spark, pages):
    root = warc.archive_root(spark)
    os.makedirs(f"{root}/_temporary")
    open(f"{root}/_temporary/lost-range-00000-00000.warc.gz", "wb").write(b"half a rec")
    manifest = warc.write_warcs(pages, root)
    assert not os.path.exists(f"{root}/_temporary") and warc.read_warcs(manifest, root).count() == len(PAGES)


def test_damage_is_found(spark, pages):
    import gzip

    root = warc.archive_root(spark)
    manifest = warc.write_warcs(pages, root)
    name = f"{root}/{manifest.first().name}"
    data = gzip.open(name).read()
    open(name, "wb").write(gzip.compress(data.replace(b"only", b"0nly")))
    with pytest.raises(Exception, match="another digest"):
        warc.read_warcs(manifest, root).count()


def test_empty_table(spark, pages):
    root = warc.archive_root(spark)
    assert warc.read_warcs(warc.write_warcs(pages.limit(0), root), root).count() == 0


def test_files_roll_at_the_shipped_ratio(spark):
    """Ranges and files scaled down alike: a range of usual pages is several files."""
    page = "concat('<html><body><p>', array_join(transform(sequence(1, 40), i -> sha1(concat(id, ':', i % 9))), ' '), '</p></body></html>')"
    pages = spark.range(400).selectExpr("id as page_id", "concat('http://x/', id) as url", f"{page} as html")
    root = warc.archive_root(spark)
    manifest = warc.write_warcs(pages, root, file_bytes=warc.FILE_BYTES >> 8, range_bytes=warc.RANGE_BYTES >> 8).collect()
    assert max(r.seq for r in manifest) >= 1 and max(r.range for r in manifest) >= 2
    assert sum(r.records for r in manifest) == 400


def test_null_and_repeated_ids_are_split(spark):
    """A third of all ids null and a third the same: no range has much more than its share of bytes."""
    pages = spark.range(900).selectExpr("if(id % 3 = 0, null, if(id % 3 = 1, 7, id)) as page_id", "'u' as url", "repeat(sha1(cast(id as string)), 10) as html")
    root = warc.archive_root(spark)
    manifest = warc.write_warcs(pages, root, range_bytes=20_000).collect()
    per_range = {r.range: r.records for r in manifest}
    assert len(per_range) == 18 and max(per_range.values()) <= 52
    assert warc.read_warcs(spark.createDataFrame(manifest), root).count() == 900


def test_many_files_are_read_in_many_tasks(spark, pages):
    from pyspark.sql import functions as F

    root = warc.archive_root(spark)
    manifest = warc.write_warcs(pages, root, file_bytes=300, range_bytes=2000)
    read = warc.read_warcs(manifest, root, task_bytes=400)
    assert read.select(F.spark_partition_id()).distinct().count() > 1 and read.count() == len(PAGES)


def test_ranges_of_ids_and_keys():
    import numpy as np

    bounds = np.array([5, 7, 7, 7, 9]), np.array([1, 10, 20, 30, 0])
    ids, keys = np.array([4, 5, 5, 6, 7, 7, 7, 7, 8, 9, 10]), np.array([99, 0, 1, 0, 5, 10, 29, 30, 0, 0, 0])
    want = [sum((a, b) <= (i, k) for a, b in zip(*bounds)) for i, k in zip(ids, keys)]
    assert warc._ranges(ids, keys, bounds).tolist() == want
