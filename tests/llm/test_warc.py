import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm.warc import parse_members, read_warc, write_warc
from tidemark.session import scratch_path

BIG = "x" * 150
ROWS = [(5, "http://a/5", BIG), (3, "http://a/3", BIG), (3, "http://a/3", BIG), (9, None, BIG), (None, "http://n/", BIG), (None, "http://n/", None),
        (7, "http://a/7\r\nWARC-Type: evil", "small"), (8, "http://a/8", "small"), (1, "http://a/1", None), (2, "http://a/2", "é" * 60), (4, "u", "é" * 60),
        (6, "u", "\r\n\r\nWARC/1.1\r\n\r\n"), (10, "u", "long " * 100_000)]


def expected(rows):
    out, seen = [], set()
    for i, _, html in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        data = (html or "").encode()
        ids = [j for j, _, h in rows if (h or "").encode() == data and j is not None]
        first = min(ids, default=None)
        revisit = len(data) >= 100 and first is not None and (i != first or (i, data) in seen)
        seen.add((i, data))
        out.append((str(i), len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "p", "d") for r in ROWS], "page_id long, url string, html string, payload string, digest string").repartition(3)


@pytest.mark.parametrize("roll", [1, 300, 1 << 28])
def test_round_trip(spark, pages, roll):
    out = scratch_path(spark, "test-warc")
    manifest = write_warc(pages, out, roll_bytes=roll, ranges=3)
    assert manifest.agg(F.sum("records")).first()[0] == len(ROWS) and (roll > 1 or manifest.count() == len(ROWS))
    rows = read_warc(spark, out).collect()
    assert sorted(((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows), key=str) == expected(ROWS)
    urls = {(str(r["page_id"]), r["url"]) for r in rows}
    assert ("9", None) in urls and ("7", "http://a/7%0D%0AWARC-Type: evil") in urls


def test_archives_are_gzip_in_id_order_and_deterministic(spark, pages):
    a, b = scratch_path(spark, "test-warc"), scratch_path(spark, "test-warc")
    first, second = (write_warc(p, o, ranges=2).orderBy("part", "piece").collect() for p, o in ((pages, a), (pages.repartition(5), b)))
    assert [r["sha256"] for r in first] == [r["sha256"] for r in second]
    ids = []
    for r in first:
        data = open(r["path"].removeprefix("file:"), "rb").read()
        assert hashlib.sha256(data).hexdigest() == r["sha256"] and len(data) == r["n_bytes"] and gzip.decompress(data).startswith(b"WARC/1.1\r\n")
        ids += [h["WARC-Record-ID"].split(":")[2] for h, _ in parse_members(r["path"]) if h["WARC-Type"] != "warcinfo"]
    assert ids == ["None", "None", *map(str, sorted(i for i, _, _ in ROWS if i is not None))]


def test_damage_is_found(spark, pages, tmp_path):
    path = write_warc(pages, scratch_path(spark, "test-warc"), ranges=1).first()["path"]
    data = open(path.removeprefix("file:"), "rb").read()
    for k, bad in enumerate((data[:-9], data[:len(data) // 2])):
        f = tmp_path / f"{k}.warc.gz"
        f.write_bytes(bad)
        with pytest.raises(ValueError):
            list(parse_members(str(f)))


def test_files_outside_the_manifest_do_not_count(spark, pages):
    out = scratch_path(spark, "test-warc")
    write_warc(pages, out, ranges=2)
    with open(f"{out.removeprefix('file:')}/pages-999999-0000.warc.gz", "wb") as f:
        f.write(b"left by a failed task")
    assert read_warc(spark, out).count() == len(ROWS)


def test_empty_table(spark, pages):
    out = scratch_path(spark, "test-warc")
    assert write_warc(pages.limit(0), out).count() == 0 and read_warc(spark, out).count() == 0


def written(spark, pages, **how):
    """Name, records and SHA-256 of every archive."""
    out = scratch_path(spark, "test-warc")
    return out, [(r["path"].rsplit("/", 1)[1], r["records"], r["sha256"]) for r in write_warc(pages, out, **how).orderBy("part", "piece").collect()]


def test_the_given_pages_give_the_same_archives_however_partitioned(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    first, again, dealt = (written(spark, p, ranges=4)[1] for p in (pages, pages, pages.repartition(7, "url")))
    assert first == again == dealt and len(first) == 4
    sizes = [n for _, n, _ in first]
    assert max(sizes) - min(sizes) <= 1


def test_null_and_repeated_ids_are_cut_like_others(spark):
    rows = [(None if k % 3 == 0 else 7 if k % 3 == 1 else k, f"u{k}", f"payload {k // 2} " * 20) for k in range(300)]
    rows += [(5, "same", "s" * 200)] * 150                                   # copies of one row
    frame = spark.createDataFrame([(*r, "p", "d") for r in rows], "page_id long, url string, html string, payload string, digest string")
    out, files = written(spark, frame.repartition(6), ranges=9)
    sizes = sorted(n for _, n, _ in files)
    assert len(files) == 9 and sizes[-1] <= 1.5 * sizes[4] and sizes[-1] - sizes[0] <= 1
    assert files == written(spark, frame.repartition(2), ranges=9)[1]
    got = read_warc(spark, out).collect()
    assert sorted(((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=str) == expected(rows)


@pytest.mark.parametrize("ranges", [1, 40])
def test_any_number_of_shards_holds_all_records(spark, pages, ranges):
    out, files = written(spark, pages, ranges=ranges)
    assert sum(n for _, n, _ in files) == len(ROWS)
    rows = read_warc(spark, out).collect()
    assert sorted(((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows), key=str) == expected(ROWS)
