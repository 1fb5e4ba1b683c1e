"""WARC round trips through the verified chain: magic inside payloads, splits inside records, damaged files, edge cases."""

import hashlib

import pytest
from pyspark.sql import functions as F

from curbline.llm import warc
from curbline.llm.common import scratch_path

FAKE = "WARC/1.1\r\nWARC-Type: response\r\nX-Page-ID: 999\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
BIG = "x" * 150
ROWS = [(1, "http://a/\r\nb", "<p>é</p>"), (2, None, None), (3, "u", ""), (4, "u", f"evil\n{FAKE}tail\n{FAKE}"), (5, "u", BIG),
        (6, "u", BIG), (7, "u", FAKE * 200), (8, "u", "short"), (9, "u", "short"), (10, "u", BIG), (None, "u", BIG),
        (12, "u", "\n" + FAKE), (13, "u", "end\r\n\r\n"), (14, "WARC/1.1", "a" * 60_000), (15, "u", "\nWARC/1.1"), (5, "u", BIG)]


@pytest.fixture(scope="module")
def archives(spark):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    path = scratch_path(spark, "warc-test")
    warc.write_archives(df.coalesce(2), path)
    return path


@pytest.mark.parametrize("split,with_payload", [("128m", False), ("4096", True), ("4096", False)])
def test_round_trip(spark, archives, split, with_payload):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found = warc.read_archives(spark, archives, with_payload).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    got = sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in found)
    want = []
    for page, _, text in ROWS:
        body = (text or "").encode()
        again = text == BIG and page != 5
        want.append((str(page), len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", 5 if again else None))
    assert got == sorted(want, key=lambda r: r[:1] + r[1:])
    for r in found if with_payload else ():
        if r["record_type"] == "response":
            assert bytes(r["payload"]) == (dict((p, t) for p, _, t in ROWS)[r["page_id"]] or "").encode()
    assert {r["url"] for r in found if r["page_id"] in (1, 2)} == {"http://a/%0D%0Ab", None}


def test_chain_ends_where_a_file_is_damaged(spark, tmp_path):
    record = "WARC/1.1\r\nWARC-Type: response\r\nX-Page-ID: {}\r\nContent-Length: {}\r\n\r\n{}\r\n\r\n"
    text = record.format(1, 3, "abc") + record.format(2, 7, "wrong") + record.format(3, 3, "abc")
    (tmp_path / "a.warc").write_bytes(text.encode())
    (tmp_path / "b.warc").write_bytes(record.format(4, 2, "ok").encode()[:-2])  # cut before its end
    (tmp_path / "c.warc").write_bytes(b"no archive at all")
    assert [r["page_id"] for r in warc.read_archives(spark, str(tmp_path)).collect()] == [1]


def test_pointer_jumping(spark):
    chain = [("f", k * 10, (k + 1) * 10) for k in range(37)] + [("f", 5, 20), ("f", 7, None), ("g", 0, 3), ("g", 4, 0)]
    found = warc.reached(spark.createDataFrame(chain, "file string, offset long, successor long")).collect()
    assert sorted(map(tuple, found)) == [("f", k * 10) for k in range(37)] + [("g", 0)]


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    path = scratch_path(spark, "warc-empty")
    warc.write_archives(df, path)
    assert warc.read_archives(spark, path).count() == 0


def test_ids_of_any_long(spark):
    big = "y" * 150
    ids = [2**63 - 1, -2**63, 10**18, 10**18 + 1, -10**18, -5, 0]
    df = spark.createDataFrame([(k, "u", big) for k in ids[2:4]] + [(k, "u", f"own {k}") for k in ids[:2] + ids[4:]],
                               "page_id long, url string, html string")
    path = scratch_path(spark, "warc-ids")
    warc.write_archives(df, path)
    found = {r["page_id"]: r["refers_to"] for r in warc.read_archives(spark, path).collect()}
    assert found == {k: 10**18 if k == 10**18 + 1 else None for k in ids}


@pytest.mark.parametrize("text,value", [
    ("9223372036854775807", 2**63 - 1), ("9223372036854775808", None), ("-9223372036854775808", -2**63),
    ("-9223372036854775809", None), ("000000000000000000000007", 7), ("9" * 5000, None), ("", None), ("-", None), ("1x", None)])
def test_stated_integers(text, value):
    assert warc.long_of(text) == value
