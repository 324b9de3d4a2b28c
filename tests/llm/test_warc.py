"""The archive gives back every payload and exact records; revisits follow the rule."""

from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.errors import PySparkException

from premia.llm import warc

LONG, SHORT = "é" * 700, "x" * 999
ROWS = [
    (1, "http://a/1", LONG, 9),
    (5, "http://a/\r\nWARC-Type: fake", LONG, 9),
    (3, None, LONG, 9),
    (7, "u", SHORT, 9),
    (8, "u", SHORT, 9),
    (9, "u", None, 9),
    (10, "u", "", 9),
    (None, "n", LONG, 9),
    (11, "one", "y" * 1000, 9),
    (12, "two", "z" * 2000, 9),
    (12, "two", "z" * 2000, 9),
    (2, "u", "<p>WARC-Type: revisit\r\n\r\nWARC/1.1</p>" * 40, 9),
]


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("warc") / "a")
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string, payload int")
    warc.write_archive(pages, root)
    return root


def test_payloads_types_and_references(spark, archive):
    got = {(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, bytes(r.payload)) for r in warc.read_records(spark, archive).collect()}
    want = set()
    for i, _, html, _ in ROWS:
        raw = (html or "").encode()
        top = max(x[0] for x in ROWS if (x[2] or "") == (html or "") and x[0] is not None)
        again = len(raw) >= 1000 and i != top
        want.add((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", top if again else None, raw))
    assert got == want
    assert warc.read_records(spark, archive).count() == len(ROWS)


def test_payload_bytes_are_stored_once(spark, archive):
    assert spark.read.parquet(f"{archive}/payloads").count() == len({x[2] or "" for x in ROWS})


def test_records_are_well_formed(spark, archive):
    for r in warc.read_records(spark, archive).collect():
        raw = bytes(r.record)
        fields, _, rest = raw.partition(b"\r\n\r\n")
        assert fields.startswith(b"WARC/1.1\r\nWARC-Type: " + r.record_type.encode())
        length = int(re.search(rb"\r\nContent-Length: (\d+)$", fields)[1])
        assert rest[length:] == b"\r\n\r\n"
        assert rest[:length].partition(b"\r\n\r\n")[2] == (bytes(r.payload) if r.record_type == "response" else b"")


def test_a_changed_payload_is_noticed(spark, archive, tmp_path):
    from pyspark.sql import functions as F

    spark.read.parquet(f"{archive}/records").write.parquet(f"{tmp_path}/records")
    broken = spark.read.parquet(f"{archive}/payloads").withColumn("payload", F.concat("payload", F.lit(b"!")))
    broken.write.parquet(f"{tmp_path}/payloads")
    with pytest.raises(PySparkException, match="doesn't match its digest"):
        warc.read_records(spark, str(tmp_path)).select("payload_digest").collect()


@pytest.mark.parametrize("mark", ["\x85", "\u2028", "\u2029", "\n", "\r\n", "\x0b"])
def test_a_url_cannot_forge_fields(spark, tmp_path, mark):
    url = f"http://a{mark}WARC-Refers-To: <urn:page:99>{mark}WARC-Type: revisit"
    warc.write_archive(spark.createDataFrame([(1, url, "x")], "page_id long, url string, html string"), f"{tmp_path}/f")
    row = warc.read_records(spark, f"{tmp_path}/f").first()
    assert (row.page_id, row.record_type, row.refers_to) == (1, "response", None)
    assert row.url == url.replace("\r", "%0D").replace("\n", "%0A")


def test_text_ids(spark, tmp_path):
    ids = ["a b>", "é%41", "null", None, "", "7"]
    pages = spark.createDataFrame([(i, "u", "x" * 2000) for i in ids], "page_id string, url string, html string")
    warc.write_archive(pages, f"{tmp_path}/t")
    rows = warc.read_records(spark, f"{tmp_path}/t", id_type="string").collect()
    assert {r.page_id: r.refers_to for r in rows} == {i: None if i == "é%41" else "é%41" for i in ids}
    with pytest.raises(PySparkException, match="a page id is no bigint"):
        warc.read_records(spark, f"{tmp_path}/t").collect()


def test_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archive(pages, f"{tmp_path}/e")
    assert warc.read_records(spark, f"{tmp_path}/e").count() == 0
