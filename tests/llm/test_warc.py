"""Archive round trips, and the query against its oracle."""

import base64
import hashlib

import pytest

from ordertide.llm import oracles, warc
from ordertide.llm.queries import QUERIES
from tests.comparing import TESTDATA, duck, rows_of

SCHEMA = "page_id long, url string, html string, header string"


def archive(spark, rows, **more):
    folder = warc.new_archive(spark)
    warc.write_archive(spark.createDataFrame(rows, SCHEMA), folder, **more)
    return folder


def test_round_trip(spark):
    rows = [(3, "http://a/", "same", "x"), (1, "http://b/\r\nX: y", "same", "x"), (2, None, None, "x"),
            (5, "http://c/", "", "x"), (4, "http://d/", "é" * 100_000, "x"), (None, "u", "same", "x"),
            (7, "u", "lone", "x"), (7, "u", "lone", "x")]
    folder = archive(spark, rows)
    assert spark.read.parquet(f"{folder}/payloads").count() == 4
    records = warc.read_archive(spark, folder)
    want = {i: (t or "").encode() for i, _, t, _ in rows}
    got = records.collect()
    assert len(got) == len(rows)
    for r in got:
        header = bytes(r.header).decode()
        lines = dict(x.split(": ", 1) for x in header.split("\r\n")[1:] if x)
        assert bytes(r.payload) == want[r.id] and header.endswith("\r\n\r\n")
        digest = base64.b32encode(hashlib.sha1(want[r.id]).digest()).decode()
        assert lines["WARC-Payload-Digest"] == f"sha1:{digest}"
        block = want[r.id] if lines["WARC-Type"] == "response" else b""
        assert bytes(r.record) == bytes(r.header) + block + b"\r\n\r\n"
        assert int(lines["Content-Length"]) == len(block)
    kinds = sorted(((r.page_id, r.record_type, r.refers_to) for r in warc.describe(records).collect()), key=str)
    assert kinds == sorted([
        (1, "response", None), (3, "revisit", 1), (None, "revisit", 1), (2, "response", None),
        (5, "revisit", 2), (4, "response", None), (7, "response", None), (7, "response", None)], key=str)


def test_ids_of_any_text(spark):
    ids = ["a>\r\nWARC-Type: x", "ü %41+ b", "b"]
    pages = spark.createDataFrame([(i, "u", "same") for i in ids], "page_id string, url string, html string")
    folder = warc.new_archive(spark)
    warc.write_archive(pages, folder)
    got = {r.page_id: r for r in warc.describe(warc.read_archive(spark, folder)).collect()}
    assert set(got) == set(ids) and [got[i].refers_to for i in ids] == [None, ids[0], ids[0]]
    assert got[ids[0]].record_type == "response" and len({r.record_sha256 for r in got.values()}) == 3


def test_small_payloads_and_empty_table(spark):
    rows = [(1, "u", "abc", ""), (2, "u", "abc", ""), (3, "u", "abcdef", ""), (4, "u", "abcdef", "")]
    found = warc.describe(warc.read_archive(spark, archive(spark, rows, min_payload=5))).collect()
    assert {r.page_id: r.record_type for r in found} == {
        1: "response", 2: "response", 3: "response", 4: "revisit"}
    assert warc.read_archive(spark, archive(spark, [])).collect() == []


def test_damaged_payload_is_an_error(spark):
    folder = archive(spark, [(1, "u", "abc", "")])
    bad = spark.read.parquet(f"{folder}/payloads").selectExpr("address", "encode('abd', 'utf-8') AS payload")
    bad.write.parquet(f"{folder}-bad/payloads")
    spark.read.parquet(f"{folder}/headers").write.parquet(f"{folder}-bad/headers")
    with pytest.raises(Exception, match="does not verify"):
        warc.read_archive(spark, f"{folder}-bad").collect()


@pytest.mark.parametrize("name", list(oracles.ORACLES))
def test_queries_with_an_oracle(spark, name):
    folder = f"{TESTDATA}/sf0.001"
    df = QUERIES[name](spark, folder)
    cur = duck(folder).execute(oracles.ORACLES[name])
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    assert want and sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == want
