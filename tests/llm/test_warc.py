import hashlib
import random

import brute_llm as brute
import pytest

from segrec.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, n int, record_type string"


def archived(frame, pages, **options):
    df = frame([(p, f"http://e.org/\u00e9 {p}?a=%20", h, "clash", 1, "x") for p, h in pages], SCHEMA)
    return warc.archive_pages(df, **options)


def test_records_read_back(frame):
    rng = random.Random(2)
    body = "<p>caf\u00e9</p>\r\n\r\nWARC/1.1\r\n" * 20
    pages = [(i, body if i % 3 == 0 else rng.choice(["", None, "x" * 99, "x" * 100, f"page {i} " * 30])) for i in range(60)]
    big = "".join(rng.choice("abc\r\n") for _ in range(700_000))
    pages += [(100, big), (101, big), (99, body)]
    manifest = archived(frame, pages, file_bytes=2000)
    chunks = warc.read_chunks(manifest).collect()
    last = [r for r in chunks if r["is_last"]]
    got = {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in last}
    assert got == brute.records(pages) and len(last) == len(pages)
    rows = sorted((r for r in chunks if r["page_id"] == 100), key=lambda r: r["chunk_no"])
    assert [r["chunk_no"] for r in rows] == [0, 1, 2]  # an oversized payload is several rows
    seen = hashlib.sha256()
    for r in rows:
        seen.update(r["payload"])
        assert r["payload_digest"] == seen.hexdigest()  # the digest so far
    assert b"".join(bytes(r["payload"]) for r in rows) == big.encode()
    assert manifest.count() > 3


def test_nulls_repeats_and_empty_table(frame):
    same = "y" * 200
    chunks = warc.read_chunks(archived(frame, [(None, same), (5, same), (5, same), (7, same)]), payloads=False).collect()
    assert sorted((str(r["page_id"]), r["record_type"], r["refers_to"]) for r in chunks) == [
        ("5", "response", None), ("5", "response", None), ("7", "revisit", 5), ("None", "revisit", 5)]
    only = warc.read_chunks(archived(frame, [(None, same), (None, same)])).collect()
    assert [r["record_type"] for r in only] == ["response", "response"]
    assert warc.read_chunks(archived(frame, [])).count() == 0


def test_damage_is_noticed(frame):
    manifest = archived(frame, [(i, f"page {i} " * 50) for i in range(5)])
    for row in manifest.collect():
        fs, path = warc.file_system(row["file"])
        with open(path, "rb") as f:
            data = f.read()
        with open(path, "wb") as f:
            f.write(data[:-10])
    with pytest.raises(Exception, match="ends within a record"):
        warc.read_chunks(manifest).collect()


def test_no_payload_is_shuffled(spark, frame):
    from plan_metrics import nodes

    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pages = frame([(i, f"u{i}", f"body {i % 7} " * 60, "clash", 1, "x") for i in range(700)], SCHEMA)
        planned = warc.plan_records(pages)
        assert planned.count() == 700
        planned.collect()
        exchanges = [n.output().toString() for n in nodes(planned._jdf.queryExecution().executedPlan()) if "Exchange" in n.nodeName()]
        assert exchanges and not any("piece" in x for x in exchanges)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
