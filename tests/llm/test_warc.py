"""WARC archives: exact round trip of awkward payloads, and revisits against a plain grouping."""
import base64
import hashlib
import random

from pyspark.sql import functions as F

from sheaf.llm import warc as W


def data():
    rng = random.Random(8)
    bits = ["\r\n\r\n", "\r\n", "\r", "\n", "a", "é", "𝄞", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 9\r\n\r\n", "page-id: 7", "\x00", " "]
    rows = [(None, "http://x/", "null id"), (4, None, "x"), (5, "u\r\nEvil: 1", None), (6, "", ""), (7, "http://a/b?c", "\r\n\r\n"), (8, "x", "\r\n"),
            (9, "http://big/", "z" * 300_000)]
    for k in range(10, 200):
        rows.append((k, f"http://h{k % 7}.org/p/{k}", "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))))
    rows += [(300 + k, "http://hot/", "the same") for k in range(60)] + [(310, "http://hot/", "the same")]
    return rows + rows[-3:] + [(300, "http://hot/", "the same"), (None, "http://y/", "null id"), (None, "http://hot/", "the same")]


def want(rows):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        raw, f = (h or "").encode(), first.get(h or "")
        new = f == i
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if new else "revisit", None if new else f))
    return sorted(out, key=repr)


def test_round_trip(spark, tmp_path):
    rows = data()
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(5).withColumn("key", F.lit("mine"))
    path = str(tmp_path / "warc")
    W.write_archives(pages, path)
    records = W.read_records(spark, path)
    kinds = {r["type"]: r["count"] for r in records.groupBy("type").count().collect()}
    assert kinds["request"] == kinds["metadata"] == len(rows) == kinds["response"] + kinds["revisit"]
    out = W.assemble(records)
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.response["type"], r.refers_to) for r in out.collect()), key=repr)
    assert got == want(rows)
    one = out.filter("page_id = 5").first()
    assert one.request.uri == one.response.uri == "u%0D%0AEvil: 1"


def test_header_digest_is_the_payloads(spark, tmp_path):
    path = str(tmp_path / "warc")
    W.write_archives(spark.createDataFrame(data(), "page_id bigint, url string, html string"), path)
    r = W.read_records(spark, path).filter("type = 'response'")
    assert r.filter("digest = found_digest").count() == r.count() > 100


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "warc")
    W.write_archives(spark.createDataFrame([], "page_id bigint, url string, html string"), path)
    assert W.assemble(W.read_records(spark, path)).count() == 0
