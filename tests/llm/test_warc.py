import base64
import hashlib

from martwright.llm import warc
from martwright.session import fresh_path

FAKE = (
    "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:666>\r\n"
    "Content-Length: 4\r\n\r\nfake\r\n\r\n"
)


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def round_trip(spark, rows, **options):
    path = fresh_path(spark, "warc-test")
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, rank int")
    warc.write(pages, path, **options)
    return warc.read(spark, path).withColumns(
        {"page_id": warc.key_of("record_id"), "first": warc.key_of("refers_to")}
    )


def test_payloads_revisits_and_fakes(spark):
    rows = [
        (1, "http://a/", "<p>one</p>", 1), (2, "http://b/\r\nX: y", "<p>one</p>", 1),
        (9, None, "<p>one</p>", 1), (3, "u", FAKE, 1), (4, "u", "x" + FAKE + FAKE, 1),
        (5, "u", "ends with\r\n\r\n", 1), (6, "u", "\r\n\r\n", 1), (7, "u", "WARC/1.0\r\n", 1),
        (8, "u", None, 1), (10, "u", "", 1), (11, "u", "ünï", 1), (None, "u", "nokey", 1),
        (12, "u", "long " * 100_000, 1), (13, "u", FAKE[:-4], None), (14, "u", "Content-Length: 3\r\n\r\n", 1),
    ]
    out = {r["page_id"]: r for r in round_trip(spark, rows, per_file=4).collect()}
    assert len(out) == len(rows)
    for key, _, html, _ in rows:
        r = out[key]
        assert (r["payload_bytes"], r["payload_digest"]) == (len((html or "").encode()), digest(html))
        assert r["intact"]
        if r["record_type"] == "response":
            assert bytes(r["payload"]).decode() == (html or "")
    kinds = {k: (out[k]["record_type"], out[k]["first"]) for k in (1, 2, 9, 8, 10)}
    assert kinds == {
        1: ("revisit", 9), 2: ("revisit", 9), 9: ("response", None), 8: ("revisit", 10),
        10: ("response", None),
    }


def test_least_bytes_and_empty_table(spark):
    rows = [(1, "u", "same", 1), (2, "u", "same", 1), (3, "u", "longer text", 1), (4, "u", "longer text", 1)]
    out = {r["page_id"]: r["record_type"] for r in round_trip(spark, rows, least_bytes=5).collect()}
    assert out == {1: "response", 2: "response", 3: "revisit", 4: "response"}
    path = fresh_path(spark, "warc-test")
    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read(spark, path).count() == 0


def test_only_the_chain_counts():
    whole = (FAKE + FAKE.replace("666", "667")).encode()
    assert [f["warc-record-id"] for _, f, _ in warc.records(whole)] == ["<urn:page:666>", "<urn:page:667>"]
    assert [p for *_, p in warc.records(whole[:-6])] == [b"fake"]  # truncated
    assert list(warc.records(b"junk" + whole)) == [] and list(warc.records(b"")) == []
    broken = whole.replace(b"Content-Length: 4", b"Content-Length: 5", 1)
    assert list(warc.records(broken)) == []
    nested = FAKE.replace("Content-Length: 4", f"Content-Length: {len(FAKE)}").replace("fake", FAKE)
    assert [p for *_, p in warc.records(nested.encode())] == [FAKE.encode()]


def test_archives_are_bounded_by_bytes(spark, monkeypatch):
    """Pages of all sizes in one partition: no archive holds more than its class allows."""
    import gzip

    monkeypatch.setattr(warc, "SMALL", 100)
    monkeypatch.setattr(warc, "STEP", 4)
    rows = [(n, "u", chr(97 + n % 26) * (n * n) + str(n), 1) for n in range(60)] + [(99, "u", None, 1)]
    path = fresh_path(spark, "warc-test")
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, rank int").coalesce(1)
    warc.write(pages, path, per_file=8)
    out = warc.read(spark, path).withColumn("page_id", warc.key_of("record_id")).collect()
    assert {r["page_id"]: bytes(r["payload"]).decode() for r in out} == {r[0]: r[2] or "" for r in rows}
    held = {}
    for r in out:
        held.setdefault(r["archive"], []).append(r["payload_bytes"])
    assert len(held) > 8 and all(len(sizes) == 1 or sum(sizes) <= 800 for sizes in held.values())
    files = spark.read.format("binaryFile").load(path).select("content").collect()
    assert max(len(gzip.decompress(f[0])) for f in files) <= 3481 + 400 + 8 * 300
