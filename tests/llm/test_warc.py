import base64
import hashlib
import io
import zlib

import pytest

from strata.llm import warc

BIG = "<p>" + "é" * 600 + "</p>"
SCHEMA = "page_id bigint, url string, html string, digest string, refers_to bigint"


def test_table_edge_cases(spark):
    rows = [(1, "http://a/", BIG), (5, "http://b/ x\r\ny", BIG), (3, None, BIG), (None, "u", BIG), (2, "u", "small"), (4, "u", "small"), (6, "u", None), (7, "u", ""), (8, "u", "x\r\n\r\ny" * 300),
            (9, "u", "z" * 300_000), (9, "u", "z" * 300_000), (None, "u", "q" * 2000), (None, "u", "q" * 2000)]
    df = spark.createDataFrame([r + ("d", 77) for r in rows], SCHEMA).repartition(3)
    got = warc.round_trip(df).collect()
    assert len(got) == len(rows)
    keep = {BIG: 5, "z" * 300_000: 9}

    def want(p, html):
        html = html or ""
        k = keep.get(html)
        refers = k if k is not None and (p is None or p < k) else None
        return (p, len(html.encode()), hashlib.sha1(html.encode()).hexdigest(), "response" if refers is None else "revisit", refers, html if refers is None else None)

    key = lambda r: repr(r)
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], r["html"]) for r in got), key=key) == sorted((want(p, h) for p, _, h in rows), key=key)
    assert warc.round_trip(df.limit(0)).count() == 0


def test_archives_are_split(spark):
    df = spark.createDataFrame([(i, "u", f"{i}" * 3000, "", 0) for i in range(40)], SCHEMA).coalesce(1)
    from strata.session import scratch_path
    manifest = warc.write_archives(df, scratch_path(spark, "warc-test"), archive_bytes=600)
    assert manifest.count() > 5 and manifest.agg({"n_records": "sum"}).first()[0] == 40
    assert warc.read_archives(manifest).count() == 40


def stream(*records):
    return io.BytesIO(b"".join(records))


def test_reader_reads_in_small_steps():
    records = [warc.record_bytes(i, f"http://x/{i}", f"body {i}".encode() * i) for i in range(20)]
    for step in (1, 7, 1 << 16):
        rows = [warc.page_of(h, b) for h, b in warc.read_records(stream(*records), step)]
        assert [r["html"] for r in rows] == [f"body {i}" * i for i in range(20)]
        assert [r["page_id"] for r in rows] == [str(i) for i in range(20)]


def test_revisit_record_names_its_response():
    head, block = next(warc.read_records(stream(warc.record_bytes(1, "u", b"abc", refers_to=9))))
    assert head["warc-type"] == "revisit" and head["x-refers-to-page-id"] == "9" and head["warc-profile"] == warc.PROFILE
    assert head["warc-payload-digest"] == "sha1:" + base64.b32encode(hashlib.sha1(b"abc").digest()).decode() and block.endswith(b"\r\n\r\n")


def rewritten(change):
    plain = zlib.decompress(warc.record_bytes(1, "u", b"payload"), 31)
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(change(plain)) + packer.flush()


@pytest.mark.parametrize("change", [
    lambda b: b.replace(b"payload", b"Payload"),
    lambda b: b.replace(b"\nContent-Length: ", b"\nContent-Length: 1", 1),
    lambda b: b.replace(b"\nContent-Length: ", b"\nContent-Length: x", 1),
    lambda b: b[:-4],
    lambda b: b + b"more",
    lambda b: b"HTTP" + b[4:],
])
def test_bad_records_are_refused(change):
    with pytest.raises(warc.WarcError):
        for head, block in warc.read_records(stream(rewritten(change))):
            warc.page_of(head, block)


def test_truncated_and_foreign_data_are_refused():
    record = warc.record_bytes(1, "u", b"payload" * 100)
    for data in (record[:-5], record + record[:30], record + b"garbage"):
        with pytest.raises(warc.WarcError):
            list(warc.read_records(stream(data)))
