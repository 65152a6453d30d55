"""WARC archives: writing with revisit records, and a sequential reader.

Every record is one gzip member. The reader takes the file in small blocks
through an incremental zlib decompressor, frames each record by its
Content-Length, checks that the member ends where the record ends, and verifies
block and payload digests. Tasks write whole archive files into the shared
folder under names of their own attempt and report them; only the files that
committed tasks reported are read, so lost or repeated tasks leave no trace in
the result.
"""

from __future__ import annotations

import base64
import hashlib
import math
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from strata.session import scratch_path

MIN_REVISIT_BYTES = 1000
ARCHIVE_BYTES = 256 << 20
READ_BYTES = 1 << 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class WarcError(ValueError):
    """A record that is truncated, badly framed or fails its digest."""


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _clean(value: str) -> str:
    """Header values hold no line ends or blanks."""
    return "".join(c if c > " " else f"%{ord(c):02X}" for c in value)


def _record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def record_bytes(page_id, url: str | None, payload: bytes, refers_to=None, date: str = "1970-01-01T00:00:00Z", level: int = 6) -> bytes:
    """One gzip member with a response record, or with a revisit of `refers_to`."""
    digest = _sha1(payload)
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is None:
        block += payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_record_id(page_id, digest)}", f"WARC-Date: {date}",
            f"WARC-Target-URI: {_clean(url) if url else 'about:blank'}", "Content-Type: application/http;msgtype=response",
            f"WARC-Payload-Digest: {digest}", f"WARC-Block-Digest: {_sha1(block)}", f"Content-Length: {len(block)}"]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to, digest)}", f"X-Refers-To-Page-Id: {refers_to}"]
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def read_records(stream: BinaryIO, read_bytes: int = READ_BYTES) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of a .warc.gz stream, in order. At most one
    record and one read are held. Raises WarcError where framing or digest fails."""
    rest = b""
    while True:
        rest = rest or stream.read(read_bytes)
        if not rest:
            return
        member, data, head, size = zlib.decompressobj(31), bytearray(), None, None
        while not member.eof:
            if not rest and not (rest := stream.read(read_bytes)):
                raise WarcError("archive ends inside a record")
            try:
                data += member.decompress(rest)
            except zlib.error as e:
                raise WarcError(f"not a gzip member: {e}") from e
            rest = member.unused_data
            if head is None and (end := data.find(b"\r\n\r\n")) >= 0:
                lines = bytes(data[:end]).decode("utf-8").split("\r\n")
                if not lines[0].startswith("WARC/"):
                    raise WarcError("no WARC version line")
                head = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
                if not head.get("content-length", "").isdigit():
                    raise WarcError("no Content-Length")
                size = int(head["content-length"])
                del data[: end + 4]
            if size is not None and len(data) > size + 4:
                raise WarcError("data beyond Content-Length")
        if head is None or len(data) != size + 4 or data[size:] != b"\r\n\r\n":
            raise WarcError("record does not end at its Content-Length")
        block = bytes(data[:size])
        if _sha1(block) != head.get("warc-block-digest", _sha1(block)):
            raise WarcError("block digest differs")
        yield head, block


def page_of(head: dict[str, str], block: bytes) -> dict:
    """A record as a row; the payload digest of a response is verified."""
    http, _, payload = block.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in http.decode("utf-8").split("\r\n")[1:])}
    kind, digest = head["warc-type"], head["warc-payload-digest"]
    if kind == "response" and (_sha1(payload) != digest or len(payload) != int(fields["content-length"])):
        raise WarcError("payload digest or length differs")
    url = head.get("warc-target-uri")
    return {
        "page_id": head.get("x-page-id"), "url": None if url == "about:blank" else url, "payload_bytes": int(fields["content-length"]),
        "payload_digest": base64.b32decode(digest.partition(":")[2]).hex(), "record_type": kind, "refers_to": head.get("x-refers-to-page-id"),
        "html": payload.decode("utf-8") if kind == "response" else None,
    }


def _open(uri: str, mode: str):
    """A file in the shared folder, by whatever store its URI names."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri if ":" in uri.split("/")[0] else "file://" + uri)
    if mode == "r":
        return store.open_input_stream(path, compression=None)
    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return store.open_output_stream(path, compression=None)


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   min_bytes: int = MIN_REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes .warc.gz files under `folder`; returns the manifest (path, n_records, n_bytes), already stored.

    Of rows with equal payloads of at least `min_bytes` bytes those with the largest id are responses,
    the others revisit it; a row with a null id revisits too, unless all ids are null. A null html is
    an empty payload. An empty table writes no archive.
    """
    spark: SparkSession = pages.sparkSession
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.encode("html", "UTF-8")))
    first = (
        rows.where(F.octet_length("html") >= min_bytes).groupBy("digest").agg(F.max("page_id").alias("keep"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and keep is not null").select("digest", "keep")
    )
    told = rows.join(first, "digest", "left").select("page_id", "url", "html", F.when(F.col("page_id").isNull() | (F.col("page_id") < F.col("keep")), F.col("keep")).alias("refers_to"))

    def write(batches):
        out, path, records, size = None, None, 0, 0
        for rb in batches:
            cols = [rb.column(i).to_pylist() for i in (0, 1, 3)]
            for i, html in enumerate(rb.column(2)):
                if out is None:
                    path, records, size = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = _open(path, "w")
                data = record_bytes(cols[0][i], cols[1][i], html.as_buffer().to_pybytes(), cols[2][i])
                out.write(data)
                records, size = records + 1, size + len(data)
                if size >= archive_bytes:
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_pydict({"path": [path], "n_records": [records], "n_bytes": [size]})
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "n_records": [records], "n_bytes": [size]})

    told.mapInArrow(write, "path string, n_records bigint, n_bytes bigint").write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def read_archives(manifest: DataFrame, with_html: bool = True, id_type: str = "bigint") -> DataFrame:
    """The records of all archives of a manifest: page_id, url, payload_bytes,
    payload_digest (hex SHA-1), record_type, refers_to and, with `with_html`, the
    payload (null for revisits). One archive is read by one task, sequentially."""
    count = manifest.agg(F.sum("n_records").alias("r"), F.count(F.lit(1)).alias("n")).first()
    schema = StructType.fromDDL("page_id string, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to string" + (", html string" if with_html else ""))
    arrow = to_arrow_schema(schema)

    def read(batches):
        for rb in batches:
            for path, expected in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist()):
                rows, held, seen = [], 0, 0
                with _open(path, "r") as stream:
                    for head, block in read_records(stream):
                        row = page_of(head, block)
                        rows.append({f.name: row[f.name] for f in arrow})
                        seen, held = seen + 1, held + (len(block) if with_html else 0)
                        if len(rows) >= 2000 or held >= 16 << 20:
                            yield pa.RecordBatch.from_pylist(rows, arrow)
                            rows, held = [], 0
                if seen != expected:
                    raise WarcError(f"{path}: {seen} records, {expected} were written")
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, arrow)

    # An archive per task: the manifest is tiny and would otherwise be read by one.
    dealt = manifest.select("path", "n_records").repartitionByRange(max(1, math.ceil(count["n"])), "path")
    out = dealt.mapInArrow(read, schema)
    return out.withColumn("page_id", F.col("page_id").cast(id_type)).withColumn("refers_to", F.col("refers_to").cast(id_type))


def round_trip(pages: DataFrame, with_html: bool = True, **columns: str) -> DataFrame:
    """Writes archives for all rows of `pages` into the shared folder and reads them back."""
    id_type = pages.schema[columns.get("id_col", "page_id")].dataType.simpleString()
    return read_archives(write_archives(pages, scratch_path(pages.sparkSession, "warc"), **columns), with_html, id_type)


ORACLE = f"""
WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS payload_digest, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages),
k AS (SELECT payload_digest, max(page_id) AS keep FROM p WHERE payload_bytes >= {MIN_REVISIT_BYTES} GROUP BY 1 HAVING count(*) > 1)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id < keep OR (page_id IS NULL AND keep IS NOT NULL) THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < keep OR (page_id IS NULL AND keep IS NOT NULL) THEN keep END AS refers_to
FROM p LEFT JOIN k USING (payload_digest)
"""
