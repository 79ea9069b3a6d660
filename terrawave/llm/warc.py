"""WARC archives as a chunked record table.

A row is a chunk of a record: record_id, chunk_no and the bytes. Chunk 0 is the record's header, the last is its end;
the payload lies between in chunks of CHUNK bytes. The chunks of an archive, in order, are a WARC file. Chunks are cut
and written by Spark's own readers and writers, on any file system; reading carries the digest from chunk to chunk and
never holds a whole record.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrawave.session import stash

CHUNK = 65_536
LEAST = 1000  # bytes from which equal payloads are written once
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _clean(c: Column) -> Column:
    """A header's value has no line ends."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"[\r\n]", " ")


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """record_id, url, payload, digest, refers_to of each row. Of equal payloads of LEAST bytes or more, the record with the largest id is written and others refer to it. A null page is empty, a null id is the least and is written as an empty one; rows that share id and payload are all written."""
    rows = pages.select(F.col(id_col).cast("long").alias("record_id"), F.col(url_col).cast("string").alias("url"), F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    groups = rows.where(F.octet_length("payload") >= LEAST).groupBy("digest").agg(F.max("record_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    rows = rows.join(stash(groups, "groups"), "digest", "left")
    first = F.when(F.octet_length("payload") >= LEAST, F.col("first"))
    return rows.select("record_id", "url", "payload", "digest", F.when(~first.eqNullSafe(F.col("record_id")), first).alias("refers_to"))


def chunks(rows: DataFrame, date: str = "2000-01-01T00:00:00Z", chunk: int = CHUNK) -> DataFrame:
    """record_id, part, chunk_no, data: part tells rows that share a record_id apart."""
    again = F.col("refers_to").isNotNull()
    body = F.when(~again, F.octet_length("payload")).otherwise(0) + len(HTTP)
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(again, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(F.col("record_id").cast("string"), F.lit("")), F.lit(">")),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), _clean(F.col("url"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(again, F.concat(F.lit(f"WARC-Profile: {PROFILE}\r\nWARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
        F.concat(F.lit("Content-Length: "), body.cast("string")),
    ]
    head = F.encode(F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n" + HTTP)), "UTF-8")
    n = F.when(again, 0).otherwise(F.ceil(F.octet_length("payload") / chunk)).cast("int")
    rows = rows.select("record_id", F.monotonically_increasing_id().alias("part"), head.alias("head"), "payload", n.alias("n"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("n") + 1)).alias("chunk_no"))  # a chunk is cut as its row is made
    data = F.when(F.col("chunk_no") == 0, F.col("head")).when(F.col("chunk_no") > F.col("n"), F.encode(F.lit("\r\n\r\n"), "UTF-8")).otherwise(F.col("payload").substr((F.col("chunk_no") - 1) * chunk + 1, F.lit(chunk)))
    return rows.select("record_id", "part", "chunk_no", data.alias("data"))


def write(pages: DataFrame, **columns) -> DataFrame:
    """Write the archives of pages to the shared folder; returns the chunk table."""
    return stash(chunks(records(pages, **columns)), "warc")


def read(table: DataFrame) -> DataFrame:
    """record_id, record_type, refers_to, payload_bytes, payload_digest, stated_digest and whole of each record of a chunk table; bytes and digest are of what is in the archive. whole: no byte of the stated length is missing, and a response has the digest that it states."""
    schema = "record_id long, record_type string, refers_to long, payload_bytes long, payload_digest string, stated_digest string, whole boolean"
    dealt = table.repartition("part").sortWithinPartitions("part", "chunk_no").select("part", "chunk_no", "data")

    def number(value: str | None):
        digits = (value or "").removeprefix("<urn:page:").removesuffix(">")
        return int(digits) if digits else None

    def run(batches):
        head, size, sha, room = None, 0, None, 0

        def row():
            digest, stated = sha.hexdigest(), head["WARC-Payload-Digest"].removeprefix("sha1:")
            return number(head["WARC-Record-ID"]), head["WARC-Type"], number(head.get("WARC-Refers-To")), size, digest, stated, room == 0 and (digest == stated or head["WARC-Type"] == "revisit")

        for batch in batches:
            out = []
            data = batch.column(2)
            for i, chunk_no in enumerate(batch.column(1).to_pylist()):
                part = data[i].as_buffer()
                if chunk_no == 0:
                    if head:
                        out.append(row())
                    warc, http, _ = bytes(part).split(b"\r\n\r\n", 2)
                    head = dict(x.split(": ", 1) for x in warc.decode("utf-8", "replace").split("\r\n")[1:])
                    size, sha, room = 0, hashlib.sha1(), int(head["Content-Length"]) - len(http) - 4
                else:
                    payload = part[: max(0, min(room, part.size))]
                    sha.update(payload)
                    size, room = size + len(payload), room - len(payload)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)
        if head:
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row(), kinds, strict=True)], names)

    names = ["record_id", "record_type", "refers_to", "payload_bytes", "payload_digest", "stated_digest", "whole"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_()]
    return dealt.mapInArrow(run, schema)


def resolved(found: DataFrame) -> DataFrame:
    """Records as of read, with bytes and digest of the full payload: a revisit has those of the record that it refers to."""
    found = stash(found, "records")
    of = stash(found.where("record_type = 'revisit'").select("refers_to").distinct().join(found.where("record_type = 'response'").select(F.col("record_id").alias("refers_to"), F.col("payload_bytes").alias("_n"), F.col("payload_digest").alias("_d")), "refers_to").dropDuplicates(["refers_to"]), "referred")
    whole = found.join(of, "refers_to", "left")
    return whole.select("record_id", F.coalesce("_n", "payload_bytes").alias("payload_bytes"), F.coalesce("_d", "payload_digest").alias("payload_digest"), "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, CAST(octet_length(b) AS BIGINT) AS n, sha1(b) AS s FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY s, n) AS first FROM d)
SELECT page_id, n AS payload_bytes, s AS payload_digest,
       CASE WHEN n >= 1000 AND first IS NOT NULL AND first IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND first IS NOT NULL AND first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM m
"""
