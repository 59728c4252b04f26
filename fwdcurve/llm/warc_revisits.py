"""WARC archives with revisit resolution.

`resolve` finds, by a shuffle of digests and ids alone, the original of each payload: of equal payloads of
`LEAST` bytes or more the one with the least page_id. `write_archive` writes one archive per task: a warcinfo
record, then a response record with the payload for an original and a revisit record, which names it, for
the others; each record is a gzip member with fresh headers. A record's id is made of its page_id, url and
digest, and of its number among equal rows, so it is unique. `read_archive` parses archives record by record and
`resolved` joins revisits to their responses by record id and checks the digest.

Scale: pages are shuffled at most once, by page_id, url and digest, to meet their decision, never by digest
alone, so a payload that a third of the pages share doesn't meet in one task; digests and ids with very
many rows are joined under salts. Equal rows are merged before they are shuffled and numbered, then dealt out
again. Writers stream and name files after their attempt; the manifest that Spark commits says which count.

Edge cases: a null html is an empty payload; payloads below `LEAST` bytes are responses each; repeated rows are
records of their own, responses all if they are the original; one page_id may have several payloads; a null
page_id, which is never an original, is written as an empty id and read as null; null urls
are written as `about:blank`; an empty table gives no file; other columns are ignored.
"""

from __future__ import annotations

import datetime
import gzip
import hashlib
import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .common import filesystem, freed_shuffles, hot_keys, join_hot, partitions, settle, work_dir

LEAST = 100
KEY = ["page_id", "url", "digest"]
_NAME = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def headers_of(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html) with payload, digest and size."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("long").alias("size"))


def resolve(headers: DataFrame, work: str) -> DataFrame:
    """(page_id, url, digest, rows, refers_to, owner_url) of the pages that are revisits or stand in several equal
    rows: refers_to is the original's page_id for a revisit, else null."""
    small = settle(headers.groupBy(*KEY).agg(F.count(F.lit(1)).alias("rows"), F.first("size").alias("size")), f"{work}/headers")
    large = small.where(F.col("size") >= LEAST)
    owner = F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("owner")
    owners = large.groupBy("digest").agg(owner, F.count(F.lit(1)).alias("n"))
    owners = settle(owners.where("n > 1 AND owner IS NOT NULL"), f"{work}/owners")
    hot = settle(owners.where(F.col("n") > common.HOT_ROWS).select("digest"), f"{work}/hot")
    met = join_hot(large, owners.drop("n"), "digest", "page_id", hot).where(~F.col("page_id").eqNullSafe(F.col("owner.page_id")))
    revisits = met.select(*KEY, "rows", F.col("owner.page_id").alias("refers_to"), F.col("owner.url").alias("owner_url"))
    marks = revisits.unionByName(small.where("rows > 1").select(*KEY, "rows"), allowMissingColumns=True)
    return settle(marks.groupBy(*KEY).agg(F.max("rows").alias("rows"), F.max("refers_to").alias("refers_to"), F.max("owner_url").alias("owner_url")), f"{work}/marks")


def record_id(page_id: int | None, url: str | None, digest: str, number: int = 0) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAME, f'page:{page_id}:{number}:{digest}:{url}')}>"


def _uri(url: str | None) -> str:
    return (url or "about:blank").replace("\r", "%0D").replace("\n", "%0A")


def _member(lines: list[str], body: bytes) -> bytes:
    """One gzip member: a record of these header lines and this block."""
    lines = ["WARC/1.1", *lines, f"WARC-Block-Digest: sha256:{hashlib.sha256(body).hexdigest()}", f"Content-Length: {len(body)}"]
    return gzip.compress("\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n", compresslevel=4, mtime=0)


def warcinfo(name: str, date: str) -> bytes:
    lines = ["WARC-Type: warcinfo", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", f"WARC-Date: {date}", f"WARC-Filename: {name}", "Content-Type: application/warc-fields"]
    return _member(lines, b"software: fwdcurve\r\nformat: WARC File Format 1.1\r\n")


def record(date: str, page_id: int | None, url: str | None, digest: str, payload: bytes, refers_to: int | None, owner_url: str | None, number: int) -> bytes:
    """A response with its payload, or a revisit of another record without."""
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (payload if refers_to is None else b"")
    lines = [f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id, url, digest, number)}", f"WARC-Date: {date}", f"WARC-Target-URI: {_uri(url)}", f"WARC-Payload-Digest: sha256:{digest}"]
    if refers_to is not None:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(refers_to, owner_url, digest)}",
            f"WARC-Refers-To-Target-URI: {_uri(owner_url)}",
            f"WARC-Refers-To-Date: {date}",
            f"X-Refers-To-Page: {refers_to}",
        ]
    return _member([*lines, f"X-Page-ID: {'' if page_id is None else page_id}", "Content-Type: application/http; msgtype=response"], body)


_FILES = pa.schema([("file", pa.string()), ("n_records", pa.int64())])


def _write(batches: Iterator[pa.RecordBatch], folder: str, date: str) -> Iterator[pa.RecordBatch]:
    fs, root = filesystem(folder)
    name, out, n = f"pages-{uuid.uuid4().hex}.warc.gz", None, 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if out is None:
                fs.create_dir(root, recursive=True)
                out = fs.open_output_stream(f"{root}/{name}", compression=None)
                out.write(warcinfo(name, date))
            out.write(record(date, *row))
            n += 1
    if out is not None:
        out.close()
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n])], schema=_FILES)


def write_archive(pages: DataFrame, folder: str, date: str | None = None) -> DataFrame:
    """Write pages (page_id, url, html) as deduplicated archives; returns the manifest (file, n_records).

    date is the WARC-Date of all records, by default the time of the call."""
    spark, date = pages.sparkSession, date or datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    with freed_shuffles(spark):
        headers = headers_of(pages)
        marks = resolve(headers, folder)
        names = {k: f"mark_{k}" for k in KEY}
        met = marks.withColumnsRenamed(names)
        rows = headers.join(met, [headers[k].eqNullSafe(met[v]) for k, v in names.items()], "left")
        columns = [*KEY, "payload", "refers_to", "owner_url"]
        every = rows.where("rows IS NULL OR rows = 1").select(*columns, F.lit(0).cast("long").alias("number"))
        if not marks.where("rows > 1").isEmpty():
            once = rows.where("rows > 1").dropDuplicates(KEY)
            again = once.select(*columns, F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)).alias("number"))
            every = every.unionByName(again.repartition(partitions(spark)))
        return settle(every.select("page_id", "url", "digest", "payload", "refers_to", "owner_url", "number").mapInArrow(lambda it: _write(it, folder, date), "file string, n_records long"), f"{folder}/manifest")


def records_in(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, body) of each record of an open archive."""
    with gzip.GzipFile(fileobj=stream) as f:
        while line := f.readline():
            if not line.strip():
                continue
            fields = {}
            while (line := f.readline().rstrip(b"\r\n")):
                key, _, value = line.partition(b":")
                fields[key.decode().lower()] = value.strip().decode()
            yield fields, f.read(int(fields["content-length"]))


_READ = pa.schema([("page_id", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()), ("digest", pa.string()), ("size", pa.int64()), ("target", pa.string()), ("refers_to", pa.int64())])


def _read(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    fs, root = filesystem(folder)
    number = lambda x: int(x) if x else None
    pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _READ.types, strict=True)], schema=_READ)
    for batch in batches:
        for name in batch.column(0).to_pylist():
            rows = []
            with fs.open_input_stream(f"{root}/{os.path.basename(name)}", compression=None) as stream:
                for fields, body in records_in(stream):
                    kind = fields["warc-type"]
                    if kind == "warcinfo":
                        continue
                    said = fields["warc-payload-digest"].removeprefix("sha256:")
                    payload = body.partition(b"\r\n\r\n")[2]
                    if kind == "response" and hashlib.sha256(payload).hexdigest() != said:
                        raise ValueError(f"{fields['warc-record-id']}: payload and digest differ")
                    rows.append((number(fields["x-page-id"]), fields["warc-record-id"], kind, said, len(payload) if kind == "response" else None, fields.get("warc-refers-to"), number(fields.get("x-refers-to-page"))))
                    if len(rows) == 2000:
                        yield pack(rows)
                        rows = []
            if rows:
                yield pack(rows)


def read_archive(manifest: DataFrame, folder: str) -> DataFrame:
    files = manifest.select("file").repartition(partitions(manifest.sparkSession))
    schema = "page_id long, record_id string, record_type string, digest string, size long, target string, refers_to long"
    return files.mapInArrow(lambda it: _read(it, folder), schema)


def resolved(records: DataFrame, work: str) -> DataFrame:
    """records with the size of each revisit's payload, from the response it names; a digest that differs raises."""
    records = settle(records, f"{work}/records")
    out = ["page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to"]
    plain = records.where("record_type = 'response'").withColumnRenamed("size", "payload_bytes")
    revisits = records.where("record_type = 'revisit'")
    responses = plain.select(F.col("record_id").alias("target"), F.col("digest").alias("true_digest"), F.col("payload_bytes").alias("true_size"))
    responses = settle(responses.join(revisits.select("target").distinct(), "target", "left_semi"), f"{work}/originals")
    met = join_hot(revisits, responses, "target", None, hot_keys(revisits, "target", f"{work}/hot_targets"), "left")
    missing = F.raise_error(F.lit("a revisit has no response with its digest")).cast("long")
    met = met.withColumn("payload_bytes", F.when(F.col("true_digest").eqNullSafe(F.col("digest")), F.col("true_size")).otherwise(missing))
    return plain.select(out).unionByName(met.select(out))


def op10_warc_revisits(spark, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "warc")
    manifest = write_archive(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return resolved(read_archive(manifest, folder), folder)


SQL = """
WITH h AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), o AS (SELECT payload_digest, min(page_id) AS owner FROM h WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN owner <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN owner <> page_id THEN owner END AS refers_to
FROM h LEFT JOIN o USING (payload_digest)
"""
