"""WARC archives: written as whole-file gzip, then normalised to one gzip member per record.

The writer turns every page into a record; Spark's text writer makes each part file one gzip
stream. The normaliser inflates such a stream once, from front to back, and writes every
record as a member of its own, so a reader can start at any of them. Offsets and lengths
go to a sidecar table. Reading back seeks by that table and checks every payload's digest.

One task normalises one archive and holds one record at a time. A retried task writes the same
bytes under a temporary name first and renames at the end.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.llm.common import small_batches, stored
from fareflow.session import scratch_path

REVISIT_FROM = 100  # bytes; smaller payloads are stored again
RECORDS_PER_ARCHIVE = 10_000
CHUNK = 1 << 20
DATE = "2000-01-01T00:00:00Z"
ID = "urn:x-page:"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
END = "\r\n\r\n"


def with_revisits(pages: DataFrame, key: str = "page_id", payload: str = "html") -> DataFrame:
    """``id``, ``url``, ``payload``, ``bytes``, ``digest`` and ``first``, the id a revisit refers to.

    Of equal payloads of at least ``REVISIT_FROM`` bytes the smallest id is the response; rows
    that repeat that id are responses too, and so are rows without id if none has one.
    """
    body = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.select(
        F.col(key).alias("id"), F.col("url").alias("url"), body.alias("payload"),
        F.octet_length(body).cast("long").alias("bytes"), F.sha2(body, 256).alias("digest"),
    )
    shared = rows.where(F.col("bytes") >= REVISIT_FROM).groupBy("digest").agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("n")
    )
    shared = stored(shared.where("n > 1").select(F.col("digest").alias("same"), "first"), "warc_shared")
    joined = rows.join(shared, rows.digest == shared.same, "left")
    first = F.when(~F.col("first").eqNullSafe(F.col("id")), F.col("first"))
    return joined.select("id", "url", "payload", "bytes", "digest", first.alias("first"))


def record_text() -> Column:
    """The record without the two line ends that close it."""
    revisit = F.col("first").isNotNull()
    block = F.when(revisit, F.lit(HTTP)).otherwise(F.concat(F.lit(HTTP), "payload"))
    name = F.concat(F.lit(f"<{ID}"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(">"))
    uri = F.regexp_replace("url", r"[\x00-\x20]", "%20")
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), name),
        F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Target-URI: "), uri),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), "digest"),
        F.concat(F.lit("X-Payload-Bytes: "), F.col("bytes").cast("string")),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.concat(F.lit(f"WARC-Refers-To: <{ID}"), F.col("first").cast("string"), F.lit(">")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(END), block)  # concat_ws leaves nulls out


def write_monolithic(pages: DataFrame, path: str) -> None:
    """Archives below ``path``, each one gzip stream from start to end."""
    writer = with_revisits(pages).select(record_text().alias("value")).write
    writer.option("lineSep", END).option("maxRecordsPerFile", RECORDS_PER_ARCHIVE).option("compression", "gzip").text(path)


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI as Hadoop writes it."""
    uri = re.sub("^file:/+", "file:///", uri)
    return fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", uri))


def inflated(source) -> Iterator[bytes]:
    """The bytes of a gzip file in pieces, over all its members."""
    unzip = zlib.decompressobj(31)
    while data := source.read(CHUNK):
        while data:
            piece = unzip.decompress(data, CHUNK)
            if piece:
                yield piece
            data = unzip.unconsumed_tail
            if unzip.eof:
                data = unzip.unused_data
                unzip = zlib.decompressobj(31)
    if tail := unzip.flush():
        yield tail


def records(pieces: Iterator[bytes]) -> Iterator[tuple[bytes, bytes]]:
    """Header and block of every record in a stream of bytes."""
    held = bytearray()

    def more() -> bool:
        piece = next(pieces, None)
        if piece is not None:
            held.extend(piece)
        return piece is not None

    while True:
        while held[:2] == b"\r\n":
            del held[:2]
        if len(held) < 2:
            if not more():
                return
            continue
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not more():
                raise ValueError("archive ends inside a record's header")
        header = bytes(held[: end + 4])
        size = int(header_fields(header)["content-length"])
        while len(held) < end + 4 + size:
            if not more():
                raise ValueError("archive ends inside a record's block")
        block = bytes(held[end + 4 : end + 4 + size])
        del held[: end + 4 + size]
        yield header, block


def header_fields(header: bytes) -> dict[str, str]:
    lines = header.decode("utf-8").split("\r\n")[1:]
    return {name.lower(): value.strip() for name, colon, value in (x.partition(":") for x in lines) if colon}


INDEX = "archive string, at long, length long, record_id string, record_type string"


def _normaliser(out: str):
    def normalise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        target, folder = _opened(out)
        target.create_dir(folder, recursive=True)
        for paths in batches:
            for path in paths["path"]:
                yield from _rewrite(path, target, folder, out)

    return normalise


def _rewrite(path: str, target: fs.FileSystem, folder: str, out: str) -> Iterator[pd.DataFrame]:
    """Normalise one archive; its index rows."""
    source, inside = _opened(path)
    name = re.sub(r"(\.txt|\.warc)?\.gz$", "", inside.rpartition("/")[2]) + ".warc.gz"
    draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
    rows, at = [], 0
    with source.open_input_stream(inside, compression=None) as read:
        with target.open_output_stream(draft, compression=None) as write:
            for header, block in records(inflated(read)):
                pack = zlib.compressobj(6, zlib.DEFLATED, 31)
                member = pack.compress(header + block + END.encode()) + pack.flush()
                write.write(member)
                fields = header_fields(header)
                rows.append((f"{out}/{name}", at, len(member), fields["warc-record-id"], fields["warc-type"]))
                at += len(member)
    target.move(draft, f"{folder}/{name}")
    yield pd.DataFrame(rows, columns=[c.split()[0] for c in INDEX.split(", ")])


def normalise(spark: SparkSession, path: str, out: str) -> DataFrame:
    """Rewrite the archives below ``path`` to ``out``; the sidecar index, written there too."""
    small_batches(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    index = files.where(F.col("path").endswith(".gz")).select("path").mapInPandas(_normaliser(out), INDEX)
    index.write.parquet(f"{out}-index")
    return spark.read.schema(INDEX).parquet(f"{out}-index")


READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _page(name: str | None) -> int | None:
    digits = (name or "").strip("<>").removeprefix(ID)
    return int(digits) if digits else None


def read_member(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of one record; the payload is checked against its digest."""
    [(header, block)] = records(iter([zlib.decompress(member, 31)]))
    fields = header_fields(header)
    payload = block.partition(b"\r\n\r\n")[2]
    if fields["warc-type"] == "response":
        if f"sha256:{hashlib.sha256(payload).hexdigest()}" != fields["warc-payload-digest"]:
            raise ValueError(f"{fields['warc-record-id']}: payload and digest differ")
    return fields, payload


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    archive, source = None, None
    for index in batches:
        rows = []
        for name, at, length in index[["archive", "at", "length"]].itertuples(index=False):
            if name != archive:
                system, inside = _opened(name)
                archive, source = name, system.open_input_file(inside)
            fields, payload = read_member(source.read_at(length, at))
            full = len(payload) if fields["warc-type"] == "response" else int(fields["x-payload-bytes"])
            rows.append((
                _page(fields["warc-record-id"]), full, fields["warc-payload-digest"].removeprefix("sha256:"),
                fields["warc-type"], _page(fields.get("warc-refers-to")),
            ))
        out = pd.DataFrame(rows, columns=[c.split()[0] for c in READ.split(", ")])
        yield out.astype({"page_id": "Int64", "refers_to": "Int64"})


def read_back(index: DataFrame) -> DataFrame:
    """One row per record of the normalised archives, each read at its offset."""
    small_batches(index.sparkSession)
    return index.mapInPandas(_read, READ)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system's scheme."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.makeQualified(hadoop).toString()


def round_trip(pages: DataFrame) -> DataFrame:
    """Pages written to archives, normalised and read back: one row per page.

    Null and empty html is an empty payload; an empty table gives no archives' records.
    """
    spark = pages.sparkSession
    raw, out = (qualified(spark, scratch_path(spark, name)) for name in ("warc", "warc_members"))
    write_monolithic(pages, raw)
    return read_back(normalise(spark, raw, out))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, octet_length(encode(body))::BIGINT AS payload_bytes, sha256(body) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to
FROM f
"""
