"""Operator 7: WARC archives with one gzip member per record.

``write_archives`` makes monolithic archives: records in one gzip stream per file, as many
crawlers leave them. ``normalise`` inflates each such stream once, record by record in bounded
memory, writes every record as a member of its own and, beside the archive, an index of
offsets and lengths. ``read_archives`` goes through the index and checks every payload against
its digest.

Of records with equal payloads of MIN_SHARED bytes or more, the one with the largest
``page_id`` is the response; others are revisits that refer to it and hold the HTTP headers
alone, with the length of the full payload among them.

Cases. Null html is an empty payload. A null url becomes ``urn:none``; line ends in it are
escaped. Rows that repeat the largest id of their group with the same payload are responses
all. A null id counts as smaller than any; a group without ids has responses only. An empty
table makes no archive. Other columns are not used.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import json
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import joins, scratch

MIN_SHARED = 1000
#: Bytes of records, before compression, after which a task starts the next archive.
ARCHIVE_BYTES = 32 << 20
CHUNK = 1 << 20
DATE = "1970-01-01T00:00:00Z"
END = b"\r\n\r\n"


def shared_payloads(pages: DataFrame) -> DataFrame:
    """sha256 and ``keeper`` of each payload that two or more records share; written, narrow."""
    payload = F.coalesce("html", F.lit(""))
    big = pages.filter(F.octet_length(payload) >= MIN_SHARED).select("page_id", F.unhex(F.sha2(payload, 256)).alias("sha"))
    groups = big.groupBy("sha").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).filter("n > 1 and keeper is not null")
    return scratch.save(groups, "shared_payloads")


def with_keeper(pages: DataFrame) -> DataFrame:
    """page_id, url, html and ``refers_to``, null for responses."""
    groups = shared_payloads(pages)
    payload = F.coalesce("html", F.lit(""))
    named = pages.select("page_id", "url", "html", F.unhex(F.sha2(payload, 256)).alias("sha"))
    if groups.limit(joins.BROADCAST_ROWS + 1).count() <= joins.BROADCAST_ROWS:
        met = named.join(F.broadcast(groups), "sha", "left")
    else:
        met = joins.weighted_join(named, groups, ["sha"], "n")
    return met.select("page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("keeper")), F.col("keeper")).alias("refers_to"))


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record, a response or a revisit."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d" % len(payload) + END
    block = http + (payload if refers_to is None else b"")
    uri = (url or "urn:none").replace("\r", "%0D").replace("\n", "%0A")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}"]
    head.append(f"WARC-Payload-Digest: sha1:{base64.b32encode(hashlib.sha1(payload).digest()).decode()}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + END + block + END


ARCHIVE = pa.schema([("path", pa.string()), ("records", pa.int64())])


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write monolithic archives to ``folder``; returns path and records of each."""

    def run(batches):
        task = TaskContext.get()
        where, name = fs.FileSystem.from_uri(folder)
        where.create_dir(name, recursive=True)
        out, number, records, size = None, 0, 0, 0

        def close():
            out.write(pack.flush())
            out.close()
            return pa.RecordBatch.from_pydict({"path": [f"{folder}/{file}"], "records": [records]}, schema=ARCHIVE)

        for batch in batches:
            for row in zip(*[batch.column(c) for c in ("page_id", "url", "html", "refers_to")], strict=True):
                page_id, url, html, refers_to = (v.as_py() for v in row)
                if out is None:
                    file = f"crawl-{task.partitionId():06d}-{number:05d}-{task.taskAttemptId()}.warc.gz"
                    out, pack = where.open_output_stream(f"{name}/{file}", compression=None), zlib.compressobj(6, zlib.DEFLATED, 31)
                raw = record(page_id, url, (html or "").encode(), refers_to)
                out.write(pack.compress(raw))
                records, size = records + 1, size + len(raw)
                if size >= archive_bytes:
                    yield close()
                    out, number, records, size = None, number + 1, 0, 0
        if out is not None:
            yield close()

    scratch.bound_batches(pages.sparkSession)
    return scratch.save(pages.mapInArrow(run, "path string, records long"), "archives")


def inflated(source):
    """The bytes of a gzip file in pieces of bounded size, over all its members."""
    unpack = zlib.decompressobj(31)
    while raw := source.read(CHUNK):
        while raw:
            if unpack.eof:
                unpack = zlib.decompressobj(31)
            piece = unpack.decompress(raw, CHUNK)
            if piece:
                yield piece
            raw = unpack.unconsumed_tail or unpack.unused_data
    if not unpack.eof:
        raise EOFError("the gzip stream is cut off")


class Feed:
    """Reads headers and counted bytes from pieces."""

    def __init__(self, pieces) -> None:
        self.pieces, self.held = iter(pieces), b""

    def header(self) -> bytes:
        """All up to and with the next empty line; nothing at the end."""
        while (at := self.held.find(END)) < 0:
            piece = next(self.pieces, b"")
            if not piece:
                if self.held.strip():
                    raise EOFError("the archive ends inside a header")
                return b""
            self.held += piece
        head, self.held = self.held[: at + 4], self.held[at + 4 :]
        return head

    def take(self, size: int):
        """The next ``size`` bytes, in pieces."""
        while size:
            if not self.held:
                self.held = next(self.pieces, b"")
                if not self.held:
                    raise EOFError("the archive ends inside a record")
            part, self.held = self.held[:size], self.held[size:]
            size -= len(part)
            yield part


def fields(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name."""
    pairs = (line.split(":", 1) for line in head.decode().split("\r\n") if ":" in line)
    return {k.strip().lower(): v.strip() for k, v in pairs}


def rewrite(source, out, index) -> int:
    """Write each record of ``source`` to ``out`` as its own member, and its place to ``index``."""
    feed, at, records = Feed(inflated(source)), 0, 0
    while head := feed.header():
        named = fields(head)
        pack, size = zlib.compressobj(6, zlib.DEFLATED, 31), 0
        for part in itertools.chain([head], feed.take(int(named["content-length"]) + len(END))):
            size += out.write(pack.compress(part))
        size += out.write(pack.flush())
        index.write(json.dumps({"offset": at, "length": size, "id": named["warc-record-id"], "type": named["warc-type"]}).encode() + b"\n")
        at, records = at + size, records + 1
    return records


class _Counted:
    """An output stream whose ``write`` tells how many bytes it wrote."""

    def __init__(self, stream) -> None:
        self.stream = stream

    def write(self, data: bytes) -> int:
        self.stream.write(data)
        return len(data)


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """One member per record and an index beside each archive; returns path, index and records."""
    kinds = pa.schema([("path", pa.string()), ("index", pa.string()), ("records", pa.int64())])

    def run(batches):
        attempt = TaskContext.get().taskAttemptId()
        where, name = fs.FileSystem.from_uri(folder)
        where.create_dir(name, recursive=True)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                file = f"{path.rsplit('/', 1)[1].removesuffix('.warc.gz')}-n{attempt}"
                from_where, from_name = fs.FileSystem.from_uri(path)
                with from_where.open_input_stream(from_name, compression=None) as source, where.open_output_stream(f"{name}/{file}.warc.gz", compression=None) as out, where.open_output_stream(f"{name}/{file}.idx") as index:
                    records = rewrite(source, _Counted(out), index)
                yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{file}.warc.gz"], "index": [f"{folder}/{file}.idx"], "records": [records]}, schema=kinds)

    spread = archives.select("path").repartition(max(1, archives.count()), "path")
    return scratch.save(spread.mapInArrow(run, "path string, index string, records long"), "normalised")


def page_of(name: str) -> int | None:
    """The id in ``<urn:page:...>``."""
    inner = name.strip("<>").rsplit(":", 1)[1]
    return None if inner == "None" else int(inner)


def parse(raw: bytes) -> tuple:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of one record."""
    head, _, rest = raw.partition(END)
    named = fields(head)
    block = rest[: int(named["content-length"])]
    http, _, payload = block.partition(END)
    digest = base64.b32decode(named["warc-payload-digest"].removeprefix("sha1:")).hex()
    size, refers_to = int(fields(http)["content-length"]), named.get("warc-refers-to")
    if refers_to is None and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"{named['warc-record-id']} does not match its digest")
    return page_of(named["warc-record-id"]), size, digest, named["warc-type"], page_of(refers_to) if refers_to else None


RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_archives(normalised: DataFrame) -> DataFrame:
    """One row per record, each read alone at the place that the index gives."""
    kinds = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])

    def run(batches):
        for batch in batches:
            for path, index in zip(batch.column("path").to_pylist(), batch.column("index").to_pylist(), strict=True):
                where, name = fs.FileSystem.from_uri(path)
                with where.open_input_file(fs.FileSystem.from_uri(index)[1]) as source:
                    places = [json.loads(line) for line in source.read().splitlines()]
                with where.open_input_file(name) as source:
                    for k in range(0, len(places), 2000):
                        rows = []
                        for place in places[k : k + 2000]:
                            source.seek(place["offset"])
                            rows.append(parse(zlib.decompress(source.read(place["length"]), 31)))
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), kinds, strict=True)], schema=kinds)

    return normalised.select("path", "index").repartition(max(1, normalised.count()), "path").mapInArrow(run, RECORD)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    archives = write_archives(with_keeper(pages), scratch.new_folder(spark, "warc"))
    return read_archives(normalise(archives, scratch.new_folder(spark, "warc-members")))


SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT page_id, h, strlen(h) AS n, sha1(h) AS d, max(page_id) OVER (PARTITION BY h) AS k FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> k THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> k THEN k END AS refers_to
FROM g
"""
