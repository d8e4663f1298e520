"""WARC archives compressed record by record with a Zstandard dictionary that leads the file in a skippable frame."""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, bounded_batches, join_counted, small_broadcast
from .media import open_store

#: Magic number of the skippable frame that holds the dictionary.
SKIPPABLE = 0x184D2A5D
#: Longer records are trained on in pieces of so many bytes.
PIECE = 128 << 10
#: A fixed date, so that equal tables give equal archives.
DATE = "2024-01-01T00:00:00Z"


@dataclass(frozen=True)
class WarcSpec:
    """least_bytes: smaller payloads are always responses. file_bytes: records of about so many bytes make a file (they are held
    until its dictionary is built). dictionary: its size. sample_bytes: of the file's records, evenly spread ones up to this many
    bytes, in pieces of 128 KB, train the dictionary. level: of compression."""

    least_bytes: int = 0
    file_bytes: int = 24 << 20
    dictionary: int = 64 << 10
    sample_bytes: int = 4 << 20
    level: int = 3


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def urn(page_id: int | None) -> str:
    """The record id of a page: its 64 bits as a UUID. A page without an id has the first UUID beyond those."""
    return f"<urn:uuid:{uuid.UUID(int=1 << 64 if page_id is None else page_id & ((1 << 64) - 1))}>"


def page_of(name: str) -> int | None:
    """The page of a record id."""
    value = uuid.UUID(name[len("<urn:uuid:") : -1]).int
    return None if value >> 64 else value - (1 << 64) if value >> 63 else value


def record(page_id: int | None, url: str, payload: bytes, size: int, digest: str, refers_to: int | None) -> bytes:
    """One WARC 1.1 record: a response with its payload, or a revisit with the HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        "WARC-Type: " + ("response" if refers_to is None else "revisit"),
        f"WARC-Record-ID: {urn(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url:
        lines.append("WARC-Target-URI: " + re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {urn(refers_to)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields (names in lower case), HTTP header and payload of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    fields = {k.lower(): v for k, v in fields.items()}
    http, _, payload = rest[: int(fields["content-length"])].partition(b"\r\n\r\n")
    return fields, http, payload


def build_dictionary(records: list[bytes], spec: WarcSpec) -> bytes:
    """A dictionary from archived records; where there is too little to train on, the records' own end serves as raw content."""
    import zstandard

    step = max(1, sum(map(len, records)) // spec.sample_bytes)
    sample = [r[k : k + PIECE] for r in records[::step] for k in range(0, len(r), PIECE)]
    try:
        return zstandard.train_dictionary(min(spec.dictionary, max(1024, sum(map(len, sample)) // 16)), sample, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(sample)[-spec.dictionary :]


def write_file(store, path: str, records: list[bytes], spec: WarcSpec) -> list[tuple[int, int]]:
    """Offsets and lengths of the records' frames."""
    import zstandard

    words = build_dictionary(records, spec)
    shared = zstandard.ZstdCompressionDict(words)
    shared.precompute_compress(level=spec.level)
    pack = zstandard.ZstdCompressor(dict_data=shared, level=spec.level, write_checksum=True)
    places = []
    with store.open_output_stream(path, compression=None) as out:
        lead = zstandard.ZstdCompressor(level=spec.level).compress(words)
        out.write(struct.pack("<II", SKIPPABLE, len(lead)) + lead)
        at = 8 + len(lead)
        for r in records:
            frame = pack.compress(r)
            places.append((at, len(frame)))
            out.write(frame)
            at += len(frame)
    return places


def read_dictionary(file):
    import zstandard

    file.seek(0)
    magic, size = struct.unpack("<II", file.read(8))
    if magic != SKIPPABLE:
        raise ValueError("the archive does not lead with a dictionary")
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(file.read(size))))


def revisits(rows: DataFrame, spec: WarcSpec, scratch: Scratch) -> DataFrame:
    """page_id, sha, refers_to: which payloads of which pages are revisits, and of which page. rows: page_id, bytes, sha.

    Digests alone are shuffled. Of equal payloads of at least least_bytes bytes the one with the largest page_id is the response;
    a null page_id is smaller than any, and where all are null every one is a response."""
    groups = rows.where(F.col("bytes") >= spec.least_bytes).groupBy("sha").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
    groups = scratch.write(groups.where("n > 1 and refers_to is not null"), "groups")
    again = join_counted(rows.where(F.col("bytes") >= spec.least_bytes).select("page_id", "sha"), groups, ["sha"]).where("not (page_id <=> refers_to)")
    return scratch.write(again.distinct(), "revisits")


def archive(pages: DataFrame, folder: str, scratch: Scratch, spec: WarcSpec = WarcSpec()) -> DataFrame:  # noqa: B008
    """page_id, file, offset, length of the record of every row of pages (page_id, url, html).

    Which rows are revisits is found from digests (see revisits) and joined back by page_id and digest, so a page_id with several
    payloads keeps each of them. That table is broadcast if small(), and then no html is shuffled; else the join shuffles the rows.
    Null html is an empty payload, a null url is left out.
    """

    def run(batches):
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        held, ids, size = [], [], 0

        def flush():
            name = f"{uuid.uuid4().hex}.warc.zst"
            places = write_file(store, f"{root}/{name}", held, spec)
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([name] * len(ids)), pa.array([p[0] for p in places], pa.int64()), pa.array([p[1] for p in places], pa.int64())], names=["page_id", "file", "offset", "length"])

        for batch in batches:
            for page, url, html, bytes_, sha, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(record(page, url or "", (html or "").encode(), bytes_, base64.b32encode(bytes.fromhex(sha)).decode(), refers))
                ids.append(page)
                size += len(held[-1])
                if size >= spec.file_bytes:
                    yield flush()
                    held, ids, size = [], [], 0
        if held:
            yield flush()

    bounded_batches(pages.sparkSession, 256)
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"), F.octet_length(html).cast("long").alias("bytes"))
    rows = rows.withColumn("sha", F.sha1(F.col("html").cast("binary")))
    digests = scratch.write(rows.select("page_id", "sha", "bytes"), "digests")
    again = small_broadcast(revisits(digests, spec, scratch).select(F.col("page_id").alias("again_id"), F.col("sha").alias("again_sha"), "refers_to"))
    joined = rows.join(again, (rows.sha == again.again_sha) & rows.page_id.eqNullSafe(again.again_id), "left")
    dealt = joined.select("page_id", "url", F.when(F.col("refers_to").isNull(), F.col("html")).alias("html"), "bytes", "sha", "refers_to")
    return dealt.mapInArrow(run, "page_id long, file string, offset long, length long")


def read_back(places: DataFrame, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, target_uri of archived records, by range reads. A response's
    values come from its payload as stored, a revisit's from its header; a response whose payload belies its digest fails."""
    tasks = int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = places.select("file", "offset", "length").repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")

    def run(batches):
        store, root = open_store(folder)
        name, file, unpack = None, None, None
        for batch in batches:
            out = []
            for at, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != name:
                    if file is not None:
                        file.close()
                    name, file = at, store.open_input_file(f"{root}/{at}")
                    unpack = read_dictionary(file)
                file.seek(offset)
                fields, http, payload = parse(unpack.decompress(file.read(length)))
                digest = fields["warc-payload-digest"].removeprefix("sha1:")
                size = int(re.search(rb"(?i)content-length: *(\d+)", http)[1])
                if fields["warc-type"] == "response" and (len(payload), sha1_base32(payload)) != (size, digest):
                    raise ValueError("a stored payload does not match its digest")
                refers = fields.get("warc-refers-to")
                out.append((page_of(fields["warc-record-id"]), size, digest, fields["warc-type"], page_of(refers) if refers else None, fields.get("warc-target-uri")))
            if out:
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri"])
        if file is not None:
            file.close()

    return dealt.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target_uri string")


def archived(pages: DataFrame, spec: WarcSpec = WarcSpec()) -> DataFrame:  # noqa: B008
    """pages written to archives in the shared folder and read back: see archive() and read_back(). An empty table gives an empty
    result. Of repeated rows with one page_id and payload each has a record of the same kind; of rows with one page_id and several
    payloads each keeps its own. Rows without a page_id are archived like any other. Other columns are not read."""
    scratch = Scratch(pages.sparkSession, "warc")
    folder = scratch.path("archives")
    places = scratch.write(archive(pages, folder, scratch, spec), "places")
    return read_back(places, folder)


ORACLE = """
with p as (select page_id, octet_length(encode(coalesce(html, ''))) as n, sha1(coalesce(html, '')) as h from pages),
g as (select h, max(page_id) as response from p group by h)
select page_id, cast(n as bigint) as payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (((16 * (strpos('0123456789abcdef', substr(p.h, 1 + (5 * i) // 4, 1)) - 1) + strpos('0123456789abcdef', substr(p.h, 2 + (5 * i) // 4, 1)) - 1) >> (3 - (5 * i) % 4)) & 31), 1)), '') as payload_digest,
  case when page_id = response then 'response' else 'revisit' end as record_type, case when page_id <> response then response end as refers_to
from p join g on p.h = g.h
"""
