"""Content-addressed media in tar shards: rows carry digest, shard, offset and length; header-only range reads fill columns.

A payload is a text's UTF-8 bytes, padded with zero bytes to a positive multiple of 64 and stored losslessly as an 8-bit
greyscale PNG, 64 samples a row. Each task writes its own tar shards, a member per distinct payload, named by digest.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, bounded_batches, join_counted
from .wordhash import chunks

WIDTH = 64
SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: Bytes of a PNG up to the end of its first chunk: all that a header read fetches.
HEADER = 33


def open_store(uri: str):
    """(file system, path) of a folder that tasks write to, by the full URI that shared_dir() gives: Hadoop's one-slash file URIs and
    s3a are put into Arrow's spelling; a path without a scheme is refused, as it would mean a different disk on each machine."""
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    if "://" not in uri:
        raise ValueError(f"{uri} does not say which file system it is on")
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1) if uri.startswith("s3a://") else uri)


def chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def pad(payload: bytes) -> bytes:
    return payload + bytes(max(WIDTH, -len(payload) % WIDTH + len(payload)) - len(payload))


def encode(payload: bytes) -> bytes:
    """A PNG of a padded payload."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    raw = np.zeros((len(rows), WIDTH + 1), np.uint8)  # filter type 0 before each row
    raw[:, 1:] = rows
    return SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw.tobytes(), 6)) + chunk(b"IEND", b"")


def dimensions(header: bytes) -> tuple[int, int, int]:
    """Width, height and bit depth from the first HEADER bytes."""
    if header[:8] != SIGNATURE or header[12:16] != b"IHDR":
        raise ValueError("not a PNG header")
    return struct.unpack(">IIB", header[16:25])


def decode(stored: bytes) -> bytes:
    """The payload of a PNG that encode() made."""
    width, height, _ = dimensions(stored)
    at, data = 8, []
    while at < len(stored):
        size = struct.unpack(">I", stored[at : at + 4])[0]
        kind, body = stored[at + 4 : at + 8], stored[at + 8 : at + 8 + size]
        if struct.unpack(">I", stored[at + 8 + size : at + 12 + size])[0] != zlib.crc32(kind + body):
            raise ValueError("damaged PNG chunk")
        if kind == b"IDAT":
            data.append(body)
        at += 12 + size
    raw = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(height, width + 1)
    return raw[:, 1:].tobytes()


def feature(payload: bytes) -> str:
    """A 64-bit average hash: the samples cut into 64 equal stretches, a bit for each whose mean is above the mean of all."""
    x = np.frombuffer(payload, np.uint8)
    means = x.reshape(64, -1).mean(1)
    return np.packbits(means > x.mean()).tobytes().hex()


def tar_header(name: str, size: int) -> bytes:
    """A ustar header with nothing that differs between runs."""
    block = bytearray(512)
    block[: len(name)] = name.encode()
    for at, value in ((100, b"0000644\0"), (108, b"0000000\0"), (116, b"0000000\0"), (124, b"%011o\0" % size), (136, b"00000000000\0"), (148, b" " * 8), (156, b"0"), (257, b"ustar\x0000")):
        block[at : at + len(value)] = value
    block[148:156] = b"%06o\0 " % sum(block)
    return bytes(block)


def write_shards(docs: DataFrame, folder: str, text: str = "text", shard_bytes: int = 256 << 20) -> DataFrame:
    """doc_id, n_bytes, digest (SHA-256 of the payload, as bytes), shard, offset, length (of the stored PNG) of every row; a task's equal payloads
    share a member. A shard is written under a new name, so a task that is run again leaves its first try unused."""

    def run(batches):
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        known: dict[bytes, tuple[str, int, int]] = {}
        out, name, at = None, "", 0
        try:
            for batch in batches:
                for i, j, data, offsets in chunks(batch.column(1)):
                    rows = []
                    body = data.tobytes()
                    for d in range(j - i):
                        own = body[offsets[d] : offsets[d + 1]]
                        payload = pad(own)
                        digest = hashlib.sha256(payload).digest()
                        if digest not in known:
                            stored = encode(payload)
                            if out is None or at > shard_bytes:
                                if out is not None:
                                    out.write(bytes(1024))
                                    out.close()
                                    known.clear()
                                name, at = f"{uuid.uuid4().hex}.tar", 0
                                out = store.open_output_stream(f"{root}/{name}", compression=None)
                            out.write(tar_header(digest.hex() + ".png", len(stored)))
                            out.write(stored)
                            out.write(bytes(-len(stored) % 512))
                            known[digest] = (name, at + 512, len(stored))
                            at += 512 + len(stored) + -len(stored) % 512
                        rows.append((len(own), digest, *known[digest]))
                    columns = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(i, j - i), *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.string(), pa.int64(), pa.int64()), strict=True))],
                        names=["doc_id", "n_bytes", "digest", "shard", "offset", "length"],
                    )
        finally:
            if out is not None:
                out.write(bytes(1024))
                out.close()

    bounded_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col(text).cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, n_bytes long, digest binary, shard string, offset long, length long")


def ranged(members: DataFrame, folder: str, schema: str, read) -> DataFrame:
    """members (digest, shard, offset, length, ...) with columns that read(file, offset, length) gives, from range reads in shard
    order."""
    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = members.repartitionByRange(tasks, "shard", "offset").sortWithinPartitions("shard", "offset")
    address = [members.columns.index(c) for c in ("shard", "offset", "length")]
    from pyspark.sql import types as T

    added = T.StructType.fromDDL(schema)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        store, root = open_store(folder)
        fields = to_arrow_schema(added)
        name, file = None, None
        for batch in batches:
            rows = []
            for shard, offset, length in zip(*(batch.column(c).to_pylist() for c in address), strict=True):
                if shard != name:
                    if file is not None:
                        file.close()
                    name, file = shard, store.open_input_file(f"{root}/{shard}")
                rows.append(read(file, offset, length))
            if rows:
                yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), fields, strict=True))], names=[*batch.schema.names, *fields.names])
        if file is not None:
            file.close()

    return dealt.mapInArrow(run, T.StructType([*dealt.schema.fields, *added.fields]))


def header_columns(members: DataFrame, folder: str) -> DataFrame:
    """width, height, bits of each member, from its first HEADER bytes only."""

    def read(file, offset, length):
        file.seek(offset)
        return dimensions(file.read(min(HEADER, length)))

    return ranged(members, folder, "width int, height int, bits int", read)


def stored_columns(members: DataFrame, folder: str) -> DataFrame:
    """What the stored bytes hold, read back whole."""

    def read(file, offset, length):
        file.seek(offset)
        stored = file.read(length)
        payload = decode(stored)
        return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), length, hashlib.sha256(stored).hexdigest(), feature(payload)

    return ranged(members, folder, "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string", read)


def catalogue(docs: DataFrame, scratch: Scratch, text: str = "text") -> tuple[DataFrame, DataFrame, str]:
    """(rows, members, folder): rows doc_id, n_bytes, digest of every document; members one address for each digest, the first
    by shard and offset. Equal texts in different shards leave copies that nothing points to."""
    folder = scratch.path("shards")
    rows = scratch.write(write_shards(docs, folder, text), "rows")
    members = rows.groupBy("digest").agg(F.min(F.struct("shard", "offset", "length")).alias("m"), F.count(F.lit(1)).alias("n")).select("digest", "m.*", "n")
    return rows.select("doc_id", "n_bytes", "digest"), scratch.write(members, "members"), folder


def media_table(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_bytes, digest, shard, offset, length (the address of the stored PNG), width, height, bits, payload_bytes,
    payload_sha256, tail_crc32, media_bytes, media_sha256, feature of every row.

    width, height and bits come from header-only range reads (HEADER bytes a member); a second pass reads the members whole, for
    what only the payload tells, and fails the job where a payload or its size does not agree with digest and header. Null and
    empty texts give a payload of 64 zero bytes. Equal texts share an address, so they have equal values, and one digest with very
    many rows is joined without shuffling them. Repeated rows stay. An empty table gives an empty result. Only doc_id and the text
    column are read.
    """
    scratch = Scratch(docs.sparkSession, "media")
    rows, members, folder = catalogue(docs, scratch, text)
    heads = scratch.write(header_columns(members, folder), "heads")
    scratch.drop("members")
    agree = (F.col("payload_sha256") == F.lower(F.hex("digest"))) & (F.col("payload_bytes") == F.col("width").cast("long") * F.col("height"))
    checked = F.when(agree, F.col("payload_sha256")).otherwise(F.raise_error(F.lit("a payload does not match its digest or header")))
    held = scratch.write(stored_columns(heads, folder).withColumn("payload_sha256", checked), "held")
    scratch.drop("shards", "heads")
    return join_counted(rows, held, ["digest"]).select(
        "doc_id", "n_bytes", F.lower(F.hex("digest")).alias("digest"), "shard", "offset", "length", "width", "height", "bits", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"
    )
