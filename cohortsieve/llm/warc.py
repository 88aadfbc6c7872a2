"""Operator 6, WARC archives in Zstandard: a writer with identical-payload revisits, and the reader.

An archive starts with a skippable frame (magic 0x184D2A5D) that holds the compression dictionary; each record
is a Zstandard frame of its own. The reader loads the dictionary, decodes frame by frame in small chunks and validates:
the version line, the header lines, that Content-Length is the block's length, the closing blank lines, that an
HTTP block's Content-Length is the payload's length, and the payload digest. A record that fails is a row with
``error``; a broken frame ends its archive with such a row.

Scale: payloads meet the first pages of repeated digests in one equi-join, whose hot digests Spark's skew join
splits; the digests are counted map-side. Tasks write archives of ``ARCHIVE_BYTES`` to the shared folder and return their paths;
only paths that Spark has committed are read, so what a lost or repeated task left behind is never seen.
The dictionary is trained on the first ``TRAIN_BYTES`` of whole payloads of each archive; it shapes sizes, not results. A worker holds
that buffer, one Arrow batch and one record.

Defined cases: a NULL html is an empty payload; a NULL url leaves out the target address; rows whose page_id is NULL refer to the smallest page_id with
the same payload, and are responses if there is none. Repeated rows with the smallest page_id are all responses. An empty table
gives no archives and no rows. Further columns are not read. Control characters in a url are percent-encoded.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortsieve.llm.registry import query
from cohortsieve.llm.texts import table
from cohortsieve.session import cut_lineage, new_folder

#: Payloads from this size on are stored once (bytes).
REVISIT_FROM = 100
ARCHIVE_BYTES, TRAIN_BYTES, DICTIONARY_BYTES, CHUNK = 64 << 20, 1 << 20, 32 << 10, 1 << 18
#: Formats (fixed values).
DICTIONARY_MAGIC, FRAME_MAGIC = 0x184D2A5D, 0xFD2FB528
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The pages carry no time of capture.
DATE = "1970-01-01T00:00:00Z"


def with_records(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, digest, refers_to): refers_to is set for revisits."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2("html", 256))
    firsts = (rows.filter(F.octet_length("html") >= REVISIT_FROM).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    return rows.join(firsts, "digest", "left").select(
        "page_id", "url", "html", "digest",
        F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))


def _id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_id(page_id)}",
            f"WARC-Date: {DATE}", "Content-Type: application/http;msgtype=response",
            f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="".join(map(chr, range(33, 127)))))
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_id(refers_to)}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def train(samples: list[bytes]) -> bytes:
    """A dictionary for the records, or no bytes where there is too little to learn from."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if len(samples) > 7 else b""
    except zstandard.ZstdError:
        return b""


def frames(records: Iterator[bytes]) -> Iterator[bytes]:
    """An archive piece by piece: the dictionary's frame, then one frame per record."""
    import zstandard

    waiting, size = [], 0
    for r in records:
        waiting.append(r)
        size += len(r)
        if size >= TRAIN_BYTES:
            break
    dictionary = train(waiting)
    if dictionary:
        yield struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary
    known = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
    packer = zstandard.ZstdCompressor(level=3, write_checksum=True, **known)
    for r in waiting:
        yield packer.compress(r)
    for r in records:
        yield packer.compress(r)


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write the rows of ``with_records``; (path, n_records) of each archive, as committed by Spark."""
    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        state = {"n": 0, "bytes": 0, "next": next(rows, None)}

        def some() -> Iterator[bytes]:
            while state["next"] is not None and state["bytes"] < ARCHIVE_BYTES:
                page_id, url, html, digest, refers_to = state["next"]
                out = record(page_id, url, html.encode(), digest, refers_to)
                state["n"] += 1
                state["bytes"] += len(out)
                state["next"] = next(rows, None)
                yield out

        while state["next"] is not None:
            state["n"] = state["bytes"] = 0
            path = f"{base}/{uuid.uuid4().hex}.warc.zst"
            store.create_dir(base, recursive=True)
            with store.open_output_stream(path) as out:
                for piece in frames(some()):
                    out.write(piece)
            name = path.rsplit("/", 1)[1]
            yield pa.record_batch({"path": pa.array([f"{folder}/{name}"]), "n_records": pa.array([state["n"]], pa.int64())})

    ordered = records.select("page_id", "url", "html", "digest", "refers_to")
    return cut_lineage(ordered.mapInArrow(per_partition, "path string, n_records long"), "warc-manifest")


@dataclass
class Found:
    record_type: str | None = None
    page_id: int | None = None
    refers_to: int | None = None
    target_uri: str | None = None
    payload: bytes | None = None
    payload_bytes: int | None = None
    payload_digest: str | None = None
    error: str | None = None


def _page(value: str | None) -> int | None:
    number = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number.lstrip("-").isdigit() else None


def _headers(data: bytes, version: bytes, what: str) -> tuple[dict[str, str], int]:
    end = data.find(b"\r\n\r\n")
    if not data.startswith(version) or end < 0:
        raise ValueError(f"no {what} header")
    out = {}
    for line in data[:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise ValueError(f"{what} header line {line[:80]!r}")
        out[name.strip().decode("latin-1").lower()] = value.strip().decode("utf-8", "replace")
    return out, end + 4


def parse(data: bytes) -> Found:
    """A record, validated; ``error`` names the first fault."""
    found = Found()
    try:
        head, start = _headers(data, b"WARC/1.", "WARC")
        found.record_type, found.page_id = head.get("warc-type"), _page(head.get("warc-record-id"))
        found.target_uri = head.get("warc-target-uri")
        length = int(head.get("content-length", "-1"))
        block, rest = data[start:start + max(length, 0)], data[start + max(length, 0):]
        if length < 0 or len(block) != length or rest != b"\r\n\r\n":
            raise ValueError("Content-Length is not the length of the block")
        if head.get("warc-block-digest", "sha256:").startswith("sha256:") and "warc-block-digest" in head:
            if head["warc-block-digest"] != "sha256:" + hashlib.sha256(block).hexdigest():
                raise ValueError("block digest")
        http, begin = _headers(block, b"HTTP/", "HTTP")
        stated, digest = int(http.get("content-length", "-1")), head.get("warc-payload-digest", "").removeprefix("sha256:")
        found.payload_bytes, found.payload_digest = stated, digest
        if found.record_type == "response":
            found.payload = block[begin:]
            if len(found.payload) != stated:
                raise ValueError("HTTP Content-Length is not the length of the payload")
            if hashlib.sha256(found.payload).hexdigest() != digest:
                raise ValueError("payload digest")
        elif found.record_type == "revisit":
            if head.get("warc-profile") != PROFILE or "warc-refers-to" not in head or len(block) != begin:
                raise ValueError("revisit without its profile or reference, or with a payload")
            found.refers_to = _page(head["warc-refers-to"])
        else:
            raise ValueError(f"record type {found.record_type!r}")
    except ValueError as e:
        found.error = str(e)
    return found


def decode_frames(stream) -> Iterator[bytes]:
    """The content of each frame of an archive, in order; ValueError at a broken one."""
    import zstandard

    held = b""

    def need(n: int) -> bool:
        nonlocal held
        while len(held) < n and (more := stream.read(max(CHUNK, n - len(held)))):
            held += more
        return len(held) >= n

    unpacker, first = zstandard.ZstdDecompressor(), True
    while need(1):
        if not need(8):
            raise ValueError("the archive ends inside a frame")
        magic, size = struct.unpack("<II", held[:8])
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            if not need(8 + size):
                raise ValueError("the archive ends inside a skippable frame")
            body, held = held[8:8 + size], held[8 + size:]
            if first and magic == DICTIONARY_MAGIC:
                if body[:4] == struct.pack("<I", FRAME_MAGIC):
                    body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
                unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(body))
            first = False
            continue
        first = False
        frame, out = unpacker.decompressobj(), []
        while not frame.eof:
            if not held and not need(1):
                raise ValueError("the archive ends inside a record")
            try:
                out.append(frame.decompress(held))
            except zstandard.ZstdError as e:
                raise ValueError(str(e)) from e
            held = frame.unused_data if frame.eof else b""
        yield b"".join(out)


FIELDS = [("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("target_uri", pa.string()),
          ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("error", pa.string())]
KIND = ("page_id long, record_type string, refers_to long, target_uri string, payload binary, "
        "payload_bytes long, payload_digest string, error string")


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per record of the archives named by ``path``; the payload is NULL unless asked for."""
    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        def rows() -> Iterator[Found]:
            for b in batches:
                for path in b.column("path").to_pylist():
                    store, name = fs.FileSystem.from_uri(path)
                    with store.open_input_stream(name) as stream:
                        try:
                            yield from map(parse, decode_frames(stream))
                        except ValueError as e:
                            yield Found(error=f"{path}: {e}")

        def batch(held: list[Found]) -> pa.RecordBatch:
            return pa.record_batch([pa.array([getattr(f, n) for f in held], t) for n, t in FIELDS],
                                   names=[n for n, _ in FIELDS])

        held, size = [], 0
        for f in rows():
            size += f.payload_bytes or 0
            held.append(f)
            if not payloads:
                f.payload = None
            if len(held) == 5000 or size > 16 << 20:
                yield batch(held)
                held, size = [], 0
        if held:
            yield batch(held)

    n = min(100_000, max(1, manifest.count()))
    return manifest.select("path").repartition(n, "path").mapInArrow(per_partition, KIND)


@query("op6_warc", f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS n, sha256(html) AS digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= {REVISIT_FROM} AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= {REVISIT_FROM} AND first <> page_id THEN first END AS refers_to, true AS valid FROM f""")
def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    manifest = write_archives(with_records(table(spark, folder, "pages")), new_folder(spark, "warc"))
    return read_archives(manifest, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", F.col("error").isNull().alias("valid"))
