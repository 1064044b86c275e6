"""WARC archives: written as monolithic gzip files, normalised, indexed and read back.

``write_archives`` lays page records into whole-file gzip streams, as many crawlers leave
them: no record can be reached without inflating all before it.  ``normalise`` inflates such
a stream once, in pieces of bounded size, writes every record as its own gzip member and
a sidecar index of offsets (JSON lines).  ``read_records`` seeks by that index.

Files go below the folder given (for the query, in ``spark.checkpoint.dir``) through pyarrow's
file systems, so any store that executors share will do.  A task that runs again writes
files under new names, and only the names that a finished task returned are read later on,
so a lost executor costs its tasks and leaves no half-written archive in use.
"""
from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import scratch, stored

FILE_BYTES = 32 << 20
CHUNK = 1 << 18
LEVEL = 1
#: Payloads below this size are never revisits (contract).
MIN_REVISIT = 100
FILES_DDL = "path string, index string, records long, bytes long"
RECORD_DDL = ("page_id string, record_type string, refers_to string, payload_bytes long, payload_digest string, "
              "target_uri string, payload binary")


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def record_header(page_id: str, url: str | None, kind: str, refers_to: str | None, n_bytes: int, digest: str) -> bytes:
    """Header block of one record.  A revisit has no content; ``WARC-Payload-Digest`` and
    ``X-Payload-Length`` describe the full payload of either kind."""
    safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Target-URI: {safe}",
             f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {n_bytes}"]
    if kind == "revisit":
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += ["Content-Type: text/html", f"Content-Length: {0 if kind == 'revisit' else n_bytes}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def parse_header(block: bytes) -> dict[str, str]:
    lines = block.decode().split("\r\n")
    return dict(x.split(": ", 1) for x in lines[1:] if x)


def classify(pages: DataFrame, key: str = "page_id", html: str = "html", url: str = "url") -> DataFrame:
    """Add ``payload`` (UTF-8 bytes), ``payload_digest``, ``payload_bytes``, ``record_type``, ``refers_to``.

    Of rows with equal payloads of at least ``MIN_REVISIT`` bytes the smallest key is the
    response and rows with a larger key revisit it.  Rows that repeat the smallest key, and
    rows with a null key, are responses too.
    """
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), payload.alias("payload"),
                        F.sha2(payload, 256).alias("payload_digest"),
                        F.octet_length(payload).cast("long").alias("payload_bytes"))
    first = (rows.where(F.col("payload_bytes") >= MIN_REVISIT).groupBy("payload_digest")
             .agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"))
             .where(F.col("first") < F.col("last")).select("payload_digest", "first"))
    # The payload side is large and may be skewed to one digest: adaptive skew handling splits it.
    joined = rows.join(first, "payload_digest", "left")
    revisit = F.col("page_id") > F.col("first")
    return joined.select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first")).alias("refers_to"))


def write_archives(records: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write ``classify`` output as monolithic gzip files of about ``file_bytes`` payload each;
    returns (and stores) one row per file: ``path, index, records, bytes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_fs(folder)
        store.create_dir(root, recursive=True)
        out, done, n, size, path = None, [], 0, 0, ""
        gz: Any = None
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)) for c in
                       ("page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to")]
            for i in range(batch.num_rows):
                page, url, payload, n_bytes, digest, kind, refers = (c[i].as_py() for c in columns)
                if out is None:
                    path = f"{root}/{uuid.uuid4().hex}.warc.gz"
                    out, n, size = store.open_output_stream(path, compression=None), 0, 0
                    gz = zlib.compressobj(LEVEL, wbits=31)
                body = b"" if kind == "revisit" else payload
                out.write(gz.compress(record_header(str(page), url, kind, str(refers), n_bytes, digest) + body + b"\r\n\r\n"))
                n, size = n + 1, size + len(body) + 400
                if size >= file_bytes:
                    out.write(gz.flush())
                    out.close()
                    done.append((path, None, n, size))
                    out = None
        if out is not None:
            out.write(gz.flush())
            out.close()
            done.append((path, None, n, size))
        yield _rows(done, pa.schema([("path", pa.string()), ("index", pa.string()), ("records", pa.int64()),
                                     ("bytes", pa.int64())]))

    return stored(records.mapInArrow(run, FILES_DDL), "warc-raw")


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def inflate(stream, chunk: int = CHUNK) -> Iterator[bytes]:
    """Decompressed pieces of at most ``chunk`` bytes of a gzip file of one or more members."""
    z = zlib.decompressobj(31)
    pending = b""
    while True:
        if not pending:
            pending = stream.read(chunk)
            if not pending:
                if not z.eof:
                    raise EOFError("gzip stream ends inside a member")
                return
        if z.eof:
            z = zlib.decompressobj(31)
        piece = z.decompress(pending, chunk)
        pending = z.unused_data if z.eof else z.unconsumed_tail
        if piece:
            yield piece


def split_records(pieces: Iterator[bytes]) -> Iterator[tuple[bytes, Iterator[bytes]]]:
    """``(header block, iterator over content pieces)`` per record of a decompressed stream.
    The content must be read before the next record is asked for."""
    held = b""
    pieces = iter(pieces)

    def more() -> bool:
        nonlocal held
        piece = next(pieces, b"")
        held += piece
        return bool(piece)

    while held or more():
        while b"\r\n\r\n" not in held:
            if not more():
                raise EOFError("WARC stream ends inside a header")
        block, held = held.split(b"\r\n\r\n", 1)
        left = int(parse_header(block)["Content-Length"])

        def content() -> Iterator[bytes]:
            nonlocal held, left
            while left:
                if not held and not more():
                    raise EOFError("WARC stream ends inside a record")
                piece, held = held[:left], held[left:]
                left -= len(piece)
                yield piece

        yield block, content()
        if left:
            raise ValueError("a record's content was not read to its end")
        while len(held) < 4:
            if not more():
                raise EOFError("WARC stream ends inside a record")
        if held[:4] != b"\r\n\r\n":
            raise ValueError("a record doesn't end with two line ends")
        held = held[4:]


def normalise_file(source: str, store: pafs.FileSystem, folder: str) -> tuple[str, str, int, int]:
    """Rewrite one monolithic file record by record; returns path, index path, records, bytes."""
    name = uuid.uuid4().hex
    path, index = f"{folder}/{name}.warc.gz", f"{folder}/{name}.cdxj"
    n = at = 0
    with store.open_input_stream(source, compression=None) as stream, \
            store.open_output_stream(path, compression=None) as out, store.open_output_stream(index, compression=None) as idx:
        for block, content in split_records(inflate(stream)):
            head = parse_header(block)
            gz = zlib.compressobj(LEVEL, wbits=31)
            size = out.write(gz.compress(block + b"\r\n\r\n")) or 0
            for piece in content:
                size += out.write(gz.compress(piece)) or 0
            size += out.write(gz.compress(b"\r\n\r\n") + gz.flush()) or 0
            idx.write((json.dumps({"id": head["WARC-Record-ID"], "type": head["WARC-Type"], "offset": at, "length": size,
                                   "digest": head["WARC-Payload-Digest"]}) + "\n").encode())
            at += size
            n += 1
    return path, index, n, at


def normalise(files: DataFrame, folder: str) -> DataFrame:
    """Normalise every file of ``write_archives`` (one task per file or a few); returns (and
    stores) ``path, index, records, bytes`` of the rewritten files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_fs(folder)
        store.create_dir(root, recursive=True)
        schema = pa.schema([("path", pa.string()), ("index", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
        for batch in batches:
            for source in batch.column(0).to_pylist():
                yield _rows([normalise_file(source, store, root)], schema)

    return stored(_spread(files).select("path").mapInArrow(run, FILES_DDL), "warc-files")


def _spread(files: DataFrame) -> DataFrame:
    """Deal file names over more partitions than files, so that tasks rarely share a partition."""
    return files.repartition(min(100_000, max(8, 3 * files.count())), "path")


def read_records(files: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """Read every record of normalised files through their indexes: ``page_id, record_type,
    refers_to, payload_bytes, payload_digest, target_uri, payload``.

    Each member is inflated on its own, from the index's offset and length; a response's
    payload is checked against its length and digest.
    """
    schema = pa.schema([("page_id", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("target_uri", pa.string()),
                        ("payload", pa.binary())])
    urn = re.compile(r"<urn:page:(.*)>", re.DOTALL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = open_fs(folder)
        for batch in batches:
            for path, index in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, size = [], 0
                with store.open_input_stream(index, compression=None) as idx, store.open_input_file(path) as f:
                    for line in _lines(idx):
                        entry = json.loads(line)
                        f.seek(entry["offset"])
                        block, body = zlib.decompress(f.read(entry["length"]), 31).split(b"\r\n\r\n", 1)
                        head = parse_header(block)
                        payload = body[:int(head["Content-Length"])]
                        kind, digest = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha256:")
                        if kind == "response" and (len(payload) != int(head["X-Payload-Length"])
                                                   or hashlib.sha256(payload).hexdigest() != digest):
                            raise ValueError(f"record {head['WARC-Record-ID']} of {path} is damaged")
                        refers = urn.fullmatch(head["WARC-Refers-To"])[1] if kind == "revisit" else None
                        rows.append((urn.fullmatch(head["WARC-Record-ID"])[1], kind, refers, int(head["X-Payload-Length"]),
                                     digest, head.get("WARC-Target-URI", ""), payload if with_payload else None))
                        size += len(payload)
                        if size >= CHUNK * 8 or len(rows) >= 5000:
                            yield _rows(rows, schema)
                            rows, size = [], 0
                yield _rows(rows, schema)

    return _spread(files).select("path", "index").mapInArrow(run, RECORD_DDL)


def _lines(stream, chunk: int = CHUNK) -> Iterator[bytes]:
    held = b""
    while piece := stream.read(chunk):
        *lines, held = (held + piece).split(b"\n")
        yield from lines
    if held:
        yield held


def archive(pages: DataFrame, folder: str | None = None, key: str = "page_id", html: str = "html",
            url: str = "url", file_bytes: int = FILE_BYTES) -> tuple[DataFrame, str]:
    """``pages`` as normalised archives: the files' rows and the folder that holds them.

    Null html is an empty payload, null urls are empty, null keys read back as null, very
    long payloads stream in pieces, repeated rows give repeated records, other columns are
    ignored, an empty table gives no files.
    """
    folder = folder or scratch(pages.sparkSession, "warc")
    raw = write_archives(classify(pages, key, html, url), folder + "/raw", file_bytes)
    return normalise(raw, folder + "/archive"), folder


def page_key(c, kind: str):
    """Key column from its text in a record id."""
    return F.when(c != "None", c).cast(kind)
