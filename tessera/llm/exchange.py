"""Ask-and-answer over the corpus: blocks of texts send the keys they hold to key parts,
and each part answers every block in the order it asked.

A corpus-wide table (counts of n-grams or words, repeated strings) can be larger than any
machine, so nothing here is broadcast.  Documents are packed, as they are scanned, into
blocks of bounded size; a block lists its distinct keys once per part, as one binary row.
``streamed`` deals rows by a column, sorts them and feeds them to a function one by one, so
that a task holds one part's merged table or one block, never a whole group of rows.
Blocks are written to the shared folder before they are used: block numbers come from the
scan's tasks, and only committed rows count.
"""
from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .textbuf import lean, slices

BLOCK_BYTES = 4 << 20
BLOCK_DOCS = 60_000


def squeeze(a: np.ndarray, ascending: bool = False) -> bytes:
    """Compressed array: differences (if ascending), bytes of equal weight side by side."""
    kind = a.dtype.str
    if ascending and len(a):
        a = np.concatenate([a[:1], a[1:] - a[:-1]])
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes() if len(a) else b""
    return bytes([ascending, len(kind)]) + kind.encode() + zstandard.compress(planes, 1)


def unsqueeze(raw: bytes) -> np.ndarray:
    ascending, n = raw[0], raw[1]
    kind = np.dtype(raw[2:2 + n].decode())
    planes = np.frombuffer(zstandard.decompress(raw[2 + n:]), dtype=np.uint8)
    a = np.ascontiguousarray(planes.reshape(kind.itemsize, -1).T).view(kind).reshape(-1)
    return np.cumsum(a, dtype=kind) if ascending else a


def pack_rows(table: pa.Table, level: int = 1) -> bytes:
    """Compressed rows; a higher ``level`` makes texts that are stored for long smaller."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", level))) as w:
        w.write_table(table)
    return sink.getvalue().to_pybytes()


def unpack_rows(raw: bytes) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(raw)).read_all().combine_chunks()


def blocks(batches: Iterator[pa.RecordBatch], text: str, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, pa.Table]]:
    """``(block number, rows)`` with about ``limit`` bytes of text (one text at least) each;
    numbers are unique over tasks."""
    task = TaskContext.get()
    number = (task.partitionId() if task else 0) << 32
    held, size, rows = [], 0, 0
    for batch in batches:
        for part in slices(batch, text, limit // 4):
            held.append(part)
            size += part.column(part.schema.get_field_index(text)).nbytes
            rows += part.num_rows
            if size >= limit or rows >= BLOCK_DOCS // 2:
                yield number, pa.Table.from_batches(held).combine_chunks()
                number, held, size, rows = number + 1, [], 0, 0
    if held:
        yield number, pa.Table.from_batches(held).combine_chunks()


def parts_for(df: DataFrame, least: int = 64, most: int = 16_384) -> int:
    """Number of key parts: follows the scan's number of splits, hence the input's size."""
    return max(least, min(most, 2 * df.rdd.getNumPartitions()))


def by_part(keys: np.ndarray, part: np.ndarray, n_parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts ``keys`` by part, then by key, and each part's first place."""
    order = np.lexsort((keys, part))
    return order, np.searchsorted(part[order], np.arange(n_parts + 1))


def streamed(df: DataFrame, deal: list[str], order: list[str],
             fn: Callable[[Iterator[dict]], Iterator[tuple]], ddl: str, schema: pa.Schema,
             rows_per_batch: int = 64) -> DataFrame:
    """Deal ``df`` by ``deal``, sort each partition by ``order`` and map its rows, in order,
    through ``fn`` (dicts in, tuples of ``schema`` out)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for batch in batches:
                names = batch.schema.names
                for i in range(batch.num_rows):
                    yield {n: batch.column(k)[i].as_py() for k, n in enumerate(names)}

        held: list[tuple] = []
        size = 0
        for row in fn(rows()):
            held.append(row)
            size += sum(len(v) for v in row if isinstance(v, bytes))
            if len(held) >= rows_per_batch or size >= 4 << 20:
                yield to_batch(held, schema)
                held, size = [], 0
        if held:
            yield to_batch(held, schema)

    return df.repartition(*deal).sortWithinPartitions(*order).mapInArrow(lean(run), ddl)


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def merge_counts(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with summed counts."""
    keys = np.concatenate([k for k, _ in held])
    counts = np.concatenate([c for _, c in held])
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts[order], first) if len(keys) else counts


def crc_of(key: str) -> int:
    return zlib.crc32(key.encode())


PAYLOADS = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("payload", pa.binary())])
PAYLOADS_DDL = "block long, part int, payload binary"


def text_blocks(docs: DataFrame, text: str, name: str, limit: int = BLOCK_BYTES, level: int = 1) -> DataFrame:
    """Documents packed into numbered blocks (``block, payload``), stored."""
    from .shared import stored

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows in blocks(batches, text, limit):
            yield to_batch([(number, -1, pack_rows(rows, level))], PAYLOADS)

    return stored(docs.mapInArrow(run, PAYLOADS_DDL), name)


def power_of_two_parts(df: DataFrame, least: int = 64) -> int:
    n = least
    while n < 2 * df.rdd.getNumPartitions():
        n *= 2
    return n


class Fingerprints:
    """Sorted distinct fingerprints of one block: ``bits`` leading bits of 64-bit hashes, whose
    first ones name the part."""

    def __init__(self, hashes: np.ndarray, n_parts: int, bits: int):
        self.order = np.argsort(hashes, kind="stable")
        keys = hashes[self.order] >> np.uint64(64 - bits)
        fresh = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, bool)
        self.slot = np.cumsum(fresh) - 1
        first = np.flatnonzero(fresh)
        self.keys = keys[first]
        self.again = np.diff(np.append(first, len(keys))) > 1
        limits = np.arange(n_parts, dtype=np.uint64) << np.uint64(bits - (n_parts.bit_length() - 1))
        self.cuts = np.append(np.searchsorted(self.keys, limits), len(self.keys))

    def requests(self, block: int) -> list[tuple]:
        return [(block, p, squeeze(self.keys[a:b], True), np.packbits(self.again[a:b]).tobytes())
                for p, (a, b) in enumerate(zip(self.cuts[:-1].tolist(), self.cuts[1:].tolist())) if b > a]

    def spread(self, answers: list[tuple[int, bytes]]) -> np.ndarray:
        """Per hash: the answer of its fingerprint."""
        said = np.zeros(len(self.keys), dtype=bool)
        for p, raw in answers:
            a, b = self.cuts[p], self.cuts[p + 1]
            said[a:b] = np.unpackbits(np.frombuffer(raw, np.uint8), count=b - a).astype(bool)
        out = np.zeros(len(self.order), dtype=bool)
        out[self.order] = said[self.slot]
        return out


REQUESTS = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("payload", pa.binary()), ("again", pa.binary())])


def repeated_keys(blocks_df: DataFrame, fingerprints: Callable[[bytes], Fingerprints]) -> DataFrame:
    """Which fingerprints of each block occur more than once in the corpus: ``block, part,
    payload`` (bits in the order of the block's fingerprints of that part).

    A part is sorted on its own (one bucket at a time).  It holds its requests compressed
    until all have come, then answers them; the number of parts follows the input, so that
    bounds a task's memory.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = fingerprints(raw.as_py()).requests(block)
                if rows:
                    yield to_batch(rows, REQUESTS)

    def answered(part: int, held: list[tuple[int, bytes, bytes]]) -> Iterator[tuple]:
        every, again = [], []
        for _, raw, flags in held:
            keys = unsqueeze(raw)
            every.append(keys)
            again.append(keys[np.unpackbits(np.frombuffer(flags, np.uint8), count=len(keys)).astype(bool)])
        keys = np.sort(np.concatenate(every + again))  # a key that a block holds twice counts twice
        twice = np.unique(keys[1:][keys[1:] == keys[:-1]])
        del keys
        for (block, _, _), mine in zip(held, every):
            at = np.searchsorted(twice, mine)
            at[at == len(twice)] = 0
            said = twice[at] == mine if len(twice) else np.zeros(len(mine), bool)
            yield block, part, np.packbits(said).tobytes()

    def run(rows: Iterator[dict]) -> Iterator[tuple]:
        at, held = None, []
        for row in rows:
            if row["part"] != at:
                if held:
                    yield from answered(at, held)
                at, held = row["part"], []
            held.append((row["block"], row["payload"], row["again"]))
        if held:
            yield from answered(at, held)

    asked = blocks_df.select("block", "payload").mapInArrow(ask, PAYLOADS_DDL + ", again binary")
    return streamed(asked, ["part"], ["part", "block"], run, PAYLOADS_DDL, PAYLOADS)


def with_answers(blocks_df: DataFrame, answers: DataFrame, fn: Callable[[int, bytes, list], Iterator[tuple]],
                 ddl: str, schema: pa.Schema, rows_per_batch: int = 64) -> DataFrame:
    """Bring each block and its answers together and map them through ``fn``."""

    def run(rows: Iterator[dict]) -> Iterator[tuple]:
        at, payload, held = None, b"", []
        for row in rows:
            if row["part"] < 0:  # the block itself comes first
                if at is not None:
                    yield from fn(at, payload, held)
                at, payload, held = row["block"], row["payload"], []
            else:
                held.append((row["part"], row["payload"]))
        if at is not None:
            yield from fn(at, payload, held)

    both = blocks_df.select("block", "part", "payload").unionByName(answers)
    return streamed(both, ["block"], ["block", "part"], run, ddl, schema, rows_per_batch)
