"""Exact removal of repeated byte strings by blockwise suffix sorting with a difference cover.

Every byte that lies in a string of ``LENGTH`` bytes which starts anywhere else too is
removed; strings do not cross texts.

1. Cover sample.  Positions whose offset modulo ``PERIOD`` is in the difference cover are
   ranked first.  For any two positions some common shift below ``PERIOD`` brings both into
   the cover, so two equal strings always hold an equal pair of sample suffixes with at
   least ``SAMPLE_LENGTH`` = ``LENGTH - PERIOD`` bytes in common.  Sample suffixes are dealt into
   buckets; each bucket is sorted on its own and tells which of its suffixes tie.
2. Suffixes.  Only positions within reach of a tied sample suffix can start a repeated
   string: the sample's ranks settle all others.  These remaining suffixes are sorted
   the same way, one bucket at a time, on their first ``LENGTH`` bytes; a tie is a repeat.

A tie, not the order, is what removal needs, so buckets compare fingerprints of the bytes
(64-bit polynomial hashes) instead of the bytes: equal strings always tie, and N remaining
suffixes tie wrongly with probability below N**2 / 2**65.  Sample ranks use 40 bits within a
bucket; a wrong tie there only costs work in step 2.

Texts travel in blocks of bounded size (``exchange.py``); a block asks each bucket about its
suffixes and gets one bit each.  Nothing is broadcast and no bucket holds a text.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .exchange import (PAYLOADS, PAYLOADS_DDL, Fingerprints, pack_rows, power_of_two_parts, repeated_keys, text_blocks,
                       to_batch, unpack_rows, with_answers)
from .packing import _arrow_type
from .shared import stored
from .textbuf import RangeHasher, TextBuf

LENGTH = 400
#: Perfect difference cover of the residues modulo 133: each difference occurs once.
PERIOD = 133
COVER = (0, 1, 3, 17, 21, 58, 65, 73, 100, 105, 111, 124)
SAMPLE_LENGTH = LENGTH - PERIOD
SAMPLE_BITS = 40
#: Bytes of text whose suffixes one task holds at a time.
BLOCK_BYTES = 2 << 20
#: Compression of stored texts: 0.33 of prose instead of 0.45 with the lowest level.
LEVEL = 6
_HASH = RangeHasher(5)


def _in_cover() -> np.ndarray:
    cover = np.zeros(PERIOD, dtype=bool)
    cover[list(COVER)] = True
    assert len({(a - b) % PERIOD for a in COVER for b in COVER}) == PERIOD
    return cover


IN_COVER = _in_cover()


def text_of(rows: pa.Table, column: str) -> TextBuf:
    c = rows.column(column)
    return TextBuf(c.chunk(0) if c.num_chunks else c.combine_chunks())


def sample_positions(buf: TextBuf) -> np.ndarray:
    """Cover positions of all texts with ``SAMPLE_LENGTH`` bytes after them in their text."""
    found = []
    steps = np.flatnonzero(IN_COVER)
    for a, b in zip(buf.offs[:-1].tolist(), buf.offs[1:].tolist()):
        if b - a >= LENGTH:
            rounds = np.arange(0, b - a - SAMPLE_LENGTH + 1, PERIOD)
            at = (rounds[:, None] + steps).reshape(-1)
            found.append(a + at[at <= b - a - SAMPLE_LENGTH])
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def sample_fingerprints(buf: TextBuf, n_parts: int) -> tuple[np.ndarray, Fingerprints]:
    at = sample_positions(buf)
    hashes = _HASH.ranges(_HASH.prefix(buf.data), at, at + SAMPLE_LENGTH)
    return at, Fingerprints(hashes, n_parts, min(64, SAMPLE_BITS + n_parts.bit_length() - 1))


def covered(n: int, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
    """Which of ``n`` places lie in a range."""
    edge = np.bincount(starts, minlength=n + 1).astype(np.int64)
    edge -= np.bincount(starts + lengths, minlength=n + 1)[:n + 1]
    return np.cumsum(edge)[:n] > 0


def candidate_starts(buf: TextBuf, tied: np.ndarray) -> np.ndarray:
    """Places from which a string of ``LENGTH`` bytes fits and holds a tied sample suffix."""
    doc = np.searchsorted(buf.offs, tied, side="right") - 1
    first = np.maximum(tied - PERIOD + 1, buf.offs[doc])
    last = np.minimum(tied, buf.offs[doc + 1] - LENGTH)
    ok = last >= first
    return np.flatnonzero(covered(len(buf.data), first[ok], (last - first + 1)[ok]))


def suffix_fingerprints(buf: TextBuf, starts: np.ndarray, n_parts: int) -> Fingerprints:
    return Fingerprints(_HASH.ranges(_HASH.prefix(buf.data), starts, starts + LENGTH), n_parts, 64)


RESULT_DDL = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", with_kept: bool = False) -> DataFrame:
    """Per document row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and, with
    ``with_kept``, ``kept`` (the remaining bytes).

    Null texts are empty; texts below ``LENGTH`` bytes keep everything; equal rows repeat
    each other, whatever their keys; null keys stay null; other columns are ignored; an
    empty table gives no rows.  Very long texts are blocks of their own.
    """
    n_parts = power_of_two_parts(docs)
    blocks = text_blocks(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), "text", "suffix-texts", BLOCK_BYTES, LEVEL)

    def sample_request(raw: bytes) -> Fingerprints:
        return sample_fingerprints(text_of(unpack_rows(raw), "text"), n_parts)[1]

    key_type = _arrow_type(docs, key)
    fields = [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
    schema = pa.schema([pa.field(key, key_type), *[pa.field(*f) for f in fields]]
                       + ([pa.field("kept", pa.binary())] if with_kept else []))
    kind = dict(docs.dtypes)[key]
    ddl = f"`{key}` {kind}, {RESULT_DDL}" + (", kept binary" if with_kept else "")

    def results(keys: pa.Array, buf: TextBuf, gone: np.ndarray | None) -> Iterator[tuple]:
        for d, (k, a, b) in enumerate(zip(keys.to_pylist(), buf.offs[:-1].tolist(), buf.offs[1:].tolist())):
            whole = buf.data[a:b]
            out = gone[a:b] if gone is not None else np.zeros(b - a, bool)
            kept = whole[~out].tobytes() if out.any() else whole.tobytes()
            n_spans = int(out[:1].sum() + (out[1:] & ~out[:-1]).sum())
            yield (k, b - a, b - a - len(kept), n_spans, hashlib.sha256(kept).hexdigest()) + ((kept,) if with_kept else ())

    # Step 1: candidates.  Blocks shrink to the documents with a tied sample suffix; the others are done.
    pending = pa.schema([("key", key_type), ("text", pa.binary()), ("starts", pa.list_(pa.int64()))])

    def candidates(block: int, raw: bytes, answers: list) -> Iterator[tuple]:
        rows = unpack_rows(raw)
        buf = text_of(rows, "text")
        at, prints = sample_fingerprints(buf, n_parts)
        starts = candidate_starts(buf, at[prints.spread(answers)])
        begins, ends = run_edges(starts)
        doc = np.searchsorted(buf.offs, begins, side="right") - 1
        open_docs = np.unique(doc)
        texts = pa.array([buf.data[buf.offs[d]:buf.offs[d + 1]].tobytes() for d in open_docs.tolist()], pa.binary())
        ranges = _ranges_by_doc(begins, ends, doc, open_docs, buf)
        keys = rows.column("key").combine_chunks()
        keys = keys.chunk(0) if isinstance(keys, pa.ChunkedArray) else keys
        yield block, -1, pack_rows(pa.Table.from_arrays(
            [keys.take(pa.array(open_docs)), texts, pa.array(ranges, pa.list_(pa.int64()))], schema=pending), LEVEL)
        rest = np.ones(buf.n, bool)
        rest[open_docs] = False
        closed = rows.filter(pa.array(rest))
        yield block, -2, pack_rows(_table(results(keys.filter(pa.array(rest)), text_of(closed, "text"), None), schema), LEVEL)

    first = stored(with_answers(blocks, repeated_keys(blocks, sample_request), candidates, PAYLOADS_DDL, PAYLOADS, 4),
                   "suffix-candidates")
    open_blocks = first.where("part = -1")

    def opened(raw: bytes) -> tuple[pa.Table, TextBuf, np.ndarray]:
        rows = unpack_rows(raw)
        buf = text_of(rows, "text")
        ranges = rows.column("starts").to_pylist()
        starts = [np.arange(a + o, b + o) for o, r in zip(buf.offs.tolist(), ranges) for a, b in zip(r[::2], r[1::2])]
        return rows, buf, np.concatenate(starts) if starts else np.zeros(0, np.int64)

    def suffix_request(raw: bytes) -> Fingerprints:
        _, buf, starts = opened(raw)
        return suffix_fingerprints(buf, starts, n_parts)

    # Step 2: the remaining suffixes, and the removal itself.
    def remove(block: int, raw: bytes, answers: list) -> Iterator[tuple]:
        rows, buf, starts = opened(raw)
        repeated = starts[suffix_fingerprints(buf, starts, n_parts).spread(answers)]
        keys = rows.column("key").combine_chunks()
        yield from results(keys, buf, covered(len(buf.data), repeated, LENGTH))

    done = with_answers(open_blocks, repeated_keys(open_blocks, suffix_request), remove, ddl, schema, 2000)

    def closed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0):
                yield from unpack_rows(raw.as_py()).to_batches()

    return done.unionByName(first.where("part = -2").select("payload").mapInArrow(closed, ddl))


def _ranges_by_doc(begins, ends, doc, open_docs, buf) -> list[list[int]]:
    cuts = np.searchsorted(doc, np.append(open_docs, doc[-1] + 1 if len(doc) else 0))
    pairs = np.stack([begins - buf.offs[doc], ends - buf.offs[doc]], 1)
    return [pairs[a:b].reshape(-1).tolist() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


def _table(rows: Iterator[tuple], schema: pa.Schema) -> pa.Table:
    rows = list(rows)
    return pa.Table.from_batches([to_batch(rows, schema)] if rows else [], schema=schema)


def run_edges(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends (exclusive) of the runs of consecutive numbers."""
    if not len(places):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.flatnonzero(np.diff(places) > 1)
    return places[np.concatenate([[0], new + 1])], places[np.concatenate([new, [len(places) - 1]])] + 1
