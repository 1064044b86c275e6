"""Cost-balanced packing of token sequences.

A document costs ``linear * n + quadratic * n**2`` (feed-forward and attention work of n
tokens).  Documents are taken by descending length and each goes to the sequence of lowest
cost that still has room for it; one that fits nowhere is cut.  Sequences hold ``capacity``
tokens.  The rest of a group that does not fill a whole sequence goes to sequences whose
lengths are powers of two (the binary digits of that rest), which need no padding.

Packing is done in groups of about ``group_tokens`` tokens, as a task reads its
documents: no shuffle, bounded memory, and no key that could be hot.  Every group is filled
completely, so groups cost no padding either.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textbuf import TextBuf, lean, segment_sums, slices
from .wordtok import json_tokenizer, word_units

CAPACITY = 2048
GROUP_TOKENS = 1 << 21
#: Bytes of text after which a group may close.
STEP_BYTES = 2 << 20
LINEAR, QUADRATIC = 1.0, 1.0 / 1024


def plan_group(lengths: np.ndarray, capacity: int = CAPACITY, linear: float = LINEAR,
               quadratic: float = QUADRATIC) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, sequence, offset)`` for one group.

    Whole multiples of ``capacity`` at the head of a document are sequences of their own;
    what is left of every document is assigned by descending length (ties: input order).
    """
    pieces = []
    n_seq = 0
    rest = []
    for d, n in enumerate(lengths.tolist()):
        at = 0
        while n - at >= capacity:
            pieces.append((d, at, capacity, n_seq, 0))
            n_seq += 1
            at += capacity
        if n > at:
            rest.append((n - at, d, at))
    total = sum(r[0] for r in rest)
    rooms = [capacity] * (total // capacity)
    rooms += [1 << b for b in range(total.bit_length(), -1, -1) if (total % capacity) >> b & 1]
    room = np.array(rooms, dtype=np.int64)
    size = room.copy()
    cost = np.zeros(len(room))
    for left, d, at in sorted(rest, key=lambda r: (-r[0], r[1])):
        while left:
            fits = np.where(room >= left, cost, np.inf)
            s = int(fits.argmin())
            if not np.isfinite(fits[s]):
                s = int(room.argmax())  # fits nowhere whole: fill the widest gap and go on with the rest
            n = min(left, int(room[s]))
            pieces.append((d, at, n, n_seq + s, int(size[s] - room[s])))
            room[s] -= n
            cost[s] += linear * n + quadratic * n * n
            left -= n
            at += n
    return pieces


def pack_documents(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text",
                   end_id: int = 1, capacity: int = CAPACITY, group_tokens: int = GROUP_TOKENS,
                   linear: float = LINEAR, quadratic: float = QUADRATIC, with_ids: bool = True) -> DataFrame:
    """Pieces of all documents: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``
    and, with ``with_ids``, ``ids`` (little-endian unsigned 32-bit ids of the piece).

    A document's ids are its text's ids followed by ``end_id``; a null or empty text is
    that one id.  Null keys stay null, repeated rows are packed one by one, equal lengths
    keep their order, other columns are ignored, an empty table gives no pieces.  A
    document longer than a group is a group of its own.  Sequence ids are unique and need
    not be consecutive (task number, then a counter).
    """
    fields = [pa.field(key, _arrow_type(docs, key)), ("start", pa.int64()), ("length", pa.int64()),
              ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
              ("offset", pa.int64())] + ([("ids", pa.binary())] if with_ids else [])
    schema = pa.schema(fields)

    def flush(keys: list[pa.Array], ids: list[np.ndarray], lengths: np.ndarray, first_seq: int):
        flat = np.concatenate(ids).astype("<u4")
        begins = np.cumsum(lengths) - lengths
        pieces = np.array(plan_group(lengths, capacity, linear, quadratic), dtype=np.int64).reshape(-1, 5)
        d, at, n, seq, offset = pieces.T
        raw = [flat[a:b].tobytes() for a, b in zip((begins[d] + at).tolist(), (begins[d] + at + n).tolist())]
        columns = [pa.concat_arrays(keys).take(pa.array(d)), at, n, [zlib.crc32(x) for x in raw],
                   lengths[d], first_seq + seq, offset] + ([raw] if with_ids else [])
        out = pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type)
                                          for c, f in zip(columns, schema)], schema=schema)
        return out, int(seq.max()) + 1 if len(seq) else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = json_tokenizer(tokenizer_path)
        task = TaskContext.get()
        seq = (task.partitionId() if task else 0) << 36
        keys, ids, lens, held = [], [], [], 0
        for batch in batches:
            for step in slices(batch, text, STEP_BYTES):
                for part in slices(step, text, STEP_BYTES // 2):
                    buf = TextBuf(part.column(part.schema.get_field_index(text)))
                    starts, ends, firsts, hashes = word_units(buf)
                    flat, per_word = cache.tokens(buf, starts, ends, hashes)
                    per_doc = segment_sums(per_word, firsts)
                    n = per_doc + 1
                    with_end = np.full(int(n.sum()), end_id, dtype=np.int32)
                    with_end[np.arange(len(flat)) + np.repeat(np.arange(buf.n), per_doc)] = flat
                    keys.append(part.column(part.schema.get_field_index(key)))
                    ids.append(with_end)
                    lens.append(n)
                    held += len(with_end)
                if held >= group_tokens:
                    out, used = flush(keys, ids, np.concatenate(lens), seq)
                    yield out
                    seq += used
                    keys, ids, lens, held = [], [], [], 0
        cache.clear()
        if held:
            yield flush(keys, ids, np.concatenate(lens), seq)[0]

    types = dict(docs.dtypes)
    ddl = (f"`{key}` {types[key]}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
           "offset long" + (", ids binary" if with_ids else ""))
    return docs.select(F.col(key), F.col(text)).mapInArrow(lean(run), ddl)


def _arrow_type(df: DataFrame, name: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(df.schema[name].dataType)
