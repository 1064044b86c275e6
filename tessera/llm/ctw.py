"""Language-model scoring by context-tree weighting over bytes.

A byte is eight binary decisions; each decision has its own context tree over the
``DEPTH`` preceding bytes.  A node keeps how often 0 and 1 followed there in the training texts.
Its Krichevsky-Trofimov estimate is mixed with its children's, with weight one half each:

    Pw(node) = (Pe(node) + product of Pw(children)) / 2

so a prediction mixes the estimates of all depths on the context's path by their posterior
weights.  The path ends at the deepest node that training reached (below it there is
nothing to weigh).  A text is its A-Z-lowered UTF-8 bytes and one end symbol (0xFF, no UTF-8 byte), which
also stands for the context before the text; scores are log10 probabilities of the whole
text under the model trained on the training documents alone.

On Spark: blocks of documents send their distinct (context, byte) strings with training
counts to the part that owns the context's last two bytes (``exchange.py``).  All nodes of depth
two and more lie in one part.  Nodes of depth one and nought (at most 65,280 sums) come to
the driver and go out again as two small tables.  Parts answer each block with the log
probabilities it asked for, and blocks add them up per document.  The table of strings
grows with the corpus and is never in one place.  Word counts for the base score take the
same way.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .exchange import (blocks, by_part, crc_of, merge_counts, pack_rows, parts_for, squeeze, streamed, to_batch,
                       unpack_rows, unsqueeze)
from .packing import _arrow_type
from .shared import stored
from .textbuf import LOWER, RangeHasher, TextBuf, doc_of, mix64, segment_sums

DEPTH = 5
END = 0xFF
#: Stands for the end token among the word hashes.
END_WORD = np.uint64(0x5EED_0F_E2D)
_WORDS = RangeHasher(3, lower=True)
_U = np.uint64
ASK = pa.schema([("block", pa.int64()), ("kind", pa.string()), ("part", pa.int32()), ("payload", pa.binary()),
                 ("counts", pa.binary())])
ASK_DDL = "block long, kind string, part int, payload binary, counts binary"


def held_out(key) -> bool:
    return crc_of(str(key)) % 7 == 2


def gram_keys(buf: TextBuf) -> np.ndarray:
    """Sorted ``string << 16 | document`` for every symbol of every text: a string is the
    ``DEPTH`` bytes before the symbol (the nearest one lowest) and the symbol itself."""
    lens = np.diff(buf.offs)
    n, docs = len(buf.data), buf.n
    x = np.full(n + DEPTH * (docs + 1), END, dtype=np.uint8)
    shift = DEPTH * (np.arange(docs) + 1)
    for d in np.flatnonzero(lens):  # whole texts are copied
        x[buf.offs[d] + shift[d]:buf.offs[d + 1] + shift[d]] = LOWER[buf.data[buf.offs[d]:buf.offs[d + 1]]]
    key = np.zeros(len(x) - DEPTH, dtype=_U)
    for k in range(DEPTH + 1):  # one byte at a time through the key's own eight
        key <<= _U(8)
        key |= x[k:len(x) - DEPTH + k]
    key <<= _U(16)
    begin = buf.offs[:-1] + DEPTH * np.arange(docs)  # the place of a text's first symbol in ``key``
    ends = begin + lens
    key |= np.repeat(np.arange(docs, dtype=np.uint16), np.diff(np.append(begin, len(key))))
    wanted = np.ones(len(key), dtype=bool)
    for k in range(1, DEPTH):
        wanted[ends + k] = False
    key = key[wanted]
    key.sort()
    return key


def word_keys(buf: TextBuf) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of every token: words between ASCII spaces, then one end per text."""
    starts, ends, firsts = buf.words()
    words = _WORDS.ranges(_WORDS.prefix(buf.data), starts, ends)
    return (np.concatenate([words, np.full(buf.n, END_WORD, dtype=_U)]),
            np.concatenate([doc_of(firsts), np.arange(buf.n)]))


class Asked:
    """The distinct strings and tokens of one block, in the order in which parts answer."""

    def __init__(self, rows: pa.Table, text: str, n_parts: int):
        column = rows.column(text)
        self.buf = TextBuf(column.chunk(0) if column.num_chunks else column.combine_chunks())
        self.n_parts = n_parts
        key = gram_keys(self.buf)
        self.gram_doc = (key & _U(0xFFFF)).astype(np.uint16)
        key >>= _U(16)
        fresh = np.ones(len(key), dtype=bool)
        np.not_equal(key[1:], key[:-1], out=fresh[1:])
        grams = key[fresh]
        del key
        self.gram_of = np.cumsum(fresh, dtype=np.int32) - np.int32(1)
        del fresh
        hashes, self.word_doc = word_keys(self.buf)
        words, self.word_of = np.unique(hashes, return_inverse=True)
        self.order, self.cuts, self.keys = {}, {}, {}
        for kind, keys, part in (("gram", grams, part_of_gram(grams, n_parts)),
                                 ("word", words, (mix64(words) % _U(n_parts)).astype(np.int64))):
            order, cuts = by_part(keys, part, n_parts)
            self.order[kind], self.cuts[kind], self.keys[kind] = order, cuts, keys[order]

    def counts(self, train: np.ndarray) -> dict[str, np.ndarray]:
        """Occurrences of each key in the documents with ``train`` true, in asking order."""
        out = {}
        for kind, of, doc in (("gram", self.gram_of, self.gram_doc), ("word", self.word_of, self.word_doc)):
            n = np.bincount(of, weights=train[doc].astype(float), minlength=len(self.keys[kind]))
            out[kind] = n.astype(np.int64)[self.order[kind]]
        return out

    def values(self, kind: str, answers: list[np.ndarray]) -> np.ndarray:
        """Per occurrence: the answered value of its key."""
        given = np.concatenate(answers) if answers else np.zeros(0)
        back = np.empty(len(given), dtype=given.dtype)
        back[self.order[kind]] = given
        return back[self.gram_of if kind == "gram" else self.word_of]


def part_of_gram(grams: np.ndarray, n_parts: int) -> np.ndarray:
    return (mix64((grams >> _U(8)) & _U(0xFFFF)) % _U(n_parts)).astype(np.int64)


def ask(docs: DataFrame, key: str, text: str, n_parts: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows in blocks(batches, text):
            asked = Asked(rows, text, n_parts)
            train = np.array([not held_out(k) for k in rows.column(key).to_pylist()], dtype=bool)
            counts = asked.counts(train)
            yield to_batch([(number, "text", -1, pack_rows(rows), b"")], ASK)
            for kind in ("gram", "word"):
                cuts, keys = asked.cuts[kind], asked.keys[kind]
                out = [(number, kind, p, squeeze(keys[a:b], True), squeeze(counts[kind][a:b]))
                       for p, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if b > a]
                if out:
                    yield to_batch(out, ASK)

    return docs.select(key, text).mapInArrow(run, ASK_DDL)


MERGED = pa.schema([("kind", pa.string()), ("part", pa.int32()), ("payload", pa.binary()), ("counts", pa.binary()),
                    ("tokens", pa.int64()), ("known", pa.int64())])


def merge(asked: DataFrame) -> DataFrame:
    """One row per part: all its keys with their counts over the whole corpus."""

    def run(rows: Iterator[dict]) -> Iterator[tuple]:
        at, held, size = None, [], 0

        def done() -> tuple:
            keys, counts = merge_counts(held)
            return (*at, squeeze(keys, True), squeeze(counts), int(counts.sum()), int((counts > 0).sum()))

        for row in rows:
            if (row["kind"], row["part"]) != at:
                if at:
                    yield done()
                at, held, size = (row["kind"], row["part"]), [], 0
            held.append((unsqueeze(row["payload"]), unsqueeze(row["counts"])))
            size += len(held[-1][0])
            if size > 3_000_000 + 2 * len(held[0][0]):
                held = [merge_counts(held)]
                size = len(held[0][0])
        if at:
            yield done()

    return streamed(asked.where("part >= 0").select("kind", "part", "payload", "counts"), ["kind", "part"],
                    ["kind", "part"], run, "kind string, part int, payload binary, counts binary, tokens long, known long",
                    MERGED, rows_per_batch=1)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x > 0 (Stirling's series after a shift by 8)."""
    shift = np.ones_like(x)
    for i in range(8):
        shift *= x + i
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(shift)


_LOG_PI = float(np.log(np.pi))


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov block probability."""
    return np.where(n0 + n1 > 0, log_gamma(n0 + 0.5) + log_gamma(n1 + 0.5) - log_gamma(n0 + n1 + 1.0) - _LOG_PI, 0.0)


class Level:
    """Nodes of one depth of one bit's trees."""

    def __init__(self, keys: np.ndarray, n0: np.ndarray, n1: np.ndarray, below: np.ndarray | None):
        self.keys, self.n0, self.n1 = keys, n0, n1
        self.kt = (n1 + 0.5) / (n0 + n1 + 1.0)
        pe = log_kt(n0, n1)
        if below is None:
            self.own, self.pw = None, pe
        else:
            self.own = 1 / (1 + np.exp(np.clip(below - pe, -700, 700)))  # posterior weight of the node's own estimate
            self.pw = np.logaddexp(pe, below) - np.log(2.0)


def climb(level: Level, depth: int) -> tuple[Level, np.ndarray]:
    """The parents (contexts of ``depth`` bytes) of ``level`` and each node's parent."""
    parent = ((level.keys >> _U(8)) & _U((1 << 8 * depth) - 1)) << _U(8) | (level.keys & _U(0xFF))
    keys, of = np.unique(parent, return_inverse=True)
    add = lambda v: np.bincount(of, weights=v, minlength=len(keys))
    return Level(keys, add(level.n0), add(level.n1), add(level.pw)), of


def bit_levels(grams: np.ndarray, counts: np.ndarray, bit: int, top: int = 2):
    """For one bit: its value per string, the node per string, and levels ``DEPTH`` .. ``top``
    with their parent links."""
    symbol = grams & _U(0xFF)
    value = ((symbol >> _U(7 - bit)) & _U(1)).astype(np.int64)
    node = (grams >> _U(8)) << _U(8) | (_U(1 << bit) | (symbol >> _U(8 - bit)))
    keys, of = np.unique(node, return_inverse=True)
    n1 = np.bincount(of, weights=counts * value, minlength=len(keys))
    n0 = np.bincount(of, weights=counts * (1 - value), minlength=len(keys))
    levels, links = [Level(keys, n0, n1, None)], []
    for depth in range(DEPTH - 1, top - 1, -1):
        up, link = climb(levels[-1], depth)
        levels.append(up)
        links.append(link)
    return value, of, levels, links


def top_sums(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums over the depth-two nodes of a part by depth-one node: ``(context byte << 8 | bit node)``
    and rows ``n0, n1, sum of log Pw``."""
    keys, sums = [], []
    for bit in range(8):
        level = bit_levels(grams, counts, bit)[2][-1]
        up = ((level.keys >> _U(8)) & _U(0xFF)) << _U(8) | (level.keys & _U(0xFF))
        k, of = np.unique(up, return_inverse=True)
        keys.append(k)
        sums.append(np.stack([np.bincount(of, weights=v, minlength=len(k)) for v in (level.n0, level.n1, level.pw)]))
    return np.concatenate(keys), np.concatenate(sums, axis=1)


def top_tables(keys: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dense ``(own weight, KT estimate, seen)`` tables for depth one (65,536) and nought (256)."""
    tables = np.full((3, 65536), 0.5), np.full((3, 256), 0.5)
    for table in tables:
        table[2] = 0
    if len(keys):
        one = Level(keys, sums[0], sums[1], sums[2])
        none, _ = climb(one, 0)
        for table, level in zip(tables, (one, none)):
            table[0, level.keys.astype(np.int64)] = level.own
            table[1, level.keys.astype(np.int64)] = level.kt
            table[2, level.keys.astype(np.int64)] = level.n0 + level.n1
    return tables


def log_probabilities(grams: np.ndarray, counts: np.ndarray, top: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """log10 probability of each string's symbol after its context, mixed over all depths."""
    out = np.zeros(len(grams))
    for bit in range(8):
        value, of, levels, links = bit_levels(grams, counts, bit)
        p = levels[0].kt
        seen = levels[0].n0 + levels[0].n1 > 0
        at = np.arange(len(p))
        for level, link in zip(levels[1:], links):
            at = link[at]
            own = np.where(seen, level.own[at], 1.0)  # an unseen child has no say
            p = own * level.kt[at] + (1 - own) * p
            seen = (level.n0 + level.n1 > 0)[at]
        keys = levels[0].keys
        node, last = (keys & _U(0xFF)).astype(np.int64), ((keys >> _U(8)) & _U(0xFF)).astype(np.int64)
        for table, index in ((top[0], last << 8 | node), (top[1], node)):
            own = np.where(seen, table[0, index], 1.0)
            p = own * table[1, index] + (1 - own) * p
            seen = table[2, index] > 0
        p = p[of]
        out += np.log10(np.where(value == 1, p, 1 - p))
    return out


TOP = pa.schema([("node", pa.int32()), ("n0", pa.float64()), ("n1", pa.float64()), ("pw", pa.float64())])


def train_top(merged: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(batch.column(0), batch.column(1)):
                k, s = top_sums(unsqueeze(keys.as_py()), unsqueeze(counts.as_py()))
                yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), *map(pa.array, s)], schema=TOP)

    sums = (merged.where("kind = 'gram'").select("payload", "counts")
            .mapInArrow(run, "node int, n0 double, n1 double, pw double")
            .groupBy("node").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("pw").alias("pw"))
            .orderBy("node").toArrow())  # at most 255 bit nodes after each of 256 bytes
    return top_tables(sums["node"].to_numpy().astype(_U), np.stack([sums[c].to_numpy() for c in ("n0", "n1", "pw")]))


ANSWER = pa.schema([("block", pa.int64()), ("kind", pa.string()), ("part", pa.int32()), ("payload", pa.binary())])


def answer(asked: DataFrame, merged: DataFrame, top: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Each part answers its blocks: log probabilities for strings, training counts for words."""

    def run(rows: Iterator[dict]) -> Iterator[tuple]:
        known = values = None
        for row in rows:
            if row["block"] < 0:  # the part's merged table comes first
                known, counts = unsqueeze(row["payload"]), unsqueeze(row["counts"])
                values = log_probabilities(known, counts, top).astype(np.float32) if row["kind"] == "gram" else counts
            else:
                at = np.searchsorted(known, unsqueeze(row["payload"]))
                yield row["block"], row["kind"], row["part"], squeeze(values[at])

    both = merged.select(F.lit(-1).cast("long").alias("block"), "kind", "part", "payload", "counts").unionByName(
        asked.where("part >= 0").select("block", "kind", "part", "payload", F.lit(None).cast("binary").alias("counts")))
    return streamed(both, ["kind", "part"], ["kind", "part", "block"], run,
                    "block long, kind string, part int, payload binary", ANSWER)


def score_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Scores per document row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Documents whose crc32(key as text) mod 7 is 2 are held out; the others are learned from.
    Null texts are empty (one end token, one end symbol); a null key counts as the text
    "None"; repeated rows are learned from and scored one by one; other columns are ignored;
    an empty table gives no rows.  Without training documents all counts are nought and
    every binary decision has probability one half.
    """
    n_parts = parts_for(docs)
    asked = stored(ask(docs, key, text, n_parts), "ctw-asked")
    merged = stored(merge(asked), "ctw-merged")
    top = train_top(merged)
    total = merged.where("kind = 'word'").agg(F.sum("tokens").alias("n"), F.sum("known").alias("v")).first()
    n_train, vocabulary = int(total.n or 0), int(total.v or 0)
    answers = answer(asked, merged, top)
    both = asked.where("part < 0").select("block", "kind", "part", "payload").unionByName(answers)
    schema = pa.schema([pa.field(key, _arrow_type(docs, key)), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                        ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()),
                        ("score", pa.float64())])

    def scored(block: pa.Table, answers: dict[str, list[np.ndarray]]) -> Iterator[tuple]:
        asked = Asked(block, text, n_parts)
        n = asked.buf.n
        score = np.bincount(asked.gram_doc, weights=asked.values("gram", answers["gram"]), minlength=n)
        counts = asked.values("word", answers["word"])
        base = np.bincount(asked.word_doc, weights=np.log10((counts + 1) / (n_train + vocabulary + 1)), minlength=n)
        n_tokens = np.bincount(asked.word_doc, minlength=n)
        n_known = np.bincount(asked.word_doc, weights=counts > 0, minlength=n).astype(np.int64)
        keys = block.column(key).to_pylist()
        yield from zip(keys, map(held_out, keys), n_tokens.tolist(), n_known.tolist(), [n_train] * n,
                       base.tolist(), score.tolist())

    def run(rows: Iterator[dict]) -> Iterator[tuple]:
        block, answers = None, {}
        for row in rows:
            if row["part"] < 0:  # a block's texts come first
                if block is not None:
                    yield from scored(block, answers)
                block, answers = unpack_rows(row["payload"]), {"gram": [], "word": []}
            else:
                answers[row["kind"]].append(unsqueeze(row["payload"]))
        if block is not None:
            yield from scored(block, answers)

    kind = dict(docs.dtypes)[key]
    return streamed(both, ["block"], ["block", "part", "kind"], run,
                    f"`{key}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                    "base_score double, score double", schema, rows_per_batch=5000)
