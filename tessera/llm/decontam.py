"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds every substring of the normalised benchmark items (words as symbols).
Training words stream through it; after each word it knows the length of the longest
benchmark substring that ends there, and its state knows the items that contain it.  A
match of at least ``window`` words contains windows of ``window`` consecutive item words,
and all its words are hit; an item shorter than that is one window of its own length.

The benchmark is the stated query set.  It is read in blocks of at most ``block_words``
words (items are not cut), one automaton per block, so that what is broadcast has a fixed
bound however large the benchmark is; every block sees all documents.
"""
from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored, with_extra
from .textbuf import ALNUM, RangeHasher, TextBuf, doc_of, lean, mix64, slices

WINDOW = 13
BLOCK_WORDS = 200_000
_HASH = RangeHasher(11, lower=True)


def hashed_words(buf: TextBuf) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of letters and digits (A-Z lower-cased, every non-ASCII character counts):
    64-bit hashes, starts, ends and each text's first word number."""
    starts, ends, firsts = buf.words(ALNUM)
    return _HASH.ranges(_HASH.prefix(buf.data), starts, ends), starts, ends, firsts


class SuffixAutomaton:
    """Generalised suffix automaton over item word sequences (symbols are word hashes)."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.len = [0]
        self.ids: list[Any] = []
        self.words: list[list[int]] = []

    def add(self, item_id: Any, words: list[int]) -> None:
        if not words:
            return
        self.ids.append(item_id)
        self.words.append(words)
        last = 0
        for c in words:
            last = self._extend(last, c)

    def _clone(self, p: int, q: int, c: int) -> int:
        clone = len(self.len)
        self.len.append(self.len[p] + 1)
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, c: int) -> int:
        p, q = last, self.next[last].get(c)
        if q is not None:  # the substring exists already, from an earlier item
            return q if self.len[q] == self.len[p] + 1 else self._clone(p, q, c)
        new = len(self.len)
        self.len.append(self.len[last] + 1)
        self.next.append({})
        self.link.append(0)
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.len[q] == self.len[p] + 1 else self._clone(p, q, c)
        return new

    def finish(self) -> "SuffixAutomaton":
        """Attach items to states, and prepare the vectorised skip of unmatched words."""
        n = len(self.len)
        #: per state: items of which it is a substring, where the state can stand for a window
        self.items: list[set[int]] = [set() for _ in range(n)]
        #: per state: (length, item) of the whole short items among its substrings' suffixes
        self.short: list[tuple] = [()] * n
        for k, words in enumerate(self.words):
            state = 0
            for c in words:
                state = self.next[state][c]
                s = state
                while s > 0 and self.len[s] >= self.window and k not in self.items[s]:
                    self.items[s].add(k)
                    s = self.link[s]
            if len(words) < self.window:
                self.short[state] = (*self.short[state], (len(words), k))
        for s in sorted(range(1, n), key=self.len.__getitem__):
            self.short[s] = (*self.short[s], *self.short[self.link[s]])
        short = min((len(w) for w in self.words), default=self.window)
        self.least = min(short, self.window)
        self.known = np.unique(np.array([c for w in self.words for c in w], dtype=np.uint64))
        self.pairs = np.unique(pair_keys(*(np.array([c for w in self.words for c in w[i:len(w) - 1 + i]],
                                                    dtype=np.uint64) for i in (0, 1))))
        return self

    def candidates(self, hashes: np.ndarray, firsts: np.ndarray) -> list[tuple[int, int]]:
        """Word ranges that can hold a window: maximal runs, within one text, in which each
        word and each pair of neighbours occurs in the benchmark.  Outside of them the
        longest match is shorter than two words, so streaming may restart at the root."""
        known = _in_sorted(hashes, self.known)
        doc = doc_of(firsts)
        linked = np.zeros(len(hashes), dtype=bool)
        if len(hashes) > 1:
            at = np.flatnonzero(known[1:] & known[:-1] & (doc[1:] == doc[:-1]))
            linked[at + 1] = _in_sorted(pair_keys(hashes[at], hashes[at + 1]), self.pairs)
        begins = np.flatnonzero(known & ~linked)
        ends = np.flatnonzero(known & ~np.append(linked[1:], False)) + 1
        long = ends - begins >= self.least
        return list(zip(begins[long].tolist(), ends[long].tolist()))

    def stream(self, words: Iterable[int]) -> Iterator[tuple[int, int, int]]:
        """``(position, matched length, state)`` after each word."""
        state = size = 0
        for i, c in enumerate(words):
            while state and c not in self.next[state]:
                state = self.link[state]
                size = self.len[state]
            to = self.next[state].get(c)
            if to is None:
                state = size = 0
            else:
                state, size = to, size + 1
            yield i, size, state

    def hits(self, words: list[int]) -> tuple[list[tuple[int, int]], set[int]]:
        """Hit ranges (merged, end exclusive) and the items with an occurring window."""
        spans: list[list[int]] = []
        found: set[int] = set()

        def mark(a: int, b: int) -> None:
            while spans and spans[-1][0] >= a:
                spans.pop()
            if spans and spans[-1][1] >= a:
                spans[-1][1] = b
            else:
                spans.append([a, b])

        for i, size, state in self.stream(words):
            if size >= self.window:
                s = state
                while self.len[self.link[s]] >= self.window:  # the state of the last ``window`` words
                    s = self.link[s]
                found |= self.items[s]
                mark(i + 1 - size, i + 1)
            for n, k in self.short[state]:
                if n <= size:
                    found.add(k)
                    if size < self.window:
                        mark(i + 1 - n, i + 1)
        return [(a, b) for a, b in spans], found


def pair_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix64(a * np.uint64(3) + mix64(b))


def _in_sorted(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values


def benchmark_blocks(items: DataFrame, item: str, text: str, block_words: int) -> Iterator[list]:
    """Blocks of ``(item_id as string, word hashes)`` with at most ``block_words`` words each
    (one item at least), read one partition at a time."""
    block, held = [], 0
    for row in items.select(F.col(item).cast("string").alias("i"), F.col(text).alias("t")).toLocalIterator():
        words = hashed_words(TextBuf(pa.array([row.t or ""])))[0].tolist()
        if block and held + len(words) > block_words:
            yield block
            block, held = [], 0
        block.append((row.i, words))
        held += len(words)
    if block:
        yield block


def _automaton(block: list, window: int) -> SuffixAutomaton:
    a = SuffixAutomaton(window)
    for i, words in block:
        a.add(i, words)
    return a.finish()


def match_benchmark(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                    item: str = "item_id", item_text: str = "text", window: int = WINDOW,
                    block_words: int = BLOCK_WORDS, keep_columns: tuple[str, ...] = ()) -> DataFrame:
    """Per document row: ``doc_id, n_words, spans`` (hit ranges: word numbers and code points,
    end exclusive), ``n_hit`` and ``items`` (sorted ids, as strings, of items with an
    occurring window).

    Null texts have no words; items without words match nothing; equal items all count;
    null and repeated keys are matched row by row; other columns are ignored unless named
    in ``keep_columns``.  Empty tables: no rows, or documents without hits.

    With more than one benchmark block, hits are merged per row afterwards through a row
    number that is written first.
    """
    blocks = benchmark_blocks(items, item, item_text, block_words)
    first = next(blocks, [])
    second = next(blocks, None)
    if second is None:
        return _match(docs, _automaton(first, window), key, text, keep_columns)
    rows = stored(docs.select(F.monotonically_increasing_id().alias("_row"), key, text,
                              *[c for c in keep_columns if c not in (key, text)]), "decontam")

    def all_blocks():
        yield first
        yield second
        yield from blocks

    parts = [stored(_match(rows, _automaton(b, window), "_row", text, ()), "decontam-block") for b in all_blocks()]
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.unionByName(p)
    merged = merged.groupBy("_row").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    merged = merged.withColumn("spans", _merge_spans(F.col("spans"))).withColumn(
        "n_hit", F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["word_end"] - s["word_start"]))
    carried = [c for c in keep_columns if c != key]
    return rows.select("_row", key, *carried).join(merged, "_row").select(
        key, *carried, "n_words", "spans", "n_hit", "items")


def _merge_spans(spans):
    """Union of ranges that may overlap, from a sorted array."""
    empty = F.array().cast("array<struct<word_start:long,word_end:long,start:long,end:long>>")
    joined = lambda a, s: F.concat(F.slice(a, F.lit(1), F.size(a) - 1), F.array(F.struct(
        F.element_at(a, -1)["word_start"].alias("word_start"),
        F.greatest(F.element_at(a, -1)["word_end"], s["word_end"]).alias("word_end"),
        F.element_at(a, -1)["start"].alias("start"),
        F.greatest(F.element_at(a, -1)["end"], s["end"]).alias("end"))))
    return F.aggregate(F.array_sort(spans), empty, lambda a, s: F.when(
        (F.size(a) > 0) & (F.try_element_at(a, F.lit(-1))["word_end"] >= s["word_start"]), joined(a, s))
        .otherwise(F.concat(a, F.array(s))))


SPAN = pa.struct([("word_start", pa.int64()), ("word_end", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])


def _match(docs: DataFrame, automaton: SuffixAutomaton, key: str, text: str, keep_columns: tuple[str, ...]) -> DataFrame:
    carried = [key, *[c for c in keep_columns if c != key]]
    cols = list(dict.fromkeys([*carried, text]))
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(automaton))  # at most block_words words
    names_out = [*carried, "n_words", "spans", "n_hit", "items"]
    types = dict(docs.dtypes)
    ddl = ", ".join([f"`{c}` {types[c]}" for c in carried]
                    + ["n_words long", "spans array<struct<word_start:long,word_end:long,start:long,end:long>>",
                       "n_hit long", "items array<string>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = pickle.loads(shared.value)
        for batch in batches:
            for part in slices(batch, text):
                buf = TextBuf(part.column(part.schema.get_field_index(text)))
                hashes, starts, ends, firsts = hashed_words(buf)
                spans = [[] for _ in range(buf.n)]
                items = [set() for _ in range(buf.n)]
                hit = np.zeros(buf.n, dtype=np.int64)
                ranges = auto.candidates(hashes, firsts)
                if ranges:
                    owner = np.searchsorted(firsts, [a for a, _ in ranges], side="right") - 1
                    points = np.concatenate([[0], np.cumsum((buf.data & 0xC0) != 0x80)])
                    for (a, b), d in zip(ranges, owner.tolist()):
                        got, found = auto.hits(hashes[a:b].tolist())
                        items[d] |= found
                        for x, y in got:
                            hit[d] += y - x
                            zero = points[buf.offs[d]]
                            spans[d].append({"word_start": a + x - firsts[d], "word_end": a + y - firsts[d],
                                             "start": points[starts[a + x]] - zero, "end": points[ends[a + y - 1]] - zero})
                names = [sorted({auto.ids[k] for k in s if auto.ids[k] is not None}) for s in items]
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index(c)) for c in carried]
                    + [pa.array(np.diff(firsts), pa.int64()), pa.array(spans, pa.list_(SPAN)),
                       pa.array(hit, pa.int64()), pa.array(names, pa.list_(pa.string()))], names=names_out)

    return docs.select(*cols).mapInArrow(lean(run), ddl)


def decontaminate(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                  min_share: int = 20, **kw) -> DataFrame:
    """Documents (all columns) without the contaminated ones: those with a hit and at least
    one word in ``min_share`` hit.  The others are left as they are, with their hit spans
    (``remove_spans`` cuts them)."""
    packed, keep, restore = with_extra(docs, (key, text))
    found = match_benchmark(packed, items, key, text, keep_columns=keep, **kw)
    return restore(found.where(~contaminated(min_share)))


def contaminated(min_share: int = 20):
    return (F.col("n_hit") > 0) & (min_share * F.col("n_hit") >= F.col("n_words"))


def remove_spans(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                 min_words: int = WINDOW, **kw) -> DataFrame:
    """Documents with every hit span of at least ``min_words`` words cut out of ``text``."""
    packed, keep, restore = with_extra(docs, (key, text))
    found = match_benchmark(packed, items, key, text, keep_columns=keep, **kw)
    cut = F.aggregate(
        F.filter("spans", lambda s: s["word_end"] - s["word_start"] >= min_words),
        F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda a, s: F.struct(F.concat(a["out"], F.substr(F.col(text), (a["at"] + 1).cast("int"),
                                                          (s["start"] - a["at"]).cast("int"))).alias("out"),
                              s["end"].alias("at")),
        lambda a: F.concat(a["out"], F.substr(F.col(text), (a["at"] + 1).cast("int"))))
    return restore(found.withColumn(text, F.when(F.size("spans") > 0, cut).otherwise(F.col(text))))

