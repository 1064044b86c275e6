"""Quality by a linear-chain conditional random field over a document's lines.

Every line with a word is labelled good or bad.  A line's evidence is a set of steps over
measures of its characters, words and repetitions, taken from itself, the line before and the
line after it; neighbouring labels are tied by four transition weights.  The field is trained by
maximum likelihood (L-BFGS on the exact gradient from forward-backward) on lines that carry
their document's label.  A document's quality is the mean of its lines' marginal probability
of good, weighted by their length.

Training takes a bounded sample: at most ``max_docs`` labelled documents and, of their lines,
at most ``max_chunks`` chunks of ``CHUNK`` consecutive lines, both the least by a hash of the key.
Chunks keep a document of any length from filling the sample while no prefix is preferred.
Everything else is a single pass over whole texts, one Arrow batch at a time; chains of all
lengths run at once as segmented prefix products of 2 x 2 matrices, log2(longest chain) steps.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality import LINE, SYMBOL
from .textbuf import LOWER, NOT_SPACE, TextBuf, doc_of, give_back, mix64, slices
from .wordtok import word_hashes

CHUNK = 32
#: Measures of a line, all from 0 to 1: see ``measure``.
MEASURES = ("capitals", "symbols", "exclamations", "digits", "marks", "non_ascii", "word_length", "same_as_last_word",
            "distinct_words", "repeated_windows", "repeated_line", "words", "capital_words", "marked_words")
#: Steps: a measure counts as one indicator for each of these that it passes.
STEPS = np.array([0.0, 0.03, 0.08, 0.15, 0.25, 0.4, 0.6, 0.8, 0.95], dtype=np.float32)
WIDTH = len(MEASURES) * len(STEPS)
_BLOCK = 1 << 16
_SALT = np.uint64(0xD6E8FEB86659FD93)

UPPER = np.zeros(256, dtype=bool)
UPPER[65:91] = True
DIGIT = np.zeros(256, dtype=bool)
DIGIT[48:58] = True
LETTER = np.zeros(256, dtype=bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True
MARK = np.zeros(256, dtype=bool)
MARK[list(b".,;:?!'\"()-")] = True
FIRST = np.zeros(256, dtype=bool)  # first bytes of characters
FIRST[:128] = FIRST[192:] = True


@dataclass
class Lines:
    """Lines of a slice's texts: byte range, text number and word characters of each, the first
    line of each text (``n + 1`` entries), and the measures (lines x measures).  A text without a
    word has one empty line."""
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    chars: np.ndarray
    firsts: np.ndarray
    measures: np.ndarray


def _sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return total[ends] - total[starts]


def _repeats(keys: np.ndarray) -> np.ndarray:
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return counts[inverse] > 1


def measure(buf: TextBuf) -> Lines:
    """Lines and their measures."""
    starts, ends, _ = buf.words(LINE)
    starts, ends = (x[_sums(NOT_SPACE[buf.data], starts, ends) > 0] for x in (starts, ends))
    doc = np.searchsorted(buf.offs, starts, side="right") - 1
    bare = np.setdiff1d(np.arange(buf.n), doc)
    at = np.searchsorted(doc, bare)
    starts, ends, doc = (np.insert(x, at, y) for x, y in ((starts, buf.offs[bare]), (ends, buf.offs[bare]), (doc, bare)))
    firsts = np.searchsorted(doc, np.arange(buf.n + 1))

    # Words, by line: a word never crosses a line.
    word_at, word_to, word_first = buf.words()
    word_doc = doc_of(word_first)
    lo, hi = np.searchsorted(word_at, starts), np.searchsorted(word_at, ends)
    n = np.maximum(hi - lo, 1)
    hashes = word_hashes(buf, word_at, word_to)
    line_of = np.repeat(np.arange(len(starts)), hi - lo)
    same_as_last = np.zeros(len(hashes), dtype=bool)
    same_as_last[1:] = (hashes[1:] == hashes[:-1]) & (line_of[1:] == line_of[:-1])
    _, first = np.unique(hashes ^ mix64(line_of.astype(np.uint64) + _SALT), return_index=True)
    distinct = np.bincount(line_of[first], minlength=len(starts))
    repeated = np.zeros(len(hashes), dtype=bool)
    if len(hashes) >= 3:
        w = np.flatnonzero(word_doc[2:] == word_doc[:-2])
        key = mix64(hashes[w] + _SALT) * np.uint64(3) + mix64(hashes[w + 1] ^ _SALT) * np.uint64(5) + hashes[w + 2]
        twice = w[_repeats(mix64(key) ^ mix64(word_doc[w].astype(np.uint64) + _SALT))]
        for k in range(3):
            repeated[twice + k] = True
    again = _repeats(word_hashes(buf, starts, ends) ^ mix64(doc.astype(np.uint64) + _SALT)) & (ends > starts)

    data = buf.data
    count = lambda table: _sums(table[data], starts, ends)
    in_words = lambda flags: _sums(flags, lo, hi) / n
    size = np.maximum(count(NOT_SPACE), 1)
    letters = np.maximum(count(LETTER), 1)
    exclaimed = np.zeros(256, dtype=bool)
    exclaimed[ord("!")] = True
    last = data[word_to - 1] if len(word_to) else np.zeros(0, np.uint8)
    head = data[word_at] if len(word_at) else np.zeros(0, np.uint8)
    columns = [
        count(UPPER) / letters, np.minimum(count(SYMBOL) / n, 4) / 4, np.minimum(count(exclaimed) / n, 2) / 2, count(DIGIT) / size,
        np.minimum(count(MARK) / n, 1), (size - np.minimum(count(LOWER < 128), size)) / size, np.minimum(size / n, 20) / 20,
        in_words(same_as_last), distinct / n, in_words(repeated), again.astype(float), np.minimum(np.log2(hi - lo + 1), 10) / 10,
        in_words(UPPER[head]), in_words(MARK[last] | SYMBOL[last])]
    chars = _sums(FIRST[data] & NOT_SPACE[data], starts, ends)
    return Lines(starts, ends, doc, chars, firsts, np.stack(columns, 1).astype(np.float32))


def indicators(measures: np.ndarray) -> np.ndarray:
    """Steps passed, 0 or 1 (lines x ``WIDTH``)."""
    return (measures[:, :, None] > STEPS).reshape(len(measures), -1).astype(np.float32)


@dataclass
class Field:
    """``weights``: bias, then indicators of the line itself, the line before and the line
    after it, as evidence for good; ``edges``: log weights of (label before, label)."""
    weights: np.ndarray
    edges: np.ndarray

    @staticmethod
    def blank() -> Field:
        return Field(np.zeros(1 + 3 * WIDTH), np.zeros((2, 2)))


def evidence(field: Field, measures: np.ndarray, starts_chain: np.ndarray) -> np.ndarray:
    """Evidence for good of every line; ``starts_chain`` marks first lines."""
    w = field.weights[1:].reshape(3, WIDTH).T.astype(np.float32)
    parts = np.concatenate([indicators(measures[i:i + _BLOCK]) @ w for i in range(0, len(measures), _BLOCK)] or [np.zeros((0, 3))])
    out = field.weights[0] + parts[:, 0].astype(float)
    inner = ~starts_chain[1:]
    out[1:][inner] += parts[:-1, 1][inner]
    out[:-1][inner] += parts[1:, 2][inner]
    return out


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """2 x 2 products (last axis: 00, 01, 10, 11), scaled to a largest entry of 1."""
    out = np.stack([a[:, 0] * b[:, 0] + a[:, 1] * b[:, 2], a[:, 0] * b[:, 1] + a[:, 1] * b[:, 3],
                    a[:, 2] * b[:, 0] + a[:, 3] * b[:, 2], a[:, 2] * b[:, 1] + a[:, 3] * b[:, 3]], 1)
    return out / out.max(1, keepdims=True)


def marginals(field: Field, scores: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Probability of good for every line, by forward-backward over all chains at once."""
    n = len(scores)
    if n == 0:
        return np.zeros(0)
    sizes = np.diff(firsts)
    pos = np.arange(n) - np.repeat(firsts[:-1], sizes)
    rest = np.repeat(sizes, sizes) - 1 - pos
    s = np.clip(scores, -60, 60)
    node = np.exp(np.stack([np.minimum(-s, 0), np.minimum(s, 0)], 1))  # larger one scaled to 1
    step = np.exp(field.edges - field.edges.max()).reshape(1, 4) * np.tile(node, 2)
    fore = np.where((pos == 0)[:, None], np.tile(node, 2), step)
    back = np.tile(np.array([1.0, 0, 0, 1]), (n, 1))
    more = np.flatnonzero(rest > 0)
    back[more] = step[more + 1]
    d = 1
    while d < sizes.max():
        at = np.flatnonzero(pos >= d)
        fore[at] = _product(fore[at - d], fore[at])
        at = np.flatnonzero(rest >= d)
        back[at] = _product(back[at], back[at + d])
        d *= 2
    bad, good = fore[:, 0] * (back[:, 0] + back[:, 1]), fore[:, 1] * (back[:, 2] + back[:, 3])
    return good / (bad + good)


def _objective(theta: np.ndarray, x: np.ndarray, y: np.ndarray, firsts: np.ndarray, l2: float) -> tuple[float, np.ndarray]:
    """Negative log likelihood of the labels with its gradient.  ``x``: indicators; chains run
    side by side, one line of each at a time (chunks have at most ``CHUNK``)."""
    w, edges = theta[1:-4].reshape(3, WIDTH), theta[-4:].reshape(2, 2)
    sizes = np.diff(firsts)
    pos = np.arange(len(y)) - np.repeat(firsts[:-1], sizes)
    inner = pos > 0
    parts = x @ w.T.astype(np.float32)
    s = theta[0] + parts[:, 0].astype(float)
    s[1:][inner[1:]] += parts[:-1, 1][inner[1:]]
    s[:-1][inner[1:]] += parts[1:, 2][inner[1:]]
    longest = int(sizes.max())
    rows = [np.flatnonzero(sizes > k) for k in range(longest)]
    alpha, beta = np.zeros((len(y), 2)), np.zeros((len(y), 2))
    for k in range(longest):
        i = firsts[:-1][rows[k]] + k
        into = np.logaddexp(alpha[i - 1][:, :1] + edges[0], alpha[i - 1][:, 1:] + edges[1]) if k else np.zeros((len(i), 2))
        alpha[i] = into + np.stack([np.zeros(len(i)), s[i]], 1)
    for k in range(longest - 2, -1, -1):
        i = firsts[:-1][rows[k + 1]] + k
        ahead = beta[i + 1] + np.stack([np.zeros(len(i)), s[i + 1]], 1)
        beta[i] = np.stack([np.logaddexp(edges[a, 0] + ahead[:, 0], edges[a, 1] + ahead[:, 1]) for a in (0, 1)], 1)
    ends = firsts[1:] - 1
    log_z = np.logaddexp(alpha[ends, 0], alpha[ends, 1])
    whole = np.repeat(log_z, sizes)
    at = np.flatnonzero(inner)
    pair = np.exp(alpha[at - 1][:, :, None] + edges + (np.stack([np.zeros(len(at)), s[at]], 1) + beta[at])[:, None, :] - whole[at][:, None, None])
    seen = np.bincount(y[at - 1] * 2 + y[at], minlength=4).reshape(2, 2)
    loss = log_z.sum() - (s * y).sum() - (seen * edges).sum() + l2 / 2 * (theta[1:] ** 2).sum()
    err = np.exp(alpha[:, 1] + beta[:, 1] - whole) - y
    after = np.zeros_like(err)
    after[:-1][inner[1:]] = err[1:][inner[1:]]
    before = np.zeros_like(err)
    before[1:][inner[1:]] = err[:-1][inner[1:]]
    by = np.stack([err, after, before]).astype(np.float32) @ x
    grad = np.concatenate([[err.sum()], by.astype(float).reshape(-1), (pair.sum(0) - seen).reshape(-1)])
    grad[1:] += l2 * theta[1:]
    return loss, grad


def _minimise(f: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, steps: int, memory: int = 10) -> np.ndarray:
    """L-BFGS with halving of the step until the loss falls enough."""
    value, grad = f(x)
    moves: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        q, kept = grad.copy(), []
        for dx, dg, inv in reversed(moves):
            a = inv * dx.dot(q)
            q -= a * dg
            kept.append(a)
        q *= moves[-1][0].dot(moves[-1][1]) / moves[-1][1].dot(moves[-1][1]) if moves else 1 / max(np.abs(grad).max(), 1)
        for (dx, dg, inv), a in zip(moves, reversed(kept)):
            q += (a - inv * dg.dot(q)) * dx
        slope, size = -grad.dot(q), 1.0
        while True:
            there, new = f(x - size * q)
            if there <= value + 1e-4 * size * slope or size < 1e-8:
                break
            size /= 2
        dx, dg = -size * q, new - grad
        done = value - there < 1e-6 * abs(value)
        x, value, grad = x + dx, there, new
        if done:
            break
        if dx.dot(dg) > 1e-12:
            moves = [*moves, (dx, dg, 1 / dx.dot(dg))][-memory:]
    return x


def held_out(key: str, modulus: int = 5) -> Column:
    """Whether ``modulus`` divides the key's CRC-32; false for a null key."""
    return F.coalesce(F.crc32(F.col(f"`{key}`").cast("string")) % modulus == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
        max_docs: int = 6_000, max_chunks: int = 6_000, l2: float = 1.0, steps: int = 120) -> Field:
    """Field trained on the labelled texts (label 1: good lines, else bad).

    Rows of ``labels`` without key or label are left out; of repeated keys the smallest label
    counts.  Without both kinds of labelled lines the field is blank: every line 0.5.
    """
    given = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("k")).agg(
        (F.min(label) == 1).alias("good"))
    sample = given.orderBy(F.xxhash64("k"), "k").limit(max_docs)  # bounded, so it can be sent to every task
    chosen = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t")).join(F.broadcast(sample), "k")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "t"):
                lines = measure(TextBuf(part.column("t")))
                rows = []
                for d, good in enumerate(part.column("good").to_pylist()):
                    for at in range(int(lines.firsts[d]), int(lines.firsts[d + 1]), CHUNK):
                        m = lines.measures[at:min(at + CHUNK, int(lines.firsts[d + 1]))]
                        rows.append((d, at - int(lines.firsts[d]), good, m.tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("k").take(pa.array([r[0] for r in rows], pa.int64()))]
                    + [pa.array([r[k] for r in rows], t) for k, t in ((1, pa.int64()), (2, pa.bool_()), (3, pa.binary()))],
                    names=["k", "at", "good", "lines"])
        give_back()

    chunks = chosen.select("k", "t", "good").mapInArrow(run, f"k {dict(chosen.dtypes)['k']}, at long, good boolean, lines binary")
    rows = chunks.orderBy(F.xxhash64("k", "at"), "k", "at", "lines").limit(max_chunks).collect()
    if len({r.good for r in rows}) < 2:
        return Field.blank()
    measures = [np.frombuffer(bytes(r.lines), np.float32).reshape(-1, len(MEASURES)) for r in rows]
    sizes = np.array([len(m) for m in measures])
    firsts = np.concatenate([[0], np.cumsum(sizes)])
    x, y = indicators(np.concatenate(measures)), np.repeat([int(r.good) for r in rows], sizes)
    theta = _minimise(lambda v: _objective(v, x, y, firsts, l2), np.zeros(1 + 3 * WIDTH + 4), steps)
    return Field(theta[:-4], theta[-4:].reshape(2, 2))


def _judged(buf: TextBuf, field: Field) -> tuple[Lines, np.ndarray]:
    lines = measure(buf)
    head = np.zeros(len(lines.doc), dtype=bool)
    head[lines.firsts[:-1]] = True
    return lines, marginals(field, evidence(field, lines.measures, head), lines.firsts)


def score_documents(docs: DataFrame, field: Field, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_lines, n_bad, score`` per row: lines with a word, those more likely bad than good,
    and the length-weighted mean probability of good.

    A null or empty text, or one of spaces, counts as one empty line, which gives its score (and
    0 lines); repeated and null keys are scored row by row; whole texts of any length are read;
    no other column is; an empty table gives no rows.
    """
    names = [key, "n_lines", "n_bad", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                buf = TextBuf(part.column(part.schema.get_field_index(text)))
                lines, good = _judged(buf, field)
                worded = lines.chars > 0
                weight = np.maximum(lines.chars, 1).astype(float)
                score = np.bincount(lines.doc, weights=weight * good, minlength=buf.n) / np.bincount(lines.doc, weights=weight, minlength=buf.n)
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index(key)), pa.array(np.bincount(lines.doc[worded], minlength=buf.n), pa.int64()),
                     pa.array(np.bincount(lines.doc[worded & (good < 0.5)], minlength=buf.n), pa.int64()),
                     pa.array(np.clip(score, 0, 1), pa.float64())], names=names)
        give_back()

    kind = dict(docs.dtypes)[key]
    return docs.select(F.col(f"`{key}`"), F.col(f"`{text}`")).mapInArrow(run, f"`{key}` {kind}, n_lines long, n_bad long, score double")


def label_lines(docs: DataFrame, field: Field, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, line_no, start, end, good`` per line with a word: its number among those, UTF-8 byte
    range in the text and probability of good.  Other cases as in ``score_documents``."""
    names = [key, "line_no", "start", "end", "good"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                buf = TextBuf(part.column(part.schema.get_field_index(text)))
                lines, good = _judged(buf, field)
                at = np.flatnonzero(lines.chars > 0)
                doc, base = lines.doc[at], buf.offs[lines.doc[at]]
                values = [at - lines.firsts[doc], lines.starts[at] - base, lines.ends[at] - base]
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index(key)).take(pa.array(doc)), *[pa.array(v, pa.int64()) for v in values],
                     pa.array(good[at], pa.float64())], names=names)
        give_back()

    kind = dict(docs.dtypes)[key]
    return docs.select(F.col(f"`{key}`"), F.col(f"`{text}`")).mapInArrow(run, f"`{key}` {kind}, line_no long, start long, end long, good double")
