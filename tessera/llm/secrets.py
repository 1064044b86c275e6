"""Secret scan: fixed patterns, and character Markov models for what they miss.

Pass 1 reads every text once.  It finds the base spans (``assign``, ``access``, ``hex``) and
the candidate tokens: long unbroken runs of key characters, whatever other characters they
touch.  From labelled samples it counts character transitions: strings inside base spans are
random, the other tokens of the same alphabet are ordinary identifiers, but for pieces of
words with non-ASCII letters.  Counts are tables of fixed size, summed over
the whole corpus.  A second random model learns from ``SAMPLES`` generated keys, since the
kinds of key that a corpus labels (say, hex) need not be the kinds it hides.

Pass 2 scores the stored candidates (not the texts again): the log-likelihood ratio of the
better random model to the ordinary one, per character.  A candidate above the threshold
becomes a ``random`` span.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored, with_extra
from .textbuf import TextBuf, lean, slices

#: Fixed values of the contract.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

#: Candidates: 20 or more key characters; ordinary identifiers: 4 or more.
MIN_CANDIDATE, MIN_ORDINARY = 20, 4
ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
STATES = len(ALPHABET) + 1  # the last is the start of a token
CLASS = np.full(256, 255, dtype=np.uint8)
CLASS[list(ALPHABET)] = np.arange(len(ALPHABET))
#: First bytes of non-ASCII letters of alphabets: two bytes but C2 (punctuation, symbols), and E0, E1.
#: From E2 on there are punctuation, Han, kana, Hangul, full-width forms and emoji, beside which
#: a token needs no space.
LETTER_LEAD = np.zeros(256, dtype=bool)
LETTER_LEAD[0xC3:0xE2] = True
MIN_MEAN_RATIO = 0.35
MIN_CLASSES = 2
MARKS = 62  # the first class of a mark
NAME_PART = re.compile(rb"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[A-Z]|[0-9]+")
SAMPLES = 4096
MARK = "[SECRET]"
SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
SPAN_DDL = "array<struct<kind:string,start:long,end:long>>"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` in code points, by start, then kind.

    Per kind the leftmost non-overlapping matches, without those that are too short.  For
    runs of one character class (access, hex) that equals matching the long ones only.
    """
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def token_runs(buf: TextBuf) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of key characters: starts, ends, texts, and whether a run is whole, that is
    touches no non-ASCII letter of a script that writes words apart (as ``Gr`` in ``Größe``)."""
    starts, ends, firsts = buf.words(CLASS < 255)
    doc = np.repeat(np.arange(buf.n), np.diff(firsts))
    whole = np.ones(len(starts), dtype=bool)
    at = np.flatnonzero(ends < buf.offs[doc + 1])
    whole[at] &= ~LETTER_LEAD[buf.data[ends[at]]]
    at = np.flatnonzero(starts > buf.offs[doc])
    lead = starts[at] - 1
    for _ in range(3):  # back to the first byte of the character before
        lead -= (buf.data[lead] & 0xC0) == 0x80
    whole[at] &= ~LETTER_LEAD[buf.data[lead]]
    return starts, ends, doc, whole


def transitions(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``STATES x STATES`` counts of neighbouring characters (and of first characters)."""
    counts = np.zeros(STATES * STATES, dtype=np.int64)
    if len(starts):
        lens = ends - starts
        at = np.repeat(starts - np.cumsum(lens) + lens, lens) + np.arange(int(lens.sum()))
        now = CLASS[data[at]].astype(np.int64)
        before = np.empty_like(now)
        before[1:] = now[:-1]
        before[np.cumsum(lens) - lens] = STATES - 1
        counts += np.bincount(before * STATES + now, minlength=STATES * STATES)
    return counts


def log_model(counts: np.ndarray, prior: float = 20.0) -> np.ndarray:
    """Log probabilities of the transitions; rows with few counts lean on how often each
    character occurs at all (``prior`` is that share's weight in counts)."""
    c = counts.reshape(STATES, STATES)[:, :-1].astype(float)
    single = c.sum(axis=0) + 0.5
    c = c + prior * single / single.sum()
    return np.log(c / c.sum(axis=1, keepdims=True))


def generated_model() -> np.ndarray:
    """Model of ``SAMPLES`` labelled keys of letters of both cases and digits (fixed seed)."""
    chars = np.frombuffer(ALPHABET[:62], dtype=np.uint8)
    data = chars[np.random.default_rng(62).integers(0, 62, (SAMPLES, 32))].reshape(-1)
    starts = np.arange(0, len(data), 32)
    return log_model(transitions(data, starts, starts + 32))


def mean_ratio(token: bytes, random_models: tuple[np.ndarray, ...], ordinary_model: np.ndarray) -> float:
    """Log-likelihood ratio random : ordinary per character, for the better random model."""
    now = CLASS[np.frombuffer(token, dtype=np.uint8)]
    before = np.concatenate([[STATES - 1], now[:-1]])
    ordinary = ordinary_model[before, now].mean()
    return float(max(m[before, now].mean() for m in random_models) - ordinary)


def name_ratio(token: bytes, random_models: tuple[np.ndarray, ...], ordinary_model: np.ndarray) -> float:
    """As ``mean_ratio`` over letters and digits, against the token read as a name: every part of it
    (``camelCase``, ``ALL_CAPS``, digits) starts anew, in its own letters or in small ones, whichever
    is likelier.  Change of case and marks alone then do not look random."""
    now = CLASS[np.frombuffer(token, dtype=np.uint8)]
    before = np.concatenate([[STATES - 1], now[:-1]])
    counted = now < MARKS
    ordinary = 0.0
    for part in NAME_PART.findall(token):
        both = [CLASS[np.frombuffer(x, dtype=np.uint8)] for x in {part, part.lower()}]
        ordinary += max(ordinary_model[np.concatenate([[STATES - 1], x[:-1]]), x].sum() for x in both)
    n = max(int(counted.sum()), 1)
    return float(max(m[before, now][counted].sum() for m in random_models) - ordinary) / n


def looks_random(token: bytes, random_models: tuple[np.ndarray, ...], ordinary_model: np.ndarray) -> bool:
    """A ratio above the limit.  Tokens with fewer than ``MIN_CLASSES`` digits or others are judged
    as names, the rest as they stand; a word of one case needs a digit, and digits a letter: no long
    word of one case and no number is reported, whatever its characters."""
    digits = sum(48 <= b < 58 for b in token)
    upper, lower = any(65 <= b < 91 for b in token), any(97 <= b < 123 for b in token)
    if digits < MIN_CLASSES or len(token) - digits < MIN_CLASSES:
        if not (upper and lower) and not (digits and (upper or lower)):
            return False
        return name_ratio(token, random_models, ordinary_model) >= MIN_MEAN_RATIO
    return mean_ratio(token, random_models, ordinary_model) >= MIN_MEAN_RATIO


def scan(docs: DataFrame, key: str, text: str, keep_columns: tuple[str, ...]) -> DataFrame:
    """Pass 1: per document its base spans and candidates; per batch its transition counts
    (rows with ``is_doc`` false)."""
    carried = [key, *[c for c in keep_columns if c != key]]
    cols = list(dict.fromkeys([*carried, text]))
    types = dict(docs.dtypes)
    cand = pa.struct([("start", pa.int64()), ("token", pa.binary())])
    names = [*carried, "spans", "candidates", "is_doc", "random_counts", "ordinary_counts"]
    ddl = ", ".join([f"`{c}` {types[c]}" for c in carried]
                    + [f"spans {SPAN_DDL}", "candidates array<struct<start:long,token:binary>>", "is_doc boolean",
                       "random_counts array<long>", "ordinary_counts array<long>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random_counts = np.zeros(STATES * STATES, dtype=np.int64)
        ordinary_counts = np.zeros(STATES * STATES, dtype=np.int64)
        kinds = None
        for batch in batches:
            for part in slices(batch, text):
                column = part.column(part.schema.get_field_index(text))
                buf = TextBuf(column)
                starts, ends, doc, whole = token_runs(buf)
                points = np.concatenate([[0], np.cumsum((buf.data & 0xC0) != 0x80)])
                raw = buf.data.tobytes()
                spans, values = [], []
                hidden = np.zeros(len(buf.data) + 1, dtype=bool)  # bytes of base spans
                for d, t in enumerate(column.to_pylist()):
                    found = base_spans(t or "")
                    spans.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in found])
                    for a, k, b in found:
                        lo, hi = np.searchsorted(points[buf.offs[d]:buf.offs[d + 1] + 1] - points[buf.offs[d]], [a, b])
                        hidden[buf.offs[d] + lo:buf.offs[d] + hi] = True
                        values.append((buf.offs[d] + lo, buf.offs[d] + hi))
                touched = np.concatenate([[0], np.cumsum(hidden[:-1])])
                free = touched[ends] == touched[starts]
                long = free & (ends - starts >= MIN_CANDIDATE)
                plain = free & whole & (ends - starts >= MIN_ORDINARY)
                ordinary_counts += transitions(buf.data, starts[plain], ends[plain])
                # The labelled random strings: the last run of key characters of each base span.
                if values:
                    v = [re.search(rb"[A-Za-z0-9+/_.=-]+$", raw[a:b]) for a, b in values]
                    pairs = [(a + m.start(), b) for (a, b), m in zip(values, v) if m]
                    s, e = np.array(pairs, dtype=np.int64).reshape(-1, 2).T
                    random_counts += transitions(buf.data, s, e)
                candidates = [[] for _ in range(buf.n)]
                for a, b, d in zip(starts[long].tolist(), ends[long].tolist(), doc[long].tolist()):
                    candidates[d].append({"start": int(points[a] - points[buf.offs[d]]), "token": raw[a:b]})
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index(c)) for c in carried]
                    + [pa.array(spans, pa.list_(SPAN)), pa.array(candidates, pa.list_(cand)),
                       pa.array([True] * buf.n, pa.bool_()), *[pa.nulls(buf.n, pa.list_(pa.int64()))] * 2], names=names)
                kinds = [part.column(part.schema.get_field_index(c)).type for c in carried]
        if kinds is None:
            return
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, kind) for kind in kinds]
            + [pa.array([[]], pa.list_(SPAN)), pa.array([[]], pa.list_(cand)), pa.array([False]),
               pa.array([random_counts.tolist()], pa.list_(pa.int64())),
               pa.array([ordinary_counts.tolist()], pa.list_(pa.int64()))], names=names)

    return docs.select(*cols).mapInArrow(lean(run), ddl)


def train(scanned: DataFrame) -> tuple[tuple[np.ndarray, ...], np.ndarray, bool]:
    """The models (random ones, ordinary) from the per-task counts: tables of ``STATES**2`` cells, added by Spark."""
    cells = scanned.where(~F.col("is_doc")).select(
        F.posexplode(F.arrays_zip("random_counts", "ordinary_counts")).alias("cell", "n"))
    cells = cells.groupBy("cell").agg(F.sum("n.random_counts").alias("r"), F.sum("n.ordinary_counts").alias("o"))
    counts = np.zeros((2, STATES * STATES), dtype=np.int64)
    for row in cells.collect():
        counts[:, row.cell] = row.r, row.o
    found = (log_model(counts[0]),) if counts[0].any() else ()
    return (*found, generated_model()), log_model(counts[1]), bool(counts[1].any())


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text",
                 keep_columns: tuple[str, ...] = ()) -> DataFrame:
    """Per document row: key, ``keep_columns``, ``base`` and ``spans`` (arrays of kind, start,
    end; code points, end exclusive; by start, then kind).  ``spans`` is ``base`` plus the
    ``random`` spans of the models.

    Null texts have no spans; null and repeated keys are scanned row by row; other columns
    are ignored; an empty table gives no rows.  Without any ordinary token in the corpus
    there is nothing to compare with and no ``random`` span is reported.
    """
    scanned = stored(scan(docs, key, text, keep_columns), "secrets")
    carried = [key, *[c for c in keep_columns if c != key]]
    random_models, ordinary_model, trained = train(scanned)
    rows = scanned.where("is_doc").select(*carried, "spans", "candidates")
    types = dict(docs.dtypes)
    rank = {k: i for i, k in enumerate((*KINDS, "random"))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, every = batch.column(len(carried)).to_pylist(), []
            for spans, candidates in zip(base, batch.column(len(carried) + 1).to_pylist()):
                more = [{"kind": "random", "start": c["start"], "end": c["start"] + len(c["token"])}
                        for c in candidates if trained and looks_random(c["token"], random_models, ordinary_model)]
                every.append(sorted(spans + more, key=lambda s: (s["start"], rank[s["kind"]])) if more else spans)
            yield pa.RecordBatch.from_arrays(
                batch.columns[:len(carried)] + [pa.array(base, pa.list_(SPAN)), pa.array(every, pa.list_(SPAN))],
                names=[*carried, "base", "spans"])

    ddl = ", ".join([f"`{c}` {types[c]}" for c in carried] + [f"base {SPAN_DDL}", f"spans {SPAN_DDL}"])
    return rows.mapInArrow(lean(run), ddl)


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text", mark: str = MARK) -> DataFrame:
    """Documents (all columns) with every found span replaced by ``mark``; overlapping spans
    become one.  All rows stay."""
    packed, keep, restore = with_extra(docs, (key, text))
    found = find_secrets(packed, key, text, keep_columns=keep)
    cut = F.aggregate(
        "spans", F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda a, s: F.when(s["end"] <= a["at"], a).when(
            s["start"] < a["at"], F.struct(a["out"].alias("out"), s["end"].alias("at"))).otherwise(F.struct(
                F.concat(a["out"], F.substr(F.col(text), (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")),
                         F.lit(mark)).alias("out"), s["end"].alias("at"))),
        lambda a: F.concat(a["out"], F.substr(F.col(text), (a["at"] + 1).cast("int"))))
    return restore(found.withColumn(text, F.when(F.size("spans") > 0, cut).otherwise(F.col(text))))


def spans_text(spans):
    """``kind:start:end`` joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
