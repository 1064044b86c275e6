"""Quality rules with tokeniser fertility.

Base counts per document (words, symbols, repeated lines, repeated three-word windows),
then three measures from public vocabularies over the document's words:

* characters per token of a byte-level vocabulary,
* share of byte-fallback tokens of a SentencePiece vocabulary,
* entropy (bits) of the document's SentencePiece tokens, relative to the most that their
  number allows: over the whole text, and as the mean over windows of at most
  ``ENTROPY_WINDOW`` tokens that cover it.  Bands judge the latter: a language's entropy
  saturates while log2 of the number grows, so the former falls with the length of any text.

Text of a language a vocabulary knows stays within a band of each; shouting, noise and
endless repetition leave it.  Bands are per language with one default, by parameter.
"""
from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import with_extra
from .textbuf import NOT_SPACE, TextBuf, doc_of, lean, mix64, segment_sums, slices
from .wordtok import drop, piece_tokenizer, rank_tokenizer, word_hashes


@dataclass(frozen=True)
class Band:
    """A document is rejected outside ``[min_chars, max_chars]`` characters per token, above
    ``max_fallback`` byte-fallback share, or below ``min_entropy`` mean relative entropy of its
    token windows.

    The least characters per token are lowered by the share ``slack / sqrt(tokens)``, since
    their mean spreads that much more the fewer tokens it has.  ``min_chars`` None takes them from the
    text's script: the harmonic mean of ``SCRIPT_FLOORS`` over its characters.  Then also
    characters of scripts that the SentencePiece vocabulary knows in part (``SPELLED``) may fall
    back to bytes, and ``min_entropy`` is halved for the share of tokens that do."""
    min_chars: float | None = None
    max_chars: float = 6.5
    max_fallback: float = 0.25
    min_entropy: float = 0.45
    slack: float = 1.25


#: Least characters per token by language, of long texts, with the byte-level vocabulary (means
#: of clean labelled texts: en 2.24, de 2.04, es 1.77, fr 1.85; standard deviation 0.9 to 1.0
#: over the root of the tokens); other languages go by script.  Least window entropy by language: 3.9
#: standard deviations below the mean of the clean labelled texts of a bounded sample (the 3,243 of sf0.1 past the
#: base rule: en 0.801, de 0.786, es 0.786, fr 0.781; standard deviation 0.017 to 0.018).
DEFAULT_BANDS: Mapping[str | None, Band] = {
    None: Band(), "en": Band(min_chars=1.95, min_entropy=0.735), "de": Band(min_chars=1.82, min_entropy=0.725),
    "es": Band(min_chars=1.6, min_entropy=0.715), "fr": Band(min_chars=1.64, min_entropy=0.725)}

#: First bytes of UTF-8 characters and the least characters per token of such text.  The
#: vocabulary spells many scripts byte by byte, with a token more for each word.
SCRIPT_FLOORS = (
    (0x00, 0x7F, 1.2),   # ASCII
    (0xC2, 0xC9, 0.5),   # further Latin letters
    (0xCA, 0xCD, 0.4),   # phonetic letters, combining marks
    (0xCE, 0xCF, 0.5),   # Greek
    (0xD0, 0xD3, 0.45),  # Cyrillic
    (0xD4, 0xD5, 0.35),  # Armenian
    (0xD6, 0xD7, 0.5),   # Hebrew
    (0xD8, 0xDB, 0.45),  # Arabic
    (0xDC, 0xDF, 0.35),  # Syriac, Thaana, N'Ko
    (0xE0, 0xEF, 0.25),  # three bytes: Indic, Thai, Georgian, Ethiopic, Han, kana, Hangul and more
    (0xF0, 0xF4, 0.18),  # four bytes
)
#: First bytes of letters of which the SentencePiece vocabulary lacks a good part (not symbols,
#: private use or, in four bytes, emoji).
SPELLED = ((0xD2, 0xD6), (0xDA, 0xDB), (0xDC, 0xDF), (0xE0, 0xE1), (0xE3, 0xED), (0xF0, 0xF0))

_PPM = 1_000_000
MOST_TOKENS = np.zeros(256, dtype=np.int64)  # millionths of a token per character, by first byte
for _a, _b, _floor in SCRIPT_FLOORS:
    MOST_TOKENS[_a:_b + 1] = round(_PPM / _floor)
MOST_TOKENS[~NOT_SPACE] = 0
SPELLED_BYTES = np.zeros(256, dtype=np.int64)
for _a, _b in SPELLED:
    SPELLED_BYTES[_a:_b + 1] = 2 if _b < 0xE0 else 3 if _b < 0xF0 else 4

ENTROPY_WINDOW = 256

SYMBOL = np.zeros(256, dtype=bool)
SYMBOL[list(b"#*$%&|<>")] = True
LINE = np.ones(256, dtype=bool)
LINE[10] = False
_SALT = np.uint64(0x9E3779B97F4A7C15)


def _range_counts(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[ends] - total[starts]


def script_floors(buf: TextBuf, word_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text the least characters per token of its scripts, and the bytes of its characters
    that may be spelled."""
    floor = word_chars * _PPM / np.maximum(segment_sums(MOST_TOKENS[buf.data], buf.offs), 1)
    spelled = SPELLED_BYTES[buf.data]
    four = np.flatnonzero(buf.data == 0xF0)
    spelled[four[buf.data[four + 1] == 0x9F]] = 0
    return floor, segment_sums(spelled, buf.offs)


def repeated_words(hashes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Words per text inside three-word windows that occur twice or more in that text."""
    doc = doc_of(firsts)
    marked = np.zeros(len(hashes), dtype=bool)
    if len(hashes) >= 3:
        at = np.flatnonzero(doc[2:] == doc[:-2])
        salt = mix64(doc[at].astype(np.uint64) + _SALT)
        key = mix64(hashes[at] + _SALT) * np.uint64(3) + mix64(hashes[at + 1] ^ _SALT) * np.uint64(5) + hashes[at + 2]
        _, inverse, counts = np.unique(mix64(key) ^ salt, return_inverse=True, return_counts=True)
        twice = at[counts[inverse] > 1]
        for k in range(3):
            marked[twice + k] = True
    return segment_sums(marked.astype(np.int64), firsts)


def duplicate_lines(buf: TextBuf) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    starts, ends, firsts = buf.words(LINE)
    doc = doc_of(firsts)
    worded = _range_counts(NOT_SPACE[buf.data], starts, ends) > 0
    starts, ends, doc = starts[worded], ends[worded], doc[worded]
    key = word_hashes(buf, starts, ends) ^ mix64(doc.astype(np.uint64) + _SALT)
    _, first = np.unique(key, return_index=True)
    return np.bincount(doc, minlength=buf.n) - np.bincount(doc[first], minlength=buf.n)


def relative_entropy(ids: np.ndarray, per_doc: np.ndarray) -> np.ndarray:
    """Token entropy per text over log2 of its number of tokens (1 with fewer than two)."""
    doc = np.repeat(np.arange(len(per_doc)), per_doc)
    key, counts = np.unique(doc.astype(np.int64) << 32 | ids, return_counts=True)
    owner = key >> 32
    n = per_doc[owner].astype(float)
    bits = np.bincount(owner, weights=counts / n * np.log2(n / counts), minlength=len(per_doc))
    return np.where(per_doc > 1, bits / np.log2(np.maximum(per_doc, 2)), 1.0)


def window_entropy(ids: np.ndarray, per_doc: np.ndarray, window: int = ENTROPY_WINDOW) -> np.ndarray:
    """Mean relative entropy of a text's consecutive windows: the fewest of at most ``window``
    tokens that cover it, equal in size but for one token (so none is a short rest)."""
    parts = np.maximum(-(-per_doc // window), 1)
    doc = np.repeat(np.arange(len(per_doc)), parts)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
    sizes = per_doc[doc] * (k + 1) // parts[doc] - per_doc[doc] * k // parts[doc]
    return np.bincount(doc, weights=relative_entropy(ids, sizes), minlength=len(per_doc)) / parts


def quality_rules(docs: DataFrame, rank_path: str, rank_pattern: str, piece_path: str,
                  key: str = "doc_id", text: str = "text", lang: str = "lang",
                  bands: Mapping[str | None, Band] = DEFAULT_BANDS, keep_columns: tuple[str, ...] = ()) -> DataFrame:
    """Measures and verdict per document: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, chars_per_token, fallback_share, token_entropy, window_entropy,
    kept``.

    ``kept`` is false if the base rule fails (fewer than 50 words, or more than half of the
    words in repeated windows), else the bands' verdict.  A null text has no words (and so
    fails the base rule); a text without tokens has 0 characters per token, no fallback
    and entropies 1; a null or unlisted language takes the default band (by script); rows with null or
    repeated keys are judged one by one; other columns are ignored unless named in
    ``keep_columns``; an empty table gives no rows.
    """
    cols = [key, text, lang, *[c for c in keep_columns if c not in (key, text, lang)]]
    carried = [c for c in cols if c == key or c in keep_columns]
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    measures = ["chars_per_token", "fallback_share", "token_entropy", "window_entropy"]
    schema = pa.schema([pa.field(c, pa.null()) for c in carried]
                       + [pa.field(c, pa.int64()) for c in counts] + [pa.field("base_failed", pa.bool_())]
                       + [pa.field(c, pa.float64()) for c in measures] + [pa.field("kept", pa.bool_())])
    types = dict(docs.dtypes)
    ddl = ", ".join([f"`{c}` {types[c]}" for c in carried] + [f"{c} long" for c in counts] + ["base_failed boolean"]
                    + [f"{c} double" for c in measures] + ["kept boolean"])
    default = bands.get(None, Band())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, pieces = rank_tokenizer(rank_path, rank_pattern), piece_tokenizer(piece_path)
        for batch in batches:
            for part in slices(batch, text):
                col = {c: part.column(part.schema.get_field_index(c)) for c in cols}
                buf = TextBuf(col[text])
                starts, ends, firsts = buf.words()
                hashes = word_hashes(buf, starts, ends)
                n_words = np.diff(firsts)
                char = (buf.data & 0xC0) != 0x80
                word_chars = segment_sums(_range_counts(char, starts, ends), firsts)
                symbols = _range_counts(SYMBOL[buf.data], buf.offs[:-1], buf.offs[1:])
                repeat = repeated_words(hashes, firsts)
                failed = (n_words < 50) | (100 * repeat > 50 * n_words)
                _, n_rank = ranks.tokens(buf, starts, ends, hashes)
                ids, n_piece = pieces.tokens(buf, starts, ends, hashes)
                rank_tokens, piece_tokens = segment_sums(n_rank, firsts), segment_sums(n_piece, firsts)
                chars = word_chars / np.maximum(rank_tokens, 1)
                owner = np.repeat(np.arange(buf.n), piece_tokens)
                fallback = np.bincount(owner[pieces.is_byte[ids]], minlength=buf.n) / np.maximum(piece_tokens, 1)
                entropy, windows = relative_entropy(ids, piece_tokens), window_entropy(ids, piece_tokens)
                band = [bands.get(x, default) for x in col[lang].to_pylist()]
                limit = np.array([(np.nan if b.min_chars is None else b.min_chars, b.max_chars, b.max_fallback,
                                   b.min_entropy, b.slack) for b in band]).reshape(-1, 5).T
                floor, spelled = script_floors(buf, word_chars)
                by_script = np.isnan(limit[0])
                least = np.where(by_script, floor, limit[0]) * (1 - limit[4] / np.sqrt(np.maximum(rank_tokens, 1)))
                allowed = np.where(by_script, np.minimum(spelled / np.maximum(piece_tokens, 1), fallback), 0)
                kept = (~failed & (chars >= least) & (chars <= limit[1]) & (fallback - allowed <= limit[2])
                        & (windows >= limit[3] * (1 - allowed / 2)))
                values = [n_words, word_chars, symbols, duplicate_lines(buf), repeat, failed, chars, fallback, entropy, windows,
                          kept]
                fields = list(schema)[len(carried):]
                yield pa.RecordBatch.from_arrays(
                    [col[c] for c in carried] + [pa.array(v, f.type) for v, f in zip(values, fields)], names=schema.names)
        drop(ranks, pieces)

    return docs.select(*[F.col(c) for c in cols]).mapInArrow(lean(run), ddl)


def keep_good(docs: DataFrame, rank_path: str, rank_pattern: str, piece_path: str, key: str = "doc_id",
              text: str = "text", lang: str = "lang", **kw) -> DataFrame:
    """The documents (all columns) that the rules keep."""
    packed, keep, restore = with_extra(docs, (key, text, lang))
    judged = quality_rules(packed, rank_path, rank_pattern, piece_path, key, text, lang, keep_columns=keep, **kw)
    return restore(judged.where("kept"))
