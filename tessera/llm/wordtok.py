"""Token ids of whole texts through a cache of words.

The public tokenizers used here never merge across white space, so the ids of a text are
the ids of its words in order.  Each distinct word is encoded once per task (the
cache is dropped when it holds ``MAX_WORDS`` words, and when a task ends, so that a worker
does not carry it into other stages) and ids are laid out with numpy.
"""
from __future__ import annotations

import itertools
import os
from collections.abc import Callable

import numpy as np

from .textbuf import RangeHasher, TextBuf

MAX_WORDS = 400_000
_HASH = RangeHasher(7)
_CACHES: dict[str, "WordCache"] = {}


class WordCache:
    """``encode`` maps a list of words to a list of id lists."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]]):
        self.encode = encode
        self.clear()

    def clear(self) -> None:
        self.known: dict[int, int] = {}
        self.size = self.used = 0
        self.starts = np.zeros(1024, dtype=np.int64)
        self.lens = np.zeros(1024, dtype=np.int64)
        self.flat = np.zeros(4096, dtype=np.int32)

    def _add(self, keys: list[int], words: list[str]) -> None:
        ids = self.encode(words)
        lens = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        total = int(lens.sum())
        while self.size + len(ids) > len(self.lens):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.lens = np.concatenate([self.lens, np.zeros_like(self.lens)])
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        at = slice(self.size, self.size + len(ids))
        self.lens[at] = lens
        self.starts[at] = self.used + np.cumsum(lens) - lens
        self.flat[self.used:self.used + total] = np.fromiter(
            itertools.chain.from_iterable(ids), dtype=np.int32, count=total)
        self.known.update(zip(keys, range(self.size, self.size + len(ids))))
        self.size += len(ids)
        self.used += total

    def tokens(self, buf: TextBuf, starts: np.ndarray, ends: np.ndarray,
               hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words back to back, and each word's number of ids."""
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        keys, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if self.size > MAX_WORDS:
            self.clear()
        keys = keys.tolist()
        slots = list(map(self.known.get, keys))
        new = [i for i, s in enumerate(slots) if s is None]
        if new:
            raw = buf.data.tobytes()
            at = first[new]
            for i, s in zip(new, range(self.size, self.size + len(new))):
                slots[i] = s
            self._add([keys[i] for i in new],
                      [raw[a:b].decode("utf-8", "replace") for a, b in zip(starts[at].tolist(), ends[at].tolist())])
        slot = np.array(slots, dtype=np.int64)[inverse]
        lens = self.lens[slot]
        before = np.cumsum(lens) - lens
        where = np.repeat(self.starts[slot] - before, lens) + np.arange(int(lens.sum()))
        return self.flat[where], lens


def word_hashes(buf: TextBuf, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return _HASH.ranges(_HASH.prefix(buf.data), starts, ends)


#: ASCII letters are 1; ASCII marks that never share a token with a letter are 2.  The
#: apostrophe (contractions) and ``<|>`` (special tokens) may, and stay with their neighbours.
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[65:91] = _KIND[97:123] = 1
_KIND[list(b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~")] = 2
_LOWER_HASH = RangeHasher(8, lower=True)


def word_units(buf: TextBuf) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words cut further between letters and marks, for the lower-casing vocabulary that
    cuts there itself: starts, ends, first unit of each text, and hashes.  Units that differ
    in A-Z only share a hash, except those with a ``<`` (special tokens know case)."""
    starts, ends, _ = buf.words()
    kind = _KIND[buf.data]
    cuts = np.flatnonzero(kind[1:] + kind[:-1] == 3) + 1
    marks = np.zeros(len(buf.data) + 1, dtype=bool)
    marks[starts] = marks[cuts] = True
    first = np.flatnonzero(marks)
    marks[:] = False
    marks[ends] = marks[cuts] = True
    last = np.flatnonzero(marks)
    hashes = _LOWER_HASH.ranges(_LOWER_HASH.prefix(buf.data), first, last)
    special = np.flatnonzero(buf.data == 60)
    if len(special):
        at = np.unique(np.searchsorted(first, special, side="right") - 1)
        hashes[at] = word_hashes(buf, first[at], last[at])
    return first, last, np.searchsorted(first, buf.offs), hashes


JOINED = 256


def drop(*caches: WordCache) -> None:
    """Let go of tokenizers at the end of a task, vocabularies included: a worker lives on into stages
    that need none, and loading one again takes a fraction of a second."""
    for cache in caches:
        cache.clear()
        for path in [p for p, c in _CACHES.items() if c is cache]:
            del _CACHES[path]


def json_tokenizer(path: str) -> WordCache:
    """Vocabulary of the ``tokenizers`` library with word-end tokens, no special tokens added.

    Words of ASCII letters are one pre-token each, so many of them are encoded as one text
    and told apart by their word-end tokens; the others are encoded one by one.
    """
    if path not in _CACHES:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        is_end = np.zeros(tok.get_vocab_size(), dtype=bool)
        is_end[[i for t, i in tok.get_vocab().items() if t.endswith("</w>")]] = True

        def one_by_one(words: list[str]) -> list[list[int]]:
            return [e.ids for e in tok.encode_batch_fast(words, add_special_tokens=False)]

        def encode(words: list[str]) -> list[list[int]]:
            plain, other = [], []
            for i, w in enumerate(words):
                (plain if w.isascii() and w.isalpha() else other).append(i)
            out: list[list[int]] = [[]] * len(words)
            for i, ids in zip(other, one_by_one([words[i] for i in other])):
                out[i] = ids
            groups = [plain[a:a + JOINED] for a in range(0, len(plain), JOINED)]
            for group, ids in zip(groups, one_by_one([" ".join([words[i] for i in g]) for g in groups])):
                stops = (np.flatnonzero(is_end[ids]) + 1).tolist()
                if len(stops) == len(group) and stops[-1] == len(ids):
                    for i, a, b in zip(group, [0, *stops], stops):
                        out[i] = ids[a:b]
                else:
                    for i, each in zip(group, one_by_one([words[i] for i in group])):
                        out[i] = each
            return out

        _CACHES[path] = WordCache(encode)
    return _CACHES[path]


def piece_tokenizer(path: str) -> WordCache:
    """SentencePiece vocabulary with byte fallback."""
    if path not in _CACHES:
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        _CACHES[path] = WordCache(lambda words: model.encode(words, num_threads=1))
        _CACHES[path].is_byte = np.array([model.is_byte(i) for i in range(model.get_piece_size())])
    return _CACHES[path]


def rank_tokenizer(path: str, pattern: str) -> WordCache:
    """Byte-level vocabulary given as ranks (``tiktoken`` file)."""
    if path not in _CACHES:
        import base64

        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        _CACHES[path] = WordCache(lambda words: [enc.encode_ordinary(" " + w) for w in words])
    return _CACHES[path]
