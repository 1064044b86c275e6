"""Context-tree weighting and repeated-string removal against plain Python."""
import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tessera.llm import ctw, exchange, suffixdedup
from tessera.llm.textbuf import SPACES


def rows_of(df):
    return [(r.doc_id, (r.text or "").encode()) for r in df.select("doc_id", "text").collect()]


def lowered(b):
    return b.lower()  # bytes: A-Z only


class PlainCtw:
    """Context-tree weighting by definition, node by node, from training sequences."""

    def __init__(self, texts, depth):
        self.depth = depth
        self.counts = defaultdict(lambda: [0, 0])
        for t in texts:
            for ctx, node, bit in self.steps(t):
                for d in range(depth + 1):
                    self.counts[ctx[depth - d:], node][bit] += 1
        self.children = defaultdict(set)
        for ctx, node in self.counts:
            if ctx:
                self.children[ctx[1:], node].add((ctx, node))
        self.memo = {}

    def steps(self, text):
        padded = bytes([255] * self.depth) + text + b"\xff"
        for i in range(self.depth, len(padded)):
            node = 1
            for j in range(8):
                bit = padded[i] >> (7 - j) & 1
                yield padded[i - self.depth:i], node, bit
                node = node << 1 | bit

    @staticmethod
    def log_kt(a, b):
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def log_pw(self, key):
        if key not in self.memo:
            pe = self.log_kt(*self.counts[key])
            if len(key[0]) == self.depth:
                self.memo[key] = pe
            else:
                below = sum(map(self.log_pw, self.children[key]))
                self.memo[key] = np.logaddexp(pe, below) - math.log(2)
        return self.memo[key]

    def log10_step(self, ctx, node, bit):
        """Mixture along the context's path: below the deepest node seen in training, nothing
        is mixed in.  Elsewhere this is the ratio of the root's weighted probabilities after
        and before one more ``bit`` (checked against that ratio where the whole path is seen)."""
        new = old = None
        for d in range(self.depth, -1, -1):
            key = (ctx[self.depth - d:], node)
            n = self.counts[key] if key in self.counts else [0, 0]
            if new is None and sum(n) == 0 and d:
                continue
            more = [n[0] + (bit == 0), n[1] + bit]
            pe0, pe1 = self.log_kt(*n), self.log_kt(*more)
            if new is None and d < self.depth:  # the path ends here: the node's own estimate alone
                old = self.log_pw(key) if sum(n) else 0.0
                new = old + pe1 - pe0
            elif new is None:
                old, new = pe0, pe1
            else:
                path = (ctx[self.depth - d - 1:], node)
                rest = sum(self.log_pw(k) for k in self.children[key] if k != path)
                old, new = (np.logaddexp(p, rest + q) - math.log(2) for p, q in ((pe0, old), (pe1, new)))
        return (new - old) / math.log(10)

    def score(self, text):
        return sum(self.log10_step(*s) for s in self.steps(text))


def is_held_out(i):
    return zlib.crc32(str(i).encode()) % 7 == 2


@pytest.mark.parametrize("source", ["documents", "tricky"])
def test_ctw_is_the_ratio_of_weighted_probabilities(request, source):
    df = request.getfixturevalue(source)
    rows = rows_of(df)
    small = {i for i, t in rows if len(t) < 700} | {0, 1, 2, 3}
    df = df.where(df.doc_id.isin([i for i in small if i is not None][:40]) | df.doc_id.isNull())
    rows = rows_of(df)
    train = [lowered(t) for i, t in rows if not is_held_out(i)]
    model = PlainCtw(train, ctw.DEPTH)
    tokens = Counter(w for t in train for w in [*t.split(), None])
    n, v = sum(tokens.values()), len(tokens)
    want = Counter()
    texts = {}
    for i, t in rows:
        words = [*lowered(t).split(), None]
        base = sum(math.log10((tokens[w] + 1) / (n + v + 1)) for w in words)
        want[i, is_held_out(i), len(words), sum(tokens[w] > 0 for w in words), n, round(base, 6)] += 1
        texts[i] = lowered(t)
    got = ctw.score_documents(df).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    for r in sorted(got, key=lambda r: (r.doc_id is None, r.doc_id))[:12]:
        assert r.score == pytest.approx(model.score(texts[r.doc_id]), rel=1e-5, abs=1e-4)


def test_ctw_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    texts = [bytes(rng.choice(list(b"ab "), 200)) for _ in range(3)]
    grams = Counter()
    for t in texts:
        p = bytes([255] * ctw.DEPTH) + t + b"\xff"
        grams.update(p[i:i + ctw.DEPTH + 1] for i in range(len(p) - ctw.DEPTH))
    context = b"abab "
    every = {context + bytes([x]): 0 for x in range(256)} | grams
    keys = np.array(sorted(int.from_bytes(g, "big") for g in every), dtype=np.uint64)
    counts = np.array([every.get(int(k).to_bytes(ctw.DEPTH + 1, "big"), 0) for k in keys])
    top = ctw.top_tables(*_grouped(*ctw.top_sums(keys, counts)))
    logs = ctw.log_probabilities(keys, counts, top)
    mine = keys >> np.uint64(8) == int.from_bytes(context, "big")
    assert mine.sum() == 256 and (10 ** logs[mine]).sum() == pytest.approx(1)


def _grouped(keys, sums):
    k, of = np.unique(keys, return_inverse=True)
    return k, np.stack([np.bincount(of, weights=s, minlength=len(k)) for s in sums])


def test_ctw_learns_on_held_out_texts(documents):
    rows = [r for r in ctw.score_documents(documents).collect() if r.held_out]
    size = {i: len(t) + 1 for i, t in rows_of(documents)}
    bits = -sum(r.score for r in rows) / math.log10(2) / sum(size[r.doc_id] for r in rows)
    assert bits < 2.9  # no model: 8; single bytes: above 4


def test_ctw_without_rows(nothing, documents):
    assert ctw.score_documents(nothing).count() == 0
    only = documents.where("crc32(cast(doc_id as string)) % 7 = 2").limit(3)
    for r in ctw.score_documents(only).collect():
        assert r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0
        size = len((dict(rows_of(only))[r.doc_id])) + 1
        assert r.score == pytest.approx(-8 * size * math.log10(2), rel=1e-5)


def brute_repeats(texts, n=400):
    where = Counter()
    for t in texts:
        where.update(hash(t[i:i + n]) for i in range(len(t) - n + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - n + 1):
            if where[hash(t[i:i + n])] > 1:
                gone[i:i + n] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def planted(spark):
    rng = np.random.default_rng(3)
    fresh = lambda n: "".join(rng.choice(list("abcdefgh é"), n))
    p400, p399, long = "q" + "".join(rng.choice(list("klmnop"), 399)), "".join(rng.choice(list("rstuvw"), 399)), fresh(3000)
    texts = [fresh(700) + p400 + fresh(300), fresh(11) + p400, fresh(50) + p399 + fresh(50), p399 + fresh(500),
             long, long[100:2500], fresh(20) + long[1300:1750] + fresh(5), "z" * 900, "yx" * 210, fresh(399), fresh(400),
             p400[:200] + p400 + p400[200:], None, "", long]
    texts += [long[:1500] + "#" + long[1501:]] * 2 + [fresh(200_000)]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_repeats_match_brute_force(spark, documents, tricky, nothing):
    for df in (planted(spark).repartition(3), documents, tricky):
        rows = rows_of(df)
        want = Counter((i, *x) for (i, _), x in zip(rows, brute_repeats([t for _, t in rows])))
        got = Counter(tuple(r) for r in suffixdedup.remove_repeats(df).collect())
        assert got == want
    assert sum(x[2] for x in want) > 0
    assert suffixdedup.remove_repeats(nothing).count() == 0
    for r in suffixdedup.remove_repeats(planted(spark), with_kept=True).collect():
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256


def test_arrays_survive_the_exchange():
    rng = np.random.default_rng(0)
    for a in (np.sort(rng.integers(0, 1 << 63, 1000, dtype=np.uint64)), np.zeros(0, np.uint64)):
        assert (exchange.unsqueeze(exchange.squeeze(a, True)) == a).all()
    b = rng.integers(-5, 1 << 40, 77)
    assert (exchange.unsqueeze(exchange.squeeze(b)) == b).all() and bytes(SPACES).split() == []
