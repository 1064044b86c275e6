"""The line field against enumeration, finite differences and plain counts; held-out quality."""
import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import crf, queries
from tessera.llm.textbuf import TextBuf

SF01 = "/root/testdata/sf0.01"


def random_field(rng):
    return crf.Field(rng.normal(size=1 + 3 * crf.WIDTH) * 0.2, rng.normal(size=(2, 2)))


def weight(field, scores, labels):
    edge = sum(field.edges[a, b] for a, b in zip(labels, labels[1:]))
    return np.exp(edge + sum(s for s, y in zip(scores, labels) if y))


def test_marginals_by_enumeration():
    rng = np.random.default_rng(1)
    field = random_field(rng)
    sizes = [1, 5, 2, 9, 1, 3]
    scores = rng.normal(size=sum(sizes)) * 3
    firsts = np.concatenate([[0], np.cumsum(sizes)])
    got = crf.marginals(field, scores, firsts)
    for a, b in zip(firsts, firsts[1:]):
        total, good = 0.0, np.zeros(b - a)
        for labels in itertools.product((0, 1), repeat=b - a):
            w = weight(field, scores[a:b], labels)
            total += w
            good += w * np.array(labels)
        assert np.allclose(got[a:b], good / total, rtol=1e-9)


def test_long_chains_neither_overflow_nor_vanish():
    rng = np.random.default_rng(2)
    field = crf.Field(np.zeros(1 + 3 * crf.WIDTH), np.array([[3.0, -3], [-3, 3]]))
    n = 100_000
    got = crf.marginals(field, rng.normal(size=n) * 50, np.array([0, n]))
    assert np.isfinite(got).all() and got.min() >= 0 and got.max() <= 1
    alone = crf.marginals(field, np.array([1.0]), np.array([0, 1]))
    assert np.allclose(alone, 1 / (1 + np.exp(-1)))


def test_objective_and_gradient():
    rng = np.random.default_rng(3)
    field = random_field(rng)
    sizes = [1, 4, 3]
    firsts = np.concatenate([[0], np.cumsum(sizes)])
    measures = rng.uniform(size=(8, len(crf.MEASURES))).astype(np.float32)
    y = rng.integers(0, 2, 8)
    x = crf.indicators(measures)
    theta = np.concatenate([field.weights, field.edges.reshape(-1)])
    head = np.zeros(8, bool)
    head[firsts[:-1]] = True
    scores = crf.evidence(field, measures, head)
    want = 0.0
    for a, b in zip(firsts, firsts[1:]):
        z = sum(weight(field, scores[a:b], lab) for lab in itertools.product((0, 1), repeat=b - a))
        want += np.log(z) - np.log(weight(field, scores[a:b], y[a:b]))
    value, grad = crf._objective(theta, x, y, firsts, 0.5)
    assert np.isclose(value, want + 0.25 * (theta[1:] ** 2).sum(), rtol=1e-5)
    for k in [0, 1, 5, crf.WIDTH + 3, 2 * crf.WIDTH + 7, len(theta) - 4, len(theta) - 2, len(theta) - 1]:
        step = np.zeros_like(theta)
        step[k] = 1e-3
        slope = (crf._objective(theta + step, x, y, firsts, 0.5)[0] - crf._objective(theta - step, x, y, firsts, 0.5)[0]) / 2e-3
        assert np.isclose(grad[k], slope, rtol=2e-2, atol=2e-3)


def test_training_ends_at_the_bottom():
    rng = np.random.default_rng(4)
    measures = rng.uniform(size=(400, len(crf.MEASURES))).astype(np.float32)
    y = np.repeat((measures[::4, 0] > 0.5).astype(int), 4)
    firsts = np.arange(0, 401, 4)
    f = lambda t: crf._objective(t, crf.indicators(measures), y, firsts, 1.0)
    theta = crf._minimise(f, np.zeros(1 + 3 * crf.WIDTH + 4), 200)
    value, grad = f(theta)
    assert np.abs(grad).max() < 1.0 and value < 0.2 * f(np.zeros_like(theta))[0]


def plain_measures(text):
    out = []
    lines = [ln for ln in (text or "").split("\n") if any(c not in " \t\n\x0b\x0c\r" for c in ln)]
    everything = [w for ln in lines for w in words(ln)]
    windows = {}
    for i in range(len(everything) - 2):
        windows.setdefault(tuple(everything[i:i + 3]), []).append(i)
    again = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    at = 0
    for ln in lines:
        w = words(ln)
        raw = "".join(w).encode()
        letters = sum(c in b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ" or c > 127 for c in raw)
        out.append({
            "capitals": sum(65 <= c <= 90 for c in raw) / max(letters, 1), "symbols": min(sum(c in b"#*$%&|<>" for c in raw) / len(w), 4) / 4,
            "digits": sum(48 <= c <= 57 for c in raw) / len(raw), "word_length": min(len(raw) / len(w), 20) / 20,
            "same_as_last_word": sum(a == b for a, b in zip(w, w[1:])) / len(w), "distinct_words": len(set(w)) / len(w),
            "repeated_windows": sum(at + i in again for i in range(len(w))) / len(w), "repeated_line": float(lines.count(ln) > 1),
            "capital_words": sum("A" <= x[0] <= "Z" for x in w) / len(w), "chars": sum(map(len, w))})
        at += len(w)
    return out


def words(line):
    import re
    return re.findall("[^\x20\x09-\x0d]+", line)


def test_measures_by_plain_counts(tricky, documents):
    texts = [r.text for df in (tricky, documents) for r in df.select("text").collect()]
    lines = crf.measure(TextBuf(pa.array(texts, pa.string())))
    for d, t in enumerate(texts):
        want = plain_measures(t)
        a, b = lines.firsts[d], lines.firsts[d + 1]
        if not want:
            assert b - a == 1 and lines.chars[a] == 0
            continue
        assert b - a == len(want)
        for k, w in zip(range(a, b), want):
            assert lines.chars[k] == w.pop("chars")
            for name, v in w.items():
                assert abs(lines.measures[k, crf.MEASURES.index(name)] - v) < 1e-5, (name, t[:80])


def auc(scores, labels):
    good, bad = scores[labels == 1], scores[labels == 0]
    return ((good[:, None] > bad[None]).mean() + (good[:, None] == bad[None]).mean() / 2)


def test_held_out_documents_are_told_apart(spark):
    got = queries.QUERIES["op13_line_crf_quality"](spark, SF01).toPandas()
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    assert (got.predicted == (got.score >= 0.3)).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    labels = spark.read.parquet(f"{SF01}/labels.parquet").toPandas()
    held = got[got.held_out].merge(labels, on="doc_id")
    assert (held.quality == 0).sum() >= 5
    assert auc(held.score.to_numpy(), held.quality.to_numpy()) > 0.95
    assert ((held.predicted == held.quality).mean()) > 0.93
    assert (held[held.quality == 1].predicted == 1).mean() > 0.97


def test_awkward_rows(spark, tricky, nothing):
    labels = spark.createDataFrame([(1, 1), (5, 0), (9, 0), (8, 1), (8, 0), (None, 1), (6, None)], "doc_id long, quality int")
    field = crf.fit(tricky, labels)
    assert np.abs(field.weights).max() > 0
    got = crf.score_documents(tricky, field)
    rows = got.collect()
    assert len(rows) == tricky.count() and all(0 <= r.score <= 1 for r in rows)
    empty = {r.score for r in rows if r.n_lines == 0}
    assert len(empty) == 1  # null, empty and blank texts alike
    assert crf.score_documents(nothing, field).count() == 0
    blank = crf.fit(nothing, labels)
    assert {r.score for r in crf.score_documents(tricky, blank).collect()} == {0.5}
    lines = crf.label_lines(tricky, field).collect()
    total = {}
    for r in rows:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.n_lines
    assert len(lines) == sum(total.values())
    text = {r.doc_id: (r.text or "").encode() for r in tricky.collect()}
    for r in lines:
        piece = text[r.doc_id][r.start:r.end]
        assert b"\n" not in piece and piece.strip()


@pytest.mark.parametrize("repeat", [1, 400])
def test_lines_of_a_long_text_keep_their_own_label(spark, repeat):
    good = "The committee met in the old town hall and discussed the budget for the coming year.\n"
    bad = "BUY NOW!! $$$ *** CLICK!! $$$ *** FREE!! $$$ ***\n"
    labelled = [(i, good * 3, 1) for i in range(40)] + [(100 + i, bad * 3, 0) for i in range(40)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in labelled], "doc_id long, text string")
    field = crf.fit(docs, spark.createDataFrame([(i, q) for i, _, q in labelled], "doc_id long, quality int"))
    mixed = spark.createDataFrame([(1, good * 5 * repeat + bad * 5 * repeat)], "doc_id long, text string")
    lines = crf.label_lines(mixed, field).orderBy("line_no").collect()
    assert all(r.good > 0.5 for r in lines[:4 * repeat]) and all(r.good < 0.5 for r in lines[6 * repeat:])
    score = crf.score_documents(mixed, field).first().score
    assert 0.4 < score < 0.9
    again = crf.score_documents(mixed.withColumn("text", F.concat("text", F.lit("\n\n \n"))), field).first().score
    assert abs(again - score) < 1e-9
