"""Chosen-path similarity join against all pairs in plain Python."""
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import neardup

WORDS = re.compile("[^\x20\x09-\x0d]+")
A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = WORDS.findall((text or "").translate(A_Z))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def brute(rows, k, percent=80):
    sets = [shingles(t, k) for _, t in rows]
    classes = {}
    for (i, _), s in zip(rows, sets):
        if s:
            ids = [x for x in (classes.get(s), i) if x is not None]
            classes[s] = min(ids) if ids else None
    keys = list(classes)
    parent = list(range(len(keys)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(keys):
        for j in range(i):
            b = keys[j]
            if 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                common = len(a & b)
                if 100 * common >= percent * (len(a) + len(b) - common):
                    parent[find(i)] = find(j)
    low = {}
    for i, s in enumerate(keys):
        r = find(i)
        ids = [x for x in (low.get(r), classes[s]) if x is not None]
        low[r] = min(ids) if ids else None
    label = {s: low[find(i)] for i, s in enumerate(keys)}
    return Counter((i, len(s), label[s] if s else i, (label[s] if s else i) == i) for (i, _), s in zip(rows, sets))


def got(df, **kw):
    return Counter(tuple(r) for r in neardup.near_duplicates(df, **kw).collect())


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("k", [2, 5])
def test_groups_match_all_pairs(documents, k):
    want = brute(rows_of(documents), k)
    assert got(documents, shingle=k) == want
    assert any(not x[3] for x in want)


def test_edges(tricky, nothing):
    assert got(tricky, shingle=2) == brute(rows_of(tricky), 2)
    assert neardup.near_duplicates(nothing).count() == 0


def planted(spark):
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnop"), 6))
    rows = []

    def add(words):
        rows.append((len(rows) * 7 % 4001, " ".join(words)))

    for size in (30, 120):  # a hub whose copies are linked to it but not to each other
        base = [word() for _ in range(size * 2)]
        for _ in range(size):
            copy = list(base)
            for at in rng.choice(len(copy), max(1, len(copy) // 22), replace=False):
                copy[at] = word()
            add(copy)
        add(base)
    chain = [word() for _ in range(200)]  # each linked to the next only
    for i in range(40):
        chain = list(chain)
        chain[i * 5 % 200: i * 5 % 200 + 5] = [word() for _ in range(5)]
        add(chain)
    mixture = [word() for _ in range(100)]  # same passage, similarity below the limit
    for _ in range(60):
        add(mixture + [word() for _ in range(40)])
    for n in (1, 2, 3, 3):
        add(mixture[:n])
    for _ in range(300):
        add([word() for _ in range(int(rng.integers(3, 60)))])
    rows += [(5000 + i, rows[3][1].upper()) for i in range(50)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_planted_groups(spark):
    df = planted(spark).repartition(4)
    want = brute(rows_of(df), 2)
    assert got(df, shingle=2) == want
    assert max(Counter(x[2] for x in want).values()) > 50


def test_large_nodes_are_dealt_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "NODE_BLOCK", 16)
    df = planted(spark)
    assert got(df, shingle=2) == brute(rows_of(df), 2)


@pytest.mark.parametrize("shingles_held", [1 << 20, 3000])
def test_rows_grow_with_members_not_with_pairs(spark, monkeypatch, shingles_held):
    """A group with 40 texts just below the limit to each of its 120 members: 4,800 pairs to refute."""
    rng = np.random.default_rng(9)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnop"), 7))
    base, rows = [word() for _ in range(400)], []
    for changed in [8] * 120 + [18] * 40:
        copy = list(base)
        for at in rng.choice(len(copy), changed, replace=False):
            copy[at] = word()
        rows.append((len(rows), " ".join(copy)))
    real, made = neardup.stored, {}

    def counted(df, name):
        out = real(df, name)
        made[name] = max(made.get(name, 0), out.count())
        return out

    monkeypatch.setattr(neardup, "stored", counted)
    monkeypatch.setattr(neardup, "NODE_SHINGLES", shingles_held, raising=False)
    want = brute(rows, 2)
    assert got(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2) == want
    assert sum(1 for x in want if x[3]) > 20
    assert max(n for name, n in made.items() if name != "neardup-nodes") <= 4 * len(rows)


def test_ids_asked_for(spark):
    df = spark.range(20_000).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("x"))
    found = neardup.asked_for(df, df.where("id % 7 = 0").select("id"))
    assert found.columns == df.columns and found.where("id % 7 = 0").count() == 2858 <= found.count() < 3000
    assert neardup.asked_for(df, df.where("false").select("id")).count() == 0


def test_one_row_of_each_group_stays(spark, documents, tricky, nothing):
    docs = documents.limit(60).withColumn("copy", F.lit(0))
    once = Counter(r.text for r in neardup.keep_one(docs).collect())
    twice = neardup.keep_one(docs.unionByName(docs.withColumn("copy", F.lit(1))))
    assert twice.columns == docs.columns
    kept = twice.collect()
    assert Counter(r.text for r in kept) == once
    assert {r.doc_id for r in kept} == {r.doc_id for r in neardup.keep_one(docs).collect()}
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(5, a), (5, b), (3, a), (None, c), (None, c), (9, c), (None, "d " + b), (7, None), (7, None), (8, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.text) for r in neardup.keep_one(df).collect())
    assert got == Counter([(3, a), (5, b), (9, c), (7, None), (7, None), (8, "")])
    assert neardup.keep_one(tricky).columns == tricky.columns and neardup.keep_one(nothing).count() == 0


def test_recall_of_the_trees():
    assert neardup.recall(0.8, 5) > 0.9999 and neardup.recall(0.8, 9) > 0.999
    assert neardup.recall(0.1, 3) < 0.1
