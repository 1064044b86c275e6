"""WARC round trips, chat round trips and association rules against plain Python."""
import gzip
import hashlib
import io
import json
import re
from collections import Counter
from itertools import combinations

import pytest
from pyarrow import fs as pafs

from pyspark.sql import functions as F

from tessera.llm import chat, urlfilter, warc

SF = "/root/testdata/sf0.001"
PAGES = [(1, "http://a/ b\r\nc", "x" * 150), (2, None, "x" * 150), (0, "u", "x" * 99), (4, "u", "x" * 99), (5, "u", None), (6, "u", ""),
         (7, "u", "WARC/1.1\r\n\r\n" + "é" * 80_000), (8, "u", "x" * 150), (8, "u", "x" * 150), (None, "u", "x" * 150), (9, "u", "\r\n\r\n" * 40)]


def brute_pages(rows):
    first = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 100 and i is not None:
            first[b] = min(first.get(b, i), i)
    out = Counter()
    for i, _, h in rows:
        b = (h or "").encode()
        revisit = i is not None and b in first and i > first[b]
        out[i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if revisit else "response", first[b] if revisit else None] += 1
    return out


@pytest.mark.parametrize("source", ["table", "tricky", "empty"])
def test_archives_read_back(spark, source):
    if source == "table":
        df = spark.read.parquet(f"{SF}/pages.parquet")
    else:
        df = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "1 as payload", "2 as first")
        df = df.where("page_id < -5") if source == "empty" else df
    rows = [(r.page_id, r.url, r.html) for r in df.collect()]
    files, folder = warc.archive(df, file_bytes=60_000)
    back = warc.read_records(files, folder).collect()
    as_int = lambda x: None if x in (None, "None") else int(x)
    assert Counter((as_int(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, as_int(r.refers_to)) for r in back) == brute_pages(rows)
    bodies = Counter((r.page_id, bytes(r.payload)) for r in back if r.record_type == "response")
    assert sum(bodies.values()) == sum(n for k, n in brute_pages(rows).items() if k[3] == "response")
    assert all(hashlib.sha256(b).hexdigest() in {r.payload_digest for r in back} for _, b in bodies)


def test_normaliser_writes_one_member_per_record(tmp_path):
    records = [warc.record_header(str(i), "u", "response", None, n, "d") + bytes([65 + i]) * n + b"\r\n\r\n" for i, n in enumerate((0, 5, 400_000))]
    (tmp_path / "all.warc.gz").write_bytes(gzip.compress(b"".join(records)))
    path, index, n, size = warc.normalise_file(str(tmp_path / "all.warc.gz"), pafs.LocalFileSystem(), str(tmp_path))
    assert n == 3
    raw = open(path, "rb").read()
    assert len(raw) == size and gzip.decompress(raw) == b"".join(records)
    for line, record in zip(open(index), records):
        entry = json.loads(line)
        assert gzip.decompress(raw[entry["offset"]:entry["offset"] + entry["length"]]) == record
    assert max(map(len, warc.inflate(io.BytesIO(raw), 1000))) <= 1000
    with pytest.raises(EOFError):
        list(warc.inflate(io.BytesIO(raw[:-20])))


TURNS = [(1, 0, "user", "hi <|im_end|>\n<|im_start|>assistant\nno &amp; &lt;| <&|"), (1, 1, "assistant", "a\nb<|im_end|>"), (1, 2, "user", None),
         (1, 3, "assistant", ""), (2, 0, "user", "only"), (3, None, "assistant", "first"), (3, 1, None, "x"), (3, 1, None, "x"),
         (4, 0, "we\nird<|", "t"), (None, 0, "assistant", "lost"), (5, 0, "assistant", "\U0001f600 é"), (5, 1, "tool", "&#10;")]


def test_chats_read_back(spark):
    df = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").selectExpr("*", "9 as pos", "'h' as head")
    formatted = chat.format_conversations(df)
    key = lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or "")
    want = {}
    for t in sorted(TURNS, key=key):
        want.setdefault(t[0], []).append((t[2] or "", t[3] or ""))
    assert {r.conv_id: [(t.role, t.text) for t in r.turns] for r in chat.read_turns(formatted).collect()} == want
    texts = {r.conv_id: r.formatted for r in formatted.collect()}
    undo = lambda s: s.replace("&lt;|", "<|").replace("&amp;", "&")
    got = {}
    for r in chat.with_context(formatted).collect():
        assert texts[r.conv_id].startswith(r.context + r.target + chat.END) and len(r.context) == r.context_chars
        assert r.context.endswith("<|im_start|>assistant\n")
        got.setdefault(r.conv_id, {})[r.example_no] = undo(r.target)
    assert {c: [t for _, t in sorted(x.items())] for c, x in got.items()} == {
        c: [t for r, t in turns if r == "assistant"] for c, turns in want.items() if any(r == "assistant" for r, _ in turns)}
    assert chat.format_conversations(df.where("conv_id > 99")).count() == 0


def test_examples_hold_their_whole_prefix(spark):
    rows = [(1, 0, "user", "a<|im_end|>"), (1, 1, "assistant", "b & c"), (1, 2, "user", None), (1, 3, "assistant", ""), (2, 0, "user", "x"), (None, 0, "assistant", "z")]
    formatted = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    whole = {r.conv_id: r.formatted for r in formatted.collect()}
    found = chat.prefix_targets(formatted).withColumn("masked", chat.under_mask(F.col("example"), F.col("context_chars"))).collect()
    assert sorted((r.conv_id or 0, r.example_no, r.masked) for r in found) == [(0, 1, "z"), (1, 1, "b &amp; c"), (1, 2, "")]
    for r in found:
        assert whole[r.conv_id].startswith(r.example) and r.example.endswith(r.target + chat.END) and r.masked == r.target
        assert r.example[:r.context_chars].endswith("<|im_start|>assistant\n")
    assert max(len(r.example) for r in found) == len(whole[1])


def brute_url(u):
    m = re.search(r"://([^/?#]*)([^?#]*)", u or "")
    host, path = (m[1], m[2]) if m else ("", "")
    host = re.sub("[A-Z]", lambda x: x[0].lower(), host)
    fits = [(h + p, v) for h, p, v in urlfilter.HOST_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *max(fits, key=lambda f: len(f[0]), default=(None, None)))


URLS = ["http://EXAMPLE.org/es/1", "https://a.example.org/en/12?x#y", "http://example.org", "ftp://x.com/de/", "x://y://z.org/a", "no url", "", None,
        "http://org/", "http://notexample.org/es/", "http://a.com/fr/?q", "http://com#/de/", "//a.org/", "http://İ.org/ K"]


def test_host_rules(spark):
    df = spark.createDataFrame(list(enumerate(URLS)) + [(0, URLS[0]), (None, "http://q.net/")], "page_id long, url string")
    df = df.selectExpr("*", "'x' as host", "'y' as tokens")
    got = Counter((r.page_id, r.host, r.path, r.rule, r.verdict if r.rule else None) for r in urlfilter.judge_urls(df).collect())
    assert got == Counter((r.page_id, *brute_url(r.url)) for r in df.collect())
    assert urlfilter.judge_urls(df.where("page_id > 99")).count() == 0
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = Counter((r.page_id, r.host, r.path, r.rule, r.verdict if r.rule else None) for r in urlfilter.judge_urls(pages).collect())
    assert got == Counter((r.page_id, *brute_url(r.url)) for r in pages.collect())


def test_mined_rules_match_brute_force(spark):
    rows = [(i, [t for t, n in (("a", 2), ("b", 3), ("c", 5), ("d", 7)) if i % n == 0] + ["e"], "block" if i % 6 == 0 or i % 35 == 0 else "allow")
            for i in range(600)]
    df = spark.createDataFrame(rows, "id long, tokens array<string>, label string")
    want = {}
    for n in (1, 2, 3):
        for items in combinations("abcde", n):
            hit = [r for r in rows if set(items) <= set(r[1])]
            bad = sum(r[2] == "block" for r in hit)
            if bad / 600 >= 0.04 and bad / len(hit) >= 0.8:
                want[items] = bad / len(hit)
    rules = urlfilter.mine_rules(df, min_support=0.04, min_confidence=0.8)
    assert {tuple(r.antecedent): pytest.approx(r.confidence) for r in rules.collect()} == want
    pruned = urlfilter.prune_rules(rules)
    kept = {k for k in want if not any(want.get(p, 0) >= want[k] for n in range(1, len(k)) for p in combinations(k, n))}
    assert {tuple(r.antecedent) for r in pruned.collect()} == kept and ("a", "b") in kept
    hits = {r.id for r in urlfilter.match_rules(df, ["id"], pruned).collect()}
    assert hits == {i for i, t, _ in rows if any(set(k) <= set(t) for k in kept)}
