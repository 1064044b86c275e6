"""Merkle proofs and fill-in-the-middle against plain Python."""
import hashlib
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tessera.llm import fim, merkle, queries

FAN = 16


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def plain_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + FAN]) for i in range(0, len(levels[-1]), FAN)])
    return levels


def plain_proofs(rows):
    """rows: (key, group, leaf); per row (key, leaf, subroot, root, steps)."""
    trees = {}
    for key, group, leaf in rows:
        trees.setdefault(group, []).append(((key is not None, key or 0), leaf, key))
    order = sorted(trees, key=lambda g: (g is not None, (g or "").encode()))
    levels = {g: plain_levels([x[1] for x in sorted(trees[g], key=lambda x: x[:2])]) for g in order}
    top = plain_levels([levels[g][-1][0] for g in order])
    out = []
    for t, g in enumerate(order):
        for p, (_, leaf, key) in enumerate(sorted(trees[g], key=lambda x: x[:2])):
            steps = []
            for tree, at in ((levels[g], p), (top, t)):
                for level in tree[:-1]:
                    run = at // FAN * FAN
                    steps.append(("".join(level[run:at]), "".join(level[at + 1:run + FAN])))
                    at //= FAN
            out.append((key, leaf, levels[g][-1][0], top[-1][0], tuple(steps)))
    return out


def proven(df, **kw):
    manifest = merkle.build_manifest(df, merkle.leaf_digest(F.col("doc_id"), F.col("text")), **kw)
    return merkle.prove(manifest).collect()


def case(name):
    rows = {
        "mixed": [(i, "hot", f"text {i % 7}") for i in range(300)] + [(i * 3, None, "null group") for i in range(17)]
        + [(5, "é", "alone")] + [(i, "", "same") for i in range(16)] + [(None, "z", None), (None, "z", ""), (7, "z", "x"), (7, "z", "x")],
        "groups": [(i, f"s{i % 290}", "t") for i in range(600)],
        "one group": [(i, "a", "t") for i in range(40)],
        "one run": [(i, "a", "t") for i in range(3)],
        "one row": [(1, "a", None)],
        "none": [],
    }[name]
    return [Row(doc_id=i, source=s, text=t, t=1, n="x", p=None, digest=b"", key=2, g="g") for i, s, t in rows]


@pytest.mark.parametrize("name", ["mixed", "groups", "one group", "one run", "one row", "none"])
def test_proofs_by_definition(spark, name):
    rows = case(name)
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, t int, n string, p int, digest binary, key int, g string")
    want = plain_proofs([(r.doc_id, r.source, h(plain_field(r.doc_id), plain_field(r.text))) for r in rows])
    got = proven(df.repartition(5))
    assert Counter((r.key, r.leaf, r.subroot, r.root, tuple((s.before, s.after) for s in r.proof)) for r in got) == Counter(want)
    assert all(r.folded == r.root for r in got)


def test_a_changed_row_is_noticed(spark):
    df = spark.createDataFrame(case("mixed")[:317], "doc_id long, source string, text string, t int, n string, p int, digest binary, key int, g string")
    claim = F.when(F.col("doc_id") % 5 == 0, merkle.leaf_digest(F.col("doc_id"), F.concat("text", F.lit("!"))))
    for r in proven(df, claim=claim):
        assert (r.folded == r.root) == (r.key % 5 != 0)


def test_fields_cannot_run_into_each_other(spark):
    row = spark.range(1).select(merkle.leaf_digest(F.lit("a"), F.lit(None).cast("string"), F.lit("é-")).alias("x")).first()
    assert row.x == h("1:a", "-", "3:é-")


def test_op11_on_whole_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def leaf(r, text):
        return h(*[plain_field(v) for v in (r.doc_id, r.source, r.lang, r.n_chars, text)])

    want = {}
    byid = {r.doc_id: r for r in docs}
    for key, own, sub, root, steps in plain_proofs([(r.doc_id, r.source, leaf(r, r.text)) for r in docs]):
        r = byid[key]
        changed = zlib.crc32(str(key).encode()) % 5 == 0 and r.text is not None
        acc = leaf(r, r.text.translate(lower)) if changed else own
        for before, after in steps:
            acc = h(before, acc, after)
        want[key] = (own, sub, root, h(*["".join(s) for s in steps]), acc, acc == root)
    got = queries.QUERIES["op11_pointer_jumping_merkle_proofs"](spark, "/root/testdata/sf0.001")
    assert {r.doc_id: (r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in got.collect()} == want
    assert {w[-1] for w in want.values()} == {True, False}


PLAIN_UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_fim(key, text, seed=42, rate=50, spm=80):
    t = text or ""
    units = PLAIN_UNIT.findall(t)
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k:8 * k + 8], 16) for k in range(4))
    n = len(units)
    if t == "" or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, t
    lo, hi = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
    if h4 % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("source", ["documents", "tricky", "nothing"])
@pytest.mark.parametrize("spm", [0, 80])
def test_fim_by_definition(request, source, spm):
    df = request.getfixturevalue(source)
    made = fim.fill_in_middle(df, fim_percent=100, spm_percent=spm)
    assert [c for c in made.columns if c != "fim"] == df.columns
    back = fim.restore(F.col("fim.output"), F.col("fim.form"))
    got = made.select("doc_id", "text", "fim.*", back.alias("back")).collect()
    assert len(got) == df.count()
    for r in got:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_fim(r.doc_id, r.text, rate=100, spm=spm)
        assert r.back == (r.text or "")


def test_fim_marks_stay_plain_and_borders_do_not_confuse(spark):
    texts = ["a <P> b", "x<S>", "<M>", "a <P < b <S", "<", "< < < <", "P> S> M>", "a <<P", " \t", "w " * 3, "\x00 \x1f\x85  é"]
    df = spark.createDataFrame([(i, t) for i in range(40) for t in texts], "doc_id long, text string")
    made = fim.fill_in_middle(df, fim_percent=100, spm_percent=50)
    for r in made.select("doc_id", "text", "fim.*", fim.restore(F.col("fim.output"), F.col("fim.form")).alias("back")).collect():
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_fim(r.doc_id, r.text, rate=100, spm=50)
        assert r.back == r.text and (r.form == "plain") == any(m in r.text for m in ("<P>", "<S>", "<M>"))


def test_one_match_gives_every_end():
    import regex
    pattern = regex.compile(f"({fim.UNIT})*+")
    for t in ["", " ", "a", " a", "a ", "a  b\n", "\n\n", "a b" * 100_000 + " " * 100_000]:
        assert fim.token_ends(pattern, t) == [m.end() for m in PLAIN_UNIT.finditer(t)]


def test_op12_draws_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = queries.QUERIES["op12_repeated_capture_fim"](spark, "/root/testdata/sf0.001").collect()
    want = {r.doc_id: plain_fim(r.doc_id, r.text) for r in docs}
    assert {r.doc_id: (r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256) for r in got} == {
        k: (*v[:4], h(v[4])) for k, v in want.items()}
    assert {r.doc_id: r.restored_sha256 for r in got} == {r.doc_id: h(r.text or "") for r in docs}
