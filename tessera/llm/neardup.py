"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its word shingles; documents with Jaccard similarity at or above a
limit are linked, and components of links are groups.

1. Signatures.  ``COORDS`` minwise tokens per distinct set (equal sets are one vertex from
   here on, so exact copies never meet each other again).
2. Trees.  In each of ``TREES`` independent trees a document starts at the root; every node it
   reaches selects one or two coordinates (1.25 on average, the inverse of the limit, so that
   a pair at the limit stays together in one child on average), and the document moves to
   the child of its token there.  The recursion goes as deep as ``log N / log 20`` levels, where
   unrelated documents part.
3. Stars.  In every node the document that shares most nodes with others is compared with
   all members: edges grow with the members, not with their square, and a group of thousands
   of copies of one text falls into one component at once.
4. Small nodes, and what is left of large ones, are compared exhaustively on signatures: every
   pair of different components that share a node, whose stars have not tried it.  A large node
   is dealt out in blocks of members.  A node reports members that have such a pair, not pairs: rows
   grow with the members of a group, however many of its pairs are close to the limit.
5. Links are confirmed on full sets: a star's pair by pair, the reported members' once for all nodes
   with the same main component, block by block, with one link for each two components that meet.
   Components by alternating large and small stars.

Sets and signatures are looked up through a bitmap of the ids asked for, so texts and vertices that no
one asks for are not shuffled.

A pair with similarity s stays together down to level k of a tree with probability
1 - q(k), q(0) = 0, q(i) = .75 (1 - s + s q) + .25 (1 - s + s q)**2; ``recall`` gives the chance
that at least one of the trees keeps it (at s = 0.8, 5 levels and 16 trees: 0.99999).
"""
from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .exchange import squeeze, streamed, unsqueeze
from .packing import _arrow_type
from .shared import stored
from .textbuf import RangeHasher, TextBuf, lean, mix64, slices

#: Minwise tokens: the first ``TREE_COORDS`` keep 16 bits and grow the trees, the others 8.
COORDS, TREE_COORDS, TREES = 512, 128, 16
SIG_BYTES = 2 * TREE_COORDS + COORDS - TREE_COORDS
#: Deviations below the limit at which a pair's share of agreeing coordinates rules it out (one
#: pair in 4,000 at the limit itself), and above it at which the pair counts as almost sure.
DEVIATIONS = 3.5
#: Members of a node that one task compares exhaustively, and shingles of these where it holds full sets.
NODE_BLOCK = 1024
NODE_SHINGLES = 1 << 20
#: Bits of the map of ids asked for (1 MB), in words that Spark's bitmap functions use.
ID_BITS, ID_WORD = 1 << 23, 1 << 15
STAR_BLOCKS = 32
_WORDS = RangeHasher(17, lower=True)
_U = np.uint64
_RNG = np.random.default_rng(128)
_A = _RNG.integers(0, 1 << 31, COORDS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _RNG.integers(0, 1 << 32, COORDS, dtype=np.uint32)


def shingle_sets(buf: TextBuf, k: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's ``k``-word shingles (A-Z lower-cased words
    between ASCII spaces; with fewer words, the whole sequence is the one shingle)."""
    starts, ends, firsts = buf.words()
    h = _WORDS.ranges(_WORDS.prefix(buf.data), starts, ends)
    n = max(len(h) - k + 1, 0)
    acc = h[:n].copy()
    for j in range(1, k):
        acc = mix64(acc) * _U(3) + h[j:n + j]
    acc = mix64(acc)
    out = []
    for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(acc[a:b - k + 1]))
        elif b > a:
            one = h[a:a + 1].copy()
            for j in range(a + 1, b):
                one = mix64(one) * _U(3) + h[j:j + 1]
            out.append(mix64(one + _U(b - a)))
        else:
            out.append(np.zeros(0, _U))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """The minwise token of each coordinate: 16 bits for the trees' ones, then 8."""
    x = (shingles >> _U(32)).astype(np.uint32)
    least = np.full(COORDS, 0xFFFFFFFF, dtype=np.uint32)
    for i in range(0, len(x), 512):
        np.minimum(least, (x[i:i + 512, None] * _A + _B).min(axis=0), out=least)
    mixed = least * np.uint32(0x9E3779B1)
    return np.concatenate([(mixed[:TREE_COORDS] >> np.uint32(16)).astype("<u2").view(np.uint8),
                           (mixed[TREE_COORDS:] >> np.uint32(24)).astype(np.uint8)])


def split_signatures(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """16-bit and 8-bit tokens of packed signatures, a row each."""
    whole = np.frombuffer(b"".join(raw), dtype=np.uint8).reshape(-1, SIG_BYTES)
    return np.ascontiguousarray(whole[:, :2 * TREE_COORDS]).view("<u2"), whole[:, 2 * TREE_COORDS:]


def deviation(percent: int, coords: int) -> float:
    s = percent / 100
    return math.sqrt(s * (1 - s) / coords)


def recall(s: float, depth: int, trees: int = TREES) -> float:
    q = 0.0
    for _ in range(depth):
        stay = 1 - s + s * q
        q = 0.75 * stay + 0.25 * stay ** 2
    return 1 - q ** trees


def chosen_paths(signatures: np.ndarray, depth: int, trees: int = TREES) -> tuple[np.ndarray, np.ndarray]:
    """Leaf nodes that each row of ``signatures`` reaches: row numbers and node ids."""
    rows, nodes = [], []
    for t in range(trees):
        row = np.arange(len(signatures))
        node = np.full(len(row), mix64(np.array([t + 1], dtype=_U))[0])
        for _ in range(depth):
            pick = mix64(node)
            first = (pick % _U(TREE_COORDS)).astype(np.int64)
            second = ((pick >> _U(20)) % _U(TREE_COORDS)).astype(np.int64)
            also = ((pick >> _U(40)) & _U(3) == 0) & (second != first)
            row = np.concatenate([row, row[also]])
            coord = np.concatenate([first, second[also]])
            node = np.concatenate([node, node[also]])
            node = mix64(node * _U(3) + (coord.astype(_U) << _U(16) | signatures[row, coord].astype(_U)))
        rows.append(row)
        nodes.append(node)
    return np.concatenate(rows), np.concatenate(nodes)


SETS = [("n_shingles", pa.int64()), ("hi", pa.int64()), ("lo", pa.int64()), ("sig", pa.binary())]


def signatures_of(docs: DataFrame, key: str, text: str, k: int) -> DataFrame:
    """``id, n_shingles, hi, lo`` (128-bit fingerprint of the set) and ``sig`` per document row."""
    schema = pa.schema([pa.field("id", _arrow_type(docs, key)), *[pa.field(*f) for f in SETS]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                sets = shingle_sets(TextBuf(part.column(1)), k)
                with np.errstate(over="ignore"):
                    hi = [int(mix64(s).sum(dtype=_U).view(np.int64)) if len(s) else None for s in sets]
                    lo = [int(mix64(s ^ _U(0xA5A5A5A5)).sum(dtype=_U).view(np.int64)) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(hi, pa.int64()),
                     pa.array(lo, pa.int64()),
                     pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary())], schema=schema)

    kind = dict(docs.dtypes)[key]
    return docs.select(F.col(key).alias("id"), F.col(text).alias(text)).mapInArrow(
        lean(run), f"id {kind}, n_shingles long, hi long, lo long, sig binary")


def tree_nodes(vertices: DataFrame, depth: int, kind: str) -> DataFrame:
    """``node, id, n`` for every leaf that a vertex reaches."""
    schema = pa.schema([("node", pa.int64()), pa.field("id", _arrow_type(vertices, "id")), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                row, node = chosen_paths(split_signatures(part.column(2).to_pylist())[0], depth)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node.view(np.int64)), part.column(0).take(take), part.column(1).take(take)], schema=schema)

    return vertices.select("id", "n", "sig").mapInArrow(lean(run), f"node long, id {kind}, n long")


def asked_for(df: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ``id`` is among ``ids``, and a few others: ids are marked in a bitmap of
    fixed size, which travels to the rows, so the others need not be shuffled to be told apart."""
    slot = F.pmod(F.xxhash64("id"), F.lit(ID_BITS))
    marks = ids.select(slot.alias("_at")).groupBy(F.floor(F.col("_at") / ID_WORD).alias("_word")).agg(
        F.bitmap_construct_agg(F.col("_at") % ID_WORD).alias("_bits"))
    byte = F.expr(f"cast(conv(hex(substring(_bits, cast(_at % {ID_WORD} div 8 as int) + 1, 1)), 16, 10) as int)")
    return (df.withColumn("_at", slot).withColumn("_word", F.floor(F.col("_at") / ID_WORD)).join(F.broadcast(marks), "_word")
            .where(F.getbit(byte, (F.col("_at") % 8).cast("int")) == 1).select(*df.columns))


def full_sets(docs: DataFrame, ids: DataFrame, key: str, text: str, k: int, kind: str) -> DataFrame:
    """``id, set`` (squeezed) of every document row asked for by ``ids``, and of a few others."""
    set_schema = pa.schema([pa.field("id", _arrow_type(docs, key)), ("set", pa.binary())])

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(TextBuf(part.column(1)), k)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([squeeze(s, True) for s in sets], pa.binary())], schema=set_schema)

    texts = asked_for(docs.select(F.col(key).alias("id"), F.col(text).alias("text")), ids)
    return stored(texts.mapInArrow(lean(to_sets), f"id {kind}, set binary"), "neardup-sets")


def likely(pairs: DataFrame, vertices: DataFrame, least: float, kind: str) -> DataFrame:
    """Pairs ``a, b`` whose signatures agree in a share ``least`` of coordinates."""
    sig = asked_for(vertices.select("id", "sig"), pairs.select(F.col("a").alias("id")).union(pairs.select("b")))
    both = (pairs.join(sig.withColumnsRenamed({"id": "a", "sig": "sa"}), "a")
            .join(sig.withColumnsRenamed({"id": "b", "sig": "sb"}), "b").select("a", "b", "sa", "sb"))
    id_type = _arrow_type(pairs, "a")
    schema = pa.schema([pa.field("a", id_type), pa.field("b", id_type)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                (x, p), (y, q) = (split_signatures(c.to_pylist()) for c in batch.columns[2:])
                ok = pa.array((x == y).sum(axis=1) + (p == q).sum(axis=1) >= least * COORDS)
                yield pa.RecordBatch.from_arrays(batch.columns[:2], schema=schema).filter(ok)

    return both.mapInArrow(lean(run), f"a {kind}, b {kind}").distinct()


def confirmed(pairs: DataFrame, docs: DataFrame, key: str, text: str, k: int, percent: int, kind: str) -> DataFrame:
    """Pairs whose full sets have 100 * intersection >= percent * union.

    The set of ``a`` is sent once per block of its partners, that of ``b`` once per pair; only
    documents that occur in a pair are read into sets.
    """
    id_type = _arrow_type(docs, key)
    sets = full_sets(docs, pairs.select(F.col("a").alias("id")).union(pairs.select("b")), key, text, k, kind)
    dealt = pairs.withColumn("block", F.pmod(F.xxhash64("b"), F.lit(STAR_BLOCKS)))
    heads = (dealt.select("a", "block").distinct().join(sets.withColumnRenamed("id", "a"), "a")
             .select("a", "block", F.lit(None).cast(kind).alias("b"), "set", F.lit(0).alias("turn")))
    rest = (dealt.join(sets.withColumnRenamed("id", "b"), "b")
            .select("a", "block", "b", "set", F.lit(1).alias("turn")))
    schema = pa.schema([pa.field("a", id_type), pa.field("b", id_type)])

    def run(rows: Iterator[dict]) -> Iterator[tuple]:
        at, own = None, []
        for row in rows:
            if row["turn"] == 0:
                if at != (row["a"], row["block"]):
                    at, own = (row["a"], row["block"]), []
                own.append(unsqueeze(row["set"]))  # several where rows share an id
            else:
                other = unsqueeze(row["set"])
                for mine in own:
                    common = len(np.intersect1d(mine, other, assume_unique=True))
                    if 100 * common >= percent * (len(mine) + len(other) - common):
                        yield row["a"], row["b"]
                        break

    return streamed(heads.unionByName(rest), ["a", "block"], ["a", "block", "turn"], run,
                    f"a {kind}, b {kind}", schema, 2000).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` (smallest id reachable) for every id of ``edges`` (``a, b``), by
    alternating large and small stars until nothing changes; every round is stored."""
    e = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    seen = None
    while True:
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .union(low.where("m < u")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .union(low).distinct()
        e = stored(small, "cc")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("id"), F.col("v").alias("component"))


def star_pairs(nodes: DataFrame, ratio: float) -> DataFrame:
    """In each node, the member that shares most nodes with others, paired with every member
    of fitting size."""
    degree = nodes.groupBy("id").agg(F.sum("size").alias("degree"))
    ranked = nodes.join(degree, "id")
    hub = ranked.groupBy("node").agg(F.max_by(F.struct(F.col("id").alias("a"), F.col("n").alias("na")),
                                              F.struct("degree", F.xxhash64("id"))).alias("hub"))
    return (nodes.join(hub, "node").select(F.col("hub.a").alias("a"), F.col("id").alias("b"), F.col("hub.na").alias("na"), "n")
            .where((F.col("a") != F.col("b")) & (F.least("na", "n") >= ratio * F.greatest("na", "n")))
            .select("a", "b").distinct())


def in_blocks(rows: DataFrame, place: str, heavy: bool) -> DataFrame:
    """``rows`` (``place, id, n, label, is_main``) dealt by ``place, what, x, y``: each member of a place meets
    all members of other labels.

    The members of the main label need not meet each other, the others meet all; both are dealt into
    blocks of about ``NODE_BLOCK`` members (and, if ``heavy``, ``NODE_SHINGLES`` shingles), and a task holds two
    blocks at most.
    """
    of = lambda main, x: F.coalesce(F.sum(F.when(F.col("is_main") == main, x)), F.lit(0))
    sizes = rows.groupBy(place).agg(*[of(main, x).alias(name) for name, main, x in (
        ("c_main", True, F.lit(1)), ("c_rest", False, F.lit(1)), ("w_main", True, F.col("n")), ("w_rest", False, F.col("n")))])
    blocks = lambda c, w: F.greatest(F.lit(1), F.ceil(c / F.lit(NODE_BLOCK)), F.ceil(
        (w if heavy else F.lit(0)) / F.lit(NODE_SHINGLES))).cast("int")
    n_main, n_rest = blocks(F.col("c_main"), F.col("w_main")), blocks(F.col("c_rest"), F.col("w_rest"))
    small = blocks(F.col("c_main") + F.col("c_rest"), F.col("w_main") + F.col("w_rest")) == 1
    mine = F.pmod(F.xxhash64("id"), F.when(F.col("is_main"), n_main).otherwise(n_rest).cast("long")).cast("int")
    count_up = lambda n: F.sequence(F.lit(0), n - 1)
    put = lambda x, y, what: F.struct(F.lit(what).alias("what"), x.alias("x"), y.alias("y"))
    puts = F.when(small, F.array(put(F.lit(0), F.lit(0), 0))).when(
        F.col("is_main"), F.transform(count_up(n_rest), lambda j: put(F.col("mine"), j, 1))).otherwise(F.concat(
            F.transform(count_up(n_main), lambda i: put(i, F.col("mine"), 1)),
            F.transform(count_up(n_rest), lambda j: put(F.least(j, F.col("mine")), F.greatest(j, F.col("mine")), 2))))
    return (rows.join(sizes, place).withColumn("mine", mine).select(*rows.columns, F.explode(puts).alias("p"))
            .select(*rows.columns, "p.what", "p.x", "p.y"))


def by_block(compared: Callable[[list[dict]], Iterator[tuple]], place: str) -> Callable[[Iterator[dict]], Iterator[tuple]]:
    """Collects the sorted rows of each block and hands them to ``compared``."""

    def run(rows: Iterator[dict]) -> Iterator[tuple]:
        at, group = None, []
        for row in rows:
            here = (row[place], row["what"], row["x"], row["y"])
            if here != at:
                yield from compared(group) if len(group) > 1 else ()
                at, group = here, []
            group.append(row)
        yield from compared(group) if len(group) > 1 else ()

    return run


def met_members(nodes: DataFrame, labels: DataFrame, vertices: DataFrame, percent: int, kind: str) -> DataFrame:
    """``main, id, n, label`` of members that share a node with a member of another component whose signature
    says that they may be similar enough; ``main`` is the node's largest component.

    A node whose members are in one component needs no more work, nor does one of two members:
    they were a star.
    """
    labelled = (nodes.join(labels, "id", "left")
                .select("node", "id", "n", "size", F.coalesce("component", "id").alias("label")).where("size > 2"))
    per_label = labelled.groupBy("node", "label").agg(F.count(F.lit(1)).alias("c"))
    per_node = per_label.groupBy("node").agg(
        F.count(F.lit(1)).alias("labels"), F.max_by("label", F.struct("c", "label")).alias("main")).where("labels > 1")
    rows = labelled.join(per_node.select("node", "main"), "node").select(
        "node", "id", "n", "label", "main", (F.col("label") == F.col("main")).alias("is_main"))
    sig = asked_for(vertices.select("id", "sig"), rows.select("id"))
    dealt = in_blocks(rows, "node", False).drop("is_main").join(sig, "id")
    id_type = _arrow_type(vertices, "id")
    schema = pa.schema([pa.field("main", id_type), pa.field("id", id_type), ("n", pa.int64()), pa.field("label", id_type)])
    limit = percent / 100 - DEVIATIONS * deviation(percent, COORDS)
    least, rough = limit * COORDS, (limit - 5 * deviation(percent, TREE_COORDS)) * TREE_COORDS

    def compared(group: list[dict]) -> Iterator[tuple]:
        wide, narrow = split_signatures([r["sig"] for r in group])
        n = np.array([r["n"] for r in group])
        _, label = np.unique([r["label"] for r in group], return_inverse=True)
        met = np.zeros(len(group), bool)
        for i in range(len(group) - 1):
            rest = n[i + 1:]
            other = i + 1 + np.flatnonzero((label[i + 1:] != label[i])
                                           & (100 * np.minimum(rest, n[i]) >= percent * np.maximum(rest, n[i])))
            if len(other):
                agree = (wide[other] == wide[i]).sum(axis=1)
                other, agree = other[agree >= rough], agree[agree >= rough]
            if len(other):
                agree = agree + (narrow[other] == narrow[i]).sum(axis=1)
                other = other[agree >= least]
                met[other] = True
                met[i] |= len(other) > 0
        for i in np.flatnonzero(met).tolist():
            yield tuple(group[i][c] for c in ("main", "id", "n", "label"))

    order = ["node", "what", "x", "y"]
    return streamed(dealt, order, order, by_block(compared, "node"),
                    f"main {kind}, id {kind}, n long, label {kind}", schema, 5000).distinct()


def links_between(met: DataFrame, docs: DataFrame, key: str, text: str, k: int, percent: int, kind: str) -> DataFrame:
    """Links ``a, b`` between the components of ``met``: in each block, as many as join those that have
    members with 100 * intersection >= percent * union of the full sets."""
    sets = full_sets(docs, met.select("id"), key, text, k, kind)
    rows = met.withColumn("is_main", F.col("label") == F.col("main"))
    dealt = in_blocks(rows, "main", True).drop("n").join(sets, "id")
    id_type = _arrow_type(docs, key)
    schema = pa.schema([pa.field("a", id_type), pa.field("b", id_type)])

    def compared(group: list[dict]) -> Iterator[tuple]:
        sets = [unsqueeze(r["set"]) for r in group]
        n = np.array([len(s) for s in sets])
        ends = np.cumsum(n)
        owner = np.repeat(np.arange(len(group)), n)
        _, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        holders, first = owner[np.argsort(token, kind="stable")], np.cumsum(count) - count
        _, label = np.unique([r["label"] for r in group], return_inverse=True)
        parent = list(range(int(label.max()) + 1))

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for i, r in enumerate(group):
            if r["is_main"]:
                continue
            mine = token[ends[i] - n[i]:ends[i]]
            common = np.zeros(len(group), np.int64)
            for part in np.array_split(mine, len(mine) * len(group) // (1 << 20) + 1):
                many = count[part]
                at = np.arange(many.sum()) + np.repeat(first[part] - (np.cumsum(many) - many), many)
                common += np.bincount(holders[at], minlength=len(group))
            linked = (label != label[i]) & (100 * common >= percent * (n + n[i] - common))
            for j in np.flatnonzero(linked).tolist():
                x, y = root(label[i]), root(label[j])
                if x != y:
                    parent[x] = y
                    yield r["id"], group[j]["id"]

    order = ["main", "what", "x", "y"]
    return streamed(dealt, order, order, by_block(compared, "main"), f"a {kind}, b {kind}", schema, 5000)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80,
                    trees: int = TREES) -> DataFrame:
    """Per document row: ``doc_id, n_shingles, component_id`` (smallest id of its group), ``kept``.

    Texts without words (null, empty, spaces) have no set, are linked with nothing and kept.
    Rows are vertices by their sets: equal sets are one vertex under their smallest id, so
    repeated rows share a group (and rows that repeat the smallest id are all kept).  Rows
    with a null id join the group of their set; a set that only null ids have is its own
    group with a null id, kept.  Other columns are ignored; empty tables give no rows.
    """
    kind = dict(docs.dtypes)[key]
    rows = stored(signatures_of(docs, key, text, shingle), "neardup-signatures")
    classes = stored(rows.where("n_shingles > 0").groupBy("hi", "lo").agg(
        F.min("id").alias("id"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig")), "neardup-classes")
    vertices = classes.where("id is not null").select("id", "n", "sig")
    count = vertices.count()
    depth = max(2, math.ceil(math.log(max(count, 2)) / math.log(20)))
    ratio, least = percent / 100, percent / 100 - DEVIATIONS * deviation(percent, COORDS)
    reached = tree_nodes(vertices, depth, kind)
    sizes = reached.groupBy("node").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    nodes = stored(reached.join(sizes, "node"), "neardup-nodes")
    stars = stored(likely(star_pairs(nodes, ratio), vertices, least, kind), "neardup-stars")
    links = stored(confirmed(stars, docs, key, text, shingle, percent, kind), "neardup-links")
    groups = components(links)
    met = stored(met_members(nodes, groups, vertices, percent, kind), "neardup-met")
    links = stored(links.unionByName(links_between(met, docs, key, text, shingle, percent, kind)), "neardup-links")
    groups = components(links)
    named = (classes.select("hi", "lo", "id").join(groups, "id", "left")
             .select("hi", "lo", F.coalesce("component", "id").alias("component")))
    out = rows.select("id", "n_shingles", "hi", "lo").join(named, ["hi", "lo"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(key), "n_shingles", component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """One row (all columns) of each group: that of the smallest id, null ids last, and any one of
    several rows with that id.  Rows are told apart by a number written once, unless their
    ids do that already."""
    odd = docs.groupBy(F.col(key).alias("id")).count().where("id is null or count > 1")
    if odd.isEmpty():
        gone = near_duplicates(docs, key, text, **kw).where("not kept").select(key)
        return docs.join(gone, key, "left_anti").select(*docs.columns)
    numbered = stored(docs.select(F.monotonically_increasing_id().alias("_row"),
                                  F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")), "neardup-rows")
    field = F.col("_doc").getField
    groups = near_duplicates(numbered.select("_row", field(text).alias("text")), "_row", "text", **kw)
    ids = numbered.select("_row", field(key).alias("id"))
    least = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "_row")).alias("least")
    first = groups.join(ids, "_row").groupBy("component_id").agg(least).select("least._row")
    return numbered.join(first, "_row", "left_semi").select("_doc.*")
