"""What a Python worker holds while it runs a stage of the pipeline, and after it."""
import gc
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from tessera.llm import decontam, neardup, packing, quality, queries, secrets, textbuf, wordtok

MB = 1 << 20
RNG = np.random.default_rng(3)
WORDS = np.array(["".join(map(chr, RNG.integers(97, 123, n))) for n in RNG.integers(2, 12, 3000)])
STAGES = {
    "quality_rules": lambda df: quality.quality_rules(df, *queries.vocabularies()),
    "near_duplicates": lambda df: neardup.signatures_of(df, "doc_id", "text", 5),
    "decontamination": lambda df: decontam._match(df, decontam._automaton([("a", [1, 2, 3])], 2), "doc_id", "text", ()),
    "secret_scan": lambda df: secrets.scan(df, "doc_id", "text", ()),
    "packing": lambda df: packing.pack_documents(df, public_tokenizers.path("word_bpe_49k.json"), with_ids=False),
}


@pytest.mark.parametrize("stage", STAGES)
def test_stage_in_a_worker(spark, monkeypatch, stage):
    df = spark.createDataFrame([], "doc_id long, text string, lang string")
    handed = []
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, run, ddl: handed.append((run, self.columns)) or self)
    STAGES[stage](df)
    run, columns = handed[0]
    texts = [" ".join(RNG.choice(WORDS, 500)) for _ in range(2400)]  # 8 MB, as a batch of Spark's holds
    table = {"doc_id": pa.array(range(len(texts))), "id": pa.array(range(len(texts))), "text": pa.array(texts),
             "lang": pa.array(["en"] * len(texts))}
    batch = pa.RecordBatch.from_pydict({c: table[c] for c in columns})
    list(run(iter([batch.slice(0, 5)])))  # loads what is loaded once
    gc.collect()
    tracemalloc.start()
    rows = sum(out.num_rows for out in run(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows >= len(texts)
    assert peak < 80 * MB
    for hasher in (wordtok._HASH, wordtok._LOWER_HASH, neardup._WORDS, decontam._HASH):
        assert len(hasher._pow) == len(hasher._inv) == 1


def test_hashes_after_giving_back():
    hasher = textbuf.RangeHasher(7)
    data = np.frombuffer(b"one two one", np.uint8)
    ranges = np.array([0, 8]), np.array([3, 11])
    before = hasher.ranges(hasher.prefix(data), *ranges)
    textbuf.give_back()
    assert len(hasher._pow) == 1
    assert before.tolist() == hasher.ranges(hasher.prefix(data), *ranges).tolist() and before[0] == before[1]
