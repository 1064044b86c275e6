"""Stages one by one against plain rules, and the whole run."""
import numpy as np

import corpus_pipeline
from tessera.llm import decontam, neardup, quality, queries, secrets

SF = "/root/testdata/sf0.001"


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_follow_their_operators(spark, documents):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "near_duplicates", "decontamination", "secret_scan", "packing"]
    good = stages["quality_rules"](spark, documents, SF)
    assert good.columns == documents.columns
    judged = quality.quality_rules(documents, *queries.vocabularies())
    assert ids(good) == ids(judged.where("kept"))
    good = good.cache()
    one = stages["near_duplicates"](spark, good, SF)
    assert one.columns == documents.columns
    assert ids(one) == ids(neardup.near_duplicates(good, shingle=5).where("kept"))
    one = one.cache()
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    clean = stages["decontamination"](spark, one, SF)
    assert clean.columns == documents.columns
    assert ids(clean) == ids(decontam.match_benchmark(one, items).where("n_hit = 0 or 20 * n_hit < n_words"))
    clean = clean.cache()
    safe = stages["secret_scan"](spark, clean, SF)
    assert safe.columns == documents.columns and ids(safe) == ids(clean)
    before, after = ({r.doc_id: r for r in df.collect()} for df in (clean, safe))
    found = {r.doc_id: r.spans for r in secrets.find_secrets(clean).collect()}
    for i, r in after.items():
        assert (r.text == before[i].text) == (not found[i]) and r.n_chars == len(r.text)
    pieces = stages["packing"](spark, safe, SF).collect()
    assert {p.doc_id for p in pieces} == set(after)


def test_run(spark):
    pieces = corpus_pipeline.run(spark, SF).collect()
    used = {}
    for p in pieces:
        used[p.sequence_id] = used.get(p.sequence_id, 0) + p.length
        assert len(np.frombuffer(bytes(p.ids), "<u4")) == p.length
    assert pieces and max(used.values()) <= 2048


def test_stages_on_awkward_rows(spark, tricky, nothing):
    for df in (tricky, nothing):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, df, SF)
            assert out.columns == df.columns, name
            n = out.count()
            assert n == 0 if name == "quality_rules" and df is nothing else n <= df.count()
        corpus_pipeline.STAGES[-1][1](spark, df, SF).count()
