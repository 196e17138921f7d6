"""The whole pipeline against brute force, stage by stage."""

from collections import Counter

import duckdb

import corpus_pipeline
from medstar.llm import decontaminate, mixing, toxicity_zstd
from medstar.llm.common import table
from tests.llm.test_llm_operators import SF, brute_classes


def test_pipeline_equals_brute_force(spark):
    docs = table(spark, SF, "documents")
    rows = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY 1").fetchall())
    items = [decontaminate.normal(t) for _, t in duckdb.sql(
        f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()]
    model = toxicity_zstd.fit_toxicity(docs, table(spark, SF, "labels"))
    scores = model.scores(list(rows.values()))
    left = [i for i, s in zip(rows, scores) if s < toxicity_zstd.THRESHOLD]
    classes = brute_classes([rows[i] for i in left])
    left = [i for k, i in enumerate(left) if classes[k] == k]
    masks = [(decontaminate.masks(p), len(p)) for p in items]
    left = [i for i in left if not any(
        decontaminate.myers(m, n, decontaminate.normal(rows[i]))[0] <= decontaminate.budget(n)
        for m, n in masks)]
    assert 100 < len(left) < len(rows)
    mixed = Counter(r["doc_id"] for r in mixing.mix(docs.filter(docs.doc_id.isin(left))).collect())
    assert set(mixed) == set(left)
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == [*docs.columns, "shard"]
    out = got.collect()
    assert Counter(r["doc_id"] for r in out) == mixed
    assert all(r["text"] == rows[r["doc_id"]] for r in out)
    sizes = Counter()
    for r in out:
        sizes[r["shard"]] += len((r["text"] or "").encode()) + 1
    assert sorted(sizes) == list(range(corpus_pipeline.SHARDS))
    assert max(sizes.values()) < 1.5 * min(sizes.values())
    # copies of a document share a shard
    assert all(len({r["shard"] for r in out if r["doc_id"] == i}) == 1 for i in left[:40])
