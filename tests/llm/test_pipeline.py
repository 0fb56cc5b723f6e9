from collections import Counter

import corpus_pipeline as cp
from loomsift.llm.minhash import bags, jaccard

from .cases import documents

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = []
    for i, (_, function) in enumerate(cp.STAGES):
        function(spark, docs, SF).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        if i < len(cp.STAGES) - 1:
            assert docs.columns == cp.COLUMNS
        rows.append(docs.collect())
    kept, lines, near, mixed, packed = rows
    assert 0 < len(near) <= len(lines) <= len(kept)
    assert all(r["n_chars"] == len(r["text"]) for r in lines)
    signed = [bags([r["text"]])[1:] for r in near]
    assert not any(jaccard(signed[i], signed[j]) >= 0.8 for i in range(len(signed)) for j in range(i))
    assert {r["doc_id"] for r in mixed} <= {r["doc_id"] for r in near} and max(Counter(r["doc_id"] for r in mixed).values()) <= 2
    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == Counter(r["doc_id"] for r in mixed)


def test_odd_rows(spark, tmp_path):
    docs = documents(spark)
    for i, (_, function) in enumerate(cp.STAGES):
        function(spark, docs, SF).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
    assert docs.count() > 0
    empty = documents(spark).limit(0)
    for _, function in cp.STAGES:
        assert function(spark, empty, SF).count() == 0
