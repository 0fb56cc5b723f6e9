import duckdb
import numpy as np

from loomsift.llm import quality as q

from .cases import clashing, documents, empty

SF = "/root/testdata/sf0.01"


def test_em_finds_accuracies():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.7
    accuracy = np.array([0.95, 0.9, 0.85, 0.8, 0.7])
    right = rng.random((20_000, 5)) < accuracy
    seen = np.where(right == truth[:, None], q.GOOD, q.BAD)
    seen = np.where(rng.random(seen.shape) < 0.3, q.NONE, seen)
    u, n = np.unique(seen, axis=0, return_counts=True)
    model = q.fit_labels(u, n.astype(float))
    assert abs(model.prior - 0.7) < 0.03 and np.abs(model.accuracy() - accuracy).max() < 0.03
    assert ((model.posterior(seen) > 0.5) == truth).mean() > 0.93
    one = model.posterior(np.full((1, 5), q.NONE))
    assert abs(one[0] - model.prior) < 1e-9


def test_held_out_accuracy(spark):
    rows = q.classify(spark.read.parquet(f"{SF}/documents.parquet")).select("doc_id", "keep", "score").collect()
    keep = {r["doc_id"]: r["keep"] for r in rows}
    labels = duckdb.sql(f"select doc_id, quality from '{SF}/labels.parquet'").fetchall()
    bad = [keep[d] for d, y in labels if y == 0]
    good = [keep[d] for d, y in labels if y == 1]
    assert np.mean(bad) < 0.07 and np.mean(good) > 0.99, (np.mean(bad), np.mean(good))


def test_odd_rows(spark):
    docs = documents(spark)
    out = q.classify(clashing(docs)).collect()
    assert len(out) == docs.count() and all(0 <= r["score"] <= 1 for r in out)
    assert len({r["score"] for r in out if r["doc_id"] in (0, 1)}) == 1
    assert q.classify(empty(docs)).count() == 0
    assert q.unpack(np.array([q.pattern(q.facts("%%% ### " * 40))]))[0, 0] == q.BAD
