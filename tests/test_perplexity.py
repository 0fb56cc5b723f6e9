import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loomsift.functions import text as fx
from loomsift.operators import perplexity

LONG = "".join(f"sentence {i} of the text says w{i * i} and goes on. " for i in range(60))
TEXTS = {1: LONG, 2: "only a short text of w961 here", 3: "x" * 2000 + "yz", 4: "a sentence 7 of xyz", 5: "ab"}


def expected(whole, scored, k=3):
    n, context = Counter(), Counter()
    for t in whole.values():
        for i in range(len(t) - k + 1):
            n[t[i : i + k]] += 1
            context[t[i : i + k - 1]] += 1
    out = {}
    for key, t in scored.items():
        own = [t[i : i + k] for i in range(len(t) - k + 1)]
        if own:
            out[key] = math.exp(-sum(math.log((n[g] + 0.1) / (context[g[: k - 1]] + 500)) for g in own) / len(own))
    return out


def test_counts_cover_whole_texts(spark):
    docs = spark.createDataFrame(list(TEXTS.items()), "id int, t string")
    texts = docs.select("id", fx.perplexity_text(F.col("t")).alias("whole"), fx.scored_text(F.col("t")).alias("scored")).collect()
    whole, scored = {r["id"]: r["whole"] for r in texts}, {r["id"]: r["scored"] for r in texts}
    assert len(scored[1]) < len(whole[1]) and "。" in scored[1]
    want = expected(whole, scored)
    got = {r["id"]: r["perplexity"] for r in perplexity.score_texts(docs, "id", "t").collect()}
    assert got == pytest.approx({k: min(want.get(k, 10000.0), 10000.0) for k in TEXTS}, rel=1e-9)


ODD = ["", "a", "ab", "abc", "x😀y😀x😀y", "中文中文中文", "a\n\n b  c　　d \t", "aaaa" * 50, None, "see www.x.org or https://a.b/c?d... well!?!", "x" * 700 + ". y. z. " * 3]


def test_many_grams_meet_the_model_in_one_row(spark):
    """Texts give a row each to the shuffle, not a row for every gram, and the same numbers as the joins of a larger model."""
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*ODD, *TEXTS.values()])], "id int, t string")
    model = perplexity.train(docs.filter("id % 2 = 0"), "t")
    sent = perplexity.perplexity(docs, "id", "t", model)
    assert "Generate" not in sent._jdf.queryExecution().optimizedPlan().toString()
    joined = {r["id"]: r["perplexity"] for r in perplexity.joined(docs, "id", "t", model, 3).collect()}
    assert {r["id"]: r["perplexity"] for r in sent.collect()} == pytest.approx(joined, rel=1e-12)


def test_models_too_large_to_send(spark, monkeypatch):
    docs = spark.createDataFrame([*TEXTS.items(), (5, "again"), (None, "no key at all")], "id int, t string")
    key = lambda r: str(tuple(r))
    sent = sorted(perplexity.score_texts(docs, "id", "t").collect(), key=key)
    monkeypatch.setattr(perplexity, "SENT_GRAMS", 10)
    for a, b in zip(sent, sorted(perplexity.score_texts(docs, "id", "t").collect(), key=key), strict=True):
        assert a["id"] == b["id"] and a[1:] == pytest.approx(b[1:], rel=1e-12)


@pytest.mark.parametrize("k", [1, 2, 3])
def test_counts_of_portions(spark, monkeypatch, k):
    monkeypatch.setattr(perplexity, "PORTION", 5)
    docs = spark.createDataFrame([(t,) for t in ODD], "t string")
    want = Counter(t[i : i + k] for t in ODD if t for i in range(len(t) - k + 1))
    assert {r["gram"]: r["n"] for r in perplexity.train(docs, "t", k).collect()} == want


def test_no_grams_at_all(spark):
    docs = spark.createDataFrame([(1, "ab"), (2, ""), (3, None)], "id int, t string")
    assert {r["id"]: r["perplexity"] for r in perplexity.score_texts(docs, "id", "t").collect()} == {1: 10000.0, 2: 10000.0, 3: 10000.0}
    assert perplexity.perplexity(docs, "id", "t", perplexity.train(docs, "t")).collect() == []
