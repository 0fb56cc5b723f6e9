import random
from collections import Counter

import numpy as np

from loomsift.llm import minhash as mh

from .cases import PROSE, clashing, documents, empty


def brute(a, b, k=5):
    def bag(t):
        w = t.split()
        return Counter([tuple(w)] if 0 < len(w) < k else [tuple(w[i : i + k]) for i in range(len(w) - k + 1)])

    x, y = bag(a), bag(b)
    return sum((x & y).values()) / max(sum((x | y).values()), 1)


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return out


def test_similarity_and_signatures():
    rng = random.Random(4)
    for n, rep in ((8, 5), (60, 1), (60, 7), (300, 2)):
        base = [f"w{rng.randrange(500)}" for _ in range(n)]
        a, b = " ".join(base * rep), " ".join(edited(rng, base, n // 12) * (rep + 1))
        doc, h, c = mh.bags([a, b])
        e = int(np.searchsorted(doc, 1))
        want = brute(a, b)
        assert abs(mh.jaccard((h[:e], c[:e]), (h[e:], c[e:])) - want) < 1e-12
        s = mh.bagminhash(doc, h, c, 2, 8192)
        assert abs(float((s[0] == s[1]).mean()) - want) < 0.03
    doc, h, c = mh.bags(["", None, "a", "a b c d", " "])
    assert list(doc) == [2, 3]
    assert np.isinf(mh.bagminhash(doc, h, c, 5, 16)[[0, 1, 4]]).all() and np.isfinite(mh.bagminhash(doc, h, c, 5, 16)[[2, 3]]).all()


def test_signature_of_a_text_does_not_depend_on_others():
    texts = [PROSE, PROSE * 2, "a b", "x " * 500]
    m = [mh.bagminhash(*mh.bags([t]), 1, 48)[0] for t in texts]
    assert (np.stack(m) == mh.bagminhash(*mh.bags(texts), 4, 48)).all()


def classes(texts, least=0.8):
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if texts[i] and texts[i].split() and texts[j] and brute(texts[i], texts[j]) >= least:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


def test_classes_against_brute_force(spark):
    rng = random.Random(7)
    texts = []
    for g in range(6):
        base = [f"g{g}w{rng.randrange(200)}" for _ in range(80)]
        for _ in range(8):
            texts.append(" ".join(edited(rng, base, rng.randrange(5))))
        last = base
        for _ in range(5):  # a chain of which only neighbours are alike
            last = edited(rng, last, 1)
            texts.append(" ".join(last))
    passage = [f"p{i}" for i in range(60)]
    texts += [" ".join(passage + [f"q{k}_{i}" for i in range(40)]) for k in range(12)]  # a shared passage is no link
    rng.shuffle(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["class_id"] for r in mh.near_duplicates(df).collect()}
    assert [got[i] for i in range(len(texts))] == classes(texts)


def test_odd_rows(spark):
    docs = documents(spark)
    rows = mh.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], set()).add(r["class_id"])
    assert by[0] == by[1] == {0} and by[2] == {2} and by[3] == {3} and by[5] == {5} and by[6] == {6} and by[4] == {4} and by[None] == {None}
    assert mh.near_duplicates(clashing(docs)).count() == docs.count()
    assert mh.near_duplicates(empty(docs)).count() == 0
