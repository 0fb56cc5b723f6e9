import random

from loomsift.llm.line_dedup import dedup_lines, windows

from .cases import clashing, documents, empty


def brute(docs, least):
    lines = [[(i, " ".join(x.split()), len(x.split())) for i, x in enumerate(t.split("\n")) if x.split()] for _, t in docs]
    out = []
    for d, own in enumerate(lines):
        gone = set()
        for s in range(len(own)):
            for e in range(s, len(own)):
                if sum(x[2] for x in own[s : e + 1]) < least:
                    continue
                seq = [x[1] for x in own[s : e + 1]]
                n = len(seq)
                if any([x[1] for x in m[p : p + n]] == seq for d2, m in enumerate(lines[: d + 1]) for p in range(s if d2 == d else len(m) - n + 1) if p + n <= len(m)):
                    gone |= set(range(own[s][0], own[e][0] + 1))
        out.append("\n".join(x for i, x in enumerate(docs[d][1].split("\n")) if i not in gone))
    return out


def test_windows():
    assert windows([60], 50) == {(0, 0)}
    assert windows([10, 10], 50) == set()
    assert windows([30, 30, 1, 30], 50) == {(0, 1), (0, 2), (1, 3)}


def test_against_brute_force(spark):
    rng = random.Random(1)
    voc = ["a b c", "d", "e f", "g h i j", "", "k l", " m  n ", "o"]
    for trial in range(2):
        docs = [(i, "\n".join(rng.choice(voc) for _ in range(rng.randint(0, 14)))) for i in range(60)]
        df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
        got = {r["doc_id"]: r["text"] for r in dedup_lines(df, 8).collect()}
        assert [got[i] for i in range(60)] == brute(docs, 8)


def test_passage(spark):
    passage = " ".join(f"p{i}" for i in range(51))
    short = " ".join(f"s{i}" for i in range(49))
    rows = [(1, f"one\n{passage}\n{short}\nend"), (2, f"two\n{short}\nx"), (3, f"three\n{passage}\nlast"), (4, f"{passage}\n{passage}")]
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (rows[0][1], 0), 2: (rows[1][1], 0), 3: ("three\nlast", 1), 4: ("", 2)}


def test_odd_rows(spark):
    docs = documents(spark)
    out = dedup_lines(clashing(docs)).collect()
    assert len(out) == docs.count()
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], []).append(r["text"])
    assert len(by[0][0]) > 100 and by[1] == ["", ""] and by[3] == [None]
    assert dedup_lines(empty(docs)).count() == 0
    twice = spark.createDataFrame([(1, "w " * 60)] * 2, "doc_id long, text string")
    assert [r["n_removed"] for r in dedup_lines(twice).collect()] == [0, 0]
