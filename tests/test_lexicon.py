import random

from pyspark.sql import functions as F

from loomsift.operators import lexicon


def col(spark, value, f):
    return spark.createDataFrame([(value,)], "t string").select(f(F.col("t")).alias("x")).first()["x"]


def scan(text, words):
    words, out, i = {w.lower().strip() for w in words} - {""}, [], 0
    text = text.lower()
    while i < len(text):
        hit = next((text[i:j] for j in range(i + 1, len(text) + 1) if text[i:j] in words), None)
        if hit:
            out.append((i, hit))
            i += len(hit)
        else:
            i += 1
    return out


def test_fixtures(spark):
    assert col(spark, "ABCbd", lambda c: lexicon.detect(c, ["ab", "abc", "bd"])) == ["ab", "bd"]
    assert col(spark, "ABCbd", lambda c: lexicon.mask(c, ["ab", "abc", "bd"])) == "**c**"
    assert col(spark, "1989", lambda c: lexicon.mask(c, ["1989年"])) == "1989"
    assert col(spark, "hello sexy baby", lambda c: lexicon.mask(c, ["sexy"])) == "hello **** baby"
    assert col(spark, "hello sexy baby", lambda c: lexicon.naive_filter(c, ["sexy"])) == "hello * baby"
    assert col(spark, "hello sexybaby", lambda c: lexicon.token_filter(c, ["sexy"])) == "hello sexybaby"
    assert col(spark, "hello sexy sexybaby", lambda c: lexicon.token_filter(c, ["sexy"])) == "hello * *baby"
    assert col(spark, "看这个坏词", lambda c: lexicon.token_filter(c, ["坏词"])) == "看这个*"


def test_random_against_scan(spark, monkeypatch):
    rng = random.Random(3)
    words = ["".join(rng.choice("ab(中") for _ in range(rng.randint(1, 4))) for _ in range(8)]
    texts = ["".join(rng.choice("abAB(中 \n") for _ in range(rng.randint(0, 30))) for _ in range(150)] + [""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for limit in (400, 0):  # by pattern, by trie
        monkeypatch.setattr(lexicon, "REGEX_WORDS", limit)
        rows = df.select("t", lexicon.detect(F.col("t"), words).alias("d"), lexicon.mask(F.col("t"), words).alias("m")).collect()
        for r in rows:
            found = scan(r["t"], words)
            assert r["d"] == [w for _, w in found]
            m = list(r["t"].lower())
            for i, w in found:
                m[i : i + len(w)] = "*" * len(w)
            assert r["m"] == "".join(m)


def test_all_matches(spark):
    df = spark.createDataFrame([(1, "abcd"), (2, ""), (3, None)], "id long, t string")
    words = spark.createDataFrame([("abcd",), ("bc",)], "word string")
    assert sorted(tuple(r) for r in lexicon.all_matches(df, "id", "t", words).collect()) == [(1, 0, "abcd"), (1, 1, "bc")]


def test_all_matches_of_odd_rows(spark, monkeypatch):
    rng = random.Random(5)
    words = ["".join(rng.choice("ab中") for _ in range(rng.randint(1, 4))) for _ in range(12)]
    rows = [(1, "abab中ab"), (1, "b"), (None, "aa中"), (None, None), (2, ""), (3, "ab中" * 2000)]
    df = spark.createDataFrame(rows, "id long, t string")
    lex = spark.createDataFrame([(w,) for w in [*words, words[0], ""]], "word string")
    want = sorted((str(k), i, w) for k, t in rows for w in set(words) for i in range(len(t or "")) if (t or "").startswith(w, i))
    for limit in (1000, 1):
        monkeypatch.setattr(lexicon, "AUTOMATON_WORDS", limit)
        assert sorted((str(r["id"]), r["pos"], r["word"]) for r in lexicon.all_matches(df, "id", "t", lex).collect()) == want
    monkeypatch.setattr(lexicon, "AUTOMATON_WORDS", 1000)
    ab = spark.createDataFrame([("ab",)], "word string")
    assert sorted((str(r["id"]), r["feature_count"], r["feature_passed"]) for r in lexicon.all_density(df, "id", "t", ab).collect()) == [("1", 0, True), ("1", 3, False), ("2", 0, True), ("3", 2000, False), ("None", 0, True), ("None", 0, True)]


def test_long_texts_are_matched_in_one_pass(spark):
    import time

    df = spark.range(1).select("id", F.repeat(F.lit("abcdefghij"), 100_000).alias("t"))
    start = time.time()
    assert lexicon.all_matches(df, "id", "t", spark.createDataFrame([("cde",), ("jab",)], "word string")).count() == 199_999
    assert time.time() - start < 30


def test_missing_lexicon(spark, tmp_path):
    assert lexicon.read_words(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "a.txt").write_bytes(b"x\xff\r\ny\n")
    (tmp_path / "out.txt").write_text("z")
    (tmp_path / "b.md").write_text("w")
    assert sorted(r[0] for r in lexicon.read_words(spark, str(tmp_path), "*.txt", "out.txt").collect()) == ["x", "y"]


def test_density(spark):
    x = spark.createDataFrame([("xx\nabcde\n",)], "t string").select(*[c.alias(k) for k, c in lexicon.density(F.col("t"), ["xx"]).items()]).first()
    assert (x["feature_count"], x["avg_per_line"], x["feature_passed"]) == (1, 1.0, False)
    x = spark.createDataFrame([("xx",)], "t string").select(*[c.alias(k) for k, c in lexicon.density(F.col("t"), None).items()]).first()
    assert (x["feature_count"], x["avg_per_line"], x["feature_passed"]) == (0, None, True)


def test_feature_score(spark):
    def score(t, words=()):
        return col(spark, t, lambda c: lexicon.feature_score(c, lexicon.detect(c, list(words))))

    assert score("") == 0.0
    assert score("安静的早晨" * 10) == 1.0
    assert score("免费" + "好" * 100) == 0.0  # 3 / 10.2
    assert score("本站禁止赌博内容" + "好" * 500) == 0.8
    assert score("手机" * 20, ["手机"]) == 1.0


def test_merge(spark, tmp_path):
    (tmp_path / "a.txt").write_text("b\nA\na\n")
    (tmp_path / "b.txt").write_text("a\n c \n\n")
    assert [r[0] for r in lexicon.merge([lexicon.read_words(spark, str(tmp_path))]).collect()] == ["A", "a", "b", "c"]
    x = lexicon.without(spark.createDataFrame([("a",), ("b",)], "word string"), spark.createDataFrame([("b",)], "word string"))
    assert [r[0] for r in x.collect()] == ["a"]
