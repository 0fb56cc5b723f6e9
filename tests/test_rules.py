import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomsift.config import EngineConfig, RuleConfig
from loomsift.operators import quality, rules

NINE = "这是一段很短文本1"


def record(spark, value, **k):
    return quality.quality(spark.createDataFrame([(value,)], "text string"), **k).first()


def score(spark, value):
    return rules.score(rules.metrics(spark.createDataFrame([(value,)], "text string"))).first()["rule_score"]


def test_short_text_is_kept(spark):
    text = "这是很短的一段文本"
    assert score(spark, text) == pytest.approx(0.8725)
    r = record(spark, text)
    assert r["quality_score"] == pytest.approx(0.9521875) and r["is_high_quality"]
    assert r["component_results"]["rule_filter"]["passed"] is False


def test_empty_and_null(spark):
    for v in ("", None):
        r = record(spark, v)
        assert (r["quality_score"], r["is_high_quality"], r["error"]) == (None, False, "division by zero")


def test_repetition(spark):
    m = rules.metrics(spark.createDataFrame([("ab" * 20,), ("abcdefghijkl",)], "text string")).collect()
    assert m[0]["dup_ratio"] == pytest.approx(1 - 2 / 28)
    assert m[1]["dup_ratio"] is None


def test_bars_and_spam(spark):
    spam = "99区99 | 在线播放 | 视频一区二区 | " * 10
    assert score(spark, spam) < 0.3
    x = rules.checks(rules.metrics(spark.createDataFrame([(spam,)], "text string"))).first()
    assert not x["rule_details"]["vertical_bar_check" if False else "bar_check"]["pass"] and x["rule_details"]["bar_check"]["reason"]


def test_spam_text(spark):
    df = spark.createDataFrame([("成人 视频",), ("好。。。。",), ("plain text",), ("",)], "t string")
    assert [r[0] for r in df.select(rules.spam_text(F.col("t"))).collect()] == [True, True, False, None]


def test_clashing_names(spark):
    df = spark.createDataFrame([("x" * 200, 5, "y")], "text string, n int, `a.b` string")
    out = rules.score(rules.metrics(df))
    assert out.first()["n"] == 200 and "a.b" in out.columns


def test_weights(spark):
    c = EngineConfig(quality_threshold=0.99, rule=RuleConfig(min_text_length=1, min_chinese_ratio=0.0))
    assert record(spark, "one plain line of words", config=c)["is_high_quality"]
    assert spark.createDataFrame([], "text string").count() == quality.quality(spark.createDataFrame([], "text string")).count()


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(max_size=60), min_size=20, max_size=40))
def test_score_range(spark, texts):
    df = spark.createDataFrame([(t.replace("\x00", ""),) for t in texts], "text string")
    for r in rules.score(rules.metrics(df)).select("rule_score").collect():
        assert r[0] is None or 0 <= r[0] <= 1 + 1e-9


def test_distinct_strings(monkeypatch):
    import random

    rng = random.Random(7)
    texts = ["", "a", "a" * 12, "a" * 13, "a" * 2000, "ab😀" * 400] + ["".join(rng.choice("abc😀中") for _ in range(rng.randint(0, 900))) for _ in range(100)]
    for k in (2, 5, 13):
        want = [len({t[i : i + k] for i in range(len(t) - k + 1)}) for t in texts]
        assert [rules.distinct_strings(t, k) for t in texts] == want
        # hashes that meet without their strings being equal
        with monkeypatch.context() as m:
            m.setattr(rules.np, "argsort", all_equal)
            assert [rules.distinct_strings(t, k) for t in texts] == want


def all_equal(h):
    h[:] = 0
    return np.arange(len(h))


def test_signs_of_spam(spark):
    """A text without a sign of spam is not searched; every pattern's matches have one."""
    hits = ["12 区 9", "在线 播放", "视频 一区 二区", "久久久久", "不卡一区 二区", "精品 视频 在线", "日本 韩国 欧美", "激情 小说", "成人 视频", "在线 观看", "一本 道", "中文 字幕", "plain", "", None]
    df = spark.createDataFrame([(t,) for t in hits], "t string")
    t = F.col("t")
    for more, patterns in ((False, rules.SPAM), (True, rules.MORE_SPAM)):
        assert df.filter(~rules.spam_match(t, more).eqNullSafe(t.rlike(rules.any_of(patterns)))).collect() == []
    assert df.filter(rules.spam_match(t, True)).count() == 12


def test_strings_are_counted_without_making_arrays_of_them(spark):
    df = spark.createDataFrame([("a b c d e f g h i j",)], "text string")
    assert "array_distinct" not in rules.metrics(df)._jdf.queryExecution().optimizedPlan().toString()
