import pytest
from pyspark.sql import functions as F

from loomsift.config import EngineConfig, FeatureConfig
from loomsift.operators import lexicon, quality

WORDS = ["than", "thand", "hean", "an", "AN"]
TEXTS = [(1, "thandthan here\nno word\nAN hean and"), (2, "nothing of it"), (3, ""), (4, "an\nan\n \nThan thean too")]


def test_quality_honours_mode(spark):
    df = spark.createDataFrame(TEXTS, "id int, text string")
    words = spark.createDataFrame([(w,) for w in WORDS], "word string")
    config = EngineConfig(feature=FeatureConfig(mode="all"))
    want = {r["id"]: r for r in lexicon.all_density(df, "id", "text", words).collect()}
    places = lexicon.all_matches(df, "id", "text", words).groupBy("id").agg(F.sort_array(F.collect_list("word")).alias("w"))
    found = {r["id"]: r["w"] for r in places.collect()}
    got = df.select("id", *[c.alias(k) for k, c in lexicon.density(F.col("text"), WORDS, config.feature).items()]).collect()
    for r in got:
        w = want[r["id"]]
        assert (r["feature_count"], r["avg_per_line"], r["feature_passed"]) == (w["feature_count"], w["avg_per_line"], w["feature_passed"])
        assert sorted(r["feature_words"]) == found.get(r["id"], [])
    first = quality.quality(df, "text", WORDS, config).filter("id = 1").first()
    assert first["component_results"]["feature_words"]["details"]["feature_count"] == want[1]["feature_count"] == 9
    with pytest.raises(ValueError):
        lexicon.density(F.col("text"), WORDS, FeatureConfig(mode="other"))
