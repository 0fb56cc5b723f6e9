"""The runs: quality filter, masking, clustering, crawl ingestion, and all in a row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsift.config import EngineConfig
from loomsift.operators import lexicon, quality
from loomsift.operators.html import with_crawl_text
from loomsift.operators.lang import is_chinese
from loomsift.operators.similarity import cluster_sizes, dbscan, hashed_embedding
from loomsift.sources import files
from loomsift.sources.warc import read_warc
from loomsift.storage import stage


def filter_texts(spark: SparkSession, folder: str, out: str, pattern: str = "*.txt", words: list[str] | None = None, config: EngineConfig = EngineConfig()) -> DataFrame:
    """Score all files; write kept texts, records and statistics under ``out``. Scores are written once and read for each sink."""
    scored = stage(quality.quality(files.read_texts(spark, folder, pattern), "text", words, config), "scored")
    files.write_kept(scored, f"{out}/kept")
    files.write_records(scored, f"{out}/results")
    counts = quality.stats(scored)
    files.write_stats(counts, f"{out}/stats")
    return counts


def mask_texts(spark: SparkSession, folder: str, out: str, words: list[str], pattern: str = "*.txt") -> DataFrame:
    """Mask keywords in all files; write texts and statistics under ``out``."""
    texts = files.read_texts(spark, folder, pattern)
    files.write_texts(texts.withColumn("text", lexicon.mask(F.col("text"), words)), f"{out}/masked")
    counts = texts.agg(F.count(F.lit(1)).alias("total"), F.count("text").alias("processed"), F.count_if(F.col("text").isNull()).alias("error"))
    files.write_stats(counts, f"{out}/stats")
    return counts


def cluster_texts(spark: SparkSession, folder: str, out: str, pattern: str = "*.txt", config: EngineConfig = EngineConfig()) -> DataFrame:
    """Embed and cluster all files; write vectors and labels under ``out``. An empty folder gives no rows."""
    texts = files.read_corpus(spark, folder, pattern).withColumn("id", F.xxhash64("path"))
    vectors = stage(texts.select("id", "name", hashed_embedding(F.col("text")).alias("embedding")), "vectors")
    labels = dbscan(vectors, "id", "embedding", config.cluster)
    files.write_vectors(vectors.join(labels, "id"), f"{out}/clusters")
    return cluster_sizes(labels)


def ingest_warc(spark: SparkSession, path: str, chinese_only: bool = True) -> DataFrame:
    """filename, payload and text of an archive's responses that leave a text, in the wanted language."""
    records = read_warc(spark, path).filter(F.col("rec_type") == "response")
    page = F.decode(F.make_valid_utf8(F.col("payload").cast("string")).cast("binary"), "UTF-8")
    text = with_crawl_text(records.withColumn("__page", page), "__page")
    if chinese_only:
        text = text.filter(is_chinese(F.col("text")))
    named = files.html_files(text)
    return named


def process(spark: SparkSession, folder: str, out: str, words: list[str] | None = None, filter_quality: bool = True, filter_sensitive: bool = True, vectorize: bool = True, pattern: str = "*.txt", config: EngineConfig = EngineConfig()) -> DataFrame:
    """Quality, masking and vectors in one plan; each step can be left out."""
    x = files.read_texts(spark, folder, pattern)
    if filter_quality:
        x = quality.quality(x, "text", words, config).filter("is_high_quality").select("name", "path", "text")
    if filter_sensitive and words:
        x = x.withColumn("text", lexicon.mask(F.col("text"), words))
    if vectorize:
        x = x.withColumn("embedding", hashed_embedding(F.col("text")))
    x.write.mode("overwrite").parquet(f"{out}/documents")
    return spark.read.parquet(f"{out}/documents")
