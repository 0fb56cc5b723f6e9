"""Text files and lexicons as tables, and the sinks of a run."""

from __future__ import annotations

import fnmatch

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsift.functions.text import blank, decode_utf8, url_to_filename
from loomsift.operators.dedup import keep_last


def empty_files(spark: SparkSession, folder: str, pattern: str = "*.txt") -> DataFrame:
    """name, path, text of the files without bytes, which Spark's readers pass over."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    found = fs.listStatus(path) if fs.exists(path) else []
    rows = [(f.getPath().getName(), f.getPath().toString(), "") for f in found if f.isFile() and f.getLen() == 0 and fnmatch.fnmatch(f.getPath().getName(), pattern)]
    return spark.createDataFrame(rows, "name string, path string, text string")


def read_texts(spark: SparkSession, folder: str, pattern: str = "*.txt") -> DataFrame:
    """name, path, text of the files in a folder, not in those below it; bytes that are not UTF-8 are left out."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    texts = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "path", decode_utf8("content").alias("text"))
    return texts.unionByName(empty_files(spark, folder, pattern))


def read_corpus(spark: SparkSession, folder: str, pattern: str = "*.txt") -> DataFrame:
    """read_texts without texts that are only white space."""
    return read_texts(spark, folder, pattern).filter(~blank(F.col("text")))


def write_texts(df: DataFrame, path: str) -> None:
    """name and text as Parquet."""
    df.select("name", "text").write.mode("overwrite").parquet(path)


def write_kept(scored: DataFrame, path: str) -> None:
    write_texts(scored.filter("is_high_quality"), path)


def write_records(scored: DataFrame, path: str) -> None:
    """One JSON record for each document, of high and of low quality."""
    scored.drop("text", "path").write.mode("overwrite").json(path)


def write_stats(stats: DataFrame, path: str) -> None:
    stats.coalesce(1).write.mode("overwrite").json(path)


def write_lexicon(words: DataFrame, path: str, sort: bool = True) -> None:
    """One word a line, in code point order or in none."""
    one = words.select("word").coalesce(1)
    (one.sortWithinPartitions("word") if sort else one).write.mode("overwrite").text(path)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_vectors(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def html_files(records: DataFrame) -> DataFrame:
    """filename and payload of WARC records under their URL's name; of equal names the last record stays."""
    named = records.select(url_to_filename(F.col("url")).alias("filename"), "path", "offset", "payload")
    return keep_last(named, "filename", ["path", "offset"])


def url_list(spark: SparkSession, path: str, n: int) -> DataFrame:
    """url of the first n lines of a file of archive paths; fetching is left to the caller."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\n", -1)).alias("line", "url"))
    return lines.filter(~blank(F.col("url"))).orderBy("line").limit(n).select("url")
