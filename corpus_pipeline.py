"""The corpus pipeline: quality, line dedup, near dedup, mixing, packing, each over all that the stage before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsift.llm.common import stage, table
from loomsift.llm.line_dedup import dedup_lines
from loomsift.llm.minhash import near_duplicates, row_key
from loomsift.llm.mixing import mix, word_counts
from loomsift.llm.packing import pack_documents
from loomsift.llm.quality import classify

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier keeps."""
    return classify(docs.select(*COLUMNS)).filter("keep").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without later repeats of runs of lines; those that lose all their words go."""
    out = dedup_lines(docs.select(*COLUMNS), removed="__gone").filter((F.col("__gone") == 0) | F.col("text").rlike(r"\S"))
    return out.withColumn("n_chars", F.when(F.col("__gone") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class, the one of the least doc_id; of rows that are equal in it and the text, the least. Documents without words all stay."""
    classes = near_duplicates(docs.select("doc_id", "text"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2")).alias("m")
    kept = classes.filter(F.col("class_key").isNotNull()).groupBy("class_key").agg(first).select("m.k1", "m.k2")
    keyed = docs.select(*COLUMNS, *row_key("doc_id", "text"))
    wordless = F.coalesce(~F.col("text").rlike(r"\S"), F.lit(True))
    rows = keyed.filter(~wordless).join(kept.hint("merge"), ["k1", "k2"]).groupBy("k1", "k2").agg(F.first("text").alias("text"), F.min(F.struct("doc_id", "lang", "source", "n_chars")).alias("r"))
    return rows.select("r.doc_id", "text", "r.lang", "r.source", "r.n_chars").unionByName(docs.filter(wordless).select(*COLUMNS))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; rows that are equal in all columns together as often as it takes all of them."""
    keyed = docs.select(*COLUMNS, *row_key(*COLUMNS))
    rows = stage(word_counts(keyed, "k1", "k2"), "mix-words")
    taken = mix(rows, ["k1", "k2"]).groupBy("k1", "k2").agg(F.sum("copies").cast("int").alias("__copies")).filter("__copies > 0")
    out = keyed.join(taken.hint("merge"), ["k1", "k2"]).dropDuplicates(["k1", "k2"])
    return out.withColumn("__i", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequences and places."""
    return pack_documents(docs)


STAGES = [("quality classifier", quality), ("line dedup", lines), ("near dedup", near_dedup), ("mixing", mixing), ("packing", packing)]

#: Tokenising, hashing and fitted models have no SQL form. The pipeline's test checks sizes, near-duplicates left, copies and
#: pieces; it recomputes no stage's rows, so documents that a stage lost would not show.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a data folder, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = function(spark, docs, sf_dir)
        if function is not STAGES[-1][1]:
            docs = stage(docs, name.replace(" ", "-"))
    return docs
