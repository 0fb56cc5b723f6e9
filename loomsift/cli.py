"""Command line: filter, train, sensitive, process, vectorize, merge-words."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from loomsift.operators.lexicon import merge, read_words
from loomsift.plans import pipelines
from loomsift.sources.files import write_lexicon


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="loomsift")
    sub = p.add_subparsers(dest="command", required=True)

    def add(name: str, out: str, *flags: str) -> argparse.ArgumentParser:
        c = sub.add_parser(name)
        c.add_argument("--input-dir", default="chinese_docs")
        c.add_argument("--output-dir", default=out)
        c.add_argument("--file-pattern", default="*.txt")
        c.add_argument("--words", help="lexicon file or folder, one word a line")
        for f in flags:
            c.add_argument(f"--{f}", action="store_true")
        return c

    add("filter", "filtered")
    add("train", "models", "skip-clustering")
    add("sensitive", "filtered_sensitive")
    add("process", "processed", "filter-quality", "filter-sensitive", "vectorize")
    add("vectorize", "vectors")
    m = sub.add_parser("merge-words")
    m.add_argument("-i", "--input-dir", required=True)
    m.add_argument("-o", "--output-file", required=True)
    m.add_argument("--no-sort", action="store_true")
    return p


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName("loomsift").getOrCreate()
    if a.command == "merge-words":
        write_lexicon(merge([read_words(spark, a.input_dir, "*.txt", a.output_file.rsplit("/", 1)[-1])], not a.no_sort), a.output_file, not a.no_sort)
        return
    words = [r["word"] for r in read_words(spark, a.words).collect()] if a.words else None
    if a.command == "filter":
        pipelines.filter_texts(spark, a.input_dir, a.output_dir, a.file_pattern, words).show()
    elif a.command == "sensitive":
        pipelines.mask_texts(spark, a.input_dir, a.output_dir, words or [], a.file_pattern).show()
    elif a.command == "train":
        if not a.skip_clustering:
            pipelines.cluster_texts(spark, a.input_dir, a.output_dir, a.file_pattern).show()
    elif a.command == "vectorize":
        pipelines.process(spark, a.input_dir, a.output_dir, words, False, False, True, a.file_pattern)
    else:
        pipelines.process(spark, a.input_dir, a.output_dir, words, a.filter_quality, a.filter_sensitive, a.vectorize, a.file_pattern)


if __name__ == "__main__":
    main()
