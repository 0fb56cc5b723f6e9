"""Small tables that all operators must get through: nulls, empty and long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

LONG = " ".join(f"long{i % 977} word{i}" for i in range(15000))
PROSE = "The quick brown fox went over the lazy dog and then it came home to sleep in the warm house by the sea. "


def documents(spark):
    rows = [
        (0, PROSE * 3, "en", "a", 1),
        (1, PROSE * 3, "en", "a", 1),
        (1, PROSE * 3, "en", "a", 1),  # a repeated row
        (2, "", "en", "b", 0),
        (3, None, None, None, None),
        (None, "a text without an id that has a few words", None, "b", 3),
        (None, None, None, None, None),
        (4, LONG, "en", "c", 9),
        (5, "   \n\t ", "en", "c", 9),
        (6, "one", "en", "ä", 1),
        (6, "another text of the same id", "en", "ä", 1),
        (7, "naïve ünïcode 中文 😀 \x00   end", "fr", "", 1),
        (8, "%%% ### *** &&& " * 40, "en", "a", 1),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


#: Names that operators might use themselves.
CLASH = ("rank", "size", "key", "pos", "spans", "v", "c", "bag", "keep", "n", "text2", "a.b", "shard", "fp", "score", "copies")


def clashing(df):
    from pyspark.sql import functions as F

    have = set(df.columns)
    return df.select("*", *[F.lit(7).alias(c) for c in CLASH if c not in have])


def empty(df):
    return df.limit(0)
