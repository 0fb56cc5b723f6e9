"""Text of HTML pages."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomsift.functions.text import clean_tool, plain_clean_crawl
from loomsift.operators.dedup import drop_repeats

#: Characters of texts that a worker gives out at once.
PORTION = 1_000_000
#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
CRAWL_DROPS = ("script", "style")
TOOL_DROPS = ("script", "style", "meta", "noscript", "header", "footer", "nav")


class _Text(HTMLParser):
    def __init__(self, drop: tuple[str, ...]):
        super().__init__(convert_charrefs=True)
        self.drop, self.inside, self.parts = frozenset(drop), [], []

    def handle_starttag(self, tag, attrs):
        if tag in self.drop and tag not in VOID:
            self.inside.append(tag)

    def handle_endtag(self, tag):
        if tag in self.inside:
            while self.inside.pop() != tag:
                pass

    def handle_data(self, data):
        if not self.inside:
            self.parts.append(data)


def page_text(markup: str, drop: tuple[str, ...], separator: str) -> str:
    """The texts of a page outside the dropped elements and comments, joined."""
    p = _Text(drop)
    p.feed(markup)
    p.close()
    return separator.join(p.parts)


def html_text(c: Column, drop: tuple[str, ...] = CRAWL_DROPS, separator: str = "") -> Column:
    """page_text of each page; null for null."""

    @F.arrow_udf(T.StringType())
    def run(pages: pa.Array) -> pa.Array:
        return pa.array([None if not x.is_valid else page_text(x.as_py(), drop, separator) for x in pages], pa.string())

    return run(c)


def with_crawl_text(df: DataFrame, markup: str, out: str = "text") -> DataFrame:
    """The other columns and the page's crawl text, without the rows that have none: page_text, cleaned as clean_crawl does, without repeated passages.

    All three steps in one worker, a page at a time, and PORTION characters given out at once; as columns, they would be
    two workers that hold whole batches, and a filter on the text would have Spark run both of them twice.
    """
    keep = [f for f in df.schema.fields if f.name != markup]
    names = [*[f.name for f in keep], out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pages, rows, texts, size = b.column(b.num_columns - 1), [], [], 0
            for i, page in enumerate(pages):
                text = drop_repeats(plain_clean_crawl(page_text(page.as_py(), CRAWL_DROPS, ""))) if page.is_valid else ""
                if text:
                    rows.append(i)
                    texts.append(text)
                    size += len(text)
                if rows and (size >= PORTION or i + 1 == len(pages)):
                    at = pa.array(rows, pa.int64())
                    yield pa.RecordBatch.from_arrays([*[c.take(at) for c in b.columns[:-1]], pa.array(texts, pa.string())], names=names)
                    rows, texts, size = [], [], 0

    x = df.select(*[F.col(f"`{f.name}`") for f in keep], F.col(f"`{markup}`"))
    return x.mapInArrow(run, T.StructType([*keep, T.StructField(out, T.StringType())]))


def tool_text(c: Column) -> Column:
    """Text without page furniture, cleaned; empty for null and empty pages."""
    return F.coalesce(clean_tool(html_text(c, TOOL_DROPS, " ")), F.lit(""))


def tags_out(c: Column) -> Column:
    """A page without scripts, styles, comments and tags, by patterns alone; character references stay."""
    c = F.regexp_replace(c, r"(?is)<(script|style)\b[^>]*>.*?</(?:script|style)>", "")
    return F.regexp_replace(F.regexp_replace(c, r"(?s)<!--.*?-->", ""), r"<[^>]*>", "")
