"""Language filter by script: a stand-in for a language model, which can be put in its place."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomsift.functions.text import clean_tool, script_ratio

Identifier = Callable[[Column], Column]


def confidence(c: Column) -> Column:
    """Share of ideographs among a text's letters, 0 without letters: an approximation of a model's confidence in Chinese."""
    return F.coalesce(script_ratio(c), F.lit(0.0))


def is_chinese(c: Column, threshold: float = 0.7, identify: Identifier = confidence, guarded: bool = False) -> Column:
    """Whether the confidence reaches the threshold; guarded: cleaned first, and never for texts under ten characters."""
    if not guarded:
        return identify(c) >= threshold
    clean = clean_tool(c)
    return F.coalesce((F.length(c) >= 10) & (clean != "") & (identify(clean) >= threshold), F.lit(False))
