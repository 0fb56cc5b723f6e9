"""Rule metrics, checks and score of a text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomsift.config import RuleConfig
from loomsift.functions.text import ANY_URL_ONCE, CJK, EMOJI, WS, python_lines

# Patterns of search spam, and weights of the rules in the order of their sum.
SPAM = (
    r"\p{Nd}+[WS]*区[WS]*\p{Nd}+",
    r"在线[WS]*播放",
    r"视频[WS]*一区[WS]*二区",
    r"久久+久+",
    r"不卡[WS]*一区[WS]*二区",
    r"精品[WS]*视频[WS]*在线",
    r"日本[WS]*韩国[WS]*欧美",
)
MORE_SPAM = (*SPAM, r"激情[WS]*小说", r"成人[WS]*视频", r"在线[WS]*观看", r"一本[WS]*道", r"中文[WS]*字幕")
#: Every match of a pattern of SPAM, or of those added in MORE_SPAM, has one of these.
SPAM_SIGNS = ("区", "在", "久", "日")
MORE_SPAM_SIGNS = (*SPAM_SIGNS, "激", "成", "道", "中")
#: Texts from this length on are hashed to count their strings; below, a set is faster.
HASHED = 256
WEIGHTS = (("length", 0.05), ("avg_line", 0.10), ("chinese", 0.15), ("symbol", 0.10), ("dup", 0.10), ("bar", 0.20), ("comma", 0.10), ("url", 0.10), ("emoji", 0.10))
#: Spam: bar ratio and URL density above these, and what the score is then multiplied by.
SPAM_BAR, SPAM_URL, SPAM_FACTOR = 0.01, 0.03, 0.3


def any_of(patterns: tuple[str, ...]) -> str:
    return "|".join(patterns).replace("[WS]", f"[{WS}]")


def count(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern))


def having(c: Column, signs: tuple[str, ...]) -> Column:
    """Whether any of the strings is in a text."""
    out = F.contains(c, F.lit(signs[0]))
    for x in signs[1:]:
        out = out | F.contains(c, F.lit(x))
    return out


def spam_match(c: Column, more: bool = False) -> Column:
    """Whether a pattern of SPAM, or MORE_SPAM, matches; only texts with a sign of them are searched."""
    return having(c, MORE_SPAM_SIGNS if more else SPAM_SIGNS) & c.rlike(any_of(MORE_SPAM if more else SPAM))


def url_count(c: Column) -> Column:
    """Matches of ANY_URL; only texts with a sign of a URL are searched."""
    some = having(c, ("://", "www.")) | c.rlike(r"\.[a-zA-Z]{2}")
    return F.when(some, count(c, ANY_URL_ONCE)).otherwise(F.when(c.isNotNull(), 0))


def distinct_strings(text: str, k: int) -> int:
    """How many different strings of k characters a text has: by sorted hashes, each equal pair of which is compared."""
    m = len(text) - k + 1
    if m < HASHED:
        return len({text[i : i + k] for i in range(m)})
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    h = np.zeros(m, np.uint64)
    for i in range(k):
        h *= np.uint64(0x9E3779B97F4A7C15)
        h += chars[i : i + m]
    h ^= h >> np.uint64(32)
    order = np.argsort(h)
    ranked = h[order]
    same = np.flatnonzero(ranked[1:] == ranked[:-1])
    a, b = order[same], order[same + 1]
    if all((chars[a + i] == chars[b + i]).all() for i in range(k)):
        return m - len(same)
    return len({text[i : i + k] for i in range(m)})


def distinct_grams(c: Column, k: int) -> Column:
    """distinct_strings of each text; null for null."""

    @F.arrow_udf(T.LongType())
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([None if not t.is_valid else distinct_strings(t.as_py(), k) for t in texts], pa.int64())

    return run(c)


def metrics(df: DataFrame, text: str = "text", k: int = 13) -> DataFrame:
    """The rows with n, avg_line, and the ratios of the rules; ratios of empty texts are null.

    All counts are over the whole text. A null text has null metrics. Columns of these names are
    replaced; all others pass through.
    """
    t = F.col(f"`{text}`")
    n = F.length(t)
    lines = F.filter(python_lines(t), lambda x: x.rlike(rf"[^{WS}]"))
    length = F.aggregate(lines, F.lit(0), lambda a, x: a + F.length(x))
    grams = distinct_grams(t, k)
    out = {
        "n": n,
        "avg_line": F.try_divide(length, F.size(lines)),
        "chinese_ratio": F.try_divide(count(t, f"[{CJK}]"), n),
        "symbol_ratio": F.try_divide(count(t, rf"[^\p{{L}}\p{{N}}_{WS}{CJK}]"), n),
        "dup_ratio": F.when(n >= k, F.lit(1.0) - F.try_divide(grams, n - (k - 1))),
        "bar_ratio": F.try_divide(count(t, r"\|"), n),
        "comma_ratio": F.try_divide(count(t, ","), n),
        "url_density": F.try_divide(url_count(t), n),
        "emoji_ratio": F.try_divide(count(t, f"[{EMOJI}]+"), n),
        "spam": spam_match(t),
    }
    keep = [F.col(f"`{c}`") for c in df.columns if c not in out]
    return df.select(*keep, *[c.alias(name) for name, c in out.items()])


def passes(c: RuleConfig) -> dict[str, Column]:
    """Each rule on the columns of metrics; an empty text fails those that need a length."""
    at_most = lambda name, most: F.coalesce(F.col(name) <= most, F.lit(False))
    return {
        "length": F.col("n") >= c.min_text_length,
        "avg_line": F.coalesce(F.col("avg_line") >= c.min_avg_line_length, F.lit(False)),
        "chinese": F.coalesce(F.col("chinese_ratio") >= c.min_chinese_ratio, F.lit(False)),
        "symbol": at_most("symbol_ratio", c.max_symbol_ratio),
        "dup": F.coalesce(F.col("dup_ratio") <= c.max_internal_dup_ratio, F.lit(True)),
        "bar": at_most("bar_ratio", c.max_vertical_bar_ratio),
        "comma": at_most("comma_ratio", c.max_comma_ratio),
        "url": at_most("url_density", c.max_url_density),
        "emoji": at_most("emoji_ratio", c.max_emoji_ratio),
    }


def checks(df: DataFrame, c: RuleConfig = RuleConfig()) -> DataFrame:
    """From metrics: rule_details (pass and reason of each rule) and rule_passed."""
    ok = passes(c)
    value = {"length": F.col("n").cast("string"), **{k: F.format_string("%.2f", F.coalesce(F.col(v), F.lit(0.0))) for k, v in (("avg_line", "avg_line"), ("chinese", "chinese_ratio"), ("symbol", "symbol_ratio"), ("dup", "dup_ratio"))}}
    value |= {k: F.format_string("%.4f", F.coalesce(F.col(v), F.lit(0.0))) for k, v in (("bar", "bar_ratio"), ("comma", "comma_ratio"), ("url", "url_density"), ("emoji", "emoji_ratio"))}
    limit = {"length": c.min_text_length, "avg_line": c.min_avg_line_length, "chinese": c.min_chinese_ratio, "symbol": c.max_symbol_ratio, "dup": c.max_internal_dup_ratio, "bar": c.max_vertical_bar_ratio, "comma": c.max_comma_ratio, "url": c.max_url_density, "emoji": c.max_emoji_ratio}
    detail = [F.struct(p.alias("pass"), F.when(p, F.lit("")).otherwise(F.concat(value[k], F.lit(f" against a limit of {limit[k]}"))).alias("reason")).alias(f"{k}_check") for k, p in ok.items()]
    every = F.lit(True)
    for p in ok.values():
        every = every & p
    return df.withColumn("rule_details", F.struct(*detail)).withColumn("rule_passed", every)


def partial_scores(c: RuleConfig) -> dict[str, Column]:
    """What a failed rule scores."""
    zero, one = F.lit(0.0), F.lit(1.0)
    upto = lambda x, most=one: F.greatest(zero, F.least(most, F.coalesce(x, one)))
    return {
        "length": F.least(one, F.col("n") / F.lit(c.min_text_length)),
        "avg_line": F.least(one, F.coalesce(F.col("avg_line"), zero) / F.lit(float(c.min_avg_line_length))),
        "chinese": F.least(one, F.coalesce(F.col("chinese_ratio"), zero) / F.lit(c.min_chinese_ratio)) if c.min_chinese_ratio else one,
        "symbol": upto(F.try_divide(F.lit(c.max_symbol_ratio), F.col("symbol_ratio"))),
        "dup": upto(F.try_divide(F.lit(c.max_internal_dup_ratio), F.col("dup_ratio"))),
        "bar": upto(F.try_divide(F.lit(c.max_vertical_bar_ratio), F.col("bar_ratio")), F.lit(0.5)),
        "comma": upto(F.try_divide(F.lit(c.max_comma_ratio), F.col("comma_ratio"))),
        "url": upto(F.try_divide(F.lit(c.max_url_density), F.col("url_density")), F.lit(0.3)),
        "emoji": upto(F.try_divide(F.lit(c.max_emoji_ratio), F.col("emoji_ratio"))),
    }


def score(df: DataFrame, c: RuleConfig = RuleConfig()) -> DataFrame:
    """From metrics: rule_score; null for null and empty texts, which have no densities."""
    ok, part = passes(c), partial_scores(c)
    every = F.lit(True)
    total, weight = None, 0.0
    for k, w in WEIGHTS:
        every = every & ok[k]
        term = F.when(ok[k], F.lit(1.0)).otherwise(part[k]) * F.lit(w)
        total = term if total is None else total + term
        weight += w
    spam = (F.col("bar_ratio") > SPAM_BAR) | (F.col("url_density") > SPAM_URL) | F.col("spam")
    mean = total / F.lit(weight)
    return df.withColumn("rule_score", F.when(F.coalesce(F.col("n"), F.lit(0)) == 0, F.lit(None)).when(every, F.lit(1.0)).when(spam, mean * F.lit(SPAM_FACTOR)).otherwise(mean))


def spam_text(c: Column) -> Column:
    """The wider spam test for perplexity: patterns, bars over one in a hundred, or signs over 15 in a hundred; null for an empty text."""
    n = F.length(c)
    signs = n - F.length(F.translate(c, ".。,，!！?？:：;；", ""))
    return F.when(n > 0, spam_match(c, True) | (F.try_divide(n - F.length(F.replace(c, F.lit("|"), F.lit(""))), n) > 0.01) | (F.try_divide(signs, n) > 0.15))
