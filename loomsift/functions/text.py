"""Cleaning, splitting and naming as Column functions."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# White space as Unicode text handling outside the JVM sees it, CJK ideographs, the
# wide emoji class, URL forms, sentence ends, and the signs that the crawl cleaner keeps.
WS = r"\t\n\x0B\f\r \x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
CJK = r"\x{4e00}-\x{9fff}"
EMOJI = r"\x{24C2}-\x{1F251}\x{1F300}-\x{1F64F}\x{1F680}-\x{1FAFF}"
NARROW_EMOJI = r"\x{2702}-\x{27B0}\x{1F300}-\x{1F64F}\x{1F680}-\x{1FAFF}"
URL = rf"https?://[^{WS}]+|www\.[^{WS}]+"
ANY_URL = URL + r"|[a-zA-Z0-9][a-zA-Z0-9-]{1,61}[a-zA-Z0-9]\.[a-zA-Z]{2,}"
# ANY_URL for Java: a name's run of characters is taken at once and never given back, as the point comes right after it.
ANY_URL_ONCE = URL + r"|[a-zA-Z0-9][a-zA-Z0-9-]{2,62}+(?<!-)\.[a-zA-Z]{2,}"
SENTENCE_END = r"[。！？.!?]"
CRAWL_KEEPS = rf"{CJK}A-Za-z0-9 !~@#$%\^&*()_+<>?:\"{{}}|,./;'\[\]\\\-！￥…（）？：，。；【】—"
# [^CRAWL_KEEPS]+ with the ASCII characters one by one in a class of their own, which Java looks up in a
# table; in one class it tests some 40 members and ranges one after another for every character.
_ASCII = "".join(chr(i) for i in range(32, 127) if re.fullmatch("[" + CRAWL_KEEPS[CRAWL_KEEPS.index("A-Z"):] + "]", chr(i)))
CRAWL_DROPS = "[^[" + "".join(x if x.isalnum() else "\\" + x for x in _ASCII) + "][" + CJK + "".join(sorted({x for x in CRAWL_KEEPS[len(CJK):] if ord(x) > 127})) + "]]+"
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value worked out once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def strip(c: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(c, rf"^[{WS}]+|[{WS}]+\z", "")


def blank(c: Column) -> Column:
    """Whether nothing but white space is in it."""
    return ~c.rlike(rf"[^{WS}]")


def one_space(c: Column) -> Column:
    """Runs of white space to one space; runs that are one space already are passed over."""
    return F.regexp_replace(c, rf" [{WS}]+|[[^ -~]&&[{WS}]][{WS}]*", " ")


def clean_tool(c: Column) -> Column:
    """White space runs to one space, control characters out, ends stripped."""
    return strip(F.regexp_replace(one_space(c), CONTROL, ""))


def clean_crawl(c: Column) -> Column:
    """Only ideographs, ASCII letters, digits and common signs; line breaks vanish; runs of spaces to one."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, CRAWL_DROPS, ""), " {2,}", " "))


def perplexity_text(c: Column, compat_emoji: bool = True) -> Column:
    """What is scored for perplexity: white space and URLs made plain, runs of signs shortened, emoji out.

    With ``compat_emoji`` the emoji class takes all ideographs with it, as in production so far.
    """
    c = bind(one_space(c), lambda x: F.when(F.contains(x, F.lit("://")) | F.contains(x, F.lit("www.")), F.regexp_replace(x, URL, "[URL]")).otherwise(x))
    c = F.regexp_replace(c, r"[!?]{2,}", "!")
    c = F.regexp_replace(c, r"\.{3,}", "...")
    return F.regexp_replace(c, rf"[[^\x00-\xff]&&[{EMOJI if compat_emoji else NARROW_EMOJI}]]+", "")


def segments(c: Column, limit: int = 500) -> Column:
    """The first two sentences of each third, joined by an ideographic full stop, at most ``limit`` characters; of up to three sentences the text's beginning."""

    def pick(s: Column) -> Column:
        n = F.size(s)
        third, two = F.floor(n / 3).cast("int"), F.floor(2 * n / 3).cast("int")
        front = F.slice(s, F.lit(1), F.least(F.lit(2), third))
        middle = F.slice(s, third + 1, F.least(F.lit(2), two - third))
        back = F.slice(s, two + 1, F.least(F.lit(2), n - two))
        return F.when(n <= 3, F.substring(c, 1, limit)).otherwise(F.substring(F.array_join(F.concat(front, middle, back), "。"), 1, limit))

    return bind(F.filter(F.split(c, SENTENCE_END, -1), lambda x: ~blank(x)), pick)


def scored_text(c: Column, limit: int = 500, compat_emoji: bool = True) -> Column:
    """perplexity_text, cut down to segments if it is longer than the limit."""
    return bind(perplexity_text(c, compat_emoji), lambda p: F.when(F.length(p) > limit, segments(p, limit)).otherwise(p))


def _python(pattern: str) -> re.Pattern:
    """A pattern of this module as Python writes it."""
    return re.compile(re.sub(r"\\x\{([0-9a-fA-F]+)\}", lambda m: chr(int(m[1], 16)), pattern))


_SPACES, _URLS, _BANGS, _DOTS, _ENDS, _INK = (_python(p) for p in (f"[{WS}]+", URL, "[!?]{2,}", r"\.{3,}", SENTENCE_END, f"[^{WS}]"))
_SIGNS = {True: _python(f"[{EMOJI}]+"), False: _python(f"[{NARROW_EMOJI}]+")}


_DROPPED, _WIDE = _python(f"[^{CRAWL_KEEPS}]+"), re.compile(" {2,}")


def plain_clean_crawl(t: str) -> str:
    """clean_crawl of one string."""
    return _WIDE.sub(" ", _DROPPED.sub("", t)).strip(" ")


def plain_perplexity_text(t: str, compat_emoji: bool = True) -> str:
    """perplexity_text of one string, for code that has it in a worker anyway."""
    t = _URLS.sub("[URL]", _SPACES.sub(" ", t))
    return _SIGNS[compat_emoji].sub("", _DOTS.sub("...", _BANGS.sub("!", t)))


def plain_scored_text(t: str, limit: int = 500, compat_emoji: bool = True) -> str:
    """scored_text of one string."""
    p = plain_perplexity_text(t, compat_emoji)
    if len(p) <= limit:
        return p
    s = [x for x in _ENDS.split(p) if _INK.search(x)]
    n = len(s)
    third, two = n // 3, 2 * n // 3
    picked = [*s[: min(2, third)], *s[third : min(third + 2, two)], *s[two : two + 2]]
    return (p if n <= 3 else "。".join(picked))[:limit]


def url_to_filename(c: Column) -> Column:
    """A file name of at most 105 characters for a URL."""
    return F.concat(F.substring(F.regexp_replace(F.regexp_replace(c, r"^https?://", ""), "[^a-zA-Z0-9]", "_"), 1, 100), F.lit(".html"))


def warc_output_name(c: Column, suffix: str = "-chinese") -> Column:
    """The name for an archive's filtered copy: the suffix goes before the extensions, both if the last is .gz."""
    name = F.element_at(F.split(c, "/"), -1)
    base = F.regexp_replace(F.regexp_replace(name, r"\.gz\z", ""), r"\.[^.]+\z", "")
    return F.concat(base, F.lit(suffix), F.substring(name, F.length(base) + 1, 1000))


@F.arrow_udf(T.StringType())
def decode_utf8(data):
    """UTF-8 text of bytes; bytes that are none of it are left out."""
    import pyarrow as pa

    return pa.array([None if x is None else x.decode("utf-8", "ignore") for x in data.to_pylist()], pa.string())


def python_lines(c: Column) -> Column:
    """Lines between line feeds; trailing empty ones stay."""
    return F.split(c, "\n", -1)


def fixed_segments(c: Column, size: int = 1000) -> Column:
    """Pieces of ``size`` characters."""
    return F.regexp_extract_all(c, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))


def chunks(c: Column, limit: int = 1000) -> Column:
    """Paragraphs between line breaks without their white space, long ones cut every ``limit`` characters."""
    parts = F.filter(F.transform(F.split(c, "\n+", -1), strip), lambda x: x != "")
    return F.flatten(F.transform(parts, lambda x: F.regexp_extract_all(x, F.lit(f"(?s).{{1,{limit}}}"), F.lit(0))))


def script_ratio(c: Column, script: str = CJK) -> Column:
    """Share of the letters of a text that are of the script; null without letters."""
    return F.try_divide(F.regexp_count(c, F.lit(f"[{script}]")), F.regexp_count(c, F.lit(r"\p{L}")))
