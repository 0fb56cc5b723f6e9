"""Keyword lexicons: loading, matching, masking, density and score."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomsift.config import FeatureConfig
from loomsift.functions.text import bind, decode_utf8, python_lines, strip

# Keywords that weigh three times, words too common to count, and phrases that deny.
HEAVY = ("色情", "赌博", "特价", "促销", "优惠", "免费", "限时", "加QQ", "加微信", "http://", "www.", "点击", "链接", "联系电话", "约炮", "一夜情")
COMMON = ("系统", "手机", "电话", "网络", "联系", "人才", "招聘")
DENIAL = r"(?:不包含|没有|禁止|反对|拒绝)[^\n]*?(?:色情|赌博|广告)"
#: Words up to which a lexicon is matched by one regular expression; beyond, by a trie in Arrow batches.
REGEX_WORDS = 400
#: Words up to which a lexicon is sent to the workers as an automaton; beyond, substrings are joined to it.
AUTOMATON_WORDS = 1_000_000


def words_of(lines: DataFrame, column: str = "value") -> DataFrame:
    """word: the distinct lines that are not blank, without white space at their ends."""
    return lines.select(strip(F.col(column)).alias("word")).filter(F.col("word") != "").distinct()


def read_words(spark: SparkSession, path: str, pattern: str = "*", without_file: str | None = None) -> DataFrame:
    """word: of the lexicon files at path, one word a line; bytes that are not UTF-8 are left out, a missing path gives no words.

    ``pattern`` chooses files by name, and ``without_file`` is passed over.
    """
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "word string")
    if without_file:
        files = files.filter(~F.endswith(F.col("path"), F.lit("/" + without_file.strip("/"))))
    return words_of(files.select(F.explode(F.split(decode_utf8("content"), r"\r\n|\r|\n", -1)).alias("value")))


def merge(lists: list[DataFrame], sort: bool = True) -> DataFrame:
    """word: of any list, once; in code point order if asked."""
    out = lists[0]
    for x in lists[1:]:
        out = out.unionByName(x)
    out = out.distinct()
    return out.orderBy("word") if sort else out


def without(words: DataFrame, others: DataFrame) -> DataFrame:
    """word: of the first list, but not of the second."""
    return words.join(others.select("word").distinct(), "word", "left_anti")


def normal(words: list[str]) -> list[str]:
    """Lower case, stripped, distinct, and without words that another one is a proper prefix of.

    A scan that stops at the shortest match never gets past the shorter one, so what is left
    matches the same; and of a prefix-free list at most one word matches at a place.
    """
    clean = sorted({w.strip().lower() for w in words} - {""})
    out: list[str] = []
    for w in clean:
        if not (out and w.startswith(out[-1])):
            out.append(w)
    return out


def alternation(words: list[str]) -> str:
    """A pattern of Java and RE2 that matches any of the words."""
    return "|".join(re.sub(r"([\\.^$|?*+()\[\]{}])", r"\\\1", w) for w in words)


class Trie:
    """Shortest leftmost matches of a prefix-free list, for long lists."""

    END = ""

    def __init__(self, words: list[str]):
        self.root: dict = {}
        for w in words:
            at = self.root
            for c in w:
                at = at.setdefault(c, {})
            at[self.END] = True

    def spans(self, text: str) -> list[tuple[int, int]]:
        out, i, n = [], 0, len(text)
        while i < n:
            at, j = self.root, i
            while j < n and (at := at.get(text[j])) is not None:
                j += 1
                if self.END in at:
                    out.append((i, j))
                    break
            else:
                i += 1
                continue
            i = out[-1][1] if at is not None and self.END in at else i + 1
        return out


def detect(c: Column, words: list[str]) -> Column:
    """Matches in order, with repeats: leftmost, shortest, not overlapping, in lower case."""
    clean = normal(words)
    if not clean:
        return F.when(c.isNotNull(), F.array().cast("array<string>"))
    if len(clean) <= REGEX_WORDS:
        return F.regexp_extract_all(F.lower(c), F.lit(alternation(clean)), F.lit(0))

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def scan(texts: pa.Array) -> pa.Array:
        trie = Trie(clean)
        return pa.array([None if t is None else [t[i:j] for i, j in trie.spans(t)] for t in texts.to_pylist()], pa.list_(pa.string()))

    return scan(F.lower(c))


def mask(c: Column, words: list[str], sign: str = "*") -> Column:
    """The text in lower case, each match of ``detect`` replaced by as many signs as it has characters; a null or empty text is unchanged."""
    clean = normal(words)
    low = F.lower(c)
    if not clean:
        return low
    if len(clean) <= REGEX_WORDS:
        p = alternation(clean)

        def cover(t: Column) -> Column:
            found = F.regexp_extract_all(t, F.lit(p), F.lit(0))
            return F.array_join(F.zip_with(F.split(t, p, -1), found, lambda a, w: F.concat(a, F.coalesce(F.repeat(F.lit(sign), F.length(w)), F.lit("")))), "")

        return bind(low, cover)

    @F.arrow_udf(T.StringType())
    def cover(texts: pa.Array) -> pa.Array:
        trie = Trie(clean)

        def one(t: str) -> str:
            out, at = [], 0
            for i, j in trie.spans(t):
                out += [t[at:i], sign * (j - i)]
                at = j
            return "".join(out) + t[at:]

        return pa.array([None if t is None else one(t) for t in texts.to_pylist()], pa.string())

    return cover(low)


def automaton(words: list[str]) -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for w in words:
        a.add_word(w, w)
    if words:
        a.make_automaton()
    return a


def occurrences(a: ahocorasick.Automaton, text: str) -> list[tuple[int, str]]:
    """First character (from 0) and word of every occurrence, overlapping ones too, by place and length; one pass over the text."""
    return sorted((end - len(w) + 1, w) for end, w in a.iter(text)) if len(a) else []


def all_matches(df: DataFrame, key: str, text: str, words: DataFrame) -> DataFrame:
    """key, pos, word of every occurrence of every word, overlapping ones too, case kept; pos is the first character's, from 0.

    Each row's matches stand under its key, also where keys repeat or are null. Null and empty texts
    have none. A lexicon of up to AUTOMATON_WORDS goes to the workers as one automaton; substrings of
    each length that a larger one has are joined to it.
    """
    words = words.select("word").filter(F.length("word") > 0).distinct()
    src = df.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").alias("__t"))
    listed = [r["word"] for r in words.limit(AUTOMATON_WORDS + 1).collect()]
    if len(listed) <= AUTOMATON_WORDS:
        kind = src.schema[0].dataType
        schema = T.StructType([T.StructField("key", kind), T.StructField("pos", T.IntegerType()), T.StructField("word", T.StringType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            a = automaton(listed)
            for b in batches:
                for k in range(0, b.num_rows, 64):
                    part = b.slice(k, 64)
                    found = [occurrences(a, t or "") for t in part.column(1).to_pylist()]
                    rows = pa.array([i for i, f in enumerate(found) for _ in f], pa.int64())
                    yield pa.RecordBatch.from_arrays([part.column(0).take(rows), pa.array([p for f in found for p, _ in f], pa.int32()), pa.array([w for f in found for _, w in f], pa.string())], names=["key", "pos", "word"])

        return src.toDF("key", "text").mapInArrow(run, schema).toDF(key, "pos", "word")
    lengths = sorted(r["n"] for r in words.select(F.length("word").alias("n")).distinct().collect())
    spot = src.filter(F.length("__t") > 0).select(key, "__t", F.explode(F.sequence(F.lit(0), F.length("__t") - 1)).alias("pos"))
    out = spot.select(key, "pos", F.explode(F.array(*[F.when(F.col("pos") + n <= F.length("__t"), F.substr("__t", F.col("pos") + 1, F.lit(n))) for n in lengths])).alias("word"))
    return out.join(words, "word").select(key, "pos", "word")


def naive_filter(c: Column, words: list[str], sign: str = "*") -> Column:
    """The text in lower case, each occurrence of a word replaced by one sign; longer words go first."""
    clean = sorted({w.strip().lower() for w in words} - {""}, key=lambda w: (-len(w), w))
    return F.regexp_replace(F.lower(c), alternation(clean), sign) if clean else F.lower(c)


def token_filter(c: Column, words: list[str], sign: str = "*") -> Column:
    """The text in lower case, keywords that its tokens bring up replaced by one sign each.

    A token of ASCII letters and digits brings up the keywords that have it as a word; any other
    one, those that share a character with it outside of such words. Keywords brought up by the
    text as it came are replaced wherever they stand, in the order of the list.
    """
    listed = list(dict.fromkeys(w.lower() for w in words if w.strip()))
    plain = re.compile(r"[0-9a-zA-Z]+").fullmatch
    index: dict[str, set[int]] = {}
    for i, w in enumerate(listed):
        for part in w.split():
            for k in [part] if plain(part) else part:
                index.setdefault(k, set()).add(i)

    @F.arrow_udf(T.StringType())
    def run(texts: pa.Array) -> pa.Array:
        def one(t: str) -> str:
            hit: set[int] = set()
            for token in t.split():
                for k in [token] if plain(token) else token:
                    hit |= index.get(k, set())
            for i in sorted(hit):
                t = t.replace(listed[i], sign)
            return t

        return pa.array([None if t is None else one(t) for t in texts.to_pylist()], pa.string())

    return run(F.lower(c))


def all_found(c: Column, words: list[str]) -> Column:
    """words: every occurrence of every word by place, overlapping ones too, case kept; total: each once for every line that has its word."""
    listed = sorted({w for w in words if w})

    @F.arrow_udf(T.StructType([T.StructField("words", T.ArrayType(T.StringType())), T.StructField("total", T.LongType())]))
    def scan(texts: pa.Array) -> pa.Array:
        a = automaton(listed)

        def one(t: str) -> dict:
            found = [w for _, w in occurrences(a, t)]
            times = Counter(found)
            total = sum(times[w] for line in t.split("\n") if line.strip() for w in {w for _, w in a.iter(line)}) if times else 0
            return {"words": found, "total": total}

        return pa.array([None if t is None else one(t) for t in texts.to_pylist()], pa.struct([("words", pa.list_(pa.string())), ("total", pa.int64())]))

    return scan(c)


def density(c: Column, words: list[str] | None, config: FeatureConfig = FeatureConfig()) -> dict[str, Column]:
    """feature_count, feature_words, avg_per_line and feature_passed.

    avg_per_line is matches in the whole text over lines of at least five characters without their
    white space; 0 without such lines. Without a lexicon nothing is found and avg_per_line is null.
    """
    if not words:
        return {"feature_count": F.lit(0), "feature_words": F.array().cast("array<string>"), "avg_per_line": F.lit(None).cast("double"), "feature_passed": F.lit(True)}
    if config.mode not in ("shortest", "all"):
        raise ValueError(f"no mode {config.mode}")
    if config.mode == "all":
        every = all_found(c, words)
        found, total = every["words"], every["total"]
        lines = F.size(F.filter(python_lines(c), lambda x: F.length(strip(x)) >= 5))
        avg = F.coalesce(F.try_divide(total, lines), F.lit(0.0))
        return {"feature_count": F.size(found), "feature_words": found, "avg_per_line": avg, "feature_passed": avg <= config.max_feature_words_per_line}
    found = detect(c, words)  # twice in the plan; Spark shares it outside of lambdas
    lines = F.size(F.filter(python_lines(c), lambda x: F.length(strip(x)) >= 5))
    avg = F.coalesce(F.try_divide(F.size(found), lines), F.lit(0.0))
    return {"feature_count": F.size(found), "feature_words": found, "avg_per_line": avg, "feature_passed": avg <= config.max_feature_words_per_line}


def all_density(df: DataFrame, key: str, text: str, words: DataFrame, config: FeatureConfig = FeatureConfig()) -> DataFrame:
    """key, feature_count, avg_per_line, feature_passed of each row in the mode of all matches: each match counts once for every line that has its word.

    Rows stand for themselves, also where keys repeat or are null. A null text has no matches and passes.
    """
    listed = [r["word"] for r in words.select("word").filter(F.length("word") > 0).distinct().limit(AUTOMATON_WORDS + 1).collect()]
    if len(listed) > AUTOMATON_WORDS:
        raise ValueError(f"a lexicon of more than {AUTOMATON_WORDS} words")
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    every = all_found(t, listed)
    lines = F.size(F.filter(python_lines(t), lambda x: F.length(strip(x)) >= 5))
    x = df.select(F.col(f"`{key}`").alias(key), F.size(every["words"]).cast("long").alias("feature_count"), F.coalesce(F.try_divide(every["total"], lines), F.lit(0.0)).alias("avg_per_line"))
    return x.withColumn("feature_passed", F.col("avg_per_line") <= config.max_feature_words_per_line)


def denied(c: Column) -> Column:
    """Whether one of the words that DENIAL ends in is in a text, without which no phrase denies."""
    return F.contains(c, F.lit("色情")) | F.contains(c, F.lit("赌博")) | F.contains(c, F.lit("广告"))


def feature_score(c: Column, found: Column) -> Column:
    """Score of a text from its matches: fewer, and none of the heavy kind, score more; an empty text scores 0."""
    n = F.length(c)
    unlike = F.size(F.array_except(F.array_distinct(found), F.array(*[F.lit(w) for w in COMMON])))

    def heavy(low: Column) -> Column:
        total = F.lit(0)
        for w in HEAVY:
            total = total + F.when(F.contains(low, F.lit(w)), F.lit(3)).otherwise(F.lit(0))
        return total

    def tiers(x: Column) -> Column:
        q, denies = x["q"], x["denies"]
        ratio = F.when(denies, q * F.lit(0.3)).otherwise(q)
        tier = F.when(ratio > 0.2, 0.0).when(ratio > 0.1, 0.2).when(ratio > 0.05, 0.5).when(ratio > 0.01, 0.8).otherwise(1.0)
        return F.when(denies & (ratio < 0.05), F.greatest(tier, F.lit(0.8))).otherwise(tier)

    q = F.try_divide((unlike + bind(F.lower(c), heavy)).cast("double"), n / F.lit(10))
    score = bind(F.struct(q.alias("q"), (denied(c) & c.rlike(DENIAL)).alias("denies")), tiers)
    return F.when(F.coalesce(n, F.lit(0)) == 0, F.lit(0.0)).otherwise(score)
