"""The registered queries over whole tables, and the DuckDB SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsift.config import ClusterConfig, EngineConfig, RuleConfig
from loomsift.functions import text as fx
from loomsift.operators import dedup, html, lang, lexicon, perplexity, quality, rules, similarity
from loomsift.storage import stage, table

Query = Callable[[SparkSession, str], DataFrame]

#: Limits for text of other scripts than Chinese, which the tables here hold none of.
LATIN = RuleConfig(min_chinese_ratio=0.0, max_comma_ratio=0.01)
ENGINE = EngineConfig(rule=LATIN)
#: Words of the invented languages of the tables; some are prefixes of others.
WORDS = ["thing", "thand", "than", "reble", "onering", "ouan", "entz", "cióna", "ción", "ought", "ererea", "hean", "of.", "the*"]
#: Vectors of the tables are nearly independent; this threshold gives clusters of all kinds.
NEAR = 0.35

DIGITS = 9

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def r(c, digits: int = DIGITS):
    return F.round(c, digits)


W = fx.WS
_ALT = "thing|than|reble|onering|ouan|entz|ción|ought|ererea|hean|of\\.|the\\*"


def _count(p: str, t: str = "text") -> str:
    return f"len(regexp_extract_all({t}, '{p}'))"


_SPAM = rules.any_of(rules.SPAM)
_METRICS = f"""
dup as (select doc_id, count(distinct substr(text, i, 13)) g from (select doc_id, text, unnest(generate_series(1, length(text) - 12)) i from documents) group by doc_id),
lines as (select doc_id, sum(length(l)) s, count(*) c from (select doc_id, unnest(string_split(text, chr(10))) l from documents) where regexp_matches(l, '[^{W}]') group by doc_id),
m as (select d.doc_id, text, length(text) n, s / nullif(c, 0) avg_line,
  {_count(f"[{fx.CJK}]")} / nullif(length(text), 0) chinese_ratio,
  {_count(rf"[^\p{{L}}\p{{N}}_{W}{fx.CJK}]")} / nullif(length(text), 0) symbol_ratio,
  case when length(text) >= 13 then 1.0::double - g / (length(text) - 12) end dup_ratio,
  (length(text) - length(replace(text, '|', ''))) / nullif(length(text), 0) bar_ratio,
  (length(text) - length(replace(text, ',', ''))) / nullif(length(text), 0) comma_ratio,
  {_count(fx.ANY_URL)} / nullif(length(text), 0) url_density,
  {_count(f"[{fx.EMOJI}]+")} / nullif(length(text), 0) emoji_ratio,
  regexp_matches(text, '{_SPAM}') spam
  from documents d left join dup using (doc_id) left join lines using (doc_id))"""
_CHECKS = """
k as (select *, n >= 100 length_ok, coalesce(avg_line >= 5, false) avg_line_ok, coalesce(chinese_ratio >= 0, false) chinese_ok, coalesce(symbol_ratio <= 0.2, false) symbol_ok,
  coalesce(dup_ratio <= 0.5, true) dup_ok, coalesce(bar_ratio <= 0.005, false) bar_ok, coalesce(comma_ratio <= 0.01, false) comma_ok, coalesce(url_density <= 0.01, false) url_ok, coalesce(emoji_ratio <= 0.02, false) emoji_ok from m)"""
_PART = """(case when length_ok then 1.0 else least(1.0, n / 100) end * 0.05::double
 + case when avg_line_ok then 1.0 else least(1.0, coalesce(avg_line, 0) / 5) end * 0.10::double
 + 1.0::double * 0.15::double
 + case when symbol_ok then 1.0 else greatest(0, least(1, coalesce(0.2::double / nullif(symbol_ratio, 0), 1))) end * 0.10::double
 + case when dup_ok then 1.0 else greatest(0, least(1, coalesce(0.5::double / nullif(dup_ratio, 0), 1))) end * 0.10::double
 + case when bar_ok then 1.0 else greatest(0, least(0.5, coalesce(0.005::double / nullif(bar_ratio, 0), 1))) end * 0.20::double
 + case when comma_ok then 1.0 else greatest(0, least(1, coalesce(0.01::double / nullif(comma_ratio, 0), 1))) end * 0.10::double
 + case when url_ok then 1.0 else greatest(0, least(0.3, coalesce(0.01::double / nullif(url_density, 0), 1))) end * 0.10::double
 + case when emoji_ok then 1.0 else greatest(0, least(1, coalesce(0.02::double / nullif(emoji_ratio, 0), 1))) end * 0.10::double)"""
_SCORE = f"""
s as (select *, case when n = 0 then null when length_ok and avg_line_ok and chinese_ok and symbol_ok and dup_ok and bar_ok and comma_ok and url_ok and emoji_ok then 1.0::double
  else {_PART} / (0.05::double + 0.10 + 0.15 + 0.10 + 0.10 + 0.20 + 0.10 + 0.10 + 0.10) * case when bar_ratio > 0.01 or url_density > 0.03 or spam then 0.3::double else 1.0 end end rule_score from k)"""
_HEAVY = " + ".join(f"case when contains(lower(text), '{w}') then 3 else 0 end" for w in lexicon.HEAVY)
_RATIO = f"(len(list_distinct(regexp_extract_all(lower(text), '{_ALT}'))) + {_HEAVY}) / nullif(length(text) / 10, 0)"
_TIER = "case when q > 0.2 then 0.0 when q > 0.1 then 0.2 when q > 0.05 then 0.5 when q > 0.01 then 0.8 else 1.0 end"
_FEATURE = f"case when length(text) = 0 then 0.0 when regexp_matches(text, '{lexicon.DENIAL}') and q * 0.3 < 0.05 then greatest(0.8, ({_TIER.replace('q >', 'q * 0.3 >')})) else {_TIER} end"
_F = f"f as (select doc_id, {_FEATURE} feature_score from (select doc_id, text, {_RATIO} q from documents))"
_QUALITY = f"with {_METRICS}, {_CHECKS}, {_SCORE}, {_F}, q as (select doc_id, rule_score, feature_score, case when n > 0 then (0.0::double + rule_score * 0.3 + feature_score * 0.5) / (0.0::double + 0.3 + 0.5) end quality_score from s join f using (doc_id))"


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "text")


_RATIOS = ["avg_line", "chinese_ratio", "symbol_ratio", "dup_ratio", "bar_ratio", "comma_ratio", "url_density", "emoji_ratio"]


@query(f"with {_METRICS} select doc_id, n, {', '.join(f'round({c}, 9) {c}' for c in _RATIOS)}, spam from m")
def rule_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return rules.metrics(_docs(spark, sf)).select("doc_id", "n", *[r(F.col(c)).alias(c) for c in _RATIOS], "spam")


@query(f"with {_METRICS}, {_CHECKS} select doc_id, length_ok, avg_line_ok, chinese_ok, symbol_ok, dup_ok, bar_ok, comma_ok, url_ok, emoji_ok, length_ok and avg_line_ok and chinese_ok and symbol_ok and dup_ok and bar_ok and comma_ok and url_ok and emoji_ok rule_passed from k")
def rule_checks(spark: SparkSession, sf: str) -> DataFrame:
    x = rules.checks(rules.metrics(_docs(spark, sf)), LATIN)
    return x.select("doc_id", *[F.col(f"rule_details.{k}_check.pass").alias(f"{k}_ok") for k, _ in rules.WEIGHTS], "rule_passed")


@query(f"with {_METRICS}, {_CHECKS}, {_SCORE} select doc_id, round(rule_score, 9) rule_score from s")
def rule_score(spark: SparkSession, sf: str) -> DataFrame:
    return rules.score(rules.metrics(_docs(spark, sf)), LATIN).select("doc_id", r(F.col("rule_score")).alias("rule_score"))


@query("select doc_id, count(distinct substr(text, i, 13)) distinct_grams from (select doc_id, text, unnest(generate_series(1, greatest(length(text) - 12, 1))) i from documents) where length(text) >= 13 group by doc_id")
def internal_dup13(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).filter(F.length("text") >= 13).select("doc_id", rules.distinct_grams(F.col("text"), 13).alias("distinct_grams"))


@query(f"select doc_id, case when length(text) > 0 then regexp_matches(text, '{rules.any_of(rules.MORE_SPAM)}') or (length(text) - length(replace(text, '|', ''))) / length(text) > 0.01 or len(regexp_extract_all(text, '[.。,，!！?？:：;；]')) / length(text) > 0.15 end spam from documents")
def spam_pattern_flag(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("doc_id", rules.spam_text(F.col("text")).alias("spam"))


@query(f"select doc_id, len(regexp_extract_all(lower(text), '{_ALT}')) n_matches, array_to_string(regexp_extract_all(lower(text), '{_ALT}'), ' ') matches from documents")
def kw_detect(spark: SparkSession, sf: str) -> DataFrame:
    x = lexicon.detect(F.col("text"), WORDS)
    return _docs(spark, sf).select("doc_id", F.size(x).cast("long").alias("n_matches"), F.array_join(x, " ").alias("matches"))


_MASK = f"array_to_string(list_transform(list_zip(regexp_split_to_array(lower(text), '{_ALT}'), regexp_extract_all(lower(text), '{_ALT}')), lambda z: z[1] || coalesce(repeat('*', length(z[2])), '')), '')"


@query(f"select conv_id, turn, {_MASK} masked from conversations")
def kw_mask(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").select("conv_id", "turn", lexicon.mask(F.col("text"), WORDS).alias("masked"))


@query(f"select doc_id, {_MASK} masked from documents")
def kw_mask_documents(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("doc_id", lexicon.mask(F.col("text"), WORDS).alias("masked"))


@query(
    f"select doc_id, round(a, 9) avg_per_line, a <= 0.2 feature_passed from (select doc_id, coalesce(len(regexp_extract_all(lower(text), '{_ALT}')) / nullif(len(list_filter(string_split(text, chr(10)), lambda l: length(regexp_replace(l, '^[{W}]+|[{W}]+$', '', 'g')) >= 5)), 0), 0) a from documents)"
)
def kw_count_per_line(spark: SparkSession, sf: str) -> DataFrame:
    x = lexicon.density(F.col("text"), WORDS)
    return _docs(spark, sf).select("doc_id", r(x["avg_per_line"]).alias("avg_per_line"), x["feature_passed"].alias("feature_passed"))


@query(f"with {_F} select * from f")
def feature_score(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("doc_id", lexicon.feature_score(F.col("text"), lexicon.detect(F.col("text"), WORDS)).alias("feature_score"))


def _quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality(_docs(spark, sf), "text", WORDS, ENGINE)


@query(f"{_QUALITY} select doc_id, round(quality_score, 9) quality_score, coalesce(quality_score >= 0.8, false) is_high_quality, round(rule_score, 9) rule_score, feature_score from q")
def quality_score(spark: SparkSession, sf: str) -> DataFrame:
    return _quality(spark, sf).select("doc_id", r(F.col("quality_score")).alias("quality_score"), "is_high_quality", r(F.col("component_scores.rule_score")).alias("rule_score"), "component_scores.feature_score")


@query(f"{_QUALITY} select count(*) total, count(*) filter (quality_score >= 0.8) high_quality, count(*) filter (not coalesce(quality_score >= 0.8, false)) low_quality from q")
def quality_stats(spark: SparkSession, sf: str) -> DataFrame:
    return quality.stats(_quality(spark, sf))


@query(f"{_QUALITY} select quality, coalesce(quality_score >= 0.8, false) is_high_quality, count(*) n from q join labels using (doc_id) group by all")
def quality_vs_labels(spark: SparkSession, sf: str) -> DataFrame:
    scored = _quality(spark, sf).select("doc_id", "is_high_quality")
    return scored.join(table(spark, sf, "labels"), "doc_id").groupBy("quality", "is_high_quality").agg(F.count(F.lit(1)).alias("n"))


@query(
    """with g as (select doc_id, text, unnest(generate_series(1, greatest(length(text), 1))) i from documents),
f as (select doc_id, i, substr(text, i, 1) c, case when i <= length(text) - 20 then min(i) over (partition by doc_id, substr(text, i, 21)) end first from g),
e as (select doc_id, i, c, max(case when i > first then i end) over (partition by doc_id order by i) last from f)
select doc_id, coalesce(string_agg(c, '' order by i) filter (last is null or last < i - 20), '') text from e group by doc_id"""
)
def dedup21(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("doc_id", dedup.dedup_passages(F.col("text")).alias("text"))



def _strip(t: str) -> str:
    return f"regexp_replace({t}, '^[{W}]+|[{W}]+$', '', 'g')"



@query(f"select doc_id, {_strip(f"regexp_replace(regexp_replace(text, '[{W}]+', ' ', 'g'), '{fx.CONTROL}', '', 'g')")} clean from documents")
def clean_text_tool(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("doc_id", fx.clean_tool(F.col("text")).alias("clean"))


@query("select doc_id, trim(regexp_replace(regexp_replace(text, '[^" + fx.CRAWL_KEEPS.replace("'", "''") + "]', '', 'g'), ' {2,}', ' ', 'g')) clean from documents")
def clean_text_crawl(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("doc_id", fx.clean_crawl(F.col("text")).alias("clean"))


_PPL = f"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '[{W}]+', ' ', 'g'), '{fx.URL}', '[URL]', 'g'), '[!?]{{2,}}', '!', 'g'), '\\.{{3,}}', '...', 'g'), '[{fx.EMOJI}]+', '', 'g')"


@query(f"select doc_id, {_PPL} processed from documents")
def ppl_preprocess(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("doc_id", fx.perplexity_text(F.col("text")).alias("processed"))


@query(
    f"""with p as (select doc_id, {_PPL} t from documents), s as (select *, list_filter(regexp_split_to_array(t, '{fx.SENTENCE_END}'), lambda x: regexp_matches(x, '[^{W}]')) l from p)
select doc_id, case when length(t) <= 500 then t when len(l) <= 3 then t[:500] else array_to_string(list_concat(list_concat(l[1:least(2, len(l) // 3)], l[len(l) // 3 + 1:len(l) // 3 + least(2, 2 * len(l) // 3 - len(l) // 3)]), l[2 * len(l) // 3 + 1:2 * len(l) // 3 + 2]), '。')[:500] end scored from s"""
)
def ppl_segments(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("doc_id", fx.scored_text(F.col("text")).alias("scored"))


_FILE = "regexp_replace(regexp_replace({u}, '^https?://', ''), '[^a-zA-Z0-9]', '_', 'g')[:100] || '.html'"


@query(f"select page_id, {_FILE.format(u='url')} filename from pages")
def url_filename(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", fx.url_to_filename(F.col("url")).alias("filename"))


@query(f"select page_id, filename, n_chars from (select page_id, {_FILE.format(u='host')} filename, length(html) n_chars, row_number() over (partition by {_FILE.format(u='host')} order by page_id desc) k from (select *, regexp_extract(url, '^https?://[^/]+') host from pages)) where k = 1")
def url_keep_last(spark: SparkSession, sf: str) -> DataFrame:
    named = table(spark, sf, "pages").select("page_id", fx.url_to_filename(F.regexp_extract("url", "^https?://[^/]+", 0)).alias("filename"), F.length("html").cast("long").alias("n_chars"))
    return dedup.keep_last(named, "filename", ["page_id"])


@query()
def html_text(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", html.tool_text(F.col("html")).alias("text"))


@query()
def html_crawl_text(spark: SparkSession, sf: str) -> DataFrame:
    return html.with_crawl_text(table(spark, sf, "pages").select("page_id", "html"), "html")


@query(r"select page_id, regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)\b[^>]*>.*?</(?:script|style)>', '', 'g'), '(?s)<!--.*?-->', '', 'g'), '<[^>]*>', '', 'g') text from pages")
def html_strip_tags(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", html.tags_out(F.col("html")).alias("text"))


_E = "e as (select vec_id, embedding::double[] v from embeddings)"
_PAIRS = f"{_E}, p as (select a.vec_id a, b.vec_id b, list_cosine_similarity(a.v, b.v) cos from e a join e b on a.vec_id < b.vec_id)"


def _vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select("vec_id", "embedding")


@query(f"with {_PAIRS} select a, b, round(cos, 6) cos from p where cos >= {NEAR}")
def cosine_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return similarity.similar_pairs(_vectors(spark, sf), "vec_id", "embedding", NEAR).select("a", "b", r(F.col("cos"), 6).alias("cos"))


_DUP = f"with {_E}, d as (select a.vec_id id, max(list_cosine_similarity(a.v, b.v)) r from e a join e b on a.vec_id <> b.vec_id group by a.vec_id)"


@query(f"{_DUP} select id, round(r, 6) duplicate_ratio from d")
def dup_ratio(spark: SparkSession, sf: str) -> DataFrame:
    v = _vectors(spark, sf)
    return similarity.duplicate_ratio(v, v, "vec_id", "embedding", True).select("id", r(F.col("duplicate_ratio"), 6).alias("duplicate_ratio"))


@query(f"{_DUP} select id, round(case when r >= {NEAR} then greatest(0, 0.2 * (1 - (r - {NEAR}) / (1 - {NEAR}))) else least(1, 0.8 + 0.2 * (1 - r / {NEAR})) end, 6) score from d")
def cluster_score(spark: SparkSession, sf: str) -> DataFrame:
    v = _vectors(spark, sf)
    return similarity.duplicate_ratio(v, v, "vec_id", "embedding", True).select("id", r(similarity.cluster_score(F.col("duplicate_ratio"), NEAR), 6).alias("score"))


@query(
    f"""with recursive {_PAIRS}, n as (select a, b from p where cos >= {NEAR} union all select b, a from p where cos >= {NEAR}),
core as (select a id from n group by a having count(*) + 1 >= 3),
walk(id, root) as (select id, id from core union select n.b, walk.root from walk join n on n.a = walk.id where n.b in (select id from core) and walk.root < n.b),
comp as (select id, min(root) root from walk group by id), names as (select root, row_number() over (order by root) - 1 label from (select distinct root from comp)),
cl as (select id, label from comp join names using (root)), border as (select n.a id, min(label) label from n join cl on cl.id = n.b where n.a not in (select id from core) group by n.a)
select vec_id id, coalesce(label, -1) label from e left join (select * from cl union all select * from border) x on x.id = e.vec_id"""
)
def dbscan(spark: SparkSession, sf: str) -> DataFrame:
    out = similarity.dbscan(_vectors(spark, sf), "vec_id", "embedding", ClusterConfig(NEAR, 3))
    return out.select("id", F.col("label").cast("long").alias("label"))


@query()
def kmeans_clusters(spark: SparkSession, sf: str) -> DataFrame:
    return similarity.kmeans(_vectors(spark, sf), "vec_id", "embedding", 10)


@query(f"with {_E}, t as (select q.vec_id query_id, e.vec_id id, list_cosine_similarity(q.v, e.v) cos from e q, e where q.vec_id % 100 = 0) select query_id, rank, id, round(cos, 6) cos from (select *, row_number() over (partition by query_id order by cos desc, id) rank from t) where rank <= 10")
def vector_top_k(spark: SparkSession, sf: str) -> DataFrame:
    v = _vectors(spark, sf)
    return similarity.top_similar(v.filter(F.col("vec_id") % 100 == 0), v, "vec_id", "embedding").select("query_id", F.col("rank").cast("long").alias("rank"), "id", r(F.col("cos"), 6).alias("cos"))


@query(f"with l as (select doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: {_strip('x')}), lambda x: x <> '') p from documents), c as (select doc_id, flatten(list_transform(p, lambda x: regexp_extract_all(x, '(?s).{{1,1000}}'))) k from l) select doc_id, unnest(generate_series(0, len(k) - 1)) chunk_no, unnest(k) chunk from c")
def chunks(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("doc_id", F.posexplode(fx.chunks(F.col("text"))).alias("chunk_no", "chunk")).select("doc_id", F.col("chunk_no").cast("long").alias("chunk_no"), "chunk")


@query("select doc_id, i // 1000 segment_no, substr(text, i + 1, 1000) segment from (select doc_id, text, unnest(generate_series(0, length(text) - 1, 1000)) i from documents)")
def fixed_segments(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("doc_id", F.posexplode(fx.fixed_segments(F.col("text"))).alias("segment_no", "segment")).select("doc_id", F.col("segment_no").cast("long").alias("segment_no"), "segment")


def _words(name: str) -> str:
    return f"select distinct {_strip('w')} word from (select unnest(string_split(text, chr(10))) w from {name}) where regexp_matches(w, '[^{W}]')"


def _list(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return lexicon.words_of(table(spark, sf, name).select(F.explode(F.split("text", "\n", -1)).alias("value")))


@query(f"{_words('benchmark')} union {_words('conversations')}")
def lexicon_merge(spark: SparkSession, sf: str) -> DataFrame:
    return lexicon.merge([_list(spark, sf, "benchmark"), _list(spark, sf, "conversations")])


@query(f"{_words('documents')} except {_words('benchmark')}")
def lexicon_diff(spark: SparkSession, sf: str) -> DataFrame:
    return lexicon.without(_list(spark, sf, "documents"), _list(spark, sf, "benchmark"))


_AC = ["than", "thand", "hean", "ción", "an", "entz", "ouan"]
_ACS = " union all ".join(f"select item_id, i - 1 pos, '{w}' word from (select item_id, text, unnest(generate_series(1, greatest(length(text), 1))) i from benchmark) where substr(text, i, {len(w)}) = '{w}'" for w in _AC)


def _ac(spark: SparkSession) -> DataFrame:
    return spark.sql("select explode(array(" + ",".join(f"'{w}'" for w in _AC) + ")) word")


@query(_ACS)
def ac_all_matches(spark: SparkSession, sf: str) -> DataFrame:
    return lexicon.all_matches(table(spark, sf, "benchmark"), "item_id", "text", _ac(spark)).select("item_id", F.col("pos").cast("long").alias("pos"), "word")


@query(
    f"""with a as ({_ACS}), k as (select item_id, word, count(*) k from a group by all), l as (select item_id, unnest(string_split(text, chr(10))) line from benchmark),
h as (select item_id, sum(k) t from l join k using (item_id) where contains(line, word) group by item_id), n as (select item_id, count(*) filter (length({_strip('line')}) >= 5) long from l group by item_id),
c as (select item_id, sum(k)::bigint feature_count from k group by item_id)
select item_id, coalesce(feature_count, 0) feature_count, round(coalesce(t / nullif(long, 0), 0), 9) avg_per_line, coalesce(t / nullif(long, 0), 0) <= 0.2 feature_passed from benchmark left join c using (item_id) left join h using (item_id) left join n using (item_id)"""
)
def ac_density(spark: SparkSession, sf: str) -> DataFrame:
    x = lexicon.all_density(table(spark, sf, "benchmark"), "item_id", "text", _ac(spark))
    return x.select("item_id", "feature_count", r(F.col("avg_per_line")).alias("avg_per_line"), "feature_passed")


@query(
    f"""with a as (select item_id, pos s, pos + length(word) - 1 e from ({_ACS})), b as (select *, case when s <= max(e) over (partition by item_id order by s, e rows between unbounded preceding and 1 preceding) + 1 then 0 else 1 end new from a),
g as (select *, sum(new) over (partition by item_id order by s, e) k from b) select item_id, min(s) s, max(e) e from g group by item_id, k"""
)
def match_spans(spark: SparkSession, sf: str) -> DataFrame:
    x = lexicon.all_matches(table(spark, sf, "benchmark"), "item_id", "text", _ac(spark))
    x = x.select("item_id", F.col("pos").cast("long").alias("from"), (F.col("pos") + F.length("word") - 1).cast("long").alias("to"))
    return dedup.spans(x, "item_id", "from", "to")


@query(f"select item_id, regexp_replace(lower(text), '{'|'.join(sorted(_AC, key=lambda w: (-len(w), w)))}', '*', 'g') masked from benchmark")
def naive_filter(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "benchmark").select("item_id", lexicon.naive_filter(F.col("text"), _AC).alias("masked"))


@query()
def bs_filter(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "benchmark").select("item_id", lexicon.token_filter(F.col("text"), _AC).alias("masked"))


@query(f"select doc_id, round(coalesce({_count('[A-Za-z]')} / nullif({_count(chr(92) + 'p{L}')}, 0), 0), 9) latin, coalesce({_count(f'[{fx.CJK}]')} / nullif({_count(chr(92) + 'p{L}')}, 0), 0) >= 0.7 is_chinese from documents")
def script_ratio_lang(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("text")
    return _docs(spark, sf).select("doc_id", r(F.coalesce(fx.script_ratio(t, "A-Za-z"), F.lit(0.0))).alias("latin"), lang.is_chinese(t).alias("is_chinese"))


@query(
    f"""with p as (select doc_id, {_PPL} t from documents), s as (select *, list_filter(regexp_split_to_array(t, '{fx.SENTENCE_END}'), lambda x: regexp_matches(x, '[^{W}]')) l from p),
q as (select doc_id, case when length(t) <= 500 then t when len(l) <= 3 then t[:500] else array_to_string(list_concat(list_concat(l[1:least(2, len(l) // 3)], l[len(l) // 3 + 1:len(l) // 3 + least(2, 2 * len(l) // 3 - len(l) // 3)]), l[2 * len(l) // 3 + 1:2 * len(l) // 3 + 2]), '。')[:500] end t from s),
g as (select doc_id, substr(t, i, 3) gram from (select doc_id, t, unnest(generate_series(1, length(t) - 2)) i from q)), m as (select gram, count(*) n from g group by gram), c as (select gram[:2] h, sum(n) context from m group by all),
o as (select doc_id, gram, count(*) k from g group by all)
select doc_id, round(least(exp(-sum(k * ln((n + 0.1) / (context + 500.0))) / sum(k)), 10000), 6) perplexity from o join m using (gram) join c on h = gram[:2] group by doc_id"""
)
def ngram_perplexity(spark: SparkSession, sf: str) -> DataFrame:
    x = stage(_docs(spark, sf).select("doc_id", fx.scored_text(F.col("text")).alias("t")), "ngram-texts")
    return perplexity.perplexity(x, "doc_id", "t", perplexity.train(x, "t")).select("doc_id", r(F.least("perplexity", F.lit(10000.0)), 6).alias("perplexity"))


@query()
def perplexity_scores(spark: SparkSession, sf: str) -> DataFrame:
    return perplexity.score_texts(_docs(spark, sf), "doc_id", "text")


@query(f"select doc_id, round(len(list_distinct(w)) / nullif(len(w), 0), 9) complexity from (select doc_id, list_filter(regexp_split_to_array(lower(text), '[{W}]+'), lambda x: x <> '') w from documents)")
def type_token_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("doc_id", r(quality.readability(F.col("text"))["complexity"]).alias("complexity"))


@query()
def readability(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("doc_id", *[r(c).alias(k) for k, c in quality.readability(F.col("text")).items()])


@query("select doc_id, line_no, line from (select *, row_number() over (partition by line order by doc_id, line_no) k from (select doc_id, unnest(generate_series(0, len(l) - 1)) line_no, unnest(l) line from (select doc_id, string_split(text, chr(10)) l from documents))) where k = 1")
def corpus_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.corpus_lines(_docs(spark, sf), "doc_id", "text").select("doc_id", F.col("line_no").cast("long").alias("line_no"), "line")
