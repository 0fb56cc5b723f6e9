"""The queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomsift.functions.text import WS
from loomsift.llm.html_extract import op5_consensus_paths
from loomsift.llm.line_dedup import op8_winnowed_line_dedup
from loomsift.llm.minhash import op3_bagminhash_near_duplicates
from loomsift.llm.mixing import op10_entropy_mixing
from loomsift.llm.multi_index import op7_inverted_multi_index
from loomsift.llm.ogg import op1_ogg_media
from loomsift.llm.packing import op9_linear_grouping_packing
from loomsift.llm.quality import op6_weak_label_quality
from loomsift.llm.sharding import op4_hash_tree_sharding
from loomsift.llm.warc import op2_warc_round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ogg_media,
        op2_warc_round_trip,
        op3_bagminhash_near_duplicates,
        op4_hash_tree_sharding,
        op5_consensus_paths,
        op6_weak_label_quality,
        op7_inverted_multi_index,
        op8_winnowed_line_dedup,
        op9_linear_grouping_packing,
        op10_entropy_mixing,
    )
}

#: DuckDB SQL where it can express a query over whole tables. The others are tested against brute force.
ORACLE_SQL: dict[str, str] = {
    "op2_warc_round_trip": """
with p as (select page_id, url, strlen(coalesce(html, '')) n, sha1(coalesce(html, '')) d from pages),
k as (select d, max(page_id) keeper from p where n >= 1000 group by d),
r as (select p.*, keeper, row_number() over (partition by d, page_id order by url desc nulls last) i from p left join k using (d))
select page_id, n payload_bytes, d payload_digest, case when n >= 1000 and keeper is not null and (page_id is distinct from keeper or i > 1) then 'revisit' else 'response' end record_type,
  case when n >= 1000 and keeper is not null and (page_id is distinct from keeper or i > 1) then keeper end refers_to, null::varchar error
from r""",
    "op3_bagminhash_near_duplicates": f"""
with recursive w as (select doc_id, list_filter(regexp_split_to_array(text, '[{WS}]+'), lambda x: x <> '') w from documents),
s as (select doc_id, unnest(case when len(w) >= 5 then list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' ')) when len(w) > 0 then [array_to_string(w, ' ')] else [] end) g from w),
c as (select doc_id, hash(g) g, count(*) n from s group by all),
t as (select doc_id, sum(n) t from c group by all),
o as (select x.doc_id a, y.doc_id b, sum(least(x.n, y.n)) o from c x join c y on x.g = y.g and x.doc_id < y.doc_id group by all),
e as (select a, b from o join t x on x.doc_id = a join t y on y.doc_id = b where o::double / (x.t + y.t - o) >= 0.8),
n as (select a, b from e union all select b, a from e),
walk(id, root) as (select distinct a, a from n union select n.b, walk.root from walk join n on n.a = walk.id where walk.root < n.b),
m as (select id doc_id, min(root) root from walk group by all)
select doc_id, coalesce(root, doc_id) class_id from documents left join m using (doc_id)""",
}
