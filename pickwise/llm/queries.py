"""Queries of the text operators, one ``opN_<name>`` each, over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pickwise.llm import (
    decontamination, embedding_dedup, fim_frames, line_dedup, ngram_join, pii_surrogates, quality, sentencepiece_codec, source_divergence,
    token_counts, token_files, toxicity, url_filters,
)
from pickwise.llm.common import table
from pickwise.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_file(name: str) -> str:
    """Place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode_digests(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def line_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"), keep_text=False)


def embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = toxicity.train_on_labels(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, chain).drop("text")


def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


PII_KEY = b"demonstration key; a production run passes its own secret"


def pii_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_surrogates.replace_entities(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)


def decontamination_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def token_count_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = sentencepiece_codec.parse_model(open(tokenizer_file("piece_bpe_32k.model"), "rb").read())
    first, rest = token_counts.split_vocabulary(t for t, _, kind in model["pieces"] if kind == sentencepiece_codec.NORMAL)
    # a word may also begin with a bare character
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), first + [p for p in rest if len(p) == 1], rest)


def _number(x: str, modulus: int) -> str:
    """SQL for an integer below ``modulus`` from the md5 of a text (Spark)."""
    return f"pmod(cast(conv(substr(md5({x}), 1, 8), 16, 10) as bigint), {modulus})"


def url_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` with a fetch time in 2024 that follows from the page's id."""
    at = F.expr("timestamp_seconds(1704067200 + pmod(page_id * 7919, 365) * 86400 + pmod(page_id * 104729, 86400))")
    return table(spark, sf_dir, "pages").select("page_id", "url", at.alias("fetched_at"))


def url_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated list events that follow from the hosts in ``pages``: one in three hosts (without a leading
    www., m. or blog.) is added to one of three lists, most are removed later, some come back."""
    host = url_filters.host_of(F.col("url"))
    pattern = F.regexp_replace(host, r"^(www|m|blog)\.", "")
    h = table(spark, sf_dir, "pages").select(pattern.alias("pattern")).where("pattern is not null").distinct()
    h = h.selectExpr(
        "pattern", f"{_number('pattern', 3)} as pick", f"element_at(array('ads', 'malware', 'spam'), cast({_number('concat(pattern, chr(49))', 3)} + 1 as int)) as list",
        f"1704067200 + {_number('concat(pattern, chr(50))', 250)} * 86400 as t0", f"{_number('concat(pattern, chr(51))', 90)} * 86400 as d1",
        f"{_number('concat(pattern, chr(52))', 60)} * 86400 as d2", f"{_number('concat(pattern, chr(53))', 4)} as kind",
    ).where("pick = 0")
    return h.selectExpr("list", "pattern", "kind", "stack(3, 'add', t0, 0, 'remove', t0 + d1, 1, 'add', t0 + d1 + d2, 3) as (action, s, least_kind)").where(
        "kind >= least_kind"
    ).selectExpr("list", "pattern", "action", "timestamp_seconds(s) as at")


def url_filter_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge_captures(url_captures(spark, sf_dir), url_events(spark, sf_dir))


END_OF_DOCUMENT = 2


def token_file_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), path, END_OF_DOCUMENT)
    return token_files.read_boundaries(spark, path)


def fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "text-frames")
    fim_frames.store_texts(table(spark, sf_dir, "documents"), path)
    return fim_frames.transform_digests(spark, path)


def divergence_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_toxicity": toxicity_query,
    "op2_quality": quality_query,
    "op3_line_dedup": line_dedup_query,
    "op4_pii_surrogates": pii_query,
    "op5_token_counts": token_count_query,
    "op6_ngram_jaccard": ngram_jaccard,
    "op7_decontamination": decontamination_query,
    "op8_sentencepiece": sentencepiece,
    "op9_url_filters": url_filter_query,
    "op10_embedding_near_dedup": embedding_near_dedup,
    "op11_token_files": token_file_query,
    "op12_fill_in_middle": fill_in_middle,
    "op13_source_divergence": divergence_query,
}

_URL_SQL = r"""
with hosts as (
  select page_id, url, nullif(lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') as host,
    1704067200 + (page_id * 7919) % 365 * 86400 + (page_id * 104729) % 86400 as at
  from pages),
patterns as (select distinct regexp_replace(host, '^(www|m|blog)[.]', '') as pattern from hosts where host is not null),
picked as (
  select pattern, ['ads', 'malware', 'spam'][1 + cast('0x' || substr(md5(pattern || '1'), 1, 8) as bigint) % 3] as list,
    1704067200 + cast('0x' || substr(md5(pattern || '2'), 1, 8) as bigint) % 250 * 86400 as t0,
    cast('0x' || substr(md5(pattern || '3'), 1, 8) as bigint) % 90 * 86400 as d1,
    cast('0x' || substr(md5(pattern || '4'), 1, 8) as bigint) % 60 * 86400 as d2,
    cast('0x' || substr(md5(pattern || '5'), 1, 8) as bigint) % 4 as kind
  from patterns where cast('0x' || substr(md5(pattern), 1, 8) as bigint) % 3 = 0),
active as (
  select list, pattern, t0 as lo, case when kind >= 1 then t0 + d1 end as hi from picked where kind = 0 or d1 > 0
  union
  select list, pattern, t0 + d1 + d2, null from picked where kind >= 3),
hits as (
  select h.page_id, a.list, a.pattern from hosts h join active a
    on (h.host = a.pattern or ends_with(h.host, '.' || a.pattern)) and h.at >= a.lo and (a.hi is null or h.at < a.hi)),
verdicts as (
  select page_id, count(distinct list || ' ' || pattern) as n_entries, string_agg(distinct list, ',' order by list) as lists from hits group by page_id)
select h.page_id, h.host, to_timestamp(h.at) at time zone 'UTC' as fetched_at, coalesce(v.n_entries, 0) as n_entries,
  coalesce(v.lists, '') as lists, v.page_id is not null as blocked
from hosts h left join verdicts v using (page_id)
"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_LINE_SQL = f"""
with parts as (select doc_id, string_split(coalesce(text, ''), chr(10)) as p from documents),
lines as (select doc_id, unnest(p) as line, generate_subscripts(p, 1) as i from parts),
keyed as (
  select *, {_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} as key from lines),
repeated as (
  select key, min(doc_id) as first from keyed where length(key) >= 10 group by key having count(distinct doc_id) > 1),
judged as (select k.doc_id, k.line, k.i, r.first is not null and r.first <> k.doc_id as gone from keyed k left join repeated r using (key))
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
from judged group by doc_id
"""

# pairs that share an n-gram, then reachability; recursion follows links from every document
_JACCARD_SQL = f"""
with recursive words as (
  select doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^ \\t\\n\\v\\f\\r]+') as w from documents),
grams as (
  select distinct doc_id, case when len(w) < 5 then array_to_string(w, ' ') else array_to_string(w[i:i + 4], ' ') end as g
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from words where len(w) > 0)),
sizes as (select doc_id, count(*) as n from grams group by doc_id),
shared as (
  select a.doc_id as x, b.doc_id as y, count(*) as o from grams a join grams b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
links as (
  select x, y from shared join sizes s on s.doc_id = x join sizes t on t.doc_id = y where 100 * o >= 80 * (s.n + t.n - o)),
edges as (select x, y from links union all select y, x from links),
reach(doc_id, other) as (select x, x from edges union select r.doc_id, e.y from reach r join edges e on e.x = r.other)
select d.doc_id, coalesce(s.n, 0) as n_shingles, coalesce((select min(other) from reach r where r.doc_id = d.doc_id), d.doc_id) as component_id
from documents d left join sizes s using (doc_id)
"""

_EMBEDDING_SQL = """
with recursive vecs as (
  select vec_id, label, embedding::double[] as e from embeddings
  where label is not null and embedding is not null and len(embedding) > 0
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0 and len([x for x in embedding if x <> 0]) > 0),
links as (
  select a.vec_id as x, b.vec_id as y from vecs a join vecs b on a.label = b.label and a.vec_id < b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.93),
edges as (select x, y from links union all select y, x from links),
reach(vec_id, other) as (select x, x from edges union select r.vec_id, e.y from reach r join edges e on e.x = r.other),
counts as (select x as vec_id, count(*) as n from edges group by x)
select v.vec_id, coalesce(c.n, 0) as n_links, coalesce((select min(other) from reach r where r.vec_id = v.vec_id), v.vec_id) as component_id,
  v.vec_id = coalesce((select min(other) from reach r where r.vec_id = v.vec_id), v.vec_id) as kept
from embeddings v left join counts c using (vec_id)
"""

_FIM_SQL = """
with cut as (
  select doc_id, coalesce(text, '') as t, length(coalesce(text, '')) as n, sha256('1:' || doc_id) as h from documents),
drawn as (
  select *, cast('0x' || h[1:8] as bigint) as h1, cast('0x' || h[9:16] as bigint) as h2, cast('0x' || h[17:24] as bigint) as h3,
    cast('0x' || h[25:32] as bigint) as h4 from cut),
formed as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
    case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain'
      when h4 % 100 < 20 then 'spm' else 'psm' end as form
  from drawn)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
  sha256(case form when 'plain' then t
    when 'psm' then '<P>' || substr(t, 1, a) || '<S>' || substr(t, b + 1) || '<M>' || substr(t, a + 1, b - a)
    else '<S>' || substr(t, b + 1) || '<P>' || substr(t, 1, a) || '<M>' || substr(t, a + 1, b - a) end) as output_sha256,
  sha256(t) as restored_sha256
from formed
"""

_DIVERGENCE_SQL = f"""
with docs as (
  select row_number() over () as d, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as terms
  from documents),
found as (
  select d, lang, source, term, count(*) as c from (select d, lang, source, unnest(terms) as term from docs) group by all),
kept as (select lang, term from found group by lang, term having count(*) >= 10),
sizes as (select lang, count(*)::hugeint as v from kept group by lang),
counts as (select lang, source, term, sum(c)::hugeint as c from found join kept using (lang, term) group by all),
groups as (
  select g.lang, g.source, coalesce(v, 0) as v, coalesce((select sum(c) from counts k where k.lang = g.lang and k.source = g.source), 0)::hugeint as n
  from (select distinct lang, source from docs) g left join sizes using (lang)),
langs as (select lang, sum(n)::hugeint as n, max(v) as v from groups group by lang),
lang_counts as (select lang, term, sum(c)::hugeint as c from counts group by all),
probs as (
  select g.lang, g.source, k.term, coalesce(c.c, 0) as c, 1 + (1000000000::hugeint * (coalesce(c.c, 0) + 2)) // (g.n + 2 * g.v) as p
  from groups g join kept k using (lang) left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term),
lang_probs as (
  select lang, term, 1 + (1000000000::hugeint * (c + 2)) // (n + 2 * v) as q from lang_counts join langs using (lang)),
pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce((
      select sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) from probs x join probs y using (lang, term)
      where x.lang = a.lang and x.source = a.source and y.source = b.source), 0)::bigint as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source),
terms as (
  select lang, source, 'term' as part, term as item, (((p - q) * (p - q)) // (p + q))::bigint as value
  from probs join lang_probs using (lang, term) where c > 0 and p > q),
ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank
  from (select * from pairs union all select * from terms))
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 10
"""

ORACLES: dict[str, str] = {
    "op3_line_dedup": _LINE_SQL,
    "op6_ngram_jaccard": _JACCARD_SQL,
    "op9_url_filters": _URL_SQL,
    "op10_embedding_near_dedup": _EMBEDDING_SQL,
    "op12_fill_in_middle": _FIM_SQL,
    "op13_source_divergence": _DIVERGENCE_SQL,
}
