"""The registered queries of this package and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from srcweave.llm import (
    decontaminate,
    divergence,
    exact_dedup,
    filter_audit,
    html_text,
    jaccard,
    langid,
    mixing,
    repeats,
    separators,
    shards,
    token_files,
    topk,
)
from srcweave.llm.common import Scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of a mixture in which no source is repeated more than twice and none is left out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix(docs, mixing.count_words(F.col("text")), max_repeats=2.0)
    return mixed.select("doc_id", "source", "mix.epoch", "mix.place", "mix.block", "mix.n_tokens")


def held_out(key: str = "doc_id"):
    """Whether a document is kept from training."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of all documents, learnt from those that aren't held out."""
    docs = _table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~held_out()))
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five largest integer inner products of every fiftieth vector with all others."""
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", topk.quantised("embedding").alias("v"))
    return topk.top_products(vectors, F.col("vec_id") % 50 == 0, 5, "vec_id", "v")


def op4_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back: place, count and checksum of each."""
    path = Scratch(spark, "token-files").path("documents")
    token_files.write_token_files(_table(spark, sf_dir, "documents"), path, tokenizer_path(), end_id=2)
    return token_files.token_checksums(spark, path, key="doc_id")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents found in flat token files of all documents, and their token counts."""
    path = Scratch(spark, "flat-tokens").path("documents")
    separators.write_flat_tokens(_table(spark, sf_dir, "documents"), path, tokenizer_path(), end_id=49407)
    return separators.count_tokens(spark, path, end_id=49407)


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return html_text.extract_text(_table(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("html")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-word windows of the benchmark found in all documents."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_benchmark(docs, _table(spark, sf_dir, "benchmark"), width=10)
    ids = F.col("found.item_ids")
    return found.select(
        "doc_id",
        "found.n_words",
        "found.n_hit",
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.sort_array(ids)), 256).alias("items_sha256"),
        (F.col("found.n_hit") > 0).alias("contaminated"),
    )


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents linked by 90 % of their three-word shingles."""
    return jaccard.similar_documents(_table(spark, sf_dir, "documents"), width=3, num=90, den=100)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all documents in strings of 50 that a smaller document holds as well."""
    return repeats.digests(repeats.remove_repeats(_table(spark, sf_dir, "documents")))


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards (2 regions of 3 racks of 4), and where each goes with one shard more."""
    placed = shards.assign_shards(_table(spark, sf_dir, "documents"), shards.tree(2, 3, 4))
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from all documents in each of their 120 orders, by language."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    fails = filter_audit.text_failures(F.col("text"))
    cells = filter_audit.masks(docs, labels, list(fails.values()), key="doc_id", text="text", part="lang")
    return filter_audit.audit(cells, [*fails, "E"])


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of documents equal but for the case of A-Z, the one of the largest id stays."""
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language differ from each other, and the terms that set each apart."""
    return divergence.source_divergence(_table(spark, sf_dir, "documents"), min_docs=3, top=200)


REGISTRY = {
    "op1_temperature_mixing": op1_temperature_mixing,
    "op2_language_id": op2_language_id,
    "op3_exact_topk": op3_exact_topk,
    "op4_token_output": op4_token_output,
    "op5_token_counts": op5_token_counts,
    "op6_html_text": op6_html_text,
    "op7_decontamination": op7_decontamination,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_shards": op10_shards,
    "op11_filter_audit": op11_filter_audit,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_source_divergence": op13_source_divergence,
}

OP1_SQL = """
with docs as (
  select doc_id, source, coalesce(doc_id::varchar, '') as k,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as n from documents),
totals as (select source, count(*) as n_docs, sum(n)::double as t from docs group by source),
bounds as (select max(t) as hi, min(t) as lo from totals where t > 0),
shares as (
  select s.*, case when t > 0 then pow(t / hi, case when hi <= 2 * lo then 0 else 1 - ln(2) / ln(hi / lo) end) else 0 end as p
  from totals s, bounds),
budget as (select max(t / p) as b from shares where p > 0),
passes as (
  select source, n_docs, t, ceil(sqrt(n_docs))::bigint as blocks,
         case when t > 0 then round(b * p)::bigint // t::bigint else 1 end as q,
         case when t > 0 then round(b * p)::bigint % t::bigint else 0 end as rest
  from shares, budget),
known as (
  select d.*, p.q, p.rest, ('0x' || substr(md5(k), 1, 8))::bigint % p.blocks as block
  from docs d join passes p on d.source is not distinct from p.source),
sums as (
  select source, block, q, rest, sum(n) as cost, ('0x' || substr(md5(block || '/' || q), 1, 8))::bigint as place
  from known group by source, block, q, rest),
ends as (
  select *, sum(cost) over (partition by source order by place, block) as upto from sums),
inside as (
  select k.source, k.k, sum(k.n) as cost, any_value(e.rest - e.upto + e.cost) as room,
         ('0x' || substr(md5(k.k || '/' || k.q || '/d'), 1, 8))::bigint as o
  from known k join ends e on k.source is not distinct from e.source and k.block = e.block
  where e.upto > e.rest and e.rest - e.upto + e.cost > 0 group by k.source, k.k, k.q),
fits as (
  select source, k from (select *, sum(cost) over (partition by source order by o, k) as upto from inside) where upto <= room),
counted as (
  select k.*, k.q + case when e.upto <= e.rest and e.rest > 0 or f.k is not null then 1 else 0 end as epochs
  from known k join ends e on k.source is not distinct from e.source and k.block = e.block
  left join fits f on k.source is not distinct from f.source and k.k = f.k)
select doc_id, source, epoch, ('0x' || substr(md5(block || '/' || epoch), 1, 8))::bigint as place, block, n::bigint as n_tokens
from (select *, unnest(range(epochs)) as epoch from counted)
"""

OP3_SQL = """
with valid as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
  where len(embedding) > 0 and vec_id is not null
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)),
pairs as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
  from valid q join valid c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id and len(q.v) = len(c.v))
select query_id, rank::integer as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from pairs) where rank <= 5
"""

OP7_SQL = """
with lowered as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words from documents),
items as (
  select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words from benchmark where item_id is not null and text is not null),
wins as (
  select distinct item_id, w, list_aggregate(words[i : i + w - 1], 'string_agg', ' ') as win
  from (select item_id, words, least(10, len(words)) as w, unnest(range(1, len(words) - least(10, len(words)) + 2)) as i
        from items where len(words) > 0)),
spots as (
  select d.doc_id, d.i, s.w, list_aggregate(d.words[d.i : d.i + s.w - 1], 'string_agg', ' ') as win
  from (select doc_id, words, unnest(range(1, len(words) + 1)) as i from lowered where len(words) > 0) d
  join (select distinct w from wins) s on d.i + s.w - 1 <= len(d.words)),
hits as (
  select s.doc_id, s.i, s.w, x.item_id from spots s join wins x on s.win = x.win and s.w = x.w),
hit_words as (
  select doc_id, count(distinct p) as n_hit
  from (select doc_id, unnest(range(i, i + w)) as p from (select distinct doc_id, i, w from hits)) group by doc_id),
hit_items as (
  select doc_id, count(distinct item_id) as n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as ids
  from hits group by doc_id)
select l.doc_id, coalesce(len(l.words), 0)::bigint as n_words, coalesce(h.n_hit, 0)::bigint as n_hit,
       coalesce(t.n_items, 0)::bigint as n_items, sha256(coalesce(t.ids, '')) as items_sha256,
       coalesce(h.n_hit, 0) > 0 as contaminated
from lowered l left join hit_words h on l.doc_id = h.doc_id left join hit_items t on l.doc_id = t.doc_id
"""

OP11_SQL = """
with words as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
fails as (
  select d.doc_id, part,
         [len(w) < 100,
          100 * len(list_distinct(w)) < 80 * len(w),
          100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text),
          regexp_matches(text, '[#$%&*|]'),
          coalesce(d.doc_id > min(d.doc_id) over (partition by text), false)] as f,
         coalesce(l.good, 0) as good, coalesce(l.toxic, 0) as toxic
  from words d left join (
    select doc_id, max(coalesce((quality = 1)::int, 0)) as good, max(coalesce((toxic = 1)::int, 0)) as toxic
    from labels group by doc_id) l on d.doc_id = l.doc_id),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as l),
orders as (
  select a.l || b.l || c.l || d.l || e.l as filter_order
  from letters a, letters b, letters c, letters d, letters e
  where a.l not in (b.l, c.l, d.l, e.l) and b.l not in (c.l, d.l, e.l) and c.l not in (d.l, e.l) and d.l <> e.l),
steps as (
  select filter_order, step, substr(filter_order, step, 1) as filter
  from orders, (select unnest([1, 2, 3, 4, 5]) as step)),
first_hit as (
  select d.*, o.filter_order,
         list_min(list_filter([1, 2, 3, 4, 5], lambda i: f[ascii(substr(filter_order, i, 1)) - 64])) as hit
  from fails d, orders o),
counts as (
  select part, s.filter_order, s.step, s.filter,
         count(*) filter (coalesce(hit > s.step, true))::bigint as kept,
         count(*) filter (hit = s.step)::bigint as removed,
         count(*) filter (hit < s.step and f[ascii(s.filter) - 64])::bigint as redundant,
         count(*) filter (f[ascii(s.filter) - 64] and len(list_filter(f, lambda x: x)) = 1)::bigint as unique_fails,
         coalesce(sum(good) filter (hit = s.step), 0)::bigint as good_lost,
         coalesce(sum(toxic) filter (hit = s.step), 0)::bigint as toxic_lost
  from first_hit h join steps s on h.filter_order = s.filter_order group by all)
select *, (sum(removed) over (partition by part, filter))::bigint as shapley from counts
"""

OP12_SQL = """
with folded as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents)
select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
       row_number() over (partition by t order by doc_id desc nulls last) = 1 as kept, sha256(t) as text_sha256
from folded
"""

OP13_SQL = """
with docs as (
  select row_number() over () as d, coalesce(lang, '') as lang, coalesce(source, '') as source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as terms from documents),
uses as (select d, lang, source, unnest(terms) as term from docs),
kept as (select lang, term from uses group by all having count(distinct d) >= 3),
sources as (select distinct lang, source from docs),
counts as (
  select s.lang, s.source, k.term, count(u.d) as n
  from sources s join kept k on s.lang = k.lang
  left join uses u on u.lang = s.lang and u.source = s.source and u.term = k.term group by all),
probs as (
  select *, 1 + (1000000000::hugeint * (n + 1)) // (sum(n) over (partition by lang, source) + count(*) over (partition by lang, source)) as p
  from counts),
lang_counts as (select lang, term, sum(n) as n from counts group by all),
lang_probs as (
  select *, 1 + (1000000000::hugeint * (n + 1)) // (sum(n) over (partition by lang) + count(*) over (partition by lang)) as q
  from lang_counts),
found as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0)::bigint as value
  from sources a join sources b on a.lang = b.lang and a.source <> b.source
  left join probs x on x.lang = a.lang and x.source = a.source
  left join probs y on y.lang = b.lang and y.source = b.source and y.term = x.term
  group by all
  union all
  select g.lang, g.source, 'term', g.term, ((g.p - q) * (g.p - q) // q)::bigint
  from probs g join lang_probs l on g.lang = l.lang and g.term = l.term where g.n > 0 and g.p > q)
select * from (
  select *, row_number() over (partition by lang, source, part order by value desc, item)::integer as rank from found)
where part = 'pair' or rank <= 200
"""

ORACLES = {
    "op1_temperature_mixing": OP1_SQL,
    "op3_exact_topk": OP3_SQL,
    "op7_decontamination": OP7_SQL,
    "op11_filter_audit": OP11_SQL,
    "op12_exact_dedup": OP12_SQL,
    "op13_source_divergence": OP13_SQL,
}
