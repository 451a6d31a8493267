"""The registered queries of the corpus operators, with SQL twins where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import ann, divergence, kneser_ney, language, lines, merkle, ngram_join, packing, pieces, quality, rules, textbatch, toxicity, warc


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    textbatch.small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    specials = packing.special_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, specials)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents", "doc_id", "text"), _table(spark, sf_dir, "labels", "doc_id", "quality"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(_table(spark, sf_dir, "documents", "doc_id", "text"), _table(spark, sf_dir, "labels", "doc_id", "toxic"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.classify(_table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = rules.judge(_table(spark, sf_dir, "documents", "doc_id", "text"))
    return docs.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.deduplicate(_table(spark, sf_dir, "documents", "doc_id", "text", "source"))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.cluster(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return ann.nearest(vectors, vectors.where("vec_id % 100 = 0"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(_table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents", "text", "lang", "source"))


def op12_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.score_documents(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.documents_manifest(_table(spark, sf_dir, "documents", "doc_id", "source", "lang", "n_chars", "text"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_quality_rules,
        op3_warc,
        op4_language_id,
        op5_quality_classifier,
        op6_line_dedup,
        op7_nearest_neighbours,
        op8_toxicity,
        op9_ngram_jaccard_join,
        op10_sentencepiece,
        op11_source_divergence,
        op12_kneser_ney,
        op13_merkle_manifest,
    )
}
ORACLES: dict[str, str] = {
    "op2_quality_rules": r"""
with d as (select doc_id, coalesce(text, '') as text from documents),
w as (select doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from d),
win as (select doc_id, i, list_slice(words, i, i + 4) as g from (select doc_id, words, unnest(range(1, len(words) - 3)) as i from w)),
again as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as n from win) where n > 1),
covered as (select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + 5)) as p from again) group by doc_id),
s as (
  select w.doc_id, w.text, cast(len(words) as bigint) as n_words, cast(length(list_aggregate(list_concat(words, ['']), 'string_agg', '')) as bigint) as word_chars,
    cast(len(regexp_extract_all(text, '[#*$%&|<>]')) as bigint) as n_symbols, cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines, cast(coalesce(covered.n, 0) as bigint) as n_repeat_words
  from w left join covered using (doc_id)),
b as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed, len(regexp_extract_all(text, '\p{L}')) as letters, len(regexp_extract_all(text, '\p{Lu}')) as capitals from s)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not (base_failed or 100 * n_symbols > 25 * n_words or word_chars < 2 * n_words or word_chars > 40 * n_words or 100 * n_dup_lines > 30 * len(string_split(text, chr(10)))
    or 100 * (length(text) - length(replace(text, '!', ''))) > 30 * n_words or 100 * capitals > 50 * letters or 100 * letters < 50 * word_chars) as kept
from b""",
    "op3_warc": """
with p as (select page_id, coalesce(html, '') as html, strlen(coalesce(html, '')) as payload_bytes from pages),
m as (select *, max(page_id) over (partition by html) as first_id from p)
select page_id, payload_bytes, sha1(html) as payload_digest,
  case when payload_bytes >= 1000 and page_id < first_id then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 1000 and page_id < first_id then first_id end as refers_to
from m""",
    "op6_line_dedup": r"""
with l as (
  select doc_id, coalesce(source, '') as site, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as pos from documents where text is not null),
b as (select doc_id, site, line, pos, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as bare from l),
spread as (select bare from b where length(bare) >= 20 group by bare having count(distinct site) >= 10),
r as (select b.*, spread.bare is not null as hit, row_number() over (partition by b.bare order by doc_id, pos) as k from b left join spread on b.bare = spread.bare),
j as (
  select doc_id, string_agg(line, chr(10) order by pos) filter (where not hit or k = 1) as text, count(*) as n_lines, count(*) filter (where hit and k > 1) as n_removed from r group by doc_id)
select d.doc_id, case when d.text is null then null else coalesce(j.text, '') end as text, d.source, coalesce(n_lines, 0) as n_lines, coalesce(n_removed, 0) as n_removed
from documents d left join j using (doc_id)""",
    "op11_source_divergence": r"""
with d as (select row_number() over () as row, coalesce(text, '') as text, coalesce(lang, '') as lang, coalesce(source, '') as source from documents),
w as (select row, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
t as (select lang, term, count(*) as n from w group by all having count(distinct row) >= 3),
s as (select distinct lang, source from d),
c as (select s.lang, s.source, t.term, coalesce(k.n, 0) as n, t.n as total from s join t on t.lang = s.lang left join (select lang, source, term, count(*) as n from w group by all) k on k.lang = s.lang and k.source = s.source and k.term = t.term),
p as (
  select *, 1 + (1000000000 * (n + 1)::hugeint) // (sum(n) over g + count(*) over g) as p, 1 + (1000000000 * (total + 1)::hugeint) // (sum(total) over g + count(*) over g) as q
  from c window g as (partition by lang, source)),
pair as (
  select a.lang, a.source, b.source as item, coalesce(f.value, 0) as value
  from s a join s b on a.lang = b.lang and a.source <> b.source
  left join (select x.lang, x.source, y.source as item, sum((x.p - y.p) * (x.p - y.p) // y.p) as value from p x join p y on x.lang = y.lang and x.term = y.term group by all) f on f.lang = a.lang and f.source = a.source and f.item = b.source),
every as (
  select lang, source, 'pair' as part, item, value from pair
  union all select lang, source, 'term', term, (p - q) * (p - q) // q from p where n > 0 and p > q)
select lang, source, part, item, cast(value as bigint) as value, cast(row_number() over (partition by lang, source, part order by value desc, item) as int) as rank
from every qualify part = 'pair' or rank <= 200""",
    "op13_merkle_manifest": r"""
with recursive
table_ as (select list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by n) as crc from (select unnest(range(256)) as n)),
d as (
  select doc_id, source, lang, n_chars, text,
    case when xor(list_reduce(list_concat([4294967295], list_transform(string_split(cast(doc_id as varchar), ''), lambda x: cast(ord(x) as bigint))), lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) % 3 = 0
      then translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else text end as claimed
  from documents, table_),
h as (
  select doc_id, lang, sha256(four || case when text is null then '-' else strlen(text) || ':' || text end) as leaf, sha256(four || case when claimed is null then '-' else strlen(claimed) || ':' || claimed end) as claimed
  from (select *, concat(case when doc_id is null then '-' else strlen(doc_id::varchar) || ':' || doc_id end, case when source is null then '-' else strlen(source) || ':' || source end, case when lang is null then '-' else strlen(lang) || ':' || lang end, case when n_chars is null then '-' else strlen(n_chars::varchar) || ':' || n_chars end) as four from d)),
l as (select *, row_number() over (partition by lang order by doc_id nulls first, leaf, claimed) - 1 as pos from h),
tree as (
  select lang, 0 as level, list(leaf order by pos) as nodes from l group by lang
  union all select lang, level + 1, list_transform(range(0, len(nodes), 8), lambda i: sha256(array_to_string(nodes[i + 1 : i + 8], ''))) from tree where len(nodes) > 1),
sub as (select lang, nodes[1] as subroot, row_number() over (order by lang nulls first) - 1 as place from tree where len(nodes) = 1),
top as (
  select 0 as level, list(subroot order by place) as nodes from sub
  union all select level + 1, list_transform(range(0, len(nodes), 8), lambda i: sha256(array_to_string(nodes[i + 1 : i + 8], ''))) from top where len(nodes) > 1),
height as (select lang, max(level) as levels from tree group by lang),
step as (
  select l.lang, l.pos, t.level, t.nodes, l.pos // (8 ** t.level)::bigint as spot from l join tree t on t.lang is not distinct from l.lang where len(t.nodes) > 1
  union all
  select l.lang, l.pos, h.levels + t.level, t.nodes, s.place // (8 ** t.level)::bigint from l join sub s on s.lang is not distinct from l.lang join height h on h.lang is not distinct from l.lang cross join top t where len(t.nodes) > 1),
side as (select lang, pos, level, array_to_string(nodes[spot // 8 * 8 + 1 : spot], '') as before, array_to_string(nodes[spot + 2 : spot // 8 * 8 + 8], '') as after from step),
proof as (select lang, pos, sha256(string_agg(before || after, '' order by level)) as proof_sha256 from side group by all),
fold as (
  select lang, pos, 0 as level, claimed as node from l
  union all select f.lang, f.pos, f.level + 1, sha256(s.before || f.node || s.after) from fold f join side s on s.lang is not distinct from f.lang and s.pos = f.pos and s.level = f.level),
done as (select lang, pos, arg_max(node, level) as folded_root from fold group by all),
one as (select nodes[1] as root from top where len(nodes) = 1)
select l.doc_id, l.leaf, sub.subroot, one.root, coalesce(proof.proof_sha256, sha256('')) as proof_sha256, done.folded_root, done.folded_root = one.root as verified
from l join sub on sub.lang is not distinct from l.lang join done on done.lang is not distinct from l.lang and done.pos = l.pos left join proof on proof.lang is not distinct from l.lang and proof.pos = l.pos cross join one""",
}
