"""One query per operator over the whole given tables, with production parameters."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineark.llm import bpe_codec, conversation_repair, decontaminate, hard_negatives, license_scan, lm_score, ngram_join, quality, secret_scan, source_mix, token_counts, topk_codes, url_filter
from lineark.llm.common import table
from lineark.session import shared_dir, ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

BPE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
TOKEN_LIMIT = 4096

# Fixed values: (verdict, host, path).
URL_RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/"))


def query(fn):
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        shared_dir(spark)
        ship_package(spark)
        return fn(spark, sf_dir)
    QUERIES[fn.__name__] = run
    return fn


@query
def op1_secret_scan(spark, sf_dir):
    """Every candidate of every text with the forest's score and decision."""
    found = secret_scan.secret_scan(table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return found.select("doc_id", "i", "start", "end", F.sha2(F.col("value").cast("binary"), 256).alias("value_sha256"),
                        "score", "is_secret")


@query
def op2_bpe_codec(spark, sf_dir):
    coded = bpe_codec.encode(table(spark, sf_dir, "documents", "doc_id", "text"), BPE_RANKS, public_tokenizers.PATTERN)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op3_quality(spark, sf_dir):
    return quality.quality(table(spark, sf_dir, "documents", "doc_id", "text", "n_chars"), table(spark, sf_dir, "labels", "doc_id", "quality"))


@query
def op4_ngram_join(spark, sf_dir):
    return ngram_join.ngram_join(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op5_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents", "doc_id", "text"), PIECE_MODEL, TOKEN_LIMIT)


@query
def op6_license_scan(spark, sf_dir):
    return license_scan.license_scan(table(spark, sf_dir, "documents", "doc_id", "text")).drop("spans")


@query
def op7_url_filter(spark, sf_dir):
    return url_filter.url_filter(table(spark, sf_dir, "pages", "page_id", "url"), URL_RULES)


@query
def op8_topk_codes(spark, sf_dir):
    return topk_codes.top_k(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


@query
def op9_decontaminate(spark, sf_dir):
    """One row per document and benchmark item that overlap; documents without a row are clean."""
    found = decontaminate.overlaps(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.select("doc_id", "item_id", "n_hits", "n_matched", "first_word")


@query
def op10_lm_score(spark, sf_dir):
    return lm_score.lm_score(table(spark, sf_dir, "documents", "doc_id", "text"), PIECE_MODEL)


@query
def op11_source_mix(spark, sf_dir):
    return source_mix.taken(table(spark, sf_dir, "documents", "doc_id", "text", "source"))


@query
def op12_hard_negatives(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors.withColumn("label", label))


def damaged(turns: DataFrame) -> DataFrame:
    """``conversations`` (conv_id, turn, role, text) with the faults that the CRC of ``conv_id:turn`` modulo 20 deals out:
    0 ``gone``, 1 no text, 2 no ``.!?``, 3 twice, 4 role user.  A null is one space."""
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.pmod(F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")), F.lit(20)).cast("int")
    rows = turns.select("conv_id", "turn", filled("role").alias("role"), filled("text").alias("text"), fate.alias("fate"))
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fate") == 4, "user").otherwise(F.col("role"))
    times = F.sequence(F.lit(1), F.when(F.col("fate") == 3, 2).otherwise(1))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("fate") == 0).alias("gone"), F.explode(times).alias("copy")).drop("copy")


@query
def op13_conversation_repair(spark, sf_dir):
    return conversation_repair.repair(damaged(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")), gone_col="gone")


ORACLES["op8_topk_codes"] = """
with code as (select distinct vec_id, list_transform(embedding, lambda x: case when x > 0 then 1 else 0 end) c
              from embeddings where embedding is not null and vec_id is not null),
pairs as (select q.vec_id query_id, n.vec_id neighbour_id,
                 cast(list_sum(list_transform(list_zip(q.c, n.c), lambda z: case when z[1] <> z[2] then 1 else 0 end)) as integer) distance
          from code q join code n on q.vec_id <> n.vec_id where q.vec_id % 50 = 0),
ranked as (select *, cast(row_number() over (partition by query_id order by distance, neighbour_id) as integer) rank from pairs)
select query_id, rank, neighbour_id, distance from ranked where rank <= 10
"""

ORACLES["op11_source_mix"] = r"""
with docs as (select row_number() over () row_id, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) size,
                     md5('mix:' || coalesce(cast(doc_id as varchar), '')) key from documents),
total as (select coalesce(sum(size), 0)::bigint budget from docs),
sizes as (select source, sum(size)::bigint source_size, row_number() over (order by source nulls last) nth from docs group by source),
weighed as (select *, [1, 2, 3][((nth - 1) % 3) + 1] weight, source_size * 3 most from sizes),
ratios as (select *, most::double / weight ratio from weighed),
sums as (select *, sum(weight) over o weight_up, sum(most) over o most_up, sum(weight) over () weights
         from ratios window o as (order by ratio, nth rows unbounded preceding)),
levels as (select *, (budget - (most_up - most))::double / (weights - weight_up + weight)::double level from sums, total),
level as (select (select level from levels where level <= ratio order by ratio, nth limit 1) level),
aims as (select source, source_size, nth, case when level is null then most::double else least(most::double, level * weight) end target from ratios, level),
placed as (select d.*, a.source_size, a.nth, a.target, sum(size) over (partition by d.source order by key, doc_id, size, row_id rows unbounded preceding)::bigint up
           from docs d join aims a on d.source is not distinct from a.source),
rounds as (select *, unnest(range(case when target > 0 then greatest(ceil(target / source_size), 1)::bigint else 1 end)) round from placed),
queue as (select *, case when target > 0 then (round * source_size + up)::double / target else 0 end finish from rounds),
sent as (select *, sum(size) over (order by finish, nth, round, key, doc_id, size, row_id rows unbounded preceding) sent from queue)
select any_value(doc_id) doc_id, any_value(size)::bigint size, any_value(source_size) source_size, any_value(target) target,
       sum(case when sent <= budget then size else 0 end)::bigint taken, count(*) filter (where sent <= budget) rounds
from sent, total group by row_id
"""

ORACLES["op12_hard_negatives"] = """
with rows as (select distinct vec_id id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end label,
                     list_transform(embedding, lambda x: floor(256 * cast(x as double))) v
              from embeddings where vec_id is not null and label is not null and embedding is not null
                   and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (select a.id anchor_id, b.id id, a.label = b.label same, cast(list_dot_product(a.v, b.v) as bigint) score
           from rows a join rows b on a.id <> b.id where a.id % 50 = 0),
positive as (select anchor_id, id positive_id, score positive_score from scored where same
             qualify row_number() over (partition by anchor_id order by score desc, id) <= 5),
paired as (select anchor_id, positive_id, id negative_id, positive_score, score negative_score,
                  cast(row_number() over (partition by anchor_id, positive_id order by score desc, id) as integer) rank
           from positive join scored using (anchor_id)
           where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from paired where rank <= 3
"""

ORACLES["op13_conversation_repair"] = r"""
with recursive keyed as (select conv_id, turn, coalesce(role, ' ') as role0, coalesce(text, ' ') as text0,
       list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda c: ascii(c)::bigint) codes from conversations),
fated as (select *, xor(list_reduce(list_prepend(4294967295::bigint, codes), lambda c, b:
              list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: case when x % 2 = 1 then xor(x // 2, 3988292384::bigint) else x // 2 end)),
              4294967295::bigint) % 20 fate from keyed),
damaged as (select conv_id, turn, case when fate = 4 then 'user' else role0 end as role,
                   case when fate = 1 then '' when fate = 2 then translate(text0, '.!?', '') else text0 end as text,
                   unnest(range(case when fate = 3 then 2 else 1 end)) copy from fated where fate <> 0),
placed as (select *, row_number() over (partition by conv_id order by turn nulls first, role, md5(text), copy) n, rtrim(text, E' \t\n\x0b\f\r') body from damaged),
seen as (select *, row_number() over (partition by conv_id, role, text order by n) nth, lead(role) over (partition by conv_id order by n) next_role from placed),
faulty as (select *, case when body = '' then 'b' when nth > 1 then 'd' when right(body, 1) not in ('.', '!', '?') then 't' else '' end fault,
                  left(role, 1) initial from seen),
figures as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint gaps, count(*) filter (where fault = 'b') blank,
                   count(*) filter (where fault = 'd') duplicate, count(*) filter (where fault = 't') truncated,
                   count(*) filter (where next_role is not null and initial || left(next_role, 1) not in ('su', 'ua', 'au')) illegal, count(*) n
            from faulty group by conv_id),
due(q, to_q, name) as (values (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')),
inserts as (select q from_q, q to_q, 0 added, '' letters, '' as texts from due
            union all select q, to_q, 5, 'I', chr(10) || name || ':' from due
            union all select a.q, b.to_q, 10, 'II', chr(10) || a.name || ':' || chr(10) || b.name || ':' from due a join due b on b.q = a.to_q),
path(conv_id, i, q, cost, audit, texts) as (
  select conv_id, 0::bigint, 0, 0, '', '' from figures
  union all
  select conv_id, i, q, cost, audit, texts from (
    select *, row_number() over (partition by conv_id, i, q order by cost, audit) best from (
      select p.conv_id, p.i + 1 i, case l.letter when 'D' then s.to_q when 'R' then d.to_q else case when f.initial = 's' then 1 else d.to_q end end q,
             p.cost + s.added + case l.letter when 'D' then 2 when 'R' then 1 else 0 end + case when l.letter <> 'D' and f.fault = 't' then 5 else 0 end as cost,
             p.audit || s.letters || l.letter audit,
             p.texts || s.texts || case l.letter when 'D' then '' when 'R' then chr(10) || d.name || ':' || f.text else chr(10) || f.role || ':' || f.text end texts
      from path p join faulty f on f.conv_id is not distinct from p.conv_id and f.n = p.i + 1 join inserts s on s.from_q = p.q join due d on d.q = s.to_q
           cross join (values ('D'), ('K'), ('R')) l(letter)
      where l.letter = 'D' or f.fault in ('', 't') and (l.letter = 'R' or f.initial = 's' and s.to_q = 0 or f.initial = left(d.name, 1)))) where best = 1),
goal as (select p.conv_id, p.cost + s.added as cost, p.audit || s.letters audit, p.texts || s.texts texts
         from path p join figures f on f.conv_id is not distinct from p.conv_id and f.n = p.i join inserts s on s.from_q = p.q where s.to_q in (0, 3)
         qualify row_number() over (partition by p.conv_id order by p.cost + s.added, p.audit || s.letters) = 1)
select c.conv_id, coalesce(gaps, 0) gaps, coalesce(blank, 0) blank, coalesce(duplicate, 0) duplicate, coalesce(truncated, 0) truncated,
       coalesce(illegal, 0) illegal, coalesce(cost, 0)::bigint as cost, coalesce(audit, '') audit, sha256(substr(coalesce(texts, ''), 2)) repaired_sha256
from (select distinct conv_id from conversations) c left join figures f on f.conv_id is not distinct from c.conv_id
     left join goal g on g.conv_id is not distinct from c.conv_id
"""
