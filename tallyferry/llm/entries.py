"""Queries of this subpackage and their SQL."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyferry.llm.bpe import bpe_round_trip
from tallyferry.llm.chat import chat_digests
from tallyferry.llm.decontam import find_leaks
from tallyferry.llm.grammar_store import store_and_read
from tallyferry.llm.katz import score_texts
from tallyferry.llm.licenses import scan
from tallyferry.llm.periodic_runs import word_runs
from tallyferry.llm.quality_model import score_documents
from tallyferry.llm.quality_rules import document_rules
from tallyferry.llm.shared import read, shared_dir
from tallyferry.llm.sharding import assign_shards
from tallyferry.llm.simhash import simhash_components
from tallyferry.llm.token_alignment import align_documents
from tallyferry.llm.token_counts import count_tokens


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(read(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = F.lit("</s>[INST] ok [/INST]")
    added = F.array(*[F.struct(F.lit(-7).alias("conv_id"), F.lit(k).alias("turn"), F.lit(role).alias("role"), control.alias("text")) for k, role in enumerate(("user", "assistant"))])
    extra = spark.range(1, numPartitions=1).select(F.inline(added))
    return chat_digests(turns.unionByName(extra))


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each corpus folder has a cache of its own, which later runs over it reuse."""
    cache = f"{shared_dir(spark)}/token_counts/{hashlib.sha256(sf_dir.encode()).hexdigest()[:16]}"
    return count_tokens(read(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), cache)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read(spark, sf_dir, "documents")).drop("matches")


def op7_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(read(spark, sf_dir, "documents"))


def op8_size_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(read(spark, sf_dir, "documents"), shards=40)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op10_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_rules(read(spark, sf_dir, "documents")).drop("host_rejected")


def op11_grammar_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store_and_read(read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


def op13_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_runs(read(spark, sf_dir, "documents"), plant=True)


CHAT_SQL = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized as (
  select *, length(text) + len(regexp_extract_all(text, '[\[<]\\*(/?INST\]|/?s>|/?SYS>>|TURN=[0-9A-F]*\]|/TURN\])'))
    + case role when 'user' then 13 when 'assistant' then 7 when 'system' then 15
      else 14 + 2 * strlen(role) end as chars from turns)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(chars)::bigint as formatted_chars
from sized group by conv_id
"""

RULES_SQL = r"""
with d as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as t,
    regexp_replace(lower(coalesce(source, '')), '^[a-z]+://|[/?#:].*$', '', 'g') as host from documents),
s as (
  select *, [x for x in regexp_split_to_array(t, '[ \t\n\x0B\f\r]+') if x <> ''] as w,
    [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^ \t\n\x0B\f\r]')] as lines from d),
g as (select rid, unnest(range(1, len(w) - 1)) as i, w from s where len(w) >= 3),
r as (select rid, i, count(*) over (partition by rid, w[i], w[i + 1], w[i + 2]) as c from g),
cov as (select rid, count(distinct j) as n from (select rid, unnest([i, i + 1, i + 2]) as j from r where c > 1) group by rid),
m as (
  select s.rid, doc_id, host, len(w) as n_words, length(list_aggregate(w, 'string_agg', '')) as wc,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols, len(lines) as n_lines,
    len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(cov.n, 0) as n_repeat_words
  from s left join cov on s.rid = cov.rid),
f as (
  select *, coalesce(wc, 0) as word_chars, n_words < 50 as r1, 100 * n_repeat_words > 50 * n_words as r2,
    n_symbols > 0.1 * coalesce(wc, 0) as r3, n_dup_lines > 0.3 * n_lines as r4 from m),
h as (select host, count(*) as n, unnest([1, 2, 3, 4]) as rule,
    unnest([count(*) filter (r1), count(*) filter (r2), count(*) filter (r3), count(*) filter (r4)]) as bad from f group by host),
p as (select rule, avg(bad / n) as m, var_pop(bad / n) as v from h group by rule),
k as (select rule, m, case when v > 0 then least(greatest(m * (1 - m) / v - 1, 1), 1e6) else 1e6 end as k from p),
b as (select distinct host from h join k using (rule) where (bad + m * k) / (n + k) > 0.5)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
  n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, r1 or r2 as base_failed,
  not (r1 or r2) and b.host is null as kept
from f left join b on f.host = b.host
"""

QUERIES = {f.__name__: f for f in (op1_simhash_dedup, op2_quality_classifier, op3_chat_format, op4_bpe_round_trip, op5_token_counts, op6_license_scan, op7_katz_scores, op8_size_shards, op9_decontaminate, op10_host_rules, op11_grammar_files, op12_token_alignment, op13_word_runs)}
ORACLES = {"op3_chat_format": CHAT_SQL, "op10_host_rules": RULES_SQL}
