"""The registered queries of this package: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import re

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from campusgrid.llm.chat import CONTROL, END, SEPARATOR, START, fold_messages, read_back, render
from campusgrid.llm.context_mixing import score_texts
from campusgrid.llm.decontaminate import decontaminate
from campusgrid.llm.fill_in_middle import fill_in_middle, restore
from campusgrid.llm.hash_forest import forest_neighbours
from campusgrid.llm.mixing import mix_sources
from campusgrid.llm.packed_ids import packed_folder, read_documents, write_ids
from campusgrid.llm.pieces import decode, encode
from campusgrid.llm.simhash import simhash_groups
from campusgrid.llm.substring_dedup import remove_repeats
from campusgrid.llm.topk import exact_top_k
from campusgrid.llm.toxicity import toxicity
from campusgrid.llm.whitening import whiten

#: Vocabulary files of the public tokenizers; pass other paths to the operators as needed.
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD_MODEL = public_tokenizers.path("word_bpe_49k.json")

#: Shares of the mixture. Sources are numbered; a source's domain is its number's place in this list.
DOMAINS = ["web", "books", "code", "forum"]
MIX = {
    "domain": {"web": 0.4, "books": 0.3, "code": 0.2, "forum": 0.1},
    "lang": {"en": 0.6, "de": 0.15, "fr": 0.15, "es": 0.1},
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def domain(source: str = "source") -> Column:
    number = F.regexp_extract(F.col(source), r"(\d{1,9})$", 1)
    names = F.array(*[F.lit(d) for d in DOMAINS])
    return F.when(number != "", F.get(names, number.cast("bigint").cast("int") % len(DOMAINS))).otherwise("other")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = decode(encode(docs, PIECE_MODEL, dropout=0.1, seed=1), PIECE_MODEL)
    return coded.select(
        "row.doc_id", F.size("pieces").cast("bigint").alias("n_pieces"), F.xxhash64("pieces").alias("pieces_hash"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select("row.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def conversation_log(rows: DataFrame) -> DataFrame:
    """Each row as the events that made it: an answer is streamed, thrown away and streamed again; any other turn is
    begun and then edited. Rows of one turn follow each other by role and a hash of the text; equal rows are messages of
    their own."""
    text = F.coalesce("text", F.lit(""))
    half = (F.length(text) / 2).cast("int")
    head, tail = F.substr(text, F.lit(1), half), F.substr(text, half + 1)
    event = lambda seq, kind, part: F.struct(F.lit(seq).alias("seq"), F.lit(kind).alias("kind"), part.alias("text"))
    streamed = F.array(event(0, "delta", head), event(1, "regenerate", F.lit("")), event(2, "delta", head), event(3, "delta", tail))
    edited = F.array(event(0, "delta", head), event(1, "edit", text))
    events = F.explode(F.when(F.col("role") == "assistant", streamed).otherwise(edited))
    row = F.monotonically_increasing_id().alias("row")
    rows = rows.withColumn("message", F.struct("turn", "role", F.xxhash64("text").alias("text"), row))
    return rows.select("conv_id", "message", "role", events.alias("e")).select("conv_id", "message", "role", "e.*")


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    added = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(tricky).alias("text"),
    )
    rows = rows.unionByName(added)
    read = read_back(render(fold_messages(conversation_log(rows))))
    listed = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    lost = F.array_join("loss_texts", "")
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(listed, 256).alias("turns_sha256"),
        F.length(lost).cast("bigint").alias("loss_chars"), F.sha2(lost, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op4_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2
    return score_texts(docs, held_out).withColumnRenamed("id", "doc_id")


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, 5)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed = mix_sources(docs, domain(), MIX, budget_share=0.8, max_epochs=2, seed=7)
    return mixed.select(
        "row.doc_id", "domain", "row.lang", "row.source", F.col("epoch").cast("bigint").alias("epoch"), "n_tokens", "take_tokens"
    )


def print_hex(column: str = "print") -> Column:
    """A fingerprint's 16 hex digits, high byte first."""
    digits = F.lower(F.hex(column))
    return F.concat(*[F.substring(digits, i, 2) for i in range(15, 0, -2)])


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return groups.select(F.col("id").alias("doc_id"), print_hex().alias("fingerprint"), "component_id")


def op8_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = packed_folder(docs)
    return read_documents(write_ids(docs, WORD_MODEL, 2, folder), folder)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = toxicity(docs, table(spark, sf_dir, "labels"), keep_text=False)
    return found.select("row.doc_id", "p_low_quality", "p_toxic", (F.col("p_toxic") >= 0.5).alias("toxic"))


def op10_hash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest_neighbours(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, 10)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), 8)
    return found.withColumnRenamed("id", "vec_id").withColumn("deviation", F.col("deviation").try_cast("bigint"))


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"), window=10, keep_text=False)
    return found.select(
        "row.doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = restore(fill_in_middle(docs, seed=7, rate=100, spm=50))
    return made.select(
        "row.doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_chat": op3_chat,
    "op4_context_mixing": op4_context_mixing,
    "op5_exact_top_k": op5_exact_top_k,
    "op6_mixing": op6_mixing,
    "op7_simhash": op7_simhash,
    "op8_packed_ids": op8_packed_ids,
    "op9_toxicity": op9_toxicity,
    "op10_hash_forest": op10_hash_forest,
    "op11_whitening": op11_whitening,
    "op12_decontaminate": op12_decontaminate,
    "op13_fill_in_middle": op13_fill_in_middle,
}

_ROLES = "coalesce(role, '')"
_TEXTS = "coalesce(text, '')"
_MARK = "(<|\\[)(\\\\*)(" + "|".join(re.escape(c[1:]) for c in sorted(CONTROL, key=len, reverse=True)) + ")"
_STUFFED = r"length(regexp_replace({}, '" + _MARK + r"', '\1\\\2\3', 'g'))"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_RUNS = (
    f"regexp_extract_all(translate({_TEXTS}, '{_UPPER}', '{_UPPER.lower()}'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

ORACLE: dict[str, str] = {
    "op2_substring_dedup": r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
     g as (select doc_id, i, array_to_string(ws[i:i + 49], ' ') as w from d, unnest(range(1, len(ws) - 48)) as t(i)),
     f as (select w, min(doc_id) as first from g group by w),
     r as (select distinct doc_id, unnest(range(i, i + 50)) as pos from g join f using (w) where first < doc_id),
     l as (select doc_id, count(*) as n_removed, list(pos) as gone from r group by doc_id)
select d.doc_id, cast(len(ws) as bigint) as n_words, coalesce(n_removed, 0) as n_removed,
       sha256(array_to_string(case when gone is null then ws
              else list_filter(ws, lambda x, i: not list_contains(gone, i)) end, ' ')) as kept_sha256
from d left join l using (doc_id)
""",
    "op3_chat": f"""
with c as (select conv_id, turn, {_ROLES} as role, {_TEXTS} as text from conversations
           union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
           union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]')
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn) filter (role = 'assistant'), '')) as loss_sha256,
       cast(sum({len(START + SEPARATOR + END)} + {_STUFFED.format('role')} + {_STUFFED.format('text')}) as bigint) as formatted_chars
from c group by conv_id
""",
    "op5_exact_top_k": """
with v as (select vec_id, list_transform(embedding, lambda x: floor(256.0::double * x::double)) as e from embeddings
           where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
     s as (select q.vec_id as query_id, v.vec_id as vec_id, cast(list_dot_product(q.e, v.e) as bigint) as score
           from v as q, v where q.vec_id % 50 = 0 and q.vec_id <> v.vec_id)
select query_id, cast(rank as integer) as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s) where rank <= 5
""",
    "op12_decontaminate": rf"""
with i as (select item_id, {_RUNS} as ws from benchmark),
     w as (select distinct item_id, k, array_to_string(ws[a:a + k - 1], ' ') as g
           from (select *, least(len(ws), 10) as k from i where len(ws) > 0), unnest(range(1, len(ws) - k + 2)) as t(a)),
     d as (select doc_id, {_RUNS} as ws from documents),
     o as (select doc_id, a, k, array_to_string(ws[a:a + k - 1], ' ') as g
           from d, (select distinct k from w), unnest(range(1, len(ws) - k + 2)) as t(a)),
     h as (select doc_id, a, k, item_id from o join w using (k, g)),
     p as (select doc_id, count(*) as n_hit from (select distinct doc_id, unnest(range(a, a + k)) as pos from h) group by doc_id),
     m as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as ids
           from (select distinct doc_id, cast(item_id as varchar) as item from h) group by doc_id)
select doc_id, cast(len(ws) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join p using (doc_id) left join m using (doc_id)
""",
    "op13_fill_in_middle": f"""
with d as (select doc_id, {_TEXTS} as text, regexp_extract_all({_TEXTS}, '[^\\n]*\\n|[^\\n]+') as u, sha256('7:' || doc_id) as h from documents),
     k as (select *, len(u) as n, {', '.join(f"cast('0x' || h[{8 * i + 1}:{8 * i + 8}] as bigint) as h{i + 1}" for i in range(4))} from d),
     c as (select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
           case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') then 'plain'
                when h4 % 100 < 50 then 'spm' else 'psm' end as form from k),
     p as (select *, array_to_string(u[1:a], '') as prefix, array_to_string(u[a + 1:b], '') as middle,
           array_to_string(u[b + 1:], '') as suffix from c)
select doc_id, cast(n as bigint) as n, form, case when form <> 'plain' then cast(length(prefix) as bigint) end as prefix_chars,
       case when form <> 'plain' then cast(length(middle) as bigint) end as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
       sha256(text) as restored_sha256
from p
""",
}
