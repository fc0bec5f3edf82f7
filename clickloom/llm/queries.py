"""One query for each operator of this package, over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import alignment, ann, bpe, chat, exact_dups, jaccard_join, langid, near_dups, packing, quality, token_files, url_filter, whitening
from clickloom.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

KEEP_SCORE = 0.3


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", (langid.remainder(F.col("doc_id"), 4) == 2).alias("held_out"))
    model = langid.train(docs.where(~F.col("held_out")))
    return langid.with_language(docs.drop("lang"), model).drop("text")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    manifest = token_files.write_token_files(docs, scratch_path(spark, "token-files"), public_tokenizers.path("word_bpe_49k.json"))
    return token_files.read_documents(manifest)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)


def op4_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.mark_near_copies(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted_turns(_table(spark, sf_dir, "conversations"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judged_urls(pages).select("page_id", "host", "path", "rule", "verdict", "score")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", (langid.remainder(F.col("doc_id"), 5) == 0).alias("held_out"))
    model = quality.train(docs.where(~F.col("held_out")), _table(spark, sf_dir, "labels"), corpus=docs)
    scored = quality.with_quality(docs, model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= KEEP_SCORE).cast("int").alias("predicted"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_exact_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dups.mark_copies(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.mark_components(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment.aligned(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def queries() -> dict[str, Query]:
    found = [f for name, f in globals().items() if name.startswith("op") and callable(f)]
    return {f.__name__: f for f in sorted(found, key=lambda f: int(f.__name__[2:].split("_")[0]))}


def oracle_sql() -> dict[str, str]:
    return {"op5_chat": _CHAT_SQL, "op9_exact_dups": _EXACT_SQL}


_EXACT_SQL = """
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size, doc_id = max(doc_id) over w as kept,
  sha256(coalesce(text, '')) as text_sha256
from documents window w as (partition by coalesce(text, ''))
"""

_CHAT_SQL = f"""
with turns as (
  select distinct conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
  from conversations where conv_id is not null and turn is not null),
whole as (
  select conv_id, list({{'turn': turn, 'role': role, 'text': text}} order by turn, role, text) as said, count(*) as n
  from turns group by conv_id),
firsts as (select min(conv_id) as conv_id, said, n from whole group by said, n),
kept as (
  select conv_id, n from firsts a
  where not exists (select 1 from whole b where b.n > a.n and b.said[1:a.n] = a.said))
select conv_id, n as n_turns, turn, role,
  concat('{chat.OPEN}', role, chr(10), text, '{chat.CLOSE}', chr(10)) as rendered
from turns join kept using (conv_id)
"""
