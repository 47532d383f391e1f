"""Queries over the test tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions.labels import language_name, source_name, subject_name
from foliant.llm import encoding, language, leak, mix, neighbours, scans, split, tokens
from foliant.session import cut, table

MODEL, DIMENSIONS = "shelf-embed-v2", 64


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return encoding.find_garbled(table(spark, d, "embeddings_pages"), "id", "raw_text").select("id")


def p1_restored(spark: SparkSession, d: str) -> DataFrame:
    return encoding.find_garbled(table(spark, d, "embeddings_pages"), "id", "raw_text")


def _current(spark: SparkSession, d: str) -> DataFrame:
    return neighbours.current_vectors(table(spark, d, "embeddings_vectors"), "chunk_id", "embedding", DIMENSIONS, ("embedding_model", MODEL), "created_at")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    rows = cut(neighbours.encoded(_current(spark, d), DIMENSIONS))
    probes = table(spark, d, "similarity_probes").select(F.col("chunk_id").alias("id")).distinct()
    found = neighbours.top_k_stored(rows, rows.join(probes, "id", "left_semi"), 5, DIMENSIONS)
    return found.select(F.col("query_id").alias("chunk_id"), F.col("id").alias("neighbour_chunk_id"))


def p2_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """Queries: the vectors whose id is divisible by 100; rows: all."""
    rows = cut(neighbours.encoded(neighbours.current_vectors(table(spark, d, "embeddings"), "vec_id", "embedding", DIMENSIONS), DIMENSIONS))
    found = neighbours.top_k_stored(rows, rows.where(F.col("id") % 100 == 0), 10, DIMENSIONS)
    return found.select(F.col("query_id").alias("vec_id"), F.col("id").alias("neighbour_id"), F.col("rank"))


P2_NEIGHBOURS = """
with v as (select vec_id, list_transform(embedding, lambda x: x::double) e from embeddings where embedding is not null),
s as (select q.vec_id, v.vec_id as neighbour_id, list_cosine_similarity(q.e, v.e) as s from v q join v on q.vec_id <> v.vec_id where q.vec_id % 100 = 0)
select vec_id, neighbour_id, cast(row_number() over (partition by vec_id order by s desc, neighbour_id) as integer) as rank
from s qualify rank <= 10"""


def p5_token_budget(spark: SparkSession, d: str) -> DataFrame:
    """Tokens by source, language and subject, of the corpus and of the pages of books, whose labels are those of the newest state of the book."""
    of_texts = tokens.token_budget(table(spark, d, "documents"), "text", {"source": source_name(F.col("source")), "language": F.coalesce(language_name(F.col("lang")), F.lit("unknown")), "subject": subject_name(F.col("subject"))})
    books = table(spark, d, "embeddings_documents").groupBy("id").agg(F.max_by(F.struct("source_type", "primary_language", "subject"), "updated_at").alias("b")).select("id", "b.*")
    pages = tokens.token_budget(table(spark, d, "embeddings_pages"), "raw_text", {"document_id": F.col("document_id")})
    labelled = pages.join(books, pages.document_id == books.id, "left").select(
        source_name(F.col("source_type")).alias("source"), F.coalesce(language_name(F.col("primary_language")), F.lit("unknown")).alias("language"), subject_name(F.col("subject")).alias("subject"), "items", "blank_items", "tokens"
    )
    of_pages = labelled.groupBy("source", "language", "subject").agg(*[F.sum(c).alias(c) for c in ("items", "blank_items", "tokens")])
    return of_texts.select(F.lit("documents").alias("corpus"), "*").unionByName(of_pages.select(F.lit("pages").alias("corpus"), "*"))


def p5_page_tokens(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings_pages").select("id", "document_id", tokens.token_count(F.col("raw_text")).alias("estimated_tokens"))


def _scan_tables(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    pages = table(spark, d, "embeddings_pages").select("id", "document_id", "page_number", F.col("raw_text").alias("text"), "metadata")
    states = table(spark, d, "embeddings_documents")
    books = states.select(F.col("id").alias("document_id"), F.explode(F.array_distinct(F.array("title", "book_title"))).alias("title")).distinct()
    rows = table(spark, d, "embeddings_book_chapters")
    chapters = rows.select("document_id", F.explode(F.array("chapter_title", "unit_title", "section_title", "lesson_title")).alias("title"), F.col("pdf_start_page").alias("start_page")).distinct()
    return pages, books, chapters


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    pages, books, chapters = _scan_tables(spark, d)
    return scans.find_noise(pages, books, chapters)


def p6_mended(spark: SparkSession, d: str) -> DataFrame:
    pages, books, chapters = _scan_tables(spark, d)
    return scans.mended_pages(pages, books, chapters)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return language.wrong_labels(table(spark, d, "embeddings_pages"), "id", "raw_text", "detected_language")


def p7_page_languages(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "embeddings_pages")
    found = language.label_languages(pages, "id", "raw_text", language.learn(pages, "id", "raw_text", "detected_language"))
    return found.select("id", "language", F.round("confidence", 6).alias("confidence"), F.to_json("segments").alias("segments"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leak.find_leaks(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_items"), "item_id", "passage").select("doc_id", "item_id")


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    found = leak.find_leaks(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_items"), "item_id", "passage")
    return found.groupBy("item_id").agg(F.count(F.lit(1)).alias("documents"), F.max("share").alias("largest_share"))


def _mixture(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "source", language_name(F.col("lang")).alias("language"), subject_name(F.col("subject")).alias("topic"), tokens.encoded_count(F.col("text")).alias("tokens"))
    return mix.mixture(docs, "doc_id", table(spark, d, "mix_targets"))


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    return _mixture(spark, d).select("doc_id", "source", "tokens", F.round("expected_copies", 9).alias("expected_copies"), "copies")


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mix.shares(_mixture(spark, d), table(spark, d, "mix_targets"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return split.oversized(table(spark, d, "documents"), "doc_id", "text")


def p10_pieces(spark: SparkSession, d: str) -> DataFrame:
    return split.split_documents(table(spark, d, "documents"), "doc_id", "text")


#: Words as leak.words() gives them. The characters between two matches of a broken line's end are too few to share.
_WORDS = r"""regexp_extract_all(lower(translate(regexp_replace(regexp_replace(nfc_normalize({0}), '(\S)[-‐‑\x{AD}¬][^\S\n]*\r?\n\s*([\p{L}\p{N}_])', '\1\2', 'g'),
'[-‐‑\x{AD}¬''’‘ʼ\x{200C}\x{200D}\x{FEFF}\x{200B}]+', '', 'g'), '०१२३४५६७८९_', '0123456789 ')), '[\p{L}\p{N}\p{M}]+')"""
P8_FOUND = f"""with d as (select doc_id, {_WORDS.replace("{0}", "text")} as ws from documents where length(text) > 0), i as (select distinct item_id, {_WORDS.replace("{0}", "passage")} as ws from eval_items where passage is not null),
g as (select distinct doc_id, array_to_string(list_slice(ws, k, k + 5), ' ') as g from (select doc_id, ws, unnest(range(1, len(ws) - 4)) as k from d where len(ws) >= 6)),
h as (select item_id, len(ws) as n, k, array_to_string(list_slice(ws, k, k + 5), ' ') as g from (select item_id, ws, unnest(range(1, len(ws) - 4)) as k from i where len(ws) >= 6)),
c as (select distinct doc_id, item_id, n, unnest(range(k, k + 6)) as at from g join h using (g))
select doc_id, item_id from c group by doc_id, item_id, n having count(*) >= n / 2.0"""

QUERIES = {f.__name__: f for f in (p1_found, p1_restored, p2_found, p2_neighbours, p5_token_budget, p5_page_tokens, p6_found, p6_mended, p7_found, p7_page_languages, p8_found, p8_report, p9_mixture, p9_shares, p10_found, p10_pieces)}
SQL = {"p2_neighbours": P2_NEIGHBOURS, "p8_found": P8_FOUND}
