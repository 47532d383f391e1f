"""Queries of the operators that fold text, read JSON, embed, export and check; few of them fit SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions import text as X
from foliant.operators import chunking, contents, embedding, export, search, structure, tables, validate
from foliant.plans.reference import books, pages, t
from foliant.session import cut, table
from foliant.sources import json_books

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def newest_pages(spark: SparkSession, d: str) -> DataFrame:
    """Each page of a book once, as stored last. Which that is is told by slim rows; the texts are read once and joined to their ids."""
    p = pages(spark, d)
    ids = p.groupBy("document_id", "page_number").agg(F.max_by("id", F.struct("created_at", "id")).alias("id")).select("id")
    return p.select("id", "document_id", "page_number", "raw_text").join(ids, "id", "left_semi")


NEWEST = "newest as (select * from embeddings_pages qualify row_number() over (partition by document_id, page_number order by created_at desc, id desc) = 1)"


def _chunks(spark, d):
    p = newest_pages(spark, d)
    return chunking.chunk_books(p, t(spark, d, "book_chapters"), chunking.profiles(p, books(spark, d)))


@query()
def chunk_documents(spark, d):
    return _chunks(spark, d)


@query()
def chunk_enrichment(spark, d):
    c = chunking.enrich(_chunks(spark, d), books(spark, d))
    return c.select("id", "document_id", "chunk_index", "chunk_type", "pedagogical_role", "content_domain", "detected_language", "word_count", "token_count", "char_count", "has_formula", "has_questions", "source_label", "citation_text", "embedding_input_hash", F.array_join("keywords", ",").alias("keywords"))


@query()
def chunk_embeddings(spark, d):
    v = embedding.embed(t(spark, d, "chunks"), "id", "content", embedding.HashEmbedder(64))
    return v.select("id", "embedding_model", "embedding_dimensions", "embedding_input_hash", F.md5(F.array_join(F.transform("embedding", lambda x: F.format_number(x, 5)), ",")).alias("digest"))


SUB_LABELS = {"Chapter": "chapter_title", "Unit": "unit_title", "Section": "section_title", "Subsection": "subsection_title"}


@query("select id, sha256(" + " || ".join(f"case when nullif(trim({c}), '') is not null then '{k}: ' || {c} || chr(10) else '' end" for k, c in SUB_LABELS.items()) + ") as input_hash from embeddings_book_subsections")
def subsection_embedding_input(spark, d):
    lines = [F.when(structure.filled(F.col(c)).isNotNull(), F.concat(F.lit(f"{k}: "), F.col(c), F.lit("\n"))).otherwise("") for k, c in SUB_LABELS.items()]
    return t(spark, d, "book_subsections").select("id", F.sha2(F.concat(*lines), 256).alias("input_hash"))


def _nodes(spark, d):
    from foliant.operators import nested

    return cut(nested.flatten(table(spark, d, "raw_book_records"), "raw_id", "payload"))


@query()
def json_metadata(spark, d):
    return json_books.metadata(_nodes(spark, d))


@query()
def json_structure(spark, d):
    return json_books.structure_records(_nodes(spark, d)).drop("text")


@query()
def json_subsections(spark, d):
    return json_books.subsections(_nodes(spark, d))


@query()
def json_pages(spark, d):
    return json_books.book_pages(_nodes(spark, d))


@query()
def title_openings(spark, d):
    return contents.openings(newest_pages(spark, d), t(spark, d, "book_chapters"))


@query()
def repaired_ranges(spark, d):
    return contents.repair_whole(t(spark, d, "book_chapters"), newest_pages(spark, d))


@query("""with k as (select distinct document_id, coalesce(nullif(trim(regexp_replace(lower(coalesce(chapter_title, section_title)), '[^\\p{L}\\p{N}_ऀ-ॿ]+', ' ', 'g')), ''), '') as t, detected_by from embeddings_book_chapters),
a as (select distinct document_id, t from k where t <> '' and detected_by like '%toc%'), b as (select distinct document_id, t from k where t <> '' and detected_by not like '%toc%')
select document_id, count(a.t) as n_a, count(b.t) as n_b, count(*) filter (a.t is not null and b.t is not null) as shared from a full join b using (document_id, t) group by document_id""")
def detection_agreement(spark, d):
    r = t(spark, d, "book_chapters")
    return contents.agreement(r.where("detected_by like '%toc%'"), r.where("detected_by not like '%toc%'"))


@query("""with k as (select *, coalesce(nullif(trim(regexp_replace(lower(coalesce(chapter_title, section_title)), '[^\\p{L}\\p{N}_ऀ-ॿ]+', ' ', 'g')), ''), '') as t from embeddings_book_chapters)
select id, epoch_us(updated_at) as updated_us from k where confidence >= 0.7 union all select id, epoch_us(updated_at) from k a where (confidence < 0.7 or confidence is null) and not exists (select 1 from k b where b.confidence >= 0.7 and b.document_id = a.document_id and b.t = a.t)""")
def toc_merge_missing(spark, d):
    r = t(spark, d, "book_chapters")
    merged = contents.merge_missing(r.where("confidence >= 0.7"), r.where("confidence < 0.7 or confidence is null"))
    return merged.select("id", F.unix_micros("updated_at").alias("updated_us"))


@query()
def export_nested(spark, d):
    j = export.nested_books(books(spark, d), t(spark, d, "book_chapters"), newest_pages(spark, d))
    return j.select("document_id", "part", F.sha2("json", 256).alias("digest"), F.length("json").alias("characters"))


@query("""select 'no_pages' as rule, count(*) as violations from (select distinct id from embeddings_documents) d where not exists (select 1 from embeddings_pages p where p.document_id = d.id)
union all select 'record_backward', count(*) from embeddings_book_chapters where pdf_end_page < pdf_start_page
union all select 'record_without_start', count(*) from embeddings_book_chapters where pdf_start_page is null
union all select 'subsection_without_text', count(*) from embeddings_book_subsections where coalesce(text_length_chars, 0) = 0
union all select 'chunk_without_vector', count(*) from embeddings_chunks c where not exists (select 1 from embeddings_vectors v where v.chunk_id = c.id)
union all select 'chunk_without_text', count(*) from embeddings_chunks where trim(coalesce(content, '')) = ''""")
def validation_counts(spark, d):
    rules = ["no_pages", "record_backward", "record_without_start", "subsection_without_text", "chunk_without_vector", "chunk_without_text"]
    found = validate.violations(t(spark, d, "documents"), pages(spark, d), t(spark, d, "book_chapters"), t(spark, d, "book_subsections"), t(spark, d, "chunks"), t(spark, d, "vectors")).where(F.col("rule").isin(rules)).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))
    all_rules = spark.createDataFrame([(r,) for r in rules], "rule string")
    return all_rules.join(found, "rule", "left").select("rule", F.coalesce("n", F.lit(0)).alias("violations"))


@query("""with n as (select * from embeddings_documents qualify row_number() over (partition by id order by updated_at desc) = 1) select file_hash, count(*) as books from n where file_hash not in (select file_hash from embeddings_ingestion_runs where status = 'completed' and file_hash is not null) group by file_hash""")
def unseen_files(spark, d):
    """Books whose file no completed run has taken in: the anti-join before an ingest."""
    from foliant.sources import files

    done = t(spark, d, "ingestion_runs").where("status = 'completed'")
    return files.unseen(books(spark, d), done).groupBy("file_hash").agg(F.count(F.lit(1)).alias("books"))


@query("""select count(*) as rows, count(distinct document_id) as books, count(*) filter (document_id in (select document_id from embeddings_book_chapters where detected_by like '%toc%')) as replaced from embeddings_book_chapters""")
def replace_children(spark, d):
    """Chapters of books that have any from a table of contents, replaced as a whole by themselves: nothing is lost or doubled."""
    r = t(spark, d, "book_chapters")
    ids = r.where("detected_by like '%toc%'").select("document_id").distinct()
    source = r.join(ids, "document_id", "left_semi").withColumn("detected_by", F.lit("again"))
    out = tables.replace_children(r, source)
    return out.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("document_id").alias("books"), F.count_if(F.col("detected_by") == "again").alias("replaced"))


@query()
def search_report(spark, d):
    """The best chunks as a reader sees them: source, preview, citation."""
    from foliant.plans.reference import _query_vector, _vectors, _with_books

    found = search.hybrid(_with_books(spark, d), _vectors(spark, d), "needle garden", _query_vector(spark, d), 8)
    return found.select("chunk_id", "source_label", F.substring(X.squeeze(F.col("content")), 1, 260).alias("preview"), X.citation(F.col("book_title"), F.col("page_start"), F.col("page_end")).alias("citation"), F.round("final_score", 4).alias("score"))
