"""Checks of books and tables: one row for each violation, (rule, document_id, key, detail)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.operators.structure import display_title, filled


def _row(df: DataFrame, rule: str, key: Column, detail: Column) -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), F.col("document_id"), key.cast("string").alias("key"), detail.cast("string").alias("detail"))


def violations(books: DataFrame, pages: DataFrame, records: DataFrame, subs: DataFrame, chunks: DataFrame, vectors: DataFrame) -> DataFrame:
    """All violations of the books; the rules are named below, in the order they are tried."""
    ids = books.select(F.col("id").alias("document_id")).distinct()
    last = pages.groupBy("document_id").agg(F.max("page_number").alias("last"), F.min("page_number").alias("first"), F.countDistinct("page_number").alias("n"))
    numbered = ["document_id", "chapter_number", "unit_number", "section_number"]
    keyed = lambda d: d.select("*", *[F.coalesce(c, F.lit("")).alias(f"k_{c}") for c in numbered[1:]])
    on = ["document_id", *[f"k_{c}" for c in numbered[1:]]]
    parents = keyed(records).groupBy(*on).agg(F.min("pdf_start_page").alias("lo"), F.max("pdf_end_page").alias("hi"))
    ordered = keyed(subs).where("pdf_start_page is not null and pdf_end_page is not null").withColumn("b", F.lag("pdf_end_page").over(Window.partitionBy(*on).orderBy("pdf_start_page", "pdf_end_page", "id")))
    out = [
        _row(books.withColumn("document_id", F.col("id")).groupBy("document_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "book_twice", F.col("document_id"), F.col("n")),
        _row(books.withColumn("document_id", F.col("id")).where(filled(F.col("document_key")).isNull()), "no_document_key", F.col("id"), F.col("title")),
        _row(ids.join(pages, "document_id", "left_anti"), "no_pages", F.col("document_id"), F.lit(None)),
        _row(pages.join(ids, "document_id", "left_anti").groupBy("document_id").count(), "pages_without_book", F.col("document_id"), F.col("count")),
        _row(last.where("last - first + 1 <> n"), "pages_missing", F.col("document_id"), F.col("last") - F.col("first") + 1 - F.col("n")),
        _row(records.where(display_title().isNull()), "record_without_title", F.col("id"), F.lit(None)),
        _row(records.where("pdf_start_page is null"), "record_without_start", F.col("id"), display_title()),
        _row(records.where("pdf_end_page < pdf_start_page"), "record_backward", F.col("id"), F.concat_ws("-", "pdf_start_page", "pdf_end_page")),
        _row(records.join(last, "document_id").where("pdf_end_page > last or pdf_start_page < 1"), "record_beyond_book", F.col("id"), F.col("pdf_end_page")),
        _row(records.where("section_key is not null").groupBy("document_id", "section_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "section_key_twice", F.col("section_key"), F.col("n")),
        _row(keyed(subs).join(parents, on, "left_anti"), "subsection_orphan", F.col("id"), F.col("subsection_title")),
        _row(keyed(subs).join(parents, on).where("pdf_start_page < lo or pdf_end_page > hi"), "subsection_out_of_parent", F.col("id"), F.concat_ws("-", "pdf_start_page", "pdf_end_page")),
        _row(subs.where("coalesce(text_length_chars, 0) = 0"), "subsection_without_text", F.col("id"), F.col("subsection_title")),
        _row(ordered.where("pdf_start_page <= b"), "subsection_overlap", F.col("id"), F.col("b") - F.col("pdf_start_page") + 1),
        _row(ordered.where("pdf_start_page > b + 1"), "subsection_gap", F.col("id"), F.col("pdf_start_page") - F.col("b") - 1),
        _row(chunks.join(vectors.select(F.col("chunk_id").alias("id")).distinct(), "id", "left_anti"), "chunk_without_vector", F.col("id"), F.col("chunk_index")),
        _row(chunks.where("trim(coalesce(content, '')) = ''"), "chunk_without_text", F.col("id"), F.col("chunk_index")),
    ]
    return reduce(DataFrame.unionByName, out)


def summary(found: DataFrame) -> DataFrame:
    return found.groupBy("rule").agg(F.count(F.lit(1)).alias("violations"), F.countDistinct("document_id").alias("books"))
