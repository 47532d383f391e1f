"""Structural lookups: text of chapters and subsections, lists of subsections, by document and structure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions import text as X
from foliant.operators import structure

NUMBERS = ["chapter_number", "unit_number", "section_number", "subsection_number"]
TITLES = ["chapter_title", "unit_title", "section_title", "subsection_title"]
#: Columns of a book and of a subsection that lookups give.
BOOK = ["document_key", "book_title", "school_name", "class_name", "subject", "grade"]
LISTED = {
    **dict.fromkeys(["chapter_number", "chapter_title", "unit_number", "unit_title", "section_number", "section_title", "subsection_number", "subsection_title", "anchor_marker"], "string"),
    **dict.fromkeys(["anchor_pdf_page", "anchor_printed_page", "pdf_start_page", "pdf_end_page", "printed_start_page", "printed_end_page", "page_count"], "int"),
    "page_numbers": "array<int>", "printed_page_numbers": "array<int>", "includes": "array<string>", "included_exercises_or_activities": "array<string>", "text_length_chars": "int", "include_in_embeddings": "boolean", "embedding_readiness": "string", "quality_flags": "array<string>",
}
WITH_TEXT = {"anchor_detection_method": "string", "anchor_raw_heading": "string", "text_sources": "array<string>", "excluded_related_pages": "string", "math_lines": "array<string>", "metadata": "string"}


def condition(filters: dict[str, str | None], columns: list[str] | None = None) -> Column:
    """Numbers equal, titles within in any case, `%` and `_` as wildcards; empty values don't count. An unknown name is an error."""
    out = F.lit(True)
    for name, value in filters.items():
        if name not in NUMBERS + TITLES or columns is not None and name not in columns:
            raise ValueError(f"no structure filter {name}")
        if value:
            out = out & (F.col(name) == value if name in NUMBERS else F.col(name).ilike(f"%{value}%"))
    return out


def of_document(books: DataFrame, document_id: str | None, document_key: str | None, every: bool = False) -> DataFrame:
    """(document_id, columns of BOOK) of the book asked for, by id and key where both are given; of all books with `every`. Neither is an error."""
    if not (document_id or document_key or every):
        raise ValueError("give document_id or document_key")
    rows = books
    if document_id:
        rows = rows.where(F.col("id") == document_id)
    if document_key:
        rows = rows.where(F.col("document_key") == document_key)
    return rows.select(F.col("id").alias("document_id"), *BOOK)


def _columns(df: DataFrame, wanted: dict[str, str]) -> list[Column]:
    """The columns of a table with their types; null where the table has none of that name."""
    return [(F.col(c) if c in df.columns else F.lit(None)).cast(kind).alias(c) for c, kind in wanted.items()]


def order() -> list[Column]:
    return [F.coalesce("pdf_start_page", F.lit(2147483647)), *[F.col(c).asc_nulls_last() for c in ("section_number", "subsection_number", "subsection_title")], F.col("id")]


def list_subsections(subsections: DataFrame, books: DataFrame, document_id: str | None = None, document_key: str | None = None, every: bool = False, **filters: str | None) -> DataFrame:
    """(id, document_id, document_key, book_title, columns of LISTED) of the subsections, in their order within the book."""
    b = of_document(books, document_id, document_key, every).select("document_id", "document_key", "book_title")
    rows = subsections.where(condition(filters, subsections.columns)).select("id", "document_id", *_columns(subsections, LISTED)).join(b, "document_id")
    return rows.select("id", "document_id", "document_key", "book_title", *LISTED).orderBy("document_id", *order())


def _with_pages(subsections: DataFrame, pages: DataFrame) -> DataFrame:
    """(id, made): the texts of the pages of each subsection, in order, blank ones left out."""
    spread = subsections.where("pdf_start_page is not null").select("id", "document_id", F.explode(X.page_range(F.col("pdf_start_page"), F.col("pdf_end_page"))).alias("page_number")).distinct()
    held = spread.join(pages.where(X.squeeze(F.col("raw_text")).isNotNull()).select("document_id", "page_number", "raw_text"), ["document_id", "page_number"])
    return held.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_number", "raw_text"))), lambda x: x["raw_text"]), "\n\n").alias("made"))


def subsection_text(subsections: DataFrame, pages: DataFrame, books: DataFrame, document_id: str | None = None, document_key: str | None = None, every: bool = False, **filters: str | None) -> DataFrame:
    """(id, document_id, columns of BOOK, LISTED and WITH_TEXT, subsection_text, subsection_text_plain), in order.

    The text is the one stored with the subsection, else that of its pages; pages holds a page once.
    """
    b = of_document(books, document_id, document_key, every)
    mine = subsections.where(condition(filters, subsections.columns)).join(b.select("document_id"), "document_id", "left_semi")
    stored = [c for c in ("subsection_text", "subsection_text_plain", "text") if c in mine.columns]
    own = F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in stored], F.lit(None).cast("string"))
    rows = mine.withColumn("_own", own).select("id", "document_id", "_own", *_columns(mine, LISTED | WITH_TEXT))
    made = _with_pages(rows.where(F.col("_own").isNull()), pages)
    rows = rows.join(made, "id", "left").join(b, "document_id").withColumn("subsection_text", F.coalesce("_own", "made"))
    return rows.select("id", "document_id", *BOOK, *LISTED, *WITH_TEXT, "subsection_text", X.squeeze(F.col("subsection_text")).alias("subsection_text_plain")).orderBy("document_id", *order())


STRUCTURE = ["chapter_number", "chapter_title", "unit_number", "unit_title", "section_number", "section_title", "lesson_title"]


def raw_text_pages(pages: DataFrame, records: DataFrame, chunks: DataFrame) -> DataFrame:
    """Pages, each once, with the structure they belong to: (id, document_id, page_number, raw_text, columns of STRUCTURE, topic, printed_page_number, found_in).

    The structure is that of the covering record, else the chapter of the first chunk over the page; found_in says which.
    Slim rows are resolved; the texts are joined to them once.
    """
    slim = pages.select("document_id", "page_number")
    known = structure.resolve_pages(slim, records.select("document_id", "id", *[c for c in STRUCTURE if c in records.columns], "pdf_start_page", "pdf_end_page", "printed_start_page"))
    by_chunk = structure.covering_chunk(known.where("record is null").select("document_id", "page_number"), chunks).select("document_id", "page_number", "chunk_id", F.col("chapter_title").alias("_chunk_title"))
    at = known.join(by_chunk, ["document_id", "page_number"], "left")
    has = F.col("record").isNotNull()
    at = at.select(
        "document_id", "page_number", *[(F.coalesce(f"record.{c}", structure.filled(F.col("_chunk_title"))) if c == "chapter_title" else F.col(f"record.{c}")).alias(c) for c in STRUCTURE],
        structure.printed_page(F.col("page_number"), F.col("record")).alias("printed_page_number"), F.when(has, "record").when(F.col("chunk_id").isNotNull(), "chunk").alias("found_in"),
    )
    topic = F.coalesce(*[structure.filled(F.col(c)) for c in ("section_title", "lesson_title", "chapter_title")])
    return pages.select("id", "document_id", "page_number", "raw_text").join(at.withColumn("topic", topic), ["document_id", "page_number"], "left").select("id", "document_id", "page_number", "raw_text", *STRUCTURE, "topic", "printed_page_number", "found_in")


def chapter_pages(raw_pages: DataFrame, books: DataFrame, document_id: str | None = None, document_key: str | None = None, every: bool = False, **filters: str | None) -> DataFrame:
    """The rows of raw_text_pages() that the filters leave, with the columns of their book, by page."""
    b = of_document(books, document_id, document_key, every)
    return raw_pages.where(condition(filters, raw_pages.columns)).join(b, "document_id").orderBy("document_id", "page_number")


def chapter_text(raw_pages: DataFrame, books: DataFrame, document_id: str | None = None, document_key: str | None = None, **filters: str | None) -> DataFrame:
    """One row a book: (document_id, document_key, book_title, page_count, pdf_pages, printed_pages, text), the pages' texts in order, blank ones left out."""
    rows = chapter_pages(raw_pages, books, document_id, document_key, **filters)
    in_order = F.array_sort(F.collect_list(F.struct("page_number", "printed_page_number", F.btrim(F.coalesce("raw_text", F.lit("")), F.lit(" \t\r\n\xa0")).alias("t"))))
    held = rows.groupBy("document_id", "document_key", "book_title").agg(F.count(F.lit(1)).alias("page_count"), in_order.alias("p"))
    text = F.array_join(F.filter(F.transform("p", lambda x: x["t"]), lambda t: t != ""), "\n\n")
    return held.select("document_id", "document_key", "book_title", "page_count", F.col("p.page_number").alias("pdf_pages"), F.filter(F.transform("p", lambda x: x["printed_page_number"]), lambda n: n.isNotNull()).alias("printed_pages"), text.alias("text"))
