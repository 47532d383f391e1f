"""Books as nested JSON, one row each, for exchange."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.functions import text as X
from foliant.operators import structure

#: Books of more pages than this are exported in parts of that many, so that no row outgrows a task.
PART_PAGES = 5000


def nested_books(books: DataFrame, records: DataFrame, pages: DataFrame, text: str = "raw_text") -> DataFrame:
    """(document_id, part, json): metadata, chapters by start and pages by number; null fields are left out."""
    meta = books.select(F.col("id").alias("document_id"), F.struct("document_key", "school_name", "class_name", "grade", "board", "medium", "book_title", "subject", "language").alias("metadata"), "file_hash")
    chapter = F.struct(F.coalesce("pdf_start_page", F.lit(2147483647)).alias("_order"), "id", "chapter_number", "chapter_title", "unit_number", "unit_title", "section_number", "section_title", "structure_type", F.col("pdf_start_page").alias("start_page"), F.col("pdf_end_page").alias("end_page"), "printed_start_page", "printed_end_page", "confidence")
    chapters = records.groupBy("document_id").agg(F.transform(F.array_sort(F.collect_set(chapter)), lambda c: c.dropFields("_order")).alias("chapters"), F.round(F.avg("confidence"), 4).alias("average_confidence"))
    held = pages.groupBy("document_id", F.floor((F.col("page_number") - 1) / PART_PAGES).alias("part")).agg(F.array_sort(F.collect_list(F.struct("page_number", F.col(text).alias("text")))).alias("page_extractions"))
    rows = held.join(meta, "document_id", "left").join(chapters, "document_id", "left")
    extraction = F.struct(F.col("metadata.book_title").alias("book_title"), F.col("metadata.subject").alias("subject"), "chapters", "page_extractions", "average_confidence")
    return rows.select("document_id", "part", F.to_json(F.struct("file_hash", "metadata", extraction.alias("extraction"))).alias("json"))


def combined(books: DataFrame, pages: DataFrame, chapters: DataFrame, subsections: DataFrame, chunks: DataFrame, plans: DataFrame) -> DataFrame:
    """(document_id, document_key, kind, place, json): a book as lines of JSON, of one shape whatever its size.

    kind `book`: metadata, plan, counts and notes. `unit`: a chapter, or, in books without chapter titles, a unit of
    sections. `lesson`: a chunk of a chapter, or a section with its text; parent is its unit's record or name. `page`: a
    page with its structure. `subsection`: as stored. place is the order within a kind; null fields are left out.
    """
    b = books.select(F.col("id").alias("document_id"), "*").drop("id")
    has = chapters.groupBy("document_id").agg(F.max(structure.filled(F.col("chapter_title")).isNotNull()).alias("in_chapters"), F.count(F.lit(1)).alias("records"), F.max("detected_by").alias("detected_by"), F.round(F.avg("confidence"), 4).alias("confidence"))
    about = b.join(has, "document_id", "left").join(plans, "document_id", "left").withColumn("in_chapters", F.coalesce("in_chapters", F.lit(False)))
    describe = F.when(F.col("in_chapters"), F.concat(F.lit("In chapters, "), "records", F.lit(" records."))).when(F.col("records") > 0, F.concat(F.lit("In units and sections, "), "records", F.lit(" records."))).otherwise("No structure found; pages alone.")
    meta = [c for c in ("title", "book_title", "school_name", "class_name", "grade", "board", "medium", "subject", "language", "publisher", "edition", "publication_year", "isbn", "author", "file_name", "file_hash", "total_pages") if c in b.columns]
    plan = F.struct(F.col("profile").alias("content_profile"), "strategy", "max_tokens", "overlap_tokens")
    line = lambda df, kind, place, *fields: df.select("document_id", F.lit(kind).alias("kind"), place.cast("bigint").alias("place"), F.to_json(F.struct(*fields)).alias("json"))
    out = [line(about, "book", F.lit(0), F.struct(*meta).alias("metadata"), plan.alias("chunking_plan"), describe.alias("structure"), "detected_by", "confidence", F.lit("Page numbers are places in the file.").alias("notes"))]

    start = F.coalesce("pdf_start_page", F.lit(2147483647))
    span = [F.col("pdf_start_page").alias("start_page"), F.col("pdf_end_page").alias("end_page"), "printed_start_page", "printed_end_page", X.page_range(F.col("pdf_start_page"), F.col("pdf_end_page")).alias("page_numbers")]
    notes = F.concat(F.lit("detected_by="), "detected_by").alias("notes")
    kept = chapters.join(has.select("document_id", "in_chapters"), "document_id").where(structure.display_title().isNotNull())
    whole, parts = kept.where(F.col("in_chapters") & structure.filled(F.col("chapter_title")).isNotNull()), kept.where(~F.col("in_chapters"))
    number = F.lpad("chapter_number", 2, "0")
    key = F.when(F.col("chapter_number").rlike("^[0-9]+$"), F.concat(F.lit("CH"), F.when(F.length("chapter_number") < 2, number).otherwise(F.col("chapter_number")))).otherwise(X.safe_id(F.col("chapter_number"), "CH"))
    names = ["chapter_number", "chapter_title", "unit_number", "unit_title"]
    out.append(line(whole, "unit", start, F.col("id").alias("record_id"), key.alias("chapter_id"), F.lit("chapter").alias("container_type"), *names, *span, "confidence", notes))
    group = F.coalesce(structure.filled(F.col("unit_title")), structure.filled(F.col("chapter_title")), F.lit("Sections"))
    units = parts.withColumn("group_title", group).groupBy("document_id", "unit_number", "group_title").agg(F.min("pdf_start_page").alias("pdf_start_page"), F.max(F.coalesce("pdf_end_page", "pdf_start_page")).alias("pdf_end_page"), F.count(F.lit(1)).alias("sections"), F.round(F.avg("confidence"), 4).alias("confidence"))
    unit_key = X.safe_id(F.coalesce("unit_number", "group_title"), "U")
    out.append(line(units, "unit", start, unit_key.alias("section_group_id"), F.lit("unit").alias("container_type"), "unit_number", F.col("group_title").alias("unit_title"), F.col("pdf_start_page").alias("start_page"), F.col("pdf_end_page").alias("end_page"), "sections", "confidence"))

    # Lessons of chapters are their chunks; a chapter without any gets the text of its pages, as does a section.
    c = chunks.select("id", "document_id", "page_start", "page_end", "chunk_index", "chunk_type", "content", "important_terms", "keywords", "source_label", *[x for x in ("chapter_title", "unit_title", "section_title", "lesson_title") if x in chunks.columns])
    by_chapter = structure.matches(c, whole, ["chapter_title"], alone=True)
    lesson = c.join(by_chapter, F.col("id") == F.col("chunk_id")).withColumn("lesson_title", X.chunk_title([structure.filled(F.col(x)) for x in ("lesson_title", "section_title", "chapter_title", "unit_title") if x in c.columns], F.col("chunk_type"), F.col("chunk_index") + 1))
    out.append(line(lesson, "lesson", F.col("chunk_index"), F.col("record_id").alias("parent"), "lesson_title", F.col("chunk_type").alias("lesson_type"), F.col("page_start").alias("start_page"), F.col("page_end").alias("end_page"), X.page_range(F.col("page_start"), F.col("page_end")).alias("page_numbers"), F.col("content").alias("lesson_text"), F.slice("important_terms", 1, 20).alias("key_terms"), F.concat(F.lit("chunk "), "chunk_index", F.lit(", "), "source_label").alias("notes")))
    by_section = structure.matches(c, parts, ["unit_title", "section_title"], alone=False)
    held = c.join(by_section, F.col("id") == F.col("chunk_id")).groupBy("record_id").agg(F.array_sort(F.collect_list(F.struct("chunk_index", "content", "chunk_type", F.concat("important_terms", "keywords").alias("terms")))).alias("cs"))
    terms = X.merged_terms(F.flatten(F.transform("cs", lambda x: x["terms"])))
    # Sections, and chapters without a chunk, by the text of their pages.
    bare = whole.join(by_chapter.select("record_id").distinct(), F.col("id") == F.col("record_id"), "left_anti")
    texts = _range_texts(bare.select("id", "document_id", "pdf_start_page", "pdf_end_page").unionByName(parts.join(held.select("record_id"), F.col("id") == F.col("record_id"), "left_anti").select("id", "document_id", "pdf_start_page", "pdf_end_page")), pages)
    rest = bare.unionByName(parts).join(held, F.col("id") == F.col("record_id"), "left").join(texts.withColumnRenamed("id", "text_of"), F.col("id") == F.col("text_of"), "left")
    text = F.coalesce(F.array_join(F.transform("cs", lambda x: F.trim(x["content"])), "\n\n"), "range_text")
    out.append(line(rest, "lesson", start, F.col("id").alias("parent"), structure.display_title().alias("lesson_title"), F.coalesce(F.col("cs")[0]["chunk_type"], "structure_type").alias("lesson_type"), *names, "section_number", "section_title", *span, text.alias("lesson_text"), terms.alias("key_terms"), notes))

    s = [x for x in ("subsection_number", "subsection_title", "anchor_marker", "page_numbers", "subsection_text", "quality_flags") if x in subsections.columns]
    out.append(line(subsections, "subsection", start, *[x for x in names if x in subsections.columns], *s, F.col("pdf_start_page").alias("start_page"), F.col("pdf_end_page").alias("end_page")))
    at = structure.resolve_pages(pages, chapters)
    facts = [x for x in ("word_count", "token_count", "detected_language", "extraction_method", "extraction_quality") if x in pages.columns]
    of = [F.col(f"record.{x}").alias(x) for x in (*names, "section_number", "section_title", "lesson_title", "structure_type") if x in chapters.columns]
    body = F.col("cleaned_text" if "cleaned_text" in pages.columns else "raw_text").alias("text")
    out.append(line(at, "page", F.col("page_number"), "page_number", structure.printed_page(F.col("page_number"), F.col("record")).alias("printed_page_number"), *of, body, *facts))
    rows = reduce(DataFrame.unionByName, out)
    return rows.join(b.select("document_id", "document_key"), "document_id", "left").select("document_id", "document_key", "kind", "place", "json")


def _range_texts(ranges: DataFrame, pages: DataFrame) -> DataFrame:
    spread = ranges.where("pdf_start_page is not null").select("id", "document_id", F.explode(X.page_range(F.col("pdf_start_page"), F.col("pdf_end_page"))).alias("page_number"))
    body = F.col("cleaned_text" if "cleaned_text" in pages.columns else "raw_text")
    rows = spread.join(pages.select("document_id", "page_number", body.alias("t")).where(F.trim("t") != ""), ["document_id", "page_number"])
    return rows.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_number", "t"))), lambda x: F.trim(x["t"])), "\n\n").alias("range_text"))


def write(lines: DataFrame, folder: str) -> None:
    """The lines as JSON text, a folder a book (`document_id=...`), in the order of kind and place within each file; any number of files a book."""
    lines.select("document_id", "kind", "place", "json").sortWithinPartitions("document_id", "kind", "place").select("document_id", F.concat(F.lit('{"kind":"'), "kind", F.lit('","place":'), "place", F.lit(',"value":'), "json", F.lit("}")).alias("value")).write.mode("overwrite").partitionBy("document_id").text(folder)
