"""Ingest end to end: files into books with pages, structure, chunks and vectors, and a log of runs.

All files of a folder go through together, as one plan a table; nothing is done book by book on the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.functions import text as X
from foliant.operators import chunking, contents, detection, embedding, lookup, nested, structure, tables
from foliant.session import cut, ship
from foliant.sources import files as file_source
from foliant.sources import json_books
from foliant.store import Store

METADATA = [*json_books.METADATA, "title", "publisher", "edition", "publication_year", "isbn", "author", "copyright_status", "source_uri"]
LANGUAGES = ["Hindi", "English", "Mixed", "Hinglish", "Unknown"]


@dataclass
class Options:
    """overrides: metadata that goes before that of the files. reindex: take in again what is there. dry_run: write nothing. export_to: folder for the combined JSON. provider: a model that reads the structure of books without JSON."""

    overrides: dict[str, str] = field(default_factory=dict)
    reindex: bool = False
    dry_run: bool = False
    export_to: str | None = None
    provider: detection.Provider | None = None

    def __post_init__(self) -> None:
        if unknown := set(self.overrides) - set(METADATA):
            raise ValueError(f"no metadata {', '.join(sorted(unknown))}")
        if (language := self.overrides.get("language")) and language not in LANGUAGES:
            raise ValueError(f"the language must be one of {', '.join(LANGUAGES)}")


def completed(meta: DataFrame, overrides: dict[str, str], fallback: str = "file_name") -> DataFrame:
    """Metadata with the overrides before it; title, book_title, grade and class_name stand in for each other, the file's name for a title."""
    value = lambda c: F.coalesce(F.lit(overrides.get(c) or None), X.squeeze(F.col(c)) if c in meta.columns else F.lit(None)).cast("string")
    known = meta.select(*[c for c in meta.columns if c not in METADATA], *[value(c).alias(c) for c in METADATA])
    stem = F.regexp_replace(F.regexp_replace(F.col(fallback), r"^.*[/\\]", ""), r"\.[^.]*$", "")
    known = known.withColumn("title", F.coalesce("title", "book_title", stem)).withColumn("book_title", F.coalesce("book_title", "title"))
    known = known.withColumn("grade", F.coalesce("grade", "class_name")).withColumn("class_name", F.coalesce("class_name", "grade"))
    derived = X.slug(F.concat_ws("-", "school_name", "class_name", "subject", "book_title"))
    return known.withColumn("document_key", F.coalesce(X.slug(F.col("document_key")), derived))


def _id(*columns) -> F.Column:
    return F.substring(F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]), 256), 1, 32)


def page_rows(pages: DataFrame) -> DataFrame:
    """(document_id, page_number, raw_text, extraction_method) with cleaned text, language, counts and flags."""
    c = F.col("cleaned_text")
    rows = cut(pages.select("document_id", "page_number", "raw_text", "extraction_method").withColumn("cleaned_text", X.clean_text("raw_text")))
    f = X.flags(c)
    return rows.select(
        _id("document_id", "page_number").alias("id"), "document_id", "page_number", "raw_text", "cleaned_text", "extraction_method", X.script_language(c).alias("detected_language"), X.word_count(c).alias("word_count"), X.regex_token_count(c).alias("token_count"),
        (X.word_count(c) > 0).alias("has_text"), f["has_formula"].alias("has_math"), f["has_table_like_text"].alias("has_table_like_text"), (X.devanagari_count(c) > 0).alias("has_devanagari"), (X.latin_count(c) > 0).alias("has_english"), X.page_quality(F.col("raw_text"), F.col("extraction_method")).alias("extraction_quality"),
    )


def dominant(pages: DataFrame) -> DataFrame:
    """(document_id, detected_language, total_pages, total_words, total_tokens, warnings)."""
    n = lambda name: F.count_if(F.col("detected_language") == name)
    share = lambda *kinds: F.avg(F.col("extraction_quality").isin(*kinds).cast("int"))
    out = pages.groupBy("document_id").agg(*[n(x).alias(x) for x in ("Hindi", "English", "Mixed")], F.count(F.lit(1)).alias("total_pages"), F.sum("word_count").alias("total_words"), F.sum("token_count").alias("total_tokens"), share("empty").alias("e"), share("empty", "low", "corrupted").alias("w"))
    top = F.when((F.col("Hindi") > 0) & (F.col("English") > 0), "Mixed").when(F.greatest("Hindi", "English", "Mixed") == 0, "Unknown").when(F.col("English") >= F.greatest("Hindi", "Mixed"), "English").when(F.col("Hindi") >= F.col("Mixed"), "Hindi").otherwise("Mixed")
    warnings = F.array_compact(F.array(F.when(F.col("e") >= 0.40, "many pages are empty"), F.when(F.col("w") >= 0.25, "many pages are empty, short or corrupted")))
    return out.select("document_id", top.alias("detected_language"), "total_pages", "total_words", "total_tokens", F.to_json(warnings).alias("warnings"))


def ingest_json(store: Store, source: str, embedder: embedding.Embedder, options: Options | None = None) -> DataFrame:
    """Take in the JSON files below a folder, or one file. A row a file: (file_name, document_key, document_id, status, reason, pages, structures, subsections, chunks, vectors).

    status is completed, skipped_existing, failed (no complete JSON, no text) or dry_run_ok. Of files of one
    document_key the last by name counts; the others are superseded.
    """
    o = options or Options()
    spark = store.spark
    ship(spark)
    records = cut(json_books.read_files(spark, source))
    nodes = cut(nested.flatten(records, "raw_id", "payload"))
    meta = json_books.metadata(nodes)
    files = records.select(F.col("raw_id").cast("string").alias("raw_key"), "file_name", F.sha2("payload", 256).alias("file_hash"), F.octet_length("payload").cast("bigint").alias("file_size_bytes"))
    # The key that a file lacks is made once its metadata is complete.
    files = completed(files.join(meta.withColumn("document_key", F.when(~F.col("key_was_derived"), F.col("document_key"))).drop("key_was_derived"), "raw_key", "left"), o.overrides)
    pages = cut(json_books.book_pages(nodes))
    rejected = nodes.where("tag = 'rejected'").select("raw_key").distinct().withColumn("no_json", F.lit(True))
    with_text = pages.select("raw_key").distinct().withColumn("text", F.lit(True))
    files = files.join(rejected, "raw_key", "left").join(with_text, "raw_key", "left").withColumn("reason", F.when(F.col("no_json"), "not a complete JSON object").when(F.col("text").isNull(), "no text of pages, chapters or sections"))
    todo = _todo(store, files, o)
    key = todo.where("reason is null").select("raw_key", "document_id")
    p = page_rows(pages.join(key, "raw_key").select("document_id", "page_number", F.col("text").alias("raw_text"), F.lit("json").alias("extraction_method")))
    s = json_books.structure_records(nodes).join(key, "raw_key")
    chapters = s.select(
        _id("document_id", "section_key").alias("id"), "document_id", *lookup.STRUCTURE, "section_key", F.when(structure.filled(F.col("section_title")).isNotNull(), "section").otherwise("chapter").alias("structure_type"),
        F.col("printed_start_page"), F.col("printed_end_page"), F.col("start_page").alias("pdf_start_page"), F.col("end_page").alias("pdf_end_page"), F.lit("json").alias("detected_by"), F.lit(1.0).alias("confidence"), F.col("node_path"),
    )
    chapters = tables.keep_first(chapters, [F.col("document_id"), F.col("section_key")], [F.desc("node_path")]).drop("node_path")
    u = json_books.subsections(nodes).join(key, "raw_key")
    start, end = F.col("start_page"), F.coalesce("end_page", "start_page")
    subsections = u.select(
        _id("document_id", "node_path").alias("id"), "document_id", *[c for c in lookup.STRUCTURE if c in u.columns], "subsection_number", "subsection_title", "anchor_marker", start.alias("pdf_start_page"), end.alias("pdf_end_page"),
        F.size(X.page_range(start, end)).alias("page_count"), X.page_range(start, end).alias("page_numbers"), F.col("text").alias("subsection_text"), F.coalesce(F.length("text"), "text_length_chars").alias("text_length_chars"), F.lit(True).alias("include_in_embeddings"),
    )
    return _finish(store, todo, p, chapters, subsections, embedder, o, "json", "application/json")


def ingest_files(store: Store, source: str, readers: list[tuple[str, file_source.PageReader]], embedder: embedding.Embedder, options: Options | None = None, glob: str = "*.pdf", ocr: Callable[[bytes, int], str] | None = None) -> DataFrame:
    """Take in the files below a folder through page readers. As ingest_json; the structure is what the pages of contents tell, with ranges repaired from the pages."""
    o = options or Options()
    ship(store.spark)
    found = file_source.scan(store.spark, source, glob)
    files = completed(found.drop("content").withColumn("file_name", F.col("path")).withColumn("raw_key", F.col("file_hash")), o.overrides).dropDuplicates(["raw_key"])
    todo = _todo(store, files.withColumn("reason", F.lit(None).cast("string")), o, by="file_hash")
    read = cut(file_source.page_texts(found.join(todo.where("reason is null").select("path"), "path", "left_semi"), readers, ocr))
    errors = read.where("error is not null").select(F.col("path"), F.col("error"))
    todo = todo.join(errors, "path", "left").withColumn("status", F.when(F.col("error").isNotNull(), "failed").otherwise(F.col("status"))).withColumn("reason", F.coalesce("reason", "error")).drop("error")
    todo = cut(todo)
    key = todo.where("reason is null").select("path", "document_id")
    p = page_rows(read.where("error is null").join(key, "path").select("document_id", "page_number", "raw_text", "extraction_method"))
    p = cut(p)
    about = todo.where("reason is null").select(F.col("document_id").alias("id"), "school_name", "class_name", "grade", "board", "subject", "book_title", "language")
    detected = cut(detection.detect_structure(p, about, o.provider))
    ranges = contents.repair_whole(detected, p).select("document_id", "id", "pdf_start_page", "pdf_end_page")
    chapters = detected.drop("pdf_start_page").join(ranges, ["document_id", "id"], "left").withColumn("section_key", F.concat_ws("/", "unit_number", "chapter_number", F.coalesce("section_number", "section_title", "chapter_title"))).withColumn("printed_end_page", F.lit(None).cast("int"))
    none = store.spark.createDataFrame([], "id string, document_id string, subsection_title string, subsection_text string, pdf_start_page int, pdf_end_page int")
    return _finish(store, todo, p, chapters, none, embedder, o, "file", "application/pdf")


def _todo(store: Store, files: DataFrame, o: Options, by: str = "document_key") -> DataFrame:
    """files with document_id, status and reason; those with a null reason are to be taken in."""
    there = store.read("documents").where(F.col(by).isNotNull()).groupBy(by).agg(F.max("id").alias("old_id"), F.lit(True).alias("there")) if store.exists("documents") else None
    rows = files.join(there, by, "left") if there is not None else files.withColumn("there", F.lit(None).cast("boolean")).withColumn("old_id", F.lit(None).cast("string"))
    if not o.reindex:
        rows = rows.withColumn("reason", F.coalesce("reason", F.when(F.col("there"), f"same {by} taken in before")))
    last = tables.latest(rows.where("reason is null").select("document_key", "file_name", "raw_key"), ["document_key"], [F.col("file_name"), F.col("raw_key")]).select("raw_key", F.lit(True).alias("last"))
    rows = rows.join(last, "raw_key", "left")
    rows = rows.withColumn("reason", F.coalesce("reason", F.when(F.col("last").isNull(), "superseded by a later file of the same document_key")))
    status = F.when(F.col("reason").isNull(), "ready").when(F.coalesce("there", F.lit(False)) & F.lit(not o.reindex), "skipped_existing").when(F.col("reason").startswith("superseded"), "superseded").otherwise("failed")
    return cut(rows.withColumn("status", status).withColumn("document_id", F.coalesce("old_id", _id("document_key"))).drop("there", "old_id", "last"))


def _finish(store: Store, todo: DataFrame, p: DataFrame, chapters: DataFrame, subsections: DataFrame, embedder: embedding.Embedder, o: Options, kind: str, mime: str) -> DataFrame:
    run = uuid.uuid4().hex
    ready = todo.where("reason is null")
    p, chapters, subsections = cut(p), cut(chapters), cut(subsections)
    about = dominant(p)
    books = ready.select(F.col("document_id").alias("id"), *METADATA, "file_name", "file_hash", "file_size_bytes").join(about.withColumnRenamed("document_id", "id"), "id", "left")
    books = books.withColumn("primary_language", F.coalesce("language", "detected_language")).withColumn("normalized_title", X.squeeze(F.lower("title")))
    books = cut(books)
    plans = cut(chunking.profiles(p, books))
    chunks = cut(chunking.enrich(chunking.chunk_books(p, chapters, plans), books))
    raw = lookup.raw_text_pages(p, chapters, chunks.select("id", "document_id", "page_start", "page_end", "chunk_index", "chapter_title"))
    n = lambda df, name: df.groupBy("document_id").agg(F.count(F.lit(1)).cast("int").alias(name))
    counts = n(p, "pages").join(n(chapters, "structures"), "document_id", "left").join(n(subsections, "subsections"), "document_id", "left").join(n(chunks, "chunks"), "document_id", "left")
    log = todo.select("document_id", F.col("file_name").alias("file_path"), "file_hash", "document_key", "status", F.col("reason").alias("error_message"), F.sha2(F.concat_ws("|", F.lit(run), "raw_key"), 256).alias("id"))
    report = lambda status, vectors: todo.join(counts.join(vectors, "document_id", "left") if vectors is not None else counts.withColumn("vectors", F.lit(0)), "document_id", "left").select(
        "file_name", "document_key", F.when(F.col("status") == "ready", F.col("document_id")).alias("document_id"), F.when(F.col("status") == "ready", status).otherwise(F.col("status")).alias("status"), "reason",
        *[F.when(F.col("status") == "ready", F.coalesce(c, F.lit(0))).otherwise(0).cast("int").alias(c) for c in ("pages", "structures", "subsections", "chunks", "vectors")],
    )
    if o.export_to:
        from foliant.operators import export

        export.write(export.combined(books, p, chapters, subsections, chunks, plans), o.export_to)
    if o.dry_run:
        return cut(report("dry_run_ok", None))
    store.init()
    store.append("ingestion_runs", log.where("status = 'ready'").withColumn("status", F.lit("running")).withColumn("started_at", F.current_timestamp()), run)
    try:
        v = embedding.embed(chunks, "id", "content_for_embedding", embedder).withColumnRenamed("id", "chunk_id").join(chunks.select(F.col("id").alias("chunk_id"), "document_id"), "chunk_id")
        v = cut(v.withColumn("id", _id("chunk_id", "embedding_model", "embedding_dimensions")))
        inputs = cut(embedding.subsection_inputs(subsections, books, "subsection_text"))
        sv = embedding.embed(inputs, "id", "content_for_embedding", embedder, "cut").withColumnRenamed("id", "subsection_id").join(inputs.withColumnRenamed("id", "subsection_id"), "subsection_id")
        sv = cut(sv.withColumn("id", _id("subsection_id", "embedding_model", "embedding_dimensions")))
        for name, rows in {"pages": p, "book_chapters": chapters, "book_subsections": subsections, "chunks": chunks, "raw_text_pages": raw, "vectors": v, "subsection_vectors": sv}.items():
            store.append(name, rows, run)
        vectors = n(v.select("document_id").unionByName(sv.select("document_id")), "vectors")
        done = cut(report("completed", vectors))
        made = plans.select(F.col("document_id").alias("id"), F.col("profile").alias("content_profile"), F.col("strategy").alias("chunking_strategy"), F.col("max_tokens").alias("chunk_max_tokens"), F.col("overlap_tokens").alias("chunk_overlap_tokens"))
        rows = books.join(made, "id", "left").join(counts.select(F.col("document_id").alias("id"), "chunks", "structures"), "id", "left")
        rows = rows.withColumn("extraction_status", F.when(F.coalesce("chunks", F.lit(0)) > 0, "extracted").otherwise("no_chunks_created")).withColumn("structure_detected_by", F.when(F.col("structures") > 0, kind).otherwise("none"))
        store.append("documents", rows.select("*", F.lit(kind).alias("source_type"), F.col("file_name").alias("file_path"), F.lit(mime).alias("mime_type")), run)  # from here on the run counts
    except Exception as e:
        failed = log.where("status = 'ready'").withColumn("status", F.lit("failed")).withColumn("error_message", F.lit(str(e)[:2000]))
        store.append("ingestion_runs", failed.withColumn("started_at", F.current_timestamp()).withColumn("finished_at", F.current_timestamp()), run)
        raise
    ended = log.join(counts.join(vectors, "document_id", "left"), "document_id", "left").join(about.select("document_id", "warnings"), "document_id", "left")
    ended = ended.withColumn("status", F.when(F.col("status") == "ready", "completed").otherwise(F.col("status"))).withColumn("pages_extracted", F.col("pages")).withColumn("chunks_created", F.col("chunks")).withColumn("embeddings_created", F.col("vectors"))
    store.append("ingestion_runs", ended.withColumn("started_at", F.current_timestamp()).withColumn("finished_at", F.current_timestamp()), run)
    return done
