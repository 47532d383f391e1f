"""Book files: scans of folders, page texts through a pluggable reader, and when OCR is called for."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions import text as X
from foliant.session import cut, ship

#: Takes a file's bytes, yields the text of its pages.
PageReader = Callable[[bytes], Iterator[str]]


def scan(spark: SparkSession, path: str, glob: str = "*.[pP][dD][fF]") -> DataFrame:
    """(path, file_hash, file_size_bytes, school_name, class_name, subject, book_title, content) of the files below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select("path", F.sha2("content", 256).alias("file_hash"), F.col("length").alias("file_size_bytes"), *[c.alias(k) for k, c in X.path_metadata(F.col("path")).items()], "content")


def listing(spark: SparkSession, path: str, glob: str = "*.[pP][dD][fF]") -> DataFrame:
    """scan() without the contents, in the order of the paths."""
    return scan(spark, path, glob).drop("content").orderBy("path")


def unseen(files: DataFrame, documents: DataFrame) -> DataFrame:
    """Files whose hash no document has."""
    return files.join(documents.select("file_hash").where("file_hash is not null").distinct(), "file_hash", "left_anti")


def reader_of(module: str) -> PageReader:
    """A reader on the library of that name, imported where the tasks run."""

    def read(content: bytes) -> Iterator[str]:
        import importlib
        import io

        lib = importlib.import_module(module)
        if module == "fitz":
            with lib.open(stream=content, filetype="pdf") as doc:
                for page in doc:
                    text = page.get_text("text", sort=True) or ""
                    # Some files give no running text but blocks, top down and from the left.
                    yield text if text.strip() else "\n".join(b[4] for b in sorted(page.get_text("blocks"), key=lambda b: (b[1], b[0])) if isinstance(b[4], str))
        else:
            yield from (page.extract_text() or "" for page in lib.PdfReader(io.BytesIO(content)).pages)

    return read


def page_texts(files: DataFrame, readers: list[tuple[str, PageReader]], ocr: Callable[[bytes, int], str] | None = None) -> DataFrame:
    """(path, page_number, raw_text, extraction_method, error): the first reader that works; a file that none reads gives one row with the error.

    ocr, where given, reads those pages again that needs_ocr() names, and replaces the text where better_ocr() says so.
    """
    ship(files.sparkSession)

    def pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows: list[tuple] = []
            for path, content in zip(batch["path"], batch["content"], strict=True):
                errors = []
                for name, read in readers:
                    try:
                        rows += [(path, i, t, name, None) for i, t in enumerate(list(read(content)), 1)]
                        break
                    except Exception as e:
                        errors.append(f"{name}: {e}")
                else:
                    rows.append((path, 0, None, None, "; ".join(errors)[:500] or "no reader"))
            yield pd.DataFrame(rows, columns=["path", "page_number", "raw_text", "extraction_method", "error"])

    native = files.select("path", "content").mapInPandas(pages, "path string, page_number int, raw_text string, extraction_method string, error string")
    if ocr is None:
        return native
    native = cut(native)

    def again(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [ocr(content, int(n)) for content, n in zip(batch["content"], batch["page_number"], strict=True)]
            yield pd.DataFrame({"path": batch["path"], "page_number": batch["page_number"], "ocr": texts})

    doubtful = native.where("error is null").where(X.needs_ocr(F.col("raw_text"))).select("path", "page_number")
    read = doubtful.join(files.select("path", "content"), "path").mapInPandas(again, "path string, page_number int, ocr string")
    both = native.join(read, ["path", "page_number"], "left")
    better = F.coalesce(X.better_ocr(F.col("raw_text"), F.col("ocr")), F.lit(False))
    return both.select("path", "page_number", F.when(better, F.col("ocr")).otherwise(F.col("raw_text")).alias("raw_text"), F.when(better, "ocr").otherwise(F.col("extraction_method")).alias("extraction_method"), "error")


def ocr_language(columns: list[Column]) -> Column:
    """Hindi with English where any attribute speaks of Hindi or Devanagari."""
    return F.when(F.lower(F.concat_ws(" ", *columns)).rlike("hindi|हिंदी|हिन्दी|devanagari|sanskrit"), "hin+eng").otherwise("eng")


# Shares and numbers of sampled pages from which a file is to be read by OCR.
EMPTY_SHARE, FEW_CHARACTERS, CORRUPTED_SHARE, STRAY_PAGES = 0.35, 120, 0.12, 2


def quality_report(sampled: DataFrame, allow_devanagari: Column) -> DataFrame:
    """(document_id, sampled_pages, empty_pages, text_pages, control_pages, replacement_pages, stray_pages, average_characters, should_ocr, reason) of sampled pages (document_id, raw_text, ...).

    Five things call for OCR: many empty pages, little text on the others, many corrupted pages, any control or
    replacement characters, and Devanagari signs on pages of Latin text of a book that is not Hindi (allow_devanagari).
    """
    c = F.col("raw_text")
    n = F.length(F.coalesce(F.regexp_replace(c, r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""), F.lit("")))
    p = sampled.select("document_id", n.alias("n"), (F.regexp_count(c, F.lit(X.C1)) > 0).alias("c"), (F.regexp_count(c, F.lit("\ufffd")) > 0).alias("r"), (X.stray_devanagari(c, 80) & ~allow_devanagari).alias("s"))
    out = p.groupBy("document_id").agg(
        F.count(F.lit(1)).alias("sampled_pages"), F.count_if(F.col("n") == 0).alias("empty_pages"), F.count_if(F.col("n") > 0).alias("text_pages"), F.count_if("c").alias("control_pages"), F.count_if("r").alias("replacement_pages"), F.count_if("s").alias("stray_pages"),
        F.round(F.coalesce(F.avg(F.when(F.col("n") > 0, F.col("n"))), F.lit(0.0)), 2).alias("average_characters"),
    )
    bad = F.col("control_pages") + F.col("replacement_pages") + F.col("stray_pages")
    of = lambda k: F.concat(k.cast("string"), F.lit(" of "), F.col("sampled_pages").cast("string"), F.lit(" sampled pages "))
    reasons = F.array_compact(F.array(
        F.when(F.col("empty_pages") >= EMPTY_SHARE * F.col("sampled_pages"), F.concat(of(F.col("empty_pages")), F.lit("have no text"))),
        F.when((F.col("text_pages") > 0) & (F.col("average_characters") < FEW_CHARACTERS), F.lit("the pages with text have little")),
        F.when(bad >= CORRUPTED_SHARE * F.col("sampled_pages"), F.concat(of(bad), F.lit("look corrupted"))),
        F.when(F.col("control_pages") + F.col("replacement_pages") > 0, F.lit("control or replacement characters")),
        F.when(F.col("stray_pages") >= STRAY_PAGES, F.lit("stray Devanagari signs")),
    ))
    return out.withColumn("should_ocr", F.size(reasons) > 0).withColumn("reason", F.coalesce(F.nullif(F.array_join(reasons, "; "), F.lit("")), F.lit("the text layer looks usable")))
