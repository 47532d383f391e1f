"""Tables of books in one folder that grow by appending: a run's rows count once its books are published.

Every row names the run that wrote it. Publishing appends the books' rows, each with its run, and what is read of any
table are the rows that the newest state of their book names. So a book is replaced as a whole or not at all, a run that
fails leaves nothing to be seen, a repeated run doubles nothing, and no table is ever rewritten for a few books.
compact() writes a table anew without what is superseded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.operators import tables

_PLACE = "chapter_number string, chapter_title string, unit_number string, unit_title string, section_number string, section_title string, lesson_title string"
_STRINGS = lambda names: ", ".join(f"{n} string" for n in names.split())
SCHEMAS = {
    "documents": "id string, " + _STRINGS("title book_title document_key normalized_title school_name class_name subject grade board medium language detected_language primary_language languages_detected publisher edition publication_year isbn author source_type source_uri file_name file_path file_hash") + ", file_size_bytes bigint, mime_type string, total_pages int, total_words int, total_tokens int, extraction_status string, copyright_status string, structure_detected_by string, content_profile string, chunking_strategy string, chunk_max_tokens int, chunk_overlap_tokens int, metadata string, created_at timestamp, updated_at timestamp, deleted boolean",
    "pages": "id string, document_id string, page_number int, raw_text string, cleaned_text string, detected_language string, word_count int, token_count int, has_text boolean, has_math boolean, has_table_like_text boolean, has_devanagari boolean, has_english boolean, extraction_method string, extraction_quality string, metadata string, created_at timestamp",
    "book_chapters": f"id string, document_id string, {_PLACE}, section_key string, structure_type string, printed_start_page int, printed_end_page int, pdf_start_page int, pdf_end_page int, detected_by string, confidence double, metadata string, created_at timestamp, updated_at timestamp",
    "book_subsections": f"id string, document_id string, {_PLACE}, subsection_number string, subsection_title string, anchor_marker string, pdf_start_page int, pdf_end_page int, page_count int, page_numbers array<int>, subsection_text string, text_length_chars int, include_in_embeddings boolean, quality_flags array<string>, metadata string, created_at timestamp, updated_at timestamp",
    "chunks": "id string, document_id string, chunk_index int, page_start int, page_end int, chapter_title string, unit_title string, lesson_title string, section_title string, chapter_number string, unit_number string, section_number string, topic string, content string, chunk_type string, pedagogical_role string, content_domain string, content_for_embedding string, summary string, keywords array<string>, important_terms array<string>, formulas array<string>, numbers array<string>, question_types array<string>, detected_language string, word_count int, token_count int, char_count int, source_label string, citation_text string, metadata string, created_at timestamp",
    "raw_text_pages": f"id string, document_id string, page_number int, raw_text string, {_PLACE}, topic string, printed_page_number int, found_in string, created_at timestamp",
    "vectors": "id string, chunk_id string, document_id string, embedding_model string, embedding_dimensions int, embedding array<float>, embedding_input_hash string, created_at timestamp",
    "subsection_vectors": "id string, subsection_id string, document_id string, embedding_model string, embedding_dimensions int, embedding array<float>, embedding_input_hash string, content_for_embedding string, token_count int, text_was_truncated boolean, created_at timestamp",
    "ingestion_runs": "id string, document_id string, file_path string, file_hash string, document_key string, status string, started_at timestamp, finished_at timestamp, pages_extracted int, chunks_created int, embeddings_created int, error_message string, warnings string, metadata string",
}


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/embeddings_{name}.parquet"

    def _fs(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def exists(self, name: str) -> bool:
        fs, at = self._fs(self.path(name))
        return fs.exists(at)

    def schema(self, name: str) -> T.StructType:
        return T.StructType.fromDDL(f"{SCHEMAS[name]}, run_id string")

    def init(self) -> list[str]:
        """Make the tables that aren't there; those that are stay, and show new columns as null. The names of the new ones."""
        new = [n for n in SCHEMAS if not self.exists(n)]
        for n in new:
            self.spark.createDataFrame([], self.schema(n)).write.parquet(self.path(n))
        return new

    def drop(self) -> None:
        for n in SCHEMAS:
            fs, at = self._fs(self.path(n))
            fs.delete(at, True)

    def append(self, name: str, rows: DataFrame, run: str) -> None:
        """Add rows of a run; columns that the table has not are left out, those that the rows lack are null, times are those of the write."""
        fields = self.schema(name).fields
        now = {"created_at", "updated_at"} if name != "ingestion_runs" else set()
        value = lambda f: F.lit(run) if f.name == "run_id" else F.col(f.name) if f.name in rows.columns else F.current_timestamp() if f.name in now else F.lit(None)
        rows.select(*[value(f).cast(f.dataType).alias(f.name) for f in fields]).write.mode("append").parquet(self.path(name))

    def _all(self, name: str) -> DataFrame:
        if name not in SCHEMAS or not self.exists(name):
            raise ValueError(f"no table {name} in {self.root}")
        own = self.spark.read.parquet(self.path(name))
        if "run_id" not in own.columns:
            return own  # tables that another program wrote
        return self.spark.read.schema(self.schema(name)).parquet(self.path(name))

    def read(self, name: str) -> DataFrame:
        """A table as the newest states of the books make it."""
        rows = self._all(name)
        if name == "documents":
            return self._documents(rows)
        if name == "ingestion_runs":
            return tables.run_states(rows)
        if "run_id" not in rows.columns:
            return rows
        current = self.read("documents").select(F.col("id").alias("document_id"), "run_id")
        return rows.join(current, ["document_id", "run_id"], "left_semi").drop("run_id")

    def _documents(self, rows: DataFrame) -> DataFrame:
        if "run_id" not in rows.columns:
            return tables.latest(rows, ["id"], [F.col("updated_at")])
        first = rows.where(~F.coalesce("deleted", F.lit(False))).groupBy("id").agg(F.min("created_at").alias("created_at"))
        newest = tables.latest(rows, ["id"], [F.col("updated_at"), F.col("run_id")]).where(~F.coalesce("deleted", F.lit(False)))
        return newest.drop("created_at", "deleted").join(first, "id")

    def delete(self, ids: DataFrame, run: str) -> None:
        """Take out the books of these ids (id), and with them all that hangs on them; their runs stay."""
        self.append("documents", ids.select("id", F.lit(True).alias("deleted")), run)

    def compact(self, name: str) -> None:
        """Write a table anew without superseded rows. Written beside it first, so that what is read isn't what is overwritten."""
        rows = self.read(name) if name == "documents" else self._all(name)
        if name not in ("documents", "ingestion_runs"):
            rows = rows.join(self.read("documents").select(F.col("id").alias("document_id"), "run_id"), ["document_id", "run_id"], "left_semi")
        elif name == "ingestion_runs":
            rows = self.read(name)
        beside = f"{self.path(name)}.new"
        rows.write.mode("overwrite").parquet(beside)
        fs, old = self._fs(self.path(name))
        fs.delete(old, True)
        fs.rename(self._fs(beside)[1], old)
