"""Book files as JSON: metadata, structure, subsections and pages, whatever layout and spelling they come in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.functions import text as X
from foliant.operators import nested

# The names, letters only, under which a field may stand.
METADATA = {
    "document_key": ["documentkey", "dockey"], "school_name": ["schoolname", "school"], "class_name": ["classname", "class", "standard"], "grade": ["grade"], "board": ["board"], "medium": ["medium"],
    "book_title": ["booktitle", "title"], "subject": ["subject", "subjectname"], "language": ["language"],
}
TITLES = {
    "chapter_number": ["chapternumber"], "chapter_title": ["chaptertitle"], "unit_number": ["unitnumber"], "unit_title": ["unittitle"], "section_number": ["sectionnumber"], "section_title": ["sectiontitle"],
    "lesson_title": ["lessontitle"], "start_page": ["startpage", "startpdfpage", "pdfstartpage"], "end_page": ["endpage", "endpdfpage", "pdfendpage"], "printed_start_page": ["printedstartpage", "startprintedpage"], "printed_end_page": ["printedendpage", "endprintedpage"],
    "text": ["lessontext", "productionlessontext", "content", "text"],
}
SUBSECTION = {"subsection_number": ["subsectionnumber"], "subsection_title": ["subsectiontitle"], "anchor_marker": ["anchormarker"], "start_page": TITLES["start_page"], "end_page": TITLES["end_page"], "text": ["productionsubsectiontext", "subsectiontext", "subsectiontextplain"], "text_length_chars": ["textlengthchars"]}
PAGE = {"page_number": ["pagenumber"], "printed_page_number": ["printedpagenumber"], "text": ["text", "textplain", "cleantext", "selectabletext", "ocrtext", "productiontext"]}
PAGES = ("start_page", "end_page", "printed_start_page", "printed_end_page", "page_number", "printed_page_number", "text_length_chars")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(raw_id, file_name, payload) of the JSON files below a folder, each read whole."""
    files = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(path)
    return files.select(F.xxhash64(F.input_file_name()).alias("raw_id"), F.input_file_name().alias("file_name"), F.col("value").alias("payload"))


def _fields(nodes: DataFrame, tag: str, fields: dict[str, list[str]]) -> DataFrame:
    rows = nested.flat_table(nodes, tag, {c: ("string", names) for c, names in fields.items()})
    return rows.select("raw_key", "node_path", "parent_path", "ordinal", *[(X.safe_int(F.col(c)) if c in PAGES else F.nullif(F.col(c), F.lit(""))).alias(c) for c in fields])


def metadata(nodes: DataFrame) -> DataFrame:
    """(raw_key, fields of METADATA, key_was_derived): the extraction's own values before those of metadata, those before the root's."""
    out = None
    for rank, tag in enumerate(("book", "metadata", "extraction")):
        one = _fields(nodes, tag, METADATA).withColumn("_rank", F.lit(rank))
        out = one if out is None else out.unionByName(one)
    best = out.groupBy("raw_key").agg(*[F.max_by(X.squeeze(F.col(c)), F.when(X.squeeze(F.col(c)).isNotNull(), F.struct("_rank", "node_path"))).alias(c) for c in METADATA])
    derived = X.slug(F.concat_ws("-", "school_name", "class_name", "subject", "book_title"))
    return best.withColumn("key_was_derived", F.col("document_key").isNull()).withColumn("document_key", F.coalesce(X.slug(F.col("document_key")), derived, F.concat(F.lit("book-"), "raw_key")))


def _ancestors(path: Column) -> Column:
    """The paths of all objects around one, the nearest last."""
    steps = F.regexp_extract_all(path, F.lit(r"\[\d+\]|\.[^.\[]+"), F.lit(0))
    return F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(steps) - 1)), lambda i: F.concat(F.lit("$"), F.array_join(F.slice(steps, 1, i), "")))


def inherited(rows: DataFrame, nodes: DataFrame, columns: list[str]) -> DataFrame:
    """rows with columns taken from the nearest object around each that has them, where it has none of its own."""
    holders = None
    for tag in ("chapters", "units", "sections"):
        one = _fields(nodes, tag, {c: TITLES[c] for c in columns}).drop("ordinal", "parent_path")
        holders = one if holders is None else holders.unionByName(one)
    spread = rows.select("raw_key", "node_path", F.posexplode(_ancestors(F.col("node_path"))).alias("_depth", "_around"))
    around = spread.join(holders.select("raw_key", F.col("node_path").alias("_around"), *[F.col(c).alias(f"_{c}") for c in columns]), ["raw_key", "_around"])
    best = around.groupBy("raw_key", "node_path").agg(*[F.max_by(f"_{c}", F.when(F.col(f"_{c}").isNotNull(), F.col("_depth"))).alias(f"_{c}") for c in columns])
    own = [F.coalesce(F.col(c), F.col(f"_{c}")).alias(c) if c in rows.columns else F.col(f"_{c}").alias(c) for c in columns]
    return rows.join(best, ["raw_key", "node_path"], "left").select(*[c for c in rows.columns if c not in columns], *own)


CONTEXT = ["chapter_number", "chapter_title", "unit_number", "unit_title", "section_number", "section_title"]


def structure_records(nodes: DataFrame) -> DataFrame:
    """Chapters, units, sections and lessons with a title that hold no other of them; of a section index, where a book has one, alone."""
    rows = None
    for tag in ("chapters", "units", "sections"):
        one = _fields(nodes, tag, TITLES).withColumn("tag", F.lit(tag))
        rows = one if rows is None else rows.unionByName(one)
    parents = rows.select("raw_key", F.col("parent_path").alias("node_path")).distinct()
    leaves = rows.join(parents, ["raw_key", "node_path"], "left_anti")
    index = F.regexp_replace(F.lower("node_path"), "[^a-z.]", "").contains(".sectionindex")
    has = F.max(index).over(Window.partitionBy("raw_key"))
    out = inherited(leaves.withColumn("_only", has).where(~F.col("_only") | index).drop("_only"), nodes, CONTEXT)
    titled = F.coalesce(*[X.squeeze(F.col(c)) for c in ("chapter_title", "unit_title", "section_title", "lesson_title")]).isNotNull()
    key = F.coalesce(*[X.squeeze(F.col(c)) for c in ("section_number", "section_title", "lesson_title", "chapter_number", "chapter_title", "unit_title")])
    # Numbers of sections repeat from chapter to chapter, so that the key names both.
    return out.where(titled).withColumn("section_key", F.concat_ws("/", "unit_number", "chapter_number", key))


def subsections(nodes: DataFrame) -> DataFrame:
    """All subsections with the titles around them; of equal ones of a book the one with the longest text, the first of those."""
    rows = inherited(_fields(nodes, "subsections", SUBSECTION), nodes, CONTEXT)
    keys = ["raw_key", *CONTEXT, "subsection_number", "subsection_title", "start_page", "end_page"]
    w = Window.partitionBy(*keys).orderBy(F.coalesce(F.length("text"), "text_length_chars", F.lit(0)).desc(), "node_path")
    return rows.where(X.squeeze(F.col("subsection_title")).isNotNull() | F.col("subsection_number").isNotNull()).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def spread_text(rows: DataFrame, keys: list[str], text: str, start: str, end: str) -> DataFrame:
    """(keys..., page_number, text): a text spread over its pages by paragraphs, else sentences, else equal slices of characters.

    Part i of n goes to page floor(i * pages / n). A text without a start page is on page 1; null texts give nothing.
    """
    t, first = F.col(text), F.coalesce(F.col(start), F.lit(1))
    n = F.greatest(F.lit(1), F.coalesce(F.col(end), first) - first + 1)
    parts = lambda p: F.filter(F.split(t, p), lambda x: F.trim(x) != "")
    width = F.greatest(F.lit(1), F.ceil(F.length(t) / n).cast("int"))
    slices = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(t)), width), lambda i: F.substr(t, i, width))
    chosen = F.when(F.size(parts(r"\n\s*\n")) >= n, parts(r"\n\s*\n")).when(F.size(parts(X.SENTENCE_END)) >= n, parts(X.SENTENCE_END)).otherwise(slices)
    spread = rows.where(F.trim(t) != "").select(*keys, first.alias("_first"), n.alias("_n"), chosen.alias("_parts")).select(*keys, "_first", "_n", F.size("_parts").alias("_m"), F.posexplode("_parts").alias("_i", "_part"))
    page = F.col("_first") + F.least(F.col("_n") - 1, F.floor(F.col("_i") * F.col("_n") / F.col("_m"))).cast("int")
    held = spread.groupBy(*keys, page.alias("page_number")).agg(F.array_sort(F.collect_list(F.struct("_i", "_part"))).alias("_ps"))
    return held.select(*keys, "page_number", F.array_join(F.transform("_ps", lambda x: F.trim(x["_part"])), "\n").alias("text"))


def book_pages(nodes: DataFrame) -> DataFrame:
    """(raw_key, page_number, text, synthesised): the pages given, else made from the texts of lessons and subsections."""
    given = _fields(nodes, "pages", PAGE).where(F.col("page_number").isNotNull() & (F.trim("text") != "")).groupBy("raw_key", "page_number").agg(F.min_by("text", "node_path").alias("text"))
    texts = structure_records(nodes).select("raw_key", "node_path", "text", "start_page", "end_page").unionByName(subsections(nodes).select("raw_key", "node_path", "text", "start_page", "end_page"))
    made = spread_text(texts, ["raw_key", "node_path"], "text", "start_page", "end_page").groupBy("raw_key", "page_number").agg(F.array_sort(F.collect_list(F.struct("node_path", "text"))).alias("ps")).select("raw_key", "page_number", F.array_join(F.transform("ps", lambda x: x["text"]), "\n\n").alias("text"))
    rest = made.join(given.select("raw_key").distinct(), "raw_key", "left_anti")
    return given.withColumn("synthesised", F.lit(False)).unionByName(rest.withColumn("synthesised", F.lit(True)))


def load(records: DataFrame, key: str = "raw_id", payload: str = "payload") -> dict[str, DataFrame]:
    """metadata, structure, subsections, pages and rejected payloads, all from one flattening."""
    nodes = nested.flatten(records, key, payload)
    return {"metadata": metadata(nodes), "structure": structure_records(nodes), "subsections": subsections(nodes), "pages": book_pages(nodes), "rejected": nodes.where("tag = 'rejected'").select("raw_key")}
