"""Pages and the chapters, units, sections and lessons they belong to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TITLES = ["chapter_title", "unit_title", "section_title", "lesson_title"]
#: Pages of a bin of the range join: a book's pages are spread over its bins, and only ranges that touch a bin meet it.
BIN = 64


def filled(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def resolve_pages(pages: DataFrame, records: DataFrame) -> DataFrame:
    """pages with `record`, the most specific range that covers each: most titles, shortest, latest start, last id.

    A range without start covers nothing, one without end goes on to the end of the book. Pages that nothing covers
    have a null record. The range join is an equi-join by book and bin of BIN pages.
    """
    last = pages.groupBy("document_id").agg(F.max("page_number").alias("_last"))
    ranges = records.where(F.coalesce("pdf_start_page", F.lit(0)) != 0).join(last, "document_id").withColumn("_end", F.coalesce("pdf_end_page", "_last"))
    titled = sum((filled(F.col(c)).isNotNull().cast("int") for c in TITLES), F.lit(0))
    rank = F.struct(titled.alias("t"), (F.col("pdf_start_page") - F.coalesce(F.col("pdf_end_page"), F.lit(2_000_000_000))).alias("s"), F.col("pdf_start_page").alias("p"), F.col("id").alias("i"))
    bins = ranges.where(F.col("_end") >= F.col("pdf_start_page")).select("document_id", "pdf_start_page", "_end", rank.alias("_rank"), F.struct(*records.columns).alias("record"), F.explode(F.sequence(F.floor(F.col("pdf_start_page") / BIN), F.floor(F.least("_end", "_last") / BIN))).alias("_bin"))
    at = pages.select("document_id", "page_number").distinct().withColumn("_bin", F.floor(F.col("page_number") / BIN))
    hit = at.join(bins, ["document_id", "_bin"]).where(F.col("page_number").between(F.col("pdf_start_page"), F.col("_end")))
    best = hit.groupBy("document_id", "page_number").agg(F.max_by("record", "_rank").alias("record"))
    return pages.join(best, ["document_id", "page_number"], "left")


def printed_page(page: Column, record: Column) -> Column:
    """The printed number of a page of a resolved record."""
    return record["printed_start_page"] + (page - record["pdf_start_page"])


def covering_chunk(pages: DataFrame, chunks: DataFrame) -> DataFrame:
    """(document_id, page_number, chunk_id, chapter_title): the first chunk over a page, one with a chapter preferred."""
    spread = chunks.where(F.col("page_start") <= F.col("page_end")).select("document_id", F.col("id").alias("chunk_id"), "chapter_title", "chunk_index", F.explode(F.sequence("page_start", "page_end")).alias("page_number"))
    hit = pages.select("document_id", "page_number").distinct().join(spread, ["document_id", "page_number"])
    order = F.struct(filled(F.col("chapter_title")).isNull(), F.col("chunk_index"))
    return hit.groupBy("document_id", "page_number").agg(F.min_by(F.struct("chunk_id", "chapter_title"), order).alias("c")).select("document_id", "page_number", "c.*")


def display_title(r: DataFrame | None = None) -> Column:
    return F.coalesce(*[filled(F.col(c)) for c in ("chapter_title", "section_title", "lesson_title", "unit_title")])


def normalized(records: DataFrame) -> DataFrame:
    """Records with a title, numbered by position within their book where the number is missing."""
    far = F.lit(10**9)
    order = [F.coalesce("pdf_start_page", far), F.coalesce("printed_start_page", far), F.coalesce(filled(F.col("chapter_number")), F.lit("")), F.coalesce(filled(F.col("section_number")), F.lit("")), display_title(), F.col("id"), F.col("updated_at")]
    ranked = records.where(display_title().isNotNull()).withColumn("position", F.row_number().over(Window.partitionBy("document_id").orderBy(*order)))
    missing = filled(F.col("chapter_number")).isNull() & filled(F.col("chapter_title")).isNotNull()
    return ranked.withColumn("chapter_number", F.when(missing, F.col("position").cast("string")).otherwise(F.col("chapter_number")))


def with_ends(records: DataFrame, pages: DataFrame) -> DataFrame:
    """Ends from the next start, the last one from the last page of the book."""
    last = pages.groupBy("document_id").agg(F.max("page_number").alias("_last"))
    w = Window.partitionBy("document_id").orderBy("pdf_start_page", "id", "updated_at")
    starts = records.where(F.coalesce("pdf_start_page", F.lit(0)) > 0).withColumn("_next", F.lead("pdf_start_page").over(w))
    return starts.join(last, "document_id").withColumn("computed_end_page", F.when(F.col("_next").isNotNull(), F.col("_next") - 1).otherwise(F.col("_last"))).drop("_next", "_last")


def printed_offsets(records: DataFrame) -> DataFrame:
    """(document_id, page_offset, source): pdf page = printed page + offset.

    From where chapter 1 starts, else where printed page 1 is, else the most frequent offset from 0 to 80 of two records
    or more, the smallest of equals.
    """
    r = records.where(F.col("pdf_start_page").isNotNull())
    one = F.translate(F.regexp_extract("chapter_number", r"(\p{Nd}+)", 1), "०१२३४५६७८९", "0123456789").try_cast("int") == 1
    offset = F.col("pdf_start_page") - F.col("printed_start_page")
    anchors = r.groupBy("document_id").agg((F.min(F.when(one & filled(F.col("chapter_title")).isNotNull(), F.col("pdf_start_page"))) - 1).alias("chapter_1"), (F.min(F.when(F.col("printed_start_page") == 1, F.col("pdf_start_page"))) - 1).alias("printed_1"))
    modes = r.where(offset.between(0, 80)).groupBy("document_id", offset.alias("o")).agg(F.count(F.lit(1)).alias("n")).groupBy("document_id").agg(F.max_by(F.struct("o", "n"), F.struct(F.col("n"), -F.col("o"))).alias("m"))
    found = anchors.join(modes, "document_id", "left")
    picks = [(F.when(F.col("chapter_1") >= 0, F.col("chapter_1")), "chapter_1_anchor"), (F.when(F.col("printed_1") >= 0, F.col("printed_1")), "printed_page_1_anchor"), (F.when(F.col("m.n") >= 2, F.col("m.o")), "dominant_offset")]
    return found.select("document_id", F.coalesce(*[c for c, _ in picks]).alias("page_offset"), F.coalesce(*[F.when(c.isNotNull(), s) for c, s in picks]).alias("source")).where(F.col("page_offset").isNotNull())


def offset_mode(records: DataFrame) -> DataFrame:
    """(document_id, page_offset, support, total) of books where one offset has the support of max(3, 40 %) records."""
    offset = F.col("pdf_start_page") - F.col("printed_start_page")
    counts = records.where(offset.between(0, 120)).groupBy("document_id", offset.alias("page_offset")).agg(F.count(F.lit(1)).alias("support"))
    best = counts.groupBy("document_id").agg(F.max_by(F.struct("page_offset", "support"), F.struct(F.col("support"), -F.col("page_offset"))).alias("b"), F.sum("support").alias("total")).select("document_id", "b.*", "total")
    return best.where((F.col("total") >= 3) & (F.col("support") >= F.greatest(F.lit(3), F.floor(F.col("total") * 0.4))))


def chunk_chapter_overlaps(chunks: DataFrame, records: DataFrame) -> DataFrame:
    """(chunk_id, record_id) of chunks and records of a book whose pages overlap and whose titles, where both have one, agree."""
    a = chunks.where(F.col("page_start") <= F.col("page_end")).select("document_id", F.col("id").alias("chunk_id"), F.col("chapter_title").alias("_title"), "page_start", "page_end", F.explode(F.sequence(F.floor(F.col("page_start") / BIN), F.floor(F.col("page_end") / BIN))).alias("_bin"))
    b = records.where(F.col("pdf_start_page") <= F.col("pdf_end_page")).select("document_id", F.col("id").alias("record_id"), "chapter_title", "pdf_start_page", "pdf_end_page", F.explode(F.sequence(F.floor(F.col("pdf_start_page") / BIN), F.floor(F.col("pdf_end_page") / BIN))).alias("_bin"))
    meets = (F.col("page_start") <= F.col("pdf_end_page")) & (F.col("page_end") >= F.col("pdf_start_page")) & (filled(F.col("_title")).isNull() | filled(F.col("chapter_title")).isNull() | (F.col("_title") == F.col("chapter_title")))
    return a.join(b, ["document_id", "_bin"]).where(meets).select("chunk_id", "record_id").distinct()


def matches(chunks: DataFrame, records: DataFrame, agree: list[str], alone: bool) -> DataFrame:
    """(chunk_id, record_id) of chunks and records of a book whose pages overlap and whose titles of `agree`, where both have one, are equal; with `alone`, a record of which no chunk agrees gets those that overlap."""
    bins = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / BIN), F.floor(F.col(b) / BIN))).alias("_bin")
    a = chunks.where(F.col("page_start") <= F.col("page_end")).select("document_id", F.col("id").alias("chunk_id"), "page_start", "page_end", *[filled(F.col(c)).alias(f"a_{c}") for c in agree], bins("page_start", "page_end"))
    end = F.coalesce("pdf_end_page", "pdf_start_page")
    b = records.where(F.col("pdf_start_page") <= end).select("document_id", F.col("id").alias("record_id"), "pdf_start_page", end.alias("end"), *[filled(F.col(c)).alias(f"b_{c}") for c in agree])
    b = b.select("*", bins("pdf_start_page", "end"))
    met = a.join(b, ["document_id", "_bin"]).where((F.col("page_start") <= F.col("end")) & (F.col("page_end") >= F.col("pdf_start_page")))
    same = F.lit(True)
    for c in agree:
        same = same & F.coalesce(F.col(f"a_{c}") == F.col(f"b_{c}"), F.lit(True))
    pairs = met.groupBy("document_id", "chunk_id", "record_id").agg(F.bool_or(same).alias("same"))
    if alone:
        some = pairs.groupBy("record_id").agg(F.bool_or("same").alias("some"))
        pairs = pairs.join(some, "record_id").withColumn("same", F.col("same") | ~F.col("some"))
    return pairs.where("same").select("chunk_id", "record_id")


def with_printed_ends(records: DataFrame, pages: DataFrame) -> DataFrame:
    """with_ends(), and printed_end_page: the end less the book's offset, where one is known, else the page before the next printed start; null without a printed start."""
    w = Window.partitionBy("document_id").orderBy("pdf_start_page", "id", "updated_at")
    ends = with_ends(records.drop("printed_end_page"), pages).withColumn("_np", F.lead("printed_start_page").over(w)).join(printed_offsets(records).select("document_id", "page_offset"), "document_id", "left")
    printed = F.when(F.col("page_offset").isNotNull(), F.col("computed_end_page") - F.col("page_offset")).otherwise(F.col("_np") - 1)
    return ends.withColumn("printed_end_page", F.when(F.col("printed_start_page").isNotNull(), printed)).drop("_np", "page_offset")
