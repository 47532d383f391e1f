"""The structure of books from their pages of contents and, where there is one, a model that reads sampled pages."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions import text as X
from foliant.operators import contents, structure
from foliant.operators.embedding import retried
from foliant.session import cut, ship

#: Takes a prompt, gives the model's answer. Pages shown of the start of a book, characters of a page.
Provider = Callable[[str], str]
FIRST_PAGES, CONTENTS_WITHIN, AFTER_CONTENTS, LATER, PAGE_CHARACTERS = 20, 40, 3, (20, 40, 60, 100), 3500
# What a title key drops, how a reliable table of contents looks, and when it goes before a model's answer.
LEAST_ROWS, WITH_PAGE, RISING = 5, 0.70, 0.80
MANY_MORE, TIMES_MORE, FEWER, SHARED, COMPARED_FROM = 8, 1.35, 0.65, 0.55, 8
#: What the model is asked for.
ASKED = {
    "task": "Give the structure of this book as one JSON object.",
    "rules": ["JSON alone.", "null for what isn't known.", "printed_start_page is the page printed in the contents, pdf_start_page the place in the file.", "Entries under units without chapters go to sections.", "An answers part listed in the contents is a chapter."],
    "fields": ["book_title", "subject", "grade", "primary_language", "languages_detected", "publisher", "author", "isbn", "edition", "publication_year", "content_profile", "recommended_chunk_max_tokens", "recommended_chunk_overlap_tokens", "confidence", "chapters", "sections"],
}


def sampled_pages(pages: DataFrame, text: str = "raw_text", first: int = FIRST_PAGES) -> DataFrame:
    """(document_id, page_number) of the pages that stand for a book: the first ones, pages of contents with those after them, and a few later ones. Slim rows are ranked."""
    toc = F.coalesce(F.col(text).rlike(r"(?i)(?<![\p{L}\p{N}_])(?:contents|table of contents|index)(?![\p{L}\p{N}_])|अनुक्रमणिका|विषय\s*सूची|সূচিপত্র"), F.lit(False))
    place = F.row_number().over(Window.partitionBy("document_id").orderBy("page_number"))
    # No page beyond the last place of interest is ranked further than that.
    most = max(first, CONTENTS_WITHIN, *LATER) + AFTER_CONTENTS + 1
    slim = pages.select("document_id", "page_number", toc.alias("toc")).withColumn("place", place).where(F.col("place") <= most)
    # The pages at the places after a page of contents' own number.
    after = slim.where(F.col("toc") & (F.col("place") <= max(first, CONTENTS_WITHIN))).select("document_id", F.explode(F.sequence(F.col("page_number") + 1, F.col("page_number") + AFTER_CONTENTS)).alias("place")).distinct().withColumn("after", F.lit(True))
    held = slim.join(after, ["document_id", "place"], "left")
    keep = (F.col("place") <= first) | F.col("toc") & (F.col("place") <= max(first, CONTENTS_WITHIN)) | F.coalesce("after", F.lit(False)) | F.col("place").isin(*LATER)
    return held.where(keep).select("document_id", "page_number")


def prompts(pages: DataFrame, books: DataFrame, text: str = "raw_text", first: int = FIRST_PAGES) -> DataFrame:
    """(document_id, prompt): what is asked, what is known, and the sampled pages; a bounded number of characters a book."""
    known = books.select(F.col("id").alias("document_id"), F.struct(*[c for c in ("school_name", "class_name", "grade", "board", "subject", "book_title", "language") if c in books.columns]).alias("known"))
    shown = pages.join(sampled_pages(pages, text, first), ["document_id", "page_number"]).select("document_id", F.struct("page_number", F.substring(F.coalesce(X.squeeze(F.col(text)), F.lit("")), 1, PAGE_CHARACTERS).alias("text")).alias("p"))
    held = shown.groupBy("document_id").agg(F.array_sort(F.collect_list("p")).alias("pages")).join(known, "document_id", "left")
    return held.select("document_id", F.concat(F.lit(json.dumps(ASKED, ensure_ascii=False)[:-1] + ', "known": '), F.coalesce(F.to_json("known"), F.lit("{}")), F.lit(', "pages": '), F.to_json("pages"), F.lit("}")).alias("prompt"))


def recovered(answer: str) -> dict[str, Any]:
    """The JSON object in an answer, with or without a fence or words around it; ValueError for none."""
    bare = re.sub(r"^```(?:json)?\s*|\s*```$", "", answer.strip())
    for candidate in (bare, bare[bare.find("{") : bare.rfind("}") + 1]):
        try:
            value = json.loads(candidate)
        except ValueError:
            continue
        if isinstance(value, dict):
            return value
    raise ValueError("no JSON object in the answer")


RECORD = "document_id string, position int, chapter_number string, chapter_title string, unit_number string, unit_title string, section_number string, section_title string, lesson_title string, printed_start_page int, pdf_start_page int, structure_type string, confidence double"
NAMES = [c.split()[0] for c in RECORD.split(", ")]


def records_of(data: dict[str, Any]) -> list[dict[str, Any]]:
    """Records of a model's object: chapters, then sections without chapter; entries without a title are left out."""
    text = lambda v: (" ".join(str(v).split()) or None) if v is not None and not isinstance(v, (dict, list)) else None
    whole = lambda v: contents.number(t) if (t := text(v)) else None
    real = lambda v: float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else None
    pick = lambda raw, *names: next((v for n in names if (v := text(raw.get(n)))), None)
    out = []
    for kind, names in (("chapter", ("chapter_title", "title", "name")), ("section", ("section_title", "lesson_title", "title", "name"))):
        for i, raw in enumerate((x for x in data.get(f"{kind}s") or [] if isinstance(x, dict)), 1):
            page = whole(raw.get("printed_start_page") or raw.get("start_page"))
            no = pick(raw, f"{kind}_number", "number") or str(i)
            title = contents.clean_title(pick(raw, *names) or "", page, contents.number(no) if kind == "chapter" else None)
            if title:
                own = {"chapter_number": no, "chapter_title": title} if kind == "chapter" else {"unit_number": pick(raw, "unit_number"), "unit_title": pick(raw, "unit_title"), "section_number": no, "section_title": title, "lesson_title": pick(raw, "lesson_title")}
                out.append({**dict.fromkeys(NAMES[2:]), **own, "printed_start_page": page, "pdf_start_page": whole(raw.get("pdf_start_page")), "structure_type": kind, "confidence": real(raw.get("confidence")) or real(data.get("confidence"))})
    return out


def asked(pages: DataFrame, books: DataFrame, provider: Provider, text: str = "raw_text") -> DataFrame:
    """Records (columns of RECORD) that the model gives for each book; a book whose answer can't be read has none."""
    ship(pages.sparkSession)

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, prompt in zip(batch["document_id"], batch["prompt"], strict=True):
                try:
                    found = records_of(recovered(retried(lambda p: [provider(p[0])], [prompt])[0]))
                except (ValueError, ConnectionError, TimeoutError):
                    continue  # the rules' records stand
                rows += [(doc, i, *[r[c] for c in NAMES[2:]]) for i, r in enumerate(found, 1)]
            yield pd.DataFrame(rows, columns=NAMES).astype({"position": "Int32", "printed_start_page": "Int32", "pdf_start_page": "Int32"})

    return prompts(pages, books, text).mapInPandas(ask, RECORD)


def reliable(records: DataFrame, order: list[str]) -> DataFrame:
    """(document_id, records, reliable): whether enough of a book's records have a printed page, and enough of these rise."""
    printed = records.where("printed_start_page is not null").withColumn("_b", F.lag("printed_start_page").over(Window.partitionBy("document_id").orderBy(*order)))
    rising = printed.groupBy("document_id").agg(F.count(F.lit(1)).alias("p"), F.count_if(F.col("printed_start_page") > F.col("_b")).alias("up"))
    n = records.groupBy("document_id").agg(F.count(F.lit(1)).alias("records")).join(rising, "document_id", "left")
    enough = (F.col("records") >= LEAST_ROWS) & (F.col("p") >= F.greatest(F.lit(5), F.floor(F.col("records") * WITH_PAGE))) & (F.col("up") >= F.greatest(F.lit(3), F.floor((F.col("p") - 1) * RISING)))
    return n.select("document_id", "records", F.coalesce(enough, F.lit(False)).alias("reliable"))


def title_key(c: str = "title"):
    return F.trim(F.regexp_replace(F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " ")), r"\s+[0-9]{1,4}$", ""))


def prefer_rules(by_model: DataFrame, by_rules: DataFrame, order: list[str]) -> DataFrame:
    """(document_id, n_model, n_rules, shared, prefer): whether the contents' records go before the model's, for each book that has any."""
    titles = lambda d: d.where(structure.display_title().isNotNull()).select("document_id", structure.display_title().alias("title"))
    keys = lambda d: titles(d).select("document_id", title_key().alias("k")).where("k <> ''").distinct()
    shared = keys(by_model).join(keys(by_rules), ["document_id", "k"]).groupBy("document_id").agg(F.count(F.lit(1)).alias("shared"))
    n = titles(by_model).groupBy("document_id").agg(F.count(F.lit(1)).alias("n_model"))
    in_sections = F.max(F.coalesce((F.col("structure_type") == "section") & structure.filled(F.col("section_title")).isNotNull() & structure.filled(F.col("chapter_title")).isNull(), F.lit(False)))
    rules = reliable(by_rules, order).withColumnRenamed("records", "n_rules").join(by_rules.groupBy("document_id").agg(in_sections.alias("in_sections")), "document_id")
    both = rules.join(n, "document_id", "full").join(shared, "document_id", "left").na.fill(0, ["n_model", "n_rules", "shared"]).na.fill(False, ["reliable", "in_sections"])
    m, r = F.col("n_model"), F.col("n_rules")
    better = F.col("in_sections") | (m == 0) | (m > F.greatest(r + MANY_MORE, F.floor(r * TIMES_MORE))) | (r >= COMPARED_FROM) & ((m < F.floor(r * FEWER)) | (F.col("shared") < F.greatest(F.lit(3), F.floor(r * SHARED))))
    return both.select("document_id", "n_model", "n_rules", "shared", (F.col("reliable") & better).alias("prefer"))


def detect_structure(pages: DataFrame, books: DataFrame, provider: Provider | None = None, text: str = "raw_text") -> DataFrame:
    """(document_id, id, columns of RECORD, detected_by): the records of each book.

    Sections under units that the contents name stand without asking. Else the model's records stand, with those of the
    contents that it lacks, unless the contents are reliable and the model splits otherwise; without a model, or where
    its answer can't be read, the contents alone.
    """
    none = lambda d: d.withColumn("lesson_title", F.lit(None).cast("string")).withColumn("pdf_start_page", F.lit(None).cast("int"))
    rules = cut(none(contents.detect(pages, text)).select(*NAMES, "detected_by"))
    if provider is not None:
        forced = rules.where("structure_type = 'section' and section_title is not null and unit_number is not null").select("document_id").distinct()
        model = cut(asked(pages.join(forced, "document_id", "left_anti"), books, provider, text).withColumn("detected_by", F.lit("model")))
        chosen = prefer_rules(model, rules, ["position"]).where(~F.col("prefer") & (F.col("n_model") > 0)).select("document_id").join(forced, "document_id", "left_anti")
        own = rules.join(chosen, "document_id", "left_anti")
        merged = contents.merge_missing(model.join(chosen, "document_id", "left_semi"), rules.join(chosen, "document_id", "left_semi"))
        rules = own.unionByName(merged.select(*own.columns))
    return rules.withColumn("id", F.substring(F.sha2(F.concat_ws("|", "document_id", "detected_by", "position"), 256), 1, 32))
