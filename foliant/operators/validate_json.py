"""Checks of book files before they are taken in: a row for each problem of a payload.

Two layouts are known, books in chapters and books in units with sections. Names of members count by their letters alone.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import pairwise
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.operators.nested import parse, plain, unwrap
from foliant.session import ship

# Names, letters only, under which a value may stand, the first that is filled counts.
SECTION_TEXT = ["productionlessontext", "lessontext", "sectiontext", "chaptertext", "textplain", "text"]
SUBSECTION_TEXT = ["productionsubsectiontext", "subsectiontext", "subsectiontextplain", "textplain", "text"]
PAGE_TEXT = ["text", "textplain", "ocrtext", "productiontext", "pagetext", "rawtext", "cleanedtext"]
STARTS, ENDS = ["startpage", "startpdfpage", "pdfstartpage"], ["endpage", "endpdfpage", "pdfendpage"]
#: Rules that make an error by layout; all others warn.
ERRORS = {
    "chapters": {"not_json", "no_section_index", "no_document_key", "section_twice", "section_range", "section_pages_outside", "section_without_text", "subsection_twice", "subsection_range", "subsection_out_of_parent", "subsection_without_pages", "subsection_without_text", "subsection_gap", "subsection_overlap", "content_page_without_text"},
    "sections": {"not_json", "no_section_index", "section_twice", "section_range", "section_page_count", "section_pages_outside", "section_without_text", "subsection_twice", "subsection_range", "subsection_out_of_parent", "subsection_anchor_outside", "subsection_without_pages", "subsection_without_text", "subsection_gap", "subsection_overlap", "subsection_not_ready", "content_page_without_text", "sections_expected", "subsections_expected"},
}

Problem = tuple[str, str, str]  # rule, key, detail


class Members:
    """An object's members by the letters of their names."""

    def __init__(self, value: Any):
        self.held = {plain(k): unwrap(v) for k, v in reversed(list(value.items()))} if isinstance(value, dict) else {}

    def text(self, names: list[str]) -> str:
        return next((v for n in names if isinstance(v := self.held.get(n), str) and v.strip()), "")

    def whole(self, names: list[str]) -> int | None:
        return next((v for n in names if isinstance(v := self.held.get(n), int) and not isinstance(v, bool) and v), None)

    def items(self, *names: str) -> list:
        return next((v for n in names if isinstance(v := self.held.get(n), list) and v), [])

    def one(self, name: str) -> Members:
        return Members(self.held.get(name))

    def label(self, *names: str) -> str:
        return next((str(v) for n in names if (v := self.held.get(n)) not in (None, "")), "")

    def range(self) -> tuple[int | None, int | None]:
        pages = self.one("pdfpages")
        return self.whole(STARTS) or pages.whole(["start"]), self.whole(ENDS) or pages.whole(["end"])


def _span(start: int | None, end: int | None) -> str:
    return f"{start}-{end}"


def _whole(pages: list) -> list[int]:
    return [p for p in pages if isinstance(p, int)]


def _section(s: Members, key: str, layout: str) -> Iterator[Problem]:
    start, end = s.range()
    if start is None or end is None or start > end:
        yield "section_range", key, _span(start, end)
        return
    pages = _whole(s.items("indexedpagenumbers", "pagenumbers"))
    if pages and (min(pages) < start or max(pages) > end):
        yield "section_pages_outside", key, f"{_span(min(pages), max(pages))} of {_span(start, end)}"
    if layout == "sections":
        for n in ([len(pages)] if pages else []) + ([n] if (n := s.whole(["pagecount"])) is not None else []):
            if n != end - start + 1:
                yield "section_page_count", key, f"{n} of {end - start + 1}"
    if not s.text(SECTION_TEXT) and not s.held.get("textlengthchars"):
        yield "section_without_text", key, ""


def _subsection(parent: Members, s: Members, key: str, layout: str) -> Iterator[Problem]:
    start, end = s.range()
    if start is None or end is None or start > end:
        yield "subsection_range", key, _span(start, end)
        return
    low, high = parent.range()
    if low is not None and high is not None and (start < low or end > high):
        yield "subsection_out_of_parent", key, f"{_span(start, end)} of {_span(low, high)}"
    pages = _whole(s.items("pagenumbers", "productionindexedpagenumbers"))
    outside = layout == "sections" and pages and (min(pages) < start or max(pages) > end)
    if not pages or outside:
        yield "subsection_without_pages", key, _span(start, end)
    if not s.text(SUBSECTION_TEXT):
        yield "subsection_without_text", key, _span(start, end)
    if layout == "sections":
        anchor = s.whole(["anchorpdfpage"])
        if anchor is not None and not start <= anchor <= end:
            yield "subsection_anchor_outside", key, f"{anchor} of {_span(start, end)}"
        if s.held.get("includeinembeddings") is False:
            yield "subsection_not_ready", key, s.label("embeddingreadiness")


def _coverage(parent: Members, subs: list[Members], key: str) -> Iterator[Problem]:
    """Gaps and overlaps of the subsections of a section, at its edges too."""
    spans = sorted((a, b, s.label("subsectionnumber")) for s in subs for a, b in [s.range()] if a is not None and b is not None)
    if not spans:
        return
    low, high = parent.range()
    if low is not None and spans[0][0] > low:
        yield "subsection_gap", key, f"start {_span(low, spans[0][0] - 1)}"
    if high is not None and spans[-1][1] < high:
        yield "subsection_gap", key, f"end {_span(spans[-1][1] + 1, high)}"
    for (_, before, a), (start, _, b) in pairwise(spans):
        if start > before + 1:
            yield "subsection_gap", key, f"{a}/{b} {_span(before + 1, start - 1)}"
        elif start <= before:
            yield "subsection_overlap", key, f"{a}/{b} {_span(start, before)}"


def _pages(pages: list[Members], extraction: Members) -> Iterator[Problem]:
    total, first, last = (extraction.whole([n]) for n in ("totalpdfpages", "contentstartpage", "contentendpage"))
    numbers = []
    for p in pages:
        n = p.whole(["pagenumber", "pdfpage", "pdfpagenumber"])
        if n is None:
            continue
        numbers.append(n)
        if not p.text(PAGE_TEXT):
            yield "page_without_text", str(n), ""
            if first is not None and last is not None and first <= n <= last:
                yield "content_page_without_text", str(n), ""
        elif not p.text(["productiontext"]):
            yield "page_without_production_text", str(n), ""
    if total and numbers and len(set(numbers)) != total:
        yield "pages_counted", "", f"{len(set(numbers))} of {total}"
    if total and numbers and (min(numbers) != 1 or max(numbers) != total):
        yield "pages_range", "", f"{_span(min(numbers), max(numbers))} of {_span(1, total)}"


def problems(payload: str | None, layout: str = "chapters", expected: dict[str, Any] | None = None) -> Iterator[Problem]:
    """(rule, key, detail) of all problems of a payload. expected: document_key, structure_type, total_pdf_pages, content_start_page, content_end_page, sections, subsections."""
    try:
        value = parse((payload or "").strip())
    except ValueError:
        value = None
    if not isinstance(value := unwrap(value), dict):
        yield "not_json", "", ""
        return
    root = Members(value)
    extraction, key = root.one("extraction"), root.one("metadata").label("documentkey") or root.label("documentkey")
    if not key:
        yield "no_document_key", "", ""
    index = extraction.held.get("sectionindex")
    if not isinstance(index, list):
        yield "no_section_index", "", ""
    sections = [Members(s) for s in index if isinstance(s, dict)] if isinstance(index, list) else []
    names = ["chapternumber", "sectionnumber"] if layout == "chapters" else ["sectionnumber", "chapternumber"]
    seen, seen_subs, n_subs = Counter(), Counter(), 0
    for s in sections:
        own = s.label(*names)
        seen[own] += 1
        yield from _section(s, own, layout)
        subs = [Members(x) for x in s.items("subsections") if isinstance(x, dict)]
        n_subs += len(subs)
        for x in subs:
            seen_subs[own, x.label("subsectionnumber")] += 1
            yield from _subsection(s, x, f"{own}/{x.label('subsectionnumber')}", layout)
        yield from _coverage(s, subs, own)
    yield from (("section_twice", k, str(n)) for k, n in seen.items() if k and n > 1)
    yield from (("subsection_twice", "/".join(k), str(n)) for k, n in seen_subs.items() if all(k) and n > 1)
    pages = [Members(p) for p in (extraction.items("pageextractions") or root.items("pageextractions")) if isinstance(p, dict)]
    yield from _pages(pages, extraction)
    found = {"document_key": key, "structure_type": extraction.label("structuretype"), "sections": len(sections), "subsections": n_subs, "pages": len(pages), **{n: extraction.whole([plain(n)]) for n in ("total_pdf_pages", "content_start_page", "content_end_page")}}
    for name, want in (expected or {}).items():
        if found.get(name) != want:
            yield f"{name}_expected", str(want), str(found.get(name))


def violations(records: DataFrame, key: str, payload: str, layout: str = "chapters", expected: dict[str, Any] | None = None) -> DataFrame:
    """(key, rule, severity, place, detail): a row for each problem of each payload; severity is error or warning by ERRORS.

    Null, blank and incomplete payloads are `not_json`. Repeated rows give their problems each; other columns are ignored.
    """
    if layout not in ERRORS:
        raise ValueError(f"the layout must be one of {', '.join(ERRORS)}")
    ship(records.sparkSession)
    kind = records.schema[key].dataType.simpleString()

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(k, rule, "error" if rule in ERRORS[layout] else "warning", place, detail) for k, p in zip(batch["k"], batch["p"], strict=True) for rule, place, detail in problems(p, layout, expected)]
            yield pd.DataFrame(rows, columns=["k", "rule", "severity", "place", "detail"])

    rows = records.select(F.col(f"`{key}`").alias("k"), F.col(f"`{payload}`").alias("p"))
    return rows.mapInPandas(check, f"k {kind}, rule string, severity string, place string, detail string").withColumnRenamed("k", key)
