"""Tables of contents into structure records, and page ranges repaired from the pages themselves.

What reads text runs page by page over the cluster; what is sequential within a book (a scan that never goes back) sees
slim rows alone: for each title the pages that may open it.
"""

from __future__ import annotations

import difflib
import itertools
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.functions import text as X
from foliant.operators import structure
from foliant.session import cut

#: Pages at the start of a book that may be its contents, how like two headings must be, how far a start may be moved.
CONTENTS_PAGES, CLOSE, NEAR = 40, 0.78, 3
#: Pages and titles of a book that are compared in one go, and the hashed values of characters by which pairs are bounded.
PAGES_AT_ONCE, TITLES_AT_ONCE, BUCKETS = 1024, 4096, 64
_LETTER = "A-Za-zऀ-ॿ"
_DIGITS = str.maketrans("०१२३४५६७८९", "0123456789")
_UNIT = re.compile(r"\bUnit\s+([0-9०-९]+)\s*[:\-–]\s*(.+)$", re.I)
_ROW = re.compile(r"^(?:(?P<no>[0-9०-९]+|[IVXivx]+)(?=[\s.)\-–:,]))?\s*[.)\-–:,]?\s*(?P<title>[" + _LETTER + r"].*?)\s+(?P<page>[0-9०-९]{1,4})$")


def number(text: str | None) -> int | None:
    t = (text or "").translate(_DIGITS)
    return int(t) if t.isdecimal() else None


_ARTICLES, _AROUND = ("A", "An", "The"), ".,;:'\"’‘“”()"
_NOT_LETTER = re.compile(f"[^{_LETTER}]")


def _is_word(w: str) -> bool:
    """Whether a word may begin a title: an article, or letters that no picture leaves, more than two and not a few small ones."""
    letters = _NOT_LETTER.sub("", w)
    return w.strip(_AROUND) in _ARTICLES or len(letters) > 2 and not (letters.islower() and len(letters) <= 5)


def without_debris(line: str) -> str:
    """A line from its unit, or its first real word, on: what pictures leave before it goes."""
    words = re.sub(f"^[^{_LETTER}0-9]+", "", line).split()
    unit = re.search(r"\bUnit\s+[0-9०-९]+\b.*", " ".join(words), re.I)
    first = next((i for i, w in enumerate(words) if _is_word(w)), len(words) - 1)
    return (unit.group() if unit else " ".join(words[max(0, first) :])).strip(" ,;:-–")


def clean_title(text: str, page: int | None = None, no: int | None = None) -> str | None:
    """A title without its number before it and the numbers after it; none for what holds too few letters or is the contents' own head."""
    after = "".join(rf"(?:\s+{n})?" for n in (no, page) if n is not None)
    t = re.sub(rf"^[0-9०-९]+\s*[.)\-–:,]\s*|{after}$" if after else r"^[0-9०-९]+\s*[.)\-–:,]\s*", "", without_debris(text)).strip(" .:-–,")
    return t if len(t) - len(_NOT_LETTER.findall(t)) >= 3 and t.lower() not in ("contents", "table of contents") else None


@dataclass(frozen=True)
class _Line:
    """A line of contents by what it may be: the unit it opens, a page alone, a title with its page, a roman number."""

    text: str
    bare: str
    unit: re.Match | None
    page: int | None
    titled: re.Match | None
    roman: bool

    @classmethod
    def of(cls, text: str) -> _Line:
        bare = without_debris(text)
        return cls(text, bare, _UNIT.search(bare), _page_alone(bare), re.match(r"^(.*[A-Za-z].*?)\s+([0-9०-९]{1,4})$", bare), re.fullmatch(r"\(?[ivxlcdm]+\)?", text, re.I) is not None)


def _page_alone(x: str) -> int | None:
    digits = re.sub(r"[^0-9०-९]", "", x)
    return number(digits) if digits and len(x) <= 8 and not re.search(f"[{_LETTER}]", x.translate(_DIGITS)) else None


def contents_rows(text: str) -> list[dict]:
    """Records of a page of contents: sections under units, else titles before a column of numbers, else rows of both."""
    lines = [x for x in (" ".join(y.split()) for y in text.splitlines()) if x]
    head = next((i for i, x in enumerate(lines) if "contents" in x.lower() or "अनुक्रमणिका" in x or "विषय सूची" in x), None)
    body = lines if head is None else lines[head + 1 :]
    return _units(body) or (_columns(body) if head is not None else []) or _rows(body)


def _sections(lines: list[_Line]) -> Iterator[tuple[str, int]]:
    """(title, page) within one unit: a title stands in up to three lines before its page, the last of which may bear it."""
    held: list[str] = []
    for x in lines:
        if x.page is not None and held:
            yield " ".join(held), x.page
            held = []
        elif x.titled:
            yield x.titled[1], number(x.titled[2])
            held = []
        elif re.search("[A-Za-z]", x.bare) and len(x.bare) <= 140:
            held = [*held, x.text if held else x.bare][-3:]  # a title may go on in small letters


def _units(body: list[str]) -> list[dict]:
    parts: list[tuple[re.Match, list[_Line]]] = []
    for x in map(_Line.of, body):
        if x.unit:
            parts.append((x.unit, []))
        elif parts and not x.roman and not re.search(r"\bReprint\b", x.text, re.I):
            parts[-1][1].append(x)
    out: list[dict] = []
    counts: Counter = Counter()
    for unit, lines in parts:
        no, title = str(number(unit[1])), clean_title(unit[2]) or unit[2].strip()
        for name, page in _sections(lines):
            if page is not None and page <= 1000 and (name := clean_title(name, page)):
                counts[no] += 1
                out.append({"unit_number": no, "unit_title": title, "section_number": str(counts[no]), "section_title": name, "printed_start_page": page, "structure_type": "section", "detected_by": "toc_units", "confidence": 0.82})
    return out if len(out) >= 3 else []


def _columns(body: list[str]) -> list[dict]:
    """Titles above, their pages below, from the first line that is a number."""
    lines = [(x, digits) for x in body for digits in [re.sub(r"[^0-9०-९]", "", x)]]
    is_page = lambda x, digits: bool(digits) and len(x) <= 8 and not re.search(f"[{_LETTER}]", x.translate(_DIGITS))
    below = next((i for i, (x, d) in enumerate(lines) if is_page(x, d) or re.fullmatch(r"\(?[ivxlcdm]+\)?", x, re.I)), len(lines))
    titles = [t for x, _ in lines[:below] if (t := clean_title(x))]
    pages = [number(d) for x, d in lines[below:] if is_page(x, d)]
    if len(titles) < 5 or len(pages) < max(3, len(titles) // 2):
        return []
    with_page = itertools.zip_longest(titles, pages[: len(titles)])
    return [{"chapter_number": str(i), "chapter_title": t, "printed_start_page": n, "structure_type": "chapter", "detected_by": "toc_columns", "confidence": 0.62} for i, (t, n) in enumerate(with_page, 1)]


def _rows(body: list[str]) -> list[dict]:
    out = []
    for line in body:
        if 4 <= len(line) <= 140 and (m := _ROW.match(line)):
            page, no = number(m["page"]), number(m["no"])
            if title := clean_title(m["title"], page, no):
                out.append({"chapter_number": m["no"], "chapter_title": title, "printed_start_page": page, "structure_type": "chapter", "detected_by": "toc_rows", "confidence": 0.55})
    return out


FIELDS = ["chapter_number", "chapter_title", "unit_number", "unit_title", "section_number", "section_title", "printed_start_page", "structure_type", "detected_by", "confidence"]
_KINDS = {"printed_start_page": T.IntegerType(), "confidence": T.DoubleType()}
ROWS = T.ArrayType(T.StructType([T.StructField(f, _KINDS.get(f, T.StringType())) for f in FIELDS]))


@F.pandas_udf(ROWS)
def _contents_udf(texts: pd.Series) -> pd.Series:
    return pd.Series([[{f: r.get(f) for f in FIELDS} for r in contents_rows(t or "")] for t in texts], dtype=object)


def detect(pages: DataFrame, text: str = "raw_text") -> DataFrame:
    """(document_id, position, fields of FIELDS): the records that a book's pages of contents name, of equal titles the first."""
    head = F.slice(F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: F.trim(x) != ""), 1, 8)
    is_contents = F.exists(head, lambda x: F.trim(x).rlike(r"(?i)^(contents|table of contents)$") | x.rlike("अनुक्रमणिका|विषय सूची")) | (F.regexp_count(F.col(text), F.lit(r"(?im)^\s*Unit\s+[0-9०-९]+\s*[:\-–].+")) >= 2)
    rows = pages.where((F.col("page_number") <= CONTENTS_PAGES) & is_contents).select("document_id", "page_number", F.posexplode(_contents_udf(F.col(text))).alias("i", "r")).select("document_id", "page_number", "i", "r.*")
    title = F.lower(F.trim(F.coalesce("chapter_title", "section_title")))
    first = rows.withColumn("_n", F.row_number().over(Window.partitionBy("document_id", title).orderBy("page_number", "i"))).where("_n = 1")
    return first.withColumn("position", F.row_number().over(Window.partitionBy("document_id").orderBy("page_number", "i"))).select("document_id", "position", *FIELDS)


def _bags(strings: list[str], pairs: bool) -> np.ndarray:
    """How often each string has each character, or pair of neighbours, by hashed value: sums of minima bound what two strings share from above."""
    codes = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    row = np.repeat(np.arange(len(strings)), [len(x) for x in strings])
    if pairs:
        inside = row[1:] == row[:-1]
        codes, row = (codes[:-1] * 31 + codes[1:])[inside], row[1:][inside]
    return np.bincount(row * BUCKETS + codes % BUCKETS, minlength=len(strings) * BUCKETS).reshape(-1, BUCKETS).astype(np.int16)


def close_pairs(lines: list[str], titles: list[str]) -> list[tuple[str, str]]:
    """The pairs of a line and a title whose ratio is CLOSE, or that are equal.

    Nothing is lost before the ratio. M equal characters of S in both need M >= CLOSE / 2 * S, so that the lengths, and
    the characters both have, must suffice; and M in at most S - 2 M + 1 blocks hold 3 M - S - 1 equal pairs of neighbours.
    """
    lines, titles = sorted({x for x in lines if x}, key=len), sorted({x for x in titles if x})
    if not lines or not titles:
        return []
    sizes, words, out = np.array([len(x) for x in lines]), np.array([len(x.split()) for x in lines]), []
    chars, pairs, title_chars, title_pairs = _bags(lines, False), _bags(lines, True), _bags(titles, False), _bags(titles, True)
    half = round(CLOSE * 50)  # of a hundred
    for j, y in enumerate(titles):
        low, high = np.searchsorted(sizes, -(-half * len(y) // (100 - half))), np.searchsorted(sizes, (100 - half) * len(y) // half, "right")
        total = sizes[low:high] + len(y)
        least = -(-half * total // 100)
        at = np.flatnonzero(np.minimum(chars[low:high], title_chars[j]).sum(axis=1) >= least)
        at = at[np.minimum(pairs[low + at], title_pairs[j]).sum(axis=1) >= 3 * least[at] - total[at] - 1] + low
        ratio = difflib.SequenceMatcher(None, "", y)
        for i in at:
            x = lines[i]
            if x != y:
                if len(x) < 4 or words[i] > max(6, len(y.split()) + 3):
                    continue
                ratio.set_seq1(x)
                if ratio.ratio() < CLOSE:
                    continue
            out.append((x, y))
    return out


def head_pairs(heads: list[str], titles: list[str], within: int) -> list[tuple[str, str]]:
    """The pairs of a page's head and a title that begins at one of its places up to `within`, found by the titles' first characters."""
    by_start: dict[str, list[str]] = {}
    for y in set(titles):
        by_start.setdefault(y[:8], []).append(y)
    sizes = {len(k) for k in by_start}
    return [(x, y) for x in set(heads) for y in {y for n in sizes for p in range(min(within, len(x) - n) + 1) for y in by_start.get(x[p : p + n], ()) if x.startswith(y, p)}]


def _hits_udf(within: int):
    @F.pandas_udf("array<struct<i:int,g:string>>")
    def hits(texts: pd.Series, heads: pd.Series, titles: pd.Series) -> pd.Series:
        out = []
        for fs, hs, gs in zip(texts, heads, titles, strict=True):
            places: dict[tuple[str, bool], list[int]] = {}
            for i, k in enumerate(zip(fs, map(bool, hs), strict=True)):
                places.setdefault(k, []).append(i)
            found = [((x, False), y) for x, y in close_pairs([x for x, h in places if not h], list(gs))]
            found += [((x, True), y) for x, y in head_pairs([x for x, h in places if h], list(gs), within)]
            out.append([{"i": i, "g": y} for k, y in found for i in places[k]])
        return pd.Series(out, dtype=object)

    return hits


def _bearing(pages: DataFrame, records: DataFrame, text: str, lines: int, characters: int, head_lines: int, within: int) -> DataFrame:
    """(document_id, id, page_number, line) of the pages with a line near the top like a record's title, or the title within the first characters of the head; there line is null.

    Lines and titles of a book meet in blocks of both, so that no row of a large book grows with it.
    """
    titles = records.select("document_id", "id", X.match_form(structure.display_title()).alias("g")).where("g <> ''").distinct()
    forms = titles.select("document_id", "g").distinct()
    sizes = forms.groupBy("document_id").agg(F.count(F.lit(1)).alias("n"), F.max(F.length("g")).alias("longest"), F.min(F.length("g")).alias("shortest"), F.max(F.size(F.split("g", " "))).alias("words"))
    blocks = forms.join(sizes, "document_id").groupBy("document_id", F.pmod(F.xxhash64("g"), F.ceil(F.col("n") / TITLES_AT_ONCE)).alias("block")).agg(F.collect_list("g").alias("gs")).drop("block")

    # Heads of pages are shuffled once, by book and bin; what is known of a book goes to its bins.
    bin_of = F.floor(F.col("page_number") / PAGES_AT_ONCE).alias("bin")
    bins = pages.select("document_id", bin_of).distinct().join(sizes, "document_id")
    slim = pages.select("document_id", bin_of, "page_number", F.substring(F.coalesce(F.col(text), F.lit("")), 1, characters).alias("c")).join(bins, ["document_id", "bin"])
    top = F.slice(F.filter(F.split("c", "\n"), lambda x: F.trim(x) != ""), 1, lines)
    bare = lambda f: F.regexp_replace(f, r"^(?:(?:chapter|unit|lesson|section|adhyay|अध्याय|इकाई|पाठ|प्रकरण)\s+)?\p{Nd}+\s+", "")
    row = lambda line, f, head: F.struct(line.cast("int").alias("line"), f.alias("f"), F.lit(head).alias("head"))
    fits = lambda f: (F.length(f) > 0) & (F.length(f) * CLOSE <= F.col("longest") * (2 - CLOSE) + 1) & (F.length(f) * (2 - CLOSE) + 1 >= F.col("shortest") * CLOSE) & (F.size(F.split(f, " ")) <= F.greatest(F.lit(6), F.col("words") + 3))
    forms_of = F.flatten(F.transform(top, lambda t, i: F.when(F.length(t) <= 160, F.transform(F.array(X.match_form(t)), lambda f: F.array(row(i, f, False), row(i, bare(f), False)))[0]).otherwise(F.expr("array()"))))
    start = X.match_form(F.array_join(F.slice(F.split("c", "\n"), 1, head_lines), "\n"))
    heads = F.transform(F.array_distinct(F.array("start", F.regexp_replace("start", r"^\p{Nd}+\s+", ""))), lambda f: row(F.lit(None), F.substring(f, F.lit(1), F.col("longest") + within), True))
    both = slim.withColumn("start", start).select("document_id", "bin", "page_number", F.concat(F.filter(F.array_distinct(forms_of), lambda x: fits(x["f"])), F.filter(heads, lambda x: x["f"] != "")).alias("e"))
    at_once = both.groupBy("document_id", "bin").agg(F.flatten(F.collect_list(F.transform("e", lambda x: F.struct(F.col("page_number").alias("page_number"), x["line"].alias("line"), x["f"].alias("f"), x["head"].alias("head"))))).alias("xs"))
    met = at_once.join(bins.select("document_id", "bin").join(blocks, "document_id"), ["document_id", "bin"]).select("document_id", "xs", F.explode(_hits_udf(within)(F.col("xs.f"), F.col("xs.head"), F.col("gs"))).alias("hit"))
    hit = met.select("document_id", F.col("hit.g").alias("g"), F.expr("xs[hit.i]").alias("x")).select("document_id", "g", "x.page_number", "x.line")
    return hit.join(titles, ["document_id", "g"]).groupBy("document_id", "id", "page_number").agg(F.min("line").alias("line"))


def openings(pages: DataFrame, records: DataFrame, text: str = "raw_text") -> DataFrame:
    """(document_id, id, page_number, line): pages of a book, but those of contents, with a line near the top like a record's title.

    The title may also begin within the first 60 characters of the page's head, where it isn't a line of its own; line is null then.
    """
    return _bearing(pages.where(~X.contents_page(F.col(text))), records, text, 10, 1100, 12, 60)


def answer_starts(pages: DataFrame, text: str = "raw_text") -> DataFrame:
    """(document_id, answers_page): where the answers at the end of a book begin, in its last fifth."""
    answer = F.size(F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: X.match_form(x).isin("answer", "answers"))) > 0
    key = X.answer_key_page(F.col(text)) & ~X.activity_page(F.col(text))
    first20 = F.exists(F.slice(F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: F.trim(x) != ""), 1, 20), lambda x: X.match_form(x).isin("answer", "answers"))
    slim = pages.select("document_id", "page_number", (first20 | answer & key).alias("heads"), key.alias("key"))
    last = slim.groupBy("document_id").agg(F.greatest(F.lit(1), F.floor(F.max("page_number") * 0.8).cast("int")).alias("least"))
    late = slim.join(last, "document_id").where(F.col("page_number") >= F.col("least"))
    first = late.where("heads").groupBy("document_id").agg(F.min("page_number").alias("h"))
    back = late.join(first, "document_id").where(F.col("page_number").between(F.col("h") - 4, F.col("h") - 1)).groupBy("document_id", "h").agg(F.max(F.when(~F.col("key"), F.col("page_number"))).alias("stop"), F.min("page_number").alias("low"))
    return first.join(back, ["document_id", "h"], "left").select("document_id", F.coalesce(F.when(F.col("stop").isNotNull(), F.col("stop") + 1).otherwise(F.col("low")), F.col("h")).cast("int").alias("answers_page"))


REPAIRED = "document_id string, id string, pdf_start_page int, pdf_end_page int, source string"


def repair_book(rows: list[dict], last_page: int, answers: int | None, contents: set[int]) -> None:
    """Sets start, end and source of a book's records, which are in the order of detection.

    Each has id, no, own, printed, section, chapter (whether it is one, has a chapter's title), title, at (pages that bear
    the title, sorted) and near (pages with it in a wider head).
    """
    before = 0
    for r in rows:
        opens = next((p for p in r["at"] if p > before), None)
        r["start"], r["source"] = (opens, "title") if opens else (r["own"], "given") if r["own"] else (None, "none")
        before = max(before, r["start"] or 0)
        if r.get("added") and r["source"] == "given":
            r["source"] = "answers"
    for r in rows:
        if answers and r["title"] in ("answer", "answers") and (r["start"] is None or answers < r["start"]):
            r["start"], r["source"] = answers, "answers"
    offset = _section_offset(rows, last_page, contents)
    if offset is not None:
        for r in rows:
            if r["section"] and r["printed"] is not None and 1 <= r["printed"] + offset <= last_page:
                r["start"], r["source"] = r["printed"] + offset, "section_offset"
    else:
        offset = _book_offset(rows)
    for r in rows:
        if offset is not None and r["printed"] is not None and 1 <= (there := r["printed"] + offset) <= last_page:
            if r["start"] is None:
                r["start"], r["source"] = there, "offset"
            elif there != r["start"] and there in r["near"] and abs(there - r["start"]) <= NEAR:
                r["start"], r["source"] = there, "offset_and_title"
    starts = sorted((r for r in rows if r["start"]), key=lambda r: r["start"])
    for r, after in zip(starts, [*starts[1:], None], strict=True):
        r["end"] = max(r["start"], after["start"] - 1) if after else last_page


def _mode(offsets: list[int]) -> tuple[int, int]:
    return min(Counter(offsets).items(), key=lambda x: (-x[1], x[0]), default=(0, 0))


def _section_offset(rows: list[dict], last_page: int, contents: set[int]) -> int | None:
    """As structure.offset_mode, of the first pages that bear the sections' titles in a wider head."""
    sections = [r for r in rows if r["section"] and r["printed"] is not None]
    firsts = [(r, min((p for p in r["near"] if p >= r["printed"] and p not in contents), default=None)) for r in sections]
    offsets = [p - r["printed"] for r, p in firsts if p is not None and p - r["printed"] <= min(120, last_page)]
    best, support = _mode(offsets)
    return best if len(sections) >= 3 and len(offsets) >= 3 and support >= max(3, int(len(offsets) * 0.4)) else None


def _book_offset(rows: list[dict]) -> int | None:
    """As structure.printed_offsets, of the starts as found."""
    found = [r for r in rows if r["start"] is not None]
    for anchors in ([r for r in found if r["no"] == 1 and r["chapter"]], [r for r in found if r["printed"] == 1]):
        if anchors and (offset := min(r["start"] for r in anchors) - 1) >= 0:
            return offset
    best, support = _mode([o for r in found if r["printed"] is not None and 0 <= (o := r["start"] - r["printed"]) <= 80])
    return best if support >= 2 else None


def repair_whole(records: DataFrame, pages: DataFrame, text: str = "raw_text") -> DataFrame:
    """(document_id, id, pdf_start_page, pdf_end_page, source): the whole repair, step by step.

    A record for the answers is added where a book has none and its pages show them; titles are looked for on the pages;
    answers that begin earlier move; the offset of sections, else that of the first chapter, of printed page 1 or of most
    records, fills what is missing and moves starts by up to NEAR pages to a page that bears the title.
    """
    kind = F.col("structure_type") if "structure_type" in records.columns else F.when(structure.filled(F.col("section_title")).isNotNull() & structure.filled(F.col("chapter_title")).isNull(), "section")
    known = records.where(structure.display_title().isNotNull()).dropDuplicates(["document_id", "id"]).withColumn("section", F.coalesce(kind == "section", F.lit(False))).withColumn("added", F.lit(False))
    known = known.select("document_id", "id", "chapter_title", "section_title", "lesson_title", "unit_title", "chapter_number", "pdf_start_page", "printed_start_page", "section", "added")
    answers = cut(answer_starts(pages, text))
    without = answers.join(known.where(X.match_form(structure.display_title()) == "answers").select("document_id").distinct(), "document_id", "left_anti")
    none = lambda n: F.lit(None).cast("string").alias(n)
    added = without.select("document_id", F.md5(F.concat_ws("|", "document_id", F.lit("answers"))).alias("id"), F.lit("Answers").alias("chapter_title"), none("section_title"), none("lesson_title"), none("unit_title"), none("chapter_number"), F.col("answers_page").alias("pdf_start_page"), F.lit(None).cast("int").alias("printed_start_page"), F.lit(False).alias("section"), F.lit(True).alias("added"))
    known = cut(known.unionByName(added))
    of = lambda hits, name: hits.groupBy("document_id", "id").agg(F.sort_array(F.collect_set("page_number")).alias(name))
    slim = known.select("document_id", "id", "added", "section", X.safe_int(F.regexp_extract("chapter_number", r"(\p{Nd}+)", 1)).alias("no"), F.col("pdf_start_page").alias("own"), F.col("printed_start_page").alias("printed"), structure.filled(F.col("chapter_title")).isNotNull().alias("chapter"), X.match_form(structure.display_title()).alias("title"))
    listed = pages.groupBy("document_id").agg(F.max("page_number").alias("last"), F.collect_set(F.when(X.contents_page(F.col(text)), F.col("page_number"))).alias("contents"))
    rows = slim.join(of(openings(pages, known, text), "at"), ["document_id", "id"], "left").join(of(_bearing(pages, known, text, 12, 1200, 15, 80), "near"), ["document_id", "id"], "left").join(listed, "document_id").join(answers, "document_id", "left")

    def one(book: pd.DataFrame) -> pd.DataFrame:
        book = book.sort_values(["no", "own", "id"], na_position="last", kind="stable")
        whole = lambda x: None if pd.isna(x) else int(x)
        some = lambda x: [] if x is None else [int(p) for p in x]
        out = [{"document_id": r.document_id, "id": r.id, "added": bool(r.added), "section": bool(r.section), "chapter": bool(r.chapter), "title": r.title, "no": whole(r.no), "own": whole(r.own), "printed": whole(r.printed), "at": some(r.at), "near": set(some(r.near)), "end": None} for r in book.itertuples()]
        # The record of answers has the number after the last, or after all where none has one.
        new, old = [r for r in out if r["added"]], [r for r in out if not r["added"]]
        numbered = [r for r in old if r["no"] is not None]
        for r in new:
            r["no"] = numbered[-1]["no"] + 1 if numbered else len(old) + 1
        out = [*numbered, *new, *[r for r in old if r["no"] is None]]
        repair_book(out, int(book["last"].iloc[0]), whole(book["answers_page"].iloc[0]), set(some(book["contents"].iloc[0])))
        return pd.DataFrame([[r["document_id"], r["id"], r["start"], r["end"], r["source"]] for r in out], columns=["document_id", "id", "pdf_start_page", "pdf_end_page", "source"]).astype({"pdf_start_page": "Int32", "pdf_end_page": "Int32"})

    return rows.groupBy("document_id").applyInPandas(one, REPAIRED)


def repair_ranges(records: DataFrame, pages: DataFrame, text: str = "raw_text") -> DataFrame:
    """(document_id, id, pdf_start_page, pdf_end_page, source) of each record with a title: starts found on the pages, ends from the next start.

    In the order of their numbers, each record opens on the first page after the one before it that bears its title;
    where none does its own start stays. The most frequent offset of starts to printed numbers then fills what is
    missing, and moves a start by up to NEAR pages to a page that bears the title. The title as a line counts alone, and
    there is no record added: the whole repair is repair_whole().
    """
    slim = records.where(structure.display_title().isNotNull()).select("document_id", "id", X.safe_int(F.regexp_extract("chapter_number", r"(\p{Nd}+)", 1)).alias("no"), F.col("pdf_start_page").alias("own"), F.col("printed_start_page").alias("printed")).dropDuplicates(["document_id", "id"])
    found = openings(pages, records, text)
    found = found.where("line is not null").groupBy("document_id", "id").agg(F.sort_array(F.collect_set("page_number")).alias("at"))
    last = pages.groupBy("document_id").agg(F.max("page_number").alias("last"))
    rows = slim.join(found, ["document_id", "id"], "left").join(last, "document_id")

    def one(book: pd.DataFrame) -> pd.DataFrame:
        book = book.sort_values(["no", "own", "id"], na_position="last", kind="stable")
        last_page, before, out = int(book["last"].iloc[0]), 0, []
        for r in book.itertuples():
            at = [int(p) for p in r.at] if r.at is not None else []
            opens = next((p for p in at if p > before), None)
            own = None if pd.isna(r.own) else int(r.own)
            start, source = (opens, "title") if opens else (own, "given") if own else (None, "none")
            before = max(before, start or 0)
            out.append([r.document_id, r.id, start, None, source, None if pd.isna(r.printed) else int(r.printed), set(at)])
        offsets = pd.Series([s - p for _, _, s, _, src, p, _ in out if s and p is not None and src == "title" and 0 <= s - p <= min(120, last_page)])
        counts = offsets.value_counts() if len(offsets) else offsets
        offset = min(counts[counts == counts.max()].index) if len(counts) and counts.max() >= 2 else None
        for x in out:
            if offset is not None and x[5] is not None and 1 <= (there := int(x[5] + offset)) <= last_page:
                if x[2] is None:
                    x[2], x[4] = there, "offset"
                elif there != x[2] and there in x[6] and abs(there - x[2]) <= NEAR:
                    x[2], x[4] = there, "offset_and_title"
        starts = sorted((x for x in out if x[2]), key=lambda x: x[2])
        for x, y in zip(starts, [*starts[1:], None], strict=True):
            x[3] = max(x[2], y[2] - 1) if y else last_page
        return pd.DataFrame([x[:5] for x in out], columns=["document_id", "id", "pdf_start_page", "pdf_end_page", "source"]).astype({"pdf_start_page": "Int32", "pdf_end_page": "Int32"})

    return rows.groupBy("document_id").applyInPandas(one, REPAIRED)


def merge_missing(primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """primary with the records of fallback whose titles, as match_form, it lacks."""
    key = X.match_form(F.coalesce("chapter_title", "section_title"))
    have = primary.select("document_id", key.alias("_t")).distinct()
    return primary.unionByName(fallback.withColumn("_t", key).join(have, ["document_id", "_t"], "left_anti").drop("_t"), allowMissingColumns=True)


def agreement(a: DataFrame, b: DataFrame) -> DataFrame:
    """(document_id, n_a, n_b, shared): how many titles two detections of a book have, and share."""
    title = X.match_form(F.coalesce("chapter_title", "section_title"))
    keys = lambda d, n: d.select("document_id", title.alias("t")).where("t <> ''").distinct().withColumn(n, F.lit(1))
    both = keys(a, "a").join(keys(b, "b"), ["document_id", "t"], "full")
    return both.groupBy("document_id").agg(F.count("a").alias("n_a"), F.count("b").alias("n_b"), F.count(F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), 1)).alias("shared"))
