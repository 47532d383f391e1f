"""Chunks in blocks against the fold of a whole book in one go."""

import random

import pytest
from pyspark.sql import functions as F

from foliant.functions import text as X
from foliant.operators import chunking as C
from foliant.operators.scan import carried, sums_before

RECORD = "document_id string, id string, chapter_number string, chapter_title string, unit_number string, unit_title string, section_number string, section_title string, lesson_title string, pdf_start_page int, pdf_end_page int, printed_start_page int"
TITLES = C.KEY_TITLES


def plain_heading(body):
    import re

    t = " ".join(body.split())
    for level, word in (("chapter_title", "Chapter"), ("unit_title", "Unit"), ("lesson_title", "Lesson"), ("section_title", "Section")):
        if m := re.match(rf"{word} (\d+): (.+)$", t):
            return level, m[2]
    return None, None


def whole_fold(pages, records, limit, overlap):
    """(page_start, page_end, titles, text) of a book's chunks: units in order with a running state, a fold for each run of titles."""
    state, runs = dict.fromkeys(TITLES), []
    for n, text in sorted(pages):
        record = next((r for r in records if r[0] <= n <= r[1]), None)
        if record and any(record[2].values()):
            state = dict(record[2])
        for body in C.paragraphs(X.clean(text), limit):
            level, title = plain_heading(body)
            if level and not record:
                state = state | {level: title} | ({} if level == "section_title" else {"section_title": None})
            if not runs or runs[-1][0] != state:
                runs.append((dict(state), []))
            runs[-1][1].append((n, body))
    kind = lambda body: "definition" if "definition" in body else "explanation"
    return [(a, b, tuple(s[c] for c in TITLES), text) for s, run in runs for a, b, text in C.fold(run, limit, overlap, kind)]


def book(rng, n):
    pages = []
    for page in range(1, n + 1):
        parts = []
        for _ in range(rng.randrange(0, 5)):
            size = rng.choice([2, 5, 9, 20, 45, 70, 155, 390])
            end = "." if rng.random() < 0.7 else ""
            parts.append(" ".join(rng.choice("oak elm yew ash fir bay".split()) for _ in range(size)) + (" the definition" if rng.random() < 0.1 else "") + end)
        if rng.random() < 0.15:
            parts.insert(rng.randrange(len(parts) + 1), f"{rng.choice(['Chapter', 'Unit', 'Lesson', 'Section'])} {page}: {rng.choice(['Seeds', 'Roots', 'Leaves'])}")
        pages.append((page, "\n\n".join(parts)))
    return pages


@pytest.mark.parametrize("block, pages_a_bin", [(4096, 512), (9, 3)])
def test_any_block_size_gives_the_whole_fold(spark, monkeypatch, block, pages_a_bin):
    monkeypatch.setattr(C, "BIN_PAGES", pages_a_bin)
    rng = random.Random(11)
    limit, overlap = 160, 30
    books = {f"b{i}": book(rng, 60) for i in range(4)} | {"long": [(n, t.replace("Chapter", "A").replace("Unit", "A").replace("Lesson", "A").replace("Section", "A")) for n, t in book(rng, 300)]}
    none = dict.fromkeys(TITLES)
    records = {"b0": [(5, 20, none | {"chapter_title": "One"}), (30, 33, none | {"unit_title": "Two", "section_title": "Three"})]}
    rows = [(d, n, t) for d, pages in books.items() for n, t in pages] + [("b0", 99, None), ("b1", 99, " \n"), (None, 1, "lost")]
    rng.shuffle(rows)
    record = [(d, f"r{a}", None, t["chapter_title"], None, t["unit_title"], None, t["section_title"], t["lesson_title"], a, b, None) for d, rs in records.items() for a, b, t in rs]
    # The block's size is bounded below by what may be held; the small one comes to 380 units, of which the long book has more.
    monkeypatch.setattr(C, "BLOCK", block)
    got = C.chunk_books(spark.createDataFrame(rows, "document_id string, page_number int, raw_text string"), spark.createDataFrame(record, RECORD), spark.createDataFrame([(d, limit, overlap) for d in books], "document_id string, max_tokens int, overlap_tokens int")).collect()
    for d, pages in books.items():
        mine = sorted((r for r in got if r.document_id == d), key=lambda r: r.chunk_index)
        want = whole_fold(pages, records.get(d, []), limit, overlap)
        assert [r.chunk_index for r in mine] == list(range(len(want)))
        assert [(r.page_start, r.page_end, tuple(r[c] for c in TITLES), r.content) for r in mine] == want
    assert {r.document_id for r in got} == set(books)


def test_outcomes_are_those_of_the_fold():
    rng = random.Random(3)
    for _ in range(200):
        limit, overlap = 160, rng.choice([0, 20, 50])
        n = [rng.choice([3, 20, 60, 80, 150, -160, -12]) for _ in range(60)]
        before = [rng.choice([3, 20, 60, 80]) for _ in range(8)]
        for held, (end, closed, sizes) in enumerate(C.outcomes(n, before, limit, overlap)):
            whole, first, groups = before + n, len(before) - held, []
            for (a, b), (_, first) in C.flushes(whole, len(before) - held, len(before), limit, overlap):
                groups.append(C.size_of(whole, a, b))
            assert (end, closed, list(sizes)) == (len(whole) - first, len(groups), groups[-2:])


def test_two_level_running_values(spark):
    rng = random.Random(5)
    rows = [(k, i, i // 7, rng.choice([None, None, f"v{i}"])) for k in ("a", "b") for i in range(rng.randrange(20, 60))]
    df = spark.createDataFrame(rows, "k string, i int, bin int, v string").repartition(5)
    out = sums_before(carried(df, "k", "bin", ["i"], ["v"], "n"), "k", "bin", ["i"], F.lit(2), "s").collect()
    for k in ("a", "b"):
        last, place = None, 0
        for _, i, _, v in sorted(r for r in rows if r[0] == k):
            last = v if v is not None else last
            row = next(r for r in out if r.k == k and r.i == i)
            assert (row.v, row.s, row.n) == (last, 2 * place, place)
            place += 1
    assert carried(df.limit(0), "k", "bin", ["i"], ["v"]).count() == 0


def test_numbers_and_topics(spark):
    body = "The oak and the elm stand here, and many of them do. " * 4
    pages = [("b", 1, f"Chapter 3: Seeds\n\n{body}\n\nA Small Garden\n\n{body}"), ("b", 2, f"Section 4: Roots\n\n{body}"), ("b", 3, body), ("b", 4, f"{body}\n\nThe Green Leaf\n\n{body}")]
    record = [("b", "r", "7", "Fruit", None, None, "2", "Pips", None, 3, 4, None)]
    rows = C.chunk_books(spark.createDataFrame(pages, "document_id string, page_number int, raw_text string"), spark.createDataFrame(record, RECORD), spark.createDataFrame([("b", 1000, 0)], "document_id string, max_tokens int, overlap_tokens int")).orderBy("chunk_index").collect()
    assert [(r.chapter_number, r.chapter_title, r.section_number, r.section_title, r.topic) for r in rows] == [("3", "Seeds", None, None, "A Small Garden"), ("3", "Seeds", "4", "Roots", "Roots"), ("7", "Fruit", "2", "Pips", "The Green Leaf")]
