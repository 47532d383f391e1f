"""Chunks, contents, ranges, search, embedding, tables, files and streams on small fixtures."""

import difflib
import json
import random

import pytest
from pyspark.sql import functions as F

from foliant.operators import chunking as C
from foliant.operators import contents as T
from foliant.operators import embedding as E
from foliant.operators import search as S
from foliant.operators import structure, tables
from foliant.sources import files
from foliant.streaming import books as stream

RECORD = "document_id string, id string, chapter_number string, chapter_title string, unit_number string, unit_title string, section_number string, section_title string, lesson_title string, pdf_start_page int, pdf_end_page int, printed_start_page int"


def one_book_fold(units, limit, overlap):
    """The whole book in one go, units (page, key, text): a change of key flushes and clears."""
    out, run = [], []
    for u in [*units, None]:
        if run and (u is None or u[1] != run[-1][1]):
            out += C.fold([(p, t) for p, _, t in run], limit, overlap, lambda _: "explanation")
            run = []
        if u:
            run.append(u)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_fold(seed):
    rng = random.Random(seed)
    units = [(i // 3 + 1, " ".join(rng.choice(["oak", "elm", "yew."]) for _ in range(rng.choice([5, 30, 60, 240])))) for i in range(60)]
    limit, overlap = 100, 20
    got = C.fold(units, limit, overlap, lambda _: "explanation")
    text = " ".join(x for _, _, x in got)
    for _, u in units:
        assert all(part in text for part in C.windows(u, limit, overlap))
    assert all(C.count(x) <= limit + overlap for _, _, x in got)
    assert [a for a, _, _ in got] == sorted(a for a, _, _ in got)


def test_fold_merges_small_ends_and_keeps_formulas():
    units = [(1, "oak " * 90), (2, "elm " * 20)]
    assert len(C.fold(units, 100, 0, lambda _: "explanation")) == 2
    units = [(1, "oak " * 50), (2, "oak " * 60), (3, "elm " * 9)]
    assert [x[:2] for x in C.fold(units, 100, 0, lambda _: "explanation")] == [(1, 1), (2, 3)]
    big = [(1, "oak " * 90), (2, "elm " * 30)]
    assert len(C.fold(big, 130, 0, lambda _: "formula")) == 1 and C.windows("", 5, 1) == []


def test_paragraphs_and_windows():
    assert C.paragraphs("a b\n\n \nc", 10) == ["a b", "c"]
    assert C.paragraphs("One two three. Four five six. Seven.", 8) == ["One two three. Four five six.", "Seven."] or len(C.paragraphs("One two three. Four five six. Seven.", 8)) == 2
    w = C.windows(" ".join(str(i) for i in range(100, 130)), 10, 3)
    assert w[0].split() == [str(i) for i in range(100, 110)] and w[1].split()[0] == "107"


def test_chunk_books(spark):
    pages = spark.createDataFrame([("b", n, f"Page {n} is about seeds. " * 20) for n in range(1, 9)] + [("b", 9, " "), ("c", 1, None)], "document_id string, page_number int, raw_text string")
    records = spark.createDataFrame([("b", "r1", "1", "Seeds", None, None, None, None, None, 2, 4, None), ("b", "r2", "2", "Roots", None, None, None, None, None, 5, None, None)], RECORD)
    plans = spark.createDataFrame([("b", 150, 30)], "document_id string, max_tokens int, overlap_tokens int")
    rows = C.chunk_books(pages, records, plans).orderBy("chunk_index").collect()
    assert [r.chunk_index for r in rows] == list(range(len(rows))) and [r.chapter_title for r in rows] == sorted((r.chapter_title for r in rows), key=[None, "Seeds", "Roots"].index)
    assert all(C.count(r.content) <= 180 for r in rows) and {p for r in rows for p in range(r.page_start, r.page_end + 1)} == set(range(1, 9))


CONTENTS = {
    "units": ("Contents\nForeword iii\n, Unit 1: Fables\nA Bottle of Dew 1\nThe Raven\nand the Fox\n13\nUnit 2: Friends\n; iv - ee: Hamara Bharat 31\nReprint 2026", [("1", "A Bottle of Dew", 1), ("1", "The Raven and the Fox", 13), ("2", "Hamara Bharat", 31)]),
    "columns": ("CONTENTS\nIntegers\nFractions\nDecimals\nExponents\nRatio\niii\n1\n18\n३६\n50\n66", [(None, "Integers", 1), (None, "Fractions", 18), (None, "Decimals", 36), (None, "Exponents", 50), (None, "Ratio", 66)]),
    "rows": ("अनुक्रमणिका\n1. Integers 1\n2 Fractions and Decimals 18\n३. भिन्न ३६\nnonsense", [(None, "Integers", 1), (None, "Fractions and Decimals", 18), (None, "भिन्न", 36)]),
    "noise": ("Contents\nabc\n12 x 3", []),
}


@pytest.mark.parametrize("kind", CONTENTS)
def test_contents(kind):
    text, want = CONTENTS[kind]
    assert [(r.get("unit_number"), r.get("section_title") or r.get("chapter_title"), r["printed_start_page"]) for r in T.contents_rows(text)] == want


def test_detect_and_repair(spark):
    body = {3: "Chapter 1\nIntegers\nbody text here", 9: "Frnctlons\nbody of it", 14: "3 Decimals\nmore", 18: "text", 19: "EXERCISE 1 EXERCISE 2\n1. 2.", 20: "Answers\n1. x", 2: CONTENTS["rows"][0].replace("अनुक्रमणिका", "Contents")}
    pages = spark.createDataFrame([("b", n, body.get(n, "The integers and fractions of this page are long.")) for n in range(1, 21)], "document_id string, page_number int, raw_text string")
    assert {r.chapter_title for r in T.detect(pages).collect()} == {"Integers", "Fractions and Decimals", "भिन्न"}
    records = spark.createDataFrame([("b", "i", "1", "Integers", None, None, None, None, None, 2, 5, 1), ("b", "f", "2", "Fractions", None, None, None, None, None, None, None, 7), ("b", "d", "3", "Decimals", None, None, None, None, None, 4, None, 12), ("b", "e", "4", "Exponents", None, None, None, None, None, None, None, 16), ("b", "x", None, " ", None, None, None, None, None, 1, 1, 1)], RECORD)
    got = {r.id: (r.pdf_start_page, r.pdf_end_page, r.source) for r in T.repair_ranges(records, pages).collect()}
    assert got == {"i": (3, 8, "title"), "f": (9, 13, "offset"), "d": (14, 17, "title"), "e": (18, 20, "offset")}
    assert [tuple(r) for r in T.answer_starts(pages).collect()] == [("b", 19)]
    assert T.repair_ranges(records.limit(0), pages).count() == 0


def test_close_pairs_lose_nothing():
    rng = random.Random(3)
    titles = ["".join(rng.choice("abcdeilor ") for _ in range(rng.choice([3, 6, 12, 25, 60]))).strip() or "a" for _ in range(60)] + ["गणित और खेल"]
    bent = lambda t: "".join(rng.choice([c, c, c, c, "", rng.choice("abxyz"), c + "q"]) for c in t).strip()
    lines = [*titles[:5], *[bent(t) for t in titles for _ in range(12)], "गणित आर खल", ""]
    ratio = lambda x, y: difflib.SequenceMatcher(None, x, y).ratio()
    want = {(x, y) for x in lines for y in titles if x and (x == y or len(x) >= 4 and len(x.split()) <= max(6, len(y.split()) + 3) and ratio(x, y) >= 0.78)}
    assert set(T.close_pairs(lines, titles)) == want and len(want) > 100
    assert T.close_pairs([], titles) == [] and T.close_pairs([""], ["", "a"]) == []


def test_openings_misread_at_both_ends_or_within_the_head(spark):
    far = "x" * 40 + " " + "y" * 30 + " Glaciers and Saddles"
    texts = ["Prologucs and Ribb0ns\nbody", "Gl@ciers and S@ddles | 7\nbody", "Exponenis\nbody", "RATIO the Glaciers and Saddles of this land are many and their ends are long\nbody", "12 " + far[30:] + " and more of it to read", far, "Contents\nGlaciers and Saddles", None, "Unit 3 Rivers"]
    pages = spark.createDataFrame([("b", n, t) for n, t in enumerate(texts, 1)] + [("z", 1, "Exponents"), (None, 1, "Exponents")], "document_id string, page_number int, raw_text string")
    titles = {"p": "Prologues and Ribbons", "g": "Glaciers and Saddles", "e": "Exponents", "r": "Unit 3: Rivers", "n": " "}
    records = spark.createDataFrame([("b", k, None, t, None, None, None, None, None, None, None, None) for k, t in titles.items()], RECORD)
    got = {(r.id, r.page_number, r.line) for r in T.openings(pages, records).collect()}
    assert got == {("p", 1, 0), ("g", 2, 0), ("e", 3, 0), ("g", 4, None), ("g", 5, None), ("r", 9, 0)}
    assert T.openings(pages, records.limit(0)).count() == 0 and T.openings(pages.limit(0), records).count() == 0


def test_whole_repair(spark):
    plain = "Here is a long line of text about other things."
    answers = {3: "Chapter 1\nIntegers\nbody", 18: "EXERCISE 1 EXERCISE 2\n1. 2.", 19: "Answers\n1. x"}
    sections = {5: "The Raven\nbody", 9: "The Kite\nbody", 12: "The Oak\nbody", 17: "The Raven\nagain"}
    rows = [(b, n, body.get(n, plain)) for b, body in (("a", answers), ("s", sections)) for n in range(1, 21)]
    pages = spark.createDataFrame(rows, "document_id string, page_number int, raw_text string")
    record = lambda b, i, no, chapter, section, own, printed: (b, i, no, chapter, None, None, None, section, None, own, None, printed)
    records = [record("a", "i", "1", "Integers", None, 2, 5), record("a", "d", "2", "Decimals", None, None, 8)]  # of one title found, the anchor of chapter 1 holds
    records += [record("s", "o", None, None, "The Oak", None, 8), record("s", "k", None, None, "The Kite", None, 5), record("s", "r", None, None, "The Raven", 17, 1), record("s", "z", None, None, "The Lost", 2, 12)]
    got = {(r.document_id, r.id if len(r.id) == 1 else "new"): (r.pdf_start_page, r.pdf_end_page, r.source) for r in T.repair_whole(spark.createDataFrame(records, RECORD), pages).collect()}
    assert got == {
        ("a", "i"): (3, 9, "title"), ("a", "d"): (10, 17, "offset"), ("a", "new"): (18, 20, "answers"),
        ("s", "r"): (5, 8, "section_offset"), ("s", "k"): (9, 11, "section_offset"), ("s", "o"): (12, 15, "section_offset"), ("s", "z"): (16, 20, "section_offset"),
    }


def test_resolve_prefers_the_most_specific(spark):
    pages = spark.createDataFrame([("b", n) for n in (1, 5, 70, 130, 999)] + [("z", 1)], "document_id string, page_number int")
    records = spark.createDataFrame([("b", "c", "1", "C", None, None, None, None, None, 1, None, None), ("b", "s", "1", "C", None, None, "1", "S", None, 60, 140, None), ("b", "t", "1", "C", None, None, "2", "T", None, 100, 140, None), ("b", "u", None, "U", None, None, None, None, None, 0, 10, None), ("b", "v", None, "V", None, None, None, None, None, 9, 2, None)], RECORD)
    got = {(r.document_id, r.page_number): r.record.id if r.record else None for r in structure.resolve_pages(pages, records).collect()}
    assert got == {("b", 1): "c", ("b", 5): "c", ("b", 70): "s", ("b", 130): "t", ("b", 999): "c", ("z", 1): None}


@pytest.mark.parametrize(
    "query, text, rank",
    [("fox", "the fox and the fox", 0.4), ("fox -red", "a red fox", None), ('"red fox"', "a fox red", None), ('"red fox"', "a red fox", 0.2), ("red fox", "red big fox", 0.1), ("cat or fox", "a fox", 0.2), ("cat fox", "a fox", None)],
)
def test_cover_density(query, text, rank):
    tokens = text.split()
    got = S.cover_density(tokens, [0.2] * len(tokens), S.parse_query(query))
    assert got == (None if rank is None else pytest.approx(rank))


def test_hybrid(spark):
    chunks = spark.createDataFrame([("a", "b", "Integers", "adding integers", "State", "explanation", "T"), ("c", "b", "Fractions", "the reciprocal of a fraction", "State", "example", "T"), ("d", "b", "Other", "reciprocal", "CBSE", "example", "T")], "id string, document_id string, chapter_title string, content string, board string, chunk_type string, book_title string")
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("c", [0.0, 1.0]), ("d", [0.0, 1.0]), ("x", [1.0, 1.0]), ("a", [0.0])], "chunk_id string, embedding array<float>")
    rows = S.hybrid(chunks, vectors, "reciprocal", [0.0, 1.0], 2, {"board": "State", "chapter_title": None}).collect()
    assert [(r.chunk_id, round(r.final_score, 4)) for r in rows] == [("c", round(0.7 + 0.2 * 0.2 + 0.1 * 0.15, 4)), ("a", 0.015)]
    assert S.keyword_top(chunks, "-x", 5, {"content": "C"}).count() == 0 and S.keyword_top(chunks, "Integers", 5, {"chapter_title": "A", "content": "C"}).first().keyword_score == pytest.approx(1.2)


def test_embedding(spark):
    calls = []

    class Flaky(E.HashEmbedder):
        def __call__(self, texts):
            calls.append(len(texts))
            if len(calls) == 1:
                raise ConnectionError
            return super().__call__(texts)

    assert E.retried(Flaky(4), ["a"], wait=0.0) == E.HashEmbedder(4)(["a"])
    df = spark.createDataFrame([("a", "red fox"), ("b", "red fox"), ("c", " "), ("d", None)], "id string, t string")
    rows = {r.id: r for r in E.embed(df, "id", "t", E.HashEmbedder(8)).collect()}
    assert set(rows) == {"a", "b"} and rows["a"].embedding == rows["b"].embedding and rows["a"].embedding_dimensions == 8
    assert E.fitted("a b c", 2) == ("a b", 2, True) and E.fitted("a b", 2) == ("a b", 2, False)
    with pytest.raises(ValueError):
        E.embed_query(" ", E.HashEmbedder())


def test_tables(spark):
    old = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (None, "n", 0)], "id int, v string, made int")
    new = spark.createDataFrame([(2, "B", 99), (3, "C", 30), (None, "N", 1)], "id int, v string, made int")
    assert sorted(map(tuple, tables.upsert(old, new, ["id"], keep=["made"]).collect()), key=str) == sorted([(1, "a", 10), (2, "B", 20), (3, "C", 30), (None, "n", 0), (None, "N", 1)], key=str)
    assert tables.upsert(old, new.limit(0), ["id"]).count() == 3 and tables.upsert(old.limit(0), new, ["id"]).count() == 3
    df = spark.createDataFrame([("", " x "), (None, None)], "a string, b string")
    assert [r.a for r in tables.backfill(df, "a", "b").collect()] == ["x", None]


def test_files(spark, tmp_path):
    d = tmp_path / "Old_Mill" / "Class_4"
    d.mkdir(parents=True)
    (d / "Science_The Book.PDF").write_bytes(b"one\fpage two")
    (d / "Maths_Bad.pdf").write_bytes(b"\x00")

    def read(content):
        if content == b"\x00":
            raise ValueError("broken")
        yield from content.decode().split("\f")

    found = files.scan(spark, str(tmp_path))
    assert {(r.school_name, r.class_name, r.subject, r.book_title) for r in found.collect()} == {("Old Mill", "Class 4", "Science", "The Book"), ("Old Mill", "Class 4", "Maths", "Bad")}
    rows = files.page_texts(found, [("missing", files.reader_of("no_such_module")), ("plain", read)]).collect()
    assert sorted((r.page_number, r.raw_text) for r in rows) == [(0, None), (1, "one"), (2, "page two")] and any("broken" in (r.error or "") for r in rows)


def test_stream(spark, tmp_path):
    schema = "raw_id bigint, file_name string, payload string, received_at timestamp"
    book = json.dumps({"chapters": [{"chapter_title": "A"}]})
    for i in range(2):
        spark.createDataFrame([(i, "f", book, None)], schema).write.mode("append").parquet(str(tmp_path / "in"))
        stream.ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).where(F.col("tag") == "chapters").count() == 2
