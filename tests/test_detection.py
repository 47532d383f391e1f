import json

import pytest
from pyspark.sql import functions as F

from foliant import config
from foliant.functions import text as X
from foliant.operators import detection as D
from foliant.sources import files


@pytest.mark.parametrize("answer", ['{"a": 1}', '```json\n{"a": 1}\n```', 'Here it is: {"a": 1} as asked.'])
def test_recovered(answer):
    assert D.recovered(answer) == {"a": 1}


@pytest.mark.parametrize("answer", ["", "[1]", "no object", "{broken"])
def test_nothing_to_recover(answer):
    with pytest.raises(ValueError):
        D.recovered(answer)


def test_records_of():
    data = {"confidence": 0.5, "chapters": [{"number": "2", "title": "2. Integers 14", "printed_start_page": "14"}, {"title": " "}, "x"], "sections": [{"unit_number": 1, "section_title": "A Bottle of Dew", "confidence": 0.9}]}
    a, b = D.records_of(data)
    assert (a["chapter_number"], a["chapter_title"], a["printed_start_page"], a["confidence"]) == ("2", "Integers", 14, 0.5)
    assert (b["unit_number"], b["section_number"], b["section_title"], b["structure_type"], b["chapter_title"]) == ("1", "1", "A Bottle of Dew", "section", None)
    assert D.records_of({}) == [] and D.records_of({"chapters": None}) == []


TITLES = ["Integers", "Fractions", "Decimals", "Exponents", "Geometry", "Symmetry", "Perimeter", "Area", "Ratio"]


def tables(spark):
    toc = "Contents\n" + "\n".join(f"{i}. {t} {i * 10}" for i, t in enumerate(TITLES, 1))
    units = "Contents\nUnit 1: Fables\nThe Raven and Fox 1\nThe Bottle of Dew 13\nUnit 2: Friends\nThe Little Bharat 31"
    rows = [("toc", 2, toc), ("units", 1, units), ("bare", 1, "Nothing here."), ("bad", 1, "Nothing here.")] + [("toc", n, "text") for n in range(3, 30)]
    pages = spark.createDataFrame(rows, "document_id string, page_number int, raw_text string")
    return pages, spark.createDataFrame([(d, d) for d in ("toc", "units", "bare", "bad")], "id string, book_title string")


def model(answers):
    def ask(prompt):
        seen = json.loads(prompt)
        assert "known" in seen and seen["pages"]
        return answers[seen["known"]["book_title"]]

    return ask


def test_detection_chain(spark):
    pages, books = tables(spark)
    alone = D.detect_structure(pages, books).groupBy("document_id").count().collect()
    assert {r.document_id: r["count"] for r in alone} == {"toc": 9, "units": 3}
    many = json.dumps({"chapters": [{"title": f"Example number {chr(65 + i)} of this"} for i in range(26)]})
    answers = {"toc": many, "units": "must not be asked", "bare": '{"chapters": [{"title": "Integers and more"}]}', "bad": "I cannot."}
    got = D.detect_structure(pages, books, model(answers)).collect()
    by = {d: sorted((r.chapter_title or r.section_title, r.detected_by) for r in got if r.document_id == d) for d in ("toc", "units", "bare", "bad")}
    assert [t for t, _ in by["toc"]] == sorted(TITLES) and {b for _, b in by["units"]} == {"toc_units"} and by["bare"] == [("Integers and more", "model")] and by["bad"] == []
    same = json.dumps({"chapters": [{"title": t} for t in TITLES[:8]]})
    got = D.detect_structure(pages, books, model(answers | {"toc": same})).where("document_id = 'toc'").collect()
    assert sorted(r.detected_by == "model" for r in got) == [False] + [True] * 8 and len({r.id for r in got}) == 9


def test_sampled_pages(spark):
    rows = [("d", n, "Contents" if n == 30 else None if n == 5 else "text") for n in range(1, 120)]
    got = [r.page_number for r in D.sampled_pages(spark.createDataFrame(rows, "document_id string, page_number int, raw_text string")).orderBy("page_number").collect()]
    assert got == [*range(1, 21), 30, 31, 32, 33, 40, 60, 100]


def test_settings():
    s = config.Settings.load({"FOLIANT_EMBEDDING_DIMENSIONS": "16", "FOLIANT_EXPORT_JSON": "Yes", "FOLIANT_LOG_LEVEL": " "})
    assert (s.embedding_dimensions, s.export_json, s.log_level) == (16, True, "INFO")
    s.check_embedder("hash", 16)
    for wrong in (lambda: s.check_embedder("hash", 17), lambda: config.Settings.load({"FOLIANT_CHUNK_MAX_TOKENS": "many"})):
        with pytest.raises(ValueError):
            wrong()


def test_quality_report(spark):
    rows = [("empty", ""), ("empty", " "), ("empty", "word " * 60), ("short", "few"), ("bad", "word " * 60 + "\x85"), ("stray", "word " * 60 + "कख"), ("stray", "word " * 60 + "गघ"), ("good", "word " * 60), ("hindi", "word " * 60 + "कख"), ("hindi", "word " * 60 + "कख")]
    df = spark.createDataFrame(rows, "document_id string, raw_text string")
    got = {r.document_id: (r.should_ocr, r.reason) for r in files.quality_report(df, F.col("document_id") == "hindi").collect()}
    assert {d for d, (o, _) in got.items() if o} == {"empty", "short", "bad", "stray"} and "usable" in got["good"][1] and "stray" in got["stray"][1] and "control" in got["bad"][1] and "2 of 3" in got["empty"][1]


def test_lists_and_terms(spark):
    df = spark.createDataFrame([('["a", " ", "3"]',), ("४",), (None,), (" ",)], "v string")
    assert [(r.t, r.i) for r in df.select(X.text_list(F.col("v")).alias("t"), X.int_list(F.col("v")).alias("i")).collect()] == [(["a", "3"], [3]), (["४"], [4]), ([], []), ([], [])]
    row = spark.createDataFrame([(["b", "A", " a ", "", "B", "c"],)], "v array<string>").select(X.merged_terms(F.col("v")).alias("t"), X.chunk_title([F.lit(None), F.lit("")], F.lit("worked_example"), F.lit(3)).alias("c"), X.safe_float(F.lit(" ३.५ ")).alias("f")).first()
    assert (row.t, row.c, row.f) == (["b", "A", "c"], "Worked Example 3", 3.5)


def test_written_tables_go(spark):
    import os

    from foliant.session import cut, written

    kept = cut(spark.range(3))
    with written():
        inner = cut(spark.range(5))
        path = inner.inputFiles()[0].removeprefix("file://")
        assert inner.count() == 5 and os.path.exists(path)
    assert not os.path.exists(path) and kept.count() == 3


def test_stored_lexemes_give_the_same(spark):
    from foliant.operators import search

    chunks = spark.createDataFrame([("a", "The garden", "a needle in the garden"), ("b", None, "needles"), ("c", "Needle", None), ("d", "x", "")], "id string, chapter_title string, content string")
    fields = {"chapter_title": "A", "content": "C"}
    for q in ("needle", '"the garden" needle', "needle -garden", "garden or x", "zzz"):
        plain = [tuple(r) for r in search.keyword_top(chunks, q, 9, fields).collect()]
        assert [tuple(r) for r in search.keyword_top(search.lexeme_table(chunks, fields), q, 9, fields).collect()] == plain


def test_keywords_in_the_attributes_of_the_book(spark):
    from foliant.operators import search

    chunks = spark.createDataFrame([("a", "Needles", "thread and needles", "Hill School", "State"), ("b", "Roots", "of a tree", "Hill School", "State"), ("c", "Roots", "of a hill", "Lake", None)], "id string, chapter_title string, content string, school_name string, board string")
    run = lambda q, attrs: {r.chunk_id: r.keyword_score for r in search.keyword_top(chunks, q, 9, search.fields_of(chunks.columns), None, attrs).collect()}
    assert run("hill", None) == {"c": pytest.approx(0.2)}
    assert run("hill", ["school_name", "board"]) == {"a": 0.0, "b": 0.0, "c": pytest.approx(0.2)}
    assert run('"hill school" -lake', ["school_name", "board"]) == {"a": 0.0, "b": 0.0} and run("needles", ["school_name"]) == {"a": pytest.approx(1.2 / 2, abs=0.7)}
    assert search.fields_of(["topic", "content", "x"]) == {"topic": "B", "content": "C"}
