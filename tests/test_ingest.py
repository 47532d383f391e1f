"""Ingest of JSON and other files, the store, lookups, checks, export and the command line."""

import json
import os
import subprocess
import sys
import urllib.parse

import pytest
from pyspark.sql import functions as F

from foliant import cli, ingest
from foliant.operators import embedding as E
from foliant.operators import export, lookup, search, validate_json
from foliant.sources import files
from foliant.store import SCHEMAS, Store


def book(key="seeds-6", title="Seeds", extra=""):
    para = lambda w: " ".join(f"The {w} of the garden number {i} is told here at length." for i in range(30))
    pages = [{"page_number": n, "text": para(w) + extra} for n, w in enumerate(["cover", "seed", "root", "leaf", "fruit", "flower"], 1)]
    sections = [
        {"chapter_number": "1", "chapter_title": "Seeds and Roots", "start_page": 2, "end_page": 3, "page_numbers": [2, 3], "lesson_text": "x", "subsections": [{"subsection_number": "1.1", "subsection_title": "Seeds", "start_page": 2, "end_page": 2, "page_numbers": [2], "subsection_text": para("seed")}, {"subsection_number": "1.2", "subsection_title": "Roots", "start_page": 3, "end_page": 3, "page_numbers": [3], "subsection_text": para("root")}]},
        {"chapter_number": "2", "chapter_title": "Leaves", "start_page": 4, "end_page": 6, "page_numbers": [4, 5, 6], "lesson_text": "x"},
    ]
    return {"metadata": {"document_key": key, "book_title": title, "school_name": "Hill School", "grade": "6", "subject": "Science", "language": "English"}, "extraction": {"total_pdf_pages": 6, "content_start_page": 2, "content_end_page": 6, "section_index": sections, "page_extractions": pages}}


@pytest.fixture
def source(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps(book()))
    (folder / "b.json").write_text(json.dumps(book("stones-7", "Stones")))
    (folder / "broken.json").write_text('{"metadata": {')
    (folder / "empty.json").write_text(json.dumps({"metadata": {"document_key": "nothing"}}))
    return str(folder)


def test_ingest_json_end_to_end(spark, source, tmp_path):
    store = Store(spark, str(tmp_path / "tables"))
    embedder = E.HashEmbedder(16)
    dry = {r.status for r in ingest.ingest_json(store, source, embedder, ingest.Options(dry_run=True)).collect()}
    assert dry == {"dry_run_ok", "failed"} and not store.exists("pages")
    report = {os.path.basename(r.file_name): r for r in ingest.ingest_json(store, source, embedder, ingest.Options({"board": "State"}, export_to=str(tmp_path / "out"))).collect()}
    a = report["a.json"]
    assert (a.status, a.pages, a.structures, a.subsections) == ("completed", 6, 2, 2) and a.chunks >= 2 and a.vectors == a.chunks + 2
    assert report["broken.json"].status == report["empty.json"].status == "failed" and "text" in report["empty.json"].reason
    rows = {n: store.read(n).count() for n in SCHEMAS}
    assert rows["documents"] == 2 and rows["pages"] == rows["raw_text_pages"] == 12 and rows["chunks"] == rows["vectors"] == 2 * a.chunks and rows["subsection_vectors"] == 4 and rows["book_chapters"] == 4
    assert {r.status for r in store.read("ingestion_runs").collect()} == {"completed", "failed"}
    assert {r.board for r in store.read("documents").collect()} == {"State"}

    again = {os.path.basename(r.file_name): r.status for r in ingest.ingest_json(store, source, embedder).collect()}
    assert again["a.json"] == again["b.json"] == "skipped_existing"
    assert {n: store.read(n).count() for n in SCHEMAS if n != "ingestion_runs"} == {n: c for n, c in rows.items() if n != "ingestion_runs"}

    created = {r.id: r.created_at for r in store.read("documents").collect()}
    with open(f"{source}/a.json", "w") as f:
        f.write(json.dumps(book(extra=" It is new.")))
    ingest.ingest_json(store, f"{source}/a.json", embedder, ingest.Options(reindex=True))
    assert {n: store.read(n).count() for n in SCHEMAS if n != "ingestion_runs"} == {n: c for n, c in rows.items() if n != "ingestion_runs"}
    assert store.read("pages").where("raw_text like '%It is new.%'").count() == 6 and {r.id: r.created_at for r in store.read("documents").collect()} == created
    before = sorted(map(str, store.read("chunks").drop("created_at").collect()))
    for n in SCHEMAS:
        store.compact(n)
    assert sorted(map(str, store.read("chunks").drop("created_at").collect())) == before

    class Failing(E.HashEmbedder):
        def __call__(self, texts):
            raise RuntimeError("no embedder")

    with pytest.raises(Exception, match="no embedder"):
        ingest.ingest_json(store, f"{source}/b.json", Failing(16), ingest.Options(reindex=True))
    assert store.read("pages").count() == 12 and store.read("chunks").count() == rows["chunks"]
    assert store.read("ingestion_runs").where("status = 'failed' and error_message like '%no embedder%'").count() == 1

    one = store.read("documents").where("document_key = 'stones-7'").select("id")
    store.delete(one, "gone")
    assert store.read("documents").count() == 1 and store.read("vectors").count() == a.chunks and store.read("ingestion_runs").count() > 4

    out = [json.loads(x) for f in os.listdir(tmp_path / "out") if "=" in f for p in os.listdir(tmp_path / "out" / f) if p.endswith(".txt") for x in open(tmp_path / "out" / f / p)]
    kinds = {k: [x for x in out if x["kind"] == k] for k in ("book", "unit", "lesson", "page", "subsection")}
    assert len(kinds["book"]) == 2 and len(kinds["unit"]) == 4 and len(kinds["page"]) == 12 and len(kinds["subsection"]) == 4 and kinds["lesson"]
    assert {x["value"]["lesson_title"] for x in kinds["lesson"]} <= {"Seeds and Roots", "Leaves"}


def test_options():
    with pytest.raises(ValueError):
        ingest.Options({"colour": "red"})
    with pytest.raises(ValueError):
        ingest.Options({"language": "Klingon"})


def feeds():
    """A reader of pages between form feeds; made here, so that it travels to the workers by itself."""

    def read(content):
        text = content.decode()
        if "unreadable" in text:
            raise OSError("cannot read")
        yield from text.split("\f")

    return read


def test_pages_of_a_library(monkeypatch):
    import types

    class Page:
        def __init__(self, text, blocks):
            self.held = {"text": text, "blocks": blocks}

        def get_text(self, kind, sort=False):
            return self.held[kind]

    class Doc(list):
        __enter__ = lambda self: self
        __exit__ = lambda self, *_: None

    lib = types.ModuleType("fitz")
    lib.open = lambda stream, filetype: Doc([Page("a page", []), Page(" ", [(0, 9, 0, 0, "below"), (0, 1, 0, 0, "above")])])
    monkeypatch.setitem(sys.modules, "fitz", lib)
    assert list(files.reader_of("fitz")(b"")) == ["a page", "above\nbelow"]


def test_ingest_files(spark, tmp_path):
    folder = tmp_path / "Hill School" / "Class 6"
    folder.mkdir(parents=True)
    body = lambda w: " ".join(f"The {w} of the land number {i} is told here." for i in range(40))
    contents = "Contents\n1. Integers 1\n2. Fractions 3\n3. Decimals 5"
    (folder / "Maths_Numbers.txt").write_text("\f".join([contents, "Integers\n" + body("integer"), body("whole"), "Fractions\n" + body("fraction"), body("half"), "Decimals\n" + body("decimal")]))
    (folder / "Maths_Bad.txt").write_text("unreadable")
    store = Store(spark, str(tmp_path / "tables"))
    got = {os.path.basename(urllib.parse.unquote(r.file_name)): r for r in ingest.ingest_files(store, str(tmp_path / "Hill School"), [("feeds", feeds())], E.HashEmbedder(16), glob="*.txt").collect()}
    good = got["Maths_Numbers.txt"]
    assert (good.status, good.pages, good.structures) == ("completed", 6, 3) and got["Maths_Bad.txt"].status == "failed" and "cannot read" in got["Maths_Bad.txt"].reason
    starts = {r.chapter_title: (r.pdf_start_page, r.pdf_end_page) for r in store.read("book_chapters").collect()}
    assert starts == {"Integers": (2, 3), "Fractions": (4, 5), "Decimals": (6, 6)}
    d = store.read("documents").first()
    assert (d.subject, d.book_title, d.class_name, d.grade) == ("Maths", "Numbers", "Class 6", "Class 6")


def test_pages_are_read_again_by_ocr_where_that_is_better(spark):
    good = "The garden of the weavers lies beyond the river, and " * 4
    texts = ["", "plain text that needs nothing done " * 5, "bad \x85\x86 text", "bad \x85 but the other is worse " * 4]
    rows = spark.createDataFrame([("p", "\f".join(texts).encode())], "path string, content binary")
    got = files.page_texts(rows, [("feeds", feeds())], lambda content, n: {1: good, 2: good, 3: good, 4: "short"}[n]).orderBy("page_number").collect()
    assert [r.extraction_method for r in got] == ["ocr", "feeds", "ocr", "feeds"] and got[3].raw_text == texts[3]


def test_lookups(spark):
    books = spark.createDataFrame([("d", "key-d", "Seeds", "Hill", "6", "Science", "6"), ("e", "key-e", "Stones", None, None, None, None)], "id string, document_key string, book_title string, school_name string, class_name string, subject string, grade string")
    pages = spark.createDataFrame([(f"{d}{n}", d, n, f" {d} page {n} \n") for d in "de" for n in range(1, 6)] + [("d6", "d", 6, None)], "id string, document_id string, page_number int, raw_text string")
    records = spark.createDataFrame([("r1", "d", "1", "The Seeds", 2, 3, 1), ("r2", "d", "12", "Roots", 4, None, 3), ("r3", "e", "1", "The Stones", 1, 9, None)], "id string, document_id string, chapter_number string, chapter_title string, pdf_start_page int, pdf_end_page int, printed_start_page int").selectExpr("*", *[f"cast(null as string) as {c}" for c in ("unit_number", "unit_title", "section_number", "section_title", "lesson_title")])
    chunks = spark.createDataFrame([("c1", "d", 0, 1, 1, "Front")], "id string, document_id string, chunk_index int, page_start int, page_end int, chapter_title string")
    raw = lookup.raw_text_pages(pages, records, chunks)
    at = {r.id: (r.chapter_title, r.printed_page_number, r.found_in) for r in raw.collect()}
    assert len(at) == 11 and at["d1"] == ("Front", None, "chunk") and at["d3"] == ("The Seeds", 2, "record") and at["d6"] == ("Roots", 5, "record") and at["e5"][0] == "The Stones"
    row = lookup.chapter_text(raw, books, document_key="key-d", chapter_title="seeds").first()
    assert (row.page_count, row.pdf_pages, row.printed_pages, row.text) == (2, [2, 3], [1, 2], "d page 2\n\nd page 3")
    assert lookup.chapter_text(raw, books, "d", chapter_number="12").first().text == "d page 4\n\nd page 5"
    assert lookup.chapter_text(raw, books, "d", chapter_number="2").count() == 0 and lookup.chapter_text(raw, books, "d", "key-e").count() == 0
    for call in (lambda: lookup.chapter_text(raw, books), lambda: lookup.chapter_text(raw, books, "d", colour="red")):
        with pytest.raises(ValueError):
            call()
    subs = spark.createDataFrame([("s2", "d", "1", "b", 3, 3), ("s1", "d", "1", "a", 2, 2), ("s3", "d", None, "c", None, None), ("s4", "e", "1", "a", 1, None)], "id string, document_id string, section_number string, subsection_title string, pdf_start_page int, pdf_end_page int").withColumn("chapter_number", F.lit("1"))
    listed = lookup.list_subsections(subs, books, "d")
    assert [r.id for r in listed.collect()] == ["s1", "s2", "s3"] and len(listed.columns) == 4 + len(lookup.LISTED)
    texts = {r.id: r.subsection_text for r in lookup.subsection_text(subs, pages, books, every=True).collect()}
    assert texts == {"s1": " d page 2 \n", "s2": " d page 3 \n", "s3": None, "s4": " e page 1 \n"}
    assert lookup.subsection_text(subs.withColumn("subsection_text", F.lit("own")), pages, books, "d", subsection_title="A").first().subsection_text == "own"


def test_embedding_keeps_every_row(spark):
    df = spark.createDataFrame([("a", "one"), ("a", "two"), (None, "three"), ("b", " "), ("c", None)], "id string, t string")
    rows = E.embed(df, "id", "t", E.HashEmbedder(8)).collect()
    assert sorted((r.id or "", r.token_count) for r in rows) == [("", 1), ("a", 1), ("a", 1)] and len({r.embedding_input_hash for r in rows}) == 3
    long = spark.createDataFrame([("x", "word " * 9000)], "id string, t string")
    assert E.embed(long, "id", "t", E.HashEmbedder(8), "cut").first().text_was_truncated
    with pytest.raises(Exception, match="more than"):
        E.embed(long, "id", "t", E.HashEmbedder(8)).collect()
    vectors = spark.createDataFrame([("other", 8)], "embedding_model string, embedding_dimensions int")
    with pytest.raises(ValueError):
        E.of_model(vectors, E.HashEmbedder(8))
    assert E.of_model(vectors.limit(0), E.HashEmbedder(8)).count() == 0


def test_vector_search_takes_the_newest(spark):
    chunks = spark.createDataFrame([("a",), ("b",)], "id string")
    vectors = spark.createDataFrame([("a", [1.0, 0.0], 1), ("a", [0.0, 1.0], 2), ("b", [0.6, 0.8], 1), ("b", [1.0], 9)], "chunk_id string, embedding array<float>, created_at int")
    assert [(r.chunk_id, round(r.vector_score, 3)) for r in search.vector_top(chunks, vectors, [1.0, 0.0], 5).collect()] == [("b", 0.6), ("a", 0.0)]


def test_book_files_are_checked(spark):
    assert list(validate_json.problems(json.dumps(book()))) == [("page_without_production_text", str(n), "") for n in range(1, 7)]
    bad = book()
    s = bad["extraction"]["section_index"]
    s[0]["end_page"], s[1]["chapter_number"], s[1]["start_page"] = 4, "1", 9
    s[0]["subsections"][1] |= {"subsection_number": "1.1", "start_page": 2, "page_numbers": [], "subsection_text": " "}
    bad["extraction"]["page_extractions"][3]["text"] = ""
    bad["extraction"]["total_pdf_pages"] = 7
    del bad["metadata"]["document_key"]
    found = list(validate_json.problems(json.dumps(bad)))
    rules = {r for r, _, _ in found}
    assert rules >= {"no_document_key", "section_twice", "section_range", "subsection_twice", "subsection_without_pages", "subsection_without_text", "subsection_gap", "subsection_overlap", "content_page_without_text", "pages_counted", "pages_range"}
    assert ("subsection_gap", "1", "end 4-4") in found and ("subsection_overlap", "1", "1.1/1.1 2-2") in found
    units = book()
    units["extraction"]["section_index"][0] |= {"page_count": 5}
    units["extraction"]["section_index"][0]["subsections"][0] |= {"anchor_pdf_page": 9, "include_in_embeddings": False}
    rules = {r for r, _, _ in validate_json.problems(json.dumps(units), "sections", {"sections": 2, "subsections": 3})}
    assert rules >= {"section_page_count", "subsection_anchor_outside", "subsection_not_ready", "subsections_expected"} and "sections_expected" not in rules
    df = spark.createDataFrame([(1, json.dumps(book()), 0), (2, "{", 0), (3, None, 0), (3, None, 0)], "k bigint, p string, rule int")
    got = validate_json.violations(df, "k", "p").where("severity = 'error'").collect()
    assert sorted((r.k, r.rule) for r in got) == [(2, "not_json"), (3, "not_json"), (3, "not_json")]
    with pytest.raises(ValueError):
        validate_json.violations(df, "k", "p", "poems")


def test_command_line(spark, source, tmp_path, capsys):
    t = str(tmp_path / "tables")

    def run(*args):
        code = cli.main([t, "--dimensions", "16", *args])
        return code, [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]

    assert run("init-db")[0] == 0 and run("search", "garden") == (0, [])
    code, rows = run("ingest-json", source)
    assert code == 1 and sorted(r["status"] for r in rows) == ["completed", "completed", "failed", "failed"]
    assert run("ingest-json", f"{source}/a.json")[0] == 0
    code, rows = run("search", "root garden", "--book-title", "Seeds", "--top-k", "2")
    assert code == 0 and len(rows) == 2 and "Seeds" in rows[0]["citation"]
    code, rows = run("chapter-text", "--document-key", "seeds-6", "--chapter-title", "leaves")
    assert rows[0]["page_count"] == 3 and "leaf of the garden" in rows[0]["text"]
    assert [r["subsection_title"] for r in run("list-subsections", "--document-key", "seeds-6")[1]] == ["Seeds", "Roots"]
    code, rows = run("subsection-text", "--document-key", "seeds-6", "--subsection-number", "1.2")
    assert len(rows) == 1 and "root of the garden" in rows[0]["subsection_text"]
    assert run("chapter-text")[0] == 2 and run("ingest-json", str(tmp_path / "none"))[0] == 2 and run("summary", "--document-key", "zzz")[0] == 1
    assert run("summary", "--document-key", "seeds-6")[1][0]["n_pages"] == 6
    assert run("validate-json", source)[0] == 1 and run("validate-json", f"{source}/a.json", "--expect", "subsections=2")[0] == 0
    (tmp_path / "notes.txt").write_text("x")
    assert run("ingest", str(tmp_path / "notes.txt"))[0] == 2 and run("ingest", str(tmp_path), "--glob", "*.txt", "--validate-only")[1][0]["path"].endswith("notes.txt")
    assert run("validate")[0] in (0, 1) and run("export", str(tmp_path / "exported"))[0] == 0
    with pytest.raises(SystemExit) as e:
        cli.main([t, "fly"])
    assert e.value.code == 2


def test_command_line_from_another_folder(source, tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = os.environ | {"PYTHONPATH": root + os.pathsep + os.environ.get("PYTHONPATH", "")}
    done = subprocess.run([sys.executable, "-m", "foliant.cli", str(tmp_path / "t"), "ingest-json", f"{source}/a.json"], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0 and '"status":"completed"' in done.stdout, done.stderr[-2000:]
