import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foliant.operators import nested as N
from foliant.sources import json_books as J

VALUES = st.recursive(
    st.none() | st.booleans() | st.integers(-9, 9) | st.sampled_from(["", " ", "title", "{", "[1", '"x"', "true"]),
    lambda x: st.lists(x, max_size=3) | st.dictionaries(st.sampled_from(["subsection_title", "subsectionTitle", "Sub-Section Title 2", "chapters", "content", "a.b"]), x, max_size=3) | st.dictionaries(st.sampled_from(["lessons", "x"]), x.map(json.dumps), max_size=2),
    max_leaves=12,
)


def brute(value, path="$", parent="$"):
    """Recursively, (parent_path, node_path) of the objects with a subsection title."""
    if isinstance(value, str):
        t = value.strip()
        try:
            inner = json.loads(t) if t[:1] in ("{", "[", '"') else None
        except ValueError:
            inner = None
        return brute(inner, path, parent) if isinstance(inner, dict | list) or isinstance(inner, str) and inner != value else []
    if isinstance(value, list):
        return [x for i, v in enumerate(value) for x in brute(v, f"{path}[{i}]", parent)]
    if isinstance(value, dict):
        titled = any("".join(c for c in k if c.isalpha()).lower() == "subsectiontitle" and isinstance(v, str) and v.strip() for k, v in value.items())
        return [(parent, path)] * titled + [x for k, v in value.items() for x in brute(v, f"{path}.{k}", path)]
    return []


@settings(max_examples=400, deadline=None)
@given(VALUES)
def test_titled_objects(value):
    found = [(r[2] or "$", r[1]) for r in N.visit(json.dumps(value)) if r[6] is not None]
    assert sorted(found) == sorted(brute(value))


@settings(max_examples=300, deadline=None)
@given(VALUES, st.integers(0, 30))
def test_deep_parser_reads_the_same(value, cut):
    text = json.dumps(value)
    for t in (text, text[: max(1, len(text) - cut)]):
        try:
            want = json.loads(t)
        except ValueError:
            with pytest.raises(ValueError):
                N._parse_deep(t)
        else:
            assert N._parse_deep(t) == want


def test_nothing_is_lost():
    """Every scalar of a payload is in the payload of one node."""
    value = {"a": 1, "b": {"c": [1, 2, {"d": 3}], "e": "x"}, "f": [[{"g": 4}], [5]], "h": '[{"i": 6}]'}
    rows = list(N.visit(json.dumps(value)))
    assert [r[1] for r in rows] == ["$", "$.b", "$.b.c[2]", "$.f[0][0]", "$.h[0]"]
    assert [r[2] for r in rows] == [None, "$", "$.b", "$", "$"]


def test_very_deep():
    deep = '{"lessons":[' * 5000 + '{"subsectionTitle":"t"}' + "]}" * 5000
    assert sum(r[6] is not None for r in N.visit(deep)) == 1


def test_table(spark, tmp_path):
    good = json.dumps({"extraction": {"chapters": [{"chapter_title": "C", "lessons": {"section_title": "S", "subsections": json.dumps([{"subsection_title": "T"}, {"subsectionTitle": " "}])}}]}})
    rows = [(1, good), (1, good), (2, None), (3, ""), (4, good[:-3]), (5, json.dumps(good)), (6, "[]"), (7, "12"), (None, good), (8, "﻿{}")]
    df = spark.createDataFrame(rows, "raw_id bigint, payload string").withColumn("raw_key", F.lit(1)).withColumn("tag", F.lit(1))
    path = "$.extraction.chapters[0].lessons"
    found = sorted((r.raw_id or 0, r.parent_path, r.node_path) for r in N.titled_subsections(df).collect())
    assert found == [(k, path, f"{path}.subsections[0]") for k in (0, 1, 1, 5)]
    nodes = N.flatten(df, "raw_id", "payload")
    assert nodes.where("tag = 'rejected'").count() == 4
    N.write_tables(nodes, str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    subs = N.flat_table(back, "subsections", {"title": ("string", ["subsectiontitle"]), "page": ("int", ["startpage"])})
    assert {r.title for r in subs.collect()} == {"T", " "} and back.where("tag = 'chapters'").count() == 4
    assert N.titled_subsections(df.limit(0)).count() == 0


BOOK = {
    "documentKey": "My Key!",
    "metadata": {"school": "Old Mill", "standard": "Class 4", "subjectName": "Science", "bookTitle": "A"},
    "extraction": {
        "book_title": "B",
        "section_index": [
            {"chapter_number": "1", "chapter_title": "Seeds", "section_title": "Roots", "start_page": " १२ ", "end_page": 14, "subsections": [{"subsection_title": "Hairs", "start_page": 12, "subsection_text": "short"}, {"subsection_title": "Hairs", "start_page": 12, "subsection_text": "much longer"}]},
            {"section_title": "Stems", "start_page": "x", "production_lesson_text": "One. Two. Three."},
        ],
        "chapters": [{"chapter_title": "Ignored"}],
    },
}


def test_book(spark):
    t = J.load(spark.createDataFrame([(1, json.dumps(BOOK)), (2, "{")], "raw_id bigint, payload string"))
    m = t["metadata"].first()
    assert (m.document_key, m.school_name, m.class_name, m.subject, m.book_title, m.key_was_derived) == ("my-key", "Old Mill", "Class 4", "Science", "B", False)
    s = {r.section_title: r for r in t["structure"].collect()}
    assert set(s) == {"Roots", "Stems"} and (s["Roots"].start_page, s["Roots"].end_page, s["Stems"].start_page) == (12, 14, None)
    sub = t["subsections"].collect()
    assert len(sub) == 1 and sub[0].text == "much longer" and (sub[0].chapter_title, sub[0].section_title) == ("Seeds", "Roots")
    assert {r.page_number: r.text for r in t["pages"].collect()} == {1: "One. Two. Three.", 12: "much longer"} or t["pages"].count() >= 2
    assert [r.raw_key for r in t["rejected"].collect()] == ["2"]


@pytest.mark.parametrize("text, pages, want", [("a\n\nb\n\nc", 3, ["a", "b", "c"]), ("One. Two. Three. Four.", 2, ["One.\nTwo.", "Three.\nFour."]), ("abcdef", 3, ["ab", "cd", "ef"]), ("abc", 1, ["abc"])])
def test_spread(spark, text, pages, want):
    df = spark.createDataFrame([(1, text, 5, 4 + pages)], "k int, t string, a int, b int")
    got = J.spread_text(df, ["k"], "t", "a", "b").orderBy("page_number").collect()
    assert [r.text for r in got] == want and [r.page_number for r in got] == list(range(5, 5 + len(want)))


def test_payloads_of_any_depth_are_kept():
    deep = "[" * 60_000 + "1" + "]" * 60_000
    rows = list(N.visit('{"a": 1, "list": %s, "subsection_title": "x"}' % deep))
    assert len(rows) == 1 and rows[0][5] == '{"a": 1, "list": %s, "subsection_title": "x"}' % deep
    assert N._dump_deep({"a": [1, {"b": []}], "c": {}, "d": "é"}) == json.dumps({"a": [1, {"b": []}], "c": {}, "d": "é"}, ensure_ascii=False)


def test_equal_names_and_mixed_lists_lose_nothing():
    text = '{"chapters": {"subsection_title": "a"}, "chapters": {"subsection_title": "b"}, "x": 1, "x": 2, "tags": ["t", {"tag": "u"}, 3]}'
    rows = list(N.visit(text))
    assert [r[6] for r in rows if r[6]] == ["a", "b"] and [r[1] for r in rows] == ["$", "$.chapters", "$.chapters", "$.tags[1]"]
    assert rows[0][5] == '{"x": 1, "x": 2, "tags": ["t", 3]}'


def test_tables_of_all_tags(spark, tmp_path):
    payload = json.dumps({"metadata": {"board": "State", "editions": [{"year": 2020}], "contributors": [{"role": "author", "name": "N"}]}, "chapters": [{"chapterNumber": "1", "Chapter Title": "T", "chapter_title": "again", "start_page": "4", "sections": [{"sectionTitle": "S", "tags": [{"tag": "x", "weight": 0.5}]}]}]})
    N.write_tables(N.flatten(spark.createDataFrame([(1, payload), (2, "{")], "raw_id bigint, payload string"), "raw_id", "payload"), str(tmp_path / "t"))
    got = {tag: [r.asDict() for r in df.collect()] for tag, df in N.read_tables(spark, str(tmp_path / "t")).items()}
    assert got["metadata"][0]["board"] == "State" and got["editions"][0]["year"] == 2020 and got["contributors"][0]["name"] == "N" and got["tags"][0]["weight"] == 0.5
    assert (got["chapters"][0]["chapter_title"], got["chapters"][0]["start_page"]) == ("T", 4) and got["sections"][0]["parent_path"] == "$.chapters[0]" and got["units"] == []
    assert set(got) == set(N.SCHEMAS)
