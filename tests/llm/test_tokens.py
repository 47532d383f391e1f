import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foliant.llm import queries, split, tokens


def reference(text: str) -> int:
    return len(split.encoding(tokens.VOCABULARY).encode_ordinary(text))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abcdeth  ing’'—\n\r\t01239कखगाि्ंéß\U0001f600")), max_size=300))
def test_counts_are_the_tokenizers(text):
    assert tokens.PieceCounter(tokens.VOCABULARY)(text) == reference(text)


@pytest.mark.parametrize("text", ["", "a" * 50_000, "क" * 20_000, " " * 9000, "the cat", "x\ud800y"])
def test_long_and_odd(text):
    assert tokens.counter(tokens.VOCABULARY)(text) >= (text != "")
    if "\ud800" not in text:
        assert tokens.counter(tokens.VOCABULARY)(text) == reference(text)


def test_budget(spark):
    rows = [("a", "the cat sat", 1), ("a", "the cat sat", 1), ("a", None, 1), ("b", "", 1), (None, "पुल", 2)]
    df = spark.createDataFrame(rows, "source string, text string, tokens int").withColumn("_tokens", F.lit(9)).withColumn("items", F.lit(9))
    got = {r.source: (r["items"], r.blank_items, r.tokens) for r in tokens.token_budget(df, "text", {"source": F.col("source")}).collect()}
    assert got == {"a": (3, 1, 2 * reference("the cat sat")), "b": (1, 1, 0), None: (1, 0, reference("पुल"))}
    assert tokens.token_budget(df.limit(0), "text", {"source": F.col("source")}).count() == 0


def prose(paragraphs: int, sentences: int = 6) -> str:
    return "\n\n".join(" ".join(f"Sentence {i} of part {p} speaks of needles and of gardens." for i in range(sentences)) for p in range(paragraphs))


@pytest.mark.parametrize("text", [prose(60), prose(1, 900), "word " * 6000, "a" * 120_000, "क्षि" * 9000, "\U0001f600" * 5000, "x\n" * 9000, prose(30).replace("\n\n", "\r\n\r\n")])
def test_pieces(text):
    limit, overlap = 1000, 100
    found = split.cut(text, limit, overlap)
    assert found[0].start == 0 and found[-1].end == len(text) and all(p.tokens <= limit and p.tokens == reference(text[p.start : p.end]) for p in found)
    for a, b in zip(found, found[1:], strict=False):
        assert a.start < b.start <= a.end < b.end
        assert overlap - 2 <= reference(text[b.start : a.end]) <= overlap + 30 or a.end == b.start
    if "." in text:
        assert {p.boundary for p in found} <= {"paragraph", "sentence", "end"}


def test_chapters_come_first():
    text = "\n\n".join(f"Chapter {n}: On needles\n\n{prose(14)}" for n in range(1, 6))
    found = split.cut(text, 1200, 50)
    assert any(p.boundary == "chapter" and text[p.end :].lstrip().startswith("Chapter") for p in found)


def test_short_texts_and_tables(spark):
    long = prose(80)
    rows = [(1, long), (1, long), (2, "short"), (3, None), (4, ""), (None, long)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("t", F.lit(0)).withColumn("pieces", F.lit(0))
    got = split.split_documents(df, "doc_id", "text", 1000, 100).collect()
    one = split.cut(long, 1000, 100)
    assert len(got) == 3 * len(one) and {r.doc_id for r in got} == {1, None} and all(r.piece == long[r.start_char : r.end_char] for r in got)
    assert sorted(r.doc_id or 0 for r in split.oversized(df, "doc_id", "text", 1000, 100).collect()) == [0, 1, 1]
    assert split.split_documents(df.limit(0), "doc_id", "text").count() == 0
    with pytest.raises(ValueError):
        split.split_documents(df, "doc_id", "text", 100, 60)


def test_found_documents_are_those_cut(spark, tmp_path):
    long = prose(200)
    rows = [(1, long), (2, "short"), (3, None), (4, "a b " * 1990), (5, "word " * 6000)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.p10_found(spark, str(tmp_path))
    assert "MapInPandas" in found._jdf.queryExecution().executedPlan().toString()
    pieces = queries.p10_pieces(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in found.collect()) == sorted({r.doc_id for r in pieces}) == [i for i, t in rows if t and reference(t) > 4000]
    of = sorted((r for r in pieces if r.doc_id == 1), key=lambda r: r.piece_no)
    assert len(of) > 1 and of[0].piece + "".join(b.piece[a.end_char - b.start_char :] for a, b in zip(of, of[1:], strict=False)) == long


@pytest.mark.parametrize("overlap", [95, 96, 97, 99, 100])
def test_pieces_overlap_where_the_step_back_splits_a_character(overlap):
    text = "\U0001f600 " * 100 + "End.\n\n" + "\U0001f600" * 2000
    found = split.cut(text, 1000, overlap)
    assert found[0].start == 0 and found[-1].end == len(text) and all(p.tokens <= 1000 for p in found)
    for a, b in zip(found, found[1:], strict=False):
        assert a.start < b.start < a.end < b.end
        assert overlap <= reference(text[b.start : a.end]) <= overlap + 3


@pytest.mark.parametrize(("limit", "overlap"), [(8, 3), (12, 5), (50, 24)])
def test_pieces_go_forward_under_small_limits(limit, overlap):
    text = "\U0001f9d1‍\U0001f33e क्षि. \U0001f600\n\n" * 60
    found = split.cut(text, limit, overlap)
    assert found[0].start == 0 and found[-1].end == len(text) and all(p.tokens <= limit for p in found)
    assert all(a.start < b.start <= a.end < b.end for a, b in zip(found, found[1:], strict=False))
