import random

import pytest
from pyspark.sql import functions as F

from foliant.llm import scans as S

WORDS = "garden weaver needle lantern followed described modern silence teacher basket window narrow common during market village copper distant".split()


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(1)
    rows, truth = [], set()
    title, chapter = "The Warm Garden of Kalno", "Lanterns and Baskets"
    misread = {"garden": "g@rden", "described": "clescribed", "common": "cornmon", "silence": "silcnce", "needle": "nee1le", "modern": "moclern", "teacher": "feacher", "window": "winclow"}
    for n in range(1, 121):
        noise = set()
        body = [rng.choice(WORDS) for _ in range(90)]
        body[10:10] = ["hand-made"] * 2
        if n % 4 == 0:
            for w in rng.sample(sorted(misread), 4):
                body.append(misread[w])
            noise.add("misread")
        elif n % 4 == 1:
            body += [misread["garden"], misread["common"]]  # two are no case
        text = " ".join(body) + "."
        k = text.index(" ", 300)
        lines = [text[:k], text[k + 1 :]]
        if n % 5 == 0:
            lines = [text[: k + 1] + "descri-", "bed " + text[k + 1 :]]
            noise.add("hyphen")
        elif n % 5 == 1:
            lines = [text[: k + 1] + "hand-", "made " + text[k + 1 :]]
        if n == 20:
            lines.insert(0, "Chapter 2: " + chapter)
        elif n % 3 == 0:
            head = [title.upper(), chapter, f"{n - 4}   {chapter}", f"{chapter} | {n - 4}"][n // 3 % 4] if n > 20 else title
            lines.insert(0, head)
            noise.add("header")
            if str(n - 4) in head.split():
                noise.add("page_number")
        if n % 7 == 0:
            lines.append(rng.choice([f"- {n - 4} -", f"Page {n - 4}", f"[{n - 4}]", str(n - 4)]))
            noise.add("page_number")
        elif n % 7 == 1:
            lines.append(str(rng.randrange(500, 900)))  # an answer, not the page's number
        rows.append((f"p{n}", "book", n, "\n".join(lines), None))
        truth |= {(f"p{n}", x) for x in noise}
    pages = spark.createDataFrame(rows, "id string, document_id string, page_number int, text string, metadata string")
    books = spark.createDataFrame([("book", title)], "document_id string, title string")
    chapters = spark.createDataFrame([("book", chapter, 20), ("book", None, 3)], "document_id string, title string, start_page int")
    return pages, books, chapters, truth


def test_kinds_of_noise(tables):
    pages, books, chapters, truth = tables
    found = {(r.id, r.noise) for r in S.find_noise(pages, books, chapters).collect()}
    assert found == truth


def test_mended(tables):
    pages, books, chapters, _ = tables
    rows = {r.id: r.mended for r in S.mended_pages(pages, books, chapters).collect()}
    assert len(rows) == 120
    assert "descri-" not in rows["p5"] and "described" in rows["p5"] and "g@rden" not in " ".join(rows.values()) and "hand-made" in rows["p6"]
    assert not rows["p24"].upper().startswith("THE WARM GARDEN") and "\n" not in rows["p5"]


@pytest.mark.parametrize("right", ["common", "discovered", "familiar", "during", "window", "Kalnopur", "बगीचा", "मध्ये"])
def test_fold_makes_misread_forms_equal(right):
    for wrong, group in S.CONFUSIONS:
        if group and group in right and wrong not in ("१", "२") and wrong.isalpha():
            if wrong != "h" and group not in ("।",):
                assert S.fold(right.replace(group, wrong, 1)) == S.fold(right)


def test_anagram_differences(spark):
    df = spark.createDataFrame([("common", "cornmon"), ("बगीचा", "वगीचा"), ("window", "windovv")], "a string, b string")
    diff = {r.a: r.d for r in df.select("a", (S.anagram(F.col("a")) - S.anagram(F.col("b"))).alias("d")).collect()}
    assert diff == {"common": S._value_of("m") - S._value_of("rn"), "बगीचा": S._value_of("ब") - S._value_of("व"), "window": S._value_of("w") - S._value_of("vv")}


def test_corrections(spark):
    words = [("common", 900), ("cornmon", 3), ("table", 700), ("fable", 650), ("discovered", 500), ("cliscovcred", 2), ("the", 5000), ("fhe", 9), ("h0use", 1), ("1st", 40), ("x" * 60, 2), ("bed", 20), ("hed", 19)]
    got = {r.word: r.right for r in S.corrections(spark.createDataFrame(words, "word string, n bigint")).collect()}
    assert got == {"cornmon": "common", "cliscovcred": "discovered", "fhe": "the", "h0use": None}


def test_learnt_confusions(spark):
    """Groups that no list names are found in the words, inflection is not taken for misreading."""
    rng = random.Random(7)
    stems = sorted({"".join(rng.choice(c) for c in ("bdgkmprt", "aeiou", "dgmn", "aeiou", "gkmnrt", "aeo")) for _ in range(300)})
    rows = {w: rng.randrange(100, 900) for w in stems}
    misread = {}
    for a, b in (("q", "g"), ("nn", "m"), ("4", "k")):
        for w in stems:
            if b in w[1:] and rng.random() < 0.5:
                misread[w[0] + w[1:].replace(b, a, 1)] = w
    for w in stems[::2]:
        rows[w + "s"] = rng.randrange(1, 400)  # of all frequencies
    rows |= {w: rng.randrange(1, 4) for w in misread if w not in rows}
    words = spark.createDataFrame(list(rows.items()), "word string, n bigint")
    known = S.learn(words)
    learnt = set(known.pairs) - set(S.CONFUSIONS)
    assert {("q", "g"), ("nn", "m"), ("4", "k")} <= learnt and not any("s" in a + b for a, b in learnt)
    assert known.fold("ganne") == known.fold("game") == known.fold("qame") and S.fold("qame") != S.fold("game") and known.signs["4"] == "k"
    got = {r.word: r.right for r in S.corrections(words, known).collect()}
    right = [w for w, r in misread.items() if got.get(w) == r]
    assert len(right) >= 0.95 * len(misread)
    assert S.learn(words.limit(0)) == S.KNOWN


def test_no_bounds_on_words_and_heads(spark):
    long = "un" * 30 + "common"
    words = spark.createDataFrame([(long, 90), (long.replace("m", "rn", 1), 2), ("é" * 70_000 + "a", 1)], "word string, n bigint")
    assert {r.word: r.right for r in S.corrections(words).collect()} == {long.replace("m", "rn", 1): long}
    title = "The long and winding account of all that befell the weavers of the village " * 3
    pages = spark.createDataFrame([(f"p{n}", "b", n, f"{title.strip()} {n}\nIt was late.\nThe end came.\nAll slept.", None) for n in range(1, 9)], "id string, document_id string, page_number int, text string, metadata string")
    found = S.page_edges(pages, spark.createDataFrame([("b", title)], "document_id string, title string"), spark.createDataFrame([], "document_id string, title string, start_page int"))
    assert found.where("noise = 'header'").count() == 8


@pytest.mark.parametrize("n, value", [("iv", 4), ("XII", 12), ("viii", 8), ("xl", 40), ("iiii", None), ("", None), ("mix", None)])
def test_roman(n, value):
    assert S.roman(n) == value


@pytest.mark.parametrize(
    "line, number, rest",
    [("- 12 -", 12, ""), ("Page l2", 12, ""), ("पृष्ठ १५", 15, ""), ("[7]", 7, ""), ("3   The Garden", 3, "thegarden"), ("The Garden | 14", 14, "thegarden"), ("Chapter 4: The Garden", None, "thegarden"), ("The Garden", None, "thegarden"), ("— ll —", 11, "")],
)
def test_edges(line, number, rest):
    at = S.read_edge(line)
    assert at["number"] == number and at["rest"] == S.fold(rest)


def test_lines_read_jvm_side_are_read_alike(spark):
    rng = random.Random(12)
    words = WORDS + ["I", "O", "l", "x", "mix", "Chapter", "Page", "12", "4th", "g@rden", "cornmon", "“so”", "it’s", "बगीचा", "क़लम", "वन।", "२स", "प्रकरण", "–", "|", "-", "é", "(iv)", "[7]", "...", "Unit:"]
    lines = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 7))) for _ in range(3000)]
    pages = spark.createDataFrame([(str(i), "b", i, t, None) for i, t in enumerate(lines)], "id string, document_id string, page_number int, text string, metadata string")
    rows = {r.id: r for r in S.edge_lines(S.line_texts(pages)).collect()}
    assert len(rows) == len(lines)
    for i, t in enumerate(lines):
        want = S.read_edge(t)
        got = rows[str(i)]
        assert {k: got[k] for k in want} == want
    assert pages.where(S._is_common(F.col("text"))).count() > 300


def test_ends_of_pages(spark):
    rng = random.Random(13)
    texts = ["\n".join(rng.choice(["", " ", "a", "b c", "\xa0"]) for _ in range(rng.choice([1, 3, 9, 17, 40]))).replace("a\n", "a\r\n") for _ in range(200)]
    pages = spark.createDataFrame([(str(i), "b", i, t) for i, t in enumerate(texts)], "id string, document_id string, page_number int, text string")
    got: dict = {}
    for r in S._ends(pages).collect():
        got.setdefault(r.id, []).append((r.line, r.t))
    for i, t in enumerate(texts):
        solid = [(n, x.strip(" \t\xa0")) for n, x in enumerate(t.replace("\r", "\n").split("\n")) if x.strip(" \t\xa0")]
        assert sorted(got.get(str(i), [])) == (solid if len(solid) <= 4 else solid[:2] + solid[-2:])


def test_dirt(spark, tables):
    _, books, chapters, _ = tables
    rows = [("a", None, 1, "word-\nless", None), ("a", None, 1, "word-\nless", None), ("b", "book", None, "x", "{"), (None, "book", 2, None, None), ("c", "book", 3, "", None), ("d", "book", 4, "long " * 60_000, '{"printed_page": "x"}')]
    pages = spark.createDataFrame(rows, "id string, document_id string, page_number int, text string, metadata string").withColumn("e", F.lit(1)).withColumn("noise", F.lit(1)).withColumn("line", F.lit(1))
    assert {(r.id, r.noise) for r in S.find_noise(pages, books, chapters).collect()} == {("a", "hyphen")}
    assert S.find_noise(pages.limit(0), books, chapters).count() == 0
    assert S.mended_pages(pages, books.limit(0), chapters.limit(0)).count() == 6


@pytest.mark.parametrize("line, number, rest", [("10234", 10234, ""), ("१०२३४", 10234, ""), ("Page 1O234", 10234, ""), ("270001 | Lanterns", 270001, "lantems"), ("2147483647", 2147483647, ""), ("2147483648", None, ""), ("8174506345", None, "")])
def test_long_numbers(line, number, rest):
    got = S.read_edge(line)
    assert got["number"] == number and (got["rest"] or "") == S.fold(rest)


def test_book_of_12000_pages(spark):
    head = lambda n: f"{n - 4}  The Warm Garden" if n % 2 else "It was late."
    rows = [(f"p{n}", "book", n, f"{head(n)}\nA line of text.\nAnd one more.\n{n - 4 if n % 2 == 0 else 'The end.'}", None) for n in range(1, 12001)]
    rows.append(("pin", "book", 12001, "A line.\nOne.\nTwo.\n110016", None))  # not the page's number
    pages = spark.createDataFrame(rows, "id string, document_id string, page_number int, text string, metadata string")
    books = spark.createDataFrame([("book", "The Warm Garden")], "document_id string, title string")
    found = S.page_edges(pages, books, spark.createDataFrame([], "document_id string, title string, start_page int"))
    got = {(r.id, r.noise) for r in found.select("id", "noise").distinct().collect()}
    late = range(9000, 12001)
    assert {(f"p{n}", "page_number") for n in late} <= got and {(f"p{n}", "header") for n in late if n % 2} <= got
    assert ("pin", "page_number") not in got
