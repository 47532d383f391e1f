import pytest
from pyspark.sql import functions as F

from foliant.llm import encoding as E

TEXTS = ["Rutor’s café — “warm” at 16°C", "तभी 456 बच्चों ने कोमल भागफल को उधार लिया।", "त्यानंतर फिरोथा व तीकलनो यांनी वेगळे केले, पण ठिकाण 3–4 नव्हते.", "½ cm² × 3 ÷ 2 … naïve Ångström"]


def garble(text: str, encoding: str) -> str | None:
    """UTF-8 read as that encoding; bytes it has no character for keep their code."""
    return "".join(chr(c) if c < 0x80 else {b: chr(k) for k, b in E._to_bytes(encoding).items() if b != 0xFFFF}[c] for c in text.encode())


@pytest.mark.parametrize("encoding", E.ENCODINGS)
@pytest.mark.parametrize("text", TEXTS)
def test_round_trip(text, encoding):
    bad = garble(text, encoding)
    new, rounds = E.repair(bad)
    assert rounds and new == text and not E.lost(new)


@pytest.mark.parametrize("text", TEXTS)
def test_nested_layers(text):
    bad = garble(garble(text, "cp1252"), "cp1252")
    assert E.repair(bad)[0] == text


def test_layers_have_no_limit():
    bad = text = "café — ½"
    for _ in range(9):
        bad = garble(bad, "latin-1")
    assert E.repair(bad) == (text, 9)


def test_a_remnant_counts_beside_a_proven_sequence(spark):
    rows = [("right", "Kâlidâs wrote plays."), ("lost", garble("Vepel’s — ", "cp1252") + "Rutorâs lamp"), ("whole", garble("Vepel’s", "cp1252") + " lamp")]
    found = {r.id: r.lossless for r in E.find_garbled(spark.createDataFrame(rows, "id string, raw_text string"), "id", "raw_text").collect()}
    assert found == {"lost": False, "whole": True}


def test_no_break_spaces_made_plain():
    text = "कुछ लोगों ने काठी को उठाया और इकट्ठा किया"
    assert E.repair(garble(text, "cp1252").replace("\xa0", " "))[0] == text


def test_part_of_a_text():
    text = "Beside the lamp, " + garble("Vepel’s पुल", "cp1252") + " stayed warm — “yes”."
    assert E.repair(text)[0] == "Beside the lamp, Vepel’s पुल stayed warm — “yes”."


@pytest.mark.parametrize("text", ["A café in São Paulo: 5 × 3 ÷ 2 = 7½ cm², 16°C, £5, “né” — naïve", "The letters Ã, Â and â hang on the chart.", "É—“x”", "", "plain", "Kâlidâs wrote plays.", "Mîrâs and dâs", "le pâs"])
def test_right_text_stays(text):
    assert E.repair(text) == (text, 0) and not E.lost(text)


def test_what_is_lost():
    new, rounds = E.repair(garble(TEXTS[1], "latin-1").replace("\x8d", ""))
    assert rounds and E.lost(new)
    assert E.lost("Korulu�s pebble") and E.lost("6 Ã 31 = 186")


def test_table(spark):
    rows = [("a", garble(TEXTS[0], "cp1252"), 1), ("a", garble(TEXTS[0], "cp1252"), 1), ("b", TEXTS[0], 1), ("c", None, 1), ("d", "", None), (None, garble(TEXTS[1], "cp1251"), 2), ("e", "x" * 300_000 + garble("é", "latin-1"), 3), ("f", "Ko�s", 1)]
    df = spark.createDataFrame(rows, "id string, raw_text string, _k int").withColumn("restored", F.lit(1)).withColumn("_r", F.lit(1))
    found = {(r.id, r.lossless): r for r in E.find_garbled(df, "id", "raw_text").collect()}
    assert E.find_garbled(df, "id", "raw_text").count() == 5
    assert found["a", True].restored == TEXTS[0] and found[None, True].restored == TEXTS[1] and ("f", False) in found
    assert E.find_garbled(df.limit(0), "id", "raw_text").count() == 0
