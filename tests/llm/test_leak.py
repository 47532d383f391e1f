import random
import re

import pytest
from pyspark.sql import functions as F

from foliant.llm import leak

VOCABULARY = [f"{a}{b}" for a in "ba ke ni do ru mi sa lo".split() for b in "t n r l s".split()]


def words_of(rng, n):
    return [rng.choice(VOCABULARY) for _ in range(n)]


def brute(passage: str, text: str) -> float:
    p, t = leak.words(passage), leak.words(text)
    grams = {tuple(t[i : i + 6]) for i in range(len(t) - 5)}
    covered = {j for i in range(len(p) - 5) if tuple(p[i : i + 6]) in grams for j in range(i, i + 6)}
    return len(covered) / len(p)


@pytest.mark.parametrize("seed", [0, 1, 3])
def test_against_brute_force(seed):
    rng = random.Random(seed)
    items = [(i, " ".join(words_of(rng, 60))) for i in range(20)]
    texts = []
    for _ in range(150):
        w = words_of(rng, 120)
        for _, p in rng.sample(items, 3):
            part = p.split()
            a, n = rng.randrange(50), rng.randrange(3, 60)
            at = rng.randrange(len(w))
            w[at:at] = part[a : a + n]
        texts.append(" ".join(w))
    held = leak.Items(items)
    for t in texts:
        want = {i: s for i, p in items if (s := brute(p, t)) >= 0.5}
        assert {m[0]: m[3] for m in held.matches(t, 0.5)} == pytest.approx(want)


def test_what_makes_no_difference():
    a = "The north-east garden, near Rutor’s lamp, was traced 412 times — कोमल पुल १२."
    b = "the NORTHEAST gar-\n  den near rutor's\nlamp was traced ४१२ times कोमल पुल 12"
    assert leak.words(a) == leak.words(b)
    assert leak.words("क़लम") == leak.words("क़लम")
    assert leak.words("") == [] and leak.words("— …") == []


def test_equal_hashes_are_compared(monkeypatch):
    """Were all words alike to the hash, the words themselves would still decide."""
    monkeypatch.setattr(leak.xxhash, "xxh3_64_intdigest", lambda w: 1)
    held = leak.Items([(1, "a b c d e f g h"), (2, "one two three four five six")])
    assert held.matches("x a b c d e f g h y", 0.5) == [(1, 8, 8, 1.0)]


def test_table(spark, monkeypatch):
    rng = random.Random(9)
    p = " ".join(words_of(rng, 60))
    docs = [(100, f"Start. {p} End."), (100, f"Start. {p} End."), (200, None), (300, ""), (400, p[: len(p) // 3]), (None, re.sub(" ", "\n", p.upper())), (500, ("z " * 100_000) + p)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("d", F.lit(1)).withColumn("share", F.lit(1)).withColumn("item_id", F.lit(1))
    items = spark.createDataFrame([(7, p, "x"), (7, p, "x"), (8, None, None), (9, "too short", ""), (10, "", "")], "item_id bigint, passage string, i string")
    got = sorted((r.doc_id or 0, r.item_id) for r in leak.find_leaks(df, "doc_id", "text", items, "item_id", "passage").collect())
    assert got == [(0, 7), (100, 7), (100, 7), (500, 7)]
    monkeypatch.setattr(leak, "BLOCK_ITEMS", 1)
    assert leak.find_leaks(df, "doc_id", "text", items, "item_id", "passage").count() == 4
    assert leak.find_leaks(df.limit(0), "doc_id", "text", items, "item_id", "passage").count() == 0
    assert leak.find_leaks(df, "doc_id", "text", items.limit(0), "item_id", "passage").count() == 0
