import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from foliant.llm import mix


def test_raking_meets_the_margins():
    rng = random.Random(1)
    cells = pd.DataFrame([(s, l, t, rng.randrange(1000, 9000)) for s in "abc" for l in "xy" for t in "pqr"], columns=["source", "language", "topic", "tokens"])
    targets, caps = {"a": 0.5, "b": 0.3, "c": 0.1, "absent": 0.1}, {"a": 4, "b": 3, "c": 9, "absent": 2}
    r = mix.rake(cells, targets, caps, {"x": 0.4, "y": 0.6}, {"p": 0.2, "q": 0.3, "r": 0.5}, total=20_000)
    r.cells["t"] = r.cells["weight"] * r.cells["tokens"]
    assert r.total == 20_000 and r.cells["t"].sum() == pytest.approx(20_000)
    for column, want in (("source", {"a": 5 / 9, "b": 3 / 9, "c": 1 / 9}), ("language", {"x": 0.4, "y": 0.6}), ("topic", {"p": 0.2, "q": 0.3, "r": 0.5})):
        got = (r.cells.groupby(column)["t"].sum() / r.total).to_dict()
        assert got == pytest.approx(want, abs=1e-6)


def test_caps_hold_and_bind():
    cells = pd.DataFrame([("a", "x", "p", 100), ("a", "y", "p", 300), ("b", "x", "p", 90_000)], columns=["source", "language", "topic", "tokens"])
    r = mix.rake(cells, {"a": 0.5, "b": 0.5}, {"a": 3, "b": 1}, {"x": 1.0}, {"p": 1.0})
    assert r.total == pytest.approx(2400) and (r.cells["weight"] <= r.cells["source"].map({"a": 3, "b": 1}) + 1e-9).all()
    assert r.cells.loc[r.cells["source"] == "a", "weight"].tolist() == pytest.approx([3, 3])


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["Big-One", "big_one", "big one ", "big_one", "mid", "mid", "other"]), rng.choice(["en", "hi", None]), rng.choice(["p", "q", None]), rng.randrange(50, 400)) for i in range(6000)]
    rows += [(10_000 + i, "tiny", "en", "p", 200 + i) for i in range(8)]
    return spark.createDataFrame(rows, "doc_id bigint, source string, language string, topic string, tokens bigint")


def test_shares(spark, corpus):
    targets = spark.createDataFrame([("big_one", 0.5, 1), ("mid", 0.44, 2), ("tiny", 0.01, 5), ("gone", 0.05, 3)], "source string, target_share double, max_repeats int")
    got = mix.mixture(corpus, "doc_id", targets)
    rows = got.collect()
    assert rows and len({r.doc_id for r in rows}) == len(rows)
    report = {r.source: r for r in mix.shares(got, targets).collect()}
    whole = sum(r.copies * r.tokens for r in rows)
    for s, share in (("big_one", 0.5), ("mid", 0.44), ("tiny", 0.01)):
        assert report[s].actual_share == pytest.approx(share / 0.95, abs=600 / whole)
        assert report[s].most_copies <= report[s].max_repeats
    assert report["gone"].actual_share == 0 and report["gone"].documents == 0
    assert mix.mixture(corpus, "doc_id", targets).exceptAll(got).count() == 0  # the same every time


def test_sampling_follows_the_weights(spark, corpus):
    """Taken about as often as the expected copies say, in every part of the corpus."""
    targets = spark.createDataFrame([("big_one", 0.9, 1), ("mid", 0.1, 1)], "source string, target_share double, max_repeats int")
    big = corpus.where("source <> 'tiny'")
    got = mix.mixture(big, "doc_id", targets, total=100_000).where("source = 'big_one'")
    n = got.agg(F.sum("copies").alias("c"), F.sum(F.col("copies") * F.col("tokens")).alias("t")).first()
    assert n.t == pytest.approx(90_000, abs=400)
    held = corpus.where("lower(source) like 'big%'").count()
    assert n.c / held == pytest.approx(90_000 / corpus.where("lower(source) like 'big%'").agg(F.sum("tokens")).first()[0], rel=0.1)


def test_dirt(spark):
    docs = spark.createDataFrame([(1, "A", "en", "p", 10, "x"), (1, "A", "en", "p", 10, "x"), (2, "a ", None, None, 0, "x"), (3, None, "en", "p", 5, "x"), (None, "a", "en", "p", 5, "x"), (4, "a", "en", "p", None, "x")], "doc_id bigint, source string, language string, topic string, tokens int, k string").withColumn("weight", F.lit(1)).withColumn("copies", F.lit(1))
    targets = spark.createDataFrame([("a", 1.0, 2), ("b", None, 1)], "source string, target_share double, max_repeats int")
    assert sorted((r.doc_id, r.copies) for r in mix.mixture(docs, "doc_id", targets).collect()) == [(1, 2), (1, 2)]
    assert mix.mixture(docs.limit(0), "doc_id", targets).count() == 0
    assert mix.mixture(docs, "doc_id", targets.limit(0)).count() == 0
    assert mix.shares(mix.mixture(docs.limit(0), "doc_id", targets), targets).count() == 2


@pytest.mark.parametrize("rows, room, want", [([(1, 50), (2, 30), (3, 20)], 55, [1]), ([(1, 90), (2, 30), (3, 20)], 55, [2, 3]), ([(1, 90), (2, 30)], 85, [1]), ([(1, 95), (2, 30), (3, 57)], 85, [2, 3]), ([(1, 60)], 55, [1]), ([(1, 200)], 55, []), ([], 9, [])])
def test_fill(rows, room, want):
    assert mix.fill(rows, room) == want


def test_a_total_beyond_the_caps_is_kept_and_reported(spark):
    docs = spark.createDataFrame([(i, "a" if i < 10 else "b", "en", "p", 100) for i in range(110)], "doc_id bigint, source string, language string, topic string, tokens int")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 1)], "source string, target_share double, max_repeats int")
    got = mix.mixture(docs, "doc_id", targets, total=6000)
    report = {r.source: r for r in mix.shares(got, targets, 6000).collect()}
    assert (report["a"].tokens, report["a"].shortfall) == (1000, 2000) and (report["b"].tokens, report["b"].shortfall) == (3000, 0)


def test_the_nearest_document_is_sought_beyond_the_next_ones(spark, monkeypatch):
    monkeypatch.setattr(mix, "FILL", 2)
    docs = spark.createDataFrame([(i, "a", "en", "p", 1000) for i in range(40)] + [(99, "a", "en", "p", 300), (98, "b", "en", "p", 5300)], "doc_id bigint, source string, language string, topic string, tokens int")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 1)], "source string, target_share double, max_repeats int")
    got = {r.doc_id for r in mix.mixture(docs, "doc_id", targets).collect()}
    assert {98, 99} <= got and len(got) == 7
