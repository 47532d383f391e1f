import random
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foliant.operators import intervals as I


def brute(rows):
    """Rows (key, start, end) into (key, kind, start, end)."""
    by = defaultdict(list)
    for k, s, e in rows:
        if s is not None:
            by[k].append((s, s if e is None or e < s else e))
    out = []
    for k, spans in by.items():
        runs = []
        for s, e in sorted(spans):
            if runs and s <= runs[-1][1] + 1:
                runs[-1][1] = max(runs[-1][1], e)
            else:
                runs.append([s, e])
        out += [(k, "period", s, e) for s, e in runs]
        out += [(k, "gap", a[1] + 1, b[0] - 1) for a, b in zip(runs, runs[1:], strict=False)]
    return sorted(out, key=str)


@settings(max_examples=200, deadline=None)
@given(st.sets(st.tuples(st.integers(0, 5), st.integers(0, 40)).map(lambda b: (b[0], b[1] % (64 >> b[0]))), max_size=40))
def test_blocks_merge_to_what_they_cover(blocks):
    covered = sorted({v for k, i in blocks for v in range(i << k, (i + 1) << k)})
    runs = I.merge_blocks(blocks, 6)
    assert [v for s, e in runs for v in range(s, e + 1)] == covered
    assert all(a[1] + 1 < b[0] for a, b in zip(runs, runs[1:], strict=False))


def got(spark, rows, schema="document_id string, s int, e int"):
    df = spark.createDataFrame(rows, schema).withColumn("kind", F.lit(1)).withColumn("_s", F.lit("x")).withColumn("start_page", F.lit(0))
    return sorted((tuple(r) for r in I.periods_and_gaps(df, ["document_id"], "s", "e").collect()), key=str)


@pytest.mark.parametrize("seed, width, longest", [(1, 200, 12), (2, 20_000, 9000), (3, 2_000_000, 300_000), (4, 5000, 3)])
def test_against_brute_force(spark, seed, width, longest):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "b", "b", "b", None]), (s := rng.randrange(-width, width)), rng.choice([s + rng.randrange(longest), s + 3, None, s - 5])) for _ in range(400)]
    rows += [("a", None, 7), ("c", None, None), ("a", 4095, 4096), ("a", 4097, 8192)] + rows[:20]
    assert got(spark, rows) == brute(rows)


def test_canonical_blocks(spark):
    r = spark.sql("select 3L s, 17L e").select(I.dyadic_blocks(F.col("s"), F.col("e")).alias("b")).first().b
    spans = sorted(((x.i << x.k) - I.SHIFT, ((x.i + 1) << x.k) - 1 - I.SHIFT) for x in r)
    assert spans == [(3, 3), (4, 7), (8, 15), (16, 17)]


def test_edges_and_empty(spark):
    assert got(spark, [("a", 1, 2), ("a", 1, 2), ("a", 3, 5), ("a", 9, 9)]) == [("a", "gap", 6, 8), ("a", "period", 1, 5), ("a", "period", 9, 9)]
    assert got(spark, [("a", None, 2)]) == [] and got(spark, []) == []
    big = 2**31 - 1
    assert got(spark, [("a", -(2**31), big)]) == [("a", "period", -(2**31), big)]


def test_a_hot_key_is_spread(spark):
    """One key, many rows: every cell is a group of its own."""
    df = spark.range(200_000).select(F.lit("a").alias("k"), (F.col("id") * 3).cast("int").alias("s"), (F.col("id") * 3 + 1).cast("int").alias("e"))
    out = I.periods_and_gaps(df, ["k"], "s", "e").groupBy("kind").count().collect()
    assert {r.kind: r["count"] for r in out} == {"period": 200_000, "gap": 199_999}
