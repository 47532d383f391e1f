"""Coverage of integer intervals: continuous periods and the gaps between them.

Each interval is cut into canonical dyadic blocks (size 2^k, start a multiple of 2^k). Blocks are gathered in three tiers
of CELL_BITS levels each, by (key, tier, cell), so a group never holds more than two blocks for each of a cell's places,
whatever the number of rows of its key. Within a cell, blocks covered by an ancestor are removed and sibling pairs
merged upward; cells covered by a block of a higher tier are dropped. What is left is coalesced: only the first and last
run of a cell can continue in another one, so the window by key sees two rows a cell.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.session import cut

#: Levels of a tier: a cell of the lowest has 2^CELL_BITS values, one of the next as many such cells.
CELL_BITS, TIERS = 12, 3
#: Added to every value, so that blocks have no sign; values from -2^31 to 2^31 are covered.
SHIFT = 1 << 31

RUNS = T.ArrayType(T.StructType([T.StructField("s", T.LongType()), T.StructField("e", T.LongType())]))


def dyadic_blocks(start: Column, end: Column) -> Column:
    """array<struct<k int, i bigint>>: the canonical blocks of [start, end], both included, at most two a level.

    At level k the whole blocks within [l, r) go from l / 2^k, rounded up, to r / 2^k, rounded down. The first is
    canonical when its number is odd, as its sibling sticks out, and the last when the number after it is.
    """
    l, r = (start + F.lit(SHIFT)).cast("bigint"), (end + F.lit(SHIFT) + F.lit(1)).cast("bigint")

    def level(x: Column) -> Column:
        k, a, b = x["k"], x["a"], x["b"]
        odd = lambda v: v.bitwiseAND(F.lit(1)) == 1
        block = lambda i: F.struct(k.alias("k"), i.alias("i"))
        return F.array(F.when((a < b) & odd(a), block(a)), F.when((a < b) & odd(b) & ~(odd(a) & (a + 1 == b)), block(b - 1)))

    levels = F.sequence(F.lit(0), F.floor(F.log2((r - l).cast("double"))).cast("int") + 1)
    # The bounds of a level are bound to names, as shifts of a column amount are an expression only in SQL.
    bounds = F.transform(levels, lambda k: F.struct(k.alias("k"), (-F.call_function("shiftright", -l, k)).alias("a"), F.call_function("shiftright", r, k).alias("b")))
    return F.array_compact(F.flatten(F.transform(bounds, level)))


def merge_blocks(blocks: set[tuple[int, int]], top: int) -> list[tuple[int, int]]:
    """Runs (start, end) of a set of blocks (level, index): drop covered blocks, merge siblings upward, coalesce."""
    kept = {b for b in blocks if not any((b[0] + d, b[1] >> d) in blocks for d in range(1, top - b[0] + 1))}
    for k in range(top):
        for i in [i for (j, i) in kept if j == k and not i & 1]:
            if (k, i + 1) in kept:
                kept -= {(k, i), (k, i + 1)}
                kept.add((k + 1, i >> 1))
    runs: list[tuple[int, int]] = []
    for s, e in sorted((i << k, ((i + 1) << k) - 1) for k, i in kept):
        if runs and runs[-1][1] + 1 == s:
            runs[-1] = (runs[-1][0], e)
        else:
            runs.append((s, e))
    return runs


@F.pandas_udf(RUNS)
def _cell_runs(tiers: pd.Series, levels: pd.Series, indexes: pd.Series) -> pd.Series:
    """Runs of values of each cell, from its blocks by level within the tier."""
    out = []
    for tier, k, i in zip(tiers, levels, indexes, strict=True):
        shift = int(tier) * CELL_BITS
        runs = merge_blocks(set(zip(map(int, k), map(int, i), strict=True)), CELL_BITS)
        out.append([{"s": s << shift, "e": ((e + 1) << shift) - 1} for s, e in runs])
    return pd.Series(out, dtype=object)


def periods_and_gaps(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Rows (keys..., kind, start_page, end_page): kind `period` for each longest covered run, `gap` between two of them.

    A null end, or an end before the start, means the start alone; a row with a null start is no interval. A null key
    is a key like any other. Runs that touch are one; an empty input gives no rows. Other columns are ignored, and may
    bear any name. Values must lie between -2^31 and 2^31 - 1. The input is read once; the cells, a fraction of it,
    are written to the checkpoint folder.
    """
    names = [f"_key{n}" for n in range(len(keys))]
    s, e = F.col("_s"), F.col("_e")
    spans = (
        df.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names, strict=True)], F.col(f"`{start}`").cast("bigint").alias("_s"), F.col(f"`{end}`").cast("bigint").alias("_e"))
        .where(s.isNotNull())
        .withColumn("_e", F.when(e.isNull() | (e < s), s).otherwise(e))
    )
    blocks = spans.select(*names, F.explode(dyadic_blocks(s, e)).alias("b")).select(*names, F.col("b.k").alias("k"), F.col("b.i").alias("i"))
    tier = F.least(F.lit(TIERS - 1), F.floor(F.col("k") / CELL_BITS)).cast("int")
    tiered = blocks.withColumn("tier", tier).withColumn("k", F.col("k") - F.col("tier") * CELL_BITS)
    # Sets of blocks: repeated ones fall away before the shuffle.
    held = tiered.groupBy(*names, "tier", F.expr(f"shiftright(i, {CELL_BITS} - k)").alias("cell")).agg(F.collect_set(F.struct("k", "i")).alias("b"))
    cells = cut(held.select(*names, "tier", "cell", _cell_runs("tier", "b.k", "b.i").alias("runs")))

    upper = cells.where(F.col("tier") > 0).select(*[F.col(n).alias(f"u{n}") for n in names], F.col("tier").alias("u_tier"), F.col("cell").alias("u_cell"), F.col("runs").alias("u_runs"))
    above = F.transform(F.sequence(F.lit(1), F.lit(TIERS - 1)), lambda t: F.struct(t.alias("t"), F.call_function("shiftright", F.col("cell"), (t - F.col("tier")) * CELL_BITS).alias("c")))
    asked = cells.where(F.col("tier") < TIERS - 1).select(*names, "tier", "cell", F.explode(F.filter(above, lambda x: x["t"] > F.col("tier"))).alias("a"))
    first = F.call_function("shiftleft", F.col("cell"), (F.col("tier") + 1) * CELL_BITS)
    inside = F.exists("u_runs", lambda x: (x["s"] <= first) & (x["e"] >= first))
    covered = asked.join(upper, _all([F.col(n).eqNullSafe(F.col(f"u{n}")) for n in names] + [F.col("a.t") == F.col("u_tier"), F.col("a.c") == F.col("u_cell")]) & inside, "left_semi")
    covered = covered.select(*[F.col(n).alias(f"c{n}") for n in names], F.col("tier").alias("c_tier"), F.col("cell").alias("c_cell")).distinct()
    alone = cells.join(covered, _all([F.col(n).eqNullSafe(F.col(f"c{n}")) for n in names] + [F.col("tier") == F.col("c_tier"), F.col("cell") == F.col("c_cell")]), "left_anti")

    # Inner runs and holes of a lowest cell are final; its first and last run, and all runs of higher tiers, may touch others.
    n, low = F.size("runs"), F.col("tier") == 0
    row = lambda kind, s_, e_, group: F.struct(F.lit(kind).alias("kind"), s_.alias("s"), e_.alias("e"), group.alias("g"))
    of = F.col("runs")[0]["s"]
    edge = F.filter(F.transform("runs", lambda x, i: F.when(~low | (i == 0) | (i == n - 1), row("edge", x["s"], x["e"], F.when(low, of).otherwise(x["s"]))).otherwise(row("period", x["s"], x["e"], of))), lambda x: x.isNotNull())
    hole = F.when(low & (n > 1), F.transform(F.sequence(F.lit(1), n - 1), lambda i: row("gap", F.col("runs")[i - 1]["e"] + 1, F.col("runs")[i]["s"] - 1, of))).otherwise(F.slice(F.array(row("gap", of, of, of)), 1, 0))
    rows = alone.select(*names, F.explode(F.concat(edge, hole)).alias("r")).select(*names, "r.*")

    order = Window.partitionBy(*names).orderBy("s")
    edges = rows.where("kind = 'edge'").withColumn("before", F.lag("e").over(order)).withColumn("group_before", F.lag("g").over(order))
    edges = edges.withColumn("island", F.sum(F.when(F.col("before") + 1 == F.col("s"), 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    between = (F.col("before") + 1 < F.col("s")) & (F.col("group_before") != F.col("g"))
    # One row an island: the period, and the gap before it where it isn't a hole within a cell.
    islands = edges.groupBy(*names, "island").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.min(F.when(between, F.col("before") + 1)).alias("from"), F.min(F.when(between, F.col("s") - 1)).alias("to"))
    outer = islands.select(*names, F.explode(F.array_compact(F.array(F.struct(F.lit("period").alias("kind"), "s", "e"), F.when(F.col("from").isNotNull(), F.struct(F.lit("gap").alias("kind"), F.col("from").alias("s"), F.col("to").alias("e")))))).alias("r")).select(*names, "r.*")
    out = rows.where("kind <> 'edge'").select(*names, "kind", "s", "e").unionByName(outer)
    return out.select(*[F.col(x).alias(k) for x, k in zip(names, keys, strict=True)], "kind", (F.col("s") - SHIFT).cast("int").alias("start_page"), (F.col("e") - SHIFT).cast("int").alias("end_page"))


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out
