"""A mixture of sources with target shares of the tokens: raked weights, then documents by calibrated probabilities."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions.labels import source_name
from foliant.session import cut

#: Cells (source, language, topic) that are raked on the driver, at most; labels of more kinds must be brought together first.
MAX_CELLS = 200_000
#: Bins of the sampling order, by source; only documents of one bin are ranked one by one.
BINS = 1 << 14
ROUNDS = 200
#: Documents of a source, the next in order, among which first those are sought that fit the room left; then all others.
FILL = 200


@dataclass
class Raked:
    """Copies expected of each document of a cell, and the tokens aimed at by source."""

    cells: pd.DataFrame
    total: float
    aims: dict[str, float]


def rake(cells: pd.DataFrame, targets: dict[str, float], caps: dict[str, int], languages: dict[str, float], topics: dict[str, float], total: float | None = None) -> Raked:
    """Iterative proportional fitting of cell weights to source, language and topic shares; no weight exceeds its source's cap.

    cells: source, language, topic, tokens. Sources without tokens drop out and the other shares keep their
    proportions. The default total is the largest that every source can fill within its cap; a larger one is kept as
    it is, and sources at their cap fall short of their part. The sources' shares are fitted last and hold up to the
    caps; those of language and topic hold as far as caps and empty cells allow.
    """
    cells = cells[cells["source"].isin([s for s, x in targets.items() if x > 0]) & (cells["tokens"] > 0)].reset_index(drop=True)
    tokens = cells["tokens"].to_numpy(dtype=float)
    held = cells.groupby("source")["tokens"].sum().to_dict()
    if not held:
        return Raked(cells.assign(weight=np.zeros(0)), 0.0, {})
    share = {s: targets[s] / sum(targets[x] for x in held) for s in held}
    most = min(held[s] * caps[s] / share[s] for s in held)
    total = most if total is None else float(total)
    cap = cells["source"].map(caps).to_numpy(dtype=float)
    weight = np.minimum(cap, cells["source"].map({s: share[s] * total / held[s] for s in held}).to_numpy(dtype=float))
    margins = [("language", languages), ("topic", topics), ("source", share)]
    for _ in range(ROUNDS):
        old = weight.copy()
        for column, shares in margins:
            for value, members in cells.groupby(column).groups.items():
                at = np.asarray(members)
                weight[at] = _fit(weight[at], tokens[at], cap[at], shares.get(value, 0.0) * total, exact=column == "source")
        if np.abs(weight - old).max() < 1e-9:
            break
    return Raked(cells.assign(weight=weight), total, {s: share[s] * total for s in held})


def _fit(weight: np.ndarray, tokens: np.ndarray, cap: np.ndarray, aim: float, exact: bool) -> np.ndarray:
    """Weights in proportion whose tokens meet the aim, none above its cap; what the caps take away the others carry."""
    if exact and (weight * tokens).sum() <= 0:
        weight = np.minimum(cap, 1e-9)
    for _ in range(60):
        free = weight < cap
        now, fixed = (weight * tokens)[free].sum(), (cap * tokens)[~free].sum()
        if now <= 0 or abs(now + fixed - aim) <= 1e-9 * max(aim, 1.0):
            break
        if aim <= fixed and not exact:
            weight = weight * (aim / (now + fixed))
            break
        weight = np.minimum(cap, np.where(free, weight * max(aim - fixed, 0.0) / now, weight)) if aim > fixed else np.minimum(cap, weight * (aim / (now + fixed)))
    return weight


def fill(rows: list[tuple[int, int]], room: float) -> list[int]:
    """The ids of rows (id, tokens) that fill the room best: the first alone, or those that fit, in order, with the one nearest to what they leave."""
    taken, left = [], room
    for i, n in rows:
        if n <= left:
            taken.append(i)
            left -= n
    rest = [(abs(left - n), i) for i, n in rows if i not in taken]
    if rest and min(rest)[0] < left:
        left, last = min(rest)
        taken.append(last)
    return [rows[0][0]] if rows and abs(room - rows[0][1]) < left else taken


def mixture(docs: DataFrame, key: str, targets: DataFrame, total: float | None = None) -> DataFrame:
    """(key, source, language, topic, tokens, expected_copies, copies) of the documents in the mixture.

    docs has key, source, language, topic, tokens; targets has source, target_share, max_repeats; total is the size
    aimed at, where the sources can't fill it they fall short, which shares() reports. Each document is
    taken floor(w) times and once more with the probability of the rest: the documents of a source are ordered by
    u / p, u a hash of the key, and taken until the next would give the source more than its tokens; what is then left is filled by fill(). Documents without
    tokens, of no key or of sources without a target are not taken; repeated keys are documents of their own. Language
    and topic shares are those of all of docs. Only cell totals, at most MAX_CELLS, bin totals and
    FILL rows a source go to the driver.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.where(F.col(f"`{key}`").isNotNull() & (F.col("tokens") > 0)).select(
        F.col(f"`{key}`").alias("k"), source_name(F.col("source")).alias("source"), F.coalesce("language", F.lit("unknown")).alias("language"), F.coalesce("topic", F.lit("unknown")).alias("topic"), F.col("tokens").cast("bigint").alias("tokens")
    )
    wanted = {r.source: r for r in targets.where("target_share is not null").groupBy(source_name(F.col("source")).alias("source")).agg(F.max("target_share").alias("share"), F.max(F.coalesce("max_repeats", F.lit(1))).alias("most")).limit(MAX_CELLS + 1).toLocalIterator()}
    if len(wanted) > MAX_CELLS:
        raise ValueError(f"more than {MAX_CELLS} sources with a target")
    rows = cut(rows.withColumn("rid", F.monotonically_increasing_id()))  # the token counts are made once
    cells = rows.groupBy("source", "language", "topic").agg(F.sum("tokens").alias("tokens")).limit(MAX_CELLS + 1).toPandas()
    if len(cells) > MAX_CELLS:
        raise ValueError(f"more than {MAX_CELLS} cells of source, language and topic; bring labels together first")
    whole = max(1, int(cells["tokens"].sum()))
    part = lambda c: {k: v / whole for k, v in cells.groupby(c)["tokens"].sum().items()}
    raked = rake(cells, {s: r.share for s, r in wanted.items()}, {s: r.most for s, r in wanted.items()}, part("language"), part("topic"), total)
    spark = docs.sparkSession
    if raked.cells.empty:
        return spark.createDataFrame([], f"{key} {kind}, source string, language string, topic string, tokens bigint, expected_copies double, copies int")
    weights = spark.createDataFrame(raked.cells[["source", "language", "topic", "weight"]], "source string, language string, topic string, weight double")
    drawn = (
        rows.join(F.broadcast(weights), ["source", "language", "topic"])
        .withColumn("base", F.floor(F.col("weight") + 1e-9).cast("int"))
        .withColumn("p", F.greatest(F.lit(0.0), F.col("weight") - F.col("base")))
        # Repeated keys get the same place in the order; the number of the row decides among them.
        .withColumn("q", F.when(F.col("p") > 1e-9, (F.pmod(F.xxhash64("k"), F.lit(1 << 40)) / (1 << 40)) / F.col("p")))
        # Documents with q below 1 are the expected ones; bins beyond serve where fewer than expected came. Without q there is no further copy.
        .withColumn("bin", F.when(F.col("q").isNotNull(), F.least(F.lit(BINS - 1), F.floor(F.when(F.col("q") < 2, F.col("q") / 2 * (BINS - 1024)).otherwise(BINS - 1024 + F.log2("q") * 16)))).cast("int"))
    )
    sums = drawn.groupBy("source", "bin").agg(F.sum(F.col("base") * F.col("tokens")).alias("sure"), F.sum("tokens").alias("more")).toPandas()
    edges = []
    for source, group in sums.groupby("source"):
        left = raked.aims[source] - float(group["sure"].sum())
        order = group[group["bin"].notna()].sort_values("bin")
        before = order["more"].cumsum().shift(fill_value=0)
        over = order[before + order["more"] > left]
        edges.append((source, int(over["bin"].iloc[0]) if len(over) else BINS, float(left - before[over.index[0]]) if len(over) else 0.0))
    at = spark.createDataFrame(edges, "source string, edge int, room double")
    placed = drawn.join(F.broadcast(at), "source")
    # Only the documents of the edge bin are ranked.
    inside = placed.where(F.col("bin") == F.col("edge")).withColumn("upto", F.sum("tokens").over(Window.partitionBy("source").orderBy("q", "rid").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    inside = inside.withColumn("extra", (F.col("upto") <= F.col("room")).cast("int"))
    others = placed.where(F.col("bin").isNull() | (F.col("bin") != F.col("edge"))).withColumn("extra", F.coalesce((F.col("bin") < F.col("edge")).cast("int"), F.lit(0)))
    chosen = inside.drop("upto").unionByName(others)
    # What room is left is filled from the next documents that fit, so that a long one at the edge doesn't spoil a share.
    filled = {r.source: r.t for r in inside.where("extra = 1").groupBy("source").agg(F.max("upto").alias("t")).toLocalIterator()}
    left = {source: room - filled.get(source, 0) for source, edge, room in edges if edge < BINS}
    more: list[int] = []
    if left:
        room = spark.createDataFrame(list(left.items()), "source string, left double")
        free = chosen.where("extra = 0 and q is not null")
        next_ones = free.join(F.broadcast(room), "source").withColumn("n", F.row_number().over(Window.partitionBy("source").orderBy("q", "rid"))).where(F.col("n") <= FILL)
        by_source: dict[str, list] = {}
        for r in next_ones.select("source", "rid", "tokens", "n").orderBy("source", "n").collect():
            by_source.setdefault(r.source, []).append((r.rid, r.tokens))
        still: list[tuple[str, float]] = []
        for source, rows_ in by_source.items():
            taken, size = fill(rows_, left[source]), dict(rows_)
            more += taken
            if len(rows_) == FILL:
                still.append((source, float(left[source] - sum(size[i] for i in taken))))
        if still:
            # Of all other documents of a source, the one nearest to what is left, where it brings the share nearer.
            after = spark.createDataFrame(still, "source string, still double")
            seen = [i for rows_ in by_source.values() for i, _ in rows_]
            others_ = free.join(F.broadcast(after), "source").join(F.broadcast(spark.createDataFrame([(i,) for i in seen], "rid bigint")), "rid", "left_anti")
            off = F.abs(F.col("still") - F.col("tokens"))
            best = others_.where(off < F.abs("still")).groupBy("source").agg(F.min_by("rid", F.struct(off.alias("off"), "q", "rid")).alias("rid"))
            more += [r.rid for r in best.toLocalIterator()]
    also = spark.createDataFrame([(i,) for i in more], "rid bigint").withColumn("also", F.lit(1))
    chosen = chosen.join(F.broadcast(also), "rid", "left").withColumn("extra", F.greatest("extra", F.coalesce("also", F.lit(0))))
    columns = [F.col("k").alias(key), "source", "language", "topic", "tokens", F.col("weight").alias("expected_copies"), (F.col("base") + F.col("extra")).alias("copies")]
    return chosen.select(*columns).where(F.col("copies") > 0)


def shares(mixed: DataFrame, targets: DataFrame, total: float | None = None) -> DataFrame:
    """(source, target_share, actual_share, documents, copies, tokens, most_copies, max_repeats, shortfall), a row for each target, absent ones too.

    shortfall is what a source lacks of its target's part of `total`, by default of the tokens that came together.
    """
    held = mixed.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum("copies").alias("copies"), F.sum(F.col("copies") * F.col("tokens")).alias("tokens"), F.max("copies").alias("most_copies"))
    wanted = targets.groupBy(source_name(F.col("source")).alias("source")).agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    whole = held.agg(F.sum("tokens").alias("whole"))
    return wanted.join(held, "source", "left").crossJoin(F.broadcast(whole)).select(  # whole is one row
        "source", "target_share", F.coalesce(F.col("tokens") / F.col("whole"), F.lit(0.0)).alias("actual_share"), *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("documents", "copies", "tokens", "most_copies")], "max_repeats",
        F.greatest(F.lit(0.0), F.round(F.col("target_share") * (F.coalesce("whole", F.lit(0)) if total is None else F.lit(float(total))) - F.coalesce("tokens", F.lit(0)))).cast("bigint").alias("shortfall"),
    )
