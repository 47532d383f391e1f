"""Running values over rows in order, in two levels: within bins of a key, and over the bins. A hot key is spread over its bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _before(key: str, bin_: str):
    return Window.partitionBy(key).orderBy(bin_).rowsBetween(Window.unboundedPreceding, -1)


def sums_before(rows: DataFrame, key: str, bin_: str, order: list[str], weight: Column, name: str) -> DataFrame:
    """rows with `name`, the sum of the weights of the rows of its key that come before (bigint). bin_ rises with the order."""
    held = rows.withColumn("_w", weight.cast("bigint"))
    totals = held.groupBy(key, bin_).agg(F.sum("_w").alias("_t"))
    base = totals.select(key, bin_, F.coalesce(F.sum("_t").over(_before(key, bin_)), F.lit(0)).alias("_base"))
    within = F.sum("_w").over(Window.partitionBy(key, bin_).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    return held.join(base, [key, bin_]).withColumn(name, F.col("_base") + F.coalesce(within, F.lit(0))).drop("_w", "_base")


def carried(rows: DataFrame, key: str, bin_: str, order: list[str], columns: list[str], number: str | None = None) -> DataFrame:
    """rows with each of columns as the last row of its key up to it has it that isn't null, and `column_in`, what it was before the row's bin; with `number`, also how many rows of its key come before."""
    place = F.struct(*order)
    totals = rows.groupBy(key, bin_).agg(F.count(F.lit(1)).alias("_rows"), *[F.max_by(c, F.when(F.col(c).isNotNull(), place)).alias(f"_{c}") for c in columns])
    known = totals.select(key, bin_, F.coalesce(F.sum("_rows").over(_before(key, bin_)), F.lit(0)).alias("_base"), *[F.last(f"_{c}", ignorenulls=True).over(_before(key, bin_)).alias(f"{c}_in") for c in columns])
    within = Window.partitionBy(key, bin_).orderBy(*order)
    upto = within.rowsBetween(Window.unboundedPreceding, 0)
    numbers = [(F.col("_base") + F.row_number().over(within) - 1).alias(number)] if number else []
    return rows.join(known, [key, bin_]).select(*[c for c in rows.columns if c not in columns], *[f"{c}_in" for c in columns], *[F.coalesce(F.last(c, ignorenulls=True).over(upto), F.col(f"{c}_in")).alias(c) for c in columns], *numbers)
