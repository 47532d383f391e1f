"""Table semantics on plain DataFrames: latest states, upserts, cascading deletes, duplicates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row a key, the last by `order`; a hash aggregate with partial maxima, so hot keys shrink before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")).select(*[c if c in keys else F.col("_last")[c].alias(c) for c in df.columns])


def keep_first(df: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """One row a key, the first by `order`."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def upsert(target: DataFrame, source: DataFrame, keys: list[str], keep: list[str] | None = None) -> DataFrame:
    """The target after insert-or-update by key. `keep` names columns that a matched row keeps; null keys never match.

    One full join; the source must hold a key once. Write the result to a new version, never over what is read.
    """
    kept = set(keep or [])
    t, s = target.withColumn("_t", F.lit(True)).alias("t"), source.withColumn("_s", F.lit(True)).alias("s")
    on = reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys])
    pick = [F.when(F.col("_t") & F.col("_s"), F.col(f"t.{c}") if c in kept else F.col(f"s.{c}")).when(F.col("_s"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) if c in source.columns else F.col(f"t.{c}").alias(c) for c in target.columns]
    return t.join(s, on, "full").select(*pick)


def delete_cascade(deleted: DataFrame, children: dict[str, DataFrame], key: str = "document_id", set_null: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """The children without the rows of deleted parents; the tables of `set_null` keep them with a null parent."""
    ids = deleted.select(F.col("id").alias("_gone")).where(F.col("_gone").isNotNull()).distinct()
    out = {}
    for name, df in children.items():
        if name in set_null:
            out[name] = df.join(ids, df[key] == ids["_gone"], "left").withColumn(key, F.when(F.col("_gone").isNull(), F.col(key))).drop("_gone")
        else:
            out[name] = df.join(ids, df[key] == ids["_gone"], "left_anti")
    return out


def replace_children(target: DataFrame, source: DataFrame, key: str = "document_id", parents: DataFrame | None = None) -> DataFrame:
    """The target with all rows of the parents replaced by those of the source. parents (key) names them, by default
    those that the source has rows of; a named parent without rows in the source loses all of its own."""
    ids = (source if parents is None else parents).select(key).distinct()
    return target.join(ids, key, "left_anti").select(*target.columns).unionByName(source.select(*target.columns))


def backfill(df: DataFrame, column: str, *others: str) -> DataFrame:
    """A column filled from the first of others that isn't blank."""
    return df.withColumn(column, F.coalesce(*[F.nullif(F.trim(F.col(c)), F.lit("")) for c in (column, *others)]))


def with_defaults(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Nulls of the columns that are named become their values, as they are to be written."""
    return df.select(*[F.coalesce(F.col(c), F.lit(values[c])).alias(c) if c in values else F.col(c) for c in df.columns])


def duplicates(df: DataFrame, keys: list[Column]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def run_states(runs: DataFrame) -> DataFrame:
    """The newest event of each run: exact repeats count once, a finished state beats an unfinished one."""
    return latest(runs.distinct(), ["id"], [F.coalesce("finished_at", "started_at"), F.col("status")])
