"""Queries of the core operators for training data: nested records and intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.operators import intervals, nested
from foliant.session import scratch, table


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return nested.titled_subsections(table(spark, d, "raw_book_records"))


def p3_flat_tables(spark: SparkSession, d: str) -> DataFrame:
    return nested.flatten(table(spark, d, "raw_book_records"), "raw_id", "payload")


def _flat(tag: str):
    def query(spark: SparkSession, d: str) -> DataFrame:
        path = scratch(spark)
        nested.write_tables(p3_flat_tables(spark, d), path)
        return nested.read_tables(spark, path)[tag]

    query.__name__ = "p3_subsection_table" if tag == "subsections" else f"p3_{tag}"
    query.__doc__ = f"The table of {tag}, from the write by tags, with its schema."
    return query


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return intervals.periods_and_gaps(table(spark, d, "embeddings_book_subsections"), ["document_id"], "pdf_start_page", "pdf_end_page")


P4_FOUND = """
with i as (select document_id, pdf_start_page s, case when pdf_end_page is null or pdf_end_page < pdf_start_page then pdf_start_page else pdf_end_page end e
  from embeddings_book_subsections where pdf_start_page is not null),
m as (select *, max(e) over (partition by document_id order by s, e rows between unbounded preceding and 1 preceding) b from i),
g as (select *, sum(case when s <= b + 1 then 0 else 1 end) over (partition by document_id order by s, e rows unbounded preceding) n from m),
p as (select document_id, min(s) s, max(e) e from g group by document_id, n),
q as (select *, lead(s) over (partition by document_id order by s) x from p)
select document_id, 'period' as kind, cast(s as integer) as start_page, cast(e as integer) as end_page from p
union all
select document_id, 'gap', cast(e + 1 as integer), cast(x - 1 as integer) from q where x is not null"""

QUERIES = {f.__name__: f for f in (p3_found, p3_flat_tables, *map(_flat, nested.SCHEMAS), p4_found)}
SQL = {"p4_found": P4_FOUND}
