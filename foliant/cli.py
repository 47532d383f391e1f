"""Command line: ingest, search, lookups, checks and export over a folder of tables. Results are lines of JSON."""

from __future__ import annotations

import argparse
import fnmatch
import json
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant import ingest
from foliant.functions import text as X
from foliant.operators import embedding, export, lookup, search, validate, validate_json
from foliant.session import ship, written
from foliant.sources import files, json_books
from foliant.store import Store

#: Reader modules for page texts, tried in this order.
READERS = ["fitz", "pypdf"]


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="foliant")
    p.add_argument("tables", help="folder of the Parquet tables")
    p.add_argument("--dimensions", type=int, default=int(os.environ.get("FOLIANT_DIMENSIONS", "64")), help="of the offline embedder")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("init-db", help="make the tables that aren't there")
    sub.add_parser("drop-db", help="delete all tables").add_argument("--yes", action="store_true", required=True)
    for name in ("ingest", "ingest-folder", "ingest-json"):
        i = sub.add_parser(name)
        i.add_argument("source", help="a file or a folder")
        for m in ingest.METADATA:
            i.add_argument("--" + m.replace("_", "-"))
        i.add_argument("--reindex", action="store_true", help="take in again what is there")
        i.add_argument("--dry-run", action="store_true", help="write no tables")
        i.add_argument("--validate-only", action="store_true", help="look at the arguments and files alone")
        i.add_argument("--export-json", metavar="FOLDER")
        if name != "ingest-json":
            i.add_argument("--glob", default="*.[pP][dD][fF]")
            i.add_argument("--reader", action="append", help="module that reads pages; may be given several times")
    s = sub.add_parser("search")
    s.add_argument("query")
    s.add_argument("--top-k", type=int, default=8)
    for name in [*search.EXACT, *search.WITHIN]:
        s.add_argument("--" + name.replace("_", "-"))
    for name in ("chapter-text", "list-subsections", "subsection-text", "summary"):
        one = sub.add_parser(name)
        one.add_argument("--document-id")
        one.add_argument("--document-key")
        for f in lookup.NUMBERS + lookup.TITLES if name != "summary" else []:
            if name == "subsection-text" or not f.startswith("subsection"):
                one.add_argument("--" + f.replace("_", "-"))
    sub.add_parser("validate", help="check the tables")
    v = sub.add_parser("validate-json", help="check book files")
    v.add_argument("source")
    v.add_argument("--layout", choices=sorted(validate_json.ERRORS), default="chapters")
    v.add_argument("--expect", action="append", default=[], metavar="NAME=VALUE")
    e = sub.add_parser("export")
    e.add_argument("folder")
    return p


def _print(rows: DataFrame) -> int:
    """Every row, one after the other; how many there were."""
    n = 0
    for r in rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).toLocalIterator():
        print(r[0])
        n += 1
    return n


def _ingest(a: argparse.Namespace, store: Store, embedder: embedding.Embedder) -> int:
    if not os.path.exists(a.source) and "://" not in a.source:
        raise ValueError(f"there is no {a.source}")
    if os.path.isfile(a.source) and not fnmatch.fnmatch(a.source, "*.json" if a.command == "ingest-json" else a.glob):
        raise ValueError(f"{a.source} is not a file of this kind")
    given = {m: v for m in ingest.METADATA if (v := getattr(a, m))}
    o = ingest.Options(given, a.reindex, a.dry_run or a.validate_only, None if a.validate_only else a.export_json)
    if a.command == "ingest-json":
        if a.validate_only:
            found = validate_json.violations(json_books.read_files(store.spark, a.source), "file_name", "payload").where("rule in ('not_json', 'no_section_index')")
            return int(_print(found) > 0)
        report = ingest.ingest_json(store, a.source, embedder, o)
    else:
        if a.validate_only:
            return int(_print(files.listing(store.spark, a.source, a.glob)) == 0)
        readers = [(m, files.reader_of(m)) for m in a.reader or READERS]
        report = ingest.ingest_files(store, a.source, readers, embedder, o, a.glob)
    _print(report)
    return int(not report.where("status = 'failed'").isEmpty())


def _run(a: argparse.Namespace, spark: SparkSession) -> int:
    store, embedder = Store(spark, a.tables), embedding.HashEmbedder(a.dimensions)
    if a.command == "init-db":
        print(json.dumps({"made": store.init()}))
    elif a.command == "drop-db":
        store.drop()
    elif a.command.startswith("ingest"):
        return _ingest(a, store, embedder)
    elif a.command == "search":
        filters = {n: getattr(a, n) for n in [*search.EXACT, *search.WITHIN]}
        b = store.read("documents").select(F.col("id").alias("document_id"), "school_name", "class_name", "grade", "board", "subject", "book_title", "language")
        vectors = embedding.of_model(store.read("vectors"), embedder)
        found = search.hybrid(store.read("chunks").join(b, "document_id"), vectors, a.query, embedding.embed_query(a.query, embedder), a.top_k, filters, attributes=search.ATTRIBUTES)
        _print(found.select(F.round("final_score", 4).alias("score"), "chunk_id", "source_label", F.substring(X.squeeze(F.col("content")), 1, 260).alias("preview"), X.citation(F.col("book_title"), F.col("page_start"), F.col("page_end")).alias("citation")))
    elif a.command == "validate":
        found = validate.violations(*[store.read(n) for n in ("documents", "pages", "book_chapters", "book_subsections", "chunks", "vectors")])
        return int(_print(validate.summary(found).orderBy("rule")) > 0)
    elif a.command == "validate-json":
        want = dict(x.split("=", 1) for x in a.expect)
        found = validate_json.violations(json_books.read_files(spark, a.source), "file_name", "payload", a.layout, {k: int(v) if v.isdigit() else v for k, v in want.items()})
        _print(found)
        return int(not found.where("severity = 'error'").isEmpty())
    elif a.command == "export":
        from foliant.operators import chunking

        books, pages = store.read("documents"), store.read("pages")
        export.write(export.combined(books, pages, store.read("book_chapters"), store.read("book_subsections"), store.read("chunks"), chunking.profiles(pages, books)), a.folder)
    else:
        books = lambda: store.read("documents")
        if a.command == "summary":
            rows = lookup.of_document(books(), a.document_id, a.document_key)
            for n in ("pages", "book_chapters", "book_subsections", "chunks", "vectors"):
                rows = rows.join(store.read(n).groupBy("document_id").agg(F.count(F.lit(1)).alias(f"n_{n}")), "document_id", "left")
            return int(_print(rows.na.fill(0)) == 0)
        filters = {f: v for f in lookup.NUMBERS + lookup.TITLES if (v := getattr(a, f, None))}
        if a.command == "chapter-text":
            if store.exists("raw_text_pages"):
                raw = store.read("raw_text_pages")
            else:
                raw = lookup.raw_text_pages(store.read("pages"), store.read("book_chapters"), store.read("chunks"))
            rows = lookup.chapter_text(raw, books(), a.document_id, a.document_key, **filters)
        elif a.command == "list-subsections":
            rows = lookup.list_subsections(store.read("book_subsections"), books(), a.document_id, a.document_key, **filters)
        else:
            rows = lookup.subsection_text(store.read("book_subsections"), store.read("pages"), books(), a.document_id, a.document_key, **filters)
        _print(rows)
    return 0


def main(argv: list[str] | None = None) -> int:
    """Exit codes: 0 done, 1 violations, failed files or nothing found, 2 wrong arguments."""
    a = _parser().parse_args(argv)
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    ship(spark)
    with written():
        try:
            return _run(a, spark)
        except ValueError as e:
            print(f"foliant: {e}", file=sys.stderr)
            return 2


if __name__ == "__main__":
    raise SystemExit(main())
