"""Vector, keyword and hybrid search over chunks; structural lookups."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce
from operator import and_, or_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.functions.text import WORD_CHARACTER

#: Columns that a filter compares for equality, and titles it looks into.
EXACT = ["document_id", "chunk_type", "subject", "school_name", "grade", "class_name", "language", "board", "book_title"]
WITHIN = ["chapter_title", "unit_title", "section_title", "subsection_title"]
#: Weights of the parts of the final score, and of a metadata filter that a row meets. Fixed values.
VECTOR, KEYWORD, METADATA = 0.70, 0.20, 0.10
SCORES = {"school_name": 0.25, "book_title": 0.20, "subject": 0.25, "grade": 0.20, "class_name": 0.20, "language": 0.20}
TERM, KIND = 0.20, 0.15
KINDS = ["definition", "explanation", "example", "activity", "grammar_rule", "worked_example"]
#: Weights of a hit by field class, the class of each field a chunk may have, and the attributes of its book that a query may match.
CLASS_WEIGHTS = {"A": 1.0, "B": 0.4, "C": 0.2, "D": 0.1}
FIELDS = {"chapter_title": "A", "unit_title": "A", "lesson_title": "A", "section_title": "A", "subsection_title": "A", "topic": "B", "content": "C"}
ATTRIBUTES = ["school_name", "class_name", "book_title", "subject", "grade", "board", "language"]


def condition(filters: dict[str, str | None], columns: list[str]) -> Column:
    """All filters that hold a value, on the columns that exist; title filters match within, in any case, `%` and `_` as wildcards."""
    out = F.lit(True)
    for name, value in filters.items():
        if value and name in columns:
            out = out & (F.col(name).ilike(f"%{value}%") if name in WITHIN else F.col(name) == value)
    return out


def cosine(vector: Column, query: list[float]) -> Column:
    """Cosine similarity in double, at least 0; null for a vector of another length, of no length, or not all of numbers. A batch of vectors is one matrix product."""
    q = np.asarray(query, dtype=np.float64)
    norm = float(np.linalg.norm(q))

    @F.pandas_udf(T.DoubleType())
    def score(vectors: pd.Series) -> pd.Series:
        out = np.full(len(vectors), np.nan)
        fit = np.array([v is not None and len(v) == len(q) for v in vectors], dtype=bool)
        if fit.any() and norm > 0:
            x = np.stack([np.asarray(v, dtype=np.float64) for v in vectors[fit]])
            with np.errstate(all="ignore"):
                out[fit] = np.maximum(0.0, (x @ q) / (np.linalg.norm(x, axis=1) * norm))
        return pd.Series([None if np.isnan(s) else s for s in out], dtype="Float64")

    # Named once in a plan: else a filter on the score would have it worked out twice.
    return score.asNondeterministic()(vector)


def vector_top(chunks: DataFrame, vectors: DataFrame, query: list[float], limit: int, filters: dict | None = None) -> DataFrame:
    """(chunk_id, vector_score): the nearest chunks. Filters go below the limit; ties by chunk_id.

    vectors are of one model; of several usable rows of a chunk, those of the query's length, the newest counts.
    """
    if "created_at" in vectors.columns:
        fit = (F.size("embedding") == len(query)) & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x)) & F.exists("embedding", lambda x: x != 0)
        vectors = vectors.where(fit).groupBy("chunk_id").agg(F.max_by("embedding", F.struct("created_at", "embedding")).alias("embedding"))
    rows = chunks.where(condition(filters or {}, chunks.columns)).select(F.col("id").alias("chunk_id"))
    scored = vectors.select("chunk_id", cosine(F.col("embedding"), query).alias("vector_score")).where(F.col("vector_score").isNotNull() & ~F.isnan("vector_score"))
    return scored.join(rows, "chunk_id").orderBy(F.desc("vector_score"), "chunk_id").limit(limit)


def lexemes(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"(?:{WORD_CHARACTER}|\\p{{M}})+"), F.lit(0))


@dataclass(frozen=True)
class Query:
    """A web search query: any of groups of all of phrases, none of others. A phrase is its words in order."""

    groups: list[list[list[str]]]
    negative: list[list[str]] = field(default_factory=list)

    @property
    def positive(self) -> list[list[str]]:
        return [p for g in self.groups for p in g]


def parse_query(text: str) -> Query:
    """Words are all wanted; "quoted words" in order; `or` between alternatives; a leading minus excludes."""
    groups: list[list[list[str]]] = [[]]
    negative: list[list[str]] = []
    for minus, quoted, plain in re.findall(r'(-?)(?:"([^"]*)"|(\S+))', text):
        if not minus and plain.lower() == "or":
            if groups[-1]:
                groups.append([])
            continue
        words = re.findall(r"[\wऀ-ॣ]+", (quoted or plain).lower())
        if words:
            (negative if minus else groups[-1]).append(words)
    return Query([g for g in groups if g], negative)


def _hits(tokens: list[str], phrase: list[str]) -> list[int]:
    n = len(phrase)
    return [i for i, t in enumerate(tokens) if t == phrase[0] and list(tokens[i : i + n]) == phrase]


def cover_density(tokens: list[str], weights: list[float], query: Query) -> float | None:
    """The rank of a text, null when it doesn't match: each shortest cover of a group adds the harmonic mean of the
    weights of its hits, divided by the words within it that are no hit, plus one."""
    if any(_hits(tokens, p) for p in query.negative):
        return None
    rank, matched = 0.0, False
    for group in query.groups:
        at = [_hits(tokens, p) for p in group]
        if not all(at):
            continue
        matched = True
        events = sorted((i, n) for n, places in enumerate(at) for i in places)
        last: dict[int, int] = {}
        ended = -1
        for i, n in events:
            last[n] = i
            if len(last) == len(group):
                start = min(last.values())
                if start > ended:
                    spots = sorted({j for m, j in last.items() for j in range(j, j + len(group[m]))})
                    stop = max(spots)
                    noise = (stop - start + 1) - len(spots)
                    rank += len(spots) / sum(1 / weights[j] for j in spots) / (1 + noise)
                    ended = start
                    last = {m: j for m, j in last.items() if j > start}
    return rank if matched else None


def _lexed(fields: dict[str, str]) -> Column:
    """array of one struct(t, w): the lexemes of all fields in order, and the weight of each."""
    each = F.array(F.struct(*[lexemes(F.col(c)).alias(c) for c in fields]))
    return F.transform(each, lambda x: F.struct(F.concat(*[x[c] for c in fields]).alias("t"), F.concat(*[F.array_repeat(F.lit(CLASS_WEIGHTS[w]), F.size(x[c])) for c, w in fields.items()]).alias("w")))


def lexeme_table(chunks: DataFrame, fields: dict[str, str]) -> DataFrame:
    """chunks with t, their lexemes in order, and w, the weight of each: to be stored when chunks are written, and searched instead of them."""
    return chunks.select("*", F.explode(_lexed(fields)).alias("_x")).select(*chunks.columns, "_x.t", "_x.w")


def fields_of(columns: list[str]) -> dict[str, str]:
    return {c: w for c, w in FIELDS.items() if c in columns}


def keyword_top(chunks: DataFrame, query: str, limit: int, fields: dict[str, str], filters: dict | None = None, attributes: list[str] | None = None) -> DataFrame:
    """(chunk_id, keyword_score): chunks by cover density over `fields` (column to class A to D), ties by chunk_id.

    A chunk that doesn't match itself, but by `attributes`, columns of its book, has the score 0. A chunk without any of the wanted words is left out JVM-side; Python ranks the rest in Arrow batches. Chunks that
    come from lexeme_table() are not taken apart again.
    """
    q = parse_query(query)
    if not q.groups:
        return chunks.select(F.col("id").alias("chunk_id"), F.lit(0.0).alias("keyword_score")).limit(0)
    any_group = lambda has: reduce(or_, [reduce(and_, [has(w) for p in g for w in p]) for g in q.groups])

    def score(t: list[str], w: list[float], a: list[str]) -> float | None:
        own = cover_density(t, w, q)
        return 0.0 if own is None and len(a) and cover_density(a, [1.0] * len(a), q) is not None else own

    @F.pandas_udf(T.DoubleType())
    def rank(ts: pd.Series, ws: pd.Series, attrs: pd.Series) -> pd.Series:
        return pd.Series([score(list(t), list(w), list(a)) for t, w, a in zip(ts, ws, attrs, strict=True)], dtype="float64")

    rows = chunks.where(condition(filters or {}, chunks.columns))
    about = F.concat_ws(" ", *attributes) if attributes else F.lit("")
    of_book = lexemes(about) if attributes else F.expr("cast(array() as array<string>)")
    if {"t", "w"} <= set(chunks.columns):
        lexed = F.array(F.struct("t", "w"))  # as lexeme_table() stores them
    else:
        # Most texts lack the words even as parts of others, and are not taken apart at all.
        text = F.lower(F.concat_ws(" ", *fields))
        in_book = any_group(lambda w: F.contains(F.lower(about), F.lit(w))) if attributes else F.lit(False)
        rows, lexed = rows.where(any_group(lambda w: F.contains(text, F.lit(w))) | in_book), _lexed(fields)
    all_ = F.transform(lexed, lambda x: F.struct(x["t"].alias("t"), x["w"].alias("w"), of_book.alias("a")))
    rows = rows.select("id", F.explode(F.filter(all_, lambda x: any_group(lambda w: F.array_contains(x["t"], w)) | any_group(lambda w: F.array_contains(x["a"], w)))).alias("x"))
    ranked = rows.select(F.col("id").alias("chunk_id"), rank.asNondeterministic()("x.t", "x.w", "x.a").alias("keyword_score"))
    return ranked.where(F.col("keyword_score").isNotNull() & ~F.isnan("keyword_score")).orderBy(F.desc("keyword_score"), "chunk_id").limit(limit)


def merge_scores(vector: DataFrame, keyword: DataFrame) -> DataFrame:
    """(chunk_id, vector_score, keyword_score): candidates of either side, the other's score 0."""
    both = vector.select("chunk_id", "vector_score", F.lit(0.0).alias("keyword_score")).unionByName(keyword.select("chunk_id", F.lit(0.0).alias("vector_score"), "keyword_score"))
    return both.groupBy("chunk_id").agg(F.max("vector_score").alias("vector_score"), F.max("keyword_score").alias("keyword_score"))


def metadata_score(columns: list[str], query: str, filters: dict[str, str | None]) -> Column:
    """What a row's attributes add, at most 1."""
    parts = [F.when(F.col(c) == filters[c], w).otherwise(0.0) for c, w in SCORES.items() if filters.get(c) and c in columns]
    terms = sorted({t.lower() for t in re.findall("[A-Za-zऀ-ॿ]{3,}", query)})
    text = F.lower(F.concat_ws(" ", *[F.col(c) for c in ("school_name", "book_title", "topic", "chapter_title", "section_title", "subsection_title", "chunk_type") if c in columns]))
    hit = F.lit(False)
    for t in terms:
        hit = hit | F.contains(text, F.lit(t))
    parts += [F.when(hit, TERM).otherwise(0.0), F.when(F.col("chunk_type").isin(KINDS), KIND).otherwise(0.0)]
    return F.least(F.lit(1.0), sum(parts, F.lit(0.0)))


def hybrid(chunks: DataFrame, vectors: DataFrame, query: str, query_vector: list[float], top_k: int = 8, filters: dict | None = None, fields: dict[str, str] | None = None, attributes: list[str] | None = None) -> DataFrame:
    """The best chunks by the weighted sum of their scores. chunks holds the attributes of their books as columns; fields are by default those of FIELDS that it has."""
    filters = {k: v for k, v in (filters or {}).items() if v}
    fields = fields or fields_of(chunks.columns)
    found = merge_scores(vector_top(chunks, vectors, query_vector, max(3 * top_k, top_k), filters), keyword_top(chunks, query, max(3 * top_k, top_k), fields, filters, attributes))
    # At most 6 * top_k candidates: small by construction.
    rows = chunks.join(F.broadcast(found), chunks["id"] == found["chunk_id"])
    scored = rows.withColumn("metadata_score", metadata_score(chunks.columns, query, filters))
    final = VECTOR * F.col("vector_score") + KEYWORD * F.col("keyword_score") + METADATA * F.col("metadata_score")
    return scored.withColumn("final_score", final).orderBy(F.desc("final_score"), "chunk_id").limit(top_k)
