"""Embeddings in Arrow batches through a provider; the offline default hashes tokens."""

from __future__ import annotations

import hashlib
import random
import re
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.functions import text as X
from foliant.session import ship

#: Texts a call, tokens of a text at most, tries of a call.
BATCH, LONGEST, TRIES = 64, 8192, 6


_TOKENS = re.compile(r"[^\W\d_]+|\d{1,3}|[^\w\s]+|_+")


class Embedder(Protocol):
    name: str
    dimensions: int

    def __call__(self, texts: list[str]) -> list[list[float]]: ...


class HashEmbedder:
    """Signed hashed counts of words, of length 1: the same everywhere and at every time, without a model."""

    name = "hash"

    def __init__(self, dimensions: int = 64):
        self.dimensions = dimensions

    def __call__(self, texts: list[str]) -> list[list[float]]:
        out = []
        for t in texts:
            v = np.zeros(self.dimensions)
            for w in re.findall(r"[\wऀ-ॣ]+", t.lower()):
                h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "big")
                v[h % self.dimensions] += 1 if h >> 63 else -1
            n = np.linalg.norm(v)
            out.append((v / n if n else v).tolist())
        return out


def retried(call: Callable[[list[str]], list[list[float]]], texts: list[str], tries: int = TRIES, wait: float = 1.0) -> list[list[float]]:
    """The call's result, after up to `tries` tries with growing random waits, at most 30 seconds each."""
    for n in range(tries):
        try:
            return call(texts)
        except (ConnectionError, TimeoutError):
            if n == tries - 1:
                raise
            time.sleep(min(30.0, wait * 2**n) * random.random())
    return []


def embed(df: DataFrame, key: str, text: str, embedder: Embedder, too_long: str = "error") -> DataFrame:
    """(key, embedding_model, embedding_dimensions, embedding, embedding_input_hash, token_count, text_was_truncated) of each text that isn't blank.

    Each row of df gives one row, whatever its key: repeated keys are embedded each, a null key stays null. A vector of
    another length than the embedder's is an error, and so is a text of more than LONGEST tokens, unless too_long is
    "cut": then its first tokens are embedded. Null and blank texts give no row.
    """
    ship(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), BATCH):
                part = batch.iloc[at : at + BATCH]
                texts = [fitted(t) for t in part["t"]]
                if too_long == "error" and any(cut for _, _, cut in texts):
                    raise ValueError(f"a text has more than {LONGEST} tokens")
                found = retried(embedder, [t for t, _, _ in texts])
                if len(found) != len(part) or any(len(v) != embedder.dimensions for v in found):
                    raise ValueError("a vector has the wrong length, or there are not as many as texts")
                hashes = [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in part["t"]]
                yield pd.DataFrame({"k": part["k"].to_numpy(), "embedding": found, "h": hashes, "n": [n for _, n, _ in texts], "c": [c for _, _, c in texts]})

    rows = df.where(F.trim(F.col(text)) != "").select(F.col(key).alias("k"), F.col(text).alias("t"))
    out = rows.mapInPandas(vectors, f"k {kind}, embedding array<float>, h string, n int, c boolean")
    return out.select(F.col("k").alias(key), F.lit(embedder.name).alias("embedding_model"), F.lit(embedder.dimensions).alias("embedding_dimensions"), "embedding", F.col("h").alias("embedding_input_hash"), F.col("n").alias("token_count"), F.col("c").alias("text_was_truncated"))


SUBSECTION_LABELS = {"School": "school_name", "Class": "class_name", "Book": "book_title", "Subject": "subject", "Chapter": "chapter_title", "Unit": "unit_title", "Lesson": "lesson_title", "Section": "section_title", "Subsection": "subsection_title"}


def subsection_inputs(subsections: DataFrame, books: DataFrame, text: str = "text") -> DataFrame:
    """(id, document_id, content_for_embedding) of every subsection with a text, whatever include_in_embeddings says: any of them may be asked for."""
    b = books.select(F.col("id").alias("document_id"), "school_name", "class_name", "book_title", "subject")
    rows = subsections.where(F.trim(F.col(text)) != "").drop("school_name", "class_name", "book_title", "subject").join(b, "document_id", "left")
    labels = {k: F.col(c) for k, c in SUBSECTION_LABELS.items() if c in rows.columns}
    return rows.select("id", "document_id", X.embedding_input(labels | {"Pages": F.concat_ws("-", "pdf_start_page", "pdf_end_page")}, F.col(text)).alias("content_for_embedding"))


def embed_query(text: str, embedder: Embedder) -> list[float]:
    if not text.strip():
        raise ValueError("the query is blank")
    return retried(embedder, [text])[0]


def fitted(text: str, limit: int = LONGEST) -> tuple[str, int, bool]:
    """(text, tokens, whether it was cut): a text cut to its first tokens."""
    at = [m.end() for m in _TOKENS.finditer(text)]
    return (text, len(at), False) if len(at) <= limit else (text[: at[limit - 1]], limit, True)


def of_model(vectors: DataFrame, embedder: Embedder) -> DataFrame:
    """The vectors that a query of this embedder may be compared with; an error where there are vectors but none of them."""
    own = vectors.where((F.col("embedding_model") == embedder.name) & (F.col("embedding_dimensions") == embedder.dimensions))
    if own.isEmpty() and not vectors.isEmpty():
        found = [r[0] for r in vectors.select("embedding_model").distinct().limit(10).collect()]
        raise ValueError(f"no vectors of {embedder.name} with {embedder.dimensions} dimensions; there are those of {', '.join(map(str, found))}")
    return own
