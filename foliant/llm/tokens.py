"""Token counts under an existing byte-pair vocabulary, and their totals by source, language and subject."""

from __future__ import annotations

import base64
import functools
import heapq
import os
from collections import Counter

import pandas as pd
import regex
import tiktoken
from pyspark import SparkContext, SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Where the vocabulary of the public tokenizer lies; a parameter of every operator here.
VOCABULARY = os.environ.get("FOLIANT_BPE", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
# Fixed value: the pattern that splits text into pieces before the merges, as the vocabulary requires it.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Distinct pieces whose counts a worker keeps before it starts anew; a bound on memory only.
CACHE_PIECES = 400_000


def ship_vocabulary(path: str) -> None:
    """Give the executors the vocabulary file, once a context: only the driver needs to have it at `path`."""
    sc = SparkContext._active_spark_context
    sent = sc.__dict__.setdefault("_foliant_vocabularies", set()) if sc else None
    if sent is not None and path not in sent:
        sc.addFile(path)
        sent.add(path)


def _at_hand(path: str) -> str:
    """Where this process has the file: as it was sent, else at the path itself."""
    try:
        sent = SparkFiles.get(os.path.basename(path))
    except Exception:  # outside of any context
        return path
    return sent if os.path.isfile(sent) else path


@functools.lru_cache(maxsize=4)
def ranks(path: str) -> dict[bytes, int]:
    with open(_at_hand(path), "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


@functools.lru_cache(maxsize=4)
def encoding(path: str) -> tiktoken.Encoding:
    """The compiled encoder of the vocabulary: the same counts as count_symbols()."""
    return tiktoken.Encoding("own", pat_str=PIECES, mergeable_ranks=ranks(path), special_tokens={})


def count_symbols(piece: bytes, rank: dict[bytes, int]) -> int:
    """Tokens of one piece: its symbols are a linked list, possible merges a priority queue by rank, then place.

    A queue entry names the two symbols it joins by their ends; it is stale when either has since been merged.
    """
    if piece in rank:
        return 1
    n = len(piece)
    end = list(range(1, n + 1))  # of the symbol that begins here; 0 once it is merged away
    before = list(range(-1, n - 1))
    queue = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := rank.get(piece[i : i + 2])) is not None]
    heapq.heapify(queue)
    left = n
    while queue:
        _, i, mid, stop = heapq.heappop(queue)
        if end[i] != mid or end[mid] != stop:
            continue
        end[i], end[mid] = stop, 0
        left -= 1
        if stop < n:
            before[stop] = i
            if (r := rank.get(piece[i : end[stop]])) is not None:
                heapq.heappush(queue, (r, i, stop, end[stop]))
        if (j := before[i]) >= 0 and (r := rank.get(piece[j:stop])) is not None:
            heapq.heappush(queue, (r, j, i, stop))
    return left


class PieceCounter:
    """Counts of texts; every distinct piece is merged once and weighted by how often it occurs."""

    def __init__(self, path: str):
        self.rank, self.cache, self.find = ranks(path), {}, regex.compile(PIECES).findall

    def __call__(self, text: str | None) -> int | None:
        if text is None:
            return None
        cache, total = self.cache, 0
        if len(cache) > CACHE_PIECES:
            cache.clear()
        for piece, times in Counter(self.find(text)).items():
            n = cache.get(piece)
            if n is None:
                n = count_symbols(piece.encode("utf-8", "surrogatepass"), self.rank)
                if len(piece) < 100:
                    cache[piece] = n
            total += n * times
        return total


@functools.lru_cache(maxsize=4)
def counter(path: str) -> PieceCounter:
    return PieceCounter(path)


def encoded_count(text: Column, path: str = VOCABULARY) -> Column:
    """As token_count, by the compiled encoder, for operators that only need the number."""
    ship_vocabulary(path)

    @F.pandas_udf("bigint")
    def count(texts: pd.Series) -> pd.Series:
        encode = encoding(path).encode_ordinary
        return pd.Series([None if t is None else len(encode(t)) for t in texts], dtype="Int64")

    return count(text)


def token_count(text: Column, path: str = VOCABULARY) -> Column:
    """Tokens of a text (bigint): null for null, 0 for the empty text."""
    ship_vocabulary(path)

    @F.pandas_udf("bigint")
    def count(texts: pd.Series) -> pd.Series:
        one = counter(path)
        return pd.Series([one(t) for t in texts], dtype="Int64")

    return count(text)


def token_budget(df: DataFrame, text: str, by: dict[str, Column], path: str = VOCABULARY) -> DataFrame:
    """(by..., items, blank_items, tokens): exact token totals of the slices that `by` names.

    A null text counts as an item without tokens; repeated rows count each; an empty table gives no rows. `by` may
    use any columns of df. Partial sums are made before the shuffle, which carries one row a slice and task.
    """
    rows = df.select(*[c.alias(f"_by{n}") for n, c in enumerate(by.values())], token_count(F.col(f"`{text}`"), path).alias("_tokens"))
    totals = rows.groupBy(*[f"_by{n}" for n in range(len(by))]).agg(
        F.count(F.lit(1)).alias("items"), F.count_if(F.coalesce("_tokens", F.lit(0)) == 0).alias("blank_items"), F.coalesce(F.sum("_tokens"), F.lit(0)).alias("tokens")
    )
    return totals.select(*[F.col(f"_by{n}").alias(k) for n, k in enumerate(by)], "items", "blank_items", "tokens")
