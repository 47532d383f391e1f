"""Evaluation passages that stand, wholly or partly, in training texts.

A passage counts as leaked when at least half of its words stand in the text in runs of six or more consecutive words.
Such a text need not be near the passage as a whole: the other half, and everything between the runs, is free. So
no fingerprint of the whole can find it (the README has figures), and the index holds all shingles of six words of the
passages: every leaked run holds one of them unaltered, and no pair can be missed.
"""

from __future__ import annotations

import functools
import re
import sys
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of a run that counts, and of a shingle.
RUN = 6
#: Items whose shingles are held at once; more are worked off in blocks of this size.
BLOCK_ITEMS = 20_000
#: Distinct words whose hashes a worker keeps; a bound on memory only.
CACHE_WORDS = 400_000
#: Odd, so that no word's bits are lost when a shingle's hash is summed up.
FACTOR = 0x9E3779B97F4A7C15

_BROKEN_LINE = re.compile(r"(?<=\S)[-‐‑\xad¬][^\S\n]*\r?\n\s*(?=\w)")
_INNER = re.compile("[-‐‑\xad¬'’‘ʼ\u200c\u200d\ufeff\u200b]+")
_DIGITS = re.compile(r"(?![0-9])\d")


@functools.cache
def _words() -> re.Pattern:
    """Letters, digits and every combining mark."""
    spans: list[list[int]] = []
    for c in range(sys.maxunicode + 1):
        if unicodedata.category(chr(c))[0] == "M":
            if spans and spans[-1][1] == c - 1:
                spans[-1][1] = c
            else:
                spans.append([c, c])
    return re.compile("[\\w" + "".join(f"{chr(a)}-{chr(b)}" for a, b in spans) + "]+")


def words(text: str) -> list[str]:
    """Words of a text, without regard to case, punctuation, spacing, line breaks, hyphens, digits' script and composition."""
    if not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    text = _INNER.sub("", _BROKEN_LINE.sub("", text))
    if not text.isascii():
        text = _DIGITS.sub(lambda m: str(unicodedata.decimal(m.group())), text)
    return _words().findall(text.replace("_", " ").lower())


class Hashes:
    """64-bit hashes of all runs of RUN words of a text: a sum of the words' hashes with powers of FACTOR."""

    def __init__(self) -> None:
        self.of: dict[str, int] = {}
        self.factors = [np.uint64(pow(FACTOR, k, 1 << 64)) for k in range(RUN)]

    def shingles(self, text_words: list[str]) -> np.ndarray:
        n = len(text_words) - RUN + 1
        if n < 1:
            return np.zeros(0, dtype=np.uint64)
        if len(self.of) > CACHE_WORDS:
            self.of = {}
        of = self.of
        for w in set(text_words).difference(of):
            of[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
        h = np.fromiter(map(of.__getitem__, text_words), dtype=np.uint64, count=len(text_words))
        total = h[:n] * self.factors[0]
        for k in range(1, RUN):
            total += h[k : k + n] * self.factors[k]
        return total


class Items:
    """Passages with the hashes of their shingles, sorted; passages of under RUN words hold none."""

    def __init__(self, items: list[tuple[int, str]]):
        self.hashes = Hashes()
        self.items = [(i, w) for i, p in items if len(w := words(p)) >= RUN]
        found = [self.hashes.shingles(w) for _, w in self.items]
        keys = np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)
        owner = np.concatenate([np.full(len(f), n) for n, f in enumerate(found)]) if found else np.zeros(0, dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.owner = keys[order], owner[order]
        # A table of the low 16 bits rules out most shingles of a text before the search.
        self.seen = np.zeros(1 << 16, dtype=bool)
        self.seen[(keys & np.uint64(0xFFFF)).astype(np.int64)] = True
        self.shingles: list[dict[tuple, list[int]]] = []
        for _, w in self.items:
            at: dict[tuple, list[int]] = defaultdict(list)
            for k in range(len(w) - RUN + 1):
                at[tuple(w[k : k + RUN])].append(k)
            self.shingles.append(dict(at))

    def candidates(self, text_words: list[str]) -> dict[int, list[int]]:
        """Places of a text at which a shingle of an item stands, by the item's number; equal hashes are still to be compared."""
        h = self.hashes.shingles(text_words)
        near = np.flatnonzero(self.seen[(h & np.uint64(0xFFFF)).astype(np.int64)])
        low, high = np.searchsorted(self.keys, h[near], "left"), np.searchsorted(self.keys, h[near], "right")
        out: dict[int, list[int]] = defaultdict(list)
        for place, a, b in zip(near[high > low].tolist(), low[high > low].tolist(), high[high > low].tolist(), strict=True):
            for o in set(self.owner[a:b].tolist()):
                out[o].append(place)
        return out

    def matches(self, text: str, share: float) -> list[tuple[int, int, int, float]]:
        """(item, covered words, words of the passage, share) of the items of which the text holds that share in runs."""
        w = words(text)
        out = []
        for o, places in self.candidates(w).items():
            item, passage = self.items[o]
            covered = np.zeros(len(passage), dtype=bool)
            for k in places:
                for at in self.shingles[o].get(tuple(w[k : k + RUN]), ()):
                    covered[at : at + RUN] = True
            n = int(covered.sum())
            if n >= share * len(passage) and n:
                out.append((item, n, len(passage), n / len(passage)))
        return out


def find_leaks(docs: DataFrame, doc_key: str, text: str, items: DataFrame, item_key: str, passage: str, share: float = 0.5) -> DataFrame:
    """(doc_key, item_key, covered_words, passage_words, share) of each text that holds at least `share` of a passage.

    Null and empty texts or passages, and passages of under six words, match nothing. Repeated rows of a text each
    give their rows, repeated items one. The items are sent to the workers, in blocks of BLOCK_ITEMS; each block
    reads the texts once and nothing is shuffled. Other columns are ignored.
    """
    item_rows = items.where(F.col(f"`{passage}`").isNotNull()).select(F.col(f"`{item_key}`").cast("bigint").alias("i"), F.col(f"`{passage}`").alias("p")).distinct()
    n_blocks = max(1, -(-item_rows.count() // BLOCK_ITEMS))
    sc = docs.sparkSession.sparkContext
    texts = docs.where(F.length(F.col(f"`{text}`")) > 0).select(F.col(f"`{doc_key}`").cast("bigint").alias("d"), F.col(f"`{text}`").alias("t"))
    out = None
    for block in range(n_blocks):
        own = item_rows if n_blocks == 1 else item_rows.where(F.pmod(F.xxhash64("i"), F.lit(n_blocks)) == block)
        sent = sc.broadcast([(r.i, r.p) for r in own.toLocalIterator()])

        def scan(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            held = Items(sent.value)
            for batch in batches:
                rows = [(d, *m) for d, t in zip(batch["d"], batch["t"], strict=True) for m in held.matches(t, share)]
                yield pd.DataFrame(rows, columns=["d", "i", "covered_words", "passage_words", "share"])

        found = texts.mapInPandas(scan, "d bigint, i bigint, covered_words int, passage_words int, share double")
        out = found if out is None else out.unionByName(found)
    return out.withColumnRenamed("d", doc_key).withColumnRenamed("i", item_key)
