"""Texts over a token limit, cut into overlapping pieces at natural boundaries."""

from __future__ import annotations

import bisect
import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm.tokens import VOCABULARY, encoding, ranks, ship_vocabulary

#: Boundaries by strength; the match ends where the next piece may begin.
BOUNDARIES = {
    "chapter": regex.compile(r"(?:^|\R)(?=[ \t]*(?i:chapter|unit|lesson|section|adhyay|ikai|paath|अध्याय|इकाई|पाठ|प्रकरण|घटक|धडा)[ \t]+[\p{Nd}IVXLivxl]+\b)"),
    "paragraph": regex.compile(r"\R[ \t\xa0]*(?:\R[ \t\xa0]*)+"),
    "sentence": regex.compile(r"[.!?।॥…][\"'”’)\]]*\s+|\R"),
    "word": regex.compile(r"(?=\s\S)"),
}
PIECE_SCHEMA = "piece_no int, pieces int, start_char int, end_char int, tokens int, boundary string"


@functools.lru_cache(maxsize=4)
def _token_bytes(path: str) -> np.ndarray:
    rank = ranks(path)
    out = np.zeros(max(rank.values()) + 1, dtype=np.int64)
    for token, i in rank.items():
        out[i] = len(token)
    return out


@dataclass(frozen=True)
class Piece:
    start: int
    end: int
    tokens: int
    boundary: str


def cut(text: str, limit: int, overlap: int, path: str = VOCABULARY) -> list[Piece]:
    """Pieces of a text of more than `limit` tokens, in order; none for a shorter one.

    Prefix sums of the token lengths give each token's offset. From the start of a piece, a binary search finds the
    last boundary at or below the limit, of the strongest kind that leaves the piece at least half full, else of any kind
    but the end of a word, else that; without any, the piece is cut hard after a whole character. The next piece begins `overlap` tokens before the end, at most three
    more where that would split a character, and ends beyond that end; if nothing beyond it fits, the overlap is shortened. A piece that encodes to more than the limit on its own is cut shorter.
    """
    enc = encoding(path)
    ids = enc.encode_ordinary(text)
    if len(ids) <= limit:
        return []
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    starts = np.concatenate(([0], np.cumsum(_token_bytes(path)[np.asarray(ids)])))  # byte offset before each token, and the end
    opens = np.concatenate(((raw & 0xC0) != 0x80, [True]))  # places in bytes where a character begins
    chars = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))  # characters before a byte offset
    whole = np.flatnonzero(opens[starts])  # token places at which no character is split
    at = chars[starts[whole]]  # their places in characters, in order
    kinds = {kind: whole[np.searchsorted(at, np.unique(np.minimum([m.end() for m in found.finditer(text)] or [len(text)], len(text))), "right") - 1].tolist() for kind, found in BOUNDARIES.items()}
    n, places, out, begin, last = len(ids), whole.tolist(), [], 0, 0
    char_of = lambda token: int(chars[starts[token]])
    while True:
        room = limit
        while True:
            stop, kind = n, "end"
            if n - begin > room:
                stop, kind = _last_boundary(kinds, places, begin, room, overlap, last)
            size = len(enc.encode_ordinary(text[char_of(begin) : char_of(stop)]))
            if size <= limit or stop <= places[bisect.bisect_right(places, begin)]:
                break  # it fits, or is a single character
            room = min(room, stop - begin) - max(1, size - limit)
        if stop <= last:
            begin = places[bisect.bisect_right(places, begin)]
            continue
        out.append(Piece(char_of(begin), char_of(stop), size, kind))
        if stop >= n:
            return out
        back = places[bisect.bisect_right(places, stop - overlap) - 1]
        begin, last = back if back > begin else stop, stop


def _last_boundary(kinds: dict[str, list[int]], places: list[int], begin: int, room: int, overlap: int, last: int) -> tuple[int, str]:
    natural = {k: at for k, at in kinds.items() if k != "word"}
    low = max(places[bisect.bisect_right(places, begin)] + overlap, last + 1)  # from there the next piece can begin after this one
    for least, of in ((max(begin + room // 2, low), natural), (low, natural), (low, kinds)):
        for kind, at in of.items():
            k = bisect.bisect_right(at, begin + room) - 1
            if k >= 0 and at[k] >= least:
                return at[k], kind
    k = bisect.bisect_right(places, begin + room) - 1
    if places[k] <= begin:  # one character of more tokens than there is room for
        k = bisect.bisect_right(places, begin)
    return places[k], "hard"


def split_documents(df: DataFrame, key: str, text: str, limit: int = 4000, overlap: int = 200, path: str = VOCABULARY, with_text: bool = True) -> DataFrame:
    """(key, piece_no, pieces, start_char, end_char, tokens, boundary[, piece]) of each text over the limit.

    Texts of at most `limit` tokens, null and empty ones give no rows. Pieces are ranges of code points of the text;
    tokens are those of the piece encoded alone. Repeated rows are each cut. Other columns are ignored. A text of n
    bytes has at most n tokens, so texts of at most `limit` bytes are left out before Python sees them.
    """
    if not 0 <= overlap < limit // 2:
        raise ValueError("the overlap must be less than half the limit")
    ship_vocabulary(path)
    names = ["piece_no", "pieces", "start_char", "end_char", "tokens", "boundary"]
    kind = df.schema[key].dataType.simpleString()

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, t in zip(batch["k"], batch["t"], strict=True):
                found = cut(t, limit, overlap, path)
                rows += [(k, i, len(found), p.start, p.end, p.tokens, p.boundary, *([t[p.start : p.end]] if with_text else [])) for i, p in enumerate(found)]
            yield pd.DataFrame(rows, columns=["k", *names, *(["piece"] if with_text else [])])

    rows = df.where(F.octet_length(F.col(f"`{text}`")) > limit).select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    return rows.mapInPandas(pieces, f"k {kind}, {PIECE_SCHEMA}" + ", piece string" * with_text).withColumnRenamed("k", key)


def oversized(df: DataFrame, key: str, text: str, limit: int = 4000, overlap: int = 200, path: str = VOCABULARY) -> DataFrame:
    """(key) of the texts that split_documents cuts with the same arguments, read off their first pieces: the texts are cut whole for it."""
    return split_documents(df, key, text, limit, overlap, path).where(F.col("piece_no") == 0).select(key)
