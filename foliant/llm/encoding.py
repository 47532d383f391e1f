"""Text decoded with the wrong character encoding: found, and restored where nothing was lost."""

from __future__ import annotations

import functools
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Legacy encodings as which UTF-8 may have been read.
ENCODINGS = ["cp1252", "latin-1", "cp1250", "cp1251", "cp1254", "cp437", "cp850", "mac_roman", "iso8859_2", "iso8859_15", "koi8_r"]
WESTERN = ["cp1252", "latin-1", "cp1254", "iso8859_15"]
#: Characters that need no look: ASCII, Devanagari, and signs that no garbled sequence consists of alone.
USUAL = r"\x00-\x7fऀ-ॿ‐–—‘’“”…×÷\xad\u200c\u200d"

_UTF8 = re.compile(
    "(?:[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2})+"
)
#: The same with a space where the byte A0 was shown as a no-break space and then made an ordinary one.
_TORN = re.compile("\xe0[\xa4\xa5](?![\x80-\xbf ])")
_SPACED = re.compile("\xe0\xa4 |\xc3 (?=\xc2)|(?<=[\xc2-\xdf\xe0-\xef\x80-\xbf])\xc3 ")


@functools.cache
def _to_bytes(encoding: str) -> dict[int, int]:
    """Translation that turns a character into the one whose code is its byte; bytes without a character keep their code, as browsers do."""
    out = dict.fromkeys(range(0x80, 0x100), 0xFFFF)
    for b in range(0x80, 0x100):
        try:
            out[ord(bytes([b]).decode(encoding))] = b
        except UnicodeDecodeError:
            out[b] = b
    return out


@functools.cache
def _lead_test(encoding: str) -> re.Pattern:
    """A lead byte's character, then that of a byte that may follow it."""
    of = {b: chr(c) for c, b in _to_bytes(encoding).items() if b != 0xFFFF}
    lead, follow = (re.escape("".join(of[b] for b in span if b in of)) for span in (range(0xC2, 0xF5), range(0x80, 0xC0)))
    return re.compile(f"[{lead}][{follow}]")


@functools.cache
def _weights() -> np.ndarray:
    w = np.full(0x10000, 4, dtype=np.uint8)
    w[:0x80] = 0
    w[0xA0:0x100] = 2
    w[0x100:0x250] = 3
    w[0x370:0x400] = 2
    w[0x900:0x980] = 0
    w[0x1E00:0x2000] = 3
    w[0x2000:0x2070] = 0
    w[[ord(c) for c in "×÷"]] = 0
    w[[ord(c) for c in "\xa0°±²³¹¼½¾·«»§©®µ"]] = 1
    w[[ord(c) for c in "€™‚„†‡‰‹›"]] = 2
    w[[ord(c) for c in "ÂÃ"]] = 4
    return w


def garbling_cost(text: str) -> int:
    """How unlikely the characters of a text are: 0 for usual ones, 1 to 3 for letters and signs that garbling yields, 4 for others."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    w = _weights()
    return int(w[np.minimum(codes, 0xFFFF)].sum(dtype=np.int64))


def _peel(text: str, encoding: str) -> str:
    """Every run that is strictly valid UTF-8 under this encoding, decoded where the cost drops."""
    as_bytes = text.translate(_to_bytes(encoding))
    out, at, peeled = [], 0, False
    for m in _UTF8.finditer(as_bytes):
        run, new = text[m.start() : m.end()], m.group().encode("latin-1").decode("utf-8")
        if garbling_cost(new) < garbling_cost(run):
            out += [text[at : m.start()], new]
            at, peeled = m.end(), True
    if not peeled:
        return text
    if _SPACED.search(as_bytes) and not _TORN.search(as_bytes):  # there is proof of this encoding and no byte was dropped, so that the spaces may be read as A0
        spaced = _SPACED.sub(lambda m: m.group()[:-1] + "\xa0", as_bytes)
        out, at = [], 0
        for m in _UTF8.finditer(spaced):
            run, new = text[m.start() : m.end()], m.group().encode("latin-1").decode("utf-8")
            if garbling_cost(new) < garbling_cost(run):
                out += [text[at : m.start()], new]
                at = m.end()
    return "".join([*out, text[at:]])


def repair(text: str) -> tuple[str, int]:
    """(the text with all layers peeled off, number of rounds it took); a text without garbling comes back as it is.

    Every round lowers the cost, a whole number, so that the rounds come to an end by themselves.
    """
    rounds = 0
    while True:
        best, cost = text, garbling_cost(text)
        western = re.search("à[¤¥]", text)  # Devanagari read as Western European; other code pages would join halves of two characters
        for encoding in WESTERN if western else ENCODINGS:
            if _lead_test(encoding).search(text):
                new = _peel(text, encoding)
                if new != text and (c := garbling_cost(new)) < cost:
                    best, cost = new, c
        if best is text:
            break
        text, rounds = best, rounds + 1
    return text, rounds


#: What stays where bytes were dropped, and can't stand in a right text: control characters, the first letter of a
#: sequence next to its second, the first letter of a multiplication sign between two numbers.
_BROKEN = re.compile("[\ufffd\x80-\x84\x86-\x9f]|[àâÃÂŕа][¤¥ҐĄ€]|(?<=\\d )Ã(?= \\d)")
#: What may stand in a right text, which names these letters or has words like "Kâlidâs": a remnant only beside a
#: sequence that was proven garbled.
_DOUBTFUL = re.compile("(?<!\\w)[ÃÂâ](?!\\w)|(?<!\\w)â(?=[A-Z])|(?<=[a-z])âs\\b")


def lost(text: str) -> bool:
    """Whether, after repair, characters are gone for good: replacement characters, or remains of a wrong decoding."""
    return _BROKEN.search(text) is not None


REPAIR_SCHEMA = T.StructType(
    [T.StructField("restored", T.StringType()), T.StructField("garbled", T.BooleanType()), T.StructField("lossless", T.BooleanType()), T.StructField("layers", T.IntegerType())]
)


@F.pandas_udf(REPAIR_SCHEMA)
def _repair_udf(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for t in texts:
        new, rounds = repair(t)
        gone = lost(new)
        rows.append((new, rounds > 0 or gone, not gone and not (rounds and _DOUBTFUL.search(new)), rounds))
    return pd.DataFrame(rows, columns=["restored", "garbled", "lossless", "layers"])


def suspicious(text: Column) -> Column:
    """JVM-side test that leaves out texts of usual characters alone, which can't be garbled."""
    return text.rlike(f"[^{USUAL}]")


def find_garbled(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, restored, lossless, layers) of each row whose text is garbled, wholly or in part.

    restored holds the text with what could be restored; lossless says whether that is all of it. Null and empty
    texts are no case; repeated rows each give a row; other columns are ignored.
    """
    rows = df.where(suspicious(F.col(f"`{text}`"))).select(F.col(f"`{key}`").alias("_k"), _repair_udf(F.col(f"`{text}`")).alias("_r"))
    return rows.where("_r.garbled").select(F.col("_k").alias(key), "_r.restored", "_r.lossless", "_r.layers")
