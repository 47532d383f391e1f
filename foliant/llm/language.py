"""Languages of texts and of the segments of mixed ones, where labels are missing or wrong."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.functions.labels import language_name
from foliant.llm.encoding import USUAL, repair

#: Languages that can be told apart, by script.
LATIN, DEVANAGARI = ("English", "Hinglish"), ("Hindi", "Marathi")
STATES = (*LATIN, *DEVANAGARI)
#: Labelled rows of which the word scores are learnt, at most about so many, chosen by a hash of their key.
SAMPLE_ROWS = 20_000
#: A word's score lies within plus or minus this; a word in another script than the state's costs OFF_SCRIPT.
CLIP, OFF_SCRIPT = 3.0, -6.0
#: What a change of language costs, in nats.
SWITCH = 9.0
#: A page is mixed when the second language has this share of its words.
MIXED = 0.25
#: A text of another language than these: of OTHER_WORDS words or more, fewer than this share of them known in its script.
OTHER, OTHER_WORDS, KNOWN_SHARE = "Other", 20, 0.15

_WORD = re.compile("[a-zÀ-ɏ]+|[ऀ-ॣ॰-ॿ]+")
_END = re.compile(r"[.!?।॥…:;,][\"'”’)\]]*\s*$")
_STOP = re.compile(r"[.!?।॥]")
_OPENING = re.compile(r"\s*(?i:chapter|unit|lesson|section|activity|exercise|answers?|adhyay|ikai|paath|gatividhi|abhyas|uttar|page|अध्याय|इकाई|पाठ|गतिविधि|अभ्यास|उत्तर|पृष्ठ|प्रकरण|घटक|धडा|कृती|स्वाध्याय|उत्तरे|पान)\b[^.!?।]*$")
_TORN = re.compile("[àâÃÂ][¤¥\x80-\xbf€]+|[¤¥�]|à(?=[\\sऀ-ॿ])|(?<=[ऀ-ॿ])à")
_USUAL = re.compile(f"[^{USUAL}]")


@dataclass(frozen=True)
class Model:
    """Log odds of the first language of a script against the second, by word in lower case; 0 for words not known."""

    latin: dict[str, float]
    devanagari: dict[str, float]


def learn(df: DataFrame, key: str, text: str, label: str, rows: int = SAMPLE_ROWS) -> Model:
    """Word scores from labelled rows, wrong labels among them: both signs survive as long as most labels are right.

    All words that the rows have twice or more are kept; their number is bounded by that of the rows.
    """
    named = df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"), language_name(F.col(f"`{label}`")).alias("l")).where(F.col("l").isin(*STATES))
    known = named.count()
    if known > rows:
        named = named.where(F.pmod(F.xxhash64("k"), F.lit(1_000_000)) < math.ceil(1e6 * rows / known))
    words = named.select("l", F.explode(F.regexp_extract_all(F.lower("t"), F.lit("[a-zÀ-ɏ]+|[ऀ-ॣ॰-ॿ]+"), F.lit(0))).alias("w"))
    counts = words.groupBy("w").agg(*[F.count_if(F.col("l") == s).alias(s) for s in STATES])
    table = counts.withColumn("n", sum(F.col(s) for s in STATES)).where("n >= 2").collect()
    totals = {s: 1 + sum(r[s] for r in table if (r.w[0] >= "ऀ") == (s in DEVANAGARI)) for s in STATES}
    scores: dict[bool, dict[str, float]] = {False: {}, True: {}}
    for r in table:
        deva = r.w[0] >= "ऀ"
        a, b = DEVANAGARI if deva else LATIN
        # The prior count follows the total, so that a word seen in one language alone isn't overrated.
        x = math.log((r[a] / totals[a] + 2e-5) / (r[b] / totals[b] + 2e-5))
        scores[deva][r.w] = max(-CLIP, min(CLIP, x))
    return Model(scores[False], scores[True])


def body(text: str) -> str:
    """A text without its headings and running heads: short lines without a sentence's end that stand first, last or alone."""
    lines = text.split("\n")
    long = sorted(len(x) for x in lines if len(x.strip()) > 20)
    usual = long[len(long) // 2] if long else 0
    solid = [i for i, x in enumerate(lines) if x.strip()]
    out = []
    for place, i in enumerate(solid):
        x = lines[i].strip()
        edge = place in (0, 1) or place >= len(solid) - 2
        alone = (i == 0 or not lines[i - 1].strip()) and (i == len(lines) - 1 or not lines[i + 1].strip())
        starts = place == 0 or not lines[i - 1].strip() or _END.search(lines[i - 1])
        if _OPENING.match(x) or len(x) < 0.72 * usual and not _END.search(x) and (alone or edge and (starts or place < 2)):
            continue
        if (edge and place < 2 or alone) and not _END.search(x) and len(solid) > 3 and (x.isupper() or x.istitle() and len(x) < 0.9 * usual):
            continue
        out.append(x)
    return "\n".join(out)


def spans(text: str, model: Model, switch: float = SWITCH) -> list[tuple[int, int, int, int, float]]:
    """(start, end, state, words, margin) of each segment of one language: the best path over the word scores.

    The path may stay in one language throughout when that scores at least what the best word by word scores, less one
    switch; only other texts are worked through.
    """
    low = text.lower()
    words = _WORD.findall(low)
    if not words:
        return []
    latin = [model.latin.get(w, 0.0) for w in words if w < "ऀ"]
    deva = [model.devanagari.get(w, 0.0) for w in words if w >= "ऀ"]
    a, b, off_a, off_b = sum(latin), sum(deva), OFF_SCRIPT * len(deva), OFF_SCRIPT * len(latin)
    totals = [a + off_a, off_a - a, b + off_b, off_b - b]
    best = max(range(4), key=totals.__getitem__)
    if totals[best] >= sum(map(abs, latin)) + sum(map(abs, deva)) - switch:
        return [(0, len(text), best, len(words), totals[best] - sorted(totals)[-2])]
    found = list(_WORD.finditer(low))
    scores = [(s, -s, OFF_SCRIPT, OFF_SCRIPT) if w < "ऀ" else (OFF_SCRIPT, OFF_SCRIPT, s, -s) for w in words for s in ((model.latin if w < "ऀ" else model.devanagari).get(w, 0.0),)]
    path = viterbi(scores, switch)
    out, at = [], 0
    for k in range(1, len(path) + 1):
        if k == len(path) or path[k] != path[at]:
            part = [sum(x) for x in zip(*scores[at:k], strict=True)]
            out.append((found[at].start(), found[k - 1].end(), path[at], k - at, part[path[at]] - max(x for s, x in enumerate(part) if s != path[at])))
            at = k
    return out


def viterbi(scores: list[tuple[float, ...]], switch: float) -> list[int]:
    """The states of the best path; a change of state costs `switch`, ties keep the state."""
    now, back = list(scores[0]), []
    for e in scores[1:]:
        top = max(range(len(now)), key=now.__getitem__)
        floor = now[top] - switch
        from_ = [s if x >= floor else top for s, x in enumerate(now)]
        now = [max(x, floor) + y for x, y in zip(now, e, strict=True)]
        back.append(from_)
    state = max(range(len(now)), key=now.__getitem__)
    path = [state]
    for from_ in reversed(back):
        state = from_[state]
        path.append(state)
    return path[::-1]


def classify(text: str | None, model: Model) -> tuple[str | None, float, list[tuple[int, int, str, float]], str]:
    """(language, confidence, segments, the text the segments are places of); no language for a text without sentences."""
    if not text:
        return None, 0.0, [], text or ""
    if _USUAL.search(text):
        text = repair(text)[0]
        if _TORN.search(text):  # letters that bytes were dropped from are no words of any language
            text = _TORN.sub("", text)
    text = text.replace("\r\n", "\n").replace("\r", "\n")
    part = body(text)
    if not _STOP.search(part):
        part = text if _STOP.search(text) else part
    found = spans(part, model)
    words: dict[int, int] = {}
    for _, _, s, n, _ in found:
        words[s] = words.get(s, 0) + n
    total = sum(words.values())
    if total < 4 or not _STOP.search(part):
        return None, 0.0, [], part
    ranked = sorted(words.items(), key=lambda x: -x[1])
    # The words are only looked up again where their scores say little.
    if total >= OTHER_WORDS and sum(margin for *_, margin in found) < total * CLIP / 4:
        known = sum(w in (model.latin if w < "ऀ" else model.devanagari) for w in _WORD.findall(part.lower()))
        if known < KNOWN_SHARE * total:
            return OTHER, 1 - known / total, [], part
    sure = lambda margin, n: 1 / (1 + math.exp(-min(30.0, margin / max(1.0, math.sqrt(n)))))
    segments = [(a, b, STATES[s], sure(margin, n)) for a, b, s, n, margin in found]
    confidence = sum(sure(margin, n) * n for _, _, _, n, margin in found) / total
    second = ranked[1][1] / total if len(ranked) > 1 else 0.0
    return ("Mixed" if second >= MIXED else STATES[ranked[0][0]]), confidence, segments, part


FOUND = "_k {kind}, language string, confidence double, segments array<struct<start:int,end:int,language:string,confidence:double>>, body string"


def label_languages(df: DataFrame, key: str, text: str, model: Model, with_body: bool = False) -> DataFrame:
    """(key, language, confidence, segments[, body]) of each row with a text of sentences.

    language is one of STATES, `Mixed` when a second one has MIXED of the words, or `Other` when hardly a word is known
    in any of them. segments are places in body, the
    text without headings and with its encoding repaired. A null, empty or wordless text gives no row; repeated rows
    each give one; other columns are ignored. The model is sent to the workers; its size is bounded by the SAMPLE_ROWS it was learnt from.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)
    kind = df.schema[key].dataType.simpleString()

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = sent.value
        for batch in batches:
            rows = []
            for k, t in zip(batch["_k"], batch["_t"], strict=True):
                language, confidence, segments, part = classify(t, held)
                if language is not None:
                    rows.append((k, language, confidence, [{"start": a, "end": b, "language": s, "confidence": c} for a, b, s, c in segments], part if with_body else None))
            yield pd.DataFrame(rows, columns=["_k", "language", "confidence", "segments", "body"])

    rows = df.where(F.length(F.col(f"`{text}`")) > 0).select(F.col(f"`{key}`").alias("_k"), F.col(f"`{text}`").alias("_t"))
    out = rows.mapInPandas(scan, FOUND.format(kind=kind)).withColumnRenamed("_k", key)
    return out if with_body else out.drop("body")


def wrong_labels(df: DataFrame, key: str, text: str, label: str, model: Model | None = None) -> DataFrame:
    """(key, language) of the rows whose label is missing, blank, unknown or names another language than the text is in.

    Rows of a null key are left out, and so are texts of other languages. The label travels with the text through one scan; nothing is joined.
    """
    model = model or learn(df, key, text, label)
    rows = df.where(F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").alias("k"), language_name(F.col(f"`{label}`")).alias("l"), F.col(f"`{text}`").alias("t"))
    found = _with_labels(rows, model)
    return found.where((F.col("language") != OTHER) & (F.col("l").isNull() | (F.col("l") != F.col("language")))).select(F.col("k").alias(key), "language")


def _with_labels(rows: DataFrame, model: Model) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(model)
    kind = rows.schema["k"].dataType.simpleString()

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = sent.value
        for batch in batches:
            found = [(k, lab, *classify(t, held)[:2]) for k, lab, t in zip(batch["k"], batch["l"], batch["t"], strict=True)]
            yield pd.DataFrame([x for x in found if x[2] is not None], columns=["k", "l", "language", "confidence"])

    return rows.where(F.length("t") > 0).mapInPandas(scan, f"k {kind}, l string, language string, confidence double")
