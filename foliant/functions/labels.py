"""Labels of language, subject and source in all their spellings, brought to one name. JVM-side lookups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of language labels, in lower case.
LANGUAGES = {
    "English": ["english", "en", "eng", "en-in", "en-us", "en-gb"],
    "Hindi": ["hindi", "hi", "hin", "hi-in", "हिन्दी", "हिंदी"],
    "Marathi": ["marathi", "mr", "mar", "mr-in", "मराठी"],
    "Hinglish": ["hinglish", "hi-latn", "hindi-latn", "roman hindi"],
    "Mixed": ["mixed", "mul", "bilingual", "multilingual"],
}
# Labels that name no language.
NO_LANGUAGE = ["", "unknown", "und", "none", "null", "n/a", "na", "?", "-", "unk", "zxx"]
# Short forms of subjects.
SUBJECTS = {
    "environmental studies": ["evs"],
    "mathematics": ["maths", "math"],
    "computer studies": ["computer", "computers", "computer science"],
    "geography": ["geog", "geo"],
    "literature": ["lit"],
    "history": ["hist"],
    "science": ["sci"],
}


def _lookup(pairs: dict[str, str], key: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])[key]


def language_name(label: Column) -> Column:
    """English, Hindi, Marathi, Hinglish or Mixed; null for a label that is missing or says unknown; else as it stands, trimmed."""
    key = F.lower(F.trim(label))
    known = {s: name for name, spellings in LANGUAGES.items() for s in spellings}
    return F.when(label.isNull() | key.isin(NO_LANGUAGE), None).otherwise(F.coalesce(_lookup(known, key), F.trim(label)))


def subject_name(label: Column) -> Column:
    """A subject in lower case, short forms written out; `unknown` when missing or blank."""
    key = F.regexp_replace(F.lower(F.trim(label)), r"[.\s]+$", "")
    key = F.regexp_replace(key, r"[\s_-]+", " ")
    return F.coalesce(_lookup({s: name for name, short in SUBJECTS.items() for s in short}, key), F.nullif(key, F.lit("")), F.lit("unknown"))


def source_name(label: Column) -> Column:
    """A source in lower case with underscores; `unknown` when missing or blank."""
    key = F.regexp_replace(F.lower(F.trim(label)), r"[^\p{L}\p{M}\p{N}]+", "_")
    return F.coalesce(F.nullif(F.regexp_replace(key, "^_+|_+$", ""), F.lit("")), F.lit("unknown"))
