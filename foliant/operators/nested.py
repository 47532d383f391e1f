"""Deeply nested JSON into related flat tables, in one depth-first pass that tags each object with its table."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Table of an object, by the name (letters only, lower case) of the member that holds it. Fixed names of the domain.
TABLES = {
    "metadata": "metadata", "editions": "editions", "contributors": "contributors", "classification": "classification", "domain": "classification", "tags": "tags",
    "extraction": "extraction", "sectionindex": "sections", "chapters": "chapters", "units": "units", "sections": "sections", "lessons": "sections", "subsections": "subsections",
    "content": "content", "pageextractions": "pages", "pages": "pages", "pdfpages": "page_ranges", "printedpages": "page_ranges",
}
TAGS = ["book", *dict.fromkeys(TABLES.values()), "other", "rejected"]

NODE_SCHEMA = "raw_key string, tag string, node_path string, parent_path string, depth int, ordinal int, payload string, title string"

#: A name's letters; titles of subsections have this one.
TITLE = "subsectiontitle"


def plain(name: str) -> str:
    """The letters of a name, in lower case."""
    return "".join(c for c in name if c.isalpha()).lower()


class Again(str):
    """A name that its object has already: equal to itself alone, so that no member is lost."""

    __slots__ = ()
    __eq__ = object.__eq__
    __hash__ = object.__hash__


def _members(pairs: list[tuple[str, Any]]) -> dict:
    out: dict = {}
    for name, value in pairs:
        out[Again(name) if name in out else name] = value
    return out


def _constant(word: str) -> None:
    raise ValueError(f"{word} is no JSON")


def parse(text: str) -> Any:
    """The value of a complete JSON text; ValueError otherwise. Nesting of any depth is read."""
    try:
        return json.loads(text, parse_constant=_constant, object_pairs_hook=_members)
    except RecursionError:
        return _parse_deep(text)


def _parse_deep(text: str) -> Any:
    """As parse, with a stack of its own instead of recursion."""
    scalar = re.compile(r'"(?:[^"\\\x00-\x1f]|\\.)*"|-?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?|true|false|null')
    stack: list[tuple[Any, list]] = []
    holder: list = []
    at, n, expect, target, name = 0, len(text), "value", holder, None

    def put(value: Any) -> None:
        if isinstance(target, dict):
            target[Again(name) if name in target else name] = value
        else:
            target.append(value)

    while at < n:
        c = text[at]
        if c in " \t\r\n":
            at += 1
        elif expect in ("value", "first") and c in "{[":
            new: Any = {} if c == "{" else []
            put(new)
            stack.append((target, [expect, name]))
            target, expect, at = new, "firstname" if c == "{" else "first", at + 1
        elif c in "]}" and stack and expect in ("first" if c == "]" else "firstname", "comma") and isinstance(target, list if c == "]" else dict):
            target, expect, at = stack.pop()[0], "comma", at + 1
        elif expect == "comma" and c == "," and stack:
            expect, at = "name" if isinstance(target, dict) else "value", at + 1
        elif (m := scalar.match(text, at)) and expect in ("value", "first"):
            put(json.loads(m.group()))
            expect, at = "comma", m.end()
        elif m and expect in ("name", "firstname") and c == '"':
            name, at = json.loads(m.group()), m.end()
            while at < n and text[at] in " \t\r\n":
                at += 1
            if at >= n or text[at] != ":":
                raise ValueError("no colon")
            expect, at = "value", at + 1
        else:
            raise ValueError(f"unexpected at {at}")
    if stack or not holder or expect != "comma":
        raise ValueError("not complete")
    return holder[0]


def unwrap(value: Any) -> Any:
    """Text that itself is JSON for an object, a list or such a text, is read, as often as it takes."""
    while isinstance(value, str):
        inner = value.strip()
        if inner[:1] not in ("{", "[", '"'):
            break
        try:
            read = parse(inner)
        except ValueError:
            break
        if isinstance(read, str) and unwrap(read) is read:
            break
        value = read
    return value


def _holds_object(value: Any) -> bool:
    """Whether an object lies in this value, once read."""
    stack = [value]
    while stack:
        x = unwrap(stack.pop())
        if isinstance(x, dict):
            return True
        if isinstance(x, list):
            stack.extend(x)
    return False


def _dump(value: dict) -> str:
    try:
        return json.dumps(value, ensure_ascii=False)
    except RecursionError:
        return _dump_deep(value)


class _Raw(str):
    """A piece of JSON that is ready."""


def _dump_deep(value: Any) -> str:
    """As json.dumps, with a stack of its own instead of recursion."""
    out, stack = [], [value]
    while stack:
        x = stack.pop()
        if isinstance(x, _Raw):
            out.append(x)
        elif isinstance(x, (dict, list)):
            parts: list[Any] = []
            for n, y in enumerate(x.items() if isinstance(x, dict) else x):
                name, inner = (json.dumps(y[0], ensure_ascii=False) + ": ", y[1]) if isinstance(x, dict) else ("", y)
                parts += [_Raw((", " if n else "") + name), inner]
            stack += reversed([_Raw("{" if isinstance(x, dict) else "["), *parts, _Raw("}" if isinstance(x, dict) else "]")])
        else:
            out.append(json.dumps(x, ensure_ascii=False))
    return "".join(out)


def visit(payload: str | None, own_payloads: bool = True) -> Iterator[tuple]:
    """(tag, node_path, parent_path, depth, ordinal, payload, title) of each object, parents before children.

    The payload of a node holds its own scalars and lists of scalars, and the scalars of lists that hold objects too;
    nested objects are nodes of their own. Of members of equal names each is read. Without own_payloads it is null.
    """
    if payload is None or not payload.strip():
        yield "rejected", "$", None, 0, 0, payload, None
        return
    try:
        root = parse(payload.strip())
    except ValueError:
        yield "rejected", "$", None, 0, 0, payload, None
        return
    stack: list[tuple[Any, str, str | None, str, int, int]] = [(root, "$", None, "book", 0, 0)]
    while stack:
        value, path, parent, tag, depth, ordinal = stack.pop()
        value = unwrap(value)
        if isinstance(value, list):
            stack.extend((x, f"{path}[{i}]", parent, tag, depth, i) for i, x in reversed(list(enumerate(value))))
        elif isinstance(value, dict):
            own, inside, title = {}, [], None
            for name, x in value.items():
                flat = plain(name)
                if flat == TITLE and isinstance(x, str) and x.strip() and title is None:
                    title = x
                y = unwrap(x)
                if _holds_object(y):
                    inside.append((y, f"{path}.{name}", path, TABLES.get(flat, "other"), depth + 1, 0))
                    if isinstance(y, list) and (plain_ones := [v for v in y if not isinstance(v, (dict, list)) and not _holds_object(v)]):
                        own[name] = plain_ones
                else:
                    own[name] = y
            yield tag, path, parent, depth, ordinal, _dump(own) if own_payloads else None, title
            stack.extend(reversed(inside))


def _visit_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["raw_key", "tag", "node_path", "parent_path", "depth", "ordinal", "payload", "title"]
    for batch in batches:
        rows: list[tuple] = []
        for key, payload in zip(batch["raw_key"], batch["payload"], strict=True):
            for row in visit(payload):
                rows.append((key, *row))
                if len(rows) >= 20_000:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
        yield pd.DataFrame(rows, columns=names)


def flatten(df: DataFrame, key: str, payload: str) -> DataFrame:
    """One row (raw_key, tag, node_path, parent_path, depth, ordinal, payload, title) for each object of each payload.

    node_path is the primary key within raw_key, parent_path the path of the nearest object around it (null at the
    root). A payload that is null, blank or not complete JSON gives one row of tag `rejected`. A payload that is a JSON
    scalar, or an empty list, gives none. Repeated rows of the input give repeated rows. Other columns are ignored.
    """
    return df.select(F.col(f"`{key}`").cast("string").alias("raw_key"), F.col(f"`{payload}`").cast("string").alias("payload")).mapInPandas(_visit_rows, NODE_SCHEMA)


def flat_table(nodes: DataFrame, tag: str, fields: dict[str, tuple[str, list[str]]]) -> DataFrame:
    """The table of one tag with its schema: fields maps a column to its type and the names, as plain() gives them, it may have; of several that an object has, the first."""
    members = F.expr("transform(map_entries(from_json(payload, 'map<string,string>')), e -> named_struct('k', lower(regexp_replace(e.key, '[^\\\\p{L}]', '')), 'v', e.value))")
    rows = nodes.where(F.col("tag") == tag).select("raw_key", "node_path", "parent_path", "ordinal", members.alias("m"))
    member = lambda name: F.get(F.filter("m", lambda e: (e["k"] == name) & e["v"].isNotNull()), F.lit(0))["v"]
    return rows.select("raw_key", "node_path", "parent_path", "ordinal", *[F.coalesce(*[member(n) for n in names]).try_cast(kind).alias(c) for c, (kind, names) in fields.items()])


def write_tables(nodes: DataFrame, path: str) -> None:
    """Write all tags in one pass, partitioned by tag."""
    nodes.write.mode("overwrite").partitionBy("tag").parquet(path)


#: Schemas of the tables: column, type, names as plain() gives them.
SCHEMAS = {
    "metadata": {c: ("string", names) for c, names in {"document_key": ["documentkey"], "school_name": ["schoolname", "school"], "class_name": ["classname", "class"], "grade": ["grade"], "board": ["board"], "medium": ["medium"], "book_title": ["booktitle", "title"], "subject": ["subject"], "language": ["language"]}.items()},
    "editions": {"year": ("int", ["year"])},
    "contributors": {"role": ("string", ["role"]), "name": ("string", ["name"])},
    "classification": {"name": ("string", ["name"]), "tags": ("string", ["tags"])},
    "tags": {"tag": ("string", ["tag"]), "weight": ("double", ["weight"])},
    "chapters": {"chapter_number": ("string", ["chapternumber"]), "chapter_title": ("string", ["chaptertitle"]), "start_page": ("int", ["startpage", "startpdfpage", "pdfstartpage"])},
    "units": {"unit_number": ("string", ["unitnumber"]), "unit_title": ("string", ["unittitle"]), "start_page": ("int", ["startpage", "startpdfpage", "pdfstartpage"])},
    "sections": {"section_number": ("string", ["sectionnumber"]), "section_title": ("string", ["sectiontitle"]), "lesson_title": ("string", ["lessontitle"]), "start_page": ("int", ["startpage", "startpdfpage", "pdfstartpage"]), "lesson_text": ("string", ["lessontext"])},
    "subsections": {"subsection_number": ("string", ["subsectionnumber"]), "subsection_title": ("string", ["subsectiontitle"]), "anchor_marker": ("string", ["anchormarker"]), "start_page": ("int", ["startpage", "startpdfpage", "pdfstartpage"]), "text_length_chars": ("int", ["textlengthchars"]), "quality_flags": ("string", ["qualityflags"])},
    "pages": {"page_number": ("int", ["pagenumber"]), "section_title": ("string", ["sectiontitle"]), "text": ("string", ["text"])},
    "page_ranges": {"start_page": ("int", ["start"]), "end_page": ("int", ["end"])},
}


def read_tables(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables that write_tables wrote, each with its schema; only its own folder is read for a table."""
    nodes = spark.read.schema(NODE_SCHEMA).parquet(path)
    return {tag: flat_table(nodes, tag, fields) for tag, fields in SCHEMAS.items()}


def titled_subsections(df: DataFrame, key: str = "raw_id", payload: str = "payload") -> DataFrame:
    """(raw_id, parent_path, node_path) of every object with a subsection title; rejected payloads give nothing. The visitor's rows without their payloads."""

    def titled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(k, parent or "$", path) for k, p in zip(batch["k"], batch["p"], strict=True) for _, path, parent, _, _, _, title in visit(p, False) if title is not None]
            yield pd.DataFrame(rows, columns=["raw_id", "parent_path", "node_path"]).astype({"raw_id": "Int64"})

    rows = df.select(F.col(f"`{key}`").cast("bigint").alias("k"), F.col(f"`{payload}`").cast("string").alias("p"))
    return rows.mapInPandas(titled, "raw_id bigint, parent_path string, node_path string")
