"""Noise in the text of scanned pages: broken words, misread characters, running heads and page numbers.

Vocabularies are counted over all pages. Rare words are joined with frequent ones by anagram hashes: exchanging one
confusable group of characters for another changes the hash, a sum over characters, by a value that depends on the
groups alone, so that "word's hash + difference" finds every candidate by an equi-join. Which groups are confused is
learnt from the vocabulary itself: all exchanges of up to two characters for up to two others, of which those count
that recur, and by which rare words nearly always come from much more frequent ones.
"""

from __future__ import annotations

import functools
import math
import re
import unicodedata
from dataclasses import dataclass

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.llm.encoding import USUAL, repair
from foliant.session import cut

# Groups of characters that are misread, and what stands on the paper, as far as they are known beforehand.
CONFUSIONS = [
    ("@", "a"), ("0", "o"), ("1", "l"), ("5", "s"), ("9", "g"), ("c", "e"), ("cl", "d"), ("f", "t"), ("b", "h"), ("ii", "u"), ("rn", "m"), ("vv", "w"), ("h", "li"),
    ("१", "।"), ("२", "र"), ("भ", "म"), ("म", "भ"), ("ष", "प"), ("प", "ष"), ("ङ", "ड"), ("ृ", "ु"), ("ट", "द"), ("व", "ब"), ("घ", "ध"), ("य", "थ"), ("", "ि"),
]
#: A learnt confusion is shown by so many different words, by so many right ones, and so large a share of its pairs are of a rare and a frequent word.
SUPPORT, RIGHT_WORDS, SHARE = 5, 5, 0.9
#: How much more frequent a word must be than its misread form.
RATIO = 12
#: Misread words on a page that make a case.
MISREAD_WORDS = 3
ORDINAL = r"^\d+(?:st|nd|rd|th)$"
#: Corrections, or frequent words, sent to the workers at most; more are joined by a shuffle.
BROADCAST_WORDS = 500_000
#: How much longer than the longest title a running head may be: letters that are garbled take up to six characters, a number and signs stand beside.
HEAD_FACTOR, HEAD_MORE = 6, 64

#: Letters, marks, digits and @; the usual ranges stand first, as classes of properties are slow.
W = r"a-z0-9@\u0900-\u0963\u0966-\u097f\p{L}\p{M}\p{Nd}"
#: Everything else up to U+3100 that isn't a letter, mark, digit or @, but the hyphen: to be blanked by translate(), which is much faster than a pattern.
SIGNS = "".join(chr(c) for c in range(0x3100) if unicodedata.category(chr(c))[0] in "PSZC" and chr(c) not in "@-" or c < 32)
MARKS = "-‐‑\xad¬"

# Words before a page number, and before the number of a heading.
PAGE_WORDS = "page|pg|p|prishth|panna|pan|पृष्ठ|पान|पेज"
HEADING_WORDS = "chapter|unit|lesson|section|part|adhyay|ikai|paath|prakaran|अध्याय|इकाई|पाठ|प्रकरण|घटक|धडा|भाग|विभाग"

_UNUSUAL = re.compile(f"[^{USUAL}]")
_NUMBER = r"[0-9०-९lIoOS]{1,10}|[ivxlcIVXLC1]{1,7}"
_IS_NUMBER = re.compile(_NUMBER)
LONGEST_NUMBER, LARGEST_NUMBER = 10, 2**31 - 1  # what the page_number column can hold
_AROUND = " \t\xa0-‐‑–—_|[](){}<>.,:;•·*~«»=+/\\"  # what stands around a page number
_IS_PAGE_WORD = re.compile(f"(?i:{PAGE_WORDS})")
_HEADING = re.compile(rf"^[\W_]*(?i:{HEADING_WORDS})\s+[0-9०-९ivxlIVXL]+\b[\s:.–—-]*(?P<rest>.*)$")
_READ = str.maketrans("०१२३४५६७८९lIoOS", "012345678911005")


_MARKS = "".join(sorted(chr(c) for c in range(0x300, 0xE00) if unicodedata.category(chr(c))[0] == "M"))
_NO_LETTER = re.compile(rf"[^\w{_MARKS}]|[\d_]")


@dataclass(frozen=True)
class Confusions:
    """Pairs (what is read, what stands on the paper) with their weights; all that depends on them derives from here."""

    pairs: tuple[tuple[str, str], ...]
    weights: tuple[float, ...]

    @functools.cached_property
    def signs(self) -> dict[str, str]:
        """Digits and signs that are read for a letter."""
        return {a: b for a, b in self.pairs if len(a) == 1 and not _is_letter(a) and b and all(map(_is_letter, b))}

    @functools.cached_property
    def _classes(self) -> dict[str, str]:
        """Each group of letters with what stands for all that are confused with it."""
        of: dict[str, str] = {}

        def top(g: str) -> str:
            while of.setdefault(g, g) != g:
                g = of[g]
            return g

        for a, b in self.pairs:
            if a and b and all(map(_is_letter, a + b)):
                x, y = sorted((top(a), top(b)), key=lambda g: (len(g), g))
                of[y] = x
        return {g: top(g) for g in of}

    @functools.cached_property
    def longer(self) -> list[tuple[str, str]]:
        return sorted(((g, t) for g, t in self._classes.items() if len(g) > 1), key=lambda x: (-len(x[0]), x[0]))

    @functools.cached_property
    def single(self) -> dict[str, str]:
        """Single letters by what stands for them; such as are lost or made up by misreading stand for nothing."""
        lost = {x for a, b in self.pairs for x, y in ((a, b), (b, a)) if not y and len(x) == 1 and _is_mark(x)}
        return {g: t for g, t in self._classes.items() if len(g) == 1 and g != t and len(t) == 1} | dict.fromkeys(lost, "")

    @functools.cached_property
    def odd(self) -> str:
        """Words with a digit or sign for a letter inside are misread even where the right form is not known."""
        latin = "".join(sorted(c for c in self.signs if c.isascii() and c.isdigit()))
        other = "".join(sorted(c for c in self.signs if not c.isascii() and c.isdigit()))
        marks = "".join(re.escape(c) for c in sorted(self.signs) if not c.isdigit())
        near = "".join(c for c in latin if c in "01")  # others stand before units of measure too
        far = "".join(c for c in latin if c not in "01")
        out = [rf"[\p{{L}}\p{{M}}][{marks}]|[{marks}][\p{{L}}\p{{M}}]"] if marks else []
        out += [rf"[a-z][{latin}][a-z]|[a-z]{{2}}[{latin}]\b"] if latin else []
        out += [rf"\b[{far}][a-z]{{3}}"] if far else []
        out += [rf"\b[{near}][a-z]{{2}}"] if near else []
        out += [rf"[ऀ-ॣ][{other}]|[{other}][ऀ-ॣ]"] if other else []
        return f"(?:{'|'.join(out)})" if out else r"(?!)"

    def fold(self, text: str | None) -> str:
        """Letters of a title, with misread groups and what they stand for made equal; case, signs and spaces don't count."""
        s = text or ""
        s = (s if s.isascii() else unicodedata.normalize("NFC", s)).lower().translate(self._sign_table)
        s = _NO_LETTER.sub("", s)
        for group, top in self.longer:
            s = s.replace(group, top)
        return s.translate(self._single_table)

    @functools.cached_property
    def _sign_table(self) -> dict:
        return str.maketrans(self.signs)

    @functools.cached_property
    def _single_table(self) -> dict:
        return str.maketrans(self.single)

    def letters(self, line: Column) -> Column:
        """fold() for lines of common characters, JVM-side."""
        gone = "".join(c for c in _GONE if c not in self.signs)
        return self._grouped(F.lower(line), gone)

    def folded(self, word: Column) -> Column:
        """fold() for words and compounds, JVM-side; the hyphen stays."""
        return self._grouped(word, "")

    def _grouped(self, word: Column, gone: str) -> Column:
        short = {a: b for a, b in self.signs.items() if len(b) == 1}
        w = F.translate(word, "".join(short) + gone, "".join(short.values()))
        for a, b in [*((a, b) for a, b in self.signs.items() if len(b) > 1), *self.longer]:
            w = F.replace(w, F.lit(a), F.lit(b))
        # translate() drops the characters that have no counterpart, so these stand last.
        kept = {a: b for a, b in self.single.items() if b}
        lost = "".join(a for a, b in self.single.items() if not b)
        return F.translate(w, "".join(kept) + lost, "".join(kept.values()))


def _is_mark(c: str) -> bool:
    return unicodedata.category(c)[0] == "M"


def _is_letter(c: str) -> bool:
    return c.isalpha() or _is_mark(c)


KNOWN = Confusions(tuple(CONFUSIONS), (1.0,) * len(CONFUSIONS))
fold, folded, ODD = KNOWN.fold, KNOWN.folded, KNOWN.odd


def roman(text: str) -> int | None:
    """The value of a roman number in small or capital letters."""
    s = text.lower().replace("1", "i")
    if not re.fullmatch(r"(?=.)(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})", s):
        return None
    values = [{"i": 1, "v": 5, "x": 10, "l": 50, "c": 100}[c] for c in s]
    return sum(-v if v < w else v for v, w in zip(values, [*values[1:], 0], strict=True))


def read_edge(line: str, fold=fold) -> dict:
    """What a line at the edge of a page holds: arabic and roman number, the rest folded, whether it is a numbered heading."""
    at = {"number": None, "roman": None, "rest": "", "heading": False, "parts": None, "whole": None}
    tokens = line.strip(_AROUND).split()
    if not tokens:
        return at
    first, last = tokens[0].strip(_AROUND), tokens[-1].strip(_AROUND)
    is_number = lambda t: len(t) <= LONGEST_NUMBER and _IS_NUMBER.fullmatch(t) is not None
    if is_number(last) and (len(tokens) == 1 or len(tokens) == 2 and _IS_PAGE_WORD.fullmatch(first)):
        return at | _value(last)
    if len(first) <= 9 and (m := _HEADING.match(line)):
        return at | {"rest": fold(m["rest"]), "heading": True}
    for n, rest in ((first, tokens[1:]), (last, tokens[:-1])):
        if is_number(n) and (title := fold(" ".join(rest))) and ((v := _value(n))["number"] is not None or v["roman"]):
            at |= {"rest": title, "whole": fold(line)} | v  # the number may belong to the title
            break
    else:
        at["rest"] = fold(line)
    if any(c in line for c in "–|—") and len(parts := [fold(x) for x in re.split(r"\s[–|—]\s", line)]) == 2 and all(len(p) > 3 for p in parts):
        at["parts"] = parts
    return at


def _value(n: str) -> dict:
    arabic = n.translate(_READ)
    has_digit = any(c.isdigit() for c in n)
    value = int(arabic) if arabic.isdigit() and (has_digit or set(n) <= {"l", "I"}) else None
    return {"number": value if value is not None and value <= LARGEST_NUMBER else None, "roman": roman(n)}


EDGE = T.StructType(
    [T.StructField("number", T.IntegerType()), T.StructField("roman", T.IntegerType()), T.StructField("rest", T.StringType()), T.StructField("heading", T.BooleanType()), T.StructField("parts", T.ArrayType(T.StringType())), T.StructField("whole", T.StringType())]
)


def _let(value: Column, then) -> Column:
    """then(value), with the value bound to a variable, so that it is made once however often it is named."""
    return F.transform(F.array(value), then)[0]


def _ends(pages: DataFrame) -> DataFrame:
    """(id, document_id, page_number, line, t) of the two first and two last lines that aren't blank. Whole pages are looked through only where eight lines at either end don't do."""
    key, few = ["id", "document_id", "page_number"], 8
    solid = lambda lines, offset: F.filter(F.transform(lines, lambda x, i: F.struct((i + offset).alias("line"), F.btrim(x, F.lit(" \t\xa0")).alias("t"))), lambda x: x["t"] != "")
    whole = lambda l: _let(solid(l, F.lit(0)), lambda s: F.when(F.size(s) <= 4, s).otherwise(F.concat(F.slice(s, 1, 2), F.slice(s, -2, 2))))
    both = lambda l, head, foot: F.when((F.size(head) >= 2) & (F.size(foot) >= 2), F.concat(F.slice(head, 1, 2), F.slice(foot, -2, 2))).otherwise(whole(l))
    parts = lambda l: _let(solid(F.slice(l, 1, few), F.lit(0)), lambda head: _let(solid(F.slice(l, -few, few), F.size(l) - few), lambda foot: both(l, head, foot)))
    ends = _let(lines_of(F.col("text")), lambda l: F.when(F.size(l) > 2 * few, parts(l)).otherwise(whole(l)))
    return pages.select(*key, F.explode(ends).alias("e")).select(*key, "e.line", "e.t")


#: Characters of lines that need no composing and are not garbled; a line of them alone can be read JVM-side.
_COMMON = r"^(?!.*[नरळ]\u093c)[\x20-\x7e‘’“”…ऀ-ॗॠ-ॿ]+$"
_GONE = "".join(chr(c) for c in range(0x20, 0x7F) if not chr(c).isalpha()) + "‘’“”…।॥०१२३४५६७८९॰"
_MAYBE_NUMBER = r"[0-9०-९]|^[^A-Za-zऀ-ॿ]*[lIoOSivxcLVXC]{1,10}[^A-Za-zऀ-ॿ]*$"


def _is_common(t: Column) -> Column:
    """Whether read_edge() would find in a line nothing but its letters: no number at either end, no heading's word, no two parts."""
    inner = F.btrim(t, F.lit(_AROUND))
    first, last = F.substring_index(inner, " ", 1), F.substring_index(inner, " ", -1)
    return t.rlike(_COMMON) & ~F.contains(t, F.lit("|")) & ~first.rlike(_MAYBE_NUMBER) & ~last.rlike(_MAYBE_NUMBER) & ~first.rlike(rf"(?i)^[^\p{{L}}]*(?:{HEADING_WORDS})")


def line_texts(pages: DataFrame, longest: int = 1 << 30) -> DataFrame:
    """(id, document_id, page_number, line, t, common) of the two first and two last lines t that aren't blank, up to `longest` characters. Cut, as it is small and read several times."""
    return cut(_ends(pages).where(F.length("t") <= longest).withColumn("common", _is_common(F.col("t"))))


def edge_lines(lines: DataFrame, known: Confusions = KNOWN) -> DataFrame:
    """(id, document_id, page_number, line, fields of EDGE) of line_texts(). Python sees only lines that may hold more than letters."""

    @F.pandas_udf(EDGE)
    def read(lines: pd.Series) -> pd.DataFrame:
        whole = [repair(t)[0] if _UNUSUAL.search(t) else t for t in lines]  # heads may be garbled too
        return pd.DataFrame([read_edge(t.strip(), known.fold) for t in whole], columns=EDGE.names).astype({"number": "Int32", "roman": "Int32"})

    key = ["id", "document_id", "page_number", "line"]
    none = lambda f: F.lit(False) if f.name == "heading" else F.lit(None)
    plain = lines.where("common").select(*key, *[(known.letters(F.col("t")) if f.name == "rest" else none(f)).cast(f.dataType).alias(f.name) for f in EDGE.fields])
    return plain.unionByName(lines.where("not common").select(*key, read("t").alias("x")).select(*key, "x.*"))


def _folded_titles(titles: DataFrame, known: Confusions) -> DataFrame:
    @F.pandas_udf(T.StringType())
    def fold_all(texts: pd.Series) -> pd.Series:
        return pd.Series([known.fold(t) for t in texts], dtype=object)

    return titles.where(F.trim("title") != "").withColumn("rest", fold_all("title")).where(F.length("rest") >= 3)


def head_texts(pages: DataFrame, books: DataFrame, chapters: DataFrame) -> DataFrame:
    """line_texts() of pages, up to the length that a running head may have."""
    longest = max((r[0] or 0) for r in books.select(F.length("title").alias("n")).unionByName(chapters.select(F.length("title").alias("n"))).agg(F.max("n")).collect())
    return line_texts(pages, HEAD_FACTOR * longest + HEAD_MORE)


def page_edges(pages: DataFrame, books: DataFrame, chapters: DataFrame, known: Confusions = KNOWN, lines: DataFrame | None = None) -> DataFrame:
    """(id, line, noise) of the lines at head and foot of pages that are running heads or page numbers.

    pages: id, document_id, page_number, text. books: document_id, title. chapters: document_id, title, start_page.
    lines: as head_texts() gives them. Titles are compared by equality of their folded form, an equi-join by book. A number is the page's when it keeps
    the distance from the page's place that most numbers of the book keep; a roman one, where the printed count has
    not begun. A title of a chapter on the page where it opens, or with its word and number before it, is its heading.
    """
    edges = cut(edge_lines(head_texts(pages, books, chapters) if lines is None else lines, known))
    of = lambda text: F.xxhash64("document_id", text)  # noqa: E731  # slim keys of a book's titles; 64 bits for a book's few lines
    titles = books.select("document_id", "title", F.lit(None).cast("int").alias("start_page"), F.lit(True).alias("book")).unionByName(chapters.select("document_id", "title", "start_page", F.lit(False).alias("book")))
    titles = _folded_titles(titles, known).groupBy(of("rest").alias("h")).agg(F.max("book").alias("book"), F.collect_set("start_page").alias("starts"))
    forms = F.concat(F.array(F.struct(F.col("rest"), F.lit(False).alias("part"))), F.when(F.col("whole").isNotNull(), F.array(F.struct(F.col("whole").alias("rest"), F.lit(False).alias("part")))).otherwise(F.expr("array()")), F.coalesce(F.transform("parts", lambda p: F.struct(p.alias("rest"), F.lit(True).alias("part"))), F.expr("array()")))
    named = edges.where(F.length("rest") >= 3).select("id", "document_id", "page_number", "line", "heading", F.explode(forms).alias("t")).where(F.length("t.rest") >= 3).select("id", "page_number", "line", "heading", F.col("t.part").alias("part"), of("t.rest").alias("h"))
    named = cut(named.join(titles, "h"))
    # Where no start is known, a chapter opens on the first page that bears its title.
    opens = named.groupBy("h").agg(F.min("page_number").alias("first"), F.min(F.when(F.col("heading"), F.col("page_number"))).alias("headed"), F.countDistinct("page_number").alias("on_pages"))
    repeated = F.when(F.col("book") & (F.size("starts") == 0), F.col("on_pages") > 1).otherwise(~F.array_contains("starts", F.col("page_number")) & ((F.size("starts") > 0) | (F.coalesce("headed", "first") != F.col("page_number"))))
    heads = named.join(opens, "h").where(~F.col("heading") & (F.col("part") | repeated)).select("id", "line", F.lit("header").alias("noise")).distinct()

    votes = edges.where(F.col("number").isNotNull()).groupBy("document_id", (F.col("page_number").cast("bigint") - F.col("number")).alias("offset")).agg(F.countDistinct("page_number").alias("n"))
    printed = pages.select("document_id", (F.col("page_number") - F.get_json_object("metadata", "$.printed_page").try_cast("int")).alias("offset")).where(F.col("offset").isNotNull()).groupBy("document_id", "offset").agg(F.count(F.lit(1)).alias("n"))
    offsets = votes.unionByName(printed).groupBy("document_id", "offset").agg(F.sum("n").alias("n")).groupBy("document_id").agg(F.max_by("offset", F.struct("n", -F.abs("offset"))).alias("offset"), F.max("n").alias("n")).where("n >= 2")
    numbered = edges.where(F.col("number").isNotNull() | F.col("roman").isNotNull()).join(offsets, "document_id", "left")
    is_page = (F.col("number") == F.col("page_number") - F.col("offset")) | (F.col("roman").isNotNull() & (F.col("page_number") <= F.coalesce("offset", F.lit(0))) & (F.abs(F.col("roman") - F.col("page_number")) < 40))
    numbers = numbered.where(is_page).select("id", "line", (F.col("rest") == "").alias("alone"), F.lit("page_number").alias("noise"))
    # Beside anything but a title a number is part of the text.
    beside = numbers.where("not alone").join(named.select("id", "line"), ["id", "line"], "left_semi")
    numbers = numbers.where("alone").unionByName(beside).drop("alone").distinct()
    return heads.unionByName(numbers)


def _blanked(text: Column, more: str = "") -> Column:
    return F.translate(text, SIGNS + more, " " * len(SIGNS + more))


def lines_of(text: Column) -> Column:
    """The lines of a text; a CRLF counts as two ends, so that the numbers are those of a split by single characters."""
    return F.split(F.replace(text, F.lit("\r"), F.lit("\n")), "\n")


def _joined(text: Column) -> Column:
    """A text whose words broken over lines are whole; marks at line ends go."""
    return F.regexp_replace(text, rf"[{MARKS}](?<=[{W}].)[ \t\xa0]*\r?\n[ \t\xa0]*(?=[{W}])", "")  # the mark first: few places have one


def raw_tokens(text: Column) -> Column:
    """What stands between blanks and line ends, signs and all, once words broken over lines are whole. Texts are only split at blanks; the distinct tokens are taken apart."""
    t = _joined(text)
    for c in "\n\r\t\xa0":
        t = F.replace(t, F.lit(c), F.lit(" "))
    return F.split(t, " ")


def raw_counts(pages: DataFrame) -> DataFrame:
    """(raw, n) of all tokens of the pages."""
    return pages.select(F.explode(raw_tokens(F.col("text"))).alias("raw")).where(F.col("raw") != "").groupBy("raw").agg(F.count(F.lit(1)).alias("n"))


def words_of(raw: DataFrame) -> DataFrame:
    """(word, n) of all words and hyphenated compounds of tokens (raw, n), in lower case; the words of compounds count too."""
    tokens = raw.select("n", F.explode(F.split(_blanked(F.col("raw")), " ")).alias("word")).where(F.col("word") != "")
    counts = tokens.groupBy(F.lower(F.regexp_replace("word", "^-+|-+$", "")).alias("word")).agg(F.sum("n").alias("n"))
    counts = cut(counts.where(F.col("word").rlike(r"[\p{L}@]")))  # small, and read twice
    parts = counts.where(F.instr("word", "-") > 0).select(F.explode(F.split("word", "-+")).alias("word"), "n")
    return counts.unionByName(parts).where(F.col("word") != "").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(pages: DataFrame) -> DataFrame:
    """words_of() the pages."""
    return words_of(raw_counts(pages))


#: Values of characters are below VALUES, and sums are taken modulo SUMS, so that words of any length fit 64 bits.
VALUES, SUMS = 1 << 47, 1 << 62


def anagram(word: Column) -> Column:
    """The sum of the values of the characters: the same for all orders of them."""
    return F.aggregate(F.transform(F.split(word, ""), lambda c: F.pmod(F.xxhash64(c), F.lit(VALUES))), F.lit(0).cast("bigint"), lambda a, x: F.pmod(a + x, F.lit(SUMS)))


def _value_of(group: str) -> int:
    """anagram() of a group of characters."""
    return sum(xxhash.xxh64_intdigest(c.encode(), seed=42) % VALUES for c in group)


def _is_plain() -> Column:
    """Words of three characters or more that may be misread; shorter ones can't be told from the numbers of exercises, as "1a"."""
    return (F.length("word") >= 3) & (F.instr("word", "-") == 0) & ~F.col("word").rlike(ORDINAL) & F.col("word").rlike(r"[\p{L}]")


def _spread(words: DataFrame) -> DataFrame:
    """Words over all cores, as each makes many rows and their table is small."""
    return words.repartition(2 * words.sparkSession.sparkContext.defaultParallelism, "word")


def _plain(words: DataFrame) -> DataFrame:
    return words.where(_is_plain()).withColumn("h", anagram(F.col("word")))


def exchanges(words: DataFrame) -> DataFrame:
    """(a, b, rare, near, rights): how many words of `words` become a more frequent one when a at one place is exchanged for b, both of up to two characters.

    rare are those of which the other is RATIO times as frequent, near the others, rights the different words that
    rare ones become. Two words meet where what is left of both before and behind a and b has the same hash.
    """
    n, word = F.length("word"), F.col("word")
    places = F.flatten(F.transform(F.sequence(F.lit(0), n), lambda i: F.transform(F.sequence(F.lit(0), F.least(F.lit(2), n - i)), lambda k: F.struct(F.substr(word, i + 1, k).alias("g"), F.xxhash64(F.substr(word, F.lit(1), i), F.substr(word, i + k + 1)).alias("rest"), ((i > 0) & (i + k < n)).alias("within")))))
    cuts = _spread(words).where((n >= 4) & _is_plain()).select("n", F.xxhash64("word").alias("w"), F.explode(places).alias("x")).select("n", "w", "x.g", "x.rest", "x.within")
    left = cuts.select("rest", "within", F.col("g").alias("a"), "n")
    right = cuts.where("n >= 3").select("rest", F.col("g").alias("b"), F.col("n").alias("m"), F.col("w").alias("right"))
    met = left.join(right.hint("shuffle_hash"), "rest").where((F.col("m") > F.col("n")) & (F.col("a") != F.col("b")))
    # Nothing at either end of a and b is the same, so that each exchange is found once.
    ends = (F.col("a") == "") | (F.col("b") == "") | (F.left("a", F.lit(1)) != F.left("b", F.lit(1))) & (F.right("a", F.lit(1)) != F.right("b", F.lit(1)))
    # What is only added or lost is one character within a word: at their ends words are inflected, or joined with others.
    inside = (F.col("a") != "") & (F.col("b") != "") | (F.length("a") + F.length("b") == 1) & F.col("within")
    rare = F.col("m") >= RATIO * F.col("n")
    return met.where(ends & inside).groupBy("a", "b").agg(F.count_if(rare).alias("rare"), F.count_if(~rare).alias("near"), F.countDistinct(F.when(rare, F.col("right"))).alias("rights"))


def learn(words: DataFrame) -> Confusions:
    """The confusions known beforehand and those that the words show, weighted by how many words show them.

    Exchanges by which words are inflected relate words of all frequencies, misreading makes rare ones of frequent ones.
    At most the square of the number of groups of two characters comes to the driver, and of that what recurs.
    """
    found = {(r.a, r.b): r for r in exchanges(words).where((F.col("rare") >= SUPPORT) & (F.col("rights") >= RIGHT_WORDS)).collect()}
    learnt = {k for k, r in found.items() if r.rare >= SHARE * (r.rare + r.near)}
    # A confusion beside which something else was added is not another one.
    simple = [(a, b) for a, b in learnt if not any(x != (a, b) and x[0] in a and x[1] in b and found[x].rare >= found[a, b].rare for x in learnt)]
    pairs = [*CONFUSIONS, *sorted(k for k in simple if k not in CONFUSIONS)]
    return Confusions(tuple(pairs), tuple(float(1 + found[k].rare) if k in found else 1.0 for k in pairs))


def corrections(words: DataFrame, known: Confusions = KNOWN) -> DataFrame:
    """(word, right) for misread words: a frequent word that one or two confusions turn into the rare one; right is null where it isn't known.

    Of several, one exchange goes before two, then weighs how often the confusions and the right word occur.
    """
    plain = _plain(_spread(words))
    single = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(_value_of(b) - _value_of(a)).cast("bigint").alias("d"), F.lit(math.log(w)).alias("w")) for (a, b), w in zip(known.pairs, known.weights, strict=True)])
    possible = F.filter(single, lambda c: (c["a"] == "") | (F.instr(F.col("word"), c["a"]) > 0))
    none = F.struct(F.lit("").alias("a"), F.lit("").alias("b"), F.lit(0).cast("bigint").alias("d"), F.lit(0.0).alias("w"))
    # What is lost whole stands beside letters of its own script.
    rare = plain.withColumn("cs", F.filter(possible, lambda c: (c["a"] != "") | F.col("word").rlike(r"[ऄ-ह]") | ~c["b"].rlike("[ऀ-ॿ]")))
    pairs = rare.where(F.size("cs") > 0).select("word", "n", "h", F.explode("cs").alias("c1"), F.concat(F.array(none), F.col("cs")).alias("cs")).select("word", "n", "h", "c1", F.explode("cs").alias("c2"))
    keyed = pairs.where((F.col("c2.a") == "") & (F.col("c2.b") == "") | (F.col("c1.a") <= F.col("c2.a"))).select("word", "n", F.pmod(F.col("h") + F.col("c1.d") + F.col("c2.d"), F.lit(SUMS)).alias("h"), F.col("c1.a").alias("a1"), F.col("c1.b").alias("b1"), F.col("c2.a").alias("a2"), F.col("c2.b").alias("b2"), (F.col("c1.w") + F.col("c2.w")).alias("w"))
    frequent = plain.where("n >= 3").select(F.col("word").alias("right"), F.col("n").alias("m"), "h")
    odd_ = lambda c: F.col(c).rlike(known.odd)
    # A word has some hundred keys, of which hardly one meets a word: they are dropped where they are made, if they can be.
    few = frequent.limit(BROADCAST_WORDS + 1).count() <= BROADCAST_WORDS
    found = keyed.join(F.broadcast(frequent) if few else frequent, "h").where((F.col("m") >= RATIO * F.col("n")) | odd_("word") & ~odd_("right"))
    # Equal hashes are anagrams, not yet exchanges: the exchange must be possible at places in order.
    found = found.where(_exchanges("word", "right", "a1", "b1", "a2", "b2"))
    two = F.when((F.col("a2") == "") & (F.col("b2") == ""), 0).otherwise(1)
    best = found.groupBy("word").agg(F.min_by("right", F.struct(two.alias("t"), (-F.col("w") - F.log("m")).alias("s"), "right")).alias("right"))
    odd = plain.where(odd_("word")).select("word")
    return best.select("word", "right").join(odd, "word", "full")


@F.pandas_udf(T.BooleanType())
def _exchanges(words: pd.Series, rights: pd.Series, a1: pd.Series, b1: pd.Series, a2: pd.Series, b2: pd.Series) -> pd.Series:
    def one(word: str, right: str, pairs: list[tuple[str, str]]) -> bool:
        if not pairs:
            return word == right
        a, b = pairs[0]
        at = range(len(word) + 1) if a == "" else [m.start() for m in re.finditer(f"(?={re.escape(a)})", word)]
        return any(one(word[:i] + b + word[i + len(a) :], right, pairs[1:]) for i in at)

    return pd.Series([one(w, r, [(a, b), *([(c, d)] if c or d else [])]) for w, r, a, b, c, d in zip(words, rights, a1, b1, a2, b2, strict=True)], dtype=bool)


def broken_words(pages: DataFrame, words: DataFrame, known: Confusions = KNOWN) -> DataFrame:
    """(id, left, right) of each word that is broken over two lines and is written without hyphen elsewhere.

    A compound is known by its hyphenated form within lines, more frequent than the form without; forms count as
    folded, so that misread ones count with the right ones. Where neither is known, the mark is taken for a break.
    """
    lines = F.split(F.regexp_replace(F.lower("text"), "\r", ""), "\n")
    ends = F.transform("l", lambda x: F.right(F.btrim(x, F.lit(" \t\xa0")), F.lit(1)).isin(*MARKS))
    rows = pages.where(F.col("text").rlike(rf"[{MARKS}][ \t\xa0]*\r?\n")).select("id", lines.alias("l")).select("id", "l", ends.alias("e")).where(F.exists("e", lambda x: x))
    at = F.filter(F.sequence(F.lit(0), F.size("l") - 1), lambda i: F.col("e")[i] & (i < F.size("l") - 1))
    pair = F.transform(at, lambda i: F.struct(F.regexp_extract(F.col("l")[i], rf"([{W}]+(?:-[{W}]+)*)[{MARKS}][ \t\xa0]*$", 1).alias("left"), F.regexp_extract(F.col("l")[i + 1], rf"^[ \t\xa0]*([\p{{L}}\p{{M}}][{W}]*(?:-[{W}]+)*)", 1).alias("right")))
    found = cut(rows.select("id", F.explode(pair).alias("b")).select("id", "b.left", "b.right").where("left <> '' and right <> ''"))  # slim, and read twice
    keys = found.select("left", "right").distinct().withColumn("joined", known.folded(F.concat("left", "right"))).withColumn("compound", known.folded(F.concat_ws("-", "left", "right")))
    forms = words.groupBy(known.folded(F.col("word")).alias("form")).agg(F.sum("n").alias("n"))
    keys = keys.join(forms.select(F.col("form").alias("joined"), F.col("n").alias("whole")), "joined", "left").join(forms.select(F.col("form").alias("compound"), F.col("n").alias("parted")), "compound", "left")
    whole = keys.where(F.coalesce("parted", F.lit(0)) <= F.coalesce("whole", F.lit(0))).select("left", "right")
    return found.join(whole, ["left", "right"])


def wrong_tokens(raw: DataFrame, wrong: DataFrame) -> DataFrame:
    """(raw, word, right) of the tokens that hold misread words, in any letter case; a row for each place of a word in a token."""
    parts = raw.select("raw", F.explode(F.split(_blanked(F.col("raw"), "-"), " ")).alias("word")).where(F.length("word") > 2)
    return parts.select("raw", F.lower("word").alias("word")).join(wrong, "word")


def misread_words(texts: DataFrame, wrong_raw: DataFrame) -> DataFrame:
    """(id, word, right, n): how often each misread word stands in the texts (id, text)."""
    found = _wrong_in(texts.select("id", F.explode(raw_tokens(F.col("text"))).alias("raw")), wrong_raw)
    return found.groupBy("id", "word", "right").agg(F.count(F.lit(1)).alias("n"))


def _wrong_in(tokens: DataFrame, wrong_raw: DataFrame) -> DataFrame:
    few = wrong_raw.limit(BROADCAST_WORDS + 1).count() <= BROADCAST_WORDS
    return tokens.where(F.length("raw") > 2).join(F.broadcast(wrong_raw) if few else wrong_raw, "raw")


def trusted(misread: DataFrame, known: Confusions = KNOWN) -> DataFrame:
    """The misread words of (id, word, right, n) without words that stand mostly alone.

    Misreading comes by the page. A right word that is only rarer than a similar one mostly stands on pages without
    two other misread words, and is dropped; words with a digit or sign for a letter stay.
    """
    page = misread.groupBy("id").agg(F.sum("n").alias("all"))
    support = misread.join(page, "id").groupBy("word").agg((F.sum(F.when(F.col("all") - F.col("n") >= 2, F.col("n")).otherwise(0)) / F.sum("n")).alias("support"))
    return misread.join(support.where((F.col("support") >= 0.5) | F.col("word").rlike(known.odd)).select("word"), "word", "left_semi")


@dataclass
class Noise:
    """What was found, each by page: lines (id, line, noise), misread words (id, word, right, n), breaks (id, left, right)."""

    lines: DataFrame
    misread: DataFrame
    breaks: DataFrame


def look(pages: DataFrame, books: DataFrame, chapters: DataFrame, words: DataFrame | None = None) -> Noise:
    rows = pages.where(F.length("text") > 0)
    raw = cut(raw_counts(rows))
    words = cut(words_of(raw)) if words is None else words
    known = learn(words)
    texts = head_texts(rows, books, chapters)
    lines = cut(page_edges(rows, books, chapters, known, texts))
    # The texts are read once for the misread words; what is found is small and read several times.
    wrong = cut(wrong_tokens(raw, corrections(words, known)))
    found = misread_words(rows, wrong)
    # Words of heads and page numbers don't count.
    at_edges = texts.select("id", "line", F.explode(raw_tokens(F.col("t"))).alias("raw"))
    # Cut before the semi-join, which Catalyst would otherwise push below the tokens and shuffle all of them for.
    heads = cut(_wrong_in(at_edges, wrong)).join(lines.select("id", "line").distinct(), ["id", "line"], "left_semi").groupBy("id", "word").agg(F.count(F.lit(1)).alias("h"))
    left = F.col("n") - F.coalesce("h", F.lit(0))
    misread = cut(found.join(heads, ["id", "word"], "left").select("id", "word", "right", left.alias("n")).where("n > 0"))
    return Noise(lines, trusted(misread, known), broken_words(rows, words, known))


def find_noise(pages: DataFrame, books: DataFrame, chapters: DataFrame, words: DataFrame | None = None) -> DataFrame:
    """(id, noise) of each page and kind of noise: `hyphen`, `misread`, `header`, `page_number`.

    pages: id, document_id, page_number, text, metadata (JSON). Null and empty texts are no case; repeated ids count as
    one page; pages of no document have no heads or numbers. Words that a page number or running head holds are not
    counted as misread.
    """
    found = look(pages, books, chapters, words)
    misread = found.misread.groupBy("id").agg(F.sum("n").alias("n")).where(F.col("n") >= MISREAD_WORDS).select("id", F.lit("misread").alias("noise"))
    hyphen = found.breaks.select("id", F.lit("hyphen").alias("noise")).distinct()
    return hyphen.unionByName(misread).unionByName(found.lines.select("id", "noise").distinct())


def mend(text: str, drop: set[int], right: dict[str, str], whole: set[tuple[str, str]]) -> str:
    """A page as paragraphs: without the lines to drop, words over two lines joined, misread words put right.

    A blank line ends a paragraph, and so does a line much shorter than the page's usual one that ends a sentence.
    """
    kept, at = [], 0
    for x in re.split("(\r\n|\r|\n)", text):
        if x in ("\r\n", "\r", "\n"):
            at += len(x)  # as lines_of() counts
        elif at not in drop:
            kept.append(x.rstrip())
    kept = "\n".join(kept)

    def join(m: re.Match) -> str:
        left, end = m["left"], m["end"]
        return left + end if (left.lower(), end.lower()) in whole else f"{left}-{end}"

    kept = _BREAK.sub(join, kept)
    if right:
        kept = _TOKEN.sub(lambda m: _like(m.group(), right.get(m.group().lower())), kept)
    width = sorted(len(x) for x in kept.split("\n") if x.strip())
    usual, out = width[len(width) // 2] if width else 0, [""]
    for x in kept.split("\n"):
        if not x.strip():
            out.append("")
        else:
            out[-1] = f"{out[-1]} {x.strip()}" if out[-1] else x.strip()
            if len(x) < 0.7 * usual and re.search(r"[.!?।॥:][\"'”’)]*$", x.strip()):
                out.append("")
    return "\n\n".join(x for x in out if x)


_BREAK = re.compile(rf"(?P<left>[\w@{_MARKS}-]*[\w@{_MARKS}])[-‐‑\xad¬][ \t\xa0]*\n[ \t\xa0]*(?P<end>[^\W\d_][\w@{_MARKS}-]*)")
_TOKEN = re.compile(rf"[\w@{_MARKS}]+")


def _like(word: str, right: str | None) -> str:
    if not right:
        return word
    return right.upper() if word.isupper() and len(word) > 1 else right[:1].upper() + right[1:] if word[:1].isupper() else right


@F.pandas_udf(T.StringType())
def _mend_udf(texts: pd.Series, drop: pd.Series, words: pd.Series, rights: pd.Series, lefts: pd.Series, ends: pd.Series) -> pd.Series:
    some = lambda x: [] if x is None else list(x)
    rows = zip(texts, drop, words, rights, lefts, ends, strict=True)
    return pd.Series([None if t is None else mend(t, set(some(d)), dict(zip(some(w), some(r), strict=True)), set(zip(some(a), some(b), strict=True))) for t, d, w, r, a, b in rows], dtype=object)


def mended_pages(pages: DataFrame, books: DataFrame, chapters: DataFrame, words: DataFrame | None = None) -> DataFrame:
    """(id, mended) of every page: its text in paragraphs, free of what look() finds; null for a null text."""
    found = look(pages, books, chapters, words)
    drop = found.lines.groupBy("id").agg(F.collect_set("line").alias("drop"))
    fixes = found.misread.where(F.col("right").isNotNull()).groupBy("id").agg(F.collect_set(F.struct("word", "right")).alias("fix"))
    breaks = found.breaks.groupBy("id").agg(F.collect_set(F.struct("left", "right")).alias("whole"))
    rows = pages.select("id", "text").join(drop.join(fixes, "id", "full").join(breaks, "id", "full"), "id", "left")
    return rows.select("id", _mend_udf("text", "drop", F.col("fix.word"), F.col("fix.right"), F.col("whole.left"), F.col("whole.right")).alias("mended"))
