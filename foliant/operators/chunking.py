"""Chunks within a token budget that keep to structure: plans, paragraph units, the fold, and their attributes.

Units of one chunk share their titles, and neither overlap nor merging crosses a change of titles, so runs of units of
equal titles are folded by themselves. A long run is folded in blocks of units: how a block ends depends on what is held
when it begins, so each block first says what would come of every possible beginning, these small tables are put
together in the order of the blocks, and then each block is folded from the beginning that is its own. All of it sees
sizes alone; the texts move when the chunks are known. The result does not depend on the size of the blocks.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.functions import text as X
from foliant.operators import structure
from foliant.operators.scan import carried, sums_before
from foliant.session import cut, ship

# Token limit, overlap and strategy by content profile.
PROFILES = {
    "math_textbook": (620, 90, "toc_structure_aware"), "question_bank": (520, 70, "question_block"), "science_textbook": (760, 110, "toc_structure_aware"), "grammar": (680, 100, "semantic_then_recursive"),
    "english_literature": (1000, 150, "paragraph_story"), "hindi_literature": (900, 140, "paragraph_story"), "mixed_textbook": (750, 120, "toc_structure_aware"), "unknown": (750, 120, "recursive_token"),
}
#: Below so many tokens a chunk joins the one before it, but for those of these kinds.
LEAST = 80
KEPT_SMALL = ("formula", "definition", "table", "vocabulary", "grammar_rule")
#: Pages at the start of a book that decide its profile.
SAMPLE_PAGES = 30


def default_overlap(limit: Column) -> Column:
    return F.when(limit <= 550, 70).when(limit <= 750, 100).when(limit <= 1000, 140).otherwise(180)


def counts(pages: DataFrame, text: str = "raw_text") -> DataFrame:
    """(document_id, tokens, questions, formulas, stories, grammar, science, d, l): hits over the first pages of each book, d and l its Devanagari and Latin letters."""
    c = F.col(text)
    n = lambda p: F.sum(F.coalesce(F.regexp_count(c, F.lit(f"(?iu){p}")), F.lit(0)))
    w = Window.partitionBy("document_id").orderBy("page_number", "id")
    head = pages.select("document_id", "page_number", "id", text).withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= SAMPLE_PAGES)
    return head.groupBy("document_id").agg(
        F.greatest(F.lit(1), F.sum(X.regex_token_count(c))).alias("tokens"), n(r"\?|exercise|objective questions|fill in|true or false|solve|अभ्यास|प्रश्न").alias("questions"),
        n(r"[=+×÷≤≥<>]|(?<![\p{L}\p{N}_])\p{Nd}+\s*/\s*\p{Nd}+(?![\p{L}\p{N}_])").alias("formulas"), n(r"(?<![\p{L}\p{N}_])(?:story|poem)(?![\p{L}\p{N}_])|कहानी|कविता").alias("stories"),
        n("grammar|vocabulary|noun|verb|adjective|व्याकरण|संज्ञा|सर्वनाम|क्रिया|विशेषण").alias("grammar"), n("experiment|activity|diagram|observe|science|evs|प्रयोग|विज्ञान").alias("science"),
        F.sum(X.devanagari_count(c)).alias("d"), F.sum(X.latin_count(c)).alias("l"),
    )


def profiles(pages: DataFrame, books: DataFrame, text: str = "raw_text") -> DataFrame:
    """(document_id, profile, max_tokens, overlap_tokens, strategy) by subject and counts over the first pages of each book."""
    s = F.lower(F.coalesce("subject", F.lit("")))
    named = lambda *words: s.rlike("|".join(words))
    profile = (
        F.when(named("math", "गणित") | (F.col("formulas") > F.greatest(F.lit(20), F.floor(F.col("tokens") / 80))), "math_textbook")
        .when(named("english", "literature"), "english_literature")
        .when(named("hindi"), "hindi_literature")
        .when((F.col("questions") > 60) & (F.col("tokens") < 12000), "question_bank")
        .when(named("grammar") | (F.col("grammar") >= 4), "grammar")
        .when(named("science", "evs") | (F.col("science") >= 4), "science_textbook")
        .when((F.col("stories") >= 2) & (F.col("d") > F.col("l")), "hindi_literature")
        .when(F.col("stories") >= 2, "english_literature")
        .when((F.least("d", "l") > 0) & (F.least("d", "l") / F.greatest("d", "l") > 0.15), "mixed_textbook")
        .otherwise("unknown")
    )
    plan = F.create_map(*[x for k, (m, o, g) in PROFILES.items() for x in (F.lit(k), F.struct(F.lit(m).alias("m"), F.lit(o).alias("o"), F.lit(g).alias("g")))])
    found = counts(pages, text).join(books.select(F.col("id").alias("document_id"), "subject"), "document_id", "left").withColumn("profile", profile)
    return found.select("document_id", "profile", plan[F.col("profile")]["m"].alias("max_tokens"), plan[F.col("profile")]["o"].alias("overlap_tokens"), plan[F.col("profile")]["g"].alias("strategy"))


def recommended(limit: Column, overlap: Column) -> tuple[Column, Column]:
    """A recommended limit and overlap where they are safe: 350 to 1400, 40 to the lesser of 220 and a third; else null."""
    ok = limit.between(350, 1400)
    good = overlap.between(40, F.least(F.lit(220), F.floor(limit / 3)))
    return F.when(ok, limit), F.when(ok, F.when(good, overlap).otherwise(default_overlap(limit)))


_TOKENS = re.compile(r"[^\W\d_]+|\d{1,3}|[^\w\s]+|_+")


def count(text: str) -> int:
    """Tokens of the default tokenizer for budgets: runs of letters, up to three digits, runs of signs."""
    return len(_TOKENS.findall(text))


def sized_paragraphs(text: str, limit: int) -> list[tuple[int, str]]:
    """(tokens, text) of the blocks between blank lines; blocks over the limit are packed from their sentences."""
    out: list[tuple[int, str]] = []
    for block in map(str.strip, re.split(r"\n\s*\n", text)):
        if not block:
            continue
        if (n := count(block)) <= limit:
            out.append((n, block))
            continue
        held: list[str] = []
        size = 0
        for part in map(str.strip, re.split(r"(?<=[.!?।॥])\s+", block)):
            n = count(part)  # no token goes over white space, so that counts add up
            if held and size + n > limit:
                out.append((size, " ".join(held)))
                held, size = [], 0
            if part:
                held.append(part)
                size += n
        if held:
            out.append((size, " ".join(held)))
    return out


def paragraphs(text: str, limit: int) -> list[str]:
    return [body for _, body in sized_paragraphs(text, limit)]


def windows(text: str, limit: int, overlap: int) -> list[str]:
    """A long unit in windows of tokens, each but the first beginning `overlap` tokens, a third at most, before the last one's end."""
    at = [m.start() for m in _TOKENS.finditer(text)]
    step = max(1, limit - min(overlap, limit // 3))
    return [text[at[i] : at[i + limit] if i + limit < len(at) else len(text)].strip() for i in range(0, max(1, len(at)), step)] if at else []


def fold(units: list[tuple[int, str]], limit: int, overlap: int, kind) -> list[tuple[int, int, str]]:
    """(first page, last page, text) of the chunks of a run of units (page, text) of equal titles, all in one go: what chunk_books gives in blocks."""
    chunks: list[list] = []

    def flush(group: list[tuple[int, str, int]]) -> None:
        body = "\n\n".join(x for _, x, _ in group).strip()
        if not body:
            return
        n, last = count(body), max(p for p, _, _ in group)
        if n < LEAST and chunks and chunks[-1][3] + n <= limit and kind(body) not in KEPT_SMALL:
            before = chunks[-1]
            before[1], before[2] = max(before[1], group[-1][0]), f"{before[2]}\n\n{body}"
            before[3] = count(before[2])
        else:
            chunks.append([min(p for p, _, _ in group), last, body, n])

    held: list[tuple[int, str, int]] = []
    for page, body in units:
        n = count(body)
        if n > limit:
            if held:
                flush(held)
                held = []
            for part in windows(body, limit, overlap):
                flush([(page, part, count(part))])
            continue
        if held and sum(k for _, _, k in held) + n > limit:
            flush(held)
            tail: list[tuple[int, str, int]] = []
            for u in reversed(held):
                if overlap <= 0 or sum(k for _, _, k in tail) + u[2] > overlap:
                    break
                tail.insert(0, u)
            held = tail
        held.append((page, body, n))
    if held:
        flush(held)
    return [(a, b, c) for a, b, c, _ in chunks]


#: Units of a block, at least; a page's units go to the bin of so many pages. Neither changes the result.
BLOCK, BIN_PAGES = 4096, 512
UNITS = "document_id string, page_number int, u int, n int, body string"


def flushes(n: list[int], held: int, at: int, limit: int, overlap: int):
    """((first, end), (at, held)) of each group of units that is closed, with the place and the first unit held after it.

    n are sizes; a negative one is a piece of a long unit, a group by itself. From (at, held) on the rest is determined.
    """
    total = sum(n[held:at])
    while at < len(n):
        k = n[at]
        if k < 0:
            if at > held:
                yield (held, at), (at, at)
            yield (at, at + 1), (at + 1, at + 1)
            at += 1
            held, total = at, 0
            continue
        if at > held and total + k > limit:
            first, tail = at, 0
            while first > held and tail + n[first - 1] <= overlap:
                first -= 1
                tail += n[first]
            yield (held, at), (at + 1, first)  # the unit that was too much is taken on in any case
            held, total = first, tail
        total += k
        at += 1


def size_of(n: list[int], first: int, end: int) -> int:
    return sum(map(abs, n[first:end]))


def outcomes(n: list[int], before: list[int], limit: int, overlap: int) -> list[tuple[int, int, tuple[int, ...]]]:
    """For a block of sizes n, by how many units of `before` are held when it begins: (units held at its end, groups closed, sizes of the last two).

    Folds from different beginnings soon meet; what follows is worked out once.
    """
    whole, base = [*before, *n], len(before)
    known: dict[tuple[int, int], tuple] = {}
    out = []
    for held in range(base + 1):
        if held and (before[-held] < 0 or size_of(before, base - held, base) > limit + overlap):
            break
        trail, first, end = [], base - held, None
        for (a, b), state in flushes(whole, first, base, limit, overlap):
            trail.append((state, size_of(whole, a, b)))
            first = state[1]
            if end := known.get(state):
                break
        end = end or (len(whole) - first, 0, ())
        for state, size in reversed(trail):
            known.setdefault(state, end)
            end = (end[0], end[1] + 1, end[2] if len(end[2]) == 2 else (size, *end[2]))
        out.append(end)
    return out


OUTCOMES = T.ArrayType(T.StructType([T.StructField("held", T.IntegerType()), T.StructField("closed", T.IntegerType()), T.StructField("sizes", T.ArrayType(T.IntegerType()))]))
GROUPS = T.ArrayType(T.StructType([T.StructField(c, T.IntegerType()) for c in ("first", "end", "n", "n1", "n2")]))


@F.pandas_udf(OUTCOMES)
def _outcomes_udf(n: pd.Series, before: pd.Series, limit: pd.Series, overlap: pd.Series) -> pd.Series:
    rows = zip(n, before, limit, overlap, strict=True)
    return pd.Series([[{"held": h, "closed": c, "sizes": list(s)} for h, c, s in outcomes(list(map(int, x)), list(map(int, b)), int(m), int(o))] for x, b, m, o in rows], dtype=object)


@F.pandas_udf(GROUPS)
def _groups_udf(n: pd.Series, before: pd.Series, held: pd.Series, limit: pd.Series, overlap: pd.Series, last: pd.Series, sizes: pd.Series) -> pd.Series:
    """Groups closed in a block, as places in before + n, with the sizes of the two before them in the run."""
    out = []
    for x, b, h, m, o, end, s in zip(n, before, held, limit, overlap, last, sizes, strict=True):
        whole, base = [*map(int, b), *map(int, x)], len(b)
        first, found, past = base - int(h), [], [None, None, *map(int, s)]
        groups = []
        for group, state in flushes(whole, first, base, int(m), int(o)):
            groups.append(group)
            first = state[1]
        if end and first < len(whole):
            groups.append((first, len(whole)))
        for a, z in groups:
            k = size_of(whole, a, z)
            found.append({"first": a, "end": z, "n": k, "n1": past[-1], "n2": past[-2]})
            past.append(k)
        out.append(found)
    return pd.Series(out, dtype=object)


def _in_order(run: pd.DataFrame) -> pd.DataFrame:
    """What each block of a run begins with: units held, groups closed before, sizes of the last two of them."""
    held, closed, sizes, rows = 0, 0, (), []
    for r in run.sort_values("block").itertuples():
        rows.append((r.document_id, r.run, r.block, held, closed, list(sizes)))
        held, c, s = r.m[held]["held"], r.m[held]["closed"], r.m[held]["sizes"]
        closed, sizes = closed + int(c), (*sizes, *map(int, s))[-2:]
        held = int(held)
    return pd.DataFrame(rows, columns=["document_id", "run", "block", "held", "closed", "sizes"])


def units(pages: DataFrame, plans: DataFrame, text: str) -> DataFrame:
    """(document_id, page_number, u, n, body, level, number, title): paragraphs of the cleaned pages in order, n their tokens; pieces of units over the limit have -n. Cut: all that follows reads it."""
    limit, overlap, _ = PROFILES["unknown"]
    rows = pages.join(plans, "document_id", "left").select("document_id", "page_number", F.coalesce("max_tokens", F.lit(limit)).alias("m"), F.coalesce("overlap_tokens", F.lit(overlap)).alias("o"), F.col(text).alias("t"))

    def split(batches):
        for batch in batches:
            out = []
            for doc, page, most, back, t in zip(batch["document_id"], batch["page_number"], batch["m"], batch["o"], batch["t"], strict=True):
                pieces: list[tuple[int, str]] = []
                for n, body in sized_paragraphs(X.clean(t), most):
                    pieces += [(n, body)] if n <= most else [(-count(x), x) for x in windows(body, most, back) if x]
                out += [(doc, page, u, n, body) for u, (n, body) in enumerate(pieces)]
            yield pd.DataFrame(out, columns=["document_id", "page_number", "u", "n", "body"])

    h = F.when(F.length("body") <= 160, X.heading(F.col("body")))
    # The heading is written whole: its fields apart would each have it worked out anew.
    found = rows.where(F.col("t").isNotNull() & F.col("page_number").isNotNull() & F.col("document_id").isNotNull()).mapInPandas(split, UNITS)
    return cut(found.withColumn("h", h)).select("document_id", "page_number", "u", "n", "body", "h.level", "h.number", "h.title")


KEY_TITLES = ["chapter_title", "unit_title", "lesson_title", "section_title"]
#: What else a unit has from its place; a change of these alone begins no run.
PLACE = ["chapter_number", "unit_number", "section_number", "topic"]


def placed_units(slim: DataFrame, records: DataFrame) -> DataFrame:
    """(document_id, page_number, u, n, titles, PLACE, run, place): each unit with its titles, the number of the first unit of its run in the book, and its own place in the run.

    The titles and numbers are those of the record that its page belongs to; after such a page, and where there is none,
    a heading sets its own and clears the section's below it. The topic is that of the page, the title of its section,
    lesson or chapter, until a heading of a section or topic sets another.
    """
    at = structure.resolve_pages(slim.select("document_id", "page_number").distinct(), records)
    of = {c: structure.filled(F.col(f"record.{c}")) for c in KEY_TITLES}
    has = F.coalesce(*of.values()).isNotNull()
    level = F.col("level")
    own = {c: F.when(level == c, F.col("title")) for c in KEY_TITLES}
    own["section_title"] = F.when(level.isin("chapter_title", "unit_title", "lesson_title"), F.lit("")).otherwise(own["section_title"])
    numbers = PLACE[:3]
    of |= {c: structure.filled(F.col(f"record.{c}")) if c in records.columns else F.lit(None).cast("string") for c in numbers}
    own |= {c: F.when(level == c.replace("number", "title"), F.coalesce("number", F.lit(""))) for c in numbers}
    own["section_number"] = F.when(level.isin("unit_title", "lesson_title"), F.lit("")).otherwise(own["section_number"])
    events = slim.join(at.select("document_id", "page_number", has.alias("has"), *[v.alias(f"r_{c}") for c, v in of.items()]), ["document_id", "page_number"])
    told = F.when(level.isin("topic", "section_title"), F.col("title")).when(level.isin("chapter_title", "unit_title", "lesson_title"), F.lit(""))
    topic = F.coalesce(told, F.when(F.col("has") & (F.col("u") == 0), F.coalesce("r_section_title", "r_lesson_title", "r_chapter_title", F.lit("")))).alias("topic")
    events = events.select("document_id", "page_number", "u", "n", F.floor(F.col("page_number") / BIN_PAGES).alias("bin"), *[F.when(F.col("has"), F.coalesce(f"r_{c}", F.lit(""))).otherwise(own[c]).alias(c) for c in KEY_TITLES + numbers], topic)
    order = ["page_number", "u"]
    known = carried(events, "document_id", "bin", order, KEY_TITLES + PLACE, "g")
    w = Window.partitionBy("document_id", "bin").orderBy(*order)
    titles = lambda suffix="": F.struct(*[F.coalesce(f"{c}{suffix}", F.lit("")).alias(c) for c in KEY_TITLES])
    before = F.when(F.row_number().over(w) == 1, titles("_in")).otherwise(F.lag(titles()).over(w))
    starts = known.withColumn("run", F.when((F.col("g") == 0) | (before != titles()), F.col("g")))
    out = carried(starts.drop(*[f"{c}_in" for c in KEY_TITLES + PLACE]), "document_id", "bin", order, ["run"])
    return out.select("document_id", *order, "n", *[F.nullif(c, F.lit("")).alias(c) for c in KEY_TITLES + PLACE], "run", (F.col("g") - F.col("run")).alias("place"))


def groups_of(placed: DataFrame, plans: DataFrame) -> DataFrame:
    """(document_id, run, number, g, n, n1, n2, most, titles, PLACE of the last unit, places): the groups of units that the fold closes, in the order g of their book.

    number counts them in their run, n1 and n2 are the sizes of the two before in it, places are (page_number, u).
    """
    limit, overlap, _ = PROFILES["unknown"]
    most, back = F.greatest(F.lit(2 * LEAST), F.coalesce("max_tokens", F.lit(limit))), F.coalesce("overlap_tokens", F.lit(overlap))
    rows = placed.join(plans, "document_id", "left").withColumn("most", most).withColumn("back", back)
    rows = rows.withColumn("block", F.floor(F.col("place") / F.greatest(F.lit(BLOCK), 2 * (F.col("most") + F.col("back")))))
    blocks = rows.groupBy("document_id", "run", "block").agg(*[F.first(c).alias(c) for c in ("most", "back", *KEY_TITLES)], F.array_sort(F.collect_list(F.struct("place", "n", "page_number", "u", *PLACE))).alias("x"))
    w = Window.partitionBy("document_id", "run").orderBy("block")
    kept = F.least(F.size("x"), F.col("most") + F.col("back"))
    blocks = blocks.withColumn("before", F.coalesce(F.lag(F.slice("x", -kept, kept)).over(w), F.slice("x", 1, 0))).withColumn("last", F.lead("block").over(w).isNull())
    blocks = cut(blocks)
    several = blocks.where(~((F.col("block") == 0) & F.col("last"))).select("document_id", "run", "block", _outcomes_udf("x.n", "before.n", "most", "back").alias("m"))
    begun = several.groupBy("document_id", "run").applyInPandas(_in_order, "document_id string, run bigint, block bigint, held int, closed int, sizes array<int>")
    none = F.expr("cast(array() as array<int>)")
    from_ = blocks.join(begun, ["document_id", "run", "block"], "left").withColumn("held", F.coalesce("held", F.lit(0))).withColumn("closed", F.coalesce("closed", F.lit(0))).withColumn("sizes", F.coalesce("sizes", none))
    found = from_.withColumn("groups", _groups_udf("x.n", "before.n", "held", "most", "back", "last", "sizes")).withColumn("bin", F.floor(F.col("run") / BLOCK))
    found = sums_before(found, "document_id", "bin", ["run", "block"], F.size("groups"), "g0")
    all_places = F.transform(F.concat("before", "x"), lambda p: F.struct(*[p[c].alias(c) for c in ("page_number", "u", *PLACE)]))
    each = found.select("document_id", "run", "closed", "g0", "most", *KEY_TITLES, all_places.alias("all"), F.posexplode("groups").alias("i", "group"))
    return each.select("document_id", "run", (F.col("closed") + F.col("i")).alias("number"), (F.col("g0") + F.col("i")).alias("g"), "group.n", "group.n1", "group.n2", "most", *KEY_TITLES, *[F.col("all")[F.col("group.end") - 1][c].alias(c) for c in PLACE], F.slice("all", F.col("group.first") + 1, F.col("group.end") - F.col("group.first")).alias("places"))


def merges(bodies: DataFrame) -> DataFrame:
    """(document_id, g): small groups that join the chunk before them.

    A group is small below LEAST tokens unless its kind is kept. Of three groups in a row at least one is not small: the
    one after a group that was closed because the next unit was too much holds more, and so does the first piece of a
    long unit; so the two groups before say what the chunk before holds.
    """
    small = bodies.where((F.col("n") < LEAST) & F.col("n1").isNotNull()).select("document_id", "run", "number", "g", "n", "n1", "n2", "most", X.content_type(F.col("body")).alias("kind")).where(~F.col("kind").isin(*KEPT_SMALL))
    small = cut(small)
    after = small.select("document_id", "run", (F.col("number") + 1).alias("number"), F.lit(True).alias("second"))
    both = small.join(after, ["document_id", "run", "number"], "left")
    two = F.coalesce(F.col("second") & (F.col("n1") + F.col("n2") <= F.col("most")), F.lit(False))
    holds = F.when(two, F.col("n1") + F.col("n2")).otherwise(F.col("n1"))
    return both.where(holds + F.col("n") <= F.col("most")).select("document_id", "g")


def chunk_books(pages: DataFrame, records: DataFrame, plans: DataFrame, text: str = "raw_text") -> DataFrame:
    """(document_id, chunk_index, page_start, page_end, chapter_title, unit_title, lesson_title, section_title, columns of PLACE, content).

    pages holds a page once. Pages are resolved to the records of their book; what a page without a record has is told
    by the headings on it, and by what came before. Null and blank pages are left out; a book without a plan has the one
    of `unknown`; a limit below twice LEAST counts as that. Texts are cleaned once and move by page, group and chunk,
    never by book.
    """
    ship(pages.sparkSession)
    plan = cut(plans.select("document_id", "max_tokens", "overlap_tokens"))  # a row a book, and read twice
    whole = units(pages, plan.withColumn("max_tokens", F.greatest("max_tokens", F.lit(2 * LEAST))), text)
    groups = groups_of(placed_units(whole.drop("body"), records), plan)
    spread = groups.select("document_id", "run", "number", "g", "n", "n1", "n2", "most", *KEY_TITLES, *PLACE, F.posexplode("places").alias("i", "p")).select("*", "p.page_number", "p.u").drop("p")
    parts = spread.join(whole.select("document_id", "page_number", "u", "body"), ["document_id", "page_number", "u"])
    same = ["run", "number", "n", "n1", "n2", "most", *KEY_TITLES, *PLACE]
    joined = lambda key, body: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(key, body))), lambda x: x[body]), "\n\n")
    bodies = cut(parts.groupBy("document_id", "g").agg(*[F.first(c).alias(c) for c in same], F.min("page_number").alias("page_start"), F.max("page_number").alias("page_end"), joined("i", "body").alias("body")))
    # By bin of groups: how many were merged before it, and which in it. A merged group gets the index of the one it
    # joins, as it counts among those merged up to itself.
    bin_ = F.floor(F.col("g") / BLOCK).alias("bin")
    gone = merges(bodies).groupBy("document_id", bin_).agg(F.collect_list("g").alias("gone"))
    bins = bodies.select("document_id", bin_).distinct().join(gone, ["document_id", "bin"], "left").withColumn("gone", F.coalesce("gone", F.expr("cast(array() as array<bigint>)")))
    bins = sums_before(bins.withColumn("all", F.lit(0)), "document_id", "all", ["bin"], F.size("gone"), "less").drop("all")
    index = F.col("g") - F.col("less") - F.size(F.filter("gone", lambda x: x <= F.col("g")))
    chunks = bodies.select("*", bin_).join(bins, ["document_id", "bin"]).withColumn("chunk_index", index.cast("int"))
    titles = [F.first(c).alias(c) for c in KEY_TITLES]
    out = chunks.groupBy("document_id", "chunk_index").agg(F.min("page_start").alias("page_start"), F.max("page_end").alias("page_end"), *titles, *[F.max_by(c, "g").alias(c) for c in PLACE], joined("g", "body").alias("content"))
    return out.select("document_id", "chunk_index", "page_start", "page_end", "chapter_title", "unit_title", "lesson_title", "section_title", *PLACE, "content")


def enrich(chunks: DataFrame, books: DataFrame) -> DataFrame:
    """Chunks with the attributes that search and citation need, in one projection over chunks that were cut once."""
    b = books.select(F.col("id").alias("document_id"), "book_title", "title", "school_name", "class_name", "grade", "board", "subject", "language", (F.col("medium") if "medium" in books.columns else F.lit(None).cast("string")).alias("medium"))
    c, kind = F.col("content"), F.col("chunk_type")
    rows = cut(chunks).join(b, "document_id", "left").withColumn("chunk_type", X.content_type(c)).withColumn("book_title", F.coalesce(F.nullif("book_title", F.lit("")), F.nullif("title", F.lit("")), F.lit("Untitled Book")))
    rows = rows.withColumn("keywords", X.keywords(c)).withColumn("formulas", X.formulas(c)).withColumn("numbers", X.numbers(c)).withColumn("question_types", X.question_types(c)).withColumn("detected_language", X.script_language(c))
    rows = rows.withColumn("important_terms", X.important_terms(c, F.col("keywords")))
    f = X.flags(c)
    label = {"School": F.col("school_name"), "Class": F.coalesce("class_name", "grade"), "Book": F.col("book_title"), "Subject": F.col("subject"), "Grade": F.coalesce("grade", "class_name"), "Board": F.col("board"), "Language": F.coalesce("language", "detected_language"), "Chapter": F.col("chapter_title"), "Unit": F.col("unit_title"), "Lesson": F.col("lesson_title"), "Section": F.col("section_title"), "Topic": F.coalesce("topic", "section_title", "lesson_title", "chapter_title"), "Chunk Type": kind, "Pages": F.concat_ws("-", "page_start", "page_end")}
    flags = {k: v for k, v in f.items() if k not in ("has_formula", "has_numbers", "has_questions")} | {"has_formula": f["has_formula"] | (F.size("formulas") > 0), "has_numbers": f["has_numbers"] | (F.size("numbers") > 0), "has_questions": f["has_questions"] | (F.size("question_types") > 0), "has_devanagari": X.devanagari_count(c) > 0, "has_english": X.latin_count(c) > 0}
    out = rows.select(
        F.sha2(F.concat_ws("|", "document_id", "chunk_index"), 256).alias("id"), *chunks.columns, "book_title", "school_name", "class_name", "subject", "grade", "board", "medium", F.coalesce("language", "detected_language").alias("language"), "chunk_type", F.lit(None).cast("string").alias("difficulty_level"), X.pedagogical_role(kind, f["has_examples"]).alias("pedagogical_role"),
        F.when(kind.isin("poem", "story", "vocabulary", "grammar_rule"), "language").when(kind.isin("worked_example", "formula"), "math").otherwise(X.content_domain(F.col("subject"))).alias("content_domain"),
        X.embedding_input(label, c).alias("content_for_embedding"), X.summary(c).alias("summary"), "keywords", "important_terms", "formulas", "numbers", "question_types", "detected_language",
        X.word_count(c).alias("word_count"), X.regex_token_count(c).alias("token_count"), F.length(c).alias("char_count"), *[v.alias(k) for k, v in flags.items()],
        X.source_label(F.col("book_title"), [F.col("chapter_title"), F.col("section_title"), F.col("lesson_title"), F.col("unit_title")], F.col("page_start"), F.col("page_end")).alias("source_label"), X.citation(F.col("book_title"), F.col("page_start"), F.col("page_end")).alias("citation_text"),
    )
    out = out.withColumn("embedding_input_hash", F.sha2("content_for_embedding", 256))
    about = ["embedding_input_hash", "school_name", "class_name", "book_title", F.sequence("page_start", "page_end").alias("source_pages"), "chapter_number", "chapter_title", "unit_number", "unit_title", "section_number", "section_title"]
    return out.withColumn("metadata", F.to_json(F.struct(*about)))
