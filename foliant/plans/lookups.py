"""Queries of the lookups, checks and contents over whole tables, with SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliant.functions import text as X
from foliant.operators import chunking, contents, lookup, structure, validate, validate_json
from foliant.plans.books import NEWEST, newest_pages
from foliant.plans.reference import BOOKS, COUNT, SQUEEZE, books, pages, t
from foliant.session import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# ---- lookups


@query(f"""with {BOOKS} select s.id, s.document_id, b.document_key, b.book_title, chapter_number, chapter_title, unit_number, unit_title, section_number, section_title, subsection_number, subsection_title, anchor_marker, anchor_pdf_page, anchor_printed_page, pdf_start_page, pdf_end_page,
printed_start_page, printed_end_page, page_count, array_to_string(page_numbers, ',') as page_numbers, array_to_string(included_exercises_or_activities, ',') as activities, text_length_chars, include_in_embeddings, embedding_readiness, array_to_string(quality_flags, ',') as quality_flags from embeddings_book_subsections s join books b on b.id = s.document_id""")
def list_subsections_all(spark, d):
    """The listing of every book."""
    rows = lookup.list_subsections(t(spark, d, "book_subsections"), books(spark, d), every=True)
    rows = rows.withColumn("page_numbers", F.array_join(F.col("page_numbers").cast("array<string>"), ",")).withColumn("activities", F.array_join("included_exercises_or_activities", ",")).withColumn("quality_flags", F.array_join("quality_flags", ","))
    return rows.drop("printed_page_numbers", "includes", "included_exercises_or_activities")


@query(f"""with {NEWEST}, {BOOKS}, s as (select distinct id, document_id, unnest(range(pdf_start_page, greatest(pdf_start_page, coalesce(pdf_end_page, pdf_start_page)) + 1)) as page_number from embeddings_book_subsections where pdf_start_page is not null),
x as (select s.id, string_agg(raw_text, chr(10) || chr(10) order by page_number) as made from s join newest using (document_id, page_number) where {SQUEEZE.format("raw_text")} is not null group by s.id)
select e.id, b.document_key, sha256(made) as digest, length(made) as characters from embeddings_book_subsections e join books b on b.id = e.document_id left join x on x.id = e.id""")
def subsection_text_all(spark, d):
    """The text of every subsection, whether it is to be embedded or not."""
    rows = lookup.subsection_text(t(spark, d, "book_subsections"), newest_pages(spark, d), books(spark, d), every=True)
    return rows.select("id", "document_key", F.sha2("subsection_text", 256).alias("digest"), F.length("subsection_text").alias("characters"))


RESOLVED = """p as (select distinct document_id, page_number from newest), l as (select document_id, max(page_number) as last from p group by document_id),
h as (select p.document_id, p.page_number, c.*, (nullif(trim(chapter_title), '') is not null)::int + (nullif(trim(unit_title), '') is not null)::int + (nullif(trim(section_title), '') is not null)::int + (nullif(trim(lesson_title), '') is not null)::int as titles
from p join l using (document_id) join embeddings_book_chapters c on c.document_id = p.document_id and c.pdf_start_page <> 0 and p.page_number between c.pdf_start_page and coalesce(c.pdf_end_page, l.last)),
r as (select * from h qualify row_number() over (partition by document_id, page_number order by titles desc, pdf_start_page - coalesce(pdf_end_page, 2000000000) desc, pdf_start_page desc, id desc) = 1),
k as (select p.document_id, p.page_number, c.id as chunk_id, nullif(trim(c.chapter_title), '') as chunk_title from p join embeddings_chunks c on c.document_id = p.document_id and p.page_number between c.page_start and c.page_end where not exists (select 1 from r where r.document_id = p.document_id and r.page_number = p.page_number)
qualify row_number() over (partition by p.document_id, p.page_number order by nullif(trim(c.chapter_title), '') is null, chunk_index) = 1)"""


@query(f"""with {NEWEST}, {RESOLVED} select n.id, n.document_id, n.page_number, md5(n.raw_text) as digest, coalesce(r.chapter_title, k.chunk_title) as chapter_title, r.unit_title, r.section_title,
coalesce(nullif(trim(r.section_title), ''), nullif(trim(r.lesson_title), ''), nullif(trim(coalesce(r.chapter_title, k.chunk_title)), '')) as topic, cast(r.printed_start_page + n.page_number - r.pdf_start_page as integer) as printed_page_number, case when r.id is not null then 'record' when k.chunk_id is not null then 'chunk' end as found_in
from newest n left join r on r.document_id = n.document_id and r.page_number = n.page_number left join k on k.document_id = n.document_id and k.page_number = n.page_number""")
def raw_text_pages(spark, d):
    """Every page with the structure it belongs to."""
    rows = lookup.raw_text_pages(newest_pages(spark, d), t(spark, d, "book_chapters"), t(spark, d, "chunks"))
    return rows.select("id", "document_id", "page_number", F.md5("raw_text").alias("digest"), "chapter_title", "unit_title", "section_title", "topic", "printed_page_number", "found_in")


@query(f"""with {NEWEST}, {BOOKS}, {RESOLVED} select n.id, b.document_key, b.subject, r.section_number, r.section_title from newest n join books b on b.id = n.document_id join r on r.document_id = n.document_id and r.page_number = n.page_number where r.chapter_number = '1' and r.chapter_title ilike '%a%'""")
def chapter_pages(spark, d):
    """The pages of all first chapters with an "a" in the title, in every book."""
    raw = lookup.raw_text_pages(newest_pages(spark, d), t(spark, d, "book_chapters"), t(spark, d, "chunks"))
    rows = lookup.chapter_pages(raw.where("found_in = 'record'"), books(spark, d), every=True, chapter_number="1", chapter_title="a")
    return rows.select("id", "document_key", "subject", "section_number", "section_title")


# ---- plans, kinds, spreading

DOUBLED = "regexp_replace({0}, '([^\\p{{L}}\\p{{N}}_])', '\\1\\1', 'g')"  # so that matches may share the character between them
_NO, _YES = "(^|[^\\p{L}\\p{N}_])", "($|[^\\p{L}\\p{N}_])"
N = lambda p: f"sum({COUNT.format('raw_text', '(?i)' + p)})"
COUNTS = f"""h as (select * from newest qualify row_number() over (partition by document_id order by page_number, id) <= 30),
c as (select document_id, greatest(1, sum({COUNT.format("raw_text", X.TOKEN)})) as tokens, {N("\\?|exercise|objective questions|fill in|true or false|solve|अभ्यास|प्रश्न")} as questions,
sum({COUNT.format("raw_text", "[=+×÷≤≥<>]")}) + sum({COUNT.format(DOUBLED.format("raw_text"), _NO + "\\p{Nd}+\\s*//\\s*\\p{Nd}+" + _YES)}) as formulas,
sum({COUNT.format(DOUBLED.format("raw_text"), "(?i)" + _NO + "(?:story|poem)" + _YES)}) + sum({COUNT.format("raw_text", "कहानी|कविता")}) as stories, {N("grammar|vocabulary|noun|verb|adjective|व्याकरण|संज्ञा|सर्वनाम|क्रिया|विशेषण")} as grammar,
{N("experiment|activity|diagram|observe|science|evs|प्रयोग|विज्ञान")} as science, sum({COUNT.format("raw_text", "[ऀ-ॿ]")}) as d, sum({COUNT.format("raw_text", "[A-Za-z]")}) as l from h group by document_id)"""
PLAN_ROWS = ", ".join(f"('{k}', {m}, {o}, '{g}')" for k, (m, o, g) in chunking.PROFILES.items())


@query(f"""with {BOOKS}, {NEWEST}, {COUNTS}, q as (select c.*, lower(coalesce(subject, '')) as s from c left join books b on b.id = c.document_id),
f as (select document_id, case when regexp_matches(s, 'math|गणित') or formulas > greatest(20, floor(tokens / 80)) then 'math_textbook' when regexp_matches(s, 'english|literature') then 'english_literature' when regexp_matches(s, 'hindi') then 'hindi_literature'
when questions > 60 and tokens < 12000 then 'question_bank' when regexp_matches(s, 'grammar') or grammar >= 4 then 'grammar' when regexp_matches(s, 'science|evs') or science >= 4 then 'science_textbook' when stories >= 2 and d > l then 'hindi_literature'
when stories >= 2 then 'english_literature' when least(d, l) > 0 and least(d, l) / greatest(d, l) > 0.15 then 'mixed_textbook' else 'unknown' end as profile from q)
select document_id, profile, max_tokens, overlap_tokens, strategy from f join (values {PLAN_ROWS}) v(profile, max_tokens, overlap_tokens, strategy) using (profile)""")
def chunk_plan(spark, d):
    return chunking.profiles(newest_pages(spark, d), books(spark, d))


@query(f"""with {BOOKS}, {NEWEST}, {COUNTS} select document_id, tokens::bigint as tokens, questions::bigint as questions, formulas::bigint as formulas, stories::bigint as stories, grammar::bigint as grammar, science::bigint as science, d::bigint as devanagari, l::bigint as latin from c""")
def profile_counts(spark, d):
    """The counts behind a chunking profile, over the first 30 pages of each book, as chunk_plan has them."""
    c = chunking.counts(newest_pages(spark, d))
    return c.select("document_id", F.col("tokens").cast("bigint").alias("tokens"), "questions", "formulas", "stories", "grammar", "science", F.col("d").alias("devanagari"), F.col("l").alias("latin"))


_HEAD = "substring(coalesce(raw_text, ''), 1, 2500)"


@query(f"""with h as (select id, {_HEAD} as h, substring(coalesce(raw_text, ''), 1, 1200) as a from embeddings_pages),
n as (select id, a, {COUNT.format(DOUBLED.format("h"), "(?i)" + _NO + "exercise" + _YES)} as e, {COUNT.format("h", "(?i)\\([a-d]\\)")} as o, {COUNT.format("h", "(?i)\\((?:i|ii|iii|iv|v|vi|vii|viii|ix|x)\\)")} as r, {COUNT.format("h", "(?:^|\\s)\\p{Nd}{1,2}\\.")} as n from h)
select id, e >= 2 or o >= 5 and n >= 5 or r >= 8 and n >= 5 as answer_key, regexp_matches(a, '(?i){_NO}(?:activity\\s*[-—]?\\s*\\p{{Nd}}+|materials required|procedure|step\\s*\\p{{Nd}}+){_YES}') as activity from n""")
def page_kinds(spark, d):
    c = F.col("raw_text")
    return pages(spark, d).select("id", X.answer_key_page(c).alias("answer_key"), X.activity_page(c).alias("activity"))


def _parts(pattern: str) -> str:
    return f"list_filter(string_split(regexp_replace(text, '{pattern}', '\\1' || chr(1), 'g'), chr(1)), lambda x: trim(x) <> '')"


@query(f"""with d as (select doc_id, text, {_parts("()\\n\\s*\\n")} as paragraphs, {_parts("([.!?।॥])\\s+")} as sentences, greatest(1, ceil(length(text) / 10))::bigint as width from documents where trim(text) <> ''),
c as (select doc_id, case when len(paragraphs) >= 10 then paragraphs when len(sentences) >= 10 then sentences else list_transform(range(0, greatest(1, length(text)), width), lambda i: substring(text, i + 1, width)) end as parts from d),
s as (select doc_id, len(parts) as m, unnest(range(0, len(parts))) as i, unnest(parts) as part from c)
select doc_id, cast(1 + least(9, i * 10 // m) as integer) as page_number, sum(length(trim(part))) + count(*) - 1 as characters from s group by all""")
def text_spread_over_pages(spark, d):
    """Documents of the corpus spread over ten pages each."""
    from foliant.sources import json_books

    rows = table(spark, d, "documents").select("doc_id", "text", F.lit(1).alias("a"), F.lit(10).alias("b"))
    return json_books.spread_text(rows, ["doc_id"], "text", "a", "b").select("doc_id", "page_number", F.length("text").cast("bigint").alias("characters"))


@query(f"""with w as (select id, generate_subscripts(ws, 1) as i, unnest(ws) as w0 from (select id, regexp_extract_all(content, '[A-Za-z][A-Za-z''-]{{2,}}|[ऀ-ॿ]{{2,}}') as ws from embeddings_chunks)),
s as (select id, i, regexp_replace(w0, '^[''’-]+|[''’-]+$', '', 'g') as word from w), f as (select * from s where length(word) >= 3 and lower(word) not in ({", ".join(f"'{x}'" for x in X.STOPWORDS)}) and word not in ({", ".join(f"'{x}'" for x in X.HINDI_STOPWORDS)})),
c as (select id, word, count(*) + case when regexp_matches(word, '^[A-Z][a-z]*(?:[''-]+(?:[A-Z][a-z]*)?)*$') or word in ({", ".join(f"'{x}'" for x in X.IMPORTANT_TERMS)}) then 2 else 0 end as n, min(i) as i from f group by id, word),
k as (select id, word from c qualify row_number() over (partition by id order by n desc, i) <= 20),
a as (select id, word from k where regexp_matches(word, '^\\p{{Lu}}') union select id, t from embeddings_chunks, (select unnest([{", ".join(f"'{x}'" for x in X.IMPORTANT_TERMS)}]) as t) where contains(content, t)),
r as (select *, row_number() over (partition by id order by word) as n from a)
select e.id, coalesce(string_agg(word, ',' order by word), '') as terms from embeddings_chunks e left join r on r.id = e.id and n <= 25 group by e.id""")
def important_terms(spark, d):
    c = F.col("content")
    return t(spark, d, "chunks").select("id", F.array_join(X.important_terms(c, X.keywords(c)), ",").alias("terms"))


# ---- contents

_FORM = "coalesce(nullif(trim(regexp_replace(lower(x), '[^\\p{{L}}\\p{{N}}_ऀ-ॿ]+', ' ', 'g')), ''), '') in ('answer', 'answers')".replace("{{", "{").replace("}}", "}")


@query(f"""with {NEWEST}, n as (select document_id, page_number, {_HEAD} as h, substring(coalesce(raw_text, ''), 1, 1200) as a, string_split(coalesce(raw_text, ''), chr(10)) as lines from newest),
k as (select document_id, page_number, lines, regexp_matches(a, '(?i){_NO}(?:activity\\s*[-—]?\\s*\\p{{Nd}}+|materials required|procedure|step\\s*\\p{{Nd}}+){_YES}') as act,
{COUNT.format(DOUBLED.format("h"), "(?i)" + _NO + "exercise" + _YES)} >= 2 or {COUNT.format("h", "(?i)\\([a-d]\\)")} >= 5 and {COUNT.format("h", "(?:^|\\s)\\p{Nd}{1,2}\\.")} >= 5 or {COUNT.format("h", "(?i)\\((?:i|ii|iii|iv|v|vi|vii|viii|ix|x)\\)")} >= 8 and {COUNT.format("h", "(?:^|\\s)\\p{Nd}{1,2}\\.")} >= 5 as key from n),
s as (select document_id, page_number, key and not act as key, len(list_filter(list_slice(list_filter(lines, lambda x: trim(x) <> ''), 1, 20), lambda x: {_FORM})) > 0 or len(list_filter(lines, lambda x: {_FORM})) > 0 and key and not act as heads from k),
l as (select *, greatest(1, floor(max(page_number) over (partition by document_id) * 0.8)) as least_page from s), f as (select document_id, min(page_number) as h from l where heads and page_number >= least_page group by document_id),
b as (select f.document_id, h, max(page_number) filter (not key) as stop, min(page_number) as low from f left join l on l.document_id = f.document_id and l.page_number >= least_page and l.page_number between h - 4 and h - 1 group by f.document_id, h)
select document_id, cast(coalesce(stop + 1, low, h) as integer) as answers_page from b""")
def answer_starts(spark, d):
    return contents.answer_starts(newest_pages(spark, d))


def contents_pages_of(spark, d):
    """A page of contents before each book, as it would print its chapters and sections: number, title and printed page a line."""
    title = structure.display_title()
    rows = t(spark, d, "book_chapters").where(title.isNotNull() & F.col("printed_start_page").isNotNull()).select("document_id", "printed_start_page", F.concat_ws(" ", F.concat(F.regexp_extract("chapter_number", r"^\d+$", 0), F.lit(".")), X.squeeze(title), F.col("printed_start_page").cast("string")).alias("line")).distinct()
    held = rows.groupBy("document_id").agg(F.array_sort(F.collect_list(F.struct("printed_start_page", "line"))).alias("x"))
    return held.select(F.md5("document_id").alias("id"), "document_id", F.lit(0).alias("page_number"), F.concat(F.lit("Contents\n"), F.array_join(F.transform("x", lambda r: F.regexp_replace(r["line"], r"^\. ?", "")), "\n")).alias("raw_text"))


@query()
def toc_detect(spark, d):
    """What pages of contents tell: those of the books, and one before each book made of its chapters, as the tables' books have none."""
    return contents.detect(newest_pages(spark, d).unionByName(contents_pages_of(spark, d)))


# ---- checks

_K = ["chapter_number", "unit_number", "section_number"]
_KEYED = ", ".join(f"coalesce({k}, '') as k_{k}" for k in _K)
_ON = " and ".join(f"p.k_{k} = s.k_{k}" for k in _K)
_TITLE = "coalesce(nullif(trim(chapter_title), ''), nullif(trim(section_title), ''), nullif(trim(lesson_title), ''), nullif(trim(unit_title), ''))"
VIOLATIONS = f"""with ids as (select distinct id as document_id from embeddings_documents), last as (select document_id, max(page_number) as last, min(page_number) as first, count(distinct page_number) as n from embeddings_pages group by document_id),
parents as (select document_id, {_KEYED}, min(pdf_start_page) as lo, max(pdf_end_page) as hi from embeddings_book_chapters group by all), subs as (select *, {_KEYED} from embeddings_book_subsections),
o as (select *, lag(pdf_end_page) over (partition by document_id, {", ".join(f"k_{k}" for k in _K)} order by pdf_start_page, pdf_end_page, id) as b from subs where pdf_start_page is not null and pdf_end_page is not null)
select 'book_twice' as rule, id as document_id, id as key, count(*)::varchar as detail from embeddings_documents group by id having count(*) > 1
union all select 'no_document_key', id, id, title from embeddings_documents where nullif(trim(document_key), '') is null
union all select 'no_pages', document_id, document_id, null from ids where document_id not in (select document_id from embeddings_pages where document_id is not null)
union all select 'pages_without_book', document_id, document_id, count(*)::varchar from embeddings_pages p where not exists (select 1 from ids where ids.document_id = p.document_id) group by document_id
union all select 'pages_missing', document_id, document_id, (last - first + 1 - n)::varchar from last where last - first + 1 <> n
union all select 'record_without_title', document_id, id, null from embeddings_book_chapters where {_TITLE} is null
union all select 'record_without_start', document_id, id, {_TITLE} from embeddings_book_chapters where pdf_start_page is null
union all select 'record_backward', document_id, id, pdf_start_page || '-' || pdf_end_page from embeddings_book_chapters where pdf_end_page < pdf_start_page
union all select 'record_beyond_book', document_id, id, pdf_end_page::varchar from embeddings_book_chapters join last using (document_id) where pdf_end_page > last or pdf_start_page < 1
union all select 'section_key_twice', document_id, section_key, count(*)::varchar from embeddings_book_chapters where section_key is not null group by document_id, section_key having count(*) > 1
union all select 'subsection_orphan', document_id, id, subsection_title from subs s where not exists (select 1 from parents p where p.document_id = s.document_id and {_ON})
union all select 'subsection_out_of_parent', s.document_id, id, concat_ws('-', pdf_start_page, pdf_end_page) from subs s join parents p on p.document_id = s.document_id and {_ON} where pdf_start_page < lo or pdf_end_page > hi
union all select 'subsection_without_text', document_id, id, subsection_title from subs where coalesce(text_length_chars, 0) = 0
union all select 'subsection_overlap', document_id, id, (b - pdf_start_page + 1)::varchar from o where pdf_start_page <= b
union all select 'subsection_gap', document_id, id, (pdf_start_page - b - 1)::varchar from o where pdf_start_page > b + 1
union all select 'chunk_without_vector', document_id, id, chunk_index::varchar from embeddings_chunks where id not in (select chunk_id from embeddings_vectors where chunk_id is not null)
union all select 'chunk_without_text', document_id, id, chunk_index::varchar from embeddings_chunks where trim(coalesce(content, '')) = ''"""


@query(VIOLATIONS)
def validation(spark, d):
    return validate.violations(t(spark, d, "documents"), pages(spark, d), t(spark, d, "book_chapters"), t(spark, d, "book_subsections"), t(spark, d, "chunks"), t(spark, d, "vectors"))


@query()
def book_files_checked(spark, d):
    """Problems of the book files as delivered."""
    return validate_json.violations(table(spark, d, "raw_book_records"), "raw_id", "payload")
