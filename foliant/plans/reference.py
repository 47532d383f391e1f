"""Queries over the tables of the domain: scans, text functions, structure, search, lookups, changes and checks, with SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.functions import text as X
from foliant.operators import search, structure, tables
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


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return table(spark, d, f"embeddings_{name}")


def pages(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "pages")


def _us():
    """Times as microseconds, which every engine writes alike."""
    return F.unix_micros("updated_at").alias("updated_us")


def books(spark: SparkSession, d: str) -> DataFrame:
    return tables.latest(t(spark, d, "documents"), ["id"], [F.col("updated_at")])


BOOKS = "books as (select * from embeddings_documents qualify row_number() over (partition by id order by updated_at desc) = 1)"
#: White space brought to single blanks, null when none is left.
SQUEEZE = "nullif(trim(regexp_replace({0}, '[\\s\\p{{Z}}]+', ' ', 'g')), '')"
COUNT = "coalesce(len(regexp_extract_all({0}, '{1}')), 0)"
WORDS = f"coalesce(len(string_split({SQUEEZE.format('raw_text')}, ' ')), 0)"
DEVA, LATIN = COUNT.format("raw_text", "[ऀ-ॿ]"), COUNT.format("raw_text", "[A-Za-z]")
GARBAGE = COUNT.format("raw_text", "[\\x80-\\x9F]|\\x{FFFD}")
TOKENS = COUNT.format("raw_text", X.TOKEN)


# ---- scans and quality


@query(f"""select id, least({WORDS}, 300) + cast(floor(least({LATIN}, 500) / 10) as integer) + least({COUNT.format("raw_text", "[=+×÷≤≥<>√π%/]")}, 120) - {GARBAGE} * 50 - {DEVA} * 8 as score_of_text
from embeddings_pages where {WORDS} > 0 union all select id, 0 from embeddings_pages where {WORDS} = 0""")
def text_quality_score(spark, d):
    return pages(spark, d).select("id", X.quality_score(F.col("raw_text")).alias("score_of_text"))


@query(f"""select id, {WORDS} = 0 or {GARBAGE} > 0 or ({LATIN} >= 120 and {DEVA} >= 2 and {DEVA} <= greatest(40, floor({LATIN} * 0.2))) as needs_ocr from embeddings_pages""")
def ocr_gate(spark, d):
    return pages(spark, d).select("id", X.needs_ocr(F.col("raw_text")).alias("needs_ocr"))


@query(f"""with p as (select document_id, {WORDS} = 0 as empty, {GARBAGE} > 0 as garbage, {TOKENS} < 20 as short from embeddings_pages)
select document_id, count(*) as pages, round(avg(empty::int), 6) as empty_ratio, round(avg((empty or garbage or short)::int), 6) as weak_ratio, avg(empty::int) >= 0.40 as many_empty, avg((empty or garbage or short)::int) >= 0.25 as many_weak from p group by document_id""")
def extraction_warnings(spark, d):
    p = pages(spark, d).select("document_id", (X.word_count(F.col("raw_text")) == 0).alias("empty"), (X.garbage_count(F.col("raw_text")) > 0).alias("garbage"), (X.regex_token_count(F.col("raw_text")) < 20).alias("short"))
    empty, weak = F.avg(F.col("empty").cast("int")), F.avg((F.col("empty") | F.col("garbage") | F.col("short")).cast("int"))
    return p.groupBy("document_id").agg(F.count(F.lit(1)).alias("pages"), F.round(empty, 6).alias("empty_ratio"), F.round(weak, 6).alias("weak_ratio"), (empty >= 0.40).alias("many_empty"), (weak >= 0.25).alias("many_weak"))


@query(f"""with r as (select *, row_number() over (partition by document_id order by page_number, id) - 1 as i, count(*) over (partition by document_id) as n from embeddings_pages),
s as (select * from r where i < 10 or (i - 10) % greatest(1, (n - 1) // 15) = 0 and (i - 10) // greatest(1, (n - 1) // 15) < 15),
q as (select document_id, {WORDS} as w, length(trim(coalesce(raw_text, ''), chr(10) || chr(13) || chr(9) || chr(160) || ' ')) as len, {COUNT.format("raw_text", "[\\x80-\\x9F]")} as c1, {COUNT.format("raw_text", "\\x{FFFD}")} as rep, {LATIN} as l, {DEVA} as v from s)
select document_id, count(*) as sampled_pages, count(*) filter (w = 0) as empty_pages, count(*) filter (c1 > 0) as control_pages, count(*) filter (rep > 0) as replacement_pages,
count(*) filter (l >= 80 and v >= 2 and v <= greatest(40, floor(l * 0.2))) as stray_pages from q group by document_id""")
def pdf_quality_report(spark, d):
    """The first ten pages of a book and up to 15 more at even distances."""
    w = Window.partitionBy("document_id")
    p = pages(spark, d).select("document_id", "page_number", "id", (X.word_count(F.col("raw_text")) == 0).alias("empty"), F.regexp_count("raw_text", F.lit(X.C1)).alias("c1"), F.regexp_count("raw_text", F.lit("�")).alias("rep"), X.stray_devanagari(F.col("raw_text"), 80).alias("stray"))
    p = p.withColumn("i", F.row_number().over(w.orderBy("page_number", "id")) - 1).withColumn("n", F.count(F.lit(1)).over(w))
    step = F.greatest(F.lit(1), F.floor((F.col("n") - 1) / 15))
    p = p.where((F.col("i") < 10) | ((F.col("i") - 10) % step == 0) & (F.floor((F.col("i") - 10) / step) < 15))
    return p.groupBy("document_id").agg(F.count(F.lit(1)).alias("sampled_pages"), F.count_if("empty").alias("empty_pages"), F.count_if(F.col("c1") > 0).alias("control_pages"), F.count_if(F.col("rep") > 0).alias("replacement_pages"), F.count_if("stray").alias("stray_pages"))


@query(f"""select id, {WORDS} as words, {TOKENS} as tokens, {DEVA} > 0 as devanagari, {LATIN} > 0 as english,
case when {TOKENS} <= 3 then 'empty' when {GARBAGE} > 0 then 'corrupted' when {TOKENS} < 20 then 'low' when extraction_method like '%ocr' then 'ocr' else 'ok' end as quality from embeddings_pages""")
def page_stats(spark, d):
    c = F.col("raw_text")
    return pages(spark, d).select("id", X.word_count(c).alias("words"), X.regex_token_count(c).alias("tokens"), (X.devanagari_count(c) > 0).alias("devanagari"), (X.latin_count(c) > 0).alias("english"), X.page_quality(c, F.col("extraction_method")).alias("quality"))


@query("select document_id, count(*) as pages, coalesce(sum(word_count), 0) as words, coalesce(sum(token_count), 0) as tokens from embeddings_pages group by document_id")
def document_totals(spark, d):
    return pages(spark, d).groupBy("document_id").agg(F.count(F.lit(1)).alias("pages"), F.coalesce(F.sum("word_count"), F.lit(0)).alias("words"), F.coalesce(F.sum("token_count"), F.lit(0)).alias("tokens"))


LANGUAGE = f"""case when coalesce(length(regexp_replace(raw_text, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')) < 8, true) or {DEVA} + {LATIN} < 5 then 'Unknown'
when {DEVA} >= 10 and {LATIN} >= 10 and {DEVA} * 5 >= {DEVA} + {LATIN} and {LATIN} * 5 >= {DEVA} + {LATIN} then 'Mixed'
when {DEVA} * 20 >= ({DEVA} + {LATIN}) * 11 then 'Hindi' when {LATIN} * 20 >= ({DEVA} + {LATIN}) * 11 then 'English' else 'Mixed' end"""


@query(f"select id, {LANGUAGE} as language from embeddings_pages")
def language_detect(spark, d):
    return pages(spark, d).select("id", X.script_language(F.col("raw_text")).alias("language"))


@query(f"""with l as (select document_id, {LANGUAGE} as language from embeddings_pages), c as (select document_id, language, count(*) as n from l where language <> 'Unknown' group by all),
b as (select document_id, bool_or(language = 'Hindi') and bool_or(language = 'English') as both_, max_by(language, n * 10 + case language when 'English' then 3 when 'Hindi' then 2 else 1 end) as top from c group by document_id)
select document_id, case when both_ then 'Mixed' else top end as language from b""")
def dominant_language(spark, d):
    c = pages(spark, d).select("document_id", X.script_language(F.col("raw_text")).alias("language")).where("language <> 'Unknown'").groupBy("document_id", "language").agg(F.count(F.lit(1)).alias("n"))
    rank = F.struct("n", F.when(F.col("language") == "English", 3).when(F.col("language") == "Hindi", 2).otherwise(1))
    b = c.groupBy("document_id").agg((F.bool_or(F.col("language") == "Hindi") & F.bool_or(F.col("language") == "English")).alias("b"), F.max_by("language", rank).alias("top"))
    return b.select("document_id", F.when(F.col("b"), "Mixed").otherwise(F.col("top")).alias("language"))


# ---- text functions


@query(r"""select id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(raw_text, '\r\n|\r', chr(10), 'g'),
'[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x9F]', '', 'g'), '[ \t\x{A0}]+', ' ', 'g'), '([A-Za-z])[-‐]\n([A-Za-z])', '\1\2', 'g'), '\n\s*\n\s*\n+', chr(10) || chr(10), 'g'), ' +(\n|$)', '\1', 'g'), '^\s+|\s+$', '', 'g') as cleaned from embeddings_pages""")
def clean_text_regex(spark, d):
    return pages(spark, d).select("id", X.clean_spacing(F.col("raw_text")).alias("cleaned"))


@query()
def clean_text_full(spark, d):
    return pages(spark, d).select("id", X.clean_text("raw_text").alias("cleaned"))


def _has(c: str, p: str) -> str:
    return f"coalesce(regexp_matches({c}, '(?i){p}'), false)"


FLAGS = {"has_formula": f"coalesce(regexp_matches(content, '{X.FORMULA}'), false)", "has_numbers": "coalesce(regexp_matches(content, '\\p{Nd}'), false)", "has_questions": _has("content", X.QUESTION), "has_exercises": _has("content", X.EXERCISES), "has_examples": _has("content", X.EXAMPLES), "has_definition": _has("content", X.DEFINITION), "has_table_like_text": f"coalesce(regexp_matches(content, '{X.TABLE_LIKE}'), false)"}
CONTENT_TYPE = f"""case when {_has("content", "poem|कविता")} then 'poem' when {_has("content", "story|कहानी")} then 'story' when {_has("content", X.VOCABULARY)} then 'vocabulary' when {_has("content", X.GRAMMAR)} then 'grammar_rule'
when has_questions then 'question_set' when has_examples and has_formula then 'worked_example' when has_examples then 'example' when has_definition then 'definition' when has_formula then 'formula'
when has_table_like_text then 'table' when {_has("content", "activity|गतिविधि")} then 'activity' when {_has("content", "summary|सारांश")} then 'summary' else 'explanation' end"""


@query(f"""with f as (select id, content, {", ".join(f"{v} as {k}" for k, v in FLAGS.items())} from embeddings_chunks), k as (select *, {CONTENT_TYPE} as kind from f)
select id, kind, case when kind in ('poem', 'story') then 'reading_passage' when kind in ('vocabulary', 'formula', 'table', 'summary') or kind = 'grammar_rule' and not has_examples then 'reference'
when kind = 'question_set' then 'assessment' when kind = 'activity' then 'activity' else 'concept_teaching' end as role, {", ".join(FLAGS)} from k""")
def classify_content(spark, d):
    c = F.col("content")
    f = t(spark, d, "chunks").select("id", X.content_type(c).alias("kind"), *[v.alias(k) for k, v in X.flags(c).items()])
    return f.select("id", "kind", X.pedagogical_role(F.col("kind"), F.col("has_examples")).alias("role"), *X.flags(c))


@query(f"""with {BOOKS} select id, case when subject is null or subject = '' then null when contains(lower(subject), 'math') or contains(subject, 'गणित') then 'math'
when regexp_matches(lower(subject), 'hindi|english|grammar|language') then 'language' when regexp_matches(lower(subject), 'science|evs') then 'science' else subject end as domain from books""")
def content_domain(spark, d):
    return books(spark, d).select("id", X.content_domain(F.col("subject")).alias("domain"))


@query()
def headings(spark, d):
    lines = pages(spark, d).select("id", F.posexplode(F.split("raw_text", "\n")).alias("line", "t"))
    return lines.select("id", "line", X.heading(F.col("t")).alias("h")).where("h.level is not null").select("id", "line", "h.level", "h.number", "h.title")


@query(f"select id, array_to_string(list_filter([{', '.join(f"case when {_has('content', p)} then '{n}' end" for p, n in X.QUESTION_TYPES)}], lambda x: x is not null), ',') as types from embeddings_chunks")
def question_types(spark, d):
    return t(spark, d, "chunks").select("id", F.array_join(X.question_types(F.col("content")), ",").alias("types"))


@query()
def numbers_and_formulas(spark, d):
    c = F.col("content")
    return t(spark, d, "chunks").select("id", F.array_join(X.numbers(c), "|").alias("numbers"), F.array_join(X.formulas(c), "|").alias("formulas"))


@query(f"select id, case when length(s) > 280 then rtrim(substring(s, 1, 280)) || '...' else s end as summary from (select id, coalesce({SQUEEZE.format('content')}, '') as s from embeddings_chunks)")
def summary(spark, d):
    return t(spark, d, "chunks").select("id", X.summary(F.col("content")).alias("summary"))


def _quoted(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


@query(f"""with w as (select id, generate_subscripts(ws, 1) as i, unnest(ws) as w0 from (select id, regexp_extract_all(content, '[A-Za-z][A-Za-z''-]{{2,}}|[ऀ-ॿ]{{2,}}') as ws from embeddings_chunks)),
s as (select id, i, regexp_replace(w0, '^[''’-]+|[''’-]+$', '', 'g') as word from w), f as (select * from s where length(word) >= 3 and lower(word) not in ({_quoted(X.STOPWORDS)}) and word not in ({_quoted(X.HINDI_STOPWORDS)})),
c as (select id, word, count(*) + case when regexp_matches(word, '^[A-Z][a-z]*(?:[''-]+(?:[A-Z][a-z]*)?)*$') or word in ({_quoted(X.IMPORTANT_TERMS)}) then 2 else 0 end as n, min(i) as i from f group by id, word),
r as (select *, row_number() over (partition by id order by n desc, i) as k from c)
select e.id, coalesce(string_agg(word, ',' order by k), '') as keywords from embeddings_chunks e left join r on r.id = e.id and k <= 20 group by e.id""")
def keywords_top20(spark, d):
    return t(spark, d, "chunks").select("id", F.array_join(X.keywords(F.col("content")), ",").alias("keywords"))


PAGES_LABEL = "case when page_start = page_end then 'page ' || page_start else 'pages ' || page_start || '-' || page_end end"


@query(f"""with {BOOKS} select c.id, concat_ws(', ', b.book_title, nullif(c.chapter_title, ''), {PAGES_LABEL}) as label, 'Source: ' || coalesce(b.book_title, '') || ', ' || {PAGES_LABEL} as citation
from embeddings_chunks c join books b on b.id = c.document_id""")
def source_labels(spark, d):
    b = books(spark, d).select(F.col("id").alias("document_id"), "book_title")
    c = t(spark, d, "chunks").join(b, "document_id")
    return c.select("id", X.source_label(F.col("book_title"), [F.col("chapter_title")], F.col("page_start"), F.col("page_end")).alias("label"), X.citation(F.col("book_title"), F.col("page_start"), F.col("page_end")).alias("citation"))


INPUT_FIELDS = {"School": "school_name", "Class": "coalesce(nullif(class_name, ''), grade)", "Book": "book_title", "Subject": "subject", "Grade": "coalesce(nullif(grade, ''), class_name)", "Board": "board", "Language": "language", "Chapter": "chapter_title", "Chunk Type": "chunk_type"}


@query(f"""with {BOOKS}, i as (select c.id, regexp_replace(concat_ws(chr(10), {", ".join(f"'{k}: ' || coalesce({v}, '')" for k, v in INPUT_FIELDS.items())}, 'Pages: ' || coalesce(page_start || '-' || page_end, ''), 'Text:', coalesce(content, '')), '^\\s+|\\s+$', '', 'g') as x
from embeddings_chunks c join books b on b.id = c.document_id) select id, sha256(x) as input_hash, length(x) as characters from i""")
def embedding_input_hash(spark, d):
    b = books(spark, d).select(F.col("id").alias("document_id"), "school_name", "class_name", "book_title", "subject", "grade", "board", "language")
    c = t(spark, d, "chunks").join(b, "document_id")
    fields = {k: F.expr(v) for k, v in INPUT_FIELDS.items()} | {"Pages": F.expr("page_start || '-' || page_end")}
    x = c.select("id", X.embedding_input(fields, F.col("content")).alias("x"))
    return x.select("id", F.sha2("x", 256).alias("input_hash"), F.length("x").alias("characters"))


SLUG = "nullif(regexp_replace(regexp_replace(regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}_.-]+', '-', 'g'), '^[-._]+|[-._]+$', '', 'g'), '-+', '-', 'g'), '')"


@query(f"select id, epoch_us(updated_at) as updated_us, {SLUG.format(SQUEEZE.format('book_title'))} as slug, {SLUG.format('concat_ws(' + chr(39) + '-' + chr(39) + ', school_name, class_name, subject, book_title)')} as derived_key, nullif(trim(regexp_replace(lower(title), '[\\s\\p{{Z}}]+', ' ', 'g')), '') as normalized from embeddings_documents")
def slug_document_key(spark, d):
    key = F.concat_ws("-", "school_name", "class_name", "subject", "book_title")
    return t(spark, d, "documents").select("id", _us(), X.slug(F.col("book_title")).alias("slug"), X.slug(key).alias("derived_key"), X.squeeze(F.lower("title")).alias("normalized"))


@query(r"""with p as (select id, updated_at, list_filter(string_split(replace(file_path, '\', '/'), '/'), lambda x: trim(x) <> '') as parts from embeddings_documents), s as (select *, regexp_replace(parts[-1], '\.[^.]*$', '') as stem from p)
select id, epoch_us(updated_at) as updated_us, case when len(parts) >= 3 then nullif(trim(regexp_replace(replace(parts[-3], '_', ' '), '[\s\p{Z}]+', ' ', 'g')), '') end as school_name, case when len(parts) >= 3 then nullif(trim(regexp_replace(replace(parts[-2], '_', ' '), '[\s\p{Z}]+', ' ', 'g')), '') end as class_name,
case when contains(stem, '_') then nullif(trim(regexp_replace(split_part(stem, '_', 1), '[\s\p{Z}]+', ' ', 'g')), '') end as subject,
nullif(trim(regexp_replace(replace(case when contains(stem, '_') then regexp_replace(stem, '^[^_]*_', '') else stem end, '_', ' '), '[\s\p{Z}]+', ' ', 'g')), '') as book_title from s""")
def path_metadata(spark, d):
    return t(spark, d, "documents").select("id", _us(), *[c.alias(k) for k, c in X.path_metadata(F.col("file_path")).items()])


@query("select id, coalesce(nullif(trim(regexp_replace(lower(chapter_title), '[^\\p{L}\\p{N}_ऀ-ॿ]+', ' ', 'g')), ''), '') as form, coalesce(nullif(regexp_replace(regexp_replace(upper(section_key), '[^A-Z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'X') as safe, try_cast(translate(trim(chapter_number), '०१२३४५६७८९', '0123456789') as integer) as number from embeddings_book_chapters")
def match_forms(spark, d):
    return t(spark, d, "book_chapters").select("id", X.match_form(F.col("chapter_title")).alias("form"), X.safe_id(F.col("section_key"), "X").alias("safe"), X.safe_int(F.col("chapter_number")).alias("number"))


@query()
def chapter_titles_cleaned(spark, d):
    return t(spark, d, "book_chapters").select("id", _us(), X.clean_chapter_title(F.col("chapter_title"), F.col("chapter_number"), F.col("printed_start_page")).alias("title"))


@query(f"""with c as (select doc_id, regexp_extract_all(text, '{X.TOKEN}') as k from documents), w as (select doc_id, unnest(range(0, greatest(len(k), 1)::bigint, 380)) as i, k from c where len(k) > 0)
select doc_id, cast(i // 380 as integer) as window_no, len(list_slice(k, i + 1, i + 500)) as tokens, md5(array_to_string(list_slice(k, i + 1, i + 500), ' ')) as digest from w""")
def token_windows(spark, d):
    """Windows of 500 regex tokens, 120 of them shared with the next."""
    k = table(spark, d, "documents").select("doc_id", F.posexplode(X.token_windows(F.col("text"), 500, 120)).alias("window_no", "w"))
    return k.select("doc_id", "window_no", F.size(F.split("w", " ")).alias("tokens"), F.md5("w").alias("digest"))


@query(f"select doc_id, {COUNT.format('text', X.TOKEN)} as tokens, {COUNT.format('text', X.TOKEN)} > 8192 as truncated from documents")
def token_counts(spark, d):
    n = X.regex_token_count(F.col("text"))
    return table(spark, d, "documents").select("doc_id", n.alias("tokens"), (n > 8192).alias("truncated"))


@query(f"select id, {_has('raw_text', '(^|[^\\p{L}\\p{N}_])(contents|table of contents|index)([^\\p{L}\\p{N}_]|$)|अनुक्रमणिका|विषय सूची')} or len(list_filter(list_slice(string_split(coalesce(raw_text, ''), chr(10)), 1, 80), lambda x: regexp_matches(trim(x), '^[0-9]{{1,2}}\\s*[.)\\-–:,]?\\s+.{{3,80}}\\s+[0-9]{{1,4}}$'))) >= 6 as contents from embeddings_pages")
def contents_pages(spark, d):
    return pages(spark, d).select("id", X.contents_page(F.col("raw_text")).alias("contents"))


# ---- structure


@query("""with p as (select distinct document_id, page_number from embeddings_pages), l as (select document_id, max(page_number) as last from p group by document_id),
h as (select p.document_id, p.page_number, c.*, (nullif(trim(chapter_title), '') is not null)::int + (nullif(trim(unit_title), '') is not null)::int + (nullif(trim(section_title), '') is not null)::int + (nullif(trim(lesson_title), '') is not null)::int as titles
from p join l using (document_id) join embeddings_book_chapters c on c.document_id = p.document_id and c.pdf_start_page <> 0 and p.page_number between c.pdf_start_page and coalesce(c.pdf_end_page, l.last)),
b as (select document_id, page_number, id, pdf_start_page, printed_start_page from h qualify row_number() over (partition by document_id, page_number order by titles desc, pdf_start_page - coalesce(pdf_end_page, 2000000000) desc, pdf_start_page desc, id desc) = 1)
select p.document_id, p.page_number, b.id as record_id, cast(b.printed_start_page + p.page_number - b.pdf_start_page as integer) as printed_page from p left join b using (document_id, page_number)""")
def page_structure_resolve(spark, d):
    p = pages(spark, d).select("document_id", "page_number").distinct()
    r = structure.resolve_pages(p, t(spark, d, "book_chapters"))
    return r.select("document_id", "page_number", F.col("record.id").alias("record_id"), structure.printed_page(F.col("page_number"), F.col("record")).alias("printed_page"))


@query("""with p as (select distinct document_id, page_number from embeddings_pages) select p.document_id, p.page_number, c.id as chunk_id, c.chapter_title from p join embeddings_chunks c on c.document_id = p.document_id and p.page_number between c.page_start and c.page_end
qualify row_number() over (partition by p.document_id, p.page_number order by nullif(trim(chapter_title), '') is null, chunk_index) = 1""")
def page_chunk_fallback(spark, d):
    return structure.covering_chunk(pages(spark, d), t(spark, d, "chunks"))


@query("""with l as (select document_id, max(page_number) as last from embeddings_pages group by document_id), n as (select c.*, lead(pdf_start_page) over (partition by document_id order by pdf_start_page, id, updated_at) as nx from embeddings_book_chapters c where pdf_start_page > 0)
select n.id, epoch_us(n.updated_at) as updated_us, cast(coalesce(nx - 1, last) as integer) as computed_end_page from n join l using (document_id)""")
def chapter_end_pages(spark, d):
    return structure.with_ends(t(spark, d, "book_chapters"), pages(spark, d)).select("id", _us(), "computed_end_page")


@query("""with x as (select *, coalesce(nullif(trim(chapter_title), ''), nullif(trim(section_title), ''), nullif(trim(lesson_title), ''), nullif(trim(unit_title), '')) as title from embeddings_book_chapters),
r as (select *, row_number() over (partition by document_id order by coalesce(pdf_start_page, 1000000000), coalesce(printed_start_page, 1000000000), coalesce(nullif(trim(chapter_number), ''), ''), coalesce(nullif(trim(section_number), ''), ''), title, id, updated_at) as position from x where title is not null)
select id, epoch_us(updated_at) as updated_us, cast(position as integer) as position, case when nullif(trim(chapter_number), '') is null and nullif(trim(chapter_title), '') is not null then position::varchar else chapter_number end as chapter_number from r""")
def normalize_chapters(spark, d):
    return structure.normalized(t(spark, d, "book_chapters")).select("id", _us(), "position", "chapter_number")


@query("""with o as (select document_id, pdf_start_page - printed_start_page as o, count(*) as n from embeddings_book_chapters where pdf_start_page - printed_start_page between 0 and 120 group by all),
b as (select document_id, o, n, sum(n) over (partition by document_id) as total from o qualify row_number() over (partition by document_id order by n desc, o) = 1)
select document_id, cast(o as integer) as page_offset, n as support, cast(total as bigint) as total from b where total >= 3 and n >= greatest(3, floor(total * 0.4))""")
def offset_mode(spark, d):
    return structure.offset_mode(t(spark, d, "book_chapters"))


@query("""with c as (select *, try_cast(translate(regexp_extract(chapter_number, '(\\p{Nd}+)', 1), '०१२३४५६७८९', '0123456789') as integer) = 1 as one from embeddings_book_chapters where pdf_start_page is not null),
a as (select document_id, min(pdf_start_page) filter (one and nullif(trim(chapter_title), '') is not null) - 1 as c1, min(pdf_start_page) filter (printed_start_page = 1) - 1 as p1 from c group by document_id),
o as (select document_id, pdf_start_page - printed_start_page as o, count(*) as n from c where pdf_start_page - printed_start_page between 0 and 80 group by all), m as (select document_id, o, n from o qualify row_number() over (partition by document_id order by n desc, o) = 1)
select document_id, cast(case when c1 >= 0 then c1 when p1 >= 0 then p1 else o end as integer) as page_offset, case when c1 >= 0 then 'chapter_1_anchor' when p1 >= 0 then 'printed_page_1_anchor' else 'dominant_offset' end as source
from a left join m using (document_id) where c1 >= 0 or p1 >= 0 or n >= 2""")
def offset_cascade(spark, d):
    return structure.printed_offsets(t(spark, d, "book_chapters"))


@query("""select document_id, cast(max(try_cast(translate(regexp_extract(chapter_number, '(\\p{Nd}+)', 1), '०१२३४५६७८९', '0123456789') as integer)) + 1 as integer) as next_number from embeddings_book_chapters group by document_id""")
def next_chapter_number(spark, d):
    n = X.safe_int(F.regexp_extract("chapter_number", r"(\p{Nd}+)", 1))
    return t(spark, d, "book_chapters").groupBy("document_id").agg((F.max(n) + 1).alias("next_number"))


@query("""select distinct c.id as chunk_id, r.id as record_id from embeddings_chunks c join embeddings_book_chapters r on c.document_id = r.document_id and c.page_start <= r.pdf_end_page and c.page_end >= r.pdf_start_page and r.pdf_start_page <= r.pdf_end_page and c.page_start <= c.page_end
where nullif(trim(c.chapter_title), '') is null or nullif(trim(r.chapter_title), '') is null or c.chapter_title = r.chapter_title""")
def chunk_chapter_overlap(spark, d):
    return structure.chunk_chapter_overlaps(t(spark, d, "chunks"), t(spark, d, "book_chapters"))


@query("""with s as (select document_id, pdf_start_page, lag(pdf_start_page) over (partition by document_id order by printed_start_page, id, updated_at) as b from embeddings_book_chapters where printed_start_page is not null)
select document_id, count(*) as records, round(avg((pdf_start_page > b)::int) filter (b is not null and pdf_start_page is not null), 6) as increasing from s group by document_id""")
def toc_reliability(spark, d):
    w = Window.partitionBy("document_id").orderBy("printed_start_page", "id", "updated_at")
    s = t(spark, d, "book_chapters").where("printed_start_page is not null").withColumn("b", F.lag("pdf_start_page").over(w))
    return s.groupBy("document_id").agg(F.count(F.lit(1)).alias("records"), F.round(F.avg((F.col("pdf_start_page") > F.col("b")).cast("int")), 6).alias("increasing"))


# ---- duplicates, joins, checks


@query("""select id, epoch_us(updated_at) as updated_us from (select *, row_number() over (partition by document_id, coalesce(section_key, '') order by updated_at desc, id desc) as n from embeddings_book_chapters) where n = 1""")
def chapter_dedupe_last(spark, d):
    return tables.keep_first(t(spark, d, "book_chapters"), [F.col("document_id"), F.coalesce("section_key", F.lit(""))], [F.desc("updated_at"), F.desc("id")]).select("id", _us())


@query("""select id from embeddings_book_subsections qualify row_number() over (partition by document_id, coalesce(chapter_number, ''), coalesce(unit_number, ''), coalesce(section_number, ''), coalesce(subsection_number, ''), coalesce(lower(subsection_title), ''), coalesce(pdf_start_page, -1), coalesce(pdf_end_page, -1) order by coalesce(text_length_chars, 0) desc, id) = 1""")
def subsection_dedupe(spark, d):
    keys = [F.col("document_id"), *[F.coalesce(c, F.lit("")) for c in ("chapter_number", "unit_number", "section_number", "subsection_number")], F.coalesce(F.lower("subsection_title"), F.lit("")), F.coalesce("pdf_start_page", F.lit(-1)), F.coalesce("pdf_end_page", F.lit(-1))]
    return tables.keep_first(t(spark, d, "book_subsections"), keys, [F.coalesce("text_length_chars", F.lit(0)).desc(), F.col("id")]).select("id")


@query("""select document_id, lower(trim(chapter_title)) as title, count(*) as n from embeddings_book_chapters where nullif(trim(chapter_title), '') is not null group by all having count(*) > 1""")
def duplicate_titles(spark, d):
    return tables.duplicates(t(spark, d, "book_chapters").where(F.trim("chapter_title") != ""), [F.col("document_id"), F.lower(F.trim("chapter_title")).alias("title")])


KEYS = ["chapter_number", "unit_number", "section_number"]


def _parents(spark, d):
    return t(spark, d, "book_chapters").groupBy("document_id", *[F.coalesce(k, F.lit("")).alias(k) for k in KEYS]).agg(F.min("pdf_start_page").alias("lo"), F.max("pdf_end_page").alias("hi"))


PARENTS = f"parents as (select document_id, {', '.join(f'coalesce({k}, {chr(39) * 2}) as {k}' for k in KEYS)}, min(pdf_start_page) as lo, max(pdf_end_page) as hi from embeddings_book_chapters group by all)"
CHILDREN = f"children as (select id, document_id, {', '.join(f'coalesce({k}, {chr(39) * 2}) as {k}' for k in KEYS)}, pdf_start_page, pdf_end_page from embeddings_book_subsections)"


def _children(spark, d):
    return t(spark, d, "book_subsections").select("id", "document_id", *[F.coalesce(k, F.lit("")).alias(k) for k in KEYS], "pdf_start_page", "pdf_end_page")


@query(f"with {PARENTS}, {CHILDREN} select id, lo, hi from children join parents using (document_id, {', '.join(KEYS)}) where pdf_start_page < lo or pdf_end_page > hi")
def subsection_bounds(spark, d):
    return _children(spark, d).join(_parents(spark, d), ["document_id", *KEYS]).where("pdf_start_page < lo or pdf_end_page > hi").select("id", "lo", "hi")


@query(f"with {PARENTS}, {CHILDREN} select id from children c where not exists (select 1 from parents p where p.document_id = c.document_id and {' and '.join(f'p.{k} = c.{k}' for k in KEYS)})")
def subsection_orphans(spark, d):
    return _children(spark, d).join(_parents(spark, d), ["document_id", *KEYS], "left_anti").select("id")


@query(f"""with {CHILDREN}, s as (select *, lag(pdf_end_page) over w as b from children where pdf_start_page is not null and pdf_end_page is not null window w as (partition by document_id, {', '.join(KEYS)} order by pdf_start_page, pdf_end_page, id))
select id, case when pdf_start_page <= b then 'overlap' else 'gap' end as kind, cast(case when pdf_start_page <= b then b - pdf_start_page + 1 else pdf_start_page - b - 1 end as integer) as pages from s where pdf_start_page <= b or pdf_start_page > b + 1""")
def subsection_gaps_overlaps(spark, d):
    w = Window.partitionBy("document_id", *KEYS).orderBy("pdf_start_page", "pdf_end_page", "id")
    s = _children(spark, d).where("pdf_start_page is not null and pdf_end_page is not null").withColumn("b", F.lag("pdf_end_page").over(w))
    return s.where("pdf_start_page <= b or pdf_start_page > b + 1").selectExpr("id", "if(pdf_start_page <= b, 'overlap', 'gap') as kind", "if(pdf_start_page <= b, b - pdf_start_page + 1, pdf_start_page - b - 1) as pages")


@query("select document_id, count(distinct page_number) as pages, min(page_number) as first_page, max(page_number) as last_page, max(page_number) - min(page_number) + 1 - count(distinct page_number) as missing from embeddings_pages group by document_id")
def page_coverage(spark, d):
    n, lo, hi = F.countDistinct("page_number"), F.min("page_number"), F.max("page_number")
    return pages(spark, d).groupBy("document_id").agg(n.alias("pages"), lo.alias("first_page"), hi.alias("last_page"), (hi - lo + 1 - n).alias("missing"))


@query("select unit_number, count(*) as records, count(distinct document_id) as books, round(avg(confidence), 4) as confidence from embeddings_book_chapters group by unit_number")
def unit_histogram(spark, d):
    return t(spark, d, "book_chapters").groupBy("unit_number").agg(F.count(F.lit(1)).alias("records"), F.countDistinct("document_id").alias("books"), F.round(F.avg("confidence"), 4).alias("confidence"))


TABLE_NAMES = ["documents", "pages", "book_chapters", "book_subsections", "chunks", "vectors", "ingestion_runs"]


@query(" union all ".join(f"select '{n}' as name, count(*) as n from embeddings_{n}" for n in TABLE_NAMES))
def table_counts(spark, d):
    out = None
    for n in TABLE_NAMES:
        one = t(spark, d, n).agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


# ---- changes


@query("select * exclude (created_at, updated_at), epoch_us(created_at) as created_us, epoch_us(updated_at) as updated_us from embeddings_documents qualify row_number() over (partition by id order by updated_at desc) = 1")
def latest_documents(spark, d):
    return books(spark, d).withColumn("created_us", F.unix_micros("created_at")).withColumn("updated_us", F.unix_micros("updated_at")).drop("created_at", "updated_at")


@query("""with old as (select id, title, total_pages, created_at, updated_at from embeddings_documents where grade is not null qualify row_number() over (partition by id order by updated_at) = 1),
new as (select id, title, total_pages, created_at + interval 1 day as created_at, updated_at from embeddings_documents qualify row_number() over (partition by id order by updated_at desc) = 1)
select n.id, n.title, n.total_pages, epoch_us(coalesce(o.created_at, n.created_at)) as created_us, epoch_us(n.updated_at) as updated_us from new n left join old o using (id)""")
def upsert_documents(spark, d):
    """The first states of books with a grade, updated and added to by the last states of all; matched rows keep created_at."""
    columns = ["id", "title", "total_pages", "created_at", "updated_at"]
    rows = t(spark, d, "documents")
    old = tables.keep_first(rows.where("grade is not null"), [F.col("id")], [F.col("updated_at")]).select(columns)
    new = books(spark, d).select(columns).withColumn("created_at", F.expr("created_at + interval 1 day"))
    return tables.upsert(old, new, ["id"], keep=["created_at"]).select("id", "title", "total_pages", F.unix_micros("created_at").alias("created_us"), _us())


GONE = "gone as (select distinct id from embeddings_documents where publisher is null)"
CHILD_NAMES = ["pages", "book_chapters", "book_subsections", "chunks", "vectors", "ingestion_runs"]


@query(f"with {GONE} " + " union all ".join(f"select '{n}' as name, count(*) as n, count(document_id) as linked from embeddings_{n} where document_id is null or document_id not in (select id from gone)" for n in CHILD_NAMES[:-1]) + " union all select 'ingestion_runs', count(*), count(*) filter (document_id is not null and document_id not in (select id from gone)) from embeddings_ingestion_runs")
def delete_cascade(spark, d):
    """What is left of the children of books without publisher, once these are deleted."""
    left = tables.delete_cascade(t(spark, d, "documents").where("publisher is null"), {n: t(spark, d, n) for n in CHILD_NAMES}, set_null=("ingestion_runs",))
    out = None
    for n, df in left.items():
        one = df.agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("n"), F.count("document_id").alias("linked"))
        out = one if out is None else out.unionByName(one)
    return out


@query("""select id, document_id, status, pages_extracted, chunks_created, embeddings_created from (select distinct * from embeddings_ingestion_runs) qualify row_number() over (partition by id order by coalesce(finished_at, started_at) desc, status desc) = 1""")
def runs_latest(spark, d):
    return tables.run_states(t(spark, d, "ingestion_runs")).select("id", "document_id", "status", "pages_extracted", "chunks_created", "embeddings_created")


# ---- lookups and search


@query(f"""with {BOOKS}, {", ".join(f"{n} as (select document_id, count(*) as n from embeddings_{n} group by document_id)" for n in ("pages", "book_chapters", "book_subsections", "chunks", "vectors"))}
select b.id, b.book_title, {", ".join(f"coalesce({n}.n, 0) as n_{n}" for n in ("pages", "book_chapters", "book_subsections", "chunks", "vectors"))} from books b {" ".join(f"left join {n} on {n}.document_id = b.id" for n in ("pages", "book_chapters", "book_subsections", "chunks", "vectors"))}""")
def document_summary(spark, d):
    out = books(spark, d).select("id", "book_title")
    for n in ("pages", "book_chapters", "book_subsections", "chunks", "vectors"):
        counts = t(spark, d, n).groupBy(F.col("document_id").alias("id")).agg(F.count(F.lit(1)).alias(f"n_{n}"))
        out = out.join(counts, "id", "left")
    return out.na.fill(0)


@query("""with p as (select * from embeddings_pages qualify row_number() over (partition by document_id, page_number order by created_at desc, id desc) = 1), l as (select document_id, max(page_number) as last from p group by document_id),
c as (select distinct document_id, id, chapter_title, pdf_start_page, pdf_end_page from embeddings_book_chapters where chapter_title ilike '%the%' and chapter_number is not null),
h as (select c.id, c.chapter_title, p.page_number, p.raw_text from c join l using (document_id) join p on p.document_id = c.document_id and p.page_number between pdf_start_page and coalesce(pdf_end_page, last))
select id, chapter_title, count(*) as pages, min(page_number) as first_page, sha256(coalesce(string_agg(raw_text, chr(10) || chr(10) order by page_number) filter (trim(raw_text, ' ' || chr(10) || chr(13) || chr(9)) <> ''), '')) as digest from h group by all""")
def chapter_text(spark, d):
    """The text of the chapters with "the" in their titles, from the newest state of each page."""
    p = pages(spark, d).groupBy("document_id", "page_number").agg(F.max_by("raw_text", F.struct("created_at", "id")).alias("raw_text"))
    c = t(spark, d, "book_chapters").where(F.col("chapter_title").ilike("%the%") & F.col("chapter_number").isNotNull()).select("document_id", "id", "chapter_title", "pdf_start_page", "pdf_end_page").distinct()
    last = p.groupBy("document_id").agg(F.max("page_number").alias("last"))
    spread = c.join(last, "document_id").withColumn("end", F.least(F.coalesce("pdf_end_page", "last"), "last")).where("pdf_start_page <= end").select("document_id", "id", "chapter_title", F.explode(F.sequence("pdf_start_page", "end")).alias("page_number"))
    h = spread.join(p, ["document_id", "page_number"])
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.trim(F.regexp_replace("raw_text", r"[\n\r\t ]+", " ")) != "", F.struct("page_number", "raw_text")))), lambda x: x["raw_text"]), "\n\n")
    return h.groupBy("id", "chapter_title").agg(F.count(F.lit(1)).alias("pages"), F.min("page_number").alias("first_page"), F.sha2(text, 256).alias("digest"))


@query(f"""with {BOOKS} select s.id, b.document_key, s.section_number, s.subsection_number, s.subsection_title, s.pdf_start_page, s.pdf_end_page,
row_number() over (partition by s.document_id order by coalesce(pdf_start_page, 2147483647), section_number nulls last, subsection_number nulls last, s.id) as place from embeddings_book_subsections s join books b on b.id = s.document_id where s.subsection_title ilike '%and%'""")
def list_subsections(spark, d):
    b = books(spark, d).select(F.col("id").alias("document_id"), "document_key")
    w = Window.partitionBy("document_id").orderBy(F.coalesce("pdf_start_page", F.lit(2147483647)), F.col("section_number").asc_nulls_last(), F.col("subsection_number").asc_nulls_last(), "id")
    s = t(spark, d, "book_subsections").where(search.condition({"subsection_title": "and"}, ["subsection_title"])).join(b, "document_id").withColumn("place", F.row_number().over(w).cast("bigint"))
    return s.select("id", "document_key", "section_number", "subsection_number", "subsection_title", "pdf_start_page", "pdf_end_page", "place")


@query("""with p as (select * from embeddings_pages qualify row_number() over (partition by document_id, page_number order by created_at desc, id desc) = 1), s as (select id, document_id, unnest(range(pdf_start_page, greatest(pdf_start_page, coalesce(pdf_end_page, pdf_start_page)) + 1)) as page_number from embeddings_book_subsections where pdf_start_page is not null and include_in_embeddings)
select s.id, count(*) as pages, sum(length(raw_text)) as characters from s join p using (document_id, page_number) group by s.id""")
def subsection_text(spark, d):
    p = pages(spark, d).groupBy("document_id", "page_number").agg(F.max_by(F.length("raw_text"), F.struct("created_at", "id")).alias("n"))
    s = t(spark, d, "book_subsections").where("include_in_embeddings").select("id", "document_id", F.explode(X.page_range(F.col("pdf_start_page"), F.col("pdf_end_page"))).alias("page_number"))
    return s.join(p, ["document_id", "page_number"]).groupBy("id").agg(F.count(F.lit(1)).alias("pages"), F.sum("n").alias("characters"))


V = """v as (select chunk_id, list_transform(embedding, lambda x: x::double) as e from embeddings_vectors where embedding_model = 'shelf-embed-v2' and len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0
qualify row_number() over (partition by chunk_id order by created_at desc, embedding desc) = 1), q as (select e as qe from v join similarity_probes p using (chunk_id) order by probe_id limit 1)"""
SCORED = "(select chunk_id, greatest(0, list_cosine_similarity(e, qe)) as s from v, q)"


def _vectors(spark, d):
    v = t(spark, d, "vectors").where("embedding_model = 'shelf-embed-v2' and size(embedding) = 64 and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(embedding, x -> x <> 0)")
    return v.groupBy("chunk_id").agg(F.max_by("embedding", F.struct("created_at", "embedding")).alias("embedding"))


def _query_vector(spark, d) -> list[float]:
    """The vector of the first probe: one row."""
    return list(_vectors(spark, d).join(table(spark, d, "similarity_probes"), "chunk_id").orderBy("probe_id").select("embedding").first()[0])


@query(f"with {V} select chunk_id, round(s, 6) as vector_score from {SCORED} join embeddings_chunks c on c.id = chunk_id order by s desc, chunk_id limit 24")
def vector_topk(spark, d):
    return search.vector_top(t(spark, d, "chunks"), _vectors(spark, d), _query_vector(spark, d), 24).select("chunk_id", F.round("vector_score", 6).alias("vector_score"))


@query(f"with {BOOKS}, {V} select chunk_id, round(s, 6) as vector_score from {SCORED} join embeddings_chunks c on c.id = chunk_id join books b on b.id = c.document_id where b.board = 'State' and c.chapter_title ilike '%and%' order by s desc, chunk_id limit 24")
def vector_topk_filtered(spark, d):
    return search.vector_top(_with_books(spark, d), _vectors(spark, d), _query_vector(spark, d), 24, {"board": "State", "chapter_title": "and"}).select("chunk_id", F.round("vector_score", 6).alias("vector_score"))


def _with_books(spark, d):
    b = books(spark, d).select(F.col("id").alias("document_id"), "school_name", "class_name", "grade", "board", "subject", "book_title", "language")
    return t(spark, d, "chunks").join(b, "document_id")


TOKENS_OF = "regexp_extract_all(lower(coalesce({0}, '')), '(?:[\\p{{L}}\\p{{N}}_]|\\p{{M}})+')"


def _hits(word: str) -> str:
    count = lambda c: f"len(list_filter({TOKENS_OF.format(c)}, lambda x: x = '{word}'))"
    return f"{count('chapter_title')} + 0.2::double * {count('content')}"



@query(f"select id as chunk_id, round(s, 6) as keyword_score from (select id, {_hits("basket")} as s from embeddings_chunks) where s > 0 order by s desc, id limit 24")
def keyword_topk(spark, d):
    return search.keyword_top(t(spark, d, "chunks"), "basket", 24, {"chapter_title": "A", "content": "C"}).select("chunk_id", F.round("keyword_score", 6).alias("keyword_score"))


@query()
def keyword_phrases(spark, d):
    """All of the syntax: phrases, alternatives, exclusions."""
    return search.keyword_top(t(spark, d, "chunks"), '"cotton bag" garden or basket -needle', 50, {"chapter_title": "A", "content": "C"})


FILTERED = "b.board = 'State'"
VS = f"vs as (select chunk_id, s as vector_score from {SCORED} join embeddings_chunks c on c.id = chunk_id join books b on b.id = c.document_id where {FILTERED} order by s desc, chunk_id limit 24)"
KS = f"ks as (select id as chunk_id, s as keyword_score from (select c.id, {_hits("needle")} as s from embeddings_chunks c join books b on b.id = c.document_id where {FILTERED}) where s > 0 order by s desc, id limit 24)"
META = "least(1.0::double, case when regexp_matches(lower(concat_ws(' ', b.school_name, b.book_title, c.chapter_title, c.chunk_type)), 'needle') then 0.2::double else 0 end + case when c.chunk_type in ('definition', 'explanation', 'example', 'activity', 'grammar_rule', 'worked_example') then 0.15::double else 0 end)"


@query(f"""with {BOOKS}, {V}, {VS}, {KS}, m as (select coalesce(vs.chunk_id, ks.chunk_id) as chunk_id, coalesce(vector_score, 0) as v, coalesce(keyword_score, 0)::double as k from vs full join ks using (chunk_id)),
f as (select chunk_id, v, k, {META} as meta, 0.70 * v + 0.20 * k + 0.10 * {META} as final from m join embeddings_chunks c on c.id = m.chunk_id join books b on b.id = c.document_id)
select chunk_id, round(v, 6) as vector_score, round(k, 6) as keyword_score, round(meta, 6) as metadata_score, round(final, 6) as final_score from f order by final desc, chunk_id limit 8""")
def hybrid_search(spark, d):
    found = search.hybrid(_with_books(spark, d), _vectors(spark, d), "needle", _query_vector(spark, d), 8, {"board": "State"})
    return found.select("chunk_id", *[F.round(c, 6).alias(c) for c in ("vector_score", "keyword_score", "metadata_score", "final_score")])


@query("""with c as (select document_id, count(*) as n, max(page_number) as hi from embeddings_pages group by document_id) select r.id, r.status, c.n = r.pages_extracted as pages_agree from (select distinct * from embeddings_ingestion_runs) r join c using (document_id)""")
def runs_against_pages(spark, d):
    c = pages(spark, d).groupBy("document_id").agg(F.count(F.lit(1)).alias("n"))
    return t(spark, d, "ingestion_runs").distinct().join(c, "document_id").select("id", "status", (F.col("n") == F.col("pages_extracted")).alias("pages_agree"))
