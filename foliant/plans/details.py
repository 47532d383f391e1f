"""Queries of the smaller operators: titles and terms, unit groups, printed ends, edges of parents, samples, quality, matching."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from foliant.functions import text as X
from foliant.operators import detection, structure
from foliant.plans.books import NEWEST, newest_pages
from foliant.plans.reference import BOOKS, LANGUAGE, SQUEEZE, books, pages, t
from foliant.sources import files

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


FILLED = "nullif(trim({0}), '')"
TITLE = "coalesce(" + ", ".join(FILLED.format(c) for c in ("chapter_title", "section_title", "lesson_title", "unit_title")) + ")"


@query(f"""with l as (select distinct document_id, {LANGUAGE} as language from embeddings_pages) select document_id, string_agg(language, ',' order by language) as languages, case when count(*) > 1 then 'Mixed' else max(language) end as language from l where language <> 'Unknown' group by document_id""")
def languages_detected(spark, d):
    found = pages(spark, d).select("document_id", X.script_language(F.col("raw_text")).alias("l")).where("l <> 'Unknown'").groupBy("document_id").agg(F.array_sort(F.collect_set("l")).alias("ls"))
    return found.select("document_id", F.array_join("ls", ",").alias("languages"), F.when(F.size("ls") > 1, "Mixed").otherwise(F.col("ls")[0]).alias("language"))


@query("""with w as (select document_id, trim(quality_flag) as term, row_number() over (partition by document_id order by coalesce(pdf_start_page, 2147483647), id, i) as n from (select document_id, pdf_start_page, id, generate_subscripts(quality_flags, 1) as i, unnest(quality_flags) as quality_flag from embeddings_book_subsections)),
f as (select document_id, arg_min(term, n) as term, min(n) as n from w where term <> '' group by document_id, lower(term)), r as (select *, row_number() over (partition by document_id order by n) as k from f)
select document_id, string_agg(term, '|' order by k) as terms from r where k <= 30 group by document_id""")
def merged_terms(spark, d):
    """The flags of a book's subsections in order, each once whatever its case."""
    s = t(spark, d, "book_subsections").where("size(quality_flags) > 0").groupBy("document_id").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("pdf_start_page", F.lit(2147483647)), "id", "quality_flags"))).alias("x"))
    return s.select("document_id", F.array_join(X.merged_terms(F.flatten(F.transform("x", lambda r: r["quality_flags"]))), "|").alias("terms")).where("terms <> ''")


@query(f"""select document_id, unit_number, coalesce({FILLED.format("unit_title")}, {FILLED.format("chapter_title")}, 'Sections') as unit, min(pdf_start_page) as start_page, max(coalesce(pdf_end_page, pdf_start_page)) as end_page, count(*) as sections, round(avg(confidence), 4) as confidence
from embeddings_book_chapters where {TITLE} is not null group by all""")
def section_units(spark, d):
    r = t(spark, d, "book_chapters").where(structure.display_title().isNotNull())
    unit = F.coalesce(structure.filled(F.col("unit_title")), structure.filled(F.col("chapter_title")), F.lit("Sections"))
    return r.groupBy("document_id", "unit_number", unit.alias("unit")).agg(F.min("pdf_start_page").alias("start_page"), F.max(F.coalesce("pdf_end_page", "pdf_start_page")).alias("end_page"), F.count(F.lit(1)).alias("sections"), F.round(F.avg("confidence"), 4).alias("confidence"))


RELIABLE = """reliable as (select document_id, count(*) as records, count(*) >= 5 and count(printed_start_page) >= greatest(5, floor(count(*) * 0.70)) and count(*) filter (printed_start_page > b) >= greatest(3, floor((count(printed_start_page) - 1) * 0.80)) as reliable from (
select *, lag(printed_start_page) over (partition by document_id, printed_start_page is null order by pdf_start_page nulls first, id, updated_at) as b from {0}) group by document_id)"""
ORDER = ["pdf_start_page", "id", "updated_at"]


@query(f"with {RELIABLE.format('embeddings_book_chapters')} select * from reliable")
def toc_reliable(spark, d):
    return detection.reliable(t(spark, d, "book_chapters"), ORDER)


_KEYOF = f"trim(regexp_replace(trim(regexp_replace(lower({TITLE}), '[^a-z0-9]+', ' ', 'g')), '\\s+[0-9]{{1,4}}$', ''))"


@query(f"""with m as (select * from embeddings_book_chapters where confidence >= 0.7), u as (select * from embeddings_book_chapters where confidence < 0.7 or confidence is null), {RELIABLE.format('u')},
s as (select document_id, bool_or(coalesce(structure_type = 'section', false) and {FILLED.format("section_title")} is not null and {FILLED.format("chapter_title")} is null) as sections from u group by document_id),
n as (select document_id, count(*) as n_model from m where {TITLE} is not null group by document_id),
h as (select document_id, count(*) as shared from (select distinct document_id, {_KEYOF} as k from m where {TITLE} is not null) join (select distinct document_id, {_KEYOF} as k from u where {TITLE} is not null) using (document_id, k) where k <> '' group by document_id),
j as (select document_id, coalesce(n_model, 0) as n_model, coalesce(records, 0) as n_rules, coalesce(shared, 0) as shared, coalesce(reliable, false) as reliable, coalesce(sections, false) as sections from reliable full join n using (document_id) left join s using (document_id) left join h using (document_id))
select document_id, n_model, n_rules, shared, reliable and (sections or n_model = 0 or n_model > greatest(n_rules + 8, floor(n_rules * 1.35)) or n_rules >= 8 and (n_model < floor(n_rules * 0.65) or shared < greatest(3, floor(n_rules * 0.55)))) as prefer from j""")
def structure_choice(spark, d):
    """Sure records as a model's, the others as those of the contents."""
    r = t(spark, d, "book_chapters")
    return detection.prefer_rules(r.where("confidence >= 0.7"), r.where("confidence < 0.7 or confidence is null"), ORDER)


@query(f"""with {NEWEST}, s as (select distinct id, document_id, unnest(range(pdf_start_page, greatest(pdf_start_page, coalesce(pdf_end_page, pdf_start_page)) + 1)) as page_number from embeddings_book_chapters where pdf_start_page is not null and chapter_number = '1')
select s.id, sha256(string_agg('[Page ' || page_number || ']' || chr(10) || raw_text, chr(10) || chr(10) order by page_number)) as digest from s join newest using (document_id, page_number) where {SQUEEZE.format("raw_text")} is not null group by s.id""")
def text_with_page_heads(spark, d):
    """The text of first chapters, each page under its number."""
    c = t(spark, d, "book_chapters").where("pdf_start_page is not null and chapter_number = '1'").select("id", "document_id", F.explode(X.page_range(F.col("pdf_start_page"), F.col("pdf_end_page"))).alias("page_number")).distinct()
    p = newest_pages(spark, d).where(X.squeeze(F.col("raw_text")).isNotNull())
    body = F.struct("page_number", F.concat(F.lit("[Page "), F.col("page_number").cast("string"), F.lit("]\n"), "raw_text").alias("t"))
    held = c.join(p.drop("id"), ["document_id", "page_number"]).groupBy("id").agg(F.array_sort(F.collect_list(body)).alias("x"))
    return held.select("id", F.sha2(F.array_join(F.transform("x", lambda r: r["t"]), "\n\n"), 256).alias("digest"))


@query("""with l as (select document_id, max(page_number) as last from embeddings_pages group by document_id), n as (select c.*, lead(pdf_start_page) over w as nx, lead(printed_start_page) over w as np from embeddings_book_chapters c where pdf_start_page > 0 window w as (partition by document_id order by pdf_start_page, id, updated_at)),
c as (select *, try_cast(translate(regexp_extract(chapter_number, '(\\p{Nd}+)', 1), '०१२३४५६७८९', '0123456789') as integer) = 1 as one from embeddings_book_chapters where pdf_start_page is not null),
a as (select document_id, min(pdf_start_page) filter (one and nullif(trim(chapter_title), '') is not null) - 1 as c1, min(pdf_start_page) filter (printed_start_page = 1) - 1 as p1 from c group by document_id),
o as (select document_id, pdf_start_page - printed_start_page as o, count(*) as n from c where pdf_start_page - printed_start_page between 0 and 80 group by all), m as (select document_id, o, n from o qualify row_number() over (partition by document_id order by n desc, o) = 1),
f as (select document_id, case when c1 >= 0 then c1 when p1 >= 0 then p1 when n >= 2 then o end as off from a left join m using (document_id))
select n.id, epoch_us(n.updated_at) as updated_us, cast(case when printed_start_page is not null then case when off is not null then coalesce(nx - 1, last) - off else np - 1 end end as integer) as printed_end_page from n join l using (document_id) left join f using (document_id)""")
def printed_ends(spark, d):
    """Printed ends: the end in the file less the book's offset, else the next printed start less one."""
    return structure.with_printed_ends(t(spark, d, "book_chapters"), pages(spark, d)).select("id", F.unix_micros("updated_at").alias("updated_us"), "printed_end_page")


_K = ["chapter_number", "unit_number", "section_number"]
_KEYED = ", ".join(f"coalesce({k}, '') as {k}" for k in _K)


@query(f"""with p as (select document_id, {_KEYED}, min(pdf_start_page) as lo, max(pdf_end_page) as hi from embeddings_book_chapters group by all),
c as (select document_id, {_KEYED}, min(pdf_start_page) as first, max(pdf_end_page) as last from embeddings_book_subsections where pdf_start_page is not null and pdf_end_page is not null group by all)
select document_id, {", ".join(_K)}, 'start' as edge, cast(first - lo as integer) as pages from c join p using (document_id, {", ".join(_K)}) where first > lo union all
select document_id, {", ".join(_K)}, 'end', cast(hi - last as integer) from c join p using (document_id, {", ".join(_K)}) where last < hi""")
def parent_edge_gaps(spark, d):
    """Pages at the start and end of a record that no subsection of it covers."""
    keyed = lambda df: df.select("document_id", *[F.coalesce(k, F.lit("")).alias(k) for k in _K], "pdf_start_page", "pdf_end_page")
    p = keyed(t(spark, d, "book_chapters")).groupBy("document_id", *_K).agg(F.min("pdf_start_page").alias("lo"), F.max("pdf_end_page").alias("hi"))
    c = keyed(t(spark, d, "book_subsections")).where("pdf_start_page is not null and pdf_end_page is not null").groupBy("document_id", *_K).agg(F.min("pdf_start_page").alias("first"), F.max("pdf_end_page").alias("last"))
    gaps = F.array_compact(F.array(F.when(F.col("first") > F.col("lo"), F.struct(F.lit("start").alias("edge"), (F.col("first") - F.col("lo")).alias("pages"))), F.when(F.col("last") < F.col("hi"), F.struct(F.lit("end").alias("edge"), (F.col("hi") - F.col("last")).alias("pages")))))
    return c.join(p, ["document_id", *_K]).select("document_id", *_K, F.explode(gaps).alias("g")).select("document_id", *_K, "g.*")


@query("""select document_id, id, subsection_title, cast(row_number() over (partition by document_id order by pdf_start_page nulls last, id) as integer) as place from embeddings_book_subsections qualify place <= 5""")
def subsection_samples(spark, d):
    """The first five subsections of each book, those without a page last."""
    w = Window.partitionBy("document_id").orderBy(F.col("pdf_start_page").asc_nulls_last(), "id")
    return t(spark, d, "book_subsections").select("document_id", "id", "subsection_title", F.row_number().over(w).alias("place")).where("place <= 5")


@query(f"""select document_id, chunk_index, coalesce({FILLED.format("chapter_title")}, array_to_string(list_transform(string_split(replace(coalesce(chunk_type, 'content'), '_', ' '), ' '), lambda x: upper(x[1]) || lower(x[2:])), ' ') || ' ' || (chunk_index + 1)) as title, substring(content, 1, 220) as preview
from embeddings_chunks qualify row_number() over (partition by document_id order by chunk_index) <= 8""")
def chunk_previews(spark, d):
    """The first eight chunks of each book by title and their first 220 characters."""
    w = Window.partitionBy("document_id").orderBy("chunk_index")
    c = t(spark, d, "chunks").withColumn("n", F.row_number().over(w)).where("n <= 8")
    return c.select("document_id", "chunk_index", X.chunk_title([structure.filled(F.col("chapter_title"))], F.col("chunk_type"), F.col("chunk_index") + 1).alias("title"), F.substring("content", 1, 220).alias("preview"))


@query(f"""with {NEWEST}, r as (select document_id, page_number, coalesce(regexp_matches(raw_text, '(?i)(^|[^\\p{{L}}\\p{{N}}_])(contents|table of contents|index)($|[^\\p{{L}}\\p{{N}}_])|अनुक्रमणिका|विषय\\s*सूची|সূচিপত্র'), false) as toc, row_number() over (partition by document_id order by page_number) as place from newest),
s as (select * from r where place <= 104), a as (select distinct document_id, unnest(range(page_number + 1, page_number + 4)) as place from s where toc and place <= 40)
select s.document_id, page_number from s left join a on a.document_id = s.document_id and a.place = s.place where s.place <= 20 or toc and s.place <= 40 or a.place is not null or s.place in (20, 40, 60, 100)""")
def prompt_pages(spark, d):
    return detection.sampled_pages(newest_pages(spark, d))


@query("""select id, epoch_us(updated_at) as updated_us, strftime(updated_at, '%Y-%m-%dT%H:%M:%SZ') as written, try_cast(translate(trim(publication_year), '०१२३४५६७८९', '0123456789') as double) as year from embeddings_documents""")
def iso_times(spark, d):
    return t(spark, d, "documents").select("id", F.unix_micros("updated_at").alias("updated_us"), F.date_format("updated_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("written"), X.safe_float(F.col("publication_year")).alias("year"))


@query("""with k as (select id, updated_at, unnest(json_keys(metadata)) as key, metadata from embeddings_documents where json_valid(metadata)) select id, epoch_us(updated_at) as updated_us, string_agg(key, ',' order by key) as keys from k where key not in ('llm', 'source', 'pages') group by all""")
def other_metadata(spark, d):
    """The names in a book's metadata but those that have a column of their own."""
    m = F.from_json("metadata", "map<string,string>")
    kept = F.map_filter(m, lambda k, v: ~k.isin("llm", "source", "pages"))
    return t(spark, d, "documents").select("id", F.unix_micros("updated_at").alias("updated_us"), F.array_join(F.array_sort(F.map_keys(kept)), ",").alias("keys")).where("keys <> ''")


_LEN = "length(coalesce(regexp_replace(raw_text, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g'), ''))"


@query(f"""with {NEWEST}, {BOOKS}, r as (select *, row_number() over (partition by document_id order by page_number, id) - 1 as i, count(*) over (partition by document_id) as n from newest),
s as (select r.*, coalesce(regexp_matches(lower(concat_ws(' ', b.subject, b.language, b.book_title)), 'hindi|हिंदी|हिन्दी|devanagari'), false) as hindi from r left join books b on b.id = r.document_id where i < 10 or (i - 10) % greatest(1, (n - 1) // 15) = 0 and (i - 10) // greatest(1, (n - 1) // 15) < 15),
q as (select document_id, {_LEN} as n, len(regexp_extract_all(raw_text, '[\\x80-\\x9F]')) > 0 as c, len(regexp_extract_all(raw_text, '\\x{{FFFD}}')) > 0 as r, coalesce(len(regexp_extract_all(raw_text, '[A-Za-z]')), 0) as l, coalesce(len(regexp_extract_all(raw_text, '[ऀ-ॿ]')), 0) as v, hindi from s),
a as (select document_id, count(*) as sampled_pages, count(*) filter (n = 0) as empty_pages, count(*) filter (n > 0) as text_pages, count(*) filter (c) as control_pages, count(*) filter (r) as replacement_pages, count(*) filter (l >= 80 and v >= 2 and v <= greatest(40, floor(l * 0.2)) and not hindi) as stray_pages, round(coalesce(avg(n) filter (n > 0), 0), 2) as average_characters from q group by document_id)
select *, empty_pages >= 0.35 * sampled_pages or text_pages > 0 and average_characters < 120 or control_pages + replacement_pages + stray_pages >= 0.12 * sampled_pages or control_pages + replacement_pages > 0 or stray_pages >= 2 as should_ocr from a""")
def ocr_triggers(spark, d):
    """Which books are to be read by OCR, by the first ten pages and up to 15 more at even distances."""
    w = Window.partitionBy("document_id")
    p = newest_pages(spark, d).withColumn("i", F.row_number().over(w.orderBy("page_number", "id")) - 1).withColumn("n", F.count(F.lit(1)).over(w))
    step = F.greatest(F.lit(1), F.floor((F.col("n") - 1) / 15))
    p = p.where((F.col("i") < 10) | ((F.col("i") - 10) % step == 0) & (F.floor((F.col("i") - 10) / step) < 15))
    b = books(spark, d).select(F.col("id").alias("document_id"), F.coalesce(F.lower(F.concat_ws(" ", "subject", "language", "book_title")).rlike("hindi|हिंदी|हिन्दी|devanagari"), F.lit(False)).alias("hindi"))
    return files.quality_report(p.join(b, "document_id", "left"), F.coalesce("hindi", F.lit(False))).drop("reason")


_SAME = lambda c: f"coalesce({FILLED.format('c.' + c)} = {FILLED.format('r.' + c)}, true)"
_MEET = "c.document_id = r.document_id and c.page_start <= coalesce(r.pdf_end_page, r.pdf_start_page) and c.page_end >= r.pdf_start_page and r.pdf_start_page <= coalesce(r.pdf_end_page, r.pdf_start_page) and c.page_start <= c.page_end"


@query(f"""with x as (select distinct c.id as chunk_id, r.id as record_id, {_SAME("chapter_title")} as same from embeddings_chunks c join embeddings_book_chapters r on {_MEET} where {FILLED.format("r.chapter_title")} is not null),
p as (select chunk_id, record_id, bool_or(same) as same from x group by all), s as (select *, bool_or(same) over (partition by record_id) as any_same from p) select chunk_id, record_id from s where same or not any_same""")
def chapter_lessons(spark, d):
    """The chunks of each chapter: of its title, or, where there are none, all over its pages."""
    r = t(spark, d, "book_chapters").where(structure.filled(F.col("chapter_title")).isNotNull())
    return structure.matches(t(spark, d, "chunks"), r, ["chapter_title"], alone=True)


# ---- writes by key, defaults, checks of keys


def _upserted(t_old, t_new, keys, keep):
    from foliant.operators import tables

    return tables.upsert(t_old, t_new, keys, keep)


@query("""with old as (select document_id, page_number, id, word_count, epoch_us(created_at) as created_us from embeddings_pages qualify row_number() over (partition by document_id, page_number order by created_at, id) = 1),
new as (select document_id, page_number, id, word_count, epoch_us(created_at) as created_us from embeddings_pages where word_count > 20 qualify row_number() over (partition by document_id, page_number order by created_at desc, id desc) = 1)
select coalesce(n.document_id, o.document_id) as document_id, coalesce(n.page_number, o.page_number) as page_number, coalesce(o.id, n.id) as id, case when n.id is not null then n.word_count else o.word_count end as word_count, coalesce(n.created_us, o.created_us) as created_us
from old o full join new n on o.document_id = n.document_id and o.page_number = n.page_number""")
def upsert_pages(spark, d):
    """The first states of pages, updated by the last states of those with text; a page keeps its first id."""
    p = pages(spark, d).select("document_id", "page_number", "id", "word_count", F.unix_micros("created_at").alias("created_us"))
    key = ["document_id", "page_number"]
    pick = lambda df, by: df.groupBy(*key).agg(by(F.struct("id", "word_count", "created_us"), F.struct("created_us", "id")).alias("r")).select(*key, "r.*")
    return _upserted(pick(p, F.min_by), pick(p.where("word_count > 20"), F.max_by), key, ["id"])


@query("""with old as (select chunk_id, embedding_model, embedding_dimensions, id, epoch_us(created_at) as created_us from embeddings_vectors qualify row_number() over (partition by chunk_id, embedding_model, embedding_dimensions order by created_at, id) = 1),
new as (select chunk_id, embedding_model, embedding_dimensions, id, epoch_us(created_at) as created_us from embeddings_vectors qualify row_number() over (partition by chunk_id, embedding_model, embedding_dimensions order by created_at desc, id desc) = 1)
select n.chunk_id, n.embedding_model, n.embedding_dimensions, o.id, n.created_us from new n join old o on n.chunk_id = o.chunk_id and n.embedding_model = o.embedding_model and n.embedding_dimensions = o.embedding_dimensions""")
def upsert_vectors(spark, d):
    """Vectors written again by chunk, model and dimensions: the first id, the last time."""
    key = ["chunk_id", "embedding_model", "embedding_dimensions"]
    v = t(spark, d, "vectors").where("chunk_id is not null and embedding_model is not null and embedding_dimensions is not null").select(*key, "id", F.unix_micros("created_at").alias("created_us"))
    pick = lambda by: v.groupBy(*key).agg(by(F.struct("id", "created_us"), F.struct("created_us", "id")).alias("r")).select(*key, "r.*")
    return _upserted(pick(F.min_by), pick(F.max_by), key, ["id"])


@query("""select document_id, chunk_index, id, case when chunk_index % 2 = 0 then token_count + 1 else token_count end as token_count from embeddings_chunks""")
def upsert_chunks(spark, d):
    """Every other chunk written again with one token more, by document and index."""
    c = t(spark, d, "chunks").select("document_id", "chunk_index", "id", "token_count")
    again = c.where("chunk_index % 2 = 0").withColumn("token_count", F.col("token_count") + 1).withColumn("id", F.lit("new"))
    return _upserted(c, again, ["document_id", "chunk_index"], ["id"])


@query("""select id, epoch_us(updated_at) as updated_us, coalesce(metadata, '{}') as metadata, coalesce(languages_detected, '[]') as languages, coalesce(total_pages, 0) as pages from embeddings_documents""")
def written_defaults(spark, d):
    """What is written for missing JSON and lists."""
    from foliant.operators import tables

    rows = tables.with_defaults(t(spark, d, "documents"), {"metadata": "{}", "languages_detected": "[]", "total_pages": 0})
    return rows.select("id", F.unix_micros("updated_at").alias("updated_us"), "metadata", F.col("languages_detected").alias("languages"), F.col("total_pages").alias("pages"))


UNIQUE = {"documents": ["document_key"], "pages": ["document_id", "page_number"], "book_chapters": ["document_id", "section_key"], "chunks": ["document_id", "chunk_index"], "vectors": ["chunk_id", "embedding_model", "embedding_dimensions"]}


@query(" union all ".join(f"select '{n}' as name, count(*) as keys, cast(coalesce(sum(n), 0) as bigint) as rows from (select count(*) as n from embeddings_{n} where {' and '.join(f'{k} is not null' for k in ks)} group by {', '.join(ks)} having count(*) > 1)" for n, ks in UNIQUE.items()))
def keys_held_twice(spark, d):
    """How many keys that are to be unique are held by several rows; a key with a null is none."""
    from functools import reduce

    from foliant.operators import tables

    one = lambda n, ks: tables.duplicates(t(spark, d, n).na.drop(subset=ks), [F.col(k) for k in ks]).agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
    return reduce(lambda a, b: a.unionByName(b), [one(n, ks) for n, ks in UNIQUE.items()])


@query("""with x as (select id, regexp_extract_all(lower(coalesce(chapter_title, '')), '(?:[\\p{L}\\p{N}_]|\\p{M})+') as a, regexp_extract_all(lower(coalesce(content, '')), '(?:[\\p{L}\\p{N}_]|\\p{M})+') as c from embeddings_chunks)
select id, len(list_distinct(list_concat(a, c))) as lexemes, len(a) as titles, len(a) + len(c) as positions from x""")
def chunk_lexemes(spark, d):
    """The stored form of a chunk for search: lexemes with their places and weights."""
    from foliant.operators import search

    x = search.lexeme_table(t(spark, d, "chunks"), {"chapter_title": "A", "content": "C"})
    return x.select("id", F.size(F.array_distinct("t")).alias("lexemes"), F.size(F.filter("w", lambda w: w == 1.0)).alias("titles"), F.size("t").alias("positions"))


@query(f"""with {BOOKS}, p as (select document_id, min(page_number) as first from embeddings_pages group by document_id) select id as document_id, document_key, book_title, school_name, class_name, subject, grade from books join p on p.document_id = id""")
def document_of_rows(spark, d):
    """The book as any of its rows has it: one row a book that has pages."""
    from foliant.operators import lookup

    b = lookup.of_document(books(spark, d), None, None, every=True)
    rows = pages(spark, d).select("document_id").join(b, "document_id")
    return rows.groupBy("document_id").agg(F.first(F.struct(*lookup.BOOK)).alias("b")).select("document_id", "b.*")
