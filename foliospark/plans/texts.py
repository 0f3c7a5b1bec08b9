"""Queries of text and page functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliospark.functions import html
from foliospark.functions import text as tx
from foliospark.registry import query
from foliospark.sources.tables import read

S, W = tx.SPACE, tx.WORD
q = lambda t: t.replace("'", "''")


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{S}+|{S}+$', '', 'g')"


def sql_clean(x: str) -> str:
    x = f"regexp_replace({x}, '<[^>]+>', '', 'g')"
    x = f"regexp_replace(translate({x}, chr(160), ' '), '[ \t]+', ' ', 'g')"
    return sql_strip(rf"regexp_replace({x}, '{S}+([_^]\{{)', '\1', 'g')")


def sql_words(x: str) -> str:
    return f"regexp_extract_all({x}, '{W}')"


@query("doc_word_sizes", f"SELECT doc_id, len({sql_words('text')})::BIGINT AS n_words FROM documents")
def doc_word_sizes(spark, sf):
    return read(spark, sf, "documents").select("doc_id", tx.word_count(F.col("text")).alias("n_words"))


@query("doc_content_hash", "SELECT doc_id, sha256(text) AS content_sha256 FROM documents")
def doc_content_hash(spark, sf):
    return read(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("content_sha256"))


@query("exact_duplicate_groups", "SELECT sha256(text) AS sha256, count(*)::BIGINT AS n_docs, min(doc_id) AS first_doc FROM documents GROUP BY 1 HAVING count(*) > 1")
def exact_duplicate_groups(spark, sf):
    return read(spark, sf, "documents").groupBy(F.sha2("text", 256).alias("sha256")).agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc")).where("n_docs > 1")


def sql_canonical(x: str) -> str:
    marks, plain = q(tx.QUOTES + tx.DOUBLE_QUOTES + tx.DASHES), q("'" * len(tx.QUOTES) + '"' * len(tx.DOUBLE_QUOTES) + "-" * len(tx.DASHES))
    return sql_strip(f"regexp_replace(translate(nfc_normalize({x}), '{marks}', '{plain}'), '{S}+', ' ', 'g')")


_CANON = sql_canonical("text")


@query("canonical_text_len", f"SELECT doc_id, length(c)::BIGINT AS n_chars, sha256(c) AS sha256, length(lower(c)) = length(c) AS keeps_length FROM (SELECT doc_id, {_CANON} AS c FROM documents)")
def canonical_text_len(spark, sf):
    d = read(spark, sf, "documents").select("doc_id", tx.canonical(F.col("text")).alias("c"))
    return d.select("doc_id", F.length("c").cast("long").alias("n_chars"), F.sha2("c", 256).alias("sha256"), (F.length(F.lower("c")) == F.length("c")).alias("keeps_length"))


@query("page_title", f"SELECT page_id, {sql_clean('regexp_extract(html, $$(?s)<title>(.*?)</title>$$, 1)')} AS title FROM pages")
def page_title(spark, sf):
    return read(spark, sf, "pages").select("page_id", tx.page_title(F.col("html")).alias("title"))


@query(
    "page_nav_children",
    f"""WITH nav AS (SELECT page_id, regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1) AS block FROM pages),
    found AS (SELECT page_id, regexp_extract_all(block, '(?s)<a href="([^"]*)">(.*?)</a>', 1) AS hrefs, regexp_extract_all(block, '(?s)<a href="([^"]*)">(.*?)</a>', 2) AS labels FROM nav),
    flat AS (SELECT page_id, unnest(hrefs) AS href, unnest(labels) AS label, generate_subscripts(hrefs, 1) AS pos FROM found)
    SELECT page_id, pos::BIGINT AS pos, href, {sql_clean("label")} AS title FROM flat""",
)
def page_nav_children(spark, sf):
    flat = read(spark, sf, "pages").select("page_id", F.posexplode(html.children(F.col("html"))).alias("p", "x"))
    return flat.select("page_id", (F.col("p") + 1).cast("long").alias("pos"), F.col("x.href").alias("href"), F.col("x.title").alias("title"))


@query(
    "page_body_fragment",
    """WITH s AS (SELECT page_id, CASE WHEN instr(html, '<article>') > 0 THEN substr(html, instr(html, '<article>')) END AS rest FROM pages),
    b AS (SELECT page_id, CASE WHEN instr(rest, '</article>') > 1 THEN substr(rest, 1, instr(rest, '</article>') - 1) ELSE rest END AS body FROM s)
    SELECT page_id, body IS NOT NULL AS has_body, coalesce(length(body), 0)::BIGINT AS n_chars, sha256(body) AS source_sha256 FROM b""",
)
def page_body_fragment(spark, sf):
    b = read(spark, sf, "pages").select("page_id", tx.fragment(F.col("html"), "<article>", "</article>").alias("body"))
    return b.select("page_id", F.col("body").isNotNull().alias("has_body"), F.coalesce(F.length("body"), F.lit(0)).cast("long").alias("n_chars"), F.sha2("body", 256).alias("source_sha256"))


@query("page_clean_text", f"SELECT page_id, length(c)::BIGINT AS n_chars, sha256(c) AS sha256 FROM (SELECT page_id, {sql_clean('html')} AS c FROM pages)")
def page_clean_text(spark, sf):
    return read(spark, sf, "pages").select("page_id", tx.clean_text(F.col("html")).alias("c")).select("page_id", F.length("c").cast("long").alias("n_chars"), F.sha2("c", 256).alias("sha256"))


@query(
    "page_url_parts",
    r"""SELECT page_id, lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) AS scheme, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) AS host,
    CASE WHEN p = '' THEN '/' ELSE p END || regexp_extract(url, '^[^?#]*(\?[^#]*)', 1) AS path
    FROM (SELECT *, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS p FROM pages)""",
)
def page_url_parts(spark, sf):
    u = F.col("url")
    return read(spark, sf, "pages").select("page_id", F.lower(F.regexp_extract(u, "^([A-Za-z][A-Za-z0-9+.-]*)://", 1)).alias("scheme"), F.regexp_extract(u, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1).alias("host"), tx.url_path(u).alias("path"))


@query(
    "etag_normalised",
    """SELECT page_id, regexp_replace(raw, '-gzip("?)$', '\\1') AS etag, regexp_matches(raw, '-gzip"?$') AS was_compressed
    FROM (SELECT page_id, CASE page_id % 3 WHEN 0 THEN '"' || left(md5(url), 8) || '-gzip"' WHEN 1 THEN '"' || left(md5(url), 8) || '"' ELSE left(md5(url), 8) || '-gzip' END AS raw FROM pages)""",
)
def etag_normalised(spark, sf):
    tag = F.left(F.md5("url"), F.lit(8))
    raw = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit('"'), tag, F.lit('-gzip"'))).when(F.col("page_id") % 3 == 1, F.concat(F.lit('"'), tag, F.lit('"'))).otherwise(F.concat(tag, F.lit("-gzip")))
    return read(spark, sf, "pages").select("page_id", raw.alias("raw")).select("page_id", tx.etag(F.col("raw")).alias("etag"), F.col("raw").rlike('-gzip"?$').alias("was_compressed"))


@query("slug_names", "SELECT page_id, left(trim(regexp_replace(lower(regexp_replace(strip_accents(title), '[^\\x00-\\x7F]', '', 'g')), '[^a-z0-9]+', '-', 'g'), '-'), 70) AS slug FROM (SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title FROM pages)")
def slug_names(spark, sf):
    return read(spark, sf, "pages").select("page_id", tx.slugify(F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1)).alias("slug"))


@query("breadcrumb_spacing", f"SELECT doc_id, {sql_strip(f'regexp_replace(replace(crumb, $$,$$, $$, $$), $${S}+$$, $$ $$, $$g$$)')} AS crumb FROM (SELECT doc_id, 'Libro ' || source || ',' || lang || ' ,  Letra ' || (doc_id % 7) AS crumb FROM documents)")
def breadcrumb_spacing(spark, sf):
    crumb = F.concat(F.lit("Libro "), "source", F.lit(","), "lang", F.lit(" ,  Letra "), (F.col("doc_id") % 7).cast("string"))
    return read(spark, sf, "documents").select("doc_id", tx.spaced(crumb).alias("crumb"))


_NOTE = """'Este numero fue modificado por la Norma de Carácter General N° ' || (doc_id % 97) || ', de fecha ' || (doc_id % 28 + 1) || ' de ' ||
    CASE doc_id % 4 WHEN 0 THEN 'enero' WHEN 1 THEN 'Abril' WHEN 2 THEN 'setiembre' ELSE 'diciembre' END || CASE WHEN doc_id % 6 = 5 THEN ' del ' ELSE ' de ' END || (1975 + doc_id % 25 * 2)
    || CASE WHEN doc_id % 9 = 0 THEN ' y por la NCG Nº ' || (doc_id % 13) ELSE '' END"""
_NOTE_OR_NOT = f"CASE WHEN doc_id % 8 = 3 THEN 'Nota sin fecha' ELSE {_NOTE} END"


def notes(spark, sf):
    """Amendment notes made from document ids, some without a date."""
    i = F.col("doc_id")
    month = F.when(i % 4 == 0, "enero").when(i % 4 == 1, "Abril").when(i % 4 == 2, "setiembre").otherwise("diciembre")
    s = lambda c: c.cast("string")
    note = F.concat(
        F.lit("Este numero fue modificado por la Norma de Carácter General N° "), s(i % 97), F.lit(", de fecha "), s(i % 28 + 1), F.lit(" de "), month, F.when(i % 6 == 5, " del ").otherwise(" de "), s(1975 + i % 25 * 2),
        F.when(i % 9 == 0, F.concat(F.lit(" y por la NCG Nº "), s(i % 13))).otherwise(""),
    )
    return read(spark, sf, "documents").select("doc_id", "source", F.when(i % 8 == 3, "Nota sin fecha").otherwise(note).alias("note"))


_MONTH_CASE = "CASE lower(m) " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in tx.MONTHS.items()) + " END"
NOTES_SQL = f"SELECT doc_id, source, {_NOTE_OR_NOT} AS note FROM documents"
LOOSE_SQL = f"""SELECT doc_id, source, y || '-' || lpad(({_MONTH_CASE})::VARCHAR, 2, '0') || '-' || lpad(d, 2, '0') AS date, n::BIGINT AS number
    FROM (SELECT doc_id, source, regexp_extract(note, '{tx.NOTE_LOOSE}', 1) AS n, regexp_extract(note, '{tx.NOTE_LOOSE}', 2) AS d, regexp_extract(note, '{tx.NOTE_LOOSE}', 3) AS m, regexp_extract(note, '{tx.NOTE_LOOSE}', 4) AS y FROM ({NOTES_SQL})) WHERE n <> ''"""
STRICT_SQL = f"SELECT doc_id, source, note, CASE WHEN y <> '' AND y::INT BETWEEN 1980 AND 2100 THEN y::BIGINT END AS year FROM (SELECT *, regexp_extract(note, '{tx.NOTE_STRICT}', 3) AS y FROM ({NOTES_SQL}))"


def loose(spark, sf):
    return notes(spark, sf).select("doc_id", "source", tx.amendment(F.col("note")).alias("a")).where("a is not null").select("doc_id", "source", "a.date", "a.number")


def strict(spark, sf):
    return notes(spark, sf).withColumn("year", tx.strict_year(F.col("note")).cast("long"))


@query("amendment_dates_loose", f"SELECT doc_id, date, number FROM ({LOOSE_SQL})")
def amendment_dates_loose(spark, sf):
    return loose(spark, sf).select("doc_id", "date", "number")


@query("amendment_dates_strict", f"SELECT doc_id, year, array_to_string(regexp_extract_all(note, '{tx.NOTE_NUMBER}', 1), ',') AS numbers FROM ({STRICT_SQL})")
def amendment_dates_strict(spark, sf):
    return strict(spark, sf).select("doc_id", "year", F.array_join(tx.note_numbers(F.col("note")).cast("array<string>"), ",").alias("numbers"))


@query(
    "formatted_numbers",
    """SELECT o_orderkey, replace(format('{:,}', o_orderkey * 7919), ',', '.') AS thousands, strftime(o_orderdate, '%d-%m-%Y') AS day_first,
    CASE WHEN n < 1024 THEN printf('%.0f B', n) WHEN n < 1048576 THEN printf('%.0f KB', n / 1024) WHEN n < 1073741824 THEN printf('%.1f MB', n / 1048576) ELSE printf('%.1f GB', n / 1073741824) END AS size
    FROM (SELECT *, (o_orderkey * 7919)::DOUBLE AS n FROM orders)""",
)
def formatted_numbers(spark, sf):
    n = F.col("o_orderkey") * 7919
    return read(spark, sf, "orders").select("o_orderkey", tx.thousands(n).alias("thousands"), tx.day_first(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day_first"), tx.human_bytes(n).alias("size"))


@query("front_matter_stripped", f"SELECT doc_id, len({sql_words('body')})::BIGINT AS n_words, sha256(body) AS sha256 FROM (SELECT doc_id, regexp_replace('---' || chr(10) || 'source: ' || source || chr(10) || '---' || chr(10) || text, '(?s)\\A---\\n.*?\\n---\\n', '') AS body FROM documents)")
def front_matter_stripped(spark, sf):
    made = F.concat(F.lit("---\nsource: "), "source", F.lit("\n---\n"), "text")
    d = read(spark, sf, "documents").select("doc_id", tx.without_front_matter(made).alias("body"))
    return d.select("doc_id", tx.word_count(F.col("body")).alias("n_words"), F.sha2("body", 256).alias("sha256"))


@query("demoted_headings", r"SELECT doc_id, sha256(array_to_string(list_transform(string_split('# ' || source || chr(10) || '##### deep' || chr(10) || text, chr(10)), lambda x: CASE WHEN regexp_matches(x, '^#{1,6}\s') THEN repeat('#', least(6, length(regexp_extract(x, '^(#+)', 1)) + 2)) || regexp_replace(x, '^#+\s', ' ') ELSE x END), chr(10))) AS sha256 FROM documents")
def demoted_headings(spark, sf):
    made = F.concat(F.lit("# "), "source", F.lit("\n##### deep\n"), "text")
    return read(spark, sf, "documents").select("doc_id", F.sha2(tx.demote(made, 2), 256).alias("sha256"))


@query("excerpt")
def excerpt(spark, sf):
    return read(spark, sf, "documents").select("doc_id", tx.excerpt(F.col("text")).alias("excerpt"))


_FLAT = "source || '. - ' || replace(text, chr(10), ' 12. Á ') || ' Nota de actualización: nueva'"
_UNTITLED = f"regexp_replace(substr({_FLAT}, length(source) + 1), '^[ .-]+', '')"
_ITEMS = f"regexp_replace(regexp_replace({_UNTITLED}, '([.;:)])\\s+(\\d{{1,3}}[.)]\\s+[A-ZÁÉÍÓÚÑ¿(])', '\\1\n\n\\2', 'g'), '(?i)\\s*Nota de actualizaci[óo]n:\\s*', '\n\n> **Nota de actualización:** ', 'g')"


@query("paragraphs_restored", f"SELECT doc_id, sha256({sql_strip(f'regexp_replace({_ITEMS}, $$\n{{3,}}$$, $$\n\n$$, $$g$$)')}) AS sha256 FROM documents")
def paragraphs_restored(spark, sf):
    made = F.concat("source", F.lit(". - "), F.replace("text", F.lit("\n"), F.lit(" 12. Á ")), F.lit(" Nota de actualización: nueva"))
    return read(spark, sf, "documents").select("doc_id", F.sha2(tx.pdf_markdown(made, F.col("source")), 256).alias("sha256"))


@query("source_folders", "SELECT DISTINCT source, upper(split_part(lower(lang) || '-' || source, '-', 2)) AS roman, 'https://example.org/w3-propertyvalue-' || (length(source) + 100) || '.html' AS url FROM documents")
def source_folders(spark, sf):
    d = read(spark, sf, "documents")
    return d.select("source", F.upper(F.split_part(F.concat(F.lower("lang"), F.lit("-"), F.col("source")), F.lit("-"), F.lit(2))).alias("roman"), F.format_string("https://example.org/w3-propertyvalue-%d.html", F.length("source") + 100).alias("url")).distinct()
