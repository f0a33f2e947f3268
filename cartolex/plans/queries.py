"""The registered queries over the driver's tables, one or more for each family of operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cartolex.functions.text import normalized_id, normalized_name, strip
from cartolex.operators import chunks, constraints, embed, graph, link, metadata, references, reports, resolve, search, sections, toc, topics, validate, validity, vector_index
from cartolex.operators.sections import HeaderProfile
from cartolex.plans import graph_queries
from cartolex.plans.knowledge_graph import Graph
from cartolex.plans.registry import query, table
from cartolex.sources import links
from cartolex.staging import new_path

#: The driver's texts have no Italian headers; upper-case lines and list-like lines open sections there.
SYNTHETIC = HeaderProfile(named=(r"permission is|copyright|the\s",), numbered=(r"[A-ZÀ-Þ]{3,}[^a-z]*$", r"[A-Z][a-z]+\.$"))
#: References of the driver's texts.
SYNTHETIC_PATTERNS = {"legge": r"token = \W?([0-9a-f]{4})", "articolo": r"version (\d+)", "circolare": r"(\d{3})-(\d{4})"}

_STRIP = r"regexp_replace({0}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"
_TRIM = lambda c: _STRIP.format(c)
_SENTENCES = f"list_filter(list_transform(string_split(regexp_replace({{0}}, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda x: {_TRIM('x')}), lambda x: x <> '')"
_SENTS = _SENTENCES.replace("{0}", "text")
#: The chunker as a recursion over (document, sentence).
_CHUNKS = rf"""
WITH RECURSIVE s AS (SELECT doc_id, text, {_SENTS} AS l FROM documents),
b AS (SELECT doc_id, CASE WHEN len(l) = 0 THEN [text] ELSE l END AS l FROM s WHERE text IS NOT NULL AND length(text) >= 100),
r(doc_id, k, cur, emitted, idx) AS (
  SELECT doc_id, 0, '', CAST(NULL AS VARCHAR), 0 FROM b
  UNION ALL
  SELECT r.doc_id, r.k + 1,
    CASE WHEN r.k >= len(b.l) THEN '' WHEN length(r.cur) + length(b.l[r.k + 1]) > 2048 AND r.cur <> '' THEN
      CASE WHEN length(r.cur) <= 200 THEN r.cur
        WHEN regexp_matches(right(r.cur, 200), '[.!?]\s+') THEN regexp_replace(right(r.cur, 200), '(?s)^.*?[.!?]\s+', '')
        ELSE right(r.cur, 200) END || ' ' || b.l[r.k + 1]
      ELSE r.cur || ' ' || b.l[r.k + 1] END,
    CASE WHEN r.k >= len(b.l) THEN {_TRIM('r.cur')} WHEN length(r.cur) + length(b.l[r.k + 1]) > 2048 AND r.cur <> '' THEN {_TRIM('r.cur')} END,
    r.idx + CASE WHEN r.emitted IS NOT NULL THEN 1 ELSE 0 END
  FROM r JOIN b USING (doc_id) WHERE r.k <= len(b.l)),
c AS (SELECT doc_id, emitted AS content, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1 AS INTEGER) AS chunk_index FROM r WHERE emitted <> ''
  UNION ALL SELECT doc_id, text, 0 FROM documents WHERE text IS NULL OR length(text) < 100)
"""


def _chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", "lang", F.posexplode(chunks.chunk_texts(F.col("text"))).alias("chunk_index", "content"))


@query("sentence_split", rf"SELECT doc_id, CAST(len(l) AS INTEGER) AS n, md5(array_to_string(l, chr(1))) AS digest FROM (SELECT doc_id, CASE WHEN len({_SENTS}) = 0 THEN [text] ELSE {_SENTS} END AS l FROM documents)")
def sentence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-11: sentences of every document."""
    found = table(spark, sf_dir, "documents").select("doc_id", chunks.sentences(F.col("text")).alias("l"))
    return found.select("doc_id", F.size("l").alias("n"), F.md5(F.array_join("l", "\x01").cast("binary")).alias("digest"))


@query("chunk_documents", _CHUNKS + "SELECT doc_id, chunk_index, length(content) AS chars, md5(content) AS digest FROM c")
def chunk_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-12, S-13, S-14: overlapping chunks of every document."""
    return _chunked(spark, sf_dir).select("doc_id", "chunk_index", F.length("content").cast("long").alias("chars"), F.md5(F.col("content").cast("binary")).alias("digest"))


@query("chunk_stats_by_lang", _CHUNKS + "SELECT d.lang, count(*) AS n_chunks, count(DISTINCT c.doc_id) AS n_docs, round(count(*) / count(DISTINCT c.doc_id), 6) AS avg_chunks, max(length(content)) AS longest FROM c JOIN documents d USING (doc_id) GROUP BY 1")
def chunk_stats_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-5, A-6: yields by group."""
    return _chunked(spark, sf_dir).groupBy("lang").agg(F.count("*").alias("n_chunks"), F.count_distinct("doc_id").alias("n_docs"), F.round(F.count("*") / F.count_distinct("doc_id"), 6).alias("avg_chunks"), F.max(F.length("content")).cast("long").alias("longest"))


@query("next_chunk_edges", _CHUNKS + "SELECT src, dst, CAST(ord AS INTEGER) AS \"order\" FROM (SELECT doc_id || '_CHK_' || chunk_index AS src, lead(doc_id || '_CHK_' || chunk_index) OVER w AS dst, row_number() OVER w - 1 AS ord FROM c WINDOW w AS (PARTITION BY doc_id ORDER BY chunk_index)) WHERE dst IS NOT NULL")
def next_chunk_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W-2, M-4: edges between consecutive chunks."""
    k, none = F.col("doc_id").cast("string"), F.lit(None).cast("string")
    rows = table(spark, sf_dir, "documents").select(k.alias("documentId"), k.alias("sectionId"), F.col("text").alias("content"), F.lit(1).alias("pageNumber"), none.alias("sectionNumber"), none.alias("sectionType"))
    return graph.edges("NEXT_CHUNK", chunks.chunk_sections(rows), "chunkId", "nextChunkId", "chunkIndex", distinct=False).select("src", "dst", "order")


_LINES = rf"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents),
s AS (SELECT doc_id, n, {_TRIM('raw')} AS s, max(n) OVER (PARTITION BY doc_id) AS last_n FROM l),
k AS (SELECT *, CASE WHEN s = '' THEN NULL WHEN regexp_matches(s, '^(?i:permission is|copyright|the\s)') THEN 'named' WHEN regexp_matches(s, '^(?:[A-ZÀ-Þ]{{3,}}[^a-z]*$|[A-Z][a-z]+\.$)') THEN 'numbered' END AS kind FROM s WHERE s <> ''),
g AS (SELECT *, sum(CASE WHEN kind IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY n) AS sec FROM k),
h AS (SELECT doc_id, sec, min(n) AS hn, min_by(s, n) AS header, min_by(kind, n) AS kind, max(last_n) AS last_n, {_TRIM("string_agg(CASE WHEN kind IS NULL THEN s END, chr(10) ORDER BY n)")} AS content FROM g WHERE sec > 0 GROUP BY 1, 2),
f AS (SELECT *, coalesce(lead(hn) OVER (PARTITION BY doc_id ORDER BY sec), last_n) AS flush FROM h),
x AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY sec) - 1 AS ord FROM f WHERE content IS NOT NULL)
"""


def _sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("documentId"), F.col("text").alias("fullText"))
    return sections.sections(docs, profile=SYNTHETIC)


@query("doc_lines", rf"SELECT doc_id, count(*) AS n_lines, sum(CASE WHEN {_TRIM('s')} <> '' THEN 1 ELSE 0 END)::BIGINT AS n_filled, max(length({_TRIM('s')})) AS longest FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS s FROM documents) GROUP BY 1")
def doc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-3: lines and filled lines, inside the row."""
    lines = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.transform(F.split("text", "\n", -1), strip).alias("l"))
    return lines.select("doc_id", F.size("l").cast("long").alias("n_lines"), F.size(F.filter("l", lambda s: s != "")).cast("long").alias("n_filled"), F.array_max(F.transform("l", F.length)).cast("long").alias("longest"))


@query("section_detect", _LINES + "SELECT CAST(doc_id AS VARCHAR) AS \"documentId\", CAST(ord AS INTEGER) AS \"order\", kind AS \"sectionType\", md5(substr(header, 1, 200)) AS title_md5, md5(content) AS content_md5, CAST(flush // 50 + 1 AS INTEGER) AS \"pageNumber\" FROM x")
def section_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-4, S-6, W-3, W-4: sections of every document."""
    return _sections(spark, sf_dir).select("documentId", "order", "sectionType", F.md5(F.col("title").cast("binary")).alias("title_md5"), F.md5(F.col("content").cast("binary")).alias("content_md5"), "pageNumber")


@query("next_section_edges", _LINES + "SELECT src, dst, CAST(i AS INTEGER) AS \"order\" FROM (SELECT doc_id || '_SEC_' || ord AS src, lead(doc_id || '_SEC_' || ord) OVER (PARTITION BY doc_id ORDER BY ord) AS dst, ord AS i FROM x) WHERE dst IS NOT NULL")
def next_section_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W-1: edges between consecutive sections."""
    return graph.edges("NEXT_SECTION", _sections(spark, sf_dir), "sectionId", "nextSectionId", "order", distinct=False).select("src", "dst", "order")


_LEVELS = """
WITH p AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS i, 1 + o_orderkey % 3 AS level FROM orders),
a AS (SELECT p.o_custkey, p.i, p.level, max(q.i) AS j FROM p LEFT JOIN p q ON q.o_custkey = p.o_custkey AND q.i < p.i AND q.level < p.level GROUP BY ALL)
"""


@query("section_hierarchy", _LEVELS + "SELECT a.o_custkey, CAST(a.i AS INTEGER) AS position, CAST(a.level AS INTEGER) AS level, CAST(CASE WHEN q.level = a.level - 1 THEN q.i END AS INTEGER) AS parent FROM a LEFT JOIN p q ON q.o_custkey = a.o_custkey AND q.i = a.j")
def section_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-7, S-10, W-5: parents by level, over each customer's orders as a sequence of levels 1 to 3."""
    rows = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sort_array(F.collect_list("o_orderkey")).alias("keys"))
    found = rows.select("o_custkey", F.transform("keys", lambda k, i: F.struct(i.alias("position"), (1 + k % 3).cast("int").alias("level"))).alias("f"))
    out = found.select("o_custkey", F.explode(sections.hierarchy(F.col("f"))).alias("x"))
    return out.select("o_custkey", "x.s.position", "x.s.level", "x.parent")


@query("toc_filter", "SELECT l_orderkey, l_linenumber FROM lineitem l LEFT JOIN (SELECT o_orderkey, 1 + o_orderkey % 2 AS a, 2 + o_orderkey % 3 AS b FROM orders WHERE o_orderkey % 5 <> 0) o ON o.o_orderkey = l.l_orderkey WHERE NOT coalesce(l_linenumber BETWEEN a AND b AND l_quantity < 25, false)")
def toc_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-5, F-6, S-9: sections of a range of pages go if they are short; lines of orders stand for sections, four signs a piece."""
    ranges = table(spark, sf_dir, "orders").where("o_orderkey % 5 <> 0").select(F.col("o_orderkey").alias("l_orderkey"), (1 + F.col("o_orderkey") % 2).alias("a"), (2 + F.col("o_orderkey") % 3).alias("b"))
    section = F.struct(F.col("l_linenumber").alias("pageNumber"), F.repeat(F.lit("x"), (F.col("l_quantity") * 4).cast("int")).alias("content"))
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(section).alias("found")).join(ranges, "l_orderkey", "left")
    return rows.select("l_orderkey", F.explode(sections.without_toc(F.col("found"), F.col("a"), F.col("b"))).alias("s")).select("l_orderkey", F.col("s.pageNumber").alias("l_linenumber"))


_COLLAPSE = r"regexp_replace({0}, '[\s\p{{Z}}]+', ' ', 'g')"


@query("doc_title", rf"""
WITH l AS (SELECT doc_id, source, list_filter(list_transform(string_split(text, chr(10))[1:20], lambda s: {_TRIM('s')}), lambda s: length(s) > 10 AND NOT regexp_matches(s, '^\d+$')) AS l FROM documents)
SELECT doc_id, coalesce(substr({_COLLAPSE.format('l[1]')}, 1, 200), source) AS title FROM l""")
def doc_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-3: titles, with the source for a file name."""
    return table(spark, sf_dir, "documents").select("doc_id", metadata.title(F.col("text"), F.col("source")).alias("title"))


@query("subject_extract", rf"""
SELECT doc_id, CASE WHEN regexp_matches(t, '(?is)OGGETTO\s*:?\s*.+?(?:\n\n|QUESITO|PREMESSA|\z)') THEN substr({_COLLAPSE.format(_TRIM(r"regexp_extract(t, '(?is)OGGETTO\s*:?\s*(.+?)(?:\n\n|QUESITO|PREMESSA|\z)', 1)"))}, 1, 500) ELSE 'No OGGETTO found' END AS oggetto
FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text ELSE 'Oggetto: ' || text || CASE WHEN doc_id % 3 = 1 THEN ' PREMESSA x' ELSE '' END END AS t FROM documents)""")
def subject_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-2: subjects; the marks are put into two thirds of the texts, which have none of their own."""
    marked = F.concat(F.lit("Oggetto: "), F.col("text"), F.when(F.col("doc_id") % 3 == 1, " PREMESSA x").otherwise(""))
    rows = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.col("text")).otherwise(marked).alias("t"))
    return rows.select("doc_id", metadata.subject(F.col("t")).alias("oggetto"))


@query("doc_metadata", r"""
WITH t AS (SELECT doc_id, CASE WHEN doc_id % 4 = 3 THEN source || CASE doc_id % 3 WHEN 0 THEN '_circolare_' WHEN 1 THEN '_Risposta_' ELSE '_x_' END || (1990 + doc_id % 40) || '.pdf' ELSE 'f.pdf' END AS f,
  CASE doc_id % 4 WHEN 0 THEN 'Circolare n. ' || doc_id || '/E del 1 giugno ' || (2000 + doc_id % 25) WHEN 1 THEN 'RISOLUZIONE n ' || doc_id || ' anno ' || (2000 + doc_id % 25) WHEN 2 THEN 'risposta n.' || doc_id || ', ' || (2000 + doc_id % 25) ELSE '' END AS c FROM documents),
k AS (SELECT doc_id, f, c, CASE WHEN c LIKE 'Circolare%' THEN 'Circolare' WHEN c LIKE 'RIS%' THEN 'Risoluzione' WHEN c LIKE 'risp%' THEN 'Risposta' WHEN lower(f) LIKE '%circolare%' THEN 'Circolare' WHEN lower(f) LIKE '%risposta%' THEN 'Risposta' ELSE 'Unknown' END AS type FROM t),
n AS (SELECT doc_id, type, CASE WHEN c <> '' THEN doc_id || CASE WHEN type = 'Circolare' THEN '/E' ELSE '' END WHEN type = 'Unknown' THEN 'unknown' ELSE regexp_extract(f, '(\d+)', 1) END AS number,
  CASE WHEN c <> '' THEN 2000 + doc_id % 25 WHEN type = 'Unknown' THEN 2024 ELSE CAST(coalesce(nullif(regexp_extract(f, '((?:19|20)\d{2})', 1), ''), '2024') AS BIGINT) END AS year FROM k)
SELECT doc_id, type, number, CAST(year AS INTEGER) AS year, CASE type WHEN 'Circolare' THEN 'CIR' WHEN 'Risoluzione' THEN 'RIS' WHEN 'Risposta' THEN 'RIP' ELSE 'UNK' END || '_' || replace(number, '/', '_') || '_' || year AS "documentId" FROM n""")
def doc_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-1, S-4: type, number, year and key, from statements and file names made from ids and sources, before the whole texts."""
    i = F.col("doc_id")
    year = (2000 + i % 25).cast("string")
    text = F.when(i % 4 == 0, F.concat(F.lit("Circolare n. "), i, F.lit("/E del 1 giugno "), year)).when(i % 4 == 1, F.concat(F.lit("RISOLUZIONE n "), i, F.lit(" anno "), year)).when(i % 4 == 2, F.concat(F.lit("risposta n."), i, F.lit(", "), year)).otherwise("")
    text = F.concat(text, F.lit("\n"), F.coalesce("text", F.lit("")))
    file = F.when(i % 4 == 3, F.concat("source", F.when(i % 3 == 0, "_circolare_").when(i % 3 == 1, "_Risposta_").otherwise("_x_"), (1990 + i % 40).cast("string"), F.lit(".pdf"))).otherwise("f.pdf")
    rows = table(spark, sf_dir, "documents").select("doc_id", metadata.kind(file, text, F.lit(2024)).alias("k"))
    return rows.select("doc_id", "k.*", metadata.document_id(F.col("k.type"), F.col("k.number"), F.col("k.year")).alias("documentId"))


@query("url_explode", r"SELECT page_id, url AS link, unnest(list_filter(string_split_regex(trim(url || ' ' || 'ftp://x ' || url), '\s+'), lambda x: starts_with(x, 'http'))) AS url FROM pages")
def url_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-2: urls of cells that hold several links."""
    cells = table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("link"), F.concat_ws(" ", "url", F.lit("ftp://x"), "url").alias("cell"))
    return links.urls(cells, "cell").drop("cell")


@query("url_filename", r"""
WITH p AS (SELECT page_id, string_split(regexp_extract(replace(url, '.html', '.pdf'), '^[^:/?#]+://[^/?#]*([^?#]*)', 1), '/') AS parts FROM pages)
SELECT page_id, regexp_replace(CASE WHEN ends_with(parts[-1], '.pdf') THEN parts[-1] ELSE 'none' END, '[^\p{L}\p{N}_\s\-.]', '_', 'g') AS name FROM p""")
def url_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-4: file names of urls; names from hashes are shown as ``none``."""
    name = links.file_name(F.regexp_replace("url", r"\.html", ".pdf"))
    return table(spark, sf_dir, "pages").select("page_id", F.when(name.startswith("document_"), "none").otherwise(name).alias("name"))


@query("filename_dedup", r"""
WITH n AS (SELECT page_id, regexp_extract(url, '([a-z]+)[^a-z]*$', 1) || '.pdf' AS name FROM pages),
k AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY page_id) - 1 AS k FROM n)
SELECT page_id, CASE WHEN k = 0 THEN name ELSE replace(name, '.pdf', '') || '_' || k || '.pdf' END AS name FROM k""")
def filename_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-5: suffixes for repeated names."""
    named = table(spark, sf_dir, "pages").select("page_id", F.concat(F.regexp_extract("url", r"([a-z]+)[^a-z]*$", 1), F.lit(".pdf")).alias("name"))
    return links.distinct_names(named, "name", "page_id")


@query("page_sections", r"SELECT page_id, regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1) AS title, CAST(len(regexp_extract_all(html, '<p>')) AS INTEGER) AS n_paragraphs, length(html) AS chars FROM pages")
def page_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-6 for pages: headings and paragraphs."""
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("html", r"(?s)<h1>(.*?)</h1>", 1).alias("title"), F.regexp_count("html", F.lit("<p>")).alias("n_paragraphs"), F.length("html").cast("long").alias("chars"))


_GATE = r"(?i)(?:token = \W?([0-9a-f]{4}))|(?:version (\d+))|(?:(\d{3})-(\d{4}))"


@query("regex_gate", f"SELECT doc_id, coalesce(regexp_matches(text, '{_GATE}'), false) AS passes FROM documents")
def regex_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-7: the gate before reference extraction."""
    return table(spark, sf_dir, "documents").select("doc_id", references.gate(F.col("text"), SYNTHETIC_PATTERNS).alias("passes"))


@query("reference_extract", r"""
WITH r AS (SELECT doc_id, 'legge' AS type, unnest(regexp_extract_all(text, '(?i)token = \W?([0-9a-f]{4})', 1)) AS number, unnest(regexp_extract_all(text, '(?i)token = \W?([0-9a-f]{4})', 0)) AS citation, CAST(NULL AS VARCHAR) AS year FROM documents
UNION ALL SELECT doc_id, 'altro', unnest(regexp_extract_all(text, '(?i)version (\d+)', 1)), unnest(regexp_extract_all(text, '(?i)version (\d+)', 0)), NULL FROM documents
UNION ALL SELECT doc_id, 'circolare', unnest(regexp_extract_all(text, '(\d{3})-(\d{4})', 1)), unnest(regexp_extract_all(text, '(\d{3})-(\d{4})', 0)), unnest(regexp_extract_all(text, '(\d{3})-(\d{4})', 2)) FROM documents)
SELECT CAST(doc_id AS VARCHAR) AS "sourceChunkId", type, number, citation, year,
  CASE WHEN year IS NOT NULL THEN 'CIR_' || number || '_' || year ELSE 'REF_' || substr(md5(type || '_' || citation), 1, 8) END AS "referenceId" FROM r""")
def reference_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X-1, X-2, C-1, C-2, F-10, F-11: references by rules, validated, with canonical keys."""
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("chunkId"), F.col("text").alias("content"))
    found = references.references(rows, lambda c: references.rule_extractor(c, SYNTHETIC_PATTERNS), SYNTHETIC_PATTERNS)
    return found.select("sourceChunkId", "type", "number", "citation", "year", "referenceId")


_RAW = """
SELECT p_partkey, CASE p_partkey % 9 WHEN 0 THEN 'Circolare' WHEN 1 THEN 'risoluzione' WHEN 2 THEN 'risposta' WHEN 3 THEN 'decreto_legislativo' WHEN 4 THEN 'decreto_legge' WHEN 5 THEN 'legge' WHEN 6 THEN 'altro' WHEN 7 THEN 'x' ELSE '' END AS type,
  CASE p_partkey % 5 WHEN 0 THEN p_size || '/E' WHEN 1 THEN p_size || '-bis' WHEN 2 THEN 'E' WHEN 3 THEN p_size || '/' || (p_size + 1) END AS number,
  CASE p_partkey % 7 WHEN 0 THEN '2019' WHEN 1 THEN ' 2020' WHEN 2 THEN 'anno 1998, poi' WHEN 3 THEN 'null' WHEN 4 THEN '99' WHEN 5 THEN NULL ELSE '2021' END AS year, p_name AS citation FROM part"""


@query("canonical_id", rf"""
WITH r AS ({_RAW}),
v AS (SELECT *, CASE WHEN year IS NULL OR lower(trim(year)) IN ('null', 'none', '') THEN NULL WHEN regexp_matches(trim(year), '^\d{{4}}$') THEN year ELSE nullif(regexp_extract(trim(year), '\b((?:19|20)\d{{2}})\b', 1), '') END AS y FROM r WHERE type <> '' AND citation <> ''),
c AS (SELECT *, trim(coalesce(number, '')) AS n, CASE lower(type) WHEN 'circolare' THEN 'CIR' WHEN 'risoluzione' THEN 'RIS' WHEN 'risposta' THEN 'RIP' WHEN 'decreto_legislativo' THEN 'EXT_DL' WHEN 'decreto_legge' THEN 'EXT_DEC' WHEN 'legge' THEN 'EXT_LEG' WHEN 'altro' THEN 'EXT_OTH' ELSE 'REF' END AS code FROM v),
b AS (SELECT *, CASE WHEN regexp_replace(n, '[/\-\s]*[A-Za-z]+$', '') = '' THEN n ELSE regexp_replace(n, '[/\-\s]*[A-Za-z]+$', '') END AS bare FROM c)
SELECT p_partkey, y AS year, CASE WHEN n <> '' AND length(trim(coalesce(y, ''))) = 4 THEN code || '_' || trim(regexp_replace(bare, '[^\p{{L}}\p{{N}}_]', '_', 'g'), '_') || '_' || trim(y) ELSE 'REF_' || substr(md5(lower(type) || '_' || citation), 1, 8) END AS "referenceId" FROM b""")
def canonical_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C-1, C-2: canonical keys of references made from parts."""
    rows = _raw_references(spark, sf_dir)
    return references.validate(rows).select(F.col("sourceChunkId").cast("long").alias("p_partkey"), "year", "referenceId")


def _raw_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size").cast("string")
    names = ["Circolare", "risoluzione", "risposta", "decreto_legislativo", "decreto_legge", "legge", "altro", "x", ""]
    kind = F.element_at(F.array(*[F.lit(n) for n in names]), (k % 9 + 1).cast("int"))
    number = F.when(k % 5 == 0, F.concat(size, F.lit("/E"))).when(k % 5 == 1, F.concat(size, F.lit("-bis"))).when(k % 5 == 2, "E").when(k % 5 == 3, F.concat(size, F.lit("/"), (F.col("p_size") + 1).cast("string")))
    year = F.when(k % 7 == 0, "2019").when(k % 7 == 1, " 2020").when(k % 7 == 2, "anno 1998, poi").when(k % 7 == 3, "null").when(k % 7 == 4, "99").when(k % 7 == 6, "2021")
    none = F.lit(None).cast("string")
    made = F.array(F.struct(kind.alias("type"), number.alias("number"), year.alias("year"), none.alias("article"), F.col("p_name").alias("citation"), none.alias("description")))
    return table(spark, sf_dir, "part").select(k.cast("string").alias("chunkId"), made.alias("references"))


@query("normalize_id", rf"""SELECT doc_id, 'T_' || regexp_replace(regexp_replace(lower(text), '[^\p{{L}}\p{{M}}\p{{N}}_\s\-]', '', 'g'), '[\s\-]+', '_', 'g') AS "topicId", lower({_TRIM('text')}) AS "normalizedName" FROM documents
WHERE regexp_replace(lower(text), '[^\p{{L}}\p{{M}}\p{{N}}_\s\-]', '', 'g') <> ''""")
def normalize_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C-3, C-4: keys and normal forms of names; whole texts stand for names."""
    name = F.col("text")
    rows = table(spark, sf_dir, "documents").where(F.regexp_replace(F.lower(name), r"(?U)[^\w\s-]", "") != "")
    return rows.select("doc_id", normalized_id(name).alias("topicId"), normalized_name(name).alias("normalizedName"))


@query("merge_last", "SELECT user_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events GROUP BY 1")
def merge_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-1: last write wins."""
    return graph.merge_last(table(spark, sf_dir, "events"), ["user_id"], ["event_id"], ["event_type", "value"])


@query("merge_first", "SELECT user_id, arg_min(event_type, event_id) AS event_type, arg_min(value, event_id) AS value FROM events GROUP BY 1")
def merge_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-2: first write wins."""
    return graph.merge_first(table(spark, sf_dir, "events"), ["user_id"], ["event_id"], ["event_type", "value"])


@query("merge_created_flag", "SELECT user_id, event_type, count(*) = 1 AND bool_and(user_id % 7 <> 0) AS created FROM events GROUP BY 1, 2")
def merge_created_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-3: keys written just once and not there before."""
    rows = table(spark, sf_dir, "events").select("user_id", "event_type")
    return graph.created_flags(rows, ["user_id", "event_type"], rows.where("user_id % 7 = 0"))


@query("merge_scored_edges", "SELECT CAST(user_id AS VARCHAR) AS src, event_type AS dst, arg_max(value, event_id) AS score FROM events GROUP BY 1, 2")
def merge_scored_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-5: edges whose last score wins."""
    rows = table(spark, sf_dir, "events").withColumn("u", F.col("user_id").cast("string"))
    return graph.scored_edges("DISCUSSES_TOPIC", rows, "u", "event_type", "value", ["event_id"]).select("src", "dst", F.col("relevanceScore").alias("score"))


@query("merge_ordered_edges", "SELECT DISTINCT l_partkey AS src, l_suppkey AS dst, l_linenumber AS \"order\" FROM lineitem")
def merge_ordered_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-4, M-6: an edge with another order is another edge."""
    return graph.edges("HAS_PART", table(spark, sf_dir, "lineitem"), "l_partkey", "l_suppkey", "l_linenumber").select("src", "dst", "order")


@query("unique_violations", "SELECT user_id, count(*) AS count FROM events GROUP BY 1 HAVING count(*) > 1")
def unique_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-8: keys that a uniqueness constraint would reject."""
    return graph.unique_violations(table(spark, sf_dir, "events"), "user_id")


_LABELS = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


@query("node_label_counts", " UNION ALL ".join(f"SELECT '{t}' AS label, count(*) AS count FROM {t}" for t in _LABELS))
def node_label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-15, U-2, Q-1: nodes by label."""
    return graph.label_counts({t: table(spark, sf_dir, t) for t in _LABELS})


@query("edge_semijoin", "SELECT o_custkey AS src, o_orderkey AS dst FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)")
def edge_semijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-8: edges whose two ends exist."""
    edges = graph.edges("PLACED", table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey")
    return graph.with_both_ends(edges, table(spark, sf_dir, "customer").where("c_acctbal > 0"), "c_custkey", table(spark, sf_dir, "lineitem").where("l_quantity > 45"), "l_orderkey").select("src", "dst")


@query("anti_root", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def anti_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-12: nodes that no edge leads to."""
    edges = graph.edges("PLACED_BY", table(spark, sf_dir, "orders"), "o_orderkey", "o_custkey")
    return graph.roots(table(spark, sf_dir, "customer"), "c_custkey", edges).select("c_custkey")


def _context(spark: SparkSession, sf_dir: str, scope: str) -> DataFrame:
    s = F.col("o_orderkey").cast("string")
    chunk = table(spark, sf_dir, "lineitem").select(F.concat_ws("_", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("chunkId"), F.col("l_orderkey").cast("string").alias("sectionId"), F.col("l_returnflag").alias("content"), F.col("l_linenumber").alias("chunkIndex"), F.col("l_orderkey").alias("k"))
    order = table(spark, sf_dir, "orders")
    chunk = chunk.join(order.select(F.col("o_orderkey").alias("k"), F.col("o_custkey").cast("string").alias("documentId")), "k").drop("k")
    section = order.select(s.alias("sectionId"), F.col("o_orderstatus").alias("sectionNumber"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).otherwise("").alias("title"), (F.col("o_orderkey") % 5).alias("order"))
    docs = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("documentId"), F.col("c_mktsegment").alias("type"), F.col("c_custkey").cast("string").alias("number"), F.col("c_nationkey").alias("year"))
    child = graph.edges("HAS_SUBSECTION", order.where("o_orderkey % 3 = 0"), F.lit("p"), s)
    return embed.chunk_context(chunk, section, docs, child, scope)


_CONTEXT = "SELECT l_orderkey || '_' || l_linenumber AS \"chunkId\", o_orderstatus AS section_number, c_mktsegment AS doc_type, c_nationkey AS doc_year FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey"


@query("chunk_context_all", _CONTEXT)
def chunk_context_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-1: chunks with their section and document; lines, orders and customers stand for them."""
    return _context(spark, sf_dir, "all").select("chunkId", "section_number", "doc_type", "doc_year")


@query("chunk_context_root", _CONTEXT + " WHERE o_orderkey % 3 <> 0")
def chunk_context_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-1 with F-12: only chunks of sections without a parent."""
    return _context(spark, sf_dir, "root").select("chunkId", "section_number", "doc_type", "doc_year")


@query("enrich_text", "SELECT l_orderkey || '_' || l_linenumber AS \"chunkId\", 'Documento: ' || c_mktsegment || ' ' || c_custkey || '/' || c_nationkey || chr(10) || 'Sezione: ' || o_orderstatus || CASE WHEN o_orderkey % 2 = 0 THEN ' - ' || o_orderpriority ELSE '' END || chr(10) || chr(10) || l_returnflag AS enriched FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey")
def enrich_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-15: the texts that are embedded."""
    return _context(spark, sf_dir, "all").select("chunkId", embed.enriched_text().alias("enriched"))


@query("ancestor_closure", """
WITH RECURSIVE n AS (SELECT 'N' || n_nationkey AS k, 'R' || n_regionkey AS p FROM nation UNION ALL SELECT 'R' || r_regionkey, 'W' FROM region UNION ALL SELECT 'W', NULL UNION ALL SELECT 'S' || s_suppkey, 'N' || s_nationkey FROM supplier),
a(node, ancestor, steps) AS (SELECT k, k, 0 FROM n UNION ALL SELECT a.node, n.p, a.steps + 1 FROM a JOIN n ON n.k = a.ancestor WHERE n.p IS NOT NULL)
SELECT * FROM a""")
def ancestor_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-2: all ancestors in a tree of suppliers, nations, regions and the world."""
    s = lambda prefix, c: F.concat(F.lit(prefix), F.col(c).cast("string"))
    nodes = table(spark, sf_dir, "nation").select(s("N", "n_nationkey").alias("k"), s("R", "n_regionkey").alias("p"))
    nodes = nodes.union(table(spark, sf_dir, "region").select(s("R", "r_regionkey"), F.lit("W")))
    nodes = nodes.union(spark.range(1).select(F.lit("W"), F.lit(None).cast("string"))).union(table(spark, sf_dir, "supplier").select(s("S", "s_suppkey"), s("N", "s_nationkey")))
    return graph.ancestors(nodes, "k", "p")


@query("ancestor_chains", """
WITH RECURSIVE n AS (SELECT doc_id AS k, CASE WHEN doc_id % 41 > 0 THEN doc_id - 1 WHEN doc_id % 2 = 0 THEN doc_id + 40 END AS p FROM documents),
a(node, ancestor, path) AS (SELECT k, k, [k] FROM n UNION ALL SELECT a.node, n.p, list_append(a.path, n.p) FROM a JOIN n ON n.k = a.ancestor WHERE n.p IS NOT NULL AND NOT list_contains(a.path, n.p))
SELECT node, ancestor, CAST(len(path) - 1 AS INTEGER) AS steps FROM a""")
def ancestor_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-2: all ancestors along chains of 41 documents, of which every other one is closed to a cycle."""
    i = F.col("doc_id")
    parent = F.when(i % 41 > 0, i - 1).when(i % 2 == 0, i + 40)
    return graph.ancestors(table(spark, sf_dir, "documents").select(i.alias("k"), parent.alias("p")), "k", "p")


_LINK = """SELECT d.doc_id, d.source, CASE WHEN doc_id % 10 = 0 THEN 'external' WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'matched' ELSE 'unmatched' END AS status FROM documents d"""


def _categorised(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("doc_id").cast("string")
    refs = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 10 == 0, F.concat(F.lit("EXT_"), key)).otherwise(key).alias("referenceId"), F.col("source").alias("type"))
    return link.categorise(refs, table(spark, sf_dir, "labels").select(key.alias("documentId")))


@query("link_categorise", f"SELECT doc_id, status FROM ({_LINK})")
def link_categorise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-3: references as matched, unmatched or external; labelled documents stand for known ones."""
    return _categorised(spark, sf_dir).select("doc_id", "status")


@query("link_report", f"SELECT status, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS percent FROM ({_LINK}) GROUP BY 1")
def link_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-9: counts and percentages."""
    return link.status_report(_categorised(spark, sf_dir)).withColumn("percent", F.round("percent", 6))


@query("link_pivot", f"SELECT source AS type, count(*) FILTER (status = 'matched') AS matched, count(*) FILTER (status = 'unmatched') AS unmatched, count(*) FILTER (status = 'external') AS external FROM ({_LINK}) GROUP BY 1")
def link_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-10: counts by type and status."""
    return link.status_pivot(_categorised(spark, sf_dir))


@query("refers_to_edges", f"SELECT CAST(doc_id AS VARCHAR) AS src, CAST(doc_id AS VARCHAR) AS dst FROM ({_LINK}) WHERE status = 'matched'")
def refers_to_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-3, M-6, Q-9: edges from references to documents."""
    return link.refers_to(_categorised(spark, sf_dir)).select("src", "dst")


@query("set_compare", "SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NOT NULL AND b.k IS NOT NULL THEN 'both' WHEN a.k IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS status FROM (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_totalprice > 200000) a FULL JOIN (SELECT DISTINCT c_custkey AS k FROM customer WHERE c_acctbal > 3000) b ON a.k = b.k")
def set_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-4, U-1: keys of two sides."""
    a = table(spark, sf_dir, "orders").where("o_totalprice > 200000").select(F.col("o_custkey").alias("k"))
    return validate.set_compare(a, table(spark, sf_dir, "customer").where("c_acctbal > 3000").select(F.col("c_custkey").alias("k")), ["k"])


#: A place in an order that tells repeated line numbers apart.
_SEQ_SQL = "l_linenumber * 1000000000000 + l_partkey * 100000L + l_suppkey"


def _entries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("d"), "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    entries = rows.where("l_partkey % 4 <> 0").select(F.col("d").alias("documentId"), F.expr(_SEQ_SQL).alias("position"), (F.col("l_partkey") % 5).cast("string").alias("section_number"), F.concat_ws(" ", "l_returnflag", "l_linestatus", F.lit("ALPHA")).alias("title"), (F.col("l_suppkey") % 7).cast("int").alias("page_number"))
    own = rows.where("l_partkey % 3 <> 0").select(F.col("d").alias("documentId"), F.expr(_SEQ_SQL).alias("order"), (F.col("l_partkey") % 5).cast("string").alias("sectionNumber"), F.concat_ws(" ", F.lit("1.1"), "l_linestatus", F.lit("beta")).alias("title"), (F.col("l_suppkey") % 5).cast("int").alias("pageNumber"))
    return entries, own


_COMPARE = """
WITH e AS (SELECT CAST(l_orderkey AS VARCHAR) AS d, l_linenumber * 1000000000000 + l_partkey * 100000 + l_suppkey AS p, CAST(l_partkey % 5 AS VARCHAR) AS n, l_returnflag || ' ' || l_linestatus || ' ALPHA' AS t, CAST(l_suppkey % 7 AS INTEGER) AS pg FROM lineitem WHERE l_partkey % 4 <> 0),
s AS (SELECT CAST(l_orderkey AS VARCHAR) AS d, l_linenumber * 1000000000000 + l_partkey * 100000 + l_suppkey AS p, CAST(l_partkey % 5 AS VARCHAR) AS n, l_linestatus || ' BETA' AS t, CAST(l_suppkey % 5 AS INTEGER) AS pg FROM lineitem WHERE l_partkey % 3 <> 0),
a AS (SELECT d, n, arg_max(t, p) AS t, arg_max(pg, p) AS pg FROM e GROUP BY 1, 2), b AS (SELECT d, n, arg_max(t, p) AS t, arg_max(pg, p) AS pg FROM s GROUP BY 1, 2),
c AS (SELECT coalesce(a.d, b.d) AS d, coalesce(a.n, b.n) AS n, CASE WHEN a.d IS NULL THEN 'only_in_sections' WHEN b.d IS NULL THEN 'only_in_toc' ELSE 'matched' END AS status,
  a.d IS NOT NULL AND b.d IS NOT NULL AND NOT contains(b.t, a.t) AND NOT contains(a.t, b.t) AND len(list_intersect(string_split(a.t, ' '), string_split(b.t, ' '))) / greatest(len(list_distinct(string_split(a.t, ' '))), 1) < 0.5 AS tm,
  coalesce(abs(a.pg - b.pg) > 1, false) AS pm FROM a FULL JOIN b ON a.d = b.d AND a.n = b.n),
r AS (SELECT d, count(*) FILTER (status = 'matched') AS matched, count(*) FILTER (status = 'only_in_toc') AS toc_only, count(*) FILTER (status = 'only_in_sections') AS own_only, count(*) FILTER (tm) AS tm, count(*) FILTER (pm) AS pm,
  (SELECT count(*) FROM e WHERE e.d = c.d) AS n_toc, (SELECT count(*) FROM s WHERE s.d = c.d) AS n_own FROM c GROUP BY 1)
"""


@query("toc_compare", _COMPARE + "SELECT d AS \"documentId\", n AS number, status, tm AS title_mismatch, pm AS page_mismatch FROM c")
def toc_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-4, J-9, J-10: tables of contents against sections; lines of orders stand for both."""
    found = validate.compare_tocs(*_entries(spark, sf_dir))
    return found.select("documentId", "number", "status", "title_mismatch", F.coalesce("page_mismatch", F.lit(False)).alias("page_mismatch"))


def _reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries, own = _entries(spark, sf_dir)
    return validate.document_report(validate.compare_tocs(entries, own), entries, own)


@query("toc_report", _COMPARE + "SELECT d AS \"documentId\", n_toc AS toc_entries_count, n_own AS actual_sections_count, matched AS matched_count, round(CASE WHEN n_toc > 0 THEN matched / n_toc ELSE 0 END, 6) AS match_rate, round(CASE WHEN n_own > 0 THEN matched / n_own ELSE 0 END, 6) AS coverage_rate FROM r")
def toc_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-11: counts and rates of each document."""
    return _reports(spark, sf_dir).select("documentId", "toc_entries_count", "actual_sections_count", "matched_count", F.round("match_rate", 6).alias("match_rate"), F.round("coverage_rate", 6).alias("coverage_rate"))


@query("toc_corpus_report", _COMPARE + "SELECT count(*) AS documents, sum(n_toc)::BIGINT AS toc_entries, sum(n_own)::BIGINT AS sections, sum(matched)::BIGINT AS matched, round(avg(CASE WHEN n_toc > 0 THEN matched / n_toc ELSE 0 END), 6) AS avg_match_rate, round(avg(CASE WHEN n_own > 0 THEN matched / n_own ELSE 0 END), 6) AS avg_coverage_rate, count(*) FILTER (toc_only > 0) AS docs_missing_sections, count(*) FILTER (tm > 0) AS docs_with_title_issues, count(*) FILTER (pm > 0) AS docs_with_page_issues FROM r")
def toc_corpus_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-12: the corpus's summary."""
    return validate.corpus_report(_reports(spark, sf_dir)).withColumn("avg_match_rate", F.round("avg_match_rate", 6)).withColumn("avg_coverage_rate", F.round("avg_coverage_rate", 6))


@query("best_worst_match", _COMPARE + """, q AS (SELECT d AS "documentId", CASE WHEN n_toc > 0 THEN matched / n_toc ELSE 0 END AS match_rate FROM r)
(SELECT 'best' AS which, * FROM q ORDER BY match_rate DESC, "documentId" LIMIT 1) UNION ALL (SELECT 'worst', * FROM q ORDER BY match_rate, "documentId" LIMIT 1)""")
def best_worst_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-13: the best and the worst document."""
    return validate.best_and_worst(_reports(spark, sf_dir))


@query("toc_entries_plain", r"""
WITH l AS (SELECT conv_id, turn, '1.' || turn || ' ' || regexp_replace(text, '[\r\n]', ' ', 'g') || ' ...... ' || (turn + 3) AS s FROM conversations)
SELECT conv_id, turn, '1.' || turn AS section_number, regexp_replace(regexp_extract(s, '^(\d+(?:\.\d+)*)\s+(.+?)\s+(\d+)$', 2), '[. ]+$', '') AS title, CAST(turn + 3 AS INTEGER) AS page_number FROM l WHERE regexp_matches(s, '^(\d+(?:\.\d+)*)\s+(.+?)\s+(\d+)$')""")
def toc_entries_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-16: entries of lines with number, title and page, made from turns."""
    line = F.concat(F.lit("1."), F.col("turn"), F.lit(" "), F.regexp_replace("text", r"[\r\n]", " "), F.lit(" ...... "), F.col("turn") + 3)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.explode(toc.plain_entries(line)).alias("e")).select("conv_id", "turn", "e.*")


@query("toc_entries_dotted", rf"""
WITH t AS (SELECT conv_id, turn, {_TRIM("'Voce ' || regexp_replace(text, '[.\r\n]', ' ', 'g')")} AS title FROM conversations)
SELECT conv_id, '1.' || turn AS section_number, title, CAST(turn + 3 AS INTEGER) AS page_number FROM t
UNION ALL SELECT DISTINCT conv_id, 'PREMESSA', 'PREMESSA', 12 FROM t UNION ALL SELECT DISTINCT conv_id, 'PARTE II', 'PARTE II', NULL FROM t""")
def toc_entries_dotted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-17: entries with dotted leaders, one a turn of each conversation, with the turns' whole texts as titles; a page number may be beyond 32 bits."""
    line = F.concat(F.lit("  1."), F.col("turn"), F.lit(". Voce "), F.regexp_replace("text", r"[.\r\n]", " "), F.lit(" ....."), F.col("turn") + 3, F.lit("\n"))
    lines = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", line.alias("s")))), lambda x: x["s"]), "").alias("s"))
    raw = F.concat("s", F.lit("PREMESSA ........12\nPARTE II ... 99999999999\n3.2 Spese.....8\n"))
    return lines.select("conv_id", F.explode(toc.dotted_entries(raw)).alias("e")).select("conv_id", "e.*")


@query("toc_entry_count", r"SELECT doc_id, CAST(len(regexp_extract_all(regexp_replace(text, '\. ', chr(10) || '1.', 'g'), '(?m)^\s*\d+\.')) AS INTEGER) AS n FROM documents")
def toc_entry_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-20: numbered lines; every sentence is made one."""
    return table(spark, sf_dir, "documents").select("doc_id", toc.entry_count(F.regexp_replace("text", r"\. ", "\n1.")).alias("n"))


@query("title_word_overlap", """
WITH p AS (SELECT p_partkey, upper(p_name) AS a, upper(p_type) AS b FROM part)
SELECT p_partkey, NOT contains(b, a) AND NOT contains(a, b) AND len(list_intersect(list_distinct(string_split(a, ' ')), list_distinct(string_split(b, ' ')))) / greatest(len(list_distinct(string_split(a, ' '))), 1) < 0.5 AS differ FROM p""")
def title_word_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-9: whether two titles differ; names and types of parts stand for them."""
    return table(spark, sf_dir, "part").select("p_partkey", validate.titles_differ(F.col("p_name"), F.col("p_type")).alias("differ"))


@query("page_tolerance_join", "SELECT l_orderkey, l_linenumber FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE abs(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) - 30) > 1")
def page_tolerance_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-10: an equi-join with a tolerance; days stand for pages."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    joined = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate").join(o, "l_orderkey")
    return joined.where(validate.pages_differ(F.datediff("l_shipdate", "o_orderdate"), F.lit(30))).select("l_orderkey", "l_linenumber")


@query("systematic_sample", "SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (ORDER BY source, doc_id) - 1 AS k FROM documents) WHERE k % 7 = 0")
def systematic_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-16: every seventh document in order."""
    return search.systematic_sample(table(spark, sf_dir, "documents").select("doc_id", "source"), ["source", "doc_id"], 7)


@query("ordered_limit", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 20")
def ordered_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-1 to O-5: the first rows in order."""
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber").limit(20)


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").withColumn("u", F.col("user_id").cast("string"))
    return graph.scored_edges("DISCUSSES_TOPIC", rows, "u", "event_type", "value", ["event_id"])


@query("topk_topic_sections", "SELECT src, score FROM (SELECT CAST(user_id AS VARCHAR) AS src, event_type, arg_max(value, event_id) AS score FROM events GROUP BY 1, 2) WHERE event_type = (SELECT min(event_type) FROM events) ORDER BY score DESC, src LIMIT 10")
def topk_topic_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-6, Q-13: the sources most relevant to one node."""
    first = table(spark, sf_dir, "events").agg(F.min("event_type")).first()[0]  # one name
    return graph_queries.sections_by_topic(Graph({}, _scored(spark, sf_dir)), first).withColumnRenamed("relevanceScore", "score")


@query("most_discussed_topics", "SELECT event_type AS dst, count(DISTINCT user_id) AS n FROM events GROUP BY 1 ORDER BY n DESC, dst LIMIT 20")
def most_discussed_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-18, Q-14: nodes with most edges."""
    kinds = table(spark, sf_dir, "events").select(F.col("event_type").alias("topicId"), F.col("event_type").alias("name")).distinct()
    return graph_queries.most_discussed_topics(Graph({"Topic": kinds}, _scored(spark, sf_dir)), 20).select("dst", "n")


@query("vector_topk", "SELECT e.vec_id, round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])), 6) AS score FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 0) q ORDER BY list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])) DESC, e.vec_id LIMIT 5")
def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-7, Q-16: the five rows nearest one vector."""
    e = table(spark, sf_dir, "embeddings")
    return search.vector_top_k_of(e, "vec_id", "embedding", e.where("vec_id = 0").select("embedding"), 5).withColumn("score", F.round("score", 6))


@query("vector_search_index", "SELECT e.vec_id, round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])), 6) AS score FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 0) q ORDER BY list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])) DESC, e.vec_id LIMIT 5")
def vector_search_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-7, Q-16: the same from a stored index, by the codes of all lists."""
    e, path = table(spark, sf_dir, "embeddings"), new_path(spark, "vectors")
    vector_index.write_index(e, "vec_id", "embedding", path)
    query = e.where("vec_id = 0").first()  # one row
    return vector_index.search(spark, path, "vec_id", query["embedding"] if query else [], 5, probed=1.0).withColumn("score", F.round("score", 6))


@query("keyword_search_bm25", r"""
WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM documents WHERE text IS NOT NULL),
s AS (SELECT count(*) AS n, avg(len(w)) AS mean FROM w),
q AS (SELECT unnest(['ering', 'the', 'tion']) AS t),
f AS (SELECT doc_id, t, len(list_filter(w, lambda x: x = t)) AS tf, len(w) AS l FROM w, q),
d AS (SELECT t, count(*) AS d FROM f WHERE tf > 0 GROUP BY 1)
SELECT doc_id, round(sum(ln(1 + (n - d + 0.5) / (d + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * l / mean))), 6) AS score FROM f JOIN d USING (t), s WHERE tf > 0 GROUP BY doc_id ORDER BY score DESC, doc_id LIMIT 10""")
def keyword_search_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-8, Q-17: the ten texts that fit three words best."""
    return search.bm25(table(spark, sf_dir, "documents"), "doc_id", "text", "the tion ering", 10).withColumn("score", F.round("score", 6))


@query("json_metadata", "SELECT event_id, '{\"type\":\"' || event_type || '\",\"k\":\"' || json_extract_string(props, '$.k') || '\"}' AS metadata, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """§1.2: maps as JSON, and JSON as columns."""
    k = F.get_json_object("props", "$.k")
    return table(spark, sf_dir, "events").select("event_id", F.to_json(F.create_map(F.lit("type"), "event_type", F.lit("k"), k)).alias("metadata"), k.cast("int").alias("k"))


@query("conversation_next_turn", "SELECT src, dst, CAST(i AS INTEGER) AS \"order\" FROM (SELECT conv_id || '_' || turn AS src, lead(conv_id || '_' || turn) OVER w AS dst, row_number() OVER w - 1 AS i FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE dst IS NOT NULL")
def conversation_next_turn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W-1: edges between consecutive turns."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat_ws("_", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("k"))
    return graph.next_edges("NEXT_TURN", rows, "k", "conv_id", "turn").select("src", "dst", "order")


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    file = F.concat(F.when(F.col("doc_id") % 3 == 0, "Circolare_").when(F.col("doc_id") % 3 == 1, "Ris_").otherwise("CIRCOLARE_Ris_"), F.col("doc_id"))
    return table(spark, sf_dir, "documents").select((F.col("doc_id") % 11 != 0).alias("success"), file.alias("filename"), (F.col("n_chars") % 7).cast("int").alias("sections_count"), (F.col("n_chars") % 13).cast("int").alias("chunks_count"), (F.col("n_chars") / 1000).alias("processing_time"), (F.col("doc_id") % 2 == 0).alias("toc_extracted"), (F.col("doc_id") % 4).cast("int").alias("toc_pages"))


@query("processing_summary", "SELECT count(*) AS total, count(*) FILTER (doc_id % 11 <> 0) AS successful, count(*) FILTER (doc_id % 11 = 0) AS failed, sum(n_chars % 7)::BIGINT AS sections, sum(n_chars % 13)::BIGINT AS chunks, round(sum(n_chars / 1000), 6) AS seconds, round(avg(n_chars / 1000), 6) AS avg_seconds, count(*) FILTER (doc_id % 2 = 0) AS docs_with_toc, sum(doc_id % 4)::BIGINT AS toc_pages, round(100.0 * count(*) FILTER (doc_id % 11 <> 0) / count(*), 6) AS success_percent FROM documents")
def processing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-1, A-2, F-14: the summary of a run; results are made from documents."""
    out = reports.processing_summary(_results(spark, sf_dir))
    return out.withColumns({c: F.round(c, 6) for c in ("seconds", "avg_seconds", "success_percent")})


@query("processing_breakdown", "SELECT t AS \"docType\", count(*) AS documents, sum(n_chars % 7)::BIGINT AS sections, sum(n_chars % 13)::BIGINT AS chunks FROM (SELECT n_chars, unnest(CASE doc_id % 3 WHEN 0 THEN ['Circolare'] WHEN 1 THEN ['Risoluzione'] ELSE ['Circolare', 'Risoluzione'] END) AS t FROM documents WHERE doc_id % 11 <> 0) GROUP BY 1")
def processing_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-3, A-4, F-15: by class of file name; a name of two classes counts in both."""
    return reports.breakdown(_results(spark, sf_dir))


@query("yield_summary", "SELECT (SELECT count(*) FROM orders) AS items, count(*) AS found, count(DISTINCT l_orderkey) AS with_any, round(count(*) / (SELECT count(*) FROM orders), 6) AS avg_all, round(count(*) / count(DISTINCT l_orderkey), 6) AS avg_with_any FROM lineitem WHERE l_quantity > 40")
def yield_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-5, A-6, Q-6, Q-7: finds, items with any, and means."""
    out = reports.yield_summary(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem").where("l_quantity > 40"), "l_orderkey")
    return out.withColumns({c: F.round(c, 6) for c in ("avg_all", "avg_with_any")})


@query("embedding_summary", "SELECT count(*) AS chunks, count(*) FILTER (label < 7) AS embedded, round(100.0 * count(*) FILTER (label < 7) / count(*), 6) AS percent, round(count(*) * 600 * 0.02 / 1000000, 9) AS dollars FROM embeddings")
def embedding_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-7, A-8, A-22, Q-15: completeness and cost."""
    rows = table(spark, sf_dir, "embeddings").select(F.when(F.col("label") < 7, F.col("embedding")).alias("embedding"))
    return reports.embedding_summary(rows).withColumn("percent", F.round("percent", 6)).withColumn("dollars", F.round("dollars", 9))


@query("download_summary", "SELECT count(*) AS total, count(*) FILTER (page_id % 5 <> 0) AS ok, count(*) FILTER (page_id % 5 = 0) AS failed FROM pages")
def download_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-23: fetches, good and failed."""
    return reports.download_summary(table(spark, sf_dir, "pages").select((F.col("page_id") % 5 != 0).alias("ok")))


@query("group_counts", "SELECT lang AS type, count(*) AS count FROM documents GROUP BY 1")
def group_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-16, A-17, A-19, Q-2, Q-8, Q-11: counts by group."""
    return graph_queries.documents_by_type(Graph({"Document": table(spark, sf_dir, "documents").select(F.col("lang").alias("type"))}, spark.range(0)))


@query("distinct_names", "SELECT DISTINCT source AS name FROM documents")
def distinct_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-21, U-5: distinct values."""
    return table(spark, sf_dir, "documents").select(F.col("source").alias("name")).distinct()


@query("two_hop_citations", "SELECT DISTINCT l_orderkey AS src FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey WHERE n_name = (SELECT min(n_name) FROM nation)")
def two_hop_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-10: sources two steps from a node."""
    first = table(spark, sf_dir, "nation").agg(F.min_by("n_nationkey", "n_name")).first()[0]  # one key
    cited = graph.edges("REFERENCES_LAW", table(spark, sf_dir, "lineitem"), "l_orderkey", "l_suppkey")
    edges = cited.unionByName(graph.edges("REFERS_TO", table(spark, sf_dir, "supplier"), "s_suppkey", F.col("s_nationkey").cast("long"), distinct=False))
    return graph_queries.chunks_citing(Graph({}, edges), first).withColumnRenamed("chunkId", "src")


_WORD = r"[\p{L}\p{M}\p{N}_]+"


def _topics_sql(source: str, patterns: dict[str, str], least: str = "true") -> str:
    """Common tables ``tw`` (sectionId, words), ``th`` (topic hits) and ``tk`` (best keywords) of (sectionId, content)."""
    hits = " UNION ALL ".join(f"SELECT \"sectionId\", '{name}' AS name, {i} AS position, len({sql}) AS n FROM tw" for i, (name, sql) in enumerate(patterns.items()))
    return rf"""
tw AS (SELECT "sectionId", content, regexp_extract_all(lower(content), '{_WORD}') AS w FROM {source} WHERE length({_TRIM('content')}) >= 50),
th AS (SELECT "sectionId", name, position, n, n / sum(n) OVER (PARTITION BY "sectionId") AS score FROM ({hits}) WHERE n > 0),
tf AS (SELECT "sectionId", word, count(*) AS n FROM (SELECT "sectionId", unnest(w) AS word FROM tw) WHERE length(word) >= 5 GROUP BY 1, 2),
td AS (SELECT word, count(*) AS df FROM tf GROUP BY 1),
tv AS (SELECT "sectionId", word, n * (ln((1 + (SELECT count(*) FROM tw)) / (1 + df)) + 1) AS weight FROM tf JOIN td USING (word)),
tk AS (SELECT "sectionId", word, place, weight / max(weight) OVER (PARTITION BY "sectionId") AS score FROM (SELECT *, row_number() OVER (PARTITION BY "sectionId" ORDER BY round(weight, 9) DESC, word) AS place FROM tv) WHERE place <= 5)"""


_SQL_LEXICON = {"T_credentials": "regexp_extract_all(lower(content), 'token|key')", "T_articles": "list_filter(w, lambda x: x IN ('the', 'der', 'la', 'el'))", "T_insults": "regexp_extract_all(lower(content), 'idiot|trash|disgusting')"}


@query("topic_offline", f"WITH d AS (SELECT CAST(doc_id AS VARCHAR) AS \"sectionId\", text AS content FROM documents), {_topics_sql('d', _SQL_LEXICON)} SELECT \"sectionId\", name AS id, round(score, 6) AS \"relevanceScore\", 'topic' AS kind FROM th UNION ALL SELECT \"sectionId\", 'T_' || word, round(score, 6), 'keyword' FROM tk")
def topic_offline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X-3, X-4, X-6, F-8, F-9, I-15: topics by patterns and keywords by TF-IDF."""
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("sectionId"), F.col("text").alias("content"))
    lexicon = {"Credentials": ("keys and tokens", r"token|key"), "Articles": ("articles", r"\b(?:the|der|la|el)\b"), "Insults": ("abuse", r"idiot|trash|disgusting")}
    found = topics.analyses(rows, topics.lexicon_extractor(lexicon))
    score = F.round("relevanceScore", 6).alias("relevanceScore")
    t = topics.topic_rows(found).select("sectionId", F.col("topicId").alias("id"), score, F.lit("topic").alias("kind"))
    return t.union(topics.keyword_rows(found).select("sectionId", "keywordId", score, F.lit("keyword")))


@query("embed_hash", r"""
WITH w AS (SELECT doc_id, unnest(list_filter(string_split_regex(lower(text), '[\s\p{Z}\x1c-\x1f\x85]+'), lambda x: x <> '')) AS word FROM documents),
h AS (SELECT doc_id, CAST('0x' || substr(md5(word), 1, 8) AS BIGINT) % 64 AS dim, CASE WHEN substr(md5(word), 9, 1) IN ('0', '2', '4', '6', '8', 'a', 'c', 'e') THEN 1 ELSE -1 END AS sign FROM w),
s AS (SELECT doc_id, dim, sum(sign) AS v FROM h GROUP BY 1, 2)
SELECT doc_id, CAST(dim AS INTEGER) AS dim, round(CAST(CAST(v / sqrt(sum(v * v) OVER (PARTITION BY doc_id)) AS FLOAT) AS DOUBLE), 5) AS value FROM s WHERE v <> 0""")
def embed_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X-5, F-13, I-16: vectors by the offline embedder, as their components that aren't zero."""
    vectors = embed.embed(table(spark, sf_dir, "documents"), "doc_id", "text", embed.hash_embedder(64))
    return vectors.select("doc_id", F.posexplode("embedding").alias("dim", "v")).where("v <> 0").select("doc_id", "dim", F.round(F.col("v").cast("double"), 5).alias("value"))


_SUITE = (
    constraints.Unique("orders", ("o_orderkey",)), constraints.Unique("orders", ("o_custkey", "o_orderdate")), constraints.Exists("lineitem", "l_orderkey", "orders", "o_orderkey"),
    constraints.Exists("orders", "o_custkey", "customer", "c_custkey", "o_orderstatus = 'O'"), constraints.Dense("lineitem", "l_orderkey", "place"), constraints.Holds("lineitem", "l_quantity < 50"),
)


@query("constraint_report", """
WITH o AS (SELECT * FROM orders WHERE o_orderkey % 7 > 0), l AS (SELECT *, l_linenumber - 1 - CASE WHEN l_orderkey % 5 = 0 AND l_linenumber > 2 THEN 1 ELSE 0 END AS place FROM lineitem), c AS (SELECT * FROM customer WHERE c_custkey % 11 > 0),
v AS (SELECT 'orders: o_orderkey unique' AS c, count(*) AS rows FROM o GROUP BY o_orderkey HAVING count(*) > 1
UNION ALL SELECT 'orders: o_custkey, o_orderdate unique', count(*) FROM o WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL GROUP BY o_custkey, o_orderdate HAVING count(*) > 1
UNION ALL SELECT 'lineitem: l_orderkey in orders.o_orderkey', count(*) FROM l WHERE l_orderkey NOT IN (SELECT o_orderkey FROM o) GROUP BY l_orderkey
UNION ALL SELECT 'orders: o_custkey in customer.c_custkey (o_orderstatus = ''O'')', count(*) FROM o WHERE o_orderstatus = 'O' AND o_custkey NOT IN (SELECT c_custkey FROM c) GROUP BY o_custkey
UNION ALL SELECT 'lineitem: place dense in l_orderkey', count(*) FROM l GROUP BY l_orderkey HAVING list_sort(list(place)) <> range(0, count(*))
UNION ALL SELECT 'lineitem: l_quantity < 50', count(*) FROM l WHERE l_quantity >= 50 HAVING count(*) > 0)
SELECT c AS "constraint", count(*) AS keys, CAST(sum(rows) AS BIGINT) AS rows FROM v GROUP BY 1""")
def constraint_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-8, M-10, A-14: what breaks declared constraints in three tables from which rows and places were taken."""
    moved = F.when((F.col("l_orderkey") % 5 == 0) & (F.col("l_linenumber") > 2), 1).otherwise(0)
    lineitem = table(spark, sf_dir, "lineitem").withColumn("place", F.col("l_linenumber") - 1 - moved)
    tables = {"orders": table(spark, sf_dir, "orders").where("o_orderkey % 7 > 0"), "lineitem": lineitem, "customer": table(spark, sf_dir, "customer").where("c_custkey % 11 > 0")}
    return constraints.report(constraints.violations(tables, _SUITE))


@query("topic_resolution", r"""
WITH RECURSIVE b AS (SELECT p_partkey AS k, regexp_replace(lower(p_name || ' ' || p_brand), '[^a-z0-9]+', '', 'g') AS n FROM part), d AS (SELECT DISTINCT n FROM b),
l AS (SELECT a.n AS a, c.n AS b FROM d a JOIN d c ON a.n <> c.n AND levenshtein(a.n, c.n) <= CAST(floor(0.1 * greatest(length(a.n), length(c.n)) + 1e-9) AS BIGINT)),
r(node, seen) AS (SELECT n, n FROM d UNION SELECT l.b, r.seen FROM r JOIN l ON l.a = r.node),
g AS (SELECT node, min(seen) AS g FROM r GROUP BY 1), m AS (SELECT g, min(k) AS entity FROM b JOIN g ON node = n GROUP BY 1)
SELECT k AS p_partkey, entity FROM b JOIN g ON node = n JOIN m USING (g)""")
def topic_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """§2.10 stretch: names of all parts that are one up to a tenth of their signs."""
    parts = table(spark, sf_dir, "part").select("p_partkey", F.concat_ws(" ", "p_name", "p_brand").alias("name"))
    return resolve.resolve(parts, "p_partkey", "name", 0.9)


@query("asof_join", """
SELECT e.event_id, c.event_id AS last_click, c.value AS click_value FROM (SELECT * FROM events WHERE event_type <> 'click') e
ASOF LEFT JOIN (SELECT user_id, ts, max(struct_pack(event_id := event_id, value := value)).event_id AS event_id, max(struct_pack(event_id := event_id, value := value)).value AS value FROM events WHERE event_type = 'click' GROUP BY 1, 2) c ON e.user_id = c.user_id AND e.ts >= c.ts""")
def asof_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """§2.10 stretch: every event with its user's last click before it."""
    events = table(spark, sf_dir, "events")
    clicks = events.where("event_type = 'click'").select("user_id", "ts", F.col("event_id").alias("last_click"), F.col("value").alias("click_value"))
    others = events.where("event_type <> 'click'").select("event_id", "user_id", "ts")
    return validity.as_of(others, clicks, "user_id", "ts", "ts", ["last_click", "click_value"]).select("event_id", "last_click", "click_value")


@query("valid_on_day", """
WITH o AS (SELECT o_orderkey AS k, o_custkey AS c, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS i, CASE WHEN o_orderkey % 4 > 0 THEN o_orderdate END AS d FROM orders),
v AS (SELECT k AS o_orderkey, d AS "validFrom", min(d) OVER (PARTITION BY c ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS "validUntil" FROM o)
SELECT * FROM v WHERE "validFrom" <= TIMESTAMP '1997-06-01' AND ("validUntil" IS NULL OR "validUntil" > TIMESTAMP '1997-06-01')""")
def valid_on_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """§2.10 stretch: orders of which each takes the place of its customer's one before, and of which some have no date: those that hold on a day."""
    from datetime import datetime

    rows = table(spark, sf_dir, "orders")
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    edges = rows.select(F.lead("o_orderkey").over(w).alias("src"), F.col("o_orderkey").alias("dst"))
    docs = rows.select("o_orderkey", F.when(F.col("o_orderkey") % 4 > 0, F.col("o_orderdate")).alias("issued"))
    return validity.valid_on(validity.validity(docs, edges, "o_orderkey"), datetime(1997, 6, 1))
