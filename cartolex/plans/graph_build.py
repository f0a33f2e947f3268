"""The registered queries of the whole path from pages to graph, over page records made from every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartolex.config import EngineConfig
from cartolex.operators import embed, ledger, references, reports, text_index, topics
from cartolex.operators.sections import ITALIAN
from cartolex.plans import graph_queries, graph_store, knowledge_graph
from cartolex.plans.queries import _CHUNKS, _LINES, _TRIM, _topics_sql
from cartolex.plans.registry import query, table
from cartolex.sources import files, link_source, links
from cartolex.staging import new_path

_LEXICON = {"Leggi": ("laws", r"legge"), "Ambito": ("scope", r"ambito")}


def book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page records: each document becomes a file of four pages, a circular or an answer with its whole text as the third page.

    The first page states type, number, year and subject, the second is a table of contents, the fourth has numbered sections that cite
    another circular, a law and an article.
    """
    i = F.col("doc_id")
    year = lambda k: (2000 + k % 25).cast("string")
    source, answer = F.coalesce("source", F.lit("x")), i % 3 == 2
    one = F.concat(F.when(answer, "Risposta").otherwise("Circolare"), F.lit(" n. "), i, F.lit(", 1 giugno "), year(i), F.lit("\nOGGETTO: "), source, F.lit("\n\n"))
    three = F.concat(F.lit("PREMESSA\n"), F.coalesce("text", F.lit("")), F.lit("\n"))
    cited = F.when(answer, "").otherwise(F.concat(F.lit("la circolare n. "), i + 3, F.lit(" del 01/06/"), year(i + 3), F.lit(" e ")))
    four = F.concat(F.lit("1. Quadro\n1.1 Ambito soggettivo\nVedi "), cited, F.lit("la legge n. "), i % 50 + 1, F.lit(" del 27/12/2006 e l'articolo "), i % 7 + 1, F.lit("-bis.\n1.1.1 Dettaglio\n"), source, F.lit("\n2. Altro\n"), F.coalesce("lang", F.lit("x")), F.lit("\n"))
    pages = F.array(one, F.lit("INDICE\nPREMESSA ..... 3\n1.1 Ambito ..... 4\n"), three, four)
    rows = table(spark, sf_dir, "documents").select(F.concat(F.lit("f"), i, F.lit(".txt")).alias("filename"), F.lit(0).cast("long").alias("file_size"), F.posexplode(pages).alias("n", "text"))
    return rows.select("filename", "file_size", (F.col("n") + 1).alias("page_no"), "text")


_BOOK = r"""
pg AS (SELECT doc_id AS i, doc_id % 3 = 2 AS answer, coalesce(source, 'x') AS source,
  CASE WHEN doc_id % 3 = 2 THEN 'Risposta' ELSE 'Circolare' END || ' n. ' || doc_id || ', 1 giugno ' || (2000 + doc_id % 25) AS head,
  'PREMESSA' || chr(10) || coalesce(text, '') || chr(10) AS three,
  '1. Quadro' || chr(10) || '1.1 Ambito soggettivo' || chr(10) || 'Vedi ' || CASE WHEN doc_id % 3 = 2 THEN '' ELSE 'la circolare n. ' || (doc_id + 3) || ' del 01/06/' || (2000 + (doc_id + 3) % 25) || ' e ' END || 'la legge n. ' || (doc_id % 50 + 1) || ' del 27/12/2006 e l''articolo ' || (doc_id % 7 + 1) || '-bis.' || chr(10) || '1.1.1 Dettaglio' || chr(10) || coalesce(source, 'x') || chr(10) || '2. Altro' || chr(10) || coalesce(lang, 'x') || chr(10) AS four FROM documents),
book AS (SELECT CASE WHEN answer THEN 'RIP_' ELSE 'CIR_' END || i || '_' || (2000 + i % 25) AS doc_id, answer, i, head, source,
  head || chr(10) || 'OGGETTO: ' || source || chr(10) || chr(10) || 'INDICE' || chr(10) || 'PREMESSA ..... 3' || chr(10) || '1.1 Ambito ..... 4' || chr(10) || three || four AS text FROM pg)"""
_HEADERS = _LINES.replace("FROM documents", "FROM book").replace("WITH l AS", "WITH l AS", 1)
_HEADERS = _HEADERS.replace(r"^(?i:permission is|copyright|the\s)", "^(?i:" + "|".join(ITALIAN.named) + ")").replace(r"^(?:[A-ZÀ-Þ]{3,}[^a-z]*$|[A-Z][a-z]+\.$)", "^(?:" + "|".join(ITALIAN.numbered) + ")")
#: Sections of the books, without those of the table of contents, which has only page 2.
_SECTIONS = rf"""
sections AS ({_HEADERS.strip()},
  y AS (SELECT x.*, flush // 50 + 1 AS page, NOT book.answer AS has_toc, regexp_extract(header, '^(\d+(?:\.\d+)*)', 1) AS digits, {_TRIM("regexp_extract(header, '(?i)^([A-ZÀ-Ÿ\\s]+)', 1)")} AS name FROM x JOIN book USING (doc_id)),
  z AS (SELECT *, CASE WHEN digits <> '' THEN len(string_split(digits, '.')) ELSE 1 END AS level, row_number() OVER (PARTITION BY doc_id ORDER BY ord) - 1 AS place FROM y WHERE NOT (has_toc AND page = 2 AND length(content) < 100)),
  up AS (SELECT a.doc_id, a.place, max(b.place) AS over FROM z a JOIN z b ON b.doc_id = a.doc_id AND b.place < a.place AND b.level < a.level GROUP BY ALL)
  SELECT z.doc_id AS "documentId", z.doc_id || '_SEC_' || z.ord AS "sectionId", CASE WHEN z.digits <> '' THEN z.digits WHEN z.kind = 'named' AND z.name <> '' THEN upper(z.name) ELSE 'UNKNOWN' END AS "sectionNumber",
    substr(z.header, 1, 200) AS title, z.content, z.kind AS "sectionType", z.level, z.page, z.place, CASE WHEN p.level = z.level - 1 THEN z.doc_id || '_SEC_' || p.ord END AS parent
  FROM z LEFT JOIN up ON up.doc_id = z.doc_id AND up.place = z.place LEFT JOIN z p ON p.doc_id = z.doc_id AND p.place = up.over)"""
_PIECES = "chunks AS (SELECT doc_id AS sid, doc_id || '_CHK_' || chunk_index AS cid, content, chunk_index FROM c)"
_BASE = f"WITH RECURSIVE {_BOOK.strip()}, {_SECTIONS.strip()}, " + _CHUNKS.strip().removeprefix("WITH RECURSIVE ").replace("FROM documents", 'FROM (SELECT "sectionId" AS doc_id, content AS text FROM sections)') + f", {_PIECES} "
_ANY = " UNION ALL ".join(
    f"SELECT cid, {k} AS kind, generate_subscripts(m, 1) AS j, unnest(m) AS citation FROM (SELECT cid, regexp_extract_all(content, '(?i){pattern}') AS m FROM chunks)" for k, pattern in enumerate(references.PATTERNS.values())
)
#: References as the rules find them: only laws, articles and circulars are cited here, and each pattern's groups are read from its find.
_REFS = rf""", raw AS ({_ANY}),
ref AS (SELECT cid, kind, j, citation, CASE kind {" ".join(f"WHEN {k} THEN '{'altro' if name == 'articolo' else name}'" for k, name in enumerate(references.PATTERNS))} END AS type, regexp_extract(citation, '(\d+(?:-[a-z]+)?)', 1) AS number, nullif(regexp_extract(citation, '(\d{{4}})$', 1), '') AS year FROM raw),
refs AS (SELECT *, CASE WHEN year IS NULL THEN 'REF_' || substr(md5(type || '_' || citation), 1, 8) ELSE CASE type WHEN 'circolare' THEN 'CIR' WHEN 'legge' THEN 'EXT_LEG' ELSE '?' END || '_' || number || '_' || year END AS rid FROM ref),
cited AS (SELECT rid, arg_max(type, (cid, kind, j)) AS type, arg_max(citation, (cid, kind, j)) AS citation, arg_max(number, (cid, kind, j)) AS number, arg_max(year, (cid, kind, j)) AS year, arg_max(CASE WHEN type = 'altro' THEN number ELSE '' END, (cid, kind, j)) AS article FROM refs GROUP BY 1)"""
_THEMES = ", " + _topics_sql("sections", {"T_leggi": "regexp_extract_all(lower(content), 'legge')", "T_ambito": "regexp_extract_all(lower(content), 'ambito')"})
_STRUCTURE_EDGES = """
SELECT 'HAS_TOC' AS type, doc_id AS src, doc_id || '_TOC' AS dst, NULL AS o, NULL AS s FROM book WHERE NOT answer
UNION ALL SELECT 'HAS_SECTION', "documentId", "sectionId", place, NULL FROM sections
UNION ALL SELECT 'HAS_SUBSECTION', parent, "sectionId", place, NULL FROM sections WHERE parent IS NOT NULL
UNION ALL SELECT 'HAS_CHUNK', sid, cid, chunk_index, NULL FROM chunks
UNION ALL SELECT * FROM (SELECT 'NEXT_SECTION', "sectionId", lead("sectionId") OVER (PARTITION BY "documentId" ORDER BY place) AS n, place, NULL FROM sections) WHERE n IS NOT NULL
UNION ALL SELECT * FROM (SELECT 'NEXT_CHUNK', cid, lead(cid) OVER (PARTITION BY sid ORDER BY chunk_index) AS n, chunk_index, NULL FROM chunks) WHERE n IS NOT NULL
UNION ALL SELECT DISTINCT 'REFERENCES_LAW', cid, rid, NULL, NULL FROM refs
UNION ALL SELECT 'REFERS_TO', rid, rid, NULL, NULL FROM cited WHERE rid IN (SELECT doc_id FROM book)"""
_TOPIC_EDGES = """
UNION ALL SELECT 'DISCUSSES_TOPIC', "sectionId", name, NULL, round(score, 6) FROM th
UNION ALL SELECT 'DISCUSSES_KEYWORD', "sectionId", 'T_' || word, NULL, round(score, 6) FROM tk"""

_md5 = lambda c: F.md5(F.col(c).cast("binary")).alias(f"{c}_md5")


@query("graph_documents", f"WITH {_BOOK} SELECT doc_id AS \"documentId\", CASE WHEN answer THEN 'Risposta' ELSE 'Circolare' END AS type, CAST(i AS VARCHAR) AS number, CAST(2000 + i % 25 AS INTEGER) AS year, head AS title, source AS oggetto, 4 AS \"pageCount\", md5(text) AS \"fullText_md5\" FROM book")
def graph_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-8, I-12, S-1 to S-4: Document records of whole files."""
    found = knowledge_graph.structure(book(spark, sf_dir))["Document"]
    return found.select("documentId", "type", "number", "year", "title", "oggetto", "pageCount", _md5("fullText"))


@query("graph_tocs", f"WITH {_BOOK} SELECT doc_id AS \"documentId\", doc_id || '_TOC' AS \"tocId\", 'INDICE' || chr(10) || 'PREMESSA ..... 3' || chr(10) || '1.1 Ambito ..... 4' AS \"rawText\", 2 AS \"startPage\", 2 AS \"endPage\", true AS \"hasHeader\", 'INDICE' AS \"headerText\", 1 AS \"entryCount\", 'PREMESSA' AS \"detectionMethod\" FROM book WHERE NOT answer")
def graph_tocs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-1, F-2, S-5: tables of contents, of circulars only."""
    return knowledge_graph.structure(book(spark, sf_dir))["TableOfContents"]


@query("graph_sections", f'WITH {_BOOK}, {_SECTIONS} SELECT "sectionId", "documentId", "sectionNumber", md5(title) AS title_md5, md5(content) AS content_md5, "sectionType", CAST(level AS INTEGER) AS level, CAST(page AS INTEGER) AS "pageNumber", CAST(place AS INTEGER) AS "order", parent AS "parentSectionId" FROM sections')
def graph_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-4, S-6 to S-10: sections by the Italian headers, with numbers, levels and parents, without those of the table of contents."""
    found = knowledge_graph.structure(book(spark, sf_dir))["Section"]
    return found.select("sectionId", "documentId", "sectionNumber", _md5("title"), _md5("content"), "sectionType", "level", "pageNumber", "order", "parentSectionId")


@query("graph_chunks", _BASE + 'SELECT cid AS "chunkId", "documentId", sid AS "sectionId", md5(chunks.content) AS content_md5, chunk_index AS "chunkIndex", CAST(page AS INTEGER) AS "pageNumber", \'{"section_number":"\' || "sectionNumber" || \'","section_type":"\' || "sectionType" || \'"}\' AS metadata FROM chunks JOIN sections ON sid = "sectionId"')
def graph_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-12 to S-14: chunk records with their metadata."""
    found = knowledge_graph.structure(book(spark, sf_dir))["Chunk"]
    return found.select("chunkId", "documentId", "sectionId", _md5("content"), "chunkIndex", "pageNumber", F.to_json("metadata").alias("metadata"))


@query("graph_references", _BASE + _REFS + ' SELECT rid AS "referenceId", type, citation, number, year, nullif(article, \'\') AS "articleNumber" FROM cited')
def graph_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-11, I-14, X-1: LegalReference records of all chunks; the last citation wins."""
    made = knowledge_graph.structure(book(spark, sf_dir))
    return knowledge_graph.cite(made["Chunk"], made["Document"])[1].drop("description")


def _whole(spark: SparkSession, pages: DataFrame, themes: bool = True) -> knowledge_graph.Graph:
    return knowledge_graph.build(pages, topic_extractor=topics.lexicon_extractor(_LEXICON) if themes else None)


@query("graph_edges", _BASE + _REFS + _THEMES + f' SELECT type, src, dst, CAST(o AS INTEGER) AS "order", CAST(s AS DOUBLE) AS "relevanceScore" FROM ({_STRUCTURE_EDGES}{_TOPIC_EDGES})')
def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-13, A-14: all ten kinds of edges of the whole build."""
    return _whole(spark, book(spark, sf_dir)).edges.withColumn("relevanceScore", F.round("relevanceScore", 6))


@query("graph_counts", _BASE + _REFS + _THEMES + " SELECT (SELECT count(*) FROM refs) AS \"references\", (SELECT count(DISTINCT name) FROM th) AS new_topics, (SELECT count(DISTINCT word) FROM tk) AS new_keywords, (SELECT count(*) FROM th) + (SELECT count(*) FROM tk) AS occurrences")
def graph_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-14, I-15: what a build reports: occurrences of references, new topics and keywords, occurrences of both."""
    return _whole(spark, book(spark, sf_dir)).counts


@query("graph_reingest", _BASE + _REFS + f", e AS ({_STRUCTURE_EDGES}) SELECT 'edge' AS kind, type AS name, count(*) AS n FROM e GROUP BY 2 UNION ALL SELECT 'node', 'Document', count(*) FROM book UNION ALL SELECT 'node', 'TableOfContents', count(*) FROM book WHERE NOT answer UNION ALL SELECT 'node', 'Section', count(*) FROM sections UNION ALL SELECT 'node', 'Chunk', count(*) FROM chunks UNION ALL SELECT 'node', 'LegalReference', count(*) FROM cited")
def graph_reingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-13, I-20, M-7: two overlapping parts of the pages, ingested into one stored graph, of which the second replaces stale sections."""
    pages, target = book(spark, sf_dir), new_path(spark, "graph")
    number = F.regexp_extract("filename", r"(\d+)", 1).cast("long")
    stale = F.when((F.col("page_no") == 3) & (number % 2 == 0), F.concat(F.lit("3. Vecchio\nvia\n"), "text")).otherwise(F.col("text"))
    graph_store.ingest(pages.where(number % 4 != 1).withColumn("text", stale), target)
    graph_store.ingest(pages.where((number % 2 == 0) | (number % 4 == 1)), target)
    stored = graph_store.read(spark, target)
    edges = graph_queries.counts_by_edge_type(stored).select(F.lit("edge").alias("kind"), F.col("type").alias("name"), F.col("count").alias("n"))
    return edges.union(graph_queries.counts_by_label(stored).select(F.lit("node"), "label", "count"))


@query("graph_scans", _BASE + "SELECT 'chunk' AS kind, cid AS id FROM (SELECT cid FROM chunks JOIN sections ON sid = \"sectionId\" ORDER BY \"documentId\", sid, chunk_index LIMIT 50) UNION ALL SELECT 'section', id FROM (SELECT \"sectionId\" AS id FROM sections ORDER BY \"documentId\", place LIMIT 50)")
def graph_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-9, I-10: the first chunks and sections in order."""
    made = knowledge_graph.structure(book(spark, sf_dir))
    g = knowledge_graph.Graph(made, made["Section"])
    return graph_queries.chunk_scan(g, 50).select(F.lit("chunk").alias("kind"), F.col("chunkId").alias("id")).union(graph_queries.section_scan(g, 50).select(F.lit("section"), "sectionId"))


@query("graph_vectors", _BASE + "SELECT cid AS \"chunkId\", CAST(64 AS INTEGER) AS dims, CASE WHEN content ~ '[^\\s]' THEN 1.0 ELSE 0.0 END AS length FROM chunks")
def graph_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-11, U-4, X-5: every chunk with the vector of its enriched text, joined back by key."""
    g = knowledge_graph.build(book(spark, sf_dir), EngineConfig(embedding_dim=64), embedder=embed.hash_embedder(64))
    squares = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return g.nodes["Chunk"].select("chunkId", F.size("embedding").alias("dims"), F.round(F.sqrt(squares), 4).alias("length"))


@query("keyword_search_index", r"""
WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM documents WHERE text IS NOT NULL),
s AS (SELECT count(*) AS n, avg(len(w)) AS mean FROM w),
f AS (SELECT doc_id, t, len(list_filter(w, lambda x: x = t)) AS tf, len(w) AS l FROM w, (SELECT unnest(['ering', 'the', 'tion']) AS t)),
d AS (SELECT t, count(*) AS d FROM f WHERE tf > 0 GROUP BY 1)
SELECT doc_id, round(sum(ln(1 + (n - d + 0.5) / (d + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * l / mean))), 6) AS score FROM f JOIN d USING (t), s WHERE tf > 0 GROUP BY doc_id ORDER BY score DESC, doc_id LIMIT 10""")
def keyword_search_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-8, M-9, Q-17: the same search from a stored inverted index."""
    path = new_path(spark, "index")
    text_index.write_index(table(spark, sf_dir, "documents"), "doc_id", "text", path)
    return text_index.search(spark, path, "doc_id", "the tion ering").withColumn("score", F.round("score", 6))


_PHRASE = "l'en, \"in the\" n. \"die\" Of"


@query("keyword_search_phrase", r"""
WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM documents WHERE text IS NOT NULL),
s AS (SELECT count(*) AS n, avg(len(w)) AS mean FROM w),
f AS (SELECT doc_id, t, len(list_filter(w, lambda x: x = t)) AS tf, len(w) AS l FROM w, (SELECT unnest(['l', 'en', 'n', 'die', 'of']) AS t)
  UNION ALL SELECT doc_id, 'in the', len(list_filter(range(1, len(w)), lambda i: w[i] = 'in' AND w[i + 1] = 'the')), len(w) FROM w),
d AS (SELECT t, count(*) AS d FROM f WHERE tf > 0 GROUP BY 1)
SELECT doc_id, round(sum(ln(1 + (n - d + 0.5) / (d + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * l / mean))), 6) AS score FROM f JOIN d USING (t), s WHERE tf > 0 GROUP BY doc_id ORDER BY score DESC, doc_id LIMIT 25""")
def keyword_search_phrase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-8, Q-17: a query as it is typed, with an apostrophe, full stops and a phrase, from the stored index."""
    path = new_path(spark, "index")
    text_index.write_index(table(spark, sf_dir, "documents"), "doc_id", "text", path)
    return text_index.search(spark, path, "doc_id", _PHRASE, 25).withColumn("score", F.round("score", 6))


@query("csv_links", "SELECT CAST(page_id AS VARCHAR) AS \"ID\", unnest([url, url || '?again']) AS url FROM pages")
def csv_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-1, I-2: a CSV whose cells hold several links on lines of their own."""
    path = new_path(spark, "csv")
    cells = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("ID"), F.concat("url", F.lit("\n"), "url", F.lit("?again")).alias(links.LINKS))
    cells.write.option("escape", '"').csv(path, header=True)
    return links.urls(links.read_questions(spark, path)).select("ID", "url")


@query("fetch_report", "SELECT count(DISTINCT url) AS total, count(DISTINCT url) FILTER (url NOT LIKE 'https%') AS ok, count(DISTINCT url) FILTER (url LIKE 'https%') AS failed FROM pages")
def fetch_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-3, A-23, X-7: every url by a fetcher that refuses some and raises on none."""
    fetcher = lambda url: (None, "", "refused") if url.startswith("https") else (url.encode(), "application/pdf", None)
    return reports.download_summary(links.fetch(table(spark, sf_dir, "pages"), fetcher, max_concurrent=8))


@query("link_source", "SELECT count(DISTINCT url) AS total, count(DISTINCT url) FILTER (url NOT LIKE 'https%') AS ok, count(DISTINCT url) FILTER (url LIKE 'https%') AS failed FROM pages")
def link_source_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-3, X-7: every url dealt in two overlapping batches and read as a data source, with fetch_report's fetcher."""
    urls, folder = table(spark, sf_dir, "pages").select("page_id", "url"), new_path(spark, "links")
    link_source.deal(urls.where("page_id % 3 < 2"), folder, slots=8)
    link_source.deal(urls, folder)
    link_source.register(spark, lambda url: (None, "", "refused") if url.startswith("https") else (url.encode(), "application/pdf", None))
    return reports.download_summary(spark.read.format("links").load(folder))


@query("file_pages", "SELECT md5(text) AS text_md5, count(*) AS n FROM documents WHERE text <> '' AND NOT contains(text, chr(12)) GROUP BY 1")
def file_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-6, I-7, M-10: documents written as pages of text files, scanned and decoded again."""
    path = new_path(spark, "files")
    docs = table(spark, sf_dir, "documents").where("text <> '' and not contains(text, '\f')")
    docs.select((F.col("doc_id") % 16).alias("shelf"), "text").write.partitionBy("shelf").option("maxRecordsPerFile", 1000).option("lineSep", "\f").text(path)  # more documents are more files, not larger ones
    found, _ = files.pages(files.scan(spark, path, "*.txt", recursive=True))
    return found.where("text <> ''").groupBy(F.md5(F.col("text").cast("binary")).alias("text_md5")).agg(F.count("*").alias("n"))


@query("model_ledger", """
WITH i AS (SELECT DISTINCT coalesce(text, '') AS t FROM documents), a AS (SELECT count(*) AS n FROM i WHERE length(t) % 7 > 0), d AS (SELECT count(*) AS n FROM i WHERE length(t) % 7 = 0)
SELECT 'answered' AS state, n AS items, n AS tries, (SELECT count(*) FROM documents WHERE length(coalesce(text, '')) % 7 > 0) AS rows FROM a UNION ALL SELECT 'dead', n, 4 * n, (SELECT count(*) FROM documents WHERE length(coalesce(text, '')) % 7 = 0) FROM d""")
def model_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X-1 to X-5, M-10: three runs over all documents with a model that refuses some texts, each time: what the ledger has then."""
    kept = ledger.Ledger(new_path(spark, "ledger"), "length", tries=2, pause=0.0, runs=2)

    def length(text: str) -> int:
        if len(text) % 7 == 0:
            raise ValueError("refused")
        return len(text)

    for _ in range(3):
        said = ledger.ask(table(spark, sf_dir, "documents"), "doc_id", "text", length, "int", kept)
    rows = said.groupBy(F.when(F.col("error").isNull(), "answered").otherwise("dead").alias("state")).agg(F.count("*").alias("rows"))
    return ledger.report(spark, kept).join(rows, "state")


@query("property_lookup", f"WITH {_BOOK} SELECT doc_id AS \"documentId\", source AS oggetto FROM book WHERE NOT answer AND i % 25 = 7")
def property_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-9: the documents of one type and year in a stored graph, from the buckets that hold one."""
    target = new_path(spark, "graph")
    graph_store.ingest(book(spark, sf_dir), target)
    return graph_store.lookup(spark, target, "Document", type="Circolare", year=2007).select("documentId", "oggetto")
