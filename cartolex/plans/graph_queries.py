"""Queries that users run on a finished graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartolex.operators import search, text_index, vector_index
from cartolex.operators.graph import label_counts
from cartolex.plans.knowledge_graph import Graph


def _edges(g: Graph, kind: str) -> DataFrame:
    return g.edges.where(F.col("type") == kind)


def counts_by_label(g: Graph) -> DataFrame:
    """Nodes by label, most first."""
    return label_counts(g.nodes).orderBy(F.desc("count"), "label")


def counts_by_edge_type(g: Graph) -> DataFrame:
    """Edges by type."""
    return g.edges.groupBy("type").count().orderBy("type")


def documents_by_type(g: Graph) -> DataFrame:
    """Documents by type."""
    return g.nodes["Document"].groupBy("type").count().orderBy("type")


def references_by_type(g: Graph) -> DataFrame:
    """References by type, most first."""
    return g.nodes["LegalReference"].groupBy("type").count().orderBy(F.desc("count"), "type")


def chunk_scan(g: Graph, limit: int = 0) -> DataFrame:
    """Chunks in the order of document, section and place; a limit of 0 means all."""
    rows = g.nodes["Chunk"].select("chunkId", "documentId", "sectionId", "content", "chunkIndex").orderBy("documentId", "sectionId", "chunkIndex")
    return rows.limit(limit) if limit else rows


def section_scan(g: Graph, limit: int = 0) -> DataFrame:
    """Sections in the order of document and place; a limit of 0 means all."""
    rows = g.nodes["Section"].select("sectionId", "documentId", "sectionNumber", "title", "content", "order").orderBy("documentId", "order")
    return rows.limit(limit) if limit else rows


def index_chunks(g: Graph, path: str) -> None:
    """The text index of all chunks, stored once at ``path``."""
    text_index.write_index(g.nodes["Chunk"], "chunkId", "content", path)


def indexed_search(g: Graph, path: str, query: str, k: int = 10) -> DataFrame:
    """Like :func:`keyword_search`, from a stored index: no text is read."""
    return text_index.search(g.edges.sparkSession, path, "chunkId", query, k)


def chunks_with_references(g: Graph) -> DataFrame:
    """How many chunks cite anything."""
    return _edges(g, "REFERENCES_LAW").agg(F.count_distinct("src").alias("chunks"))


def chunks_citing(g: Graph, document_id: str) -> DataFrame:
    """Chunks that cite a document by way of a reference."""
    to = _edges(g, "REFERS_TO").where(F.col("dst") == document_id).select(F.col("src").alias("ref"))
    return _edges(g, "REFERENCES_LAW").join(to, F.col("dst") == F.col("ref"), "left_semi").select(F.col("src").alias("chunkId")).distinct()


def references_per_document(g: Graph) -> DataFrame:
    """Documents by how many references lead to them."""
    return _edges(g, "REFERS_TO").groupBy(F.col("dst").alias("documentId")).count().orderBy(F.desc("count"), "documentId")


def sections_by_topic(g: Graph, topic_id: str, k: int = 10) -> DataFrame:
    """The sections most relevant to a topic."""
    return search.top_by_score(_edges(g, "DISCUSSES_TOPIC"), topic_id, k)


def most_discussed_topics(g: Graph, k: int = 20) -> DataFrame:
    """The topics of most sections, with names."""
    top = search.most_linked(_edges(g, "DISCUSSES_TOPIC"), k)
    return top.join(g.nodes["Topic"].select(F.col("topicId").alias("dst"), "name"), "dst").orderBy(F.desc("n"), "dst")


def embedding_completeness(g: Graph) -> DataFrame:
    """Chunks with and without a vector."""
    return g.nodes["Chunk"].agg(F.count("*").alias("chunks"), F.count_if(F.col("embedding").isNotNull()).alias("embedded"))


def semantic_search(g: Graph, vector: list[float], k: int = 5) -> DataFrame:
    """The chunks nearest a vector."""
    return search.vector_top_k(g.nodes["Chunk"], "chunkId", "embedding", vector, k)


def index_vectors(g: Graph, path: str) -> None:
    """The vector index of all embedded chunks, stored once at ``path``."""
    vector_index.write_index(g.nodes["Chunk"], "chunkId", "embedding", path)


def indexed_semantic_search(g: Graph, path: str, vector: list[float], k: int = 5) -> DataFrame:
    """Like :func:`semantic_search`, from a stored index: about half of the lists are read, and of most vectors their codes only."""
    return vector_index.search(g.edges.sparkSession, path, "chunkId", vector, k)


def keyword_search(g: Graph, query: str, k: int = 10) -> DataFrame:
    """The chunks that fit a query's words best."""
    return search.bm25(g.nodes["Chunk"], "chunkId", "content", query, k)


def related_documents(g: Graph, document_id: str) -> DataFrame:
    """Other documents that cite what a document cites, by number of shared references."""
    chunk_doc = g.nodes["Chunk"].select(F.col("chunkId").alias("src"), "documentId")
    cited = _edges(g, "REFERENCES_LAW").join(chunk_doc, "src").select("documentId", F.col("dst").alias("ref")).distinct()
    own = cited.where(F.col("documentId") == document_id).select("ref")
    return cited.where(F.col("documentId") != document_id).join(own, "ref", "left_semi").groupBy("documentId").agg(F.count("*").alias("shared")).orderBy(F.desc("shared"), "documentId")
