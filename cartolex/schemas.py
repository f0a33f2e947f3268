"""Record types of the knowledge graph, as DDL strings."""

from __future__ import annotations

from pyspark.sql.types import StructType

METADATA = "metadata map<string,string>"
PAGES = "filename string, file_size bigint, page_no int, text string"
DOCUMENT = f"documentId string, type string, number string, year int, title string, oggetto string, publicationDate date, url string, pageCount int, fullText string, {METADATA}, fullTextEmbedding array<float>"
TOC = "tocId string, documentId string, rawText string, startPage int, endPage int, hasHeader boolean, headerText string, entryCount int, detectionMethod string"
SECTION = "sectionId string, documentId string, sectionNumber string, title string, content string, sectionType string, level int, pageNumber int, order int, parentSectionId string, embedding array<float>"
CHUNK = f"chunkId string, documentId string, sectionId string, content string, chunkIndex int, pageNumber int, {METADATA}, embedding array<float>"
REFERENCE = "referenceId string, type string, citation string, number string, year string, article string, description string, sourceChunkId string"
RAW_REFERENCES = "array<struct<type:string,number:string,year:string,article:string,citation:string,description:string>>"
TOPIC = "topicId string, name string, description string, normalizedName string, topicEmbedding array<float>"
KEYWORD = "keywordId string, name string, normalizedName string"
RESULT = "success boolean, documentId string, filename string, error string, sections_count int, chunks_count int, processing_time double, toc_extracted boolean, toc_pages int"
ANALYSIS_TOPICS = "array<struct<name:string,description:string,relevance_score:double>>"
ANALYSIS_KEYWORDS = "array<struct<keyword:string,relevance_score:double>>"
EDGE = "type string, src string, dst string, order int, relevanceScore double"


def struct(ddl: str) -> StructType:
    """A DDL string as a schema."""
    return StructType.fromDDL(ddl)
