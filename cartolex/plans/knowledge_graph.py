"""The whole path from pages to node and edge tables, and its export; :mod:`cartolex.plans.graph_store` keeps a graph that grows."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartolex.config import EngineConfig
from cartolex.operators import chunks as chunking
from cartolex.operators import embed, graph, link, metadata, references, topics, toc
from cartolex.operators import sections as sectioning
from cartolex.operators.ledger import Ledger
from cartolex.staging import delete, stage

NODE_KEYS = {"Document": "documentId", "TableOfContents": "tocId", "Section": "sectionId", "Chunk": "chunkId", "LegalReference": "referenceId", "Topic": "topicId", "Keyword": "keywordId"}


@dataclass
class Graph:
    """Node tables by label, one table of edges, and the counts of a build (one row; see :func:`counts`)."""

    nodes: dict[str, DataFrame]
    edges: DataFrame
    counts: DataFrame | None = None


def _same_file(left: DataFrame, right: DataFrame, one: list[str], how: str) -> DataFrame:
    """A join on what names a version of a file; a null time equals itself."""
    if len(one) == 1:
        return left.join(right, one, how)
    right = right.withColumnsRenamed({c: f"_{c}" for c in one})
    return left.join(right, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in one]), how)


def structure(pages: DataFrame, config: EngineConfig | None = None, profile: sectioning.HeaderProfile = sectioning.ITALIAN) -> dict[str, DataFrame]:
    """Document, TableOfContents, Section and Chunk records of page records, each staged before the next reads it.

    Files that map to one document key are merged: the last file by name (then path) wins, as a whole; if pages have a time
    ``modified``, the newest version does, and names decide between equal times. ``pages`` is read and grouped once: tables of contents are found while a file's pages
    are in one row, so whole texts are shuffled once.
    """
    config = config or EngineConfig()
    pages = pages if "path" in pages.columns else pages.withColumn("path", F.col("filename"))
    found = stage(metadata.documents(pages, config.as_of_year, toc_of="Circolare"), "files")
    one = ["path", "modified"] if "modified" in pages.columns else ["path"]
    file = F.struct(*one[1:], F.col("metadata")["filename"].alias("filename"), "path")
    last = found.groupBy("documentId").agg(F.max(file).alias("_last"), F.count("*").alias("_n")).where("_n > 1")
    outdone = stage(found.select("documentId", *one, file.alias("_file")).join(last, "documentId").where("_file <> _last").select(*one), "outdone")
    docs = _same_file(found, outdone, one, "left_anti").select(found.columns)  # files that lose their document are few, so whole texts stay where they are
    bounded = docs.select("documentId", "fullText", "toc.startPage", "toc.endPage")
    sections = stage(sectioning.sections(bounded, None, profile, config.lines_per_page), "sections")
    chunks = stage(chunking.chunk_sections(sections, config.chunk_size, config.chunk_overlap), "chunks")
    return {"Document": docs.drop("toc"), "TableOfContents": toc.records(docs), "Section": sections, "Chunk": chunks}


def structural_edges(nodes: dict[str, DataFrame]) -> DataFrame:
    """HAS_TOC, HAS_SECTION, HAS_SUBSECTION, HAS_CHUNK, NEXT_SECTION and NEXT_CHUNK; a section belongs to its document even when it has a parent.

    Records have unique keys and name their successors, so all of it is projections: nothing is sorted or shuffled.
    """
    tocs, sections, chunks = nodes["TableOfContents"], nodes["Section"], nodes["Chunk"]
    parts = [
        ("HAS_TOC", tocs, "documentId", "tocId", None),
        ("HAS_SECTION", sections, "documentId", "sectionId", "order"),
        ("HAS_SUBSECTION", sections, "parentSectionId", "sectionId", "order"),
        ("HAS_CHUNK", chunks, "sectionId", "chunkId", "chunkIndex"),
        ("NEXT_SECTION", sections, "sectionId", "nextSectionId", "order"),
        ("NEXT_CHUNK", chunks, "chunkId", "nextChunkId", "chunkIndex"),
    ]
    return reduce(DataFrame.unionByName, [graph.edges(*p, distinct=False) for p in parts])


def cite(chunks: DataFrame, docs: DataFrame, extractor: references.Extractor = references.rule_extractor, config: EngineConfig | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """References of chunks: their staged occurrences, LegalReference records, and edges REFERENCES_LAW and REFERS_TO. Each chunk that passes the gate meets the extractor once."""
    refs = stage(references.references(chunks, extractor), "references")
    properties = ["type", "citation", "number", "year", "article", "description"]
    nodes = stage(graph.merge_last(refs, ["referenceId"], ["sourceChunkId", "position"], properties).withColumnRenamed("article", "articleNumber"), "legal_references")
    cited = link.categorise(nodes, docs, (config or EngineConfig()).canonical)
    return refs, nodes, graph.edges("REFERENCES_LAW", refs, "sourceChunkId", "referenceId").unionByName(link.refers_to(cited))


def discuss(sections: DataFrame, extractor: topics.Extractor) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """Topics and keywords of sections: their occurrences, Topic and Keyword records, and edges DISCUSSES_TOPIC and DISCUSSES_KEYWORD. Each section meets the extractor once."""
    found = stage(topics.analyses(sections, extractor), "analyses")
    t, k, order = topics.topic_rows(found), topics.keyword_rows(found), ["sectionId", "position"]
    themes = graph.merge_first(t, ["topicId"], order, ["name", "description", "normalizedName"])
    words = graph.merge_first(k, ["keywordId"], order, ["name", "normalizedName"])
    edges = graph.scored_edges("DISCUSSES_TOPIC", t, "sectionId", "topicId", "relevanceScore", ["position"])
    return t, k, themes, words, edges.unionByName(graph.scored_edges("DISCUSSES_KEYWORD", k, "sectionId", "keywordId", "relevanceScore", ["position"]))


def counts(refs: DataFrame, t: DataFrame | None = None, k: DataFrame | None = None, known: Graph | None = None) -> DataFrame:
    """One row: occurrences of references; topics and keywords that ``known`` lacks; and occurrences of both."""
    out = refs.agg(F.count("*").alias("references"))
    for rows, key, label, name in ((t, "topicId", "Topic", "topics"), (k, "keywordId", "Keyword", "keywords")):
        if rows is None:
            out = out.withColumn(f"new_{name}", F.lit(0).cast("long")).withColumn(f"{name}_occurrences", F.lit(0).cast("long"))
            continue
        new = rows.select(key).distinct()
        if known is not None and label in known.nodes:
            new = new.join(known.nodes[label].select(key), key, "left_anti")
        out = out.join(new.agg(F.count("*").alias(f"new_{name}"))).join(rows.agg(F.count("*").alias(f"{name}_occurrences")))
    return out.select("references", "new_topics", "new_keywords", (F.col("topics_occurrences") + F.col("keywords_occurrences")).alias("occurrences"))


def build(pages: DataFrame, config: EngineConfig | None = None, profile: sectioning.HeaderProfile = sectioning.ITALIAN, reference_extractor: references.Extractor = references.rule_extractor, topic_extractor: topics.Extractor | None = None, embedder: embed.Embedder | None = None, known: Graph | None = None, vectors: Ledger | None = None) -> Graph:
    """All node and edge tables of page records. Models left out: rules for references, none for topics and vectors.

    What a model or a heavy step makes is staged once, and nodes and edges both come from there, so they agree
    even where a model wouldn't answer twice alike. ``known`` is an earlier graph, for the counts of what is new; ``vectors`` a ledger of
    the embedder's calls, which later builds share.
    """
    config = config or EngineConfig()
    nodes = structure(pages, config, profile)
    edges = structural_edges(nodes)
    sections, chunks = nodes["Section"], nodes["Chunk"]
    refs, nodes["LegalReference"], more = cite(chunks, nodes["Document"], reference_extractor, config)
    edges = edges.unionByName(more)
    t = k = None
    if topic_extractor is not None:
        t, k, nodes["Topic"], nodes["Keyword"], more = discuss(sections, topic_extractor)
        edges = edges.unionByName(more)
    if embedder is not None:
        children = edges.where("type = 'HAS_SUBSECTION'")
        context = embed.chunk_context(chunks, sections, nodes["Document"], children, config.embed_scope)
        made = embed.embed(context.select("chunkId", embed.enriched_text().alias("enriched")), "chunkId", "enriched", embedder, config.embedding_batch, config.max_concurrent, vectors)
        nodes["Chunk"] = embed.set_embeddings(chunks, stage(made, "vectors"))
    nodes["Document"] = nodes["Document"].drop("path", "modified")
    nodes["Section"], nodes["Chunk"] = sections.drop("nextSectionId"), nodes["Chunk"].drop("nextChunkId")
    return Graph(nodes, edges, counts(refs, t, k, known))


def stored_form(nodes: DataFrame) -> DataFrame:
    """Node records as they are stored: without full texts and dates of publication, maps as JSON."""
    stored = nodes.drop("fullText", "publicationDate")
    return stored.withColumns({name: F.to_json(name) for name, kind in stored.dtypes if kind.startswith("map")})


def write(graph_tables: Graph, target: str, overwrite: bool = False) -> None:
    """All tables under ``target``, or none: they are written beside it and moved there at the end.

    With ``overwrite`` an older graph is moved aside first, moved back if the new one can't take its place, and
    deleted only afterwards, so one whole graph is there at any time but between two renames, and then both are
    beside it. Nodes are in :func:`stored_form`, sorted by their keys
    within files, so that a lookup by key skips row groups; edges are partitioned by type and sorted by source.
    """
    spark = graph_tables.edges.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(target).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(path(target)) and not overwrite:
        raise FileExistsError(target)
    run = uuid.uuid4().hex
    staging, aside = f"{target}.staging-{run}", f"{target}.old-{run}"
    try:
        for label, df in graph_tables.nodes.items():
            stored_form(df).sortWithinPartitions(NODE_KEYS[label]).write.parquet(f"{staging}/nodes/{label}")
        graph_tables.edges.sortWithinPartitions("type", "src").write.partitionBy("type").parquet(f"{staging}/edges")
        moved = fs.exists(path(target)) and fs.rename(path(target), path(aside))
        if not fs.rename(path(staging), path(target)):
            if moved:
                fs.rename(path(aside), path(target))
            raise OSError(f"{target} could not be put in place")
        if moved:
            fs.delete(path(aside), True)
    finally:
        fs.delete(path(staging), True)


def read(spark: SparkSession, target: str) -> Graph:
    """The tables that :func:`write` made."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(target).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    labels = [label for label in NODE_KEYS if fs.exists(path(f"{target}/nodes/{label}"))]
    return Graph({label: spark.read.parquet(f"{target}/nodes/{label}") for label in labels}, spark.read.parquet(f"{target}/edges"))


def clear(spark: SparkSession, target: str, really: bool = False) -> bool:
    """Deletes a graph; only when asked for explicitly."""
    return delete(spark, target) if really else False
