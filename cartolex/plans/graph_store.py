"""A stored graph that grows by ingests: each writes only what it changes, and becomes visible at once.

Rows lie in buckets by the document that owns them; references by their own key, in the bucket of the document that they
would name, so links are found bucket by bucket; topics and keywords by their key. A bucket of a table is a list of folders of Parquet
files that are never changed. A version names the folders of all tables in one small JSON file, so readers see whole
versions only, older versions stay readable, and an ingest ends with the one step of claiming the next version's name.
Whoever claims second merges once more, onto the version that came first: no ingest is lost.

New documents are appended to their buckets; only buckets in which something is replaced (or that hold many folders) are rewritten.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartolex.operators import link
from cartolex.plans.knowledge_graph import NODE_KEYS, Graph, build, stored_form
from cartolex.staging import delete, release, stage

OWNED = ("Document", "TableOfContents", "Section", "Chunk")
SHARED = ("Topic", "Keyword")
#: Edge types by what their source is: the owner itself, or a part of it whose key says so.
FROM_DOCUMENT = ("HAS_TOC", "HAS_SECTION")
SCORED = ("DISCUSSES_TOPIC", "DISCUSSES_KEYWORD")
EDGE_TYPES = (*FROM_DOCUMENT, "HAS_SUBSECTION", "HAS_CHUNK", "NEXT_SECTION", "NEXT_CHUNK", "REFERENCES_LAW", *SCORED)
EDGE_SCHEMA = "src string, dst string, order int, relevanceScore double"
#: Properties by which nodes are looked up, together or the first alone.
INDEXED = {"Document": ("type", "year"), "LegalReference": ("type", "year"), "Topic": ("normalizedName",), "Keyword": ("normalizedName",)}
#: A bucket with this many folders is rewritten as one when something comes to it.
MOST_PARTS = 8
#: Documents for each bucket of a new graph, and the least and most buckets that it gets.
BUCKET_DOCUMENTS, BUCKETS = 500, (16, 4096)


def bucket_of(key: Column, buckets: int) -> Column:
    """The bucket of a document's or reference's key; keys that link to one another share it."""
    return F.pmod(F.xxhash64(link.canonical_document_id(key, "strict")), F.lit(buckets)).cast("int")


def owner_of(kind: Column, src: Column) -> Column:
    """The document that an edge belongs to."""
    return F.when(kind.isin(*FROM_DOCUMENT), src).otherwise(F.regexp_replace(src, r"_SEC_\d+(?:_CHK_\d+)?$", ""))


def _version(metadata: str) -> Column:
    """What orders the versions of a document: time, then name and path of the file. One without a time is older than all that have one."""
    part = lambda name: F.get_json_object(metadata, f"$.{name}").alias(name)
    return F.struct(part("modified").cast("long").alias("modified"), part("filename"), part("path"))


@dataclass
class Snapshot:
    """One version of a stored graph: the folders of each bucket of each table, and each table's schema."""

    spark: SparkSession
    target: str
    version: int = 0
    buckets: int = 0
    canonical: str = "reference"
    schemas: dict[str, str] = field(default_factory=dict)
    parts: dict[str, dict[int, list[str]]] = field(default_factory=dict)

    def folders(self, table: str, buckets: set[int] | None = None) -> list[str]:
        """The folders of some buckets of a table, or of all."""
        own = self.parts.get(table, {})
        return [f for b in sorted(own if buckets is None else buckets & own.keys()) for f in own[b]]

    def table(self, table: str, buckets: set[int] | None = None) -> DataFrame:
        """The rows of some buckets of a table, or of all; other buckets' files aren't opened."""
        schema = T.StructType.fromJson(json.loads(self.schemas[table]))
        found = self.folders(table, buckets)
        if not found:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.target}/data/{f}" for f in found])

    def to_json(self) -> str:
        return json.dumps({"version": self.version, "buckets": self.buckets, "canonical": self.canonical, "schemas": self.schemas, "parts": self.parts})

    def graph(self) -> Graph:
        """All tables; a filter on an edge's type leaves the files of other types unread."""
        nodes = {label: self.table(label) for label in NODE_KEYS if label in self.schemas}
        typed = [self.table(f"edges/{kind}").select(F.lit(kind).alias("type"), "*") for kind in (*EDGE_TYPES, "REFERS_TO") if self.folders(f"edges/{kind}")]
        none = self.spark.createDataFrame([], "type string, " + EDGE_SCHEMA)
        return Graph(nodes, reduce(DataFrame.unionByName, typed or [none]))


def _fs(spark: SparkSession, target: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return path(target).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def versions(spark: SparkSession, target: str) -> list[int]:
    """The numbers of the versions that can be read, in order."""
    fs, path = _fs(spark, target)
    if not fs.exists(path(f"{target}/versions")):
        return []
    names = [x.getPath().getName() for x in fs.listStatus(path(f"{target}/versions"))]
    return sorted(int(n[1:-5]) for n in names if re.fullmatch(r"v\d+\.json", n))


def snapshot(spark: SparkSession, target: str, version: int | None = None) -> Snapshot | None:
    """A version of a stored graph (the last one by default); None where there is none yet."""
    known = versions(spark, target)
    if version is None and not known:
        return None
    x = json.loads(spark.read.text(f"{target}/versions/v{known[-1] if version is None else version:09d}.json", wholetext=True).first()[0])
    return Snapshot(spark, target, x["version"], x["buckets"], x["canonical"], x["schemas"], {t: {int(b): p for b, p in own.items()} for t, own in x["parts"].items()})


def read(spark: SparkSession, target: str, version: int | None = None) -> Graph:
    """A version's tables as a graph (the last one by default)."""
    found = snapshot(spark, target, version)
    if found is None:
        raise FileNotFoundError(target)
    return found.graph()


def lookup(spark: SparkSession, target: str, label: str, version: int | None = None, **values) -> DataFrame:
    """The nodes of a label with certain values of its :data:`INDEXED` properties; only buckets that hold one are read.

    The property table names the buckets; it keeps what a node once was, so the nodes themselves are compared too. A value of None asks for null.
    """
    found = snapshot(spark, target, version)
    if found is None:
        raise FileNotFoundError(target)
    if unknown := set(values) - set(INDEXED.get(label, ())):
        raise ValueError(f"{label} isn't looked up by {', '.join(sorted(unknown))}")
    if f"property/{label}" not in found.schemas:
        return found.table(label) if label in found.schemas else spark.createDataFrame([], f"{NODE_KEYS[label]} string")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in values.items()], F.lit(True))
    homes = {r[0] for r in found.table(f"property/{label}").where(same).select("_bucket").distinct().collect()}  # at most as many as there are buckets
    return found.table(label, homes).where(same)


def _claim(made: Snapshot) -> bool:
    """Make a version visible, whole; False if its number is taken.

    On HDFS and file systems like it, renaming a file onto another fails; on a local one a hard link does.
    """
    fs, path = _fs(made.spark, made.target)
    jvm = made.spark.sparkContext._jvm
    fs.mkdirs(path(f"{made.target}/versions"))
    draft, name = path(f"{made.target}/versions/.{uuid.uuid4().hex}"), path(f"{made.target}/versions/v{made.version:09d}.json")
    out = fs.create(draft, False)
    out.write(bytearray(made.to_json().encode()))
    out.close()
    try:
        if fs.getUri().getScheme() != "file":
            return fs.rename(draft, name)
        local = lambda p: jvm.java.nio.file.Paths.get(p.toUri().getPath(), made.spark.sparkContext._gateway.new_array(jvm.java.lang.String, 0))
        try:
            jvm.java.nio.file.Files.createLink(local(name), local(draft))
        except Exception as e:
            if "FileAlreadyExists" in str(e):
                return False
            raise
        return True
    finally:
        fs.delete(draft, False)


def _buckets(rows: DataFrame) -> set[int]:
    """The buckets of some rows; at most as many as a graph has."""
    return {r[0] for r in rows.select("_bucket").distinct().collect()}


def _save(rows: DataFrame, folder: str, by: list[str], order: list[str]) -> dict[tuple[str, ...], str]:
    """Writes rows to a folder for each value of ``by``, one file each, sorted; returns the folders, by those values."""
    spark = rows.sparkSession
    rows.repartition(*by).sortWithinPartitions(*by, *order).write.partitionBy(*by).parquet(folder)
    fs, path = _fs(spark, folder)
    found, level = {}, [((), folder)]
    while level:
        values, at = level.pop()
        for x in fs.listStatus(path(at)):
            name = x.getPath().getName()
            if "=" in name and x.isDirectory():
                key = (*values, name.split("=", 1)[1])
                (found.__setitem__ if len(key) == len(by) else lambda k, v: level.append((k, v)))(key, f"{at}/{name}")
    return found


class _Merge:
    """One attempt to put new tables upon a version."""

    def __init__(self, base: Snapshot, new: Graph, keep_stale: bool, newest: bool = False) -> None:
        self.base, self.new, self.keep_stale = base, Graph(dict(new.nodes), new.edges), keep_stale
        self.newest = newest
        self.run = uuid.uuid4().hex
        self.made = Snapshot(base.spark, base.target, base.version + 1, base.buckets, base.canonical, dict(base.schemas), {t: dict(p) for t, p in base.parts.items()})

    def _rewritten(self, table: str, touched: set[int], dirty: set[int]) -> set[int]:
        return dirty | {b for b in touched if len(self.base.parts.get(table, {}).get(b, ())) >= MOST_PARTS}

    def _old(self, table: str, buckets: set[int], like: DataFrame) -> DataFrame:
        return self.base.table(table, buckets) if table in self.base.schemas else like.limit(0)

    def _place(self, table: str, schema: T.StructType, folders: dict[int, str], rewritten: set[int]) -> None:
        """The next version's folders of a table: new ones in place of rewritten buckets' old ones, else after them."""
        self.made.schemas[table] = schema.json()
        own = self.made.parts.setdefault(table, {})
        for b in rewritten:
            own.pop(b, None)
        for b, folder in folders.items():
            own[b] = [*own.get(b, []), folder.removeprefix(f"{self.base.target}/data/")]

    def _store(self, table: str, rows: DataFrame, rewritten: set[int]) -> None:
        folder = f"{self.base.target}/data/{self.run}/{table}"
        found = _save(rows, folder, ["_bucket"], [NODE_KEYS[table]])
        self._place(table, rows.drop("_bucket").schema, {int(b): f for (b,), f in found.items()}, rewritten)

    def _index(self, label: str, rows: DataFrame) -> None:
        """Adds rows (with their buckets) to the label's property table: files of ranges of (properties, key), so a frequent value fills several."""
        table, by = f"property/{label}", [*INDEXED[label], NODE_KEYS[label]]
        made, own = rows.select(*by, "_bucket"), self.made.parts.setdefault(table, {0: []})
        if len(own[0]) >= MOST_PARTS:
            made, own[0] = made.unionByName(self.base.table(table)).distinct(), []
        folder = f"{self.run}/{table}"
        made.repartitionByRange(*by).sortWithinPartitions(*by).write.parquet(f"{self.base.target}/data/{folder}")
        own[0] = [*own[0], folder]
        self.made.schemas[table] = made.schema.json()

    def _leave_late(self) -> None:
        """Takes out documents that come too late: the graph has their version, or a newer one. References that only they cite go with them."""
        new = self.new.nodes["Document"].select("documentId", bucket_of(F.col("documentId"), self.base.buckets).alias("_bucket"), _version("metadata").alias("_new"))
        if "Document" not in self.base.schemas:
            return
        old = self.base.table("Document", _buckets(new)).select("documentId", _version("metadata").alias("_old"))
        late = stage(new.join(old, "documentId").where("_new <= _old").select("documentId"), "late")
        if late.isEmpty():
            return
        for label in OWNED:
            if label in self.new.nodes:
                self.new.nodes[label] = self.new.nodes[label].join(late, "documentId", "left_anti")
        columns = self.new.edges.columns
        self.new.edges = self.new.edges.withColumn("documentId", owner_of(F.col("type"), F.col("src"))).join(late, "documentId", "left_anti").select(columns)
        cited = self.new.edges.where("type = 'REFERENCES_LAW'").select(F.col("dst").alias("referenceId"))
        self.new.nodes["LegalReference"] = self.new.nodes["LegalReference"].join(cited, "referenceId", "left_semi")

    def owned(self) -> None:
        """Documents with all that is theirs: what was there of one that comes again goes, unless stale rows are kept."""
        n = self.base.buckets
        docs = self.new.nodes["Document"].select("documentId", bucket_of(F.col("documentId"), n).alias("_bucket"))
        self.touched = _buckets(docs)
        known = self._old("Document", self.touched, docs).select("documentId")
        again = stage(docs.join(known, "documentId", "left_semi"), "again")
        dirty, again = _buckets(again), again.select("documentId")
        self.dirty, self.again = dirty, again
        for label in OWNED:
            new = self.new.nodes.get(label)
            if new is None:
                continue
            rewritten = self._rewritten(label, self.touched, dirty)
            old = self._old(label, rewritten, new)
            kept = old.join(new.select(NODE_KEYS[label]), NODE_KEYS[label], "left_anti") if self.keep_stale else old.join(again, "documentId", "left_anti")
            rows = new.unionByName(kept, allowMissingColumns=True)
            self._store(label, rows.withColumn("_bucket", bucket_of(F.col("documentId"), n)), rewritten)
            if label in INDEXED:
                self._index(label, new.withColumn("_bucket", bucket_of(F.col("documentId"), n)))
        self._edges(again, dirty)

    def _edges(self, again: DataFrame, dirty: set[int]) -> None:
        n, own = self.base.buckets, owner_of(F.col("type"), F.col("src"))
        kinds = [k for k in EDGE_TYPES if k not in SCORED or "Topic" in self.new.nodes]
        rewritten = {k: self._rewritten(f"edges/{k}", self.touched, dirty) for k in kinds}
        new = self.new.edges.where(F.col("type").isin(*kinds))
        old = [self.base.table(f"edges/{k}", rewritten[k]).select(F.lit(k).alias("type"), "*") for k in kinds if self.base.folders(f"edges/{k}", rewritten[k])]
        rows = new
        if old:
            kept = reduce(DataFrame.unionByName, old)
            if self.keep_stale:
                last = kept.withColumn("_age", F.lit(0)).unionByName(new.withColumn("_age", F.lit(1)))
                rows = last.groupBy("type", "src", "dst", "order").agg(F.max_by("relevanceScore", "_age").alias("relevanceScore"))
            else:
                owned = kept.withColumn("documentId", own).join(again, "documentId", "left_anti")
                rows = new.unionByName(owned.select(*new.columns))
        folder = f"{self.base.target}/data/{self.run}/edges"
        found = _save(rows.withColumn("_bucket", bucket_of(own, n)), folder, ["type", "_bucket"], ["src", "dst"])
        schema = self.base.spark.createDataFrame([], EDGE_SCHEMA).schema
        for kind in kinds:
            self._place(f"edges/{kind}", schema, {int(b): f for (k, b), f in found.items() if k == kind}, rewritten[kind])

    def _uncited(self) -> DataFrame | None:
        """(referenceId, _bucket) of references that only replaced text cited; other documents' citations are read only if there may be one."""
        if self.keep_stale or not self.dirty:
            return None
        table, own = "edges/REFERENCES_LAW", owner_of(F.lit("REFERENCES_LAW"), F.col("src"))
        cited = lambda edges: edges.select(F.col("dst").alias("referenceId"))
        was = cited(self.base.table(table, self.dirty).withColumn("documentId", own).join(self.again, "documentId", "left_semi")).distinct()
        lost = stage(was.join(cited(self.new.edges.where("type = 'REFERENCES_LAW'")), "referenceId", "left_anti"), "lost")
        if lost.isEmpty():
            return None
        return stage(lost.join(cited(self.made.table(table)), "referenceId", "left_anti").withColumn("_bucket", bucket_of(F.col("referenceId"), self.base.buckets)), "uncited")

    def shared(self) -> None:
        """Topics and keywords stay as they were written first; a reference's last record wins, and it goes when nothing cites it any more."""
        n = self.base.buckets
        for label in SHARED:
            if (new := self.new.nodes.get(label)) is None:
                continue
            key = NODE_KEYS[label]
            new = new.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(n)).cast("int"))
            touched = _buckets(new)
            rewritten = self._rewritten(label, touched, set())
            fresh = new.join(self._old(label, touched, new).select(key), key, "left_anti")
            old = self._old(label, rewritten, new.drop("_bucket")).withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(n)).cast("int"))
            self._store(label, fresh.unionByName(old, allowMissingColumns=True), rewritten)
            self._index(label, fresh)
        key = F.col("referenceId")
        new = self.new.nodes["LegalReference"].withColumn("_bucket", bucket_of(key, n))
        uncited = self._uncited()
        emptied = set() if uncited is None else _buckets(uncited)
        touched = _buckets(new) | emptied
        old = self._old("LegalReference", touched, new.drop("_bucket")).withColumn("_bucket", bucket_of(key, n))
        a, b = new.alias("a"), old.alias("b")
        same = reduce(lambda x, y: x & y, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in new.columns])
        changed = stage(a.join(b, same, "left_anti"), "changed")
        dirty = _buckets(changed.join(old.select("referenceId"), "referenceId", "left_semi")) | emptied
        rewritten = self._rewritten("LegalReference", _buckets(changed), dirty)
        kept = old.where(F.col("_bucket").isin(*rewritten)) if rewritten else old.limit(0)
        if uncited is not None:
            kept = kept.join(uncited.select("referenceId"), "referenceId", "left_anti")
        self._store("LegalReference", changed.unionByName(kept.join(changed.select("referenceId"), "referenceId", "left_anti"), allowMissingColumns=True), rewritten)
        self._index("LegalReference", changed)
        self.linked = _buckets(changed) | emptied
        release(changed)

    def links(self) -> None:
        """References to documents, anew in the buckets to which documents or references came."""
        buckets = self.touched | self.linked
        refs = self.made.table("LegalReference", buckets).select("referenceId")
        docs = self.made.table("Document", buckets).select("documentId")
        edges = link.refers_to(link.categorise(refs, docs, self.base.canonical)).drop("type").withColumn("_bucket", bucket_of(F.col("dst"), self.base.buckets))
        found = _save(edges, f"{self.base.target}/data/{self.run}/links", ["_bucket"], ["src"])
        self._place("edges/REFERS_TO", edges.drop("_bucket").schema, {int(b): f for (b,), f in found.items()}, buckets)

    def attempt(self) -> bool:
        """Write what changes and claim the next version; what was written goes if that fails."""
        done = False
        try:
            if self.newest:
                self._leave_late()
            self.owned()
            self.shared()
            self.links()
            done = _claim(self.made)
        finally:
            if not done:
                delete(self.base.spark, f"{self.base.target}/data/{self.run}")
        return done


def ingest(pages: DataFrame, target: str, keep_stale: bool = False, buckets: int | None = None, canonical: str = "reference", newest: bool = False, **models) -> DataFrame:
    """Build ``pages`` and merge them into the graph at ``target``, or make it; returns one row of counts, as of the version that was there first.

    Of a document that comes again, all that was its goes with its old edges (those to topics only if topics are extracted now), and so do references that nothing
    else cites; ``keep_stale`` keeps what isn't written anew. With ``newest``, pages have a time ``modified``, and a document of which the graph holds this version
    or a newer one is left out, so ingests may come late, again and in any order. References are linked over all documents. ``models`` go to
    :func:`cartolex.plans.knowledge_graph.build`, which runs once however often the merge has to be repeated. A new graph has
    ``buckets`` buckets, by default one for 500 documents within 16 to 4096, and the ``canonical`` mode of links; later ingests keep both.
    """
    spark = pages.sparkSession
    first = snapshot(spark, target)
    known = Graph({label: first.table(label) for label in SHARED if label in first.schemas}, None) if first else None
    new = build(pages, known=known, **models)
    new.nodes = {label: stored_form(df) for label, df in new.nodes.items()}
    report = stage(new.counts, "counts")
    for label in ("LegalReference", *SHARED):
        if label in new.nodes:
            new.nodes[label] = stage(new.nodes[label], label)
    if first is None and buckets is None:
        low, high = BUCKETS
        buckets = min(high, max(low, 1 << max(0, new.nodes["Document"].count() // BUCKET_DOCUMENTS).bit_length()))
    while True:
        base = snapshot(spark, target) or Snapshot(spark, target, 0, buckets or BUCKETS[0], canonical)
        if _Merge(base, new, keep_stale, newest).attempt():
            return report


def vacuum(spark: SparkSession, target: str, keep: int = 2) -> int:
    """Deletes versions but the last ``keep``, and the folders that only they name; returns how many folders. What an unfinished ingest wrote is left alone."""
    old = versions(spark, target)[: -max(1, keep)]
    kept = {f for v in versions(spark, target)[-max(1, keep) :] for own in snapshot(spark, target, v).parts.values() for b in own.values() for f in b}
    gone = {f for v in old for own in snapshot(spark, target, v).parts.values() for b in own.values() for f in b} - kept
    for folder in gone:
        delete(spark, f"{target}/data/{folder}")
    for v in old:
        delete(spark, f"{target}/versions/v{v:09d}.json")
    return len(gone)
