"""URL rules with redirect equivalence; DataFrame operations only.

A url's host and path are matched against rules; the longest that fits decides. Rules are a table of
any size: a url asks for the suffixes of its host, and of those that have rules for the beginnings of its path that are
as long as one of their rules, by equality joins. Urls joined by redirects, canonical links, or because
they are one page's addresses are aliases: their components are found by
:mod:`cartolex.llm.components`, and a url without a rule of its own follows its component: allow if
any alias is explicitly allowed, else block if any is blocked, else allow.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartolex.llm.components import connected_components
from cartolex.llm.scratch import cut

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Query parameters that don't change the page.
TRACKING = r"(?i)^(?:utm_[a-z]+|ref|fbclid|gclid)="
ARTICLE = r"(?is)<article\b[^>]*>(.+?)</article>"
_QUOTED = r"""\s*=\s*["']?\s*"""


@dataclass(frozen=True)
class Rule:
    """``verdict`` (allow or block) for a host with its subdomains, where paths start with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the query (fixed values).
RULES = (Rule("org", "/", "allow"), Rule("example.org", "/es/", "block"), Rule("example.org", "/en/1", "block"), Rule("com", "/fr/", "allow"), Rule("com", "/de/", "block"))


def parts(df: DataFrame, url_col: str) -> DataFrame:
    """``df`` with host (A-Z lower-cased) and path."""
    rest = F.when(F.instr(F.col(url_col), "://") > 0, F.substring(F.col(url_col), F.instr(F.col(url_col), "://") + 3, F.length(F.col(url_col)))).otherwise("")
    with_rest = df.withColumn("_rest", F.coalesce(rest, F.lit("")))
    host = F.translate(F.regexp_extract("_rest", r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return with_rest.withColumn("host", host).withColumn("path", F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1)).drop("_rest")


def rule_table(spark: SparkSession, rules: tuple[Rule, ...] | DataFrame) -> DataFrame:
    """(host, path, verdict) of rules given as such a table or as :class:`Rule` values."""
    if isinstance(rules, DataFrame):
        return rules.select("host", "path", "verdict")
    made = F.array(*[F.struct(F.lit(r.host).alias("host"), F.lit(r.path).alias("path"), F.lit(r.verdict).alias("verdict")) for r in rules])
    return spark.range(1).select(F.explode(made.cast("array<struct<host:string,path:string,verdict:string>>")).alias("r")).select("r.*")


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``(host, path, rule, verdict)`` of each distinct (host, path) of ``urls`` that a rule fits: of the longest, of equals the first by name, then allow.

    Hosts are looked up once each. A host suffix brings the lengths of its rules' paths, of which there are no more than
    a path has signs; a url asks for its beginnings of those lengths.
    """
    named = rules.select(F.col("host").alias("r_host"), F.col("path").alias("r_path"), "verdict", F.concat("host", "path").alias("rule"))
    lengths = named.groupBy("r_host").agg(F.collect_set(F.length("r_path")).alias("lengths"))
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    distinct = urls.select("host", "path").distinct()
    ruled = distinct.select("host").distinct().withColumn("r_host", F.explode(suffixes)).join(lengths, "r_host")
    fitting = F.filter("lengths", lambda n: n <= F.length("path"))
    asked = distinct.join(ruled, "host").select("host", "path", "r_host", F.explode(fitting).alias("n")).select("host", "path", "r_host", F.substring(F.col("path"), F.lit(1), F.col("n")).alias("r_path"))
    found = asked.join(named, ["r_host", "r_path"])
    best = F.min(F.struct((-F.length("rule")).alias("n"), "rule", "verdict"))
    return found.groupBy("host", "path").agg(best.alias("b")).select("host", "path", "b.rule", "b.verdict")


def node(url: Column) -> Column:
    """A url as a node: without its fragment, scheme and host lower-cased."""
    bare = F.regexp_replace(F.trim(url), r"(?s)#.*$", "")
    head = F.regexp_extract(bare, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?]*)", 1)
    return F.concat(F.translate(head, _UPPER, _LOWER), F.substring(bare, F.length(head) + 1, F.length(bare)))


def resolved(target: Column, url: Column) -> Column:
    """A link's target against its page's url, by RFC 3986; a target with a scheme stays as it is."""
    bare = F.regexp_replace(url, r"(?s)#.*$", "")
    head = F.regexp_extract(bare, r"^([^:/?#]+://[^/?#]*)", 1)
    path = F.regexp_extract(bare, r"^[^:/?#]+://[^/?#]*([^?#]*)", 1)
    folder = F.concat(F.lit("/"), F.regexp_extract(path, r"^/(.*/)?", 1))
    to = F.when(target.startswith("/"), target).when(target.rlike(r"^[?#]"), F.concat(path, target)).otherwise(F.concat(folder, target))
    steps = F.split(F.regexp_extract(to, r"^/?([^?#]*)", 1), "/")
    up = lambda done: F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
    kept = F.aggregate(steps, F.array().cast("array<string>"), lambda done, x: F.when(x == "..", up(done)).when(x == ".", done).otherwise(F.concat(done, F.array(x))))
    kept = F.when(F.element_at(steps, -1).isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    walked = F.concat(F.when(to.startswith("/"), "/").otherwise(""), F.array_join(kept, "/"), F.regexp_extract(to, r"(?s)^[^?#]*(.*)$", 1))
    whole = F.when(target.startswith("//"), F.concat(F.regexp_extract(bare, r"^([^:/?#]+:)//", 1), target))
    return whole.when(target.rlike(r"^[^:/?#]+:"), target).when(head != "", F.concat(head, walked)).otherwise("")


def page_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(src, dst)`` nodes of all canonical links and refreshes, after whatever delay, that pages state; relative targets are resolved."""
    link = r"(?is)<link\b(?=[^>]*\brel" + _QUOTED + r"canonical\b)[^>]*\bhref" + _QUOTED + r"([^\s\"'>]+)"
    refresh = r"(?is)<meta\b(?=[^>]*\bhttp-equiv" + _QUOTED + r"refresh\b)[^>]*\burl\s*=\s*([^\s\"'>]+)"
    targets = F.concat(*[F.regexp_extract_all(html_col, F.lit(pattern), 1) for pattern in (link, refresh)])
    stated = pages.where(F.col(html_col).rlike(r"(?i)\bcanonical\b|\bhttp-equiv")).select(F.trim(url_col).alias("u"), F.explode(targets).alias("to"))
    to = resolved(F.regexp_replace("to", r"(?i)&(?:amp|#0*38|#x0*26);", "&"), F.col("u"))
    return stated.where("u is not null and to <> ''").select(node(F.col("u")).alias("src"), node(to).alias("dst")).where(F.col("dst").rlike(r"^[^:/?#]+://"))


def address(url: Column) -> Column:
    """A url's canonical address: without fragment and query parameters that only track visitors, https for http, and a page's name without slash or .html at its end."""
    bare = node(url)
    head, query = F.regexp_extract(bare, r"^([^?]*)", 1), F.regexp_extract(bare, r"^[^?]*\?(.*)$", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    plain = F.regexp_replace(F.regexp_replace(head, r"(?i)(?<=[^/:])(?:/|/index\.html?|\.html?)$", ""), "^http://", "https://")
    return F.when(F.size(kept) > 0, F.concat(plain, F.lit("?"), F.array_join(kept, "&"))).otherwise(plain)


def mirrors(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(src, dst)`` nodes of pages whose canonical addresses differ in nothing, or in their host only while they hold one article.

    Each such group is joined to its smallest node; groups are pre-aggregated, so a page of many addresses costs a task one row.
    """
    at = address(F.col(url_col))
    article = F.md5(F.regexp_extract(html_col, ARTICLE, 1).cast("binary"))
    same_text = F.when(F.col(html_col).rlike(ARTICLE), F.concat_ws("\n", article, F.regexp_extract(at, r"^[^:/?#]+://[^/?]*(.*)$", 1)))
    keyed = pages.where(F.col(url_col).contains("://")).select(node(F.col(url_col)).alias("src"), F.explode(F.array(at, same_text)).alias("key")).where("key is not null")
    keyed = cut(keyed, "addresses")
    least = keyed.groupBy("key").agg(F.min("src").alias("dst"), F.max("src").alias("last")).where("dst <> last").select("key", "dst")
    return keyed.join(least, "key").where("src <> dst").select("src", "dst")


def judge(pages: DataFrame, rules: tuple[Rule, ...] | DataFrame = RULES, redirects: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, host, path, rule, verdict, component)`` for every row of ``pages``.

    ``redirects`` may add a (from_url, to_url) table, ``rules`` may be a table (host, path, verdict). component is the smallest alias, null for a url
    without aliases. A null url, or one without ``://``, has an empty host and path, no rule and no
    aliases, and is allowed. Repeated rows are judged alike, each on its own; a null html states no links.
    """
    edges = page_links(pages, url_col, html_col).union(mirrors(pages, url_col, html_col))
    if redirects is not None:
        edges = edges.union(redirects.where("from_url is not null and to_url is not null").select(node(F.col("from_url")), node(F.col("to_url"))))
    of = cut(parts(connected_components(edges, "src", "dst"), "node"), "alias_components")
    rows = parts(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")), "url").select("page_id", "host", "path", node(F.col("url")).alias("node"))
    rows = cut(rows, "urls")
    fits = cut(matched(rows.select("host", "path").union(of.select("host", "path")), rule_table(pages.sparkSession, rules)), "rule_matches")
    whole = of.join(fits, ["host", "path"]).groupBy("component").agg(F.max(F.col("verdict") == "allow").alias("allowed"), F.max(F.col("verdict") == "block").alias("blocked"))
    known = cut(of.select("node", "component").join(whole, "component", "left"), "alias_verdicts")
    own = fits.withColumnRenamed("verdict", "own")
    out = rows.join(own, ["host", "path"], "left").join(known, "node", "left")
    inherited = F.when(F.coalesce("allowed", F.lit(False)), "allow").when(F.coalesce("blocked", F.lit(False)), "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("own", inherited).alias("verdict"), "component")
