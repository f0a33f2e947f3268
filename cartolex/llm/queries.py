"""The registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartolex.llm import centroids, embedding_dedup, fim, language, lm_scoring, mixing, near_dedup, nearest, pieces, preference, quality, secrets, url_rules
from cartolex.llm.scratch import cut

#: The vocabulary of the token query: any ``.model`` file with identity normalisation.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id is in fold -1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % n, F.lit(-1))


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.QualityModel:
    """The quality model: vectors from all of ``docs``, the network from labels outside fold 2 of 4."""
    return quality.train(docs, _table(spark, sf_dir, "labels"), fold("doc_id", 4) != 2)


def language_model(docs: DataFrame) -> language.LanguageModel:
    """The language model, from rows outside fold 1 of 3."""
    return language.train(docs, fold("doc_id", 3) != 1)


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at a cosine of 0.95 or more."""
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op2_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations of equal first turns as preference pairs: prompts, completions and masks, digested."""
    found = preference.preferences(_table(spark, sf_dir, "conversations"))
    digest = lambda c: F.md5(F.col(c).cast("binary")).alias(f"{c}_md5")
    trained = lambda c: F.aggregate(f"{c}_mask", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"]).alias(f"{c}_trained")
    return found.select("chosen_id", "rejected_id", "n_prompt_turns", digest("prompt"), digest("chosen"), digest("rejected"), trained("chosen"), trained("rejected"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned outside fold 1 of 3."""
    docs = _table(spark, sf_dir, "documents")
    found = language_model(docs).predict(docs.select("doc_id", "text"))
    return found.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "rejected")


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token ids of every document, and whether they decode to its text."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode(docs, PIECE_MODEL).drop("text")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated sampling probabilities of every document, and which are sampled."""
    measured = cut(mixing.measure(_table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")).drop("text"), "measured")
    found = mixing.calibrate(measured)
    return found.select("doc_id", "mix_topic", "mix_tokens", F.round("mix_prob", 6).alias("mix_prob"), "sampled")


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-entropy difference of every document: labelled good documents against the whole corpus."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    good = _table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return lm_scoring.train(docs, good).score(docs).drop("text")


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest others of every fiftieth embedding."""
    return nearest.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, learned outside fold 2 of 4."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality_model(spark, docs, sf_dir).transform(docs)
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's verdict by rule, or by its aliases."""
    return url_rules.judge(_table(spark, sf_dir, "pages")).drop("component")


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: 5-word shingles, similarity of 0.75 or more."""
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut for fill-in-middle training, and its text rebuilt from the result, as digests."""
    found = fim.transform(_table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    output, form = F.col("fim_output"), F.col("fim_form")
    sizes = [F.col(f"fim_{name}").alias(name) for name in ("n", "form", "prefix_chars", "middle_chars")]
    return found.select("doc_id", *sizes, digest(output).alias("output_sha256"), digest(fim.restored(output, form)).alias("restored_sha256"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """40 clusters of all embeddings after 5 rounds."""
    return centroids.cluster(_table(spark, sf_dir, "embeddings"))


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of every document: counts of the fixed patterns' finds, their digest, and all spans."""
    found = secrets.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    joined = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    of = lambda *kinds: F.filter("secret_spans", lambda x: x["kind"].isin(*kinds))
    base = secrets.KINDS[:3]
    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in base]
    return found.select("doc_id", *counts, F.sha2(joined(of(*base)).cast("binary"), 256).alias("base_sha256"), joined(F.col("secret_spans")).alias("spans"))


QUERIES |= {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_preference": op2_preference,
    "op3_minhash": op3_minhash,
    "op4_language_id": op4_language_id,
    "op5_pieces": op5_pieces,
    "op6_mixing": op6_mixing,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_nearest": op8_nearest,
    "op9_quality": op9_quality,
    "op10_url_rules": op10_url_rules,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_centroids": op12_centroids,
    "op13_secrets": op13_secrets,
}
ORACLES["op1_embedding_dedup"] = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
n AS (SELECT a, count(*) AS n FROM l GROUP BY 1),
r(node, seen) AS (SELECT vec_id, vec_id FROM v UNION SELECT l.b, r.seen FROM r JOIN l ON l.a = r.node),
m AS (SELECT node, min(seen) AS component_id FROM r GROUP BY 1)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, m.component_id, v.vec_id = m.component_id AS kept FROM v JOIN m ON m.node = v.vec_id LEFT JOIN n ON n.a = v.vec_id
"""
ORACLES["op3_minhash"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh FROM w),
n AS (SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles FROM s),
e AS (SELECT doc_id, unnest(sh) AS x FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * n_both >= 75 * (na.n_shingles + nb.n_shingles - n_both)),
u AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(node, seen) AS (SELECT doc_id, doc_id FROM n UNION SELECT u.b, r.seen FROM r JOIN u ON u.a = r.node),
m AS (SELECT node, min(seen) AS component_id FROM r GROUP BY 1)
SELECT n.doc_id, n.n_shingles, m.component_id, n.doc_id = m.component_id AS kept FROM n JOIN m ON m.node = n.doc_id
"""

ORACLES["op2_preference"] = """
WITH c AS (
  SELECT conv_id, list({'role': coalesce(role, 'unknown'), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
k AS (SELECT conv_id, md5(turns[1].role || chr(31) || turns[1].text) AS key FROM c),
n AS (SELECT *, count(*) OVER (PARTITION BY key) AS n FROM k),
s AS (SELECT *, CAST('0x' || substr(md5(CAST(conv_id AS VARCHAR)), 1, 8) AS BIGINT) % CAST(ceil(n / 128) AS BIGINT) AS salt FROM n),
d AS (SELECT *, row_number() OVER w AS k, lead(conv_id) OVER w AS nxt FROM s WINDOW w AS (PARTITION BY key, salt ORDER BY conv_id)),
f AS (SELECT key, conv_id AS chosen_id, nxt AS rejected_id FROM d WHERE k % 2 = 1),
l AS (SELECT *, row_number() OVER w AS k, lead(chosen_id) OVER w AS nxt FROM f WHERE rejected_id IS NULL WINDOW w AS (PARTITION BY key ORDER BY chosen_id)),
p AS (SELECT chosen_id, rejected_id FROM f WHERE rejected_id IS NOT NULL UNION ALL SELECT chosen_id, nxt FROM l WHERE k % 2 = 1),
j AS (SELECT p.*, a.turns AS c, b.turns AS r FROM p JOIN c a ON a.conv_id = p.chosen_id LEFT JOIN c b ON b.conv_id = p.rejected_id),
x AS (SELECT *, CASE WHEN r IS NULL THEN len(c) - 1
  ELSE coalesce(list_min(list_filter(range(1, least(len(c), len(r)) + 1), lambda i: c[i] <> r[i])) - 1, least(len(c), len(r))) END AS n FROM j),
y AS (SELECT chosen_id, rejected_id, n, c[:n] AS p, c[n + 1:] AS ct, CASE WHEN r IS NOT NULL THEN r[n + 1:] END AS rt FROM x)
SELECT chosen_id, rejected_id, CAST(n AS INTEGER) AS n_prompt_turns,
  md5(coalesce(array_to_string(list_transform(p, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)), ''), '')) AS prompt_md5,
  md5(coalesce(array_to_string(list_transform(ct, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)), ''), '')) AS chosen_md5,
  CASE WHEN rt IS NOT NULL THEN md5(coalesce(array_to_string(list_transform(rt, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)), ''), '')) END AS rejected_md5,
  CAST(coalesce(list_sum(list_transform(list_filter(ct, lambda t: t.role = 'assistant'), lambda t: length(t.text) + 8)), 0) AS BIGINT) AS chosen_trained,
  CASE WHEN rt IS NOT NULL THEN CAST(coalesce(list_sum(list_transform(list_filter(rt, lambda t: t.role = 'assistant'), lambda t: length(t.text) + 8)), 0) AS BIGINT) END AS rejected_trained
FROM y
"""


#: Enough rounds for the SQL, which can't stop by itself, to be at the fixed point on the given tables.
SQL_ROUNDS = 24


def _mixing_sql() -> str:
    """The raking rounds, one common table a marginal."""
    dims, steps, last = mixing.DIMENSIONS, [], "w0"
    for k in range(SQL_ROUNDS):
        for d in dims:
            name = f"w{k}_{d}"
            steps.append(f"{name} AS MATERIALIZED (SELECT w.source, w.lang, w.topic, w.tokens, w.weight * coalesce(g.goal / m.m, 0) AS weight FROM {last} w LEFT JOIN (SELECT {d} AS v, sum(weight) AS m FROM {last} GROUP BY 1 HAVING sum(weight) > 0) m ON m.v = w.{d} LEFT JOIN goal_{d} g ON g.v = w.{d})")
            last = name
    topics = " ".join(f"WHEN text LIKE '%{sign}%' THEN '{name}'" for name, sign in mixing.TOPICS.items())
    goals = ", ".join(f"goal_{d} AS (SELECT v, pow(CAST(t AS DOUBLE), {mixing.TEMPER[d]}) / sum(pow(CAST(t AS DOUBLE), {mixing.TEMPER[d]})) OVER () AS goal FROM (SELECT {d} AS v, sum(tokens) AS t FROM cells GROUP BY 1) WHERE t > 0)" for d in dims)
    return rf"""
WITH d AS (SELECT doc_id, coalesce('=' || source, '') AS source, coalesce('=' || lang, '') AS lang,
    CASE WHEN text IS NULL THEN 'none' {topics} ELSE 'prose' END AS topic,
    CAST(coalesce(len(regexp_extract_all(text, '[^ 	-
]+')), 0) AS BIGINT) AS n FROM documents),
cells AS (SELECT source, lang, topic, sum(n) AS tokens FROM d GROUP BY ALL),
{goals},
w0 AS (SELECT *, tokens / (SELECT sum(tokens) FROM cells) AS weight FROM cells),
{", ".join(steps)},
f AS (SELECT *, CASE WHEN tokens > 0 THEN weight * (SELECT sum(tokens) FROM cells) / tokens ELSE 0 END AS factor FROM {last}),
p AS (SELECT *, CASE WHEN tokens > 0 THEN factor / (SELECT max(factor) FROM f) ELSE 1.0 END AS prob FROM f)
SELECT d.doc_id, d.topic AS mix_topic, d.n AS mix_tokens, round(p.prob, 6) AS mix_prob,
  CAST('0x' || substr(md5(coalesce(CAST(d.doc_id AS VARCHAR), 'null') || ':7'), 1, 12) AS BIGINT) / pow(2.0, 48) < p.prob AS sampled
FROM d JOIN p USING (source, lang, topic)
"""


ORACLES["op6_mixing"] = _mixing_sql()

_CASES = lambda value: " ".join(
    f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{value(r)}'" for r in sorted(url_rules.RULES, key=lambda r: (-len(r.name), r.name, r.verdict))
)
_HOST_PATH = r"""translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path"""
_NODE = r"""translate(regexp_extract({0}, '^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || regexp_replace(regexp_replace({0}, '^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)', ''), '(?s)#.*$', '')"""
_ADDRESS = r"""regexp_replace(regexp_replace(regexp_extract(node, '^([^?]*)', 1), '(?i)([^/:])(?:/|/index\.html?|\.html?)$', '\1'), '^http://', 'https://')"""
#: Stated links with all their matches resolved, and one page's addresses, as edges; then components and verdicts.
ORACLES["op10_url_rules"] = rf"""
WITH RECURSIVE tags AS (
  SELECT trim(url) AS u, unnest(list_concat(
    list_transform(list_filter(regexp_extract_all(html, '(?is)<link\b[^>]*'), lambda x: regexp_matches(x, '(?is)\brel\s*=\s*["'']?\s*canonical\b')), lambda x: regexp_extract(x, '(?is)^<link\b[^>]*\bhref\s*=\s*["'']?\s*([^\s"''>]+)', 1)),
    list_transform(list_filter(regexp_extract_all(html, '(?is)<meta\b[^>]*'), lambda x: regexp_matches(x, '(?is)\bhttp-equiv\s*=\s*["'']?\s*refresh\b')), lambda x: regexp_extract(x, '(?is)^<meta\b[^>]*\burl\s*=\s*([^\s"''>]+)', 1)))) AS t
  FROM pages WHERE url IS NOT NULL AND html IS NOT NULL),
base AS (SELECT u, regexp_replace(t, '(?i)&(?:amp|#0*38|#x0*26);', '&', 'g') AS t, regexp_replace(u, '(?s)#.*$', '') AS bare FROM tags WHERE t <> ''),
whole AS (SELECT *, regexp_extract(bare, '^([^:/?#]+://[^/?#]*)', 1) AS head, regexp_extract(bare, '^[^:/?#]+://[^/?#]*([^?#]*)', 1) AS path FROM base),
goes AS (SELECT *, CASE WHEN t LIKE '/%' THEN t WHEN regexp_matches(t, '^[?#]') THEN path || t ELSE '/' || regexp_extract(path, '^/(.*/)?', 1) || t END AS goal FROM whole),
steps AS (SELECT *, string_split(regexp_extract(goal, '^/?([^?#]*)', 1), '/') AS s FROM goes),
walked AS (SELECT *, list_reduce(list_transform(s, lambda x: [x]), lambda done, x: CASE WHEN x = ['..'] THEN done[:greatest(len(done) - 1, 0)] WHEN x = ['.'] THEN done ELSE done || x END, CAST([] AS VARCHAR[])) || CASE WHEN s[-1] IN ('.', '..') THEN [''] ELSE [] END AS kept FROM steps),
ends AS (SELECT u, CASE WHEN t LIKE '//%' THEN regexp_extract(bare, '^([^:/?#]+:)//', 1) || t WHEN regexp_matches(t, '^[^:/?#]+:') THEN t WHEN head <> '' THEN head || CASE WHEN goal LIKE '/%' THEN '/' ELSE '' END || array_to_string(kept, '/') || regexp_extract(goal, '(?s)^[^?#]*(.*)$', 1) ELSE '' END AS v FROM walked),
e AS (SELECT {_NODE.format("u")} AS a, {_NODE.format("trim(v)")} AS b FROM ends WHERE regexp_matches(v, '^[^:/?#]+://')),
own AS (SELECT {_NODE.format("trim(url)")} AS node, html FROM pages WHERE contains(url, '://')),
kept AS (SELECT *, {_ADDRESS} AS plain, list_filter(string_split(regexp_extract(node, '^[^?]*\?(.*)$', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(p, '{url_rules.TRACKING}')) AS q FROM own),
addressed AS (SELECT node, html, plain || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS addr FROM kept),
keyed AS (SELECT node, addr AS key FROM addressed UNION ALL
  SELECT node, md5(regexp_extract(html, '{url_rules.ARTICLE}', 1)) || chr(10) || regexp_extract(addr, '^[^:/?#]+://[^/?]*(.*)$', 1) FROM addressed WHERE regexp_matches(html, '{url_rules.ARTICLE}')),
m AS (SELECT node AS a, min(node) OVER (PARTITION BY key) AS b FROM keyed),
l AS (SELECT a, b FROM e UNION SELECT a, b FROM m),
u AS (SELECT a, b FROM l WHERE a <> b UNION SELECT b, a FROM l WHERE a <> b),
r(node, seen) AS (SELECT a, a FROM u UNION SELECT u.b, r.seen FROM r JOIN u ON u.a = r.node),
c AS (SELECT node, min(seen) AS component FROM r GROUP BY 1),
cv AS (SELECT component, CASE {_CASES(lambda r: r.verdict)} END AS v FROM (SELECT component, {_HOST_PATH} FROM (SELECT component, substr(node, instr(node, '://') + 3) AS rest FROM c))),
w AS (SELECT component, bool_or(v = 'allow') AS allowed, bool_or(v = 'block') AS blocked FROM cv GROUP BY 1),
p AS (SELECT page_id, node, {_HOST_PATH} FROM (SELECT page_id, {_NODE.format("trim(url)")} AS node, coalesce(CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END, '') AS rest FROM pages))
SELECT page_id, host, path, CASE {_CASES(lambda r: r.name)} END AS rule,
  coalesce(CASE {_CASES(lambda r: r.verdict)} END, CASE WHEN allowed THEN 'allow' WHEN blocked THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN c USING (node) LEFT JOIN w USING (component)
"""

ORACLES["op11_fill_in_middle"] = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '(?s)[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
l AS (SELECT *, len(u) AS n, list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(h, i, 8) AS BIGINT)) AS lots FROM t),
c AS (SELECT *, least(lots[1] % (n + 1), lots[2] % (n + 1)) AS low, greatest(lots[1] % (n + 1), lots[2] % (n + 1)) AS high,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR lots[3] % 100 >= 90 THEN 'plain' WHEN lots[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM l),
p AS (SELECT *, coalesce(array_to_string(u[:low], ''), '') AS prefix, coalesce(array_to_string(u[low + 1:high], ''), '') AS middle, coalesce(array_to_string(u[high + 1:], ''), '') AS suffix FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256 FROM p
"""


def _centroids_sql(rounds: int = 5) -> str:
    """The rounds, three common tables each: assignments, floors of means, centroids."""
    assigned = "a{0} AS MATERIALIZED (SELECT rn, arg_min(c, (d, c)) AS c, min(d) AS d FROM (SELECT rn, c, list_sum(list_transform(range(1, 65), lambda i: (v[i] - m[i]) * (v[i] - m[i]))) AS d FROM kept, c{0}) GROUP BY 1)"
    moved = "s{0} AS MATERIALIZED (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS m FROM (SELECT c, i, sum(v[i]) AS s, count(*) AS n FROM a{0} JOIN kept USING (rn), range(1, 65) t(i) GROUP BY 1, 2) GROUP BY 1)"
    centroid = "c{1} AS MATERIALIZED (SELECT c, coalesce(s.m, o.m) AS m FROM c{0} o LEFT JOIN s{0} s USING (c))"
    steps = [x.format(k, k + 1) for k in range(rounds) for x in (assigned, moved, centroid)] + [assigned.format(rounds)]
    return f"""
WITH kept AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS rn, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS c, v AS m FROM (SELECT sha256('2:' || CAST(vec_id AS VARCHAR)) AS h, v FROM kept ORDER BY h LIMIT 40)),
{", ".join(steps)}
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a{rounds} a JOIN kept USING (rn) JOIN c{rounds} c ON c.c = a.c
"""


ORACLES["op12_centroids"] = _centroids_sql()
