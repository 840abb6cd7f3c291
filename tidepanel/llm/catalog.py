"""The registered queries of this subpackage, and their SQL where SQL can state them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.llm import byte_bpe, filter_audit, licenses, minmax, packing, pivot_topk, prefix_trie, quality, rp_forest, simhash, slot_shards, toxicity, url_filter, vectors
from tidepanel.llm.common import held_out, table
from tidepanel.session import new_path

#: (verdict, host, path)
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


TOXIC_FROM, GOOD_FROM = 0.3, 0.7


def op1_toxicity(spark: SparkSession, root: str) -> DataFrame:
    """Chance that each document is toxic."""
    docs = table(spark, root, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, root, "labels"))
    return _judged(toxicity.score(docs, model), TOXIC_FROM)


def _judged(scored: DataFrame, least: float) -> DataFrame:
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted")
    )


def op2_pivot_topk(spark: SparkSession, root: str) -> DataFrame:
    """The 10 highest integer inner products of every hundredth vector."""
    rows = pivot_topk.quantised(table(spark, root, "embeddings"))
    return pivot_topk.top_k(rows, rows.where("vec_id % 100 = 0"))


OP2_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM pairs
)
SELECT * FROM ranked WHERE rank <= 10
"""


def op3_url_filter(spark: SparkSession, root: str) -> DataFrame:
    """Verdict of every page's URL."""
    pages = table(spark, root, "pages").select("page_id", "url")
    return url_filter.judge(pages, url_filter.rule_table(spark, URL_RULES)).drop("url")


OP3_SQL = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{url_filter.UPPER}', '{url_filter.LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), rules(said, rhost, rpath) AS (VALUES {", ".join(str(r) for r in URL_RULES)})
SELECT page_id, host, path, rhost || rpath AS rule, coalesce(said, 'allow') AS verdict
FROM parts LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC NULLS LAST) = 1
"""


def op4_slot_shards(spark: SparkSession, root: str) -> DataFrame:
    """All documents in 24 shards of nearly equal bytes."""
    placed = slot_shards.shard_records(table(spark, root, "documents"), 24, new_path(spark, "slot-map"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), F.col("vslot").alias("virtual_slot"),
    )


def op5_minmax(spark: SparkSession, root: str) -> DataFrame:
    """Components of near-duplicate documents."""
    return minmax.near_duplicates(table(spark, root, "documents"), words=2)


def op6_pack(spark: SparkSession, root: str) -> DataFrame:
    """All documents in sequences of 2048 tokens."""
    pieces = packing.pack(table(spark, root, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op7_quality(spark: SparkSession, root: str) -> DataFrame:
    """Chance that each document is of good quality."""
    docs = table(spark, root, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, root, "labels"))
    return _judged(quality.score(docs, model), GOOD_FROM)


def op8_byte_bpe(spark: SparkSession, root: str) -> DataFrame:
    """Every text's ids and the bytes they decode to, as digests."""
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    texts = table(spark, root, "documents").select("doc_id", "text")
    ids = byte_bpe.encode(texts, ranks, pattern).drop("text")
    both = byte_bpe.decode(ids, ranks, pattern)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_rp_forest(spark: SparkSession, root: str) -> DataFrame:
    """The 20 nearest of every twentieth vector, by inner product."""
    rows = vectors.usable(table(spark, root, "embeddings"), "vec_id", "embedding", zero=False)
    return rp_forest.nearest(rows, rows.where("vec_id % 20 = 0"))


def op10_licenses(spark: SparkSession, root: str) -> DataFrame:
    """Licence notices of every document."""
    docs = table(spark, root, "documents").select("doc_id", "text")
    return licenses.scan(docs, licenses.fit(docs)).select(
        "doc_id",
        "n_paragraphs",
        F.size("hits").alias("n_hits"),
        F.array_join("licenses", ",").alias("licenses"),
        F.array_max(F.transform("hits", lambda h: h["probability"])).alias("best_probability"),
        F.array_max(F.transform("hits", lambda h: h["similarity"])).alias("best_similarity"),
        "hits",
    )


def op11_prefix_trie(spark: SparkSession, root: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations."""
    return prefix_trie.prefix_trie(table(spark, root, "conversations"))


OP11_SQL = """
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place,
         coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), crc AS (
  SELECT DISTINCT conv_id, xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END))) AS crc FROM t
), c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, crc % 6 AS h FROM crc
), n AS (SELECT conv_id, count(*) AS n FROM t GROUP BY 1
), r AS (
  SELECT c.conv_id, place, role, text FROM c JOIN t ON t.conv_id = c.base AND place < h
  UNION ALL SELECT c.conv_id, place - h + least(h, coalesce(n.n, 0)), role, text
  FROM c JOIN t ON t.conv_id = c.conv_id AND place >= h LEFT JOIN n ON n.conv_id = c.base
), p AS (
  SELECT conv_id, 0 AS depth, '' AS key, 0 AS chars FROM c
  UNION ALL SELECT conv_id, place + 1, string_agg(concat(length(role), ':', role, length(text), ':', text), '') OVER (PARTITION BY conv_id ORDER BY place), length(text) FROM r
), nodes AS (SELECT depth, key, min(conv_id) AS conv_id, count(*) AS n_convs, min(chars) AS chars FROM p GROUP BY 1, 2
), tree AS (
  SELECT n.*, p.key AS parent_key FROM nodes n LEFT JOIN p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1
), kids AS (SELECT parent_key AS key, depth - 1 AS depth, count(*) AS n_children FROM tree WHERE depth > 0 GROUP BY 1, 2
), totals AS (
  SELECT p.depth, p.key, count(*) FILTER (k.key IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.chars) AS saved
  FROM nodes n LEFT JOIN kids k ON k.key = n.key AND k.depth = n.depth JOIN p ON p.conv_id = n.conv_id AND p.depth <= n.depth GROUP BY 1, 2
), ends AS (
  SELECT depth, key, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends_sha256
  FROM (SELECT * FROM p QUALIFY depth = max(depth) OVER (PARTITION BY conv_id)) GROUP BY 1, 2
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children,
       t.n_leaves, CAST(t.saved AS BIGINT) AS saved_tokens, coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM tree n JOIN totals t ON t.key = n.key AND t.depth = n.depth LEFT JOIN kids k ON k.key = n.key AND k.depth = n.depth
LEFT JOIN ends e ON e.key = n.key AND e.depth = n.depth LEFT JOIN nodes up ON up.key = n.parent_key AND up.depth = n.depth - 1
"""


def op12_filter_audit(spark: SparkSession, root: str) -> DataFrame:
    """What five filters remove in each of their 120 orders, for every language."""
    out = filter_audit.audit(table(spark, root, "documents"), table(spark, root, "labels"))
    return out.withColumnsRenamed({"lost_quality": "good_lost", "lost_toxic": "toxic_lost"})


OP12_SQL = """
WITH w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[ \\x09-\\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), f AS (
  SELECT doc_id, part, [len(words) < 100, 100 * len(list_distinct(words)) < 80 * len(words),
         100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t), regexp_matches(t, '[#$%&*|]'),
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS fails FROM w
), l AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY 1
), m AS (
  SELECT part, fails, coalesce(good, false) AS good, coalesce(bad, false) AS bad, count(*) AS n
  FROM f LEFT JOIN l ON l.doc_id = f.doc_id GROUP BY ALL
), k AS (SELECT unnest(range(1, 6)) AS i), o AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS seq FROM k a, k b, k c, k d, k e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
), s AS (SELECT seq, list_aggregate(list_transform(seq, lambda x: substr('ABCDE', x, 1)), 'string_agg', '') AS filter_order, k.i AS step, seq[k.i] AS own FROM o, k),
g AS (
  SELECT part, filter_order, step, own, fails[own] AS failed, len(list_filter(seq[:step - 1], lambda x: fails[x])) > 0 AS earlier,
         len(list_filter(fails, lambda x: x)) AS n_fails, good, bad, n FROM s, m
), r AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, own,
         CAST(coalesce(sum(n) FILTER (NOT failed AND NOT earlier), 0) AS BIGINT) AS kept,
         CAST(coalesce(sum(n) FILTER (failed AND NOT earlier), 0) AS BIGINT) AS removed,
         CAST(coalesce(sum(n) FILTER (failed AND earlier), 0) AS BIGINT) AS redundant,
         CAST(coalesce(sum(n) FILTER (failed AND n_fails = 1), 0) AS BIGINT) AS unique_fails,
         CAST(coalesce(sum(n) FILTER (failed AND NOT earlier AND good), 0) AS BIGINT) AS good_lost,
         CAST(coalesce(sum(n) FILTER (failed AND NOT earlier AND bad), 0) AS BIGINT) AS toxic_lost
  FROM g GROUP BY 1, 2, 3, 4
)
SELECT * EXCLUDE own, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM r
"""


def op13_simhash(spark: SparkSession, root: str) -> DataFrame:
    """Components of documents whose fingerprints differ in at most 3 bits."""
    out = simhash.near_duplicates(table(spark, root, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_pivot_topk": op2_pivot_topk,
    "op3_url_filter": op3_url_filter,
    "op4_slot_shards": op4_slot_shards,
    "op5_minmax": op5_minmax,
    "op6_pack": op6_pack,
    "op7_quality": op7_quality,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_rp_forest": op9_rp_forest,
    "op10_licenses": op10_licenses,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_filter_audit": op12_filter_audit,
    "op13_simhash": op13_simhash,
}

ORACLE = {"op2_pivot_topk": OP2_SQL, "op3_url_filter": OP3_SQL, "op11_prefix_trie": OP11_SQL, "op12_filter_audit": OP12_SQL}
