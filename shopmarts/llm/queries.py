"""Registered queries of the training-data operators: each applies its operator,
with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmarts.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


@register
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of at most 4096 tokens."""
    import public_tokenizers

    from shopmarts.llm.packing import pack

    pieces = pack(read_table(spark, sf_dir, "documents"),
                  public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset", "sequence_tokens", "step_id")


@register
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    from shopmarts.llm.simhash import near_duplicates

    return near_duplicates(read_table(spark, sf_dir, "documents"), shingle=4, radius=4)


@register
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both views' and the combined quality score of every document."""
    from shopmarts.llm.quality import fit_quality, quality_scores

    docs = read_table(spark, sf_dir, "documents")
    model = fit_quality(docs, read_table(spark, sf_dir, "labels"))
    return quality_scores(docs, model)


@register
def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document."""
    from shopmarts.llm.secrets import digest, fit_markov, labelled_samples, scan

    docs = read_table(spark, sf_dir, "documents")
    return digest(scan(docs, fit_markov(labelled_samples(docs))))


@register
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    from shopmarts.llm.mixing import mix

    m = mix(read_table(spark, sf_dir, "documents"))
    return m.select("doc_id", "size", "source_size", "target",
                    (F.col("size") * F.col("copies")).alias("taken"), "copies")


@register
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document; shards are equal in bytes."""
    from shopmarts.llm.sharding import shard

    return shard(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@register
def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    from shopmarts.llm.urlfilter import judge

    return judge(read_table(spark, sf_dir, "pages"))


@register
def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector, within its label."""
    from shopmarts.llm.covertree import near_duplicates

    return near_duplicates(read_table(spark, sf_dir, "embeddings"), least=0.93)


@register
def op5_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model score of every document; a tenth is kept from training."""
    from shopmarts.llm.ngramtrie import held_out, lm_scores, train

    docs = read_table(spark, sf_dir, "documents")
    trie = train(docs.filter(~held_out("doc_id")), least_triple=1)
    aside = held_out("doc_id").alias("held_out")
    tokens = F.lit(trie.words.tokens).cast("long").alias("train_tokens")
    return lm_scores(docs, trie).select("doc_id", aside, "n_tokens", "n_known", tokens,
                                        "base_score", "score")


@register
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and perplexity verdict of every document."""
    from shopmarts.llm.perplexity import judge

    out = judge(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", "base_failed", "kept", "perplexity", "lower", "upper")


@register
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 8 whitened components of every vector."""
    from shopmarts.llm.whitening import fit, identity_error, whiten

    vectors = read_table(spark, sf_dir, "embeddings")
    model = fit(vectors, components=8)
    error = identity_error(vectors, model) if model else None
    return whiten(vectors, model).select(
        "vec_id", "component", F.lit(model.n if model else None).cast("long").alias("n"), "deviation",
        "whitened", "explained", F.lit(error).cast("double").alias("identity_error"))


@register
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of two tokenizers' tokens in every document."""
    import public_tokenizers

    from shopmarts.llm.alignment import align

    out = align(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                public_tokenizers.path("piece_bpe_32k.model"))
    return out.withColumnRenamed("groups", "groups_sha256")


@register
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    import public_tokenizers

    from shopmarts.llm.tokencounts import token_counts

    return token_counts(read_table(spark, sf_dir, "documents"),
                        public_tokenizers.path("byte_bpe_50k.json"), limit=512)


# ---------------------------------------------------------------- SQL of the above
# The other queries have none: SQL has no tokenizer (2), XXH64 (3, 6), trained
# classifier or model (1, 4, 5, 7) or ordered filling of a gap (9); their tests
# compare them with brute-force versions.
ORACLES["op8_urls"] = r"""
WITH RECURSIVE p AS (
  SELECT page_id, coalesce(url, '') AS u, coalesce(html, '') AS h FROM pages),
split AS (
  SELECT page_id, u, h,
         CASE WHEN strpos(u, '://') > 0 THEN substr(u, strpos(u, '://') + 3) ELSE '' END AS rest FROM p),
parts AS (
  SELECT page_id, u, h, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(rest, '^([^#]*)', 1) AS node FROM split),
judged AS (
  SELECT *, CASE WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
                 WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
                 WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
                 WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule FROM parts),
links AS (
  SELECT node AS a, regexp_extract(regexp_extract(h, '(?is)<link\b[^>]*rel\s*=\s*["'']?canonical[^>]*>'),
                                   '(?is)href\s*=\s*["'']?[a-z]+://([^"''\s>#]*)', 1) AS b FROM judged),
edges AS (SELECT a, b FROM links WHERE b <> '' UNION SELECT b, a FROM links WHERE b <> ''),
bad AS (
  SELECT node AS n FROM judged WHERE rule IN ('net/', 'example.com/de/')
  UNION SELECT e.b FROM bad JOIN edges e ON e.a = bad.n)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN node IN (SELECT n FROM bad) THEN 'block' ELSE 'allow' END AS verdict,
       rule IS NULL AND node IN (SELECT n FROM bad) AS alias_block
FROM judged"""

ORACLES["op10_embeddings"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (
  SELECT vec_id AS n, vec_id AS m FROM embeddings
  UNION SELECT r.n, l.b FROM reach r JOIN links l ON l.a = r.m),
low AS (SELECT n, min(m) AS component_id FROM reach GROUP BY n),
deg AS (SELECT a, count(*) AS c FROM links GROUP BY a)
SELECT vec_id, coalesce(c, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN low ON n = vec_id LEFT JOIN deg ON a = vec_id"""
