"""Batch retrieval over the document corpus (R1-R3).

R1  passages: documents split into line passages (doc_id, pos).
R2  lexical top-k: BM25 over passages for a batch of query texts, exact, with
    MaxScore pruning so that frequent ("hot") terms never fan out.
R3  vector top-k: exact cosine top-k of a bounded query batch against a corpus
    of embeddings, scored in one scan with a per-partition top-k before the
    shuffle.

Scale notes
-----------
* Tokens are produced by ``split`` + ``explode`` (JVM-side).  Document length
  is computed per row before the explode, so no join is needed for it.
* Term statistics (document frequency, the largest per-posting BM25 factor)
  are plain aggregations over the postings of a batch's terms: partial
  aggregation map-side makes a term that sits in a third of all passages cost
  no more than any other, and terms that nobody asks for are not aggregated.
* A naive BM25 join of query terms with postings emits, for every common term,
  all (query, passage) pairs.  Instead, for each query we (1) score passages
  from its rarest terms only, giving a lower bound ``theta`` on its k-th best
  score; (2) set aside a run of low-impact terms whose summed maximal
  contributions stay below a fraction of ``theta`` -- no passage holding only
  those terms can reach the top k; (3) fan out only the remaining terms, drop
  passages whose upper bound stays below ``theta``, and score the survivors in
  full by keyed lookups on the passage.  The result equals brute force
  (MaxScore, Turtle & Flood 1995).  The fraction trades fan-out against lookups.
* Bounds are summed as doubles, with ``MARGIN`` for their rounding; scores are
  summed as DECIMAL, which is slow and needed for the survivors only, so the sum
  does not depend on the order rows arrive in; exact copies of a passage tie
  exactly and are ordered by id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from shopmarts.sources.files import written

TOKEN_SPLIT = r"[^\p{L}\p{N}]+"
K1, B = 1.2, 0.75
SCORE_TYPE = "decimal(20,12)"
MARGIN = 1e-6   # slack on every pruning test: float bounds never drop a true top-k row
# Postings row groups: small enough for bounded writer memory per task (parquet
# buffers a whole row group).
ROW_GROUP_BYTES = 16 << 20
BUILD_FANOUT = 4
TEXT_PER_TASK = 8 << 20   # bytes of text whose postings a build task counts


# ---------------------------------------------------------------- R1 passages
def passages(documents: DataFrame) -> DataFrame:
    """One row per non-blank line of every document: (doc_id, pos, passage)."""
    return (documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "passage"))
            .filter(F.trim("passage") != ""))


# ---------------------------------------------------------------- tokens
def tokens_of(text: Column) -> Column:
    """Lower-cased letter/digit runs of ``text`` as an array (empty runs removed)."""
    return F.filter(F.split(F.lower(text), TOKEN_SPLIT), lambda t: t != "")


def postings(psg: DataFrame) -> DataFrame:
    """(doc_id, pos, dl, term, tf, first) for every distinct term of every passage;
    ``first`` marks the term at token 0, so each passage has exactly one."""
    toks = psg.select("doc_id", "pos", tokens_of(F.col("passage")).alias("toks"))
    return (toks.select("doc_id", "pos", F.size("toks").cast("long").alias("dl"),
                        F.posexplode("toks").alias("at", "term"))
            .groupBy("doc_id", "pos", "dl", "term")
            .agg(F.count(F.lit(1)).alias("tf"), (F.min("at") == 0).alias("first")))


def _tf_part(tf: Column, dl: Column, avgdl: Column) -> Column:
    return (tf * (K1 + 1)) / (tf + K1 * ((1 - B) + B * dl / avgdl))


def _idf(df: Column, n: Column) -> Column:
    return F.log(1 + (n - df + 0.5) / (df + 0.5))


def build_tasks(documents: DataFrame) -> int:
    """Tasks of an index build: BUILD_FANOUT for each input split, and enough that a
    task's postings (counted in memory) come from about TEXT_PER_TASK bytes of text,
    however much text there is and however well its files are compressed."""
    from shopmarts.session import default_parallelism, num_partitions
    spark = documents.sparkSession
    size = documents.agg(F.sum(F.octet_length(F.col("text")).cast("long"))).first()[0] or 0
    return max(default_parallelism(spark), int(spark.conf.get("spark.sql.shuffle.partitions", "200")),
               (num_partitions(documents) or 0) * BUILD_FANOUT, -(-size // TEXT_PER_TASK))


class LexicalIndex:
    """An inverted index of line passages, materialized once and reused.

    ``postings`` (doc_id, pos, term, tf, dl, tfp) is written as a parquet table
    in the shared checkpoint folder: lineage is cut, every query batch reads it
    back with column pruning, and a lost executor only re-reads files.
    """

    def __init__(self, postings: DataFrame, n_passages: int, avgdl: float, path: str):
        self.postings = postings
        self.n_passages, self.avgdl = n_passages, avgdl
        self.path = path

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write a small per-query table next to the index and read it back
        (cuts lineage, so later branches do not recompute it)."""
        p = f"{self.path}/{name}"
        df.write.mode("overwrite").option("parquet.block.size", ROW_GROUP_BYTES).parquet(p)
        return df.sparkSession.read.parquet(p)

    @classmethod
    def build(cls, documents: DataFrame, path: str | None = None) -> "LexicalIndex":
        from shopmarts.session import shared_path
        spark = documents.sparkSession
        path = path or shared_path(spark, "lexical_index", unique=True)
        # All tokens of a passage come from one document row, so hash-partitioning
        # the documents by doc_id satisfies the postings aggregation: the text is
        # shuffled once (fewer bytes than the token rows would be) and the
        # aggregation runs without a shuffle of its own.  It also spreads the
        # tokenizing when the input has few splits (e.g. one large row group).
        documents = documents.repartition(build_tasks(documents), "doc_id")
        # The passage count and total length come with the write (one job):
        # every passage has one ``first`` term, and its tf values sum to dl.
        # Rows stay in the order of their passages: a search sums by passage.
        obs = Observation()
        (postings(passages(documents))
         .observe(obs, F.count_if("first").alias("n"), F.sum("tf").alias("tokens"))
         .drop("first")
         .write.mode("overwrite").option("parquet.block.size", ROW_GROUP_BYTES)
         .parquet(f"{path}/postings0"))
        n_passages, tokens = obs.get["n"], obs.get["tokens"]
        if not n_passages:
            raise ValueError("no passages with terms in the corpus")
        avgdl = tokens / n_passages
        post = spark.read.parquet(f"{path}/postings0")
        post = post.withColumn("tfp", _tf_part(F.col("tf"), F.col("dl"), F.lit(avgdl)))
        return cls(post, n_passages, avgdl, path)

    def search(self, queries: DataFrame, k: int = 5, query_id: str = "item_id",
               query_text: str = "text", seed_postings: int = 2000,
               seed_pool: int = 4, split_ratio: float = 0.5) -> DataFrame:
        """Exact BM25 top-k passages per query: (query_id, rank_no, doc_id, pos, score).

        ``seed_postings``, ``seed_pool`` and ``split_ratio`` (in (0, 1]) only tune
        the work; the result is the same for any value.  A smaller ``split_ratio``
        fans out more terms but lets fewer passages survive to the lookups.
        The postings of the batch's terms are selected in one pass, by a join
        with the written term table; the later steps read only those, with the
        terms as numbers."""
        import uuid
        run_id = f"search_{uuid.uuid4().hex[:10]}"
        # query terms are written first, so the joins below know their (small)
        # size and broadcast them while streaming the postings
        asked = self._keep(
            queries.select(F.col(query_id).alias("qid"),
                           F.explode(tokens_of(F.col(query_text))).alias("term"))
            .distinct(), f"{run_id}/asked")
        terms = self._keep(asked.select("term").distinct()
                           .withColumn("tid", F.monotonically_increasing_id()), f"{run_id}/terms")
        # every join below needs postings of query terms only
        post = self._keep(self.postings.join(terms, "term")
                          .select("doc_id", "pos", "tid", "tfp"), f"{run_id}/postings")
        stats = (post.groupBy("tid").agg(F.count(F.lit(1)).alias("df"), F.max("tfp").alias("max_tfp"))
                 .withColumn("idf", _idf(F.col("df"), F.lit(self.n_passages)))
                 .select("tid", "df", "idf", (F.col("idf") * F.col("max_tfp")).alias("maxc")))
        qterms = self._keep(asked.join(terms, "term").drop("term").join(stats, "tid"),
                            f"{run_id}/qterms")
        key = ["qid", "doc_id", "pos"]
        best = Window.partitionBy("qid").orderBy(F.desc("s"), "doc_id", "pos")

        def bounds(some: DataFrame, out: str) -> DataFrame:
            """Sum of contributions of the terms ``some`` (qid, tid, idf) to every
            passage that has one of them, as doubles: for bounds only."""
            return (some.select("qid", "tid", "idf").join(post, "tid")
                    .groupBy(*key).agg(F.sum(F.col("idf") * F.col("tfp")).alias(out)))

        def exact(pairs: DataFrame) -> DataFrame:
            """The scores ``s`` of the given (qid, doc_id, pos), by keyed lookups of
            the passage; an id may be null."""
            p = pairs.select("qid", F.col("doc_id").alias("d"), F.col("pos").alias("at"))
            return (post.join(p, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("pos") == F.col("at")))
                    .join(qterms.select("qid", "tid", "idf"), ["qid", "tid"])
                    .withColumn("c", (F.col("idf") * F.col("tfp")).cast(SCORE_TYPE))
                    .groupBy(*key).agg(F.sum("c").alias("s")))

        def top(df: DataFrame, n: int) -> DataFrame:
            return df.withColumn("rank_no", F.row_number().over(best)).filter(F.col("rank_no") <= n)

        # (1) theta: the k-th best *exact* score among passages found by the
        #     rarest terms (taken until their postings reach ``seed_postings``).
        rarer = (Window.partitionBy("qid").orderBy("df", "tid")
                 .rowsBetween(Window.unboundedPreceding, -1))
        seeds = (qterms.withColumn("before", F.coalesce(F.sum("df").over(rarer), F.lit(0)))
                 .filter(F.col("before") < seed_postings))
        pool = self._keep(top(bounds(seeds, "s"), k * seed_pool).select(*key), f"{run_id}/pool")
        theta = self._keep(
            top(exact(pool), k).groupBy("qid")
            .agg(F.min("s").cast("double").alias("t"), F.count(F.lit(1)).alias("found"))
            .select("qid", F.when(F.col("found") >= k, F.col("t")).otherwise(0.0)
                    .alias("theta")), f"{run_id}/theta")

        # (2) non-essential terms: the low-impact prefix whose summed maxima < theta
        run = (Window.partitionBy("qid").orderBy("maxc", "tid")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        split = self._keep(
            qterms.withColumn("upto", F.sum("maxc").over(run))
            .join(theta, "qid", "left")
            .withColumn("essential",
                        F.col("upto") + MARGIN
                        >= F.coalesce(F.col("theta"), F.lit(0.0)) * split_ratio),
            f"{run_id}/split")
        ess = split.filter(F.col("essential"))
        non = split.filter(~F.col("essential"))
        bound = (non.groupBy("qid").agg(F.sum("maxc").alias("ne_max"))
                 .join(theta, "qid", "full_outer"))

        # (3) essential terms fan out; drop passages whose upper bound < theta
        surv = self._keep(
            bounds(ess, "es").join(bound, "qid", "left")
            .filter(F.col("es") + F.coalesce(F.col("ne_max"), F.lit(0.0))
                    + MARGIN >= F.coalesce(F.col("theta"), F.lit(0.0)))
            .select(*key), f"{run_id}/survivors")

        # (4) exact scores of the survivors
        result = self._keep(
            top(exact(surv), k).select(F.col("qid").alias(query_id), "rank_no", "doc_id", "pos",
                                 F.round(F.col("s").cast("double"), 6).alias("score")),
            f"{run_id}/topk")
        # the result is written; the per-search tables are no longer needed
        from shopmarts.session import remove_path
        for part in ("asked", "terms", "postings", "qterms", "pool", "theta", "split", "survivors"):
            remove_path(result.sparkSession, f"{self.path}/{run_id}/{part}")
        return result

    def drop(self) -> None:
        """Delete the index files (postings); search results stay."""
        from shopmarts.session import remove_path
        remove_path(self.postings.sparkSession, f"{self.path}/postings0")


def lexical_topk(documents: DataFrame, queries: DataFrame, k: int = 5,
                 query_id: str = "item_id", query_text: str = "text") -> DataFrame:
    """Exact BM25 top-k passages per query: (query_id, rank_no, doc_id, pos, score).

    One-shot: the index is built for this batch and dropped once the (written)
    result exists; build a ``LexicalIndex`` once to serve many batches."""
    index = LexicalIndex.build(documents)
    result = index.search(queries, k, query_id, query_text)
    index.drop()
    return result


def lexical_topk_with_source(documents: DataFrame, queries: DataFrame, k: int = 5,
                             **kw) -> DataFrame:
    """R2 with the answering passage's source and text.

    Only the documents that appear in the top-k are re-read and split (a semi
    join against the small top-k id set, which AQE broadcasts once it has
    measured it), so attaching text never shuffles the whole corpus."""
    top = lexical_topk(documents, queries, k, **kw)
    hits = documents.join(top.select("doc_id").distinct(), "doc_id", "left_semi")
    text = passages(hits.select("doc_id", "text"))
    return (top.join(hits.select("doc_id", "source"), "doc_id")
            .join(text, ["doc_id", "pos"])
            .select(*top.columns, "source", "passage"))


# ---------------------------------------------------------------- R3 vectors
def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def _norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, v: s + v * v))


def label_centroids(embeddings: DataFrame, label: str = "label",
                    vec: str = "embedding") -> DataFrame:
    """Mean vector per label: (label, centroid array<double>).

    Averaged per (label, dimension) with partial aggregation, so a label that
    holds a third of all vectors is combined map-side before the shuffle."""
    per_dim = (embeddings.select(label, F.posexplode(vec).alias("i", "v"))
               .groupBy(label, "i").agg(F.avg(F.col("v").cast("double")).alias("m")))
    return (per_dim.groupBy(label)
            .agg(F.array_sort(F.collect_list(F.struct("i", "m"))).alias("dims"))
            .select(label, F.transform("dims", lambda d: d["m"]).alias("centroid")))


def vector_topk(corpus: DataFrame, queries: DataFrame, k: int = 10, *,
                corpus_id: str = "vec_id", corpus_vec: str = "embedding",
                query_id: str = "query_id", query_vec: str = "vector",
                block: int = 16, salts: int = 64, sample: int = 32) -> DataFrame:
    """Exact cosine top-k of every query against the whole corpus.

    Queries are written as a table of blocks of about ``block`` vectors; each
    corpus row is joined with every block (by block number and a salt that
    spreads a block over ``salts`` keys) and scores a block's queries with
    JVM-side array arithmetic, so plan and driver do not grow with the queries.
    A first pass over one in ``sample`` corpus rows gives each query a score that
    at least k rows reach; the full pass unpacks only scores not below it, which
    loses none of the top k.

    Null, empty and all-zero vectors have no cosine: such corpus rows are never a
    hit and such queries have no rows in the result."""
    qv = F.transform(F.col(query_vec), lambda v: v.cast("double"))
    q = queries.select(F.col(query_id).alias("qid"), qv.alias("q")).withColumn("qn", _norm(F.col("q")))
    q = written(q.filter(F.col("qn") > 0), "vector_queries")
    blocks = max(1, -(-q.count() // block))
    q = q.withColumn("block", F.pmod(F.xxhash64("qid"), F.lit(blocks)).cast("int"))
    x = F.transform(F.col(corpus_vec), lambda v: v.cast("double"))
    rows = (corpus.select(F.col(corpus_id).alias("cid"), x.alias("x"))
            .withColumn("xn", _norm(F.col("x"))).filter(F.col("xn") > 0)
            .withColumn("salt", F.pmod(F.xxhash64("cid", "x"), F.lit(salts)).cast("int")))
    best = Window.partitionBy("qid").orderBy(F.desc("score"), "cid")

    def top(corpus_rows: DataFrame, query_rows: DataFrame) -> DataFrame:
        packed = (query_rows.groupBy("block").agg(F.collect_list(F.struct("qid", "q", "qn", "least")).alias("qs"))
                  .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))))
        each = corpus_rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        scored = each.join(packed, ["block", "salt"])
        scores = F.transform("qs", lambda s: F.struct(
            s["qid"].alias("qid"), (_dot(s["q"], F.col("x")) / (s["qn"] * F.col("xn"))).alias("score"),
            s["least"].alias("least")))
        hits = F.filter(scores, lambda s: s["least"].isNull() | (s["score"] >= s["least"]))
        return (scored.select("cid", F.inline(hits)).select("cid", "qid", "score")
                .withColumn("rank_no", F.row_number().over(best)).filter(F.col("rank_no") <= k))

    some = rows.filter(F.pmod(F.xxhash64(F.lit(1), "cid", "x"), F.lit(sample)) == 0)
    first = top(some, q.withColumn("least", F.lit(None).cast("double")))
    least = (first.groupBy("qid").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("s"))
             .select("qid", F.when(F.col("n") >= k, F.col("s")).alias("least")))
    bounded = written(q.join(least, "qid", "left"), "vector_bounds")
    return top(rows, bounded).select(
        F.col("qid").alias(query_id), "rank_no", F.col("cid").alias(corpus_id),
        F.round("score", 6).alias("score"))


def centroid_topk(embeddings: DataFrame, k: int = 10) -> DataFrame:
    """R3 on the embeddings table: the k vectors nearest to each label's centroid."""
    cents = label_centroids(embeddings).select(F.col("label").alias("query_id"),
                                              F.col("centroid").alias("vector"))
    return vector_topk(embeddings, cents, k).withColumnRenamed("query_id", "label")
