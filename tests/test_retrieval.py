import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from shopmarts.operators import retrieval as R
from tests.conftest import SF_SMALL

TOK = re.compile(r"[^\w]+|_")


def _tokens(text):
    return [t for t in TOK.split(text.lower()) if t]


def brute_bm25(docs, queries, k):
    """Plain-Python BM25 over line passages (the definition, no pruning)."""
    psg = [(d, i, line) for d, text in docs for i, line in enumerate(text.split("\n"))
           if line.strip(" ")]
    toks = {(d, i): Counter(_tokens(line)) for d, i, line in psg}
    toks = {key: c for key, c in toks.items() if c}
    n = len(toks)
    avgdl = sum(sum(c.values()) for c in toks.values()) / n
    df = Counter(t for c in toks.values() for t in c)
    out = {}
    for qid, text in queries:
        scores = {}
        for t in set(_tokens(text)):
            if t not in df:
                continue
            idf = math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5))
            for key, c in toks.items():
                if t in c:
                    dl = sum(c.values())
                    tf = c[t]
                    scores[key] = scores.get(key, 0) + idf * (tf * 2.2) / (
                        tf + 1.2 * (0.25 + 0.75 * dl / avgdl))
        ranked = sorted(scores.items(), key=lambda kv: (-round(kv[1], 9), kv[0]))[:k]
        out[qid] = [(key, round(s, 6)) for key, s in ranked]
    return out


DOCS = [
    (1, "the cat sat on the mat\nthe dog barked\n\n  \nzebra crossing at night"),
    (2, "the cat sat on the mat\nthe the the the\nÉté chaud à Paris"),
    (3, "a quick brown fox jumps over the lazy dog\nthe cat and the dog"),
    (4, "night zebra night zebra\nthe mat is red"),
    (5, "übermäßig große Straße\nthe end"),
]
QUERIES = [(10, "the cat on the mat"), (11, "zebra at night"), (12, "été à paris"),
           (13, "the"), (14, "große straße"), (15, "nothing matches here")]


def test_bm25_matches_brute_force(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    qs = spark.createDataFrame(QUERIES, "item_id long, text string")
    got = {}
    for r in R.lexical_topk(docs, qs, k=3).orderBy("item_id", "rank_no").collect():
        got.setdefault(r.item_id, []).append(((r.doc_id, r.pos), r.score))
    want = brute_bm25(DOCS, QUERIES, 3)
    want = {q: v for q, v in want.items() if v}
    assert got == want


def _naive(docs, qs, k):
    """Join every query term with every posting (no pruning)."""
    post = R.postings(R.passages(docs))
    lengths = post.select("doc_id", "pos", "dl").distinct()
    n = lengths.agg(F.count(F.lit(1))).scalar()
    avgdl = lengths.agg(F.avg("dl")).scalar()
    post = post.withColumn("tfp", R._tf_part(F.col("tf"), F.col("dl"), avgdl))
    dfs = post.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    q = qs.select("item_id", F.explode(R.tokens_of(F.col("text"))).alias("term")).distinct()
    s = (q.join(post, "term").join(dfs, "term")
         .withColumn("c", (R._idf(F.col("df"), n) * F.col("tfp")).cast(R.SCORE_TYPE))
         .groupBy("item_id", "doc_id", "pos").agg(F.sum("c").alias("s")))
    from pyspark.sql import Window
    w = Window.partitionBy("item_id").orderBy(F.desc("s"), "doc_id", "pos")
    return (s.withColumn("rank_no", F.row_number().over(w)).filter(F.col("rank_no") <= k)
            .select("item_id", "rank_no", "doc_id", "pos",
                    F.round(F.col("s").cast("double"), 6).alias("score")))


def test_maxscore_equals_naive_join_on_driver_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    qs = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    a = sorted(map(tuple, R.lexical_topk(docs, qs, k=5).collect()))
    b = sorted(map(tuple, _naive(docs, qs, 5).collect()))
    assert a == b and len(a) > 0


def test_passages_skip_blank_lines(spark):
    docs = spark.createDataFrame(DOCS[:1], "doc_id long, text string")
    assert [(r.pos, r.passage) for r in R.passages(docs).collect()] == \
        [(0, "the cat sat on the mat"), (1, "the dog barked"), (4, "zebra crossing at night")]


def test_vector_topk_matches_numpy(spark):
    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    pdf = emb.toPandas()
    x = np.stack(pdf.embedding.values).astype(np.float64)
    got = {}
    for r in R.centroid_topk(emb, k=4).collect():
        got.setdefault(r.label, []).append((r.rank_no, r.vec_id))
    for label, grp in pdf.groupby("label"):
        c = np.stack(grp.embedding.values).astype(np.float64).mean(0)
        cos = x @ c / (np.linalg.norm(x, axis=1) * np.linalg.norm(c))
        order = np.lexsort((pdf.vec_id.values, -cos))[:4]
        assert [v for _, v in sorted(got[label])] == list(pdf.vec_id.values[order])


def test_vector_topk_batches(spark):
    corpus = spark.createDataFrame([(i, [float(i % 3), 1.0, float(i % 5)]) for i in range(40)],
                                   "vec_id long, embedding array<float>")
    queries = spark.createDataFrame([(q, [1.0, float(q), 0.5]) for q in range(7)],
                                    "query_id long, vector array<double>")
    one = sorted(map(tuple, R.vector_topk(corpus, queries, 3).collect()))
    many = sorted(map(tuple, R.vector_topk(corpus, queries, 3, block=2, salts=3, sample=4).collect()))
    assert one == many and len(one) == 21


def test_vectors_without_a_cosine_are_left_out(spark):
    corpus = spark.createDataFrame(
        [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [0.5, 0.5]), (5, [])],
        "vec_id long, embedding array<float>")
    queries = spark.createDataFrame([(7, [2.0, 0.0]), (8, [0.0, 0.0]), (9, None)],
                                    "query_id long, vector array<double>")
    got = sorted((r.query_id, r.rank_no, r.vec_id) for r in R.vector_topk(corpus, queries, 3).collect())
    assert got == [(7, 1, 1), (7, 2, 4)]


def test_vector_plan_does_not_grow_with_the_queries(spark):
    corpus = spark.createDataFrame([(1, [1.0, 0.0])], "vec_id long, embedding array<float>")

    def size(n):
        queries = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(n)],
                                        "query_id long, vector array<double>")
        return R.vector_topk(corpus, queries)._jdf.queryExecution().optimizedPlan().toString().count("\n")

    assert size(2) == size(300)


def test_pruning_knobs_never_change_results(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    qs = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    idx = R.LexicalIndex.build(docs)
    want = sorted(map(tuple, _naive(docs, qs, 3).collect()))
    for ratio, seeds, pool in [(1.0, 2000, 4), (0.3, 50, 1), (0.0, 1, 2)]:
        got = sorted(map(tuple, idx.search(qs, 3, split_ratio=ratio, seed_postings=seeds,
                                           seed_pool=pool).collect()))
        assert got == want, (ratio, seeds, pool, push)


def test_index_build_uses_more_tasks_for_more_text(spark, monkeypatch):
    docs = spark.range(300).selectExpr("id AS doc_id", "concat('word ', id, ' of a text') AS text").coalesce(1)
    monkeypatch.setattr(R, "TEXT_PER_TASK", 10)
    assert R.build_tasks(docs) >= 300
    assert R.build_tasks(docs.limit(0)) >= 1


def test_fan_out_sums_bounds_without_decimals_and_reads_passages_once(spark, monkeypatch):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    qs = spark.createDataFrame(QUERIES, "item_id long, text string")
    plans, keep = {}, R.LexicalIndex._keep

    def noted(self, df, name):
        plans[name.split("/")[1]] = df._jdf.queryExecution().optimizedPlan().toString()
        return keep(self, df, name)

    monkeypatch.setattr(R.LexicalIndex, "_keep", noted)
    got = sorted(map(tuple, R.lexical_topk(docs, qs, k=3).collect()))
    assert got == sorted(map(tuple, _naive(docs, qs, 3).collect()))
    assert "decimal" not in plans["survivors"]
    assert "decimal" in plans["topk"]


def test_passages_without_an_id_are_scored_in_full(spark):
    docs = spark.createDataFrame([*DOCS, (None, "the zebra crossing\nthe mat at night"), (None, "a mat")],
                                 "doc_id long, text string")
    qs = spark.createDataFrame(QUERIES, "item_id long, text string")
    want = sorted(map(str, _naive(docs, qs, 4).collect()))
    idx = R.LexicalIndex.build(docs)
    for ratio in (1.0, 0.5, 0.0):
        assert sorted(map(str, idx.search(qs, 4, split_ratio=ratio).collect())) == want, ratio
