import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from shopmarts.llm import quality as Q
from tests.conftest import SF_SMALL

GOOD = "the results of this study show that the model learns a general rule from few examples".split()


def corpus(n=600, seed=1):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        words = [rng.choice(GOOD) + str(rng.randrange(9)) * (rng.random() < .1) for _ in range(rng.randrange(20, 90))]
        if bad:
            words = [w.upper() + "!!" if i % 8 else w + " |" for w in words]
        source = "spam" if bad and rng.random() < .9 else f"s{rng.randrange(4)}"
        rows.append((i, " ".join(words), "en", source, 100))
        if i % 3:
            labels.append((i, 0 if bad else 1))
    return rows, labels


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_held_out_accuracy_and_both_views(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    model = Q.fit_quality(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    out = {r.doc_id: r for r in Q.quality_scores(docs, model).collect()}
    held = [i for i in range(600) if i % 3 == 0]
    right = lambda f: np.mean([f(out[i]) == (i % 4 != 0) for i in held])
    assert right(lambda r: r.kept) > 0.97
    assert right(lambda r: r.p_text > .5) > 0.95 and right(lambda r: r.p_meta > .5) > 0.9
    # calibrated: the mean score is close to the share of good documents
    assert abs(np.mean([r.score for r in out.values()]) - 0.75) < 0.05


def test_views_teach_each_other(spark):
    rows, labels = corpus(900)
    docs = spark.createDataFrame(rows, SCHEMA)
    few = spark.createDataFrame([x for x in labels if x[0] < 40], "doc_id long, quality int")
    def accuracy(rounds):
        out = Q.quality_scores(docs, Q.fit_quality(docs, few, rounds=rounds)).collect()
        return np.mean([r.kept == (r.doc_id % 4 != 0) for r in out if r.doc_id >= 40])
    alone, both = accuracy(0), accuracy(4)
    assert both >= alone and both > 0.97


class LocalPool:
    """The pool's sums by brute force over arrays."""

    def __init__(self, code, x):
        self.code, self.x = code, x
        self.counts = np.bincount(code, minlength=Q.N_CODES).astype(float)

    def steps(self, w):
        out = np.zeros(Q.BINS)
        for z in Q._logit(self.x, w):
            out[min(Q.BINS - 1, max(0, int(np.floor((z + 20) * 64))))] += 1
        return out

    def by_code(self, history):
        out = np.zeros((Q.N_CODES, 2))
        for code, x in zip(self.code, self.x):
            for w, (hi, lo) in history:
                z = x @ w[:-1] + w[-1]
                if z >= hi or z <= lo:
                    out[code, int(z >= hi)] += 1
                    break
        return out

    def sums(self, w, label, weight):
        g, h = np.zeros(len(w)), np.zeros((len(w), len(w)))
        for code, x in zip(self.code, self.x):
            if (y := label[code]) >= 0:
                x = np.append(x, 1)
                p = 1 / (1 + np.exp(-x @ w))
                g += weight[y] * (p - y) * x
                h += weight[y] * max(p * (1 - p), 1e-4) * np.outer(x, x)
        return g, h


def test_exchange_equals_brute_force_over_the_whole_pool(spark):
    rows, labels = corpus(400)
    docs = spark.createDataFrame(rows, SCHEMA)
    got = Q.fit_quality(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    text = Q.text_features([r[1] for r in rows]).astype(np.float16).astype(float)
    code = Q.meta_codes([r[3] for r in rows], [r[2] for r in rows], [r[4] for r in rows])
    y = np.array([dict(labels).get(i, -1) for i in range(400)])
    known = sorted(np.flatnonzero(y >= 0), key=lambda i: zlib.crc32(str(i).encode()))
    want = Q.co_train(text[known], code[known], y[known], LocalPool(code[y < 0], text[y < 0]))
    assert np.allclose(got.text, want.text, atol=1e-4) and np.allclose(got.meta, want.meta, atol=1e-4)
    assert np.allclose(got.blend, want.blend, atol=1e-3)


def test_all_of_a_pool_takes_part(spark):
    """A source that no label covers is learnt from the pool, wherever its rows are."""
    rows, labels = corpus(6600)
    rare = [(i, ("x | " if i % 2 else "") + t.lower().replace("!!", "") + (" | |" * 40) * (i % 2),
             "en", "rare" if i % 2 else "fine", n) for i, t, _, _, n in rows[6400:]]
    docs = spark.createDataFrame(rows[:6400] + rare, SCHEMA)
    few = spark.createDataFrame([x for x in labels if x[0] < 900], "doc_id long, quality int")
    model, alone = Q.fit_quality(docs, few), Q.fit_quality(docs, few, rounds=0)
    slot = Q.meta_codes(["rare"], ["en"], [100])[0] // (Q.N_LANG * Q.N_LENGTH)
    assert alone.meta[slot] == 0 and model.meta[slot] != 0
    n = Q.Pool(docs.select(F.lit(3).alias("code"), F.lit(b"").alias("t"))).counts
    assert n[3] == 6600 and n.sum() == 6600


def test_clean_driver_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = Q.fit_quality(docs, labels)
    out = Q.quality_scores(docs, model).join(labels, "doc_id")
    share = {r.quality: r.s for r in out.groupBy("quality").agg(
        F.avg(F.col("kept").cast("int")).alias("s")).collect()}
    assert share[1] > 0.98 and share[0] < 0.4
    kept = Q.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == Q.quality_scores(docs, model).filter("kept").count()


def test_nulls_empty_texts_repeats_and_clashing_columns(spark):
    rows, labels = corpus(120)
    odd = [(None, None, None, None, None), (7000, "", "en", None, -5), (7000, "", "en", None, -5),
           (7001, "x" * 3_000_000, None, "s1", 3_000_000), (7002, " \n\n", "de", "s1", 3)]
    docs = spark.createDataFrame(rows + odd, SCHEMA).withColumn("score", F.lit("clash")).withColumn(
        "kept", F.lit(1))
    more = labels + [(None, 1), (1, 0), (1, 1), (2, None)]
    model = Q.fit_quality(docs, spark.createDataFrame(more, "doc_id long, quality int"))
    out = Q.quality_scores(docs, model).collect()
    assert len(out) == 125 and all(0 <= r.score <= 1 for r in out)
    assert set(Q.keep_good(docs, model).columns) == set(docs.columns)


def test_without_labels_everything_has_the_prior(spark):
    docs = spark.createDataFrame(corpus(20)[0], SCHEMA)
    none = spark.createDataFrame([], "doc_id long, quality int")
    out = Q.quality_scores(docs, Q.fit_quality(docs, none)).collect()
    assert {r.score for r in out} == {0.5} and all(r.kept for r in out)
    empty = docs.limit(0)
    assert Q.quality_scores(empty, Q.fit_quality(empty, none)).collect() == []


def test_refit_gives_the_same_model(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    a, b = Q.fit_quality(docs, labels), Q.fit_quality(docs.repartition(5), labels.repartition(3))
    assert np.allclose(a.text, b.text) and np.allclose(a.blend, b.blend)


def test_few_labels_of_a_class_are_learnt_from(spark):
    rows, labels = corpus(300)
    docs = spark.createDataFrame(rows, SCHEMA)
    good, bad = ([x for x in labels if x[1] == c] for c in (1, 0))
    for some in (good + bad[:9], good[:9] + bad):
        model = Q.fit_quality(docs, spark.createDataFrame(some, "doc_id long, quality int"))
        kept = {r.doc_id for r in Q.keep_good(docs, model).collect()}
        right = sum((i in kept) == (i % 4 != 0) for i in range(300))
        assert right > 0.9 * 300
    one = Q.fit_quality(docs, spark.createDataFrame(good + bad[:1], "doc_id long, quality int"))
    assert one.text is not None
    only_bad = Q.fit_quality(docs, spark.createDataFrame(bad, "doc_id long, quality int"))
    assert Q.keep_good(docs, only_bad).count() == 300
