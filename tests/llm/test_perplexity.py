import math
import random
import re
from collections import Counter, defaultdict

import numpy as np

from pyspark.sql import functions as F

from shopmarts.llm import perplexity as P
from shopmarts.llm.ngramtrie import discounts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[k:k + 8]) for k in range(len(words) - 7))
    inside = {j for k in range(len(words) - 7) if windows[tuple(words[k:k + 8])] > 1 for j in range(k, k + 8)}
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), repeated, len(inside))


def brute_model(rows):
    """Modified Kneser-Ney over byte n-grams of words, by dictionaries."""
    counts = defaultdict(Counter)
    for lang, text in rows:
        for w in WORD.findall(text or ""):
            s = bytes([1] * 4) + w.encode() + b"\x02"
            for k in range(4, len(s)):
                counts[lang, 5][s[k - 4:k + 1]] += 1
    for lang in {g for g, _ in list(counts)}:
        for k in (4, 3, 2, 1):
            for gram, c in counts[lang, k + 1].items():
                tail = gram[1:]
                counts[lang, k][tail] += c if tail[0] == 1 else 1
    d = {key: discounts([sum(v == k for v in c.values()) for k in (1, 2, 3, 4)]) for key, c in counts.items()}
    totals, cuts = defaultdict(Counter), defaultdict(Counter)
    for (lang, k), c in counts.items():
        for gram, v in c.items():
            totals[lang, k][gram[:-1]] += v
            cuts[lang, k][gram[:-1]] += d[lang, k][min(v, 3)]

    def p(lang, gram):
        if not gram:
            return 1 / 256
        k, h = len(gram), gram[:-1]
        low, total = p(lang, gram[1:]), totals[lang, k][h]
        if not total:
            return low
        v = counts[lang, k][gram]
        share = (v - d[lang, k][min(v, 3)]) / total if v else 0.0
        return share + cuts[lang, k][h] / total * low

    return p


def corpus():
    rng = random.Random(6)
    syllables = ["ka", "to", "mé", "ri", "sun", "o", "lé"]
    rows = []
    for i in range(120):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(5, 60))]
        text = "\n".join(" ".join(words[k:k + 9]) for k in range(0, len(words), 9))
        rows.append((i, text, rng.choice(["aa", "bb", None])))
    rows += [(200, (rows[0][1] + "\n") * 3, "aa"), (201, None, "aa"), (202, "", None), (203, " \n\t", "bb"),
             (204, "a b c d e f g h " * 5, "aa"), (205, "x\r\nx\r\n#*|<&> y\x0by", "bb"),
             (None, "to ka ri", "aa"), (1, rows[1][1], rows[1][2]), (206, "Q" * 70_000 + " z", "cc")]
    return rows


def test_counts_and_probabilities_equal_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, kept string")
    model = P.fit(df)
    got = P.measures(df, model).collect()
    p = brute_model([(g, t) for _, t, g in rows])
    want = []
    for i, t, g in rows:
        log_p, events = 0.0, 0
        for w in WORD.findall(t or ""):
            s = bytes([1] * 4) + w.encode() + b"\x02"
            log_p += sum(math.log(p(g, s[k - 4:k + 1])) for k in range(4, len(s)))
            events += len(s) - 4
        want.append((str(i), brute_counts(t), events, log_p))
    key = lambda x: (x[0], x[1])
    seen = sorted(((str(r.doc_id), (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words),
                    r.events, r.log_p) for r in got), key=key)
    for a, b in zip(seen, sorted(want, key=key), strict=True):
        assert a[:3] == b[:3] and abs(a[3] - b[3]) <= 1e-5 * max(1, abs(b[3])), (a, b)


def test_backoff_for_unseen_text(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model, p = P.fit(df), brute_model([(g, t) for _, t, g in rows])
    for lang, word in (("aa", "katxri"), ("bb", "zz"), ("cc", "QQ!"), ("aa", "é")):
        s = bytes([1] * 4) + word.encode() + b"\x02"
        grams = np.array([int(P.tagged(np.array([P.lang_code(lang)]), 5)[0])
                          | int.from_bytes(s[k - 4:k + 1], "big") for k in range(4, len(s))])
        want = [math.log(p(lang, s[k - 4:k + 1])) for k in range(4, len(s))]
        assert np.allclose(model.log_p(grams), want, atol=1e-4), word


def test_bands_reject_noise_and_keep_clean_documents(spark):
    rng = random.Random(2)
    clean = [(i, corpus()[i % 110][1] + " " + " ".join(rng.choice(["kato", "sun", "méri"]) for _ in range(40)), "aa")
             for i in range(300)]
    noise = [(1000 + i, " ".join("".join(rng.choice("qxzvwkj0987") for _ in range(6)) for _ in range(40)), "aa")
             for i in range(6)]
    flat = [(2000, " ".join(f"sun{'o' * (k % 3)}" for k in range(40)), "aa")]
    df = spark.createDataFrame(clean + noise + flat, "doc_id long, text string, lang string")
    out = {r.doc_id: r for r in P.judge(df).collect()}
    assert all(out[i].kept == (not out[i].base_failed) for i in range(300))
    assert not any(out[1000 + i].kept for i in range(6))
    assert all(r.kept is False for r in out.values() if r.base_failed)


def test_empty_table_and_null_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert P.judge(empty).collect() == []
    one = spark.createDataFrame([(None, None, None), (1, "a", None)], "doc_id long, text string, lang string")
    assert all(r.base_failed and not r.kept for r in P.judge(one).collect())


def test_bands_reject_labelled_junk_and_monotonous_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rng = random.Random(4)
    flat = " ".join(rng.choice(["the", "and", "of", "to", "in"]) for _ in range(400))
    more = spark.createDataFrame([(-1, flat, "en")], "doc_id long, text string, lang string").select(
        *(F.col(f.name).cast(f.dataType) for f in docs.schema))
    out = P.judge(docs.unionByName(more)).filter("not base_failed")
    one = out.filter("doc_id = -1").collect()[0]
    assert not one.kept and one.perplexity < one.lower
    share = {r.quality: r.s for r in out.join(labels, "doc_id").groupBy("quality").agg(
        F.avg((~F.col("kept")).cast("int")).alias("s")).collect()}
    assert share[0] > 0.25 and share[1] < 0.02, share
