import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from shopmarts.llm import ngramtrie as N
from shopmarts.llm.arrayfiles import read_arrays, write_arrays
from shopmarts.llm.eliasfano import EliasFano, _place
from shopmarts.llm.wordblocks import SPACES, hashed_blocks, word_lists


@pytest.mark.parametrize("n,u", [(0, 1), (1, 1), (1, 10 ** 12), (1000, 1000), (1000, 10 ** 9),
                                 (5000, 3000), (64, 320), (3000, 2 ** 50)])
def test_elias_fano_access_and_find(n, u):
    rng = np.random.default_rng(n)
    v = np.sort(rng.integers(0, u, n).astype(np.uint64))
    e = EliasFano(EliasFano.encode(v))
    assert (e.access(np.arange(n)) == v).all()
    q = np.concatenate([v, rng.integers(0, 2 * u, 500).astype(np.uint64)])
    at = {int(x): k for k, x in reversed(list(enumerate(v.tolist())))}
    assert e.find(q).tolist() == [at.get(int(x), -1) for x in q]


def test_word_hashes_follow_words_over_any_piece_size():
    rng = random.Random(2)
    texts = [None, "", " \t\n", "é A\x0bb\x0cc\rd", "x" * 300,
             *("".join(rng.choice("aAbé \n\t") for _ in range(rng.randrange(200))) for _ in range(60))]
    flat = [[w for ws in word_lists(t) for w in ws] for t in texts]
    assert flat == [(t or "").encode().lower().split() for t in texts]
    seen = {}
    for limit in (16, 1 << 20):
        got = [[] for _ in texts]
        for _, of, words in hashed_blocks(texts, limit=limit):
            for k, h in zip(of, words.hash):
                got[k].append(int(h))
        for ws, hs in zip(flat, got):
            assert len(ws) == len(hs)
            for w, h in zip(ws, hs):
                assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen) and set(SPACES) == set(b" \t\n\x0b\x0c\r")


def test_array_files(tmp_path):
    arrays = {"a": np.arange(5, dtype=np.uint16), "b": np.empty(0), "c": np.array([2 ** 63], np.uint64)}
    write_arrays(f"file://{tmp_path}/x", "f-1", arrays)
    got = read_arrays(f"file://{tmp_path}/x", "f-1")
    assert all((got[k] == a).all() and got[k].dtype == a.dtype for k, a in arrays.items())


def corpus():
    rng = random.Random(8)
    words = [f"W{int(rng.paretovariate(0.8))}" for _ in range(3000)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 80)))) for i in range(250)]
    rows += [(1000 + i, rows[i % 5][1]) for i in range(20)]
    return rows + [(None, "W1 W2"), (7, None), (8, ""), (9, " \n"), (7, rows[7][1]), (7, rows[7][1]),
                   (400, "W1 W1 " * 20_000)]


def brute(rows, least=2):
    """Scores by dictionaries; the same formula."""
    def seq(t):
        return ["<s>", *(t or "").encode().lower().split(), "</s>"]

    aside = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 10 == 0
    uni, bi, tri, n_docs = Counter(), Counter(), Counter(), 0
    for i, t in rows:
        if not aside(i):
            s = seq(t)
            n_docs += 1
            uni.update(s[1:])
            bi.update(zip(s, s[1:]))
            tri.update(zip(s, s[1:], s[2:]))
    tri = Counter({k: c for k, c in tri.items() if bi[k[:2]] >= least and bi[k[1:]] >= least})
    d2, d3 = (N.discounts([sum(c == k for c in x.values()) for k in (1, 2, 3, 4)]) for x in (bi, tri))
    tri = Counter({k: c for k, c in tri.items() if c >= least})
    total, size = sum(uni.values()), len(uni)
    ctx, kept2, kept3 = Counter(uni), Counter(), Counter()
    ctx["<s>"] = n_docs
    for k, c in bi.items():
        kept2[k[0]] += c - d2[min(c, 3)]
    for k, c in tri.items():
        kept3[k[:2]] += c - d3[min(c, 3)]
    out = []
    for i, t in rows:
        s, base, score = seq(t), 0.0, 0.0
        for k in range(1, len(s)):
            b = (uni[s[k]] + 0.1) / (total + 0.1 * (size + 1))
            p, h = b, s[k - 1]
            if h in ctx and ctx[h]:
                c = bi[(h, s[k])]
                p = (c - d2[min(c, 3)] if c else 0) / ctx[h] + (1 - kept2[h] / ctx[h]) * b
            h2 = tuple(s[max(0, k - 2):k])
            if len(h2) == 2 and bi[h2]:
                c = tri[(*h2, s[k])]
                p = (c - d3[min(c, 3)] if c else 0) / bi[h2] + (1 - kept3[h2] / bi[h2]) * p
            base += math.log10(b)
            score += math.log10(p)
        out.append((str(i), len(s) - 1, sum(uni[w] > 0 for w in s[1:]), base, score))
    return total, sorted(out)


def test_scores_equal_brute_force(spark, monkeypatch):
    rows = corpus()
    total, want = brute(rows)
    df = spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id long, text string, score double")
    df = df.repartition(3)
    trie = N.train(df.filter(~N.held_out("doc_id")))
    assert trie.words.tokens == total
    got = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.base_score, r.score)
                 for r in N.lm_scores(df, trie).collect())
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:3] == w[:3]
        assert abs(g[3] - w[3]) < 1e-6 * max(1, abs(w[3]))
        # stored terms are rounded down by less than a two-thousandth of a halving
        assert -4e-4 * w[1] - 1e-6 <= g[4] - w[4] <= 1e-6 * w[1] + 1e-6
    assert len(trie.pairs.border[0]) > 0          # frequent words span several files


def test_probabilities_of_a_context_sum_to_at_most_one(spark):
    rows = corpus()
    trie = N.train(spark.createDataFrame(rows, "doc_id long, text string"))
    words = sorted({w for _, t in rows for w in (t or "").encode().lower().split()})
    ids, _ = N.sequences([w.decode() for w in words])
    hashes = ids[ids > N.END]
    for lead in ([], [b"w1"], [b"w1", b"w1"], [b"w2", b"w1"]):
        start, _ = N.sequences([" ".join(w.decode() for w in lead)])
        start = start[:-1]
        total = 0.0
        for h in [*hashes, N.END]:
            total += 10 ** float(trie.log10(np.append(start, h))[1][-1])
        assert 0.9 < total <= 1 + 1e-9


def test_held_out_text_like_the_training_text_gains(spark):
    rng = random.Random(3)
    phrases = [" ".join(f"p{rng.randrange(50)}" for _ in range(4)) for _ in range(60)]
    rows = [(i, " ".join(rng.choice(phrases) for _ in range(20))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    trie = N.train(df.filter(~N.held_out("doc_id")))
    out = N.lm_scores(df.filter(N.held_out("doc_id")), trie).collect()
    assert out and all(r.score > r.base_score + 20 for r in out)


def test_empty_training_and_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    trie = N.train(empty)
    assert N.lm_scores(empty, trie).collect() == []
    r = N.lm_scores(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), trie).collect()[0]
    assert (r.n_tokens, r.n_known, r.score) == (3, 0, r.base_score)


def test_the_query_keeps_triples_seen_once(spark, tmp_path):
    from shopmarts.llm.queries import QUERIES

    rows = corpus()
    rows = [r for r in rows if r[1] is not None and r[0] is not None]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((str(r.doc_id), r.score) for r in QUERIES["op5_lm"](spark, str(tmp_path)).collect())
    want = sorted(brute(rows, least=1)[1], key=lambda w: (w[0], w[4]))
    assert len(got) == len(want)
    for (i, score), w in zip(got, want):
        assert i == w[0] and -4e-4 * w[1] - 1e-6 <= score - w[4] <= 1e-6 * w[1] + 1e-6


def test_elias_fano_pairs_of_neighbours_and_places_in_words():
    rng = np.random.default_rng(7)
    v = np.sort(np.concatenate([rng.integers(0, 10 ** 6, 2000), rng.integers(0, 2 ** 40, 50)]).astype(np.uint64))
    e = EliasFano(EliasFano.encode(v))
    at = rng.integers(0, len(v) - 1, 900)
    one, two = e.access_two(at)
    assert (one == v[at]).all() and (two == v[at + 1]).all()
    assert [len(x) for x in e.access_two(at[:0])] == [0, 0]
    words = [1, 1 << 63, (1 << 64) - 1, *map(int, rng.integers(1, 2 ** 63, 40))]
    want = [(w, k, p) for w in words for k, p in enumerate(p for p in range(64) if w >> p & 1)]
    w, k, p = (np.array(x, np.uint64) for x in zip(*want))
    assert (_place(w, k) == p).all()


def test_distinct_keys_are_numbered_as_by_unique():
    keys = np.random.default_rng(3).integers(0, 50, 400).astype(np.uint64)
    for x in (keys, keys[:1], keys[:0]):
        first, number = N.distinct(x)
        own, inverse = np.unique(x, return_inverse=True)
        assert (x[first] == own).all() and (number == inverse).all()
