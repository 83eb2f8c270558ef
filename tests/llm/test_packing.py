import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shopmarts.llm import packing as P

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [None, "", "  \n ", "Hello, WORLD!! it's 'll don't", "á ́x ΑΣ ΑΣΑ İstanbul　x\x1c\x85\ty",
         "1234 a1b2 %%% $$$ | & x|y <|endoftext|> ab", "É é ß ÿ µ ª º naïve, Ærø.",
         "z" * 300, "!" * 200 + " a" * 70, "日本語 テキスト 😀😀", "word " * 9000, "x y\n" * 3000]


def plain(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def test_ids_equal_the_tokenizer():
    tokenizer, encode = Tokenizer.from_file(PATH), P.WordEncoder(PATH)
    for text in TEXTS * 2:
        assert [*encode(text).tolist(), 2] == plain(tokenizer, text), text


def check(rows, want):
    """Every id once, sequences gapless; returns the padding to 4096."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert by_doc.keys() == want.keys()
    for d, ps in by_doc.items():
        at = 0
        for p in sorted(ps, key=lambda p: p.start):
            ids = np.frombuffer(p.ids, "<u4").tolist()
            assert p.start == at and p.length == len(ids) > 0 and p.doc_tokens == len(want[d])
            assert ids == want[d][at:at + p.length]
            at += p.length
        assert at == len(want[d])
    padding = 0
    for ps in by_seq.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at and p.sequence_tokens == sum(q.length for q in ps)
            at += p.length
        assert at <= 4096
        padding += 0 if at & (at - 1) == 0 else 4096 - at
    return padding


def test_round_trip_without_padding(spark):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    tokenizer = Tokenizer.from_file(PATH)
    out = P.pack(df, PATH, block=5000).collect()
    assert check(out, {i: plain(tokenizer, t) for i, t, _ in rows}) == 0
    steps = {}
    for r in out:
        steps[r.step_id] = steps.get(r.step_id, 0) + r.length
    assert max(steps.values()) <= 16 * 4096


def test_repeated_and_null_rows_are_documents(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    out = P.pack(df.coalesce(1), PATH).collect()
    assert sum(r.length for r in out) == 8
    assert sorted(str(r.doc_id) for r in out if r.start == 0) == ["1", "1", "None"]


@pytest.mark.parametrize("seed", range(3))
def test_packer_fills_tiers_and_balances_steps(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.lognormal(6, 1.2, 3000).astype(int) + 1
    packer, pieces = P.Packer(block=200_000), []
    for k, n in enumerate(sizes):
        pieces += packer.add(k, int(n))
    pieces += packer.finish()
    got = np.zeros(len(sizes), int)
    seqs, cost = {}, {}
    for d, s, n, q, o, size, step in pieces:
        got[d] += n
        seqs[q] = size
        cost[step] = cost.get(step, 0) + n
    assert (got == sizes).all()
    odd = [s for s in seqs.values() if s not in P.TIERS]
    assert len(odd) <= 12 and all(s & (s - 1) == 0 for s in odd)
    # documents stay whole except where they close a window
    cut = sum(1 for _ in pieces) - len(sizes) - int((sizes // 4096).sum())
    assert cut <= len(seqs)
    full = sorted(cost.values())[2:-4]
    assert not full or min(full) >= 0.9 * 16 * 4096


def test_empty_table(spark):
    assert P.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def test_crc_is_that_of_little_endian_ids(spark):
    from pyspark.sql import functions as F
    r = P.pack(spark.createDataFrame([(1, "hello")], "doc_id long, text string"), PATH).select(
        F.crc32("ids").alias("c"), "ids").collect()
    assert all(x.c == zlib.crc32(x.ids) for x in r)
