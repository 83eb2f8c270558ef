import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from shopmarts.llm import alignment as A

PATH_A = public_tokenizers.path("byte_bpe_50k.json")
PATH_B = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [None, "", " ", "Hello, world!", "  two  spaces ", "naïve café\n\nÆrø ßß", "日本語 テキスト 😀",
         "a▁b has no way back", "tab\there\r\nline", "<|endoftext|> </s> <s> <0x41>", "1234567 12 !!??",
         "The quick brown fox jumps over the lazy dog, unbelievably.", "Hello, world!", "　x\x00y"]


@pytest.fixture(scope="module")
def models():
    t = Tokenizer.from_file(PATH_A)
    t.encode_special_tokens = True
    return t, sentencepiece.SentencePieceProcessor(model_file=PATH_B)


def tokens(models, text):
    """Ids with their byte ranges, from the libraries' own pieces."""
    t, m = models
    if not text:
        return [], []
    whole = (" " + text).encode()
    chars = {chr(b) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF else None: b
             for b in range(256)}
    spare = iter(range(256, 512))
    chars |= {chr(next(spare)): b for b in range(256)
              if not (0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF)}
    a, at = [], 0
    for i in t.encode(" " + text, add_special_tokens=False).ids:
        data = bytes(chars[c] for c in t.id_to_token(i))
        a.append((i, at, at + len(data)))
        at += len(data)
    b, said = [], b""
    for i in m.encode(text):
        p = m.id_to_piece(i)
        data = bytes([int(p[3:5], 16)]) if m.is_byte(i) else p.replace("▁", " ").encode()
        b.append((i, len(said), len(said) + len(data)))
        said += data
    return (a, b) if at == len(whole) and said == whole else ([], [])


def brute(models, texts):
    """n_a, n_b, n_groups, n_links, n_best, count_sum and groups of each text."""
    both = [tokens(models, t) for t in texts]
    links = [[(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]] for a, b in both]
    count = Counter(p for d in links for p in d)
    top = {}
    for (_, b), n in count.items():
        top[b] = max(top.get(b, 0), n)
    out = []
    for (a, b), d in zip(both, links):
        ends = sorted({x[2] for x in a} & {y[2] for y in b})
        groups = ";".join("|".join(",".join(str(x[0]) for x in side if s <= x[1] < e)
                                   for side in (a, b)) for s, e in zip([0, *ends], ends))
        out.append((len(a), len(b), len(ends), len(d), sum(count[p] == top[p[1]] for p in d),
                    sum(count[p] for p in d), groups))
    return out


@pytest.mark.parametrize("seed", range(5))
def test_coalescing_equals_all_pairs(seed):
    rng = np.random.default_rng(seed)
    total = int(rng.integers(1, 200))
    cuts = [np.diff([0, *np.sort(rng.choice(np.arange(1, total), int(rng.integers(0, total)), False)),
                     total]) for _ in range(2)]
    group_a, group_b, link_a, link_b = A.coalesce(*cuts)
    end = [np.cumsum(c) for c in cuts]
    want = [(i, j) for i in range(len(cuts[0])) for j in range(len(cuts[1]))
            if end[0][i] - cuts[0][i] < end[1][j] and end[1][j] - cuts[1][j] < end[0][i]]
    assert list(zip(link_a.tolist(), link_b.tolist())) == want
    common = np.intersect1d(*end)
    for e, g in ((end[0], group_a), (end[1], group_b)):
        assert g.tolist() == np.searchsorted(common, e).tolist()


def test_coalescing_nothing():
    none = np.empty(0, np.int64)
    assert [x.tolist() for x in A.coalesce(none, none)] == [[], [], [], []]


def test_whole_result_equals_brute_force(spark, models):
    rng = random.Random(3)
    words = ["Hello", "world", "unbelievable", "ßtraße", "\n", " ", "日本", "x1y2", "don't", "▁", "\t"]
    texts = TEXTS + ["".join(rng.choice(words) + rng.choice(["", " "]) for _ in range(rng.randint(1, 30)))
                     for _ in range(60)]
    df = spark.createDataFrame([(i, t, "n") for i, t in enumerate(texts)],
                               "doc_id long, text string, groups string").repartition(3)
    want = brute(models, texts)
    for block in (1 << 20, 60):
        got = {r.doc_id: tuple(r)[1:] for r in A.align(df, PATH_A, PATH_B, block=block,
                                                       digest=False).collect()}
        assert got == dict(enumerate(want))
    assert want[7][:4] == (0, 0, 0, 0) and want[7][6] == ""
    hashed = {r.doc_id: r.groups for r in A.align(df, PATH_A, PATH_B).collect()}
    assert hashed == {i: hashlib.sha256(w[6].encode()).hexdigest() if w[6] else ""
                      for i, w in enumerate(want)}


def aligned(units, texts):
    x = A.Aligned(units, texts)
    return [*zip(x.n_a.tolist(), x.n_b.tolist(), x.n_groups.tolist(), x.n_links.tolist(), x.groups)]


def test_units_pieces_and_full_tables_change_nothing(models, monkeypatch):
    """Whole texts as units, small units, texts in pieces and a table that is
    emptied again and again."""
    rng = random.Random(5)
    parts = ["a", "Bc", "é", "日", "\n", " ", "  ", "\t", "\r", "'s", "12", "½", "!", "..", "</s>",
             "\x85", "　", "\xa0", "😀", "▁", "word", " word", "\n\n", " \n", "\x00", "\u1680", "\u200b"]
    texts = [t for t in TEXTS if t] + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 25)))
                                       for _ in range(1500)]
    small, whole = A.Units(PATH_A, PATH_B), A.Units(PATH_A, PATH_B)
    assert small.by_units
    whole.by_units = whole.a.by_units = whole.b.by_units = False
    want = aligned(whole, texts)
    assert [w[0] for w in want] == [len(tokens(models, t)[0]) for t in texts]
    assert aligned(small, texts) == want
    monkeypatch.setattr(A, "PIECE", 5)
    monkeypatch.setattr(A, "_UNITS", 10)
    assert [x for t in texts for x in aligned(small, [t])] == want
    assert any(len(list(A.text_pieces(" " + t))) > 3 for t in texts)


def test_very_long_text_nulls_and_repeats(spark, models):
    long = "word another, " * 200_000 + "z" * 200_000
    rows = [(1, long), (None, "Hello planet"), (2, "Hello planet"), (2, "Hello planet"), (3, None)]
    got = A.align(spark.createDataFrame(rows, "doc_id int, text string"), PATH_A, PATH_B).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "2", "2", "3", "None"]
    t, m = models
    by = {r.doc_id: r for r in got}
    assert by[1].n_a == len(t.encode(" " + long, add_special_tokens=False).ids)
    assert by[1].n_b == len(m.encode(long))
    assert by[2].groups == by[None].groups and by[2].count_sum == 3 * by[2].n_links
    assert by[3].groups == "" and by[3].count_sum == 0


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    out = A.align(df, PATH_A, PATH_B)
    assert out.collect() == [] and out.columns[0] == "doc_id"
    only = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(tuple(r) for r in A.align(only, PATH_A, PATH_B).collect()) == [
        (i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]


def test_query_on_all_documents(spark, models):
    import __spark_entry__
    from tests.conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    small = [r for r in docs if len(r.text or "") < 3000]
    got = {r.doc_id: r for r in __spark_entry__.queries()["op12_alignment"](spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    for r in small:
        a, b = tokens(models, r.text)
        assert (got[r.doc_id].n_a, got[r.doc_id].n_b) == (len(a), len(b))
        assert got[r.doc_id].n_groups == len({x[2] for x in a} & {y[2] for y in b})
