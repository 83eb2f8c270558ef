import json
import random

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from shopmarts.llm import tokencounts as T

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "B", "é", "ß", "日", "\n", " ", "  ", "\t", "\r", "'s", "'ll", "1", "23", "½", "٣", "!",
         "..", "<|endoftext|>", "<|endof", "\x1c", "\x85", "　", "\xa0", "​", "᠎", "😀",
         "é", "_", "x" * 70, "\x00", "ǅ", "Ⅷ", "‍", "word", " word", "Ġ", "\n\n"]


@pytest.fixture(scope="module")
def whole():
    return T.whole_tokens(PATH)


def plain(text):
    return len(Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids)


def test_whole_tokens_are_proved_one_by_one(whole):
    t = Tokenizer.from_file(PATH)
    vocab = t.get_vocab(with_added_tokens=False)
    assert {s for s, i in vocab.items() if [x.id for x in t.model.tokenize(s)] == [i]} == whole
    assert "<|endoftext|>" not in whole and len(whole) > 50_000


def test_strings_that_merges_do_not_reach_are_not_whole(tmp_path):
    # "abc" is in the vocabulary, but no merge makes it
    j = json.load(open(PATH))
    j["added_tokens"] = []
    vocab = {c: i for i, c in enumerate(T.BYTE_CHARS.values())}
    vocab |= {"ab": 256, "abc": 257}
    j["model"] |= {"vocab": vocab, "merges": [["a", "b"]]}
    path = tmp_path / "small.json"
    path.write_text(json.dumps(j))
    whole = T.whole_tokens(str(path))
    assert "ab" in whole and "abc" not in whole
    assert T.Counter(str(path), whole)("abc ab") == 2 + 2


@pytest.mark.parametrize("seed,piece", [(0, 1 << 20), (1, 1 << 20), (2, 12), (3, 1)])
def test_counts_equal_the_library(whole, monkeypatch, seed, piece):
    monkeypatch.setattr(T, "PIECE", piece)
    rng, count, t = random.Random(seed), T.Counter(PATH, whole), Tokenizer.from_file(PATH)
    for _ in range(4000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25)))
        assert count(text) == len(t.encode(text, add_special_tokens=False).ids), repr(text)


def test_every_character_ends_a_unit_as_the_library_does():
    """What Python does not call white space, the pre-tokenizer does not join
    with a space that follows it."""
    pre = Tokenizer.from_file(PATH).pre_tokenizer
    for start in range(0, 0x110000, 4096):
        chars = [c for c in map(chr, range(start, start + 4096))
                 if not 0xD800 <= ord(c) < 0xE000 and not c.isspace()]
        text = "".join(f"{c} \n" for c in chars)
        tokens = [p for p, _ in pre.pre_tokenize_str(text)]
        assert sum(p in ("Ġ", "ĠĊ", "Ċ") for p in tokens) == len([p for p in tokens if p[0] in "ĠĊ"])
        assert sum(p[0] in "ĠĊ" and len(p) <= 2 for p in tokens) >= len(chars)


def test_full_tables_start_again(whole, monkeypatch):
    monkeypatch.setattr(T, "_UNITS", 3)
    monkeypatch.setattr(T, "_PARTS", 2)
    count = T.Counter(PATH, whole)
    text = "Xqzzt vrrkk, plonkk; Xqzzt qqxxy zzykk. word"
    assert [count(text) for _ in range(4)] == [plain(text)] * 4


def test_table(spark):
    texts = [None, "", " ", "Hello, world!", "x " * 600, "a <|endoftext|> b", "naïve\n\ncafé",
             "Hello, world!", "word " * 400_000 + "z" * 1_000_000]
    rows = [(i if i != 7 else None, x, 5) for i, x in enumerate(texts)] + [(3, texts[3], 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long").repartition(3)
    got = sorted(tuple(r) for r in T.token_counts(df, PATH).fillna(-1).collect())
    want = sorted((-1 if i is None else i, len((x or "").encode()), plain(x), plain(x) > 512)
                  for i, x, _ in rows)
    assert got == want
    assert T.token_counts(df.limit(0), PATH).collect() == []


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_tokenizers_count_as_their_library(spark, name):
    path = public_tokenizers.path(name)
    texts = [None, "", "Hello  World\n x", "日本 😀 </s> <|endoftext|>"]
    got = dict(tuple(r)[::2] for r in T.token_counts(spark.createDataFrame(
        list(enumerate(texts)), "doc_id int, text string"), path).drop("over_limit").collect())
    if name.endswith(".json"):
        t = Tokenizer.from_file(path)
        want = [len(t.encode(x or "", add_special_tokens=False).ids) for x in texts]
    else:
        m = sentencepiece.SentencePieceProcessor(model_file=path)
        want = [len(m.encode(x or "")) for x in texts]
    assert got == dict(enumerate(want))


def test_query_on_all_documents(spark):
    import __spark_entry__
    from tests.conftest import SF_SMALL
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    t = Tokenizer.from_file(PATH)
    for r in __spark_entry__.queries()["op13_token_counts"](spark, SF_SMALL).collect():
        n = len(t.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 512)
