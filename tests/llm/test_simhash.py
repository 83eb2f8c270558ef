import itertools
import random
import re

import pytest
import xxhash

from shopmarts.llm import simhash as S


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    """``fps``: list of (id, fingerprint); smallest id reachable of each entry."""
    part = list(range(len(fps)))
    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i][1] ^ fps[j][1]).bit_count() <= 4 and part[i] != part[j]:
            old, new = part[j], part[i]
            part = [new if p == old else p for p in part]
    low = {}
    for (k, _), p in zip(fps, part):
        if k is not None:
            low[p] = min(low.get(p, k), k)
    return [low.get(p) for p in part]


def test_masks_cover_every_pair_within_the_radius():
    for radius in (1, 2, 4):
        masks = S.covering_masks(radius, 24)
        assert len(masks) == 2 ** (radius + 1) - 1
        for bits in itertools.combinations(range(24), radius):
            diff = sum(1 << b for b in bits)
            assert any(m & diff == 0 for m in masks)
    masks = S.covering_masks(4)
    rng = random.Random(1)
    for _ in range(3000):
        diff = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(m & diff == 0 for m in masks)


def corpus():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    rows, k = [], 0
    for _ in range(40):
        base = [rng.choice(words) for _ in range(rng.choice([3, 30, 200]))]
        for _ in range(rng.choice([1, 3, 6])):
            t = list(base)
            for _ in range(rng.randrange(3)):
                t[rng.randrange(len(t))] = "X" + rng.choice(words)
            rows.append((k, "\t".join(t) if k % 3 else " ".join(t), "f"))
            k += 1
    rows += [(k, None, "f"), (k + 1, "", "f"), (k + 2, " \n\x0b ", "f"), (None, rows[0][1], "f"),
             (3, rows[3][1], "f"), (3, rows[3][1], "f"), (None, "only null id", "f"),
             (k + 3, "É ß x A Z " * 50_000, "f")]
    rng.shuffle(rows)
    return rows


def test_fingerprints_and_components_equal_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    want_fp = [(i, brute_fingerprint(t)) for i, t, _ in rows]
    want = sorted((str(i), f"{fp:016x}", str(c)) for (i, fp), c in
                  zip(want_fp, brute_components(want_fp)))
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id))
                 for r in S.near_duplicates(df).collect())
    assert got == want
    assert len({c for _, _, c in want}) < len(rows) - 20


def test_a_crowded_bucket_is_dealt_into_cells_without_losing_links(spark):
    rng = random.Random(9)
    center = rng.getrandbits(64)
    fps = {center ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(7))) for _ in range(400)}
    fps |= {rng.getrandbits(64) for _ in range(100)}
    fps = sorted(fps)
    signed = [(S._signed(f),) for f in fps]
    links = S.fingerprint_links(spark.createDataFrame(signed, "fp long"), 4, block=16)
    from shopmarts.llm.components import connected_components
    label = {r.node: r.component for r in connected_components(links).collect()}
    got = {}
    for (s,), f in zip(signed, fps):
        got.setdefault(label.get(s, s), set()).add(f)
    want = {}
    for (f, _), c in zip([(f, f) for f in fps], brute_components([(f, f) for f in fps])):
        want.setdefault(c, set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_one_document_of_each_group_stays(spark):
    text = " ".join(f"w{i}" for i in range(100))
    rows = [(5, text, "a"), (2, text, "b"), (2, text, "b"), (9, "else " * 9, "c"), (None, text, "d"),
            (None, "no id at all", "e"), (None, "no id at all", "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    kept = S.keep_one_per_group(df, S.grouped(df))
    assert kept.dtypes == df.dtypes
    assert sorted((str(r[0]), r[2]) for r in kept.collect()) == [("2", "b"), ("9", "c"), ("None", "e")]


@pytest.mark.parametrize("parts", [1, 2, 3])
def test_texts_that_share_an_id_are_not_lost(spark, parts):
    """Two texts of one id are two documents; of two near texts of one id one
    stays, the same one whatever the partitioning."""
    text = [f"w{i}" for i in range(200)]
    near = " ".join([*text[:199], "other"])
    rows = [(1, "alpha beta gamma delta", "x"), (1, "totally other words stand here", "y"),
            (7, " ".join(text), "p"), (7, near, "q"), (8, near, "r"), (7, near, "q"),
            (3, "alpha beta gamma delta", "z")]
    df = spark.createDataFrame(rows, "doc_id long, key string, `group` string").toDF(
        "doc_id", "key", "group").repartition(parts)
    fps = {r[0] for r in S.near_duplicates(df, text_col="key").filter("doc_id in (7, 8)")
           .select("component_id").collect()}
    assert fps == {7}
    kept = sorted(tuple(r) for r in S.keep_one_per_group(df, S.grouped(df, text_col="key")).collect())
    assert kept[:2] == [rows[0], rows[1]] and len(kept) == 3 and kept[2][0] == 7
    everywhere = df.coalesce(1).orderBy("group")
    same = S.keep_one_per_group(everywhere, S.grouped(everywhere, text_col="key")).collect()
    assert sorted(map(tuple, same)) == kept


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_duplicates(df).collect() == []
    assert S.keep_one_per_group(df, S.grouped(df)).collect() == []
