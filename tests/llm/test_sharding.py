import random
import zlib

from shopmarts.llm import sharding as S


def docs(spark, n=3000, seed=1):
    rng = random.Random(seed)
    rows = [(i, "x" * rng.randrange(200) + "é", "clash") for i in range(n)]
    rows += [(n + i, "hot text", "k") for i in range(n // 2)]           # a third is one text
    rows += [(None, None, "k"), (1, "", "k"), (7, None, "k")] + [rows[0]] * 4
    rows.append((n * 2, "long " * 2000, "k"))
    return rows, spark.createDataFrame(rows, "doc_id long, text string, size string")


def test_shards_are_equal_in_bytes_and_slots_gapless(spark):
    rows, df = docs(spark)
    out = S.shard(df, ranges=64).collect()
    want = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))
                  for i, t, _ in rows)
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in out) == want
    total, largest = sum(w[1] for w in want), max(w[1] for w in want)
    for s in range(8):
        own = [r for r in out if r.shard == s]
        assert abs(sum(r["size"] for r in own) - total / 8) <= largest
        assert sorted(r.slot for r in own) == list(range(len(own)))


def test_equal_texts_stay_together_unless_a_shard_ends_in_them(spark):
    rows, df = docs(spark)
    small = [(i, f"text {i // 5}", "") for i in range(2000)]
    out = S.shard(spark.createDataFrame(small, "doc_id long, text string, size string"), ranges=64)
    by = {}
    for r in out.collect():
        by.setdefault(r.doc_id // 5, set()).add(r.shard)
    assert sum(len(v) > 1 for v in by.values()) <= 7


def test_result_does_not_depend_on_partitions_or_ranges(spark):
    _, df = docs(spark, 500)
    key = lambda d: sorted(map(str, d.collect()))
    a = key(S.shard(df, ranges=64))
    assert a == key(S.shard(df.repartition(7), ranges=16)) == key(S.shard(df, ranges=500))


def test_splitters_are_size_weighted_quantiles(spark):
    rows = [(k, 1000 if k < 100 else 1) for k in range(10_000)]
    df = spark.createDataFrame(rows, "key long, size long")
    cut = S.sampled_splitters(df, sum(s for _, s in rows), 10)
    assert len(cut) <= 10 and sum(c < 100 for c in cut) >= 8


def test_overfull_ranges_are_subdivided_and_empty_tables_work(spark):
    rows, df = docs(spark, 300)
    sums = S.shard(df, shards=2, ranges=4, rounds=4).groupBy("shard").sum("size").collect()
    assert abs(sums[0][1] - sums[1][1]) <= 2 * 10_001
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert S.shard(empty).collect() == []


def test_range_search_equals_bisect(spark):
    import bisect
    cut = sorted(random.Random(2).sample(range(-10 ** 6, 10 ** 6), 300))
    keys = cut[::7] + [c + 1 for c in cut[::5]] + [-2 * 10 ** 6, 2 * 10 ** 6]
    df = spark.createDataFrame([(k,) for k in keys], "key long")
    got = df.select("key", S.range_of(df.key, cut, fan=16).alias("r")).collect()
    assert all(r.r == bisect.bisect_left(cut, r.key) for r in got)
