"""SimHash near-duplicates by covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from shopmarts.llm.components import connected_components
from shopmarts.llm.rows import column, one_each, released, row_key
from shopmarts.llm.storage import written
from shopmarts.llm.wordblocks import word_lists

BITS = 64
SEED = 42


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """``2**(radius+1) - 1`` bit masks such that two words differing in at most
    ``radius`` bits agree on all bits of at least one mask.

    Each bit position gets a nonzero vector of ``radius+1`` bits; the mask of a
    nonzero vector v holds the positions whose vector has odd parity with v.
    The vectors of ``radius`` differing positions cannot span all radius+1
    dimensions, so some v is orthogonal to all of them: its mask avoids every
    differing position.
    """
    side = 1 << (radius + 1)
    vectors = [1 + i % (side - 1) for i in range(bits)]
    return [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() & 1)
            for v in range(1, side)]


def fingerprint(text: str | None, shingle: int) -> int:
    """Majority bits of the XXH64 hashes of all word shingles of ``text``."""
    ones, total = np.zeros(BITS, np.int64), 0
    carry: list[bytes] = []
    for words in word_lists(text):
        words = carry + words
        if len(words) >= shingle:
            joined = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
            n = len(words) - shingle + 1
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, joined, repeat(SEED)), "<u8", n)
            ones += _bit_counts(hashes)
            total += n
        carry = words[-(shingle - 1):] if shingle > 1 else []
    if not total:
        if not carry:
            return 0
        ones, total = _bit_counts(np.array([xxhash.xxh64_intdigest(b" ".join(carry), SEED)], "<u8")), 1
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    out = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 4096):
        block = hashes[i:i + 4096].view(np.uint8).reshape(-1, 8)
        out += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return out


def fingerprints(docs: DataFrame, shingle: int = 4, keep: list[str] = ("doc_id",),
                 text_col: str = "text") -> DataFrame:
    """The columns ``keep`` and ``fp`` (the fingerprint's 64 bits as a signed long) of
    every row.

    A null, empty or blank text has fingerprint zero; fewer than ``shingle``
    words count as one shingle.  Texts are read whole, in bounded pieces.
    """
    rows = docs.select(*map(column, keep), column(text_col).cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column(len(keep))], "<u8")
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fps.view("<i8"))],
                                             [*keep, "fp"])

    return rows.mapInArrow(run, StructType([*rows.schema.fields[:-1], StructField("fp", LongType())]))


def fingerprint_links(fps: DataFrame, radius: int = 4, block: int = 1024) -> DataFrame:
    """Links ``a, b`` that connect all fingerprints within ``radius`` bits.

    ``fps`` has one column of distinct longs.  Each fingerprint goes into one
    bucket per covering mask.  A bucket over ``block`` members is dealt into
    sub-blocks and each pair of sub-blocks becomes a cell of at most about
    2 * block members, so no bucket ever sits in one task; within a cell all
    pairs are compared and only a star for each connected group is returned.
    Links that the stars leave out join members that are connected anyway.
    """
    (col,) = fps.columns
    tables = [F.struct(F.lit(t).alias("t"), F.col(col).bitwiseAND(F.lit(_signed(m))).alias("key"))
              for t, m in enumerate(covering_masks(radius))]
    probes = fps.select(F.col(col).alias("fp"), F.explode(F.array(*tables)).alias("p"))
    probes = probes.select("fp", "p.t", "p.key")
    sizes = written(probes.groupBy("t", "key").agg(F.count("*").alias("n")).filter("n > 1"),
                    "simhash_buckets")
    cells = (probes.join(sizes, ["t", "key"])
             .withColumn("parts", F.ceil(F.col("n") / block).cast("int"))
             .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("t", "key", F.least("own", "other").alias("i"),
                     F.greatest("own", "other").alias("j"), "fp"))
    keys = ["t", "key", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, len(keys)):
            a, b = _stars(group, radius)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return (cells.repartition(*keys).sortWithinPartitions(*keys)
            .mapInArrow(run, "a long, b long"))


def _groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[np.ndarray]:
    """The last column's values of each run of equal keys, over batch ends."""
    held, last = [], None
    for b in batches:
        if not b.num_rows:
            continue
        keys = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64)
                         for c in b.columns[:n_keys]], axis=1)
        values = b.column(n_keys).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        starts = [0, *cuts.tolist(), b.num_rows]
        for s, e in zip(starts, starts[1:]):
            key = tuple(keys[s])
            if key != last and held:
                yield np.concatenate(held)
                held = []
            held.append(values[s:e])
            last = key
    if held:
        yield np.concatenate(held)


def _stars(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Star links (smallest member, member) of the groups linked in one cell."""
    fps = np.sort(fps)
    if len(fps) == 2:
        near = int(np.bitwise_count((fps[:1] ^ fps[1:]).view(np.uint64))[0]) <= radius
        return (fps[:1], fps[1:]) if near else (fps[:0], fps[:0])
    near = np.bitwise_count((fps[:, None] ^ fps[None, :]).view(np.uint64)) <= radius
    free = np.ones(len(fps), bool)
    a, b = [], []
    for root in range(len(fps)):
        if not free[root]:
            continue
        free[root] = False
        front = near[root] & free
        while front.any():
            free &= ~front
            a.append(np.full(int(front.sum()), fps[root]))
            b.append(fps[front])
            front = near[front].any(axis=0) & free
    none = fps[:0]
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def grouped(docs: DataFrame, shingle: int = 4, radius: int = 4, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """``id, key, fp, group, component_id`` of every row of ``docs``.

    ``key`` is the row's hash, ``group`` names the row's group of linked
    fingerprints (by one of them) and ``component_id`` by its smallest id.  Two
    groups can share that id where rows of different texts do.
    """
    ids = docs.select(column(id_col).alias("id"), row_key(docs).alias("key"),
                      column(text_col).alias("text"))
    rows = written(fingerprints(ids, shingle, ["id", "key"], "text"), "fingerprints")
    per_fp = written(rows.groupBy("fp").agg(F.min("id").alias("low")), "distinct_fingerprints")
    labels = connected_components(fingerprint_links(per_fp.select("fp"), radius))
    nodes = written(
        per_fp.join(labels, F.col("fp") == F.col("node"), "left")
        .select("fp", "low", F.coalesce("component", "fp").alias("group")), "fp_components")
    # written, so that a large component is a skewed join that can be split
    lows = written(nodes.groupBy("group").agg(F.min("low").alias("component_id")), "fp_lows")
    named = written(nodes.join(lows, "group").select("fp", "group", "component_id"), "fp_names")
    return rows.join(named, "fp").select("id", "key", "fp", "group", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col, fingerprint, component_id``.

    Documents whose fingerprints differ in at most ``radius`` bits are linked;
    ``component_id`` is the smallest id reachable over links, itself included.
    Copies share a fingerprint and are linked through it, whatever their
    number.  A null text is an empty one (fingerprint zero, linked like any
    other).  Rows with a null id take part but never name a component; a
    component without any id has a null ``component_id``.  Repeated rows come
    back as often as they went in.  Other columns are not read.
    """
    rows = docs.select(column(id_col), column(text_col))
    return grouped(rows, shingle, radius, id_col, text_col).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id")


def keep_one_per_group(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay when one row of each group of ``grouped`` does.

    That is the row with the group's smallest id; of several rows with that id
    (equal or near texts) the one whose hash over all columns is least, so the
    partitioning does not matter.  A row that occurs more than once stays once.
    Rows with one id and texts of different groups stay in each of them.  Null
    ids come last; of a group without any id one row stays.  Columns keep their
    names and types whatever they are called; an empty table stays empty.

    The choice is made on ids and hashes alone; whole rows move once.
    """
    rows = groups.groupBy("group", "id", "key").agg(F.count("*").alias("rows"))
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "key", "rows")).alias("first")
    chosen = rows.groupBy("group").agg(first).select(
        "first.id", "first.key", "first.rows", F.lit(1).alias("copies"))
    kept = one_each(docs, row_key(docs), written(chosen, "simhash_kept"), id_col)
    return released(kept, docs.columns)
