"""Quality rules: repetition and size rules, and character n-gram perplexity bands.

The model counts byte n-grams inside words, by language, over all documents;
Spark joins turn the counts into modified Kneser-Ney probabilities, which are
written as sorted arrays of packed n-grams.  Its size follows the languages'
spelling, not the corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmarts.llm.arrayfiles import read_arrays, write_arrays
from shopmarts.llm.ngramtrie import summed
from shopmarts.llm.storage import written
from shopmarts.llm.wordblocks import Words, hashed_blocks
from shopmarts.session import shared_path

ORDER = 5                     # bytes in the longest n-gram; five bytes and a tag fill a long
BEGIN, END = 1, 2             # bytes that stand for a word's ends
SYMBOLS = b"#*$%&|<>"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_SPACE_CHARS = " \t\n\x0b\x0c\r"
WINDOW = 8
BLOCK = 1 << 19
_FLUSH = 1 << 20


def lang_code(lang: str | None) -> int:
    """20 bits for a language name; null has one of its own."""
    return 0 if lang is None else 1 + zlib.crc32(lang.encode()) % ((1 << 20) - 1)


# ---------------------------------------------------------------- n-grams of words


class DistinctWords:
    """The distinct (language, word) pairs of a block and their n-grams.

    ``inverse`` gives each word's pair; ``gram`` are the packed n-grams (language,
    order, bytes) of all letters and the end of each pair, ``first`` where each
    pair's begin.
    """

    def __init__(self, words: Words, lang: np.ndarray):
        key = words.hash ^ (lang.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, at, self.inverse, self.count = np.unique(key, return_index=True, return_inverse=True,
                                                    return_counts=True)
        size = words.end[at] - words.start[at]
        # each pair in a row of bytes: begin marks, the word, the end mark
        room = size + ORDER
        start = np.concatenate([[0], np.cumsum(room)])
        text = np.full(start[-1], BEGIN, np.uint8)
        letter = np.repeat(words.start[at] - np.concatenate([[0], np.cumsum(size)])[:-1], size)
        letter += np.arange(len(letter))
        place = np.repeat(start[:-1] + ORDER - 1 - np.concatenate([[0], np.cumsum(size)])[:-1], size)
        place += np.arange(len(place))
        text[place] = words.data[letter]
        text[start[1:] - 1] = END
        gram = np.zeros(max(0, len(text) - ORDER + 1), np.int64)
        for k in range(ORDER):
            gram = (gram << 8) | text[k:len(text) - ORDER + 1 + k]
        # n-grams that end on a letter or end mark: all but those that end on a begin mark
        event = np.ones(len(text), bool)
        event[(start[:-1, None] + np.arange(ORDER - 1)).ravel()] = False
        ends = np.flatnonzero(event)
        self.events = size + 1
        self.first = np.concatenate([[0], np.cumsum(self.events)])[:-1]
        self.gram = tagged(np.repeat(lang[at], self.events), ORDER) | gram[ends - ORDER + 1]


def tagged(lang: np.ndarray, order: int) -> np.ndarray:
    return (lang.astype(np.int64) << 43) | (order << 40)


def count_grams(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``gram, n``: occurrences of every longest n-gram in all texts."""
    rows = docs.select(F.col(text_col).cast("string").alias("t"), F.col(lang_col).cast("string").alias("g"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)

        def rows_of(k, c):
            return pa.RecordBatch.from_arrays([pa.array(k), pa.array(c)], ["gram", "n"])

        for b in batches:
            lang = np.array([lang_code(x) for x in b.column(1).to_pylist()], np.int64)
            for _, of, words in hashed_blocks(b.column(0).to_pylist(), lower=False, limit=BLOCK):
                if not len(of):
                    continue
                d = DistinctWords(words, lang[of])
                keys, counts = summed(np.concatenate([keys, d.gram]),
                                      np.concatenate([counts, np.repeat(d.count, d.events)]))
                if len(keys) > _FLUSH:
                    yield rows_of(keys, counts)
                    keys, counts = keys[:0], counts[:0]
        if len(keys):
            yield rows_of(keys, counts)

    return rows.mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


# ---------------------------------------------------------------- the model


def _tag(gram: Column, order: int) -> Column:
    """The language of a packed n-gram, tagged with another order."""
    return F.shiftleft(F.shiftright(gram, 43), 43).bitwiseOR(F.lit(order << 40))


def _suffix(gram: Column, order: int) -> Column:
    return _tag(gram, order).bitwiseOR(gram.bitwiseAND(F.lit((1 << 8 * order) - 1)))


def _context(gram: Column, order: int) -> Column:
    return _tag(gram, order - 1).bitwiseOR(
        F.shiftright(gram.bitwiseAND(F.lit((1 << 8 * order) - 1)), 8))


def kneser_ney(grams: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(gram, p)`` of all orders and ``(context, backoff)``, from ``gram, n``.

    Orders below the longest count distinct continuations to the left; n-grams
    at a word's begin have only one and keep their occurrences.  Discounts are
    estimated for each language and order.  Each order is written before the
    next uses it.
    """
    levels = {ORDER: written(grams, "kn_counts")}
    for k in range(ORDER - 1, 0, -1):
        x = levels[k + 1].groupBy(_suffix(F.col("gram"), k).alias("gram")).agg(
            F.sum("n").alias("seen"), F.count("*").alias("kinds"))
        begins = F.shiftright(F.col("gram"), 8 * (k - 1)).bitwiseAND(F.lit(255)) == BEGIN
        levels[k] = written(x.select("gram", F.when(begins, F.col("seen")).otherwise(
            F.col("kinds")).alias("n")), "kn_counts")
    probabilities, backoffs, lower = [], [], None
    for k in range(1, ORDER + 1):
        x = levels[k].withColumn("lang", F.shiftright("gram", 43))
        ones = [F.greatest(F.lit(1), F.count(F.when(F.col("n") == c, 1))).alias(f"n{c}") for c in (1, 2, 3, 4)]
        y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
        # raw estimates, held between a twentieth and just under the count
        d = x.groupBy("lang").agg(*ones).select("lang", *(
            F.least(F.lit(c - 0.05), F.greatest(F.lit(0.05), c - (c + 1) * y * F.col(f"n{c + 1}")
                                                / F.col(f"n{c}"))).alias(f"d{c}") for c in (1, 2, 3)))
        cut = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        x = x.join(d, "lang").select("gram", "n", cut.alias("cut"), _context(F.col("gram"), k).alias("context"))
        h = written(x.groupBy("context").agg(F.sum("n").alias("total"), (
            F.sum("cut") / F.sum("n")).alias("backoff")), "kn_contexts")
        x = x.join(h, "context").select("gram", ((F.col("n") - F.col("cut")) / F.col("total")).alias("share"),
                                        "backoff")
        if lower is None:
            p = x.select("gram", (F.col("share") + F.col("backoff") / 256).alias("p"))
        else:
            low = lower.select(F.col("gram").alias("suffix"), F.col("p").alias("q"))
            p = x.join(low, _suffix(F.col("gram"), k - 1) == F.col("suffix")).select(
                "gram", (F.col("share") + F.col("backoff") * F.col("q")).alias("p"))
        lower = written(p, "kn_level")
        probabilities.append(lower)
        backoffs.append(h.select("context", "backoff"))
    grams, contexts = probabilities[0], backoffs[0]
    for p, b in zip(probabilities[1:], backoffs[1:]):
        grams, contexts = grams.unionByName(p), contexts.unionByName(b)
    return grams, contexts


@dataclass
class SortedArrays:
    """Keys in ascending order over several files, with a value each."""

    folder: str
    name: str
    parts: list[int]
    low: list[int]                     # a file's smallest key
    files: dict = field(default_factory=dict)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(found, value)`` of keys in ascending order."""
        found, value = np.zeros(len(keys), bool), np.zeros(len(keys))
        cut = [0, *np.searchsorted(keys, np.array(self.low[1:], np.int64)).tolist(), len(keys)]
        for p, s, e in zip(self.parts, cut, cut[1:]):
            if s == e:
                continue
            if p not in self.files:
                self.files[p] = read_arrays(self.folder, f"{self.name}-{p}")
            have = self.files[p]["key"]
            k = np.minimum(np.searchsorted(have, keys[s:e]), len(have) - 1)
            hit = have[k] == keys[s:e]
            found[s:e], value[s:e] = hit, np.where(hit, self.files[p]["value"][k], 0.0)
        return found, value


def _write_sorted(df: DataFrame, folder: str, name: str) -> SortedArrays:
    """``df`` (a long key, a double) by key ranges, one file a range."""
    key, value = df.columns

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, keys, values = TaskContext.get().partitionId(), [], []
        for b in batches:
            keys.append(b.column(0).to_numpy())
            values.append(b.column(1).to_numpy())
        if sum(map(len, keys)):
            keys, values = np.concatenate(keys), np.concatenate(values)
            write_arrays(folder, f"{name}-{part}", {"key": keys, "value": values.astype(np.float32)})
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "low": [int(keys[0])]})

    ranged = df.select(key, F.log(value).alias("v")).repartitionByRange(key).sortWithinPartitions(key)
    rows = sorted(ranged.mapInArrow(write, "part int, low long").collect(), key=lambda r: r["low"])
    return SortedArrays(folder, name, [r["part"] for r in rows], [r["low"] for r in rows])


@dataclass
class CharModel:
    grams: SortedArrays
    contexts: SortedArrays

    def log_p(self, gram: np.ndarray) -> np.ndarray:
        """Natural log probability of the last byte of each longest n-gram.

        The longest known suffix's probability, times the backoff of the longer
        contexts that are known; a byte new to a language has one in 256."""
        keys, inverse = np.unique(gram, return_inverse=True)
        out, open_ = np.zeros(len(keys)), np.arange(len(keys))
        lang = (keys >> 43).astype(np.int64)
        for k in range(ORDER, 0, -1):
            g = tagged(lang[open_], k) | (keys[open_] & ((1 << 8 * k) - 1))
            found, p = _find(self.grams, g)
            out[open_[found]] += p[found]
            open_, g = open_[~found], g[~found]
            if not len(open_):
                break
            context = tagged(lang[open_], k - 1) | ((g & ((1 << 8 * k) - 1)) >> 8)
            known, b = _find(self.contexts, context)
            out[open_] += np.where(known, b, 0.0)
        out[open_] += np.log(1 / 256)
        return out[inverse]


def _find(arrays: SortedArrays, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    found, value = np.empty(len(keys), bool), np.empty(len(keys))
    found[order], value[order] = arrays.find(keys[order])
    return found, value


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> CharModel:
    """The model of all texts of ``docs``."""
    grams, contexts = kneser_ney(count_grams(docs, text_col, lang_col))
    folder = shared_path(docs.sparkSession, "llm", "char_model", unique=True)
    return CharModel(_write_sorted(grams, folder, "grams"), _write_sorted(contexts, folder, "contexts"))


# ---------------------------------------------------------------- rules


def _repeated_lines(text: str | None) -> int:
    seen, n = set(), 0
    for line in (text or "").split("\n"):
        if line.strip(_SPACE_CHARS):
            n += line in seen
            seen.add(line)
    return n


def _repeat_words(h: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """Words per text inside windows that occur more than once in the text."""
    m = len(h) - WINDOW + 1
    if m <= 0:
        return np.zeros(n, np.int64)
    window = np.zeros(m, np.uint64)
    for k in range(WINDOW):
        window = window * np.uint64(0xD1342543DE82EF95) + h[k:m + k]
    window ^= of[:m].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    at = np.flatnonzero(of[:m] == of[WINDOW - 1:])
    order = at[np.argsort(window[at])]
    same = window[order[1:]] == window[order[:-1]]
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    step = np.zeros(len(h) + 1, np.int64)
    hit = order[twice]
    np.add.at(step, hit, 1)
    np.add.at(step, hit + WINDOW, -1)
    inside = np.cumsum(step[:-1]) > 0
    return np.bincount(of[inside], minlength=n)


def measures(docs: DataFrame, model: CharModel, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """The base rules' counts and the text's log probability, one row per row."""
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("t"),
                       F.col(lang_col).cast("string").alias("g"))
    kind = rows.schema[0].dataType.simpleString()
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "events")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, texts = b.num_rows, b.column(1).to_pylist()
            lang = np.array([lang_code(x) for x in b.column(2).to_pylist()], np.int64)
            x = {c: np.zeros(n, np.int64) for c in counts}
            log_p, hashes, owners = np.zeros(n), [], []
            for piece_of, of, words in hashed_blocks(texts, lower=False, limit=BLOCK):
                symbol = np.flatnonzero(_SYMBOL[words.data])
                if len(symbol):
                    x["n_symbols"] += np.bincount(
                        piece_of[np.searchsorted(words.piece_ends, symbol, side="right")], minlength=n)
                if not len(of):
                    continue
                first_bytes = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
                chars = first_bytes[words.end] - first_bytes[words.start]
                x["n_words"] += np.bincount(of, minlength=n)
                x["word_chars"] += np.bincount(of, weights=chars, minlength=n).astype(np.int64)
                d = DistinctWords(words, lang[of])
                p = np.add.reduceat(model.log_p(d.gram), d.first)
                log_p += np.bincount(of, weights=p[d.inverse], minlength=n)
                x["events"] += np.bincount(of, weights=d.events[d.inverse], minlength=n).astype(np.int64)
                hashes.append(words.hash)
                owners.append(of)
            if hashes:
                x["n_repeat_words"] = _repeat_words(np.concatenate(hashes), np.concatenate(owners), n)
            x["n_dup_lines"] = np.array([_repeated_lines(t) for t in texts], np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), *(pa.array(x[c].astype(np.int64)) for c in counts), pa.array(log_p)],
                ["id", "lang", *counts, "log_p"])

    longs = ", ".join(f"{c} long" for c in counts)
    return rows.mapInArrow(run, f"id {kind}, lang string, {longs}, log_p double").withColumnRenamed(
        "id", id_col)


def judge(docs: DataFrame, width: float = 3.5, least_docs: int = 20, id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per row: the base counts, ``base_failed``, ``perplexity``,
    ``lower``, ``upper`` and ``kept``.

    Base rules: fewer than 20 words, or over 30 % of the words in repeated
    8-word windows.  Perplexity is per byte and word end.  A language's band is
    the median log perplexity of its documents that pass the base rules, and
    ``width`` robust deviations to either side: 1.4826 times the median deviation
    of those above, and of those below.  A language with fewer than
    ``least_docs`` such documents, or without a deviation, takes that of all
    documents from their languages' medians.  A document outside its band is
    rejected.  Short
    texts' estimates scatter more, so a document's band is widened by what 60
    words would vary.  Null languages form one group.  Null and empty texts have
    no words and fail the base rules; repeated rows come back as often.
    """
    model = fit(docs, text_col, lang_col)
    x = written(measures(docs, model, id_col, text_col, lang_col), "text_measures")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    x = x.withColumn("base_failed", failed).withColumn(
        "log_ppl", F.when(F.col("events") > 0, -F.col("log_p") / F.col("events")))
    x = x.withColumn("g", F.coalesce(F.concat(F.lit("g"), "lang"), F.lit("n")))
    sound = x.filter(~F.col("base_failed"))
    middle = sound.groupBy("g").agg(F.percentile_approx("log_ppl", 0.5, 10_000).alias("m"))
    middle = written(middle, "ppl_medians")
    off = sound.join(middle, "g").select("g", "m", (F.col("log_ppl") - F.col("m")).alias("off"))
    spreads = [(1.4826 * F.percentile_approx(F.when(s * F.col("off") >= 0, s * F.col("off")),
                                             0.5, 10_000)).alias(n) for s, n in ((1, "above"), (-1, "below"))]
    every = off.agg(*spreads).first()
    own = off.groupBy("g").agg(F.first("m").alias("m"), F.count("*").alias("n"), *spreads)
    band = written(own.select(F.col("g").alias("of"), "m", *(
        F.when((F.col("n") >= least_docs) & (F.col(c) > 0), F.col(c)).otherwise(
            F.lit(every[c] or None).cast("double")).alias(c) for c in ("above", "below"))), "ppl_bands")
    x = x.join(band, F.col("g") == F.col("of"), "left")
    wide = width * F.sqrt(1 + 60 / F.greatest(F.lit(1), F.col("n_words")))
    low, high = F.col("m") - wide * F.col("below"), F.col("m") + wide * F.col("above")
    inside = (F.coalesce(F.col("log_ppl") >= low, F.lit(True))
              & F.coalesce(F.col("log_ppl") <= high, F.lit(True)))
    return x.select(id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", F.exp("log_ppl").alias("perplexity"),
                    F.exp(low).alias("lower"), F.exp(high).alias("upper"),
                    (~F.col("base_failed") & inside).alias("kept"))
