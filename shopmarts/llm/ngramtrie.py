"""Language-model scoring with an Elias-Fano n-gram trie.

Training is three counting jobs (words, pairs, triples) over the documents; each
sends sorted, delta-coded counts to key ranges, and each range is written as one
file of the shared folder.  Scoring tasks memory-map the files.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmarts.llm.arrayfiles import read_arrays, write_arrays
from shopmarts.llm.eliasfano import EliasFano
from shopmarts.llm.wordblocks import hashed_blocks
from shopmarts.session import remove_path, shared_path

BEGIN, END = np.uint64(0), np.uint64(1)      # reserved word hashes
CHUNK = 1 << 19                              # tokens looked up together
FLUSH = 1 << 22                              # counted keys a task holds before it sends them
MOST_PARTS = 4096                            # ranges of a level
GRID = 2048                                  # steps of the quantised log2 in one halving
BASE_ADD = 0.1


# ---------------------------------------------------------------- token sequences


def sequences(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """``(tokens, text_index)``: for each text BEGIN, its words' hashes, END."""
    hashes, owners = [], []
    for _, word_text, words in hashed_blocks(texts):
        hashes.append(np.maximum(words.hash, np.uint64(2)))
        owners.append(word_text)
    n = len(texts)
    h = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
    of = np.concatenate(owners).astype(np.int64) if owners else np.empty(0, np.int64)
    counts = np.bincount(of, minlength=n)
    start = np.concatenate([[0], np.cumsum(counts + 2)])[:n]
    out, text = np.empty(len(h) + 2 * n, np.uint64), np.repeat(np.arange(n), counts + 2)
    out[start] = BEGIN
    out[start + counts + 1] = END
    out[np.arange(len(h)) + 2 * of + 1] = h
    return out, text


def _chunks(tokens: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """``(start, lead, part)``: parts with up to two tokens of lead-in."""
    for s in range(0, len(tokens), CHUNK):
        lead = min(s, 2)
        yield s, lead, tokens[s - lead:s + CHUNK]


# ---------------------------------------------------------------- counts on the way


def _planes(a: np.ndarray) -> bytes:
    """Bytes of equal rank side by side: leading zeros compress to nothing."""
    return a.view(np.uint8).reshape(len(a), -1).T.tobytes()


def _unplanes(data: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).ravel()


def _packed(a: np.ndarray) -> np.ndarray:
    return np.frombuffer(zlib.compress(_planes(a), 1), np.uint8)


def _unpacked(a: np.ndarray, kind: str) -> np.ndarray:
    return _unplanes(zlib.decompress(a.tobytes()), kind)


def _release(spark) -> None:
    """Let Spark's cleaner drop the shuffle files of jobs that are done: it does
    so when the driver's collector finds them unused.  Best effort."""
    try:
        spark.sparkContext._jvm.System.gc()
    except Exception:
        pass


def summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their counts."""
    if not len(keys):
        return keys, np.empty(0, np.int64)
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    if counts is None:
        return keys[first], np.diff(np.append(first, len(keys)))
    return keys[first], np.add.reduceat(counts, first)


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A position of each distinct key, by rising key, and each position's key's
    number among them; as ``np.unique``, without its slower stable sort."""
    order = np.argsort(keys)
    own = keys[order]
    new = np.concatenate([np.ones(min(1, len(own)), bool), own[1:] != own[:-1]])
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


class Sender:
    """Collects keys and sends sorted counts, one row for each range."""

    def __init__(self, range_of):
        self.range_of, self.held, self.size = range_of, [], 0

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append(keys)
        self.size += len(keys)
        if self.size >= FLUSH:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        keys, counts = summed(np.concatenate(self.held))
        self.held, self.size = [], 0
        to = self.range_of(keys)
        cut = np.concatenate([[0], np.flatnonzero(to[1:] != to[:-1]) + 1, [len(to)]])
        for s, e in zip(cut, cut[1:]):
            k = keys[s:e]
            step = np.concatenate([k[:1], np.diff(k)]).astype("<u8")
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(to[s])], pa.int32()), pa.array([_planes(step)], pa.binary()),
                 pa.array([_planes(counts[s:e].astype("<u4"))], pa.binary())],
                ["part", "steps", "counts"])


SENT = "part int, steps binary, counts binary"


def _received(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Each range with the merged counts of all that was sent to it."""
    part, keys, counts = None, [], []
    for b in batches:
        for p, s, c in zip(*(col.to_pylist() for col in b.columns)):
            if p != part and keys:
                yield (part, *summed(np.concatenate(keys), np.concatenate(counts)))
                keys, counts = [], []
            part = p
            keys.append(np.cumsum(_unplanes(s, "<u8"), dtype=np.uint64))
            counts.append(_unplanes(c, "<u4").astype(np.int64))
    if keys:
        yield (part, *summed(np.concatenate(keys), np.concatenate(counts)))


# ---------------------------------------------------------------- the model's files


def _by_part(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each file's number and the positions that ask for it."""
    part = part.astype(np.int16 if len(part) and part.max() < 1 << 15 else np.int32)
    order = np.argsort(part, kind="stable")
    own = part[order]
    cut = np.concatenate([[0], np.flatnonzero(np.diff(own)) + 1, [len(own)]]) if len(own) else [0]
    for s, e in zip(cut[:-1], cut[1:]):
        yield int(own[s]), order[s:e]


@dataclass
class Level:
    """N-grams of one length as an Elias-Fano sequence by context.

    In a file, a context's n-grams are the values base(context) + word id; the
    bases are a monotone pointer sequence of their own.
    """

    folder: str
    name: str
    first: list[int]                       # a file's first n-gram number
    context: list[tuple[int, int]]         # a file's first context and number of contexts
    border: tuple = ((), ())               # contexts that lie in several files, and their backoff
    files: dict = field(default_factory=dict)

    def file(self, s: int):
        if s not in self.files:
            a = read_arrays(self.folder, f"{self.name}-{s}")
            self.files[s] = (EliasFano(a, "base_"), EliasFano(a, "gram_"), a)
        return self.files[s]

    def query(self, context: np.ndarray, word: np.ndarray, part: np.ndarray):
        """``(number, share, backoff)`` of n-grams: number -1 and share 0 where the
        n-gram is not there; backoff 1 where the context is not.  Each distinct
        n-gram is looked up once."""
        if not len(context):
            return np.empty(0, np.int64), np.empty(0), np.empty(0)
        wide = np.uint64(int(word.max()) + 1)
        first, inverse = distinct(context.astype(np.uint64) * wide + word.astype(np.uint64))
        context, word, part = context[first], word[first], part[first]
        n = len(first)
        number, share, backoff = np.full(n, -1, np.int64), np.zeros(n), np.ones(n)
        if len(self.border[0]):
            k = np.minimum(np.searchsorted(self.border[0], context), len(self.border[0]) - 1)
            backoff = np.where(self.border[0][k] == context, self.border[1][k], 1.0)
        for p, at in _by_part(part):
            low, size = self.context[p]
            j = context[at] - low
            inside = np.flatnonzero((j >= 0) & (j < size))
            if not len(inside):
                continue
            at, j = at[inside], j[inside]
            base, gram, a = self.file(p)
            backoff[at] = _unquantised(a["backoff"][j])
            # contexts are in order, so equal ones stand together
            new = np.concatenate([[True], j[1:] != j[:-1]])
            own = np.cumsum(new) - 1
            begin, end = base.access_two(j[new])
            want = begin[own] + word[at].astype(np.uint64)
            ok = np.flatnonzero(want < end[own])
            found = gram.find(want[ok])
            hit = np.flatnonzero(found >= 0)
            number[at[ok[hit]]] = found[hit] + self.first[p]
            share[at[ok[hit]]] = _unquantised(a["share"][found[hit]])
        return number[inverse], share[inverse], backoff[inverse]

    def counts(self, number: np.ndarray) -> np.ndarray:
        out = np.zeros(len(number), np.int64)
        part = np.searchsorted(np.array(self.first), number, side="right") - 1
        for p, at in _by_part(part):
            a, k = self.file(p)[2], number[at] - self.first[p]
            out[at] = a["count"][k]
            large = np.flatnonzero(out[at] == 255)
            out[at[large]] = a["large"][np.searchsorted(a["large_at"], k[large])]
        return out


def _quantised(x: np.ndarray) -> np.ndarray:
    """Shares as whole steps of -log2, rounded so that sums never pass one."""
    with np.errstate(divide="ignore"):
        q = np.ceil(-np.log2(np.maximum(x, 0)) * GRID - 1e-9)
    return np.minimum(np.maximum(q, 0), 65535).astype(np.uint16)


_STEPS = np.append(2.0 ** (-np.arange(65535) / GRID), 0.0)


def _unquantised(q: np.ndarray) -> np.ndarray:
    return _STEPS[q]


@dataclass
class Vocabulary:
    folder: str
    first: list[int]            # a file's first word id
    before: list[int]           # tokens of all words in earlier files
    n_words: int                # distinct words
    word_tokens: int
    n_docs: int
    files: dict = field(default_factory=dict)

    @property
    def tokens(self) -> int:
        return self.word_tokens + self.n_docs

    def lookup(self, tokens: np.ndarray):
        """``(id, tokens of smaller ids, count)`` of word hashes; id -1 if unknown.
        END has the id ``n_words``; BEGIN is unknown here.  Each distinct hash is
        looked up once."""
        first, inverse = distinct(tokens)
        tokens = tokens[first]
        ids = np.full(len(tokens), -1, np.int64)
        before, count = np.zeros(len(tokens), np.int64), np.zeros(len(tokens), np.int64)
        part = _hash_range(tokens, len(self.first)).astype(np.int32)
        part[tokens <= END] = len(self.first)
        for p, at in _by_part(part):
            if p == len(self.first):
                continue
            if p not in self.files:
                self.files[p] = read_arrays(self.folder, f"words-{p}")
            words, upto = self.files[p]["hash"], self.files[p]["upto"]
            if not len(words):
                continue
            k = np.minimum(np.searchsorted(words, tokens[at]), len(words) - 1)
            hit = np.flatnonzero(words[k] == tokens[at])
            k, at = k[hit], at[hit]
            ids[at] = k + self.first[p]
            before[at] = upto[k] + self.before[p]
            count[at] = upto[k + 1] - upto[k]
        end = tokens == END
        ids[end], count[end] = self.n_words if self.n_docs else -1, self.n_docs
        return ids[inverse], before[inverse], count[inverse]


def _hash_range(h: np.ndarray, parts: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


@dataclass
class NgramTrie:
    """The model: vocabulary, and levels of pairs and triples."""

    words: Vocabulary
    parts: int
    pairs: Level | None = None
    triples: Level | None = None
    n_pairs: int = 0

    def pair_part(self, before: np.ndarray, count: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The range of a pair: contexts take room by their count, and a context's
        pairs spread over its room by word, so a frequent one spans many ranges."""
        w = self.words
        at = before + count * (word / (w.n_words + 1))
        return np.minimum((at * (self.parts / max(1, w.tokens))).astype(np.int64), self.parts - 1)

    def triple_part(self, context: np.ndarray) -> np.ndarray:
        return context * self.parts // max(1, self.n_pairs)

    def look(self, tokens: np.ndarray) -> dict[str, np.ndarray]:
        """Ids and n-grams that end at each token (in one or more sequences)."""
        w = self.words
        word, before, count = w.lookup(tokens)
        context = np.where(tokens == END, -1, word)
        begin = tokens == BEGIN
        context[begin], before[begin], count[begin] = w.n_words, w.word_tokens, w.n_docs
        # an unknown word has a number of its own, of which there are no n-grams,
        # so what its context leaves to the lower order is still found
        code = np.where(word < 0, w.n_words + 1, word)
        prev = np.flatnonzero((context[:-1] >= 0) & ~begin[1:])
        part = self.pair_part(before[prev], count[prev], np.minimum(code[prev + 1], w.n_words))
        return {"word": word, "code": code, "count": count, "pair_at": prev + 1,
                "pair_context": context[prev], "pair_word": code[prev + 1], "pair_part": part}

    def look_pairs(self, tokens: np.ndarray) -> dict[str, np.ndarray]:
        """As ``look``, and the pair that ends at each token with its terms."""
        x = self.look(tokens)
        n = len(tokens)
        number, share, backoff = (np.full(n, -1, np.int64), np.zeros(n), np.ones(n))
        k = x["pair_at"]
        number[k], share[k], backoff[k] = self.pairs.query(
            x["pair_context"], x["pair_word"], x["pair_part"])
        return x | {"pair": number, "pair_share": share, "pair_backoff": backoff}

    def log10(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(base, model, known)`` log10 probabilities of every token."""
        x, w = self.look_pairs(tokens), self.words
        distinct = w.n_words + (1 if w.n_docs else 0)
        base = (x["count"] + BASE_ADD) / (w.tokens + BASE_ADD * (distinct + 1))
        p = x["pair_share"] + x["pair_backoff"] * base
        if self.triples is not None:
            at = np.flatnonzero((x["pair"][:-1] >= 0) & (tokens[1:] != BEGIN)) + 1
            context = x["pair"][at - 1]
            _, share, backoff = self.triples.query(context, x["code"][at], self.triple_part(context))
            p[at] = share + backoff * p[at]
        return np.log10(base), np.log10(p), x["word"] >= 0


# ---------------------------------------------------------------- training


def held_out(id_col: str) -> Column:
    """Whether a document is kept from training, by its id as text (null: empty)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 10 == 0


def _texts(docs: DataFrame, text_col: str) -> DataFrame:
    return docs.select(F.col(text_col).cast("string").alias("t"))


def _ranges(sent: DataFrame, parts: int) -> DataFrame:
    return sent.repartition(parts, "part").sortWithinPartitions("part")


def train(docs: DataFrame, text_col: str = "text", least_triple: int = 2) -> NgramTrie:
    """Count all words, pairs and triples of ``docs`` and write the model.

    The smoothing is interpolated absolute discounting: all orders use raw
    counts, with three discounts an order (Chen and Goodman's formula) from its
    counts of counts; the lowest order is the add-0.1 word distribution.  With
    ``least_triple`` 1 all triples are kept and the counts of counts are whole.
    A larger one prunes: triples below it go, those with a rarer pair are not
    counted at all, and the triples' discounts come from what is counted.  Ranges (and files of a level)
    number twice the input's partitions, at most ``MOST_PARTS``: a task sends one
    row to each range, so more would make the rows many and small.
    """
    spark = docs.sparkSession
    folder = shared_path(spark, "llm", "ngram_trie", unique=True)
    parts = min(MOST_PARTS, max(4, 2 * docs.rdd.getNumPartitions()))
    texts = _texts(docs, text_col)
    trie = NgramTrie(_count_words(texts, folder, parts), parts)
    _count_pairs(texts, folder, trie)
    if trie.n_pairs:
        _count_triples(texts, folder, trie, least_triple)
    return trie


def _count_words(texts: DataFrame, folder: str, parts: int) -> Vocabulary:
    def send(batches):
        out = Sender(lambda k: _hash_range(k, parts))
        for b in batches:
            tokens, _ = sequences(b.column(0).to_pylist())
            yield from out.add(tokens[tokens > END])
        yield from out.flush()

    def write(batches):
        for part, keys, counts in _received(batches):
            write_arrays(folder, f"words-{part}", {
                "hash": keys, "upto": np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)})
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()),
                                              "n": [len(keys)], "tokens": [int(counts.sum())]})

    found = _ranges(texts.mapInArrow(send, SENT), parts).mapInArrow(
        write, "part int, n long, tokens long").collect()          # one row per range
    rows = {r["part"]: r for r in found}
    for p in set(range(parts)) - set(rows):
        write_arrays(folder, f"words-{p}", {"hash": np.empty(0, np.uint64), "upto": np.zeros(1, np.int64)})
    n = [rows[p]["n"] if p in rows else 0 for p in range(parts)]
    t = [rows[p]["tokens"] if p in rows else 0 for p in range(parts)]
    return Vocabulary(folder, _starts(n), _starts(t), sum(n), sum(t), texts.count())


def _starts(sizes: list[int]) -> list[int]:
    return [0, *np.cumsum(sizes).tolist()][:len(sizes)]


RAW = ("part int, n long, ones array<long>, edge array<long>, edge_tokens array<long>, "
       "edge_counts array<array<long>>")


def _write_raw(folder: str, name: str, wide: int, least: int):
    """Writes merged counts of a range; returns its counts of counts, and what its
    first and last context have in it (they may go on in the next range)."""
    def write(batches):
        for part, keys, counts in _received(batches):
            ones = [int((counts == k).sum()) for k in (1, 2, 3, 4)]
            keys, counts = keys[counts >= least], counts[counts >= least]
            step = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
            write_arrays(f"{folder}/raw", f"{name}-{part}", {
                "steps": _packed(step), "counts": _packed(counts.astype("<u4"))})
            context = keys // np.uint64(wide)
            edge = sorted({int(c) for c in (*context[:1], *context[-1:])})
            own = [counts[context == np.uint64(c)] for c in edge]
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "n": [len(keys)], "ones": [ones],
                "edge": pa.array([edge], pa.list_(pa.int64())),
                "edge_tokens": pa.array([[int(c.sum()) for c in own]], pa.list_(pa.int64())),
                "edge_counts": pa.array([[[int((c == 1).sum()), int((c == 2).sum()), int((c >= 3).sum())]
                                          for c in own]], pa.list_(pa.list_(pa.int64())))})
    return write


def discounts(ones: list[int]) -> np.ndarray:
    """Absolute discounts (Chen and Goodman) for counts 0, 1, 2 and 3 or more."""
    n1, n2, n3, n4 = (max(1, x) for x in ones)
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.array([0.0, *(min(max(x, 0.05), k - 0.05) for k, x in enumerate(d, 1))])


def _discounted(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    return counts - d[np.minimum(counts, 3)]


def _build(spark, folder: str, name: str, rows: list, wide: int, d: np.ndarray, parts: int,
           keep_counts: bool, totals, border: tuple = ((), ())) -> Level:
    """One file for each range from its raw counts.  ``totals(context, tokens)``
    gives the contexts' occurrences from their numbers and tokens in the range."""
    sizes = {r["part"]: r["n"] for r in rows}
    edges = {c: g for c, g in zip(border[0], border[1])}

    def build(batches):
        for b in batches:
            for part in b.column(0).to_pylist():
                raw = read_arrays(f"{folder}/raw", f"{name}-{part}")
                keys = np.cumsum(_unpacked(raw["steps"], "<u8"), dtype=np.uint64)
                counts = _unpacked(raw["counts"], "<u4").astype(np.int64)
                context = (keys // np.uint64(wide)).astype(np.int64)
                word = (keys % np.uint64(wide)).astype(np.int64)
                low, n = int(context[0]), int(context[-1] - context[0]) + 1
                first = np.searchsorted(context, np.arange(low, low + n + 1))
                some = first[1:] > first[:-1]
                room = np.zeros(n, np.int64)
                room[some] = word[first[1:][some] - 1] + 1
                base = np.concatenate([[0], np.cumsum(room)])
                tokens = np.zeros(n, np.int64)
                tokens[some] = np.add.reduceat(counts, first[:-1][some])
                total = totals(low + np.arange(n), tokens)
                left = _discounted(counts, d)
                share = left / total[context - low]
                kept = np.zeros(n)
                kept[some] = np.add.reduceat(left, first[:-1][some])
                backoff = np.where(total > 0, 1 - kept / np.maximum(total, 1), 1.0)
                for c in {low, low + n - 1} & edges.keys():
                    backoff[c - low] = edges[c]
                arrays = {"share": _quantised(share), "backoff": _quantised(backoff),
                          **EliasFano.encode(base, "base_"),
                          **EliasFano.encode(base[context - low] + word, "gram_")}
                if keep_counts:
                    # most counts fit a byte; the others stand apart
                    large = np.flatnonzero(counts >= 255)
                    arrays |= {"count": np.minimum(counts, 255).astype(np.uint8),
                               "large_at": large, "large": counts[large]}
                write_arrays(folder, f"{name}-{part}", arrays)
                yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()),
                                                  "low": [low], "n": [n]})

    full = [p for p in sorted(sizes) if sizes[p]]
    _release(spark)                                # the raw counts are written
    todo = spark.createDataFrame([(p,) for p in full], "part int").repartition(max(1, len(full)))
    got = {r["part"]: r for r in todo.mapInArrow(build, "part int, low long, n long").collect()}
    remove_path(spark, f"{folder}/raw")
    return Level(folder, name, _starts([sizes.get(p, 0) for p in range(parts)]),
                 [(got[p]["low"], got[p]["n"]) if p in got else (0, 0) for p in range(parts)],
                 (np.array(border[0], np.int64), np.array(border[1])))


def _count_pairs(texts: DataFrame, folder: str, trie: NgramTrie) -> None:
    wide, parts = trie.words.n_words + 1, trie.parts

    def send(batches):
        out = PairSender(trie)
        for b in batches:
            tokens, _ = sequences(b.column(0).to_pylist())
            for _, lead, part in _chunks(tokens):
                yield from out.add_pairs(part, lead)
        yield from out.flush()

    rows = _ranges(texts.mapInArrow(send, SENT), parts).mapInArrow(
        _write_raw(folder, "pairs", wide, 1), RAW).collect()        # one row per range
    d = discounts(np.sum([r["ones"] for r in rows], axis=0).tolist() if rows else [0] * 4)
    edge: dict[int, np.ndarray] = {}
    for r in rows:
        for c, t, k in zip(r["edge"], r["edge_tokens"], r["edge_counts"]):
            edge[c] = edge.get(c, np.zeros(4)) + np.array([t, *k], float)
    several = sorted(edge)
    total = {c: edge[c][0] for c in several}
    backoff = [float(edge[c][1:] @ d[1:] / edge[c][0]) for c in several]

    def totals(context, tokens):
        out = tokens.astype(float)
        for k in (0, len(out) - 1):                # an edge context's other ranges count too
            out[k] = total[int(context[k])]
        return out

    trie.n_pairs = sum(r["n"] for r in rows)
    trie.pairs = _build(texts.sparkSession, folder, "pairs", rows, wide, d, parts, True, totals,
                        (several, backoff))


class PairSender(Sender):
    """Sends pairs; keys are context * wide + word, and their range follows the
    context's place among the tokens, noted when the key was made."""

    def __init__(self, trie: NgramTrie):
        super().__init__(None)
        self.trie, self.parts = trie, []

    def add_pairs(self, tokens: np.ndarray, lead: int) -> Iterator[pa.RecordBatch]:
        x = self.trie.look(tokens)
        new = x["pair_at"] >= lead
        wide = np.uint64(self.trie.words.n_words + 1)
        keys = x["pair_context"][new].astype(np.uint64) * wide + x["pair_word"][new].astype(np.uint64)
        self.parts.append(x["pair_part"][new])
        yield from self.add(keys)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            # parts rise with the keys, so sorted keys and sorted parts belong together
            keys, parts = np.sort(np.concatenate(self.held)), np.sort(np.concatenate(self.parts))
            first = np.concatenate([[True], keys[1:] != keys[:-1]])
            parts = parts[first]
            self.range_of = lambda _: parts
            self.parts = []
        yield from super().flush()


def _count_triples(texts: DataFrame, folder: str, trie: NgramTrie, least: int) -> None:
    wide, parts = trie.words.n_words + 1, trie.parts

    def send(batches):
        out = Sender(lambda k: trie.triple_part((k // np.uint64(wide)).astype(np.int64)))
        for b in batches:
            tokens, _ = sequences(b.column(0).to_pylist())
            for _, lead, part in _chunks(tokens):
                x = trie.look_pairs(part)
                pair = x["pair"]
                often = pair >= 0
                if least > 1:
                    have = np.flatnonzero(often)
                    often[have] = trie.pairs.counts(pair[have]) >= least
                at = np.flatnonzero(often[:-1] & often[1:] & (part[1:] != BEGIN)) + 1
                at = at[at >= lead]
                yield from out.add(pair[at - 1].astype(np.uint64) * np.uint64(wide)
                                   + x["word"][at].astype(np.uint64))
        yield from out.flush()

    rows = _ranges(texts.mapInArrow(send, SENT), parts).mapInArrow(
        _write_raw(folder, "triples", wide, least), RAW).collect()  # one row per range
    d = discounts(np.sum([r["ones"] for r in rows], axis=0).tolist() if rows else [0] * 4)
    pairs = trie.pairs
    trie.triples = _build(texts.sparkSession, folder, "triples", rows, wide, d, parts, False,
                          lambda context, tokens: pairs.counts(context).astype(float))


# ---------------------------------------------------------------- scoring


def lm_scores(docs: DataFrame, trie: NgramTrie, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """``id_col, n_tokens, n_known, base_score, score`` of every row.

    Tokens are the text's words and one end.  ``base_score`` is the add-0.1 word
    model; ``score`` interpolates it with pairs and triples.  A null or empty
    text is one end token; repeated rows come back as often; other columns are
    not read.  With no training tokens both scores are the base's.
    """
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("t"))
    kind = rows.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            tokens, text = sequences(b.column(1).to_pylist())
            base, score = np.zeros(n), np.zeros(n)
            known, size = np.zeros(n, np.int64), np.zeros(n, np.int64)
            for s, lead, part in _chunks(tokens):
                own = text[s:s + CHUNK]
                count = part[lead:] != BEGIN
                p, q, k = (v[lead:] for v in trie.log10(part))
                of = own[count]
                base += np.bincount(of, weights=p[count], minlength=n)
                score += np.bincount(of, weights=q[count], minlength=n)
                known += np.bincount(of, weights=k[count], minlength=n).astype(np.int64)
                size += np.bincount(of, minlength=n)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(size), pa.array(known), pa.array(base), pa.array(score)],
                ["id", "n_tokens", "n_known", "base_score", "score"])

    out = rows.mapInArrow(run, f"id {kind}, n_tokens long, n_known long, base_score double, score double")
    return out.withColumnRenamed("id", id_col)
