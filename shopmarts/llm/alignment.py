"""Alignment of two tokenizers' tokens by interval coalescing."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmarts.llm.storage import written
from shopmarts.llm.tokencounts import BYTE_CHARS, is_byte_level, load

# one thread a task: Spark places the tasks
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

PIECE = 1 << 20
BLOCK = 2 << 20
JOINED = 1 << 18
_UNITS = 500_000
_RUN = re.compile(r"(?<=\S)(?=[ \n])")
_TWO_SPACES = re.compile(r"\s\s")
_CUT = re.compile(r"(?<=\S)(?= .)", re.DOTALL)
_TABLES: dict[tuple[str, str], "Units"] = {}


def text_pieces(text: str) -> Iterator[str]:
    """``text`` in pieces of about a million characters, cut before a space between
    other characters: neither tokenizer has a token across such a place.  A longer
    run without one makes a longer piece."""
    start = 0
    while start < len(text):
        end = len(text)
        if end - start > PIECE:
            cut = _CUT.search(text, start + PIECE)
            end = cut.start() if cut else end
        yield text[start:end]
        start = end


class ByteBpe:
    """Tokenizer A."""

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.tokenizer.encode_special_tokens = True      # their strings are plain text
        byte_of = {c: b for b, c in BYTE_CHARS.items()}
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.token = [b""] * self.tokenizer.get_vocab_size()
        for s, i in vocab.items():
            self.token[i] = bytes(byte_of[c] for c in s)
        self.name = self.token.__getitem__

        # its pre-tokens never join other characters with a white space after them
        self.by_units = is_byte_level(self.tokenizer)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class PieceBpe:
    """Tokenizer B, which puts the space before a text itself."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.token = [bytes([int(s[3:5], 16)]) if self.model.is_byte(i)
                      else s.replace("▁", " ").encode() for i, s in enumerate(pieces)]
        self.name = self.token.__getitem__

        # no piece joins other characters with a space or line break after them, and
        # a line break keeps apart what stands before it
        self.by_units = (not any(b" " in t.lstrip(b" ") or b"\n" in t[1:] for t in self.token)
                         and len(self.model.encode("\n")) == 2)

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of units, without the space that the model puts first."""
        if self.by_units:
            return [x[2:] for x in self.model.encode(["\n" + t for t in texts], num_threads=1)]
        return self.model.encode([t[1:] for t in texts], num_threads=1)


def coalesce(size_a: np.ndarray, size_b: np.ndarray) -> tuple[np.ndarray, ...]:
    """Groups and links of two tokenizations of the same bytes.

    ``size_a`` and ``size_b`` are token lengths in bytes, each adding up to all
    bytes.  Returns ``group_a, group_b`` (the group's number of every token) and
    ``link_a, link_b`` (positions of every overlapping pair, by A).  All tokens
    are sorted by start; a group breaks where a start reaches the running
    maximum of the ends, which is where an A and a B token both end.
    """
    end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
    start = np.concatenate([end_a - size_a, end_b - size_b])
    end = np.concatenate([end_a, end_b])
    side = np.repeat([0, 1], [len(end_a), len(end_b)])
    order = np.lexsort((side, start))
    reach = np.maximum.accumulate(end[order])
    fresh = np.ones(len(order), bool)
    fresh[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(fresh) - 1
    # overlaps: an A token meets the B tokens from the one that ends after its
    # start to the last that starts before its end
    first = np.searchsorted(end_b, end_a - size_a, side="right")
    last = np.searchsorted(end_b - size_b, end_a, side="left")
    n = last - first
    link_a = np.repeat(np.arange(len(end_a)), n)
    link_b = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    return group[:len(end_a)], group[len(end_a):], link_a, link_b


class Units(dict):
    """Aligned units of texts, each aligned once.

    A unit is a run that begins at a space or line break after other text.  Both
    tokenizers cut there, so a text's tokens are those of its units end to end,
    and no group crosses a unit's end.  Where a tokenizer does not promise that,
    a whole text is one unit.  The mapping gives a unit's number; its key is the
    unit, without its space if another character follows that.  The table is
    emptied when full, so memory is bounded.
    """

    def __init__(self, path_a: str, path_b: str):
        super().__init__()
        self.a, self.b = ByteBpe(path_a), PieceBpe(path_b)
        self.by_units = self.a.by_units and self.b.by_units
        if max(len(self.a.token), len(self.b.token)) > 1 << 16:
            raise ValueError("a tokenizer has ids over 16 bits")
        self.size_a = np.fromiter(map(len, self.a.token), np.int64)
        self.size_b = np.fromiter(map(len, self.b.token), np.int64)
        # every id in decimal with each separator that may follow it
        n = max(len(self.size_a), len(self.size_b))
        self.digits = np.array([f"{i}{sep}" for i in range(n) for sep in (",", "|", ";", "")], object)
        self.empty()

    def empty(self) -> None:
        self.clear()
        self.counts = np.empty((5, 0), np.int64)     # n_a, n_b, n_groups, n_links, bad
        self.links = np.empty(0, np.int64)           # a << 16 | b of all units, end to end
        self.groups: list[str] = []

    def keys_of(self, text: str | None) -> list[str]:
        """The keys of all units of space+``text``; none of a null or empty text."""
        if not text:
            return []
        if not self.by_units:
            return [" " + text]
        if not text[0].isspace() and len(text) <= PIECE and not _TWO_SPACES.search(text):
            return text.replace("\n", " \n").split(" ")
        units = [u for p in text_pieces(" " + text) for u in _RUN.split(p)]
        return [u[1:] if u[0] == " " and u[1:2] not in (" ", "\n") else u for u in units]

    def add(self, keys: list[str]) -> None:
        """Align new units: all their tokens end to end."""
        texts = keys if not self.by_units else [k if k[:1] in (" ", "\n") and k else " " + k
                                                for k in keys]
        (a, n_a, bad_a), (b, n_b, bad_b) = (
            self._tokens(m, size, texts) for m, size in ((self.a, self.size_a), (self.b, self.size_b)))
        bad = bad_a | bad_b
        a, b = a[~np.repeat(bad, n_a)], b[~np.repeat(bad, n_b)]
        n_a, n_b = np.where(bad, 0, n_a), np.where(bad, 0, n_b)
        group_a, group_b, link_a, link_b = coalesce(self.size_a[a], self.size_b[b])
        of_a, of_b = np.repeat(np.arange(len(keys)), n_a), np.repeat(np.arange(len(keys)), n_b)
        new = np.ones(len(group_a), bool)            # every group has an A token
        new[1:] = group_a[1:] != group_a[:-1]
        n_groups = np.bincount(of_a[new], minlength=len(keys))
        n_links = np.bincount(of_a[link_a], minlength=len(keys))
        said = self._listed(np.concatenate([a, b]), np.concatenate([group_a, group_b]),
                            np.repeat([0, 1], [len(a), len(b)]), np.concatenate([of_a, of_b]))
        ends = np.cumsum(n_a + n_b).tolist()
        first = len(self)
        self.update(zip(keys, range(first, first + len(keys))))
        self.counts = np.hstack([self.counts, np.stack([n_a, n_b, n_groups, n_links, bad])])
        self.links = np.concatenate([self.links, a[link_a] << 16 | b[link_b]])
        self.groups += ["".join(said[s:e]) for s, e in zip([0, *ends], ends)]

    def _tokens(self, model, size: np.ndarray, texts: list[str]) -> tuple[np.ndarray, ...]:
        """All units' ids end to end, their number in each unit, and whether a unit
        does not get back its bytes.

        Units are encoded joined, as they stand in texts, where the joined tokens
        give back all bytes and end where units do; else one by one."""
        if self.by_units and texts and not any(t[-1].isspace() for t in texts):
            ends = [0]
            for t in texts:
                ends.append(ends[-1] + len(t))
            cuts = np.unique(np.searchsorted(ends, np.arange(0, ends[-1] + JOINED, JOINED)))
            cuts = [*cuts[cuts < len(texts)].tolist(), len(texts)]
            runs = ["".join(texts[s:e]) for s, e in zip(cuts, cuts[1:])]
            got = model.encode(runs)
            ids, _ = _flat(got)
            end = np.cumsum(np.fromiter((len(t.encode()) for t in texts), np.int64, len(texts)))
            at = np.searchsorted(np.cumsum(size[ids]), end)
            if (np.append(np.cumsum(size[ids]), -1)[at] == end).all() and all(
                    b"".join(map(model.name, x)) == r.encode() for x, r in zip(got, runs)):
                return ids, np.diff(at + 1, prepend=0), np.zeros(len(texts), bool)
        got = model.encode(texts)
        bad = np.fromiter((b"".join(map(model.name, x)) != t.encode() for x, t in zip(got, texts)),
                          bool, len(texts))
        return *_flat(got), bad

    def _listed(self, ids: np.ndarray, group: np.ndarray, side: np.ndarray,
                unit: np.ndarray) -> list[str]:
        """Every token in decimal and the separator after it, in groups: ``,`` inside
        a side, ``|`` between sides, ``;`` between groups, none at a unit's end."""
        order = np.lexsort((side, group))            # stable: tokens stay in order within
        ids, group, side, unit = ids[order], group[order], side[order], unit[order]
        sep = np.full(len(ids), 3)
        sep[:-1] = np.where(unit[1:] != unit[:-1], 3, np.where(
            group[1:] != group[:-1], 2, np.where(side[1:] != side[:-1], 1, 0)))
        return self.digits[ids * 4 + sep].tolist()


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All values end to end, and the length of each list."""
    n = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(n.sum())), n


class Aligned:
    """The aligned documents of one block."""

    def __init__(self, units: Units, texts: list[str | None]):
        if len(units) > _UNITS:
            units.empty()
        keys = [units.keys_of(t) for t in texts]
        new = sorted(set(chain.from_iterable(keys)).difference(units))
        # a unit that ends in white space (at a text's end) can't stand before another
        for some in ([k for k in new if k and not k[-1].isspace()],
                     [k for k in new if not k or k[-1].isspace()]):
            if some:
                units.add(some)
        number, n = _flat([list(map(units.__getitem__, k)) for k in keys])
        doc = np.repeat(np.arange(len(texts)), n)
        # a text with a unit that does not give back its bytes has no tokens
        bad = np.bincount(doc, units.counts[4][number], minlength=len(texts)) > 0
        number, doc = number[~bad[doc]], doc[~bad[doc]]
        ends = np.searchsorted(doc, np.arange(len(texts) + 1))
        self.n_a, self.n_b, self.n_groups, self.n_links = (
            np.diff(np.concatenate([[0], np.cumsum(c[number])])[ends]) for c in units.counts[:4])
        said = [units.groups[i] for i in number.tolist()]
        self.groups = [";".join(said[s:e]) for s, e in zip(ends.tolist(), ends[1:].tolist())]
        # the links of all units in turn
        many = units.counts[3]
        n = many[number]
        links = units.links[np.arange(n.sum()) + np.repeat(
            (np.cumsum(many) - many)[number] - (np.cumsum(n) - n), n)]
        # the block's distinct id pairs, how often each is linked, and how often in each document
        self.pairs, of, self.times = np.unique(links, return_inverse=True, return_counts=True)
        self.cells, self.in_cell = np.unique(np.repeat(doc, n) * len(self.pairs) + of,
                                             return_counts=True)


def _pack(x: np.ndarray) -> bytes:
    """Longs, byte plane by byte plane, so small ones cost little."""
    raw = x.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(x).to_bytes(8, "little") + (pa.Codec("zstd").compress(raw, asbytes=True) if raw else b"")


def _unpack(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    if not n:
        return np.empty(0, np.int64)
    raw = pa.Codec("zstd").decompress(data[8:], 8 * n, asbytes=True)
    return np.frombuffer(raw, np.uint8).reshape(8, n).T.copy().view("<i8").reshape(n)


def _doc_type(id_type: pa.DataType) -> pa.StructType:
    long = pa.int64()
    return pa.struct([("id", id_type), ("n_a", long), ("n_b", long), ("n_groups", long),
                      ("n_links", long), ("groups", pa.string())])


def aligned_blocks(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id",
                   text_col: str = "text", block: int = BLOCK, digest: bool = True) -> DataFrame:
    """One row per block of about ``block`` characters: ``block, docs, pairs, times,
    cells, in_cell``.

    ``docs`` is an array of ``id, n_a, n_b, n_groups, n_links, groups``.  The others
    are packed longs: the block's distinct ``a << 16 | b`` and their links, and for
    each document the places of its pairs in that list (gaps between
    ``document * len(pairs) + place``) and their links in the document.
    """
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    kind = rows.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (path_a, path_b) not in _TABLES:
            _TABLES[path_a, path_b] = Units(path_a, path_b)
        units = _TABLES[path_a, path_b]
        number = TaskContext.get().partitionId() << 36
        keys, texts, size, doc_type = [], [], 0, None

        def made() -> pa.RecordBatch:
            x = Aligned(units, texts)
            said = ([hashlib.sha256(g.encode()).hexdigest() if g else "" for g in x.groups]
                    if digest else x.groups)
            fields = [pa.array(keys, doc_type[0].type), *map(pa.array, (
                x.n_a, x.n_b, x.n_groups, x.n_links)), pa.array(said, pa.string())]
            rows_ = pa.StructArray.from_arrays(fields, fields=list(doc_type))
            packed = (x.pairs, x.times, np.diff(x.cells, prepend=0), x.in_cell)
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.ListArray.from_arrays([0, len(keys)], rows_),
                 *(pa.array([_pack(p)], pa.binary()) for p in packed)],
                ["block", "docs", "pairs", "times", "cells", "in_cell"])

        for b in batches:
            doc_type = _doc_type(b.column(0).type)
            for key, text in zip(b.column(0).to_pylist(), b.column(1)):
                text = text.as_py()
                n = len(text or "") + 16
                if texts and size + n > block:
                    yield made()
                    keys, texts, size, number = [], [], 0, number + 1
                keys.append(key)
                texts.append(text)
                size += n
        if texts:
            yield made()

    return rows.mapInArrow(
        run, f"block long, docs array<struct<id:{kind},n_a:long,n_b:long,n_groups:long,n_links:long,"
             "groups:string>>, pairs binary, times binary, cells binary, in_cell binary")


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for block, pairs, times in zip(*(c.to_pylist() for c in b.columns)):
            pairs = _unpack(pairs)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(pairs), block)), pa.array(pairs), pa.array(_unpack(times))],
                ["block", "pair", "times"])


def pair_counts(pairs: DataFrame) -> DataFrame:
    """``pair, n, best`` from rows of ``pair, times``: a pair's links in the corpus,
    and whether no pair with the same B id has more."""
    total = written(pairs.groupBy("pair").agg(F.sum("times").alias("n")), "align_pairs")
    by_b = F.col("pair").bitwiseAND(F.lit(0xFFFF))
    most = total.groupBy(by_b.alias("b")).agg(F.max("n").alias("most"))
    return total.join(most, by_b == F.col("b")).select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id",
          text_col: str = "text", block: int = BLOCK, digest: bool = True) -> DataFrame:
    """One row per row of ``docs``: ``id_col, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups``.

    A encodes space+text, B the text; tokens are aligned by their byte ranges.
    ``groups`` is the SHA-256 of the text ``a1,a2|b1;a3|b2,b3`` in hex, or with
    ``digest=False`` that text.  ``n_best`` counts a document's links whose pair
    has, in the corpus, its B id's highest count; ``count_sum`` adds its links'
    corpus-wide counts.  Texts that are null, empty, or whose tokens do not give
    back their bytes have no tokens: zeros and an empty ``groups``.  Repeated
    rows and null ids are documents of their own; an empty table gives an empty
    result; other columns are not read.

    Documents are aligned in blocks, each one row of a written table.  A block's
    links are counted in its task; only a row for each of its distinct id pairs
    is shuffled to be added up, and the sums return to the blocks that hold the
    pair.  So a pair that is everywhere costs one row a block, and a task holds
    one block and the counts of its pairs.
    """
    blocks = written(aligned_blocks(docs, path_a, path_b, id_col, text_col, block, digest),
                     "aligned_blocks")
    id_type = docs.schema[id_col].dataType.simpleString()
    pairs = blocks.select("block", "pairs", "times").mapInArrow(
        _spread, "block long, pair long, times long")
    known = pairs.select("block", "pair").join(pair_counts(pairs), "pair")

    def score(block_: pa.Table, known_: pa.Table) -> pa.Table:
        known_ = known_.sort_by("pair")
        n, best = known_["n"].to_numpy(), known_["best"].to_numpy().astype(np.int64)
        rows = block_["docs"].combine_chunks().flatten()
        cells = np.cumsum(_unpack(block_["cells"][0].as_py()))
        times = _unpack(block_["in_cell"][0].as_py())
        # starts of each document's cells; sums of longs, exact
        starts = np.searchsorted(cells, np.arange(len(rows) + 1) * len(n))
        at = cells % len(n) if len(n) else cells
        total = lambda v: np.diff(np.concatenate([[0], np.cumsum(v[at] * times)])[starts])
        of = dict(zip([f.name for f in rows.type], rows.flatten()))
        cols = [of["id"], *(of[c] for c in ("n_a", "n_b", "n_groups", "n_links")),
                pa.array(total(best)), pa.array(total(n)), of["groups"]]
        return pa.table(cols, ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                               "groups"])

    scored = blocks.drop("pairs", "times").groupBy("block").cogroup(
        known.groupBy("block")).applyInArrow(
        score, f"id {id_type}, n_a long, n_b long, n_groups long, n_links long, n_best long, "
               "count_sum long, groups string")
    return scored.withColumnRenamed("id", id_col)
