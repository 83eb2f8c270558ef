"""Hierarchical multi-length packing of tokenized documents."""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

TIERS = (512, 1024, 2048, 4096)
_CACHE_UNITS, _CACHE_LETTERS = 700_000, 400_000
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]{1,64})([.,;:!?%*#$&|]{0,64})")
# the public byte-level alphabet: bytes without a printable character of their
# own take the characters from 256 on
_OWN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_CHARS = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _OWN)}
_ENCODERS: dict[str, "WordEncoder"] = {}


class WordEncoder(dict):
    """Token ids of a text by a tokenizer whose pre-tokenizer splits at white
    space and between letters and marks, and whose ids fit 16 bits.

    The mapping holds, for each unit between spaces or newlines, its ids as
    bytes.  Units seen before are looked up; a letters-and-marks unit is its
    letters' ids followed by its marks' ids; the tokenizer encodes everything
    else as it stands.  Both tables are emptied when full, so memory is bounded.
    """

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("the tokenizer has ids over 16 bits")
        self.letters: dict[str, bytes] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        if len(self) > _CACHE_UNITS:
            self.clear()
        units = (text or "").replace("\n", " ").split(" ")
        return np.frombuffer(b"".join(map(self.__getitem__, units)), "<u2").astype("<u4")

    def __missing__(self, unit: str) -> bytes:
        m = _PLAIN.fullmatch(unit)
        if m is None:
            ids = self._encode(unit)
        else:
            word, marks = m.groups()
            word = word.lower()
            ids = self.letters.get(word)
            if ids is None:
                if len(self.letters) > _CACHE_LETTERS:
                    self.letters.clear()
                ids = self.letters[word] = self._word(word)
            if marks:
                ids += self[marks]
        if len(unit) < 64:
            self[unit] = ids
        return ids

    def _encode(self, unit: str) -> bytes:
        ids = self.tokenizer.encode(unit, add_special_tokens=False).ids
        return np.array(ids, "<u2").tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of lower-case letters, straight from the tokenizer's model."""
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(_BYTE_CHARS)
        return np.array([t.id for t in self.tokenizer.model.tokenize(word)], "<u2").tobytes()


def _encoder(path: str) -> WordEncoder:
    """One encoder a worker process: its tables serve all tasks of the worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


class Packer:
    """Packs documents of one task; pieces come out with their sequence.

    A document of n tokens gives n // top windows of its own; the rest is routed
    to the shortest tier that holds it.  Every ``block`` tokens the routed
    rests are packed: each tier's windows best-fit, longest first; then the gaps
    of the longer tiers' windows are filled from shorter tiers, whole documents
    first and a cut one last, so the windows are full.  What is left, less than
    one window, waits for the next block.  The task's last rest is cut into
    powers of two, which need no padding.
    """

    def __init__(self, tiers: tuple[int, ...] = TIERS, block: int = 1 << 20,
                 step_windows: int = 16):
        self.tiers, self.top, self.block = tiers, tiers[-1], block
        self.rest: list[tuple[int, object, int, int]] = []   # (tokens, document, start, end)
        self.held = 0
        self.n_sequences = 0
        self.steps = Steps(self.top * step_windows)

    def add(self, doc, n: int) -> Iterator[tuple]:
        whole = n - n % self.top
        for s in range(0, whole, self.top):
            yield from self._emit([(self.top, doc, s, s + self.top)])
        if n > whole:
            self.rest.append((n - whole, doc, whole, n))
            self.held += n - whole
        if self.held >= self.block:
            yield from self._pack(last=False)

    def finish(self) -> Iterator[tuple]:
        yield from self._pack(last=True)

    def _pack(self, last: bool) -> Iterator[tuple]:
        # a tier's documents in ascending length, longest taken from the end
        waiting = {t: [] for t in self.tiers}
        for k, d in enumerate(self.rest):
            t = self.tiers[bisect.bisect_left(self.tiers, d[0])]
            waiting[t].append((d[0], k, d))
        self.rest, self.held = [], 0
        for t in self.tiers:
            waiting[t].sort(key=lambda x: x[:2])
        for k in range(len(self.tiers) - 1, -1, -1):
            tier = self.tiers[k]
            sources = [waiting[t] for t in self.tiers[k::-1]]      # own tier, then shorter ones
            while waiting[tier]:
                gap, window = tier, []
                for docs in sources:                               # whole documents, best fit
                    while gap and docs:
                        at = bisect.bisect_right(docs, gap, key=lambda x: x[0]) - 1
                        if at < 0:
                            break
                        window.append(docs.pop(at)[2])
                        gap -= window[-1][0]
                if gap:                                            # a cut one closes the window
                    docs = next((d for d in reversed(sources) if d), None)
                    if docs is None:
                        self._keep(window)
                        break
                    n, order, (_, doc, s, e) = docs.pop()
                    window.append((gap, doc, s, s + gap))
                    left = (n - gap, doc, s + gap, e)
                    home = waiting[self.tiers[bisect.bisect_left(self.tiers, n - gap)]]
                    bisect.insort(home, (n - gap, order, left), key=lambda x: x[:2])
                yield from self._emit(window)
        if last:
            yield from self._tail()

    def _keep(self, window: list) -> None:
        self.rest += window
        self.held += sum(p[0] for p in window)

    def _tail(self) -> Iterator[tuple]:
        left, self.rest, self.held = self.rest[::-1], [], 0
        total = sum(p[0] for p in left)
        while total:
            size = min(self.top, 1 << (total.bit_length() - 1))
            gap, window = size, []
            while gap:
                n, doc, s, e = left.pop()
                if n > gap:
                    left.append((n - gap, doc, s + gap, e))
                    e, n = s + gap, gap
                window.append((n, doc, s, e))
                gap -= n
            total -= size
            yield from self._emit(window)

    def _emit(self, window: list) -> Iterator[tuple]:
        offset, size = 0, sum(p[0] for p in window)
        step = self.steps.place(size, sum(p[0] ** 2 for p in window))
        for n, doc, s, e in window:
            yield doc, s, n, self.n_sequences, offset, size, step
            offset += n
        self.n_sequences += 1


class Steps:
    """Step groups: a sequence joins, of a few open groups with room for it, the
    one with the least attention cost so far, so groups match in tokens and cost."""

    def __init__(self, tokens: int, open_groups: int = 4):
        self.tokens, self.groups, self.next = tokens, [], open_groups
        self.groups = [[0, k, 0] for k in range(open_groups)]      # cost, number, tokens

    def place(self, size: int, cost: int) -> int:
        fits = [g for g in self.groups if g[2] + size <= self.tokens]
        if not fits:
            self.groups.remove(max(self.groups, key=lambda g: g[2]))
            fits = [[0, self.next, 0]]
            self.groups += fits
            self.next += 1
        g = min(fits)
        g[0] += cost
        g[2] += size
        return g[1]


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 2, id_col: str = "doc_id",
         text_col: str = "text", tiers: tuple[int, ...] = TIERS,
         block: int = 1 << 20) -> DataFrame:
    """One row per piece: ``id_col, start, length, ids, doc_tokens, sequence_id,
    offset, sequence_tokens, step_id``.

    A document is its tokenizer ids and then ``end_id``; a null or empty text is
    ``end_id`` alone.  Each task tokenizes and packs its own input split, holding
    ``block`` tokens at a time: no shuffle, nothing to be skewed, and a lost task
    is repeated from its split with the same result.  ``sequence_id`` and
    ``step_id`` carry the task's number in their upper bits.  Repeated rows and
    null ids are documents of their own.  Other columns are not read.
    """
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    kind = rows.schema[0].dataType.simpleString()
    names = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset",
             "sequence_tokens", "step_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = _encoder(tokenizer_path), Packer(tiers, block)
        base = TaskContext.get().partitionId() << 36
        id_type = None

        def batch(pieces: list) -> pa.RecordBatch:
            docs_, start, length, seq, offset, size, step = zip(*pieces)
            cut = [d[1][s:s + n].tobytes() for d, s, n in zip(docs_, start, length)]
            long = lambda v: pa.array(v, pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array([d[0] for d in docs_], id_type), long(start), long(length),
                 pa.array(cut, pa.binary()), long([len(d[1]) for d in docs_]),
                 long([base + s for s in seq]), long(offset), long(size),
                 long([base + s for s in step])], names)

        out: list = []
        for b in batches:
            id_type = b.column(0).type
            for key, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = np.append(encode(text.as_py()), np.uint32(end_id)).astype("<u4")
                out.extend(packer.add((key, ids), len(ids)))
                if len(out) > 2000:
                    yield batch(out)
                    out = []
        out.extend(packer.finish())
        if out:
            yield batch(out)

    packed = rows.mapInArrow(run, f"id {kind}, start long, length long, ids binary, "
                                  "doc_tokens long, sequence_id long, offset long, "
                                  "sequence_tokens long, step_id long")
    return packed.withColumnRenamed("id", id_col)
