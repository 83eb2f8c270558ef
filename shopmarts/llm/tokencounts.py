"""Token counts by the whole-token shortcut."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

PIECE = 1 << 20
_UNITS, _PARTS = 600_000, 400_000
_TWO_SPACES = re.compile(r"\s\s")
_RUN = re.compile(r"(?<=\S)(?=[ \n])")
_CUT = re.compile(r"(?<=\S)(?= )")
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]{1,64})([.,;:!?%*#$&|]{0,64})")
# the public byte-level alphabet: bytes without a printable character of their
# own take the characters from 256 on
_OWN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_OTHERS = [b for b in range(256) if b not in _OWN]
BYTE_CHARS = {b: chr(b) for b in _OWN} | {b: chr(256 + k) for k, b in enumerate(_OTHERS)}
_SPACE = BYTE_CHARS[0x20]
_COUNTERS: dict[str, "Counter"] = {}


def load(path: str) -> Tokenizer:
    """The tokenizer of ``path``, without truncation or padding."""
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def is_byte_level(t: Tokenizer) -> bool:
    """Whether texts reach the model as the byte-level pre-tokenizer cuts them."""
    p = t.pre_tokenizer
    return (t.normalizer is None and isinstance(p, pre_tokenizers.ByteLevel)
            and not p.add_prefix_space and getattr(p, "use_regex", True))


def whole_tokens(path: str) -> frozenset[str]:
    """The vocabulary strings (in byte-level characters) that the model's merges
    make one token when they stand alone.

    This is the proof of the shortcut: the model sees a pre-token alone, so one
    that is such a string counts one, and nothing has to be merged.  A vocabulary
    can hold strings that merges never reach; they are not in the result.
    Empty for a tokenizer that is not byte-level.
    """
    if not path.endswith(".json"):
        return frozenset()
    t = load(path)
    if not is_byte_level(t):
        return frozenset()
    whole = []
    for s, i in t.get_vocab(with_added_tokens=False).items():
        got = t.model.tokenize(s)
        if len(got) == 1 and got[0].id == i:
            whole.append(s)
    return frozenset(whole)


class Counter(dict):
    """Token counts of the units of a text, a unit being a run that begins at a
    space or line break after other text.

    The byte-level pre-tokenizer never joins what stands before such a white
    space with what follows, so a unit's count does not depend on its
    neighbours.  The mapping's key is the unit without its leading space, or with
    its leading line break.  Both tables are emptied when full.
    """

    def __init__(self, path: str, whole: frozenset[str]):
        super().__init__()
        self.tokenizer, self.whole = load(path), whole
        self.parts: dict[str, int] = {}
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, self.special))) if self.special else None

    def __call__(self, text: str) -> int:
        if len(self) > _UNITS:
            self.clear()
        if self.special is None or not self.special.search(text):
            return self._between(text)
        return self.plain(text)

    def plain(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _between(self, text: str) -> int:
        """Count of a text without special strings, in bounded pieces."""
        total, start, first = 0, 0, True
        while start < len(text):
            end = len(text)
            if end - start > PIECE:
                cut = _CUT.search(text, start + PIECE)
                end = cut.start() if cut else end
            total += self._piece(text[start:end], first)
            start, first = end, False
        return total

    def _piece(self, text: str, first: bool) -> int:
        if _TWO_SPACES.search(text):
            units = _RUN.split(text)
            if first:
                return self.literal(units[0]) + sum(map(self._unit, units[1:]))
            return sum(map(self._unit, units))
        units = text.replace("\n", " \n").split(" ")
        head = units[0]                         # the text's first unit, or nothing before a cut
        return (self.literal(head) if head else 0) + sum(map(self.__getitem__, units[1:]))

    def _unit(self, unit: str) -> int:
        if unit[0] == "\n":
            return self[unit]
        return self[unit[1:]] if unit[1:2] != "\n" else self.literal(unit)

    def __missing__(self, key: str) -> int:
        m = _PLAIN.fullmatch(key)
        if m is None:
            n = self.literal(key if key[:1] == "\n" else " " + key)
        else:                                   # a word and a run of marks: two pre-tokens
            word, marks = m.groups()
            if not word.isascii():
                word = "".join(map(BYTE_CHARS.__getitem__, word.encode()))
            n = self.part(_SPACE + word) + (self.part(marks) if marks else 0)
        if len(key) < 64:
            self[key] = n
        return n

    def literal(self, text: str) -> int:
        """Count of a text by the library's own pre-tokens."""
        return sum(self.part(p) for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text))

    def part(self, token: str) -> int:
        """One for a whole token; merges for the rest."""
        if token in self.whole:
            return 1
        n = self.parts.get(token)
        if n is None:
            if len(self.parts) > _PARTS:
                self.parts.clear()
            n = len(self.tokenizer.model.tokenize(token))
            if len(token) < 64:
                self.parts[token] = n
        return n


class PieceCounter:
    """Counts of a sentencepiece model, which has no pre-tokens to look up."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def __call__(self, text: str) -> int:
        return len(self.model.encode(text))


def counter(path: str, whole: frozenset[str]):
    """One counter a worker process: its tables serve all tasks of the worker."""
    if path not in _COUNTERS:
        if path.endswith(".json"):
            c = Counter(path, whole)
            _COUNTERS[path] = c if is_byte_level(c.tokenizer) else c.plain
        else:
            _COUNTERS[path] = PieceCounter(path)
    return _COUNTERS[path]


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 512,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_bytes, n_tokens, over_limit`` of every row of ``docs``.

    Counts are the library's (tokenizers for ``.json``, sentencepiece for
    ``.model``), without tokens added at either end; a special token's string
    inside a text is what the library makes of it.  Pre-tokens proved whole count
    one, the others are merged; a tokenizer that is not byte-level encodes whole
    texts.  One pass without a shuffle; what travels to the tasks is bounded by
    the vocabulary.  Null and empty texts have no bytes and no tokens; long texts
    are counted in pieces cut before a space; repeated rows and null ids come
    back as they are; other columns are not read.
    """
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    kind = rows.schema[0].dataType.simpleString()
    whole = whole_tokens(tokenizer_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer_path, whole)
        for b in batches:
            text = b.column(1)
            n = np.fromiter((count(t.as_py() or "") for t in text), np.int64, b.num_rows)
            size = pc.fill_null(pc.binary_length(text), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), size, pa.array(n), pa.array(n > limit)],
                ["id", "n_bytes", "n_tokens", "over_limit"])

    out = rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean")
    return out.withColumnRenamed("id", id_col)
