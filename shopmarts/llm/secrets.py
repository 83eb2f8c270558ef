"""Secret scan: fixed rules, and random strings told by character Markov models.

Everything here is DataFrame expressions: rows stay in the JVM, nothing is
shuffled but the small training sample's transition counts.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmarts.llm.rows import column, held

# Fixed values of the base rules.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"         # runs of 18 or more characters
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "random")

CANDIDATE = r"[A-Za-z0-9+/_-]{16,}={0,2}"
ALPHABET = string.ascii_lowercase + string.ascii_uppercase + string.digits + "+/_-="
SIDE = len(ALPHABET) + 1              # row 0: the start of a string; any other character
SCALE = 1000                          # scores are whole thousandths of a nat
LEAST = 16                            # characters of the shortest candidate
#: Neither an identifier nor known to be random: left out of the ordinary class.
#: Tried at the start of a run only, so a long run takes time in proportion.
MIXED = r"(?<![A-Za-z0-9])(?=[A-Za-z]*[0-9])(?=[0-9]*[A-Za-z])[A-Za-z0-9]{16,}"
#: What a class keeps for transitions it has not seen: a random string may use any
#: alphabet, and one rare transition of an ordinary string is no proof.
OPEN = (0.05, 0.5)
SPAN = "array<struct<start:int,end:int,value:string>>"


def find_all(text: Column, regex: str) -> Column:
    """Leftmost non-overlapping matches with their positions in code points."""
    values = F.regexp_extract_all(text, F.lit(regex), F.lit(0))
    gaps = F.split(text, regex, -1)
    steps = F.zip_with(values, F.slice(gaps, F.lit(1), F.size(values)),
                       lambda v, g: F.struct(F.length(g).alias("gap"), v.alias("value")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("found"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        end = begin + F.length(x["value"])
        span = F.struct(begin.alias("start"), end.alias("end"), x["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["found"], F.array(span)).alias("found"))

    return F.when(text.rlike(regex), F.aggregate(steps, start, step, lambda acc: acc["found"])
                  ).otherwise(F.array().cast(SPAN))


def base_spans(text: Column) -> dict[str, Column]:
    """Spans of the fixed rules by kind."""
    assign = F.filter(find_all(text, ASSIGN), lambda s: F.length(
        F.regexp_extract(s["value"], ASSIGN, 2)) >= ASSIGN_LEAST)
    return {"assign": assign, "access": find_all(text, ACCESS), "hex": find_all(text, HEX)}


def _codes(value: Column) -> Column:
    """Alphabet index of every character; split once, so long runs cost no more
    a character than short ones."""
    return F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c))


def random_strings(spark, n: int) -> DataFrame:
    """Labelled random samples: hash digests as hex, base64 and base 36 text."""
    digest = F.sha2(F.col("id").cast("string").cast("binary"), 256)
    upper = F.conv(F.substr(digest, F.lit(1), F.lit(12)), 16, 36)
    upper2 = F.conv(F.substr(digest, F.lit(13), F.lit(12)), 16, 36)
    value = (F.when(F.col("id") % 3 == 0, F.substr(digest, F.lit(1), F.lit(40)))
             .when(F.col("id") % 3 == 1, F.base64(F.unhex(F.substr(digest, F.lit(1), F.lit(60)))))
             .otherwise(F.concat(upper, upper2)))
    return spark.range(n).select(value.alias("value"), F.lit(1).alias("label"))


def structured_strings(spark, n: int) -> DataFrame:
    """Ordinary strings of digits and separators: dates, numbers, rules."""
    day = F.date_add(F.lit("1990-01-01").cast("date"), (F.col("id") * 7 % 15000).cast("int"))
    part = lambda k, size: F.lpad(F.pmod(F.xxhash64("id", F.lit(k)), F.lit(10 ** size))
                                  .cast("string"), size, "0")
    rules = [F.repeat(F.lit(c), (F.lit(LEAST) + F.col("id") % 64).cast("int")) for c in "-_/+"]
    values = F.array(*(F.date_format(day, f) for f in ("yyyy/MM/dd/", "yyyy-MM-dd-", "yyyy_MM_dd_",
                                                       "yyyyMMdd_HHmmss", "/yyyy/MM", "_yyyyMMdd-")),
                     F.concat(F.lit("+"), F.concat_ws("-", *(part(k, 2 + k // 2) for k in range(4)))),
                     F.concat_ws("/", part(5, 3), part(6, 4)), part(7, 12), *rules)
    return spark.range(n).select(F.explode(values).alias("value"), F.lit(0).alias("label"))


def labelled_samples(docs: DataFrame, max_docs: int = 2000, max_random: int = 3000,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``value, label`` from at most ``max_docs`` documents, chosen by a hash of
    their id: label 1 for the base rules' values and for random strings, 0 for
    words and identifiers put together from neighbouring words, for strings of
    digits and separators, and for the candidates of texts without a base span
    (but those with a long run of mixed letters and digits)."""
    chosen = (docs.select(id_col).filter(F.col(id_col).isNotNull()).distinct()
              .orderBy(F.xxhash64(F.col(id_col), F.lit(5)), id_col).limit(max_docs))
    text = (docs.select(F.col(id_col), F.col(text_col).cast("string").alias("t"))
            .join(F.broadcast(chosen), id_col).select("t"))   # max_docs ids at most
    rules = base_spans(F.col("t"))
    secret = F.concat(F.transform(rules["assign"], lambda s: F.regexp_extract(s["value"], ASSIGN, 2)),
                      *(F.transform(rules[k], lambda s: s["value"]) for k in ("access", "hex")))
    words = text.select(F.regexp_extract_all("t", F.lit("[A-Za-z]{4,}"), F.lit(0)).alias("w"))
    pair = F.zip_with("w", F.expr("slice(w, 2, greatest(size(w) - 1, 0))"),
                      lambda a, b: F.when(b.isNotNull(), F.array(
                          a, F.upper(a), F.initcap(a), F.concat(a, F.initcap(b)),
                          F.concat_ws("_", a, b), F.concat_ws("-", a, b), F.concat_ws("/", a, b),
                          F.concat(F.upper(a), F.lit("_"), F.upper(b)),
                          *_numbered_words(a, b))))
    ordinary = words.select(F.explode(F.flatten(F.filter(pair, lambda x: x.isNotNull())))
                            .alias("value"), F.lit(0).alias("label"))
    clean = text.filter(F.size(secret) == 0).select(F.explode(F.regexp_extract_all(
        "t", F.lit(CANDIDATE), F.lit(0))).alias("value"), F.lit(0).alias("label"))
    ordinary = (ordinary.unionByName(clean.filter(~F.col("value").rlike(MIXED)))
                .unionByName(structured_strings(docs.sparkSession, max_random // 6)))
    return (text.select(F.explode(secret).alias("value"), F.lit(1).alias("label"))
            .unionByName(random_strings(docs.sparkSession, max_random)).distinct()
            .unionByName(ordinary.distinct()))


def _numbered_words(a: Column, b: Column) -> list[Column]:
    """Identifiers of two words and a number."""
    n = F.pmod(F.xxhash64(a, b), F.lit(1000)).cast("string")
    return [F.concat(a, n), *(F.concat_ws(c, F.concat(a, n), n, b) for c in "_-/")]


def fit_markov(samples: DataFrame) -> list[int]:
    """Log-likelihood ratios (random against ordinary) of every transition.

    ``samples`` has ``value`` and ``label`` (1 random, 0 ordinary; others and
    nulls are not used).  Counts are added up in Spark; the driver gets at most
    two counts for each pair of alphabet characters.  Shares are mixed with a
    uniform distribution (``OPEN``); after a character that a class has never
    seen, it is all there is.  A character's repeat or its successor (rules of
    dashes, alphabets) never counts as random.
    """
    x = samples.filter(F.col("label").isin(0, 1) & (F.length("value") > 0))
    codes = x.select("label", _codes(F.col("value")).alias("c"))
    steps = F.arrays_zip(F.concat(F.array(F.lit(0)), F.col("c")).alias("a"), F.col("c").alias("b"))
    pairs = codes.select("label", F.explode(steps).alias("s")).select("label", "s.a", "s.b")
    counts = pairs.filter("b is not null").groupBy("label", "a", "b").count().collect()
    n = [[[0] * SIDE for _ in range(SIDE)] for _ in range(2)]
    for r in counts:
        n[r["label"]][r["a"]][r["b"]] += r["count"]

    def log(c: int, a: int, b: int) -> float:
        total = sum(n[c][a])
        return math.log((1 - OPEN[c]) * n[c][a][b] / total + OPEN[c] / SIDE if total else 1 / SIDE)

    ratio = lambda a, b: log(1, a, b) - log(0, a, b)
    return [round(SCALE * (min(0, ratio(a, b)) if a and b - a in (0, 1) else ratio(a, b)))
            for a in range(SIDE) for b in range(SIDE)]


def score(value: Column, table: list[int]) -> Column:
    """Log-likelihood ratio of a string in thousandths of a nat."""
    ratios = F.split(F.lit(",".join(map(str, table))), ",").cast("array<int>")
    start = F.struct(F.lit(0).alias("last"), F.lit(0).cast("long").alias("sum"))
    # a long: an int overflows after half a million random characters
    return F.aggregate(_codes(value), start, lambda acc, c: F.struct(
        c.alias("last"), (acc["sum"] + F.get(ratios, acc["last"] * SIDE + c)).alias("sum")),
        lambda acc: acc["sum"])


def _numbered(spans: Column, kind: int) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))


def all_spans(text: Column, table: list[int], threshold: float) -> Column:
    """Sorted ``start, kind, end`` of the base spans and of runs of 16 or more
    key characters that overlap none of them and whose ratio reaches
    ``threshold`` nats for each 16 characters.  ``kind`` is the place in ``KINDS``."""
    kinds = base_spans(text)
    numbered = [_numbered(kinds[k], n) for n, k in enumerate(KINDS[:3])]
    random = F.filter(find_all(text, CANDIDATE),
                      lambda s: score(s["value"], table) * LEAST >= F.length(s["value"])
                      * F.lit(int(threshold * SCALE)).cast("long"))
    both = F.struct(F.concat(*numbered).alias("base"), random.alias("random"))

    def join(acc: Column, x: Column) -> Column:
        free = F.filter(x["random"], lambda s: ~F.exists(
            x["base"], lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
        return F.array_sort(F.concat(x["base"], _numbered(free, 3)))

    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    # the one-element aggregate names the spans once, so no rule is evaluated twice
    return F.aggregate(F.array(both), empty, join)


def _text(docs: DataFrame, text_col: str) -> Column:
    return F.coalesce(column(text_col).cast("string"), F.lit(""))


def scan(docs: DataFrame, table: list[int], threshold: float = 10.0, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """``id_col, found`` for every row: the array of ``start, kind, end``.

    Null texts are empty ones and have no span; repeated rows come back as
    often as they went in; other columns are not read.
    """
    return docs.select(F.col(id_col), _text(docs, text_col).alias("t")).select(
        id_col, all_spans(F.col("t"), table, threshold).alias("found"))


def redact(docs: DataFrame, table: list[int], threshold: float = 10.0, text_col: str = "text",
           size_col: str | None = "n_chars", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced by ``mark``; overlapping spans by one.

    Rows without a span are unchanged, a null text stays null and an empty one
    empty; ``size_col``, if there is one, follows the new text where there was a
    span.  No row goes; repeated rows and null ids are rows like any other.
    Columns keep their names and types whatever they are called.
    """
    text, found = F.col("doc").getField(text_col), F.col("found")
    clean = F.aggregate(
        found, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] >= acc["at"], F.concat(
                acc["out"], F.substr(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark)))
            .otherwise(acc["out"]).alias("out")),
        lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1, F.length(text))))
    hit = F.size("found") > 0
    marked = held(docs, found=all_spans(_text(docs, text_col), table, threshold))
    marked = marked.select("doc", "found", F.when(hit, clean).otherwise(text).alias("clean"))
    old = lambda c: F.col("doc").getField(c)
    out = [F.col("clean").alias(c) if c == text_col
           else F.when(hit, F.length("clean")).otherwise(old(c)).cast(docs.schema[c].dataType)
           .alias(c) if c == size_col else old(c).alias(c) for c in docs.columns]
    return marked.select(*out)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts by base kind, the base spans' hash and all spans as text."""
    def listed(spans: Column) -> Column:
        names = F.array(*map(F.lit, KINDS))
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.get(names, s["kind"]), s["start"], s["end"])), ",")

    def count(kind: int) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("found", lambda s: s["kind"] < 3)
    return found.select(id_col, *(count(n).alias(f"n_{k}") for n, k in enumerate(KINDS[:3])),
                        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
                        listed(F.col("found")).alias("spans"), count(3).alias("n_random"))
