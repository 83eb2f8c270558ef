"""Exact vector top-k by a metric pivot index (R3).

Angles between vectors are a metric.  Every vector belongs to the pivot nearest to
it, at a known angle r; for a query at angle d from the pivot no vector of the cell
is nearer than |d - r|.  Once k vectors within some angle of a query are known,
only vectors with r in a band around d can be among its k nearest, so cells and
parts of cells are left unread.  The result equals brute force.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopmarts.operators.retrieval import _dot, _norm
from shopmarts.sources.files import written

MARGIN = 1e-6       # slack on every angle: rounding never drops a true hit


def _doubles(vec: str) -> Column:
    return F.transform(F.col(vec), lambda v: v.cast("double"))


def _angle(cosine: Column) -> Column:
    return F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine)))


def _with_norm(df: DataFrame, id_col: str, vec: str, name: str) -> DataFrame:
    """``id, x, xn`` of the vectors that have a cosine: not null, not all zero."""
    rows = df.select(F.col(id_col).alias(name), _doubles(vec).alias("x")).withColumn("xn", _norm(F.col("x")))
    return rows.filter(F.col("xn") > 0)


@dataclass
class PivotIndex:
    """``pivots``: ``pivot, p`` (unit vectors); ``cells``: ``pivot, n, low, high``;
    ``vectors``: ``pivot, r, cid, x, xn``, written by pivot and sorted by r."""

    pivots: DataFrame
    cells: DataFrame
    vectors: DataFrame

    def bands(self, queries: DataFrame) -> DataFrame:
        """``qid, pivot, d, n, low, high`` of every query and cell: as many rows as
        the stated number of pivots times the queries."""
        listed = self.pivots.agg(F.collect_list(F.struct("pivot", "p"))).scalar()
        each = queries.withColumn("listed", listed).select("qid", "q", "qn", F.explode("listed").alias("v"))
        d = _angle(_dot(F.col("q"), F.col("v.p")) / F.col("qn"))
        return each.select("qid", "q", "qn", F.col("v.pivot").alias("pivot"), d.alias("d")).join(
            self.cells, "pivot")

    def scored(self, bands: DataFrame) -> DataFrame:
        """``qid, cid, score`` of the vectors whose r lies in a query's band of their
        cell: an equi-join on the cell with a range condition."""
        near = bands.join(self.vectors.alias("v"), "pivot").filter(
            (F.col("r") >= F.col("from")) & (F.col("r") <= F.col("to")))
        return near.select("qid", "cid", (_dot(F.col("q"), F.col("x")) / (F.col("qn") * F.col("xn")))
                           .alias("score"))

    def topk(self, queries: DataFrame, k: int, query_id: str = "query_id",
             query_vec: str = "vector") -> DataFrame:
        """``query_id, rank_no, cid, score``: the k vectors of the largest cosine of
        each query, ties by id.  Queries without a cosine have no rows."""
        q = written(_with_norm(queries, query_id, query_vec, "qid").select(
            "qid", F.col("x").alias("q"), F.col("xn").alias("qn")), "pivot_queries")
        best = Window.partitionBy("qid").orderBy(F.desc("score"), "cid")

        def top(scored: DataFrame) -> DataFrame:
            return scored.withColumn("rank_no", F.row_number().over(best)).filter(F.col("rank_no") <= k)

        bands = written(self.bands(q), "pivot_bands")
        # the nearest cells that hold k vectors give a first k, and an angle none of
        # the true k exceeds
        nearer = Window.partitionBy("qid").orderBy("d", "pivot").rowsBetween(Window.unboundedPreceding, -1)
        seeds = (bands.withColumn("before", F.coalesce(F.sum("n").over(nearer), F.lit(0)))
                 .filter(F.col("before") < k).withColumns({"from": F.col("low"), "to": F.col("high")}))
        reach = (top(self.scored(seeds)).groupBy("qid")
                 .agg(F.count("*").alias("found"), F.min("score").alias("least"))
                 .select("qid", F.when(F.col("found") >= k, _angle(F.col("least")) + MARGIN).alias("reach")))
        bound = bands.join(reach, "qid", "left").withColumns({
            "from": F.greatest("low", F.coalesce(F.col("d") - F.col("reach"), F.col("low"))),
            "to": F.least("high", F.coalesce(F.col("d") + F.col("reach"), F.col("high")))})
        self.final = written(bound.filter(F.col("from") <= F.col("to")), "pivot_bounds")
        return top(self.scored(self.final)).select(
            F.col("qid").alias(query_id), "rank_no", "cid", F.round("score", 6).alias("score"))


def build(corpus: DataFrame, pivots: int = 32, corpus_id: str = "vec_id",
          corpus_vec: str = "embedding") -> PivotIndex:
    """The index of all vectors that have a cosine.

    Pivots are distinct directions chosen by hash, a stated number of them.  The
    index is written by cell, in order of the angle, so it can serve any number of
    query batches."""
    rows = _with_norm(corpus, corpus_id, corpus_vec, "cid")
    unit = F.transform("x", lambda v: v / F.col("xn"))
    chosen = (rows.select(unit.alias("p")).withColumn("h", F.xxhash64("p")).distinct()
              .orderBy("h", "p").limit(pivots))
    chosen = written(chosen.select(F.col("h").alias("pivot"), "p").dropDuplicates(["pivot"]), "pivots")
    listed = chosen.agg(F.collect_list(F.struct("pivot", "p"))).scalar()
    nearest = F.array_max(F.transform("listed", lambda v: F.struct(
        _dot(v["p"], F.col("x")).alias("dot"), v["pivot"].alias("pivot"))))
    placed = rows.withColumn("listed", listed).withColumn("near", nearest).select(
        F.col("near.pivot").alias("pivot"), _angle(F.col("near.dot") / F.col("xn")).alias("r"),
        "cid", "x", "xn")
    vectors = written(placed.repartitionByRange("pivot", "r").sortWithinPartitions("pivot", "r"),
                      "pivot_vectors")
    cells = written(vectors.groupBy("pivot").agg(F.count("*").alias("n"), F.min("r").alias("low"),
                                                 F.max("r").alias("high")), "pivot_cells")
    return PivotIndex(chosen, cells, vectors)


def centroid_topk(embeddings: DataFrame, k: int = 10) -> DataFrame:
    """The k vectors nearest to each label's centroid, through the index."""
    from shopmarts.operators.retrieval import label_centroids

    cents = label_centroids(embeddings).select(F.col("label").alias("query_id"),
                                               F.col("centroid").alias("vector"))
    return build(embeddings).topk(cents, k).withColumnRenamed("query_id", "label").withColumnRenamed(
        "cid", "vec_id")
