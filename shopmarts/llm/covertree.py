"""Embedding near-duplicates: exact threshold links by cover-tree dual traversal."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmarts.llm.components import connected_components
from shopmarts.llm.storage import written

LEAF = 32
SLACK = 1e-9       # on distances that prune; the link test itself is on the cosine


class CoverTree:
    """Nested levels over unit vectors: a node's children are centres of half
    its level's radius, the node's own centre first.  ``radius`` is the largest
    distance from a node's centre to any point below it."""

    def __init__(self, unit: np.ndarray):
        self.unit = unit
        self.center, self.radius, self.children, self.points = [], [], [], []
        if len(unit):
            self._build()

    def _node(self, center: int, points: np.ndarray) -> int:
        d = _distances(self.unit[center:center + 1], self.unit[points])[0]
        self.center.append(center)
        self.radius.append(float(d.max()) if len(d) else 0.0)
        self.children.append([])
        self.points.append(points)
        return len(self.center) - 1

    def _build(self) -> None:
        todo = [(self._node(0, np.arange(len(self.unit))), 1.0)]
        while todo:
            node, r = todo.pop()
            points = self.points[node]
            if len(points) <= LEAF or self.radius[node] < 1e-12:
                continue
            while r > 2 * self.radius[node]:
                r /= 2
            for center, members in self._net(self.center[node], points, r):
                child = self._node(center, members)
                self.children[node].append(child)
                todo.append((child, r / 2))
            self.points[node] = points[:0]

    def _net(self, center: int, points: np.ndarray, r: float):
        """Centres more than ``r`` apart, and for each the points it covers."""
        out, left = [], points
        pick = np.array([center])
        while len(left):
            d = _distances(self.unit[pick], self.unit[left])
            chosen: list[int] = []
            apart = _distances(self.unit[pick], self.unit[pick]) > r
            for k in range(len(pick)):
                if all(apart[k, c] for c in chosen):
                    chosen.append(k)
            near = d[chosen] <= r
            near[:, :] |= pick[chosen][:, None] == left[None, :]
            first = np.where(near.any(axis=0), near.argmax(axis=0), -1)
            for n, k in enumerate(chosen):
                out.append((int(pick[k]), left[first == n]))
            left = left[first < 0]
            pick = left[:64]
        return out


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


class Cell:
    """Links between the points of two trees (or within one)."""

    def __init__(self, vectors: np.ndarray, weight: np.ndarray, least: float):
        norm = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
        self.vectors, self.norm, self.weight = vectors, norm, weight
        self.unit = vectors / norm[:, None]
        self.least, self.reach = least, float(np.sqrt(max(0.0, 2 - 2 * least))) + SLACK
        self.links = np.zeros(len(vectors), np.int64)
        self.parent = np.arange(len(vectors))

    def join(self, a: np.ndarray, b: np.ndarray | None) -> None:
        """Dual traversal of the trees over index sets ``a`` and ``b`` (None:
        ``a`` with itself).  A node pair goes when its centres lie further apart
        than both covering radii and the threshold's distance together."""
        ta = CoverTree(self.unit[a])
        tb, ib = (ta, a) if b is None else (CoverTree(self.unit[b]), b)
        if not len(a) or not len(ib):
            return
        todo = [(0, 0)]
        while todo:
            x, y = todo.pop()
            if not ta.children[x] and not tb.children[y]:
                self._pairs(a[ta.points[x]], ib[tb.points[y]], same=b is None and x == y)
                continue
            cx, cy = ta.children[x] or [x], tb.children[y] or [y]
            if b is None and x == y:
                cy = cx
            # the children's centres against each other, in blocks
            for s in range(0, len(cx), 1024):
                part = cx[s:s + 1024]
                d = _distances(ta.unit[[ta.center[k] for k in part]],
                               tb.unit[[tb.center[k] for k in cy]])
                far = np.array([ta.radius[k] for k in part])[:, None] + np.array(
                    [tb.radius[k] for k in cy])[None, :] + self.reach
                for i, j in zip(*np.nonzero(d <= far)):
                    if b is not None or x != y or s + i <= j:     # each pair once
                        todo.append((part[i], cy[j]))

    def _pairs(self, a: np.ndarray, b: np.ndarray, same: bool) -> None:
        cos = (self.vectors[a] @ self.vectors[b].T) / (self.norm[a][:, None] * self.norm[b])
        near = cos >= self.least
        if same:
            near &= ~np.eye(len(a), dtype=bool)
            self.links[a] += near @ self.weight[b]
        else:
            self.links[a] += near @ self.weight[b]
            self.links[b] += near.T @ self.weight[a]
        # the block's links as a forest: each point with its first partner, and
        # those partners with one another where a point has several
        for i in np.flatnonzero(near.any(axis=1)):
            ks = b[np.flatnonzero(near[i])]
            roots = {self._root(k) for k in ks.tolist()} | {self._root(int(a[i]))}
            low = min(roots)
            for k in roots:
                self.parent[k] = low

    def _root(self, k: int) -> int:
        while self.parent[k] != k:
            self.parent[k] = self.parent[self.parent[k]]
            k = int(self.parent[k])
        return k

    def forest(self) -> tuple[np.ndarray, np.ndarray]:
        roots = np.array([self._root(k) for k in range(len(self.parent))], int)
        member = np.flatnonzero(roots != np.arange(len(roots)))
        return roots[member], member


def _classes(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """One row per distinct usable vector of a label, under a 128-bit name."""
    v = F.col("v")
    usable = (F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0)
              & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
              & F.exists(v, lambda x: x != 0))
    return (rows.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"),
                        F.transform(F.col(vector_col), lambda x: x.cast("double")).alias("v"))
            .withColumn("node", F.when(F.coalesce(usable, F.lit(False)), F.concat(
                F.hex(F.xxhash64("label", "v")), F.lit("-"),
                F.hex(F.xxhash64(F.lit(1), "v", "label"))))))


def near_duplicates(rows: DataFrame, least: float = 0.93, block: int = 1024,
                    max_cells: int = 64, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label") -> DataFrame:
    """One row per row: ``id_col, n_links, component_id, kept``.

    Rows are compared when their labels are equal and not null; a vector that
    is null, zero, or holds null or non-finite components has no link.  Vectors
    of different lengths have none either.  Equal vectors become one class with
    a weight.  A label's classes go to the nearest of its pivots (a sample of at
    most about ``max_cells``), which gives cells with a covering radius; cells
    over ``block`` members are dealt into sub-blocks, and only pairs of cells
    that the radii allow are joined, each pair of sub-blocks as a task of its
    own: no label sits in one task.  A task builds a cover tree on either side,
    traverses both together, and tests the remaining pairs' cosine in doubles.  It returns link
    counts and a spanning forest, never the pairs.

    ``n_links`` counts rows, copies included; ``component_id`` is the smallest
    id reachable (null if the component has no id); ``kept`` tells whether the
    row's id is that one.  Repeated rows link with each other.  An empty table
    gives an empty result; other columns are not read.
    """
    named = written(_classes(rows, id_col, vector_col, label_col), "vectors")
    classes = named.filter(F.col("node").isNotNull()).groupBy("node").agg(
        F.first("label").alias("label"), F.first("v").alias("v"), F.count("*").alias("weight"),
        F.min("id").alias("low"))
    classes = written(classes.withColumn("dim", F.size("v")), "vector_classes")
    tasks, points = _cells(classes, block, max_cells, least)
    sides = (points.join(tasks, ["label", "dim", "cell", "sub"])
             .select("task", "side", "node", "v", "weight"))
    sides = sides.repartition("task").sortWithinPartitions("task", "side", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _tasks(batches):
            yield _join_task(group, least)

    found = written(sides.mapInArrow(run, "node string, links long, other string"), "vector_links")
    counts = found.filter("links > 0").groupBy("node").agg(F.sum("links").alias("links"))
    labels = connected_components(found.filter("other is not null").select("node", "other"))
    named_by = classes.select("node", "weight", "low").join(
        labels.select("node", F.col("component").alias("c")), "node", "left")
    named_by = written(named_by.join(counts, "node", "left").select(
        "node", "low", F.coalesce("c", "node").alias("c"),
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")), "vector_nodes")
    # written, so that the join below shuffles both sides and a large component
    # is a skewed join that can be split
    lows = written(named_by.groupBy("c").agg(F.min("low").alias("component_id")), "vector_lows")
    final = written(named_by.join(lows, "c").select(
        F.col("node").alias("n"), "n_links", "component_id"), "vector_names")
    out = named.select("id", "node").join(final, F.col("node") == F.col("n"), "left")
    own = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col),
                      F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      own.alias("component_id"),
                      F.coalesce(F.col("id") == own, F.lit(False)).alias("kept"))


def _cells(classes: DataFrame, block: int, max_cells: int, least: float):
    """``(tasks, points)``: points with their cell and sub-block, and for each
    sub-block the tasks and sides it takes part in."""
    group = ["label", "dim"]
    sizes = classes.groupBy(*group).agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("want", F.least(F.lit(max_cells), F.ceil(F.col("n") / block)))
    sizes = written(sizes, "vector_labels")
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(3), "node"), 11) + 0.5) / float(1 << 53)
    # about ``want`` pivots a label, by a hash; none drawn: the label is one cell
    pivots = (classes.join(sizes, group).filter((F.col("want") > 1) & (u * F.col("n") < F.col("want")))
              .groupBy(*group).agg(F.sort_array(F.collect_list(F.struct("node", "v"))).alias("p")))
    pivots = written(pivots, "vector_pivots")
    x = classes.join(pivots, group, "left").select(*group, "node", "v", "weight", "p.v")
    x = x.toDF(*group, "node", "v", "weight", "pivots")

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell, dist = np.zeros(b.num_rows, np.int32), np.full(b.num_rows, 2.0)
            # rows of one label share their pivots
            label = pd.Series(list(zip(b.column(0).to_pylist(), b.column(1).to_pylist())))
            for _, rows in label.groupby(label).groups.items():
                p = b.column(5)[int(rows[0])].as_py()
                if p:
                    v = _unit(np.array(b.column(3).take(pa.array(rows)).to_pylist()))
                    d = _distances(v, _unit(np.array(p)))
                    cell[rows], dist[rows] = d.argmin(axis=1), d.min(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(k) for k in range(5)), pa.array(cell), pa.array(dist)],
                ["label", "dim", "node", "v", "weight", "cell", "dist"])

    kinds = {f.name: f.dataType.simpleString() for f in x.schema}
    placed = x.mapInArrow(nearest, ", ".join(
        f"{c} {kinds[c]}" for c in (*group, "node", "v", "weight")) + ", cell int, dist double")
    placed = written(placed, "vector_places")
    cells = placed.groupBy(*group, "cell").agg(F.count("*").alias("n"), F.max("dist").alias("r"))
    cells = written(cells.withColumn("parts", F.ceil(F.col("n") / block).cast("int")), "vector_cells")
    reach = float(np.sqrt(max(0.0, 2 - 2 * least))) + SLACK

    with_pivots = cells.join(pivots.select(*group, "p.v"), group, "left").toDF(
        *group, "cell", "n", "r", "parts", "p")
    allowed = with_pivots.groupBy(*group).applyInPandas(
        lambda g: cell_pairs(g, reach),
        f"label {kinds['label']}, dim int, a int, a_parts int, b int, b_parts int")
    # sub-block pairs grow with the square of a label: made in Spark, a row for
    # each sub-block of the first cell dealt out before the second's are added
    upto = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    x = allowed.withColumn("s", F.explode(upto("a_parts"))).repartition(*group, "a", "b", "s")
    x = x.withColumn("t", F.explode(upto("b_parts"))).filter("a < b or s <= t")
    sub_block = lambda c, k: F.concat_ws(".", c, k)
    task = F.concat_ws("/", "label", "dim", sub_block("a", "s"), sub_block("b", "t"))
    one, two = (F.struct(F.col(c).alias("cell"), F.col(k).alias("sub"), F.lit(n).alias("side"))
                for n, (c, k) in enumerate((("a", "s"), ("b", "t"))))
    sides = F.when(F.expr("a = b and s = t"), F.array(one)).otherwise(F.array(one, two))
    tasks = x.select(*group, task.alias("task"), F.explode(sides).alias("x")).select(
        *group, "x.cell", "x.sub", "task", "x.side")
    points = placed.join(cells.select(*group, "cell", "parts"), [*group, "cell"]).withColumn(
        "sub", F.pmod(F.xxhash64(F.lit(4), "node"), F.col("parts")).cast("int"))
    return written(tasks, "vector_tasks"), written(points.drop("parts", "dist"), "vector_points")


def cell_pairs(g: pd.DataFrame, reach: float) -> pd.DataFrame:
    """The cell pairs of one label (``max_cells`` cells or a few more) that their
    covering radii allow, with the sub-blocks of either: as many rows whatever
    the number of sub-blocks."""
    g = g.sort_values("cell").reset_index(drop=True)
    p = g["p"].iloc[0]
    keep = np.ones((len(g), len(g)), bool)
    if p is not None and len(p):
        c = _unit(np.array([list(p[k]) for k in g["cell"]]))
        r = g["r"].to_numpy()
        keep = _distances(c, c) <= r[:, None] + r[None, :] + reach
    i, j = np.nonzero(np.triu(keep))
    cell, parts = g["cell"].to_numpy(), g["parts"].to_numpy()
    return pd.DataFrame({"label": g["label"].iloc[0], "dim": g["dim"].iloc[0], "a": cell[i],
                         "a_parts": parts[i], "b": cell[j], "b_parts": parts[j]})


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]


def _tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each task, over batch ends."""
    held, last = [], None
    for b in batches:
        if not b.num_rows:
            continue
        task = b.column(0).to_pandas()
        cuts = [0, *np.flatnonzero((task != task.shift()).to_numpy())[1:].tolist(), b.num_rows]
        for s, e in zip(cuts, cuts[1:]):
            if task[s] != last and held:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(s, e - s))
            last = task[s]
    if held:
        yield pa.Table.from_batches(held)


def _join_task(group: pa.Table, least: float) -> pa.RecordBatch:
    side = group.column("side").to_numpy()
    v = group.column("v").combine_chunks()
    vectors = v.flatten().to_numpy(zero_copy_only=False).reshape(len(side), -1).astype(np.float64)
    # scaled by a power of two where squares could leave the doubles' range
    top = np.abs(vectors).max(axis=1)
    vectors = np.ldexp(vectors, -np.frexp(top)[1][:, None])
    cell = Cell(vectors, group.column("weight").to_numpy(), least)
    one = np.flatnonzero(side == 0)
    cell.join(one, np.flatnonzero(side == 1) if side.any() else None)
    node = group.column("node").to_pandas().to_numpy(object)
    a, b = cell.forest()
    hit = np.flatnonzero(cell.links)
    return pa.RecordBatch.from_arrays(
        [pa.array([*node[hit], *node[a]], pa.string()),
         pa.array([*cell.links[hit].tolist(), *[0] * len(a)], pa.int64()),
         pa.array([*[None] * len(hit), *node[b]], pa.string())], ["node", "links", "other"])
