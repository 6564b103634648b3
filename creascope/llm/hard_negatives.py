"""Hard negatives by inner product, searched in a multiway hyperplane tree.

Maximal inner products become nearest neighbours: every vector x gets one more component,
sqrt(M - |x|^2) with M the largest squared norm, and an anchor a gets 0; then
|a - x|^2 = |a|^2 + M - 2 <a, x>, so a window of scores is an annulus around the anchor.

The tree is GNAT's: a node has up to ``FANOUT`` split points, taken far apart from a bounded sample,
and a row goes to the nearest one. For each pair of siblings (i, j) the node stores the smallest and
largest distance from split point i to the rows below j, over all rows. A search computes the
distances from the anchor to the split points and drops every sibling j whose range from some i
the annulus, seen from there, cannot meet. The leaves left over are searched exactly, in whole
numbers.

The tree itself (points and ranges) has a fixed largest size. The rows stay in Spark: each is given its
leaf, leaves are cut into cells of about ``CELL_ROWS`` rows and ``CELL_ANCHORS`` anchors, and every
cell returns only its best rows per anchor and window.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from creascope.llm.common import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FANOUT = 16
SAMPLE_ROWS = 8192     # bound of the sample the split points and first bounds come from
LEAF_ROWS = 4096       # the tree gets deeper until leaves are about so large, as far as the sample allows
ANCHOR_BLOCK = 256
LEAST_SAMPLE = 2 * FANOUT  # a node with fewer sampled rows is a leaf
CELL_ROWS = 8192
CELL_ANCHORS = 512
SLACK = 1e-9           # relative, for distances in doubles; the leaves decide exactly
ROW = "vec_id long, label int, q array<long>, leaf int"
LOWEST = -(1 << 62)


# -- vectors in Arrow batches -----------------------------------------------------------------

def matrix(column: pa.Array, width: int) -> np.ndarray:
    """List column as a (rows, width) array of whole numbers; short lists end in zeros."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    out = np.zeros((len(array), width), np.int64)
    if len(array):
        bounds = array.offsets.to_numpy()
        sizes = np.diff(bounds)
        flat = array.values.to_numpy(zero_copy_only=False)[bounds[0]:bounds[-1]]
        out[np.arange(width) < sizes[:, None]] = flat
    return out


def scores(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products of the rows; doubles hold them exactly below 2**53, else Python numbers do."""
    if exact:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return (a.astype(object) @ b.astype(object).T).astype(np.int64)


def lifted(q: np.ndarray, largest: float) -> np.ndarray:
    """Rows with the component that brings all to the same norm."""
    x = q.astype(np.float64)
    rest = np.sqrt(np.maximum(largest - np.einsum("ij,ij->i", x, x), 0.0))
    return np.concatenate((x, rest[:, None]), axis=1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances between the rows, accurate also for close ones."""
    out = np.empty((len(a), len(b)))
    for j in range(len(b)):
        step = a - b[j]
        out[:, j] = np.sqrt(np.einsum("ij,ij->i", step, step))
    return out


# -- the tree ---------------------------------------------------------------------------------

class Tree:
    """``nodes`` holds (split points, children); a child is a node number or, below 0, leaf -1 - c."""

    def __init__(self, sample: np.ndarray, depth: int, largest: float):
        self.largest = largest
        self.nodes: list[tuple[np.ndarray, list[int]]] = []
        self.leaves = 0
        self.ranges: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.root = self._grow(lifted(sample, largest), depth)

    def _grow(self, points: np.ndarray, depth: int) -> int:
        chosen = far_apart(points, FANOUT) if depth and len(points) >= LEAST_SAMPLE else []
        if len(chosen) < 2:
            self.leaves += 1
            return -self.leaves
        node = len(self.nodes)
        splits = points[chosen]
        self.nodes.append((splits, []))
        nearest = distances(points, splits).argmin(axis=1)
        for j in range(len(splits)):
            self.nodes[node][1].append(self._grow(points[nearest == j], depth - 1))
        return node

    def place(self, points: np.ndarray, visit=None) -> np.ndarray:
        """Leaf of every row; ``visit`` is called with (node, distances, nearest split)."""
        leaf = np.zeros(len(points), np.int32)
        waiting = [(self.root, np.arange(len(points)))]
        while waiting:
            node, rows = waiting.pop()
            if node < 0:
                leaf[rows] = -1 - node
                continue
            splits, children = self.nodes[node]
            away = distances(points[rows], splits)
            nearest = away.argmin(axis=1)
            if visit is not None:
                visit(node, away, nearest)
            waiting += [(children[j], rows[nearest == j]) for j in np.unique(nearest)]
        return leaf

    def reached(self, point: np.ndarray, inner: float, outer: float) -> list[int]:
        """Leaves that can hold a row at a distance from ``inner`` to ``outer`` of the point."""
        found, waiting = [], [self.root]
        while waiting:
            node = waiting.pop()
            if node < 0:
                found.append(-1 - node)
                continue
            splits, children = self.nodes[node]
            if node not in self.ranges:  # no row below
                continue
            low, high = self.ranges[node]
            away = distances(point[None], splits)[0]
            slack = SLACK * (1.0 + outer + away)
            # seen from split point i the annulus lies between these distances
            least = np.maximum(np.maximum(away - outer, inner - away), 0.0) - slack
            most = away + outer + slack
            alive = ((low <= most[:, None]) & (high >= least[:, None])).all(axis=0)
            waiting += [children[j] for j in np.flatnonzero(alive)]
        return found


def far_apart(points: np.ndarray, count: int) -> list[int]:
    """Greedy choice: each point is the one farthest from those before it; equal ones stop it."""
    if not len(points):
        return []
    chosen = [0]
    away = distances(points, points[:1])[:, 0]
    while len(chosen) < count:
        following = int(away.argmax())
        if away[following] <= 0:
            break
        chosen.append(following)
        away = np.minimum(away, distances(points, points[following:following + 1])[:, 0])
    return chosen


def place_batches(batches: Iterator[pa.RecordBatch], tree, width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        leaf = tree.value.place(lifted(matrix(batch.column(2), width), tree.value.largest))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=["vec_id", "label", "q", "leaf"])


def range_batches(batches: Iterator[pa.RecordBatch], tree, width: int) -> Iterator[pa.RecordBatch]:
    """Per task the distance range of every pair of siblings, and the rows of every leaf."""
    low: dict[int, np.ndarray] = {}
    high: dict[int, np.ndarray] = {}
    rows = np.zeros(tree.value.leaves, np.int64)

    def visit(node, away, nearest):
        m = away.shape[1]
        if node not in low:
            low[node], high[node] = np.full((m, m), np.inf), np.full((m, m), -np.inf)
        for j in np.unique(nearest):
            part = away[nearest == j]
            low[node][:, j] = np.minimum(low[node][:, j], part.min(axis=0))
            high[node][:, j] = np.maximum(high[node][:, j], part.max(axis=0))

    for batch in batches:
        leaf = tree.value.place(lifted(matrix(batch.column(2), width), tree.value.largest), visit)
        rows += np.bincount(leaf, minlength=len(rows))
    out = [(node, i, j, low[node][i, j], high[node][i, j], 0) for node in low
           for i in range(len(low[node])) for j in range(len(low[node])) if np.isfinite(low[node][i, j])]
    out += [(-1, int(leaf), 0, 0.0, 0.0, int(n)) for leaf, n in enumerate(rows) if n]
    if out:
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["node", "i", "j", "low", "high", "n"])


def build_tree(rows: DataFrame, sample: np.ndarray, width: int, largest: float, total: int,
               leaf_rows: int) -> tuple[DataFrame, Tree, dict[int, int]]:
    """(rows with their leaf, tree with ranges over all rows, rows per leaf)."""
    spark = rows.sparkSession
    depth = 0
    while depth < 3 and total > leaf_rows * FANOUT ** depth:
        depth += 1
    tree = Tree(sample, depth, largest)
    shared = spark.sparkContext.broadcast(tree)
    placed = stored(rows.mapInArrow(lambda b: place_batches(b, shared, width), ROW), "placed")
    ranges = placed.mapInArrow(
        lambda b: range_batches(b, shared, width), "node int, i int, j int, low double, high double, n long")
    bounds = ranges.groupBy("node", "i", "j").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
    sizes: dict[int, int] = {}
    # at most FANOUT**2 rows per node and one per leaf, whatever the data
    for r in bounds.collect():
        if r["node"] < 0:
            sizes[r["i"]] = r["n"]
            continue
        if r["node"] not in tree.ranges:
            m = len(tree.nodes[r["node"]][0])
            tree.ranges[r["node"]] = np.full((m, m), np.inf), np.full((m, m), -np.inf)
        low, high = tree.ranges[r["node"]]
        low[r["i"], r["j"]], high[r["i"], r["j"]] = r["low"], r["high"]
    return placed, tree, sizes


# -- the search -------------------------------------------------------------------------------

# An anchor's row: its vector and the windows [lo, hi] of scores it asks for, each with the id that
# names it. ``same`` asks for rows of the anchor's label, otherwise for those of other labels.
QUERY = "anchor_id long, label int, q array<long>, names array<long>, lo array<long>, hi array<long>"
FOUND = "anchor_id long, name long, vec_id long, score long"


def best(score: np.ndarray, ids: np.ndarray, lo: int, hi: int, count: int) -> np.ndarray:
    """Positions of the first ``count`` rows in the window; rows are in order of the result."""
    first = int(np.searchsorted(-score, -hi, side="left"))
    last = int(np.searchsorted(-score, -lo, side="right"))
    return np.arange(first, min(last, first + count))


def allowed(label: int, own: int, labels: np.ndarray, ids: np.ndarray, same: bool) -> np.ndarray:
    return (labels == label) & (ids != own) if same else labels != label


def search_cell(asked: pa.Table, rows: pa.Table, width: int, count: int, same: bool, exact: bool) -> pa.Table:
    out: list[tuple[np.ndarray, ...]] = []
    if asked.num_rows and rows.num_rows:
        ids, labels = rows.column("vec_id").to_numpy(), rows.column("label").to_numpy()
        every = scores(matrix(asked.column("q"), width), matrix(rows.column("q"), width), exact)
        wanted = asked.select(["anchor_id", "label", "names", "lo", "hi"]).to_pylist()
        for a, score in zip(wanted, every):
            pick = np.flatnonzero(allowed(a["label"], a["anchor_id"], labels, ids, same)
                                  & (score >= min(a["lo"])) & (score <= max(a["hi"])))
            pick = pick[np.lexsort((ids[pick], -score[pick]))]
            for name, lo, hi in zip(a["names"], a["lo"], a["hi"]):
                at = pick[best(score[pick], ids[pick], lo, hi, count)]
                out.append((np.full(len(at), a["anchor_id"]), np.full(len(at), name), ids[at], score[at]))
    columns = [np.concatenate(c) if out else np.zeros(0, np.int64) for c in (zip(*out) if out else [()] * 4)]
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=["anchor_id", "name", "vec_id", "score"])


def reach_batches(batches: Iterator[pa.RecordBatch], tree, sample, width: int, count: int, same: bool,
                  exact: bool) -> Iterator[pa.RecordBatch]:
    """A row per anchor and leaf its windows can meet.

    The sample's rows narrow a window first: below the last of its ``count`` best rows in the
    window no other row can be among the best of all.
    """
    index, (s_ids, s_labels, s_q) = tree.value, sample.value
    for batch in batches:
        yield from (reach_block(batch.slice(at, ANCHOR_BLOCK), index, s_ids, s_labels, s_q, width, count, same, exact)
                    for at in range(0, batch.num_rows, ANCHOR_BLOCK))


def reach_block(batch: pa.RecordBatch, index: Tree, s_ids, s_labels, s_q, width: int, count: int, same: bool,
                exact: bool) -> pa.RecordBatch:
    vectors = matrix(batch.column(2), width)
    near = scores(vectors, s_q, exact)
    points = np.concatenate((vectors.astype(np.float64), np.zeros((len(vectors), 1))), axis=1)
    squares = np.einsum("ij,ij->i", points, points)
    who, leaves, los = [], [], []
    for i, a in enumerate(batch.select(["anchor_id", "label", "lo", "hi"]).to_pylist()):
        may = np.flatnonzero(allowed(a["label"], a["anchor_id"], s_labels, s_ids, same))
        ranked = np.sort(near[i][may])[::-1]
        narrowed, met = [], set()
        for lo, hi in zip(a["lo"], a["hi"]):
            at = best(ranked, s_ids, lo, hi, count)
            narrowed.append(int(ranked[at[-1]]) if len(at) == count else lo)
            around = squares[i] + index.largest
            inner = np.sqrt(max(around - 2.0 * hi, 0.0)) if hi < -LOWEST else 0.0
            outer = np.sqrt(max(around - 2.0 * narrowed[-1], 0.0)) if narrowed[-1] > LOWEST else np.inf
            outer = min(outer, 2.0 * np.sqrt(around))  # farther apart no two rows are
            margin = SLACK * (1.0 + np.sqrt(around))
            met.update(index.reached(points[i], max(inner - margin, 0.0), outer + margin))
        who += [i] * len(met)
        leaves += sorted(met)
        los += [narrowed] * len(met)
    picked = batch.take(pa.array(who, pa.int64()))
    return pa.RecordBatch.from_arrays(
        [*picked.columns[:4], pa.array(los, pa.list_(pa.int64())), picked.column(5), pa.array(leaves, pa.int32())],
        names=["anchor_id", "label", "q", "names", "lo", "hi", "leaf"])


def search(asked: DataFrame, placed: DataFrame, tree, sample, sizes: dict[int, int], width: int, count: int,
           same: bool, exact: bool, cell_rows: int, cell_anchors: int) -> DataFrame:
    """(anchor_id, name, vec_id, score, rank) of the ``count`` best rows per window of ``asked``."""
    spark = asked.sparkSession
    pairs = stored(asked.mapInArrow(
        lambda b: reach_batches(b, tree, sample, width, count, same, exact), f"{QUERY}, leaf int"), "reached")
    # both tables have a row per leaf, and the number of leaves is bounded
    asking = {r["leaf"]: r["n"] for r in pairs.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
    plan = spark.createDataFrame(
        [(leaf, -(-n // cell_rows), -(-asking[leaf] // cell_anchors)) for leaf, n in sizes.items() if leaf in asking],
        "leaf int, slices long, blocks long")
    cells = F.broadcast(plan)
    rows = placed.join(cells, "leaf").select(
        "vec_id", "label", "q", "leaf", F.pmod(F.xxhash64("vec_id", "label"), "slices").alias("slice"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    wanted = pairs.join(cells, "leaf").select(
        *[c.split()[0] for c in QUERY.split(", ")], "leaf",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice"),
        F.pmod(F.xxhash64("anchor_id"), "blocks").alias("block"))
    key = ["leaf", "slice", "block"]
    found = wanted.groupBy(*key).cogroup(rows.groupBy(*key)).applyInArrow(
        lambda a, b: search_cell(a, b, width, count, same, exact), FOUND)
    order = Window.partitionBy("anchor_id", "name").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count)


def hard_negatives(
    vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
    id_col: str = "vec_id", label_col: str = "label", vector_col: str = "q", leaf_rows: int = LEAF_ROWS,
    cell_rows: int = CELL_ROWS, cell_anchors: int = CELL_ANCHORS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors`` holds vectors of whole numbers; scores are inner products. Each row for which
    ``anchor`` holds gets its ``positives`` best other rows of the same label, and for each of these the
    ``negatives`` best rows of other labels whose score is ``low`` to ``high`` percent of the positive's.
    Higher scores come first, ties go to the smaller id.

    Rows with a NULL id, label, vector or component take no part. Shorter vectors count as ended with zeros.
    Repeated rows each count, but are never their own positive; of anchors with one id the one of the
    smallest label and vector asks. An empty table gives no row, an anchor without positives or
    without negatives none either. A positive with a negative score has an empty window. Other columns
    are not read. Scores beyond 64 bits raise an error.
    """
    spark = vectors.sparkSession
    rows = stored(vectors.filter(
        F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull()
        & ~F.exists(vector_col, lambda x: x.isNull())).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("int").alias("label"),
        F.col(vector_col).cast("array<long>").alias("q"), F.coalesce(anchor, F.lit(False)).alias("asks")), "vectors")
    # the largest squared norm in doubles: it bounds every score
    square = F.aggregate("q", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    total, width, largest = rows.agg(F.count("*"), F.max(F.size("q")), F.max(square)).first()
    width, largest = width or 1, largest or 0.0
    if largest >= 2.0 ** 62:
        raise ValueError(f"squared norms up to {largest:.3g} make scores beyond 64 bits")
    exact = largest < 2.0 ** 53
    largest = largest * (1 + 1e-12) + 1.0

    vectors = rows.select("vec_id", "label", "q")
    drawn = vectors.orderBy(F.xxhash64("vec_id"), "vec_id", "label", "q").limit(SAMPLE_ROWS).toArrow()
    sampled = matrix(drawn.column("q"), width)
    placed, built, sizes = build_tree(vectors, sampled, width, largest, total, leaf_rows)
    tree = spark.sparkContext.broadcast(built)
    sample = spark.sparkContext.broadcast(
        (drawn.column("vec_id").to_numpy(), drawn.column("label").to_numpy(), sampled))
    anchors = stored(rows.filter("asks").groupBy(F.col("vec_id").alias("anchor_id")).agg(
        F.min(F.struct("label", "q")).alias("r")).select("anchor_id", "r.label", "r.q"), "anchors")

    everything = anchors.select(
        "*", F.array("anchor_id").alias("names"), F.array(F.lit(LOWEST).cast("long")).alias("lo"),
        F.array(F.lit(-LOWEST).cast("long")).alias("hi"))
    same = stored(search(
        everything, placed, tree, sample, sizes, width, positives, True, exact, cell_rows, cell_anchors), "positives")
    lowest = F.expr(f"cast(ceil(cast(score as decimal(20, 0)) * {low} / 100) as long)")
    highest = F.expr(f"cast(floor(cast(score as decimal(20, 0)) * {high} / 100) as long)")
    windows = same.withColumns({"lo": lowest, "hi": highest}).filter("lo <= hi").groupBy("anchor_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "lo", "hi"))).alias("w"))
    windowed = anchors.join(windows, "anchor_id").select(
        "anchor_id", "label", "q", F.expr("transform(w, x -> cast(x.rank as long))").alias("names"), F.col("w.lo").alias("lo"), F.col("w.hi").alias("hi"))
    # a window is named by its positive's rank, as rows with one id can be positives twice
    other = search(
        windowed, placed, tree, sample, sizes, width, negatives, False, exact, cell_rows, cell_anchors)
    given = same.select("anchor_id", F.col("rank").cast("long").alias("name"), F.col("vec_id").alias("positive_id"),
                        F.col("score").alias("positive_score"))
    return other.join(given, ["anchor_id", "name"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
