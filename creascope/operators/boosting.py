"""Gradient-boosted regression trees by histograms, grown best leaf first.

The rows are stored once and dealt to slices of at most ``TASK_ROWS`` rows with their quantile bins, one byte
per feature. Several fits over the same rows (models and folds of a cross-validation, targets) grow in the
same jobs: a block of arrays per slice and fit stays cached in between, each in a task of its own.

A level of a tree is one job: every task adds up gradient and row count per node, feature and bin, the sums
are reduced per node, and the best split of each node is found where its sums are. Only the splits come back
to the driver, at most one per node. With a single slice there is nothing to reduce: its tasks go through
the same levels by themselves, ``STORE_ROUNDS`` trees a job. They add up the smaller child of every split only;
the sums of the larger one are those of the parent without it. A tree is grown level by level to its depth and
then taken best leaf first until it has its leaves, which gives the same tree as growing it in that
order, as a split's gain does not depend on when it is made.

The blocks get each round's trees added when the next round first reads them. With several slices they are
checkpointed every ``STORE_ROUNDS`` rounds, so a lost block is made again from that many trees at most.
"""

from __future__ import annotations

import heapq
import json
import pickle
import sys
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from creascope.session import stash

# the Python workers need not have this package installed: its functions travel with the task
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STORE_ROUNDS = 50
# Rows of one slice, about 100 bytes each; the sums of a single slice need no reducing. A job per level costs
# more than a task adds up in the meantime, so only tables beyond this are parted.
TASK_ROWS = 1_000_000
MOST_BINS = 256  # bins are single bytes
Slice = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # row, fold, y per target, bins per feature
Block = tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # fit, row, fold, y, bins, score


@dataclass(frozen=True)
class Settings:
    """Defaults of the boosted trees. ``max_bins`` bounds the bins of a feature."""
    rounds: int = 300
    rate: float = 0.05
    max_depth: int = 6
    leaves: int = 31
    min_rows: int = 10
    row_share: float = 0.8
    column_share: float = 0.8
    l1: float = 0.1
    l2: float = 0.1
    seed: int = 42
    max_bins: int = 255


@dataclass
class Tree:
    """Nodes as parallel lists; ``left`` is -1 in a leaf, ``value`` is kept for every node."""
    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def add(self, value: float) -> int:
        for column, start in ((self.feature, -1), (self.bin, -1), (self.left, -1), (self.right, -1), (self.value, value)):
            column.append(start)
        return len(self.value) - 1

    def walk(self, bins: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Step by step (rows that move on, node they leave, node they reach); all start at node 0."""
        feature, edge, left, right = (np.array(c) for c in (self.feature, self.bin, self.left, self.right))
        rows, at = np.arange(len(bins)), np.zeros(len(bins), np.int64)
        while True:
            inner = left[at] >= 0
            rows, at = rows[inner], at[inner]
            if not len(rows):
                return
            low = bins[rows, feature[at]] <= edge[at]
            following = np.where(low, left[at], right[at])
            yield rows, at, following
            at = following

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """Leaf each row ends in."""
        out = np.zeros(len(bins), np.int64)
        parts = [(0, np.arange(len(bins)))]
        while parts:
            node, rows = parts.pop()
            if self.left[node] < 0:
                out[rows] = node
            elif len(rows):
                low, high = self.parted(node, rows, bins.T)
                parts += [(self.left[node], low), (self.right[node], high)]
        return out

    def parted(self, node: int, rows: np.ndarray, bins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows of a split node that go left and right; ``bins`` has a line per feature."""
        low = bins[self.feature[node]][rows] <= self.bin[node]
        return rows[low], rows[~low]

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.nodes(bins)]


@dataclass
class Forest:
    """A fitted model: features, bin edges per feature, mean of the target and trees."""
    features: list[str]
    edges: list[list[float]]
    base: float
    trees: list[Tree]

    @property
    def offset(self) -> float:
        """What every prediction starts from: the mean of the target and the values of the roots."""
        return self.base + sum(t.value[0] for t in self.trees)

    def bins(self, values: np.ndarray) -> np.ndarray:
        return binned(values, self.edges)

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        """Add the prediction; missing and NaN features count as 0."""
        # fixed-size model: trees times leaves
        shared = df.sparkSession.sparkContext.broadcast(self)

        @F.pandas_udf("double")
        def predict(columns: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            for frame in columns:
                bins = shared.value.bins(frame.to_numpy(np.float64))
                yield pd.Series(shared.value.base + sum((t.predict(bins) for t in shared.value.trees), np.zeros(len(bins))))

        return df.withColumn(output, predict(F.struct(*[number(name).alias(name) for name in self.features])))

    def contributions(self, df: DataFrame, output: str = "contributions", top: int | None = 5) -> DataFrame:
        """Add what each feature moved the prediction by, largest movement first.

        Each step from a node to its child changes the node's value; the change goes to the feature that
        was asked. Together with ``offset`` all contributions add up to the prediction. ``top`` keeps the
        first ones; None keeps all features.
        """
        shared = df.sparkSession.sparkContext.broadcast(self)

        @F.pandas_udf("array<double>")
        def moved(columns: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            for frame in columns:
                forest, bins = shared.value, shared.value.bins(frame.to_numpy(np.float64))
                total = np.zeros(bins.shape)
                for tree in forest.trees:
                    feature, value = np.array(tree.feature), np.array(tree.value)
                    for rows, at, following in tree.walk(bins):
                        total[rows, feature[at]] += value[following] - value[at]
                yield pd.Series(list(total))

        parts = moved(F.struct(*[number(name).alias(name) for name in self.features]))
        names = F.array(*[F.lit(name) for name in self.features])
        pairs = F.zip_with(names, parts, lambda f, v: F.struct(
            (-F.abs(v)).alias("order"), f.alias("feature"), v.alias("contribution")))
        ranked = F.transform(F.array_sort(pairs), lambda p: F.struct(
            p["feature"].alias("feature"), p["contribution"].alias("contribution")))
        return df.withColumn(output, ranked if top is None else F.slice(ranked, 1, top))

    def importances(self) -> list[tuple[str, float]]:
        """How many splits use each feature, most first."""
        counts = np.bincount([f for t in self.trees for f in t.feature if f >= 0], minlength=len(self.features))
        return sorted(((n, float(c)) for n, c in zip(self.features, counts)), key=lambda pair: (-pair[1], pair[0]))

    def save(self, spark: SparkSession, path: str) -> None:
        header = json.dumps({"features": self.features, "edges": self.edges, "base": self.base})
        rows = [(-1, header)] + [(i, json.dumps(asdict(t))) for i, t in enumerate(self.trees)]
        spark.createDataFrame(rows, "tree int, content string").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Forest:
        rows = {r["tree"]: json.loads(r["content"]) for r in spark.read.parquet(path).collect()}
        return cls(**rows.pop(-1), trees=[Tree(**rows[i]) for i in sorted(rows)])


def number(name: str) -> Column:
    value = F.col(f"`{name}`").cast("double")
    return F.coalesce(F.nanvl(value, F.lit(0.0)), F.lit(0.0))


def binned(values: np.ndarray, edges: Sequence[Sequence[float]]) -> np.ndarray:
    """Bin b holds values above edge b - 1, up to edge b."""
    out = np.empty(values.shape, np.uint8)
    for j, cuts in enumerate(edges):
        out[:, j] = np.searchsorted(cuts, values[:, j], side="left")
    return out


def quantile_edges(df: DataFrame, features: Sequence[str], max_bins: int = 255) -> list[list[float]]:
    """At most ``max_bins`` - 1 cuts per feature, at its approximate quantiles; one scan for all."""
    shares = [i / max_bins for i in range(1, max_bins)]
    row = df.agg(*[F.percentile_approx(number(f), shares, 20 * max_bins).alias(f"q{i}") for i, f in enumerate(features)],
                 *[F.max(number(f)).alias(f"m{i}") for i, f in enumerate(features)]).first()
    # a cut at the largest value would leave nothing above it
    return [sorted(set(row[f"q{i}"] or ()) - {row[f"m{i}"]}) for i in range(len(features))]


# -- fitting ----------------------------------------------------------------------------------

@dataclass
class Fit:
    """One model in the making: which target, which features, and the fold it leaves out (-1: none)."""
    target: int
    features: list[int]
    fold: int
    base: float = 0.0
    trees: list[Tree] = field(default_factory=list)
    columns: list[int] = field(default_factory=list)  # features of the tree being grown
    growing: Tree | None = None
    active: list[int] = field(default_factory=list)   # its nodes whose split is looked for
    splits: dict[int, tuple] = field(default_factory=dict)
    done: bool = False


def hashed(row: np.ndarray, salt: int) -> np.ndarray:
    """A number in [0, 1) per row and salt, by the finalizer of the public SplitMix64 generator."""
    z = row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt * 0x632BE59BD9B4E019 % (1 << 64))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / (1 << 53)


def slices_of(raw: DataFrame, cuts: Sequence[Sequence[float]], tasks: int) -> RDD[Slice]:
    """The stored rows in ``tasks`` slices of arrays, one per task; a lost slice is read again."""
    def packed(batches):
        parts = []
        for batch in batches:
            n = batch.num_rows
            y, values = (np.asarray(batch.column(i).flatten().to_numpy(zero_copy_only=False), np.float64).reshape(n, -1)
                         for i in (2, 3))
            parts.append((batch.column(0).to_numpy(), batch.column(1).to_numpy(), y.T,
                          np.ascontiguousarray(binned(values.reshape(n, len(cuts)), cuts).T)))
        if parts:
            content = pickle.dumps(tuple(np.concatenate(column, axis=-1) for column in zip(*parts)), protocol=5)
            yield pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], names=["slice"])

    dealt = raw.coalesce(1) if tasks == 1 else raw.repartition(tasks)
    sliced = dealt.mapInArrow(packed, "slice binary").rdd.map(lambda record: pickle.loads(record[0]))
    return sliced.persist(StorageLevel.MEMORY_AND_DISK)


def blocks_of(slices: RDD[Slice], fits: Sequence[Fit]) -> RDD[Block]:
    """Every slice once per fit, each in a partition of its own; the fits with most features start first."""
    def block(i: int, target: int, base: float):
        def of(part: Slice) -> Block:
            row, fold, y, bins = part
            return i, row, fold, y[target], bins, np.full(len(row), base)
        return of

    parts = [slices.map(block(i, f.target, f.base)) for i, f in sorted(enumerate(fits), key=lambda p: -len(p[1].features))]
    return slices.context.union(parts).persist(StorageLevel.MEMORY_AND_DISK)


def advanced(block: Block, trees: Mapping[int, Tree | None]) -> Block:
    """The block with the prediction of one more tree of its fit (None: none) in its score."""
    i, row, fold, y, bins, score = block
    return block if trees.get(i) is None else (i, row, fold, y, bins, score + trees[i].predict(bins.T))


def sampled(block: Block, fit: Fit, settings: Settings, turn: int) -> tuple[np.ndarray, np.ndarray]:
    """(bins, gradient) of the rows that a fit's tree is grown on."""
    i, row, fold, y, bins, score = block
    use = (fold != fit.fold) & ~np.isnan(y)
    if settings.row_share < 1:
        use &= hashed(row, settings.seed + 1000 * turn + i) < settings.row_share
    return bins[:, use], (score - y)[use]


def histograms(bins: np.ndarray, gradient: np.ndarray, fit: Fit, offsets: np.ndarray) -> dict[int, np.ndarray]:
    """Sums per active node with rows: gradient and rows per bin, the bins of all features one after the other."""
    nodes = len(fit.active)
    place = np.full(len(fit.growing.value), -1)
    place[fit.active] = np.arange(nodes)
    node = place[fit.growing.nodes(bins.T)]
    inside = np.flatnonzero(node >= 0)
    node, gradient = node[inside], gradient[inside]
    total = np.zeros((nodes, 2, int(offsets[-1])))
    for column in fit.columns:
        first, last = int(offsets[column]), int(offsets[column + 1])
        flat = node * (last - first) + bins[column][inside]
        for k, weight in ((0, gradient), (1, None)):
            total[:, k, first:last] = np.bincount(flat, weight, nodes * (last - first)).reshape(nodes, -1)
    return {n: total[j] for j, n in enumerate(fit.active) if total[j, 1].any()}


def group_sums(bins: np.ndarray, gradient: np.ndarray, groups: Sequence[np.ndarray], columns: Sequence[int], offsets: np.ndarray) -> np.ndarray:
    """Sums per group of rows: gradient and rows per bin, the bins of the ``columns`` one after the other."""
    at = np.concatenate(groups)
    base = np.repeat(np.arange(len(groups)) * MOST_BINS, [len(rows) for rows in groups])
    weights = gradient[at]
    total = np.empty((len(groups), 2, int(offsets[-1])))
    for j, column in enumerate(columns):
        first, last = int(offsets[j]), int(offsets[j + 1])
        flat = base + bins[column][at]
        for k, weight in ((0, weights), (1, None)):
            total[:, k, first:last] = np.bincount(flat, weight, len(groups) * MOST_BINS).reshape(-1, MOST_BINS)[:, :last - first]
    return total


def grow(bins: np.ndarray, gradient: np.ndarray, fit: Fit, offsets: np.ndarray, settings: Settings) -> None:
    """All levels of a started tree whose rows are all here."""
    tree, columns = fit.growing, fit.columns
    offsets = np.concatenate(([0], np.cumsum(np.diff(offsets)[columns])))
    rows = {0: np.arange(len(gradient))}
    sums = {0: group_sums(bins, gradient, list(rows.values()), columns, offsets)[0]} if len(gradient) else {}
    for level in range(settings.max_depth):
        found = []
        for node, total in sums.items():
            feature, *split = best_split(total, range(len(columns)), offsets, settings)
            found.append((node, columns[feature] if feature >= 0 else -1, *split))
        extend(fit, found, settings)
        if level == settings.max_depth - 1 or not fit.active:
            break
        sides = []  # (smaller child, larger child, their node)
        for node in sums:
            if node in fit.splits:
                children = tree.left[node], tree.right[node]
                rows.update(zip(children, tree.parted(node, rows[node], bins)))
                if any(child in fit.active for child in children):
                    sides.append((*sorted(children, key=lambda child: len(rows[child])), node))
        # every row is added up in at most every other level
        smaller = group_sums(bins, gradient, [rows[small] for small, _, _ in sides], columns, offsets)
        both = {}
        for total, (small, large, node) in zip(smaller, sides):
            both |= {small: total, large: sums[node] - total}
        sums = {node: both[node] for node in fit.active}


def weight_of(g, n, settings: Settings):
    """Value of a leaf before the rate: minus the shrunk gradient sum over the rows and L2 term."""
    return -np.sign(g) * np.maximum(np.abs(g) - settings.l1, 0.0) / (n + settings.l2)


def gain_of(g, n, settings: Settings):
    return np.maximum(np.abs(g) - settings.l1, 0.0) ** 2 / (n + settings.l2)


def best_split(sums: np.ndarray, columns: Sequence[int], offsets: np.ndarray, settings: Settings) -> tuple:
    """(feature, bin, gain, left gradient, left rows, gradient, rows); feature -1 without a split."""
    gradient, rows = np.cumsum(sums, axis=1)
    size = np.diff(offsets)
    # what the features before add up to; every row is in one bin of each sampled feature
    before = np.concatenate(([[0.0], [0.0]], (gradient, rows)), axis=1)[:, offsets[:-1]]
    first = columns[0]
    g, n = (float(total[offsets[first + 1] - 1] - start) for total, start in zip((gradient, rows), before[:, first]))
    gl, nl = gradient - np.repeat(before[0], size), rows - np.repeat(before[1], size)
    allowed = np.zeros(len(gl), bool)
    for feature in columns:
        allowed[offsets[feature]:offsets[feature + 1] - 1] = True
    allowed &= (nl >= settings.min_rows) & (n - nl >= settings.min_rows)
    if not allowed.any():
        return -1, -1, 0.0, 0.0, 0.0, g, n
    gain = np.where(allowed, gain_of(gl, nl, settings) + gain_of(g - gl, n - nl, settings), -np.inf)
    gained = gain - float(gain_of(g, n, settings))
    # sums of the same rows in another order differ in the last digits: the first of equal gains is taken
    at = int(np.flatnonzero(gained >= gained.max() - 1e-9 * abs(gained.max()))[0])
    if gained[at] <= 1e-12:
        return -1, -1, 0.0, 0.0, 0.0, g, n
    feature = int(np.searchsorted(offsets, at, side="right")) - 1
    return feature, at - int(offsets[feature]), float(gained[at]), float(gl[at]), float(nl[at]), g, n


def best_first(tree: Tree, splits: Mapping[int, tuple], leaves: int) -> Tree:
    """The part of a tree grown level by level that best-leaf growth reaches with ``leaves`` leaves; its root is split."""
    out, count = Tree(), 1
    waiting = [(-splits[0][2], 0, out.add(tree.value[0]))]
    while waiting and count < leaves:
        _, node, copy = heapq.heappop(waiting)
        out.feature[copy], out.bin[copy] = tree.feature[node], tree.bin[node]
        for side, child in (("left", tree.left[node]), ("right", tree.right[node])):
            twin = out.add(tree.value[child])
            getattr(out, side)[copy] = twin
            if child in splits:
                heapq.heappush(waiting, (-splits[child][2], child, twin))
        count += 1
    return out


def start(fit: Fit, i: int, settings: Settings, turn: int) -> None:
    """A new tree on a draw of the features."""
    draw = np.random.default_rng([settings.seed, turn, i])
    count = max(1, round(settings.column_share * len(fit.features)))
    fit.columns = sorted(int(c) for c in draw.choice(fit.features, count, replace=False))
    fit.growing, fit.active, fit.splits = Tree(), [0], {}
    fit.growing.add(0.0)


def extend(fit: Fit, found: Sequence[tuple], settings: Settings) -> None:
    """One level more, from (node, best split) of the active nodes."""
    tree, fit.active = fit.growing, []
    for node, feature, edge, gain, gl, nl, g, n in sorted(found):
        tree.value[node] = settings.rate * float(weight_of(g, n, settings))
        if feature < 0:
            continue
        tree.feature[node], tree.bin[node] = feature, edge
        halves = ((gl, nl), (g - gl, n - nl))
        tree.left[node], tree.right[node] = (
            tree.add(settings.rate * float(weight_of(part, rows_in, settings))) for part, rows_in in halves)
        fit.active += [child for child, (_, rows_in) in zip((tree.left[node], tree.right[node]), halves)
                       if rows_in >= 2 * settings.min_rows]
        fit.splits[node] = (feature, edge, gain)


def finish(fit: Fit, settings: Settings) -> Tree | None:
    """The grown tree; without a split the fit ends, as no later tree would find one on these gradients."""
    tree = best_first(fit.growing, fit.splits, settings.leaves) if fit.splits else None
    if tree is None:
        fit.done = True
    else:
        fit.trees.append(tree)
    fit.growing, fit.active, fit.splits = None, [], {}
    return tree


def grown_alone(block: Block, fit: Fit, offsets: np.ndarray, settings: Settings, turns: Sequence[int]) -> tuple[Block, list[Tree], bool]:
    """(block, new trees, whether the fit has ended) for a block with all rows of its fit."""
    i, fit = block[0], replace(fit, trees=[])
    for turn in turns:
        if fit.done:
            break
        start(fit, i, settings, turn)
        grow(*sampled(block, fit, settings, turn), fit, offsets, settings)
        block = advanced(block, {i: finish(fit, settings)})
    return block, fit.trees, fit.done


def boost_alone(blocks: RDD[Block], fits: list[Fit], offsets: np.ndarray, settings: Settings) -> RDD[Block]:
    """Grow all ``fits`` on one block each; returns the blocks with their final scores."""
    for first in range(0, settings.rounds, STORE_ROUNDS):
        if all(f.done for f in fits):
            break
        turns = range(first, min(first + STORE_ROUNDS, settings.rounds))
        known = [replace(f, trees=[]) for f in fits]
        grown = blocks.map(lambda b, k=known, t=turns: grown_alone(b, k[b[0]], offsets, settings, t)).persist(
            StorageLevel.MEMORY_AND_DISK)
        for i, trees, done in grown.map(lambda found: (found[0][0], *found[1:])).collect():
            fits[i].trees += trees
            fits[i].done = done
        older, blocks = blocks, grown.map(lambda found: found[0]).persist(StorageLevel.MEMORY_AND_DISK)
        blocks.count()
        older.unpersist()
        grown.unpersist()
    return blocks


def boost(blocks: RDD[Block], fits: list[Fit], offsets: np.ndarray, settings: Settings) -> RDD[Block]:
    """Grow all ``fits`` in step, level by level; returns the blocks with their final scores."""
    older = None
    for turn in range(settings.rounds):
        live = [(i, f) for i, f in enumerate(fits) if not f.done]
        if not live:
            break
        for i, fit in live:
            start(fit, i, settings, turn)
        for _ in range(settings.max_depth):
            if not any(f.active for _, f in live):
                break
            # the trees grown so far stay here
            known = [replace(f, trees=[]) for f in fits]

            def sums(block: Block, known=known, turn=turn):
                fit = known[block[0]]
                if not fit.active:
                    return []
                found = histograms(*sampled(block, fit, settings, turn), fit, offsets)
                return [((block[0], node), total) for node, total in found.items()]

            found = blocks.flatMap(sums).reduceByKey(np.add).map(lambda kv, k=known: (
                *kv[0], *best_split(kv[1], k[kv[0][0]].columns, offsets, settings))).collect()
            if older is not None:
                older.unpersist()
                older = None
            for i, fit in live:
                extend(fit, [split for at, *split in found if at == i], settings)
        trees = {i: finish(fit, settings) for i, fit in live}
        older, blocks = blocks, blocks.map(lambda block, t=trees: advanced(block, t)).persist(StorageLevel.MEMORY_AND_DISK)
        if turn % STORE_ROUNDS == STORE_ROUNDS - 1:
            blocks.checkpoint()
    return blocks


def score_rows(blocks: RDD[Block], spark: SparkSession) -> DataFrame:
    """(row, fit, score) of every block."""
    def packed(block: Block) -> tuple[bytearray]:
        i, row, *_, score = block
        batch = pa.RecordBatch.from_arrays(
            [pa.array(row), pa.array(np.full(len(row), i, np.int32)), pa.array(score)], names=["row", "fit", "score"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema) as writer:
            writer.write_batch(batch)
        return (bytearray(sink.getvalue().to_pybytes()),)

    def opened(batches):
        for batch in batches:
            for content in batch.column(0).to_pylist():
                yield pa.ipc.open_stream(content).read_next_batch()

    return spark.createDataFrame(blocks.map(packed), "block binary").mapInArrow(opened, "row long, fit int, score double")


def fit_together(
    df: DataFrame, models: Sequence[tuple[Sequence[str], str, int]], settings: Settings = Settings(),
    fold: str | None = None, edges: Mapping[str, Sequence[float]] | None = None,
) -> tuple[list[Forest], DataFrame]:
    """Fit several models on one table: (forests, scores).

    ``models`` holds (features, target, fold left out or -1); rows without the target take no part in its
    fit. ``scores`` holds (row, fold, y, score): all targets and the scores of all models for every row,
    so a cross-validation's predictions are there without another pass. Missing and NaN features count
    as 0. Bin edges come from all rows, or from ``edges`` per feature.
    """
    names = list(dict.fromkeys(f for features, _, _ in models for f in features))
    targets = list(dict.fromkeys(target for _, target, _ in models))
    cuts = [list(edges[n]) for n in names] if edges else quantile_edges(df, names, settings.max_bins)
    fold_column = F.col(fold).cast("int") if fold else F.lit(0)
    raw = df.select(
        F.monotonically_increasing_id().alias("row"), F.coalesce(fold_column, F.lit(-2)).alias("fold"),
        F.array(*[F.coalesce(F.col(t).cast("double"), F.lit(float("nan"))) for t in targets]).alias("y"),
        F.array(*[number(n) for n in names]).alias("values"))
    raw = stash(raw, "boosting")
    # one row per fold: sum and count of every target give every fit's mean
    known = [F.when(~F.isnan(F.col("y")[t]), F.col("y")[t]) for t in range(len(targets))]
    parts = raw.groupBy("fold").agg(
        F.count("*").alias("rows"),
        *[F.sum(y).alias(f"s{t}") for t, y in enumerate(known)], *[F.count(y).alias(f"c{t}") for t, y in enumerate(known)]).collect()
    fits = []
    for features, target, left_out in models:
        t = targets.index(target)
        used = [r for r in parts if r["fold"] != left_out]
        count = sum(r[f"c{t}"] for r in used)
        base = sum(r[f"s{t}"] or 0.0 for r in used) / count if count else 0.0
        fits.append(Fit(t, [names.index(f) for f in features], left_out, base, done=not features or not count))
    tasks = -(-sum(r["rows"] for r in parts) // TASK_ROWS) or 1
    offsets = np.concatenate(([0], np.cumsum([len(e) + 1 for e in cuts])))
    slices = slices_of(raw, cuts, tasks)
    grown = boost_alone if tasks == 1 else boost
    blocks = grown(blocks_of(slices, fits), fits, offsets, settings)
    long = stash(score_rows(blocks, df.sparkSession), "fitted")
    blocks.unpersist()
    slices.unpersist()
    # one score per fit
    wide = long.groupBy("row").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("fit", "score"))), lambda s: s["score"]).alias("score"))
    scores = stash(raw.join(wide, "row").select("row", "fold", "y", "score"), "scores")
    forests = []
    for (features, _, _), fit in zip(models, fits):
        place = {j: i for i, j in enumerate(fit.features)}
        trees = [Tree([place.get(f, -1) for f in t.feature], t.bin, t.left, t.right, t.value) for t in fit.trees]
        forests.append(Forest(list(features), [cuts[j] for j in fit.features], fit.base, trees))
    return forests, scores


def fit_forest(df: DataFrame, features: Sequence[str], target: str, **settings) -> Forest:
    """One forest on the rows whose target is known."""
    forests, _ = fit_together(df, [(features, target, -1)], Settings(**settings))
    return forests[0]
