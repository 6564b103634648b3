"""Histogram boosting against a plain best-first version, and its shared jobs, storage and attributions."""

import heapq

import numpy as np
import pytest
from pyspark.sql import functions as F

from creascope.operators import boosting, models
from creascope.operators.boosting import Settings

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    n = 400
    x = np.column_stack([rng.integers(0, 30, n), rng.normal(size=n).round(1), rng.integers(0, 4, n)]).astype(float)
    y = np.sin(x[:, 0] / 4) + x[:, 1] * (x[:, 2] > 1) + rng.normal(scale=0.1, size=n)
    rows = [(i, *map(float, r), float(v), i % 4) for i, (r, v) in enumerate(zip(x, y))]
    rows += [(n, float("nan"), None, 1.0, None, 1), (n + 1, None, 1.0, 1.0, None, None)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, y double, k int").repartition(5)
    return df.cache(), x, y


def plain(x, y, settings):
    """Predictions of boosting that searches every value of every feature and splits the best leaf."""
    score = np.full(len(y), y.mean())
    for _ in range(settings.rounds):
        g = score - y

        def value(rows):
            total = g[rows].sum()
            return -np.sign(total) * max(abs(total) - settings.l1, 0) / (len(rows) + settings.l2)

        def share(rows):
            return max(abs(g[rows].sum()) - settings.l1, 0) ** 2 / (len(rows) + settings.l2)

        def split(rows, depth):
            found = None
            for j in range(x.shape[1]) if depth < settings.max_depth else ():
                for cut in np.unique(x[rows, j])[:-1]:
                    low, high = rows[x[rows, j] <= cut], rows[x[rows, j] > cut]
                    if min(len(low), len(high)) < settings.min_rows:
                        continue
                    gain = share(low) + share(high) - share(rows)
                    if gain > 0 and (found is None or gain > found[0] * (1 + 1e-9)):
                        found = (gain, low, high)
            return found

        leaves, waiting, count = [], [], 0

        def leaf(rows, depth):
            nonlocal count
            found = split(rows, depth)
            count += 1
            if found:
                heapq.heappush(waiting, (-found[0], count, rows, depth, found))
            else:
                leaves.append(rows)

        leaf(np.arange(len(y)), 0)
        while waiting and len(leaves) + len(waiting) < settings.leaves:
            _, _, _, depth, (_, low, high) = heapq.heappop(waiting)
            leaf(low, depth + 1)
            leaf(high, depth + 1)
        for rows in leaves + [w[2] for w in waiting]:
            score[rows] += settings.rate * value(rows)
    return score


@pytest.mark.parametrize("leaves, depth", [(31, 6), (5, 6), (31, 2)])
def test_equals_plain_boosting(data, leaves, depth):
    df, x, y = data
    settings = Settings(rounds=3, rate=0.3, leaves=leaves, max_depth=depth, min_rows=7, row_share=1.0, column_share=1.0)
    edges = {n: sorted(set(x[:, j]))[:-1] for j, n in enumerate(NAMES)}
    forests, scores = boosting.fit_together(df.filter("id < 400"), [(NAMES, "y", -1)], settings, edges=edges)
    expected = plain(x, y, settings)
    assert all(len(t.value) <= 2 * leaves - 1 for t in forests[0].trees)
    got = {r["id"]: r["prediction"] for r in forests[0].transform(df.filter("id < 400")).collect()}
    assert [got[i] for i in range(400)] == pytest.approx(list(expected), abs=1e-9)
    stored = sorted(r["score"][0] for r in scores.collect())
    assert stored == pytest.approx(sorted(expected), abs=1e-9)


def test_tasks_and_shared_jobs_do_not_change_a_fit(data, monkeypatch):
    df, _, _ = data
    settings = Settings(rounds=4, min_rows=5, max_bins=16)
    asked = [(NAMES, "y", k) for k in range(2)]
    together, scores = boosting.fit_together(df, asked, settings, "k")
    monkeypatch.setattr(boosting, "TASK_ROWS", 50)
    monkeypatch.setattr(boosting, "STORE_ROUNDS", 2)
    parted, again = boosting.fit_together(df, asked, settings, "k")
    for one, other in zip(together, parted):
        assert one.edges == other.edges and one.base == pytest.approx(other.base)
    assert again.count() == scores.count() == 402
    # rows of the fold left out do not matter to the fit: its mean is that of the others
    means = {r["k"]: (r["s"], r["c"]) for r in df.groupBy("k").agg(F.sum("y").alias("s"), F.count("y").alias("c")).collect()}
    rest = [v for k, v in means.items() if k != 0 and v[0] is not None]
    assert together[0].base == pytest.approx(sum(s for s, _ in rest) / sum(c for _, c in rest))


def test_defaults_learn_and_explain(spark, data, tmp_path):
    df, _, y = data
    forest = models.BoostedTrees(rounds=25, rate=0.2)(df, NAMES, "y")
    rows = forest.contributions(forest.transform(df), top=None).collect()
    assert len(rows) == 402
    for r in rows:
        parts = [c["contribution"] for c in r["contributions"]]
        assert r["prediction"] == pytest.approx(forest.offset + sum(parts), abs=1e-9)
        assert sorted(parts, key=abs, reverse=True) == pytest.approx(parts)
    known = [r for r in rows if r["y"] is not None]
    assert np.mean([(r["y"] - r["prediction"]) ** 2 for r in known]) < 0.1 * np.var(y)
    top = forest.contributions(df, top=2).first()["contributions"]
    assert len(top) == 2
    assert {n for n, _ in forest.importances()} == set(NAMES) and forest.importances()[0][1] > 0
    models.save_model(spark, forest, str(tmp_path / "m"))
    back = models.load_model(spark, str(tmp_path / "m"), models.model_kind(forest))
    assert back == forest


def test_nothing_to_split(spark):
    df = spark.createDataFrame([(1.0, 2.0)] * 9, "a double, y double")
    forest = boosting.fit_forest(df, ["a"], "y", rounds=5)
    assert forest.trees == [] and forest.transform(df).first()["prediction"] == 2.0
    empty = boosting.fit_forest(df.limit(0), ["a"], "y", rounds=5)
    assert empty.base == 0.0 and empty.trees == []


def test_cross_validation_in_shared_jobs(data):
    df, _, y = data
    rows = df.withColumn("g", F.concat(F.lit("g"), F.col("id") % 23))
    predictions, importances = models.group_cv(
        rows, NAMES, "y", "g", fit=models.BoostedTrees(rounds=5, rate=0.3), name="trees")
    got = predictions.collect()
    assert sorted(r["y"] for r in got) == pytest.approx(sorted(y)) and {r["model"] for r in got} == {"trees"}
    assert np.mean([(r["y"] - r["prediction"]) ** 2 for r in got]) < 0.6 * np.var(y)
    assert importances.count() == 15


def test_one_slice_grows_many_trees_a_job_and_slices_give_the_same_trees(spark, data, monkeypatch):
    df, _, _ = data
    context = spark.sparkContext
    settings = Settings(rounds=6, min_rows=5, max_bins=16)
    asked = [(NAMES, "y", k) for k in range(3)]
    context.setJobGroup("one slice", "trees")
    alone, scores = boosting.fit_together(df, asked, settings, "k")
    jobs = len(context.statusTracker().getJobIdsForGroup("one slice"))
    context.setJobGroup("rest", "other work")
    assert all(len(f.trees) == 6 for f in alone)
    assert jobs < 6 * 4  # a job per level would be at least as many for the trees alone
    monkeypatch.setattr(boosting, "TASK_ROWS", 150)
    monkeypatch.setattr(boosting, "STORE_ROUNDS", 2)
    parted, again = boosting.fit_together(df, asked, settings, "k")
    assert [[t.feature for t in f.trees] for f in alone] == [[t.feature for t in f.trees] for f in parted]
    first, second = ({r["row"]: r["score"] for r in s.collect()} for s in (scores, again))
    assert first.keys() == second.keys() and all(first[row] == pytest.approx(second[row]) for row in first)


def test_a_task_adds_up_the_smaller_child_of_a_split_only(monkeypatch):
    rng = np.random.default_rng(5)
    rows, depth = 3000, 6
    bins = rng.integers(0, 20, (4, rows)).astype(np.uint8)
    y = bins[0] * 1.0 + bins[1] * (bins[2] > 9) + rng.normal(size=rows)
    fit = boosting.Fit(0, [0, 1, 2, 3], -1, float(y.mean()))
    settings = Settings(rounds=1, max_depth=depth, row_share=1.0, column_share=1.0)
    offsets = np.arange(5) * 20
    block = (0, np.arange(rows), np.zeros(rows, int), y, bins, np.full(rows, fit.base))
    added, count = [], np.bincount
    monkeypatch.setattr(boosting.np, "bincount", lambda x, *a: added.append(len(x)) or count(x, *a))
    (*_, score), (tree,), _ = boosting.grown_alone(block, fit, offsets, settings, range(1))
    monkeypatch.undo()
    assert sum(added) <= 2 * 4 * rows * (1 + (depth - 1) / 2)  # gradients and rows of four features
    # the same tree from the sums of all nodes
    boosting.start(fit, 0, settings, 0)
    for _ in range(depth):
        sums = boosting.histograms(bins, fit.base - y, fit, offsets)
        boosting.extend(fit, [(n, *boosting.best_split(t, fit.columns, offsets, settings)) for n, t in sums.items()], settings)
    other = boosting.finish(fit, settings)
    assert (tree.feature, tree.bin, tree.left) == (other.feature, other.bin, other.left)
    assert tree.value == pytest.approx(other.value) and score == pytest.approx(fit.base + other.predict(bins.T))


def test_tables_of_some_hundred_thousand_rows_need_no_job_per_level(spark):
    df = spark.range(120_000).select((F.col("id") % 40).cast("double").alias("a"), (F.col("id") % 40 % 7).cast("double").alias("y"))
    spark.sparkContext.setJobGroup("many rows", "trees")
    forest = models.BoostedTrees(rounds=6, max_depth=4)(df, ["a"], "y")
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("many rows"))
    spark.sparkContext.setJobGroup("rest", "other work")
    assert len(forest.trees) == 6 and jobs < 6 * 4
