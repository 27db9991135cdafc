import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ledgerlens.operators import boosting, classifiers, evaluation, projection, sampling, scaling, tuning
from ledgerlens.operators.dense_net import DenseNet

FEATURES = list("abcd")


@pytest.fixture(scope="module")
def scaled(blobs):
    model = scaling.fit_scaler(blobs, "standard", FEATURES)
    rows = scaling.scale(blobs, model).select("id", "features", "label")
    return rows.withColumn("fold", sampling.fold_column("id")).cache()


def test_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "a double, b double")
    for kind, value in (("standard", 0.0), ("minmax", 0.5)):
        rows = scaling.scale(df, scaling.fit_scaler(df, kind, ["a", "b"]))
        assert {r[0] for r in rows.select(vector_to_array("features")[1]).collect()} == {value}


def test_missing_feature_is_an_error(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    with pytest.raises(Exception):
        scaling.assembler(["a", "b"]).transform(df).collect()


def test_projection_matches_svd(blobs):
    frame = blobs.toPandas().sort_values("id")
    x = frame[FEATURES].to_numpy() - frame[FEATURES].to_numpy().mean(axis=0)
    axes = np.linalg.svd(x, full_matrices=False)[2][:2]
    axes *= np.sign(axes[np.arange(2), np.abs(axes).argmax(axis=1)])[:, None]
    got = projection.project(blobs, ["id"], FEATURES).toPandas().sort_values("id")
    assert np.allclose(got[["pc1", "pc2"]].to_numpy(), x @ axes.T, atol=1e-9)


def test_naive_bayes_closed_form(blobs):
    model = scaling.fit_scaler(blobs, "minmax", FEATURES)
    rows = scaling.scale(blobs, model).select("features", "label")
    got = classifiers.naive_bayes_parameters(classifiers.fit(classifiers.naive_bayes(), rows), FEATURES)
    frame = blobs.toPandas()
    x = frame[FEATURES].to_numpy()
    x = (x - x.min(axis=0)) / (x.max(axis=0) - x.min(axis=0))
    for r in got.collect():
        own = x[frame.label == r.label]
        assert r.log_prior == pytest.approx(np.log((len(own) + 1) / (len(x) + 2)))
        s = own.sum(axis=0)
        assert r.log_likelihood == pytest.approx(np.log((s[FEATURES.index(r.feature)] + 1) / (s.sum() + 4)))


def test_grid_sizes():
    counts = {"linear_svc": 12, "decision_tree": 576, "gradient_boosted_trees": 54, "multilayer_perceptron": 24}
    for family, n in counts.items():
        assert len(tuning.param_grid(classifiers.FAMILIES[family](), tuning.GRIDS[family])) == n
    assert len(tuning.param_grid(classifiers.logistic_regression(), tuning.GRIDS["logistic_regression"])) == 810
    assert len(tuning.param_grid(boosting.BoostedTrees(), tuning.GRIDS["boosted_trees"])) == 72


def test_search_repeats_and_reports(scaled):
    grid = {"maxDepth": [1, 4]}
    one, two = (tuning.grid_search(classifiers.decision_tree(), grid, scaled) for _ in range(2))
    assert [r.weighted_f1 for r in one.results.collect()] == [r.weighted_f1 for r in two.results.collect()]
    assert one.best == {"maxDepth": 4} and one.model.getMaxDepth() == 4
    assert [tuple(r) for r in tuning.best_parameters(one).collect()] == [("maxDepth", "4")]


def test_thresholds_cost_no_fits_and_change_no_scores(scaled):
    search = tuning.grid_search(
        classifiers.logistic_regression(maxIter=20), {"regParam": [0.0, 0.1], "threshold": [0.2, 0.5]}, scaled
    )
    means = {}
    for fold in range(3):
        fitting, held = scaled.filter(F.col("fold") != fold), scaled.filter(F.col("fold") == fold)
        for reg in (0.0, 0.1):
            for t in (0.2, 0.5):
                model = classifiers.logistic_regression(maxIter=20, regParam=reg, threshold=t).fit(fitting)
                score = tuning.evaluator().evaluate(model.transform(held))
                means[str(reg), str(t)] = means.get((str(reg), str(t)), 0.0) + score / 3
    got = {(r.parameters["regParam"], r.parameters["threshold"]): r.weighted_f1 for r in search.results.collect()}
    assert got == pytest.approx(means)
    assert search.model.getThreshold() == search.best["threshold"]


def _f1(model, rows):
    return evaluation.binary_metrics(classifiers.predict(model, rows)).first().f1


def test_boosted_trees_match_plain_newton_steps(scaled):
    """One tree of depth one, against a direct search over the same cuts."""
    model = boosting.BoostedTrees(n_estimators=1, max_depth=1, max_bin=16).fit(scaled)
    frame = scaled.select(vector_to_array("features").alias("x"), "label").toPandas()
    x, y = np.stack(frame.x), frame.label.to_numpy()
    g, h = 0.5 - y, np.full(len(y), 0.25)
    best = (-1.0, None)
    for j, edges in enumerate(model.edges):
        for k, edge in enumerate(edges):
            left = x[:, j] <= edge
            gain = 0.5 * sum(g[s].sum() ** 2 / (h[s].sum() + 1) for s in (left, ~left))
            best = max(best, (gain, (-j, -k)))
    tree = model.trees[0]
    assert (tree.feature[0], tree.cut[0]) == (-best[1][0], -best[1][1])
    left = x[:, tree.feature[0]] <= model.edges[tree.feature[0]][tree.cut[0]]
    assert tree.value[1] == pytest.approx(-0.3 * g[left].sum() / (h[left].sum() + 1))


def test_boosted_trees_learn_and_repeat(scaled):
    settings = dict(n_estimators=12, max_depth=3, subsample=0.8, colsample_bytree=0.5, max_bin=16, num_workers=2)
    model, again = (boosting.BoostedTrees(**settings).fit(scaled) for _ in range(2))
    assert model.trees == again.trees and len(model.trees) == 12
    assert _f1(model, scaled) > 0.85


def test_dense_net_learns_and_repeats(scaled):
    settings = dict(hidden=[16, 8], epochs=6, batch_size=16, learning_rate=0.01, dropout=0.1, num_workers=2)
    model, again = (DenseNet(**settings).fit(scaled) for _ in range(2))
    assert (model.weights == again.weights).all()
    assert _f1(model, scaled) > 0.85


def test_dense_net_gradient():
    from ledgerlens.operators import dense_net as N

    random = np.random.default_rng(0)
    shapes = N._shapes(3, [4, 2])
    flat, x, y = N._initial(shapes, 1), random.normal(size=(5, 3)), random.integers(0, 2, 5).astype(float)

    def loss(w):
        p = N._forward(x, N._unpack(w, shapes))[0][-1][:, 0]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    got = N._gradient(x, y, flat, shapes, 1.0, None)
    step = 1e-6 * np.eye(len(flat))
    assert got == pytest.approx(np.array([(loss(flat + s) - loss(flat - s)) / 2e-6 for s in step]), abs=1e-6)


def test_dense_net_steps_reuse_their_arrays():
    """Batches of all sizes in one room, masks drawn ahead: the plain formulas bit by bit, nothing allocated twice."""
    from ledgerlens.operators import dense_net as N

    random = np.random.default_rng(3)
    shapes, size, keep = N._shapes(3, [8, 4]), 16, 0.75
    flat, room = N._initial(shapes, 1), N._Room(size, shapes)
    batches = [(random.normal(size=(n, 3)), random.integers(0, 2, n).astype(float)) for n in (16, 16, 16, 5)]
    drawn, order = np.random.default_rng(9), []
    for x, y, masks in N._with_masks(iter(batches), size, shapes, keep, np.random.default_rng(9)):
        got = N._gradient(x, y, flat, shapes, keep, None, masks, room)
        assert got is room.grad
        (w1, b1), (w2, b2), (w3, b3) = N._unpack(flat, shapes)
        a1 = np.maximum(x @ w1 + b1, 0.0)
        m1 = (drawn.random(a1.shape) < keep) / keep
        a2 = np.maximum((a1 * m1) @ w2 + b2, 0.0)
        m2 = (drawn.random(a2.shape) < keep) / keep
        d3 = (1.0 / (1.0 + np.exp(-((a2 * m2) @ w3 + b3))) - y[:, None]) / len(y)
        d2 = (d3 @ w3.T) * m2 * (a2 * m2 > 0)
        d1 = (d2 @ w2.T) * m1 * (a1 * m1 > 0)
        parts = [(x.T @ d1, d1), ((a1 * m1).T @ d2, d2), ((a2 * m2).T @ d3, d3)]
        assert got == pytest.approx(np.concatenate([np.r_[g.ravel(), d.sum(axis=0)] for g, d in parts]), rel=1e-12, abs=1e-15)
        order.append(len(y))
    assert order == [16, 16, 16, 5]


def test_dense_net_reads_arrow_batches():
    """Slices, empty frames and frames smaller than a batch; no row is lost or moved, uneven rows are an error."""
    import pyarrow as pa

    from ledgerlens.operators import dense_net as N

    x, y = np.arange(120.0).reshape(40, 3), np.arange(40.0)
    table = pa.record_batch({"x": pa.array(list(x), pa.list_(pa.float64())), "y": pa.array(y)})
    cuts = [0, 3, 3, 5, 21, 22, 40]
    got = list(N._batches((table.slice(a, b - a) for a, b in zip(cuts, cuts[1:])), 8, 3))
    assert [len(b) for _, b in got] == [8] * 5
    assert (np.concatenate([a for a, _ in got]) == x).all() and (np.concatenate([b for _, b in got]) == y).all()
    assert [len(b) for _, b in N._batches(iter([table]), 32, 3)] == [32, 8]
    for rows in ([[1.0, 2.0], [1.0, 2.0, 3.0, 4.0]], [[1.0, 2.0, 3.0], None]):
        odd = pa.record_batch({"x": pa.array(rows, pa.list_(pa.float64())), "y": pa.array([0.0, 1.0])})
        with pytest.raises(ValueError, match="3 features"):
            list(N._batches(iter([odd]), 8, 3))


@pytest.mark.parametrize("family", ["linear_svc", "logistic_regression", "decision_tree"])
def test_families_learn(scaled, family):
    assert _f1(classifiers.fit(classifiers.FAMILIES[family](), scaled), scaled) > 0.8


def test_forest_rows_keep_their_nodes(scaled):
    """Kept nodes spare the walk from the roots at every level and change no tree."""
    settings = dict(numTrees=12, maxDepth=6)
    forest = classifiers.random_forest(**settings)
    assert forest.getCacheNodeIds()
    plain = classifiers.random_forest(**settings, cacheNodeIds=False)
    kept, walked = (classifiers.fit(f, scaled) for f in (forest, plain))
    trees = [[t.toDebugString.split("\n", 1)[1] for t in m.trees] for m in (kept, walked)]
    assert trees[0] == trees[1] and len(trees[0]) == 12


def test_cuts_of_a_level_are_the_best_gains(spark):
    random = np.random.default_rng(5)
    x = random.normal(size=(600, 5)).round(1)
    rows = spark.createDataFrame([(v.tolist(), float(v[0] > 0.2) if i % 9 else float(v[1] > 0)) for i, v in enumerate(x)], "x array<double>, y double")
    table = boosting.binned(rows.repartition(4), "x", "y", boosting.bin_edges(rows, "x", 5, 8)).cache()
    tree = boosting.Tree(feature={0: 1}, cut={0: 3}, value={1: 0.3, 2: -0.1})
    newer = [boosting.Tree(feature={0: 0}, cut={0: 2}, value={1: -0.5, 2: 0.4})]
    where = (newer, tree, [0, 2, 3], 1, 2, (3, 1, 0.7))
    want = {r.node: r for r in boosting.best_splits(boosting.split_gains(boosting.level_histogram(table, 5, 8, *where), 0.5, 0.1, 2.0)).collect()}
    got = {r.node: r for r in boosting.level_cuts(table, 5, 8, *where, 0.5, 0.1, 2.0).collect()}
    assert set(got) == set(want) == {1, 2}
    for node, cut in got.items():
        assert (cut.feature, cut.bin) == (want[node].feature, want[node].bin)
        assert np.allclose([cut[c] for c in ("gain", "gl", "hl", "g", "h")], [want[node][c] for c in ("gain", "gl", "hl", "g", "h")], atol=1e-9)


def test_models_that_grow_side_by_side_are_those_of_single_fits(scaled, monkeypatch):
    """Unlike depths, lengths, samples and bins, in bundles of few nodes; only last digits of sums may differ."""
    calls, cuts = [], boosting.cuts_side_by_side
    monkeypatch.setattr(boosting, "cuts_side_by_side", lambda *a: calls.append(len(a[3])) or cuts(*a))
    monkeypatch.setattr(boosting, "_NODES_AT_ONCE", 5)
    estimator = boosting.BoostedTrees(max_bin=16, learning_rate=0.5)
    settings = [
        {"n_estimators": 3, "max_depth": 3},
        {"n_estimators": 2, "max_depth": 1, "subsample": 0.7, "min_child_weight": 0.1},
        {"n_estimators": 4, "max_depth": 2, "colsample_bytree": 0.5, "seed": 5},
        {"n_estimators": 2, "max_depth": 2, "max_bin": 8},
    ]
    maps = [{estimator.getParam(k): v for k, v in m.items()} for m in settings]
    together = estimator.fit(scaled, maps)
    assert max(calls) == 3
    for model, own in zip(together, maps):
        single = estimator.fit(scaled, own)
        assert model.edges == single.edges and len(model.trees) == len(single.trees) == own[estimator.n_estimators]
        assert model.getOrDefault("max_depth") == own[estimator.max_depth]
        for a, b in zip(model.trees, single.trees):
            assert (a.feature, a.cut) == (b.feature, b.cut) and a.value == pytest.approx(b.value, rel=1e-9)


def test_nodes_that_no_cut_may_divide_are_not_opened():
    from types import SimpleNamespace as Cut

    growth = boosting.Growth("score", [], boosting.Tree(), [0], min_child_weight=1.0, max_depth=3)
    growth.grow([Cut(node=0, feature=0, bin=1, gain=2.0, gl=1.0, hl=1.9, g=3.0, h=6.0)])
    assert growth.open == [2] and growth.tree.value == {1: -1.0 / 2.9, 2: -2.0 / 5.1}
    growth.grow([Cut(node=2, feature=0, bin=2, gain=1.0, gl=1.0, hl=2.0, g=2.0, h=4.1)])
    assert growth.open == [5, 6]
    growth.grow([Cut(node=5, feature=0, bin=0, gain=None, gl=0.0, hl=0.0, g=1.0, h=2.0), Cut(node=6, feature=0, bin=0, gain=1.0, gl=0.0, hl=1.0, g=1.0, h=2.1)])
    assert growth.open == [] and set(growth.tree.value) == {1, 5, 13, 14}


def test_no_rows_to_boost(spark):
    none = spark.createDataFrame([], "features array<double>, label double").select(array_to_vector("features").alias("features"), "label")
    with pytest.raises(ValueError, match="no rows"):
        boosting.BoostedTrees().fit(none)


def test_trees_are_walked_alike_in_both_ways(monkeypatch):
    """Uneven trees, bytes where Arrow holds them, and the walk of deep trees."""
    import pyarrow as pa

    random = np.random.default_rng(6)
    codes = random.integers(0, 256, (500, 3)).astype(np.uint8)
    sliced = pa.array([b"abc", *[r.tobytes() for r in codes]], pa.binary())[1:]
    assert (boosting._arrow_codes(sliced, 3) == codes).all()
    tree = boosting.Tree(feature={0: 1, 2: 0, 5: 2}, cut={0: 100, 2: 30, 5: 255}, value={1: 0.5, 6: 2.0, 11: 3.0, 12: 4.0})
    for some in (tree, boosting.Tree(), boosting.Tree(value={0: 1.0})):
        full = some.nodes_of(codes)
        monkeypatch.setattr(boosting, "_FULL_DEPTH", -1)
        assert (some.nodes_of(codes) == full).all()
        monkeypatch.undo()
