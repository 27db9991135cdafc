import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import dbscan as D
from ledgerlens.operators.components import connected_components
from ledgerlens.operators.joins import Grid, near_pairs, skew_join
from ledgerlens.sources import Scratch

FOLDS = {
    "euclidean": lambda g: np.sqrt((g**2).sum(-1)),
    "manhattan": lambda g: g.sum(-1),
    "chebyshev": lambda g: g.max(-1),
}


def brute_force(points, eps, min_pts, metric="euclidean"):
    """{id: (cluster, is_core)} by all pairs; ids are positions."""
    x = np.asarray(points, float)
    near = FOLDS[metric](np.abs(x[:, None] - x[None])) <= eps
    core = near.sum(1) >= min_pts
    label = np.full(len(x), -1)
    for i in np.nonzero(core)[0]:
        if label[i] < 0:
            label[i], todo = i, [i]
            while todo:
                fresh = near[todo.pop()] & core & (label < 0)
                label[fresh] = i
                todo += np.nonzero(fresh)[0].tolist()
    out = {int(i): (int(label[i]), True) for i in np.nonzero(core)[0]}
    for i in np.nonzero(~core & (near & core).any(1))[0]:
        out[int(i)] = (int(label[near[i] & core].min()), False)
    return out


def _table(spark, points):
    names = [f"c{j}" for j in range(len(points[0]))]
    rows = [(i, *[float(v) for v in p]) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, ", ".join(["id long", *[f"{n} double" for n in names]])), names


def cluster(spark, points, eps, min_pts, metric="euclidean", partitions=3):
    df, names = _table(spark, points)
    rows = D.dbscan(df.repartition(partitions), "id", names, eps, min_pts, metric).collect()
    assert len(rows) == len({r.point for r in rows})
    return {r.point: (r.component, r.is_core) for r in rows}


def clouds(seed, n, dims):
    """Two dense clouds with a third of all points in one spot, and scattered points."""
    random = np.random.default_rng(seed)
    spot = np.zeros((n // 3, dims))
    tight = random.normal(0.5, 0.05, (n // 3, dims))
    return np.concatenate([tight, spot, random.uniform(-1, 1, (n - 2 * (n // 3), dims))])[random.permutation(n)]


@pytest.mark.parametrize("metric", list(FOLDS))
def test_plane_matches_brute_force(spark, metric):
    points = clouds(1, 240, 2)
    assert cluster(spark, points, 0.12, 5, metric) == brute_force(points, 0.12, 5, metric)


def test_many_dimensions_match_brute_force(spark):
    points = clouds(2, 150, 7)
    assert cluster(spark, points, 0.35, 5) == brute_force(points, 0.35, 5)


def test_dense_cells_settled_by_halving(spark, monkeypatch):
    monkeypatch.setattr(D, "_COMPARISONS_PER_SITE", 0)
    random = np.random.default_rng(4)
    points = random.uniform(0, 1, (400, 2)) * [1.0, 0.3]
    assert cluster(spark, points, 0.11, 4) == brute_force(points, 0.11, 4)


def test_hand_made_shapes(spark):
    right, left, between = [2.0, 2.1, 1.9, 2.05], [0.0, 0.1, -0.1, -0.05], [1.0]
    shapes = {
        "two clusters and a border point of both": [(x, 0.0) for x in right + left + between],
        "chain": [(0.4 * i, 50.0) for i in range(30)],
        "noise": [(10.0 * i, 100.0) for i in range(5)],
        "copies": [(0.0, 200.0)] * 12,
    }
    points = [p for shape in shapes.values() for p in shape]
    one, many = (cluster(spark, points, 0.95, 4, partitions=n) for n in (1, 8))
    assert one == many == brute_force(points, 0.95, 4)
    assert one[8] == (0, False) and one[4] == (4, True)
    assert {one[i][0] for i in range(9, 39)} == {10}
    assert not set(one) & set(range(39, 44))
    assert {one[i] for i in range(44, 56)} == {(44, True)}


def test_missing_coordinate_is_noise(spark):
    df = spark.createDataFrame([(i, 0.0 if i else None) for i in range(5)], "id long, a double")
    assert {r.point for r in D.dbscan(df, "id", ["a"], 1.0, 2).collect()} == {1, 2, 3, 4}


def test_core_noise_and_neighbours(spark):
    points = clouds(5, 120, 2)
    df, names = _table(spark, points)
    want = brute_force(points, 0.12, 5)
    assert {r.point for r in D.core_points(df, "id", names, 0.12, 5).collect()} == {i for i, v in want.items() if v[1]}
    clusters = D.dbscan(df, "id", names, 0.12, 5)
    assert {r.point for r in D.noise_points(df, "id", clusters).collect()} == set(range(120)) - set(want)
    counts = {r.id: r.neighbours for r in D.neighbour_counts(df, "id", names, 0.12).collect()}
    near = FOLDS["euclidean"](np.abs(points[:, None] - points[None])) <= 0.12
    assert counts == {i: int(n) for i, n in enumerate(near.sum(1))}


@pytest.mark.parametrize("crowd", [1000, 8])
def test_crowded_cells_lose_and_repeat_nothing(spark, crowd):
    points = clouds(6, 150, 5)
    rows = [(i, [float(v) for v in p]) for i, p in enumerate(points)]
    left = spark.createDataFrame(rows, "l_id long, l_x array<double>")
    right = spark.createDataFrame(rows, "r_id long, r_x array<double>")
    pairs = near_pairs(
        left,
        right,
        [F.col("l_x")[i] for i in range(5)],
        [F.col("r_x")[i] for i in range(5)],
        Grid(0.3, crowd=crowd),
        "r_id",
        Scratch(spark, "near"),
    ).select("l_id", "r_id").collect()
    got = [(r.l_id, r.r_id) for r in pairs]
    assert len(got) == len(set(got))
    close = (np.abs(points[:, None] - points[None]) <= 0.29).all(-1)
    assert set(zip(*(v.tolist() for v in np.nonzero(close)))) <= set(got)


def test_skew_join_salts_hot_keys(spark):
    big = spark.range(900).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    keyed = Scratch(spark, "keys").write(
        big.filter("k <> 7").groupBy("k").agg(F.count("*").alias("n")).withColumn("v", F.col("k") * 2), "keys"
    )
    for how in ("inner", "left"):
        salted = skew_join(big, keyed, ["k"], "n", F.col("id"), how, harmless=0).select("id", "k", "v")
        plain = big.join(keyed.drop("n"), "k", how).select("id", "k", "v")
        assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))


@pytest.mark.parametrize("chunk", [500_000, 10])
def test_components(spark, chunk):
    random = np.random.default_rng(8)
    order = random.permutation(60).tolist()
    path = list(zip(order[:-1], order[1:]))
    star = [(100, 100 + i) for i in range(1, 40)]
    loose = [(200, 201), (203, 202), (201, 203), (300, 301)]
    edges = spark.createDataFrame(path + star + loose, "a long, b long").repartition(5)
    got = {r.node: r.component for r in connected_components(edges, Scratch(spark, "cc"), chunk).collect()}
    want = {i: 0 for i in order} | {100 + i: 100 for i in range(40)} | {i: 200 for i in range(200, 204)}
    assert got == want | {300: 300, 301: 300}


def test_contraction_holds_a_bounded_number_of_links(spark, monkeypatch):
    """A batch larger than a chunk is contracted piece by piece."""
    from ledgerlens.operators import components as P

    scratch, sizes = Scratch(spark, "cc"), spark.sparkContext.accumulator(0)
    stars = P._stars

    def counted(a, b):
        sizes.add(int(len(a) > 10))
        return stars(a, b)

    monkeypatch.setattr(P, "_stars", counted)
    links = spark.createDataFrame([(i + 1, i) for i in range(200)], "child long, parent long").coalesce(1)
    found = P._contract(links, scratch, 10)
    assert sizes.value == 0 and P._CHUNK <= 500_000
    monkeypatch.undo()
    got = {r.node: r.component for r in connected_components(found.toDF("a", "b"), scratch).collect()}
    assert got == {i: 0 for i in range(201)}
