"""NN-descent against brute force."""

import numpy as np
from pyspark.sql import functions as F

from ledgerlens.llm import vectors
from ledgerlens.sources import Scratch


def test_links_match_brute_force(spark):
    random = np.random.default_rng(5)
    base = random.normal(size=(150, 16))
    x = np.concatenate([base, base[:20] + random.normal(scale=0.03, size=(20, 16)), base[:1] + random.normal(scale=0.02, size=(60, 16))])
    labels = [int(i) % 2 if i < 150 else (int(i) - 150) % 20 % 2 if i < 170 else 0 for i in range(len(x))]
    rows = [(i, v.tolist(), label, "n", 1.0) for i, (v, label) in enumerate(zip(x, labels))]
    rows += [(900, x[0].tolist(), 0, "n", 1.0), (901, (2 * x[0]).tolist(), 0, "n", 1.0), (902, x[0].tolist(), None, "n", 1.0)]
    odd = [None, [0.0] * 16, [float("nan")] * 16, [None] * 16, [], [1.0, 2.0]]
    rows += [(910 + i, v, 0, "n", 1.0) for i, v in enumerate(odd)]
    schema = "vec_id long, embedding array<double>, label int, node string, sim double"
    got = {r.vec_id: r for r in vectors.near_vectors(spark.createDataFrame(rows, schema), Scratch(spark, "v")).collect()}
    able = [r for r in rows if r[2] is not None and r[1] and len(r[1]) == 16 and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])]
    units = np.array([np.array(r[1]) / np.linalg.norm(r[1]) for r in able])
    same = np.array([r[2] for r in able])
    linked = (units @ units.T >= 0.98) & (same[:, None] == same[None, :])
    np.fill_diagonal(linked, False)
    part = np.arange(len(able))
    for _ in able:
        part = np.minimum(part, np.where(linked, part[None, :], len(able)).min(axis=1))
    want = {r[0]: (int(n), able[p][0]) for r, n, p in zip(able, linked.sum(axis=1), part)}
    assert max(n for n, _ in want.values()) > 50
    for r in rows:
        n, component = want.get(r[0], (0, r[0]))
        assert (got[r[0]].n_links, got[r[0]].component_id, got[r[0]].kept) == (n, component, component == r[0]), r[0]


def test_empty_table(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vectors.near_vectors(none, Scratch(spark, "v")).count() == 0


def test_crowds_that_no_stretch_joins(spark):
    random = np.random.default_rng(2)
    # The first hyperplane of the only order parts the two crowds, and other vectors lie between them.
    plane = np.random.default_rng([0, 16]).normal(size=(40, 16))[0]
    plane /= np.linalg.norm(plane)
    along = random.normal(size=16)
    along -= (along @ plane) * plane
    along /= np.linalg.norm(along)
    turned = np.arccos(0.985) / 2
    crowds = [np.cos(turned) * along + side * np.sin(turned) * plane for side in (-1, 1)]
    x = np.concatenate([*(c + random.normal(scale=0.002, size=(90, 16)) for c in crowds), random.normal(size=(600, 16))])
    table = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in vectors.near_vectors(table, Scratch(spark, "v"), orders=1).collect()}
    units = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = (units @ units.T >= 0.98).sum(axis=1) - 1
    assert links[:180].min() > 90
    assert [got[i].n_links for i in range(180)] == links[:180].tolist()
    assert {got[i].component_id for i in range(180)} == {0}


def test_audit_goes_on_where_links_are_rare(spark):
    ranked = [r.node for r in spark.range(1000).select(F.col("id").alias("node")).orderBy(F.xxhash64("id")).collect()]
    x = np.random.default_rng(4).normal(size=(1000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for i in range(0, 60, 2):
        x[ranked[300 + i]] = x[ranked[301 + i]]
    nodes = spark.createDataFrame([(i, "0", v.tolist()) for i, v in enumerate(x)], "node long, label string, unit array<double>")
    none = spark.createDataFrame([], "a long, b long")
    assert vectors._recall(none, nodes, nodes.select("node").limit(0), 0.98) == 0
