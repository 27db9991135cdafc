"""Near-duplicate vectors by NN-descent.

Equal vectors of a label form a class; classes are the nodes of a neighbour
graph that keeps for each its nearest others. The graph starts from stretches
of vectors that are neighbours in orders by random hyperplanes. Then it is
refined: around each node, the nodes it lists and those that list it are
compared with each other, and better neighbours enter the lists, until no round
brings new links. An audit compares a fixed number of nodes with all others; if
it finds too few of their links, lists grow and new orders are tried. Entries
of the lists above the threshold, confirmed in double precision, are the links.

A list whose last entry is still above the threshold is saturated: it may hide
further links. The lists of its component are enlarged to the whole component,
in blocks of bounded size that leave counts of links instead of pairs, so a
crowd of vectors that are all alike costs comparisons but no rows. As full lists
drop links to other crowds, every stretch that is compared also tells what links
join in it, and a second audit compares saturated nodes with all others: links
that leave their component join it, new orders are tried, and other nodes are
audited, until none of them has such a link.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.columns import column
from ledgerlens.operators.components import connected_components
from ledgerlens.sources import Scratch

NEIGHBOURS = 8
ORDERS = 8
_STRETCH, _STEP = 64, 32
# Nodes around one node that are compared at a time, about.
_AROUND = 64
_BITS = 40
# Single precision serves the search; what it may be off by.
_SLACK = 1e-5
_AUDITED = 200
# True links that an audit must have seen, and nodes audited for that; if they have fewer links, a warning says so.
_SEEN, _MOST_AUDITED = 20, 3200
# Crowds of which a node each is audited for links that leave their component.
_CROWDS = 1000
_ROUNDS = 8
# Vectors of a crowd that are compared with as many others at a time, about.
_BLOCK = 1024
# Stands for the similarity of pairs that links join, though they may not be linked themselves.
_JOINED = 9.0


def near_vectors(
    table: DataFrame,
    scratch: Scratch,
    threshold: float = 0.98,
    neighbours: int = NEIGHBOURS,
    orders: int = ORDERS,
    least_recall: float = 0.995,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Vectors link when their labels are equal and not null and their cosine, in
    double precision, is at least `threshold`. A vector that is null, zero, or
    holds a null or a non-finite component links with nothing; vectors of
    different length don't link. `n_links` counts other rows linked directly.
    A null id counts among its links' partners but names no component, and is
    kept. Further columns are not read.
    """
    source = table.select(
        column(table, id_col).cast("long").alias("vec_id"),
        column(table, label_col).cast("string").alias("label"),
        column(table, vector_col).cast("array<double>").alias("vector"),
    )
    rows = scratch.write(source.mapInArrow(_units, "vec_id long, label string, node long, unit array<double>"), "rows")
    nodes = rows.filter("node IS NOT NULL").groupBy("node").agg(
        F.min("vec_id").alias("first"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("unit").alias("unit")
    )
    nodes = scratch.write(nodes, "nodes")
    links, named, saturated = _search(nodes, scratch, threshold, neighbours, orders, least_recall)
    crowds = named.join(saturated, "node", "left_semi").select("root").distinct()
    crowded = named.join(crowds, "root", "left_semi").join(nodes.select("node", "unit"), "node")
    inside = _crowd_links(crowded, scratch, threshold)
    counted = links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
        links.select(F.col("b").alias("node"), F.col("a").alias("other"))
    )
    sizes = nodes.select(F.col("node").alias("other"), F.col("n").alias("copies"))
    listed = counted.join(sizes, "other").groupBy("node").agg(F.sum("copies").alias("listed"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    facts = named.join(smallest, "root").join(listed, "node", "left").join(inside, "node", "left")
    outer = F.coalesce("inside", "listed", F.lit(0))
    facts = facts.select("node", (F.col("n") - 1 + outer).alias("n_links"), "component_id")
    found = rows.select("vec_id", "node").join(scratch.write(facts, "facts"), "node", "left")
    own = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return found.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        own.alias("component_id"),
        F.coalesce(own == F.col("vec_id"), F.lit(True)).alias("kept"),
    )


def _units(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors of length one, and a 64-bit name for those of one label that are equal."""
    for batch in batches:
        names, units = [], []
        for label, vector in zip(batch["label"].to_pylist(), batch["vector"]):
            unit = None
            if label is not None and vector.is_valid and not vector.values.null_count:
                x = vector.values.to_numpy(zero_copy_only=False).astype(np.float64)
                most = np.abs(x).max() if len(x) and np.isfinite(x).all() else 0.0
                if most > 0:
                    # Adding zero turns -0.0 into 0.0; dividing first keeps squares in range.
                    unit = (x + 0.0) / most
                    unit /= np.sqrt(unit @ unit)
            units.append(unit)
            names.append(
                None if unit is None else xxhash.xxh3_64_intdigest(label.encode() + b"\0" + (x + 0.0).tobytes()) - (1 << 63)
            )
        yield pa.RecordBatch.from_arrays(
            [batch["vec_id"], batch["label"], pa.array(names, pa.int64()), pa.array(units, pa.list_(pa.float64()))],
            names=["vec_id", "label", "node", "unit"],
        )


def _search(nodes, scratch, threshold, neighbours, orders, least_recall) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(a, b) of links between nodes, (node, first, n, root) of all, and the nodes whose lists are saturated."""
    small = scratch.write(nodes.select("node", "label", F.col("unit").cast("array<float>").alias("unit")), "single")
    floor, turn = threshold - _SLACK, 0
    lists, bridges = _first_lists(small, scratch, neighbours, orders, 0, threshold)
    while True:
        for _ in range(_ROUNDS):
            turn += 1
            lists, joined, new = _refined(lists, small, scratch, turn, floor, threshold)
            bridges = bridges.unionByName(joined)
            if not new and turn > 1:
                break
        links = scratch.write(_confirmed(lists, nodes, threshold, floor), "links")
        saturated = lists.filter(_saturated(floor)).select("node")
        if _recall(links, nodes, saturated, threshold) >= least_recall:
            bridges = scratch.write(bridges.distinct(), "bridges")
            break
        # The audit missed links: longer lists and orders not tried yet.
        neighbours *= 2
        more, joined = _first_lists(small, scratch, neighbours, orders, turn, threshold)
        bridges = bridges.unionByName(joined)
        both = lists.select("node", F.explode("near").alias("e")).unionByName(more.select("node", F.explode("near").alias("e")))
        lists = scratch.write(_merged(both, neighbours), "lists")
    while True:
        turn += 1
        roots = scratch.write(connected_components(links.unionByName(bridges), scratch), "roots")
        named = nodes.select("node", "first", "n").join(roots, "node", "left")
        named = scratch.write(named.withColumn("root", F.coalesce("component", "node")).drop("component"), "named")
        leaving = scratch.write(_leaving(named, nodes, saturated, threshold, turn), "leaving")
        if leaving.isEmpty():
            return links, named, saturated
        _, joined = _first_lists(small, scratch, 1, orders, turn, threshold)
        bridges = bridges.unionByName(leaving).unionByName(joined)


def _saturated(floor: float) -> Column:
    return (F.size("near") >= F.col("k")) & (F.element_at("near", -1)["sim"] >= floor)


def _crowd_links(crowded: DataFrame, scratch: Scratch, threshold: float) -> DataFrame:
    """(node, inside): copies of other nodes that a node of a crowd links with, counted block by block."""
    sizes = crowded.groupBy("root").agg(F.ceil(F.count("*") / _BLOCK).cast("int").alias("blocks"))
    dealt = crowded.join(sizes, "root").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    group = F.xxhash64("root", F.least("own", "with"), F.greatest("own", "with"))
    dealt = dealt.select(group.alias("group"), "node", "n", "own", "unit").repartition("group").sortWithinPartitions("group", "own")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, ("node", "n", "own", "unit")):
            nodes, copies, own = (np.array([r[c] for r in rows]) for c in range(3))
            units = np.stack([r[3] for r in rows])
            split = np.searchsorted(own, own[-1])
            # A block against itself, or the lower block of two against the upper one.
            parts = [(slice(None), slice(None))] if split == 0 else [(slice(0, split), slice(split, None)), (slice(split, None), slice(0, split))]
            for a, b in parts:
                linked = (units[a] @ units[b].T >= threshold) & (nodes[a][:, None] != nodes[b][None, :])
                yield pa.RecordBatch.from_arrays([pa.array(nodes[a]), pa.array(linked @ copies[b])], names=["node", "inside"])

    found = dealt.mapInArrow(count, "node long, inside long")
    return scratch.write(found.groupBy("node").agg(F.sum("inside").alias("inside")), "inside")


def _groups(batches: Iterable[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[list[tuple]]:
    """The rows of each group of rows that are ordered by group."""
    held: list[tuple] = []
    group = None
    for batch in batches:
        groups = np.asarray(batch["group"])
        columns = [batch[c] if c == "unit" else np.asarray(batch[c]) for c in names]
        for i in range(len(groups)):
            if held and groups[i] != group:
                yield held
                held = []
            group = groups[i]
            held.append(tuple(c[i].values.to_numpy() if n == "unit" else c[i] for n, c in zip(names, columns)))
    if held:
        yield held


def _merged(entries: DataFrame, k: int) -> DataFrame:
    """The k nearest different others of each node; entries have node and e (sim, other)."""
    best = entries.groupBy("node").agg(F.sort_array(F.collect_set("e"), asc=False).alias("all"))
    return best.select("node", F.lit(k).alias("k"), F.slice("all", 1, k).alias("near"))


def _first_lists(
    small: DataFrame, scratch: Scratch, neighbours: int, orders: int, seed: int, threshold: float
) -> tuple[DataFrame, DataFrame]:
    """Neighbour lists from stretches of vectors in orders by random hyperplanes, and pairs that links join in them."""

    def coded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            codes = []
            for unit in batch["unit"]:
                x = unit.values.to_numpy(zero_copy_only=False)
                if len(x) not in planes:
                    planes[len(x)] = np.random.default_rng([seed, len(x)]).normal(size=(orders * _BITS, len(x)))
                bits = (planes[len(x)] @ x > 0).reshape(orders, _BITS)
                codes.append(bits @ (np.int64(1) << np.arange(_BITS, dtype=np.int64)[::-1]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.list_(pa.int64()))], names=[*batch.schema.names, "codes"])

    codes = small.mapInArrow(coded, "node long, label string, unit array<float>, codes array<long>")
    codes = codes.select("node", "label", "unit", F.posexplode("codes").alias("turn", "code"))
    keys = ["label", "turn", "code", "node"]
    ordered = codes.repartitionByRange(*keys).sortWithinPartitions(*keys)
    near = ordered.select(F.xxhash64("label", "turn").alias("group"), "node", F.lit(neighbours).alias("k"), "unit")
    compare = _compare(_STRETCH, _STEP, threshold + _SLACK)
    found = scratch.write(near.mapInArrow(compare, "node long, sim double, other long"), "found")
    entries = found.filter(F.col("sim") < _JOINED).select("node", F.struct("sim", "other").alias("e"))
    bridges = found.filter(F.col("sim") == _JOINED)
    bridges = bridges.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
    return scratch.write(_merged(entries, neighbours), "lists"), scratch.write(bridges, "bridges")


def _refined(
    lists: DataFrame, small: DataFrame, scratch: Scratch, turn: int, floor: float, threshold: float
) -> tuple[DataFrame, DataFrame, int]:
    """One round of comparisons around each node, the pairs that links join in them, and how many links it brought to
    lists that weren't saturated."""
    edges = lists.select("node", F.explode("near.other").alias("other"))
    around = edges.select(F.col("node").alias("centre"), F.col("other").alias("node")).unionByName(
        edges.select(F.col("other").alias("centre"), "node")
    )
    around = around.unionByName(lists.select(F.col("node").alias("centre"), "node")).distinct()
    # Many nodes around one are compared in groups dealt anew each round.
    crowd = around.groupBy("centre").agg(F.ceil(F.count("*") / _AROUND).cast("int").alias("groups"))
    dealt = around.join(crowd, "centre").select(
        "node", F.xxhash64("centre", F.pmod(F.xxhash64("node", F.lit(turn)), F.col("groups"))).alias("group")
    )
    # A full list has no use for anything below its last entry.
    last = F.when(F.size("near") >= F.col("k"), F.element_at("near", -1)["sim"]).otherwise(F.lit(-2.0))
    with_units = small.drop("label").join(lists.select("node", "k", last.alias("last")), "node", "left").select(
        "node", "unit", F.coalesce("k", F.lit(1)).alias("k"), F.coalesce("last", F.lit(-2.0)).alias("last")
    )
    grouped = dealt.join(with_units, "node").repartition("group").sortWithinPartitions("group", "node")
    found = grouped.select("group", "node", "k", "last", "unit").mapInArrow(
        _compare(4 * _AROUND, 4 * _AROUND, threshold + _SLACK), "node long, sim double, other long"
    )
    entries = lists.select("node", F.explode("near").alias("e")).unionByName(
        found.select("node", F.struct("sim", "other").alias("e"))
    )
    best = entries.groupBy("node").agg(F.sort_array(F.collect_set("e"), asc=False).alias("all"))
    before = lists.select("node", "k", F.size(F.filter("near", lambda e: e["sim"] >= floor)).alias("before"), _saturated(floor).alias("full"))
    near = F.slice(F.filter("all", lambda e: e["sim"] < _JOINED), F.lit(1), F.col("k"))
    joined = F.transform(F.filter("all", lambda e: e["sim"] == _JOINED), lambda e: e["other"])
    merged = best.join(before, "node").withColumn("near", near)
    after = F.size(F.filter("near", lambda e: e["sim"] >= floor))
    new = F.when(F.col("full"), 0).otherwise(after - F.col("before"))
    merged = scratch.write(merged.select("node", "k", "near", new.alias("new"), joined.alias("joined")), "refined")
    bridges = merged.select("node", F.explode("joined").alias("other"))
    bridges = bridges.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
    return merged.drop("new", "joined"), bridges, merged.agg(F.sum("new")).first()[0] or 0


def _compare(stretch: int, step: int, joined: float | None = None) -> Callable:
    """A function over rows ordered by group: compares rows of a group within stretches of it.

    Each row gets its k nearest others of a stretch, of those above its `last`.
    With `joined`, it also gets the first row of the stretch that it reaches by
    similarities of at least that, marked by the similarity _JOINED.
    """

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        held: list[tuple] = []
        group = None
        for batch in batches:
            names = batch.schema.names
            groups, nodes, ks = (np.asarray(batch[c]) for c in ("group", "node", "k"))
            lasts = np.asarray(batch["last"]) if "last" in names else np.full(len(groups), -2.0)
            units = batch["unit"]
            for i in range(len(groups)):
                if held and (groups[i] != group or len(held) == stretch):
                    yield held
                    held = held[step:] if groups[i] == group else []
                group = groups[i]
                held.append((nodes[i], ks[i], lasts[i], units[i].values.to_numpy(zero_copy_only=False)))
        if held:
            yield held

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0
        for rows in blocks(batches):
            for length in {len(r[3]) for r in rows}:
                same = [r for r in rows if len(r[3]) == length]
                nodes, ks, lasts = (np.array([r[c] for r in same]) for c in range(3))
                x = np.stack([r[3] for r in same])
                sims = (x @ x.T).astype(np.float64)
                sims[nodes[:, None] == nodes[None, :]] = -3
                k = min(int(ks.max()), len(same) - 1)
                if k < 1:
                    continue
                best = np.argpartition(-sims, k - 1, axis=1)[:, :k]
                value = np.take_along_axis(sims, best, axis=1)
                rows_, columns_ = np.nonzero((value > lasts[:, None]) & (value > -2))
                out.append((nodes[rows_], np.round(value[rows_, columns_], 7), nodes[best[rows_, columns_]]))
                size += len(rows_)
                if joined is not None and (sims >= joined).any():
                    at = _reached(sims >= joined)
                    moved = np.flatnonzero(at != np.arange(len(at)))
                    out.append((nodes[moved], np.full(len(moved), _JOINED), nodes[at[moved]]))
            if size > 100_000:
                yield _flat(out)
                out, size = [], 0
        if out:
            yield _flat(out)

    return compare


def _reached(linked: np.ndarray) -> np.ndarray:
    """For each row, the first row that it reaches."""
    at = np.arange(len(linked))
    while True:
        lowest = np.where(linked, at[None, :], len(at)).min(axis=1)
        after = np.minimum(at, lowest)
        after = np.minimum(after, after[after])
        if (after == at).all():
            return at
        at = after


def _flat(out: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    node, sim, other = (np.concatenate(x) for x in zip(*out))
    return pa.RecordBatch.from_arrays([pa.array(node), pa.array(sim), pa.array(other)], names=["node", "sim", "other"])


def _cosine() -> Column:
    return F.aggregate(F.zip_with("a_unit", "b_unit", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _confirmed(lists: DataFrame, nodes: DataFrame, threshold: float, floor: float) -> DataFrame:
    """Distinct links of the lists, in double precision."""
    pairs = lists.select("node", F.inline("near")).filter(F.col("sim") >= floor)
    pairs = pairs.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
    pairs = pairs.join(nodes.select(F.col("node").alias("a"), F.col("unit").alias("a_unit")), "a")
    pairs = pairs.join(nodes.select(F.col("node").alias("b"), F.col("unit").alias("b_unit")), "b")
    return pairs.filter(_cosine() >= threshold).select("a", "b")


def _recall(links: DataFrame, nodes: DataFrame, saturated: DataFrame, threshold: float) -> float:
    """Of the links of some nodes, found by comparing these with all nodes, the part that is known.

    More nodes are drawn until these have _SEEN links, as far as there are any or to _MOST_AUDITED.

    Nodes with saturated lists are compared with their whole components later; `_leaving` audits those.
    """
    wanted = _AUDITED
    while True:
        drawn, total, found = _audit(links, nodes, saturated, threshold, wanted)
        if total >= _SEEN or drawn < wanted:
            break
        if wanted >= _MOST_AUDITED:
            warnings.warn(f"near_vectors: an audit of {drawn} vectors saw {total} true links, {found} of them known", stacklevel=2)
            break
        wanted *= 4
    return found / total if total else 1.0


def _audit(links: DataFrame, nodes: DataFrame, saturated: DataFrame, threshold: float, wanted: int) -> tuple[int, int, int]:
    """Audited nodes, their true links, and those of these that are known."""
    audited = nodes.select("node", "label", "unit").join(saturated, "node", "left_anti").orderBy(F.xxhash64("node")).limit(wanted).toArrow().to_pylist()
    sent = nodes.sparkSession.sparkContext.broadcast(audited)

    def against(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple, tuple] = {}
        for row in sent.value:
            groups.setdefault((row["label"], len(row["unit"])), ([], []))
            ids, units = groups[row["label"], len(row["unit"])]
            ids.append(row["node"])
            units.append(row["unit"])
        ready = {k: (np.array(i), np.array(u)) for k, (i, u) in groups.items()}
        for batch in batches:
            a, b = [], []
            for node, label, unit in zip(batch["node"].to_pylist(), batch["label"].to_pylist(), batch["unit"]):
                ids, units = ready.get((label, len(unit)), (None, None))
                if ids is not None:
                    near = ids[(units @ unit.values.to_numpy() >= threshold + 1e-9) & (ids != node)]
                    a += np.minimum(near, node).tolist()
                    b += np.maximum(near, node).tolist()
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    true = nodes.select("node", "label", "unit").mapInArrow(against, "a long, b long").distinct()
    known = links.withColumn("known", F.lit(1))
    total, found = true.join(known, ["a", "b"], "left").agg(F.count("*"), F.count("known")).first()
    return len(audited), total, found


def _leaving(named: DataFrame, nodes: DataFrame, saturated: DataFrame, threshold: float, turn: int) -> DataFrame:
    """(a, b) of links between audited nodes with saturated lists and nodes of other components, one for each such component.

    Audited are a node of each crowd, of the first _CROWDS by hash, and _AUDITED of all; each turn takes others.
    """
    placed = nodes.select("node", "label", "unit").join(named.select("node", "root"), "node")
    full = named.select("node", "root").join(saturated, "node", "left_semi")
    mark = F.xxhash64("node", F.lit(turn))
    each = full.groupBy("root").agg(F.min_by("node", mark).alias("node")).orderBy(F.xxhash64("root", F.lit(turn))).limit(_CROWDS)
    chosen = each.select("node").unionByName(full.orderBy(mark).limit(_AUDITED).select("node")).distinct()
    audited = placed.join(F.broadcast(chosen), "node", "left_semi").toArrow().to_pylist()
    groups: dict[tuple, list[dict]] = {}
    for row in audited:
        groups.setdefault((row["label"], len(row["unit"])), []).append(row)
    ready = {
        k: (np.array([r["node"] for r in g]), np.array([r["root"] for r in g]), np.array([r["unit"] for r in g]))
        for k, g in groups.items()
    }
    sent = nodes.sparkSession.sparkContext.broadcast(ready)

    def against(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            columns = (batch[c].to_pylist() for c in ("node", "root", "label"))
            for node, root, label, unit in zip(*columns, batch["unit"]):
                ids, roots, units = sent.value.get((label, len(unit)), (None, None, None))
                if ids is not None:
                    out = np.flatnonzero((units @ unit.values.to_numpy() >= threshold + 1e-9) & (roots != root))
                    for i in out[np.unique(roots[out], return_index=True)[1]].tolist():
                        a.append(min(node, int(ids[i])))
                        b.append(max(node, int(ids[i])))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return placed.mapInArrow(against, "a long, b long").distinct()
