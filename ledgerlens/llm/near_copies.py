"""Near-duplicate documents: one-permutation MinHash, banded buckets, star-shaped candidate links.

Documents with equal shingle sets form a class, and classes are compared. A
class's set is dealt into bins by one hash; each bin keeps its smallest hash
and an empty bin borrows from a full one that its own random probes reach first
(optimal densification). Runs of bins form bands; classes that share a band
share a bucket.

Inside a bucket, candidates form stars: the first class is compared with all
others, not everyone with everyone. Then buckets whose members are not yet
known to be connected get further centres, eight times as many each round, until the
members of each bucket are connected or every unconnected pair has been
compared. So no link is lost that a bucket shows, and a bucket of n connected
classes costs about n comparisons. Links are confirmed on full sets.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.columns import column, free_names
from ledgerlens.llm.kept import kept
from ledgerlens.llm.words import SHINGLE, mixed, shingle_sets
from ledgerlens.operators.components import connected_components
from ledgerlens.sources import Scratch

# Centres of a bucket grow by this factor each round: fewer rounds against a few more comparisons.
_MORE = 8


@dataclass(frozen=True)
class Banding:
    """`bands` runs of `rows` bins. The defaults miss a pair of similarity 0.85 about 6 times in 10^9."""

    bands: int = 40
    rows: int = 6
    seed: int = 1

    @property
    def bins(self) -> int:
        return self.bands * self.rows


def _probes(bins: int, seed: int, tries: int) -> np.ndarray:
    """For each bin, the bins it looks at for a value, one after another."""
    return kept(("probes", bins, seed, tries), lambda: _drawn(bins, seed, tries))


def _drawn(bins: int, seed: int, tries: int) -> np.ndarray:
    at = np.arange(bins, dtype=np.uint64)[:, None] * np.uint64(1 << 20) + np.arange(tries, dtype=np.uint64)
    return (mixed(at + np.uint64(seed * 2654435761)) % np.uint64(bins)).astype(np.int64)


def signature(hashes: np.ndarray, banding: Banding) -> np.ndarray:
    """The densified bin values of a set of hashes."""
    bins = banding.bins
    value = mixed(hashes ^ np.uint64(banding.seed * 0x5851F42D4C957F2D & (1 << 64) - 1))
    # The top bits choose the bin, the whole word is the value that is compared.
    place = ((value >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    kept = np.full(bins, np.iinfo(np.uint64).max, dtype=np.uint64)
    np.minimum.at(kept, place, value)
    full = np.zeros(bins, dtype=bool)
    full[place] = True
    if full.all():
        return kept
    out, tries, todo = kept.copy(), 64, np.flatnonzero(~full)
    while len(todo):
        probes = _probes(bins, banding.seed, tries)[todo]
        hit = full[probes]
        found = hit.any(axis=1)
        out[todo[found]] = kept[probes[found, hit[found].argmax(axis=1)]]
        todo, tries = todo[~found], tries * 8
    return out


def band_keys(hashes: np.ndarray, banding: Banding) -> np.ndarray:
    """One 64-bit key for each band."""
    values = signature(hashes, banding).reshape(banding.bands, banding.rows)
    key = np.arange(1, banding.bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for column in values.T:
        key = mixed(key ^ column) + column
    return key.view(np.int64)


def near_copies(
    docs: DataFrame,
    scratch: Scratch,
    percent: int = 85,
    banding: Banding = Banding(),
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    Two documents are linked when 100 * intersection >= percent * union of their
    shingle sets. `component_id` is the smallest id reachable by links, `kept`
    tells whether it is the row's own. A text that is null or has no words links
    with nothing; so does a row with a null id, whose component is null and which
    is kept. Rows with one id are documents of their own; equal rows are equal.
    Further columns are not read.
    """
    found = _grouped(docs, scratch, percent, banding, id_col, text_col, shingle)
    result = found.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return result.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_of_each(
    docs: DataFrame,
    scratch: Scratch,
    percent: int = 85,
    banding: Banding = Banding(),
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
) -> DataFrame:
    """The rows with all their columns, of each group of near copies only one: of the smallest id, and of its texts
    the one of the smallest digest.

    Rows without words or id are in no group and stay. Rows that share an id but
    hold texts of different groups stay each; of rows with one id and one text,
    which are copies, an arbitrary one stays.
    """
    mark, chosen, alone, other, text_mark = free_names(docs, "mark", "chosen", "alone", "other_id", "other_mark")
    digest = F.md5(column(docs, text_col).cast("binary"))
    found = _grouped(docs, scratch, percent, banding, id_col, text_col, shingle)
    grouped = found.filter("root IS NOT NULL").select("doc_id", "mark", "root").distinct()
    first = grouped.groupBy("root").agg(F.min(F.struct("doc_id", "mark")).alias("first"))
    states = grouped.join(first, "root").select(
        F.col("doc_id").alias(other), F.col("mark").alias(text_mark), (F.struct("doc_id", "mark") == F.col("first")).alias(chosen)
    )
    own = column(docs, id_col).cast("long")
    marked = docs.filter(own.isNotNull()).withColumn(mark, F.coalesce(digest, F.lit("")))
    joined = marked.join(states, (own == F.col(other)) & (F.col(mark) == F.col(text_mark)), "left")
    # Rows in no group are told apart, so that only copies of a chosen row fall away.
    joined = joined.filter(F.coalesce(F.col(chosen), F.lit(True)))
    joined = joined.withColumn(alone, F.when(F.col(chosen).isNull(), F.monotonically_increasing_id()))
    stays = joined.dropDuplicates([id_col, mark, alone])
    return stays.select(*(column(stays, c) for c in docs.columns)).unionByName(docs.filter(own.isNull()))


def _grouped(docs, scratch: Scratch, percent: int, banding: Banding, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(doc_id, mark, n_shingles, root, component_id) of every row: the digest of its text, its group and the group's smallest id."""
    text = column(docs, text_col).cast("binary")
    source = docs.select(column(docs, id_col).cast("long").alias("doc_id"), text.alias("text"), F.coalesce(F.md5(text), F.lit("")).alias("mark"))

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, nodes, keys = [], [], []
            for found in shingle_sets(batch["text"], shingle):
                sizes.append(len(found))
                nodes.append(_node(found))
                keys.append(band_keys(found, banding) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["mark"], pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "mark", "n_shingles", "node", "keys"],
            )

    rows = "doc_id long, mark string, n_shingles long, node long, keys array<long>"
    signed = scratch.write(source.mapInArrow(sign, rows), "signed")
    linked_rows = signed.filter("node IS NOT NULL AND doc_id IS NOT NULL")
    classes = scratch.write(
        linked_rows.groupBy("node").agg(
            F.min("doc_id").alias("first"), F.max("n_shingles").alias("size"), F.first("keys").alias("keys")
        ),
        "classes",
    )
    shared = scratch.write(_shared(classes), "shared")

    def shingles_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(shingle_sets(batch["text"], shingle))
            yield pa.RecordBatch.from_arrays(
                [pa.array([_node(x) for x in found], pa.int64()), pa.array([x.view(np.int64) for x in found], pa.list_(pa.int64()))],
                names=["node", "shingles"],
            )

    # Sets of classes that have a candidate, one document for each class.
    wanted = classes.join(shared.select("node").distinct(), "node", "left_semi").select(F.col("first").alias("doc_id"))
    sets = source.drop("mark").join(wanted, "doc_id", "left_semi").mapInArrow(shingles_of, "node long, shingles array<long>")
    sets = scratch.write(sets.dropDuplicates(["node"]), "sets")

    members = scratch.write(_members(shared, sets, percent), "members")
    listed = members.groupBy("node").agg(F.collect_list("key").alias("keys"))
    members = scratch.write(members.join(listed, "node"), "listed")
    roots = _links(members, sets, percent, scratch)
    named = classes.select("node", "first").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = scratch.write(named, "named")
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    component = named.join(smallest, "root").select("node", "root", "component_id")
    alone = signed.withColumn("node", F.when(F.col("doc_id").isNotNull(), F.col("node"))).join(component, "node", "left")
    return alone.select("doc_id", "mark", "n_shingles", "root", "component_id")


def _node(hashes: np.ndarray) -> int | None:
    return xxhash.xxh3_64_intdigest(hashes.tobytes()) - (1 << 63) if len(hashes) else None


def _shared(classes: DataFrame) -> DataFrame:
    """(key, node, size, n) of the buckets that hold more than one class."""
    dealt = classes.select("node", "size", F.explode("keys").alias("key"))
    return dealt.join(dealt.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "key")


def _members(shared: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(key, node, size, common, weight) of the classes that may have a link in a bucket.

    `common` counts the shingles of a class that some other candidate has too, so
    no intersection is larger; a class whose own shingles rule out a link with
    anything as large as its bucket's smallest falls away. `weight` counts the
    company a class has in its buckets: the original of a group of copies, which
    is closest to all of them, has most of it.
    """
    owners = sets.select("node", F.explode("shingles").alias("shingle")).groupBy("shingle")
    owners = owners.agg(F.count("*").alias("n"), F.min("node").alias("node")).filter("n = 1")
    own = owners.groupBy("node").agg(F.count("*").alias("own"))
    weights = shared.groupBy("node").agg(F.sum("n").alias("weight"), F.max("size").alias("size"))
    nodes = weights.join(own, "node", "left").select(
        "node", "size", "weight", (F.col("size") - F.coalesce("own", F.lit(0))).alias("common")
    )
    found = shared.select("key", "node").join(nodes.filter(100 * F.col("common") >= percent * F.col("size")), "node")
    smallest = found.groupBy("key").agg(F.min("size").alias("smallest"), F.count("*").alias("n")).filter("n > 1")
    bound = F.col("size") + F.greatest("smallest", "common") - F.col("common")
    return found.join(smallest.drop("n"), "key").filter(100 * F.col("common") >= percent * bound).drop("smallest")


def _possible(percent: int, size: str, common: str, other_size: str, other_common: str) -> Column:
    """Whether two classes of these sizes can be similar enough, before their sets are compared."""
    most = F.least(common, other_common)
    return 100 * most >= percent * (F.col(size) + F.col(other_size) - most)


def _links(members: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """(node, root) of the classes that have a link; see the module's text for the rounds."""
    left = members.select("key", "node", "size", "common", "weight", "keys")
    roots, centres = None, 1
    while True:
        if roots is None:
            placed = left.withColumn("root", F.col("node"))
        else:
            placed = left.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        own = F.struct("weight", "node")
        groups = placed.groupBy("key", "root").agg(F.count("*").alias("n"), F.max(own).alias("best"))
        largest = F.max(F.struct("n", "root"))
        open_ = groups.groupBy("key").agg(
            F.count("*").alias("groups"),
            largest["root"].alias("main"),
            (F.sum("n") - largest["n"]).alias("others"),
            F.max("best").alias("best"),
        ).filter("groups > 1")
        # Centres come from outside the bucket's largest group; the best of them always, so that each round gets on.
        # The others are chosen alike in all buckets, which repeats fewer comparisons.
        chance = F.pmod(F.xxhash64("node", F.lit(centres)), F.lit(1 << 30)) / F.lit(1 << 30)
        placed = placed.join(open_.drop("groups"), "key")
        outside = F.col("root") != F.col("main")
        first = F.col("node") == F.col("best.node")
        centre = first | (outside & (chance < F.lit(centres - 1) / F.col("others")))
        placed = scratch.write(placed.select("key", "node", "size", "common", "weight", "keys", "root", centre.alias("centre")), "open")
        if placed.isEmpty():
            return roots if roots is not None else scratch.write(_roots_of_none(placed), "roots")
        chosen = placed.filter("centre").select(
            "key",
            F.col("node").alias("other"),
            F.col("size").alias("other_size"),
            F.col("common").alias("other_common"),
            F.col("keys").alias("other_keys"),
            F.col("root").alias("other_root"),
        )
        met = placed.join(chosen, "key").filter("root <> other_root")
        met = met.filter(_possible(percent, "size", "common", "other_size", "other_common"))
        # Two classes that share several buckets are compared in the one of the smallest key only.
        met = met.filter(F.col("key") == F.array_min(F.array_intersect("keys", "other_keys")))
        new = _pairs(met.select("node", "size", "root", "other", "other_size", "other_root"))
        fresh = scratch.write(_confirmed(new, sets, percent).filter("linked"), "links")
        if roots is None or not fresh.isEmpty():
            roots = scratch.write(_joined(roots, connected_components(fresh.select("a", "b"), scratch)), "roots")
        # A centre has met all others of its bucket and leaves it.
        left = placed.filter("NOT centre").select("key", "node", "size", "common", "weight", "keys")
        centres *= _MORE


def _roots_of_none(placed: DataFrame) -> DataFrame:
    return placed.select("node", "root").limit(0)


def _pairs(found: DataFrame) -> DataFrame:
    """Distinct pairs (a < b) of different classes."""
    low = F.col("node") < F.col("other")
    return (
        found.filter("node <> other")
        .select(
            F.least("node", "other").alias("a"),
            F.greatest("node", "other").alias("b"),
            F.when(low, F.col("size")).otherwise(F.col("other_size")).alias("a_size"),
            F.when(low, F.col("other_size")).otherwise(F.col("size")).alias("b_size"),
            F.least("root", "other_root").alias("low_root"),
            F.greatest("root", "other_root").alias("high_root"),
        )
        .distinct()
    )


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, linked): pairs compared on full sets, with a and b the roots that a link joins."""
    near = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("a_set")), "a")
    near = near.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("b_set")), "b")
    shared = F.size(F.array_intersect("a_set", "b_set"))
    linked = 100 * shared >= percent * (F.col("a_size") + F.col("b_size") - shared)
    return near.select(F.col("low_root").alias("a"), F.col("high_root").alias("b"), linked.alias("linked"))


def _joined(roots: DataFrame | None, found: DataFrame) -> DataFrame:
    """(node, root) after the roots of `found` have been joined; a node without links so far is its own root."""
    if roots is None:
        return found.select("node", F.col("component").alias("root"))
    moved = found.select(F.col("node").alias("root"), "component")
    known = roots.join(moved, "root", "left").select("node", F.coalesce("component", "root").alias("root"))
    new = found.join(roots.select("node"), "node", "left_anti").select("node", F.col("component").alias("root"))
    return known.unionByName(new)
