"""Benchmark passages in documents: SimHash of item-sized windows, multi-index Hamming search, exact similarity.

A window of as many words as a benchmark item slides over the document, also
partly beyond its ends, where it holds fewer words. Its fingerprint is the
64-bit SimHash of its five-word shingles, weighted by how often they occur.
Fingerprints are cut into radius + 1 blocks: two that differ in at most
`radius` bits agree on a block, so looking up each block finds all items of
that size within the radius. Those are compared exactly by weighted Jaccard
similarity, sum of the smaller over sum of the larger counts.

A window holds at least as many shingles of an item as the two share, so only
windows where enough words begin a shingle of items get a fingerprint, and only
candidates that hold enough shingles of their own item are compared. That skips
nothing. Windows are searched in chunks, which bounds the memory of one text.

The benchmark is the query set: it is taken in blocks of bounded size, and each
block is laid against all documents where they lie, without a shuffle.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.columns import free_names
from ledgerlens.llm.words import SHINGLE, Words, shingles, words

# Two texts of similarity 0.8 have fingerprints about 10 bits apart, with a deviation of about 3.
RADIUS = 21
# Bytes of benchmark text that are laid against the documents at a time.
BLOCK_BYTES = 4 << 20
# (window, item) places that are looked at together, and words whose signs are summed together.
_PLACES, _SIGNED = 1 << 20, 1 << 16
_FOUND = "array<struct<item_id: bigint, first_word: int, n_words: int, shared: int, total: int>>"
_ARROW = pa.list_(
    pa.struct(
        [("item_id", pa.int64()), ("first_word", pa.int32()), ("n_words", pa.int32()), ("shared", pa.int32()), ("total", pa.int32())]
    )
)


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    percent: int = 80,
    radius: int = RADIUS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, item_id, first_word, n_words, shared, total, similarity): the best window of each item that a document holds.

    A row says that `n_words` words from `first_word` on have a similarity of at
    least `percent` % to the item; ties go to the earlier window. Null or empty
    texts hold nothing and items without words are in nothing. Items and rows
    that repeat give their rows each; a null id stays null.
    """
    found = with_leaks(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), benchmark, "found", "text", percent, radius)
    return found.select("doc_id", F.inline("found")).withColumn("similarity", F.col("shared") / F.col("total"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, percent: int = 80, radius: int = RADIUS, text_col: str = "text") -> DataFrame:
    """The rows whose text holds no benchmark item, with their columns as they are."""
    (name,) = free_names(docs, "leaks")
    return with_leaks(docs, benchmark, name, text_col, percent, radius).filter(F.size(name) == 0).drop(name)


def with_leaks(
    docs: DataFrame, benchmark: DataFrame, name: str, text_col: str = "text", percent: int = 80, radius: int = RADIUS
) -> DataFrame:
    """The rows with a column of what they hold of the benchmark."""
    text = F.col(text_col).cast("binary")
    parts = [_search(docs.sparkSession, block, percent, radius)(text) for block in _blocks(benchmark)]
    none = F.array().cast(_FOUND)
    return docs.withColumn(name, F.concat(*parts) if len(parts) > 1 else parts[0] if parts else none)


def _blocks(benchmark: DataFrame) -> Iterator[tuple[list[int | None], list[bytes]]]:
    """Ids and texts of the items, in blocks of about BLOCK_BYTES."""
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("binary").alias("text")).filter("text IS NOT NULL")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-size // BLOCK_BYTES)
    for k in range(n):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).orderBy("item_id", "text").collect()
        yield [r[0] for r in rows], [bytes(r[1]) for r in rows]


def _search(spark, block: tuple[list, list[bytes]], percent: int, radius: int):
    """An Arrow function from texts to what they hold of the block's items."""
    # Pickled with the code of its class, as executors need not have this package.
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(Items.of(*block, radius)))

    @F.arrow_udf(_FOUND)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        items = pickle.loads(sent.value)
        for texts in batches:
            out: list[list[dict]] = []
            for run in words(texts):
                out += items.in_texts(run, percent)
            yield pa.array(out, _ARROW)

    return found


def fingerprints(bits: np.ndarray) -> np.ndarray:
    """Words of 64 bits from rows of 64 booleans."""
    return np.packbits(bits, axis=-1, bitorder="little").view(np.uint64)[..., 0]


def _signs(hashes: np.ndarray) -> np.ndarray:
    """A row of 64 signs for each hash."""
    bits = np.unpackbits(hashes.reshape(-1, 1).view(np.uint8), axis=1, bitorder="little")
    return bits.astype(np.int32) * 2 - 1


@dataclass
class Items:
    """A block of benchmark items, ready to be looked up."""

    ids: list[int | None]
    counts: list[Counter]
    sizes: np.ndarray
    prints: np.ndarray
    anchors: np.ndarray
    anchor_sizes: list[np.ndarray]
    radius: int
    cuts: np.ndarray
    tables: dict[int, tuple[np.ndarray, list[dict[int, np.ndarray]]]]

    @staticmethod
    def of(ids: list[int | None], texts: list[bytes], radius: int) -> Items:
        own, sizes = [], []
        for run in words(pa.array(texts, pa.binary())):
            hashes, valid = shingles(run)
            for a, b in zip(run.bounds[:-1], run.bounds[1:]):
                own.append(hashes[a:b][valid[a:b]])
                sizes.append(int(b - a))
        keep = [i for i, n in enumerate(sizes) if n]
        own, ids = [own[i] for i in keep], [ids[i] for i in keep]
        sizes = np.array([sizes[i] for i in keep], dtype=np.int64)
        held: dict[int, set[int]] = {}
        for n, hashes in zip(sizes, own):
            for h in hashes.tolist():
                held.setdefault(h, set()).add(int(n))
        anchors = np.array(sorted(held), dtype=np.uint64)
        prints = np.array([fingerprints(_signs(h).sum(axis=0) > 0) for h in own], dtype=np.uint64)
        cuts = np.linspace(0, 64, radius + 2).astype(np.uint64)
        tables = {}
        for n in np.unique(sizes):
            of_size = np.flatnonzero(sizes == n)
            by_block: list[dict[int, list[int]]] = []
            for value in _cut(prints[of_size], cuts):
                table: dict[int, list[int]] = {}
                for place, v in enumerate(value.tolist()):
                    table.setdefault(v, []).append(place)
                by_block.append({v: np.array(x) for v, x in table.items()})
            tables[int(n)] = (of_size, by_block)
        return Items(
            ids, [Counter(h.tolist()) for h in own], sizes, prints, anchors,
            [np.array(sorted(held[h])) for h in anchors.tolist()], radius, cuts, tables,
        )

    def in_texts(self, run: Words, percent: int) -> list[list[dict]]:
        """For each text, the best window of each item that it holds."""
        out: list[list[dict]] = [[] for _ in range(len(run))]
        if not len(self.ids) or not len(run.hashes):
            return out
        for size in sorted({min(int(n), SHINGLE) for n in self.tables}):
            hashes, valid = shingles(run, size)
            where = np.flatnonzero(valid)
            place = np.minimum(np.searchsorted(self.anchors, hashes[where]), len(self.anchors) - 1)
            hit = where[self.anchors[place] == hashes[where]]
            texts = np.searchsorted(run.bounds, hit, side="right") - 1
            for text in np.unique(texts):
                a, b = run.bounds[text], run.bounds[text + 1]
                own = hashes[a:b][valid[a:b]]
                out[text] += self._in_text(own, hit[texts == text] - a, b - a, size, percent)
        return out

    def _in_text(self, own: np.ndarray, hits: np.ndarray, length: int, size: int, percent: int) -> list[dict]:
        """Search one text by its shingles of `size` words, `hits` being those that some item has."""
        best: dict[int, tuple] = {}
        anchors = np.searchsorted(self.anchors, own[hits])
        different, which = np.unique(anchors, return_inverse=True)
        held_by = [self.anchor_sizes[a].tolist() for a in different.tolist()]
        for n in sorted({n for sizes in held_by for n in sizes if min(n, SHINGLE) == size}):
            span = max(1, n - size + 1)
            # All items of n words have `span` shingles, so a window must share this many with one of them.
            least = -(-percent * span // 100)
            near = hits[np.array([n in sizes for sizes in held_by])[which]]
            if len(near) < least:
                continue
            for low, high in _windows(near, len(own), span, least):
                prints = _prints(own, low, high)
                for window, item in self._within(prints, n):
                    a, b = int(low[window]), int(high[window])
                    there = self.counts[item]
                    held = [h for h in own[a:b].tolist() if h in there]
                    if len(held) < least:
                        continue
                    shared = sum((Counter(held) & there).values())
                    total = (b - a) + there.total() - shared
                    if 100 * shared >= percent * total:
                        known = best.get(item)
                        if known is None or (shared * known[1], -a) > (known[0] * total, -known[2]):
                            best[item] = (shared, total, a, b)
        return [
            {"item_id": self.ids[i], "first_word": a, "n_words": min(b + size - 1, length) - a, "shared": s, "total": t}
            for i, (s, t, a, b) in sorted(best.items())
        ]

    def _within(self, prints: np.ndarray, n: int) -> Iterator[tuple[int, int]]:
        """(window, item) of all items of n words whose fingerprint is within the radius."""
        of_size, tables = self.tables[n]
        step = max(1, _PLACES // len(of_size))
        for first in range(0, len(prints), step):
            some = prints[first : first + step]
            seen = np.zeros((len(some), len(of_size)), dtype=bool)
            for value, table in zip(_cut(some, self.cuts), tables):
                for v in np.unique(value).tolist():
                    if v in table:
                        seen[np.ix_(value == v, table[v])] = True
            window, place = np.divmod(np.flatnonzero(seen), len(of_size))
            near = np.bitwise_count(some[window] ^ self.prints[of_size[place]]) <= self.radius
            yield from zip((window[near] + first).tolist(), of_size[place[near]].tolist())


def _windows(near: np.ndarray, n: int, span: int, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bounds of the windows of `span` among n shingles that hold at least `least` of the places `near`, in chunks and in order."""
    # A window that does begins at most span - 1 places before one of `near`.
    step = max(1, _PLACES // span)
    done = 1 - span
    for first in range(0, len(near), step):
        starts = np.unique((near[first : first + step, None] - np.arange(span)).ravel())
        starts = starts[starts >= done]
        if not len(starts):
            continue
        done = int(starts[-1]) + 1
        low, high = np.maximum(starts, 0), np.minimum(starts + span, n)
        enough = np.searchsorted(near, high) - np.searchsorted(near, low) >= least
        if enough.any():
            yield low[enough], high[enough]


def _prints(own: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The fingerprint of each window, bounds ascending; signs are summed for a stretch of the text at a time."""
    out = np.zeros(len(low), dtype=np.uint64)
    first = 0
    while first < len(low):
        end = max(first + 1, int(np.searchsorted(low, low[first] + _SIGNED)))
        base, top = int(low[first]), int(high[end - 1])
        signs = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(_signs(own[base:top]), axis=0, dtype=np.int32)])
        out[first:end] = fingerprints(signs[high[first:end] - base] - signs[low[first:end] - base] > 0)
        first = end
    return out


def _cut(prints: np.ndarray, cuts: np.ndarray) -> list[np.ndarray]:
    """The values of each block of bits."""
    return [
        (prints >> a) & np.uint64((1 << int(b - a)) - 1) for a, b in zip(cuts[:-1], cuts[1:])
    ]
