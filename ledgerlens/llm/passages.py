"""Passages that repeat across documents, found by hashing lines and their parts.

A text falls into units: its lines, and inside a line the stretches that end
with a mark (. ! ? , ;) before white space. Units are normalised
(lower case, one space for white space) and hashed to 128 bits. Digests are
grouped over all documents; the document of the smallest id keeps a unit, and
inside it the first place. Everywhere else the unit is a repeat.

A run of repeats is removed when it has `least` words or more. Units of one or
two words prove nothing alone and go with the run around them. So a passage
that begins and ends inside lines loses all of its whole units, and chance
repeats of a short sentence stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.sources import Scratch

LEAST_WORDS = 20
_PROOF = 3
_UNIT = re.compile(r"[^\n.!?,;]+(?:[.!?,;]+(?!\s)[^\n.!?,;]+)*[.!?,;]*|[.!?,;]+")
_LAST = (1 << 63) - 1


def units(text: str) -> list[tuple[int, int, int, bytes]]:
    """(start, end, words, digest) of each unit; units of fewer than three words have an empty digest."""
    found = []
    for m in _UNIT.finditer(text):
        words = m[0].lower().split()
        if words:
            digest = xxhash.xxh3_128_digest(" ".join(words).encode("utf-8", "surrogatepass")) if len(words) >= _PROOF else b""
            found.append((m.start(), m.end(), len(words), digest))
    return found


def repeated_spans(text: str, known: set[bytes], least: int) -> list[tuple[int, int]]:
    """(start, end) of the runs to remove, given the digests that earlier documents hold."""
    spans, here = [], set()
    run: list[tuple[int, int]] = []
    words = waiting = 0
    pending: list[tuple[int, int]] = []

    def close() -> None:
        nonlocal run, words, waiting, pending
        if words >= least:
            spans.append((run[0][0], run[-1][1]))
        run, words, waiting, pending = [], 0, 0, []

    for start, end, n, digest in units(text):
        if not digest:
            if run:
                pending.append((start, end))
                waiting += n
            continue
        if digest in known or digest in here:
            run += pending
            run.append((start, end))
            words += waiting + n
            pending, waiting = [], 0
        else:
            close()
        here.add(digest)
    close()
    return spans


def without_repeats(
    docs: DataFrame, scratch: Scratch, least: int = LEAST_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, text, n_removed, removed) of every row: the text without repeats, characters gone, and where they were.

    `removed` lists (start, end) in code points of the original text, so that
    text plus spans give the original's layout. A null text stays null, an empty
    one empty. Rows of one id are one document: they take nothing from each
    other. Rows with a null id rank behind all others. Further columns are not read.
    """
    rank = F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), rank.alias("rank"), F.col(text_col).cast("string").alias("text"))

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = [list({u[3] for u in units(text.as_py() or "") if u[3]}) for text in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["rank"], pa.array(digests, pa.list_(pa.binary()))], names=["rank", "digests"]
            )

    listed = source.select("rank", "text").mapInArrow(hashed, "rank long, digests array<binary>")
    placed = scratch.write(listed.select("rank", F.explode("digests").alias("digest")), "digests")
    first = placed.groupBy("digest").agg(F.min("rank").alias("first"), F.max("rank").alias("last"))
    first = scratch.write(first.filter("last > first").drop("last"), "repeated")
    later = placed.join(first, "digest").filter("rank > first")
    known = scratch.write(later.groupBy("rank").agg(F.collect_set("digest").alias("known")), "known")
    joined = source.join(known, "rank", "left").select("doc_id", "text", "known")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, gone, spans = [], [], []
            for text, known_ in zip(batch["text"], batch["known"]):
                whole = text.as_py()
                found = repeated_spans(whole or "", set(known_.as_py() or ()), least)
                kept, at = [], 0
                for a, b in found:
                    kept.append((whole or "")[at:a])
                    at = b
                texts.append(None if whole is None else "".join(kept) + whole[at:])
                gone.append(sum(b - a for a, b in found))
                spans.append([{"start": a, "end": b} for a, b in found])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(texts, pa.string()), pa.array(gone, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                names=["doc_id", "text", "n_removed", "removed"],
            )

    return joined.mapInArrow(cut, "doc_id long, text string, n_removed long, removed array<struct<start: bigint, end: bigint>>")
