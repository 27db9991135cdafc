"""Byte-level BPE with the tiktoken library and a local rank file.

The pattern falls into the same matches left and right of a safe boundary, so
long texts are encoded in parts that end at one. Safe are the place before a
blank that follows a visible character, as a match has white space at its
beginning only, and the place between an ASCII letter and a digit or mark behind
it, as letters end a match there. Very long runs of white space, which the
library's matcher does not survive, are matches of their own but for their last
character, and are merged without the matcher.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.columns import column
from ledgerlens.llm.kept import kept

# Characters of a text that are encoded at a time, and bytes of results that are handed over at a time.
_PART, _BATCH = 1 << 16, 4 << 20
# White space that the matcher is spared from this length on.
_RUN = 4096
# Python's \S is narrower than the pattern's, its \s wider, so both readings agree on these boundaries.
_SAFE = re.compile(r"\S(?=[ \t-\r])|[A-Za-z](?=[0-9.,;:!?])")
# White space as Unicode's property has it, which is the pattern's \s.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_SPACES = re.compile(f"[{_SPACE}]{{{_RUN},}}")

_CODED = "doc_id long, n_tokens long, ids binary"
_DECODED = _CODED + ", decoded binary"


def encoding(ranks: str, pattern: str):
    """The library's encoding for a rank file (a line for each token: base64 bytes, rank), loaded once a worker."""

    def load():
        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    return kept(("encoding", ranks, pattern), load)


def parts(text: str, size: int = _PART) -> Iterator[tuple[str, bool]]:
    """The text in order, cut at safe boundaries, and whether a part is a match of its own.

    A part is longer than `size` only where no boundary comes before.
    """
    at = 0
    for run in _SPACES.finditer(text) if len(text) >= _RUN else ():
        yield from _cut(text, at, run.start(), size)
        # The last blank of a run goes with what follows it.
        at = run.end() - (run.end() < len(text))
        yield text[run.start() : at], True
    yield from _cut(text, at, len(text), size)


def _cut(text: str, start: int, end: int, size: int) -> Iterator[tuple[str, bool]]:
    while end - start > size:
        found = _SAFE.search(text, start + size - 1, end)
        if found is None or found.end() >= end:
            break
        yield text[start : found.end()], False
        start = found.end()
    if start < end:
        yield text[start:end], False


def ids_of(text: str, ranks: str, pattern: str, size: int = _PART) -> bytes:
    """The ids of a text as little-endian unsigned 32-bit integers."""
    encoder = encoding(ranks, pattern)
    out = bytearray()
    for part, whole in parts(text, size):
        found = encoder._encode_single_piece(part) if whole else encoder.encode_ordinary(part)
        out += np.array(found, "<u4").tobytes()
    return bytes(out)


def encode(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids) of every row: the ids of the whole text, little-endian unsigned 32-bit integers in one binary value.

    A null text counts as empty and has no ids; a null id stays null; rows that
    repeat are encoded each. There are no special tokens: text that looks like
    one is ordinary text. Further columns are not read. A task holds an Arrow
    batch of texts and the ids of some of them.
    """
    source = docs.select(column(docs, id_col).cast("long").alias("doc_id"), column(docs, text_col).cast("string").alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = ((i.as_py(), ids_of(t.as_py() or "", ranks, pattern)) for i, t in zip(batch["doc_id"], batch["text"]))
            yield from _batches(((doc_id, len(ids) // 4, ids) for doc_id, ids in found), _CODED)

    return source.mapInArrow(run, _CODED)


def decode(coded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """The rows of `encode` with `decoded`, the bytes that the ids stand for; null ids stand for none.

    Decoding gives raw bytes: ids need not end at the end of a character.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(ranks, pattern)
        for batch in batches:
            rows = zip(*(batch[c] for c in ("doc_id", "n_tokens", "ids")))
            yield from _batches(
                (
                    (i.as_py(), n.as_py(), ids.as_py(), encoder.decode_bytes(np.frombuffer(ids.as_py() or b"", "<u4").tolist()))
                    for i, n, ids in rows
                ),
                _DECODED,
            )

    return coded.select("doc_id", "n_tokens", "ids").mapInArrow(run, _DECODED)


def digests(decoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): what tells whether two encodings agree."""
    empty = F.lit(b"")
    return decoded.select(
        "doc_id",
        "n_tokens",
        F.sha2(F.coalesce("ids", empty), 256).alias("ids_sha256"),
        F.sha2(F.coalesce("decoded", empty), 256).alias("decoded_sha256"),
    )


def _batches(rows: Iterable[tuple], schema: str) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of bounded size."""
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(x) if isinstance(x, bytes) else 8 for x in row)
        if size >= _BATCH:
            yield _batch(held, fields, kinds)
            held, size = [], 0
    if held:
        yield _batch(held, fields, kinds)


def _batch(rows: list[tuple], fields: list[list[str]], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = [pa.array(x, kinds[kind]) for x, (_, kind) in zip(zip(*rows), fields)]
    return pa.RecordBatch.from_arrays(columns, names=[name for name, _ in fields])
