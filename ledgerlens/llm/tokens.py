"""Token ids as length-delimited binary records with a separate offset index.

A shard file is the magic `TOKREC01` and then one record after another:

    uint64  length of the payload      uint32  masked checksum of those 8 bytes
    payload                            uint32  masked checksum of the payload

A payload is int64 document id, uint8 flags (1: the id is null), uint8 width w
in bytes of a token id, then the ids as little-endian unsigned integers of w
bytes. Ids of a vocabulary of up to 65,536 entries take two bytes, else four.
Checksums are CRC-32, rotated right by 15 bits plus a constant, so a checksum
stored among the data doesn't look like one of its own.

The offset index is a Parquet table with a row per document: shard file,
offset, bytes, number of ids and the ids before it. Readers that want records
in another order seek by it; every task attempt writes files of its own name
and the index names only those of attempts that Spark has committed, so lost
executors leave no half files in the result.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.kept import kept
from ledgerlens.sources import Scratch

MAGIC = b"TOKREC01"
_HEAD, _SUM, _BODY = "<Q", "<I", "<qBB"
# A shard file ends with the record that reaches this size.
SHARD_BYTES = 32 << 20
# Words and pieces of text whose ids a worker keeps from task to task, of either so many in each of two generations.
_KEPT = 400_000
# Longer texts are split piece by piece, without a list of all pieces.
_AT_ONCE = 1 << 20

# Byte-level BPE never merges across the place where white space is followed by
# other characters, but for one space before a word, nor between a run of letters
# and the mark behind it. So text falls into pieces that encode alike alone and
# in place. The white space is Unicode's; the letters are those of Latin scripts,
# other runs stay whole.
_S = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_WORD = f" ?[A-Za-z\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\u017f]+(?=[.,;:!?()|*$%&#\"]|[{_S}]|$)"
_PIECE = re.compile(f"{_WORD}| ?[^{_S}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
# A single space always begins a piece; one before other white space or the end may belong to a longer run.
_LOOSE = re.compile(f" (?:[{_S}]|\\Z)")
# Pieces that the byte-level split leaves whole.
_PLAIN = re.compile(" ?[A-Za-z\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\u017f]+")
# Byte-level BPE writes a byte as the character of that number if it is visible, the others as those from 256 on.
_HIDDEN = [b for b in range(256) if not (33 <= b < 127 or 161 <= b and b != 173)]
_LETTERS = {b: 256 + i for i, b in enumerate(_HIDDEN)}


def masked(checksum: int) -> int:
    """A stored form of the checksum."""
    return ((checksum >> 15 | checksum << 17) + 0xA282EAD8) & 0xFFFFFFFF


class Encoder:
    """Encodes texts with a tokenizer file; repeated pieces of text are encoded once.

    `by_piece` says that the tokenizer splits text before its merges as byte-level
    BPE does. Texts that hold one of its added tokens are always encoded whole.
    A plain word goes straight to the library's BPE model where the file has that
    model behind the byte-level split alone; the split would leave the word whole.
    """

    def __init__(self, path: str, end_id: int | None, by_piece: bool = True):
        # Tasks already run side by side; threads of the library's own would only compete with them.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_padding()
        self._tokenizer.no_truncation()
        self.width = 2 if self._tokenizer.get_vocab_size() <= 1 << 16 else 4
        self._code = "H" if self.width == 2 else "I"
        self._end = b"" if end_id is None else np.array([end_id], f"<u{self.width}").tobytes()
        added = [re.escape(t.content) for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._added = re.compile("|".join(added)) if added else None
        self._by_piece = by_piece
        self._model = self._tokenizer.model if _splits_bytes_only(self._tokenizer) else None
        self._ids = _Ids(self._piece)
        self._words = _Ids(self._word)

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as bytes, the end id behind them; null counts as empty."""
        return [self._text(text or "") + self._end for text in texts]

    def _text(self, text: str) -> bytes:
        if not self._by_piece or (self._added and self._added.search(text)):
            return self._encode(text)
        if len(self._ids) > _KEPT:
            self._ids = _Ids(self._piece, self._ids)
        if len(self._words) > _KEPT:
            self._words = _Ids(self._word, self._words)
        if len(text) > _AT_ONCE:
            return b"".join(self._ids[piece.group()] for piece in _PIECE.finditer(text))
        if _LOOSE.search(text):
            return self._pieces(text)
        first, *rest = text.split(" ")
        return b"".join((self._pieces(first), *map(self._words.__getitem__, rest)))

    def _pieces(self, text: str) -> bytes:
        return b"".join(map(self._ids.__getitem__, _PIECE.findall(text)))

    def _word(self, word: str) -> bytes:
        """The ids of a word behind a space; marks behind it have ids of their own."""
        first, *marks = _PIECE.findall(" " + word)
        if not marks:
            return self._piece(first)
        return b"".join((self._words[first[1:]], *map(self._ids.__getitem__, marks)))

    def _piece(self, piece: str) -> bytes:
        if self._model is None or not _PLAIN.fullmatch(piece):
            return self._encode(piece)
        letters = piece.encode().decode("latin-1").translate(_LETTERS)
        return array(self._code, [token.id for token in self._model.tokenize(letters)]).tobytes()

    def _encode(self, text: str) -> bytes:
        return array(self._code, self._tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


class _Ids(dict):
    """Ids of pieces, encoded when first asked for; `older` has those of the generation before."""

    def __init__(self, encode: Callable[[str], bytes], older: dict[str, bytes] | None = None):
        self._encode = encode
        # The generation before that one is let go.
        self._older = dict(older or {})

    def __missing__(self, piece: str) -> bytes:
        found = self._older.get(piece)
        if found is None:
            found = self._encode(piece)
        self[piece] = found
        return found


def _splits_bytes_only(tokenizer) -> bool:
    """Whether text goes to a BPE model as words of byte letters, changed and split by nothing else."""
    parts = json.loads(tokenizer.to_str())
    split = parts["pre_tokenizer"] or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
    return bool(plain and parts["normalizer"] is None and parts["model"]["type"] == "BPE")


def encoder(path: str, end_id: int | None, by_piece: bool = True) -> Encoder:
    """The worker's encoder, loaded once for all its tasks, with the pieces it has met."""
    return kept(("encoder", path, end_id, by_piece), lambda: Encoder(path, end_id, by_piece))


def record(doc_id: int | None, ids: bytes, width: int) -> bytes:
    """One framed record."""
    body = struct.pack(_BODY, doc_id or 0, doc_id is None, width) + ids
    head = struct.pack(_HEAD, len(body))
    return b"".join((head, struct.pack(_SUM, masked(zlib.crc32(head))), body, struct.pack(_SUM, masked(zlib.crc32(body)))))


def parsed(data: bytes, start: int = 0) -> Iterator[tuple[int | None, np.ndarray]]:
    """(document id, ids) of the records from an offset on; raises where a checksum differs."""
    at = start
    while at < len(data):
        head = data[at : at + 8]
        if len(head) < 8 or struct.unpack_from(_SUM, data, at + 8)[0] != masked(zlib.crc32(head)):
            raise ValueError(f"damaged length at byte {at}")
        end = at + 12 + struct.unpack(_HEAD, head)[0]
        body = data[at + 12 : end]
        if len(data) < end + 4 or struct.unpack_from(_SUM, data, end)[0] != masked(zlib.crc32(body)):
            raise ValueError(f"damaged record at byte {at}")
        doc_id, flags, width = struct.unpack_from(_BODY, body)
        yield (None if flags & 1 else doc_id), np.frombuffer(body, f"<u{width}", offset=struct.calcsize(_BODY))
        at = end + 4


@dataclass
class TokenFiles:
    """Written shards: their folder, the offset index and one row per shard with the ids before it."""

    root: str
    index: DataFrame
    shards: DataFrame


_INDEX = (
    "part int, shard int, path string, doc_id long, offset long, length long, n_tokens long, before_in_shard long"
)


def write_token_shards(
    docs: DataFrame,
    tokenizer: str,
    scratch: Scratch,
    end_id: int | None = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_bytes: int = SHARD_BYTES,
    by_piece: bool = True,
) -> TokenFiles:
    """Encode every whole text and write it to shard files in ascending id order.

    A null text is an empty one; a null id comes first. Rows with one id follow
    their text; equal rows are all written. An empty table gives no shard.
    Only the two named columns are used, whatever else the table has. Texts are
    dealt by ranges of the id, so no task holds more than its range, and each
    shard is written as its records are made.
    """
    root = scratch.path("shards")
    _storage(root)[0].create_dir(_storage(root)[1], recursive=True)
    ordered = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    ordered = ordered.repartitionByRange("id").sortWithinPartitions("id", "text")

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(tokenizer, end_id, by_piece), TaskContext.get().partitionId()
        files, folder = _storage(root)
        shard, out, path, at, before = -1, None, "", 0, 0
        try:
            for batch in batches:
                rows = []
                for doc_id, ids in zip(batch["id"].to_pylist(), encode(batch["text"].to_pylist())):
                    if out is None:
                        shard, before, at = shard + 1, 0, len(MAGIC)
                        path = f"{folder}/part-{part:06d}-{shard:04d}-{uuid.uuid4().hex}.tok"
                        out = files.open_output_stream(path)
                        out.write(MAGIC)
                    framed, n = record(doc_id, ids, encode.width), len(ids) // encode.width
                    out.write(framed)
                    rows.append((part, shard, path.rsplit("/", 1)[1], doc_id, at, len(framed), n, before))
                    at, before = at + len(framed), before + n
                    if at >= shard_bytes:
                        out.close()
                        out = None
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*rows), _types(_INDEX))], names=_names(_INDEX)
                ) if rows else _empty(_INDEX)
        finally:
            if out is not None:
                out.close()

    index = scratch.write(ordered.mapInArrow(write, _INDEX), "index")
    shards = index.groupBy("part", "shard", "path").agg(
        F.sum("n_tokens").alias("n_tokens"), F.max(F.col("offset") + F.col("length")).alias("bytes")
    )
    # Ids before a shard: those of its part's earlier shards and those of earlier parts.
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    parts = parts.select(
        "part", F.coalesce(F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base")
    )
    earlier = F.sum("n_tokens").over(
        Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    )
    shards = (
        shards.withColumn("inside", F.coalesce(earlier, F.lit(0)))
        .join(parts, "part")
        .select("part", "shard", "path", "n_tokens", "bytes", (F.col("base") + F.col("inside")).alias("start"))
    )
    return TokenFiles(root, index, scratch.write(shards, "shard-starts"))


def read_token_shards(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, shard file) read back from all shard files, every checksum verified."""
    root = files.root
    slots = spark.sparkContext.defaultParallelism
    listed = files.shards.select("path", "start").repartition(max(1, slots), "path")

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _storage(root)
        for batch in batches:
            for path, start in zip(batch["path"].to_pylist(), batch["start"].to_pylist()):
                with store.open_input_stream(f"{folder}/{path}") as stream:
                    data = stream.read()
                if data[: len(MAGIC)] != MAGIC:
                    raise ValueError(f"{path} is no shard file")
                rows = []
                for doc_id, ids in parsed(data, len(MAGIC)):
                    rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), path))
                    start += len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*rows), _types(_READ))], names=_names(_READ)
                )

    return listed.mapInArrow(read, _READ)


_READ = "doc_id long, start long, n_tokens long, ids_crc32 long, shard string"


def read_records(spark: SparkSession, files: TokenFiles, wanted: DataFrame) -> DataFrame:
    """(doc_id, ids) of chosen rows of the offset index, fetched by offset: the access of a shuffled reader."""
    root = files.root
    rows = wanted.select("path", "offset", "length").repartition("path").sortWithinPartitions("path", "offset")

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _storage(root)
        name, source = None, None
        for batch in batches:
            ids, lists = [], []
            for path, offset, length in zip(*(batch[c].to_pylist() for c in ("path", "offset", "length"))):
                if path != name:
                    name, source = path, store.open_input_file(f"{folder}/{path}")
                for doc_id, found in parsed(source.read_at(length, offset)):
                    ids.append(doc_id)
                    lists.append(found.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(lists, pa.list_(pa.int64()))], names=["doc_id", "ids"]
            )

    return rows.mapInArrow(read, "doc_id long, ids array<long>")


def _storage(uri: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(re.sub("^file:/(?=[^/])", "file:///", uri))


_ARROW = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _types(schema: str) -> list[pa.DataType]:
    return [_ARROW[field.split()[1]] for field in schema.split(", ")]


def _empty(schema: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([], t) for t in _types(schema)], names=_names(schema))
