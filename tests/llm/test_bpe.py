"""Byte-level BPE against the library on whole texts."""

import hashlib

import numpy as np
import public_tokenizers
import pytest

from ledgerlens.llm import bpe

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
ALPHABET = [*"ab Zé'\n\t.,!s12²Ⅷß|*_-’ ", "\x1c", "\x85", " ", " ", "　", "文", "'ll", "'s", "  ", "<|endoftext|>"]


def whole(text):
    return bpe.encoding(RANKS, PATTERN).encode_ordinary(text)


@pytest.mark.parametrize("size", [1, 2, 7])
def test_parts_encode_as_whole_texts(size):
    random = np.random.default_rng(size)
    for _ in range(1500):
        text = "".join(random.choice(ALPHABET, random.integers(0, 30)))
        assert "".join(p for p, _ in bpe.parts(text, size)) == text
        assert np.frombuffer(bpe.ids_of(text, RANKS, PATTERN, size), "<u4").tolist() == whole(text), repr(text)


def test_runs_of_white_space(monkeypatch):
    import re

    monkeypatch.setattr(bpe, "_RUN", 3)
    monkeypatch.setattr(bpe, "_SPACES", re.compile(f"[{bpe._SPACE}]{{3,}}"))
    random = np.random.default_rng(9)
    for _ in range(1500):
        text = "".join(random.choice([" ", "\n", "\t", "　", " ", "a", "1", "'s", "\x1c"], random.integers(0, 20)))
        assert np.frombuffer(bpe.ids_of(text, RANKS, PATTERN, 4), "<u4").tolist() == whole(text), repr(text)


def test_very_long_texts():
    for text in (" " * 3_000_000 + "a", "x " * 200_000, "é" * 100_000, "\n" * 2_000_000, "word, " * 100_000 + " " * 9000 + "\nend"):
        ids = np.frombuffer(bpe.ids_of(text, RANKS, PATTERN), "<u4").tolist()
        assert bpe.encoding(RANKS, PATTERN).decode_bytes(ids) == text.encode()
        assert max((len(p) for p, own in bpe.parts(text) if not own), default=0) <= max(100_000, bpe._PART + 16)


def test_round_trip(spark):
    rows = [(1, "One <|endoftext|> two"), (2, None), (3, ""), (None, "none"), (1, "One <|endoftext|> two"), (4, "long words " * 40_000)]
    rows = [(i, t, "ids", 7, b"d") for i, t in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int, decoded binary")
    decoded = bpe.decode(bpe.encode(docs, RANKS, PATTERN), RANKS, PATTERN)
    got = sorted(tuple(r) for r in bpe.digests(decoded).fillna(-1, ["doc_id"]).collect())
    want = []
    for doc_id, text, *_ in rows:
        ids = np.array(whole(text or ""), "<u4")
        want.append((-1 if doc_id is None else doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want)
    assert bpe.digests(bpe.decode(bpe.encode(docs.limit(0), RANKS, PATTERN), RANKS, PATTERN)).count() == 0
    # Ids may end inside a character.
    first = whole("文")[:1]
    half = spark.createDataFrame([(1, 1, np.array(first, "<u4").tobytes()), (2, None, None)], "doc_id long, n_tokens long, ids binary")
    bytes_of = [bytes(r.decoded) for r in bpe.decode(half, RANKS, PATTERN).orderBy("doc_id").collect()]
    assert bytes_of == [bpe.encoding(RANKS, PATTERN).decode_bytes(first), b""] and "文".encode().startswith(bytes_of[0])
