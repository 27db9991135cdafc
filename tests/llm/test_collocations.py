"""Collocations against plain counting."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerlens.llm import collocations as C
from ledgerlens.sources import Scratch

SCHEMA = "doc_id long, text string, lang string, h1 string, f int, score string"


def expected(rows, least, top, cover):
    counts, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(w)
            for k in range(1, 5):
                counts[lang or "und"].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = defaultdict(int)
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i : i + k]] = max(inside[p[i : i + k]], a)
        found = []
        for p, a in candidates.items():
            if 100 * inside[p] >= cover * a:
                continue
            s, _, l, r = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))  # noqa: E741
            found.append((-s, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):  # noqa: E741
            out.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -s))
    return sorted(out)


def made(spark, rows):
    return spark.createDataFrame([(i, t, x, "h", 1, "s") for i, (t, x) in enumerate(rows)], SCHEMA)


def corpus(seed, n, vocabulary):
    random = np.random.default_rng(seed)
    words = [f"{'wéX文z'[i % 5]}{i}" for i in range(vocabulary)]
    share = 1 / np.arange(1, vocabulary + 1)
    rows = []
    for i in range(n):
        w = random.choice(words, random.integers(0, 60), p=share / share.sum()).tolist()
        for _ in range(random.integers(0, 4)):
            at, start = random.integers(0, len(w) + 1), random.integers(0, vocabulary - 5)
            w[at:at] = words[start : start + random.integers(2, 6)]
        text = "".join(x + random.choice([" ", "  ", "\t", ", ", "\n", "!"], p=[0.8, 0.05, 0.05, 0.04, 0.03, 0.03]) for x in w)
        rows.append((text, [None, "en", "en", "de"][i % 4]))
    return rows


@pytest.mark.parametrize("least, top, cover, vocabulary", [(2, 5, 80, 40), (3, 30, 60, 60), (2, 100000, 80, 40), (2, 12, 100, 300)])
def test_matches_plain_counting(spark, monkeypatch, least, top, cover, vocabulary):
    rows = corpus(least + vocabulary, 250, vocabulary) + [(None, "en"), ("", None), ("A b c d " * 40, "fr"), ("a, B", "xx"), (" \t..\n", "yy")]
    monkeypatch.setattr(C, "_CHUNK", 3000)
    got = C.collocations(made(spark, rows), Scratch(spark, "c"), least, top, cover)
    assert sorted(tuple(r) for r in got.collect()) == expected(rows, least, top, cover)


def test_marks_are_lowered(spark, monkeypatch):
    """Where most of the first phrases are inside longer ones, the search goes on below them."""
    monkeypatch.setattr(C, "_FIRST", 1)
    waves = []
    wave = C._wave
    monkeypatch.setattr(C, "_wave", lambda *a: waves.append(1) or wave(*a))
    lines = [f"p{i} q{i} r{i} s{i} t{i}. p{i} x{i % 7}" for i in range(60)] * 4
    rows = [(line, "en") for line in lines]
    got = C.collocations(made(spark, rows), Scratch(spark, "c"), 3, 90)
    assert sorted(tuple(r) for r in got.collect()) == expected(rows, 3, 90, 80) and len(waves) > 1


def test_nothing_to_find(spark):
    for rows in ([], [(None, None)], [("a b", "en")]):
        got = C.collocations(made(spark, rows), Scratch(spark, "c"))
        assert got.count() == 0 and got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_very_long_texts_in_parts():
    data = np.frombuffer(("ab cd. " * 1000).encode(), np.uint8)
    parts = list(C._pieces(data, np.array([0, len(data)]), 100))
    assert len(parts) > 10 and b"".join(p.tobytes() for p, _ in parts) == data.tobytes()
    assert all(p[-1] == ord(".") for p, _ in parts[:-1]) and all(len(p) < 120 for p, _ in parts)
    whole = np.frombuffer(b"ab " * 1000, np.uint8)
    assert len(list(C._pieces(whole, np.array([0, len(whole)]), 100))) == 1


def test_products_beyond_64_bits(spark):
    big = spark.createDataFrame([((1 << 62), (1 << 62) + 1, (1 << 62) + 3)], "a long, l long, r long")
    assert big.select(C.score("a", "l", "r")).first()[0] == 2000000 * (1 << 62) // ((1 << 63) + 4)


def test_words_of_one_hash_are_noticed(spark, monkeypatch):
    hashes = C._hashes
    monkeypatch.setattr(C, "_hashes", lambda d, f, s, seed: hashes(d, f, s, seed) % np.uint64(5 if seed < 1 else 1 << 63))
    rows = corpus(1, 60, 30)
    got = C.collocations(made(spark, rows), Scratch(spark, "c"), 2, 20)
    assert sorted(tuple(r) for r in got.collect()) == expected(rows, 2, 20, 80)
