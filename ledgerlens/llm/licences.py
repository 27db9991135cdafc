"""Licence notices in paragraphs: a trained classifier, calibrated, and confirmed by templates.

The classifier is a multinomial logistic regression over the presence of
hashed word n-grams of one to three words. It learns each family from its
templates with words left out at either end, and the class `unknown` from
paragraphs of the corpus that share no three words in a row with a template.
A temperature fitted on paragraphs that were held out of the fit calibrates
its probabilities. A prediction counts when its probability is high enough and
the paragraph holds enough of the three-word shingles of one of the family's
templates, more than of any other family's, with the same words that tell
families apart (such as `Lesser` or `NoDerivatives`) and the family's version.

A paragraph is a line, or the lines that a notice is wrapped over: lines without
a blank one between them are joined where a shingle of a template runs from one
into the next, or where shingles on both sides follow each other in a template.
So lines of other text, or another notice, next to a notice stay apart from it.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.columns import column
from ledgerlens.sources import Scratch

UNKNOWN = "unknown"
# Different paragraphs of the corpus that the unknown class is learned from, at most: of those that share no shingle with
# a template, those of the smallest hashes.
SAMPLE = 4000
_HASHES = 1 << 62
_HASHED_BITS = 12
# What a variant of a template weighs against a paragraph of the corpus, of which there are many more.
_WEIGHT = 10.0
_SHINGLE = 3
_FEATURES = _SHINGLE << _HASHED_BITS
# Words that are hashed at a time, and words whose codes a task keeps.
_BLOCK, _KEPT = 1 << 15, 1 << 18
# Words from the start of a shingle to that of the next one of a notice, at most, and words more or less than in the template.
_APART, _CHANGED = 8, 2
_WORD = re.compile(r"[^\W_]+")
# Words around a notice that belong to it, and words behind it that may name its version.
_AROUND, _BEHIND = 2, 20

# Words that tell families apart, and words that may follow a notice which is no sentence of its own.
_TELLING = frozenset("lesser library affero lgpl agpl nd noderivatives noderivs nc noncommercial sa sharealike".split())
_FOLLOWING = frozenset("by worldwide under throughout to in unless except".split())

# Notices by which works are put under a licence.
TEMPLATES: dict[str, list[str]] = {
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Released under the BSD License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ],
    "CC-BY": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ],
    "CC-BY-NC": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ],
    "CC-BY-NC-ND": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
        "Licensed under CC BY-NC-ND 4.0.",
    ],
    "CC-BY-NC-SA": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
        "Licensed under CC BY-NC-SA 4.0.",
    ],
    "CC-BY-ND": [
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
        "Licensed under CC BY-ND 4.0.",
    ],
    "CC-BY-SA": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-2.0-or-later",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "Proprietary": ["All rights reserved.", "Copyright. All rights reserved. Unauthorized copying is strictly prohibited."],
}


def licences(
    docs: DataFrame,
    scratch: Scratch,
    least_probability: float = 0.5,
    least_cover: float = 0.6,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample: int = SAMPLE,
) -> DataFrame:
    """(doc_id, paragraph, licence, probability, cover, confirmed): paragraphs (by their first lines, from 0) that a family is predicted for.

    `cover` is the share of the three-word shingles of the family's best
    template that the paragraph holds. `confirmed` asks for `least_cover`, for
    no less cover than any other family's, for the words around the notice that
    tell families apart to be those of the template, and for the version of the
    family's name, if it has one. Paragraphs of the unknown class give no row, so
    null and empty texts give none. Equal rows give equal rows, null ids stay
    null. Further columns are not read. Long texts are hashed in blocks of words.
    """
    source = docs.select(column(docs, id_col).alias("doc_id"), column(docs, text_col).cast("string").alias("text"))
    # A bound of how many different paragraphs there are; of those that are joined, it counts each line.
    marks = F.explode(F.split(column(docs, text_col), "\n")).alias("text")
    several = docs.select(marks).select(F.xxhash64("text").alias("mark")).distinct().count()
    model, families, temperature = _fit(_paragraphs(source), scratch, sample, several)
    fitted = model.stages[-1]
    # One number per hashed n-gram and family: its size does not depend on the corpus.
    sent = docs.sparkSession.sparkContext.broadcast(
        (np.ascontiguousarray(fitted.coefficientMatrix.toArray().T), fitted.interceptVector.toArray(), temperature, families)
    )
    places, firsts = _places()

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, biases, temperature, families = sent.value
        codes: dict[str, int] = {}
        for batch in batches:
            rows, found = [], []
            for row, text in enumerate(batch["text"]):
                text = text.as_py()
                if not text:
                    continue
                pieces = list(_pieces(text, places, firsts))
                for some, odds in _odds(pieces, codes, weights, biases):
                    odds /= temperature
                    best = odds.argmax(axis=1)
                    sure = 1 / np.exp(odds - odds.max(axis=1, keepdims=True)).sum(axis=1)
                    for k in np.flatnonzero((best > 0) & (sure >= least_probability)):
                        at, piece, _ = pieces[some + k]
                        family = families[best[k]]
                        rows.append(row)
                        found.append((at, family, float(sure[k]), *_compare(piece, family, least_cover)))
            columns = list(zip(*found)) or [[]] * 5
            kinds = (pa.int32(), pa.string(), pa.float64(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(rows, pa.int64())), *(pa.array(list(c), t) for c, t in zip(columns, kinds))],
                names=["doc_id", "paragraph", "licence", "probability", "cover", "confirmed"],
            )

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(read, f"doc_id {kind}, paragraph int, licence string, probability double, cover double, confirmed boolean")


def _keys(codes: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """Sorted different owner * _FEATURES + feature of the n-grams of words of one owner."""
    keys, mixed = [], codes
    for n in range(_SHINGLE):
        if n:
            mixed = mixed[:-1] * np.uint64(0x9E3779B97F4A7C15) + codes[n:]
        starts = owners[: max(0, len(owners) - n)]
        spread = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        bins = (spread >> np.uint64(64 - _HASHED_BITS)).astype(np.int64)
        keys.append((starts * _FEATURES + ((n << _HASHED_BITS) + bins))[owners[n:] == starts])
    return _different(np.concatenate(keys))


def _different(keys: np.ndarray) -> np.ndarray:
    """Different keys in order; sorting is several times as fast here as the hashing of np.unique."""
    keys.sort()
    return keys[np.r_[True, keys[1:] != keys[:-1]]] if len(keys) else keys


def _codes(words: list[str], known: dict[str, int]) -> np.ndarray:
    if len(known) > _KEPT:
        known.clear()
    for word in set(words):
        if word not in known:
            known[word] = zlib.crc32(word.encode("utf-8", "surrogatepass")) + 1
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def _features(text: str, known: dict[str, int]) -> np.ndarray:
    """The different features of a paragraph, in order; its words are hashed in blocks."""
    words = _WORD.findall(text.lower())
    found = []
    for k in range(0, max(1, len(words)), _BLOCK):
        codes = _codes(words[k : k + _BLOCK + _SHINGLE - 1], known)
        found.append(_keys(codes, np.zeros(len(codes), np.int64)))
    return _different(np.concatenate(found)) if len(found) > 1 else found[0]


def _odds(pieces: list[tuple[int, str, list[str] | None]], known: dict[str, int], weights: np.ndarray, biases: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(number of the first piece, scores of each family for it and the pieces behind it), some thousand words at a time.

    Pieces are given as (line, text, words); words that are None are found here, block by block.
    """
    begin, words, owners = 0, [], []

    def scores(keys: np.ndarray, n: int) -> np.ndarray:
        odds = np.tile(biases, (n, 1))
        if len(keys):
            owner, feature = np.divmod(keys, _FEATURES)
            firsts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            odds[owner[firsts]] += np.add.reduceat(weights.take(feature, axis=0), firsts)
        return odds

    def block(end: int) -> tuple[int, np.ndarray]:
        owner = np.repeat(np.arange(len(owners)), owners)
        return begin, scores(_keys(_codes(words, known), owner), end - begin)

    for k, (_, piece, own) in enumerate(pieces):
        if own is None and len(piece) <= 16 * _BLOCK:
            own = _WORD.findall(piece.lower())
        if owners and (own is None or len(words) + len(own) > _BLOCK):
            yield block(k)
            begin, words, owners = k, [], []
        if own is None or len(own) > _BLOCK:
            yield k, scores(_features(piece, known), 1)
            begin = k + 1
        else:
            words += own
            owners.append(len(own))
    if owners:
        yield block(len(pieces))


def _compare(text: str, family: str, least_cover: float) -> tuple[float, bool]:
    """(cover by the family's best template, whether the paragraph is confirmed to be of the family)."""
    lower = text.lower()
    spans = [m.span() for m in _WORD.finditer(lower)]
    words = [lower[a:b] for a, b in spans]
    at: dict[str, list[int]] = {}
    for i in range(max(1, len(words) - _SHINGLE + 1)):
        at.setdefault(" ".join(words[i : i + _SHINGLE]), []).append(i)
    best, others, agrees = 0.0, 0.0, False
    for name, templates in TEMPLATES.items():
        for template in templates:
            shingles = list(dict.fromkeys(_of(template)))
            cover = sum(s in at for s in shingles) / len(shingles)
            if name != family:
                others = max(others, cover)
                continue
            best = max(best, cover)
            if cover >= least_cover and not agrees:
                agrees = _agrees(text, words, spans, sorted(i for s in shingles for i in at.get(s, ())), family, template)
    return best, agrees and best >= others


def _agrees(text: str, words: list[str], spans: list[tuple[int, int]], hits: list[int], family: str, template: str) -> bool:
    """Whether the longest stretch of hits tells the same family as the template."""
    if not hits:
        return False
    stretches = [[hits[0]]]
    for i in hits[1:]:
        if i - stretches[-1][-1] > _APART:
            stretches.append([])
        stretches[-1].append(i)
    stretch = max(stretches, key=len)
    begin, end = stretch[0], min(len(words), stretch[-1] + _SHINGLE)
    near, own = words[max(0, begin - _AROUND) : end + _AROUND], set(_WORD.findall(template.lower()))
    if set(near) & _TELLING != own & _TELLING:
        return False
    version = re.search(r"-(\d+)\.\d+$", family)
    if version and version[1] in own:
        if version[1] not in near:
            return False
    elif version:
        named = [words[i + 1] for i in range(end, min(len(words) - 1, end + _BEHIND)) if words[i] in ("version", "v")]
        if any(x.isdigit() for x in named) and version[1] not in named:
            return False
    if len(own) <= _SHINGLE:
        # A notice this short is one only where its sentence ends, on any place that it stands.
        ends = (min(len(words), i + _SHINGLE) for i in hits)
        return any(k == len(words) or words[k] in _FOLLOWING or _breaks(text[spans[k - 1][1] : spans[k][0] + 1]) for k in ends)
    return True


def _breaks(between: str) -> bool:
    """Whether a sentence may end between two words; the first letter of the second is the last one of `between`."""
    return any(not c.isspace() for c in between[:-1]) or "\n" in between or not between[-1].islower()


def _places() -> tuple[dict[str, list[tuple[int, int]]], set[str]]:
    """(template, place in it) of each shingle of a template, and the first words of shingles."""
    places: dict[str, list[tuple[int, int]]] = {}
    for k, template in enumerate(t for ts in TEMPLATES.values() for t in ts):
        for at, shingle in enumerate(_of(template)):
            places.setdefault(shingle, []).append((k, at))
    return places, {s.split()[0] for s in places}


def _paragraphs(docs: DataFrame) -> DataFrame:
    """(doc_id, paragraph, text) of the paragraphs that are not blank."""
    places, firsts = _places()

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, at, texts = [], [], []
            for row, text in enumerate(batch["text"].to_pylist()):
                for line, piece in joined_lines(text, places, firsts) if text else ():
                    rows.append(row)
                    at.append(line)
                    texts.append(piece)
            ids = batch["doc_id"].take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(at, pa.int32()), pa.array(texts, pa.string())], names=["doc_id", "paragraph", "text"])

    return docs.mapInArrow(read, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, paragraph int, text string")


def joined_lines(text: str, places: dict[str, list[tuple[int, int]]], firsts: set[str]) -> list[tuple[int, str]]:
    """(first line, text) of each paragraph; `places` has (template, place in it) of each shingle, `firsts` their first words."""
    return [(line, piece) for line, piece, _ in _pieces(text, places, firsts)]


def _pieces(text: str, places: dict[str, list[tuple[int, int]]], firsts: set[str]) -> Iterator[tuple[int, str, list[str] | None]]:
    """(first line, text, words) of each paragraph; None for the words of long texts, of which only those of neighbouring lines are held."""
    lines = text.split("\n")
    joins = [False] * len(lines)
    words: list[str] = []
    lies: list[int] = []
    kept: list[list[str]] | None = [] if len(text) <= 16 * _BLOCK else None

    def close() -> None:
        before: tuple[int, list[tuple[int, int]]] | None = None
        for i in range(len(words) - _SHINGLE + 1):
            found = places.get(" ".join(words[i : i + _SHINGLE])) if words[i] in firsts else None
            if found is None:
                continue
            begin = i
            if before and i - before[0] <= _APART and any(
                k == k_ and p < p_ and abs(i - before[0] - (p_ - p)) <= _CHANGED for k, p in before[1] for k_, p_ in found
            ):
                begin = before[0]
            for line in range(lies[begin], lies[i + _SHINGLE - 1]):
                joins[line] = True
            before = (i, found)
        words.clear()
        lies.clear()

    for k, line in enumerate(lines):
        own = _WORD.findall(line.lower())
        if kept is not None:
            kept.append(own)
        if not own:
            close()
        words += own
        lies += [k] * len(own)
    close()
    k = 0
    while k < len(lines):
        begin = k
        while joins[k]:
            k += 1
        k += 1
        piece = lines[begin] if k == begin + 1 else "\n".join(lines[begin:k])
        if piece.strip(" "):
            yield begin, piece, None if kept is None else kept[begin] if k == begin + 1 else sum(kept[begin:k], [])


def _words() -> RegexTokenizer:
    return RegexTokenizer(inputCol="text", outputCol="l_words", pattern=r"[\p{L}\p{N}]+", gaps=False)


def _shingles(words: str) -> Column:
    """Three words in a row, or all of fewer."""
    n = F.greatest(F.size(words) - _SHINGLE + 1, F.lit(1))
    return F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(words, i, F.lit(_SHINGLE)), " "))


def _of(template: str) -> list[str]:
    words = _WORD.findall(template.lower())
    return [" ".join(words[i : i + _SHINGLE]) for i in range(max(1, len(words) - _SHINGLE + 1))]


def _variants(spark: SparkSession, families: list[str]) -> DataFrame:
    """(family label, text, held): templates, whole and without some words at either end."""
    rows = []
    for k, family in enumerate(families):
        for template in TEMPLATES.get(family, []):
            words = template.split()
            for a in range(0, max(1, len(words) // 3 + 1)):
                for b in range(len(words), max(a + 2, 2 * len(words) // 3) - 1, -1):
                    if b - a >= min(3, len(words)):
                        rows.append((float(k), " ".join(words[a:b]), (a + b) % 5 == 4))
    import pandas as pd

    return spark.createDataFrame(pd.DataFrame(rows, columns=["label", "text", "held"]))


def _others(lines: DataFrame, scratch: Scratch, sample: int, several: int) -> DataFrame:
    """The `sample` different paragraphs of the smallest hashes that share no shingle with a template, or all of fewer."""
    own = F.array(*(F.lit(s) for s in sorted({s for ts in TEMPLATES.values() for t in ts for s in _of(t)})))
    mark = F.pmod(F.xxhash64("text"), F.lit(_HASHES))
    part = min(1.0, (2 * sample + 100) / max(1, several))
    while True:
        # Only paragraphs whose hashes lie below a bound are told apart; it grows until enough of them are left.
        some = lines.select("text") if part == 1.0 else lines.select("text").filter(mark < int(part * _HASHES))
        other = _words().transform(some.distinct()).filter(F.size(F.array_intersect(_shingles("l_words"), own)) == 0)
        other = scratch.write(other.select("text").orderBy(mark, "text").limit(sample), "others")
        if part == 1.0 or other.count() == sample:
            return other
        part = min(1.0, 8 * part)


def _fit(lines: DataFrame, scratch: Scratch, sample: int, several: int) -> tuple[PipelineModel, list[str], float]:
    """The classifier, its classes in the order of its scores, and the temperature of its probabilities."""
    spark, families = lines.sparkSession, [UNKNOWN, *sorted(TEMPLATES)]
    other = _others(lines, scratch, sample, several)
    other = other.select(F.lit(0.0).alias("label"), "text", (F.pmod(F.xxhash64("text", F.lit(1)), F.lit(5)) == 4).alias("held"))
    rows = other.unionByName(_variants(spark, families))
    rows = rows.withColumn("weight", F.when(F.col("label") == 0, 1.0).otherwise(_WEIGHT))
    rows = scratch.write(rows.coalesce(4).withColumn("l_all", F.udf(_vector, VectorUDT())("text")), "training")
    stages = [
        LogisticRegression(
            featuresCol="l_all", labelCol="label", weightCol="weight", rawPredictionCol="l_raw", probabilityCol="", predictionCol="",
            family="multinomial", regParam=1e-4, standardization=False, maxIter=40,
        )
    ]
    model = Pipeline(stages=stages).fit(rows.filter("NOT held"))
    held = model.transform(rows.filter("held")).select(vector_to_array("l_raw").alias("raw"), F.col("label").cast("int").alias("label"))
    tried = [2.0 ** (k / 2) for k in range(-6, 9)]
    losses = held.agg(*(F.avg(_loss(t)).alias(f"t{k}") for k, t in enumerate(tried))).first()
    scored = [(x, t) for x, t in zip(losses, tried) if x is not None and math.isfinite(x)]
    return model, families, min(scored)[1] if scored else 1.0


def _vector(text: str) -> SparseVector:
    found = _features(text, {})
    return SparseVector(_FEATURES, found.tolist(), [1.0] * len(found))


def _loss(temperature: float) -> Column:
    most = F.array_max("raw")
    total = F.aggregate("raw", F.lit(0.0), lambda s, x: s + F.exp((x - most) / temperature))
    return F.log(total) - (F.element_at("raw", F.col("label") + 1) - most) / temperature
