"""Phrase collocations by best-first branch and bound.

Texts are read once into chunks: a dictionary of a chunk's words and the text as
places in it. Words and pairs of words are counted over all chunks. A phrase
grows from its first pair, and the counts of its prefixes bound the score of all
that can grow from it: with q the prefix and w its first word, no phrase from q
scores more than 2000000 f(q) / (f(w) + f(q)), as a phrase is no more frequent
than q and neither are its parts less frequent than itself.

The frontier is expanded best first: all prefixes whose own score or whose bound
reaches a mark of their language grow by one word, and once more. Then all
phrases that reach the mark are known, with all longer phrases that hold them.
Languages in which too few of them survive get a lower mark and are expanded
again. What a pass over the chunks must count is told to the tasks by Bloom
filters of bounded size; what they let through by mistake is counted in full, so
it costs time and changes nothing.

Words go by 64-bit hashes. Two words of a language with one hash would be
noticed where their strings meet, and the search begins anew with another hash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.columns import column
from ledgerlens.llm.words import binary_batches, mixed
from ledgerlens.sources import Scratch

LEAST, TOP, COVER, FACTOR = 30, 2000, 80, 2_000_000
NO_LANG = "und"
# Phrases above the first mark of a language, about, in multiples of the rows that are wanted, and growth from mark to mark.
_FIRST, _MORE = 2, 8
# Steps in which marks are looked for, bytes of text in a chunk, largest filter in bits, keys of a language's rows.
_STEP, _CHUNK, _BITS, _SALTS = 1000, 1 << 20, 1 << 28, 64

_BLANK, _BREAK = 1, 2
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[9, 32]] = _BLANK
_KIND[[*b".,;:!?\n\x0b\x0c\r"]] = _BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CHUNKS = "lang string, hashes array<long>, counts array<long>, names array<string>, words array<int>"
_NAMES = ("h1", "h2", "h3", "h4")


def collocations(
    docs: DataFrame,
    scratch: Scratch,
    least: int = LEAST,
    top: int = TOP,
    cover: int = COVER,
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the `top` phrases of two to four words of each language by score.

    Texts are split into pieces at `.,;:!?` and line ends, pieces at blanks and
    tabs into words, A to Z count as a to z. `a` counts a phrase within pieces,
    overlaps included, and is at least `least`; `n` counts the language's words.
    Of the cuts into two parts with counts `l` and `r`, the one of the lowest
    floor(2000000 a / (l + r)) counts, the first of those that tie. A phrase
    goes if one that is longer, holds its words in a row and is frequent enough
    has `cover` % of its count or more. Ranks go by score, count and the bytes
    of the phrase.

    Null and empty texts have no words; a null language is `und`. Rows that
    repeat count each time. A table without frequent phrases gives no rows.
    Further columns are not read. A task holds a chunk of text, which ends at
    the end of a piece: memory grows with the longest piece, not the text.
    """
    for seed in range(8):
        chunks = scratch.write(_chunks(docs, text_col, lang_col, seed), "chunks")
        words = _words(chunks, least, scratch)
        if words.filter("word <> other").isEmpty():
            return _search(chunks, words.drop("other"), scratch, least, top, cover)
        scratch.drop(chunks)
    raise RuntimeError("words of one language share a hash under every seed")


# Chunks


def _chunks(docs: DataFrame, text_col: str, lang_col: str, seed: int) -> DataFrame:
    source = docs.select(
        F.coalesce(column(docs, lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"), column(docs, text_col).cast("binary").alias("text")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch["lang"].to_pylist(), dtype=object)
            for first, data, offsets in binary_batches(batch["text"], _CHUNK):
                for part, bounds in _pieces(data, offsets):
                    yield from _chunk(part, bounds, langs[first : first + len(bounds) - 1], seed)

    return source.mapInArrow(run, _CHUNKS)


def _pieces(data: np.ndarray, offsets: np.ndarray, size: int = _CHUNK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A run of texts as it is, or a very long text in parts that end where pieces do."""
    if len(offsets) != 2 or len(data) <= 2 * size:
        yield data, offsets
        return
    breaks, at = np.flatnonzero(_KIND[data] == _BREAK), 0
    while at < len(data):
        place = np.searchsorted(breaks, at + size)
        end = int(breaks[place]) + 1 if place < len(breaks) else len(data)
        yield data[at:end], np.array([0, end - at])
        at = end


def _chunk(data: np.ndarray, bounds: np.ndarray, langs: np.ndarray, seed: int) -> Iterator[pa.RecordBatch]:
    """A row for each language of the texts: its different words, and its texts as places in them, 0 where a piece ends."""
    if not len(data):
        return
    data = _LOWER[data]
    kind = _KIND[data]
    filled = kind == 0
    begins, ends = filled.copy(), filled.copy()
    begins[1:] &= ~filled[:-1]
    ends[:-1] &= ~filled[1:]
    # Texts lie side by side: a word ends where its text does.
    inner = bounds[1:-1][(bounds[1:-1] > 0) & (bounds[1:-1] < len(data))]
    begins[inner] = filled[inner]
    ends[inner - 1] = filled[inner - 1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    if not len(starts):
        return
    hashes = _hashes(data, filled, starts, seed)
    text = np.searchsorted(bounds, starts, side="right") - 1
    breaks = np.cumsum(kind == _BREAK)[starts]
    fresh = np.ones(len(starts), dtype=bool)
    fresh[1:] = (breaks[1:] != breaks[:-1]) | (text[1:] != text[:-1])
    of_word = langs[text]
    whole = data.tobytes()
    for lang in sorted(set(langs)):
        own = np.flatnonzero(of_word == lang)
        if not len(own):
            continue
        found, first, places, counts = np.unique(hashes[own], return_index=True, return_inverse=True, return_counts=True)
        names = [whole[a:b].decode("utf-8", "replace") for a, b in zip(starts[own[first]].tolist(), stops[own[first]].tolist())]
        words = np.zeros(len(own) + int(fresh[own].sum()), dtype=np.int32)
        words[np.arange(len(own)) + np.cumsum(fresh[own])] = places + 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang], pa.string()),
                _list(found.view(np.int64)),
                _list(counts.astype(np.int64)),
                pa.array([names], pa.list_(pa.string())),
                _list(words),
            ],
            names=["lang", "hashes", "counts", "names", "words"],
        )


def _hashes(data: np.ndarray, filled: np.ndarray, starts: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of each word: its bytes as a polynomial, mixed."""
    lead = starts[0]
    base = mixed(np.array([seed], np.uint64))[0] * np.uint64(2) + np.uint64(0x9E3779B97F4A7C15)
    place = np.arange(lead, len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    powers = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(int(place.max()), base)]))
    value = (data[lead:].astype(np.uint64) + np.uint64(1)) * powers[place]
    value[~filled[lead:]] = 0
    return mixed(np.add.reduceat(value, starts - lead))


def _list(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.array([0, len(values)], np.int32), pa.array(values))


def _words(chunks: DataFrame, least: int, scratch: Scratch) -> DataFrame:
    """(lang, h1, word, other, f) of the frequent words; word and other differ where two words share a hash."""
    seen = chunks.select("lang", F.inline(F.arrays_zip("hashes", "counts", "names")))
    counted = seen.groupBy("lang", F.col("hashes").alias("h1")).agg(
        F.sum("counts").alias("f"), F.min("names").alias("word"), F.max("names").alias("other")
    )
    return scratch.write(counted.filter((F.col("f") >= least) | (F.col("word") != F.col("other"))), "words")


# Filters


def _keys(langs: np.ndarray, hashes: list[np.ndarray]) -> np.ndarray:
    """A 64-bit key of a phrase in its language."""
    key = langs
    for h in hashes:
        key = mixed(key ^ h.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)
    return mixed(key)


def _of_lang(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(lang.encode()))


def _slots(keys: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The bits of a filter of 64 * size bits that stand for the keys."""
    step = (keys >> np.uint64(32)) | np.uint64(1)
    for probe in range(4):
        yield (keys + np.uint64(probe) * step) & np.uint64(64 * size - 1)


def _has(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    found = np.ones(len(keys), dtype=bool)
    for slot in _slots(keys, len(bits)):
        found &= (bits[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)
    return found


def _filter(phrases: DataFrame, size: int):
    """A broadcast Bloom filter of the (lang, h1, ...) rows. It has 16 bits a row, at most 32 MB, and at least one block."""
    names = _NAMES[:size]
    wanted = max(1, 16 * phrases.count())
    length = min(_BITS, 1 << max(10, (wanted - 1).bit_length())) // 64

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(length, np.uint64)
        for batch in batches:
            langs = batch["lang"].dictionary_encode()
            of = np.array([_of_lang(x) for x in langs.dictionary.to_pylist()], np.uint64)
            keys = _keys(of[langs.indices.to_numpy()], [batch[c].to_numpy() for c in names]) if len(batch) else np.zeros(0, np.uint64)
            for slot in _slots(keys, length):
                np.bitwise_or.at(bits, (slot >> np.uint64(6)).astype(np.int64), np.uint64(1) << (slot & np.uint64(63)))
        used = np.flatnonzero(bits)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(bits[used].view(np.int64))], names=["slot", "bits"])

    parts = phrases.select("lang", *names).mapInArrow(run, "slot long, bits long")
    found = parts.groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(length, np.uint64)
    bits[found["slot"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return phrases.sparkSession.sparkContext.broadcast(bits)


# Passes over the chunks


class _Chunk:
    """The phrases of one chunk by number: `place` says which starts at each word, -1 where none does."""

    def __init__(self, lang: str, hashes: np.ndarray, words: np.ndarray):
        self.lang, self.words = np.array([_of_lang(lang)], np.uint64), words.astype(np.int64) - 1
        self.place, self.names = self.words, [hashes]

    def keys(self) -> np.ndarray:
        return _keys(self.lang, self.names)

    def grown(self, usable: np.ndarray) -> np.ndarray:
        """Go on to phrases that are a word longer, where `usable` says so; how often each occurs."""
        size = len(self.names)
        last = self.words[size:]
        at = np.flatnonzero(usable[: len(last)] & (self.place[: len(last)] >= 0) & (last >= 0))
        width = np.int64(len(self.names[0]) if size == 1 else self._width)
        codes, numbers, counts = np.unique(self.place[at] * width + last[at], return_inverse=True, return_counts=True)
        before, added = codes // width, codes % width
        if size == 1:
            self._width, self._single = len(self.names[0]), self.names[0]
        self.place = np.full(len(self.words), -1, np.int64)
        self.place[at] = numbers
        self.names = [*(h[before] for h in self.names), self._single[added]]
        return counts

    def of(self, flags: np.ndarray, shift: int = 0) -> np.ndarray:
        """The flag of the phrase that starts at each word, or `shift` words on."""
        out = np.zeros(len(self.words), dtype=bool)
        place = self.place[shift:]
        out[: len(place)] = (place >= 0) & (flags[place] if len(flags) else False)
        return out


def _counted(chunks: DataFrame, size: int, count, least: int) -> DataFrame:
    """(lang, h1, ..., f) of the phrases that `count` finds in chunks, those that are frequent."""
    names = _NAMES[:size]
    schema = "lang string, " + "".join(f"{c} long, " for c in names) + "f long"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, hashes, words in zip(batch["lang"], batch["hashes"], batch["words"]):
                chunk = _Chunk(lang.as_py(), hashes.values.to_numpy(), words.values.to_numpy())
                counts, found = count(chunk)
                if len(counts):
                    langs = pa.DictionaryArray.from_arrays(np.zeros(len(counts), np.int8), [lang.as_py()]).cast(pa.string())
                    yield pa.RecordBatch.from_arrays([langs, *map(pa.array, found), pa.array(counts)], names=["lang", *names, "f"])

    rows = chunks.select("lang", "hashes", "words").mapInArrow(run, schema)
    return rows.groupBy("lang", *names).agg(F.sum("f").alias("f")).filter(F.col("f") >= least)


def _pairs(chunks: DataFrame, words: DataFrame, least: int) -> DataFrame:
    """Pairs of frequent words."""
    known = _filter(words, 1)

    def count(chunk: _Chunk):
        frequent = _has(known.value, chunk.keys())
        counts = chunk.grown(chunk.of(frequent) & chunk.of(frequent, 1))
        return counts, chunk.names

    return _counted(chunks, 2, count, least)


def _triples(chunks: DataFrame, pairs, prefixes, suffixes, least: int) -> DataFrame:
    """Triples of frequent pairs that begin with one of the prefixes or end with one of the suffixes."""

    def count(chunk: _Chunk):
        chunk.grown(np.ones(len(chunk.words), dtype=bool))
        keys = chunk.keys()
        frequent = _has(pairs.value, keys)
        wanted = chunk.of(frequent & _has(prefixes.value, keys)) | chunk.of(frequent & _has(suffixes.value, keys), 1)
        counts = chunk.grown(wanted & chunk.of(frequent) & chunk.of(frequent, 1))
        return counts, chunk.names

    return _counted(chunks, 3, count, least)


def _named_triples(chunks: DataFrame, pairs, named, least: int) -> DataFrame:
    """Triples out of a filter, and some more."""

    def count(chunk: _Chunk):
        chunk.grown(np.ones(len(chunk.words), dtype=bool))
        frequent = _has(pairs.value, chunk.keys())
        counts = chunk.grown(chunk.of(frequent) & chunk.of(frequent, 1))
        kept = _has(named.value, chunk.keys())
        return counts[kept], [h[kept] for h in chunk.names]

    return _counted(chunks, 3, count, least)


def _fours(chunks: DataFrame, pairs, prefixes, suffixes, least: int) -> DataFrame:
    """Phrases of four words that begin with one of the prefixes or end with one of the suffixes."""

    def count(chunk: _Chunk):
        chunk.grown(np.ones(len(chunk.words), dtype=bool))
        frequent = _has(pairs.value, chunk.keys())
        chunk.grown(chunk.of(frequent) & chunk.of(frequent, 1))
        keys = chunk.keys()
        every = np.ones(len(keys), dtype=bool)
        wanted = chunk.of(_has(prefixes.value, keys)) | chunk.of(_has(suffixes.value, keys), 1)
        counts = chunk.grown(wanted & chunk.of(every, 1))
        return counts, chunk.names

    return _counted(chunks, 4, count, least)


# Scores


def score(a: str, l: str, r: str) -> Column:  # noqa: E741
    """floor(2000000 a / (l + r)) in decimals, which hold products that pass 64 bits."""
    whole = "cast({} as decimal(20, 0))".format
    return F.expr(f"(cast({FACTOR} as decimal(17, 0)) * {whole(a)}) div ({whole(l)} + {whole(r)})")


def _lowest(*cuts: tuple[str, str]) -> Column:
    """(score, k, l, r) of the cut that counts."""
    found = [F.struct(score("a", l, r).alias("score"), F.lit(k + 1).alias("k"), F.col(l).alias("l"), F.col(r).alias("r")) for k, (l, r) in enumerate(cuts)]
    return F.array_min(F.array(*found))


def _known(phrases: DataFrame, counts: DataFrame, at: tuple[str, ...], name: str, how: str = "inner") -> DataFrame:
    """The rows with the count of a part of theirs, given by its columns."""
    parts = counts.select("lang", *(F.col(own).alias(c) for own, c in zip(_NAMES, at)), F.col("f").alias(name))
    return phrases.join(parts, ["lang", *at], how)


def _scored(phrases: DataFrame, size: int, *cuts: tuple[str, str]) -> DataFrame:
    """(lang, h1, ..., a, first, score, l, r, most): score by the cuts, and the most that anything grown from the phrase scores."""
    best = phrases.withColumn("best", _lowest(*cuts))
    return best.select("lang", *_NAMES[:size], "a", "first", "best.score", "best.l", "best.r", score("a", "first", "a").alias("most"))


def _search(chunks: DataFrame, words: DataFrame, scratch: Scratch, least: int, top: int, cover: int) -> DataFrame:
    totals = chunks.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda x, y: x + y)).alias("n"))
    pairs = scratch.write(_pairs(chunks, words, least), "pairs")
    both = _known(_known(pairs.withColumnRenamed("f", "a"), words, ("h1",), "first"), words, ("h2",), "last")
    scored = scratch.write(_scored(both, 2, ("first", "last")), "scored-pairs")
    frequent = _filter(pairs, 2)
    open_, settled, want = scored.select("lang").distinct(), [], _FIRST * top
    while True:
        marks = scratch.write(_marks(scored, open_, want), "marks")
        if marks.isEmpty():
            break
        found = scratch.write(_wave(chunks, words, pairs, scored, frequent, marks, scratch, least, cover), "survivors")
        enough = found.groupBy("lang").agg(F.count("*").alias("survivors"))
        state = marks.join(enough, "lang", "left").withColumn("done", (F.coalesce("survivors", F.lit(0)) >= top) | (F.col("mark") == 0))
        state = scratch.write(state, "state")
        settled.append(found.join(state.filter("done").select("lang"), "lang", "left_semi"))
        open_, want = state.filter("NOT done").select("lang"), want * _MORE
    survivors = settled[0] if settled else _no_survivors(scored)
    for more in settled[1:]:
        survivors = survivors.unionByName(more)
    return _ranked(survivors, words, totals, scratch, top)


def _marks(scored: DataFrame, langs: DataFrame, want: int) -> DataFrame:
    """(lang, mark): a score that about `want` pairs of the language reach, 0 where it has fewer."""
    steps = scored.join(langs, "lang", "left_semi").groupBy("lang", F.floor(F.col("score") / _STEP).alias("step")).count()
    upto = F.sum("count").over(Window.partitionBy("lang").orderBy(F.desc("step")))
    reached = F.max(F.when(F.col("upto") >= want, F.col("step") * _STEP))
    return steps.withColumn("upto", upto).groupBy("lang").agg(F.coalesce(reached, F.lit(0)).cast("long").alias("mark"))


def _wave(chunks, words, pairs, scored, frequent, marks, scratch: Scratch, least: int, cover: int) -> DataFrame:
    """The surviving phrases that reach the mark of their language."""
    own = chunks.join(marks.select("lang"), "lang", "left_semi")
    twos = scored.join(marks, "lang")
    reach = twos.filter("score >= mark")
    open_twos = twos.filter("greatest(score, most) >= mark")
    threes = scratch.write(_triples(own, frequent, _filter(open_twos, 2), _filter(reach, 2), least), "triples")

    grown = _known(_known(threes.withColumnRenamed("f", "a"), words, ("h1",), "first"), words, ("h3",), "third")
    grown = _known(_known(grown, pairs, ("h1", "h2"), "front"), pairs, ("h2", "h3"), "back")
    scored_threes = scratch.write(_scored(grown, 3, ("first", "back"), ("front", "third")).join(marks, "lang"), "scored-triples")
    reach_threes = scored_threes.filter("score >= mark")
    fours = _fours(own, frequent, _filter(scored_threes.filter("most >= mark"), 3), _filter(reach_threes, 3), least)
    fours = scratch.write(fours, "fours")

    # Prefixes that are not known are below the mark, and so is all that grows from them.
    grown = _known(fours.withColumnRenamed("f", "a"), threes, ("h1", "h2", "h3"), "front3").join(marks, "lang")
    grown = _known(_known(grown, words, ("h1",), "first"), words, ("h4",), "fourth")
    grown = _known(_known(grown, pairs, ("h1", "h2"), "front2"), pairs, ("h3", "h4"), "back2")
    bound = F.least(score("a", "first", "a"), score("a", "front2", "back2"), score("a", "front3", "fourth"))
    grown = scratch.write(grown.filter(bound >= F.col("mark")), "grown")
    backs = grown.select("lang", F.col("h2").alias("h1"), F.col("h3").alias("h2"), F.col("h4").alias("h3")).distinct()
    missing = scratch.write(backs.join(threes, ["lang", *_NAMES[:3]], "left_anti"), "missing")
    if not missing.isEmpty():
        more = _named_triples(own, frequent, _filter(missing, 3), least)
        threes_known = scratch.write(threes.unionByName(more.join(missing, ["lang", *_NAMES[:3]], "left_semi")), "more-triples")
    else:
        threes_known = threes
    full = _known(grown, threes_known, ("h2", "h3", "h4"), "back3")
    scored_fours = _scored(full, 4, ("first", "back3"), ("front2", "back2"), ("front3", "fourth")).join(marks, "lang")

    kept = [
        _uncovered(reach, threes, 2, cover),
        _uncovered(reach_threes, fours, 3, cover),
        scored_fours.filter("score >= mark"),
    ]
    survivors = [_padded(rows) for rows in kept]
    return survivors[0].unionByName(survivors[1]).unionByName(survivors[2])


def _uncovered(phrases: DataFrame, longer: DataFrame, size: int, cover: int) -> DataFrame:
    """The phrases that no phrase a word longer holds `cover` % as often or more.

    Those that are still longer need not be looked at: what they hold of a word
    more than the phrase is at least as frequent as they are.
    """
    names = _NAMES[:size]
    ends = [longer.select("lang", *(F.col(c).alias(own) for own, c in zip(names, _NAMES[shift:])), "f") for shift in (0, 1)]
    most = ends[0].unionByName(ends[1]).groupBy("lang", *names).agg(F.max("f").alias("longer"))
    share = F.expr(f"cast(100 as decimal(10, 0)) * cast(longer as decimal(20, 0)) >= cast({int(cover)} as decimal(10, 0)) * cast(a as decimal(20, 0))")
    return phrases.join(most, ["lang", *names], "left").filter(~F.coalesce(share, F.lit(False)))


def _padded(phrases: DataFrame) -> DataFrame:
    return phrases.select("lang", *(F.col(c) if c in phrases.columns else F.lit(None).cast("long").alias(c) for c in _NAMES), "a", "l", "r", "score")


def _no_survivors(scored: DataFrame) -> DataFrame:
    return _padded(scored.limit(0))


def _ranked(survivors: DataFrame, words: DataFrame, totals: DataFrame, scratch: Scratch, top: int) -> DataFrame:
    """The first rows of each language. A language's rows are dealt over many tasks before one sees the first of each."""
    salt = F.pmod(F.xxhash64(*_NAMES), F.lit(_SALTS))

    def first(rows: DataFrame, *order) -> DataFrame:
        dealt = rows.withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
        few = dealt.filter(F.col("place") <= top).drop("place")
        return few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)

    dealt = survivors.withColumn("salt", salt)
    last = first(dealt.select("lang", "salt", "score", "a"), F.desc("score"), F.desc("a"))
    last = last.groupBy("lang").agg(F.min(F.struct("score", "a")).alias("last"))
    rows = dealt.join(last, "lang").filter(F.struct("score", "a") >= F.col("last"))
    for i, name in enumerate(_NAMES, 1):
        spelt = words.select("lang", F.col("h1").alias(name), F.col("word").alias(f"w{i}"))
        rows = rows.join(spelt, ["lang", name], "left")
    rows = rows.withColumn("phrase", F.concat_ws(" ", *(f"w{i}" for i in range(1, 5))))
    rows = scratch.write(rows.select("lang", "salt", "phrase", "a", "l", "r", "score"), "spelt")
    ranked = first(rows, F.desc("score"), F.desc("a"), "phrase").join(totals, "lang")
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
