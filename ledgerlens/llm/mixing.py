"""Temperature mixing of sources, realised as budgeted permutations of blocks.

A source's weight is its share of the tokens, raised to an exponent and
normalised. Exponent 1 keeps the shares, 0 makes all sources equal. The
exponent is found by bisection: the largest that reaches a target entropy, but
never so small that a source would have to be repeated more often than the
limit. The budget is such that the source with the fewest repeats is read once
from end to end, so no document is left out.

A source of weight w then owes w * budget tokens: whole passes over all its
documents and a part of one more. Its documents lie in blocks of about
`block_tokens` tokens, each pass has a permutation of the blocks of its own,
and the last pass takes blocks in that order until its budget is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.columns import column, free_names, n_words
from ledgerlens.sources import Scratch

BLOCK_TOKENS = 1 << 16
MAX_REPEATS = 1.25
TARGET_EVENNESS = 0.9
_GRID = 33


def mix(
    docs: DataFrame,
    scratch: Scratch,
    source_col: str = "source",
    id_col: str = "doc_id",
    text_col: str = "text",
    max_repeats: float = MAX_REPEATS,
    evenness: float | None = TARGET_EVENNESS,
    block_tokens: int = BLOCK_TOKENS,
    seed: int = 1,
) -> tuple[DataFrame, list[str]]:
    """One row for each time a document is read, with five more columns, and the names these got.

    They are tokens (words and an end mark), weight (of the source), pass (from
    1), block and place: rows in ascending place, 0 to 1, are the mixture, and
    every stretch of it holds the sources by their weights. `evenness` is the
    target entropy as a part of the largest possible. A null source is a source
    of its own; a null or empty text counts one token. Rows of one id and text
    share a block. An empty table stays empty. Further columns pass through.
    """
    names = free_names(docs, "tokens", "weight", "pass", "block", "place")
    tokens, weight, pass_, block, place = names
    key, n_blocks, passes, part, turns, u, taken = free_names(
        docs, "m_key", "m_blocks", "m_passes", "m_part", "m_turns", "m_u", "m_taken"
    )
    counted = docs.withColumn(tokens, n_words(f"`{text_col}`") + 1)
    sources = counted.groupBy(column(counted, source_col).alias(key)).agg(F.sum(tokens).alias("t"))
    sources = scratch.write(sources, "sources")
    largest = sources.agg(F.max("t")).first()[0] or 1
    sources = sources.withColumn("share", F.col("t") / F.lit(float(largest)))
    alpha = exponent(sources, max_repeats, evenness)
    raised = F.pow("share", F.lit(alpha))
    norm = sources.agg(F.sum(raised)).first()[0] or 1.0
    read = raised / F.col("share")
    sources = scratch.write(
        sources.select(
            key,
            (raised / F.lit(norm)).alias(weight),
            read.alias(turns),
            F.floor(read).cast("int").alias(passes),
            ((read - F.floor(read)) * F.col("t")).alias(part),
            F.ceil(F.col("t") / block_tokens).cast("int").alias(n_blocks),
        ),
        "weights",
    )
    placed = counted.join(sources, column(counted, source_col).eqNullSafe(F.col(key)))
    own = F.xxhash64(column(placed, id_col), column(placed, text_col), F.lit(seed))
    placed = placed.withColumn(block, F.pmod(own, F.col(n_blocks)).cast("int"))
    last = _last_pass(placed, sources, key, block, tokens, passes, part, n_blocks, u, taken, seed)
    last = scratch.write(last, "last-pass")
    again = last.select(F.col(key).alias(key + "2"), F.col(block).alias(block + "2"), F.lit(1).alias(taken))
    same = F.col(key).eqNullSafe(F.col(key + "2")) & (F.col(block) == F.col(block + "2"))
    placed = placed.join(again, same, "left")
    times = F.col(passes) + F.coalesce(F.col(taken), F.lit(0))
    placed = placed.withColumn(pass_, F.explode(F.sequence(F.lit(1), times)))
    turn = _unit(F.xxhash64(key, block, pass_, F.lit(seed)))
    placed = placed.withColumn(place, (F.col(pass_) - 1 + turn) / F.greatest(F.col(turns), F.col(pass_)))
    return placed.select(*(column(placed, c) for c in docs.columns), *names), names


def exponent(sources: DataFrame, max_repeats: float, evenness: float | None) -> float:
    """The exponent for sources with a column `share`, their tokens as a part of the largest source's."""
    n, least = sources.agg(F.count("*"), F.min("share")).first()
    if n < 2:
        return 1.0
    low = 0.0 if evenness is None else _by_entropy(sources, evenness, n)
    if evenness is None or least ** (low - 1) > max_repeats:
        # Repeats of the smallest source fall as the exponent grows.
        a, b = low, 1.0
        for _ in range(60):
            middle = (a + b) / 2
            a, b = (middle, b) if least ** (middle - 1) > max_repeats else (a, middle)
        return b
    return low


def _by_entropy(sources: DataFrame, evenness: float, n: int) -> float:
    """The largest exponent whose entropy reaches the target; each pass over the sources tries a grid of them."""
    import math

    target, a, b = evenness * math.log(n), 0.0, 1.0
    for _ in range(6):
        tried = [a + (b - a) * k / (_GRID - 1) for k in range(_GRID)]
        sums = []
        for x in tried:
            raised = F.pow("share", F.lit(x))
            sums += [F.sum(raised), F.sum(raised * F.log("share"))]
        found = sources.agg(*(s.alias(f"s{k}") for k, s in enumerate(sums))).first()
        # Entropy of the weights raised / z is log z less the mean of log raised.
        reached = [
            math.log(found[2 * k]) - x * found[2 * k + 1] / found[2 * k] >= target for k, x in enumerate(tried)
        ]
        if reached[-1]:
            return tried[-1]
        if not reached[0]:
            return tried[0]
        k = max(i for i, ok in enumerate(reached) if ok)
        a, b = tried[k], tried[k + 1]
    return a


def _last_pass(placed, sources, key, block, tokens, passes, part, n_blocks, u, taken, seed) -> DataFrame:
    """(key, block) of the blocks that the last pass of each source reads."""
    blocks = placed.groupBy(key, block).agg(
        F.sum(tokens).alias(tokens), F.first(passes).alias(passes), F.first(part).alias(part), F.first(n_blocks).alias(n_blocks)
    )
    blocks = blocks.filter(F.col(part) > 0).withColumn(u, _unit(F.xxhash64(key, block, F.col(passes) + 1, F.lit(seed))))
    # Running sums in two steps, so that a source of very many blocks isn't ordered in one place.
    blocks = blocks.withColumn("m_group", F.floor(F.col(u) * F.ceil(F.col(n_blocks) / 64)))
    groups = blocks.groupBy(key, "m_group").agg(F.sum(tokens).alias("m_total"))
    before = Window.partitionBy(key).orderBy("m_group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select(
        F.col(key).alias("m_key2"), F.col("m_group").alias("m_group2"), F.coalesce(F.sum("m_total").over(before), F.lit(0)).alias("m_base")
    )
    within = Window.partitionBy(key, "m_group").orderBy(u, block).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("m_inside", F.coalesce(F.sum(tokens).over(within), F.lit(0)))
    same = F.col(key).eqNullSafe(F.col("m_key2")) & (F.col("m_group") == F.col("m_group2"))
    return blocks.join(groups, same).filter(F.col("m_base") + F.col("m_inside") < F.col(part)).select(key, block)


def _unit(hash_):
    """A hash as a number from 0 to 1, 1 excluded."""
    return F.pmod(hash_, F.lit(1 << 40)) / F.lit(float(1 << 40))
