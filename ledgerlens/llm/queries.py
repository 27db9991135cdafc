"""The operators of this subpackage as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import (
    bpe,
    collocations,
    language,
    leaks,
    licences,
    mixing,
    near_copies,
    pages,
    passages,
    quality,
    tokens,
    vectors,
    whitening,
)
from ledgerlens.sources import Scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents encoded to shard files and read back from them."""
    files = tokens.write_token_shards(
        table(spark, sf_dir, "documents"), tokenizer_path(), Scratch(spark, "tokens"), end_id=0
    )
    return tokens.read_token_shards(spark, files).drop("shard")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return pages.extract(table(spark, sf_dir, "pages"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their quality; those below one half are rejected."""
    docs = table(spark, sf_dir, "documents")
    scored, names = quality.quality(docs, table(spark, sf_dir, "labels"), Scratch(spark, "quality"))
    evidence, host, path, final = names
    return scored.select("doc_id", "source", "lang", evidence, host, path, final, (F.col(final) >= 0.5).alias("kept"))


def op4_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each reading of a document in the mixture of sources."""
    mixed, names = mixing.mix(table(spark, sf_dir, "documents"), Scratch(spark, "mixing"))
    return mixed.select("doc_id", "source", *names)


def op5_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in documents."""
    return leaks.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors with the number of their links and their component."""
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"), Scratch(spark, "vectors"))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the component of near copies that each belongs to."""
    return near_copies.near_copies(table(spark, sf_dir, "documents"), Scratch(spark, "near-copies"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    may_train = F.col("doc_id").isNotNull() & ~language.held_out()
    return language.predict(docs, language.train(docs, may_train))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one holds."""
    return passages.without_repeats(table(spark, sf_dir, "documents"), Scratch(spark, "passages"))


def op10_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs that put a document under a licence."""
    return licences.licences(table(spark, sf_dir, "documents"), Scratch(spark, "licences"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings on their leading components, with unit variance."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), Scratch(spark, "whitening"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of each language."""
    return collocations.collocations(table(spark, sf_dir, "documents"), Scratch(spark, "collocations"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every document and of the bytes that they decode to."""
    import public_tokenizers

    files = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe.digests(bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), *files), *files))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_records": op1_token_records,
    "op2_html_extraction": op2_html_extraction,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_temperature_mixing": op4_temperature_mixing,
    "op5_benchmark_leaks": op5_benchmark_leaks,
    "op6_nn_descent": op6_nn_descent,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_language_id": op8_language_id,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_licence_scan": op10_licence_scan,
    "op11_whitening": op11_whitening,
    "op12_collocations": op12_collocations,
    "op13_byte_bpe": op13_byte_bpe,
}

# SQL that gives a query's rows, where SQL can express them.
ORACLE: dict[str, str] = {
    "op12_collocations": r"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
),
split AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts),
pieces AS (SELECT lang, [x FOR x IN string_split_regex(piece, '[ \t]+') IF x <> ''] AS w FROM split),
counted AS MATERIALIZED (
  SELECT lang, k, p, count(*) AS f
  FROM (
    SELECT lang, k, unnest([w[i:i + k - 1] FOR i IN range(1, len(w) - k + 2)]) AS p
    FROM pieces, (VALUES (1), (2), (3), (4)) AS sizes(k)
    WHERE len(w) >= k
  )
  GROUP BY lang, k, p
),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE k = 1 GROUP BY lang),
candidates AS MATERIALIZED (SELECT lang, k, p, f AS a FROM counted WHERE k > 1 AND f >= 30),
inside AS (
  SELECT lang, p[i:i + m - 1] AS p, max(a) AS longer
  FROM candidates, (VALUES (2, 1), (2, 2), (2, 3), (3, 1), (3, 2)) AS parts(m, i)
  WHERE m < k AND i + m - 1 <= k
  GROUP BY lang, p[i:i + m - 1]
),
parted AS (
  SELECT lang, p, a, cut, p[1:cut] AS front, p[cut + 1:] AS back
  FROM candidates, (VALUES (1), (2), (3)) AS places(cut)
  WHERE cut < k
),
cuts AS (
  SELECT parted.lang, parted.p, a, cut, l.f AS l, r.f AS r, ((2000000::HUGEINT * a) // (l.f::HUGEINT + r.f))::BIGINT AS score
  FROM parted
  JOIN counted AS l ON l.lang = parted.lang AND l.p = front
  JOIN counted AS r ON r.lang = parted.lang AND r.p = back
),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1),
surviving AS (
  SELECT lowest.lang, array_to_string(lowest.p, ' ') AS phrase, a, l, r, score
  FROM lowest LEFT JOIN inside ON inside.lang = lowest.lang AND inside.p = lowest.p
  WHERE NOT coalesce(100::HUGEINT * longer >= 80::HUGEINT * a, false)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM surviving JOIN totals USING (lang)
QUALIFY rank <= 2000
""",
}
