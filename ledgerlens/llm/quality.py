"""Quality of documents: a text classifier's evidence under empirical Bayes priors of host and path.

The classifier is a logistic regression over hashed words and a few measures
of style. Its probabilities, summed over all documents, give each path of a
host and each host its share of good documents. A path's share is shrunk to
its host's, a host's to the whole corpus's; how strongly follows from how much
more shares differ between sites than chance explains (beta-binomial moments).
A document's odds are the classifier's, with the site's prior in place of that
of the training sample. Its own probability is left out of its site's share.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer, RegexTokenizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.columns import WORD, column, free_names
from ledgerlens.sources import Scratch

# Labelled documents that the classifier is fitted on, at most: those of the smallest hashes.
SAMPLE = 6000
_HASHED = 1 << 14
_STYLE = ["style_upper", "style_mark", "style_distinct", "style_long", "style_size"]


@dataclass
class Priors:
    """Shares of good documents over the corpus and how many documents a prior counts for."""

    share: float
    host_weight: float
    path_weight: float


def quality(
    docs: DataFrame,
    labels: DataFrame,
    scratch: Scratch,
    host_col: str = "source",
    path_col: str = "lang",
    id_col: str = "doc_id",
    text_col: str = "text",
    sample: int = SAMPLE,
) -> tuple[DataFrame, list[str]]:
    """The rows with four more columns, and the names these got.

    They are evidence (the classifier's probability), host_share, path_share
    (shrunk, without the row's own part) and quality (0 to 1). A null host or
    path is a site of its own. A null or empty text gives no evidence: its
    evidence is the training share and its quality the path's share. Several
    labels of a document count by their mean, half or more being good; null
    labels don't count. Without labels of both kinds there is no evidence, and
    each quality is one half. Further columns pass through.
    """
    text = column(docs, text_col)
    row_names = free_names(docs, "evidence", "host_share", "path_share", "quality")
    model, trained = _fit(docs, labels, id_col, text_col, sample)
    margin, n, s, hs, host, path = free_names(docs, "q_margin", "q_n", "q_sum", "q_host", "q_host_key", "q_path_key")
    # The classifier reads each text once; sums and rows both come from what it left.
    scored = scratch.write(_scored(docs, text, model, trained, margin), "scored")
    good = _logistic(F.col(margin))
    sites = (
        scored.groupBy(column(scored, host_col).alias(host), column(scored, path_col).alias(path))
        .agg(F.count("*").alias(n), F.sum(good).alias(s))
    )
    sites = scratch.write(sites, "sites")
    hosts = scratch.write(sites.groupBy(host).agg(F.sum(n).alias(n), F.sum(s).alias(s)), "hosts")
    priors = _priors(sites, hosts, host, n, s)
    host_share = (F.col(s) + priors.host_weight * priors.share) / (F.col(n) + priors.host_weight)
    named = hosts.select(F.col(host).alias(hs + "k"), host_share.alias(hs))
    sites = scratch.write(sites.join(named, F.col(host).eqNullSafe(F.col(hs + "k"))).drop(hs + "k"), "site-shares")
    joined = scored.join(
        sites, column(scored, host_col).eqNullSafe(F.col(host)) & column(scored, path_col).eqNullSafe(F.col(path))
    )
    rest = F.greatest(F.col(s) - good, F.lit(0.0))
    path_share = (rest + priors.path_weight * F.col(hs)) / (F.col(n) - 1 + priors.path_weight)
    evidence, host_name, path_name, final = row_names
    out = joined.withColumns({evidence: good, host_name: F.col(hs), path_name: path_share})
    odds = F.col(margin) - F.lit(_logit(trained)) + F.log(_inside(F.col(path_name)) / (1 - _inside(F.col(path_name))))
    return out.withColumn(final, _logistic(odds)).drop(margin, n, s, hs, host, path), row_names


def _fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, sample: int) -> tuple[PipelineModel | None, float]:
    """The fitted classifier and the share of good documents in its sample."""
    marks = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.avg("quality").alias("mean"))
    marks = marks.select("doc_id", (F.col("mean") >= 0.5).cast("double").alias("label"))
    marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select(column(docs, id_col).alias("doc_id"), column(docs, text_col).alias("text"))
    rows = texts.join(marks, "doc_id").select("label", "text")
    rows = _styled(rows.filter(F.length("text") > 0), F.col("text"))
    rows = rows.cache()
    try:
        counts = rows.agg(F.sum("label"), F.count("*")).first()
        if not counts[1] or counts[0] in (0, counts[1]):
            return None, 0.5
        words = RegexTokenizer(inputCol="text", outputCol="style_words", pattern=WORD, gaps=False)
        hashed = HashingTF(inputCol="style_words", outputCol="style_hashed", numFeatures=_HASHED, binary=True)
        unit = Normalizer(inputCol="style_hashed", outputCol="style_unit")
        all_ = VectorAssembler(inputCols=["style_unit", *_STYLE], outputCol="style_all")
        model = LogisticRegression(
            featuresCol="style_all", labelCol="label", rawPredictionCol="style_raw", probabilityCol="",
            predictionCol="", regParam=2e-4, standardization=False, maxIter=60,
        )
        return Pipeline(stages=[words, hashed, unit, all_, model]).fit(rows), counts[0] / counts[1]
    finally:
        rows.unpersist()


def _scored(docs: DataFrame, text: Column, model: PipelineModel | None, trained: float, margin: str) -> DataFrame:
    """The rows with the classifier's log odds."""
    if model is None:
        return docs.withColumn(margin, F.lit(0.0))
    # The rows travel through the classifier as one column, so that no name of theirs can clash with its own.
    packed = docs.select(F.struct(*(column(docs, c) for c in docs.columns)).alias("row"), F.coalesce(text, F.lit("")).alias("text"))
    raw = model.transform(_styled(packed, F.col("text")))
    odds = F.when(F.length("text") > 0, vector_to_array("style_raw")[1]).otherwise(_logit(trained))
    return raw.select("row", odds.alias("odds")).select("row.*", F.col("odds").alias(margin))


def _styled(rows: DataFrame, text: Column) -> DataFrame:
    """Measures of style, about 0 to 1 each."""
    rows = rows.withColumn("style_parts", F.split(text, r"\s+"))
    size = F.greatest(F.length(text), F.lit(1)).cast("double")
    n = F.size("style_parts").cast("double")
    styled = rows.withColumns(
        {
            "style_upper": F.regexp_count(text, F.lit(r"\p{Lu}")) / size,
            "style_mark": F.least(8 * F.regexp_count(text, F.lit(r"[^\p{L}\p{N}\s.,]++")) / size, F.lit(2.0)),
            "style_distinct": F.size(F.array_distinct("style_parts")) / n,
            "style_long": F.least(size / n / 12, F.lit(2.0)),
            "style_size": F.log1p(n) / 10,
        }
    )
    return styled.drop("style_parts")


def _priors(sites: DataFrame, hosts: DataFrame, host: str, n: str, s: str) -> Priors:
    """The corpus's share and the weights, from sums over hosts and over paths within their hosts."""
    total, good = hosts.agg(F.sum(n), F.sum(s)).first()
    share = good / total if total else 0.5
    between = hosts.agg(
        F.count("*"), F.sum(n), F.sum(F.col(n) * F.col(n)), F.sum(F.col(n) * F.pow(F.col(s) / F.col(n) - share, 2))
    ).first()
    inside = hosts.select(F.col(host).alias("k"), (F.col(s) / F.col(n)).alias("mean"), F.col(n).alias("all"))
    paths = sites.join(inside, F.col(host).eqNullSafe(F.col("k")))
    within = paths.agg(
        F.count("*"),
        F.sum(n),
        F.sum(F.col(n) * F.col(n) / F.col("all")),
        F.sum(F.col(n) * F.pow(F.col(s) / F.col(n) - F.col("mean"), 2)),
    ).first()
    n_hosts = between[0] or 0
    return Priors(
        share,
        _weight(share, n_hosts - 1, (between[1] or 0) - (between[2] or 0) / max(between[1] or 0, 1), between[3] or 0.0),
        _weight(share, (within[0] or 0) - n_hosts, (within[1] or 0) - (within[2] or 0.0), within[3] or 0.0),
    )


def _weight(share: float, freedom: float, size: float, spread: float) -> float:
    """Documents that a prior counts for: few where sites differ much, many where they differ by chance."""
    chance = share * (1 - share)
    if freedom <= 0 or chance <= 0 or size <= freedom:
        return 1000.0
    excess = (spread - chance * freedom) / (chance * (size - freedom))
    return min(max(1 / excess - 1, 1.0), 1000.0) if excess > 0 else 1000.0


def _inside(share: Column) -> Column:
    return F.least(F.greatest(share, F.lit(1e-4)), F.lit(1 - 1e-4))


def _logistic(odds: Column) -> Column:
    return 1 / (1 + F.exp(-odds))


def _logit(share: float) -> float:
    return math.log(share / (1 - share))
