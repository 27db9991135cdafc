"""Principal components of the features."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens import schema as S
from ledgerlens.operators.scaling import assembler


def project(
    df: DataFrame, keep: Sequence[str], features: Sequence[str] = S.MODEL_FEATURES, k: int = 2
) -> DataFrame:
    """The kept columns and coordinates pc1 .. pck of every row.

    Features are centred, not scaled. Of each component the loading of largest
    magnitude is positive, which settles the sign.
    """
    raw = assembler(features).transform(df.select(*dict.fromkeys([*keep, *features])))
    centred = StandardScaler(inputCol="raw", outputCol="centred", withMean=True, withStd=False)
    rows = centred.fit(raw).transform(raw)
    model = PCA(k=k, inputCol="centred", outputCol="scores").fit(rows)
    loadings = model.pc.toArray()
    signs = np.sign(loadings[np.abs(loadings).argmax(axis=0), np.arange(k)])
    scores = vector_to_array("scores")
    return model.transform(rows).select(
        *keep, *[(scores.getItem(i) * F.lit(float(signs[i]))).alias(f"pc{i + 1}") for i in range(k)]
    )
