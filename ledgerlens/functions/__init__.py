"""Column expressions shared by the operators."""

from ledgerlens.functions.columns import (
    bisect_right,
    clock_hour,
    guarded_ratio,
    hash_bucket,
    positive_probability,
    threshold_label,
)
from ledgerlens.functions.metrics import METRICS, Metric, haversine

__all__ = [
    "METRICS",
    "Metric",
    "bisect_right",
    "clock_hour",
    "guarded_ratio",
    "hash_bucket",
    "haversine",
    "positive_probability",
    "threshold_label",
]
