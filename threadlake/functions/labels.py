"""Category labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds and the names reports use.
POSITIVE_FROM = 0.05
NEGATIVE_UP_TO = -0.05
FAST_HOURS = 6
MEDIUM_HOURS = 24
FAST, MEDIUM, SLOW = "fast (<=6h)", "medium (6-24h)", "slow (>24h)"


def sentiment_label(score: Column) -> Column:
    return (
        F.when(score >= POSITIVE_FROM, "positive")
        .when(score <= NEGATIVE_UP_TO, "negative")
        .otherwise("neutral")
    )


def speed_category(hours_to_peak: Column) -> Column:
    """Unknown hours count as slow."""
    return (
        F.when(hours_to_peak <= FAST_HOURS, FAST)
        .when(hours_to_peak <= MEDIUM_HOURS, MEDIUM)
        .otherwise(SLOW)
    )
