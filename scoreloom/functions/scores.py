"""Scores and scalings of rates and volumes."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from scoreloom.fixed_values import (
    ABOVE_BASELINE_SCALE,
    ABOVE_BASELINE_SHIFT,
    BUBBLE_MIN,
    BUBBLE_SPAN,
)

EPSILON = 1e-9


def min_max_score(x: Column, low: Column, high: Column) -> Column:
    """``x`` on a 0 to 100 scale between ``low`` and ``high``; 0 when they are equal."""
    return (x - low) / F.greatest((high - low).cast("double"), F.lit(EPSILON)) * 100


def bubble_size(x: Column, low: Column, high: Column) -> Column:
    return (x - low) / ((high - low) + F.lit(EPSILON)) * BUBBLE_SPAN + BUBBLE_MIN


def above_baseline_score(delta: Column) -> Column:
    """Distance to the baseline on a 0 to 100 scale, 50 at the baseline itself."""
    clamped = F.least(F.greatest((delta + ABOVE_BASELINE_SHIFT) * ABOVE_BASELINE_SCALE, F.lit(0.0)), F.lit(100.0))
    return F.when(delta.isNotNull(), clamped)


def overall_score(rate_score: Column, played_score: Column) -> Column:
    return (rate_score + played_score) / 2


def normal_density(x: Column, mean: Column, deviation: Column) -> Column:
    """Density of the normal distribution; null when the deviation is 0."""
    deviation = F.nullif(deviation, F.lit(0.0))
    z = (x - mean) / deviation
    return F.lit(1.0) / (deviation * F.lit(math.sqrt(2 * math.pi))) * F.exp(F.lit(-0.5) * z * z)
