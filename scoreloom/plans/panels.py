"""The table behind each dashboard panel, from the feed with its derived metrics.

``metrics`` is the result of ``champion_metrics``: one row per champion. Values that every
row needs (extremes, median, counts) come from single-row subqueries. Where the dashboard
leaves the order of equal rates open, ties go by champion.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.fixed_values import (
    AXIS_START,
    BASELINE_RATE,
    CURVE_POINTS,
    DEFAULT_TIER,
    HIGHLIGHT_SCALE,
    HISTOGRAM_BINS,
    MAX_SELECTION,
    QUADRANT_DOMINANT,
    QUADRANT_GEM,
    QUADRANT_HIGH_VOLUME,
    QUADRANT_NICHE,
    RADAR_AXES,
    SELECTED_AXIS,
    SLIDER_DEFAULT,
    SMALL_FEED_SCORE,
    TOP_AXIS,
    TOP_BARS,
    TOP_SERIES,
)
from scoreloom.functions import text
from scoreloom.functions.overall import with_one_row
from scoreloom.functions.positions import with_position
from scoreloom.functions.scores import (
    above_baseline_score,
    bubble_size,
    normal_density,
    overall_score,
)
from scoreloom.functions.tiers import tier_bar_color, tier_map_color, tier_table
from scoreloom.operators.feed import best_first

RATE = "win_rate_pct"
PLAYED = "matches_played"
TEXT_PLACES = 9  # decimals of a mean that its text is made of: sums differ beyond with the order


def column_or(df: DataFrame, name: str, default: object) -> Column:
    """A column, or a constant under its name where the feed lacks it."""
    return F.col(name) if name in df.columns else F.lit(default).alias(name)


def _count(weight: str | None, condition: Column | None = None) -> Column:
    """Rows, or the sum of their weights, where a condition holds."""
    if weight is None:
        return F.count(F.lit(1)) if condition is None else F.count_if(condition)
    counted = F.col(weight) if condition is None else F.when(condition, F.col(weight))
    return F.coalesce(F.sum(counted), F.lit(0))


def _mean(weight: str | None) -> Column:
    """Mean of the known rates."""
    if weight is None:
        return F.avg(RATE)
    return F.try_divide(F.sum(F.col(RATE) * F.col(weight)), F.sum(F.when(F.col(RATE).isNotNull(), F.col(weight))))


def _above_baseline(rate: Column) -> Column:
    return F.coalesce(rate >= BASELINE_RATE, F.lit(False))


# --- key figures ------------------------------------------------------------------------


def kpi_summary(metrics: DataFrame) -> DataFrame:
    """Mean rate, its distance to the baseline, the leading champion, and the number of rows.

    The leader is found in the same aggregation as the mean; no sort. No rows, no figures.
    """
    rank = F.struct(F.col(RATE).isNull(), -F.col(RATE), F.col("champion"))
    return (
        metrics.agg(
            F.avg(RATE).alias("avg_wr"),
            F.min_by(F.struct("champion", RATE), rank).alias("top"),
            F.count(F.lit(1)).alias("n_champions"),
        )
        .where(F.col("n_champions") > 0)
        .select(
            "avg_wr",
            (F.col("avg_wr") - BASELINE_RATE).alias("avg_delta"),
            F.col("top.champion").alias("top_champion"),
            F.col("top." + RATE).alias("top_wr"),
            (F.col("top." + RATE) - F.col("avg_wr")).alias("top_minus_avg"),
            "n_champions",
        )
        .withColumns(
            {
                "avg_label": text.percent_1(F.round("avg_wr", TEXT_PLACES)),
                "avg_delta_label": text.trend_label(F.round("avg_delta", TEXT_PLACES)),
                "top_delta_label": text.trend_label(F.round("top_minus_avg", TEXT_PLACES)),
            }
        )
    )


def spark_all(metrics: DataFrame) -> DataFrame:
    """All rates in ascending order, as ``pos, value``."""
    return with_position(metrics.select("champion", RATE), RATE, "champion").select(
        "pos", F.col(RATE).alias("value")
    )


def spark_top5(metrics: DataFrame) -> DataFrame:
    """The five highest rates in ascending order, as ``pos, value``."""
    top = best_first(metrics.select("champion", RATE)).limit(TOP_SERIES)
    # Unknown rates were last and become first when the five are reversed.
    reversed_values = F.sort_array(F.collect_list(F.struct(F.col(RATE).alias("value"))))
    return top.agg(reversed_values.alias("v")).select(F.posexplode("v").alias("pos", "v")).select(
        "pos", F.col("v.value").alias("value")
    )


def tier_counts(metrics: DataFrame, weight: str | None = None) -> DataFrame:
    """Champions per tier, C to S, with 0 for a tier without any.

    Without the column ``tier`` all rows count for the default tier. ``weight`` names a column of the number of
    champions that a row stands for, here and in the other panels that take it.
    """
    spark = metrics.sparkSession
    counts = F.count("champion") if "tier" in metrics.columns else F.count(F.lit(1))
    if weight is not None:
        counts = _count(weight)
    tier = column_or(metrics, "tier", DEFAULT_TIER)
    counted = metrics.select(tier, weight or "champion").groupBy("tier").agg(counts.alias("n"))
    return (
        tier_table(spark, worst_first=True)
        .join(counted, "tier", "left")
        .select(F.col("tier_rank").alias("pos"), "tier", F.coalesce("n", F.lit(0)).alias("value"))
    )


# --- overview ---------------------------------------------------------------------------


def top_rates(metrics: DataFrame, n: int = TOP_BARS) -> DataFrame:
    """The highest rates, shown in ascending order, with bar texts and colours' class."""
    top = best_first(
        metrics.select("champion", RATE, PLAYED, column_or(metrics, "tier", "—"))
    ).limit(n)
    rate = F.col(RATE)
    return top.select(
        "*",
        _above_baseline(rate).alias("above_baseline"),
        F.concat(F.lit("  "), text.percent_1(rate)).alias("label"),
        text.thousands(F.col(PLAYED)).alias("matches_label"),
    ).orderBy(F.asc_nulls_last(RATE), F.desc("champion"))


def axis_upper(df: DataFrame, margin: float, least: float) -> DataFrame:
    """Upper end of a rate axis: the highest rate plus a margin, and at least ``least``."""
    return df.agg(F.greatest(F.max(RATE) + margin, F.lit(least)).alias("x_max"))


def axis_bounds(metrics: DataFrame) -> DataFrame:
    """Rate axes of the top bars and of the comparison bars."""
    bars = axis_upper(top_rates(metrics), *TOP_AXIS).select(F.lit("top").alias("panel"), "x_max")
    shown = axis_upper(deep_dive(metrics, []), *SELECTED_AXIS)
    return bars.unionByName(shown.select(F.lit("selected").alias("panel"), "x_max")).select(
        "panel", F.lit(AXIS_START).alias("x_min"), "x_max"
    )


def _volume_split(weight: str | None = None) -> dict[str, Column]:
    median = F.median(PLAYED) if weight is None else F.percentile(PLAYED, F.lit(0.5), F.col(weight))
    return {
        "median_played": median,
        "min_played": F.min(PLAYED),
        "max_played": F.max(PLAYED),
    }


def volume_split(metrics: DataFrame, weight: str | None = None) -> DataFrame:
    """Median, smallest and largest volume.

    The exact median keeps one counter per distinct volume. Volumes are counts that add up to
    all games, so among g games there are at most sqrt(2g) distinct ones.
    """
    return metrics.agg(*[value.alias(name) for name, value in _volume_split(weight).items()])


def volume_points(metrics: DataFrame, highlighted: str | None = None) -> DataFrame:
    """Volume against rate: marker size and symbol, and the quadrant of each champion.

    Quadrants split at the median volume and the baseline; a value on a line counts as above.
    """
    played, split = F.col(PLAYED), F.col("split")
    chosen = F.coalesce(F.col("champion") == F.lit(highlighted), F.lit(False))
    size = bubble_size(played, split["min_played"], split["max_played"])
    strong = _above_baseline(F.col(RATE))
    popular = played >= split["median_played"]
    return with_one_row(metrics, "split", **_volume_split()).select(
        "champion",
        PLAYED,
        RATE,
        column_or(metrics, "tier", "—"),
        strong.alias("above_baseline"),
        F.when(chosen, size * HIGHLIGHT_SCALE).otherwise(size).alias("bubble_size"),
        F.when(chosen, "star").otherwise("circle").alias("symbol"),
        F.when(strong & popular, QUADRANT_DOMINANT)
        .when(strong, QUADRANT_GEM)
        .when(popular, QUADRANT_HIGH_VOLUME)
        .otherwise(QUADRANT_NICHE)
        .alias("quadrant"),
    )


# --- distribution -----------------------------------------------------------------------


def _with_bins(df: DataFrame, metrics: DataFrame) -> DataFrame:
    """Add ``first``, ``last`` and ``step``: the ends and bin width of the histogram.

    The range is widened by half a point on each side when all rates are equal.
    """
    low, high = F.col("ends.low"), F.col("ends.high")
    first = F.when(low == high, low - 0.5).otherwise(low)
    last = F.when(low == high, high + 0.5).otherwise(high)
    return (
        with_one_row(df, "ends", of=metrics, low=F.min(RATE), high=F.max(RATE))
        .withColumns({"first": first, "last": last})
        .withColumn("step", (F.col("last") - F.col("first")) / HISTOGRAM_BINS)
        .drop("ends")
    )


def rate_histogram(metrics: DataFrame, weight: str | None = None) -> DataFrame:
    """Equal-width histogram of the rates: ``bin, lo, hi, center, width, n``.

    A rate belongs to the last bin whose left edge it reaches, so the highest rate falls into
    the last bin. Comparing with the edges is exact where dividing by the width is not. One
    aggregation counts the rates that reach each edge; neighbours differ by a bin's count.
    """
    first, last, step = F.col("first"), F.col("last"), F.col("step")
    reached = [_count(weight, F.col(RATE) >= step * k + first) for k in range(HISTOGRAM_BINS)]
    values = metrics.select(RATE, *([weight] if weight else []))
    totals = _with_bins(values, metrics).agg(
        *[F.max(end).alias(end) for end in ("first", "last", "step")],
        *[count.alias(f"reached_{k}") for k, count in enumerate(reached)],
    )

    def bin_row(k: int) -> Column:
        is_last = k == HISTOGRAM_BINS - 1
        above = F.lit(0) if is_last else F.col(f"reached_{k + 1}")
        return F.struct(
            F.lit(k).cast("long").alias("bin"),
            (step * k + first).alias("lo"),
            (last if is_last else step * (k + 1) + first).alias("hi"),
            ((step + first) - first).alias("width"),
            (F.col(f"reached_{k}") - above).alias("n"),
        )

    center = (F.col("lo") + F.col("hi")) / 2
    bins = totals.select(F.inline(F.array(*[bin_row(k) for k in range(HISTOGRAM_BINS)])))
    return bins.select(
        "bin",
        "lo",
        "hi",
        center.alias("center"),
        "width",
        "n",
        (center >= BASELINE_RATE).alias("above_baseline"),
    )


def rate_moments(metrics: DataFrame, weight: str | None = None) -> DataFrame:
    """Mean and population deviation of the rates, and the number of rows."""
    if weight is not None:
        centred = with_one_row(metrics, "over_all", mean=_mean(weight)).withColumn(
            "square", F.pow(F.col(RATE) - F.col("over_all.mean"), 2) * F.col(weight)
        )
        known = F.sum(F.when(F.col(RATE).isNotNull(), F.col(weight)))
        return centred.agg(
            F.max("over_all.mean").alias("mean_wr"),
            F.sqrt(F.try_divide(F.sum("square"), known)).alias("std_wr"),
            _count(weight).alias("n"),
        )
    return metrics.agg(
        F.avg(RATE).alias("mean_wr"),
        F.stddev_pop(RATE).alias("std_wr"),
        F.count(F.lit(1)).alias("n"),
    )


def normal_curve(metrics: DataFrame, points: int = CURVE_POINTS) -> DataFrame:
    """The normal curve over the histogram: ``i, x, y``, scaled to its counts.

    With equal rates the deviation is 0, the curve is undefined, and ``y`` is null.
    """
    grid = metrics.sparkSession.range(points).withColumnRenamed("id", "i")
    fitted = with_one_row(
        _with_bins(grid, metrics),
        "fit",
        of=metrics,
        n=F.count(F.lit(1)),
        mean=F.avg(RATE),
        deviation=F.stddev_pop(RATE),
        low=F.min(RATE),
        high=F.max(RATE),
    )
    i, fit = F.col("i"), F.col("fit")
    start, stop = fit["low"] - 1, fit["high"] + 1
    x = F.when(i == points - 1, stop).otherwise(i * ((stop - start) / (points - 1)) + start)
    density = normal_density(F.col("x"), fit["mean"], fit["deviation"])
    return fitted.withColumn("x", x).select(
        "i", "x", (density * fit["n"] * F.col("step")).alias("y")
    )


# --- tiers ------------------------------------------------------------------------------


def tier_summary(metrics: DataFrame, weight: str | None = None) -> DataFrame:
    """Champions and mean rate per tier, best tier first, with text and colour."""
    counts = F.count("champion") if weight is None else _count(weight)
    per_tier = (
        metrics.select(weight or "champion", RATE, column_or(metrics, "tier", DEFAULT_TIER))
        .groupBy("tier")
        .agg(counts.alias("n"), _mean(weight).alias("avg_wr"))
    )
    return (
        per_tier.join(tier_table(metrics.sparkSession), "tier")
        .select(
            "tier_rank",
            "tier",
            "n",
            "avg_wr",
            text.tier_label(F.round("avg_wr", TEXT_PLACES), F.col("n")).alias("label"),
            tier_map_color(F.col("tier")).alias("color"),
        )
        .orderBy("tier_rank")
    )


def tier_attributes(metrics: DataFrame) -> DataFrame:
    """Both tier colours of every champion."""
    return metrics.select(
        "champion",
        "tier",
        tier_map_color(F.col("tier")).alias("map_color"),
        tier_bar_color(F.col("tier")).alias("bar_color"),
    )


# --- selection and comparison -----------------------------------------------------------


def options(metrics: DataFrame) -> DataFrame:
    """The list to choose champions from: ``rank, value, label, search, icon, color``."""
    listed = metrics.select("champion", RATE, column_or(metrics, "tier", DEFAULT_TIER))
    champion, tier = F.col("champion"), F.col("tier")
    return with_position(listed, RATE, "champion", descending=True, name="rank").select(
        "rank",
        champion.alias("value"),
        text.option_label(champion, tier).alias("label"),
        champion.alias("search"),
        text.icon_url(champion).alias("icon_url"),
        tier_map_color(tier).alias("border_color"),
    )


def in_range(metrics: DataFrame, rate_range: tuple[float, float] | None = None) -> DataFrame:
    """Champions within the slider, both ends included; the whole slider when unset."""
    low, high = rate_range or SLIDER_DEFAULT
    return metrics.where(F.col(RATE).between(low, high))


def default_selection(
    metrics: DataFrame, rate_range: tuple[float, float] | None = None
) -> DataFrame:
    """The five highest rates within the slider."""
    return best_first(in_range(metrics, rate_range)).limit(MAX_SELECTION)


def _selection_rows(metrics: DataFrame, selected: Sequence[str]) -> DataFrame:
    """The selected names that exist, with their place in the selection.

    Bounded by the selection; the name test reaches the scan of the feed.
    """
    spark = metrics.sparkSession
    asked = spark.createDataFrame(list(enumerate(selected)), "place int, champion string")
    known = metrics.where(F.col("champion").isin(list(selected))).select("champion")
    return asked.join(known, "champion", "left_semi")


def deep_dive(
    metrics: DataFrame,
    selected: Sequence[str],
    rate_range: tuple[float, float] | None = None,
) -> DataFrame:
    """The champions to compare, in ascending order of rate, with their bar texts.

    Those of the selection that exist, whatever the slider says; the slider only limits the
    default selection, which is shown when nothing valid is selected.
    """
    shown = default_selection(metrics, rate_range)
    if selected:
        chosen = metrics.where(F.col("champion").isin(list(selected)))
        n_chosen = chosen.agg(F.count(F.lit(1))).scalar()
        shown = chosen.unionByName(shown.where(n_chosen == 0))
    return comparison_rows(shown).orderBy(F.asc_nulls_last(RATE), "champion")


def comparison_rows(metrics: DataFrame) -> DataFrame:
    """Bar texts and colour of each champion."""
    rate, tier = F.col(RATE), column_or(metrics, "tier", DEFAULT_TIER)
    delta = text.baseline_delta(rate)
    return metrics.select(
        "champion",
        RATE,
        delta.alias("delta"),
        text.rate_label(rate).alias("label"),
        text.signed_1(delta).alias("delta_label"),
        tier,
        PLAYED,
        text.thousands(F.col(PLAYED)).alias("matches_label"),
        tier_bar_color(tier).alias("color"),
    )


def radar(
    metrics: DataFrame,
    selected: Sequence[str],
    rate_range: tuple[float, float] | None = None,
) -> DataFrame:
    """Four scores per compared champion: ``place, champion, axis_pos, axis, value``.

    At most five champions in selection order, the default selection when none is valid, and
    no rows for fewer than two. The first axis comes again at the end to close the shape.
    """
    shape = F.struct(
        column_or(metrics, "wr_normalized", SMALL_FEED_SCORE).alias("rate"),
        column_or(metrics, "pop_normalized", SMALL_FEED_SCORE).alias("played"),
        column_or(metrics, "win_rate_delta", 0.0).alias("delta"),
    ).alias("shape")
    best_row = F.struct(F.col(RATE).isNull(), -F.col(RATE), F.col(PLAYED))

    fallback = _numbered(default_selection(metrics, rate_range))
    places = fallback
    if selected:
        valid = _selection_rows(metrics, selected)
        n_valid = valid.agg(F.count(F.lit(1))).scalar()
        places = valid.unionByName(fallback.where(n_valid == 0))

    # Places are few: five by default, otherwise the length of the selection.
    in_order = Window.orderBy("place")
    every = Window.partitionBy(F.lit(1))
    first_five = (
        places.select(
            "champion",
            (F.row_number().over(in_order) - 1).alias("place"),
            F.count(F.lit(1)).over(every).alias("n"),
        )
        .where((F.col("n") >= 2) & (F.col("place") < MAX_SELECTION))
        .drop("n")
    )
    # One row per champion: the one listed first in the feed's order.
    candidates = metrics.select("champion", shape, best_row.alias("rank"))
    compared = (
        first_five.join(candidates, "champion")
        .groupBy("place", "champion")
        .agg(F.min_by("shape", "rank").alias("shape"))
    )
    rate, played = F.col("shape.rate"), F.col("shape.played")
    values = [
        rate,
        played,
        above_baseline_score(F.col("shape.delta")),
        overall_score(rate, played),
    ]
    axes = F.array(
        *[
            F.struct(F.lit(axis).alias("axis"), value.cast("double").alias("value"))
            for axis, value in zip([*RADAR_AXES, RADAR_AXES[0]], [*values, values[0]])
        ]
    )
    points = compared.select("place", "champion", F.posexplode(axes).alias("axis_pos", "point"))
    return points.select("place", "champion", "axis_pos", "point.axis", "point.value")


def _numbered(top: DataFrame) -> DataFrame:
    """Places of an already limited list, best first."""
    best = Window.orderBy(F.desc_nulls_last(RATE), "champion")
    return top.select((F.row_number().over(best) - 1).alias("place"), "champion")


def selected_champions(metrics: DataFrame, selected: Sequence[str]) -> DataFrame:
    """The selected champions that exist, in selection order."""
    return _selection_rows(metrics, selected).select("place", "champion")


def champion_row(metrics: DataFrame, champion: str) -> DataFrame:
    """The first feed row of one champion."""
    return best_first(metrics.where(F.col("champion") == F.lit(champion))).limit(1)


def icons(metrics: DataFrame) -> DataFrame:
    return metrics.select("champion", text.icon_url(F.col("champion")).alias("icon_url"))
